"""Classification and ingest of the file names of the reshaped catalogue."""

import uuid

from pyspark.sql import functions as F

from checks.audit_checks import DISK, files_of_documents
from checks.registry import catalogue, query
from tidemark.operators import ingest
from tidemark.operators.trace import trace_products
from tidemark.session import checkpoint_folder, durable
from tidemark.sources import listing as listing_module
from tidemark.sources.key_index import KeyIndex
from tidemark.sources.versions import Versions
from tidemark.streaming.incoming import IncomingSource


def _one_link(t):
    c = catalogue(t)
    link = c.instrumentproductlink.groupBy("product_id").agg(F.min("instrument_id").alias("instrument_id"))
    return c.replace(instrumentproductlink=link.select("instrument_id", "product_id"))


def _rules(t):
    c = _one_link(t)
    # The names of the views end in an event number, which the template leaves open.
    trace = trace_products(c).withColumn("format", F.replace("format", F.lit("{nn}"), F.lit("{EVENT}")))
    return c, trace, ingest.inspection_rules(c, trace)


def _listing(t):
    return t.file.select(
        "filename", F.concat(F.lit("/in/"), "filename").alias("path"), F.col("utc_stop_time").alias("modified"))


# Products with an active inspector and an instrument; one row per file name they claim.
_CLAIMS = """
  claims AS (SELECT f.*, i.inspector_id FROM v_file f JOIN v_inspector i ON i.product = f.product_id AND i.active_code
    WHERE f.product_id IN (SELECT product_id FROM v_instrumentproductlink))
"""


@query(
    "pat01_classify",
    f"""
    WITH {_CLAIMS} SELECT f.filename, c.product_id, CASE WHEN c.file_id IS NULL THEN 'no inspector match' END AS reason
    FROM v_file f LEFT JOIN claims c USING (file_id)
    """,
)
def _(t):
    _c, _trace, rules = _rules(t)
    claimed, rest = ingest.classify(_listing(t), rules)
    return claimed.select("filename", "product_id", F.lit(None).cast("string").alias("reason")).unionByName(
        rest.select("filename", F.lit(None).cast("bigint").alias("product_id"), "reason"))


@query(
    "pat02_extracted_metadata",
    f"""
    WITH {_CLAIMS} SELECT filename, utc_file_date, CAST(utc_file_date AS TIMESTAMP) AS utc_start_time,
      CAST(utc_file_date AS TIMESTAMP) + INTERVAL '86399999999' MICROSECOND AS utc_stop_time, interface_version, quality_version, revision_version, data_level
    FROM claims
    """,
)
def _(t):
    _c, _trace, rules = _rules(t)
    claimed, _rest = ingest.classify(_listing(t), rules)
    return claimed.select("filename", "utc_file_date", "utc_start_time", "utc_stop_time", "interface_version",
                          "quality_version", "revision_version", "data_level")


_OLD = "old AS (SELECT * FROM v_file WHERE NOT exists_on_disk)"
_BATCH = f"""
  {_OLD}, {_CLAIMS}, fresh AS (SELECT * FROM claims WHERE filename NOT IN (SELECT filename FROM old)),
  tagged AS (SELECT f.*, (utc_file_date, product_id, interface_version, quality_version, revision_version) IN
      (SELECT (utc_file_date, product_id, interface_version, quality_version, revision_version) FROM old) AS taken FROM fresh f),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY taken, utc_file_date, product_id, interface_version, quality_version, revision_version ORDER BY filename) AS rk FROM tagged),
  good AS (SELECT *, (SELECT max(file_id) FROM old) + row_number() OVER (ORDER BY filename) AS new_id FROM ranked WHERE NOT taken AND rk = 1)
"""


def _batch(t):
    c, trace, rules = _rules(t)
    return ingest.ingest_batch(_listing(t), c.replace(file=t.file.where("NOT exists_on_disk")), rules, trace, "/data")


@query(
    "ing01_accepted",
    f"WITH {_BATCH} SELECT new_id AS file_id, filename, product_id FROM good",
)
def _(t):
    return _batch(t).accepted.select("file_id", "filename", "product_id")


@query(
    "ing01_quarantine",
    f"""
    WITH {_BATCH} SELECT filename, 'name already in the catalogue' AS reason FROM old
    UNION ALL SELECT filename, 'no inspector match' FROM v_file WHERE filename NOT IN (SELECT filename FROM old) AND file_id NOT IN (SELECT file_id FROM claims)
    UNION ALL SELECT filename, 'version already in the catalogue' FROM ranked WHERE taken
    UNION ALL SELECT filename, 'version twice in the batch' FROM ranked WHERE NOT taken AND rk > 1
    """,
)
def _(t):
    return _batch(t).quarantine.select("filename", "reason")


@query(
    "ing02_moves",
    f"WITH {_BATCH} SELECT new_id AS file_id, concat('/in/', filename) AS path, TRUE AS needs_move FROM good",
)
def _(t):
    return _batch(t).moves.select("file_id", "path", "needs_move")


@query(
    "ing03_not_ingested",
    """
    SELECT f.product_id, f.filename FROM v_file f WHERE f.product_id % 3 = 2 AND f.product_id IN (SELECT product_id FROM v_instrumentproductlink)
      AND (f.product_id, f.filename) NOT IN (SELECT (product_id, filename) FROM v_file WHERE exists_on_disk)
    """,
)
def _(t):
    # Only every third product lies in the flat folder that is listed here.
    _c, trace, _rules_ = _rules(t)
    found = listing_module.product_files(
        t.file.select(F.concat(F.lit("flat/"), "filename").alias("relative_path")),
        listing_module.path_patterns(trace))
    return ingest.not_ingested(found, t.file.where("exists_on_disk")).select("product_id", "filename")


def _indexed(t, *parts):
    """An index of file names and versions, grown by `parts` of a file table, at its newest version."""
    folder = f"{checkpoint_folder(t.spark)}/indexed/{uuid.uuid4().hex}"
    versions = Versions(t.spark, folder, merge=2)
    index = KeyIndex(versions, "file", {"name": ["filename"], "version": list(ingest.UNIQUE)}, buckets=32)
    manifest = versions.manifest()
    for number, part in enumerate(parts):
        manifest = versions.append(number, index.rows(part))
    return index, manifest


@query(
    "join06_names_not_catalogued",
    "SELECT filename FROM v_file WHERE filename NOT IN (SELECT filename FROM v_file_other)",
)
def _(t):
    index, manifest = _indexed(t, t.file_other)
    _there, others = index.split(t.file.select("filename"), "name", manifest)
    return others


@query(
    "src06_keys_present",
    """
    SELECT filename, 'name' AS kind FROM v_file WHERE filename IN (SELECT filename FROM v_file_other)
    UNION ALL SELECT filename, 'version' FROM v_file WHERE (utc_file_date, product_id, interface_version, quality_version, revision_version) IN
      (SELECT (utc_file_date, product_id, interface_version, quality_version, revision_version) FROM v_file_other)
    """,
)
def _(t):
    # The index grows by three appends, of which the first two are merged.
    index, manifest = _indexed(t, *[t.file_other.where(F.col("file_id") % 3 == part) for part in range(3)])
    found = [index.split(t.file, kind, manifest)[0].select("filename", F.lit(kind).alias("kind")) for kind in ("name", "version")]
    return found[0].unionByName(found[1])


@query(
    "ing01_indexed",
    f"WITH {_BATCH} SELECT new_id AS file_id, filename, product_id FROM good",
)
def _(t):
    c, trace, rules = _rules(t)
    old = t.file.where("NOT exists_on_disk")
    index, manifest = _indexed(t, old.where("file_id % 2 = 0"), old.where("file_id % 2 = 1"))
    known = ingest.Known(
        names=lambda rows: index.split(rows, "name", manifest), versions=lambda rows: index.split(rows, "version", manifest),
        highest=old.agg(F.max("file_id")).first()[0],
    )
    out = ingest.ingest_batch(_listing(t), c, rules, trace, "/data", known=known)
    return out.accepted.select("file_id", "filename", "product_id")


@query("str01_incoming_stream", f"SELECT filename, CAST(strlen(content) AS BIGINT) AS length, sha1(content) AS shasum FROM ({DISK}) WHERE doc_id % 11 <> 3")
def _(t):
    folder, _files = files_of_documents(t)
    work = f"{checkpoint_folder(t.spark)}/streamed/{uuid.uuid4().hex}"
    versions = Versions(t.spark, work)
    t.spark.dataSource.register(IncomingSource)

    def publish(listing, _batch):
        rows = durable(listing)
        for r in rows.select("snapshot").distinct().orderBy("snapshot").collect():
            versions.append(r.snapshot, {"listing": rows.where(F.col("snapshot") == r.snapshot)})

    reader = t.spark.readStream.format("tidemark_incoming").option("snapshots", f"{work}/marks").option("recursive", "true")
    stream = reader.option("files_per_batch", 20_000).load(folder).writeStream.foreachBatch(publish)
    stream.option("checkpointLocation", f"{work}/mark").trigger(availableNow=True).start().awaitTermination()
    return versions.read("listing", versions.manifest()).select("filename", "length", "shasum")


@query(
    "ing04_names_to_fetch",
    """
    SELECT filename, concat('/src/', filename) AS path FROM v_file WHERE filename NOT LIKE 'p1%_v2.%' AND quality_version <> 3
      AND NOT (filename LIKE 'p%' AND filename IN (SELECT filename FROM v_file_other WHERE data_level = 1.0)) AND exists_on_disk
      AND filename NOT IN (SELECT filename FROM v_file WHERE revision_version = 6)
    """,
)
def _(t):
    source = t.file.select(F.concat(F.lit("/src/"), "filename").alias("path"))
    return ingest.names_to_fetch(
        source, t.file_other.where("data_level = 1.0"), t.file.where("NOT exists_on_disk"),
        failed=t.file.where("revision_version = 6"), ignore=["*/p1*_v2.*", "*_v?.3.*"], like="p%",
    ).select("filename", "path")


@query(
    "ing05_substitutes",
    """
    WITH a AS (SELECT DISTINCT product_id, utc_file_date FROM v_file WHERE exists_on_disk AND quality_version < 2),
    b AS (SELECT product_id, utc_file_date, max(filename) AS filename FROM v_file GROUP BY 1, 2)
    SELECT product_id, utc_file_date AS day, filename, concat('quick_', strftime(utc_file_date, '%Y%m%d'), '.dat') AS link_name FROM b
    WHERE (product_id, utc_file_date) NOT IN (SELECT (product_id, utc_file_date) FROM a)
    """,
)
def _(t):
    a = t.file.where("exists_on_disk AND quality_version < 2").select("product_id", "filename")
    return ingest.substitutes(a, t.file.select("product_id", "filename"), "quick_XXXX.dat", by=("product_id",))
