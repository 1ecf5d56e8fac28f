"""Filters, newest versions, lookups, listings and trace-back joins."""

import datetime as dt

from pyspark.sql import functions as F

from checks.registry import catalogue, query
from tidemark.operators import audit, workset
from tidemark.operators import catalogue as cat
from tidemark.operators import trace
from tidemark.operators.skew import join_to_groups

# Newest of the rows of `src`, ties broken by the highest id.
_RANK = """row_number() OVER (PARTITION BY product_id, utc_file_date
  ORDER BY interface_version DESC, quality_version DESC, revision_version DESC, file_id DESC)"""
NEWEST = f"newest AS (SELECT * FROM (SELECT *, {_RANK} AS rk FROM v_file) WHERE rk = 1)"


def ranked(where: str, columns: str = "file_id") -> str:
    return (
        f"SELECT {columns} FROM (SELECT *, {_RANK} AS rk FROM v_file WHERE {where}) WHERE rk = 1"
    )


@query(
    "cat01_filtered_files",
    """
    SELECT f.file_id, f.filename FROM v_file f
    JOIN v_filecodelink c ON c.resulting_file = f.file_id JOIN v_instrumentproductlink i ON i.product_id = f.product_id
    WHERE f.exists_on_disk AND f.data_level = 1.0 AND c.source_code = 8 AND i.instrument_id = 5
      AND f.utc_file_date BETWEEN DATE '2024-01-03' AND DATE '2024-01-25'
      AND f.utc_stop_time >= TIMESTAMP '2024-01-03 06:00:00' AND f.utc_start_time < TIMESTAMP '2024-01-24 18:00:01'
    """,
)
def _(t):
    return cat.select_files(
        catalogue(t), start_date="2024-01-03", end_date=dt.date(2024, 1, 25), level=1.0, code=8, instrument=5,
        exists=True, start_time=dt.datetime(2024, 1, 3, 6), end_time=dt.datetime(2024, 1, 24, 18),
    ).select("file_id", "filename")


@query("cat02_newest_version", ranked("TRUE", "file_id, filename, product_id, utc_file_date"))
def _(t):
    return cat.newest(t.file).select("file_id", "filename", "product_id", "utc_file_date")


@query("cat02_newest_on_disk", ranked("exists_on_disk AND utc_file_date <= DATE '2024-01-20'"))
def _(t):
    return cat.select_files(
        catalogue(t), exists=True, end_date="2024-01-20", newest_version=True
    ).select("file_id")


@query(
    "cat03_limit_before_newest",
    f"""
    WITH cut AS (SELECT * FROM v_file ORDER BY interface_version, quality_version, revision_version, file_id LIMIT 500)
    SELECT file_id FROM (SELECT *, {_RANK} AS rk FROM cut) WHERE rk = 1
    """,
)
def _(t):
    return cat.select_files(catalogue(t), limit=500, newest_version=True).select("file_id")


@query(
    "cat04_time_overlap",
    """
    SELECT file_id FROM v_file WHERE trunc(epoch_us(utc_stop_time) / 1000000) >= epoch_us(TIMESTAMP '2024-01-10 12:00:00') / 1000000
      AND trunc(epoch_us(utc_start_time) / 1000000) <= epoch_us(TIMESTAMP '2024-01-12 23:59:59') / 1000000
    """,
)
def _(t):
    return cat.in_time_range(
        t.file, dt.datetime(2024, 1, 10, 12, 0, 0, 700000), dt.date(2024, 1, 12)
    ).select("file_id")


@query(
    "cat04_time_open_side",
    "SELECT file_id FROM v_file WHERE utc_stop_time >= TIMESTAMP '2024-01-28 00:00:00.5'",
)
def _(t):
    return cat.in_time_range(
        t.file, dt.datetime(2024, 1, 28, 0, 0, 0, 500000), whole_second=False
    ).select("file_id")


@query(
    "cat06_by_product_and_date",
    ranked("product_id = 8 AND utc_file_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'"),
)
def _(t):
    days = [dt.date(2024, 1, 20), dt.date(2024, 1, 5)]
    return cat.files_by_product_date(catalogue(t), 8, days, newest_version=True).select("file_id")


@query(
    "cat07_by_product_and_time",
    ranked("product_id = 8 AND utc_stop_time >= TIMESTAMP '2024-01-05' AND utc_start_time < TIMESTAMP '2024-01-21'"),
)
def _(t):
    days = [dt.date(2024, 1, 20), dt.date(2024, 1, 5)]
    return cat.files_by_product_time(catalogue(t), 8, days, newest_version=True).select("file_id")


@query("cat08_by_date", ranked("utc_file_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'"))
def _(t):
    days = [dt.date(2024, 1, 20), dt.date(2024, 1, 5)]
    return cat.files_by_date(catalogue(t), days, newest_version=True).select("file_id")


@query(
    "cat09_by_product_name",
    """
    SELECT f.file_id FROM v_file f WHERE f.product_id IN (
      SELECT p.product_id FROM v_product p JOIN orders o ON CAST(o.o_orderkey AS STRING) = CAST(p.product_id AS STRING) OR concat('p', o.o_custkey) = p.product_name)
    """,
)
def _(t):
    o = t.base("orders")
    keys = o.select(F.col("o_orderkey").cast("string").alias("key")).union(
        o.select(F.concat(F.lit("p"), F.col("o_custkey")))
    ).distinct()
    return cat.files_by_product(catalogue(t), keys).select("file_id")


@query(
    "cat10_by_instrument",
    "SELECT f.file_id FROM v_file f JOIN v_instrumentproductlink i USING (product_id) WHERE i.instrument_id = 4 AND f.data_level = 3.0",
)
def _(t):
    return cat.files_by_instrument(catalogue(t), 4, 3.0)


@query(
    "cat11_files_of_codes",
    """
    SELECT f.file_id, min(l.source_code) AS code_id, max(f.filename) AS filename
    FROM v_file f JOIN v_filecodelink l ON l.resulting_file = f.file_id GROUP BY f.file_id
    """,
)
def _(t):
    return cat.code_of_files(catalogue(t)).join(t.file.select("file_id", "filename"), "file_id")


@query(
    "cat11_by_code",
    "SELECT f.file_id FROM v_file f JOIN v_filecodelink l ON l.resulting_file = f.file_id WHERE l.source_code = 8",
)
def _(t):
    return cat.files_by_code(catalogue(t), 8).select("file_id")


@query("cat12_newest_names", ranked("TRUE", "file_id, filename"))
def _(t):
    return cat.newest(t.file).select("file_id", "filename")


# Directory and file name of every file, the product's fields filled in.
FULL_PATH = """
  concat('/data/', replace(replace(CASE p.product_id % 3
    WHEN 0 THEN concat(coalesce(s.r_name, '{SATELLITE}'), '/', coalesce(n.n_name, '{INSTRUMENT}'), '/', p.product_name, '/', strftime(f.utc_file_date, '%Y/%m'))
    WHEN 1 THEN concat('l{LEVEL}/', strftime(f.utc_file_date, '%Y%m%d'), '/', strftime(f.utc_start_time, '%H'))
    ELSE 'flat' END, '//', '/'), '@', ''), '/', f.filename)
"""


@query(
    "cat13_full_paths",
    f"""
    SELECT f.file_id, {FULL_PATH} AS full_path
    FROM v_file f JOIN v_product_full p ON p.product_id = f.product_id
    JOIN v_instrumentproductlink l ON l.product_id = p.product_id
    JOIN nation n ON n.n_nationkey = l.instrument_id JOIN region s ON s.r_regionkey = n.n_regionkey
    """,
)
def _(t):
    c = catalogue(t)
    return cat.full_paths(c.file, trace.trace_products(c), "/data").select("file_id", "full_path")


@query(
    "cat14_file_days",
    "SELECT file_id, CAST(utc_start_time AS DATE) AS first_day, CAST(utc_stop_time AS DATE) AS last_day FROM v_file",
)
def _(t):
    return cat.file_dates(t.file)


@query(
    "cat15_resolve_products",
    """
    WITH k AS (SELECT DISTINCT CASE WHEN event_id % 2 = 0 THEN CAST(user_id + event_id % 3 AS STRING) ELSE concat('p', user_id + event_id % 5) END AS key FROM events)
    SELECT k.key, coalesce(a.product_id, b.product_id) AS id FROM k
    LEFT JOIN v_product a ON CAST(a.product_id AS STRING) = k.key LEFT JOIN v_product b ON b.product_name = k.key
    """,
)
def _(t):
    key = F.expr(
        "CASE WHEN event_id % 2 = 0 THEN CAST(user_id + event_id % 3 AS STRING) ELSE concat('p', user_id + event_id % 5) END"
    )
    return cat.resolve(t.base("events").select(key.alias("key")).distinct(), t.product, "product_id", "product_name")


@query(
    "cat15_resolve_codes",
    """
    SELECT k.filename AS key, c.code_id AS id FROM (SELECT DISTINCT filename FROM v_code_full) k JOIN v_code_full c USING (filename)
    """,
)
def _(t):
    keys = t.code_full.select(F.col("filename").alias("key")).distinct()
    return cat.resolve(keys, t.code_full, "code_id", "filename", all_ids=True)


@query(
    "cat15_resolve_instruments",
    """
    WITH i AS (SELECT n_nationkey AS id, r_name AS nm, n_regionkey AS sat FROM nation JOIN region ON r_regionkey = n_regionkey),
    k AS (SELECT DISTINCT nm AS key, CASE WHEN id % 2 = 0 THEN id END AS satellite_id FROM i)
    SELECT k.key, CAST(k.satellite_id AS BIGINT) AS satellite_id, count(i.id) AS matches,
      CAST(CASE WHEN count(i.id) = 1 THEN min(i.id) END AS BIGINT) AS id
    FROM k LEFT JOIN i ON i.nm = k.key AND (k.satellite_id IS NULL OR k.satellite_id = i.id) GROUP BY ALL
    """,
)
def _(t):
    # Instruments named after their region share names; the own id stands for the satellite.
    i = (
        t.instrument.join(t.satellite, "satellite_id")
        .select("instrument_id", F.col("satellite_name").alias("instrument_name"),
                F.col("instrument_id").alias("satellite_id"))
    )
    keys = i.select(
        F.col("instrument_name").alias("key"),
        F.when(F.col("instrument_id") % 2 == 0, F.col("instrument_id")).alias("satellite_id"),
    ).distinct()
    return cat.resolve_instruments(keys, i)


@query(
    "cat16_is_newest",
    f"SELECT file_id, rk = 1 AS is_newest FROM (SELECT *, {_RANK} AS rk FROM v_file)",
)
def _(t):
    return cat.is_newest(t.file).select("file_id", "is_newest")


@query(
    "cat17_keep_newest",
    f"WITH {NEWEST} SELECT n.file_id FROM newest n JOIN v_processqueue q USING (file_id)",
)
def _(t):
    return cat.keep_newest(t.processqueue.select("file_id"), t.file)


@query(
    "cat18_name_filters",
    """
    SELECT file_id, filename LIKE 'p1%_v2.%' AS liked, regexp_matches(filename, '^p[0-4]._.*_v1\\.[!3]?.*\\.dat$') AS globbed FROM v_file
    WHERE filename LIKE 'p1%_v2.%' OR regexp_matches(filename, '^p[0-4]._.*_v1\\.[^3]\\..*\\.dat$')
    """.replace("[!3]?.*", "[^3]\\..*"),
)
def _(t):
    from tidemark.functions.text import glob_match

    liked = F.col("filename").like("p1%_v2.%")
    globbed = glob_match(F.col("filename"), "p[0-4]?_*_v1.[!3].*.dat")
    return t.file.select("file_id", liked.alias("liked"), globbed.alias("globbed")).where("liked OR globbed")


@query(
    "cat21_dimension_lists",
    """
    SELECT 'level' AS kind, CAST(level AS STRING) AS name, product_id AS id FROM v_product
    UNION ALL SELECT 'instrument', CAST(instrument_id AS STRING), product_id FROM v_instrumentproductlink
    UNION ALL SELECT 'run', output_timebase, process_id FROM v_process WHERE output_timebase = 'RUN'
    UNION ALL SELECT 'code', 'active', code_id FROM v_code WHERE active_code AND newest_version
    UNION ALL SELECT 'timebase', output_timebase, process_id FROM v_process
    """,
)
def _(t):
    c = catalogue(t)

    def listed(df, kind, name, key):
        return df.select(F.lit(kind).alias("kind"), name.cast("string").alias("name"), F.col(key).alias("id"))

    return (
        listed(c.product, "level", F.col("level"), "product_id")
        .union(listed(c.instrumentproductlink, "instrument", F.col("instrument_id"), "product_id"))
        .union(listed(cat.processes(c, "run"), "run", F.col("output_timebase"), "process_id"))
        .union(listed(cat.active_codes(c), "code", F.lit("active"), "code_id"))
        .union(listed(cat.processes(c), "timebase", F.col("output_timebase"), "process_id"))
    )


@query(
    "cat22_product_listing",
    """
    SELECT p.product_id, p.product_name, p.level, n.n_name AS instrument_name, r.r_name AS satellite_name, count(f.file_id) AS n_files
    FROM v_product p JOIN v_instrumentproductlink l USING (product_id) JOIN nation n ON n.n_nationkey = l.instrument_id
    JOIN region r ON r.r_regionkey = n.n_regionkey LEFT JOIN v_file f ON f.product_id = p.product_id
    GROUP BY ALL
    """,
)
def _(t):
    c = catalogue(t)
    return cat.product_listing(trace.trace_products(c), c.file).select(
        "product_id", "product_name", "level", "instrument_name", "satellite_name", "n_files"
    )


@query(
    "cat23_process_listing",
    """
    WITH l AS (SELECT l.process_id, l.optional, p.product_name FROM v_productprocesslink l JOIN v_product p ON p.product_id = l.input_product_id)
    SELECT pr.process_id, pr.process_name, coalesce((SELECT string_agg(product_name, ',' ORDER BY product_name) FROM l WHERE l.process_id = pr.process_id AND NOT optional), '') AS required,
      coalesce((SELECT string_agg(product_name, ',' ORDER BY product_name) FROM l WHERE l.process_id = pr.process_id AND optional), '') AS optional
    FROM v_process_full pr
    """,
)
def _(t):
    return cat.process_inputs(catalogue(t)).select(
        "process_id", "process_name", F.array_join("required", ",").alias("required"),
        F.array_join("optional", ",").alias("optional"),
    )


@query(
    "cat23_required_products",
    """
    SELECT DISTINCT p.product_id, p.product_name FROM v_productprocesslink l JOIN v_product p ON p.product_id = l.input_product_id WHERE NOT l.optional
    """,
)
def _(t):
    return cat.required_inputs(catalogue(t))


@query(
    "cat24_active_inspectors",
    """
    SELECT inspector_id, concat('/data/inspectors/', filename) AS path, arguments, product FROM v_inspector WHERE active_code AND newest_version
    """,
)
def _(t):
    return cat.active_inspectors(catalogue(t), "/data/").drop("description")


@query(
    "cat25_products_on_day",
    "SELECT file_id, filename FROM v_file WHERE utc_file_date = DATE '2024-01-12' AND product_id IN (3, 8, 13)",
)
def _(t):
    day = dt.date(2024, 1, 12)
    return cat.select_files(
        catalogue(t), products=[3, 8, 13], start_date=day, end_date=day
    ).select("file_id", "filename")


@query(
    "cat26_file_listing",
    f"""
    SELECT f.file_id, f.filename, {FULL_PATH} AS full_path
    FROM v_file f JOIN v_product_full p ON p.product_id = f.product_id
    JOIN v_instrumentproductlink l ON l.product_id = p.product_id
    JOIN nation n ON n.n_nationkey = l.instrument_id JOIN region s ON s.r_regionkey = n.n_regionkey
    WHERE f.product_id = 12 AND f.utc_file_date >= DATE '2024-01-10'
    """,
)
def _(t):
    c = catalogue(t)
    return cat.product_file_listing(
        c, 12, "/data", trace.trace_products(c), start_date="2024-01-10"
    ).select("file_id", "filename", "full_path")


@query(
    "cat26_code_listing",
    """
    SELECT c.code_id, c.filename, p.process_name, concat(c.interface_version, '.', c.quality_version, '.', c.revision_version) AS version,
      c.output_interface_version, c.code_start_date, c.code_stop_date
    FROM v_code_full c JOIN v_process_full p USING (process_id) WHERE c.active_code AND c.newest_version
    """,
)
def _(t):
    return cat.active_codes(catalogue(t)).select(
        "code_id", "filename", "process_name", "version", "output_interface_version", "code_start_date", "code_stop_date"
    )


@query(
    "cat26_mission_listing",
    """
    SELECT DISTINCT CAST(r_regionkey % 2 AS BIGINT) AS mission_id, concat('survey', r_regionkey % 2) AS mission_name, '/data' AS rootdir, 'incoming' AS incoming_dir FROM region
    """,
)
def _(t):
    return cat.missions(catalogue(t))


@query(
    "cat12_provenance",
    """
    SELECT file_id, filename, concat('make -o ', filename) AS verbose_provenance FROM v_file WHERE data_level > 0.0
    """,
)
def _(t):
    made = F.when(F.col("data_level") > 0.0, F.concat(F.lit("make -o "), "filename"))
    return cat.provenance(t.file.withColumn("verbose_provenance", made))


_CHAIN = """
  JOIN v_inspector i ON i.product = p.product_id JOIN v_instrumentproductlink l ON l.product_id = p.product_id
  JOIN nation n ON n.n_nationkey = l.instrument_id JOIN region r ON r.r_regionkey = n.n_regionkey JOIN v_mission m ON m.mission_id = r.r_regionkey % 2
"""


@query(
    "join01_file_traceback",
    f"""
    SELECT f.file_id, p.product_name, n.n_name AS instrument_name, r.r_name AS satellite_name, m.mission_name
    FROM v_file f JOIN v_product p ON p.product_id = f.product_id {_CHAIN}
    """,
)
def _(t):
    return trace.trace_files(catalogue(t)).select(
        "file_id", "product_name", "instrument_name", "satellite_name", "mission_name"
    )


@query(
    "join01_traceback_faults",
    """
    SELECT p.product_id, count(l.product_id) AS rows,
      CASE WHEN count(l.product_id) = 0 THEN 'no traceback' WHEN count(l.product_id) > 1 THEN 'multiple tracebacks' END AS fault
    FROM v_product p LEFT JOIN v_instrumentproductlink l ON l.product_id = p.product_id GROUP BY 1
    """,
)
def _(t):
    c = catalogue(t)
    return trace.multiplicity(c.product, trace.trace_products(c, inspectors=True), "product_id")


@query(
    "join01_code_traceback",
    f"""
    SELECT c.code_id, pr.process_id, n.n_name AS instrument_name, r.r_name AS satellite_name
    FROM v_code c JOIN v_process pr USING (process_id) JOIN v_product p ON p.product_id = pr.output_product {_CHAIN}
    WHERE pr.output_timebase <> 'RUN'
    UNION ALL SELECT c.code_id, pr.process_id, NULL, NULL FROM v_code c JOIN v_process pr USING (process_id) WHERE pr.output_timebase = 'RUN'
    """,
)
def _(t):
    return trace.trace_codes(catalogue(t)).select("code_id", "process_id", "instrument_name", "satellite_name")


@query(
    "join01_process_traceback",
    f"""
    SELECT pr.process_id, p.product_name, n.n_name AS instrument_name, r.r_name AS satellite_name, c.code_id
    FROM v_process pr JOIN v_product p ON p.product_id = pr.output_product {_CHAIN}
    LEFT JOIN v_code c ON c.process_id = pr.process_id AND c.active_code AND c.newest_version
      AND DATE '2024-01-20' BETWEEN c.code_start_date AND c.code_stop_date
    """,
)
def _(t):
    return trace.trace_processes(catalogue(t), "2024-01-20").select(
        "process_id", "product_name", "instrument_name", "satellite_name", "code_id"
    )


@query(
    "join01_satellite_mission",
    """
    SELECT CAST(r_regionkey AS BIGINT) AS satellite_id, r_name AS satellite_name, CAST(r_regionkey % 2 AS BIGINT) AS mission_id, concat('survey', r_regionkey % 2) AS mission_name FROM region
    """,
)
def _(t):
    return trace.satellite_mission(catalogue(t))


@query(
    "join02_link_joins",
    """
    SELECT f.file_id, c.source_code, i.instrument_id, CAST(trunc(epoch_us(f.utc_start_time) / 1000000) AS BIGINT) AS unix_start
    FROM v_file f JOIN v_filecodelink c ON c.resulting_file = f.file_id JOIN v_instrumentproductlink i USING (product_id)
    """,
)
def _(t):
    from tidemark.functions.dates import whole_seconds

    return (
        t.file.join(t.filecodelink, F.col("file_id") == F.col("resulting_file"))
        .join(t.instrumentproductlink, "product_id")
        .select("file_id", "source_code", "instrument_id", whole_seconds(F.col("utc_start_time")).alias("unix_start"))
    )


@query(
    "join03_code_of_day",
    """
    WITH d AS (SELECT DISTINCT l.process_id, f.utc_file_date AS day FROM v_file f JOIN v_productprocesslink l ON l.input_product_id = f.product_id)
    SELECT d.process_id, d.day, CASE WHEN count(c.code_id) = 1 THEN min(c.code_id) END AS code_id, count(c.code_id) AS n_codes
    FROM d LEFT JOIN v_code c ON c.process_id = d.process_id AND c.active_code AND c.newest_version AND d.day BETWEEN c.code_start_date AND c.code_stop_date
    GROUP BY 1, 2
    """,
)
def _(t):
    links = trace.processes_of_inputs(catalogue(t))
    dated = (
        t.file.select("product_id", F.col("utc_file_date").alias("day")).distinct()
        .join(links, "product_id").select("process_id", "day").distinct()
    )
    return trace.code_for_process(dated, t.code)


@query(
    "join03_code_is_active",
    """
    SELECT code_id, active_code AND newest_version AND DATE '2024-01-20' BETWEEN code_start_date AND code_stop_date AS is_active FROM v_code
    """,
)
def _(t):
    return trace.code_is_active(t.code, "2024-01-20")


@query(
    "join05_processes_not_queued",
    f"""
    WITH {NEWEST} SELECT n.file_id FROM newest n WHERE n.file_id NOT IN (SELECT file_id FROM v_processqueue)
      AND n.file_id IN (SELECT source_file FROM v_filefilelink)
    """,
)
def _(t):
    return (
        cat.newest_ids(t.file)
        .join(t.processqueue, "file_id", "left_anti")
        .join(t.filefilelink.select(F.col("source_file").alias("file_id")), "file_id", "left_semi")
    )


@query(
    "join07_child_processes",
    "SELECT f.file_id, l.process_id FROM v_file f JOIN v_productprocesslink l ON l.input_product_id = f.product_id",
)
def _(t):
    return trace.child_processes(catalogue(t), t.file).select("file_id", "process_id")


@query(
    "join07_process_of_output",
    "SELECT output_product AS product_id, min(process_id) AS process_id FROM v_process WHERE output_product IS NOT NULL GROUP BY 1",
)
def _(t):
    return trace.process_of_output(catalogue(t))


@query(
    "agg01_counts",
    """
    SELECT 'queue' AS what, count(*) AS n FROM v_processqueue
    UNION ALL SELECT concat('links of ', product_id), count(*) FROM v_instrumentproductlink GROUP BY product_id
    UNION ALL SELECT concat('files of ', product_id), count(*) FROM v_file WHERE exists_on_disk GROUP BY product_id
    """,
)
def _(t):
    def counted(df, word):
        return df.groupBy("product_id").count().select(
            F.concat(F.lit(word), F.col("product_id")).alias("what"), F.col("count").alias("n")
        )

    queue = workset.length(t.processqueue).select(F.lit("queue").alias("what"), F.col("queued").alias("n"))
    return queue.union(counted(t.instrumentproductlink, "links of ")).union(
        counted(t.file.where("exists_on_disk"), "files of ")
    )


@query(
    "agg02_extremes",
    """
    SELECT min(utc_file_date) AS first_date, max(utc_file_date) AS last_date, max(interface_version) AS max_interface,
      max(quality_version) AS max_quality, max(revision_version) AS max_revision FROM v_file
    """,
)
def _(t):
    parts = audit.large_version_parts(t.file).groupBy().pivot("part", ["interface", "quality", "revision"]).agg(F.first("highest"))
    dates = t.file.agg(F.min("utc_file_date").alias("first_date"), F.max("utc_file_date").alias("last_date"))
    # One row each.
    highest = parts.select(F.lit(1).alias("one"), *[F.col(p).alias(f"max_{p}") for p in ("interface", "quality", "revision")])
    return dates.withColumn("one", F.lit(1)).join(highest, "one").drop("one")


@query(
    "agg03_newest_by_number",
    """
    SELECT file_id FROM (SELECT file_id, row_number() OVER (PARTITION BY product_id, utc_file_date
      ORDER BY 1000 * interface_version + 100 * quality_version + revision_version DESC, file_id DESC) AS rk FROM v_file) WHERE rk = 1
    """,
)
def _(t):
    return cat.newest_by_legacy_number(t.file).select("file_id")


@query(
    "agg04_highest_version",
    """
    SELECT f.file_id, m.v AS max_version FROM v_file f JOIN (
      SELECT product_id, utc_file_date, max((interface_version, quality_version, revision_version)) AS mx,
        arg_max(concat(interface_version, '.', quality_version, '.', revision_version), (interface_version, quality_version, revision_version)) AS v
      FROM v_file GROUP BY 1, 2) m USING (product_id, utc_file_date)
    """,
)
def _(t):
    from tidemark.functions.version import format_version

    cells = cat.cell_versions(t.file)
    rows = t.file.select("file_id", *cat.CELL)
    return join_to_groups(rows, cells, cat.CELL, "file_id").select(
        "file_id", format_version(F.col("max_version")).alias("max_version")
    )


@query(
    "win01_first_seen",
    """
    SELECT file_id, product_id, process_keywords FROM (
      SELECT *, row_number() OVER (PARTITION BY product_id, process_keywords ORDER BY utc_start_time, file_id) AS rk FROM v_file) WHERE rk = 1
    """,
)
def _(t):
    return cat.first_seen(
        t.file, ["product_id", "process_keywords"], ["utc_start_time", "file_id"]
    ).select("file_id", "product_id", "process_keywords")


@query(
    "sort01_ordered_listing",
    """
    SELECT data_level, filename, file_id FROM v_file ORDER BY data_level, filename
    """,
)
def _(t):
    return t.file.select("data_level", "filename", "file_id").orderBy("data_level", "filename")


@query(
    "limit01_kth_row",
    """
    SELECT * FROM (SELECT file_id, 'head' AS place FROM v_processqueue ORDER BY file_id LIMIT 1 OFFSET 5)
    UNION ALL SELECT * FROM (SELECT file_id, 'tail' FROM v_processqueue ORDER BY file_id DESC LIMIT 1 OFFSET 1)
    """,
)
def _(t):
    q = t.processqueue
    head = cat.row_at(q, ["file_id"], 5).select("file_id", F.lit("head").alias("place"))
    return head.union(cat.row_at(q, ["file_id"], -2).select("file_id", F.lit("tail")))


@query(
    "set01_set_operations",
    f"""
    WITH {NEWEST}, q AS (SELECT file_id FROM v_processqueue), n AS (SELECT file_id FROM newest)
    SELECT 'difference' AS op, file_id FROM (SELECT file_id FROM n EXCEPT SELECT file_id FROM q)
    UNION ALL SELECT 'intersection', file_id FROM (SELECT file_id FROM n INTERSECT SELECT file_id FROM q)
    UNION ALL SELECT 'union', file_id FROM (SELECT file_id FROM n UNION SELECT file_id FROM q)
    """,
)
def _(t):
    n, q = cat.newest_ids(t.file), t.processqueue.select("file_id")

    def named(df, op):
        return df.select(F.lit(op).alias("op"), "file_id")

    return (
        named(n.subtract(q), "difference")
        .union(named(n.intersect(q), "intersection"))
        .union(named(n.union(q).distinct(), "union"))
    )
