"""Ingest and planning as streams over versioned tables.

The catalogue is the static side; each batch sees one pinned version of it.
What a batch adds to all tables is published at once (see
:mod:`tidemark.sources.versions`), so a batch that is run again after a failure
either finds itself done or starts from the same version as before.  Names and
versions are looked up in a key index; a batch does not read the file table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.model import TABLES, Catalogue, conform
from tidemark.operators.ingest import UNIQUE, Known, ingest_batch, inspection_rules
from tidemark.operators.trace import trace_products
from tidemark.plans.reprocess import plan_changes, run_list
from tidemark.session import durable
from tidemark.sources.key_index import KeyIndex
from tidemark.sources.versions import Manifest, Versions
from tidemark.streaming.incoming import IncomingSource, VersionsSource

# Tables a stream appends to; all others are dimensions.
GROWING = ("file", "processqueue", "filefilelink", "filecodelink")
FIRST_BATCH = -1


def stored(spark: SparkSession, folder: str) -> tuple[Versions, KeyIndex]:
    """The growing tables of a folder and the index of its file names and versions."""
    versions = Versions(spark, folder, "catalogue")
    return versions, KeyIndex(versions, "file", {"name": ["filename"], "version": list(UNIQUE)})


def start_folder(catalogue: Catalogue, folder: str) -> None:
    """Write a catalogue in the layout the streams read: dimensions as folders, the rest as version 0."""
    growing = {}
    for table in TABLES:
        if table in catalogue:
            rows = conform(getattr(catalogue, table), table)
            if table in GROWING:
                growing[table] = rows
            else:
                rows.write.mode("overwrite").parquet(f"{folder}/{table}")
    spark = next(iter(growing.values())).sparkSession
    versions, index = stored(spark, folder)
    highest = growing["file"].agg(F.coalesce(F.max("file_id"), F.lit(0))).scalar() if "file" in growing else F.lit(0)
    number = spark.range(1).select(highest.alias("n")).first().n
    if "file" in growing:
        growing |= index.rows(growing["file"])
    versions.append(FIRST_BATCH, growing, {"file_id": int(number)})


def read_folder(spark: SparkSession, folder: str, tables: list[str], version: int | None = None) -> Catalogue:
    """The catalogue at one version, by default the newest."""
    versions, _index = stored(spark, folder)
    manifest = versions.manifest(version)
    out = {}
    for table in tables:
        if table in GROWING:
            rows = versions.read(table, manifest)
            rows = spark.createDataFrame([], TABLES[table].schema) if rows is None else rows
        else:
            rows = spark.read.parquet(f"{folder}/{table}")
        out[table] = conform(rows, table)
    return Catalogue(**out)


def read_output(spark: SparkSession, folder: str, table: str, writer: str = "catalogue") -> DataFrame | None:
    """A table that only streams write: ``moves`` and ``quarantine``, or ``run_list`` of the writer ``plans``."""
    versions = Versions(spark, folder, writer)
    return versions.read(table, versions.manifest())


def _known(index: KeyIndex, manifest: Manifest) -> Known:
    return Known(
        names=lambda rows: index.split(rows, "name", manifest),
        versions=lambda rows: index.split(rows, "version", manifest),
        highest=manifest.numbers["file_id"],
    )


def take_incoming(folder: str, root: str, tables: list[str]) -> Callable[[DataFrame, int], None]:
    """The step that ingests one batch of listed files into the folder and publishes it."""

    def take(listing: DataFrame, batch_id: int) -> None:
        spark = listing.sparkSession
        versions, index = stored(spark, folder)
        manifest = versions.manifest()
        if manifest.batch is not None and batch_id <= manifest.batch:
            return
        catalogue = read_folder(spark, folder, [t for t in tables if t not in GROWING], manifest.version)
        trace = trace_products(catalogue)
        rules = durable(inspection_rules(catalogue, trace))
        out = ingest_batch(durable(listing), catalogue, rules, trace, root, known=_known(index, manifest))
        accepted = durable(out.accepted)
        last = accepted.agg(F.max("file_id")).first()[0]
        rows = conform(accepted, "file")
        versions.append(batch_id, {
            "file": rows,
            "processqueue": accepted.select("file_id", F.lit(None).cast("smallint").alias("version_bump")),
            "moves": out.moves,
            "quarantine": out.quarantine,
            **index.rows(rows),
        }, {"file_id": last if last is not None else manifest.numbers["file_id"]})

    return take


def ingest_stream(
    spark: SparkSession, incoming: str, folder: str, root: str, tables: list[str], checkpoint: str,
    glob: str = "*", archive: str | None = None, files_per_batch: int | None = None, recursive: bool = False,
) -> StreamingQuery:
    """Ingest all files in the incoming folder and stop; `archive` moves the taken ones there.

    Takes every file that a batch over `list_folder` takes: empty ones, names
    starting with ``_`` or ``.``, files of any size.  A file that comes again
    with another size or time is offered again.
    """
    spark.dataSource.register(IncomingSource)
    reader = spark.readStream.format("tidemark_incoming").option("snapshots", f"{checkpoint}/listings").option("glob", glob)
    reader = reader.option("recursive", str(recursive).lower())
    if files_per_batch is not None:
        reader = reader.option("files_per_batch", files_per_batch)
    if archive is not None:
        reader = reader.option("archive", archive)
    take = take_incoming(folder, root, tables)

    def each_snapshot(listing: DataFrame, _batch_id: int) -> None:
        # Spark's batch may span several snapshots; each is published under its own number.
        rows = durable(listing)
        for r in rows.select("snapshot").distinct().orderBy("snapshot").collect():
            take(rows.where(F.col("snapshot") == r.snapshot).drop("snapshot"), r.snapshot)

    return (
        reader.load(incoming).writeStream.foreachBatch(each_snapshot)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def plan_stream(
    spark: SparkSession, folder: str, tables: list[str], checkpoint: str
) -> StreamingQuery:
    """Plan what newly queued files make necessary; run lists are published by the writer ``plans``.

    Each version of the catalogue that brought queue rows is planned against
    that very version, so a batch run again gives the same list.
    """
    spark.dataSource.register(VersionsSource)
    found = spark.readStream.format("tidemark_versions").option("writer", "catalogue").load(folder)

    def plan(batch: DataFrame, _batch_id: int) -> None:
        plans = Versions(spark, folder, "plans")
        for r in batch.orderBy("version").collect():  # one small row a version
            manifest = plans.manifest()
            queue = stored(spark, folder)[0].added("processqueue", r.version)
            if queue is None or (manifest.batch is not None and r.version <= manifest.batch):
                continue
            queue = durable(queue.select("file_id", "version_bump"))
            if queue.isEmpty():
                continue
            runs = run_list(plan_changes(read_folder(spark, folder, tables, r.version), queue))
            plans.append(r.version, {"run_list": runs})

    return (
        found.writeStream.foreachBatch(plan)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
