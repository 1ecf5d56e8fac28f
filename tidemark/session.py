"""Session set-up and the one place where lineage is cut."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "tidemark", **conf: str) -> SparkSession:
    """A session with the settings the operators rely on.

    The catalogue keeps naive UTC times, so the session runs in UTC.  AQE
    coalesces small shuffles, splits skewed ones and turns a join into a
    broadcast when the measured side is small enough.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own.
    """
    context = spark.sparkContext
    folder = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="tidemark-checkpoint-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def durable(df: DataFrame) -> DataFrame:
    """Write `df` to a table in the shared checkpoint folder and go on from the table.

    A lost executor then costs a re-read, not a re-run of every earlier step.
    Later steps read only the columns and rows they need, and their joins are
    planned from the table's real size.
    """
    spark = df.sparkSession
    path = f"{checkpoint_folder(spark)}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def durable_rows(df: DataFrame) -> DataFrame:
    """Checkpoint `df` with the order of its rows and partitions kept."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint()


def durable_partitioned(df: DataFrame, partitions: int, *keys: str) -> DataFrame:
    """Write `df` to a table bucketed by `keys`, so that joins on them shuffle the other side only."""
    spark = df.sparkSession
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), partitions)
    name = f"bucketed_{uuid.uuid4().hex}"
    path = f"{checkpoint_folder(spark)}/tables/{name}"
    writer = df.repartition(buckets, *keys).write.format("parquet").bucketBy(buckets, *keys)
    writer.option("path", path).saveAsTable(name)
    return spark.table(name)
