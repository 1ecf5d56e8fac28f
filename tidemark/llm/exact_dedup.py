"""Exact dedup against a persistent digest index.

The index is a Parquet table bucketed and sorted by digest.  A batch of
documents is reduced to one row per digest, joined to the index by sort-merge
(the index side is read by bucket, without a shuffle) and what the anti join
leaves is appended.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import partitions, quoted, read_table, scratch, whole_rows
from tidemark.operators.skew import join_to_groups
from tidemark.session import durable


def text_digest(text: Column) -> Column:
    """SHA-256 of the text in UTF-8, lowercase hex; a null text counts as empty."""
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


class DigestIndex:
    """One row per text ever added: ``digest``, ``keep_id``, ``n_rows`` of its batch, ``batch``.

    `path` is a folder all executors share.  The files carry the whole state:
    a later session that opens the path goes on from there.  `buckets` is
    fixed when the index is made and should give some 100 MB a bucket.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark, self.path, self.buckets = spark, path, buckets
        self.table = "digest_index_" + hashlib.md5(path.encode()).hexdigest()
        place = path.replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} (digest STRING, keep_id BIGINT, n_rows BIGINT, batch STRING) "
            f"USING parquet CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{place}'"
        )

    def rows(self) -> DataFrame:
        return self.spark.table(self.table)

    def add(self, docs: DataFrame, batch: str = "0", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """Append the texts of `docs` that the index lacks; decide on every row.

        Returns one row per row of `docs`: id, ``keep_id``, ``group_size``,
        ``kept``, ``text_sha256`` and ``known`` (the text came with an earlier
        batch, nothing of the group stays).  Of the rows of a new text the one
        with the largest id stays.  A null text is the empty text.  A null id
        loses against any id; if a text has null ids only, ``keep_id`` is null
        and its rows count as kept.  Rows that repeat id and text get the same
        answer (see `drop_repeats`).  An empty batch appends nothing.  Adding a
        batch again, for instance after a failure, changes nothing and gives
        the same answer, as rows of the same `batch` don't count as known.
        """
        keyed = durable(docs.select(
            quoted(id_col).cast("long").alias("id"), text_digest(quoted(text_col)).alias("digest")
        ))
        groups = keyed.groupBy("digest").agg(
            F.max("id").alias("newest"), F.count(F.lit(1)).alias("group_rows")
        )
        index = self.rows()
        earlier = index.where(F.col("batch") != batch).select("digest", F.col("keep_id").alias("earlier_id"))
        decided = durable(
            groups.join(earlier.withColumn("known", F.lit(True)).hint("merge"), "digest", "left").select(
                "digest", "group_rows", F.coalesce("known", F.lit(False)).alias("known"),
                F.when(F.col("known"), F.col("earlier_id")).otherwise(F.col("newest")).alias("keep_id"),
            )
        )
        new = decided.join(index.select("digest").hint("merge"), "digest", "left_anti")
        (
            new.select("digest", "keep_id", F.col("group_rows").alias("n_rows"), F.lit(batch).alias("batch"))
            .repartition(self.buckets, "digest")
            .write.format("parquet").mode("append").bucketBy(self.buckets, "digest").sortBy("digest")
            .option("path", self.path).saveAsTable(self.table)
        )
        # A copy of the size survives the join, which uses group_rows to split hot texts.
        rows = keyed.withColumn("spread", F.coalesce("id", F.lit(0)))
        out = join_to_groups(rows, decided.withColumn("group_size", F.col("group_rows")), ["digest"], "spread")
        return out.select(
            F.col("id").alias(id_col), "keep_id", "group_size",
            (~F.col("known") & F.col("id").eqNullSafe(F.col("keep_id"))).alias("kept"),
            F.col("digest").alias("text_sha256"), "known",
        )


def drop_repeats(docs: DataFrame, index: DigestIndex, batch: str = "0") -> DataFrame:
    """The rows of `docs` that stay, with all their columns: one row per new text.

    Rows that repeat both id and text leave one of them.
    """
    decided = index.add(docs, batch).where("kept").select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_digest"))
    # One row per text is kept, so this side is unique after the distinct.
    winners = durable(decided.distinct())
    rows = whole_rows(docs, _id=quoted("doc_id").cast("long"), _digest=text_digest(quoted("text")))
    same = F.col("d._digest").eqNullSafe(F.col("w._digest")) & F.col("d._id").eqNullSafe(F.col("w._id"))
    return (
        rows.alias("d").join(winners.alias("w"), same, "left_semi")
        .dropDuplicates(["_digest"]).select("_row.*")
    )


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = DigestIndex(spark, scratch(spark, "digest-index"), max(8, partitions(spark)))
    return index.add(read_table(spark, sf_dir, "documents")).drop("known")


OP1_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""
