"""A persistent index of a table's keys, so that a batch does not read the table to find what is there.

Keys lie in buckets by their hash, sorted by hash inside; each folder of the
index has a Bloom filter per bucket.  A lookup reads the filters of the buckets
its own keys fall into, and then only those buckets of those folders that may
hold one.  New names, the usual case, cost the filters alone.

The index is a table of a :class:`~tidemark.sources.versions.Versions`, so it is
published together with the rows it is about.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import durable
from tidemark.sources.versions import Layout, Manifest, Versions

#: Bits of a filter for each key, and places a key sets; one key in 120 passes in vain.
BITS, PLACES = 10, 7
BUCKETS = 256


def key_text(columns: list[str]) -> Column:
    """The columns as one text; null if any of them is, as in SQL a null in a key never clashes."""
    filled = F.lit(True)
    for c in columns:
        filled = filled & F.col(c).isNotNull()
    return F.when(filled, F.to_json(F.array(*[F.col(c).cast("string") for c in columns])))


def _places(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The places of each hash in a filter of `bits`, one row a key."""
    x = hashes.astype(np.int64).view(np.uint64)
    step = (x >> np.uint64(32)) | np.uint64(1)
    return ((x[:, None] + np.arange(PLACES, dtype=np.uint64)[None, :] * step[:, None]) % np.uint64(bits)).astype(np.int64)


def filter_of(hashes: np.ndarray) -> bytes:
    """A Bloom filter of the keys with these hashes."""
    bits = 8 * max(8, -(-BITS * len(hashes) // 8))
    marked = np.zeros(bits, bool)
    marked[_places(hashes, bits).ravel()] = True
    return np.packbits(marked).tobytes()


def may_hold(filter_: bytes, hashes: np.ndarray) -> np.ndarray:
    marked = np.unpackbits(np.frombuffer(filter_, np.uint8)).astype(bool)
    return marked[_places(hashes, len(marked))].all(axis=1)


def _write(rows: DataFrame, path: str) -> None:
    dealt = rows.select("kind", "key", "hash", "bucket").repartition("kind", "bucket")
    dealt.sortWithinPartitions("kind", "bucket", "hash").write.partitionBy("kind", "bucket").parquet(f"{path}/keys")

    def build(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"kind": group["kind"].iloc[:1], "bucket": group["bucket"].iloc[:1], "filter": [filter_of(group["hash"].to_numpy())]})

    hashes = rows.select("kind", "bucket", "hash").groupBy("kind", "bucket")
    hashes.applyInPandas(build, "kind string, bucket int, filter binary").write.partitionBy("kind", "bucket").parquet(f"{path}/filters")


KEY_ROWS = "key string, hash bigint, kind string, bucket int"


def _part(spark: SparkSession, path: str, part: str, schema: str) -> DataFrame:
    """One folder's keys or filters; an empty one has no files to tell their schema."""
    return spark.read.schema(schema).parquet(f"{path}/{part}")


def _read(spark: SparkSession, paths: list[str]) -> DataFrame:
    found = None
    for path in paths:
        rows = _part(spark, path, "keys", KEY_ROWS)
        found = rows if found is None else found.unionByName(rows)
    return found


LAYOUT = Layout(_write, _read)


class KeyIndex:
    """The keys of `table`, by kind: each kind is a list of columns that are unique together."""

    def __init__(self, versions: Versions, table: str, kinds: dict[str, list[str]], buckets: int = BUCKETS):
        self.versions, self.table, self.kinds, self.buckets = versions, f"{table}_keys", kinds, buckets
        versions.layouts[self.table] = LAYOUT

    def _hashed(self, rows: DataFrame, kind: str) -> DataFrame:
        keyed = rows.withColumn("key", key_text(self.kinds[kind])).where("key IS NOT NULL")
        return keyed.withColumn("hash", F.xxhash64("key")).withColumn("bucket", F.pmod("hash", F.lit(self.buckets)).cast("int"))

    def rows(self, rows: DataFrame) -> dict[str, DataFrame]:
        """The index rows of new table rows, to be appended in the same batch."""
        parts = [self._hashed(rows, k).select(F.lit(k).alias("kind"), "key", "hash", "bucket") for k in self.kinds]
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return {self.table: out}

    def touched(self, asked: DataFrame, kind: str, manifest: Manifest) -> list[tuple[str, int]]:
        """(folder, bucket) pairs that may hold one of the `asked` keys (key, hash, bucket).

        The list is bounded by folders times buckets, whatever the table's size.
        """
        spark = self.versions.spark
        buckets = [r[0] for r in asked.select("bucket").distinct().collect()]  # at most one row a bucket
        folders = [f"{self.versions.folder}/{path}" for path, _ in manifest.folders.get(self.table, [])]
        if not buckets or not folders:
            return []
        filters = None
        for path in folders:
            one = _part(spark, path, "filters", "filter binary, kind string, bucket int").where((F.col("kind") == kind) & F.col("bucket").isin(buckets))
            one = one.select(F.lit(path).alias("folder"), "bucket", "filter")
            filters = one if filters is None else filters.unionByName(one)

        def test(keys: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
            hashes = keys["hash"].to_numpy()
            hits = [may_hold(f, hashes).any() for f in filters["filter"]] if len(hashes) else [False] * len(filters)
            return filters.loc[hits, ["folder", "bucket"]]

        # A bucket's keys of one batch in one task: a batch of n keys has n / buckets of them there.
        hit = asked.select("bucket", "hash").groupBy("bucket").cogroup(filters.groupBy("bucket")).applyInPandas(test, "folder string, bucket int")
        return sorted((r.folder, r.bucket) for r in hit.collect())

    def present_keys(self, rows: DataFrame, kind: str, manifest: Manifest) -> DataFrame:
        """The distinct keys (key) of `rows` that the table has."""
        asked = durable(self._hashed(rows, kind).select("key", "hash", "bucket").distinct())
        found = None
        by_folder: dict[str, list[int]] = {}
        for folder, bucket in self.touched(asked, kind, manifest):
            by_folder.setdefault(folder, []).append(bucket)
        for folder, buckets in by_folder.items():
            # By their own folders: no other bucket is even listed.
            paths = [f"{folder}/keys/kind={kind}/bucket={b}" for b in buckets]
            reader = self.versions.spark.read.schema(KEY_ROWS).option("basePath", f"{folder}/keys")
            keys = reader.parquet(*paths).select("key", "hash", "bucket")
            found = keys if found is None else found.unionByName(keys)
        if found is None:
            return asked.select("key").limit(0)
        return asked.join(found, ["bucket", "hash", "key"], "left_semi").select("key")

    def split(self, rows: DataFrame, kind: str, manifest: Manifest) -> tuple[DataFrame, DataFrame]:
        """(rows whose key is in the table, all others); a null in a key is never there."""
        present = durable(self.present_keys(rows, kind, manifest))
        keyed = rows.withColumn("_key", key_text(self.kinds[kind]))
        present = present.withColumnRenamed("key", "_key")
        return keyed.join(present, "_key", "left_semi").drop("_key"), keyed.join(present, "_key", "left_anti").drop("_key")
