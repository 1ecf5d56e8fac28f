"""Small helpers that the operators of this folder share."""

from __future__ import annotations

import sys
import types
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import checkpoint_folder

#: Word separators of the contracts: blank and \t \n \v \f \r.
WORD = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quoted(name: str) -> Column:
    """A column by its exact name, whatever characters the name holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def whole_rows(df: DataFrame, **keys: Column) -> DataFrame:
    """`df` as one struct column ``_row`` next to computed `keys`.

    Extra columns of `df` can then not clash with a name an operator uses;
    ``select("_row.*")`` gives them back.
    """
    return df.select(F.struct(*[quoted(c) for c in df.columns]).alias("_row"), *[v.alias(k) for k, v in keys.items()])


def scratch(spark: SparkSession, purpose: str) -> str:
    """A new path in the folder that all executors share."""
    return f"{checkpoint_folder(spark)}/{purpose}/{uuid.uuid4().hex}"


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def type_of(df: DataFrame, name: str) -> str:
    return df.schema[name].dataType.simpleString()


def fold_of(doc_id) -> int:
    """crc32 of the id as text, modulo 4; a null id counts as empty text."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 4


def fold_column(doc_id: Column) -> Column:
    """The same remainder in Spark."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(4))


def slices(batches: Iterator, rows: int = 1_000) -> Iterator:
    """Arrow batches in portions of at most so many rows, which bounds what is made of them at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def worker_store() -> dict:
    """A dict that lives as long as the worker process, so that caches outlive a task.

    What is kept there must be bounded and must not change results.
    """
    name = "_tidemark_worker_store"
    return vars(sys.modules.setdefault(name, types.ModuleType(name)))


def best_of_groups(scores: np.ndarray, groups: np.ndarray, ids: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(scores, groups, ids) of the `top` of each group: highest score first, then the least id."""
    order = np.lexsort((ids, -scores, groups))
    scores, groups, ids = scores[order], groups[order], ids[order]
    first = np.flatnonzero(np.r_[True, groups[1:] != groups[:-1]]) if len(groups) else np.empty(0, np.int64)
    place = np.arange(len(groups)) - np.repeat(first, np.diff(np.r_[first, len(groups)]))
    keep = place < top
    return scores[keep], groups[keep], ids[keep]
