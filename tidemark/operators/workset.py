"""The queue of files to process, and release tags.

Every operator returns the rows to append or the table that is left; writing
it is the caller's step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.model import Catalogue
from tidemark.operators.catalogue import full_paths, newest_ids, row_at

_BUMP = "smallint"


def raw_add(queue: DataFrame, ids: DataFrame, version_bump: int | None = None) -> DataFrame:
    """Queue rows for the given ids that are not queued yet; ids are not checked."""
    return (
        ids.select("file_id").distinct()
        .join(queue, "file_id", "left_anti")
        .select("file_id", F.lit(version_bump).cast(_BUMP).alias("version_bump"))
    )


def push(queue: DataFrame, files: DataFrame, ids: DataFrame, version_bump: int | None = None) -> DataFrame:
    """Queue rows for the given ids that are catalogued files and not queued yet."""
    return raw_add(queue, ids.join(files.select("file_id"), "file_id", "left_semi"), version_bump)


def remove(queue: DataFrame, ids: DataFrame) -> DataFrame:
    """The queue without the given ids."""
    return queue.join(ids.select("file_id"), "file_id", "left_anti").select(*queue.columns)


def remove_named(queue: DataFrame, files: DataFrame, names: DataFrame) -> DataFrame:
    """The queue without the files of the given names."""
    return remove(queue, files.join(names.select("filename"), "filename", "left_semi"))


def flush(queue: DataFrame) -> DataFrame:
    """The empty queue."""
    return queue.where(F.lit(False))


def length(queue: DataFrame) -> DataFrame:
    return queue.agg(F.count(F.lit(1)).alias("queued"))


def clean(queue: DataFrame, files: DataFrame) -> DataFrame:
    """Queue rows whose file is newest, and all rows that carry a bump."""
    newest = newest_ids(files).withColumn("_newest", F.lit(True))
    return (
        queue.join(newest, "file_id", "left")
        .where(F.col("version_bump").isNotNull() | F.col("_newest"))
        .select(*queue.columns)
    )


def head(queue: DataFrame, index: int = 0) -> DataFrame:
    """One row of the queue in id order; a negative index counts from the end."""
    return row_at(queue, ["file_id"], index)


def report(queue: DataFrame, catalogue: Catalogue, products: Column | None = None) -> DataFrame:
    """Queued files with product and date in (date, product name) order; `products` filters."""
    rows = (
        queue.join(catalogue.file.select("file_id", "filename", "utc_file_date", "product_id"), "file_id")
        .join(catalogue.product.select("product_id", "product_name"), "product_id")
    )
    if products is not None:
        rows = rows.where(products)
    return rows.select("file_id", "filename", "product_name", "utc_file_date", "version_bump").orderBy(
        "utc_file_date", "product_name", "file_id"
    )


def tag_release(files: DataFrame, release: DataFrame, number: str) -> DataFrame:
    """Release rows for all newest files that do not carry the tag yet."""
    rows = newest_ids(files).withColumn("release_num", F.lit(number))
    return rows.join(release, ["file_id", "release_num"], "left_anti")


def add_to_release(files: DataFrame, release: DataFrame, ids: DataFrame, number: str) -> DataFrame:
    """Release rows for the given catalogued files that do not carry the tag yet."""
    known = ids.select("file_id").distinct().join(files.select("file_id"), "file_id", "left_semi")
    rows = known.withColumn("release_num", F.lit(number))
    return rows.join(release, ["file_id", "release_num"], "left_anti")


def list_release(
    catalogue: Catalogue, number: str, product_trace: DataFrame | None = None, root: str | None = None
) -> DataFrame:
    """Names, or with a trace and a root the full paths, of the files of a release."""
    tagged = catalogue.release.where(F.col("release_num") == number)
    files = catalogue.file.join(tagged, "file_id", "left_semi")
    if product_trace is None:
        return files.select("file_id", "filename")
    return full_paths(files, product_trace, root).select("file_id", "full_path")
