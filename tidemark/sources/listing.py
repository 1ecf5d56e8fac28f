"""Directory listings as DataFrames: paths, sizes, times, digests."""

from __future__ import annotations

import datetime as dt
import hashlib
import os
import re
import stat
from collections.abc import Callable, Iterator
from functools import reduce
from itertools import islice

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructField, StructType

from tidemark.functions.templates import fill, literal_prefix, to_pattern
from tidemark.functions.text import basename, join_path
from tidemark.session import durable

_SCHEME = r"^[a-zA-Z0-9+.-]+:(//[^/]*(?=/))?"

# Bytes of a file that are read at once.
PORTION = 1 << 20

# Entries of a folder that are handed over at once.
LISTED = 5_000

LISTING = "path string, modificationTime timestamp, length bigint, content binary"


def content_digest(content: Column) -> Column:
    """SHA-1 of a file's bytes as 40 hex digits."""
    return F.sha1(content.cast("binary"))


def listing_columns(folder: str, content: bool = False) -> list[Column]:
    """Columns of a listing row, made from what a binary file read gives."""
    path = F.regexp_replace("path", _SCHEME, "")
    root = F.lit(folder.split("://", 1)[-1].rstrip("/") + "/")
    columns = [
        path.alias("path"),
        basename(path).alias("filename"),
        F.when(path.startswith(root), path.substr(F.length(root) + 1, F.length(path))).alias("relative_path"),
        F.col("length"),
        F.col("modificationTime").cast("timestamp_ntz").alias("modified"),
    ]
    return columns + ([F.col("content")] if content else [])


def full_uri(folder: str) -> str:
    """The folder with its scheme; one without is a path all executors share."""
    if "://" in folder:
        return folder.rstrip("/")
    if folder.startswith("file:"):
        folder = folder.removeprefix("file:")
    return "file://" + os.path.abspath(folder)


def store_of(uri: str) -> tuple[fs.FileSystem, str, str]:
    """The store of a full URI, the path inside it, and what stands before such paths; names may hold any character."""
    scheme, rest = uri.split("://", 1)
    authority, _, inner = rest.partition("/")
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + inner, "file://"
    store, base = fs.FileSystem.from_uri(f"{scheme}://{authority}/")
    base = base.rstrip("/")
    return store, f"{base}/{inner}", f"{scheme}://{authority}".removesuffix(base)


def entries_of(store: fs.FileSystem, inner: str) -> Iterator[tuple[str, fs.FileType, int | None, int | None]]:
    """(path, type, size, time in ns) of what lies directly in a folder, a local one as a stream: it may hold any number of files."""
    if not isinstance(store, fs.LocalFileSystem):
        yield from ((f.path, f.type, f.size, f.mtime_ns) for f in store.get_file_info(fs.FileSelector(inner)))
        return
    with os.scandir(inner) as found:
        for entry in found:
            try:
                about = entry.stat()
            except FileNotFoundError:
                continue  # a link to nothing, or gone since
            kind = fs.FileType.File if stat.S_ISREG(about.st_mode) else fs.FileType.Directory if stat.S_ISDIR(about.st_mode) else fs.FileType.Unknown
            size = about.st_size if kind == fs.FileType.File else None
            yield f"{inner.rstrip('/')}/{entry.name}", kind, size, about.st_mtime_ns


def _time(ns: int | None) -> dt.datetime | None:
    return None if ns is None else dt.datetime.fromtimestamp(ns / 1e9, dt.UTC).replace(tzinfo=None)


def _scan(folders: DataFrame) -> DataFrame:
    """What lies directly in each folder (`uri`), one task per share of the folders."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for uri in frame["uri"]:
                store, inner, start = store_of(uri)
                entries = ((start + path, kind == fs.FileType.Directory, size, _time(ns)) for path, kind, size, ns in entries_of(store, inner))
                while rows := list(islice(entries, LISTED)):
                    yield pd.DataFrame(rows, columns=["uri", "is_folder", "length", "modified"])

    return folders.select("uri").mapInPandas(run, "uri string, is_folder boolean, length bigint, modified timestamp_ntz")


def _read(uri: str, take: Callable[[bytes], None]) -> None:
    store, inner, _start = store_of(uri)
    with store.open_input_stream(inner) as stream:
        while part := stream.read(PORTION):
            take(part)


def digested(listing: DataFrame) -> DataFrame:
    """Add `shasum`, the SHA-1 of each listed file (`uri`), read in portions, so files may be of any size."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            sums = []
            for uri in frame["uri"]:
                total = hashlib.sha1()
                _read(uri, total.update)
                sums.append(total.hexdigest())
            yield frame.assign(shasum=sums)

    return listing.mapInPandas(run, StructType([*listing.schema.fields, StructField("shasum", StringType())]))


def _with_content(listing: DataFrame) -> DataFrame:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for at in range(len(frame)):
                parts: list[bytes] = []
                one = frame.iloc[at:at + 1]
                _read(one["uri"].iloc[0], parts.append)
                yield one.assign(content=[b"".join(parts)])

    return listing.mapInPandas(run, StructType([*listing.schema.fields, StructField("content", BinaryType())]))


def glob_pattern(pattern: str) -> str:
    """The expression of a file glob: ``*``, ``?``, ``[...]`` and ``{a,b}``."""
    marks = {"*": ".*", "?": ".", "{": "(?:", "}": ")", "[": "[", "]": "]"}
    out, depth = [], 0
    for c in pattern:
        depth += (c == "{") - (c == "}")
        out.append("|" if c == "," and depth else marks.get(c) or re.escape(c))
    return "^(?s:" + "".join(out) + ")$"


def list_folder(
    spark: SparkSession, folder: str, glob: str = "*", recursive: bool = False, content: bool = False, digest: bool = False
) -> DataFrame:
    """All files of a folder, or of its whole tree, each path once.

    Empty files and names that start with ``_`` or ``.`` are listed like any
    other.  A tree is descended level by level, each level one job over its
    folders, so no list of files passes the driver.  No file is opened unless
    `content` or `digest` (column `shasum`) is asked for.  `relative_path` is
    the path below `folder`, `uri` the path with its scheme.
    """
    start = full_uri(folder)
    level = durable(_scan(spark.createDataFrame([(start,)], "uri string")))
    levels = [level]
    while recursive:
        folders = level.where("is_folder").select("uri")
        if folders.isEmpty():
            break
        level = durable(_scan(folders.repartition(spark.sparkContext.defaultParallelism)))
        levels.append(level)
    files = reduce(DataFrame.unionByName, levels).where("NOT is_folder")
    if glob != "*":
        files = files.where(basename(F.col("uri")).rlike(glob_pattern(glob)))
    path = F.regexp_replace("uri", _SCHEME, "")
    root = F.lit(re.sub(_SCHEME, "", start).rstrip("/") + "/")
    listing = files.select(
        path.alias("path"), basename(path).alias("filename"),
        F.when(path.startswith(root), path.substr(F.length(root) + 1, F.length(path))).alias("relative_path"),
        "length", "modified", "uri",
    )
    if digest:
        listing = digested(listing)
    return _with_content(listing) if content else listing


def incoming(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """Files waiting in the incoming folder in path order."""
    return list_folder(spark, folder, glob).orderBy("path")


def with_digest(listing: DataFrame) -> DataFrame:
    """Add `shasum` to a listing that holds `content`, and drop the bytes."""
    return listing.withColumn("shasum", content_digest(F.col("content"))).drop("content")


def path_patterns(product_trace: DataFrame) -> DataFrame:
    """Pattern of the relative path of every product's files, its names filled in.

    `product_trace` is the output of :func:`tidemark.operators.trace.trace_products`.
    """
    names = {
        "INSTRUMENT": F.col("instrument_name"),
        "MISSION": F.col("mission_name"),
        "PRODUCT": F.col("product_name"),
        "SATELLITE": F.col("satellite_name"),
        "SPACECRAFT": F.col("satellite_name"),
    }
    filled = fill(join_path(F.col("relative_path"), F.col("format")), names)
    return product_trace.select("product_id", filled.alias("_filled")).distinct().select(
        "product_id",
        to_pattern(F.col("_filled")).alias("pattern"),
        literal_prefix(F.col("_filled")).alias("prefix"),
    )


def product_files(listing: DataFrame, patterns: DataFrame) -> DataFrame:
    """(product, path) pairs whose relative path starts like the product's pattern."""
    from tidemark.operators.ingest import match_patterns

    return match_patterns(listing, "relative_path", patterns, whole=False)
