"""Tables that grow by batches, seen through numbered manifests.

A batch writes its rows to new folders and then publishes one small manifest
that lists, for each table, the folders that make it up.  The manifest appears
by a rename, so a batch is there whole or not at all; folders of a batch that
was lost on the way are in no manifest.  A reader pins a version and is not
disturbed by later ones.  Folders of one size class are merged when enough of
them have come together, as part of a batch, so a table of n batches is made of
some log n folders, and every row is rewritten some log n times.

One writer publishes at a time, as a stream does.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

from tidemark.sources.listing import full_uri, store_of

#: Folders of one size class that are merged into one of the next.
MERGE = 8


@dataclass(frozen=True)
class Layout:
    """How a table's rows are written to a folder and read from several."""

    write: Callable[[DataFrame, str], None]
    read: Callable[[SparkSession, list[str]], DataFrame]


def _write_plain(rows: DataFrame, path: str) -> None:
    rows.write.parquet(path)


def _read_plain(spark: SparkSession, paths: list[str]) -> DataFrame:
    return spark.read.parquet(*paths)


PLAIN = Layout(_write_plain, _read_plain)


@dataclass(frozen=True)
class Manifest:
    """A version: the folders of each table with their size class, those the version added, and numbers kept along."""

    version: int = -1
    batch: int | None = None
    folders: dict[str, list[list]] = field(default_factory=dict)
    added: dict[str, str] = field(default_factory=dict)
    numbers: dict[str, int] = field(default_factory=dict)


def published(folder: str, name: str) -> list[int]:
    """The numbers of all versions in order, without Spark."""
    store, inner, _ = store_of(full_uri(folder))
    found = store.get_file_info(fs.FileSelector(f"{inner}/_versions/{name}", allow_not_found=True))
    return sorted(int(f.base_name[:-5]) for f in found if f.base_name.endswith(".json") and f.base_name[:-5].isdigit())


class Versions:
    """The tables below `folder` that the writer `name` publishes."""

    def __init__(self, spark: SparkSession, folder: str, name: str = "tables", layouts: dict[str, Layout] | None = None, merge: int = MERGE):
        self.spark, self.folder, self.name, self.merge = spark, full_uri(folder), name, merge
        self.layouts = layouts or {}

    def manifest(self, version: int | None = None) -> Manifest:
        """The manifest of a version, by default the newest; version -1 has no tables."""
        if version is None:
            version = max(published(self.folder, self.name), default=-1)
        if version == -1:
            return Manifest()
        store, inner, _ = store_of(self.folder)
        with store.open_input_stream(f"{inner}/_versions/{self.name}/{version}.json") as stream:
            return Manifest(**json.loads(stream.read()))

    def read(self, table: str, manifest: Manifest) -> DataFrame | None:
        """The table as the manifest has it, None if it never got a row set."""
        folders = manifest.folders.get(table)
        if not folders:
            return None
        return self.layouts.get(table, PLAIN).read(self.spark, [f"{self.folder}/{path}" for path, _ in folders])

    def added(self, table: str, version: int) -> DataFrame | None:
        """The rows that one version brought."""
        path = self.manifest(version).added.get(table)
        return path and self.layouts.get(table, PLAIN).read(self.spark, [f"{self.folder}/{path}"])

    def append(self, batch: int, rows: dict[str, DataFrame], numbers: dict[str, int] | None = None) -> Manifest:
        """Publish a batch's rows of all tables at once.

        A batch that is there already changes nothing, so a batch can be run
        again after any failure; batches come in rising order.
        """
        now = self.manifest()
        if now.batch is not None and batch <= now.batch:
            return now
        folders = {table: list(listed) for table, listed in now.folders.items()}
        added = {}
        for table, frame in rows.items():
            added[table] = self._written(table, frame)
            folders.setdefault(table, []).append([added[table], 0])
        for table in rows:
            folders[table] = self._merged(table, folders[table])
        new = Manifest(now.version + 1, batch, folders, added, {**now.numbers, **(numbers or {})})
        self._publish(new)
        return new

    def _written(self, table: str, rows: DataFrame) -> str:
        path = f"{table}/{uuid.uuid4().hex}"
        self.layouts.get(table, PLAIN).write(rows, f"{self.folder}/{path}")
        return path

    def _merged(self, table: str, listed: list[list]) -> list[list]:
        """Merge the folders of a size class as long as there are enough of one; the old folders stay for their readers."""
        layout = self.layouts.get(table, PLAIN)
        while True:
            classes = [level for _, level in listed]
            full = next((level for level in sorted(set(classes)) if classes.count(level) >= self.merge), None)
            if full is None:
                return listed
            old = [path for path, level in listed if level == full]
            rows = layout.read(self.spark, [f"{self.folder}/{path}" for path in old])
            listed = [x for x in listed if x[1] != full] + [[self._written(table, rows.coalesce(self._tasks(rows))), full + 1]]

    def _tasks(self, rows: DataFrame) -> int:
        """Files of about 128 MB: merged folders must not keep one small file of every batch."""
        size = sum(f.size for path in rows.inputFiles() for f in [self._info(path)])
        return max(1, -(-size // (128 << 20)))

    @staticmethod
    def _info(uri: str) -> fs.FileInfo:
        store, inner, _ = store_of(uri if "://" in uri else uri.replace("file:", "file://", 1))
        return store.get_file_info(inner)

    def _publish(self, manifest: Manifest) -> None:
        store, inner, _ = store_of(self.folder)
        folder = f"{inner}/_versions/{self.name}"
        store.create_dir(folder)
        waiting, final = f"{folder}/{manifest.version}.{uuid.uuid4().hex}.tmp", f"{folder}/{manifest.version}.json"
        with store.open_output_stream(waiting) as stream:
            stream.write(json.dumps(manifest.__dict__).encode())
        if store.get_file_info(final).type != fs.FileType.NotFound:
            raise RuntimeError(f"version {manifest.version} was published by another writer")
        store.move(waiting, final)

    def unlisted(self) -> list[str]:
        """Folders of tables that no version lists: what lost batches left behind."""
        store, inner, _ = store_of(self.folder)
        listed = {path for v in published(self.folder, self.name) for m in [self.manifest(v)]
                  for paths in ([p for p, _ in x] for x in m.folders.values()) for path in paths}
        listed |= {path for v in published(self.folder, self.name) for path in self.manifest(v).added.values()}
        tables = {path.split("/")[0] for path in listed}
        found = [f"{t}/{f.base_name}" for t in tables for f in store.get_file_info(fs.FileSelector(f"{inner}/{t}"))]
        return sorted(set(found) - listed)

