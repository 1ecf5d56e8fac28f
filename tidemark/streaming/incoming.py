"""Streaming sources: a folder of waiting files, and the versions of a folder of tables.

Spark's own file source skips empty files and names that start with ``_`` or
``.``, and holds a file's bytes in one cell.  The source here lists a folder as
:func:`tidemark.sources.listing.list_folder` does and reads digests in
portions.  An offset is the number of a listing snapshot, a small file that says
which files (path, size, time) were new and which were there already; a
partition is a share of the new ones.  A snapshot is written before its offset
is known to Spark and is never changed, so a batch run again reads the same
files.  Files that are gone from the folder leave the snapshots, which keeps
them as small as the folder.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import uuid
from collections.abc import Iterable, Iterator, Sequence
from itertools import chain

from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition, SimpleDataSourceStreamReader

from tidemark.sources.listing import PORTION, entries_of, full_uri, glob_pattern, store_of
from tidemark.sources.versions import published

INCOMING = "snapshot long, path string, filename string, relative_path string, length long, modified timestamp_ntz, uri string, shasum string"


File = tuple[str, int, int]  # path, size, time in ns


def _walk(store: fs.FileSystem, folder: str, recursive: bool) -> Iterator[File]:
    """The files of a folder, or of its whole tree, by path; what is held is one folder's list at each level."""
    found = [(path + "/" * (kind == fs.FileType.Directory), size, time) for path, kind, size, time in entries_of(store, folder)
             if kind == fs.FileType.File or recursive and kind == fs.FileType.Directory]
    for path, size, time in sorted(found, key=lambda x: x[0]):
        if path.endswith("/"):
            yield from _walk(store, path[:-1], recursive)
        else:
            yield path, size, time


def _marked(listed: Iterator[File], given: Iterator[File]) -> Iterator[tuple[File, bool]]:
    """Each listed file and whether it was given out with this size and time; both go by path."""
    before = next(given, None)
    for file in listed:
        while before is not None and before < file:
            before = next(given, None)
        yield file, file == before


class Snapshots:
    """The listing snapshots of one stream, numbered from 0.

    A snapshot's new files lie in shares, files of a bounded number of lines
    by path.  Those that one listing brought follow each other; only the first
    of them has a list of what had been given out before.  So no reader of a
    share meets another file than its own, and nobody needs to hold a list.
    """

    def __init__(self, folder: str):
        self.store, self.inner, _ = store_of(full_uri(folder))

    def newest(self) -> int:
        found = self.store.get_file_info(fs.FileSelector(self.inner, allow_not_found=True))
        return max((int(f.base_name[:-5]) for f in found if re.fullmatch(r"\d+\.json", f.base_name)), default=-1)

    def _lines(self, name: str) -> Iterator[File]:
        rest = b""
        with self.store.open_input_stream(f"{self.inner}/{name}") as stream:
            while part := stream.read(PORTION):
                *lines, rest = (rest + part).split(b"\n")
                yield from (tuple(json.loads(line)) for line in lines)

    def _mark(self, number: int) -> dict:
        with self.store.open_input_stream(f"{self.inner}/{number}.json") as stream:
            return json.loads(stream.read())

    def shares(self, number: int) -> int:
        return self._mark(number)["shares"]

    def share(self, number: int, share: int) -> Iterator[File]:
        return self._lines(f"{number}.{share}.new")

    def new(self, number: int) -> Iterator[File]:
        for share in range(self.shares(number)):
            yield from self.share(number, share)

    def old(self, number: int) -> Iterator[File]:
        """By path: what was given out before and is still there."""
        first = self._mark(number)["first"]
        return heapq.merge(self._lines(f"{first}.old"), chain.from_iterable(self.new(n) for n in range(first, number)))

    def given(self, number: int) -> Iterator[File]:
        return heapq.merge(self.old(number), self.new(number)) if number >= 0 else iter(())

    def read(self, number: int) -> dict:
        if number < 0:
            return {"new": [], "old": []}
        return {"new": list(self.new(number)), "old": list(self.old(number))}

    def _write(self, name: str, files: Iterable[File]) -> None:
        with self.store.open_output_stream(f"{self.inner}/{name}") as stream:
            for file in files:
                stream.write(json.dumps(file).encode() + b"\n")

    def add(self, listed: Iterator[File], most: int, per_share: int) -> int:
        """Snapshots of `most` files (0: all in one) for what is listed and not given out yet; the newest number.

        The marks that make snapshots known are written last, by a rename.
        """
        newest = self.newest()
        self.store.create_dir(self.inner)
        first, counts, waiting = newest + 1, [], []
        marked = _marked(listed, self.given(newest))

        def flush() -> None:
            self._write(f"{first + len(counts) - 1}.{counts[-1]}.new", waiting)
            counts[-1] += 1
            waiting.clear()

        def old() -> Iterator[File]:
            taken = 0  # files of the snapshot that is being filled
            for file, known in marked:
                if known:
                    yield file
                    continue
                if not counts or most and taken == most:
                    if waiting:
                        flush()
                    counts.append(0)
                    taken = 0
                waiting.append(file)
                taken += 1
                if len(waiting) == per_share:
                    flush()

        self._write(f"{first}.old", old())
        if waiting:
            flush()
        for n, shares in enumerate(counts):
            unnamed = f"{self.inner}/{first + n}.{uuid.uuid4().hex}.tmp"
            with self.store.open_output_stream(unnamed) as stream:
                stream.write(json.dumps({"first": first, "shares": shares}).encode())
            self.store.move(unnamed, f"{self.inner}/{first + n}.json")
        if not counts:
            self.store.delete_file(f"{self.inner}/{first}.old")
        return newest + len(counts)


class Share(InputPartition):
    def __init__(self, number: int, share: int):
        self.number, self.share = number, share


class IncomingReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.folder = full_uri(options["path"])
        self.snapshots = Snapshots(options["snapshots"])
        self.pattern = glob_pattern(options.get("glob", "*"))
        self.recursive = options.get("recursive", "false") == "true"
        self.archive = options.get("archive")
        self.most = int(options.get("files_per_batch", 0))
        self.per_share = int(options.get("files_per_share", 1_000))

    def initialOffset(self) -> dict:
        return {"snapshot": -1}

    def latestOffset(self) -> dict:
        """Writes a snapshot if the folder has a file that no snapshot has given out with this size and time."""
        store, inner, _ = store_of(self.folder)
        listed = (x for x in _walk(store, inner, self.recursive) if re.search(self.pattern, x[0].rsplit("/", 1)[-1]))
        return {"snapshot": self.snapshots.add(listed, self.most, self.per_share)}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        """Only numbers are handed out; a share's files are read from the snapshot where it runs."""
        return [
            Share(number, share) for number in range(start["snapshot"] + 1, end["snapshot"] + 1)
            for share in range(self.snapshots.shares(number))
        ]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        import datetime as dt

        store, inner, start = store_of(self.folder)
        root = inner.rstrip("/") + "/"
        for path, size, time_ns in self.snapshots.share(partition.number, partition.share):
            total = hashlib.sha1()
            try:
                with store.open_input_stream(path) as stream:
                    while part := stream.read(PORTION):
                        total.update(part)
            except FileNotFoundError:
                continue  # taken away since it was listed
            modified = dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=time_ns // 1_000)
            yield (partition.number, path, path.rsplit("/", 1)[-1], path.removeprefix(root), size, modified, start + path, total.hexdigest())

    def commit(self, end: dict) -> None:
        """Files of finished batches go to the archive folder, if there is one."""
        if self.archive is None:
            return
        store, inner, _ = store_of(self.folder)
        target = store_of(full_uri(self.archive))[1]
        for path, _size, _time in self.snapshots.given(end["snapshot"]):
            relative = path.removeprefix(inner.rstrip("/") + "/")
            if store.get_file_info(path).type == fs.FileType.File:
                store.create_dir(f"{target}/{relative}".rsplit("/", 1)[0])
                store.move(path, f"{target}/{relative}")


class IncomingSource(DataSource):
    """Format ``tidemark_incoming``: path, snapshots, and optionally glob, recursive, archive, files_per_batch, files_per_share."""

    @classmethod
    def name(cls) -> str:
        return "tidemark_incoming"

    def schema(self) -> str:
        return INCOMING

    def streamReader(self, schema) -> DataSourceStreamReader:
        return IncomingReader(self.options)


class VersionsReader(SimpleDataSourceStreamReader):
    def __init__(self, options: dict):
        self.folder, self.writer = options["path"], options.get("writer", "tables")

    def initialOffset(self) -> dict:
        return {"version": -1}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        found = [v for v in published(self.folder, self.writer) if v > start["version"]]
        return iter([(v,) for v in found]), {"version": max(found, default=start["version"])}

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        return iter([(v,) for v in published(self.folder, self.writer) if start["version"] < v <= end["version"]])


class VersionsSource(DataSource):
    """Format ``tidemark_versions``: the numbers of the versions that a writer has published below path."""

    @classmethod
    def name(cls) -> str:
        return "tidemark_versions"

    def schema(self) -> str:
        return "version long"

    def simpleStreamReader(self, schema) -> SimpleDataSourceStreamReader:
        return VersionsReader(self.options)
