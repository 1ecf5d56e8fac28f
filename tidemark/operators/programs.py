"""User programs over files: inputs by path, one output each, put in place by a rename.

No content passes a shuffle or a cell: a run's row holds the paths of its
inputs, the program reads them in the task and writes to a file that only this
attempt of the task knows.
"""

from __future__ import annotations

import hashlib
import subprocess
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any

import pandas as pd
from pyarrow import NativeFile, fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import durable
from tidemark.sources.listing import PORTION, full_uri, store_of

ATTEMPTS = "_attempts"

# Bytes of a program's complaints that are kept: the last ones, where it says why it gave up.
COMPLAINT = 2_000

# The length goes as text: a pandas column of numbers with gaps would turn them into floats.
_RAN = "filename string, status string, error string, length string, shasum string, private string"
_PLACED = "filename string, status string, error string, uri string, length string, shasum string"


def _local(uri: str) -> str:
    """The path of a file that an external program can open by itself."""
    store, inner, _start = store_of(uri)
    if not isinstance(store, fs.LocalFileSystem):
        raise ValueError(f"{uri} has no path in a mounted folder")
    return inner


@dataclass(frozen=True)
class InputFile:
    """One input of a run.  `uri` is None if no path of the file is known; using it then fails the run."""

    file_id: Any
    filename: str | None
    uri: str | None

    def _known(self) -> str:
        if self.uri is None:
            raise FileNotFoundError(f"no path of input {self.file_id}")
        return self.uri

    def open(self) -> NativeFile:
        """The file's bytes, with `seek`, `read` and `size`; to be used in a ``with`` block."""
        store, inner, _start = store_of(self._known())
        return store.open_input_file(inner)

    def portions(self) -> Iterator[bytes]:
        with self.open() as stream:
            while part := stream.read(PORTION):
                yield part

    def read_range(self, start: int, length: int) -> bytes:
        with self.open() as stream:
            stream.seek(start)
            return stream.read(length)

    def path(self) -> str:
        return _local(self._known())


class OutputFile:
    """The output of one attempt: either written to in pieces, or by path, not both."""

    def __init__(self, uri: str):
        self._uri = uri
        self._store, self._inner, _start = store_of(uri)
        self._stream: NativeFile | None = None
        self._by_path = False
        self._sum, self._length = hashlib.sha1(), 0

    def write(self, data: bytes) -> None:
        if self._by_path:
            raise ValueError("the output is written by path")
        if self._stream is None:
            self._stream = self._store.open_output_stream(self._inner)
        self._stream.write(data)
        self._sum.update(data)
        self._length += len(data)

    def path(self) -> str:
        if self._stream is not None:
            raise ValueError("the output is written in pieces")
        inner = _local(self._uri)
        self._by_path = True
        return inner

    def finish(self) -> tuple[int, str]:
        """Close the file and give its length and SHA-1; a run that wrote nothing made an empty file."""
        if self._by_path:
            if self._store.get_file_info(self._inner).type == fs.FileType.NotFound:
                raise FileNotFoundError("the program left no output")
            for part in InputFile(None, None, self._uri).portions():
                self._sum.update(part)
                self._length += len(part)
        else:
            self.write(b"")
            self._stream.close()
        return self._length, self._sum.hexdigest()

    def discard(self) -> None:
        if self._stream is not None:
            self._stream.close()
        if self._store.get_file_info(self._inner).type != fs.FileType.NotFound:
            self._store.delete_file(self._inner)


# A program: (inputs by name, arguments, output).  What it raises is recorded, and its output dropped.
FileProgram = Callable[[list[InputFile], list[str], OutputFile], None]


def command(*words: str) -> FileProgram:
    """An external program as a :data:`FileProgram`: words, arguments, input paths, output path.

    It is started in the task, so it must be installed on the executors, and
    all files must lie in folders that are mounted there.  A return code other
    than 0 or a missing output fails the run.
    """

    def program(inputs: list[InputFile], arguments: list[str], output: OutputFile) -> None:
        line = [*words, *arguments, *[i.path() for i in inputs], output.path()]
        tail = b""
        with subprocess.Popen(
            line, stdin=subprocess.DEVNULL, stdout=subprocess.DEVNULL, stderr=subprocess.PIPE) as run:
            while part := run.stderr.read(PORTION):
                tail = (tail + part)[-COMPLAINT:]
        if run.returncode:
            raise RuntimeError(f"exit {run.returncode}: {tail.decode(errors='replace').strip()}")

    return program


def _attempt(name: str | None, inputs: list[InputFile], arguments: list[str], program: FileProgram, area: str) -> tuple:
    """One run in a file of its own below `area`: a row of `_RAN`."""
    if not name or "/" in name or name in (".", "..", ATTEMPTS):
        return name, "failed", f"ValueError: {name!r} is no name of a file", None, None, None
    store, inner, _start = store_of(area)
    store.create_dir(inner, recursive=True)
    private = f"{area}/{uuid.uuid4().hex}"
    output = OutputFile(private)
    try:
        program(inputs, arguments, output)
        length, digest = output.finish()
    except Exception as error:  # a program may fail in any way; the run is recorded as failed
        output.discard()
        return name, "failed", f"{type(error).__name__}: {error}", None, None, None
    return name, "ok", None, str(length), digest, private


def _present(store: fs.FileSystem, inner: str) -> bool:
    return store.get_file_info(inner).type != fs.FileType.NotFound


def _place(private: str, final: str) -> None:
    """Rename `private` to `final` in place of what is there; done again it finds itself done."""
    store, source, _start = store_of(private)
    target = store_of(final)[1]
    if _present(store, source):
        if not isinstance(store, fs.LocalFileSystem) and _present(store, target):
            store.delete_file(target)  # a rename replaces a file only in some stores
        try:
            store.move(source, target)
        except OSError:
            if _present(store, source):
                raise
    if not _present(store, target):
        raise FileNotFoundError(f"neither {private} nor {final} is there")


def run_programs(runs: DataFrame, files: DataFrame, program: FileProgram, folder: str, tasks: int | None = None) -> DataFrame:
    """Run a program once per run over the paths of its inputs; outputs come to lie in `folder`.

    `runs` has filename (one row a name) and inputs, and may have params and
    arguments; `files` has file_id, filename and uri.  A run gets all its
    inputs in the order of their names, as many as the process's input windows
    hold; a run without inputs still runs.  Returns filename, status (``ok`` or
    ``failed``), error, uri, length and SHA-1 of the output.  Null or unfit
    output names, and inputs without a path that the program opens, are
    failed runs; no rows give no rows and no files.

    An attempt of a task writes to a file of its own.  The rows of the
    attempts that Spark took are written to a table first, and only then are
    their files renamed, so tasks that are repeated, doubled or lost leave one
    file per output, the one whose digest is in the row, also when a program
    gives other bytes every time.  An output that is there already is
    replaced.  What a lost driver leaves below ``_attempts`` is read by nobody.
    """
    spark = runs.sparkSession
    target = full_uri(folder)
    area = f"{target}/{ATTEMPTS}/{uuid.uuid4().hex}"
    arguments = (
        F.concat("params", "arguments") if {"params", "arguments"} <= set(runs.columns)
        else F.array().cast("array<string>")
    )
    asked = runs.select("filename", arguments.alias("arguments"), F.explode_outer("inputs").alias("file_id"))
    paths = asked.join(files.select("file_id", F.col("filename").alias("input"), "uri"), "file_id", "left")
    # Rows of paths are small, runs are not: a fixed number keeps AQE from packing them into a few tasks.
    tasks = tasks or max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)

    def one_run(frame: pd.DataFrame) -> pd.DataFrame:
        given = frame[frame["file_id"].notna()].sort_values(["input", "file_id"])
        inputs = [
            InputFile(i, None if pd.isna(n) else n, None if pd.isna(u) else u)
            for i, n, u in zip(given["file_id"], given["input"], given["uri"], strict=True)
        ]
        words = frame["arguments"].iloc[0]
        name = frame["filename"].iloc[0]
        row = _attempt(
            None if pd.isna(name) else name, inputs, list(words if words is not None else []), program, area)
        return pd.DataFrame([row], columns=["filename", "status", "error", "length", "shasum", "private"])

    ran = durable(paths.repartition(tasks, "filename").groupBy("filename").applyInPandas(one_run, _RAN))

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            uris = []
            for name, private in zip(frame["filename"], frame["private"], strict=True):
                made = not pd.isna(private)
                if made:
                    _place(private, f"{target}/{name}")
                uris.append(f"{target}/{name}" if made else None)
            yield frame.assign(uri=uris)[["filename", "status", "error", "uri", "length", "shasum"]]

    placed = durable(ran.mapInPandas(place, _PLACED))
    store, inner, _start = store_of(area)
    if _present(store, inner):
        store.delete_dir(inner)  # what is left of attempts that were not taken
    return placed.withColumn("length", F.col("length").cast("bigint"))


def run_commands(runs: DataFrame, files: DataFrame, folder: str, tasks: int | None = None) -> DataFrame:
    """Run each run's own code (`code_path`) as a command line: code, parameters, arguments, inputs, output.

    `runs` comes from :func:`tidemark.plans.reprocess.with_arguments`.
    """
    lines = runs.withColumn("params", F.concat(F.array("code_path"), "params"))
    return run_programs(lines, files, command(), folder, tasks)
