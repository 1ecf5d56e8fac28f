"""Making outputs from inputs: user code per run, two built-in derivations, provenance."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain, groupby
from operator import itemgetter

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.model import Catalogue
from tidemark.operators.ingest import Ingested, ingest_batch

# User code: (inputs with file_id, filename, content; arguments; output name) -> text of the output.
UserCode = Callable[[pd.DataFrame, list[str], str], str]

# Results a task hands over at once, and the characters of their contents.
MADE, MADE_SIZE = 1_000, 1 << 24

RESULT = "filename string, status string, error string, content string, shasum string"


def run_inputs(runs: DataFrame, files: DataFrame) -> DataFrame:
    """One row per run and input: `output`, `input` (its name) and `file_id`."""
    pairs = runs.select(F.col("filename").alias("output"), F.explode("inputs").alias("file_id"))
    return pairs.join(files.select("file_id", F.col("filename").alias("input")), "file_id").select(
        "output", "input", "file_id")


def concatenate(inputs: DataFrame, lines: DataFrame) -> DataFrame:
    """The lines of all inputs of each output; their order is (input, line_no).

    `inputs` has output, input and file_id, `lines` file_id, line_no and
    line.  The output stays in rows, so it may be larger than any task;
    sorting by output, input and line_no gives the file's text.
    """
    return inputs.join(lines.select("file_id", "line_no", "line"), "file_id").select(
        "output", "input", "line_no", "line")


def write_outputs(derived: DataFrame, folder: str) -> None:
    """Write the lines as text, one folder per output, in order across its part files."""
    ordered = derived.repartitionByRange("output", "input", "line_no").sortWithinPartitions("output", "input", "line_no")
    ordered.select("output", F.col("line").alias("value")).write.partitionBy("output").mode("append").text(folder)


def rot13(text: Column) -> Column:
    """Turn each letter by thirteen places."""
    small, large = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    turned = small[13:] + small[:13] + large[13:] + large[:13]
    return F.translate(text, small + large, turned)


def run_code(runs: DataFrame, files: DataFrame, contents: DataFrame, code: UserCode) -> DataFrame:
    """Run user code once per run with all its inputs; a failure is caught and recorded.

    The code gets all inputs of one output at once, as a program on a command
    line would: as many as the days in the process's input windows, which a
    plan bounds.  Runs are spread over tasks by output name.  A run without
    inputs still runs.  Returns filename, status
    (``ok`` or ``failed``), error, content and its SHA-1.
    """
    arguments = (
        F.concat("params", "arguments") if {"params", "arguments"} <= set(runs.columns)
        else F.array().cast("array<string>")
    )
    asked = runs.select("filename", arguments.alias("arguments"), F.explode_outer("inputs").alias("file_id"))
    named = asked.join(files.select("file_id", F.col("filename").alias("input")), "file_id", "left")
    rows = named.join(contents.select("file_id", "content"), "file_id", "left")
    # A run's rows lie side by side: a task goes through them as a stream, a portion and a run at a time.
    lined_up = rows.select("filename", "arguments", "file_id", "input", "content").repartition("filename").sortWithinPartitions(
        "filename", F.col("input").asc_nulls_last(), "file_id")

    def one_run(name: str | None, words: list[str] | None, inputs: list[tuple]) -> tuple:
        try:
            frame = pd.DataFrame(dict(zip(("file_id", "filename", "content"), zip(*inputs))) or {"file_id": [], "filename": [], "content": []})
            content = code(frame, words or [], name)
            return name, "ok", None, content, hashlib.sha1(content.encode()).hexdigest()
        except Exception as error:  # user code may fail in any way; the run is recorded as failed
            return name, "failed", f"{type(error).__name__}: {error}", None, None

    def taken(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        portions = (batch.slice(at, MADE) for batch in batches for at in range(0, batch.num_rows, MADE))
        rows = (row for portion in portions for row in zip(*(column.to_pylist() for column in portion.columns)))
        for name, run in groupby(rows, itemgetter(0)):
            _name, words, *first = next(run)
            inputs = [given for given in chain([first], (row[2:] for row in run)) if given[0] is not None]
            yield one_run(name, words, inputs)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, size = [], 0
        for result in taken(batches):
            made.append(result)
            size += len(result[3] or "")
            if len(made) >= MADE or size >= MADE_SIZE:
                yield _results(made)
                made, size = [], 0
        if made:
            yield _results(made)

    return lined_up.mapInArrow(work, RESULT)


def _results(made: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(column, pa.string()) for column in zip(*made)]
    return pa.RecordBatch.from_arrays(columns, names=["filename", "status", "error", "content", "shasum"])


def succeeded(results: DataFrame) -> DataFrame:
    return results.where("status = 'ok'")


def failed(results: DataFrame) -> DataFrame:
    """Failed outputs with their message, for the error area."""
    return results.where("status = 'failed'").select("filename", "error")


def status_counts(results: DataFrame) -> DataFrame:
    return results.groupBy("status").agg(F.count(F.lit(1)).alias("runs"))


def write_side_output(results: DataFrame, folder: str, batch: int | None = None) -> None:
    """Write what RUN processes print to a text folder; they make no catalogue row.

    Without `batch` the lines are appended.  With it they get a folder of
    their own, which the same batch run again replaces, so no line comes twice.
    """
    lines = succeeded(results).select(F.col("content").alias("value"))
    if batch is None:
        lines.write.mode("append").text(folder)
    else:
        lines.write.mode("overwrite").text(f"{folder}/batch={batch}")


@dataclass(frozen=True)
class Derived:
    """Catalogue rows that a round of runs adds."""

    ingested: Ingested
    files: DataFrame
    filecodelink: DataFrame
    filefilelink: DataFrame


def provenance_text(runs: DataFrame) -> DataFrame:
    """The command of each output as one text."""
    return runs.select("filename", F.array_join("command", " ").alias("verbose_provenance"))


def ingest_outputs(
    catalogue: Catalogue, runs: DataFrame, results: DataFrame, rules: DataFrame, product_trace: DataFrame,
    root: str, created,
) -> Derived:
    """Catalogue the outputs of successful runs with command, code and inputs recorded.

    RUN processes make no output and are left out.
    """
    made = runs.where("timebase <> 'RUN'").select("filename")
    listing = succeeded(results).join(made, "filename", "left_semi").select(
        "filename", F.concat(F.lit("incoming/"), "filename").alias("path"),
        F.lit(created).cast("timestamp_ntz").alias("modified"), "shasum")
    taken = ingest_batch(listing, catalogue, rules, product_trace, root)
    facts = taken.accepted.select("file_id", "filename").join(
        runs.select("filename", "code_id", "inputs"), "filename")
    files = taken.accepted.join(provenance_text(runs), "filename", "left") if "command" in runs.columns else taken.accepted
    return Derived(
        ingested=taken,
        files=files,
        filecodelink=facts.select(F.col("file_id").alias("resulting_file"), F.col("code_id").alias("source_code")),
        filefilelink=facts.select(F.explode("inputs").alias("source_file"), F.col("file_id").alias("resulting_file")),
    )
