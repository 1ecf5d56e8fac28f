"""Plan, derive, ingest, and again, until nothing is left to make.

With a journal every finished round is published at once: its catalogue rows,
contents, failures, what RUN processes printed, and the queue it leaves.  A
driver that is lost costs the round it was in; the next one starts where the
last finished round ended, and no row or line is written twice.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.model import Catalogue, conform
from tidemark.operators.derive import UserCode, failed, ingest_outputs, run_code, succeeded
from tidemark.operators.programs import FileProgram, run_commands, run_programs
from tidemark.operators.trace import trace_products
from tidemark.plans.reprocess import plan_changes, run_list, with_arguments
from tidemark.session import durable
from tidemark.sources.versions import Versions


class Processed(NamedTuple):
    """What emptying the queue left behind.

    ``failed`` has filename, error and round of every run that raised, and
    ``quarantine`` filename, path, reason and round of outputs that the
    catalogue would not take.  The queue in `catalogue` holds what is
    really left to plan, which is nothing unless the work was interrupted.
    """

    catalogue: Catalogue
    contents: DataFrame
    rounds: int
    failed: DataFrame
    quarantine: DataFrame


GROWING = ("file", "filecodelink", "filefilelink")


def _grown(catalogue: Catalogue, rows: dict[str, DataFrame]) -> Catalogue:
    """The catalogue with new rows behind each table; what was there is not written again."""
    tables = {}
    for table in GROWING:
        present = getattr(catalogue, table)
        tables[table] = present.unionByName(conform(rows[table], table).select(*present.columns))
    return catalogue.replace(**tables)


def _all(pieces: list[DataFrame], spark, schema: str) -> DataFrame:
    return reduce(DataFrame.unionByName, pieces) if pieces else spark.createDataFrame([], schema)


def process_queue(
    catalogue: Catalogue,
    contents: DataFrame,
    code: UserCode | FileProgram | None,
    rules: DataFrame,
    root: str,
    code_root: str,
    created,
    on_results: Callable[[DataFrame, DataFrame], None] | None = None,
    journal: str | None = None,
    folder: str | None = None,
) -> Processed:
    """Empty the queue: each round plans all queued files, runs and catalogues the outputs.

    New outputs are queued for the next round, so lower levels come first,
    and rounds go on until one makes nothing.  `contents` has file_id and
    content.  One round is one set of distributed jobs; the driver only asks
    whether anything is left.  `journal` is a folder for the finished rounds:
    called again with the same catalogue and journal, rounds that are there
    are not run again.  What RUN processes print is in its table ``side``, see
    :func:`side_output`.  `on_results` is called before a round is published
    and so may see a round twice.

    With `folder` the work is done on files: `contents` has file_id and uri,
    `code` is a program over files, or None for each process's own code as a
    command line, and outputs lie in `folder`.  The result's `contents` and
    what is kept of RUN processes then hold a uri as well.
    """
    spark = contents.sparkSession
    trace = trace_products(catalogue)
    held = "content" if folder is None else "uri"
    contents = contents.select("file_id", held)

    def ran(runs: DataFrame) -> DataFrame:
        if folder is None:
            return durable(run_code(runs, catalogue.file, contents, code))
        files = catalogue.file.select("file_id", "filename").join(contents, "file_id")
        return run_commands(runs, files, folder) if code is None else run_programs(runs, files, code, folder)

    queue = durable(catalogue.processqueue.select("file_id", "version_bump"))
    rounds, errors, refused = 0, [], []
    state = Versions(spark, journal, "rounds") if journal is not None else None
    done = state.manifest() if state is not None else None
    if done is not None and done.batch is not None:
        rounds = done.batch
        catalogue = _grown(catalogue, {table: state.read(table, done) for table in GROWING})
        contents = contents.unionByName(state.read("contents", done))
        errors, refused = [state.read("failed", done)], [state.read("quarantine", done)]
        queue = state.added("queue", done.version)
    while not queue.isEmpty():
        runs = durable(run_list(plan_changes(catalogue, queue)))
        if runs.isEmpty():
            queue = queue.where(F.lit(False))  # planned, and nothing to do
            break
        rounds += 1
        runs = with_arguments(catalogue, runs, root, code_root)
        results = ran(runs)
        if on_results is not None:
            on_results(runs, results)
        made = ingest_outputs(catalogue, runs, results, rules, trace, root, created)
        files = durable(made.files)
        new = files.select("file_id", "filename").join(results.select("filename", held), "filename")
        printed = runs.where("timebase = 'RUN'").select("filename")
        rows = {
            "file": conform(files, "file"), "filecodelink": conform(made.filecodelink, "filecodelink"),
            "filefilelink": conform(made.filefilelink, "filefilelink"), "contents": new.select("file_id", held),
            "failed": failed(results).withColumn("round", F.lit(rounds)),
            "quarantine": made.ingested.quarantine.withColumn("round", F.lit(rounds)),
            "side": succeeded(results).join(printed, "filename", "left_semi").select("filename", held, F.lit(rounds).alias("round")),
            "queue": files.select("file_id", F.lit(None).cast("smallint").alias("version_bump")),
        }
        if state is not None:
            version = state.append(rounds, rows).version
            rows = {table: state.added(table, version) for table in rows}
        else:
            rows = {table: durable(frame) for table, frame in rows.items() if table != "side"}
        errors.append(rows["failed"])
        refused.append(rows["quarantine"])
        contents = contents.unionByName(rows["contents"])
        catalogue = _grown(catalogue, rows)
        queue = rows["queue"]
    return Processed(
        catalogue.replace(processqueue=conform(queue, "processqueue")),
        contents,
        rounds,
        _all(errors, spark, "filename string, error string, round int"),
        _all(refused, spark, "filename string, path string, reason string, round int"),
    )


def side_output(spark: SparkSession, journal: str) -> DataFrame:
    """What RUN processes have printed in the finished rounds: filename, content (or uri), round."""
    state = Versions(spark, journal, "rounds")
    found = state.read("side", state.manifest())
    return spark.createDataFrame([], "filename string, content string, round int") if found is None else found
