"""Log lines to rows, event streams, reports and run times.

A line reads ``YYYY-MM-DD HH:MM:SS,mmm - module:line - LEVEL - message``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import basename
from tidemark.operators.catalogue import first_seen

_LINE = r"^\d{4}-\d\d-\d\d \d\d:\d\d:\d\d,\d{3} - [^ ]*:\d+ - [A-Z]+ - "
_INGESTED = r"^File (.*) entered in DB.*f_id=(\d*)$"
# Two spellings of the same event, from older and newer writers.
_COMMAND = r"^(?:running command: |Command: (?=.*starting))\s*(.*)$"
_TOOK = r"^Command: (.*) took\s*(\S+)\s+seconds"


def parse_lines(lines: DataFrame) -> DataFrame:
    """Split `value` into ts, module, line, level and message; other columns are kept.

    Lines of another form, such as the rest of a stack trace, keep null parts.
    """
    value = F.rtrim(F.col("value"))
    parts = F.when(value.rlike(_LINE), F.split(value, " - ", 4))
    row = F.struct(
        F.replace(F.col("_parts")[0], F.lit(","), F.lit(".")).try_cast("timestamp_ntz").alias("ts"),
        F.substring_index(F.col("_parts")[1], ":", 1).alias("module"),
        F.substring_index(F.col("_parts")[1], ":", -1).cast("int").alias("line"),
        F.col("_parts")[2].alias("level"),
        F.col("_parts")[3].alias("message"),
    )
    # A one-row generator: later filters stay above it, so a line is parsed once and not per condition.
    return lines.withColumn("_parts", parts).select(*lines.columns, F.inline(F.array(row)))


def time_span(parsed: DataFrame, by: list[str] | None = None) -> DataFrame:
    """First and last time, over everything or per file."""
    return parsed.groupBy(*(by or [])).agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


def of_level(parsed: DataFrame, level: str) -> DataFrame:
    return parsed.where(F.col("level") == level)


def errors(parsed: DataFrame) -> DataFrame:
    """ERROR lines with the code position and the text."""
    return of_level(parsed, "ERROR").select(
        "ts", F.concat_ws(":", "module", F.col("line").cast("string")).alias("codename"),
        F.col("message").alias("error"),
    )


def ingested(parsed: DataFrame, products: DataFrame | None = None) -> DataFrame:
    """Files entered in the catalogue; with `products` also product name and level.

    `products` has file_id, product_name and data_level; a file that is not
    in it gets the product name ``unknown``.
    """
    rows = of_level(parsed, "INFO").where(F.col("message").rlike(_INGESTED)).select(
        "ts",
        F.regexp_extract("message", _INGESTED, 1).alias("filename"),
        F.regexp_extract("message", _INGESTED, 2).try_cast("bigint").alias("file_id"),
    )
    if products is None:
        return rows
    known = products.select("file_id", "product_name", F.col("data_level").alias("level"))
    return rows.join(known, "file_id", "left").withColumn(
        "product_name", F.coalesce("product_name", F.lit("unknown"))
    )


def moved_to_error(parsed: DataFrame) -> DataFrame:
    """Files moved to the error folder: the base name of the fourth word from the end."""
    words = F.split(F.trim("message"), r"\s+")
    return of_level(parsed, "INFO").where(F.col("message").startswith("moveToError")).select(
        "ts", basename(F.try_element_at(words, F.lit(-4))).alias("filename")
    )


def commands_run(parsed: DataFrame) -> DataFrame:
    """The first run of each program, per log file where `log_name` is known."""
    per = [c for c in ("log_name",) if c in parsed.columns]
    rest = F.regexp_extract("message", _COMMAND, 1)
    rows = of_level(parsed, "INFO").where(F.col("message").rlike(_COMMAND)).select(
        *per, "ts", F.regexp_extract(rest, r"^(\S+)", 1).alias("filename"), "message"
    )
    return first_seen(rows, [*per, "filename"], ["ts", "message"]).select(*per, "ts", "filename")


def run_times(parsed: DataFrame) -> DataFrame:
    """(code, seconds) of every finished run."""
    return of_level(parsed, "INFO").where(F.col("message").rlike(_TOOK)).select(
        "ts", F.regexp_extract("message", _TOOK, 1).alias("code"),
        F.regexp_extract("message", _TOOK, 2).try_cast("double").alias("seconds"),
    )


def run_time_histogram(times: DataFrame, low: float, high: float, bins: int) -> DataFrame:
    """Runs per code and bin of equal width; bin 0 is below `low`, bin ``bins + 1`` from `high` on."""
    place = F.width_bucket(F.col("seconds"), F.lit(float(low)), F.lit(float(high)), F.lit(bins))
    return times.groupBy("code", place.alias("bin")).agg(F.count(F.lit(1)).alias("runs"))


def run_time_summary(times: DataFrame) -> DataFrame:
    """Count, extremes, mean and approximate median of the run times per code."""
    return times.groupBy("code").agg(
        F.count("seconds").alias("runs"), F.min("seconds").alias("shortest"), F.max("seconds").alias("longest"),
        F.avg("seconds").alias("mean"), F.percentile_approx("seconds", 0.5).alias("median"),
    )


def range_report(parsed: DataFrame, first, last) -> DataFrame:
    """Everything of interest between the start of one day and 23:59:59 of another, in time order.

    A program counts at its first run in its log file, so one first run
    before the range is not listed again from the same file.
    """
    start = F.lit(first).cast("date").cast("timestamp_ntz")
    stop = F.lit(last).cast("date").cast("timestamp_ntz") + F.expr("INTERVAL '86399' SECOND")
    second = F.date_trunc("second", F.col("ts"))
    in_range = (second >= start) & (second <= stop)

    # All kinds but the first runs come out of one pass over the lines.
    info, message = F.col("level") == "INFO", F.col("message")
    words = F.split(F.trim(message), r"\s+")
    kind = (
        F.when(F.col("level") == "ERROR", "error")
        .when(info & message.rlike(_INGESTED), "ingested")
        .when(info & message.startswith("moveToError"), "moved")
    )
    what = (
        F.when(F.col("kind") == "error", F.concat(
            "module", F.lit(":"), F.col("line").cast("string"), F.lit(" "), message))
        .when(F.col("kind") == "ingested", F.regexp_extract(message, _INGESTED, 1))
        .otherwise(basename(F.try_element_at(words, F.lit(-4))))
    )
    events = parsed.where(in_range).withColumn("kind", kind).where("kind IS NOT NULL").select(
        "kind", "ts", what.alias("what"))
    commands = commands_run(parsed).where(in_range).select(
        F.lit("command").alias("kind"), "ts", F.col("filename").alias("what"))
    return events.unionByName(commands).orderBy("ts", "kind", "what")


def report_counts(report: DataFrame) -> DataFrame:
    return report.groupBy("kind").agg(F.count(F.lit(1)).alias("entries"))
