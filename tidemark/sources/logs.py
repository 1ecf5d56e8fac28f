"""Dated log files as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.dates import extract_day, parse_day
from tidemark.functions.text import basename


def read_log_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Lines of all log files with file name and the date in it (``YYYY-MM-DD`` or ``YYYYMMDD``)."""
    name = basename(F.input_file_name())
    dashed = F.nullif(F.regexp_extract(name, r"(\d{4}-\d\d-\d\d)", 1), F.lit(""))
    return spark.read.text(paths).select(
        "value",
        name.alias("log_name"),
        F.coalesce(parse_day(dashed), extract_day(name)).alias("log_date"),
    )


def logs_between(lines: DataFrame, first, last) -> DataFrame:
    """Lines of the log files dated in the closed range."""
    day = F.col("log_date")
    return lines.where((day >= F.lit(first).cast("date")) & (day <= F.lit(last).cast("date")))
