"""Dates in file names, date ranges and integer seconds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted period of dates found in names.
EARLIEST = "1957-10-04 19:28:34"
LATEST = "2050-01-01 00:00:00"

_DAY_IN_NAME = r"([12][90]\d\d[01]\d[0-3]\d)"
_MONTH_IN_NAME = r"([12][90]\d\d[01]\d)"


def _in_period(day: Column) -> Column:
    moment = day.cast("timestamp_ntz")
    low, high = (F.lit(t).cast("timestamp_ntz") for t in (EARLIEST, LATEST))
    return F.when((moment >= low) & (moment <= high), day)


def _parsed(text: Column, pattern: str) -> Column:
    return F.to_date(F.try_to_timestamp(text, F.lit(pattern)))


def extract_day(name: Column) -> Column:
    """Date of the first ``YYYYMMDD``-like run in a name; null if it is no accepted date.

    Only the first run counts, as a later valid one would be a guess.
    """
    return _in_period(_parsed(F.nullif(F.regexp_extract(name, _DAY_IN_NAME, 1), F.lit("")), "yyyyMMdd"))


def extract_month(name: Column) -> Column:
    """First day of the month of the first ``YYYYMM``-like run in a name, else null."""
    text = F.nullif(F.regexp_extract(name, _MONTH_IN_NAME, 1), F.lit(""))
    return _in_period(_parsed(F.concat(text, F.lit("01")), "yyyyMMdd"))


def valid_day(text: Column) -> Column:
    """Is `text` a real ``YYYYMMDD`` date?"""
    return F.coalesce(text.rlike(r"^\d{8}$"), F.lit(False)) & _parsed(text, "yyyyMMdd").isNotNull()


def days_between(first: Column, last: Column) -> Column:
    """Array of every day from `first` to `last`, both included; empty when reversed."""
    first, last = first.cast("date"), last.cast("date")
    return F.when(
        first <= last, F.sequence(first, last, F.expr("INTERVAL 1 DAY"))
    ).otherwise(F.array().cast("array<date>"))


def parse_day(text: Column) -> Column:
    """``YYYY-MM-DD`` to a date; anything else is null."""
    return F.when(text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), _parsed(text, "yyyy-M-d"))


def parse_month_end(text: Column) -> Column:
    """``YYYYMM`` to the last day of that month; anything else is null."""
    return F.when(
        text.rlike(r"^\d{6}$"), F.last_day(_parsed(F.concat(text, F.lit("01")), "yyyyMMdd"))
    )


def as_moment(day: Column, end: bool = False) -> Column:
    """A date as its first moment, or as its last representable one when `end`."""
    moment = day.cast("date").cast("timestamp_ntz")
    return moment + F.expr("INTERVAL '86399.999999' SECOND") if end else moment


def whole_seconds(moment: Column) -> Column:
    """Seconds since 1970, the fraction cut off toward zero (not floored)."""
    micros = F.unix_micros(moment.cast("timestamp"))
    return F.call_function("div", micros, F.lit(1_000_000))
