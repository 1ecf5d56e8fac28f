"""Which days have which files: gaps, matrices, version tables, latest views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import days_between, extract_day, extract_month
from tidemark.functions.text import basename
from tidemark.functions.version import PARTS, extract_version, format_version, version_of
from tidemark.operators.catalogue import CELL, first_seen, in_date_range, newest
from tidemark.operators.skew import join_to_groups

_BASE = r"^(.*?)v\d\d?\.\d\d?\.\d\d?\..*$"


def calendar(products: DataFrame, first: Column, last: Column) -> DataFrame:
    """One row per product and day; each product row expands its own days."""
    return products.select("*", F.explode(days_between(first, last)).alias("day"))


def missing_dates(files: DataFrame, products: DataFrame, first, last) -> DataFrame:
    """(product, day) cells of the closed range with no file of that product.

    A day without a newest file is a day without any file, so the distinct
    cells are enough and versions need not be ranked.
    """
    cells = in_date_range(files, first, last).select(*CELL).distinct()
    days = calendar(products.select("product_id"), F.lit(first).cast("date"), F.lit(last).cast("date"))
    return days.join(
        cells.withColumnRenamed("utc_file_date", "day"), ["product_id", "day"], "left_anti"
    )


def parents_of_missing(files: DataFrame, edges: DataFrame, missing: DataFrame) -> DataFrame:
    """Files (all versions) of each parent product on the days its child lacks.

    `edges` has (product_id, child_id).  Cells are matched first; the rows of
    a hot cell are then joined in shares.
    """
    wanted = (
        missing.withColumnRenamed("product_id", "child_id").join(edges, "child_id")
        .select("product_id", F.col("day").alias("utc_file_date")).distinct()
    )
    cells = files.groupBy(*CELL).agg(F.count(F.lit(1)).alias("group_rows")).join(wanted, CELL, "left_semi")
    return join_to_groups(files, cells, CELL, "file_id")


def coverage_matrix(files: DataFrame, panels: DataFrame, first, last) -> DataFrame:
    """0 or 1 per (panel, product, day).

    `panels` has `panel` and `product_id`, and may have `pattern` (a whole
    name expression, see ``glob_pattern``) and `minimum` (a version).  Both
    test the newest file of a day only; an older match does not count.
    """
    ranked = newest(in_date_range(files, first, last)).select(
        "product_id", F.col("utc_file_date").alias("day"), "filename", version_of().alias("_version")
    )
    days = calendar(panels, F.lit(first).cast("date"), F.lit(last).cast("date"))
    joined = days.join(ranked, ["product_id", "day"], "left")
    covered = F.col("filename").isNotNull()
    if "pattern" in panels.columns:
        covered = covered & (F.col("pattern").isNull() | F.expr("filename RLIKE pattern"))
    if "minimum" in panels.columns:
        covered = covered & (F.col("minimum").isNull() | (F.col("_version") >= F.col("minimum")))
    return joined.select("panel", "product_id", "day", covered.cast("int").alias("covered"))


def pages(days: DataFrame, first, per_page: int) -> DataFrame:
    """Add the page number of each day, `per_page` days to a page, counted from `first`."""
    return days.withColumn(
        "page", F.floor(F.datediff("day", F.lit(first).cast("date")) / F.lit(per_page))
    )


def version_by_day(files: DataFrame, products: DataFrame, extra_days: int = 3) -> DataFrame:
    """Newest version per product and day, null where there is none, latest day first.

    The days run from the first file date of the whole table to `extra_days`
    past the last, that end excluded.  `products` has `product_id`,
    `product_name`, `level` and whatever names the report groups by.
    """
    first = files.agg(F.min("utc_file_date")).scalar()
    last = files.agg(F.date_add(F.max("utc_file_date"), extra_days - 1)).scalar()
    listed = products.withColumns({"_first": first, "_last": last})
    days = calendar(listed, F.col("_first"), F.col("_last")).drop("_first", "_last")
    shown = newest(files).select(
        "product_id", F.col("utc_file_date").alias("day"), format_version(version_of()).alias("version")
    )
    return days.join(shown, ["product_id", "day"], "left").orderBy(
        F.col("day").desc(), "level", "product_name", "product_id"
    )


def as_table(by_day: DataFrame, product_names: list[str], value: str = "version") -> DataFrame:
    """Pivot a long result to one row per day and one column per named product."""
    return (
        by_day.groupBy("day").pivot("product_name", product_names).agg(F.first(value, ignorenulls=True))
        .orderBy(F.col("day").desc())
    )


def latest_view(
    names: DataFrame, links: DataFrame, first=None, last=None, today=None, delay_days: int = 0
) -> DataFrame:
    """Which links a "latest files" folder should gain and lose.

    Of each base name (the text before the version) the newest file is
    shown, if its date lies in [first, min(last, today - delay_days)].  Names
    are dated by day, else by month; undated ones are not shown.  Without
    `first` and `last` dates do not matter.  `names` and `links` have
    `filename`; the result adds `action` (``add`` or ``remove``).
    """
    name = basename(F.col("filename"))
    base = F.when(name.rlike(_BASE), F.regexp_extract(name, _BASE, 1)).otherwise(name)
    version = extract_version(name)
    parts = names.select("filename", base.alias("_base"), version.alias("_v"))
    parts = parts.withColumns({f"_{p}": F.col("_v")[p] for p in PARTS})
    shown = first_seen(
        parts, ["_base"], [F.col(f"_{p}").desc_nulls_last() for p in PARTS] + [F.col("filename")]
    )
    if first is not None and last is not None:
        final = F.lit(last).cast("date")
        if today is not None:
            final = F.least(final, F.date_sub(F.lit(today).cast("date"), delay_days))
        day = F.coalesce(extract_day(F.col("filename")), extract_month(F.col("filename")))
        shown = shown.where((day >= F.lit(first).cast("date")) & (day <= final))
    shown = shown.select("filename")
    add = shown.join(links.select("filename"), "filename", "left_anti")
    remove = links.select("filename").join(shown, "filename", "left_anti")
    return add.withColumn("action", F.lit("add")).unionByName(remove.withColumn("action", F.lit("remove")))
