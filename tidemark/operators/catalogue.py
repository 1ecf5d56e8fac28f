"""Catalogue queries: filters, newest version, lookups and listings.

Three scopes of "newest" are kept apart on purpose:

* ``newest``      newest among the rows that are *left* after other filters;
* ``newest_ids``  newest of a product and date in the whole file table;
* ``cell_versions``  the highest version of a product and date, no file named.

Ties on the version are broken by the highest file id.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.dates import whole_seconds
from tidemark.functions.templates import substitute_path
from tidemark.functions.text import join_path
from tidemark.functions.version import format_version, version, version_of
from tidemark.model import Catalogue

CELL = ["product_id", "utc_file_date"]


def _newest_first() -> list[Column]:
    return [
        F.col("interface_version").desc(),
        F.col("quality_version").desc(),
        F.col("revision_version").desc(),
        F.col("file_id").desc(),
    ]


def newest(files: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """The newest row of each (product, date) among the given rows.

    Spark limits each key to one row before the shuffle (the group limit of
    a ``row_number = 1`` filter), so a hot key sends one row per task.  A
    null date is a key of its own.
    """
    window = Window.partitionBy(*(keys or CELL)).orderBy(*_newest_first())
    return (
        files.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")
    )


# Versions and id as one exact number: three 16-bit parts above a 64-bit id.
_ID_RANGE = "CAST(18446744073709551616 AS DECIMAL(20,0))"
_ID_OFFSET = "CAST(9223372036854775808 AS DECIMAL(20,0))"
_PACKED_VERSION = (
    "(CAST(CAST(interface_version AS SMALLINT) AS BIGINT) + 32768) * 4294967296"
    " + (CAST(CAST(quality_version AS SMALLINT) AS BIGINT) + 32768) * 65536"
    " + CAST(CAST(revision_version AS SMALLINT) AS BIGINT) + 32768"
)


def newest_ids(files: DataFrame) -> DataFrame:
    """Ids of the files that are newest for their product and date.

    Version and id are ranked as one decimal, whose maximum Spark keeps in a
    hash aggregate; a struct or a window would sort every input partition.
    Version parts are small integers, so nothing is lost in the packing, and
    a part out of that range raises an error.
    """
    packed = F.expr(
        f"CAST({_PACKED_VERSION} AS DECIMAL(15,0)) * {_ID_RANGE}"
        f" + (CAST(file_id AS DECIMAL(20,0)) + {_ID_OFFSET})"
    )
    tops = files.groupBy(*CELL).agg(F.max(packed).alias("_top"))
    return tops.select(F.expr(f"CAST(_top % {_ID_RANGE} - {_ID_OFFSET} AS BIGINT)").alias("file_id"))


def is_newest(files: DataFrame) -> DataFrame:
    """Every file with the flag `is_newest`; the join is on the unique file id."""
    flags = newest_ids(files).select("file_id", F.lit(True).alias("_newest"))
    return (
        files.join(flags, "file_id", "left")
        .withColumn("is_newest", F.coalesce("_newest", F.lit(False)))
        .drop("_newest")
    )


def cell_versions(files: DataFrame) -> DataFrame:
    """Highest version and row count of each (product, date)."""
    return files.groupBy(*CELL).agg(
        F.max(version_of()).alias("max_version"), F.count(F.lit(1)).alias("group_rows")
    )


def keep_newest(given: DataFrame, files: DataFrame) -> DataFrame:
    """Of the given file ids, those newest for their product and date."""
    return given.join(newest_ids(files), "file_id", "left_semi")


def _day(value) -> Column:
    return F.lit(value).cast("date")


def _bound_seconds(value, end: bool) -> int:
    """Integer seconds of a date or time bound; a plain date means its first or last moment."""
    if isinstance(value, str):
        value = dt.datetime.strptime(value, "%Y-%m-%d")
        value = value.date()
    if not isinstance(value, dt.datetime):
        value = dt.datetime(value.year, value.month, value.day)
        if end:
            value += dt.timedelta(seconds=86399, microseconds=999999)
    return int((value - dt.datetime(1970, 1, 1)).total_seconds())


def in_time_range(
    files: DataFrame, start_time=None, end_time=None, whole_second: bool = True
) -> DataFrame:
    """Files whose closed interval overlaps the closed range; either side may be open.

    With `whole_second` both sides drop the fraction, which may keep a file
    that misses the range by less than a second but never loses one.  The
    bounds on the raw times that follow from it reach the scan.
    """
    def moment(seconds: int) -> Column:
        return F.lit(dt.datetime(1970, 1, 1) + dt.timedelta(seconds=seconds)).cast("timestamp_ntz")

    if whole_second and start_time is not None:
        files = files.where(F.col("utc_stop_time") > moment(_bound_seconds(start_time, False) - 1))
    if whole_second and end_time is not None:
        files = files.where(F.col("utc_start_time") < moment(_bound_seconds(end_time, True) + 1))
    if whole_second:
        start, stop = whole_seconds(F.col("utc_start_time")), whole_seconds(F.col("utc_stop_time"))
        low = None if start_time is None else F.lit(_bound_seconds(start_time, False))
        high = None if end_time is None else F.lit(_bound_seconds(end_time, True))
    else:
        start, stop = F.col("utc_start_time"), F.col("utc_stop_time")
        low = None if start_time is None else F.lit(start_time).cast("timestamp_ntz")
        high = None if end_time is None else F.lit(end_time).cast("timestamp_ntz")
    if low is not None:
        files = files.where(stop >= low)
    if high is not None:
        files = files.where(start <= high)
    return files


def in_date_range(files: DataFrame, start_date=None, end_date=None) -> DataFrame:
    """Files with a file date in the closed range; either side may be open.

    A table stored by month (`file_month`) is pruned to the months in range.
    """
    by_month = "file_month" in files.columns
    if start_date is not None:
        files = files.where(F.col("utc_file_date") >= _day(start_date))
        if by_month:
            files = files.where(F.col("file_month") >= F.date_format(_day(start_date), "yyyy-MM"))
    if end_date is not None:
        files = files.where(F.col("utc_file_date") <= _day(end_date))
        if by_month:
            files = files.where(F.col("file_month") <= F.date_format(_day(end_date), "yyyy-MM"))
    return files


def select_files(
    catalogue: Catalogue,
    *,
    start_date=None,
    end_date=None,
    level: float | None = None,
    product: int | None = None,
    products: Iterable[int] | None = None,
    code: int | None = None,
    instrument: int | None = None,
    exists: bool | None = None,
    newest_version: bool = False,
    limit: int | None = None,
    start_time=None,
    end_time=None,
) -> DataFrame:
    """The conjunction of all given filters; newest is taken from what they leave.

    Filters on file columns come first so that they reach the scan.  With
    both `limit` and `newest_version` the limit cuts the rows, lowest version
    first, *before* the newest are picked.
    """
    files = catalogue.file
    if product is not None:
        files = files.where(F.col("product_id") == product)
    if products is not None:
        files = files.where(F.col("product_id").isin(list(products)))
    if level is not None:
        files = files.where(F.col("data_level") == level)
    if exists is not None:
        files = files.where(F.col("exists_on_disk") == exists)
    files = in_date_range(files, start_date, end_date)
    files = in_time_range(files, start_time, end_time)
    if code is not None:
        made = catalogue.filecodelink.where(F.col("source_code") == code)
        files = files.join(made, files.file_id == made.resulting_file, "left_semi")
    if instrument is not None:
        linked = catalogue.instrumentproductlink.where(F.col("instrument_id") == instrument)
        files = files.join(linked.select("product_id"), "product_id", "left_semi")
    if limit is not None:
        order = ["file_id"]
        if newest_version:
            order = ["interface_version", "quality_version", "revision_version", "file_id"]
        files = files.orderBy(*order).limit(limit)
    return newest(files) if newest_version else files


def files_by_product_date(catalogue: Catalogue, product: int, dates: list, **kw) -> DataFrame:
    """Files of one product whose date lies between the earliest and latest of `dates`."""
    return select_files(catalogue, product=product, start_date=min(dates), end_date=max(dates), **kw)


def files_by_product_time(catalogue: Catalogue, product: int, times: list, **kw) -> DataFrame:
    """Files of one product that overlap the time between the earliest and latest of `times`."""
    return select_files(catalogue, product=product, start_time=min(times), end_time=max(times), **kw)


def files_by_date(catalogue: Catalogue, dates: list, **kw) -> DataFrame:
    """Files of any product whose date lies between the earliest and latest of `dates`."""
    return select_files(catalogue, start_date=min(dates), end_date=max(dates), **kw)


def files_by_product(catalogue: Catalogue, keys: DataFrame, newest_version: bool = False) -> DataFrame:
    """Files of the products named by `keys` (column `key`, a name or an id)."""
    found = resolve(keys, catalogue.product, "product_id", "product_name")
    wanted = found.where("id IS NOT NULL").select(F.col("id").alias("product_id")).distinct()
    files = catalogue.file.join(wanted, "product_id", "left_semi")
    return newest(files) if newest_version else files


def files_by_instrument(catalogue: Catalogue, instrument: int, level=None, **kw) -> DataFrame:
    """Ids of the files whose product is linked to the instrument."""
    return select_files(catalogue, instrument=instrument, level=level, **kw).select("file_id")


def files_by_code(catalogue: Catalogue, code: int, **kw) -> DataFrame:
    """Files made by one code."""
    return select_files(catalogue, code=code, **kw)


def code_of_files(catalogue: Catalogue) -> DataFrame:
    """The lowest code id recorded for each file that has one."""
    return catalogue.filecodelink.groupBy(F.col("resulting_file").alias("file_id")).agg(
        F.min("source_code").alias("code_id")
    )


def with_version(rows: DataFrame, name: str = "version") -> DataFrame:
    """Add the composite version of file, code or inspector rows."""
    return rows.withColumn(name, version_of())


def version_text() -> Column:
    return format_version(version_of())


def at_least_version(files: DataFrame, interface: int, quality: int, revision: int) -> DataFrame:
    """Files whose version is not below the given one."""
    return files.where(version_of() >= version(interface, quality, revision))


def full_paths(files: DataFrame, product_trace: DataFrame, root: str) -> DataFrame:
    """Add `full_path`: root, product directory and file name, with fields filled.

    `product_trace` has one row per product with `relative_path` and the name
    columns of :func:`tidemark.operators.trace.trace_products`.
    """
    wanted = ["relative_path", "instrument_name", "satellite_name", "mission_name", "product_name"]
    have = [c for c in wanted if c in product_trace.columns and (c == "relative_path" or c not in files.columns)]
    joined = files.join(product_trace.select("product_id", *have), "product_id")
    names = {
        "INSTRUMENT": "instrument_name", "SATELLITE": "satellite_name",
        "SPACECRAFT": "satellite_name", "MISSION": "mission_name", "PRODUCT": "product_name",
    }
    path = substitute_path(
        join_path(F.lit(root), F.col("relative_path"), F.col("filename")),
        F.col("utc_file_date"),
        F.col("utc_start_time"),
        version_text(),
        {k: F.col(c) for k, c in names.items() if c in joined.columns},
    )
    return joined.withColumn("full_path", path).select(*files.columns, "full_path")


def file_dates(files: DataFrame) -> DataFrame:
    """First and last day each file's data span."""
    return files.select(
        "file_id",
        F.to_date("utc_start_time").alias("first_day"),
        F.to_date("utc_stop_time").alias("last_day"),
    )


def resolve(
    keys: DataFrame, table: DataFrame, id_column: str, name_column: str, all_ids: bool = False
) -> DataFrame:
    """Turn each `key` (text: an id or a name) into an id of `table`.

    A key that reads as an integer is looked up as an id, any other as a
    name.  A repeated name gives its lowest id, or every id with `all_ids`
    (the rule for code names).  Keys that match nothing stay, with a null id.
    """
    number = F.col("key").try_cast("bigint")
    named = keys.withColumn("_number", number)
    by_id = (
        named.where("_number IS NOT NULL")
        .join(table.select(F.col(id_column).alias("id")), F.col("_number") == F.col("id"), "left")
        .select("key", "id")
    )
    names = table.select(F.col(name_column).alias("_name"), F.col(id_column).alias("id"))
    if not all_ids:
        names = names.groupBy("_name").agg(F.min("id").alias("id"))
    by_name = (
        named.where("_number IS NULL")
        .join(names, F.col("key") == F.col("_name"), "left")
        .select("key", "id")
    )
    return by_id.unionByName(by_name)


def resolve_instruments(keys: DataFrame, instrument: DataFrame) -> DataFrame:
    """Instrument names with their satellite (column `satellite_id`, may be null) to ids.

    Without a satellite a name that several satellites share is ambiguous:
    `matches` counts the candidates and the id is given only when there is one.
    """
    named = instrument.select(
        F.col("instrument_name").alias("_name"), F.col("satellite_id").alias("_satellite"), "instrument_id"
    )
    hit = (F.col("key") == F.col("_name")) & (
        F.col("satellite_id").isNull() | (F.col("satellite_id") == F.col("_satellite"))
    )
    return (
        keys.join(named, hit, "left")
        .groupBy("key", "satellite_id")
        .agg(F.count("instrument_id").alias("matches"), F.min("instrument_id").alias("_id"))
        .withColumn("id", F.when(F.col("matches") == 1, F.col("_id")))
        .drop("_id")
    )


def product_listing(trace: DataFrame, files: DataFrame) -> DataFrame:
    """Products with their dimension names and file counts, in report order."""
    counts = files.groupBy("product_id").agg(F.count(F.lit(1)).alias("n_files"))
    return (
        trace.join(counts, "product_id", "left")
        .withColumn("n_files", F.coalesce("n_files", F.lit(0)))
        .orderBy("satellite_name", "instrument_name", "level", "product_name", "product_id")
    )


def process_inputs(catalogue: Catalogue) -> DataFrame:
    """Each process with its required and optional input product names as sorted lists."""
    named = catalogue.productprocesslink.join(
        catalogue.product.select(F.col("product_id").alias("input_product_id"), "product_name"),
        "input_product_id",
    )
    lists = named.groupBy("process_id").agg(
        F.array_sort(F.collect_list(F.when(~F.col("optional"), F.col("product_name")))).alias("required"),
        F.array_sort(F.collect_list(F.when(F.col("optional"), F.col("product_name")))).alias("optional"),
    )
    nothing = F.array().cast("array<string>")
    return catalogue.process.join(lists, "process_id", "left").withColumns(
        {"required": F.coalesce("required", nothing), "optional": F.coalesce("optional", nothing)}
    )


def required_inputs(catalogue: Catalogue) -> DataFrame:
    """Distinct products that some process cannot run without."""
    return (
        catalogue.productprocesslink.where(~F.col("optional"))
        .select(F.col("input_product_id").alias("product_id"))
        .distinct()
        .join(catalogue.product.select("product_id", "product_name"), "product_id")
    )


def active_inspectors(catalogue: Catalogue, inspector_root: str) -> DataFrame:
    """Active, newest inspectors with their full path."""
    path = join_path(F.lit(inspector_root), F.col("relative_path"), F.col("filename"))
    return (
        catalogue.inspector.where("active_code AND newest_version")
        .select("inspector_id", path.alias("path"), "description", "arguments", "product")
    )


def active_codes(catalogue: Catalogue) -> DataFrame:
    """Active, newest codes with the name of their process."""
    return (
        catalogue.code.where("active_code AND newest_version")
        .join(catalogue.process.select("process_id", "process_name"), "process_id")
        .withColumn("version", version_text())
    )


def processes(catalogue: Catalogue, timebase: str = "all") -> DataFrame:
    """All processes, or those of one output timebase."""
    if timebase == "all":
        return catalogue.process
    return catalogue.process.where(F.col("output_timebase") == timebase.upper())


def products_by_level(catalogue: Catalogue, level: float) -> DataFrame:
    return catalogue.product.where(F.col("level") == level).select("product_id")


def products_by_instrument(catalogue: Catalogue, instrument: int) -> DataFrame:
    return catalogue.instrumentproductlink.where(F.col("instrument_id") == instrument).select("product_id")


def missions(catalogue: Catalogue) -> DataFrame:
    """Missions with their root and incoming folders."""
    return catalogue.mission.select("mission_id", "mission_name", "rootdir", "incoming_dir").orderBy("mission_id")


def provenance(files: DataFrame) -> DataFrame:
    """Name and recorded command of every file that has one."""
    return files.where("verbose_provenance IS NOT NULL").select("file_id", "filename", "verbose_provenance")


def product_file_listing(
    catalogue: Catalogue, product: int, root: str, product_trace: DataFrame, start_date=None, end_date=None
) -> DataFrame:
    """Files of a product in a date range by name; one open side takes the widest bound."""
    if start_date is None and end_date is not None:
        start_date = dt.date(1957, 10, 4)
    if end_date is None and start_date is not None:
        end_date = dt.date(2100, 12, 31)
    files = select_files(catalogue, product=product, start_date=start_date, end_date=end_date)
    return full_paths(files, product_trace, root).orderBy("filename")


def row_at(df: DataFrame, order: list[str], index: int = 0) -> DataFrame:
    """The row at a position of a total order; a negative index counts from the end."""
    if index < 0:
        return df.orderBy(*[F.col(c).desc() for c in order]).offset(-index - 1).limit(1)
    return df.orderBy(*order).offset(index).limit(1)


def first_seen(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key, the first by `order`; a hot key is cut before the shuffle."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_seen", F.row_number().over(window)).where("_seen = 1").drop("_seen")


def newest_by_legacy_number(files: DataFrame) -> DataFrame:
    """Newest by the older number ``1000*i + 100*q + r``; ties go to the highest id."""
    number = (
        F.col("interface_version") * 1000 + F.col("quality_version") * 100 + F.col("revision_version")
    )
    window = Window.partitionBy(*CELL).orderBy(number.desc(), F.col("file_id").desc())
    return files.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")
