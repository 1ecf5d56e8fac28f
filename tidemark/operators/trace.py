"""Trace-back joins through the dimension tables, for all keys at once.

The dimension chain is joined among the small tables first; a fact table then
joins the finished chain once.  No side is forced to broadcast: Spark does so
where the table's size allows and shuffles otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.model import Catalogue


def trace_instruments(catalogue: Catalogue) -> DataFrame:
    """Instrument with its satellite and mission."""
    satellite = catalogue.satellite.select("satellite_id", "satellite_name", "mission_id")
    mission = catalogue.mission.select("mission_id", "mission_name", "rootdir")
    return (
        catalogue.instrument.select("instrument_id", "instrument_name", "satellite_id")
        .join(satellite, "satellite_id")
        .join(mission, "mission_id")
    )


def trace_products(catalogue: Catalogue, inspectors: bool = False) -> DataFrame:
    """Product with instrument, satellite and mission through the link table.

    A product without a link has no row; one with several links has several.
    `inspectors` adds the inspector step, which drops products with none.
    """
    link = catalogue.instrumentproductlink.select("product_id", "instrument_id")
    own = [c for c in catalogue.product.columns if c != "instrument_id"]
    out = catalogue.product.select(*own).join(link, "product_id")
    if inspectors:
        out = out.join(
            catalogue.inspector.select("inspector_id", F.col("product").alias("product_id")), "product_id"
        )
    return out.join(trace_instruments(catalogue), "instrument_id")


def trace_files(catalogue: Catalogue) -> DataFrame:
    """Each file with every trace-back row it has."""
    chain = trace_products(catalogue, inspectors=True)
    return catalogue.file.join(chain, "product_id")


def trace_inspectors(catalogue: Catalogue) -> DataFrame:
    """Each inspector with the trace-back of its product."""
    chain = trace_products(catalogue).withColumnRenamed("product_id", "product")
    return catalogue.inspector.select("inspector_id", "product").join(chain, "product")


def trace_processes(catalogue: Catalogue, day) -> DataFrame:
    """Each process with its output product's trace-back and the code active on `day`."""
    chain = trace_products(catalogue, inspectors=True).withColumnRenamed("product_id", "output_product")
    dated = catalogue.process.select("process_id").withColumn("day", F.lit(day).cast("date"))
    code = code_for_process(dated, catalogue.code).select("process_id", "code_id", "n_codes")
    return (
        catalogue.process.join(chain, "output_product").join(code, "process_id", "left")
    )


def trace_codes(catalogue: Catalogue) -> DataFrame:
    """Each code with its process; beyond the process only when that is not a RUN one."""
    chain = trace_products(catalogue, inspectors=True).withColumnRenamed("product_id", "output_product")
    base = catalogue.code.select("code_id", "process_id").join(
        catalogue.process.select("process_id", "output_product", "output_timebase"), "process_id"
    )
    run = F.coalesce(F.col("output_timebase") == "RUN", F.lit(False))
    traced = base.where(~run).join(chain, "output_product")
    return traced.unionByName(base.where(run), allowMissingColumns=True)


def multiplicity(keys: DataFrame, traced: DataFrame, key: str) -> DataFrame:
    """How many trace-back rows each key has; anything but 1 is a fault.

    For files, count at the product level and join the counts to the files:
    the number of rows depends on the product alone.
    """
    counts = traced.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    rows = F.coalesce(F.col("rows"), F.lit(0))
    fault = F.when(rows == 0, "no traceback").when(rows > 1, "multiple tracebacks")
    return (
        keys.select(key).join(counts, key, "left").select(key, rows.alias("rows"), fault.alias("fault"))
    )


def satellite_mission(catalogue: Catalogue) -> DataFrame:
    """Mission of each satellite."""
    return catalogue.satellite.join(
        catalogue.mission.select("mission_id", "mission_name"), "mission_id"
    ).select("satellite_id", "satellite_name", "mission_id", "mission_name")


def _is_active() -> Column:
    return F.col("newest_version") & F.col("active_code")


def active_codes_of_process(code: DataFrame) -> DataFrame:
    """Active, newest codes of every process with their period."""
    return code.where(_is_active()).select("process_id", "code_id", "code_start_date", "code_stop_date")


def code_is_active(code: DataFrame, day) -> DataFrame:
    """Is each code active, newest and valid on `day`?"""
    day = F.lit(day).cast("date")
    inside = (F.col("code_start_date") <= day) & (F.col("code_stop_date") >= day)
    return code.select("code_id", (_is_active() & inside).alias("is_active"))


def code_for_process(dated: DataFrame, code: DataFrame, day: str = "day") -> DataFrame:
    """The code valid for each (process, day) row: none gives null, several give a count above 1.

    The join carries the process as equi key and the period as a residual
    condition, so it hashes on the process.  `dated` needs distinct
    (process_id, day) rows.
    """
    active = active_codes_of_process(code).withColumnRenamed("process_id", "_process")
    hit = (
        (F.col("process_id") == F.col("_process"))
        & (F.col(day) >= F.col("code_start_date"))
        & (F.col(day) <= F.col("code_stop_date"))
    )
    return (
        dated.join(active, hit, "left")
        .groupBy(*dated.columns)
        .agg(F.min("code_id").alias("_code"), F.count("code_id").alias("n_codes"))
        .withColumn("code_id", F.when(F.col("n_codes") == 1, F.col("_code")))
        .drop("_code")
    )


def child_processes(catalogue: Catalogue, files: DataFrame) -> DataFrame:
    """(file, process) pairs: the processes that take each file's product as input."""
    links = catalogue.productprocesslink.select(
        F.col("input_product_id").alias("product_id"), "process_id"
    )
    return files.select("file_id", "product_id").join(links, "product_id")


def processes_of_inputs(catalogue: Catalogue) -> DataFrame:
    """Input product to process."""
    return catalogue.productprocesslink.select(
        F.col("input_product_id").alias("product_id"), "process_id"
    )


def process_of_output(catalogue: Catalogue) -> DataFrame:
    """Output product to the first (lowest id) process that makes it."""
    return (
        catalogue.process.where("output_product IS NOT NULL")
        .groupBy(F.col("output_product").alias("product_id"))
        .agg(F.min("process_id").alias("process_id"))
    )
