"""Reading a catalogue (JSON dump, Parquet folder, database) and appending to it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.model import TABLES, Catalogue, conform


class RuleViolation(ValueError):
    """Rows to append break the rules of their table."""


def _dump_field(field: T.StructField) -> T.StructField:
    """Dates and times stand as text in a dump."""
    if isinstance(field.dataType, (T.DateType, T.TimestampNTZType)):
        return T.StructField(field.name, T.StringType(), True)
    return T.StructField(field.name, field.dataType, True)


def read_dump(spark: SparkSession, path: str) -> Catalogue:
    """A catalogue from a JSON dump: one object holding an array of rows per table.

    Tables or columns that an older dump lacks are empty or take their
    defaults.  The dump is one JSON value and so is read by one task; it is
    the exchange form for small catalogues.
    """
    schema = T.StructType([
        T.StructField(name, T.ArrayType(T.StructType([_dump_field(f) for f in spec.schema.fields])))
        for name, spec in TABLES.items()
    ])
    dump = spark.read.schema(schema).json(path, multiLine=True)
    return Catalogue(**{
        name: conform(_typed(dump.select(F.inline(name)), name), name) for name in TABLES
    })


def _typed(rows: DataFrame, table: str) -> DataFrame:
    casts = {}
    for field in TABLES[table].schema.fields:
        if isinstance(field.dataType, T.DateType):
            casts[field.name] = F.to_date(F.col(field.name).try_cast("timestamp_ntz"))
        elif isinstance(field.dataType, T.TimestampNTZType):
            casts[field.name] = F.col(field.name).try_cast("timestamp_ntz")
    return rows.withColumns(casts) if casts else rows


def read_tables(spark: SparkSession, folder: str, tables: list[str] | None = None) -> Catalogue:
    """A catalogue from a folder with one Parquet directory per table.

    A column that older files lack takes its default.  The month column that
    the file table is partitioned by stays, so date filters prune folders.
    """
    out = {}
    for table in tables or list(TABLES):
        rows = spark.read.option("mergeSchema", "false").parquet(f"{folder}/{table}")
        out[table] = conform(rows, table, keep=("file_month",))
    return Catalogue(**out)


def read_database(spark: SparkSession, url: str, properties: dict[str, str] | None = None,
                  tables: list[str] | None = None, partitions: dict[str, dict] | None = None) -> Catalogue:
    """A catalogue through JDBC (SQLite, PostgreSQL); needs the driver's jar on the class path.

    `partitions` may give per table the ``column``, ``lowerBound``,
    ``upperBound`` and ``numPartitions`` of a parallel read; a big table needs
    it, as a plain JDBC read is one task.
    """
    out = {}
    for table in tables or list(TABLES):
        rows = spark.read.jdbc(url, table, properties=properties or {}, **(partitions or {}).get(table, {}))
        out[table] = conform(rows, table)
    return Catalogue(**out)


def checked_append(catalogue: Catalogue, table: str, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows given the table's shape, and the rules they would break in this catalogue.

    Uniqueness is checked against the rows already there, the other rules on
    the new rows alone.
    """
    from tidemark.operators.audit import table_violations

    shaped = conform(rows, table)
    spec = TABLES[table]
    broken = table_violations(catalogue.replace(**{table: shaped}), table)
    if table not in catalogue:
        return shaped, broken
    present = getattr(catalogue, table)
    for columns in (spec.key, *spec.unique):
        if set(columns) <= set(present.columns):
            clash = shaped.join(present.select(*columns), list(columns), "left_semi")
            key = F.concat_ws("|", *[F.col(c).cast("string") for c in columns])
            broken = broken.unionByName(clash.select(
                F.lit(table).alias("table_name"), F.lit(f"unique {','.join(columns)}").alias("rule"),
                key.alias("key"), F.lit("already in the catalogue").alias("detail"),
            ))
    return shaped, broken


def append_rows(catalogue: Catalogue, table: str, rows: DataFrame, folder: str) -> DataFrame:
    """Check rows against the catalogue and append them to the table's Parquet directory.

    Nothing is written when a rule is broken; the error shows a few of the
    violations.  The file table is partitioned by the month of the file date.
    """
    shaped, broken = checked_append(catalogue, table, rows)
    sample = broken.limit(5).collect()
    if sample:
        raise RuleViolation("; ".join(f"{r.table_name} {r.key}: {r.rule}" for r in sample))
    write_table(shaped, table, folder)
    return shaped


def write_table(rows: DataFrame, table: str, folder: str, mode: str = "append") -> None:
    """Write a table with the model's types; the file table by month, each month's rows kept in few files.

    Times are stored as the model has them, without a zone, so that bounds on them reach the scan.
    """
    rows = conform(rows, table, keep=tuple(c for c in rows.columns if c not in TABLES[table].schema.names))
    writer = rows.write.mode(mode)
    if table == "file":
        months = rows.withColumn("file_month", F.date_format("utc_file_date", "yyyy-MM"))
        # Rows of one month spread over some tasks by id, so a hot month is not one task's.
        spread = F.pmod(F.xxhash64("file_id"), F.lit(16))
        writer = (
            months.repartition("file_month", spread).sortWithinPartitions("file_month", "product_id", "utc_file_date")
            .write.mode(mode).partitionBy("file_month")
        )
    writer.parquet(f"{folder}/{table}")


def write_report(report: DataFrame, path: str, form: str = "parquet") -> None:
    """Write a report's rows as Parquet, CSV (with header) or JSON lines."""
    if form not in ("parquet", "csv", "json"):
        raise ValueError("form must be parquet, csv or json")
    writer = report.write.mode("overwrite")
    (writer.option("header", "true") if form == "csv" else writer).format(form).save(path)
