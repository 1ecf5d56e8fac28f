"""Consistency reports: table rules, odd rows, differences between catalogues."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.version import version_of
from tidemark.model import TABLES, Catalogue
from tidemark.operators.catalogue import CELL, cell_versions, newest, newest_by_legacy_number, newest_ids
from tidemark.operators.skew import join_to_groups
from tidemark.session import durable

# Rows of a table that one task looks through for repeated keys.
COUNTED_ROWS = 1_000_000


def _union(pieces: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), pieces)


def _key(columns) -> Column:
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in columns])


def table_violations(
    catalogue: Catalogue, table: str, unique: tuple[tuple[str, ...], ...] | None = None
) -> DataFrame:
    """Rows of one table that break its rules: (table_name, rule, key, detail).

    `unique` replaces the table's unique column sets.  As in SQL a unique set
    with a null in it is not compared, and a check that yields null passes.
    Rules on columns the table does not have are left out.

    The table is written once, as every rule reads it.  A unique set is
    counted in as many tasks as the table has portions of `COUNTED_ROWS`:
    narrow rows shuffle to few bytes, of which AQE would give a task any
    number.  Rows that repeat one key are counted as they come.
    """
    spec = TABLES[table]
    rows = getattr(catalogue, table)
    asked = {*spec.schema.fieldNames(), *(c for columns in unique or () for c in columns)}
    rows = durable(rows.select(*[c for c in rows.columns if c in asked]))
    tasks = -(-rows.count() // COUNTED_ROWS) or 1
    have = set(rows.columns)
    own = [c for c in spec.key if c in have]
    out = []

    def found(df: DataFrame, rule: str, key: Column, detail: Column) -> None:
        out.append(
            df.select(
                F.lit(table).alias("table_name"), F.lit(rule).alias("rule"), key.alias("key"),
                detail.cast("string").alias("detail"),
            )
        )

    # All row-wise rules in one pass over the table.
    faults = []
    for column in spec.required:
        if column in have:
            faults.append(F.when(F.col(column).isNull(), F.struct(
                F.lit(f"{column} not null").alias("rule"), F.lit("null").alias("detail"))))
    for rule, condition in spec.checks.items():
        if all(c in have for c in _columns_in(condition, spec)):
            faults.append(F.when(F.expr(f"NOT ({condition})"), F.struct(
                F.lit(rule).alias("rule"), F.lit(condition).alias("detail"))))
    if faults:
        listed = rows.select(_key(own).alias("key"), F.explode(F.array_compact(F.array(*faults))).alias("f"))
        out.append(listed.select(
            F.lit(table).alias("table_name"), F.col("f.rule").alias("rule"), "key", F.col("f.detail").alias("detail")
        ))
    for columns in (spec.key, *(spec.unique if unique is None else unique)):
        if set(columns) <= have:
            filled = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
            repeated = rows.where(filled).repartition(tasks, *columns).groupBy(*columns).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
            found(repeated, f"unique {','.join(columns)}", _key(columns),
                  F.concat(F.col("_n"), F.lit(" rows")))
    for column, target in spec.references.items():
        other, other_key = target.split(".")
        if column in have and other in catalogue:
            known = getattr(catalogue, other).select(F.col(other_key).alias(column))
            dangling = rows.where(F.col(column).isNotNull()).join(known, column, "left_anti")
            found(dangling, f"{column} references {target}", _key(own), F.col(column))
    return _union(out)


def _columns_in(condition: str, spec) -> list[str]:
    import re

    names = {f.name for f in spec.schema.fields}
    return [w for w in re.findall(r"\w+", condition) if w in names]


def violations(catalogue: Catalogue) -> DataFrame:
    """Broken rules of every table the catalogue holds."""
    return _union([table_violations(catalogue, table) for table in TABLES if table in catalogue])


def instrument_link_faults(catalogue: Catalogue) -> DataFrame:
    """Products linked to no instrument or to more than one."""
    counts = catalogue.instrumentproductlink.groupBy("product_id").agg(F.count(F.lit(1)).alias("_n"))
    n = F.coalesce("_n", F.lit(0))
    return (
        catalogue.product.join(counts, "product_id", "left")
        .where(n != 1)
        .select("product_id", "product_name", n.alias("links"))
    )


def odd_durations(files: DataFrame) -> DataFrame:
    """Newest files whose length in days fits no usual period; the ranges are open at both ends."""
    micros = F.timestamp_diff("MICROSECOND", F.col("utc_start_time"), F.col("utc_stop_time"))
    # Whole seconds only, as the usual periods are given in seconds.
    days = F.floor(micros / 1_000_000) / 86400
    kind = (
        F.when(days < 1 / 24, "short")
        .when((days > 2) & (days < 6), "odd week")
        .when((days > 8) & (days < 27), "odd month")
        .when(((days > 35) & (days < 364)) | (days > 368), "odd year")
    )
    return newest(files).select("file_id", "filename", days.alias("days"), kind.alias("kind")).where("kind IS NOT NULL")


def wrong_newest_flag(files: DataFrame) -> DataFrame:
    """Files whose stored `newest_version` flag does not match the version of their cell.

    All files that share the highest version should carry the flag.
    """
    rows = files.select("file_id", "filename", *CELL, "newest_version", version_of().alias("_version"))
    joined = join_to_groups(rows, cell_versions(files), CELL, "file_id")
    should = F.col("_version") == F.col("max_version")
    return joined.where(should != F.col("newest_version")).select(
        "file_id", "filename", F.when(should, "not marked newest").otherwise("marked newest").alias("fault")
    )


def dates_without_newest(files: DataFrame) -> DataFrame:
    """(product, date) cells with files of which none carries the stored flag."""
    flagged = files.groupBy(*CELL).agg(F.max(F.col("newest_version").cast("int")).alias("_any"))
    return flagged.where("coalesce(_any, 0) = 0").select(*CELL)


def parents_not_newest(files: DataFrame, links: DataFrame) -> DataFrame:
    """Inputs of newest files that are not newest themselves."""
    ids = newest_ids(files)
    of_newest = links.join(ids.withColumnRenamed("file_id", "resulting_file"), "resulting_file", "left_semi")
    used = of_newest.select(F.col("source_file").alias("file_id")).distinct()
    return used.join(ids, "file_id", "left_anti")


def large_version_parts(files: DataFrame, limit: int = 1000) -> DataFrame:
    """The highest value of each version part and whether it has grown past the limit."""
    top = files.agg(*[F.max(f"{p}_version").alias(p) for p in ("interface", "quality", "revision")])
    return top.select(F.expr(
        "stack(3, 'interface', interface, 'quality', quality, 'revision', revision) AS (part, highest)"
    )).withColumn("too_large", F.col("highest") >= limit)


def newest_created_earlier(files: DataFrame) -> DataFrame:
    """Newest files with a file of the same product and date that was created later."""
    last = files.groupBy(*CELL).agg(F.max("file_create_date").alias("last_created")).withColumnRenamed(
        "utc_file_date", "_date").withColumnRenamed("product_id", "_product")
    same = F.col("product_id").eqNullSafe(F.col("_product")) & F.col("utc_file_date").eqNullSafe(F.col("_date"))
    return (
        newest(files).join(last, same)
        .where(F.col("file_create_date") < F.col("last_created"))
        .select("file_id", "filename", "file_create_date", "last_created")
    )


def newest_rule_differences(files: DataFrame) -> DataFrame:
    """Files that are newest by version but not by one of two older rules, and the other way round.

    The first old rule takes, per product and date, the highest
    ``1000i+100q+r``.  The second takes every file whose number equals the
    highest number of its product on *some* date, which is why it can return
    several files for a date.
    """
    number = F.col("interface_version") * 1000 + F.col("quality_version") * 100 + F.col("revision_version")
    by_version = newest_ids(files)
    by_number = newest_by_legacy_number(files).select("file_id")
    numbered = files.select("file_id", *CELL, number.alias("_number"))
    tops = numbered.groupBy(*CELL).agg(F.max("_number").alias("_number"))
    by_value = ["product_id", "_number"]
    groups = numbered.groupBy(*by_value).agg(F.count(F.lit(1)).alias("group_rows"))
    groups = groups.join(tops.select(*by_value).distinct(), by_value, "left_semi")
    by_any_date = join_to_groups(numbered, groups, by_value, "file_id").select("file_id")

    def differ(old: DataFrame, rule: str) -> list[DataFrame]:
        return [
            by_version.join(old, "file_id", "left_anti").select(
                F.lit(rule).alias("rule"), F.lit("version only").alias("side"), "file_id"),
            old.join(by_version, "file_id", "left_anti").select(
                F.lit(rule).alias("rule"), F.lit("number only").alias("side"), "file_id"),
        ]

    return _union(differ(by_number, "per date") + differ(by_any_date, "any date"))


def dangling_process_products(catalogue: Catalogue) -> DataFrame:
    """Products that a process names as input or output and that do not exist."""
    used = catalogue.productprocesslink.select(
        "process_id", F.lit("input").alias("role"), F.col("input_product_id").alias("product_id")
    ).unionByName(
        catalogue.process.where("output_product IS NOT NULL").select(
            "process_id", F.lit("output").alias("role"), F.col("output_product").alias("product_id")
        )
    )
    return used.join(catalogue.product.select("product_id"), "product_id", "left_anti").select(
        "process_id", "role", "product_id"
    )


def checksum_audit(files: DataFrame, digests: DataFrame) -> DataFrame:
    """Files whose bytes do not match (result 1) or that are not on disk (result 2).

    `files` has `full_path`; `digests` has `path` and `shasum` of what is there.
    """
    disk = digests.select(F.col("path").alias("full_path"), F.col("shasum").alias("_found"))
    result = F.when(F.col("_found").isNull(), 2).when(~F.col("_found").eqNullSafe(F.col("shasum")), 1)
    return (
        files.join(disk, "full_path", "left")
        .select("file_id", "filename", result.alias("result"))
        .where("result IS NOT NULL")
    )


def refreshed_checksums(files: DataFrame, digests: DataFrame) -> DataFrame:
    """Files with the checksum of the bytes on disk; files not on disk keep theirs."""
    disk = digests.select(F.col("path").alias("full_path"), F.col("shasum").alias("_found"))
    return (
        files.join(disk, "full_path", "left")
        .withColumn("shasum", F.coalesce("_found", "shasum"))
        .select(*files.columns)
    )


def existence_audit(files: DataFrame, listing: DataFrame, from_id: int | None = None,
                    newest_only: bool = False) -> DataFrame:
    """Files the catalogue says are on disk but whose `full_path` no listing has."""
    if newest_only:
        files = newest(files)
    if from_id is not None:
        files = files.where(F.col("file_id") >= from_id)
    seen = listing.select(F.col("path").alias("full_path"))
    return files.where("exists_on_disk").join(seen, "full_path", "left_anti").select(
        "file_id", "filename", "full_path"
    )


def corrected_existence(files: DataFrame, missing: DataFrame) -> DataFrame:
    """Files with `exists_on_disk` cleared for the ids found missing."""
    gone = missing.select("file_id", F.lit(True).alias("_gone")).distinct()
    return (
        files.join(gone, "file_id", "left")
        .withColumn("exists_on_disk", F.col("exists_on_disk") & F.col("_gone").isNull())
        .select(*files.columns)
    )


def compare_rows(left: DataFrame, right: DataFrame, key: list[str], attributes: list[str]) -> DataFrame:
    """Differences of two tables by natural key: (key, attribute, left, right).

    A key on one side only gives one row with attribute ``only left`` or
    ``only right``.  Keys and attributes compare as text, null equal to null;
    the parts of a key are compared one by one and only shown joined by bars.
    """
    parts = [f"_key{i}" for i in range(len(key))]

    def side(df: DataFrame, word: str) -> DataFrame:
        values = F.array(*[F.struct(F.lit(a).alias("attribute"), F.col(a).cast("string").alias("value"))
                           for a in attributes])
        return df.select(*[F.col(c).cast("string").alias(p) for c, p in zip(key, parts)], values.alias(word))

    same = reduce(lambda x, y: x & y, [F.col(f"a.{p}").eqNullSafe(F.col(f"b.{p}")) for p in parts])
    shown = [F.coalesce(F.when(F.col("l").isNotNull(), F.col(f"a.{p}")).otherwise(F.col(f"b.{p}")), F.lit("null")) for p in parts]
    joined = side(left, "l").alias("a").join(side(right, "r").alias("b"), same, "full_outer").select(
        F.concat_ws("|", *shown).alias("key"), "l", "r")
    pairs = F.filter(
        F.transform(F.sequence(F.lit(0), F.lit(len(attributes) - 1)), lambda i: F.struct(
            F.get("l", i)["attribute"].alias("attribute"),
            F.get("l", i)["value"].alias("left"), F.get("r", i)["value"].alias("right"))),
        lambda p: ~p["left"].eqNullSafe(p["right"]),
    )

    def one(word: str) -> Column:
        return F.array(F.struct(F.lit(word).alias("attribute"), F.lit(None).cast("string").alias("left"),
                                F.lit(None).cast("string").alias("right")))

    changes = F.when(F.col("r").isNull(), one("only left")).when(
        F.col("l").isNull(), one("only right")).otherwise(pairs)
    return joined.select("key", F.explode(changes).alias("c")).select("key", "c.attribute", "c.left", "c.right")


# Natural key of each compared table; foreign ids are compared by name, and
# text that is bound to differ (provenance, digest, creation time) is not compared.
_COMPARED = {
    "product": ["product_name"],
    "process": ["process_name"],
    "code": ["code_description", "filename", "arguments"],
    "file": ["filename"],
}
_IGNORED = {"verbose_provenance", "shasum", "file_create_date"}
_NAMES = {
    "output_product": ("product", "product_id", "product_name"),
    "product_id": ("product", "product_id", "product_name"),
    "process_id": ("process", "process_id", "process_name"),
    "instrument_id": ("instrument", "instrument_id", "instrument_name"),
}


def _by_name(catalogue: Catalogue, table: str) -> DataFrame:
    rows = getattr(catalogue, table)
    for column, (other, other_id, other_name) in _NAMES.items():
        if column in rows.columns and column != f"{table}_id" and other in catalogue:
            names = getattr(catalogue, other).select(
                F.col(other_id).alias(column), F.col(other_name).alias("_name"))
            rows = rows.join(names, column, "left").withColumn(column, F.coalesce("_name", F.lit(""))).drop("_name")
    return rows


def compare_table(left: Catalogue, right: Catalogue, table: str) -> DataFrame:
    """Differences of the product, process, code or file table of two catalogues."""
    key = _COMPARED[table]
    a, b = _by_name(left, table), _by_name(right, table)
    if table == "code":
        a, b = (c.where("active_code AND newest_version") for c in (a, b))
    skip = _IGNORED | set(key) | {f"{table}_id"}
    attributes = [c for c in a.columns if c in b.columns and c not in skip]
    return compare_rows(a, b, key, attributes).select(F.lit(table).alias("table_name"), "*")


def _named_links(catalogue: Catalogue) -> DataFrame:
    name = catalogue.file.select("file_id", "filename")
    return (
        catalogue.filefilelink
        .join(name.toDF("source_file", "parent"), "source_file")
        .join(name.toDF("resulting_file", "child"), "resulting_file")
        .select("child", "parent")
    )


def compare_lineage(left: Catalogue, right: Catalogue) -> DataFrame:
    """(child, parent, side) links by name that only one catalogue has, for files both have."""
    both = left.file.select(F.col("filename").alias("child")).join(
        right.file.select(F.col("filename").alias("child")), "child", "left_semi")
    a, b = _named_links(left), _named_links(right)
    pair = ["child", "parent"]
    only = a.join(b, pair, "left_anti").withColumn("side", F.lit("left")).unionByName(
        b.join(a, pair, "left_anti").withColumn("side", F.lit("right")))
    return only.join(both, "child", "left_semi").select("child", "parent", "side")


def compare_codes_of_files(left: Catalogue, right: Catalogue) -> DataFrame:
    """Files both catalogues have whose recorded codes differ in number or in an attribute."""
    attributes = ["code_description", "filename", "relative_path", "arguments"]

    def coded(c: Catalogue, word: str) -> DataFrame:
        code = c.code.select(F.col("code_id").alias("source_code"),
                             *[F.col(a).alias(f"_{a}") for a in attributes])
        facts = c.filecodelink.join(code, "source_code", "left").groupBy(
            F.col("resulting_file").alias("file_id")).agg(
            F.count(F.lit(1)).alias("_n"), *[F.min(f"_{a}").alias(f"_{a}") for a in attributes])
        return c.file.select("file_id", "filename").join(facts, "file_id", "left").select(
            "filename", F.coalesce("_n", F.lit(0)).alias(f"{word}_n"),
            *[F.col(f"_{a}").alias(f"{word}_{a}") for a in attributes])

    both = coded(left, "l").join(coded(right, "r"), "filename")

    def row(attribute: str, a: Column, b: Column) -> Column:
        return F.struct(F.lit(attribute).alias("attribute"), a.cast("string").alias("left"), b.cast("string").alias("right"))

    l_n, r_n = F.col("l_n"), F.col("r_n")
    same = F.array_compact(F.array(*[
        F.when(~F.col(f"l_{a}").eqNullSafe(F.col(f"r_{a}")), row(a, F.col(f"l_{a}"), F.col(f"r_{a}")))
        for a in attributes]))
    faults = F.when((l_n != r_n) | (l_n > 1), F.array(row("codes", l_n, r_n))).otherwise(same)
    return both.select("filename", F.explode(faults).alias("f")).select("filename", "f.attribute", "f.left", "f.right")
