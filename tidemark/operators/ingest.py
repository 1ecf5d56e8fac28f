"""From file names to catalogue rows: classify, extract, check, number."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import as_moment, extract_day, extract_month
from tidemark.functions.templates import FIELDS, fill, literal_prefix, to_pattern
from tidemark.functions.text import any_glob, basename, keyword_map
from tidemark.functions.version import extract_version, parse_version
from tidemark.model import Catalogue
from tidemark.operators.catalogue import first_seen, full_paths
from tidemark.operators.skew import number_rows
from tidemark.session import durable


def match_patterns(names: DataFrame, column: str, patterns: DataFrame, whole: bool = True) -> DataFrame:
    """Every (row, pattern) pair where the text matches.

    `patterns` has `pattern` and `prefix`, the text each match starts with.
    The prefix is an equi key: a name is tried only against patterns whose
    whole literal start it has, and the expression is the residual
    condition.  Names repeat once per prefix length in use.  Patterns match
    from the start, with `whole` to the end.
    """
    patterns = durable(patterns)  # read twice below
    length = F.length("prefix")
    lengths = sorted(r[0] for r in patterns.select(length.alias("n")).distinct().collect())
    keyed = patterns.withColumns({
        "_length": length, "_key": F.col("prefix"),
    })
    text = F.col(column)
    spread = names.withColumn("_length", F.explode(F.array(*[F.lit(n) for n in lengths]).cast("array<int>")))
    spread = spread.withColumn("_key", F.substring(text, F.lit(1), F.col("_length")))
    expression = F.concat(F.lit("^(?:"), F.col("pattern"), F.lit(")$" if whole else ")"))
    joined = spread.join(keyed, ["_length", "_key"]).withColumn("_expression", expression)
    return joined.where(F.expr(f"`{column}` RLIKE _expression")).drop("_length", "_key", "_expression")


def inspection_rules(catalogue: Catalogue, product_trace: DataFrame) -> DataFrame:
    """One rule row per active inspector, in table order.

    The pattern comes from the product's name template.  ``k=v`` arguments
    of the inspector may set ``period=month`` (names dated by month),
    ``keyword=FIELD`` (the value of that template field becomes the process
    keyword) and ``version=x.y.z`` (for names that carry none).
    """
    rows = (
        catalogue.inspector.where("active_code AND newest_version")
        .select("inspector_id", F.col("product").alias("product_id"), keyword_map(F.col("arguments")).alias("_args"))
        .join(product_trace, "product_id")
    )
    names = {
        "INSTRUMENT": F.col("instrument_name"), "MISSION": F.col("mission_name"),
        "PRODUCT": F.col("product_name"), "SATELLITE": F.col("satellite_name"),
        "SPACECRAFT": F.col("satellite_name"),
    }
    # Named steps keep Spark from copying the long expressions into each use.
    rows = rows.withColumn("_filled", fill(F.col("format"), names))
    keyword = F.col("_args")["keyword"]
    field = F.concat(F.lit("{"), keyword, F.lit("}"))
    start = F.substring(F.col("_filled"), F.lit(1), F.position(field, F.col("_filled")) - 1)
    before = to_pattern(start)
    known = F.create_map(*[F.lit(v) for k, (_, p) in FIELDS.items() for v in (k, p)])
    return rows.select(
        "inspector_id", "product_id", F.col("level").alias("data_level"),
        to_pattern(F.col("_filled")).alias("pattern"), literal_prefix(F.col("_filled")).alias("prefix"),
        F.coalesce(F.col("_args")["period"], F.lit("day")).alias("period"),
        F.col("_args")["version"].alias("fixed_version"),
        keyword.alias("keyword"),
        F.when(keyword.isNotNull(), F.concat(F.lit("^(?:"), before, F.lit(")"))).alias("before_keyword"),
        F.when(keyword.isNotNull(), F.concat(F.lit("^("), F.try_element_at(known, keyword), F.lit(")"))).alias("keyword_pattern"),
    )


def extract_metadata(claims: DataFrame) -> DataFrame:
    """File metadata of each claimed name by the rules of its inspector.

    A name gives the date; the data span the whole day, or the whole month.
    """
    name = F.col("filename")
    by_month = F.col("period") == "month"
    day = F.when(by_month, extract_month(name)).otherwise(extract_day(name))
    last = F.when(by_month, F.last_day(day)).otherwise(day)
    version = F.coalesce(extract_version(name), parse_version(F.col("fixed_version")))
    rest = F.expr("regexp_replace(filename, before_keyword, '')")
    value = F.nullif(F.expr("regexp_extract(filename_rest, keyword_pattern, 1)"), F.lit(""))
    return (
        claims.withColumns({"utc_file_date": day, "_last": last, "_version": version, "filename_rest": rest})
        .withColumns({
            "utc_start_time": as_moment(F.col("utc_file_date")),
            "utc_stop_time": as_moment(F.col("_last"), end=True),
            "interface_version": F.col("_version")["interface"],
            "quality_version": F.col("_version")["quality"],
            "revision_version": F.col("_version")["revision"],
            "process_keywords": F.when(
                F.col("keyword").isNotNull(), F.concat(F.col("keyword"), F.lit("="), value)
            ),
        })
        .drop("_last", "_version", "filename_rest")
    )


REQUIRED = (
    "filename", "utc_file_date", "utc_start_time", "utc_stop_time", "data_level", "file_create_date",
    "exists_on_disk", "product_id", "interface_version",
)


def incomplete(required: tuple[str, ...] = REQUIRED) -> Column:
    """Which required fields of a row are empty, as text, or null when none is."""
    missing = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in required]))
    return F.when(F.size(missing) > 0, F.concat(F.lit("incomplete: "), F.array_join(missing, ",")))


def classify(
    listing: DataFrame, rules: DataFrame, inspected: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Claimed files with their metadata, and files no rule could claim with the reason.

    Rules are tried in inspector order; one that matches but leaves a
    required field empty does not claim the file.  `listing` has `filename`
    (unique), `path` and, if known, `modified` and `shasum`.  `inspected`
    are claims of user inspectors, from :func:`inspect_with`: `filename`,
    `inspector_id`, `product_id` and whatever metadata they know.  They take
    their place in inspector order and fall under the same rules.
    """
    present = listing.select(
        "filename", "path",
        (F.col("modified") if "modified" in listing.columns else F.lit(None)).cast("timestamp_ntz").alias("file_create_date"),
        (F.col("shasum") if "shasum" in listing.columns else F.lit(None)).cast("string").alias("shasum"),
        F.lit(True).alias("exists_on_disk"),
    )
    candidates = extract_metadata(match_patterns(present, "filename", rules)).withColumn("reason", incomplete())
    if inspected is not None:
        facts = [c for c in inspected.columns if c == "filename" or c not in present.columns]
        claims = present.join(inspected.select(*facts), "filename")
        for column in REQUIRED:
            if column not in claims.columns:
                claims = claims.withColumn(column, F.lit(None).cast(candidates.schema[column].dataType))
        candidates = candidates.unionByName(claims.withColumn("reason", incomplete()), allowMissingColumns=True)
    # The best candidate of each name; a complete one always goes first.
    best = first_seen(candidates, ["filename"], [F.col("reason").isNotNull(), F.col("inspector_id")])
    claimed = best.where("reason IS NULL").drop(
        "reason", "pattern", "prefix", "period", "keyword", "fixed_version", "before_keyword", "keyword_pattern")
    faults = best.where("reason IS NOT NULL").select("filename", "path", "reason")
    unmatched = present.join(best.select("filename"), "filename", "left_anti").select(
        "filename", "path", F.lit("no inspector match").alias("reason"))
    return claimed, faults.unionByName(unmatched)


def inspect_with(
    listing: DataFrame, inspect: Callable[[pd.DataFrame], pd.DataFrame], schema: str
) -> DataFrame:
    """Run a user's inspector over (path, content) batches.

    `inspect` takes and returns a pandas frame; it sees one Arrow batch at a
    time and returns a row for each file it claims.
    """
    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield inspect(frame)

    return listing.select("path", "filename", "content").mapInPandas(batches, schema)


@dataclass(frozen=True)
class Ingested:
    """What one batch adds: file rows, queue rows, moves, and what it turns away."""

    accepted: DataFrame
    queue: DataFrame
    moves: DataFrame
    quarantine: DataFrame


# The documented rule: product, date and version are unique.
UNIQUE = ("utc_file_date", "product_id", "interface_version", "quality_version", "revision_version")


@dataclass(frozen=True)
class Known:
    """What is in the catalogue already, asked of an index in place of the file table.

    `names` and `versions` split rows into those that are there and the others.
    """

    names: Callable[[DataFrame], tuple[DataFrame, DataFrame]]
    versions: Callable[[DataFrame], tuple[DataFrame, DataFrame]]
    highest: int


def accept(
    claimed: DataFrame, catalogue: Catalogue, unique: tuple[str, ...] | None = None, known: Known | None = None
) -> tuple[DataFrame, DataFrame]:
    """Split claimed files by the rule that product, date and version are unique.

    The first name of equal ones in a batch is taken.  `unique` replaces the
    columns of the rule; as in SQL a null in them never clashes.
    """
    columns = list(unique or UNIQUE)
    filled = F.lit(True)
    for c in columns:
        filled = filled & F.col(c).isNotNull()
    tested = claimed.where(filled)
    if known is not None:
        there, new = known.versions(tested)
    else:
        taken = catalogue.file.select(*columns).distinct()
        there, new = tested.join(taken, columns, "left_semi"), tested.join(taken, columns, "left_anti")
    clash = there.select("filename", "path").withColumn("reason", F.lit("version already in the catalogue"))
    firsts = first_seen(new, columns, ["filename"])
    doubles = new.select("filename", "path").join(firsts.select("filename"), "filename", "left_anti").withColumn(
        "reason", F.lit("version twice in the batch"))
    return firsts.unionByName(claimed.where(~filled)), clash.unionByName(doubles)


def ingest_batch(
    listing: DataFrame, catalogue: Catalogue, rules: DataFrame, product_trace: DataFrame, root: str,
    unique: tuple[str, ...] | None = None, inspected: DataFrame | None = None, known: Known | None = None,
) -> Ingested:
    """Take a batch of incoming files into the catalogue.

    Names already catalogued, names no rule claims and repeated versions go
    to the quarantine.  Accepted files are numbered in name order from the
    highest id on, so a rerun of the batch gives the same ids.  `inspected`
    holds the claims of user inspectors, see :func:`classify`.  With `known`
    the file table is not read; its index must be by the columns of `unique`.
    """
    listing = first_seen(listing, ["filename"], ["path"])
    if known is not None:
        there, fresh = known.names(listing)
        highest = F.lit(known.highest)
    else:
        names = catalogue.file.select("filename")
        there, fresh = listing.join(names, "filename", "left_semi"), listing.join(names, "filename", "left_anti")
        highest = catalogue.file.agg(F.coalesce(F.max("file_id"), F.lit(0))).scalar()
    old = there.select("filename", "path", F.lit("name already in the catalogue").alias("reason"))
    claimed, unclaimed = classify(fresh, rules, inspected)
    claimed = durable(claimed)
    accepted, repeated = accept(claimed, catalogue, unique, known)
    numbered = number_rows(accepted, ["filename"], "_number").withColumn(
        "file_id", (F.col("_number") + highest).cast("long")).drop("_number")
    placed = full_paths(numbered, product_trace, root)
    moves = placed.select(
        "file_id", "path", "full_path", (F.col("path") != F.col("full_path")).alias("needs_move"))
    queue = numbered.select("file_id", F.lit(None).cast("smallint").alias("version_bump"))
    quarantine = old.unionByName(unclaimed).unionByName(repeated)
    return Ingested(numbered, queue, moves, quarantine)


def not_ingested(found: DataFrame, files: DataFrame) -> DataFrame:
    """(product, path) pairs of a tree scan whose name the catalogue lacks under that product."""
    named = found.withColumn("filename", basename(F.col("relative_path")))
    return named.join(files.select("product_id", "filename"), ["product_id", "filename"], "left_anti")


def names_to_fetch(
    source: DataFrame, catalogued: DataFrame, waiting: DataFrame, failed: DataFrame | None = None,
    ignore: list[str] | None = None, like: str | None = None,
) -> DataFrame:
    """Source paths whose name is neither catalogued, waiting nor (when given) failed before.

    `ignore` globs test the whole path, `like` limits the catalogued names
    looked at.  Every frame but `source` has `filename`; `source` has `path`.
    """
    rows = source.withColumn("filename", basename(F.col("path")))
    if ignore:
        rows = rows.where(~any_glob(F.col("path"), ignore))
    known = catalogued.select("filename")
    if like is not None:
        known = known.where(F.col("filename").like(like))
    known = known.unionByName(waiting.select("filename"))
    if failed is not None:
        known = known.unionByName(failed.select("filename"))
    return rows.join(known, "filename", "left_anti")


def substitutes(
    missing_in: DataFrame, source: DataFrame, name_template: str, contains: str | None = None,
    by: tuple[str, ...] = (),
) -> DataFrame:
    """For each day the first series lacks, the highest name the second has, and its stand-in name.

    Both frames have `filename` (and the columns of `by`, within which days
    are compared); the day is the one in the name.  ``XXXX`` in the template
    stands for it.
    """
    day = extract_day(F.col("filename"))
    keys = [*by, "day"]
    have = missing_in.withColumn("day", day).where("day IS NOT NULL").select(*keys).distinct()
    offered = source.withColumn("day", day).where("day IS NOT NULL")
    lacking = offered.select(*keys).distinct().join(have, keys, "left_anti")
    if contains is not None:
        offered = offered.where(F.col("filename").contains(contains))
    best = offered.groupBy(*keys).agg(F.max("filename").alias("filename"))
    stand_in = F.replace(F.lit(name_template), F.lit("XXXX"), F.date_format("day", "yyyyMMdd"))
    return best.join(lacking, keys, "left_semi").withColumn("link_name", stand_in)
