"""Mixing sources to target weights by pivotal dependent rounding.

Every document is wanted a fractional number of times.  Two documents of a
source transfer words to each other, in a random direction whose odds keep
each expectation, until one of the two fractions is 0 or 1; the other goes on
to meet the next.  So a source's words stay constant but for one last
fraction.  The pairing is a reduction tree: leaves of bounded size reduce to
one residual each, residuals meet in the next level.  DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, quoted, read_table, whole_rows
from tidemark.session import durable

#: Units that meet in one task of the tree.
FAN_IN = 64


def size_of(text: Column) -> Column:
    """Number of words; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets_of(sources: DataFrame, weights: list[float], share: float, most: float) -> DataFrame:
    """Adds ``target`` to (source, source_size): water filling under `most` times the source's size.

    Sources in code point order, null last, take the `weights` in turn.  With
    sources sorted by limit per weight, those before the first one that its
    plain share does not fill are at their limit and the rest share by weight
    what is left: the result of resharing the excess until none is above.
    The window runs over one row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_limit = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    everything = Window.partitionBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    turn = (F.row_number().over(by_name) - 1) % len(weights) + 1
    weighed = sources.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn)).withColumn(
        "cap", F.col("source_size") * F.lit(float(most))
    ).withColumn("ratio", F.col("cap") / F.col("weight"))
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("source_size").over(everything) * F.lit(float(share))
    left = total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    rest = F.sum("weight").over(by_limit.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    levels = weighed.withColumn("place", F.row_number().over(by_limit)).withColumn("level", left / rest)
    first = F.min(F.when(F.col("level") <= F.col("ratio"), F.col("place"))).over(everything)
    levels = levels.withColumn("first", first)
    level = F.max(F.when(F.col("place") == F.col("first"), F.col("level"))).over(everything)
    return levels.select(
        "source", "source_size",
        F.when(F.col("place") < F.coalesce("first", F.lit(1 << 30)), F.col("cap"))
        .otherwise(F.least(level * F.col("weight"), F.col("cap"))).alias("target"),
    )


def _uniform(seed: int, *keys: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *keys), 11) / F.lit(float(1 << 53))


def _meet(seed: int):
    """Fold one unit into (cur, done): cur and x transfer words until one of them is decided."""

    def item(unit: Column, p: Column) -> Column:
        return F.struct(unit["h"].alias("h"), unit["key"].alias("key"), unit["w"].alias("w"), p.alias("p"))

    def decided(unit: Column, up: Column) -> Column:
        return F.struct(unit["key"].alias("key"), up.cast("int").alias("up"))

    def fold(acc: Column, x: Column) -> Column:
        i = acc["cur"]
        i_gives, j_takes = i["p"] * i["w"], (1 - x["p"]) * x["w"]
        i_takes, j_gives = (1 - i["p"]) * i["w"], x["p"] * x["w"]
        forth, back = F.least(i_gives, j_takes), F.least(i_takes, j_gives)
        moves_forth = _uniform(seed, i["h"], x["h"]) * (forth + back) < back
        one, zero = F.lit(1), F.lit(0)
        cur = (
            F.when(moves_forth & (i_gives <= j_takes), item(x, x["p"] + forth / x["w"]))
            .when(moves_forth, item(i, i["p"] - forth / i["w"]))
            .when(i_takes <= j_gives, item(x, x["p"] - back / x["w"]))
            .otherwise(item(i, i["p"] + back / i["w"]))
        )
        done = (
            F.when(moves_forth & (i_gives <= j_takes), decided(i, zero))
            .when(moves_forth, decided(x, one))
            .when(i_takes <= j_gives, decided(i, one))
            .otherwise(decided(x, zero))
        )
        return F.when(i.isNull(), F.struct(item(x, x["p"]).alias("cur"), acc["done"].alias("done"))).otherwise(
            F.struct(cur.alias("cur"), F.concat(acc["done"], F.array(done)).alias("done"))
        )

    return fold


def pivotal(units: DataFrame, seed: int) -> DataFrame:
    """Round the fractions `p` of `units` to 0 or 1: (source, key, up).

    `units` has source, key (struct), w > 0 and 0 < p < 1.  Within a source
    the sum of p * w changes by the last residual only, and the expectation of
    `up` is p.  All draws are hashes of seed and keys, so reruns agree.
    """
    counts = units.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    leaves = durable(counts.select("source", F.ceil(F.col("n") / FAN_IN).cast("long").alias("leaves")))
    most = leaves.agg(F.max("leaves")).first()[0] or 0
    level = durable(
        units.alias("u").join(leaves.alias("l"), F.col("u.source").eqNullSafe(F.col("l.source")))
        .select("u.source", "key", "w", "p", "leaves", F.xxhash64(F.lit(seed), "key").alias("h"))
        .withColumn("leaf", F.pmod(F.xxhash64(F.lit(seed + 1), "key"), F.col("leaves")))
    )
    kind = level.select(F.struct("h", "key", "w", "p").alias("x")).schema["x"].dataType.simpleString()
    key = level.schema["key"].dataType.simpleString()
    start = F.struct(F.lit(None).cast(kind).alias("cur"), F.array().cast(f"array<struct<key:{key},up:int>>").alias("done"))
    outcomes = []
    while most:
        folded = durable(
            level.groupBy("source", "leaf", "leaves")
            .agg(F.array_sort(F.collect_list(F.struct("h", "key", "w", "p"))).alias("items"))
            .select("source", "leaf", "leaves", F.aggregate("items", start, _meet(seed)).alias("r"))
            .select("source", "leaf", "leaves", "r.cur", "r.done")
        )
        outcomes.append(folded.select("source", F.explode("done").alias("d")).select("source", "d.key", "d.up"))
        last = folded.where(F.col("leaves") == 1)
        outcomes.append(last.select(
            "source", "cur.key", (_uniform(seed + 2, F.col("cur.h")) < F.col("cur.p")).cast("int").alias("up")
        ))
        level = folded.where(F.col("leaves") > 1).select(
            "source", "cur.key", "cur.w", "cur.p", F.ceil(F.col("leaves") / FAN_IN).cast("long").alias("leaves"),
            "cur.h", F.floor(F.col("leaf") / FAN_IN).cast("long").alias("leaf"),
        )
        most = 0 if most == 1 else -(-most // FAN_IN)
    if not outcomes:
        return units.select("source", "key", F.lit(0).alias("up"))
    out = outcomes[0]
    for more in outcomes[1:]:
        out = out.union(more)
    return out


def mix(
    docs: DataFrame, weights: tuple = (3, 1, 2), share: float = 1.5, most: float = 2.0, seed: int = 7,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """How often the mix takes each document.

    Returns one row per unit: ``source``, ``doc_id``, ``size``, ``n_rows``,
    ``copies`` (of each of these rows), ``source_size``, ``target``.  Rows
    that repeat source, id and size are one unit and get the same number of
    copies; null ids count as one id, null sources as one source, the last.  A
    text without words has size 0, takes no part in the rounding and is taken
    as often as its source's plain ratio rounds down to; in a source without
    any words that is 0.  Every other unit is taken floor or ceiling of target /
    source_size times, never more than `most` rounded up.  No rows give no rows.
    """
    sized = docs.select(
        quoted(source_col).cast("string").alias("source"), quoted(id_col).cast("long").alias("doc_id"),
        size_of(quoted(text_col).cast("string")).alias("size"),
    )
    units = durable(sized.groupBy("source", "doc_id", "size").agg(F.count(F.lit(1)).alias("n_rows")))
    totals = units.groupBy("source").agg(F.sum(F.col("size") * F.col("n_rows")).alias("source_size"))
    targets = durable(targets_of(totals, list(weights), share, most))
    ratio = F.coalesce(F.try_divide(F.col("target"), F.col("source_size")), F.lit(0.0))
    wanted = (
        units.alias("u").join(targets.alias("t"), F.col("u.source").eqNullSafe(F.col("t.source")))
        .select("u.*", "source_size", "target", F.floor(ratio).cast("int").alias("base"), (ratio - F.floor(ratio)).alias("p"))
    )
    wanted = durable(wanted)
    key = F.struct("doc_id", "size", "n_rows")
    open_ = (F.col("size") > 0) & (F.col("p") > 0)
    fractions = wanted.where(open_).select("source", key.alias("key"), (F.col("size") * F.col("n_rows")).cast("double").alias("w"), "p")
    rounded = pivotal(fractions, seed)
    same = F.col("w.source").eqNullSafe(F.col("r.source")) & key_equal("w", "r")
    columns = ["source", "doc_id", "size", "n_rows", "copies", "source_size", "target"]
    drawn = (
        wanted.where(open_).alias("w").join(rounded.alias("r"), same)
        .select("w.*", (F.col("base") + F.col("up")).alias("copies")).select(*columns)
    )
    return drawn.unionByName(wanted.where(~open_).withColumn("copies", F.col("base")).select(*columns))


def key_equal(left: str, right: str) -> Column:
    return F.col(f"{left}.doc_id").eqNullSafe(F.col(f"{right}.key.doc_id")) & (F.col(f"{left}.size") == F.col(f"{right}.key.size"))


def mixed_rows(docs: DataFrame, **settings) -> DataFrame:
    """The mix itself: rows of `docs` with all their columns, each as often as `mix` says."""
    decided = durable(mix(docs, **settings).select("source", "doc_id", "size", "copies").where("copies > 0"))
    rows = whole_rows(
        docs, _source=quoted("source").cast("string"), _id=quoted("doc_id").cast("long"),
        _size=size_of(quoted("text").cast("string")),
    )
    same = (
        F.col("d._source").eqNullSafe(F.col("m.source")) & F.col("d._id").eqNullSafe(F.col("m.doc_id"))
        & (F.col("d._size") == F.col("m.size"))
    )
    joined = rows.alias("d").join(decided.alias("m"), same)
    return joined.select("_row", F.explode(F.sequence(F.lit(1), "copies"))).select("_row.*")


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = mix(read_table(spark, sf_dir, "documents"))
    rows = units.select("*", F.explode(F.sequence(F.lit(1), F.col("n_rows").cast("int"))).alias("_nth"))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")
