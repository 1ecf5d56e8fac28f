"""Exact inner-product search by best-first search of a paged M-tree.

Inner products become distances by one more coordinate: a vector x gets
``sqrt(M^2 - |x|^2)`` with M the largest norm, a query gets 0.  Then
``d(q, x)^2 = |q|^2 + M^2 - 2 q.x``, so the largest products are the nearest
vectors, and the triangle inequality holds.

The tree is built from the top: each node with more members than a page takes
some of them as routing vectors and deals the members to the nearest.  Every
entry of a page keeps its distance to the page's own routing vector (the parent
distance) and, if it leads on, a covering radius.  A query that knows its
distance to the page's routing vector can rule entries out by these two numbers
alone, without computing a product.

Every query visits its nearest open nodes first, one at a time until it has
reached a page of vectors, then more a round; a round is a join of visits and
pages.  A node is dropped once its least possible distance exceeds that of the
worst result so far.  All candidates not ruled out are compared in whole
numbers, so the result is exact.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import best_of_groups, quoted, read_table, slices
from tidemark.operators.skew import join_to_groups, number_rows
from tidemark.session import durable, durable_partitioned

TOP, EVERY, SCALE = 5, 50, 256
#: Entries of a page at most, routing vectors of a node at most.
PAGE, FAN = 256, 32
#: Members of a node that one task deals out, and queries that meet a page in one task.
MEMBERS, QUERIES = 4_000, 1_000
#: By how much the nodes a query visits grow from round to round.
GROWTH = 8
NO_ID = 2**63 - 1


def _whole(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, packed, norm2): components floor(256 x) as 32-bit numbers, filled up with 0 to one length."""
    rows = vectors.select(F.coalesce(quoted(id_col).cast("long"), F.lit(NO_ID)).alias("id"), quoted(vector_col).cast("array<double>").alias("v"))
    length = rows.agg(F.max(F.size("v"))).first()[0] or 1
    length = max(1, length)

    def run(batches):
        for batch in slices(batches):
            lists = batch.column("v")
            sizes = np.diff(lists.offsets.to_numpy())
            valid = np.asarray(lists.is_valid())
            flat = lists.flatten()
            values = flat.fill_null(np.nan).to_numpy()
            sizes = np.where(valid, sizes, 0)
            row = np.repeat(np.arange(len(sizes)), sizes)
            at = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            valid[row[~np.isfinite(values)]] = False
            dense = np.zeros((len(sizes), length))
            dense[row, at] = np.where(np.isfinite(values), np.floor(SCALE * np.where(np.isfinite(values), values, 0)), 0)
            dense = dense[valid]
            if len(dense) and np.abs(dense).max() >= 2**31:
                raise ArithmeticError("a component times 256 needs more than 32 bits")
            packed = dense.astype("<i4")
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").filter(pa.array(valid)), pa.array([r.tobytes() for r in packed], pa.binary()), pa.array((dense**2).sum(axis=1))],
                names=["id", "packed", "norm2"],
            )

    return rows.mapInArrow(run, "id bigint, packed binary, norm2 double")


def matrix(column) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), "<i4").reshape(len(rows), -1).astype(np.float64)


def products(x: np.ndarray, y: np.ndarray, most: float) -> np.ndarray:
    """Exact inner products of whole vectors of squared norm up to `most`."""
    if most < 2**53:
        return x @ y.T
    return (x.astype(np.int64) @ y.astype(np.int64).T)


def _objects(rows: DataFrame, top: int, every: int) -> DataFrame:
    """Distinct vectors with their least ids, one more than a query can need, and whether a query has the vector."""
    ids = rows.groupBy("packed", "id").agg(F.first("norm2").alias("norm2"))
    asked = rows.groupBy("packed").agg(
        F.max((F.col("id") % every == 0) & (F.col("id") != NO_ID)).alias("asked"), F.first("norm2").alias("norm2")
    )
    first = ids.withColumn("place", F.row_number().over(Window.partitionBy("packed").orderBy("id"))).where(F.col("place") <= top + 1)
    least = first.groupBy("packed").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    return asked.join(least, "packed")


def _split(members: DataFrame, big: DataFrame, level: int, most: float) -> tuple[DataFrame, DataFrame]:
    """(members of the children, entries of the children) of the nodes `big` (node, group_rows)."""
    members = join_to_groups(members, big.withColumn("n", F.col("group_rows")), ["node"], "key")
    share = F.pmod("key", F.ceil(F.col("n") / MEMBERS)).cast("int")
    members = durable(members.withColumn("share", share))
    fan = F.least(F.lit(FAN), F.greatest(F.lit(2), F.ceil(2 * F.col("n") / PAGE)))
    chosen = members.withColumn(
        "number", F.row_number().over(Window.partitionBy("node").orderBy(F.xxhash64("key", F.lit(level)), "key", "packed"))
    ).where(F.col("number") <= FAN).where(F.col("number") <= fan)
    routing = durable(chosen.select(
        "node", "number", "n", F.concat("node", F.lpad(F.hex("number"), 2, "0")).alias("child"), "packed", "s", "pd"
    ))

    def deal(key, mine, routes):
        x, c = matrix(mine.column("packed")), matrix(routes.column("packed"))
        apart = 2 * (most - products(x, c, most) - np.outer(mine.column("s").to_numpy(), routes.column("s").to_numpy()))
        apart = np.maximum(apart, 0)
        # Ties are dealt evenly, else many equally far members would all follow the first.
        noise = (mine.column("key").to_numpy()[:, None] * (2 * np.arange(c.shape[0]) + 1) % 1_000_003) / 1_000_003
        nearest = (apart + 1e-6 * (1 + apart) * noise * (apart > 0.5)).argmin(axis=1)
        child = routes.column("child").take(pa.array(nearest))
        return pa.table({
            "packed": mine.column("packed"), "s": mine.column("s"), "norm2": mine.column("norm2"), "ids": mine.column("ids"),
            "asked": mine.column("asked"), "key": mine.column("key"), "node": child,
            "pd": pa.array(np.sqrt(apart[np.arange(len(x)), nearest])),
        })

    spread = routing.withColumn("share", F.explode(F.sequence(F.lit(0), F.ceil(F.col("n") / MEMBERS).cast("int") - 1)))
    dealt = durable(
        members.groupBy("node", "share").cogroup(spread.groupBy("node", "share")).applyInArrow(deal, MEMBER)
    )
    radius = dealt.groupBy("node").agg(F.max("pd").alias("radius")).withColumnRenamed("node", "child")
    entries = routing.join(radius, "child").select("node", "packed", "s", "pd", "radius", "child", F.lit(None).cast("array<bigint>").alias("ids"))
    return dealt, entries


MEMBER = "packed binary, s double, norm2 double, ids array<bigint>, asked boolean, key bigint, node string, pd double"


def _tree(objects: DataFrame, most: float) -> tuple[DataFrame, DataFrame]:
    """(entries of all pages, members with their page).  Entries of vectors have ids, those of nodes a child and a radius."""
    members = durable(objects.select(
        "packed", F.sqrt(F.greatest(F.lit(most) - F.col("norm2"), F.lit(0.0))).alias("s"), "norm2", "ids", "asked",
        F.xxhash64("packed").alias("key"), F.lit("").alias("node"), F.lit(0.0).alias("pd"),
    ))
    entries, pages, level = None, None, 0
    while True:
        sizes = durable(members.groupBy("node").agg(F.count(F.lit(1)).alias("group_rows")))
        big = sizes.where(F.col("group_rows") > PAGE)
        small = members.join(sizes.where(F.col("group_rows") <= PAGE), "node", "left_semi")
        pages = small if pages is None else pages.unionByName(small)
        if big.isEmpty():
            break
        members, more = _split(members, big, level, most)
        entries = more if entries is None else entries.unionByName(more)
        level += 1
    pages = durable(pages)
    leaves = pages.select("node", "packed", "s", "pd", F.lit(0.0).alias("radius"), F.lit(None).cast("string").alias("child"), "ids")
    return leaves if entries is None else entries.unionByName(leaves), pages


def visit(queries: pa.Table, entries: pa.Table, top: int, most: float) -> tuple[dict, dict, int]:
    """What queries find in one page: (children to go on with, results, products computed for a query and an entry).

    `queries` have number, packed, norm2, the distance to the page's routing
    vector (null at the root), ``reach`` (the distance beyond which nothing
    counts) and ``worst`` (the score of the worst result so far).
    """
    slack = 1e-6 * (1 + math.sqrt(most))
    number = queries.column("number").to_numpy()
    reach = queries.column("reach").to_numpy()[:, None] + slack
    distance = queries.column("distance").to_numpy(zero_copy_only=False).astype(np.float64)[:, None]
    radius, pd = entries.column("radius").to_numpy(), entries.column("pd").to_numpy()
    # By the stored distances alone.
    least = np.where(np.isnan(distance), 0, np.abs(distance - pd) - radius)
    open_ = least <= reach
    asked, used = open_.any(axis=1), open_.any(axis=0)
    at_q, at_e = np.flatnonzero(asked), np.flatnonzero(used)
    open_ = open_[np.ix_(at_q, at_e)]
    q = matrix(queries.column("packed").take(pa.array(at_q))) if len(at_q) else np.zeros((0, 1))
    x = matrix(entries.column("packed").take(pa.array(at_e))) if len(at_e) else np.zeros((0, q.shape[1]))
    dots = products(q, x, most) if len(at_q) and len(at_e) else np.zeros((len(at_q), len(at_e)))
    apart = np.sqrt(np.maximum(queries.column("norm2").to_numpy()[at_q][:, None] + most - 2 * dots.astype(np.float64), 0))
    is_node = np.array([c is not None for c in entries.column("child").take(pa.array(at_e)).to_pylist()], bool)
    nearest = np.maximum(apart - radius[at_e], 0)
    i, j = np.nonzero(open_ & is_node[None, :] & (nearest <= reach[at_q]))
    further = {
        "number": number[at_q][i], "child": entries.column("child").take(pa.array(at_e[j])), "distance": apart[i, j], "least": nearest[i, j],
    }
    worst = queries.column("worst").to_numpy()[at_q][:, None]
    i, j = np.nonzero(open_ & ~is_node[None, :] & (dots >= worst))
    ids = entries.column("ids").take(pa.array(at_e[j])).combine_chunks()
    sizes = np.diff(ids.offsets.to_numpy())
    i, j = np.repeat(i, sizes), np.repeat(j, sizes)
    score, who, ids = best_of_groups(dots[i, j].astype(np.int64), number[at_q][i], ids.flatten().to_numpy(), top)
    return further, {"number": who, "score": score, "id": ids}, int(open_.sum())


VISITED = "number bigint, child string, distance double, least double, score bigint, id bigint, computed bigint"


def _visits(chosen: DataFrame, pages: DataFrame, top: int, most: float) -> DataFrame:
    """All that the `chosen` (number, node, distance and the query) find, and the number of products computed."""

    def run(key, queries, entries):
        further, results, computed = visit(queries, entries, top, most)
        n, m = len(further["number"]), len(results["number"])
        null = pa.nulls
        parts = [
            [pa.array(further["number"]), further["child"], pa.array(further["distance"]), pa.array(further["least"]), null(n, pa.int64()), null(n, pa.int64()), null(n, pa.int64())],
            [pa.array(results["number"]), null(m, pa.string()), null(m, pa.float64()), null(m, pa.float64()), pa.array(results["score"]), pa.array(results["id"]), null(m, pa.int64())],
            [null(1, pa.int64()), null(1, pa.string()), null(1, pa.float64()), null(1, pa.float64()), null(1, pa.int64()), null(1, pa.int64()), pa.array([computed])],
        ]
        names = ["number", "child", "distance", "least", "score", "id", "computed"]
        return pa.concat_tables(pa.table(dict(zip(names, p))) for p in parts)

    chosen = chosen.withColumn("share", F.floor(F.col("number") / QUERIES))
    # A page goes once to every share of queries that visits it.
    wanted = chosen.select("node", F.col("share").alias("page_share")).distinct()
    read = pages.join(wanted, "node")
    return chosen.groupBy("node", "share").cogroup(read.groupBy("node", "page_share")).applyInArrow(run, VISITED)


def _searched(queries: DataFrame, pages: DataFrame, top: int, most: float, depth: int) -> tuple[DataFrame, int]:
    """((number, score, id) of the best `top` vectors of every query, products computed)."""
    spark = queries.sparkSession
    found = spark.range(0).select(F.col("id").alias("number"), F.col("id").alias("score"), "id")
    open_ = durable(queries.select("number", F.lit("").alias("node"), F.lit(None).cast("double").alias("distance"), F.lit(0.0).alias("least")))
    several, rounds, computed = 1, 0, 0
    while True:
        worst = found.groupBy("number").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("worst")).where(F.col("n") >= top)
        reach = queries.join(worst.select("number", "worst"), "number", "left").select(
            "number", "packed", "norm2", F.coalesce("worst", F.lit(-(2**62))).alias("worst"),
            F.when(F.col("worst").isNull(), F.lit(float("inf"))).otherwise(
                F.sqrt(F.greatest(F.col("norm2") + most - 2 * F.col("worst").cast("double"), F.lit(0.0)))
            ).alias("reach"),
        )
        slack = 1e-6 * (1 + math.sqrt(most))
        order = Window.partitionBy("number").orderBy("least", "node")
        left = open_.join(reach, "number").where(F.col("least") <= F.col("reach") + slack)
        left = durable(left.withColumn("place", F.row_number().over(order)))
        if left.isEmpty():
            return found, computed
        seen = durable(_visits(left.where(F.col("place") <= several).drop("place", "least"), pages, top, most))
        computed += seen.agg(F.sum("computed")).first()[0] or 0
        results = found.unionByName(seen.where("score is not null").select("number", "score", "id"))
        best = Window.partitionBy("number").orderBy(F.desc("score"), "id")
        found = durable(results.withColumn("place", F.row_number().over(best)).where(F.col("place") <= top).drop("place"))
        further = seen.where("child is not null").select("number", F.col("child").alias("node"), "distance", "least")
        open_ = durable(left.where(F.col("place") > several).select("number", "node", "distance", "least").unionByName(further))
        rounds += 1
        several = 1 if rounds <= depth else several * GROWTH


def nearest_by_product(
    vectors: DataFrame, top: int = TOP, every: int = EVERY, id_col: str = "vec_id", vector_col: str = "embedding", costs: dict | None = None
) -> DataFrame:
    """The `top` largest integer inner products of every query: query_id, rank, vec_id, score.

    Components become ``floor(256 * x)``.  Queries are the rows whose id is
    divisible by `every`; candidates are all rows with another id, ties go to
    the smaller id, a null id comes last and never asks.  Vectors that are null
    or hold null or non-finite components take no part; shorter ones count
    as filled up with 0, an empty vector as all 0.  Rows that repeat id and vector
    count once; an id with several vectors asks once with each and is no
    candidate of its own.  A component that needs more than 32 bits, or products
    of more than 62, end in an ArithmeticError.  No rows give no rows.  `costs`, if given, gets the number of products computed for
    results and routing (``computed``), and how many all pairs would take (``pairs``).
    """
    spark = vectors.sparkSession
    rows = durable(_whole(vectors, id_col, vector_col))
    most = rows.agg(F.max("norm2")).first()[0]
    if most is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    if most >= 2**62:
        raise ArithmeticError("inner products need more than 62 bits")
    objects = durable(_objects(rows, top, every))
    entries, pages = _tree(objects, most)
    pages_by_node = durable_partitioned(entries, 1, "node")
    depth = (pages.agg(F.max(F.length("node"))).first()[0] or 0) // 2
    # Queries that lie in one page get neighbouring numbers, and so visit pages together.
    queries = durable(number_rows(pages.where("asked").select("packed", "norm2", "node"), ["node", "packed"], "number").drop("node"))
    found, computed = _searched(queries, pages_by_node, top + 1, most, depth)
    if costs is not None:
        costs["computed"], costs["pairs"] = computed, queries.count() * pages.count()
    results = found.groupBy("number").agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), "id"))).alias("found"))
    results = queries.select("number", "packed").join(results, "number").drop("number")
    asking = rows.where((F.col("id") % every == 0) & (F.col("id") != NO_ID)).select("id", "packed").distinct()
    results = results.join(asking.groupBy("packed").agg(F.count(F.lit(1)).alias("group_rows")), "packed")
    each = join_to_groups(asking, results, ["packed"], "id").select(
        F.col("id").alias("query_id"), F.posexplode(F.expr("slice(filter(found, f -> f.id != id), 1, %d)" % top)).alias("at", "f")
    )
    vec_id = F.when(F.col("f.id") != NO_ID, F.col("f.id"))
    return each.select("query_id", (F.col("at") + 1).alias("rank"), vec_id.alias("vec_id"), (-F.col("f.s")).alias("score"))


def op12_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_by_product(read_table(spark, sf_dir, "embeddings"))


OP12_SQL = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM whole q JOIN whole c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
