"""Connected components of links, as joins over tables of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.skew import join_to_groups
from tidemark.session import durable


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def _to_least(pairs: DataFrame) -> DataFrame:
    """`pairs` (u, v) with the least v of each u as ``m``; a hot u is split over tasks."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("group_rows"))
    return join_to_groups(pairs, least, ["u"], "v")


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of `edges` (a, b); the component is its least node.

    Nodes are of any ordered type.  Loops and repeated edges do no harm, edges
    with a null end are ignored, no edges give no rows.  Each round links all
    larger neighbours of a node to the least one, then all smaller ones; it
    keeps at most as many edges as there were and needs some log^2 of the
    longest path rounds.  Every round is a written table.
    """
    now = durable(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("u") != F.col("v"))).distinct()
    )
    mark = _mark(now)
    while mark[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (
            _to_least(both).where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()
        )
        large = durable(large)
        small = _to_least(large).select(
            F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")
        )
        heads = large.groupBy("u").agg(F.min("v").alias("v"))
        now = durable(small.unionByName(heads).distinct())
        before, mark = mark, _mark(now)
        if mark == before:
            break
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
