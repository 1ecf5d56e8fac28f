import math
import random

import pytest
from pyspark.sql import functions as F

from tidemark.model import Catalogue
from tidemark.operators import lineage
from tidemark.operators.lineage import reach
from tidemark.operators.skew import join_to_groups, number_rows
from tidemark.session import durable, durable_partitioned


def test_join_to_groups_splits_hot_and_null_keys(spark):
    rows = [(i, "hot" if i % 3 else None if i % 2 else "cold") for i in range(60)]
    df = spark.createDataFrame(rows, "id bigint, k string")
    groups = df.groupBy("k").agg(F.count(F.lit(1)).alias("group_rows"), F.max("id").alias("top"))
    for hot_rows in (1, 7, 1000):
        joined = join_to_groups(df, groups, ["k"], "id", hot_rows=hot_rows)
        tops = {}
        for i, k in rows:
            tops[k] = max(tops.get(k, -1), i)
        got = {r.id: (r.k, r.top) for r in joined.collect()}
        assert joined.count() == len(rows)
        assert got == {i: (k, tops[k]) for i, k in rows}


def test_number_rows_follows_the_order(spark):
    names = [f"n{i:04d}" for i in range(500)]
    shuffled = names[:]
    random.Random(1).shuffle(shuffled)
    df = spark.createDataFrame([(n,) for n in shuffled], "name string").repartition(7)
    got = {r.name: r.pos for r in number_rows(df, ["name"], "pos", start=10).collect()}
    assert got == {n: 10 + i for i, n in enumerate(names)}


def brute_reach(seeds, edges):
    depth = {s: 0 for s in seeds}
    frontier = set(seeds)
    while frontier:
        level = max(depth[f] for f in frontier) + 1
        frontier = {b for a, b in edges if a in frontier and b not in depth}
        depth.update({f: level for f in frontier})
    return depth


def test_reach_equals_brute_force_with_hot_nodes_and_cycles(spark):
    rng = random.Random(4)
    edges = {(rng.randrange(40), rng.randrange(40)) for _ in range(70)} | {(3, n) for n in range(100, 130)}
    seeds = [3, 7]
    edge_df = spark.createDataFrame(sorted(edges), "node bigint, next bigint")
    seed_df = spark.createDataFrame([(s,) for s in seeds], "node bigint")
    for hot in (1, 5, 1000):
        got = {r.node: r.depth for r in reach(seed_df, edge_df, hot_edges=hot).collect()}
        assert got == brute_reach(seeds, edges)


def test_partitioned_edges_are_not_shuffled_again(spark):
    edge_df = spark.range(1000).select((F.col("id") % 50).alias("node"), F.col("id"), F.col("id").alias("next"))
    kept = durable_partitioned(edge_df.withColumn("_share", (F.col("id") % 3).cast("int")), 4, "node", "_share")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = durable(spark.range(20).select(F.col("id").alias("node"), F.lit(0).alias("_share"))).join(kept, ["node", "_share"])
        plan = joined._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 1


def test_reach_down_a_long_chain(spark):
    edge_df = spark.range(25).select(F.col("id").alias("node"), (F.col("id") + 1).alias("next"))
    seed = spark.createDataFrame([(0,)], "node bigint")
    got = {r.node: r.depth for r in reach(seed, edge_df).collect()}
    assert got == {i: i for i in range(26)}


def test_reach_without_seeds(spark):
    edge_df = spark.createDataFrame([(1, 2)], "node bigint, next bigint")
    assert reach(edge_df.where("false").select("node"), edge_df).count() == 0


@pytest.mark.parametrize("plain_rounds", [0, 1, 3])
def test_reach_by_shortcuts_equals_brute_force(spark, plain_rounds):
    """Chains that merge, part and close into cycles, a node that many point to, and seeds in mid-chain."""
    rng = random.Random(plain_rounds)
    edges = {(i, i + 1) for i in range(60) if i % 13}
    edges |= {(i, 70) for i in range(200, 240)} | {(70, 71), (71, 72), (72, 0), (60, 60), (300, 301), (301, 302), (302, 300)}
    edges |= {(rng.randrange(80), rng.randrange(80)) for _ in range(6)}
    seeds = [1, 17, 205, 300, 999]
    edge_df = spark.createDataFrame(sorted(edges) * 2, "node bigint, next bigint")
    seed_df = spark.createDataFrame([(s,) for s in seeds], "node bigint")
    found = reach(seed_df, edge_df, hot_edges=7, plain_rounds=plain_rounds).collect()
    assert len(found) == len({r.node for r in found})
    assert {r.node: r.depth for r in found} == brute_reach(seeds, sorted(edges))


def test_a_chain_of_ten_thousand_takes_few_rounds(spark, monkeypatch):
    rounds, levels = [], []
    nearer, doubled = lineage._nearer, lineage._doubled
    monkeypatch.setattr(lineage, "_nearer", lambda *a: rounds.append(1) or nearer(*a))
    monkeypatch.setattr(lineage, "_doubled", lambda *a: levels.append(1) or doubled(*a))
    n = 10_000
    edge_df = spark.range(n).select(F.col("id").alias("node"), (F.col("id") + 1).alias("next"))
    found = reach(spark.range(1).select(F.col("id").alias("node")), edge_df)
    assert found.where("node <> depth").count() == 0 and found.count() == n + 1
    assert len(levels) <= math.log2(n) + 1
    assert len(rounds) <= math.log2(n) + lineage.PLAIN_ROUNDS + 2


@pytest.mark.parametrize("worth", [0, 1_000])
def test_late_rounds_read_the_edges_that_are_still_open(spark, monkeypatch, worth):
    """Nodes with several ways to them, as n is made from n / 2 and n / 3; a hot node and a cycle beside them."""
    dealt, met = [], []
    deal, nearer = lineage._dealt, lineage._nearer
    monkeypatch.setattr(lineage, "WORTH", worth)
    monkeypatch.setattr(lineage, "_dealt", lambda edges, hot: dealt.append(edges.count()) or deal(edges, hot))
    monkeypatch.setattr(lineage, "_nearer", lambda found, tables: met.append(sum(t.count() for t in tables)) or nearer(found, tables))
    edges = {(n // 2, n) for n in range(1, 600)} | {(n // 3, n) for n in range(2, 600)} | {(7, n) for n in range(600, 640)}
    edges |= {(599, 700), (700, 701), (701, 599), (701, 702), (702, 703)}
    seeds = [n for n in range(1, 600) if n % 97 == 5]
    edge_df = spark.createDataFrame(sorted(edges), "node bigint, next bigint")
    seed_df = spark.createDataFrame([(s,) for s in seeds], "node bigint")
    found = reach(seed_df, edge_df, hot_edges=9, plain_rounds=2).collect()
    want = brute_reach(seeds, sorted(edges))
    assert len(found) == len(want) and {r.node: r.depth for r in found} == want
    if worth:
        assert min(dealt) < 0.6 * dealt[0]
        assert max(met[-2:]) < len(want) / 2


def test_ids_that_go_are_worked_out_once(spark):
    """`purged_rows` meets a written table of ids, whatever they were made by."""
    ids = spark.range(3).select((F.col("id") + 1).alias("file_id")).unionByName(spark.range(1).select((F.col("id") + 1).alias("file_id")))
    links = spark.createDataFrame([(1, 5), (5, 2), (6, 7), (None, 3)], "source_file bigint, resulting_file bigint")
    files = spark.createDataFrame([(i, f"f{i}") for i in range(1, 6)], "file_id bigint, filename string")
    rows = lineage.purged_rows(Catalogue(file=files, filefilelink=links), ids)
    assert sorted(r.file_id for r in rows["file"].collect()) == [1, 2, 3]
    assert sorted((r.source_file or 0, r.resulting_file) for r in rows["filefilelink"].collect()) == [(0, 3), (1, 5), (5, 2)]
    assert "Range (" not in rows["filefilelink"]._jdf.queryExecution().executedPlan().toString()


def test_nodes_already_found_are_not_shuffled(spark):
    known = durable_partitioned(spark.range(1_000).select(F.col("id").alias("node"), F.lit(0).alias("depth")), 1, "node")
    cand = spark.range(500, 1_500).select(F.col("id").alias("node")).groupBy("node").agg(F.lit(3).alias("depth"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fresh = lineage._nearer(cand, [known, known])
        plan = fresh._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("SortMergeJoin") == 2 and plan.count("Exchange hashpartitioning") == 1
    assert sorted(r.node for r in fresh.collect()) == list(range(1_000, 1_500))
