import math
import random

import numpy as np
import pytest

from tidemark.llm import vector_search as vs

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def plain(rows, top, every):
    """Every query against every row."""
    whole = {}
    length = max([len(v) for _, v in rows if v is not None], default=0)
    for i, v in rows:
        if v is not None and all(x is not None and math.isfinite(x) for x in v):
            x = [math.floor(256 * float(np.float32(c))) for c in v]
            whole[(i, tuple(x + [0] * (length - len(x))))] = True
    out = []
    for qi, q in whole:
        if qi is None or qi % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(q, c)), ci is None, ci or 0) for ci, c in whole if ci != qi)
        out += [(qi, rank, None if none else ci, -s) for rank, (s, none, ci) in enumerate(scored[:top], 1)]
    return sorted(out, key=str)


def vectors(seed, n=400, dims=6):
    """Clusters, a vector that very many rows have, norms of all sizes and odd rows."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(8, dims))
    rows = [(int(i), (centres[i % 8] * (1 + i % 3) + 0.2 * rng.normal(size=dims)).tolist()) for i in range(n)]
    rows += [(1_000 + i, rows[7][1]) for i in range(60)]
    rows += [(2_000, None), (2_010, []), (2_020, [1.0]), (2_030, [None] * dims), (2_040, [float("nan")] * dims), (2_050, [float("inf")] + [0.0] * (dims - 1))]
    rows += [(None, rows[10][1]), (10, rows[10][1]), (20, rows[3][1]), (-10, rows[5][1]), (3_000, [0.0] * dims)]
    random.Random(seed).shuffle(rows)
    return rows


def search(spark, rows, top=5, every=10, **options):
    frame = spark.createDataFrame([(i, v, 1, "x", "x") for i, v in rows], SCHEMA + ", id string, packed string")
    found = vs.nearest_by_product(frame, top, every, **options)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(map(tuple, found.collect()), key=str)


def test_as_every_query_against_every_row(spark, monkeypatch):
    monkeypatch.setattr(vs, "PAGE", 16)
    monkeypatch.setattr(vs, "FAN", 4)
    monkeypatch.setattr(vs, "MEMBERS", 50)
    monkeypatch.setattr(vs, "QUERIES", 7)
    rows, costs = vectors(1), {}
    assert search(spark, rows, costs=costs) == plain(rows, 5, 10)
    # The stored distances rule most products out.
    assert 0 < costs["computed"] < 0.7 * costs["pairs"]


def test_fewer_rows_than_asked_for(spark):
    rows = [(10, [0.5, 1.0]), (1, [0.5, -1.0]), (2, [0.25, 0.0])]
    assert search(spark, rows) == plain(rows, 5, 10)
    assert search(spark, [(10, [0.5])]) == [] and search(spark, []) == []
    assert search(spark, [(10, None), (20, [float("nan")])]) == []


def test_numbers_that_do_not_fit_are_refused(spark):
    with pytest.raises(Exception, match="32 bits"):
        search(spark, [(10, [1e12, 0.0]), (1, [1.0, 0.0])])


def test_large_products_are_exact():
    rng = np.random.default_rng(2)
    x = rng.integers(-(2**30), 2**30, (5, 3)).astype(float)
    want = [[sum(int(a) * int(b) for a, b in zip(r, s)) for s in x] for r in x]
    assert vs.products(x, x, 2.0**61).tolist() == want
