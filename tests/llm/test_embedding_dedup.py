import math

import numpy as np
import pytest

from tidemark.llm import embedding_dedup as ed

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def plain(rows, cosine):
    n = len(rows)
    parent = list(range(n))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    def usable(v, label):
        return v is not None and label is not None and any(x for x in v if x) and all(x is not None and math.isfinite(x) for x in v)

    links = [0] * n
    for i in range(n):
        for j in range(i):
            (_, v, a), (_, w, b) = rows[i], rows[j]
            if a == b and usable(v, a) and usable(w, b) and len(v) == len(w):
                x, y = np.array(v, np.float32).astype(float), np.array(w, np.float32).astype(float)
                if x @ y / math.sqrt((x @ x) * (y @ y)) >= cosine:
                    links[i] += 1
                    links[j] += 1
                    parent[root(i)] = root(j)
    out = []
    for i in range(n):
        same = [rows[j][0] for j in range(n) if root(j) == root(i) and rows[j][0] is not None]
        out.append((rows[i][0], links[i], min(same, default=None)))
    return sorted(out, key=str)


def check(spark, rows, **settings):
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA + ", node string, component string")
    found = ed.near_embeddings(df, **settings).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in found), key=str) == plain(rows, settings.get("cosine", 0.98))


def clustered(seed, clusters=14, size=9, dims=16, noise=0.05):
    rng = np.random.default_rng(seed)
    rows = []
    for c in range(clusters):
        centre = rng.standard_normal(dims)
        centre /= np.linalg.norm(centre)
        for _ in range(size):
            v = centre + noise * rng.standard_normal(dims)
            rows.append((len(rows) + 5, [float(np.float32(x)) for x in v], int(c % 3)))
    return rows


def test_as_all_pairs_with_unusable_vectors_and_ties(spark):
    rows = clustered(1)
    one = rows[0][1]
    rows += [
        (1_000, None, 1), (1_001, [], 1), (1_002, [0.0] * 16, 1), (1_003, one, None), (1_004, [None, *one[1:]], 0),
        (1_005, [float("nan"), *one[1:]], 0), (1_006, [float("inf"), *one[1:]], 0), (1_007, one[:8], 0), (1_008, one[:8], 0),
        (1_009, one, 0), (1_009, one, 0), (None, one, 0), (None, [3.0, -1.0], 5), (1_010, [1e30, 1e30], 4), (1_011, [1e-30, 1e-30], 4),
        (1_012, [-0.0, 1.0], 4), (1_013, [0.0, 2.0], 4),
    ]
    check(spark, rows)


def test_dense_groups_have_all_their_links(spark, monkeypatch):
    monkeypatch.setattr(ed, "CELL", 16)
    check(spark, clustered(2, clusters=3, size=70, noise=0.02))


def test_empty_table(spark):
    assert ed.near_embeddings(spark.createDataFrame([], SCHEMA)).collect() == []


def test_passes_grow_slowly_with_the_table():
    assert 4 <= ed.passes_for(10, 0.98) <= ed.passes_for(10**4, 0.98) <= ed.passes_for(10**9, 0.98) <= 120


@pytest.mark.parametrize("seed", [3, 4])
def test_recall_of_the_passes_alone(spark, seed):
    """Pairs at the threshold, hidden among strangers, meet in some window."""
    rng = np.random.default_rng(seed)
    rows, pairs = [], []
    for i in range(120):
        v = rng.standard_normal(32)
        v /= np.linalg.norm(v)
        side = rng.standard_normal(32)
        side -= (side @ v) * v
        side /= np.linalg.norm(side)
        w = 0.9805 * v + math.sqrt(1 - 0.9805**2) * side
        rows += [(2 * i, v.tolist(), 0), (2 * i + 1, w.tolist(), 0)]
        pairs.append((2 * i, 2 * i + 1))
    found = ed.near_embeddings(spark.createDataFrame(rows, SCHEMA.replace("float", "double"))).collect()
    joined = {r.vec_id: r.component_id for r in found}
    assert sum(joined[a] == joined[b] for a, b in pairs) / len(pairs) == 1.0


def dense(strangers, pairs, dims=64, background=0.94, together=0.985, seed=5):
    """Pairs above the threshold in one label, all others below it but close to each other."""
    rng = np.random.default_rng(seed)

    def at(centre, cosine, n):
        side = rng.standard_normal((n, dims))
        side -= (side * centre).sum(axis=1, keepdims=True) / (centre * centre).sum(axis=-1, keepdims=True) * centre
        side /= np.linalg.norm(side, axis=1, keepdims=True)
        return cosine * centre + math.sqrt(1 - cosine**2) * side

    centre = np.eye(dims)[:1]
    one = at(centre, math.sqrt(background), strangers)
    two = at(one[:pairs], together, pairs)
    return [(i, v.tolist(), 0) for i, v in enumerate([*one, *two])]


def joined_pairs(spark, rows, strangers, pairs):
    found = ed.near_embeddings(spark.createDataFrame(rows, SCHEMA.replace("float", "double"))).collect()
    joined = {r.vec_id: r.component_id for r in found}
    return sum(joined[i] == joined[strangers + i] for i in range(pairs)) / pairs


def test_all_pairs_of_a_dense_label_are_joined(spark):
    assert joined_pairs(spark, dense(6_000, 2_000), 6_000, 2_000) == 1.0


@pytest.mark.parametrize("centres", [0.94, 0.3])
def test_runs_longer_than_a_block_are_compared_whole(spark, monkeypatch, centres):
    """Labels too large for one grid: dense ones go back to it, others are dealt by their bits."""
    monkeypatch.setattr(ed, "BLOCK", 24)
    rows = dense(700, 300, background=centres)
    assert joined_pairs(spark, rows, 700, 300) == 1.0


def test_runs_in_small_blocks_as_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(ed, "BLOCK", 2)
    monkeypatch.setattr(ed, "TOGETHER", 8)
    check(spark, clustered(6, clusters=9, size=14, noise=0.04))


@pytest.mark.parametrize("window, span", [(3, 7), (8, 8), (20, 64)])
def test_windows_that_overflow_lose_no_link(spark, monkeypatch, window, span):
    """Runs longer than the window and places cut by the ends of tasks, against all pairs."""
    monkeypatch.setattr(ed, "WINDOW", window)
    monkeypatch.setattr(ed, "SPAN", span)
    monkeypatch.setattr(ed, "TOGETHER", 4)
    check(spark, clustered(7, clusters=9, size=16, noise=0.04))


def test_a_window_joins_its_neighbours(spark, monkeypatch):
    """Each vector meets exactly the next ones of the order, also across the ends of tasks."""
    monkeypatch.setattr(ed, "WINDOW", 5)
    monkeypatch.setattr(ed, "SPAN", 8)
    n = 40
    vectors = spark.createDataFrame([(bytes([i]), [1.0, i / 1e6]) for i in range(n)], "node binary, vector array<double>")
    orders = spark.createDataFrame([(bytes([i]), 0, 2, 0, 0, i) for i in range(n)], "node binary, label int, width int, pass int, run bigint, place bigint")
    found = {(r.a[0], r.b[0]) for r in ed._neighbours(orders, vectors, 0.98).collect()}
    assert all(0 < b - a <= 5 for a, b in found)
    assert {i for pair in found for i in pair} == set(range(n))
    reached = {0}
    while more := {j for pair in found if reached & set(pair) for j in pair} - reached:
        reached |= more
    assert reached == set(range(n))
