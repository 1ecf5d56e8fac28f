import random

import numpy as np
import pandas as pd
from llm_helpers import documents, near_components

from tidemark.llm import minhash
from tidemark.llm.components import connected_components


def corpus(seed, n=60):
    """Families of near copies with a few changed words, chains of them, exact copies and strangers."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for family in range(n // 6):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 12, 60, 120]))]
        for _ in range(6):
            rows.append((rng.randrange(10_000), " ".join(base)))
            for _ in range(rng.randrange(3)):
                base = list(base)
                base[rng.randrange(len(base))] = rng.choice(vocabulary)
    rng.shuffle(rows)
    return rows


EDGES = [
    (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "Two words"), (8, "two words"), (9, "two\x0bwords"),
    (None, "two words"), (10, "été à"), (11, "ÉTÉ à"), (12, "same row twice here"), (12, "same row twice here"),
    (20, "long " * 30_000), (21, "Long " * 30_000), (None, "without any id"), (None, "Without any id"),
]


def check(spark, rows, width, percent):
    found = minhash.near_duplicates(documents(spark, rows, clash=True), width, percent).collect()
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found), key=str)
    assert got == sorted(near_components(rows, width, percent), key=str)
    for r in found:
        assert r.component_id is None or r.kept == (r.doc_id == r.component_id)


def test_as_all_pairs(spark):
    check(spark, corpus(1) + EDGES, 3, 85)


def test_as_all_pairs_with_the_defaults(spark):
    check(spark, corpus(2), 5, 80)


def test_empty_table(spark):
    assert minhash.near_duplicates(documents(spark, [])).collect() == []


def test_one_row_of_each_component_stays_whole(spark):
    docs = documents(spark, EDGES, clash=True)
    kept = minhash.drop_near_duplicates(docs, 3, 85)
    assert kept.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    without_words = [(1, None), (2, ""), (3, " \t\n")]
    assert [g for g in got if g[0] in (1, 2, 3)] == without_words
    assert [g[0] for g in got if g[0] is not None] == sorted([1, 2, 3, 4, 6, 7, 10, 11, 12, 20], key=str)
    assert len([g for g in got if g[0] is None]) == 1


def test_sketches_agree_as_the_sets_do():
    rng = np.random.default_rng(5)
    for n in (1, 3, 40, 300, 3_000):
        for similarity in (0.5, 0.85):
            agree = []
            for _ in range(20):
                items = rng.integers(0, 2**63, 2 * n + 2, dtype=np.int64).astype(np.uint64)
                common = round(similarity * 2 * n / (1 + similarity))
                a, b = np.unique(items[:n]), np.unique(items[n - common:2 * n - common])
                exact = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
                agree.append((minhash.sketch(a) == minhash.sketch(b)).mean() - exact)
            assert abs(np.mean(agree)) < 0.06
            assert np.abs(agree).max() < 0.3


def test_every_coordinate_fills_and_depends_on_the_set_only():
    items = np.array([7, 9, 11], np.uint64)
    full = minhash.sketch(items)
    assert (full != np.iinfo(np.uint64).max).all()
    assert (full == minhash.sketch(items[::-1])).all()
    assert len(np.unique(minhash.bands_of(full))) == minhash.BANDS


def test_members_that_the_leader_does_not_join_are_still_compared(spark, monkeypatch):
    texts = {b"a" * 16: "p q r s t u v w x y", b"b" * 16: "k l m n o a b c d e", b"c" * 16: "k l m n o a b c d e f"}
    hashes = minhash.WordHashes()
    rows, full = [], []
    for node, text in texts.items():
        items = minhash.shingles(text, 1, hashes)
        rows.append((node, len(items), minhash.marks_of(minhash.sketch(items))))
        full.append((node, items.astype("<u8").tobytes()))
    sets = spark.createDataFrame(full, "node binary, items binary")
    nodes = spark.createDataFrame(rows, "node binary, n bigint, marks binary")
    members = spark.createDataFrame([(1, n, b"a" * 16) for n in texts], "band bigint, node binary, leader binary")
    none = connected_components(spark.createDataFrame([], "a binary, b binary"))
    for cell in (1, 2_000):
        monkeypatch.setattr(minhash, "CELL", cell)
        got = minhash._rest_of_buckets(members, none, nodes, sets, 80).collect()
        assert {tuple(sorted((bytes(r.a), bytes(r.b)))) for r in got} == {(b"b" * 16, b"c" * 16)}


def test_components_of_chains_stars_loops_and_nulls(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(7, 7), (200, 201), (201, 200), (None, 5), (6, None)]
    random.Random(1).shuffle(edges)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a int, b int")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 130)}, 200: 200, 201: 200}


def test_a_family_of_edited_copies_leaves_a_cell_with_joining_links_only():
    rng = random.Random(9)
    base = [f"w{rng.randrange(4_000)}" for _ in range(260)]
    words = minhash.WordHashes()
    rows, texts = [], []
    for number in range(300):
        copy = list(base)
        for _ in range(5):
            copy[rng.randrange(len(copy))] = f"x{rng.randrange(10**6)}"
        items = minhash.shingles(" ".join(copy), 3, words)
        texts.append((number, " ".join(copy)))
        rows.append((number.to_bytes(16, "big"), minhash.marks_of(minhash.sketch(items)), items.astype("<u8").tobytes()))
    cell = pd.DataFrame(
        [(node, node, marks, items, asks) for asks in (True, False) for node, marks, items in rows],
        columns=["node", "component", "marks", "items", "asks"],
    )
    links = minhash.joining_links(cell, 85)
    assert len(links) <= len(rows) - 1
    parent = list(range(300))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        parent[max(root(int.from_bytes(a, "big")), root(int.from_bytes(b, "big")))] = min(root(int.from_bytes(a, "big")), root(int.from_bytes(b, "big")))
    assert [root(i) for i in range(300)] == [c for _, _, c in near_components(texts, 3, 85)]
