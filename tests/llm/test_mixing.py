import random
from collections import defaultdict

from llm_helpers import documents, words

from tidemark.llm import mixing


def water(sizes, weights, share, most):
    """Targets by resharing the excess until none is above its limit."""
    total, targets, open_ = share * sum(sizes.values()), {}, dict(sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    while open_:
        left = total - sum(targets.values())
        level = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        full = [s for s in open_ if level[s] > most * sizes[s]]
        if not full:
            targets.update(level)
            break
        for s in full:
            targets[s] = most * sizes[s]
            del open_[s]
    return targets


def rows_of(seed, n=600):
    random.seed(seed)
    sources = ["hot"] * 8 + ["b", "c", "Ä", "a", None]
    return [(i, " ".join("w" * random.randint(1, 5) for _ in range(random.randint(0, 30))), random.choice(sources)) for i in range(n)]


def test_targets_copies_and_reruns(spark):
    rows = rows_of(1)
    docs = documents(spark, rows, clash=True)
    got = mixing.mix(docs).collect()
    sizes, texts = defaultdict(int), {}
    for i, text, source in rows:
        sizes[source] += len(words(text))
        texts[i] = len(words(text))
    targets = water(sizes, (3, 1, 2), 1.5, 2.0)
    taken = defaultdict(int)
    for r in got:
        ratio = targets[r.source] / sizes[r.source]
        assert r.size == texts[r.doc_id] and r.source_size == sizes[r.source] and abs(r.target - targets[r.source]) < 1e-6
        assert int(ratio + 1e-9) <= r.copies <= -int(-ratio - 1e-9 // 1) + 1 and r.copies <= 2
        taken[r.source] += r.size * r.copies
    assert len(got) == len(rows)
    for source, target in targets.items():
        assert abs(taken[source] - target) <= 30  # one last document
    again = {(r.doc_id, r.copies) for r in mixing.mix(docs.repartition(7)).collect()}
    assert again == {(r.doc_id, r.copies) for r in got}


def test_draws_are_fair(spark):
    docs = documents(spark, [(i, "w " * (1 + i % 7), "ab"[i % 2]) for i in range(60)])
    total = defaultdict(int)
    runs = 12
    for seed in range(runs):
        for r in mixing.mix(docs, weights=(1, 1.4), share=0.5, seed=seed).collect():
            total[r.source, r.doc_id] += r.copies
    by_source = {s: sum(n for (x, _), n in total.items() if x == s) / runs / 30 for s in "ab"}
    sizes = {"a": sum(1 + i % 7 for i in range(0, 60, 2)), "b": sum(1 + i % 7 for i in range(1, 60, 2))}
    want = water(sizes, (1, 1.4), 0.5, 2.0)
    for s in "ab":
        assert abs(by_source[s] - want[s] / sizes[s]) < 0.12
    assert 0 < min(total.values()) + 1 and max(total.values()) <= runs


def test_edges(spark):
    assert mixing.mix(documents(spark, [])).collect() == []
    rows = [(1, None, "a"), (2, "", "a"), (3, " \t", None)]
    assert {(r.doc_id, r.size, r.copies, r.target) for r in mixing.mix(documents(spark, rows)).collect()} == {(1, 0, 0, 0.0), (2, 0, 0, 0.0), (3, 0, 0, 0.0)}
    # Rows that repeat are one unit; null ids count as one id; a very long text meets short ones.
    rows = [(1, "x y", "a"), (1, "x y", "a"), (None, "z", "a"), (None, "z", "a"), (5, "w " * 50_000, "a"), (6, "q r s", "b")]
    got = {(r.doc_id, r.size): (r.n_rows, r.copies) for r in mixing.mix(documents(spark, rows)).collect()}
    assert got.keys() == {(1, 2), (None, 1), (5, 50_000), (6, 3)}
    assert got[1, 2][0] == 2 and got[None, 1][0] == 2


def test_the_mix_repeats_whole_rows(spark):
    rows = rows_of(2, 80)
    docs = documents(spark, rows, clash=True)
    copies = {(r.doc_id, r.source): r.copies for r in mixing.mix(docs).collect()}
    out = mixing.mixed_rows(docs)
    assert out.columns == docs.columns
    seen = defaultdict(int)
    for r in out.collect():
        seen[r.doc_id, r.source] += 1
        assert r.text == rows[r.doc_id][1]
    assert dict(seen) == {k: n for k, n in copies.items() if n}


def test_no_python_in_the_plan(spark):
    plan = mixing.mix(documents(spark, rows_of(3, 50)))._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Arrow", "Pandas"))
