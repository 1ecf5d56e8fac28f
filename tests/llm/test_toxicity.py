import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_helpers import documents

from tidemark.llm import toxicity as tx


def plain_segments(scores):
    """A segment is maximal if its score is higher than that of any of its parts, and no longer one is so too."""
    n = len(scores)
    sums = np.r_[0, np.cumsum(scores)]

    def proper(a, b):  # every beginning and every end of it is positive
        return sums[b] > sums[a] and all(sums[a] < sums[i] for i in range(a + 1, b + 1)) and all(sums[i] < sums[b] for i in range(a, b))

    found = [(a, b) for a in range(n) for b in range(a + 1, n + 1) if proper(a, b)]
    return sorted((a, b) for a, b in found if not any((c, d) != (a, b) and c <= a and b <= d for c, d in found))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(-5, 5), max_size=14))
def test_segments_as_by_definition(scores):
    values = np.array(scores, float)
    got = tx.segments(values)
    assert [(a, b) for a, b, _ in got] == plain_segments(values)
    assert all(abs(values[a:b].sum() - s) < 1e-9 for a, b, s in got)


def table(spark, name):
    return spark.read.parquet(f"/root/testdata/sf0.1/{name}.parquet")


def test_held_out_accuracy_and_passages(spark):
    docs, labels = table(spark, "documents"), table(spark, "labels")
    model = tx.fit(docs, labels)
    rows = tx.score_documents(docs, model).join(labels, "doc_id").join(docs.select("doc_id", "text"), "doc_id").collect()
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    order = np.argsort(np.argsort([r.score for r in held])) + 1
    toxic = np.array([r.toxic for r in held])
    auc = (order[toxic == 1].sum() - toxic.sum() * (toxic.sum() + 1) / 2) / (toxic.sum() * (len(toxic) - toxic.sum()))
    assert auc > 0.95
    assert np.mean([r.predicted for r in held if r.toxic]) > 0.9
    assert np.mean([r.predicted for r in held if not r.toxic]) < 0.03
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    for r in rows:
        for p, q in zip(r.passages, r.passages[1:]):
            assert p.start < p.end <= q.start
        assert all(0 <= p.start < p.end <= len(r.text) and p.evidence > 0 for p in r.passages)
    words = [r.text[p.start:p.end].lower() for r in rows if r.toxic for p in r.passages]
    assert any("idiot" in w for w in words)
    check_edges(spark, model)


def check_edges(spark, model):
    rows = [(1, None), (2, ""), (3, "!!"), (4, "you stupid idiot, pathetic worthless scum"), (4, "you stupid idiot, pathetic worthless scum"),
            (None, "the and of"), (5, "the and of " * 20_000), (6, "İstanbul ß"), (7, "x" * 100_000)]
    docs = documents(spark, rows, clash=True)
    got = tx.score_documents(docs, model).collect()
    scores = {}
    for r in got:
        scores.setdefault(r.doc_id, []).append(r.score)
    assert len(got) == len(rows) and scores[4][0] == scores[4][1] > 0.9
    assert scores[1] == scores[2] == scores[3] and scores[1][0] < 0.1 and scores[5][0] < 0.3
    kept = tx.drop_toxic(docs, model)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted((r for r in rows if r[0] != 4), key=str)
    assert tx.score_documents(documents(spark, []), model).collect() == []


def test_tables_without_one_of_the_classes(spark):
    docs = documents(spark, [(i, f"word{i} other") for i in range(20)])
    for labels in ([], [(i, 1, 0) for i in range(20)], [(i, 1, 1) for i in range(20)], [(None, None, None), (1, 1, None)]):
        model = tx.fit(docs, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))
        got = [r.score for r in tx.score_documents(docs, model).collect()]
        assert len(got) == 20 and len(set(got)) == 1 and 0 <= got[0] <= 1


def test_held_out_labels_are_not_learned(spark):
    held = [i for i in range(200) if zlib.crc32(str(i).encode()) % 4 == 2]
    docs = documents(spark, [(i, "poison word" if i in held else "clean word" if i % 2 else "dirty word") for i in range(200)])
    labels = spark.createDataFrame([(i, 1, 1 if i in held else 1 - i % 2) for i in range(200)], "doc_id bigint, quality int, toxic int")
    model = tx.fit(docs, labels)
    assert model.words["poison"] == model.words["unseen"] < model.words["dirty"]


def test_conflicting_labels_count_as_toxic_and_training_is_bounded(spark):
    docs = documents(spark, [(i, "some words") for i in range(400)])
    labels = spark.createDataFrame([(i, 1, x) for i in range(400) for x in (0, 1)], "doc_id bigint, quality int, toxic int")
    rows = tx._training(docs, labels, "doc_id", "text", 50).collect()
    assert {r.toxic for r in rows} == {1} and 20 < len(rows) < 90


def test_calibration_sums_all_segments(spark):
    """As the score does, also of texts with more than fifty."""
    rows = [(i, ("poison " * 6 + "plain " * 30) * (55 + i % 30) if i % 2 else "plain word other " * 300) for i in range(80)]
    labels = spark.createDataFrame([(i, 1, i % 2) for i, _ in rows], "doc_id bigint, quality int, toxic int")
    model = tx.fit(documents(spark, rows), labels)
    fold = [(i, text) for i, text in rows if zlib.crc32(str(i).encode()) % 4 == 3]
    found = [tx.significant(tx.scores_of(text, model), model) for _, text in fold]
    assert max(map(len, found)) > 50
    want = tx._logistic(np.log1p([sum(f[2] for f in one) for one in found]), np.array([float(i % 2) for i, _ in fold]))
    assert np.allclose((model.slope, model.offset), want)


def test_very_long_words_count(spark):
    """By the letters that are kept, and by their shorter beginnings."""
    training = spark.createDataFrame([("x" * 70 + "a " + "x" * 90 + " short", 1), ("short", 0)], "text string, toxic int")
    counts = {r.word: (r.toxic, r.other) for r in tx._word_counts(training).collect()}
    assert counts == {"x" * 64 + "*": (2, 0), "short": (1, 1)}
    assert tx.features_of("x" * 70) == ["x" * 64 + "*", "xxxxxxx*", "xxxxx*", "xxx*"] and tx.features_of("x" * 64)[0] == "x" * 64
