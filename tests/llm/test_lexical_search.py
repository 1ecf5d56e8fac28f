import math
import random
import re
from collections import Counter

import pytest
from llm_helpers import documents

from tidemark.llm import lexical_search as ls


def terms(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def plain(docs, items, top=10):
    """Every item against every document, by the formula."""
    counted = [(doc_id, Counter(terms(text))) for doc_id, text in docs]
    held = [c for _, c in counted if c]
    n_docs, length = len(held), sum(sum(c.values()) for c in held)
    df = Counter(t for c in held for t in c)
    out = []
    for item_id, text in items:
        scores = []
        for doc_id, c in counted:
            n, score = sum(c.values()), 0
            for t in set(terms(text)) & set(c):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * (10**9 * c[t] // (1000 * c[t] + 8 * (10 + 90 * n * n_docs // length)))
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0))
        out += [(item_id, rank, None if none else doc_id, -s) for rank, (s, none, doc_id) in enumerate(sorted(scores)[:top], 1)]
    return sorted(out, key=str)


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)] + ["été", "naïve", "É", "日本", "a1b2"]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 5, 40, 200]))) for _ in range(60)]
    docs = list(enumerate(texts)) + [(100, texts[3]), (100, texts[3]), (None, texts[4]), (None, "W1 w2"), (101, None), (102, ""), (103, " \n--"), (104, "w1,w2;W3_w4 x\x00y")]
    docs += [(105, "w1 " * 30_000)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 12)))) for i in range(12)]
    items += [(20, None), (21, ""), (22, "unknown words only"), (23, "w1 W1 w1"), (23, "w2 é"), (None, "w5 w6 É")]
    return docs, items


def ranked(spark, docs, items, clash=True, **options):
    frame = spark.createDataFrame(items, "item_id bigint, text string")
    if clash:
        frame = frame.selectExpr("*", "'x' AS number", "'x' AS doc_id", "'x' AS score")
    found = ls.ranked_documents(documents(spark, docs, clash=clash), frame, **options)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, found.collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_as_every_item_against_every_document(spark, seed, monkeypatch):
    docs, items = corpus(seed)
    want = plain(docs, items)
    assert ranked(spark, docs, items) == want
    # Several automata, blocks of one document.
    monkeypatch.setattr(ls, "CELLS", 1)
    if seed == 2:
        assert ranked(spark, docs, items, share_bytes=60) == want


def test_ties_go_to_the_smaller_id(spark):
    docs = [(i, "same words here") for i in range(40, 10, -1)] + [(99, "other")]
    got = ranked(spark, docs, [(1, "words")], clash=False)
    assert sorted(r[2] for r in got) == list(range(11, 21)) and sorted(r[1] for r in got) == list(range(1, 11))


def test_empty_tables(spark):
    docs, items = corpus(1)
    assert ranked(spark, [], items, clash=False) == []
    assert ranked(spark, docs, [], clash=False) == []
    assert ranked(spark, [(1, None), (2, "")], items, clash=False) == []


def test_terms_are_guarded_by_separators():
    found = ls.automaton_of([b"an", b"ana", b"a"])
    counts = ls.counts_in(ls.normal("an ana,banana an-a"), found)
    assert counts == {0: 2, 1: 1, 2: 1}
