import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_helpers import documents
from tokenizers import Tokenizer

from tidemark.llm import token_counts as tc

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
PRE = tc.PreTokens(PATH)
CACHES = {m: tc.Lengths(PRE, {}, m) for m in (False, True)}


def count(text):
    return sum(sum(CACHES[m][p] for p in pieces) for m, pieces in PRE.parts(text))


def want(text):
    return len(LIBRARY.encode(text or "", add_special_tokens=False).ids)


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=60))
def test_any_text_as_the_library(text):
    if "<|" not in text:
        assert count(text) == want(text)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.characters(max_codepoint=0x24F), max_size=80))
def test_latin_text_as_the_library(text):
    assert count(text) == want(text)


def test_documents(spark):
    rows = [(1, "Hello World's 2024"), (1, "Hello World's 2024"), (None, "İstanbul ΣΑΣ 中文"), (2, None), (3, ""),
            (4, "a <|endoftext|> b <|startoftext|>"), (5, "word " * 3_000), (6, "x" * 100_000), (7, "é \x1c \x85 z")]
    got = tc.count_tokens(documents(spark, rows, clash=True), PATH).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in got), key=str) == sorted(
        ((i, len((t or "").encode()), want(t), want(t) > 2048) for i, t in rows), key=str
    )
    assert tc.count_tokens(documents(spark, []), PATH).collect() == []


def test_the_table_holds_the_most_frequent_pre_tokens(spark, monkeypatch):
    rows = [(i, "often often rare%d" % i) for i in range(50)]
    table = tc.frequent_lengths(documents(spark, rows), PATH)
    assert table["often"] == want("often") and table["rare"] == want("rare")


def test_a_full_summary_keeps_what_is_frequent(monkeypatch):
    monkeypatch.setattr(tc, "SUMMARY", 100)
    summary = tc.Summary()
    for i in range(2_000):
        summary.add(["often", f"once{i}", f"also{i}"])
    assert len(summary) <= 103 and summary["often"] == 2_000
