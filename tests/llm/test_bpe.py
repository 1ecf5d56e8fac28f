import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_helpers import documents

from tidemark.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
RANKS = bpe.load_ranks(PATH)
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
ENCODER = bpe.Encoder(PATH, public_tokenizers.PATTERN)


def ids(text, encoder=ENCODER):
    return np.frombuffer(encoder.encode(text), "<u4").tolist()


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80))
def test_any_text_as_the_library(text):
    assert ids(text) == LIBRARY.encode_ordinary(text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="aeioutnrsThéü ", max_size=200))
def test_many_merges_as_the_library(text):
    assert ids(text) == LIBRARY.encode_ordinary(text)


def test_long_pieces_small_tables_and_special_strings():
    random.seed(3)
    small = bpe.Encoder(PATH, public_tokenizers.PATTERN)
    small.pieces.transducer.max_states = 50
    for text in ("a" * 30_000, "ab" * 9_000, " " * 5_000 + "x", "".join(random.choice("aeioustn") for _ in range(20_000)),
                 "<|endoftext|> a <|startoftext|>", "\x1c\x1d \x85 a　b\n\n\t c", "it's we'll I'D"):
        want = LIBRARY.encode_ordinary(text)
        assert ids(text) == want
        assert ids(text, small) == want


def test_long_texts_go_in_portions(monkeypatch):
    text = "Some words, and 123 numbers é.\n" * 500
    want = ids(text)
    monkeypatch.setattr(bpe, "PIECES", 7)
    assert ids(text) == want == LIBRARY.encode_ordinary(text)


@settings(max_examples=300, deadline=None)
@given(st.binary(max_size=60), st.lists(st.integers(0, 60), max_size=8))
def test_streamed_decoding_does_not_depend_on_the_portions(data, cuts):
    cuts = sorted({0, len(data), *(c for c in cuts if c < len(data))})
    stream = bpe.Utf8Stream()
    parts = [stream.feed(data[a:b]) for a, b in zip(cuts, cuts[1:])]
    assert "".join([*parts, stream.finish()]) == data.decode("utf-8", "replace")


def test_documents_round_trip(spark):
    rows = [(1, "Hello world"), (1, "Hello world"), (None, "é" * 10), (2, None), (3, ""), (4, "long wörds " * 60_000)]
    docs = documents(spark, rows, clash=True)
    decoded = bpe.decode_documents(bpe.encode_documents(docs, PATH, public_tokenizers.PATTERN), PATH)
    got = sorted(((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.digests(decoded).collect()), key=str)
    want = []
    for i, t in rows:
        known = LIBRARY.encode_ordinary(t or "")
        want.append((i, len(known), hashlib.sha256(np.array(known, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want, key=str)
    assert {r.text for r in decoded.collect()} == {t or "" for _, t in rows}
    assert bpe.encode_documents(documents(spark, []), PATH, public_tokenizers.PATTERN).collect() == []


def test_an_unknown_id_is_an_error(spark):
    from pyspark.errors import PythonException

    bad = spark.createDataFrame([(1, 1, bytearray(b"\xff\xff\xff\x0f"))], "doc_id bigint, n_tokens bigint, ids binary")
    with pytest.raises(PythonException):
        bpe.decode_documents(bad, PATH).collect()
