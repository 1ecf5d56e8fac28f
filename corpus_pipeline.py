"""A training-data pipeline over `documents`.

Each stage reads what the one before it kept, as a written table.  All but the
last return the columns of `documents`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import bpe, exact_dedup, minhash, mixing, toxicity
from tidemark.llm.common import partitions, read_table, scratch
from tidemark.session import durable


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold; the model is fitted on the table's labels.

    Nulls and empty texts are clean.
    """
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, model)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each text, that with the largest id."""
    index = exact_dedup.DigestIndex(spark, scratch(spark, "digest-index"), max(8, partitions(spark)))
    return exact_dedup.drop_repeats(docs, index)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of texts that share 80 % of their five-word shingles."""
    return minhash.drop_near_duplicates(docs, width=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.mixed_rows(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document of the mix, next to their digest and that of the decoded text."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = bpe.encode_documents(docs, path, public_tokenizers.PATTERN)
    return bpe.digests(bpe.decode_documents(encoded, path))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("minhash_dedup", drop_near_copies),
    ("mix_sources", mix_sources),
    ("byte_bpe", encode),
]

# SQL can't express the toxicity model; the tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each stage's result is written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
