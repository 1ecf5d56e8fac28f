"""Token counts by a two-tier lookup next to the data.

The first tier is a table of the corpus' frequent pre-tokens and their lengths
in tokens, of bounded size, broadcast to all workers.  A miss goes to the
worker's cache and from there to the model.  The table comes from a summary
that each task keeps of all its pre-tokens in bounded memory, so pre-tokens
themselves are never shuffled.  It only decides how fast a count is found.
"""

from __future__ import annotations

import json
from collections import Counter
from functools import reduce

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import quoted, read_table, type_of

#: Pre-tokens a task's summary holds and hands over, the size of the broadcast table, and of a worker's cache.
SUMMARY, HANDED_OVER, TABLE, CACHED = 100_000, 4_096, 32_768, 500_000
#: Longer pre-tokens are counted without being remembered.
CACHED_LENGTH = 64


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary.

    Printable bytes stand for themselves, the others follow from U+0100 on.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {b: chr(b) for b in plain}
    for b in range(256):
        letters.setdefault(b, chr(256 + len(letters) - len(plain)))
    return [letters[b] for b in range(256)]


class PreTokens:
    """Splits text as the tokenizer file says.

    Characters up to U+024F, except U+0130, are their own canonical form and
    have a one-to-one lower case, so such texts are split here; for others
    the library's own normaliser and splitter are asked.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.special = [t["content"] for t in spec["added_tokens"]]
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.split = regex.compile(pattern.replace(r"[^\s", r"[^\p{White_Space}"))
        self.unusual = regex.compile("[İɐ-\U0010ffff]")
        self.letters = byte_letters()

    def mapped(self, piece: str) -> str:
        return "".join([self.letters[b] for b in piece.encode()])

    def parts(self, text: str) -> list[tuple[bool, list[str]]]:
        """(already in the vocabulary's letters, pieces); usually one part for a text."""
        if self.unusual.search(text) is None:
            return [(False, self.split.findall(text.lower()))]
        normal = self.whole.normalizer.normalize_str(text)
        return [(True, [p for p, _ in self.whole.pre_tokenizer.pre_tokenize_str(normal)])]

    def length(self, mapped: str) -> int:
        return len(self.whole.model.tokenize(mapped))


class Lengths(dict):
    """Worker cache: a piece's number of tokens, from the broadcast table or else from the model."""

    def __init__(self, pre: PreTokens, table: dict[str, int], is_mapped: bool):
        super().__init__()
        self.pre, self.table, self.is_mapped = pre, table, is_mapped

    def __missing__(self, piece: str) -> int:
        mapped = piece if self.is_mapped else self.pre.mapped(piece)
        n = self.table.get(mapped)
        if n is None:
            n = self.pre.length(mapped)
        if len(piece) <= CACHED_LENGTH:
            if len(self) >= CACHED:
                self.clear()
            self[piece] = n
        return n


class Summary(Counter):
    """Frequent items in bounded memory: when full, what is at or below the median count goes.

    A piece that makes up over 2 / SUMMARY of a task's pieces is always kept.
    """

    def add(self, pieces: list[str]) -> None:
        self.update(pieces)
        if len(self) > SUMMARY:
            cut = sorted(self.values())[len(self) // 2]
            for piece in [p for p, n in self.items() if n <= cut]:
                del self[piece]


def frequent_lengths(docs: DataFrame, path: str, text_col: str = "text") -> dict[str, int]:
    """The broadcast table: at most `TABLE` frequent pre-tokens over all of `docs`, with their lengths."""

    def run(batches):
        pre, seen = PreTokens(path), {False: Summary(), True: Summary()}
        for batch in batches:
            for text in batch.column("text").to_pylist():
                for is_mapped, pieces in pre.parts(text or ""):
                    seen[is_mapped].add([p for p in pieces if len(p) <= CACHED_LENGTH])
        total = reduce(lambda a, b: a + b, [Counter({p if m else pre.mapped(p): n for p, n in s.items()}) for m, s in seen.items()])
        top = total.most_common(HANDED_OVER)
        yield pa.RecordBatch.from_arrays(
            [pa.array([p for p, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())], names=["piece", "n"]
        )

    rows = docs.select(quoted(text_col).cast("string").alias("text"))
    summaries = rows.mapInArrow(run, "piece string, n bigint").groupBy("piece").agg(F.sum("n").alias("n"))
    top = summaries.orderBy(F.desc("n"), "piece").limit(TABLE).select("piece").collect()
    pre = PreTokens(path)
    return {row.piece: pre.length(row.piece) for row in top}


def count_tokens(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 2048
) -> DataFrame:
    """Tokens of every whole text: id, ``n_bytes``, ``n_tokens``, ``over_limit`` (more than `limit`).

    `path` names a tokenizer file that every executor can open.  Special
    strings inside a text count as the library counts them by default.  A
    null text is the empty text with no tokens.  Each row is counted by
    itself, so ids may be null or repeat; no rows give no rows.
    """
    table = docs.sparkSession.sparkContext.broadcast(frequent_lengths(docs, path, text_col))

    def run(batches):
        pre = PreTokens(path)
        caches = {m: Lengths(pre, table.value, m) for m in (False, True)}

        def count(text: str) -> int:
            if any(s in text for s in pre.special):
                return len(pre.whole.encode(text, add_special_tokens=False).ids)
            return sum(sum(map(caches[m].__getitem__, pieces)) for m, pieces in pre.parts(text))

        for batch in batches:
            counts = [count(t) if t else 0 for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("n_bytes"), pa.array(counts, pa.int64())], names=["id", "n_bytes", "n_tokens"]
            )

    text = quoted(text_col).cast("string")
    rows = docs.select(
        quoted(id_col).alias("id"), F.octet_length(F.coalesce(text, F.lit(""))).cast("long").alias("n_bytes"), text.alias("text")
    )
    counted = rows.mapInArrow(run, f"id {type_of(rows, 'id')}, n_bytes bigint, n_tokens bigint")
    return counted.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return count_tokens(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
