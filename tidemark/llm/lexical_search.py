"""Ranked lexical search by an Aho-Corasick scan of the documents.

All terms of all items make one automaton.  Each term is guarded by a
separator on both sides, and so is each term of a document, so a match is a
whole term.  Documents are scanned as they stand, once for what the weights
need (how many documents hold a term, how long documents are) and once for the
scores; no index of the documents is made.  A match leads to the items that
have the term.  Each task keeps the best documents of every item only.

Items are dealt into shares whose terms have a bounded size, one automaton a
share, so what is sent to the tasks is bounded however many items there are.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import best_of_groups, quoted, read_table, slices, worker_store
from tidemark.session import durable

TOP = 10
#: Bytes of distinct terms, item by item, that one automaton is made of.
SHARE_BYTES = 4_000_000
#: Cells of (document, item) scored at once.
CELLS = 2_000_000
#: Shares that an item's candidates are cut down in before they meet.
SALTS = 16
#: Letters, digits and all bytes over 127 make terms, A-Z as a-z; every other byte separates them.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def normal(text: str | None) -> bytes:
    return (text or "").encode().translate(TERM_BYTES)


def automaton_of(terms: list[bytes]) -> ahocorasick.Automaton:
    """Matches each term between separators and gives its place in the list."""
    found = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    for number, term in enumerate(terms):
        found.add_word(" " + term.decode("latin-1") + " ", number)
    found.make_automaton()
    return found


def counts_in(text: bytes, automaton) -> Counter:
    """How often each term of the automaton stands in the normal `text`."""
    return Counter([number for _, number in automaton.iter(" " + text.decode("latin-1") + " ")])


def _held(key: str, terms: list[bytes]):
    """The automaton of the worker; one is kept, so a worker's memory is bounded."""
    store = worker_store()
    if store.get("lexical-key") != key:
        store["lexical-key"], store["lexical"] = key, automaton_of(terms)
    return store["lexical"]


def _item_shares(items: DataFrame, share_bytes: int):
    """Lists of (item's number, id, its distinct terms), each of a bounded size unless one item alone is larger."""
    rows = durable(items.select(
        F.monotonically_increasing_id().alias("number"), quoted("item_id").alias("id"), quoted("text").cast("string").alias("text")
    ))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shares = max(1, -(-2 * total // share_bytes))
    for share in range(shares):
        part, size = [], 0
        for row in rows.where(F.pmod(F.xxhash64("number"), F.lit(shares)) == share).toLocalIterator():
            terms = sorted(set(normal(row.text).split()))
            if part and size + sum(map(len, terms)) > share_bytes:
                yield part
                part, size = [], 0
            part.append((row.number, row.id, terms))
            size += sum(map(len, terms))
        if part:
            yield part


def _statistics(docs: DataFrame, terms: list[bytes]) -> tuple[int, int, np.ndarray]:
    """(documents with a term, all their terms, documents that hold each of `terms`)."""
    spark = docs.sparkSession
    sent, key = spark.sparkContext.broadcast(terms), hashlib.sha256(b" ".join(terms)).hexdigest()

    def run(batches):
        automaton = _held(key, sent.value)
        documents = length = 0
        holding = np.zeros(len(sent.value), np.int64)
        for batch in slices(batches):
            for text in batch.column("text").to_pylist():
                text = normal(text)
                n = len(text.split())
                documents += n > 0
                length += n
                found = {number for _, number in automaton.iter(" " + text.decode("latin-1") + " ")}
                holding[np.fromiter(found, np.int64, len(found))] += 1
        used = np.flatnonzero(holding)
        # Two rows for the whole: -1 the documents, -2 their terms.
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.r_[-1, -2, used].astype(np.int32)), pa.array(np.r_[documents, length, holding[used]])], names=["term", "n"]
        )

    rows = docs.mapInArrow(run, "term int, n bigint").groupBy("term").agg(F.sum("n").alias("n")).collect()  # a row a term of the share
    found = {r.term: r.n for r in rows}
    holding = np.zeros(len(terms), np.int64)
    for number, n in found.items():
        if number >= 0:
            holding[number] = n
    return found.get(-1, 0), found.get(-2, 0), holding


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def _ranked(docs: DataFrame, share: list, top: int) -> DataFrame:
    """(item's number, doc_id, score) of the best documents of each item, by task."""
    terms = sorted({t for _, _, listed in share for t in listed})
    documents, length, holding = _statistics(docs, terms)
    place = {t: i for i, t in enumerate(terms)}
    items_of: list[list[int]] = [[] for _ in terms]
    for at, (_, _, listed) in enumerate(share):
        for t in listed:
            items_of[place[t]].append(at)
    spark = docs.sparkSession
    ends = np.cumsum([0, *map(len, items_of)])
    facts = (terms, np.array([weight(documents, int(n)) for n in holding], np.int64), ends,
             np.array([i for listed in items_of for i in listed], np.int32), np.array([n for n, _, _ in share], np.int64))
    sent, key = spark.sparkContext.broadcast(facts), hashlib.sha256(b" ".join(terms)).hexdigest()
    nothing = np.iinfo(np.int64).max

    def run(batches):
        terms, weights, ends, items_of, numbers = sent.value
        automaton = _held(key, terms)
        rows = max(1, CELLS // len(numbers))
        best = [np.empty(0, np.int64)] * 3

        def merge(table, ids):
            nonlocal best
            at, item = np.nonzero(table)
            # Of a full table only what reaches the item's worst so far can enter.
            score = table[at, item]
            floor = np.zeros(len(numbers), np.int64)
            if len(best[0]):
                sizes = np.bincount(best[1], minlength=len(numbers))
                last = np.cumsum(sizes) - 1
                full = sizes >= top
                floor[full] = best[0][last[full]]
            keep = score >= floor[item]
            best = list(best_of_groups(np.r_[best[0], score[keep]], np.r_[best[1], item[keep]], np.r_[best[2], ids[at[keep]]], top))

        for batch in slices(batches, rows):
            table = np.zeros((batch.num_rows, len(numbers)), np.int64)
            ids = batch.column("id").fill_null(nothing).to_numpy()
            for i, text in enumerate(batch.column("text").to_pylist()):
                text = normal(text)
                found = counts_in(text, automaton)
                if not found:
                    continue
                m = 10 + 90 * len(text.split()) * documents // length
                t = np.fromiter(found.keys(), np.int64, len(found))
                tf = np.fromiter(found.values(), np.int64, len(found))
                if m < 2**58 and tf.max() < 2**33:
                    value = weights[t] * (1_000_000_000 * tf // (1_000 * tf + 8 * m))
                else:
                    value = np.array([int(w) * (10**9 * int(x) // (1000 * int(x) + 8 * m)) for w, x in zip(weights[t], tf)], np.int64)
                sizes = ends[t + 1] - ends[t]
                of_item = items_of[np.repeat(ends[t] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())]
                np.add.at(table[i], of_item, np.repeat(value, sizes))
            merge(np.maximum(table, 0), ids)
        score, item, ids = best
        yield pa.RecordBatch.from_arrays(
            [pa.array(numbers[item]), pa.array(ids, mask=ids == nothing), pa.array(score)], names=["number", "doc_id", "score"]
        )

    return docs.mapInArrow(run, "number bigint, doc_id bigint, score bigint")


def ranked_documents(
    docs: DataFrame, items: DataFrame, top: int = TOP, share_bytes: int = SHARE_BYTES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The `top` documents of each item by their terms in common: item_id, rank, doc_id, score.

    A term is a longest run of letters, digits and characters beyond ASCII, A-Z
    as a-z.  With N documents that hold a term, L terms in them, n in this
    document, df documents that hold the term and tf its occurrences here, an
    item's distinct terms add up ``w * (10^9 tf div (1000 tf + 8 m))``, where
    ``w = floor(1000 ln((2N + 2) / (2 df + 1)))`` and ``m = 10 + 90 n N div L``.
    Only scores above 0 count; equal scores go by the document's id, null ids
    last.  A null or empty text has no terms.  Every row of `items` is an item
    and every row of `docs` a document, also repeated ones.  Without items or
    documents there are no rows.
    """
    spark = docs.sparkSession
    texts = docs.select(quoted(id_col).cast("long").alias("id"), quoted(text_col).cast("string").alias("text"))
    found = None
    names = []
    for share in _item_shares(items, share_bytes):
        if any(terms for _, _, terms in share):
            part = durable(_ranked(texts, share, top))
            found = part if found is None else found.unionByName(part)
            names.append(durable(spark.createDataFrame([(n, i) for n, i, _ in share], f"number bigint, item_id {items.schema['item_id'].dataType.simpleString()}")))
    if found is None:
        return spark.createDataFrame([], f"item_id {items.schema['item_id'].dataType.simpleString()}, rank int, doc_id bigint, score bigint")
    # A task gives `top` rows an item; with very many tasks these are cut down in shares before an item's rows meet.
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    salted = found.withColumn("salt", F.pmod(F.xxhash64("doc_id", "score"), F.lit(SALTS)))
    first = Window.partitionBy("number", "salt").orderBy(*order)
    cut = salted.withColumn("place", F.row_number().over(first)).where(F.col("place") <= top).drop("place", "salt")
    ranked = cut.withColumn("rank", F.row_number().over(Window.partitionBy("number").orderBy(*order))).where(F.col("rank") <= top)
    ids = names[0]
    for more in names[1:]:
        ids = ids.unionByName(more)
    return ranked.join(ids, "number").select("item_id", "rank", "doc_id", "score")


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


OP11_SQL = r"""
WITH said AS (
  SELECT row_no, doc_id, unnest(terms) AS term, len(terms)::BIGINT AS n FROM (
    SELECT row_number() OVER () AS row_no, doc_id, regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents WHERE text IS NOT NULL)),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark WHERE text IS NOT NULL),
whole AS (SELECT count(DISTINCT row_no)::BIGINT AS n_docs, count(*)::BIGINT AS n_terms FROM said),
tfs AS (SELECT row_no, doc_id, term, any_value(n) AS n, count(*)::BIGINT AS tf FROM said GROUP BY row_no, doc_id, term),
dfs AS (SELECT term, count(*)::BIGINT AS df FROM tfs GROUP BY term),
weights AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM dfs, whole),
scores AS (
  SELECT item_id, row_no, doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM asked JOIN tfs USING (term) JOIN weights USING (term), whole GROUP BY item_id, row_no, doc_id),
ranked AS (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank
  FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
