"""Toxic passages as maximal scoring segments.

A word's score is its log-odds between toxic and other labelled documents, less
a constant that makes clean text drift down.  The Dirichlet prior of a word is
centred on its beginning, that of the beginning on a shorter one, and so on to
the share of all words; a word never seen scores as its longest known beginning.  A
linear scan finds all maximal scoring segments of a text.  The distribution of
the best segment of clean text is of the extreme-value kind; it turns
segment scores into bits of evidence, whose sum over the significant segments
is mapped to a probability.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import fold_column, quoted, read_table, type_of
from tidemark.session import durable

#: Labelled documents of each class that the model is fitted on, and words and beginnings it keeps.
TRAIN_ROWS, FEATURES = 20_000, 60_000
#: Lengths of the beginnings that a word's prior goes through.
BEGINNINGS = (3, 5, 7)
#: Letters of a word that are kept; longer words that agree on these are one.
LONGEST = 64
#: Words whose scores a worker remembers.
CACHED_WORDS = 300_000
#: Weight of each prior, as a number of uses.
PRIOR = 4.0
#: What is taken off each word's log-odds.
DRIFT = 0.7
#: Distinct words a task holds before it hands over its counts.
HELD_WORDS = 300_000
THRESHOLD = 0.3

TOKEN = regex.compile(r"[\p{L}\p{N}]+")


class WordScores(dict):
    """Word -> score, from the bounded table of log-odds of words and beginnings."""

    def __init__(self, table: dict[str, float]):
        super().__init__()
        self.table = table

    def __missing__(self, word: str) -> float:
        score = next((self.table[f] for f in features_of(word) if f in self.table), 0.0) - DRIFT
        if len(self) >= CACHED_WORDS:
            self.clear()
        if len(word) <= LONGEST:
            self[word] = score
        return score


def counted_as(word: str) -> str:
    """The word, or the beginning that stands for a very long one."""
    return word if len(word) <= LONGEST else word[:LONGEST] + "*"


def features_of(word: str) -> list[str]:
    """The word, then its beginnings from long to short, marked by a star."""
    return [counted_as(word), *(word[:n] + "*" for n in reversed(BEGINNINGS) if n < len(word))]


@dataclass(frozen=True)
class ToxicModel:
    """Scores and calibration; all it learned, bounded by `FEATURES`."""

    table: dict[str, float]
    rate: float
    scale: float
    slope: float
    offset: float
    words: WordScores = field(init=False, compare=False)

    def __post_init__(self):
        object.__setattr__(self, "words", WordScores(self.table))

    def plain(self) -> tuple:
        """Built-in types only, for a broadcast."""
        return self.table, self.rate, self.scale, self.slope, self.offset

    def probability(self, evidence: float) -> float:
        return 1.0 / (1.0 + math.exp(-max(-50.0, min(50.0, self.slope * math.log1p(evidence) + self.offset))))


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, end, score) in one pass.

    Candidates are kept as (first, end, sum before, sum after).  A new positive
    score is joined with candidates as long as the last one with a smaller
    sum before has also a smaller sum after.  Only positive scores are visited.
    """
    after = np.cumsum(scores)
    places = np.flatnonzero(scores > 0)
    stack: list[tuple[int, int, float, float]] = []
    links: list[int] = []  # for each candidate, the nearest earlier one with a smaller sum before
    for place, high in zip(places.tolist(), after[places].tolist()):
        first, low = place, high - float(scores[place])
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= low:
                j = links[j]
            if j < 0 or stack[j][3] >= high:
                stack.append((first, place + 1, low, high))
                links.append(j)
                break
            first, low = stack[j][0], stack[j][2]
            del stack[j:], links[j:]
    return [(a, b, high - low) for a, b, low, high in stack]


def tokens_of(text: str) -> list[str]:
    return TOKEN.findall(text.lower())


def scores_of(text: str, model: ToxicModel) -> np.ndarray:
    words = tokens_of(text)
    return np.fromiter(map(model.words.__getitem__, words), np.float64, len(words))


def bits(score: float, words: int, model: ToxicModel) -> float:
    """Evidence of a segment: how far it lies above the best of clean text with so many words."""
    return model.rate * score - math.log(model.scale * max(words, 1))


def significant(scores: np.ndarray, model: ToxicModel) -> list[tuple[int, int, float]]:
    """(first word, end word, evidence) of the segments with positive evidence."""
    found = [(a, b, bits(s, len(scores), model)) for a, b, s in segments(scores)]
    return [f for f in found if f[2] > 0]


def _training(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, train_rows: int) -> DataFrame:
    """At most about `train_rows` labelled documents of each class, outside the held-out fold.

    An id with several labels is toxic if one of them says so.  The choice is
    by hash of the id, whatever the order of the rows; the list of ids is
    bounded by twice `train_rows` and broadcast, so no text is shuffled.
    """
    one = durable(
        labels.where("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("id"))
        .agg(F.max(F.col("toxic").cast("int")).alias("toxic")).where(fold_column(F.col("id")) != 2)
    )
    sizes = {r.toxic: r["n"] for r in one.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).where("toxic in (0, 1)").collect()}
    share = F.lit(0.0)
    for toxic, n in sizes.items():
        share = F.when(F.col("toxic") == toxic, F.lit(min(1.0, train_rows / max(n, 1)))).otherwise(share)
    chosen = one.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < share * (1 << 30))
    rows = docs.select(quoted(id_col).cast("long").alias("id"), quoted(text_col).cast("string").alias("text")).where("text is not null")
    return rows.join(F.broadcast(chosen), "id")


def _word_counts(training: DataFrame) -> DataFrame:
    """(word, toxic, other): uses in the training documents, pre-added by each task."""

    def run(batches):
        counts: dict[bool, Counter] = {True: Counter(), False: Counter()}

        def hand_over():
            words = sorted(set(counts[True]) | set(counts[False]))
            out = pa.RecordBatch.from_arrays(
                [pa.array(words, pa.string()), pa.array([counts[True][w] for w in words], pa.int64()),
                 pa.array([counts[False][w] for w in words], pa.int64())], names=["word", "toxic", "other"],
            )
            counts[True].clear()
            counts[False].clear()
            return out

        for batch in batches:
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                counts[bool(toxic)].update(map(counted_as, tokens_of(text)))
                if len(counts[True]) + len(counts[False]) > HELD_WORDS:
                    yield hand_over()
        yield hand_over()

    counted = training.select("text", "toxic").mapInArrow(run, "word string, toxic bigint, other bigint")
    return counted.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))


def _log_odds(counts: DataFrame, features: int) -> dict[str, float]:
    """Log-odds of the `features` words and beginnings that add most to their own prior."""
    totals = counts.agg(F.coalesce(F.sum("toxic"), F.lit(0)).alias("t"), F.coalesce(F.sum("other"), F.lit(0)).alias("o")).first()
    t, o = totals["t"], totals["o"]
    if not t or not o:
        return {}
    base = t / (t + o)
    logit = lambda share: F.log(share / (1 - share))
    begun = lambda n: F.concat(F.substring("word", 1, n), F.lit("*"))
    # Level by level, words that go on and words that end join the share of what they begin with.
    rows = counts.withColumn("above", F.lit(base))
    found = []
    for n in (*BEGINNINGS, None):
        ends = rows if n is None else rows.where(F.length("word") <= n)
        whole = ends.select(F.col("word").alias("feature"), "toxic", "other", "above")
        found.append(whole)
        if n is None:
            break
        rows = rows.where(F.length("word") > n).withColumn("feature", begun(n))
        level = durable(
            rows.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"), F.first("above").alias("above"))
        )
        found.append(level)
        share = (F.col("toxic") + PRIOR * F.col("above")) / (F.col("toxic") + F.col("other") + PRIOR)
        rows = rows.drop("above").join(level.select("feature", share.alias("above")), "feature").drop("feature")
    every = reduce(DataFrame.unionByName, found)
    uses = F.col("toxic") + F.col("other")
    share = (F.col("toxic") + PRIOR * F.col("above")) / (uses + PRIOR)
    top = (
        every.select("feature", (logit(share) - F.lit(math.log(base / (1 - base)))).alias("score"),
                     (F.abs(logit(share) - logit(F.col("above"))) * F.sqrt(uses)).alias("adds"))
        .orderBy(F.desc("adds"), "feature").limit(features).select("feature", "score").collect()
    )
    return {r.feature: r.score for r in top}


def _rate(counts: DataFrame, table: dict[str, float]) -> float:
    """The positive root of sum(p * exp(rate * score)) = 1 over the uses of words in clean text.

    It says how fast high segments get rare.  Scores are rounded to hundredths,
    so that few numbers come back.
    """
    shared = counts.sparkSession.sparkContext.broadcast(table)

    def run(batches):
        scores = WordScores(shared.value)
        for batch in batches:
            found = [round(100 * scores[w]) for w in batch.column("word").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), batch.column("other")], names=["score", "other"])

    seen = counts.select("word", "other").mapInArrow(run, "score bigint, other bigint")
    rows = seen.groupBy("score").agg(F.sum("other").alias("n")).collect()
    if not rows:
        return 1.0
    # A score never seen in clean text still has a chance there.
    p = np.array([r.n + 0.5 for r in rows])
    s = np.array([r.score / 100 for r in rows])
    p = p / p.sum()
    if s.max() <= 0 or (p * s).sum() >= 0:
        return 1.0
    low, high = 1e-6, 1e-3
    while (p * np.exp(np.minimum(high * s, 700))).sum() < 1 and high < 100:
        low, high = high, high * 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if (p * np.exp(np.minimum(middle * s, 700))).sum() < 1 else (low, middle)
    return float((low + high) / 2)


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope (not below 0) and offset by Newton steps, with a little ridge and smoothed targets."""
    if not len(x) or not y.any() or y.all():
        share = (y.sum() + 1) / (len(y) + 2) if len(y) else 0.1
        return 1.0, float(math.log(share / (1 - share)) - 1.0)
    up, down = (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2)
    target = np.where(y == 1, up, down)
    features = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(features @ w, -30, 30)))
        gradient = features.T @ (p - target) + 1e-3 * w
        hessian = (features * (p * (1 - p))[:, None]).T @ features + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        w = w - np.clip(step, -2, 2)
    return max(0.0, float(w[0])), float(w[1])


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", train_rows: int = TRAIN_ROWS,
    features: int = FEATURES,
) -> ToxicModel:
    """Learn word scores from two folds and the calibration from a third; the fourth is never looked at.

    At most about `train_rows` documents of each class are used and `features`
    words and beginnings of words are kept.  Without labels of both classes
    every word has the same negative score, and every text the same
    probability.
    """
    training = durable(_training(docs, labels, id_col, text_col, train_rows))
    fold = fold_column(F.col("id"))
    counts = durable(_word_counts(training.where(fold != 3)))
    table = _log_odds(counts, features)
    rate = _rate(counts, table)
    raw = ToxicModel(table, rate, 1.0, 1.0, 0.0)
    shared = docs.sparkSession.sparkContext.broadcast(raw.plain())

    def run(batches):
        model = ToxicModel(*shared.value)
        for batch in batches:
            best, sizes = [], []
            for text in batch.column("text").to_pylist():
                values = scores_of(text, model)
                sizes.append(len(values))
                best.append(max((s for _, _, s in segments(values)), default=0.0))
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic"), pa.array(sizes, pa.int64()), pa.array(best, pa.float64())], names=["toxic", "n", "best"]
            )

    held = training.where(fold == 3).select("toxic", "text")
    rows = held.mapInArrow(run, "toxic int, n bigint, best double").collect()  # bounded by the training rows
    # Best segments of clean texts: rate * best - ln(n) has mean ln(scale) + Euler's constant.
    clean_best = [rate * r.best - math.log(r.n) for r in rows if r.toxic == 0 and r.n > 0]
    scale = math.exp(np.median(clean_best) + math.log(math.log(2))) if clean_best else 1.0
    known = ToxicModel(table, rate, max(scale, 1e-12), 1.0, 0.0)
    scaled = docs.sparkSession.sparkContext.broadcast(known.plain())

    def weigh(batches):
        model = ToxicModel(*scaled.value)
        for batch in batches:
            found = [sum(f[2] for f in significant(scores_of(t, model), model)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(found, pa.float64())], names=["toxic", "evidence"])

    rows = held.mapInArrow(weigh, "toxic int, evidence double").collect()
    slope, offset = _logistic(np.log1p([r.evidence for r in rows]), np.array([float(r.toxic) for r in rows]))
    return ToxicModel(table, rate, known.scale, slope, offset)


def score_documents(
    docs: DataFrame, model: ToxicModel, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """One row per document: id, ``score``, ``predicted`` and its toxic ``passages``.

    Passages are code points (start, end) with their evidence, in order.  A
    null text is the empty text: no passages, the lowest score.  Each row is
    scored by itself and as a whole; ids may be null or repeat; no rows give no
    rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model.plain())

    def run(batches):
        model = ToxicModel(*shared.value)
        for batch in batches:
            scores, passages = [], []
            for text in batch.column("text").to_pylist():
                found = significant(scores_of(text or "", model), model)
                scores.append(model.probability(sum(f[2] for f in found)))
                if found:
                    places = [m.span() for m in TOKEN.finditer(text)]
                    exact = len(places) == len(tokens_of(text))  # a lower case can split a word, in theory
                    passages.append([
                        {"start": places[a][0] if exact else 0, "end": places[b - 1][1] if exact else len(text), "evidence": e}
                        for a, b, e in found
                    ])
                else:
                    passages.append([])
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("evidence", pa.float64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(scores, pa.float64()), pa.array(passages, kind)], names=["id", "score", "passages"]
            )

    rows = docs.select(quoted(id_col).alias("id"), quoted(text_col).cast("string").alias("text"))
    scored = rows.mapInArrow(
        run, f"id {type_of(rows, 'id')}, score double, passages array<struct<start:bigint,end:bigint,evidence:double>>"
    )
    return scored.select(F.col("id").alias(id_col), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "passages")


def drop_toxic(docs: DataFrame, model: ToxicModel, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs` below the threshold, with all their columns; a null text stays."""
    shared = docs.sparkSession.sparkContext.broadcast(model.plain())

    @F.pandas_udf("double")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = ToxicModel(*shared.value)
        for texts in parts:
            found = [significant(scores_of(t or "", model), model) for t in texts]
            yield pd.Series([model.probability(sum(f[2] for f in one)) for one in found], dtype="float64")

    return docs.where(score(quoted("text").cast("string")) < threshold)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    scored = score_documents(docs, fit(docs, read_table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id", (fold_column(F.col("doc_id")) == 2).alias("held_out"), "score", "predicted",
        F.size("passages").cast("long").alias("n_passages"),
    )

