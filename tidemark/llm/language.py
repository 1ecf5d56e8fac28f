"""Language identification in two levels.

Linear support vector machines first tell language families apart, then, one
against one, the languages within the predicted family.  The features are
letter n-grams of the whole text, hashed into a fixed number of columns.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import regex
from pyspark.ml.classification import LinearSVC
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import fold_column, quoted, read_table, type_of
from tidemark.session import durable

#: Columns of the n-grams of each length 1, 2 and 3.
COLUMN_BITS = 11
COLUMNS = 1 << COLUMN_BITS
#: Documents per language that the machines are fitted on.
TRAIN_ROWS = 1_000
#: Characters of a text whose n-grams are counted at once.
PORTION = 1_000_000
#: Families by language; a language that is not listed is a family of its own.
FAMILIES = {
    "de": "germanic", "en": "germanic", "nl": "germanic", "sv": "germanic", "da": "germanic", "no": "germanic", "is": "germanic",
    "fr": "romance", "es": "romance", "it": "romance", "pt": "romance", "ro": "romance", "ca": "romance",
    "ru": "slavic", "uk": "slavic", "pl": "slavic", "cs": "slavic", "sk": "slavic", "bg": "slavic", "hr": "slavic",
}

NOT_LETTERS = regex.compile(r"\P{L}+")


def features(text: str | None) -> np.ndarray | None:
    """Square roots of the counts of hashed letter n-grams, of length 1; None without a letter.

    Everything but letters counts as one blank, also before and after the text.
    """
    total, found = np.zeros(3 * COLUMNS), False
    for at in range(0, len(text or ""), PORTION):
        letters = NOT_LETTERS.sub(" ", " " + text[at:at + PORTION].lower() + " ")
        found = found or letters != " "
        codes = np.frombuffer(letters.encode("utf-32-le"), "<u4").astype(np.uint64)
        code = codes
        for n in range(3):
            if n:
                code = code[:-1] * np.uint64(0x100000001B3) + codes[n:]
            places = ((code * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - COLUMN_BITS)).astype(np.int64)
            total[n * COLUMNS:(n + 1) * COLUMNS] += np.bincount(places, minlength=COLUMNS)
    if not found:
        return None
    total = np.sqrt(total)
    return total / np.linalg.norm(total)


class LanguageModel:
    """Separating planes: ``planes[a, b]`` is positive for a; families first, then languages.

    Held as built-in types, so that it can be broadcast as it is.
    """

    def __init__(self, families: dict[str, list[str]], planes: dict[tuple[str, str], list[float]]):
        self.families, self.planes = families, planes
        self.arrays = {pair: np.array(plane) for pair, plane in planes.items()}

    def choose(self, names: list[str], x: np.ndarray) -> tuple[str, float]:
        """One against one: most duels won, then the clearest; and the mean certainty of its duels."""
        if len(names) == 1:
            return names[0], 1.0
        won, sure = dict.fromkeys(names, 0), {n: [] for n in names}
        for a, b in combinations(names, 2):
            plane = self.arrays[a, b]
            p = 1 / (1 + np.exp(-np.clip(4 * (x @ plane[:-1] + plane[-1]), -30, 30)))
            won[a] += p >= 0.5
            won[b] += p < 0.5
            sure[a].append(p)
            sure[b].append(1 - p)
        best = min(names, key=lambda n: (-won[n], -sum(sure[n]), n))
        return best, float(np.mean(sure[best]))

    def predict(self, text: str | None) -> tuple[str, float]:
        x = features(text) if self.families else None
        if x is None:
            return "und", 0.0
        family, p = self.choose(sorted(self.families), x)
        language, q = self.choose(self.families[family], x)
        return language, p * q


def _training(docs: DataFrame, id_col: str, text_col: str, lang_col: str, train_rows: int) -> DataFrame:
    """(lang, text) of at most about `train_rows` distinct texts per language, outside the held-out fold.

    Texts are chosen by a hash of their own, whatever their order and number of
    copies; how many there are is a count of the distinct ones.
    """
    rows = docs.where(quoted(lang_col).isNotNull() & (fold_column(quoted(id_col)) != 2))
    named = rows.select(quoted(lang_col).cast("string").alias("lang"), quoted(text_col).cast("string").alias("text")).where(
        "text is not null"
    ).withColumn("draw", F.xxhash64("text"))
    distinct = named.select("lang", "draw").distinct()
    counts = {r.lang: r.n for r in distinct.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = F.lit(0.0)
    for lang, n in counts.items():
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, train_rows / n))).otherwise(share)
    return named.where(F.pmod("draw", F.lit(1 << 30)) < share * (1 << 30)).dropDuplicates(["lang", "draw"]).select("lang", "text")


def _vectors(training: DataFrame) -> DataFrame:
    """(lang, features) as sparse vectors; texts without a letter teach nothing."""

    def run(batches):
        for batch in batches:
            langs, places, values = [], [], []
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                x = features(text)
                if x is not None:
                    langs.append(lang)
                    places.append(np.flatnonzero(x).astype(np.int32))
                    values.append(x[places[-1]])
            yield pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()), pa.array(places, pa.list_(pa.int32())), pa.array(values, pa.list_(pa.float64()))],
                names=["lang", "places", "values"],
            )

    sparse = F.udf(lambda places, values: Vectors.sparse(3 * COLUMNS, places, values), VectorUDT())
    rows = training.mapInArrow(run, "lang string, places array<int>, values array<double>")
    return rows.select("lang", sparse("places", "values").alias("features"))


def _plane(rows: DataFrame, first: list[str], second: list[str]) -> list[float]:
    """The plane between two groups of languages; the last number is its offset."""
    two = rows.where(F.col("lang").isin(first + second)).select(
        F.col("lang").isin(first).cast("double").alias("label"), "features"
    )
    fitted = LinearSVC(maxIter=40, regParam=1e-4, standardization=False, tol=1e-4).fit(two)
    return [*map(float, fitted.coefficients.toArray()), float(fitted.intercept)]


def fit(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    train_rows: int = TRAIN_ROWS, families: dict[str, str] | None = None,
) -> LanguageModel:
    """Learn from at most about `train_rows` distinct texts per language of three folds of four.

    `families` names the family of a language; one that is missing is a
    family of its own.  Without any labelled text everything is ``und``.
    """
    rows = durable(_vectors(_training(docs, id_col, text_col, lang_col, train_rows)))
    languages = sorted(r.lang for r in rows.select("lang").distinct().collect())
    known = FAMILIES if families is None else families
    members: dict[str, list[str]] = {}
    for language in languages:
        members.setdefault(known.get(language, "only " + language), []).append(language)
    planes = {(a, b): _plane(rows, members[a], members[b]) for a, b in combinations(sorted(members), 2)}
    for inside in members.values():
        planes |= {(a, b): _plane(rows, [a], [b]) for a, b in combinations(inside, 2)}
    return LanguageModel(members, planes)


def predict_languages(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``lang_pred``, ``family``, ``score``.

    A text that is null or has no letter is ``und`` with score 0 and no family.
    Each whole text is judged by itself; ids may be null or repeat; no rows
    give no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.families, model.planes))

    def run(batches):
        model = LanguageModel(*shared.value)
        for batch in batches:
            found = [model.predict(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                names=["id", "lang_pred", "score"],
            )

    rows = docs.select(quoted(id_col).alias("id"), quoted(text_col).cast("string").alias("text"))
    family = F.lit(None).cast("string")
    for name, languages in model.families.items():
        family = F.when(F.col("lang_pred").isin(languages) & (F.col("score") > 0), F.lit(name)).otherwise(family)
    return rows.mapInArrow(run, f"id {type_of(rows, 'id')}, lang_pred string, score double").select(
        F.col("id").alias(id_col), "lang_pred", family.alias("family"), "score"
    )


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    found = predict_languages(docs, fit(docs))
    return found.select("doc_id", (fold_column(F.col("doc_id")) == 2).alias("held_out"), "lang_pred", "score", "family")
