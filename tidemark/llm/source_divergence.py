"""Divergence of the sources of each language, from exact counts of terms.

A `CountVectorizer` is fitted for each language, on counts of documents that
tasks have summed up beforehand; it keeps every term that stands in at least
`min_documents` of the language's documents and turns each document into an
exact sparse vector.  Vectors are summed by (language,
source) in the tasks, as `Summarizer` does, but sparsely.  What two sources
have to do with each other is then evaluated on those sums without the terms
that neither has.

With counts c of a group over the V kept terms of its language, N in all, a
term's mass is ``p = 1 + floor(10^9 * (c + 1) / (N + V))``, also where c is 0.
Two groups differ on a term by ``f = floor((p - q)^2 / q)``.
"""

from __future__ import annotations

from collections import Counter
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.errors import IllegalArgumentException
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import quoted, read_table, scratch, slices
from tidemark.session import durable

MIN_DOCUMENTS = 3
TERM_RANKS = 200
VOCABULARY = 2**31 - 1
#: Letters and all bytes over 127 make terms, A-Z as a-z; every other byte separates them.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))
#: Sums held in a task before they are merged, and ordered pairs of sources evaluated at once.
ENTRIES, PAIRS = 2_000_000, 1_000_000
#: Terms in one list of a fit, and languages whose documents are vectorised in one pass.
LISTED, LANGUAGES = 10_000, 16
SCALE = 1_000_000_000


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(TERM_BYTES).split()


def _rows(docs: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    return docs.select(*[
        F.coalesce(quoted(c).cast("string"), F.lit("")).alias(n) for c, n in ((text_col, "text"), (lang_col, "lang"), (source_col, "source"))
    ])


def _term_lists(lists: list, **columns: pa.Array) -> pa.RecordBatch:
    ends = np.cumsum([0, *map(len, lists)])
    flat = pa.array([t for listed in lists for t in listed], pa.string())
    terms = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)
    return pa.RecordBatch.from_arrays([*columns.values(), terms], names=[*columns, "terms"])


def _frequent(rows: DataFrame, min_documents: int) -> DataFrame:
    """(lang, terms): lists in which a term stands as often as in documents, but at most `min_documents` times a portion.

    A fit asks only whether a term stands in `min_documents` documents.  A
    task therefore counts the documents of each term and, for j up to that
    bound, hands on one list of the terms with at least j documents.
    """

    def run(batches):
        counts: dict[str, Counter] = {}
        held = 0

        def out():
            for lang, found in counts.items():
                for j in range(1, min_documents + 1):
                    enough = [t for t, n in found.items() if n >= j]
                    for at in range(0, len(enough), LISTED):
                        yield _term_lists([enough[at:at + LISTED]], lang=pa.array([lang], pa.string()))

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                found = counts.setdefault(lang, Counter())
                held -= len(found)
                found.update(set(terms_of(text)))
                held += len(found)
                if held >= ENTRIES // 4:
                    yield from out()
                    counts, held = {}, 0
        yield from out()

    return rows.select("lang", "text").mapInArrow(run, "lang string, terms array<string>")


def _terms(rows: DataFrame) -> DataFrame:
    """(lang, source, all terms in order) of every document."""

    def run(batches):
        for batch in slices(batches):
            lists = [terms_of(t) for t in batch.column("text").to_pylist()]
            yield _term_lists(lists, lang=batch.column("lang"), source=batch.column("source"))

    return rows.mapInArrow(run, "lang string, source string, terms array<string>")


def _sums(vectors: DataFrame, numbers: list[int]) -> DataFrame:
    """(lang_no, source, idx, count) summed over the documents' vectors of a task, in portions of bounded size.

    Column ``v<number>`` has the document's vector over the terms of that language.
    """

    def merged(names, keys, counts):
        keys, counts = np.concatenate(keys), np.concatenate(counts)
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        keys = keys[first]
        group = pa.array((keys >> 32).astype(np.int32))
        source = pa.DictionaryArray.from_arrays(group, pa.array([s for _, s in names], pa.string())).cast(pa.string())
        language = pa.array(np.array([no for no, _ in names], np.int32)[keys >> 32])
        return pa.RecordBatch.from_arrays(
            [language, source, pa.array((keys & 0xFFFFFFFF).astype(np.int32)), pa.array(np.add.reduceat(counts, first))],
            names=["lang_no", "source", "idx", "count"],
        )

    def run(batches):
        codes: dict[tuple, int] = {}
        keys, counts, held = [], [], 0
        for batch in batches:
            sources = batch.column("source").to_pylist()
            for no in numbers:
                vector = batch.column(f"v{no}")
                lists = vector.field("indices")
                sizes = np.diff(lists.offsets.to_numpy())
                used = np.flatnonzero(sizes)
                if not len(used):
                    continue
                group = np.array([codes.setdefault((no, sources[i]), len(codes)) for i in used], np.int64)
                indices = lists.flatten().to_numpy().astype(np.int64)
                keys.append((np.repeat(group, sizes[used]) << 32) | indices)
                counts.append(vector.field("values").flatten().to_numpy().astype(np.int64))
                held += len(indices)
            if held >= ENTRIES:
                yield merged(list(codes), keys, counts)
                codes, keys, counts, held = {}, [], [], 0
        if held:
            yield merged(list(codes), keys, counts)

    return vectors.mapInArrow(run, "lang_no int, source string, idx int, count bigint")


def _fitted(terms: DataFrame, min_documents: int, no: int):
    """The language's model, or None if no term stands in enough documents."""
    try:
        return CountVectorizer(inputCol="terms", outputCol=f"v{no}", minDF=float(min_documents), vocabSize=VOCABULARY).fit(terms)
    except IllegalArgumentException as error:
        if "vocabulary size" not in str(error):
            raise
        return None


def _vocabulary(spark: SparkSession, model) -> DataFrame:
    """(idx, term), from the model's own table."""
    path = scratch(spark, "vocabulary")
    model.save(path)
    return spark.read.parquet(f"{path}/data").select(F.posexplode("vocabulary").alias("idx", "term"))


def mass(count: Column, total: Column) -> Column:
    """1 + floor(10^9 * (count + 1) / total), in whole numbers of any size."""
    large = F.lit(SCALE).cast("decimal(10,0)") * (count + 1).cast("decimal(20,0)")
    exact = F.call_function("div", large, total.cast("decimal(20,0)"))
    return 1 + F.when(count < 9 * SCALE, F.call_function("div", SCALE * (count + 1), total)).otherwise(exact)


def apart(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _evaluated(counts: DataFrame, term_ranks: int) -> DataFrame:
    """All that needs the groups of a term side by side: (kind, a, b, value), from rows sorted by term within their partition.

    Kind 0: for groups a and b, summed over the terms that both have, what
    differs from taking each alone; for such a term A + B + (V - n_a - n_b) f0
    counts f(a, 0), f(0, b) and minus f(0, 0) where f(a, b) is due.  Kind 1:
    term b of group a that its language uses less, if fewer than `term_ranks`
    terms of the task have a larger value.
    """

    def f(p, q):
        return (p - q) ** 2 // q

    def out(kind, a, b, value):
        kinds = pa.array(np.full(len(a), kind, np.int32))
        return pa.RecordBatch.from_arrays(
            [kinds, pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32)), pa.array(value)], names=["kind", "a", "b", "value"]
        )

    def both(begin, sizes, gid, p, p0):
        """Sums of the pairs of groups over portions of terms that equally many groups have."""
        for k in np.unique(sizes[sizes > 1]):
            rows = begin[sizes == k]
            for column in range(k):
                others = np.delete(np.arange(k), column)[None, :]
                for at in range(0, len(rows), max(1, PAIRS // k)):
                    i = rows[at:at + max(1, PAIRS // k), None] + column
                    j = i - column + others
                    value = f(p[i], p[j]) - f(p[i], p0[j]) - f(p0[i], p[j]) + f(p0[i], p0[j])
                    yield ((gid[i] << 32) | gid[j]).ravel(), value.ravel()

    def merged(parts):
        key, value = (np.concatenate(c) for c in zip(*parts))
        found, inverse = np.unique(key, return_inverse=True)
        total = np.zeros(len(found), np.int64)
        np.add.at(total, inverse, value)
        return found, total

    def largest(gid, idx, value):
        """Of each group the terms with fewer than `term_ranks` larger values; ties stay."""
        order = np.lexsort((-value, gid))
        gid, idx, value = gid[order], idx[order], value[order]
        first = np.flatnonzero(np.r_[True, gid[1:] != gid[:-1]])
        sizes = np.diff(np.r_[first, len(gid)])
        last = value[np.minimum(first + term_ranks, first + sizes) - 1]
        keep = value >= np.repeat(last, sizes)
        return gid[keep], idx[keep], value[keep]

    def run(batches):
        rest: np.ndarray | None = None
        sums: list[tuple[np.ndarray, np.ndarray]] = []
        tops: list[tuple[np.ndarray, ...]] = []
        names = ("lang_no", "idx", "gid", "count", "p", "p0", "size")

        def take(rows):
            """Whole terms: adds to `sums` and `tops`, which are merged when they grow."""
            nonlocal sums, tops
            lang, idx, gid, count, p, p0, size = rows
            begin = np.flatnonzero(np.r_[True, (lang[1:] != lang[:-1]) | (idx[1:] != idx[:-1])])
            sizes = np.diff(np.r_[begin, len(idx)])
            total = np.add.reduceat(count, begin)
            if total.max() < 9 * SCALE:
                q = 1 + SCALE * (total + 1) // size[begin]
            else:
                q = np.array([1 + SCALE * (int(t) + 1) // int(n) for t, n in zip(total, size[begin])], np.int64)
            q = np.repeat(q, sizes)
            over = p > q
            tops.append(largest(gid[over], idx[over], f(p[over], q[over]))) if over.any() else None
            for key, value in both(begin, sizes, gid, p, p0):
                sums.append((key, value))
                if sum(len(k) for k, _ in sums) >= PAIRS:
                    sums = [merged(sums)]
            if sum(len(g) for g, _, _ in tops) >= PAIRS:
                tops = [largest(*(np.concatenate(c) for c in zip(*tops)))]

        for batch in batches:
            rows = np.stack([batch.column(n).to_numpy().astype(np.int64) for n in names])
            rows = rows if rest is None else np.concatenate([rest, rows], axis=1)
            # The last term may go on in the next batch.
            new = np.flatnonzero((rows[0, 1:] != rows[0, :-1]) | (rows[1, 1:] != rows[1, :-1])) + 1
            cut = new[-1] if len(new) else 0
            rest = rows[:, cut:]
            if cut:
                take(rows[:, :cut])
        if rest is not None and rest.shape[1]:
            take(rest)
        if sums:
            key, value = merged(sums)
            yield out(0, key >> 32, key & 0xFFFFFFFF, value)
        if tops:
            yield out(1, *largest(*(np.concatenate(c) for c in zip(*tops))))

    return counts.mapInArrow(run, "kind int, a int, b int, value bigint")


def _of_pairs(counts: DataFrame, groups: DataFrame, both: DataFrame) -> DataFrame:
    """Every ordered pair of sources of a language with f summed over all kept terms."""
    a = groups.select("lang_no", F.col("gid").alias("a"), "source", F.col("p0").alias("a0"), F.col("held").alias("a_held"), "kept")
    b = groups.select("lang_no", F.col("gid").alias("b"), F.col("source").alias("item"), F.col("p0").alias("b0"), F.col("held").alias("b_held"))
    pairs = a.join(b, "lang_no").where("a != b")
    # Groups share few counts, so a group alone is summed up by its masses.
    masses = counts.groupBy("gid", "p").agg(F.count(F.lit(1)).alias("times"))
    first = (
        pairs.select("a", "b", "b0").join(masses, F.col("a") == F.col("gid"))
        .groupBy("a", "b").agg(F.sum(F.col("times") * apart(F.col("p"), F.col("b0"))).alias("first"))
    )
    second = (
        pairs.select("a", "b", "a0").join(masses, F.col("b") == F.col("gid"))
        .groupBy("a", "b").agg(F.sum(F.col("times") * apart(F.col("a0"), F.col("p"))).alias("second"))
    )
    parts = [first, second, both]
    joined = reduce(lambda x, y: x.join(y, ["a", "b"], "left"), parts, pairs)
    neither = (F.col("kept") - F.col("a_held") - F.col("b_held")) * apart(F.col("a0"), F.col("b0"))
    value = sum((F.coalesce(F.col(c), F.lit(0)) for c in ("first", "second", "both")), neither)
    return joined.select("lang_no", "source", "item", F.when(F.col("kept") > 0, value).otherwise(F.lit(0)).cast("long").alias("value"))


def source_divergence(
    docs: DataFrame, min_documents: int = MIN_DOCUMENTS, term_ranks: int = TERM_RANKS,
    text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
) -> DataFrame:
    """How far the sources of each language lie apart, and by which terms: lang, source, part, item, value, rank.

    Null text, language and source are read as ''.  Part ``pair`` has every
    other source of the language as item, part ``term`` the source's
    `term_ranks` terms that it uses more than its language does.  Ranks go by
    value, the largest first, then by the item's bytes.  A source without
    terms counts as one with all counts 0; a language without kept terms has
    pairs of value 0 and no terms.  Repeated rows count as often as they
    stand there.  No rows give no rows.

    The driver holds the list of languages (one row a language) and, while
    it is fitted, one language's vocabulary; the models of up to 16 languages
    are sent to the tasks at once.
    """
    spark = docs.sparkSession
    names = [r[0] for r in docs.select(F.coalesce(quoted(lang_col).cast("string"), F.lit("")).alias("lang")).distinct().collect()]
    numbers = {name: no for no, name in enumerate(sorted(names))}
    languages = spark.createDataFrame([(no, name) for name, no in numbers.items()], "lang_no int, lang string")
    rows = _rows(docs, text_col, lang_col, source_col)
    frequent = durable(_frequent(rows, min_documents))
    none = spark.range(0).selectExpr("0 AS lang_no", "'' AS source", "0 AS idx", "id AS count", "'' AS term")
    sums, words = [none.drop("term")], [none.select("lang_no", "idx", "term")]
    for at in range(0, len(names), LANGUAGES):
        vectors, fitted = _terms(rows.where(F.col("lang").isin(names[at:at + LANGUAGES]))), []
        for name in names[at:at + LANGUAGES]:
            no, own = numbers[name], F.col("lang") == name
            model = _fitted(frequent.where(own).select("terms"), min_documents, no)
            if model is not None:
                model.setInputCol(f"t{no}")
                vectors = model.transform(vectors.withColumn(f"t{no}", F.when(own, F.col("terms")).otherwise(F.array().cast("array<string>"))))
                words.append(_vocabulary(spark, model).select(F.lit(no).alias("lang_no"), "idx", "term"))
                fitted.append(no)
        if fitted:
            sums.append(durable(_sums(vectors.select("source", *[f"v{no}" for no in fitted]), fitted)))
    # Dealt by term once: sums by source and lists by term then need no further exchange.
    counts = reduce(DataFrame.unionByName, sums).repartition("lang_no", "idx").groupBy("lang_no", "idx", "source").agg(F.sum("count").alias("count"))
    words = durable(reduce(DataFrame.unionByName, words))
    kept = words.groupBy("lang_no").agg(F.count(F.lit(1)).alias("kept"))
    counts = durable(counts)
    all_groups = rows.select("lang", "source").distinct().join(languages, "lang").select("lang_no", "source")
    totals = counts.groupBy("lang_no", "source").agg(F.sum("count").alias("total"), F.count(F.lit(1)).alias("held"))
    groups = all_groups.join(totals, ["lang_no", "source"], "left").join(kept, "lang_no", "left").na.fill(0, ["total", "held", "kept"])
    size = F.col("total") + F.col("kept")
    groups = durable(groups.select(
        "*", F.row_number().over(Window.orderBy("lang_no", "source")).alias("gid"),
        F.when(size > 0, mass(F.lit(0), size)).otherwise(F.lit(1)).alias("p0"), size.alias("size"),
    ))
    of_languages = groups.groupBy("lang_no").agg(F.sum("total").alias("n"), F.max("kept").alias("v"))
    facts = groups.join(of_languages, "lang_no").select("lang_no", "source", "gid", "p0", "size", (F.col("n") + F.col("v")).alias("lang_size"))
    counts = counts.join(facts, ["lang_no", "source"]).select(
        "lang_no", "idx", "gid", "count", mass(F.col("count"), F.col("size")).alias("p"), "p0", F.col("lang_size").alias("size")
    )
    found = durable(_evaluated(counts.repartition("lang_no", "idx").sortWithinPartitions("lang_no", "idx"), term_ranks))
    both = found.where("kind = 0").groupBy("a", "b").agg(F.sum("value").alias("both"))
    pairs = _of_pairs(counts.select("gid", "p"), groups, both)
    valued = found.where("kind = 1").select(F.col("a").alias("gid"), F.col("b").alias("idx"), "value")
    # Ties stay in until terms are known.
    in_question = valued.withColumn("place", F.rank().over(Window.partitionBy("gid").orderBy(F.desc("value")))).where(F.col("place") <= term_ranks)
    named = in_question.join(groups.select("gid", "lang_no", "source"), "gid").join(words, ["lang_no", "idx"])
    by_term = named.select("lang_no", "source", F.col("term").alias("item"), "value")
    order = Window.partitionBy("lang_no", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.withColumn("rank", F.row_number().over(order)).withColumn("part", F.lit("pair"))
    by_term = by_term.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= term_ranks).withColumn("part", F.lit("term"))
    return pairs.unionByName(by_term).join(languages, "lang_no").select("lang", "source", "part", "item", "value", "rank")


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(read_table(spark, sf_dir, "documents"))


OP13_SQL = r"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         row_number() OVER () AS row_no FROM documents),
said AS (
  SELECT lang, source, row_no, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
kept AS (SELECT lang, term FROM said GROUP BY lang, term HAVING count(DISTINCT row_no) >= 3),
sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
counts AS (SELECT lang, source, term, count(*) AS c FROM said JOIN kept USING (lang, term) GROUP BY ALL),
grps AS (SELECT DISTINCT lang, source FROM docs),
totals AS (
  SELECT g.lang, g.source, coalesce(max(v), 0) AS v, coalesce(sum(c), 0)::BIGINT AS n
  FROM grps g LEFT JOIN sizes USING (lang) LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source GROUP BY g.lang, g.source),
dense AS (
  SELECT t.lang, t.source, k.term, coalesce(c.c, 0) AS c,
         (1 + (1000000000::HUGEINT * (coalesce(c.c, 0) + 1)) // (t.n + t.v))::BIGINT AS p
  FROM totals t JOIN kept k USING (lang) LEFT JOIN counts c ON c.lang = t.lang AND c.source = t.source AND c.term = k.term),
langs AS (
  SELECT lang, term, (1 + (1000000000::HUGEINT * (sum(c) + 1)) // (any_value(n) + any_value(v)))::BIGINT AS q
  FROM counts JOIN (SELECT lang, sum(n) AS n, max(v) AS v FROM totals GROUP BY lang) USING (lang) GROUP BY lang, term),
summed AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p)::BIGINT AS value
  FROM dense a JOIN dense b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
  FROM grps a JOIN grps b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN summed s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (
  SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q)) // q AS value
  FROM dense JOIN langs USING (lang, term) WHERE c > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""
