"""Personal data: fixed kinds, and terms that give the people behind them away.

Mail and network addresses, cards and phone numbers are found by their form;
each distinct value is a protected entity.  How much a term reveals of an
entity is taken from co-occurrence over the whole corpus, as the share of the
entity's information that the term's presence in a document conveys:

    log(n(entity, term) * N / (n(entity) * n(term))) / log(N / n(entity))

where n counts documents that hold the entity, or the term anywhere.  1 means
that the term occurs only with the entity.  Wherever a document that holds the
entity mentions a term at or above the threshold, the term is replaced by its
general shape if that shape reveals less than the threshold, else it is
removed.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import quoted, read_table, slices, type_of
from tidemark.operators.skew import join_to_groups
from tidemark.session import durable

#: Kinds in the order in which spans at one place are listed.
KINDS = ("email", "ip", "card", "phone", "general", "removed")
#: Documents in which an entity and a term must meet before their share is an estimate.
LEAST_JOINT = 3
#: Share of an entity's information that a term may reveal.
THRESHOLD = 0.8
#: Terms in question, up to which every task gets their set; above, they are joined.
TERM_SET = 200_000
#: Counts a task holds before it hands them over.
HELD = 300_000

EMAIL_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
EMAIL_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# Numbers joined by dots, as many as there are; each four of them in turn are a match of the form.
DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGITS = re.compile(r"[0-9]")
TERM = re.compile(r"[^\W_]+")


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of the address form, found from each @ to the left."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in EMAIL_LOCAL:
            start -= 1
        if start < at and (m := EMAIL_DOMAIN.match(text, at)):
            out.append((start, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    return out


def addresses(numbers: str, at: int) -> list[tuple[int, int]]:
    """Each four of the dotted `numbers` in turn, if none is over 255."""
    parts, out = numbers.split("."), []
    for i in range(0, len(parts), 4):
        four = parts[i:i + 4]
        end = at + sum(map(len, four)) + len(four) - 1
        if len(four) == 4 and all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in four):
            out.append((at, end))
        at = end + 1
    return out


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(DIGITS.findall(text))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start and then kind; matches that fail a check are dropped."""
    out = [("email", a, b) for a, b in emails(text)]
    for m in DOTTED.finditer(text):
        if m[0].count(".") >= 3:
            out += [("ip", a, b) for a, b in addresses(m[0], m.start())]
    for m in CARD.finditer(text):
        if m.end() - m.start() <= 37:  # 19 digits with a separator between any two
            digits = _digits(m[0])
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
    for m in PHONE.finditer(text):
        if 9 <= len(_digits(m[0])) <= 15:
            out.append(("phone", *m.span()))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def entity_of(kind: str, value: str) -> int:
    """A signed 64-bit number for a value, alike however it is written."""
    plain = value.lower() if kind == "email" else value if kind == "ip" else _digits(value)
    return xxhash.xxh3_64_intdigest(f"{kind}:{plain}".encode()) - (1 << 63)


def shape_of(term: str) -> str:
    """What a term is generalised to: its sort of letters and its rough length."""
    sort = "number" if term.isdigit() else "code" if any(c.isdigit() for c in term) else "name" if term[:1].isupper() else "word"
    return f"{sort}{min(3, (len(term) + 3) // 4)}"


def outside(text: str, spans: list[tuple[int, int]]) -> Iterator[re.Match]:
    """The words of a text that touch none of the spans, which are given by start."""
    starts, ends = [], []  # the spans as stretches that do not overlap
    for start, end in spans:
        if ends and start <= ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            starts.append(start)
            ends.append(end)
    for m in TERM.finditer(text):
        i = bisect_right(ends, m.start())  # the first stretch that ends after the word begins
        if i == len(ends) or starts[i] >= m.end():
            yield m


def _found(docs: DataFrame, id_col: str, text_col: str, with_text: bool) -> DataFrame:
    """One row per document: key, id, base spans with their entities, the text if it has spans or is asked for.

    The key numbers the rows within the tasks of this one write.
    """
    span = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64()), ("entity", pa.int64())])

    def run(batches):
        key = TaskContext.get().partitionId() << 40
        for batch in batches:
            keys, spans, texts = [], [], []
            for text in batch.column("text").to_pylist():
                base = base_spans(text or "")
                keys.append(key)
                key += 1
                spans.append([{"start": a, "kind": KINDS.index(k), "end": b, "entity": entity_of(k, text[a:b])} for k, a, b in base])
                texts.append(text if base or with_text else None)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), batch.column("id"), pa.array(spans, pa.list_(span)), pa.array(texts, pa.string())],
                names=["key", "id", "spans", "text"],
            )

    rows = docs.select(quoted(id_col).alias("id"), quoted(text_col).cast("string").alias("text"))
    return rows.mapInArrow(
        run, f"key bigint, id {type_of(rows, 'id')}, spans array<struct<start:bigint,kind:int,end:bigint,entity:bigint>>, text string"
    )


def _words(texts: DataFrame) -> DataFrame:
    """(key, term, shapes): each distinct word of each text, with the shapes of its spellings."""

    def run(batches):
        for batch in slices(batches):
            keys, terms, shapes = [], [], []
            for key, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist()):
                forms: dict = {}
                for word in set(TERM.findall(text)):
                    forms.setdefault(word.lower(), set()).add(shape_of(word))
                keys += [key] * len(forms)
                terms += forms
                shapes += map(sorted, forms.values())
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(terms, pa.string()), pa.array(shapes, pa.list_(pa.string()))],
                names=["key", "term", "shapes"],
            )

    return texts.select("key", "text").mapInArrow(run, "key bigint, term string, shapes array<string>")


def _document_counts(docs: DataFrame, terms: DataFrame, text_col: str) -> DataFrame:
    """(word, is_shape, n): documents that hold each term in question, and each shape, over all documents.

    Few terms go to every task as a set; many are joined to the words of all
    documents.  Both ways count the same.
    """
    wanted = durable(terms.select("term").distinct())
    few = wanted.count() <= TERM_SET
    chosen = frozenset(r.term for r in wanted.collect()) if few else None
    shared = docs.sparkSession.sparkContext.broadcast(chosen)

    def run(batches):
        chosen, words, shapes, looks = shared.value, Counter(), Counter(), {}

        def hand_over():
            both = [(w, False, n) for w, n in words.items()] + [(s, True, n) for s, n in shapes.items()]
            words.clear()
            shapes.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([b[0] for b in both], pa.string()), pa.array([b[1] for b in both], pa.bool_()),
                 pa.array([b[2] for b in both], pa.int64())], names=["word", "is_shape", "n"],
            )

        for batch in batches:
            for text in batch.column("text").to_pylist():
                seen = set(TERM.findall(text or ""))
                if len(looks) > HELD:
                    looks.clear()
                looks.update({t: shape_of(t) for t in seen if t not in looks})
                shapes.update({looks[t] for t in seen})
                lower = {t.lower() for t in seen}
                words.update(lower if chosen is None else lower & chosen)
                if len(words) > HELD:
                    yield hand_over()
        yield hand_over()

    rows = docs.select(quoted(text_col).cast("string").alias("text"))
    counted = rows.mapInArrow(run, "word string, is_shape boolean, n bigint")
    if not few:
        words = counted.where("not is_shape").join(wanted, F.col("word") == F.col("term"), "left_semi")
        counted = counted.where("is_shape").unionByName(words)
    return counted.groupBy("word", "is_shape").agg(F.sum("n").alias("n"))


def _share(both: Column, entity: Column, word: Column, total: int) -> Column:
    """Share of the entity's information that the word conveys; 0 for an entity in every document."""
    share = F.log(both * F.lit(float(total)) / (entity * word)) / F.log(F.lit(float(total)) / entity)
    return F.when(entity < total, share).otherwise(F.lit(0.0))


def _most_documents(n_entity: int, total: int, threshold: float) -> float:
    """Documents above which no term conveys the threshold of an entity with up to `n_entity` documents."""
    if not 0 < threshold <= 1 or not n_entity:
        return float(total)
    return n_entity * (total / n_entity) ** (1 - threshold) + 1


def _revealing(found: DataFrame, docs: DataFrame, text_col: str, threshold: float, least_joint: int) -> DataFrame:
    """(key, more): mentions of terms to be generalised or removed, as spans (start, kind, end)."""
    total = found.count()
    held = found.where(F.size("spans") > 0)
    holds = held.select("key", F.explode(F.array_distinct(F.transform("spans", lambda x: x["entity"]))).alias("entity"))
    # Only an entity of so many documents can meet a term in as many.
    frequent = holds.groupBy("entity").agg(F.count(F.lit(1)).alias("n_entity")).where(F.col("n_entity") >= least_joint)
    holds = durable(join_to_groups(holds, frequent.withColumn("group_rows", F.col("n_entity")), ["entity"], "key"))
    words = durable(_words(held.join(holds.select("key").distinct(), "key", "left_semi")))
    asked = durable(words.groupBy("term").agg(F.count(F.lit(1)).alias("group_rows")).where(F.col("group_rows") >= least_joint))
    counts = durable(_document_counts(docs, asked, text_col))
    n_word = F.col("n").alias("n_word")
    # No entity meets a term in more documents than it has, so this bounds the share from above.
    most = _share(F.col("n_entity"), F.col("n_entity"), F.col("n_word"), total)
    top = holds.agg(F.max("n_entity")).first()[0] or 0
    terms = asked.join(counts.where("not is_shape").select(F.col("word").alias("term"), n_word), "term")
    pairs = join_to_groups(words, terms.where(F.col("n_word") <= _most_documents(top, total, threshold)), ["term"], "key")
    pairs = durable(pairs.join(holds, "key").where(most >= threshold - 1e-9))
    terms = durable(
        pairs.groupBy("entity", "term", "n_entity", "n_word").agg(F.count(F.lit(1)).alias("n_both"))
        .where((F.col("n_both") >= least_joint) & (_share(F.col("n_both"), F.col("n_entity"), F.col("n_word"), total) >= threshold))
        .select("entity", "term", F.col("n_both").alias("group_rows"))
    )
    shapes = (
        words.select("key", F.explode("shapes").alias("shape")).distinct()
        .join(holds.join(terms.select("entity").distinct(), "entity", "left_semi"), "key")
        .groupBy("entity", "shape", "n_entity").agg(F.count(F.lit(1)).alias("n_both"))
        .join(counts.where("is_shape").select(F.col("word").alias("shape"), n_word), "shape")
        .select("entity", "shape", F.col("n_both").alias("group_rows"),
                (_share(F.col("n_both"), F.col("n_entity"), F.col("n_word"), total) < threshold).alias("harmless"))
    )
    flagged = join_to_groups(pairs, terms, ["entity", "term"], "key").select("key", "entity", "term", F.explode("shapes").alias("shape"))
    judged = join_to_groups(flagged, shapes, ["entity", "shape"], "key")
    kind = F.when(F.col("harmless"), F.lit(KINDS.index("general"))).otherwise(F.lit(KINDS.index("removed")))
    # With two entities, the stricter treatment.
    rules = durable(
        judged.groupBy("key", "term", "shape").agg(F.max(kind).cast("int").alias("kind"))
        .groupBy("key").agg(F.collect_list(F.struct("term", "shape", "kind")).alias("rules"))
    )

    def run(batches):
        for batch in slices(batches):
            more = []
            for text, spans, rules in zip(*(batch.column(c).to_pylist() for c in ("text", "spans", "rules"))):
                kinds = {(r["term"], r["shape"]): r["kind"] for r in rules}
                terms = {r["term"] for r in rules}
                more.append([
                    {"start": m.start(), "kind": kinds[t, shape_of(m[0])], "end": m.end()}
                    for m in outside(text, [(s["start"], s["end"]) for s in spans]) if (t := m[0].lower()) in terms
                ])
            kind = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(more, kind)], names=["key", "more"])

    texts = held.select("key", "text", "spans").join(rules, "key").select("key", "text", "spans", "rules")
    return texts.mapInArrow(run, "key bigint, more array<struct<start:bigint,kind:int,end:bigint>>")


def personal_spans(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
    least_joint: int = LEAST_JOINT, with_text: bool = False,
) -> DataFrame:
    """One row per document: id, ``spans`` (start, kind, end), and its text if asked for.

    Spans are code points, by start and then kind; ``kind`` numbers `KINDS`.
    Spans of the base kinds never depend on other documents.  Those of
    terms do: counts are taken over all rows, copies included.  A null text
    is the empty text without spans.  Ids may be null or repeat; no rows give
    no rows.
    """
    found = durable(_found(docs, id_col, text_col, with_text))
    more = _revealing(found, docs, text_col, threshold, least_joint)
    base = F.transform("spans", lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end")))
    empty = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    rows = found.join(more, "key", "left").select(
        F.col("id").alias(id_col), F.array_sort(F.concat(base, F.coalesce("more", empty))).alias("spans"), "text"
    )
    return rows if with_text else rows.drop("text")


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """The clean texts: id, ``spans``, ``clean_text``.

    A base span becomes its kind in brackets, a generalised term its shape, a
    removed one goes.  Where spans overlap the first one speaks for all.  A
    null text becomes the empty text.
    """

    def run(batches):
        for batch in batches:
            out = []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                text, parts, at = text or "", [], 0
                for span in spans:
                    if span["start"] >= at:
                        kind = KINDS[span["kind"]]
                        old = text[span["start"]:span["end"]]
                        parts += [text[at:span["start"]], "" if kind == "removed" else f"[{shape_of(old) if kind == 'general' else kind}]"]
                    at = max(at, span["end"])
                out.append("".join([*parts, text[at:]]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("spans"), pa.array(out, pa.string())], names=["id", "spans", "clean_text"]
            )

    rows = personal_spans(docs, id_col, text_col, with_text=True, **settings).withColumnRenamed(id_col, "id")
    kind = f"id {type_of(rows, 'id')}, spans array<struct<start:bigint,kind:int,end:bigint>>, clean_text string"
    return rows.select("id", "spans", "text").mapInArrow(run, kind).withColumnRenamed("id", id_col)


def spelled(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))), ","
    )


def n_spans(kind: str) -> Column:
    """Number of a row's spans of one kind."""
    number = KINDS.index(kind)  # not an argument of the lambda: Spark gives a second one the place in the array
    return F.size(F.filter("spans", lambda x: x["kind"] == number)).cast("long")


def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_spans(read_table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda x: x["kind"] < 4)
    return found.select(
        "doc_id", *[n_spans(kind).alias(f"n_{kind}") for kind in KINDS[:4]], F.sha2(spelled(base), 256).alias("base_sha256"), spelled(F.col("spans")).alias("spans")
    )
