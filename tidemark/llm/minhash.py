"""Near-duplicate texts by fast similarity sketching, banding and exact verification.

A sketch has a fixed number of coordinates.  In each round every shingle is
thrown into one bin; a bin keeps the least hash of the first round that hit it.
Rounds go on until no bin is empty, which the later rounds force, as round
i throws everything into bin i.  Agreement of two sketches is concentrated
around the similarity of the sets as in sampling without replacement.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, partitions, quoted, read_table, whole_rows
from tidemark.llm.components import connected_components
from tidemark.operators.skew import join_to_groups
from tidemark.session import durable

#: 32 bands of 5: a pair of similarity 0.8 shares no band with probability 3e-6, one of 0.85 with 7e-9.
BANDS, ROWS = 32, 5
COORDINATES = BANDS * ROWS
#: Members of a bucket that one task compares with as many others, and the summed size of their sets.
CELL, CELL_ITEMS = 2_000, 400_000
#: Bits of the bitmap that holds back texts before their sets are made.
BITMAP = 1 << 24
CACHED_WORDS = 500_000
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
U64 = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit over the output."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) >= CACHED_WORDS:
            self.clear()
        if len(word) <= 64:
            self[word] = value
        return value


def shingles(text: str | None, width: int, words: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the text's `width`-word shingles.

    A-Z count as a-z.  A text with fewer words is one shingle, a text without
    words has none.
    """
    parts = (text or "").encode().translate(LOWER).split()
    if not parts:
        return np.empty(0, U64)
    hashes = np.fromiter(map(words.__getitem__, parts), U64, len(parts))
    width = min(width, len(parts))
    last = len(parts) - width + 1
    out = np.full(last, U64(width))
    for i in range(width):
        out = mix(out * U64(0x9E3779B97F4A7C15) + hashes[i:i + last])
    return np.unique(out)


_ROUND = mix(np.arange(1, 2 * COORDINATES + 1, dtype=U64) * U64(0xD1342543DE82EF95))


def sketch(items: np.ndarray) -> np.ndarray:
    """The coordinates of a non-empty set; equal coordinates mean the same least item."""
    best = np.full(COORDINATES, np.iinfo(np.uint64).max, U64)
    at = 0
    while at < 2 * COORDINATES:
        rounds = min(2 * COORDINATES - at, max(1, 2 * COORDINATES // len(items)))
        numbers = np.arange(at, at + rounds, dtype=U64)[:, None]
        hashes = mix(items[None, :] ^ _ROUND[at:at + rounds, None])
        bins = (hashes >> U64(32)) % U64(COORDINATES)
        forced = numbers >= COORDINATES
        if forced.any():
            bins = np.where(forced, numbers - U64(COORDINATES), bins)
        values = (numbers << U64(54)) | (mix(hashes) >> U64(10))
        np.minimum.at(best, bins.ravel().astype(np.int64), values.ravel())
        at += rounds
        if best.max() != np.iinfo(np.uint64).max:
            break
    return best


_BAND = mix(np.arange(7, 7 + COORDINATES, dtype=U64)).reshape(BANDS, ROWS) | U64(1)


def bands_of(coordinates: np.ndarray) -> np.ndarray:
    return mix((mix(coordinates).reshape(BANDS, ROWS) * _BAND).sum(axis=1, dtype=U64) + _BAND[:, 0]).view(np.int64)


def marks_of(coordinates: np.ndarray) -> bytes:
    """One byte of each coordinate: what rejects hopeless pairs before sets are moved."""
    return (mix(coordinates) >> U64(56)).astype(np.uint8).tobytes()


def least_agreement(percent: int) -> int:
    """Coordinates on which a pair at the similarity agrees but for odds of about 1e-12.

    Seven standard deviations of independent draws below the mean; the
    sketch's are narrower.  Agreeing bytes of different coordinates only
    let more pairs through.
    """
    s = percent / 100
    return max(1, int(COORDINATES * s - 7 * (COORDINATES * s * (1 - s)) ** 0.5))


def node_of(text: Column) -> Column:
    """16 bytes that stand for a text; a null text is the empty text."""
    return F.substring(F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)), 1, 16)


def _sketched(docs: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    def run(batches):
        words = WordHashes()
        for batch in batches:
            sizes, bands, marks = [], [], []
            for text in batch.column("text").to_pylist():
                items = shingles(text, width, words)
                sizes.append(len(items))
                if len(items):
                    found = sketch(items)
                    bands.append(bands_of(found))
                    marks.append(marks_of(found))
                else:
                    bands.append(None)
                    marks.append(None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("node"), pa.array(sizes, pa.int64()),
                 pa.array(bands, pa.list_(pa.int64())), pa.array(marks, pa.binary())],
                names=["id", "node", "n", "bands", "marks"],
            )

    text = quoted(text_col).cast("string")
    rows = docs.select(quoted(id_col).cast("long").alias("id"), node_of(text).alias("node"), text.alias("text"))
    return rows.mapInArrow(run, "id bigint, node binary, n bigint, bands array<bigint>, marks binary")


def _may_link(left: str, right: str, percent: int) -> Column:
    """Set sizes alone allow the similarity."""
    a, b = F.col(f"{left}.n"), F.col(f"{right}.n")
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _agreeing(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """`pairs` (a, b) whose sizes and marks allow a link."""
    least = least_agreement(percent)

    def run(batches):
        for batch in batches:
            left = np.frombuffer(b"".join(batch.column("ma").to_pylist()), np.uint8).reshape(-1, COORDINATES)
            right = np.frombuffer(b"".join(batch.column("mb").to_pylist()), np.uint8).reshape(-1, COORDINATES)
            keep = pa.array((left == right).sum(axis=1) >= least)
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], names=["a", "b"])

    small = nodes.select("node", "n", "marks")
    both = (
        pairs.alias("p").join(small.alias("x"), F.col("p.a") == F.col("x.node"))
        .join(small.alias("y"), F.col("p.b") == F.col("y.node")).where(_may_link("x", "y", percent))
        .select("p.a", "p.b", F.col("x.marks").alias("ma"), F.col("y.marks").alias("mb"))
    )
    return both.mapInArrow(run, "a binary, b binary")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """`pairs` (a, b) with 100 * intersection >= percent * union on the full sets."""

    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("xs").to_pylist(), batch.column("ys").to_pylist()):
                x, y = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], names=["a", "b"])

    both = (
        pairs.alias("p").join(sets.alias("x"), F.col("p.a") == F.col("x.node"))
        .join(sets.alias("y"), F.col("p.b") == F.col("y.node"))
        .select("p.a", "p.b", F.col("x.items").alias("xs"), F.col("y.items").alias("ys"))
    )
    return both.mapInArrow(run, "a binary, b binary")


def _sets(docs: DataFrame, wanted: DataFrame, width: int, text_col: str) -> DataFrame:
    """Full sets of the texts whose node is in `wanted`: (node, items as sorted 64-bit numbers).

    A bitmap of the wanted nodes, of `BITMAP` bits at any size, holds back
    most other texts before texts are shuffled.
    """

    def run(batches):
        words = WordHashes()
        for batch in batches:
            items = [shingles(t, width, words).astype("<u8").tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(items, pa.binary())], names=["node", "items"])

    text = quoted(text_col).cast("string")
    bit = F.pmod(F.xxhash64("node"), F.lit(BITMAP))
    word, mask = F.shiftright(bit, 6).alias("word"), F.expr("shiftleft(1L, cast(bit % 64 as int))")
    bitmap = wanted.withColumn("bit", bit).groupBy(word).agg(F.bit_or(mask).alias("bits"))
    texts = docs.select(node_of(text).alias("node"), text.alias("text")).withColumn("bit", bit).withColumn("word", word)
    texts = texts.join(F.broadcast(durable(bitmap)), "word").where(F.col("bits").bitwiseAND(mask) != 0)
    texts = texts.groupBy("node").agg(F.first("text").alias("text"))
    return texts.join(wanted, "node", "left_semi").mapInArrow(run, "node binary, items binary")


def joining_links(cell: pd.DataFrame, percent: int) -> list[tuple[bytes, bytes]]:
    """Links of a cell that join components: each asking row against all others, on full sets.

    Rows have node, component, n, marks, items and asks.  What a link has
    joined is one component from then on, so there are fewer links than rows.
    """
    least = least_agreement(percent)
    labels, inverse = np.unique(cell.component.to_numpy(object), return_inverse=True)
    root = np.arange(len(labels))
    items = [np.frombuffer(i, "<u8") for i in cell["items"]]
    sizes = np.array([len(i) for i in items])
    begin = np.cumsum(sizes) - sizes
    codes = np.unique(np.concatenate(items), return_inverse=True)[1]
    here = np.zeros(codes.max() + 1, bool)
    marks = np.frombuffer(b"".join(cell.marks), np.uint8).reshape(-1, COORDINATES)
    nodes, asks = cell.node.to_numpy(object), cell.asks.to_numpy(bool)
    others = np.flatnonzero(~asks)
    links = []
    for one in np.flatnonzero(asks):
        n = sizes[one]
        fits = others[root[inverse[others]] != root[inverse[one]]]
        fits = fits[np.minimum(sizes[fits], n) * 100 >= np.maximum(sizes[fits], n) * percent]
        fits = fits[(marks[fits] == marks[one]).sum(axis=1) >= least]
        if not len(fits):
            continue
        mine = codes[begin[one]:begin[one] + n]
        here[mine] = True
        ends = np.cumsum(sizes[fits])
        at = np.arange(ends[-1]) + np.repeat(begin[fits] - ends + sizes[fits], sizes[fits])
        common = np.add.reduceat(here[codes[at]].astype(np.int64), ends - sizes[fits])
        here[mine] = False
        for other in fits[100 * common >= percent * (n + sizes[fits] - common)]:
            x, y = root[inverse[one]], root[inverse[other]]
            if x != y:
                root[root == y] = x
                links.append((nodes[one], nodes[other]))
    return links


def _rest_of_buckets(members: DataFrame, components: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) on full sets that stars through the leaders have left open, as far as they join components.

    Buckets with the same leader, in whatever band, are one group.  In each
    group the members outside the leader's component are compared with all
    others of another component: a grid of cells, dealt by the summed sizes of
    the sets, in each of which sets meet as arrays.  A cell returns fewer
    links than it has rows.
    """
    pairs = members.select("leader", "node").distinct()
    labelled = pairs.alias("m").join(components.alias("c"), F.col("m.node") == F.col("c.node"), "left").select(
        "m.leader", "m.node", F.coalesce("c.component", "m.node").alias("component")
    )
    labelled = labelled.alias("m").join(components.alias("c"), F.col("m.leader") == F.col("c.node"), "left").select(
        "m.leader", "m.node", "m.component", (F.col("m.component") != F.coalesce("c.component", "m.leader")).alias("stray")
    )
    labelled = durable(labelled.join(nodes.select("node", "n", "marks"), "node"))

    def cells(rows, size):
        return F.greatest(F.ceil(rows / CELL), F.ceil(size / CELL_ITEMS)).cast("int")

    stray = F.col("stray").cast("long")
    open_ = labelled.groupBy("leader").agg(
        F.count(F.lit(1)).alias("group_rows"), F.sum("n").alias("size"), F.sum(stray).alias("strays"), F.sum(stray * F.col("n")).alias("stray_size")
    ).where("strays > 0").select(
        "leader", "group_rows", cells(F.col("group_rows"), F.col("size")).alias("columns"), cells(F.col("strays"), F.col("stray_size")).alias("rows")
    )
    rows = join_to_groups(labelled, open_, ["leader"], "node").join(sets, "node").select(
        "*", F.pmod(F.xxhash64("node", "leader"), F.col("rows")).cast("int").alias("row"),
        F.pmod(F.xxhash64("leader", "node"), F.col("columns")).cast("int").alias("column"),
    )
    base = ["leader", "node", "component", "marks", "items"]
    asking = rows.where("stray").select(*base, F.lit(True).alias("asks"), "row", F.explode(F.sequence(F.lit(0), F.col("columns") - 1)).alias("column"))
    asked = rows.select(*base, F.lit(False).alias("asks"), F.explode(F.sequence(F.lit(0), F.col("rows") - 1)).alias("row"), "column")

    def compare(cell: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(joining_links(cell, percent), columns=["a", "b"])

    key = ["leader", "row", "column"]
    # A fixed number of tasks: cells take long for the bytes they have.
    dealt = asking.unionByName(asked).repartition(4 * partitions(members.sparkSession), *key)
    return dealt.groupBy(*key).applyInPandas(compare, "a binary, b binary")


def near_duplicates(
    docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: id, ``node``, ``n_shingles``, ``component_id``, ``kept``.

    Texts are linked if 100 * intersection >= `percent` * union of their sets
    of `width`-word shingles.  Candidates share a band of their sketches.  All
    texts of a bucket are compared with one of them; those that this does not
    join are compared with every other of the bucket.  All links rest on
    full sets.  Equal texts are one node.  ``component_id`` is the least id
    reachable by links, ``kept`` marks the row that carries it.  A null text
    or one without words is linked with nothing, not even its copies: its
    component is its own id.  Null ids never win; if a component has no
    other, its id is null and the rows of its least node count as kept.  Rows that repeat id and
    text get the same answer.  No rows give no rows.
    """
    sketched = durable(_sketched(docs, width, id_col, text_col))
    nodes = durable(
        sketched.where("n > 0").groupBy("node").agg(
            F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("marks").alias("marks")
        )
    )
    banded = nodes.select("node", F.explode("bands").alias("band"))
    buckets = banded.groupBy("band").agg(F.min("node").alias("leader"), F.count(F.lit(1)).alias("group_rows")).where("group_rows > 1")
    members = durable(join_to_groups(banded, buckets, ["band"], "node"))
    stars = members.where("node != leader").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()
    stars = durable(_agreeing(stars, nodes, percent))
    sets = durable(_sets(docs, members.select("node").distinct(), width, text_col))
    links = durable(_verified(stars, sets, percent))
    components = connected_components(links)
    more = durable(_rest_of_buckets(members, durable(components), nodes, sets, percent))
    if not more.isEmpty():
        components = connected_components(links.unionByName(more))
    rows = sketched.alias("s").join(durable(components).alias("c"), F.col("s.node") == F.col("c.node"), "left").select(
        "s.id", "s.node", "s.n", F.coalesce("c.component", "s.node").alias("component")
    )
    rows = durable(rows)
    linked = rows.where("n > 0")
    least = linked.groupBy("component").agg(F.min("id").alias("component_id"), F.count(F.lit(1)).alias("group_rows"))
    out = join_to_groups(linked.withColumn("spread", F.coalesce("id", F.lit(0))), least, ["component"], "spread").drop("spread")
    # Without words: a component of its own.
    out = out.unionByName(rows.where("n = 0").withColumn("component_id", F.col("id")))
    return out.select(
        F.col("id").alias(id_col), "node", F.col("n").alias("n_shingles"), "component_id",
        F.when(F.col("component_id").isNull() & (F.col("n") > 0), F.col("node") == F.col("component"))
        .otherwise(F.col("id").eqNullSafe(F.col("component_id"))).alias("kept"),
    )


def drop_near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of `docs` with one document of each component, with all columns.

    Documents without words all stay.  Rows that repeat id and text of the one
    that stays leave one of them.
    """
    found = near_duplicates(docs, width, percent)
    winners = durable(found.where("kept and n_shingles > 0").select("node", F.col("doc_id").alias("winner")).distinct())
    rows = whole_rows(
        docs, _id=quoted("doc_id").cast("long"), _node=node_of(quoted("text").cast("string")),
        _words=F.coalesce(quoted("text").cast("string").rlike(WORD), F.lit(False)),
    )
    same = (F.col("d._node") == F.col("w.node")) & F.col("d._id").eqNullSafe(F.col("w.winner"))
    one = rows.where("_words").alias("d").join(winners.alias("w"), same, "left_semi").dropDuplicates(["_node"])
    return one.select("_row.*").unionByName(rows.where("not _words").select("_row.*"))


def digest16(data: bytes) -> bytes:
    """What `node_of` gives for a text, for tests and other tools."""
    return hashlib.sha256(data).digest()[:16]


def op8_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(read_table(spark, sf_dir, "documents"), width=3, percent=85)
    return found.select("doc_id", "n_shingles", "component_id", "kept")
