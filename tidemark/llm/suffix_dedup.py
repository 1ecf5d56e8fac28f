"""Removal of long byte strings that occur more than once, by prefix doubling on chosen places.

Ranking every byte of the corpus would shuffle many times its size.  So the
places that are ranked are chosen by content: of each window of `length` bytes
the short string with the least hash, its anchor.  Equal windows have equal
anchors at equal distances, so two windows can only be equal if their anchors
are.  All windows with the same anchor place differ only in the distance.

The rounds are those of prefix doubling: a rank is a class of equal strings,
Spark sorts pairs of (rank so far, string at the larger offset) and ranks anew,
and what is unique is dropped.  The first rank is the anchor itself; then
windows are taken together in cells of 49, of 7 and of 1 neighbouring
distances.  A cell has an inner string, common to all its windows, and an outer
one, which holds them all.  If the outer string occurs elsewhere at the same
anchor, all its windows do; if the inner one is unique, none does; only what is
between goes on to the next round with a longer inner string, until it is the
window itself.

Ranks are hashes modulo a prime by a multiplier drawn for the run, so that no
text can be made to collide; anchors, whose choice removes nothing, use a fixed
one.  Before anything is removed the strings found equal are compared once
more by a cryptographic digest of their bytes.
"""

from __future__ import annotations

import hashlib
import secrets
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import partitions, quoted, read_table, scratch, slices
from tidemark.llm.minhash import mix, node_of
from tidemark.operators.skew import join_to_groups
from tidemark.session import durable

U64 = np.uint64
#: An odd multiplier; the hash that chooses anchors is a polynomial in it modulo 2^64, then mixed.
BASE = 0x9E3779B97F4A7C15
#: The hash that ranks is a polynomial modulo this prime.
PRIME = (1 << 61) - 1
#: Distances taken together in each round; the first is the number of places an anchor is chosen from.
CELLS = (343, 49, 7, 1)
#: Bytes of a text handled at once, next to what overlaps; a place in a portion fits in PLACE_BITS.
PORTION, PLACE_BITS = 4_000_000, 23
#: A run of windows with one anchor, and a cell of it in a later round.
RUN = "node binary, place int, low smallint, high smallint, gram bigint, outer bigint"
CELL = RUN + ", cell smallint, inner bigint, open boolean"
KINDS = {"place": np.int32, "low": np.int16, "high": np.int16, "cell": np.int16, "open": bool}


def drawn_multiplier() -> int:
    return (1 << 32) + secrets.randbelow(PRIME - (1 << 33))


def _reduced(x: np.ndarray) -> np.ndarray:
    x = (x & U64(PRIME)) + (x >> U64(61))
    return np.where(x >= U64(PRIME), x - U64(PRIME), x)


def _up32(x: np.ndarray) -> np.ndarray:
    """x * 2^32 modulo the prime, not yet reduced, for x below 2^62."""
    return (x >> U64(29)) + ((x & U64((1 << 29) - 1)) << U64(32))


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a * b modulo the prime, for numbers below it."""
    half = U64((1 << 32) - 1)
    a1, a0, b1, b0 = a >> U64(32), a & half, b >> U64(32), b & half
    low = a0 * b0
    return _reduced(((a1 * b1) << U64(3)) + _up32(a1 * b0 + a0 * b1) + (low >> U64(61)) + (low & U64(PRIME)))


class Powers:
    """Powers of both multipliers and of their inverses, grown when a longer text comes."""

    def __init__(self, multiplier: int | None = None):
        self.multiplier = drawn_multiplier() if multiplier is None else multiplier
        self.up = self.down = self.prime_up = self.prime_down = np.ones(1, U64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << (n - 1).bit_length()
            self.up = np.cumprod(np.r_[U64(1), np.full(size - 1, BASE, U64)], dtype=U64)
            self.down = np.cumprod(np.r_[U64(1), np.full(size - 1, pow(BASE, -1, 1 << 64), U64)], dtype=U64)
        return self.up[:n], self.down[:n]

    def upto_in_field(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.prime_up) < n:
            size = len(self.prime_up)
            for name, base in (("prime_up", self.multiplier), ("prime_down", pow(self.multiplier, -1, PRIME))):
                known = getattr(self, name)
                setattr(self, name, np.concatenate([known, times(known, np.full(size, pow(base, size, PRIME), U64))]))
        return self.prime_up[:n], self.prime_down[:n]


class Strings:
    """Hashes of any substrings of `data`; equal strings have equal hashes wherever they stand."""

    def __init__(self, data: bytes, powers: Powers):
        up, self.down = powers.upto(len(data) + 1)
        values = np.frombuffer(data, np.uint8).astype(U64) + U64(1)
        self.sums = np.concatenate([np.zeros(1, U64), np.cumsum(values * up[:len(data)], dtype=U64)])

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start])


class RankedStrings:
    """As `Strings`, modulo the prime and by the drawn multiplier; no hash is 0."""

    def __init__(self, data: bytes, powers: Powers):
        up, self.down = powers.upto_in_field(len(data) + 1)
        terms = times(np.frombuffer(data, np.uint8).astype(U64) + U64(1), up[:len(data)])
        # Halves are summed up apart, so that no sum of a portion overflows.
        high, low = np.cumsum(terms >> U64(32), dtype=U64), np.cumsum(terms & U64((1 << 32) - 1), dtype=U64)
        self.sums = np.concatenate([np.zeros(1, U64), _reduced(_up32(high) + low)])

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        between = _reduced(self.sums[end] + U64(PRIME) - self.sums[start])
        return times(between, self.down[start]) + U64(1)


def least_of_windows(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` neighbouring values.

    Least values of blocks from the left and from the right make the least of
    any window a matter of one comparison.
    """
    n = len(values)
    blocks = -(-n // width)
    grid = np.full(blocks * width, np.iinfo(np.uint64).max, U64)
    grid[:n] = values
    grid = grid.reshape(blocks, width)
    left = np.minimum.accumulate(grid, axis=1).ravel()
    right = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n - width + 1], left[width - 1:n])


def anchors_of(data: bytes, length: int, powers: Powers) -> list[np.ndarray]:
    """place, lowest and highest distance and hash of the anchor of each run of windows that share it.

    The anchor has the least leading bits of its hash, the first of equals:
    a choice that depends on the window's bytes alone.
    """
    gram = length - CELLS[0] + 1
    mask = U64((1 << PLACE_BITS) - 1)
    out: list[list[np.ndarray]] = [[], [], [], []]
    for at in range(0, len(data) - length + 1, PORTION):
        part = data[at:at + PORTION + length - 1]
        starts = np.arange(len(part) - gram + 1)
        hashes = Strings(part, powers).hashes(starts, starts + gram)
        least = least_of_windows((hashes & ~mask) | starts.astype(U64), CELLS[0])
        places = (least & mask).astype(np.int64)
        first = np.flatnonzero(np.r_[True, places[1:] != places[:-1]])
        last = np.r_[first[1:], len(places)] - 1
        anchor = places[first]
        for column, values in zip(out, (anchor + at, anchor - last, anchor - first, hashes[anchor].view(np.int64))):
            column.append(values)
    place, low, high, gram = (np.concatenate(c) if c else np.empty(0, np.int64) for c in out)
    # A run that the end of a portion has cut is one run.
    first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]]) if len(place) else np.empty(0, np.int64)
    last = np.r_[first[1:], len(place)] - 1 if len(place) else first
    return [place[first], low[last], high[first], gram[first]]


def cells_of(data: bytes, length: int, places: np.ndarray, cells: np.ndarray, size: int, powers: Powers):
    """Inner and outer hash of each cell: distances from ``cell * size`` on, `size` of them.

    An outer string that leaves the text, as at its ends, gets 0.  An inner
    one is cut at the ends of the text, where its windows do not exist.
    """
    inner, outer = np.zeros(len(places), np.int64), np.zeros(len(places), np.int64)
    low, high = cells * size, cells * size + size - 1
    n = len(data)
    for at in range(0, n, PORTION):
        here = np.flatnonzero((places >= at) & (places < at + PORTION))
        if not len(here):
            continue
        begin = max(0, at - CELLS[0])
        strings = RankedStrings(data[begin:at + PORTION + length], powers)
        p, lo, hi = places[here], low[here], high[here]
        start, end = np.maximum(p - lo, 0), np.minimum(p + length - hi, n)
        inner[here] = strings.hashes(start - begin, end - begin).view(np.int64)
        whole = (p - hi >= 0) & (p + length - lo <= n)
        h, start, end = here[whole], (p - hi)[whole], (p + length - lo)[whole]
        outer[h] = strings.hashes(start - begin, end - begin).view(np.int64)
    return inner, outer


def _batch(nodes: list[bytes], columns: dict[str, list[np.ndarray]]) -> pa.RecordBatch:
    arrays = [pa.array(nodes, pa.binary())] + [
        pa.array(np.concatenate(c or [np.empty(0)]).astype(KINDS.get(name, np.int64))) for name, c in columns.items()
    ]
    return pa.RecordBatch.from_arrays(arrays, names=["node", *columns])


def _runs(texts: DataFrame, length: int, multiplier: int) -> DataFrame:
    """All runs of all texts; the first rank of a run is its anchor."""

    def run(batches):
        powers = Powers(multiplier)
        for batch in slices(batches):
            nodes, columns = [], {name: [] for name in ("place", "low", "high", "gram", "outer")}
            for node, text in zip(batch.column("node").to_pylist(), batch.column("text").to_pylist()):
                data = text.encode()
                place, low, high, gram = anchors_of(data, length, powers)
                outer = cells_of(data, length, place, np.zeros(len(place), np.int64), CELLS[0], powers)[1]
                nodes += [node] * len(place)
                for column, values in zip(columns.values(), (place, low, high, gram, outer)):
                    column.append(values)
            yield _batch(nodes, columns)

    return texts.select("node", "text").mapInArrow(run, RUN)


def _next_rank(going: DataFrame, kept: DataFrame, length: int, size_before: int, size: int, multiplier: int) -> DataFrame:
    """The smaller cells of every cell that goes on."""
    fields = ("place", "low", "high", "gram", "cell", "open")
    asked = going.groupBy("node").agg(F.collect_list(F.struct(*fields)).alias("asked"))
    share = size_before // size

    def run(batches):
        powers = Powers(multiplier)
        for batch in slices(batches):
            nodes, columns = [], {name: [] for name in ("place", "low", "high", "gram", "outer", "cell", "inner", "open")}
            asked = batch.column("asked")
            for i, (node, text) in enumerate(zip(batch.column("node").to_pylist(), batch.column("text").to_pylist())):
                rows = asked[i].values
                place, low, high, gram, cell, is_open = (
                    np.repeat(rows.field(f).to_numpy(zero_copy_only=False).astype(bool if f == "open" else np.int64), share) for f in fields
                )
                cell = cell * share + np.tile(np.arange(share), len(cell) // share)
                use = (cell * size <= high) & (cell * size + size - 1 >= low)
                place, low, high, gram, cell, is_open = (x[use] for x in (place, low, high, gram, cell, is_open))
                inner, outer = cells_of(text.encode(), length, place, cell, size, powers)
                nodes += [node] * len(place)
                for column, values in zip(columns.values(), (place, low, high, gram, outer, cell, inner, is_open)):
                    column.append(values)
            yield _batch(nodes, columns)

    return kept.join(asked, "node").mapInArrow(run, CELL)


def _rank_anew(rows: DataFrame, size: int, length: int) -> tuple[DataFrame, DataFrame]:
    """(runs of starts of windows that occur elsewhere with the outer string's place, cells that go on).

    A rank is (anchor, cell, inner string); the pair with the outer string is
    the next one.  A pair that occurs twice settles all windows of its cell.
    A rank with one pair is done: its windows are settled or unique.  Where a
    rank has several pairs and one of them is open, a place of each pair goes
    on, also of settled ones, as an open window may be found in these.
    """
    rank = ["gram", "cell", "inner"]
    # An outer string that leaves the text is like no other.
    keyed = rows.withColumn("pair", F.when(F.col("outer") == 0, F.xxhash64("node", "place")).otherwise(F.col("outer")))
    pairs = durable(keyed.groupBy(*rank, "pair").agg(
        F.count(F.lit(1)).alias("times"), F.max("open").alias("open"), F.min(F.struct("node", "place", "low", "high")).alias("one"),
    ))
    settled = pairs.where("times > 1").select(*rank, "pair", F.col("times").alias("group_rows"))
    again = join_to_groups(keyed, settled, [*rank, "pair"], "place").select(
        "node", (F.col("place") - F.least("high", F.col("cell") * size + size - 1)).alias("first"),
        (F.col("place") - F.greatest("low", F.col("cell") * size)).alias("last"),
        (F.col("place") - F.col("cell") * size - (size - 1)).alias("begin"),
        (F.col("place") - F.col("cell") * size + length).alias("end"),
    )
    ranks = pairs.groupBy(*rank).agg(
        F.count(F.lit(1)).alias("group_rows"), F.max(F.col("open") & (F.col("times") == 1)).alias("any_open")
    ).where("group_rows > 1 and any_open")
    going = join_to_groups(pairs, ranks, rank, "pair").select(
        "gram", "cell", (F.col("open") & (F.col("times") == 1)).alias("open"), "one.*"
    )
    return again, going


def _proved(found: DataFrame, texts: DataFrame) -> DataFrame:
    """Those of `found` whose outer string, byte by byte, also starts elsewhere: (node, first, last).

    Only digests of the strings are moved.
    """
    fields = ("first", "last", "begin", "end")
    asked = found.groupBy("node").agg(F.collect_list(F.struct(*fields)).alias("asked"))

    def run(batches):
        for batch in slices(batches):
            nodes, columns, digests = [], {f: [] for f in fields}, []
            asked = batch.column("asked")
            for i, (node, text) in enumerate(zip(batch.column("node").to_pylist(), batch.column("text").to_pylist())):
                data, rows = text.encode(), asked[i].values
                for f in fields:
                    columns[f].append(rows.field(f).to_numpy())
                for begin, end in zip(columns["begin"][-1].tolist(), columns["end"][-1].tolist()):
                    digests.append(hashlib.blake2b(data[begin:end], digest_size=20).digest())
                nodes += [node] * len(rows)
            arrays = [pa.array(nodes, pa.binary()), *[pa.array(np.concatenate(columns[f] or [np.empty(0)]).astype(np.int32)) for f in fields[:3]]]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(digests, pa.binary())], names=["node", "first", "last", "begin", "digest"])

    rows = durable(texts.join(asked, "node").mapInArrow(run, "node binary, first int, last int, begin int, digest binary"))
    place = F.struct("node", "begin")
    equal = rows.groupBy("digest").agg(F.count(F.lit(1)).alias("group_rows"), F.min(place).alias("one"), F.max(place).alias("other"))
    return join_to_groups(rows, equal.where("one != other").select("digest", "group_rows"), ["digest"], "begin").select("node", "first", "last")


def _bucketed_texts(spark: SparkSession, docs: DataFrame, text_col: str) -> DataFrame:
    """Every distinct text once, in a table bucketed by node: the only shuffle of texts."""
    path = scratch(spark, "texts")
    table = "texts_" + path.rsplit("/", 1)[1]
    text = F.coalesce(quoted(text_col).cast("string"), F.lit(""))
    one = docs.select(node_of(text).alias("node"), text.alias("text")).dropDuplicates(["node"])
    (
        one.write.format("parquet").bucketBy(partitions(spark), "node").sortBy("node").option("path", path).saveAsTable(table)
    )
    return spark.table(table)


def repeated_windows(texts: DataFrame, length: int) -> DataFrame:
    """(node, first, last): starts of windows of distinct `texts` (node, text) that also start elsewhere."""
    long_texts = texts.where(F.octet_length("text") >= length)
    multiplier = drawn_multiplier()
    runs = durable(_runs(long_texts, length, multiplier))
    # Most anchors are unique; only their hashes are counted, and they go at once.
    often = runs.groupBy("gram").agg(F.count(F.lit(1)).alias("group_rows")).where("group_rows > 1")
    rows = join_to_groups(runs, often, ["gram"], "place").select(
        "*", F.lit(0).cast("smallint").alias("cell"), F.col("gram").alias("inner"), F.lit(True).alias("open")
    )
    rows = durable(rows)
    found = []
    for number, size in enumerate(CELLS):
        again, going = _rank_anew(rows, size, length)
        found.append(again)
        if size > 1:
            rows = durable(_next_rank(durable(going), long_texts, length, size, CELLS[number + 1], multiplier))
    return _proved(reduce(DataFrame.unionByName, found), long_texts)


def _cleaned(docs: DataFrame, length: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(id and node of every row; for every distinct text its node, rows, sizes, spans and remaining bytes)."""
    if length <= CELLS[0]:
        raise ValueError(f"length must be over {CELLS[0]}")
    texts = _bucketed_texts(docs.sparkSession, docs, text_col)
    ids = durable(docs.select(quoted(id_col).alias("id"), node_of(quoted(text_col).cast("string")).alias("node")))
    copies = ids.groupBy("node").agg(F.count(F.lit(1)).alias("group_rows"))
    runs = repeated_windows(texts, length).groupBy("node").agg(F.collect_list(F.struct("first", "last")).alias("runs"))
    facts = copies.join(runs, "node", "left")
    names = ["node", "group_rows", "n_bytes", "n_removed", "spans", "kept"]
    kinds = (pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.binary())

    def run(batches):
        for batch in slices(batches):
            columns: list[list] = [[] for _ in names]
            runs = batch.column("runs")
            for i, (node, text, rows) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("node", "text", "group_rows")))):
                data = text.encode()
                if rows > 1 and len(data) >= length:
                    spans = [(0, len(data))]
                elif runs[i].is_valid:
                    first = runs[i].values.field("first").to_numpy()
                    order = np.argsort(first, kind="stable")
                    start, end = first[order], runs[i].values.field("last").to_numpy()[order] + length
                    reach = np.maximum.accumulate(end)
                    new = np.flatnonzero(np.r_[True, start[1:] > reach[:-1]])
                    spans = list(zip(start[new].tolist(), np.r_[reach[new[1:] - 1], reach[-1]].tolist()))
                else:
                    spans = []
                kept, at = [], 0
                for a, b in spans:
                    kept.append(data[at:a])
                    at = b
                kept.append(data[at:])
                removed = sum(b - a for a, b in spans)
                for column, value in zip(columns, (node, rows, len(data), removed, [{"start": a, "end": b} for a, b in spans], b"".join(kept))):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return ids, texts.join(facts, "node").select("node", "text", "group_rows", "runs").mapInArrow(
        run, "node binary, group_rows bigint, n_bytes bigint, n_removed bigint, spans array<struct<start:bigint,end:bigint>>, kept binary"
    )


def _per_row(ids: DataFrame, cleaned: DataFrame, id_col: str) -> DataFrame:
    rows = ids.withColumn("spread", F.coalesce(F.xxhash64("id"), F.lit(0)))
    joined = join_to_groups(rows, cleaned, ["node"], "spread")
    return joined.drop("node", "spread").withColumnRenamed("id", id_col)


def drop_repeated_spans(
    docs: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Remove every byte covered by a `length`-byte string that also starts anywhere else.

    Texts are UTF-8 bytes; strings are judged on the input and never cross
    documents; overlaps count.  `length` is at least 344.  Returns one row per
    document: id, ``n_bytes``, ``n_removed``, ``spans`` (start, end of the
    maximal removed runs, in bytes) and ``kept`` (the remaining bytes).  A null
    text is the empty text.  A text that occurs in several rows goes whole
    if it is long enough, in all of them.  Ids may be null or repeat; no rows
    give no rows.
    """
    return _per_row(*_cleaned(docs, length, id_col, text_col), id_col)


def removal_digests(
    docs: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """As `drop_repeated_spans`, with the remaining bytes as a digest: those of equal texts are made once and not moved."""
    ids, cleaned = _cleaned(docs, length, id_col, text_col)
    cleaned = cleaned.select(
        "node", "group_rows", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )
    return _per_row(ids, durable(cleaned), id_col)


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removal_digests(read_table(spark, sf_dir, "documents"))
