"""Near-duplicate embeddings by sorted projection passes.

Every pass orders the vectors of a label by a string of hashes, the sides of
random hyperplanes they lie on, and compares each vector with a bounded number
of neighbours in that order.  Vectors that share the first bits of the string
form a run; a run no longer than the window is thereby compared whole, and
what the window leaves of a longer one is covered by a grid of bounded cells.
A pair is missed only if it shares no run in any pass, and the number of
passes bounds that chance, however dense its surroundings.  Cells and windows
return verified links that join what all their links join; the links of all
passes are united, and inside the components every link is then counted in
blocks.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import quoted, read_table
from tidemark.llm.components import connected_components
from tidemark.operators.skew import join_to_groups, number_rows
from tidemark.session import durable

#: Neighbours that a vector is compared with on either side of the order; places of the order in one task.
WINDOW, SPAN = 256, 4_096
#: Strangers that share a run if they are spread evenly.
TOGETHER = 128
#: Bits of a string.
BITS = 62
#: Vectors of a long run that one task compares with as many others.
BLOCK = 4_096
#: Vectors of a component that one task compares with as many others.
CELL = 1_024
#: Vectors of a component that meet its size in one task; larger ones are split.
SPLIT = 16 * CELL
#: A pair at the threshold is missed by all passes with at most this probability.
MISSED = 1e-6


def bits_for(n: int, together: int = TOGETHER) -> int:
    """Leading bits that split `n` evenly spread vectors into runs of at most `together`; a matter of cost alone."""
    return min(BITS, max(0, math.ceil(math.log2(max(1, n) / together))))


def passes_for(n: int, cosine: float, missed: float = MISSED, together: int = TOGETHER) -> int:
    """Passes in which a pair at the threshold shares no run with at most that probability.

    A bit agrees with probability 1 - angle / pi; runs are compared whole, so
    a pair that agrees on all leading bits of some pass is found.
    """
    meet = (1 - math.acos(cosine) / math.pi) ** bits_for(n, together)
    return max(4, math.ceil(math.log(missed) / math.log(1 - meet))) if meet < 1 else 4


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1 in double precision."""
    scale = np.abs(vectors).max(axis=1, keepdims=True)
    vectors = vectors / scale
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _stacked(column, size: int | None = None) -> np.ndarray:
    return np.array([np.asarray(v, dtype=np.float64) for v in column], dtype=np.float64).reshape(len(column), -1)


def _strings(vectors: np.ndarray, number: int, seed: int) -> np.ndarray:
    """The bits of pass `number` as one integer, the first of them highest."""
    planes = np.random.default_rng([seed, number, vectors.shape[1]]).standard_normal((vectors.shape[1], BITS))
    return ((vectors @ planes) >= 0) @ (np.int64(1) << np.arange(BITS - 1, -1, -1, dtype=np.int64))


def _joined(near: np.ndarray) -> list[tuple[int, int]]:
    """Entries (row, column) of a matrix of links that join whatever all of its entries join."""
    across, out = np.ascontiguousarray(near.T), []
    rows, columns = near.any(axis=1), across.any(axis=1)  # not reached yet
    for first in np.flatnonzero(rows):
        if not rows[first]:
            continue
        rows[first], todo = False, [(True, int(first))]
        while todo:
            is_row, i = todo.pop()
            fresh = np.flatnonzero(near[i] & columns if is_row else across[i] & rows)
            (columns if is_row else rows)[fresh] = False
            out += [(i, int(j)) if is_row else (int(j), i) for j in fresh]
            todo += [(not is_row, int(j)) for j in fresh]
    return out


def _orders(vectors: DataFrame, labels: DataFrame, cosine: float, seed: int) -> DataFrame:
    """The order of every pass: node, label, width, pass, run (its leading bits) and `place`, counted over all rows.

    Ids only; the vectors stay where they are.
    """
    label, together, bits_of = vectors.schema["label"].dataType.simpleString(), TOGETHER, BITS

    def key(batches):
        for batch in batches:
            widths, counts = batch.column("width").to_numpy(), batch.column("n").to_numpy()
            for width, n in sorted(set(zip(widths.tolist(), counts.tolist()))):
                part = batch.filter(pa.array((widths == width) & (counts == n)))
                unit = _unit(_stacked(part.column("vector").to_pylist()))
                for number in range(passes_for(n, cosine, together=together)):
                    strings = _strings(unit, number, seed)
                    yield pa.RecordBatch.from_arrays(
                        [part.column("node"), part.column("label"), part.column("width"),
                         pa.array(np.full(part.num_rows, number, np.int32)), pa.array(strings),
                         pa.array(strings >> np.int64(bits_of - bits_for(n, together)))],
                        names=["node", "label", "width", "pass", "string", "run"],
                    )

    several = labels.where("n > 1").withColumn("group_rows", F.col("n"))
    keyed = join_to_groups(vectors, several, ["label", "width"], "node").select("node", "label", "width", "n", "vector").mapInArrow(
        key, f"node binary, label {label}, width int, pass int, string bigint, run bigint"
    )
    order = ["label", "width", "pass", "string", "node"]
    return number_rows(keyed, order, "place", start=0).drop("string")


def _neighbours(orders: DataFrame, vectors: DataFrame, cosine: float) -> DataFrame:
    """Links (a, b) between vectors at most `WINDOW` places apart in some pass.

    A task holds `SPAN` places and the window behind them, whatever the data.
    """
    window, span = WINDOW, max(SPAN, WINDOW)
    cell = F.floor(F.col("place") / span)
    behind = (F.col("place") % span < window) & (cell > 0)
    dealt = orders.drop("run").withColumn("cell", F.explode(F.when(behind, F.array(cell, cell - 1)).otherwise(F.array(cell))))

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        out, end = [], (int(frame.cell.iloc[0]) + 1) * span
        for _, same in frame.sort_values("place").groupby(["label", "width", "pass"], sort=False):
            unit, nodes = _unit(_stacked(same.vector)), same.node.to_numpy()
            own = int((same.place < end).sum())  # the others are asked in the next cell
            for i in range(0, own, window):
                ask, others = unit[i:min(i + window, own)], unit[i:i + 2 * window]
                apart = np.arange(len(others))[None, :] - np.arange(len(ask))[:, None]
                near = ((ask @ others.T) >= cosine) & (apart > 0) & (apart <= window)
                out += [(nodes[i + a], nodes[i + b]) for a, b in _joined(near)]
        return pd.DataFrame(out, columns=["a", "b"])

    rows = dealt.join(vectors.select("node", "vector"), "node")
    return rows.groupBy("cell").applyInPandas(compare, "a binary, b binary")


def _long_runs(orders: DataFrame, vectors: DataFrame, labels: DataFrame, cosine: float) -> DataFrame:
    """Links (a, b) inside runs longer than a window reaches, over all their pairs.

    A run is half a grid of blocks by blocks; those of up to a block share
    bins.  Where the long runs of all passes hold as many pairs as their
    label, the grid of the label is taken once in their place.
    """
    whole, run = ["label", "width"], ["label", "width", "pass", "run"]
    long = durable(orders.groupBy(*run).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > WINDOW + 1))
    pairs = long.groupBy(*whole).agg(F.sum(F.col("n").cast("double") * F.col("n")).alias("pairs"))
    at_once = durable(
        labels.join(pairs, whole).where(F.col("pairs") >= F.col("n").cast("double") * F.col("n")).select(*whole, "n")
    )
    runs = long.join(at_once.select(*whole), whole, "left_anti")
    in_runs = join_to_groups(orders.select("node", *run), runs.withColumn("group_rows", F.col("n")), run, "node")
    in_labels = join_to_groups(
        vectors.select("node", *whole), at_once.withColumn("group_rows", F.col("n")), whole, "node"
    ).withColumns({"pass": F.lit(-1), "run": F.lit(0).cast("long")})
    rows = in_runs.select("node", *run, "n").unionByName(in_labels.select("node", *run, "n"))
    sizes = runs.select("n").unionByName(at_once.select("n"))
    small = sizes.where(F.col("n") <= BLOCK).agg(F.sum("n")).first()[0] or 0
    bin_ = F.pmod(F.xxhash64(*run), F.lit(math.ceil(small / BLOCK) or 1)).cast("int")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    own = F.when(blocks > 1, F.pmod(F.xxhash64("node"), blocks)).otherwise(F.lit(0)).cast("int")
    cells = rows.withColumns({"own": own, "bin": F.when(blocks == 1, bin_).otherwise(F.lit(-1)), "big": F.when(blocks > 1, F.xxhash64(*run))})
    cells = cells.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1))).withColumns(
        {"row": F.least("own", "other"), "column": F.greatest("own", "other")}
    ).drop("n", "other")

    def compare(cell: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, same in cell.groupby(run, sort=False):
            if len(same) < 2:
                continue
            unit, nodes, at = _unit(_stacked(same.vector)), same.node.to_numpy(), same.own.to_numpy()
            rows, columns = np.flatnonzero(at == same.row.to_numpy()), np.flatnonzero(at == same.column.to_numpy())
            near, others = np.zeros((len(rows), len(columns)), bool), unit[columns].T
            for i in range(0, len(rows), 512):
                near[i:i + 512] = unit[rows[i:i + 512]] @ others >= cosine
            near &= rows[:, None] != columns[None, :]
            out += [(nodes[rows[i]], nodes[columns[j]]) for i, j in _joined(near)]
        return pd.DataFrame(out, columns=["a", "b"])

    filled = cells.join(vectors.select("node", "vector"), "node")
    return filled.groupBy("bin", "big", "row", "column").applyInPandas(compare, "a binary, b binary")


def _links(vectors: DataFrame, cosine: float, seed: int) -> DataFrame:
    """Verified links (a, b) that join the nodes of a label as all of its links do, but for `MISSED`."""
    labels = durable(vectors.groupBy("label", "width").agg(F.count(F.lit(1)).alias("n")))
    orders = durable(_orders(vectors, labels, cosine, seed))
    return _neighbours(orders, vectors, cosine).unionByName(_long_runs(orders, vectors, labels, cosine))


def _count_links(members: DataFrame, cosine: float) -> DataFrame:
    """(node, others): vectors linked with each node, over all pairs of its component.

    A component is a grid of cells of bounded size; a cell returns one number
    per node, not its pairs.
    """
    sizes = members.groupBy("component").agg(F.count(F.lit(1)).alias("group_rows"))
    sizes = sizes.withColumn("n", F.col("group_rows"))
    cells = F.ceil(F.col("n") / CELL).cast("int")
    rows = join_to_groups(members, sizes, ["component"], "node", hot_rows=SPLIT).withColumn("cells", cells).withColumn(
        "own", F.pmod(F.xxhash64("node"), F.col("cells")).cast("int")
    )
    base = ["component", "node", "vector", "copies"]
    every = F.explode(F.sequence(F.lit(0), F.col("cells") - 1))
    grid = rows.select(*base, F.lit(True).alias("asks"), F.col("own").alias("row"), every.alias("column")).unionByName(
        rows.select(*base, F.lit(False).alias("asks"), every.alias("row"), F.col("own").alias("column"))
    )

    def compare(cell: pd.DataFrame) -> pd.DataFrame:
        ask, other = cell[cell.asks], cell[~cell.asks]
        if not len(ask) or not len(other):
            return pd.DataFrame({"node": [], "others": []})
        near = (_unit(_stacked(ask.vector)) @ _unit(_stacked(other.vector)).T) >= cosine
        near &= ask.node.to_numpy()[:, None] != other.node.to_numpy()[None, :]
        return pd.DataFrame({"node": ask.node, "others": near @ other.copies.to_numpy(dtype=np.int64)})

    found = grid.groupBy("component", "row", "column").applyInPandas(compare, "node binary, others bigint")
    return found.groupBy("node").agg(F.sum("others").alias("others"))


def near_embeddings(
    rows: DataFrame, cosine: float = 0.98, seed: int = 11, id_col: str = "vec_id",
    vector_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """One row per vector: id, ``n_links``, ``component_id``, ``kept``.

    Vectors are linked if their labels are equal and not null, their lengths
    are equal and their cosine in double precision is at least `cosine`.
    Vectors that are null, empty or zero, or hold null or non-finite
    components, have no links.  Rows with equal label and vector are one node
    and linked with each other.  ``n_links`` counts the other rows linked
    directly, ``component_id`` is the least id reachable, itself included;
    ``kept`` marks the row that carries it.  Null ids never win; a component
    without any id has a null one and its rows count as kept.  No rows give no
    rows.
    """
    vector = quoted(vector_col).cast("array<double>")
    usable = (
        vector.isNotNull() & quoted(label_col).isNotNull() & F.exists(vector, lambda x: x != 0)
        & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    )
    known = durable(rows.select(
        quoted(id_col).cast("long").alias("id"), quoted(label_col).alias("label"),
        F.when(usable, vector).alias("vector"), F.coalesce(usable, F.lit(False)).alias("usable"),
    ).withColumn("node", F.when(F.col("usable"), F.unhex(F.md5(F.concat_ws(
        "|", F.col("label").cast("string"), F.array_join(F.transform("vector", lambda x: (x + F.lit(0.0)).cast("string")), ",")
    ).cast("binary"))))))
    nodes = durable(
        known.where("usable").groupBy("node").agg(
            F.first("label").alias("label"), F.first("vector").alias("vector"), F.count(F.lit(1)).alias("copies")
        ).withColumn("width", F.size("vector"))
    )
    components = durable(connected_components(durable(_links(nodes, cosine, seed))))
    members = durable(
        nodes.alias("n").join(components.alias("c"), "node").select("n.node", "n.vector", "n.copies", "c.component")
    )
    counted = durable(_count_links(members, cosine))
    found = known.where("usable").select("id", "node").alias("k").join(components.alias("c"), F.col("k.node") == F.col("c.node"), "left").join(
        counted.alias("l"), F.col("k.node") == F.col("l.node"), "left"
    ).select("k.id", "k.node", F.coalesce("c.component", "k.node").alias("component"), F.coalesce("l.others", F.lit(0)).alias("others"))
    copies = nodes.select("node", F.col("copies").alias("group_rows"), (F.col("copies") - 1).alias("twins"))
    found = durable(join_to_groups(found.withColumn("spread", F.coalesce("id", F.lit(0))), copies, ["node"], "spread"))
    least = found.groupBy("component").agg(F.min("id").alias("component_id"), F.count(F.lit(1)).alias("group_rows"))
    out = join_to_groups(found, least, ["component"], "spread").select(
        "id", (F.col("others") + F.col("twins")).alias("n_links"), "component_id"
    )
    alone = known.where("not usable").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return out.unionByName(alone).select(
        F.col("id").alias(id_col), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_embeddings(read_table(spark, sf_dir, "embeddings"))


OP4_SQL = """
WITH RECURSIVE usable AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
    WHERE embedding IS NOT NULL AND label IS NOT NULL
      AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
      AND list_bool_or(list_transform(embedding, lambda x: x <> 0))
),
links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
      ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.98
),
reach AS (
    SELECT vec_id AS node, vec_id AS least FROM embeddings
    UNION
    SELECT links.b, reach.least FROM reach JOIN links ON links.a = reach.node
),
found AS (
    SELECT e.vec_id, (SELECT count(*) FROM links WHERE a = e.vec_id) AS n_links,
           (SELECT min(least) FROM reach WHERE node = e.vec_id) AS component_id
    FROM embeddings e
)
SELECT vec_id, n_links, component_id, vec_id = component_id AS kept FROM found
"""
