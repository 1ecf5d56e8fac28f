"""Lineage between files and between products: reach, purge, subset."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.model import Catalogue
from tidemark.operators import skew
from tidemark.session import durable, durable_partitioned


def parents(links: DataFrame, files: DataFrame) -> DataFrame:
    """Direct inputs of each file, one row per link."""
    source = files.withColumnRenamed("file_id", "source_file")
    return links.join(source, "source_file").withColumnsRenamed(
        {"resulting_file": "file_id", "source_file": "parent_id"}
    )


def children(links: DataFrame, files: DataFrame) -> DataFrame:
    """Files made directly from each file, one row per link."""
    result = files.withColumnRenamed("file_id", "resulting_file")
    return links.join(result, "resulting_file").withColumnsRenamed(
        {"source_file": "file_id", "resulting_file": "child_id"}
    )


# Rounds of single steps before shortcuts are laid; lineage is mostly no deeper than the levels of data.
PLAIN_ROUNDS = 4
# Edges are written anew without those to settled nodes if there are at most so many to a node found since the last time.
WORTH = 8


def reach(
    seeds: DataFrame, edges: DataFrame, hot_edges: int = skew.HOT_ROWS, plain_rounds: int = PLAIN_ROUNDS
) -> DataFrame:
    """Every node reachable from the seeds, with the fewest steps to it.

    `seeds` has `node`; `edges` has `node` and `next`.  Seeds come back with
    depth 0.  Only nodes are kept, never (seed, node) pairs.

    The edges are written once, bucketed by node, so that each round shuffles
    its frontier to them and not them.  Every node's edges are dealt over
    ``ceil(n / hot_edges)`` shares, one for nearly all nodes; the list of the
    others has at most ``edges / hot_edges`` rows, which bounds its
    broadcast.  Each round is a table, so a lost executor repeats one round.
    Tables of nodes already found are merged like the digits of a binary
    counter, so that a node is written again log2(rounds) times at most, and
    merged tables are bucketed too.

    What is not exhausted after `plain_rounds` is deep: from then on rounds
    also follow shortcuts of 2, 4, 8, ... steps along nodes with one way on,
    so that a stretch of n such nodes takes log2(n) rounds, and as many to
    lay the shortcuts.  A node that a later round reaches by fewer steps
    passes the better depth on.  Cycles end.

    Whenever the rounds have doubled, edges to nodes that no later round can
    reach by fewer steps are left out, and these nodes are no longer looked
    for among the found, so that the many late rounds of a wide reach read
    what is still open and not the whole table.
    """
    edges = durable(edges.select("node", "next"))
    degree = edges.groupBy("node").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_edges)
    hot = durable(degree.select("node", F.ceil(F.col("_n") / hot_edges).cast("int").alias("_shares")))
    spread = _dealt(edges.withColumn("steps", F.lit(1)), hot)
    shares = F.explode(F.sequence(F.lit(0), F.coalesce("_shares", F.lit(1)) - 1))

    frontier = durable(seeds.select("node").distinct().withColumn("depth", F.lit(0)))
    found_so_far = [(1, frontier)]  # (rounds in it, table), of nodes that edges may still lead to
    settled = []  # tables of nodes that no edge leads to any more
    rounds, due = 0, plain_rounds
    new = unsettled = frontier.count()
    while new:
        if rounds == due:
            tables = [table for _, table in found_so_far]
            open_edges = spread.drop("_share")
            if unsettled * WORTH >= open_edges.count():
                last = frontier.agg(F.min("depth")).first()[0] + 1  # the fewest steps a later round can find
                open_edges, done, found_so_far = _settle(open_edges, tables, last)
                settled, unsettled = settled + done, 0
            if rounds == plain_rounds:
                single = durable(open_edges) if settled else open_edges
                open_edges = _union([single, *_shortcuts(single, hot_edges)])
            if rounds == plain_rounds or not unsettled:
                spread = _dealt(open_edges, hot)
            due = max(2 * rounds, PLAIN_ROUNDS)
        rounds += 1
        ahead = frontier.join(F.broadcast(hot), "node", "left").select("node", "depth", shares.alias("_share"))
        found = ahead.join(spread, ["node", "_share"]).select(F.col("next").alias("node"), (F.col("depth") + F.col("steps")).alias("depth"))
        found = found.groupBy("node").agg(F.min("depth").alias("depth"))
        frontier = durable(_nearer(found, [table for _, table in found_so_far]))
        new = frontier.count()
        unsettled += new
        found_so_far.append((1, frontier))
        while len(found_so_far) > 1 and found_so_far[-2][0] == found_so_far[-1][0]:
            (n, earlier), (_, later) = found_so_far[-2:]
            merged = earlier.unionByName(later)
            found_so_far[-2:] = [(2 * n, merged if n == 1 else durable_partitioned(merged, 1, "node"))]
    everything = _union([*settled, *[table for _, table in found_so_far]])
    return everything if rounds <= plain_rounds else everything.groupBy("node").agg(F.min("depth").alias("depth"))


def _settle(
    edges: DataFrame, tables: list[DataFrame], last: int
) -> tuple[DataFrame, list[DataFrame], list[tuple[int, DataFrame]]]:
    """The edges without those to nodes found at depth `last` or less; these nodes; the others that were found.

    The nodes are one table in the join, which shuffles both sides, so that
    AQE splits a node that very many edges lead to.
    """
    found = _union(tables)
    near = found.where(F.col("depth") <= last)
    far = durable(found.where(F.col("depth") > last))
    left = edges.join(near.select(F.col("node").alias("next")), "next", "left_anti").select(*edges.columns)
    return left, [near], [] if far.isEmpty() else [(1, far)]


def _dealt(edges: DataFrame, hot: DataFrame) -> DataFrame:
    """The edges bucketed by node, those of hot nodes over their shares."""
    share = F.coalesce(F.pmod(F.xxhash64("next"), F.col("_shares")), F.lit(0)).cast("int")
    dealt = edges.join(F.broadcast(hot), "node", "left").select("node", "next", "steps", share.alias("_share"))
    return durable_partitioned(dealt, 1, "node", "_share")


def _nearer(found: DataFrame, tables: list[DataFrame]) -> DataFrame:
    """Nodes of `found` that no table holds at the same or a smaller depth.

    One anti join a table: `found` is shuffled once by node, and bucketed
    tables are met where they lie.
    """
    for table in tables:
        known = table.select("node", F.col("depth").alias("_depth"))
        found = found.join(known, (found["node"] == known["node"]) & (known["_depth"] <= found["depth"]), "left_anti")
    return found


def _shortcuts(edges: DataFrame, hot_edges: int) -> list[DataFrame]:
    """Edges of 2, 4, 8, ... `steps` from nodes with one way on, by pointer doubling.

    Each level has no more rows than there are such nodes, and only those with
    that many steps ahead.  A cycle of them would never end: no level is
    longer than their number.
    """
    ways = edges.groupBy("node").agg(F.min("next").alias("next"), F.max("next").alias("_other"))
    now = durable(ways.where((F.col("next") == F.col("_other")) & (F.col("next") != F.col("node"))).select("node", "next"))
    nodes, steps, levels = now.count(), 2, []
    while steps <= nodes:
        now = durable(_doubled(now, hot_edges))
        if now.isEmpty():
            break
        levels.append(now.withColumn("steps", F.lit(steps)))
        steps *= 2
    return levels


def _doubled(now: DataFrame, hot_edges: int) -> DataFrame:
    """Each pointer followed by the one it points to; a node that very many point to is repeated over shares."""
    ahead = now.select(F.col("node").alias("next"), F.col("next").alias("_beyond"))
    pointed = now.groupBy("next").agg(F.count(F.lit(1)).alias("group_rows")).join(ahead, "next")
    return skew.join_to_groups(now, pointed, ["next"], "node", hot_rows=hot_edges).select("node", F.col("_beyond").alias("next"))


def _union(pieces: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, pieces)


def descendants(ids: DataFrame, links: DataFrame) -> DataFrame:
    """The given files (`file_id`) and all files made from them, directly or not."""
    edges = links.select(F.col("source_file").alias("node"), F.col("resulting_file").alias("next"))
    return reach(ids.select(F.col("file_id").alias("node")), edges).withColumnRenamed("node", "file_id")


def ancestors(ids: DataFrame, links: DataFrame) -> DataFrame:
    """The given files (`file_id`) and everything they were made from, directly or not."""
    edges = links.select(F.col("resulting_file").alias("node"), F.col("source_file").alias("next"))
    return reach(ids.select(F.col("file_id").alias("node")), edges).withColumnRenamed("node", "file_id")


def product_edges(catalogue: Catalogue) -> DataFrame:
    """(product, child product) pairs through one process; processes with no output are left out."""
    made = catalogue.process.where("output_product IS NOT NULL").select(
        "process_id", F.col("output_product").alias("child_id")
    )
    return (
        catalogue.productprocesslink.select("process_id", F.col("input_product_id").alias("product_id"))
        .join(made, "process_id")
        .select("product_id", "child_id")
        .distinct()
    )


def product_tree(catalogue: Catalogue) -> DataFrame:
    """Every product with the sorted list of products made from it, lower levels first."""
    grouped = product_edges(catalogue).groupBy("product_id").agg(
        F.array_sort(F.collect_list("child_id")).alias("children")
    )
    return (
        catalogue.product.select("product_id", "product_name", "level")
        .join(grouped, "product_id", "left")
        .withColumn("children", F.coalesce("children", F.array().cast("array<bigint>")))
        .orderBy("level", "product_id")
    )


def related_products(catalogue: Catalogue, products: DataFrame, outputs: bool = False) -> DataFrame:
    """The given products and all inputs needed to make them; with `outputs` also what they make.

    Inputs are those of the first (lowest id) process that makes a product.
    """
    from tidemark.operators.trace import process_of_output

    maker = process_of_output(catalogue).withColumnRenamed("product_id", "node")
    inputs = catalogue.productprocesslink.select("process_id", F.col("input_product_id").alias("next"))
    edges = maker.join(inputs, "process_id").select("node", "next")
    if outputs:
        made = product_edges(catalogue).select(F.col("product_id").alias("node"), F.col("child_id").alias("next"))
        edges = edges.unionByName(made).distinct()
    return reach(products.select(F.col("product_id").alias("node")), edges).select(
        F.col("node").alias("product_id")
    )


# Columns by which each table refers to files.
FILE_REFERENCES = {
    "file": ("file_id",),
    "unixtime": ("file_id",),
    "processqueue": ("file_id",),
    "release": ("file_id",),
    "filefilelink": ("source_file", "resulting_file"),
    "filecodelink": ("resulting_file",),
    "logging_file": ("file_id",),
}


def purged_rows(catalogue: Catalogue, ids: DataFrame) -> dict[str, DataFrame]:
    """Rows of each table that go when the given files go."""
    ids = durable(ids.select("file_id").distinct())  # met once for every reference
    out = {}
    for table, columns in FILE_REFERENCES.items():
        if table not in catalogue:
            continue
        rows = getattr(catalogue, table)
        marked = rows
        for column in columns:
            gone = ids.select(F.col("file_id").alias(column), F.lit(True).alias(f"_{column}"))
            marked = marked.join(gone, column, "left")
        hit = F.coalesce(*[F.col(f"_{c}") for c in columns], F.lit(False))
        out[table] = marked.where(hit).select(*rows.columns)
    return out


def purge(catalogue: Catalogue, ids: DataFrame, recursive: bool = False) -> tuple[Catalogue, DataFrame]:
    """Remove files and every row that refers to them; also returns the ids that went.

    `recursive` removes all descendants too.  Rows of the release, seconds
    and run-history tables go as well, so that nothing is left dangling.
    """
    gone = ids.select("file_id").distinct()
    if recursive:
        gone = durable(descendants(gone, catalogue.filefilelink).select("file_id"))
    left = {}
    for table, columns in FILE_REFERENCES.items():
        if table not in catalogue:
            continue
        rows = getattr(catalogue, table)
        for column in columns:
            rows = rows.join(gone.withColumnRenamed("file_id", column), column, "left_anti")
        left[table] = rows.select(*getattr(catalogue, table).columns)
    return catalogue.replace(**left), gone


def subset(catalogue: Catalogue, keep: DataFrame, last_date=None) -> Catalogue:
    """The catalogue of the kept products only (`product_id`), all references intact.

    Files of other products go, and their links; a process goes with its
    output product, and with it its codes and input links.  With `last_date`
    files of later dates go too, together with all their descendants.
    """
    keep = keep.select("product_id").distinct()

    def kept(rows: DataFrame, column: str) -> DataFrame:
        return rows.join(keep.withColumnRenamed("product_id", column), column, "left_semi").select(*rows.columns)

    process = catalogue.process.where("output_product IS NULL").unionByName(
        kept(catalogue.process, "output_product")
    )
    of_process = process.select("process_id")
    out = catalogue.replace(
        product=kept(catalogue.product, "product_id"),
        instrumentproductlink=kept(catalogue.instrumentproductlink, "product_id"),
        inspector=kept(catalogue.inspector, "product"),
        process=process,
        productprocesslink=kept(catalogue.productprocesslink, "input_product_id").join(
            of_process, "process_id", "left_semi"
        ),
        code=catalogue.code.join(of_process, "process_id", "left_semi"),
    )
    gone = catalogue.file.join(keep, "product_id", "left_anti").select("file_id")
    if last_date is not None:
        late = catalogue.file.where(F.col("utc_file_date") > F.lit(last_date).cast("date"))
        late = descendants(late.select("file_id"), catalogue.filefilelink)
        gone = gone.unionByName(late.select("file_id"))
    out, _ = purge(out, durable(gone.distinct()))
    codes = out.code.select(F.col("code_id").alias("source_code"))
    return out.replace(
        filecodelink=out.filecodelink.join(codes, "source_code", "left_semi").select(
            *catalogue.filecodelink.columns
        )
    )
