"""Lineage, retention, purge and subset queries."""

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from checks.catalogue_checks import FULL_PATH, NEWEST
from checks.registry import catalogue, query
from tidemark.operators import lineage
from tidemark.operators.catalogue import full_paths, newest_ids
from tidemark.operators.trace import trace_products
from tidemark.plans import retention
from tidemark.session import durable

# Everything made from, or used to make, the files of `seed`.
DOWN = """down AS (SELECT file_id FROM seed UNION SELECT l.resulting_file FROM down JOIN v_filefilelink l ON l.source_file = down.file_id)"""


@query(
    "lin01_parents",
    """
    SELECT l.resulting_file AS file_id, l.source_file AS parent_id, f.filename AS parent_name, f.product_id AS parent_product
    FROM v_filefilelink l JOIN v_file f ON f.file_id = l.source_file
    """,
)
def _(t):
    return lineage.parents(t.filefilelink, t.file).select(
        "file_id", "parent_id", F.col("filename").alias("parent_name"), F.col("product_id").alias("parent_product")
    )


@query(
    "lin02_children",
    """
    SELECT l.source_file AS file_id, l.resulting_file AS child_id, f.filename AS child_name
    FROM v_filefilelink l JOIN v_file f ON f.file_id = l.resulting_file
    """,
)
def _(t):
    return lineage.children(t.filefilelink, t.file).select(
        "file_id", "child_id", F.col("filename").alias("child_name")
    )


@query(
    "lin03_descendants",
    f"""
    WITH RECURSIVE seed AS (SELECT file_id FROM v_file WHERE NOT exists_on_disk AND utc_file_date = DATE '2024-01-02'), {DOWN}
    SELECT file_id FROM down
    """,
)
def _(t):
    seeds = t.file.where("NOT exists_on_disk AND utc_file_date = DATE '2024-01-02'").select("file_id")
    return lineage.descendants(seeds, t.filefilelink).select("file_id")


@query(
    "lin03_hot_nodes",
    """
    WITH RECURSIVE edge AS (SELECT o_custkey * 2 AS a, o_orderkey * 2 + 1 AS b FROM orders WHERE o_custkey % 3 <> 0
        UNION ALL SELECT 0, o_orderkey * 2 + 1 FROM orders WHERE o_custkey % 3 = 0
        UNION ALL SELECT o_orderkey * 2 + 1, (o_custkey + 1) * 2 FROM orders WHERE o_orderkey % 4 = 0),
    up AS (SELECT CAST(0 AS BIGINT) AS node UNION SELECT e.b FROM up JOIN edge e ON e.a = up.node)
    SELECT node FROM up
    """,
)
def _(t):
    # A node with a third of all edges; the lowered threshold spreads it and others over many shares.
    o = t.base("orders")
    down = o.select(F.when(F.col("o_custkey") % 3 == 0, 0).otherwise(F.col("o_custkey") * 2).cast("long").alias("node"),
                    (F.col("o_orderkey") * 2 + 1).cast("long").alias("next"))
    on = o.where("o_orderkey % 4 = 0").select(
        (F.col("o_orderkey") * 2 + 1).cast("long").alias("node"), ((F.col("o_custkey") + 1) * 2).cast("long").alias("next"))
    seeds = o.select(F.lit(0).cast("long").alias("node")).limit(1)
    return lineage.reach(seeds, down.unionByName(on), hot_edges=5).select("node")


@query(
    "lin03_deep_chain",
    """
    WITH made AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS depth FROM orders),
    -- The shortest way to an order leads over whole orders, to its line items one step further.
    nodes AS (SELECT o_orderkey * 10 AS node, depth FROM made
        UNION ALL SELECT DISTINCT l_orderkey * 10 + l_linenumber, depth + 1 FROM lineitem JOIN made ON l_orderkey = o_orderkey WHERE l_linenumber BETWEEN 1 AND 2)
    SELECT CAST(node AS BIGINT) AS node, CAST(depth AS INTEGER) AS depth FROM nodes
    """,
)
def _(t):
    # A running file a customer: each order is made from the customer's previous one, and its line items lead on to the next.
    last = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    o = t.base("orders").select("o_custkey", F.col("o_orderkey").cast("long").alias("o_orderkey")).withColumns(
        {"place": F.row_number().over(last), "after": F.lead("o_orderkey").over(last)})
    node = F.col("o_orderkey") * 10
    straight = o.where("after IS NOT NULL").select(node.alias("node"), (F.col("after") * 10).alias("next"))
    item = F.col("l_orderkey").cast("long") * 10 + F.col("l_linenumber")
    items = t.base("lineitem").where("l_linenumber BETWEEN 1 AND 2").join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    aside = items.select(node.alias("node"), item.alias("next"))
    back = items.where("after IS NOT NULL AND l_linenumber = 1").select(item.alias("node"), (F.col("after") * 10).alias("next"))
    edges = straight.unionByName(aside).unionByName(back)
    return lineage.reach(o.where("place = 1").select(node.alias("node")), edges).select("node", "depth")


@query(
    "lin03_ancestors",
    f"""
    WITH RECURSIVE {NEWEST}, up AS (SELECT file_id FROM newest UNION SELECT l.source_file FROM up JOIN v_filefilelink l ON l.resulting_file = up.file_id)
    SELECT file_id FROM up
    """,
)
def _(t):
    return lineage.ancestors(newest_ids(t.file), t.filefilelink).select("file_id")


_EDGES = """
  SELECT DISTINCT l.input_product_id AS product_id, p.output_product AS child_id
  FROM v_productprocesslink l JOIN v_process p USING (process_id) WHERE p.output_product IS NOT NULL
"""


@query("lin04_product_children", _EDGES)
def _(t):
    return lineage.product_edges(catalogue(t))


@query(
    "lin05_product_tree",
    f"""
    WITH e AS ({_EDGES}) SELECT p.product_id, p.product_name, p.level, coalesce((SELECT string_agg(CAST(child_id AS STRING), ',' ORDER BY child_id) FROM e WHERE e.product_id = p.product_id), '') AS children
    FROM v_product p
    """,
)
def _(t):
    return lineage.product_tree(catalogue(t)).withColumn("children", F.array_join("children", ","))


@query(
    "lin06_related_products",
    f"""
    WITH RECURSIVE e AS ({_EDGES}), maker AS (SELECT output_product, min(process_id) AS process_id FROM v_process WHERE output_product IS NOT NULL GROUP BY 1),
    step AS (SELECT m.output_product AS node, l.input_product_id AS nxt FROM maker m JOIN v_productprocesslink l USING (process_id) UNION SELECT product_id, child_id FROM e),
    rel AS (SELECT product_id FROM v_product WHERE level = 3.0 AND instrument_id = 7 UNION SELECT s.nxt FROM rel JOIN step s ON s.node = rel.product_id)
    SELECT product_id FROM rel
    """,
)
def _(t):
    seeds = t.product.where("level = 3.0 AND instrument_id = 7")
    return lineage.related_products(catalogue(t), seeds, outputs=True)


_SEED = "seed AS (SELECT file_id FROM v_file WHERE NOT exists_on_disk AND quality_version = 0)"


@query(
    "lin07_purged_rows",
    f"""
    WITH RECURSIVE {_SEED}, {DOWN}
    SELECT 'file' AS table_name, CAST(file_id AS STRING) AS key FROM v_file WHERE file_id IN (SELECT file_id FROM down)
    UNION ALL SELECT 'processqueue', CAST(file_id AS STRING) FROM v_processqueue WHERE file_id IN (SELECT file_id FROM down)
    UNION ALL SELECT 'release', CAST(file_id AS STRING) FROM v_release WHERE file_id IN (SELECT file_id FROM down)
    UNION ALL SELECT 'filefilelink', concat(source_file, '>', resulting_file) FROM v_filefilelink WHERE source_file IN (SELECT file_id FROM down) OR resulting_file IN (SELECT file_id FROM down)
    UNION ALL SELECT 'filecodelink', concat(resulting_file, '>', source_code) FROM v_filecodelink WHERE resulting_file IN (SELECT file_id FROM down)
    """,
)
def _(t):
    links = durable(t.filefilelink)  # followed and reported
    c = catalogue(t).replace(filefilelink=links)
    seeds = t.file.where("NOT exists_on_disk AND quality_version = 0").select("file_id")
    gone = lineage.descendants(seeds, links).select("file_id")
    keys = {"filefilelink": ["source_file", "resulting_file"], "filecodelink": ["resulting_file", "source_code"]}
    rows = [
        df.select(F.lit(name).alias("table_name"), F.concat_ws(">", *keys.get(name, ["file_id"])).alias("key"))
        for name, df in lineage.purged_rows(c, gone).items()
    ]
    return reduce(lambda a, b: a.union(b), rows)


@query(
    "lin07_purge_leaves",
    f"""
    WITH RECURSIVE {_SEED}, {DOWN} SELECT file_id, filename FROM v_file WHERE file_id NOT IN (SELECT file_id FROM down)
    """,
)
def _(t):
    seeds = t.file.where("NOT exists_on_disk AND quality_version = 0")
    left, _gone = lineage.purge(catalogue(t), seeds, recursive=True)
    return left.file.select("file_id", "filename")


# Raw files (level 0) have no inputs, so they are the roots.
_LINKS = "links AS (SELECT l.* FROM v_filefilelink l JOIN v_file f ON f.file_id = l.resulting_file WHERE f.data_level > 0.0)"
_KEEP = f"""
  {_LINKS}, {NEWEST}, wanted AS (SELECT file_id FROM newest UNION SELECT file_id FROM v_release),
  up AS (SELECT file_id FROM wanted UNION SELECT l.source_file FROM up JOIN links l ON l.resulting_file = up.file_id),
  seed AS (SELECT file_id FROM v_file WHERE utc_file_date <= DATE '2024-01-20' AND file_id NOT IN (SELECT resulting_file FROM links)),
  down AS (SELECT file_id FROM seed UNION SELECT l.resulting_file FROM down JOIN links l ON l.source_file = down.file_id)
"""


def _rooted(t):
    c = catalogue(t)
    derived = t.file.where("data_level > 0.0").select(F.col("file_id").alias("resulting_file"))
    return c.replace(filefilelink=c.filefilelink.join(derived, "resulting_file", "left_semi"))


@query(
    "lin08_retention_candidates",
    f"WITH RECURSIVE {_KEEP} SELECT file_id FROM v_file WHERE file_id NOT IN (SELECT file_id FROM up) AND file_id NOT IN (SELECT file_id FROM down)",
)
def _(t):
    return retention.retention_candidates(_rooted(t), "2024-01-20")


@query(
    "lin09_reap_plan",
    f"""
    WITH RECURSIVE {_KEEP}, cand AS (SELECT * FROM v_file WHERE file_id NOT IN (SELECT file_id FROM up) AND file_id NOT IN (SELECT file_id FROM down)),
    path AS (SELECT DISTINCT f.file_id, {FULL_PATH} AS full_path FROM cand f JOIN v_product_full p ON p.product_id = f.product_id
      JOIN (SELECT product_id, min(instrument_id) AS instrument_id FROM v_instrumentproductlink GROUP BY 1) l ON l.product_id = p.product_id
      JOIN nation n ON n.n_nationkey = l.instrument_id JOIN region s ON s.r_regionkey = n.n_regionkey)
    SELECT c.file_id, path.full_path, replace(path.full_path, '/data/', '/archive/') AS archive_path, 'archive file' AS action
    FROM cand c JOIN path USING (file_id) WHERE c.exists_on_disk
    """,
)
def _(t):
    c = _rooted(t)
    one_link = c.instrumentproductlink.groupBy("product_id").agg(F.min("instrument_id").alias("instrument_id"))
    c = c.replace(instrumentproductlink=one_link.select("instrument_id", "product_id"))
    candidates = retention.retention_candidates(c, "2024-01-20")
    paths = full_paths(c.file, trace_products(c), "/data")
    return retention.reap_plan(candidates, paths, "files", "/data", archive="/archive")


@query(
    "lin09_archive",
    f"""
    WITH path AS (SELECT DISTINCT f.file_id, {FULL_PATH} AS full_path FROM v_file f JOIN v_product_full p ON p.product_id = f.product_id
      JOIN (SELECT product_id, min(instrument_id) AS instrument_id FROM v_instrumentproductlink GROUP BY 1) l ON l.product_id = p.product_id
      JOIN nation n ON n.n_nationkey = l.instrument_id JOIN region s ON s.r_regionkey = n.n_regionkey)
    SELECT f.file_id, concat('/c++ (old.)', substr(path.full_path, 6)) AS full_path, concat('/archive', substr(path.full_path, 6)) AS archive_path,
      'archive file' AS action
    FROM v_file f JOIN path USING (file_id) WHERE f.exists_on_disk AND f.file_id % 10 = 3
    """,
)
def _(t):
    # A root whose characters mean something else in an expression.
    c = _rooted(t)
    one_link = c.instrumentproductlink.groupBy("product_id").agg(F.min("instrument_id").alias("instrument_id"))
    c = c.replace(instrumentproductlink=one_link.select("instrument_id", "product_id"))
    paths = full_paths(c.file, trace_products(c), "/c++ (old.)")
    return retention.reap_plan(c.file.where("file_id % 10 = 3"), paths, "files", "/c++ (old.)/", archive="/archive")


@query(
    "lin10_subset",
    """
    WITH RECURSIVE k AS (SELECT product_id FROM v_product WHERE level >= 1.0), late AS (
      SELECT file_id FROM v_file WHERE utc_file_date > DATE '2024-01-20'
      UNION SELECT l.resulting_file FROM late JOIN v_filefilelink l ON l.source_file = late.file_id),
    f AS (SELECT file_id FROM v_file WHERE product_id IN (SELECT product_id FROM k) AND file_id NOT IN (SELECT file_id FROM late)),
    pr AS (SELECT process_id FROM v_process WHERE output_product IS NULL OR output_product IN (SELECT product_id FROM k))
    SELECT 'file' AS table_name, CAST(file_id AS STRING) AS key FROM f
    UNION ALL SELECT 'process', CAST(process_id AS STRING) FROM pr
    UNION ALL SELECT 'code', CAST(code_id AS STRING) FROM v_code WHERE process_id IN (SELECT process_id FROM pr)
    UNION ALL SELECT 'filefilelink', concat(source_file, '>', resulting_file) FROM v_filefilelink WHERE source_file IN (SELECT file_id FROM f) AND resulting_file IN (SELECT file_id FROM f)
    UNION ALL SELECT 'productprocesslink', concat(process_id, '>', input_product_id) FROM v_productprocesslink WHERE process_id IN (SELECT process_id FROM pr) AND input_product_id IN (SELECT product_id FROM k)
    """,
)
def _(t):
    c = lineage.subset(catalogue(t), t.product.where("level >= 1.0"), last_date="2024-01-20")
    keys = {
        "file": ["file_id"], "process": ["process_id"], "code": ["code_id"],
        "filefilelink": ["source_file", "resulting_file"], "productprocesslink": ["process_id", "input_product_id"],
    }
    rows = [
        getattr(c, name).select(F.lit(name).alias("table_name"), F.concat_ws(">", *cols).alias("key"))
        for name, cols in keys.items()
    ]
    return reduce(lambda a, b: a.union(b), rows)
