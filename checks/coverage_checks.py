"""Gaps, coverage matrices, version tables, latest views."""

from pyspark.sql import functions as F

from checks.catalogue_checks import NEWEST
from checks.registry import catalogue, query
from tidemark.functions.text import glob_pattern
from tidemark.functions.version import version
from tidemark.operators import coverage, workset
from tidemark.operators.lineage import product_edges
from tidemark.operators.trace import trace_products

FIRST, LAST = "2024-01-01", "2024-01-30"
_DAYS = "days AS (SELECT CAST(unnest(generate_series(DATE '2024-01-01', DATE '2024-01-30', INTERVAL 1 DAY)) AS DATE) AS day)"
_MISSING = "missing AS (SELECT p.product_id, d.day FROM v_product p, days d EXCEPT SELECT product_id, utc_file_date FROM v_file)"


@query("cov01_missing_dates", f"WITH {_DAYS}, {_MISSING} SELECT product_id, day FROM missing")
def _(t):
    return coverage.missing_dates(t.file, t.product, FIRST, LAST)


_EDGES = """edges AS (SELECT DISTINCT l.input_product_id AS product_id, p.output_product AS child_id
  FROM v_productprocesslink l JOIN v_process p USING (process_id) WHERE p.output_product IS NOT NULL)"""


@query(
    "cov02_parents_of_missing",
    f"""
    WITH {_DAYS}, {_MISSING}, {_EDGES}
    SELECT DISTINCT f.file_id, f.filename FROM missing m JOIN edges e ON e.child_id = m.product_id
    JOIN v_file f ON f.product_id = e.product_id AND f.utc_file_date = m.day
    """,
)
def _(t):
    missing = coverage.missing_dates(t.file, t.product, FIRST, LAST)
    return coverage.parents_of_missing(t.file, product_edges(catalogue(t)), missing).select("file_id", "filename")


@query(
    "cov03_requeue_missing",
    f"""
    WITH {_DAYS}, {_MISSING}, {_EDGES}
    SELECT DISTINCT f.file_id FROM missing m JOIN edges e ON e.child_id = m.product_id
    JOIN v_file f ON f.product_id = e.product_id AND f.utc_file_date = m.day WHERE f.file_id NOT IN (SELECT file_id FROM v_processqueue)
    """,
)
def _(t):
    missing = coverage.missing_dates(t.file, t.product, FIRST, LAST)
    wanted = coverage.parents_of_missing(t.file, product_edges(catalogue(t)), missing)
    return workset.push(t.processqueue, t.file, wanted).select("file_id")


@query(
    "cov04_coverage_matrix",
    f"""
    WITH {_DAYS}, {NEWEST}
    SELECT concat('level ', p.level) AS panel, p.product_id, d.day,
      CAST(n.file_id IS NOT NULL AND (p.product_id % 2 = 1 OR regexp_matches(n.filename, '_v1\\.')) AND (p.product_id % 3 <> 0 OR (n.quality_version, n.revision_version) >= (2, 1)
        OR n.interface_version > 1) AS INT) AS covered
    FROM v_product p CROSS JOIN days d LEFT JOIN newest n ON n.product_id = p.product_id AND n.utc_file_date = d.day
    """,
)
def _(t):
    panels = t.product.select(
        F.concat(F.lit("level "), F.col("level").cast("string")).alias("panel"),
        "product_id",
        F.when(F.col("product_id") % 2 == 0, F.lit(glob_pattern("*_v1.*"))).alias("pattern"),
        F.when(F.col("product_id") % 3 == 0, version(1, 2, 1)).alias("minimum"),
    )
    return coverage.coverage_matrix(t.file, panels, FIRST, LAST)


@query(
    "cov05_day_pages",
    f"""
    WITH {_DAYS} SELECT p.product_id, d.day, CAST(floor((d.day - DATE '2024-01-01') / 7) AS BIGINT) AS page FROM v_product p, days d
    """,
)
def _(t):
    days = coverage.calendar(
        t.product.select("product_id"), F.lit(FIRST).cast("date"), F.lit(LAST).cast("date")
    )
    return coverage.pages(days, FIRST, 7)


@query(
    "cov06_version_by_day",
    f"""
    WITH span AS (SELECT min(utc_file_date) AS a, max(utc_file_date) AS b FROM v_file), {NEWEST},
    days AS (SELECT CAST(unnest(generate_series(a, b + 2, INTERVAL 1 DAY)) AS DATE) AS day FROM span)
    SELECT r.r_name AS satellite_name, p.product_name, p.level, d.day,
      CASE WHEN n.file_id IS NOT NULL THEN concat(n.interface_version, '.', n.quality_version, '.', n.revision_version) END AS version
    FROM v_product p JOIN v_instrumentproductlink l USING (product_id) JOIN nation na ON na.n_nationkey = l.instrument_id JOIN region r ON r.r_regionkey = na.n_regionkey
    CROSS JOIN days d LEFT JOIN newest n ON n.product_id = p.product_id AND n.utc_file_date = d.day
    """,
)
def _(t):
    products = trace_products(catalogue(t)).select("product_id", "product_name", "level", "satellite_name")
    return coverage.version_by_day(t.file, products, 3).select(
        "satellite_name", "product_name", "level", "day", "version"
    )


@query(
    "cov07_latest_view",
    r"""
    WITH b AS (SELECT filename, regexp_extract(filename, '^(.*?)v\d\d?\.\d\d?\.\d\d?\.', 1) AS base, interface_version AS i, quality_version AS q, revision_version AS r FROM v_file),
    shown AS (SELECT filename FROM (SELECT *, row_number() OVER (PARTITION BY base ORDER BY i DESC, q DESC, r DESC, filename) AS rk FROM b) WHERE rk = 1
      AND strptime(regexp_extract(filename, '_(\d{8})_', 1), '%Y%m%d') BETWEEN DATE '2024-01-03' AND DATE '2024-01-26'),
    links AS (SELECT filename FROM v_file WHERE quality_version = 4)
    SELECT filename, 'add' AS action FROM shown WHERE filename NOT IN (SELECT filename FROM links)
    UNION ALL SELECT filename, 'remove' FROM links WHERE filename NOT IN (SELECT filename FROM shown)
    """,
)
def _(t):
    links = t.file.where("quality_version = 4").select("filename")
    return coverage.latest_view(
        t.file.select("filename"), links, "2024-01-03", "2024-01-31", today="2024-01-31", delay_days=5
    )
