"""Queue, release and bulk edit queries."""

from pyspark.sql import functions as F

from checks.catalogue_checks import NEWEST
from checks.registry import catalogue, query
from tidemark.operators import edits, workset
from tidemark.operators.trace import trace_products


@query(
    "queue01_push",
    """
    SELECT file_id, 2 AS version_bump FROM (SELECT DISTINCT resulting_file + 3 AS file_id FROM v_filecodelink)
    WHERE file_id IN (SELECT file_id FROM v_file) AND file_id NOT IN (SELECT file_id FROM v_processqueue)
    """,
)
def _(t):
    ids = t.filecodelink.select((F.col("resulting_file") + 3).alias("file_id"))
    return workset.push(t.processqueue, t.file, ids, 2)


@query(
    "queue02_raw_add",
    "SELECT DISTINCT resulting_file + 3 AS file_id FROM v_filecodelink WHERE resulting_file + 3 NOT IN (SELECT file_id FROM v_processqueue)",
)
def _(t):
    ids = t.filecodelink.select((F.col("resulting_file") + 3).alias("file_id"))
    return workset.raw_add(t.processqueue, ids).select("file_id")


@query(
    "queue03_remove_named",
    "SELECT file_id, version_bump FROM v_queue_bumped WHERE file_id NOT IN (SELECT file_id FROM v_file WHERE filename IN (SELECT filename FROM v_file_other WHERE NOT exists_on_disk))",
)
def _(t):
    names = t.file_other.where("NOT exists_on_disk").select("filename")
    return workset.remove_named(t.queue_bumped, t.file, names)


@query("queue03_length", "SELECT count(*) AS queued FROM v_queue_bumped")
def _(t):
    return workset.length(t.queue_bumped)


@query(
    "queue04_clean",
    f"WITH {NEWEST} SELECT file_id, version_bump FROM v_queue_bumped WHERE version_bump IS NOT NULL OR file_id IN (SELECT file_id FROM newest)",
)
def _(t):
    return workset.clean(t.queue_bumped, t.file)


@query(
    "queue05_report",
    """
    SELECT q.file_id, f.filename, p.product_name, f.utc_file_date, q.version_bump FROM v_queue_bumped q JOIN v_file f USING (file_id) JOIN v_product p USING (product_id)
    WHERE p.product_id BETWEEN 10 AND 60
    """,
)
def _(t):
    return workset.report(t.queue_bumped, catalogue(t), F.col("product_id").between(10, 60))


@query(
    "queue06_head_and_tail",
    """
    SELECT min(file_id) AS file_id, 'head' AS place FROM v_queue_bumped UNION ALL SELECT max(file_id), 'tail' FROM v_queue_bumped
    """,
)
def _(t):
    q = t.queue_bumped
    return workset.head(q).select("file_id", F.lit("head").alias("place")).union(
        workset.head(q, -1).select("file_id", F.lit("tail")))


@query(
    "release01_tag_newest",
    f"WITH {NEWEST} SELECT file_id, '1.0' AS release_num FROM newest WHERE file_id NOT IN (SELECT file_id FROM v_release)",
)
def _(t):
    return workset.tag_release(t.file, t.release, "1.0")


@query("release02_list", "SELECT f.file_id, f.filename FROM v_release r JOIN v_file f USING (file_id) WHERE r.release_num = '1.0'")
def _(t):
    return workset.list_release(catalogue(t), "1.0")


@query(
    "edit01_replace_text",
    """
    SELECT code_id, replace(filename, 'make', 'build') AS filename, replace(code_description, 'process', 'process no.') AS code_description FROM v_code_full
    """,
)
def _(t):
    rows = edits.edit_text(t.code_full, "filename", edits.Replace("make", "build"))
    rows = edits.edit_text(rows, "code_description", edits.insert_after("process", " no."))
    return rows.select("code_id", "filename", "code_description")


@query(
    "edit01_after_flag",
    """
    SELECT code_id, concat('-i /new/data/in', process_id % 3, ' -m {CODEDIR}/mask -i {ROOTDIR}/x -d {DATE}') AS after_flag,
      concat('-i /data/in', process_id % 3, ',{ROOTDIR}/x -m {CODEDIR}/mask -d {DATE}') AS combined FROM v_code_full
    """,
)
def _(t):
    rows = t.code_full.withColumn("again", F.col("arguments"))
    rows = edits.edit_flag_values(rows, "-i", edits.insert_before("/data", "/new"))
    merged = edits.join_flag_values(
        rows.withColumn("after_flag", F.col("arguments")).withColumn("arguments", F.col("again")), "-i")
    return merged.select("code_id", "after_flag", F.col("arguments").alias("combined"))


@query(
    "edit02_root_in_arguments",
    "SELECT code_id, replace(arguments, '/data', '{ROOTDIR}') AS arguments FROM v_code_full WHERE arguments LIKE '%/data%'",
)
def _(t):
    return edits.arguments_with_root(t.code_full, "/data").select("code_id", "arguments")


@query(
    "edit03_move_product",
    """
    SELECT f.file_id, concat('/data/flat/', f.filename) AS old_path, concat('/data/moved/', strftime(f.utc_file_date, '%Y'), '/', f.filename) AS new_path
    FROM v_file f WHERE f.product_id = 8 AND f.exists_on_disk
    """,
)
def _(t):
    c = catalogue(t)
    _table, moves = edits.move_product(c, 8, "moved/{Y}", trace_products(c), "/data")
    return moves


@query(
    "edit04_rename",
    "SELECT f.file_id, CASE WHEN o.filename IS NOT NULL THEN concat('old_', f.filename) ELSE f.filename END AS filename FROM v_file f LEFT JOIN v_file_other o USING (filename)",
)
def _(t):
    renames = t.file_other.select("filename", F.concat(F.lit("old_"), "filename").alias("new_name"))
    return edits.rename_files(t.file, renames).select("file_id", "filename")


@query(
    "edit05_code_succession",
    """
    WITH s AS (SELECT code_id + 100000 AS code_id, code_id AS replaces, quality_version, process_id, process_id % 3 AS up FROM v_code_full),
    good AS (SELECT * FROM s WHERE up > 0)
    SELECT code_id, active_code AND code_id NOT IN (SELECT replaces FROM good) AS active_code, newest_version AND code_id NOT IN (SELECT replaces FROM good) AS newest_version, quality_version FROM v_code_full
    UNION ALL SELECT code_id, TRUE, TRUE, CAST(quality_version + up AS INT) FROM good
    """,
)
def _(t):
    successors = t.code_full.withColumns({
        "replaces": F.col("code_id"), "code_id": F.col("code_id") + 100000,
        "quality_version": (F.col("quality_version") + F.col("process_id") % 3).cast("int"),
    })
    table, _refused = edits.succeed_codes(t.code_full, successors)
    return table.select("code_id", "active_code", "newest_version", "quality_version")


@query(
    "edit06_delete_and_link",
    """
    WITH gone AS (SELECT process_id FROM v_process WHERE output_timebase = 'RUN'),
    kept AS (SELECT process_id, input_product_id FROM v_productprocesslink WHERE process_id NOT IN (SELECT process_id FROM gone))
    SELECT 'process' AS kind, process_id, NULL AS input_product_id FROM v_process WHERE process_id NOT IN (SELECT process_id FROM gone)
    UNION ALL SELECT 'link', process_id, input_product_id FROM kept
    UNION ALL SELECT 'new link', process_id, input_product_id FROM (SELECT DISTINCT process_id, output_product AS input_product_id FROM v_process WHERE output_product IS NOT NULL)
      WHERE (process_id, input_product_id) NOT IN (SELECT (process_id, input_product_id) FROM kept)
    """,
)
def _(t):
    c = catalogue(t)
    c = edits.delete_processes(c, c.process.where("output_timebase = 'RUN'"))
    wanted = t.process.where("output_product IS NOT NULL").select(
        "process_id", F.col("output_product").alias("input_product_id"))
    new = edits.add_input_links(c, wanted)
    return (
        c.process.select(F.lit("process").alias("kind"), "process_id", F.lit(None).cast("bigint").alias("input_product_id"))
        .union(c.productprocesslink.select(F.lit("link"), "process_id", "input_product_id"))
        .union(new.select(F.lit("new link"), "process_id", "input_product_id"))
    )


@query(
    "tpl04_names_filled",
    """
    WITH l AS (SELECT product_id, min(instrument_id) AS instrument_id FROM v_instrumentproductlink GROUP BY 1)
    SELECT p.product_id, CASE WHEN n.n_name IS NULL THEN p.product_description ELSE concat('files of ', p.product_name, ' from ', n.n_name) END AS product_description,
      CASE p.product_id % 3 WHEN 0 THEN concat(coalesce(r.r_name, '{SATELLITE}'), '/', coalesce(n.n_name, '{INSTRUMENT}'), '/', CASE WHEN n.n_name IS NULL THEN '{PRODUCT}' ELSE p.product_name END, '/{Y}/{m}')
        WHEN 1 THEN CASE WHEN n.n_name IS NULL THEN p.relative_path ELSE concat('l', CAST(p.level AS STRING), '/{DATE}/{H}') END ELSE 'flat' END AS relative_path
    FROM v_product_full p LEFT JOIN l ON l.product_id = p.product_id LEFT JOIN nation n ON n.n_nationkey = l.instrument_id LEFT JOIN region r ON r.r_regionkey = n.n_regionkey
    """,
)
def _(t):
    c = catalogue(t)
    link = c.instrumentproductlink.groupBy("product_id").agg(F.min("instrument_id").alias("instrument_id"))
    c = c.replace(instrumentproductlink=link.select("instrument_id", "product_id"))
    return edits.fill_names(c, "product", trace_products(c)).select("product_id", "product_description", "relative_path")


@query(
    "release02_full_paths",
    """
    SELECT f.file_id, concat('/data/set', f.product_id % 4, '/', strftime(f.utc_file_date, '%Y'), '/', f.filename) AS full_path
    FROM v_release r JOIN v_file f USING (file_id) WHERE r.release_num = '1.0'
    """,
)
def _(t):
    c = catalogue(t).replace(product=t.product_plan, instrumentproductlink=t.link_plan)
    return workset.list_release(c, "1.0", trace_products(c), "/data")


@query(
    "release01_add_files",
    """
    SELECT DISTINCT source_file AS file_id, '2.0' AS release_num FROM v_filefilelink WHERE source_file IN (SELECT file_id FROM v_file WHERE exists_on_disk)
    """,
)
def _(t):
    used = t.filefilelink.select(F.col("source_file").alias("file_id"))
    return workset.add_to_release(t.file.where("exists_on_disk"), t.release, used, "2.0")
