"""Rules, consistency reports and comparisons of two catalogues."""

import uuid

from pyspark.sql import functions as F

from checks.catalogue_checks import NEWEST
from checks.registry import catalogue, query
from tidemark.model import Catalogue
from tidemark.operators import audit


@query(
    "audit01_rule_violations",
    """
    SELECT 'process' AS table_name, 'output_product references product.product_id' AS rule, CAST(process_id AS STRING) AS key, CAST(output_product AS STRING) AS detail
    FROM v_process WHERE output_product IS NOT NULL AND output_product NOT IN (SELECT product_id FROM v_product)
    UNION ALL SELECT 'productprocesslink', 'input_product_id references product.product_id', concat(process_id, '|', input_product_id), CAST(input_product_id AS STRING)
    FROM v_productprocesslink WHERE input_product_id NOT IN (SELECT product_id FROM v_product)
    UNION ALL SELECT 'file', 'unique utc_file_date,product_id,interface_version,quality_version,revision_version',
      concat(utc_file_date, '|', product_id, '|', interface_version, '|', quality_version, '|', revision_version), concat(count(*), ' rows')
    FROM v_file GROUP BY utc_file_date, product_id, interface_version, quality_version, revision_version HAVING count(*) > 1
    UNION ALL SELECT 'filecodelink', 'source_code references code.code_id', concat(resulting_file, '|', source_code), CAST(source_code AS STRING)
    FROM v_filecodelink WHERE source_code NOT IN (SELECT code_id FROM v_code)
    """,
)
def _(t):
    return audit.violations(catalogue(t))


@query(
    "audit02_instrument_links",
    """
    SELECT p.product_id, p.product_name, count(l.product_id) AS links FROM v_product p LEFT JOIN v_instrumentproductlink l USING (product_id)
    GROUP BY 1, 2 HAVING count(l.product_id) <> 1
    """,
)
def _(t):
    return audit.instrument_link_faults(catalogue(t))


@query(
    "audit03_odd_durations",
    f"""
    WITH {NEWEST}, d AS (SELECT file_id, filename, floor((epoch_us(utc_stop_time) - epoch_us(utc_start_time)) / 1000000) / 86400 AS days FROM newest)
    SELECT *, CASE WHEN days < 1 / 24 THEN 'short' WHEN days > 2 AND days < 6 THEN 'odd week' WHEN days > 8 AND days < 27 THEN 'odd month' ELSE 'odd year' END AS kind
    FROM d WHERE days < 1 / 24 OR (days > 2 AND days < 6) OR (days > 8 AND days < 27) OR (days > 35 AND days < 364) OR days > 368
    """,
)
def _(t):
    return audit.odd_durations(t.file)


@query(
    "audit04_wrong_newest_flag",
    """
    WITH m AS (SELECT product_id, utc_file_date, max((interface_version, quality_version, revision_version)) AS mx FROM v_file GROUP BY 1, 2),
    s AS (SELECT f.file_id, f.filename, f.newest_version, ((f.interface_version, f.quality_version, f.revision_version) = m.mx) AS should
      FROM v_file_flags f JOIN m USING (product_id, utc_file_date))
    SELECT file_id, filename, CASE WHEN should THEN 'not marked newest' ELSE 'marked newest' END AS fault FROM s WHERE should <> newest_version
    """,
)
def _(t):
    return audit.wrong_newest_flag(t.file_flags)


@query(
    "audit05_dates_without_newest",
    "SELECT product_id, utc_file_date FROM v_file_flags GROUP BY 1, 2 HAVING NOT bool_or(newest_version)",
)
def _(t):
    return audit.dates_without_newest(t.file_flags)


@query(
    "audit06_parents_not_newest",
    f"""
    WITH {NEWEST} SELECT DISTINCT l.source_file AS file_id FROM v_filefilelink l WHERE l.resulting_file IN (SELECT file_id FROM newest)
      AND l.source_file NOT IN (SELECT file_id FROM newest)
    """,
)
def _(t):
    return audit.parents_not_newest(t.file, t.filefilelink)


@query(
    "audit07_large_version_parts",
    """
    SELECT 'interface' AS part, max(interface_version) AS highest, max(interface_version) >= 5 AS too_large FROM v_file
    UNION ALL SELECT 'quality', max(quality_version), max(quality_version) >= 5 FROM v_file
    UNION ALL SELECT 'revision', max(revision_version), max(revision_version) >= 5 FROM v_file
    """,
)
def _(t):
    return audit.large_version_parts(t.file, 5)


@query(
    "audit08_newest_created_earlier",
    f"""
    WITH {NEWEST}, m AS (SELECT product_id, utc_file_date, max(file_create_date) AS last_created FROM v_file_flags GROUP BY 1, 2)
    SELECT n.file_id, n.filename, f.file_create_date, m.last_created FROM newest n JOIN v_file_flags f USING (file_id)
    JOIN m ON m.product_id = n.product_id AND m.utc_file_date = n.utc_file_date WHERE f.file_create_date < m.last_created
    """,
)
def _(t):
    return audit.newest_created_earlier(t.file_flags)


@query(
    "audit09_newest_rule_differences",
    f"""
    WITH {NEWEST}, num AS (SELECT *, 1000 * interface_version + 100 * quality_version + revision_version AS vn FROM v_file),
    one AS (SELECT file_id FROM (SELECT file_id, row_number() OVER (PARTITION BY product_id, utc_file_date ORDER BY vn DESC, file_id DESC) AS rk FROM num) WHERE rk = 1),
    tops AS (SELECT product_id, utc_file_date, max(vn) AS vn FROM num GROUP BY 1, 2),
    two AS (SELECT file_id FROM num WHERE (product_id, vn) IN (SELECT (product_id, vn) FROM tops))
    SELECT 'per date' AS rule, 'version only' AS side, file_id FROM newest WHERE file_id NOT IN (SELECT file_id FROM one)
    UNION ALL SELECT 'per date', 'number only', file_id FROM one WHERE file_id NOT IN (SELECT file_id FROM newest)
    UNION ALL SELECT 'any date', 'version only', file_id FROM newest WHERE file_id NOT IN (SELECT file_id FROM two)
    UNION ALL SELECT 'any date', 'number only', file_id FROM two WHERE file_id NOT IN (SELECT file_id FROM newest)
    """,
)
def _(t):
    return audit.newest_rule_differences(t.file)


@query(
    "audit10_dangling_products",
    """
    SELECT process_id, 'input' AS role, input_product_id AS product_id FROM v_productprocesslink WHERE input_product_id NOT IN (SELECT product_id FROM v_product)
    UNION ALL SELECT process_id, 'output', output_product FROM v_process WHERE output_product IS NOT NULL AND output_product NOT IN (SELECT product_id FROM v_product)
    """,
)
def _(t):
    return audit.dangling_process_products(catalogue(t))


@query(
    "audit11_checksums",
    """
    WITH disk AS (SELECT url AS full_path, sha1(html) AS shasum, page_id FROM pages),
    cat AS (SELECT d.doc_id AS file_id, concat('doc', d.doc_id) AS filename, p.url AS full_path, CASE WHEN d.lang = 'en' THEN sha1(p.html) ELSE sha1(d.text) END AS shasum
      FROM documents d LEFT JOIN pages p ON p.page_id = d.doc_id)
    SELECT c.file_id, c.filename, CASE WHEN c.full_path IS NULL THEN 2 ELSE 1 END AS result FROM cat c LEFT JOIN disk d ON d.page_id = c.file_id
    WHERE c.full_path IS NULL OR c.shasum <> d.shasum
    """,
)
def _(t):
    from tidemark.sources.listing import with_digest

    d, p = t.base("documents"), t.base("pages")
    disk = with_digest(p.select(F.concat_ws("#", "url", "page_id").alias("path"), F.col("html").alias("content")))
    listed = d.join(p, d.doc_id == p.page_id, "left").select(
        F.col("doc_id").alias("file_id"), F.concat(F.lit("doc"), "doc_id").alias("filename"),
        F.when(F.col("url").isNotNull(), F.concat_ws("#", "url", "page_id")).alias("full_path"),
        F.sha1(F.when(F.col("lang") == "en", F.coalesce("html", F.lit(""))).otherwise(F.col("text"))).alias("shasum"),
    )
    return audit.checksum_audit(listed, disk)


def files_of_documents(t):
    """Write documents as files in a folder of the query's own: some empty, some with a leading bar, some left out."""
    from tidemark.session import checkpoint_folder

    folder = f"{checkpoint_folder(t.spark)}/listed/{uuid.uuid4().hex}".removeprefix("file://").removeprefix("file:")
    name = F.concat(F.when(F.col("doc_id") % 5 == 0, "_").otherwise(""), F.lit("f"), "doc_id", F.lit(".txt"))
    files = t.base("documents").select(
        "doc_id", name.alias("filename"), F.concat(F.lit(f"{folder}/"), F.col("doc_id") % 10, F.lit("/"), name).alias("full_path"),
        F.when(F.col("doc_id") % 7 == 0, "").otherwise(F.coalesce("text", F.lit(""))).alias("text"))

    def write(batches):
        import os

        for batch in batches:
            for at in range(0, batch.num_rows, 100):  # so few texts at a time lie in a worker as Python's
                part = batch.slice(at, 100)
                for path, text in zip(part.column("full_path").to_pylist(), part.column("text").to_pylist()):
                    os.makedirs(os.path.dirname(path), exist_ok=True)
                    with open(path, "wb") as file:
                        file.write(text.encode())
            yield batch.select(["doc_id"])

    written = files.where("doc_id % 11 <> 3").mapInArrow(write, "doc_id bigint")
    written.agg(F.count("doc_id")).collect()
    return folder, files


DISK = """SELECT concat(CASE WHEN doc_id % 5 = 0 THEN '_' ELSE '' END, 'f', doc_id, '.txt') AS filename, doc_id,
      CASE WHEN doc_id % 7 = 0 THEN '' ELSE coalesce(text, '') END AS content FROM documents"""


@query("src03_listing", f"SELECT filename, CAST(strlen(content) AS BIGINT) AS length, sha1(content) AS shasum FROM ({DISK}) WHERE doc_id % 11 <> 3")
def _(t):
    from tidemark.sources.listing import list_folder

    folder, _files = files_of_documents(t)
    return list_folder(t.spark, folder, recursive=True, digest=True).select("filename", "length", "shasum")


@query(
    "audit11_files_on_disk",
    f"""
    SELECT doc_id AS file_id, filename, CASE WHEN doc_id % 11 = 3 THEN 2 ELSE 1 END AS result FROM ({DISK})
    WHERE doc_id % 11 = 3 OR doc_id % 4 = 1
    """,
)
def _(t):
    from tidemark.sources.listing import list_folder

    folder, files = files_of_documents(t)
    told = files.select(F.col("doc_id").alias("file_id"), "filename", "full_path",
                        F.when(F.col("doc_id") % 4 == 1, "other").otherwise(F.sha1(F.col("text").cast("binary"))).alias("shasum"))
    return audit.checksum_audit(told, list_folder(t.spark, folder, recursive=True, digest=True))


@query("audit14_listed_files", f"SELECT doc_id AS file_id, filename FROM ({DISK}) WHERE doc_id % 11 = 3")
def _(t):
    from tidemark.sources.listing import list_folder

    folder, files = files_of_documents(t)
    told = files.select(F.col("doc_id").alias("file_id"), "filename", "full_path", F.lit(True).alias("exists_on_disk"))
    return audit.existence_audit(told, list_folder(t.spark, folder, recursive=True)).select("file_id", "filename")


_CODE_KEYS = """SELECT code_id, concat('d', code_id, '|x') AS a, 'f' AS b, CASE WHEN code_id % 2 = 0 THEN 'null' END AS c,
      relative_path AS r FROM v_code_full"""


@query(
    "audit12_compare_codes",
    f"""
    WITH l AS ({_CODE_KEYS}),
    o AS (SELECT code_id, CASE WHEN code_id % 3 = 1 THEN concat('d', code_id) ELSE a END AS a, CASE WHEN code_id % 3 = 1 THEN 'x|f' ELSE b END AS b,
      CASE WHEN code_id % 3 = 2 THEN CASE WHEN c IS NULL THEN 'null' END ELSE c END AS c, concat(r, '/new') AS r FROM l)
    SELECT concat(l.a, '|', l.b, '|', coalesce(l.c, 'null')) AS key, 'relative_path' AS attribute, l.r AS "left", o.r AS "right" FROM l JOIN o USING (code_id) WHERE code_id % 3 = 0
    UNION ALL SELECT concat(a, '|', b, '|', coalesce(c, 'null')), 'only left', NULL, NULL FROM l WHERE code_id % 3 <> 0
    UNION ALL SELECT concat(a, '|', b, '|', coalesce(c, 'null')), 'only right', NULL, NULL FROM o WHERE code_id % 3 <> 0
    """,
)
def _(t):
    # Keys that look alike when their parts are glued, and null against the word null.
    n = F.col("code_id")
    left = t.code_full.select(
        "code_id", F.concat(F.lit("d"), n, F.lit("|x")).alias("a"), F.lit("f").alias("b"),
        F.when(n % 2 == 0, "null").alias("c"), F.col("relative_path").alias("relative_path"))
    right = left.select(
        F.when(n % 3 == 1, F.concat(F.lit("d"), n)).otherwise(F.col("a")).alias("a"),
        F.when(n % 3 == 1, "x|f").otherwise(F.col("b")).alias("b"),
        F.when(n % 3 == 2, F.when(F.col("c").isNull(), "null")).otherwise(F.col("c")).alias("c"),
        F.concat("relative_path", F.lit("/new")).alias("relative_path"))
    return audit.compare_rows(left, right, ["a", "b", "c"], ["relative_path"])


def _other(t):
    return Catalogue(
        file=t.file_other.withColumn("product_id", F.col("product_id")), product=t.product_other,
        instrument=t.instrument, filefilelink=t.filefilelink_other,
    )


def _mine(t):
    return Catalogue(file=t.file, product=t.product, instrument=t.instrument, filefilelink=t.filefilelink)


_DIFF_COLUMNS = ["utc_file_date", "utc_start_time", "utc_stop_time", "data_level", "interface_version", "quality_version",
                 "revision_version", "exists_on_disk", "process_keywords"]


@query(
    "audit12_compare_files",
    """
    WITH a AS (SELECT f.*, coalesce(p.product_name, '') AS pn FROM v_file f LEFT JOIN v_product p USING (product_id)),
    b AS (SELECT f.*, coalesce(p.product_name, '') AS pn FROM v_file_other f LEFT JOIN v_product_other p USING (product_id)),
    j AS (SELECT a.*, b.utc_stop_time AS t2, b.quality_version AS q2, b.exists_on_disk AS e2, b.process_keywords AS k2, b.pn AS pn2 FROM a JOIN b USING (filename))
    SELECT 'file' AS table_name, filename AS key, 'only left' AS attribute, CAST(NULL AS STRING) AS "left", CAST(NULL AS STRING) AS "right" FROM a WHERE filename NOT IN (SELECT filename FROM b)
    UNION ALL SELECT 'file', filename, 'quality_version', CAST(quality_version AS STRING), CAST(q2 AS STRING) FROM j WHERE quality_version <> q2
    UNION ALL SELECT 'file', filename, 'exists_on_disk', CAST(exists_on_disk AS STRING), CAST(e2 AS STRING) FROM j WHERE exists_on_disk <> e2
    UNION ALL SELECT 'file', filename, 'process_keywords', process_keywords, k2 FROM j WHERE process_keywords IS DISTINCT FROM k2
    UNION ALL SELECT 'file', filename, 'product_id', pn, pn2 FROM j WHERE pn <> pn2
    UNION ALL SELECT 'file', filename, 'utc_stop_time', strftime(utc_stop_time, '%Y-%m-%d %H:%M:%S.%f'), strftime(t2, '%Y-%m-%d %H:%M:%S.%f') FROM j WHERE utc_stop_time <> t2
    """,
)
def _(t):
    diff = audit.compare_table(_mine(t), _other(t), "file")

    def micros(name):
        # Spark prints no trailing zeros in a fraction; the SQL side prints six digits.
        moment = F.col(name).try_cast("timestamp_ntz")
        return F.when(F.col("attribute") == "utc_stop_time", F.date_format(moment, "yyyy-MM-dd HH:mm:ss.SSSSSS")).otherwise(F.col(name))

    return diff.withColumns({"left": micros("left"), "right": micros("right")})


@query(
    "audit12_compare_products",
    """
    WITH j AS (SELECT a.product_name, a.level AS l1, b.level AS l2 FROM v_product a JOIN v_product_other b USING (product_name))
    SELECT 'product' AS table_name, product_name AS key, 'only left' AS attribute, CAST(NULL AS STRING) AS "left", CAST(NULL AS STRING) AS "right" FROM v_product WHERE product_name NOT IN (SELECT product_name FROM v_product_other)
    UNION ALL SELECT 'product', product_name, 'only right', NULL, NULL FROM v_product_other WHERE product_name NOT IN (SELECT product_name FROM v_product)
    UNION ALL SELECT 'product', product_name, 'level', CAST(l1 AS STRING), CAST(l2 AS STRING) FROM j WHERE l1 <> l2
    """,
)
def _(t):
    return audit.compare_table(_mine(t), _other(t), "product")


@query(
    "audit13_compare_lineage",
    """
    WITH a AS (SELECT c.filename AS child, p.filename AS parent FROM v_filefilelink l JOIN v_file p ON p.file_id = l.source_file JOIN v_file c ON c.file_id = l.resulting_file),
    b AS (SELECT c.filename AS child, p.filename AS parent FROM v_filefilelink_other l JOIN v_file_other p ON p.file_id = l.source_file JOIN v_file_other c ON c.file_id = l.resulting_file)
    SELECT *, 'left' AS side FROM (SELECT * FROM a EXCEPT SELECT * FROM b) WHERE child IN (SELECT filename FROM v_file_other)
    UNION ALL SELECT *, 'right' FROM (SELECT * FROM b EXCEPT SELECT * FROM a) WHERE child IN (SELECT filename FROM v_file)
    """,
)
def _(t):
    return audit.compare_lineage(_mine(t), _other(t))


@query(
    "audit13_compare_codes",
    """
    WITH j AS (SELECT f.filename, count(l.source_code) AS n1, min(c.filename) AS a1 FROM v_file f LEFT JOIN v_filecodelink l ON l.resulting_file = f.file_id LEFT JOIN v_code_full c ON c.code_id = l.source_code GROUP BY 1),
    k AS (SELECT f.filename, count(l.source_code) AS n2, min(c.filename) AS a2 FROM v_file f LEFT JOIN v_filecodelink l ON l.resulting_file = f.file_id AND f.data_level <> 2.0 LEFT JOIN v_code_full c ON c.code_id = l.source_code AND c.process_id % 3 <> 0 GROUP BY 1)
    SELECT filename, 'codes' AS attribute, CAST(n1 AS STRING) AS "left", CAST(n2 AS STRING) AS "right" FROM j JOIN k USING (filename) WHERE n1 <> n2 OR n1 > 1
    UNION ALL SELECT filename, u.attribute, CASE u.attribute WHEN 'filename' THEN a1 WHEN 'relative_path' THEN 'codes/v{CODEVERSION}' WHEN 'arguments' THEN ag ELSE ds END, NULL
    FROM (SELECT j.filename, a1, min(c.arguments) AS ag, min(c.code_description) AS ds FROM j JOIN k USING (filename) JOIN v_code_full c ON c.filename = a1 WHERE n1 = n2 AND n1 = 1 AND a2 IS NULL GROUP BY 1, 2) x
    CROSS JOIN (SELECT unnest(['filename', 'relative_path', 'arguments', 'code_description']) AS attribute) u
    """,
)
def _(t):
    mine = catalogue(t)
    some = t.file.where("data_level <> 2.0").select(F.col("file_id").alias("resulting_file"))
    other = mine.replace(
        filecodelink=mine.filecodelink.join(some, "resulting_file", "left_semi"),
        code=mine.code.where("process_id % 3 <> 0"),
    )
    return audit.compare_codes_of_files(mine, other)


@query(
    "audit14_missing_on_disk",
    f"""
    WITH {NEWEST} SELECT file_id, filename, concat('/data/', filename) AS full_path FROM newest
    WHERE exists_on_disk AND concat('/data/', filename) NOT IN (SELECT concat('/data/', filename) FROM v_file_other WHERE quality_version <> 1)
    """,
)
def _(t):
    files = t.file.withColumn("full_path", F.concat(F.lit("/data/"), "filename"))
    listing = t.file_other.where("quality_version <> 1").select(F.concat(F.lit("/data/"), "filename").alias("path"))
    return audit.existence_audit(files, listing, newest_only=True)
