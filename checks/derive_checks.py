"""Derivations: lines of conversations, text of documents, user code on planned runs."""

from pyspark.sql import functions as F

from checks.audit_checks import DISK, files_of_documents
from checks.plan_checks import WALKED, _queue, plan_catalogue
from checks.registry import query
from tidemark.operators import derive
from tidemark.plans import reprocess
from tidemark.sources.listing import full_uri, list_folder


@query(
    "derive02_concatenate",
    """
    WITH s AS (SELECT concat('conv_', conv_id) AS output, concat('turn_', lpad(CAST(turn AS STRING), 4, '0'), '_', role) AS input, string_split(text, chr(10)) AS lines FROM conversations)
    SELECT output, input, CAST(l.pos - 1 AS INT) AS line_no, s.lines[l.pos] AS line FROM s, unnest(generate_series(1, len(s.lines))) AS l(pos)
    """,
)
def _(t):
    # Each conversation is one output made from its turns, the turns being the input files.
    turn = F.concat(F.lit("turn_"), F.lpad(F.col("turn").cast("string"), 4, "0"), F.lit("_"), "role")
    files = t.base("conversations").select(
        F.concat(F.lit("conv_"), "conv_id").alias("output"), turn.alias("input"),
        F.concat_ws("/", "conv_id", turn).alias("file_id"), F.col("text"))
    lines = files.select("file_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return derive.concatenate(files.drop("text"), lines)


@query(
    "derive03_rot13",
    """
    SELECT doc_id, translate(text, 'abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ', 'nopqrstuvwxyzabcdefghijklmNOPQRSTUVWXYZABCDEFGHIJKLM') AS turned FROM documents
    """,
)
def _(t):
    return t.base("documents").select("doc_id", derive.rot13(F.col("text")).alias("turned"))


def _planned_runs(t):
    c = plan_catalogue(t)
    runs = reprocess.run_list(reprocess.plan_changes(c, _queue(t)))
    contents = c.file.select("file_id", F.concat_ws(" ", "filename", "process_keywords").alias("content"))
    return runs, c.file, contents


def _join_unless_many():
    """User code made in place, so that it travels to the workers by value."""

    def work(inputs, arguments, name):
        if len(inputs) > 3:
            raise ValueError(f"{len(inputs)} inputs")
        return "\n".join(inputs["content"])

    return work


_RESULTS = f"""
  WITH {WALKED}, g AS (SELECT r.filename, count(*) AS n, string_agg(concat(f.filename, ' ', f.process_keywords), chr(10) ORDER BY f.filename) AS content
    FROM runs r, unnest(string_split(r.inputs, ',')) AS u(id) JOIN v_file_plan f ON f.file_id = CAST(u.id AS BIGINT) GROUP BY 1),
  res AS (SELECT filename, CASE WHEN n > 3 THEN 'failed' ELSE 'ok' END AS status, CASE WHEN n > 3 THEN concat('ValueError: ', n, ' inputs') END AS error,
    CASE WHEN n <= 3 THEN sha1(content) END AS shasum FROM g)
"""


@query("derive01_user_code", _RESULTS + "SELECT * FROM res")
def _(t):
    runs, files, contents = _planned_runs(t)
    return derive.run_code(runs, files, contents, _join_unless_many()).drop("content")


@query("derive06_status_counts", _RESULTS + "SELECT status, count(*) AS runs FROM res GROUP BY 1")
def _(t):
    runs, files, contents = _planned_runs(t)
    return derive.status_counts(derive.run_code(runs, files, contents, _join_unless_many()))


@query(
    "derive05_provenance_links",
    f"""
    WITH {WALKED}, good AS (SELECT r.* FROM runs r WHERE r.timebase <> 'RUN' AND r.outcome = 'run')
    SELECT g.filename, g.code_id, CAST(u.id AS BIGINT) AS source_file FROM good g, unnest(string_split(g.inputs, ',')) AS u(id)
    WHERE g.output_product IN (SELECT product FROM v_inspector WHERE active_code)
    """,
)
def _(t):
    from tidemark.operators.ingest import inspection_rules
    from tidemark.operators.trace import trace_products
    from tidemark.session import durable

    c = plan_catalogue(t)
    trace = trace_products(c).withColumn("format", F.replace("format", F.lit("{VERSION}.dat"), F.lit("{VERSION}\\.dat")))
    runs = durable(reprocess.run_list(reprocess.plan_changes(c, _queue(t))))
    results = runs.select("filename", F.lit("ok").alias("status"), F.sha1(F.col("filename").cast("binary")).alias("shasum"))
    made = derive.ingest_outputs(
        c, runs.where("outcome = 'run'"), results, inspection_rules(c, trace), trace, "/data", "2024-03-01 00:00:00")
    names = made.files.select(F.col("file_id").alias("resulting_file"), "filename")
    return made.filefilelink.join(made.filecodelink, "resulting_file").join(names, "resulting_file").select(
        "filename", F.col("source_code").alias("code_id"), "source_file")


def _framed():
    """A program in pieces: every input between a byte 0 and a byte 255, which no text holds."""

    def work(inputs, arguments, output):
        for given in inputs:
            output.write(b"\x00")
            for part in given.portions():
                output.write(part)
            output.write(b"\xff")

    return work


_SETS = f"""
  WITH d AS (SELECT concat('set_', CAST(FLOOR(doc_id / 4) AS BIGINT), '.bin') AS output, * FROM ({DISK})),
  r AS (SELECT output AS filename, max(CASE WHEN doc_id % 11 = 3 THEN 1 ELSE 0 END) AS gap,
      unhex(string_agg(concat('00', hex(encode(content)), 'FF'), '' ORDER BY filename)) AS bytes FROM d GROUP BY 1)
"""


@query(
    "derive01_binary",
    _SETS + """SELECT filename, CASE WHEN gap = 1 THEN 'failed' ELSE 'ok' END AS status,
      CASE WHEN gap = 0 THEN octet_length(bytes) END AS length, CASE WHEN gap = 0 THEN sha1(bytes) END AS shasum,
      CASE WHEN gap = 0 THEN sha1(bytes) END AS shasum_on_disk FROM r""",
)
def _(t):
    # Four files a run, read and written by path; a run with a file that is not there fails. The folder is listed afterwards.
    from tidemark.operators.programs import run_programs

    folder, listed = files_of_documents(t)
    files = listed.select(F.col("doc_id").alias("file_id"), "filename", F.concat(F.lit("file://"), "full_path").alias("uri"))
    runs = files.groupBy(F.concat(F.lit("set_"), F.floor(F.col("file_id") / 4), F.lit(".bin")).alias("filename")).agg(
        F.collect_list("file_id").alias("inputs"))
    made = f"{full_uri(folder)}_made"
    results = run_programs(runs, files, _framed(), made)
    lying = list_folder(t.spark, made, recursive=True, digest=True).select("filename", F.col("shasum").alias("shasum_on_disk"))
    return results.drop("error", "uri").join(lying, "filename", "full")
