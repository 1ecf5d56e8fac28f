"""Log parsing, event streams, run times and range reports."""

from pyspark.sql import functions as F

from checks.registry import query
from tidemark.operators import logs

_PARSED = r"""
  p AS (SELECT strptime(replace(substr(value, 1, 23), ',', '.'), '%Y-%m-%d %H:%M:%S.%g') AS ts,
    regexp_extract(value, '^[^,]*,\d+ - (.*?):(\d+) - ([A-Z]+) - (.*)$', 3) AS level, regexp_extract(value, '^[^,]*,\d+ - (.*?):(\d+) - ([A-Z]+) - (.*)$', 4) AS message FROM v_log)
"""


@query("log01_parse_lines", f"WITH {_PARSED} SELECT ts, 'runner' AS module, 105 AS line, level, message FROM p")
def _(t):
    return logs.parse_lines(t.log).select("ts", "module", "line", "level", "message")


@query("log01_time_span", f"WITH {_PARSED} SELECT min(ts) AS first_ts, max(ts) AS last_ts FROM p")
def _(t):
    return logs.time_span(logs.parse_lines(t.log))


@query("log02_by_level", f"WITH {_PARSED} SELECT level, ts, message FROM p WHERE level IN ('ERROR', 'INFO', 'DEBUG')")
def _(t):
    parsed = logs.parse_lines(t.log)
    streams = [logs.of_level(parsed, level).select("level", "ts", "message") for level in ("ERROR", "INFO", "DEBUG")]
    return streams[0].union(streams[1]).union(streams[2])


@query(
    "log03_ingested",
    rf"""
    WITH {_PARSED}, i AS (SELECT ts, regexp_extract(message, '^File (.*) entered', 1) AS filename, CAST(regexp_extract(message, 'f_id=(\d+)', 1) AS BIGINT) AS file_id FROM p WHERE message LIKE 'File % entered in DB%')
    SELECT i.*, coalesce(pr.product_name, 'unknown') AS product_name, f.data_level AS level FROM i
    LEFT JOIN (SELECT * FROM v_file WHERE exists_on_disk AND data_level < 3) f USING (file_id) LEFT JOIN v_product pr ON pr.product_id = f.product_id
    """,
)
def _(t):
    known = t.file.where("exists_on_disk AND data_level < 3").join(t.product, "product_id")
    return logs.ingested(logs.parse_lines(t.log), known).select("ts", "filename", "file_id", "product_name", "level")


@query(
    "log04_moved_to_error",
    rf"WITH {_PARSED} SELECT ts, regexp_extract(message, '/inc/(\S+)', 1) AS filename FROM p WHERE message LIKE 'moveToError%'",
)
def _(t):
    return logs.moved_to_error(logs.parse_lines(t.log))


# The given log writes finished runs; the start lines are made from the same rows.
_STARTED = """
  started AS (SELECT ts, CASE WHEN minute(ts) % 2 = 0 THEN concat('running command: ', split_part(message, ' ', 2), ' x') ELSE concat('Command: ', split_part(message, ' ', 2), ' x starting') END AS message,
    split_part(message, ' ', 2) AS filename FROM p WHERE message LIKE 'Command:%')
"""


def _started(t):
    parsed = logs.parse_lines(t.log)
    code = F.split("message", " ")[1]
    message = F.when(
        F.minute("ts") % 2 == 0, F.concat(F.lit("running command: "), code, F.lit(" x"))
    ).otherwise(F.concat(F.lit("Command: "), code, F.lit(" x starting")))
    return parsed.where("message LIKE 'Command:%'").withColumn("message", message)


@query("log05_first_commands", f"WITH {_PARSED}, {_STARTED} SELECT filename, min(ts) AS ts FROM started GROUP BY 1")
def _(t):
    return logs.commands_run(_started(t))


@query(
    "log06_run_time_histogram",
    rf"""
    WITH {_PARSED}, r AS (SELECT split_part(message, ' ', 2) AS code, CAST(split_part(message, ' ', 4) AS DOUBLE) AS s FROM p WHERE message LIKE 'Command: %took%')
    SELECT code, CAST(CASE WHEN s < 0 THEN 0 WHEN s >= 60 THEN 13 ELSE floor(s / 5) + 1 END AS BIGINT) AS bin, count(*) AS runs FROM r GROUP BY 1, 2
    """,
)
def _(t):
    return logs.run_time_histogram(logs.run_times(logs.parse_lines(t.log)), 0, 60, 12)


@query(
    "log06_run_time_extremes",
    rf"""
    WITH {_PARSED}, r AS (SELECT split_part(message, ' ', 2) AS code, CAST(split_part(message, ' ', 4) AS DOUBLE) AS s FROM p WHERE message LIKE 'Command: %took%')
    SELECT code, count(*) AS runs, min(s) AS shortest, max(s) AS longest FROM r GROUP BY 1
    """,
)
def _(t):
    return logs.run_time_summary(logs.run_times(logs.parse_lines(t.log))).select("code", "runs", "shortest", "longest")


_REPORT = rf"""
  WITH {_PARSED}, a AS (
    SELECT 'ingested' AS kind, ts, regexp_extract(message, '^File (.*) entered', 1) AS what FROM p WHERE message LIKE 'File % entered in DB%'
    UNION ALL SELECT 'moved', ts, regexp_extract(message, '/inc/(\S+)', 1) FROM p WHERE message LIKE 'moveToError%'
    UNION ALL SELECT 'error', ts, concat('runner:105 ', message) FROM p WHERE level = 'ERROR'),
  r AS (SELECT * FROM a WHERE ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-15')
"""


@query("log07_range_report", _REPORT + "SELECT kind, ts, what FROM r")
def _(t):
    return logs.range_report(logs.parse_lines(t.log), "2024-01-08", "2024-01-14")


@query("log07_report_counts", _REPORT + "SELECT kind, count(*) AS entries FROM r GROUP BY 1")
def _(t):
    return logs.report_counts(logs.range_report(logs.parse_lines(t.log), "2024-01-08", "2024-01-14"))
