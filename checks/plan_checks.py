"""The reprocessing plan, stage by stage, with every file as a trigger."""

from pyspark.sql import functions as F

from checks.registry import catalogue, query
from tidemark.operators.catalogue import full_paths
from tidemark.operators.trace import trace_products
from tidemark.plans import reprocess
from tidemark.session import durable

_RANK = """row_number() OVER (PARTITION BY product_id, utc_file_date
  ORDER BY interface_version DESC, quality_version DESC, revision_version DESC, file_id DESC)"""


def plan_catalogue(t):
    """The catalogue to plan over, its tables written once as a catalogue's tables are."""
    views = {
        "file": "file_plan", "product": "product_plan", "instrumentproductlink": "link_plan",
        "inspector": "inspector", "process": "process_full", "code": "code_full",
        "productprocesslink": "productprocesslink",
    }
    return catalogue(t).replace(**{
        table: (lambda view=view: durable(getattr(t, view))) for table, view in views.items()
    })


def _queue(t):
    return t.file_plan.select("file_id", F.lit(None).cast("smallint").alias("version_bump"))


AFFECTED = f"""
  newest AS (SELECT * FROM (SELECT *, {_RANK} AS rk FROM v_file_plan) WHERE rk = 1),
  aff AS (SELECT DISTINCT l.process_id, p.output_timebase AS timebase,
      CAST(unnest(generate_series(CAST(f.utc_start_time AS DATE), CAST(f.utc_stop_time AS DATE), INTERVAL 1 DAY)) AS DATE) AS day,
      CASE WHEN p.output_timebase = 'FILE' THEN f.process_keywords END AS keywords
    FROM newest f JOIN v_productprocesslink l ON l.input_product_id = f.product_id JOIN v_process p USING (process_id))
"""

INPUTS = f"""
  {AFFECTED},
  cand AS (SELECT a.process_id, a.day, l.input_product_id, l.optional, f.file_id, f.process_keywords,
      row_number() OVER (PARTITION BY a.process_id, a.day, l.input_product_id, f.utc_file_date
        ORDER BY f.interface_version DESC, f.quality_version DESC, f.revision_version DESC, f.file_id DESC) AS rk
    FROM (SELECT DISTINCT process_id, timebase, day FROM aff) a JOIN v_productprocesslink l USING (process_id)
    JOIN v_file_plan f ON f.product_id = l.input_product_id AND f.exists_on_disk AND CASE WHEN a.timebase = 'DAILY'
      THEN f.utc_stop_time >= a.day - l.yesterday AND f.utc_start_time < a.day + l.tomorrow + 1
      ELSE f.utc_file_date BETWEEN a.day - l.yesterday AND a.day + l.tomorrow END),
  inp AS (SELECT * FROM cand WHERE rk = 1),
  present AS (SELECT process_id, day, count(DISTINCT CASE WHEN NOT optional THEN input_product_id END) AS n FROM inp GROUP BY 1, 2),
  needed AS (SELECT process_id, count(*) FILTER (NOT optional) AS m FROM v_productprocesslink GROUP BY 1),
  chosen AS (SELECT a.process_id, a.day, a.keywords, string_agg(CAST(i.file_id AS STRING), ',' ORDER BY i.file_id) AS inputs, count(i.file_id) AS n_inputs, min(i.file_id) AS first_input
    FROM aff a JOIN inp i ON i.process_id = a.process_id AND i.day = a.day AND (a.timebase <> 'FILE' OR i.process_keywords IS NOT DISTINCT FROM a.keywords) GROUP BY 1, 2, 3),
  plan1 AS (SELECT a.process_id, a.timebase, a.day, a.keywords, coalesce(c.inputs, '') AS inputs, coalesce(c.n_inputs, 0) AS n_inputs, c.first_input,
      CASE WHEN coalesce(pr.n, 0) < coalesce(nd.m, 0) THEN 'required input missing' WHEN c.inputs IS NULL THEN 'no inputs' END AS reason
    FROM aff a LEFT JOIN chosen c ON c.process_id = a.process_id AND c.day = a.day AND c.keywords IS NOT DISTINCT FROM a.keywords
    LEFT JOIN present pr ON pr.process_id = a.process_id AND pr.day = a.day LEFT JOIN needed nd ON nd.process_id = a.process_id)
"""

CODED = f"""
  {INPUTS},
  code1 AS (SELECT d.process_id, d.day, CASE WHEN count(c.code_id) = 1 THEN min(c.code_id) END AS code_id, count(c.code_id) AS n_codes
    FROM (SELECT DISTINCT process_id, day FROM aff) d LEFT JOIN v_code c ON c.process_id = d.process_id AND c.active_code AND c.newest_version
      AND d.day BETWEEN c.code_start_date AND c.code_stop_date GROUP BY 1, 2),
  plan2 AS (SELECT p.* EXCLUDE (reason), c.code_id, coalesce(p.reason, CASE WHEN c.n_codes = 0 THEN 'no active code' WHEN c.n_codes > 1 THEN 'several active codes' END) AS reason
    FROM plan1 p JOIN code1 c ON c.process_id = p.process_id AND c.day = p.day)
"""

NAMED = f"""
  {CODED},
  plan3 AS (SELECT p.* EXCLUDE (reason), pr.output_product, o.level AS data_level, concat(o.product_name, '_', strftime(p.day, '%Y%m%d'), '_v') AS stem,
      coalesce(p.reason, CASE WHEN p.timebase <> 'RUN' AND o.product_id IS NULL THEN 'no single traceback of the output' END) AS reason
    FROM plan2 p JOIN v_process pr ON pr.process_id = p.process_id LEFT JOIN v_product o ON o.product_id = pr.output_product)
"""

# Existing outputs of each row of plan3 and the step that follows each.
_WALK = """
  tops AS (SELECT product_id, utc_file_date, max((interface_version, quality_version, revision_version)) AS mx FROM v_file_plan GROUP BY 1, 2),
  par AS (SELECT l.resulting_file AS file_id, count(*) AS n_parents,
      max(CASE WHEN t.mx[1] <> f.interface_version OR t.mx[2] <> f.quality_version THEN 1 ELSE 0 END) AS big,
      max(CASE WHEN t.mx[3] <> f.revision_version THEN 1 ELSE 0 END) AS small
    FROM v_filefilelink l JOIN v_file_plan f ON f.file_id = l.source_file JOIN tops t ON t.product_id = f.product_id AND t.utc_file_date = f.utc_file_date GROUP BY 1),
  made1 AS (SELECT resulting_file AS file_id, min(source_code) AS code_id FROM v_filecodelink GROUP BY 1),
  maker AS (SELECT output_product AS product_id, min(process_id) AS process_id FROM v_process WHERE output_product IS NOT NULL GROUP BY 1),
  guess AS (SELECT f.file_id, CASE WHEN count(c.code_id) = 1 THEN min(c.code_id) END AS code_id FROM v_file_plan f JOIN maker m ON m.product_id = f.product_id
    LEFT JOIN v_code c ON c.process_id = m.process_id AND c.active_code AND c.newest_version AND f.utc_file_date BETWEEN c.code_start_date AND c.code_stop_date GROUP BY 1),
  live AS (SELECT * FROM plan3 WHERE reason IS NULL AND timebase <> 'RUN'),
  ex AS (SELECT p.process_id, p.day, p.keywords, p.n_inputs, p.code_id, f.file_id, f.interface_version AS i, f.quality_version AS q, f.revision_version AS r, coalesce(m.code_id, g.code_id) AS made_by
    FROM live p JOIN v_file_plan f ON f.product_id = p.output_product AND f.utc_file_date = p.day
    LEFT JOIN made1 m ON m.file_id = f.file_id LEFT JOIN guess g ON g.file_id = f.file_id),
  st AS (SELECT ex.*, o.interface_version AS oi, o.quality_version AS oq, o.revision_version AS orr, n.interface_version AS ni, n.quality_version AS nq, n.revision_version AS nr, par.n_parents, par.big, par.small
    FROM ex LEFT JOIN v_code o ON o.code_id = ex.made_by LEFT JOIN v_code n ON n.code_id = ex.code_id LEFT JOIN par ON par.file_id = ex.file_id),
  step AS (SELECT *, CASE WHEN oi IS NULL THEN 'error: code of existing output unknown'
      WHEN code_id <> made_by AND (oi, oq, orr) = (ni, nq, nr) THEN 'error: two codes of one version'
      WHEN code_id <> made_by AND ni <> oi THEN 'quality'
      WHEN code_id <> made_by AND nq > oq THEN 'quality'
      WHEN code_id <> made_by AND nr > orr THEN 'revision'
      WHEN code_id <> made_by THEN 'error: code is older than that of the existing output'
      WHEN n_inputs = 0 THEN 'up to date' WHEN n_parents IS NULL THEN 'no parents' WHEN n_parents <> n_inputs THEN 'quality'
      WHEN big = 1 THEN 'quality' WHEN small = 1 THEN 'revision' ELSE 'up to date' END AS what FROM st),
  walk AS (SELECT process_id, day, keywords, 1 AS i, 0 AS q, 0 AS r, CAST(NULL AS STRING) AS outcome FROM live
    UNION ALL
    SELECT w.process_id, w.day, w.keywords, w.i, CASE WHEN s.what = 'quality' THEN w.q + 1 ELSE w.q END,
      CASE WHEN s.what = 'quality' THEN 0 WHEN s.what = 'revision' THEN w.r + 1 ELSE w.r END,
      CASE WHEN s.what NOT IN ('quality', 'revision') THEN s.what END
    FROM walk w JOIN step s ON s.process_id = w.process_id AND s.day = w.day AND s.keywords IS NOT DISTINCT FROM w.keywords AND s.i = w.i AND s.q = w.q AND s.r = w.r
    WHERE w.outcome IS NULL),
  final AS (SELECT process_id, day, keywords, max((i, q, r)) AS v, max(outcome) AS outcome FROM walk GROUP BY 1, 2, 3),
  plan4 AS (SELECT p.*, CASE WHEN p.reason IS NOT NULL THEN concat('not runnable: ', p.reason) ELSE coalesce(f.outcome, 'run') END AS outcome,
      CASE WHEN p.reason IS NULL AND p.timebase = 'RUN' THEN concat('RUN_make_', p.process_id, '_', p.first_input)
           WHEN p.reason IS NULL THEN concat(p.stem, f.v[1], '.', f.v[2], '.', f.v[3], '.dat') END AS filename
    FROM plan3 p LEFT JOIN final f ON f.process_id = p.process_id AND f.day = p.day AND f.keywords IS NOT DISTINCT FROM p.keywords AND p.reason IS NULL AND p.timebase <> 'RUN'),
  runnable AS (SELECT *, CASE WHEN timebase = 'RUN' THEN 5000.0 ELSE data_level END AS lev FROM plan4 WHERE outcome IN ('run', 'no parents')),
  runs AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY filename ORDER BY lev, day, process_id, keywords NULLS FIRST) AS rk FROM runnable) WHERE rk = 1)
"""

WALKED = NAMED + "," + _WALK



@query("plan01_affected_cells", f"WITH {AFFECTED} SELECT process_id, timebase, day, keywords FROM aff")
def _(t):
    return reprocess.affected(plan_catalogue(t), _queue(t)).select("process_id", "timebase", "day", "keywords")


@query(
    "plan01_neighbour_days",
    f"""
    WITH {AFFECTED} SELECT DISTINCT l.process_id, CAST(unnest(generate_series(CAST(f.utc_start_time AS DATE) - l.tomorrow, CAST(f.utc_stop_time AS DATE) + l.yesterday, INTERVAL 1 DAY)) AS DATE) AS day
    FROM newest f JOIN v_productprocesslink l ON l.input_product_id = f.product_id
    """,
)
def _(t):
    return reprocess.affected(plan_catalogue(t), _queue(t), neighbours=True).select("process_id", "day").distinct()


@query("plan02_required_inputs", f"WITH {INPUTS} SELECT process_id, day, keywords, inputs, reason FROM plan1")
def _(t):
    c = plan_catalogue(t)
    return reprocess.required_inputs(c, reprocess.affected(c, _queue(t))).select(
        "process_id", "day", "keywords", F.array_join(F.col("inputs").cast("array<string>"), ",").alias("inputs"), "reason")


@query(
    "join04_interval_overlap",
    f"""
    WITH {AFFECTED}, d AS (SELECT DISTINCT process_id, day FROM aff)
    SELECT process_id, day, input_product_id, file_id FROM (SELECT d.process_id, d.day, l.input_product_id, f.file_id,
        row_number() OVER (PARTITION BY d.process_id, d.day, l.input_product_id, f.utc_file_date
          ORDER BY f.interface_version DESC, f.quality_version DESC, f.revision_version DESC, f.file_id DESC) AS rk
      FROM d JOIN v_productprocesslink l USING (process_id)
      JOIN v_file_plan f ON f.product_id = l.input_product_id AND f.utc_stop_time >= d.day - l.yesterday AND f.utc_start_time < d.day + l.tomorrow + 1)
    WHERE rk = 1
    """,
)
def _(t):
    c = plan_catalogue(t)
    wanted = reprocess.affected(c, _queue(t)).select("process_id", "day").distinct()
    links = c.productprocesslink.withColumn("timebase", F.lit("DAILY"))
    return reprocess.input_candidates(c.file, links).join(wanted, ["process_id", "day"], "left_semi").select(
        "process_id", "day", "input_product_id", "file_id")


@query(
    "plan03_same_keywords",
    f"WITH {INPUTS} SELECT process_id, day, keywords, inputs FROM plan1 WHERE timebase = 'FILE' AND reason IS NULL",
)
def _(t):
    c = plan_catalogue(t)
    rows = reprocess.required_inputs(c, reprocess.affected(c, _queue(t)))
    return rows.where("timebase = 'FILE' AND reason IS NULL").select(
        "process_id", "day", "keywords", F.array_join(F.col("inputs").cast("array<string>"), ",").alias("inputs"))


@query(
    "plan04_chosen_processes",
    f"WITH {AFFECTED} SELECT process_id, day, keywords FROM aff WHERE timebase <> 'RUN' AND process_id IN (1, 2, 5, 6, 9, 10, 21, 32)",
)
def _(t):
    return reprocess.affected(
        plan_catalogue(t), _queue(t), skip_run=True, only=[1, 2, 5, 6, 9, 10, 21, 32]
    ).select("process_id", "day", "keywords")


@query(
    "plan04_processes_by_name",
    f"WITH {AFFECTED} SELECT process_id, day, keywords FROM aff WHERE process_id IN (1, 2, 5, 6, 9, 10, 21, 32)",
)
def _(t):
    names = ["make_1", 2, "make_5", "make_6", 9, "10", "make_21", "make_32", "no such process"]
    return reprocess.affected(plan_catalogue(t), _queue(t), only=names).select("process_id", "day", "keywords")


@query(
    "plan17_range_by_name",
    f"""
    WITH {AFFECTED} SELECT process_id FROM v_process WHERE process_id IN (1, 2, 6, 9)
    """,
)
def _(t):
    c = plan_catalogue(t)
    by_name = reprocess.chosen_processes(c, ["make_1", "make_2", 6, 9])
    named = reprocess.plan_range(c, ["make_1", "make_2", 6, 9], "2024-01-05", "2024-01-25").select("process_id").distinct()
    return by_name.join(named, "process_id", "left").select("process_id")


@query("plan05_code_of_cell", f"WITH {CODED} SELECT process_id, day, keywords, code_id, reason FROM plan2")
def _(t):
    c = plan_catalogue(t)
    cells = reprocess.affected(c, _queue(t))
    dated = cells.select("process_id", "day").distinct()
    plan = reprocess.with_code(c, reprocess.required_inputs(c, cells), dated)
    return plan.select("process_id", "day", "keywords", "code_id", "reason")


@query(
    "plan07_output_names",
    f"""
    WITH {NAMED} SELECT process_id, day, keywords, CASE WHEN timebase = 'RUN' THEN concat('RUN_make_', process_id, '_', coalesce(CAST(first_input AS STRING), 'none')) WHEN data_level IS NOT NULL THEN concat(stem, '{{VERSION}}.dat') END AS name_template,
      CASE WHEN timebase = 'RUN' THEN 5000.0 ELSE data_level END AS data_level FROM plan3
    """,
)
def _(t):
    c = plan_catalogue(t)
    cells = reprocess.affected(c, _queue(t))
    dated = cells.select("process_id", "day").distinct()
    plan = reprocess.with_code(c, reprocess.required_inputs(c, cells), dated)
    return reprocess.with_output(c, plan).select("process_id", "day", "keywords", "name_template", "data_level")


@query(
    "plan10_parent_changes",
    f"WITH {WALKED} SELECT file_id, n_parents, CASE WHEN big = 1 THEN 1 WHEN small = 1 THEN 2 END AS changed FROM par WHERE file_id IN (SELECT file_id FROM v_file_plan)",
)
def _(t):
    c = plan_catalogue(t)
    return reprocess.parent_changes(c, c.file.select("file_id"))


@query("plan11_versions_to_write", f"WITH {WALKED} SELECT process_id, day, keywords, filename, outcome FROM plan4")
def _(t):
    plan = reprocess.plan_changes(plan_catalogue(t), _queue(t))
    return plan.select("process_id", "day", "keywords", F.when(F.col("reason").isNull(), F.col("filename")).alias("filename"), "outcome")


@query(
    "plan12_run_timebase",
    f"WITH {WALKED} SELECT process_id, day, filename, lev AS data_level FROM runnable WHERE timebase = 'RUN'",
)
def _(t):
    plan = reprocess.plan_changes(plan_catalogue(t), _queue(t)).where("timebase = 'RUN' AND runnable")
    return plan.select("process_id", "day", "filename", "data_level")


@query("plan15_run_list", f"WITH {WALKED} SELECT process_id, day, filename, inputs, lev AS data_level FROM runs")
def _(t):
    runs = reprocess.run_list(reprocess.plan_changes(plan_catalogue(t), _queue(t)))
    return runs.select("process_id", "day", "filename", F.array_join(F.col("inputs").cast("array<string>"), ",").alias("inputs"), "data_level")


@query(
    "plan14_commands",
    f"""
    WITH {WALKED}, path AS (SELECT f.file_id, concat('/data/set', f.product_id % 4, '/', strftime(f.utc_file_date, '%Y'), '/', f.filename) AS full_path FROM v_file_plan f),
    lists AS (SELECT r.filename, string_agg(p.full_path, ' ' ORDER BY p.file_id) AS paths FROM runs r, unnest(string_split(r.inputs, ',')) AS u(id) JOIN path p ON p.file_id = CAST(u.id AS BIGINT) GROUP BY 1)
    SELECT r.filename, concat_ws(' ', concat('/codes/codes/v1.', c.quality_version, '.0/make_', r.process_id, '.py'),
      CASE WHEN r.process_id % 4 = 1 THEN concat('-d ', strftime(r.day, '%Y%m%d'), ' /data/aux 1.', c.quality_version, '.0') END,
      concat('-i /data/in', r.process_id % 3, ' -m /codes/codes/v1.', c.quality_version, '.0/mask -i /data/x -d ', strftime(r.day, '%Y%m%d')),
      l.paths, CASE WHEN r.timebase <> 'RUN' THEN concat('/out/', r.filename) END) AS command
    FROM runs r JOIN v_code c ON c.code_id = r.code_id JOIN lists l ON l.filename = r.filename
    """,
)
def _(t):
    c = plan_catalogue(t)
    runs = reprocess.run_list(reprocess.plan_changes(c, _queue(t)))
    runs = reprocess.with_arguments(c, runs, "/data", "/codes")
    paths = full_paths(c.file, trace_products(c), "/data")
    return reprocess.commands(runs, paths, "/out").select("filename", F.array_join("command", " ").alias("command"))


@query(
    "plan13_arguments",
    f"""
    WITH {WALKED} SELECT r.filename, concat_ws('|', CASE WHEN r.process_id % 4 = 1 THEN concat('-d|', strftime(r.day, '%Y%m%d'), '|/data/aux|1.', c.quality_version, '.0') ELSE '' END) AS params,
      concat('-i|/data/in', r.process_id % 3, '|-m|/codes/codes/v1.', c.quality_version, '.0/mask|-i|/data/x|-d|', strftime(r.day, '%Y%m%d')) AS arguments
    FROM runs r JOIN v_code c ON c.code_id = r.code_id
    """,
)
def _(t):
    c = plan_catalogue(t)
    runs = reprocess.run_list(reprocess.plan_changes(c, _queue(t)))
    return reprocess.with_arguments(c, runs, "/data", "/codes").select(
        "filename", F.array_join("params", "|").alias("params"), F.array_join("arguments", "|").alias("arguments"))


# A range plan of every process: the day's own files only, on disk or not.
_RANGE = f"""
  days AS (SELECT CAST(unnest(generate_series(DATE '2024-01-05', DATE '2024-01-25', INTERVAL 1 DAY)) AS DATE) AS day),
  cand AS (SELECT p.process_id, d.day, f.file_id, row_number() OVER (PARTITION BY p.process_id, d.day, l.input_product_id, f.utc_file_date
      ORDER BY f.interface_version DESC, f.quality_version DESC, f.revision_version DESC, f.file_id DESC) AS rk
    FROM v_process p JOIN v_productprocesslink l USING (process_id) CROSS JOIN days d JOIN v_file_plan f ON f.product_id = l.input_product_id
      AND CASE WHEN p.output_timebase = 'DAILY' THEN f.utc_stop_time >= d.day AND f.utc_start_time < d.day + 1 ELSE f.utc_file_date = d.day END),
  r AS (SELECT process_id, day, string_agg(CAST(file_id AS STRING), ',' ORDER BY file_id) AS inputs FROM cand WHERE rk = 1 GROUP BY 1, 2)
"""


@query(
    "plan16_range_plan",
    f"""
    WITH {_RANGE} SELECT r.process_id, r.day, r.inputs,
      CASE WHEN c.n = 0 THEN 'not runnable: no active code' WHEN o.product_id IS NULL AND p.output_timebase <> 'RUN' THEN 'not runnable: no single traceback of the output' ELSE 'run' END AS outcome
    FROM r JOIN v_process p USING (process_id) LEFT JOIN v_product o ON o.product_id = p.output_product
    JOIN LATERAL (SELECT count(*) AS n FROM v_code c WHERE c.process_id = r.process_id AND c.active_code AND c.newest_version AND r.day BETWEEN c.code_start_date AND c.code_stop_date) c ON TRUE
    """,
)
def _(t):
    c = plan_catalogue(t)
    plan = reprocess.plan_range(c, c.process, "2024-01-05", "2024-01-25")
    return plan.select("process_id", "day", F.array_join(F.col("inputs").cast("array<string>"), ",").alias("inputs"), "outcome")


_RANGE_NAMED = f"""
  {_RANGE},
  coded AS (SELECT r.*, p.output_timebase AS timebase, p.output_product, CASE WHEN count(c.code_id) = 1 THEN min(c.code_id) END AS code_id, count(c.code_id) AS n_codes
    FROM r JOIN v_process p USING (process_id) LEFT JOIN v_code c ON c.process_id = r.process_id AND c.active_code AND c.newest_version
      AND r.day BETWEEN c.code_start_date AND c.code_stop_date GROUP BY ALL),
  plan3 AS (SELECT c.process_id, c.timebase, c.day, CAST(NULL AS STRING) AS keywords, c.inputs, length(c.inputs) - length(replace(c.inputs, ',', '')) + 1 AS n_inputs,
      CAST(split_part(c.inputs, ',', 1) AS BIGINT) AS first_input, c.code_id, c.output_product, o.level AS data_level,
      concat(o.product_name, '_', strftime(c.day, '%Y%m%d'), '_v') AS stem,
      CASE WHEN c.n_codes = 0 THEN 'no active code' WHEN c.timebase <> 'RUN' AND o.product_id IS NULL THEN 'no single traceback of the output' END AS reason
    FROM coded c LEFT JOIN v_product o ON o.product_id = c.output_product)
"""


@query("plan16_range_update", f"WITH {_RANGE_NAMED}, {_WALK} SELECT process_id, day, filename, outcome FROM runnable")
def _(t):
    c = plan_catalogue(t)
    plan = reprocess.plan_range(c, c.process, "2024-01-05", "2024-01-25", update=True)
    return plan.select("process_id", "day", "filename", "outcome")


@query(
    "plan17_reprocess_selection",
    f"""
    SELECT file_id, 1 AS version_bump FROM (SELECT *, {_RANK} AS rk FROM v_file_plan WHERE data_level = 2.0 AND utc_file_date BETWEEN DATE '2024-01-04' AND DATE '2024-01-19')
    WHERE rk = 1 AND file_id NOT IN (SELECT file_id FROM v_processqueue)
    """,
)
def _(t):
    return reprocess.reprocess(
        plan_catalogue(t), 1, level=2.0, start_date="2024-01-04", end_date="2024-01-19")
