"""The given tables reshaped as a file catalogue.

`VIEWS` holds one statement per catalogue table that Spark and DuckDB both
accept; the reshaped rows are the *input* of every registered query.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

VIEWS = {
    "v_file": """SELECT event_id AS file_id,
  CONCAT('p', CAST(user_id AS STRING), '_', REPLACE(CAST(CAST(ts AS DATE) AS STRING), '-', ''), '_v',
    CAST(1 + event_id % 2 AS STRING), '.', CAST(CAST(FLOOR(value) AS BIGINT) % 5 AS STRING), '.', CAST(event_id % 7 AS STRING), '.',
    CAST(event_id AS STRING), '.dat') AS filename,
  CAST(ts AS DATE) AS utc_file_date, ts AS utc_start_time,
  CASE WHEN event_id % 50 = 0 THEN ts + INTERVAL '72' HOUR
       WHEN event_id % 51 = 0 THEN ts + INTERVAL '30' MINUTE
       ELSE ts + INTERVAL '6' HOUR END AS utc_stop_time,
  CAST(user_id % 4 AS DOUBLE) AS data_level,
  CAST(1 + event_id % 2 AS INT) AS interface_version,
  CAST(CAST(FLOOR(value) AS BIGINT) % 5 AS INT) AS quality_version,
  CAST(event_id % 7 AS INT) AS revision_version,
  event_type <> 'error' AS exists_on_disk,
  CAST(user_id AS BIGINT) AS product_id,
  CONCAT('nnn=', CAST(event_id % 3 AS STRING)) AS process_keywords
FROM events""",
    "v_product": """SELECT DISTINCT CAST(user_id AS BIGINT) AS product_id, CONCAT('p', CAST(user_id AS STRING)) AS product_name,
  CAST(user_id % 25 AS INT) AS instrument_id, CAST(user_id % 4 AS DOUBLE) AS level
FROM events""",
    "v_process": """SELECT DISTINCT CAST(user_id AS BIGINT) AS process_id,
  CASE WHEN user_id % 11 = 10 THEN NULL ELSE CAST(user_id + 1 AS BIGINT) END AS output_product,
  CASE WHEN user_id % 11 = 10 THEN 'RUN' WHEN user_id % 3 = 0 THEN 'FILE' ELSE 'DAILY' END AS output_timebase
FROM events WHERE user_id % 4 < 3""",
    "v_productprocesslink": """SELECT DISTINCT CAST(user_id AS BIGINT) AS process_id, CAST(user_id AS BIGINT) AS input_product_id, FALSE AS optional,
  CAST(user_id % 2 AS INT) AS yesterday, CAST(CASE WHEN user_id % 5 = 0 THEN 1 ELSE 0 END AS INT) AS tomorrow
FROM events WHERE user_id % 4 < 3
UNION ALL
SELECT DISTINCT CAST(user_id AS BIGINT), CAST(user_id + 4 AS BIGINT), user_id % 2 = 0, 0, 0
FROM events WHERE user_id % 4 < 3 AND user_id % 8 < 4""",
    "v_code": """SELECT DISTINCT CAST(user_id * 2 AS BIGINT) AS code_id, CAST(user_id AS BIGINT) AS process_id,
  DATE '2010-01-01' AS code_start_date, DATE '2024-01-15' AS code_stop_date,
  1 AS interface_version, 0 AS quality_version, 0 AS revision_version, 1 AS output_interface_version,
  TRUE AS active_code, TRUE AS newest_version
FROM events WHERE user_id % 4 < 3
UNION ALL
SELECT DISTINCT CAST(user_id * 2 + 1 AS BIGINT), CAST(user_id AS BIGINT),
  DATE '2024-01-16', DATE '2099-01-01', 1, 1, 0, 1, user_id % 7 <> 0, TRUE
FROM events WHERE user_id % 4 < 3""",
    "v_filefilelink": """SELECT CAST((event_id - event_id % 2) / 2 AS BIGINT) AS source_file, event_id AS resulting_file FROM events WHERE event_id >= 1
UNION
SELECT CAST((event_id - event_id % 3) / 3 AS BIGINT), event_id FROM events WHERE event_id >= 2""",
    "v_filecodelink": """SELECT event_id AS resulting_file, CAST((user_id - 1) * 2 + event_id % 2 AS BIGINT) AS source_code
FROM events WHERE user_id % 4 > 0""",
    "v_processqueue": """SELECT event_id AS file_id, CAST(NULL AS INT) AS version_bump FROM events WHERE event_id % 13 = 0""",
    "v_release": """SELECT event_id AS file_id, '1.0' AS release_num FROM events WHERE event_id % 97 = 0""",
    "v_log": """SELECT CONCAT(CAST(DATE_TRUNC('second', ts) AS STRING), ',', LPAD(CAST(event_id % 1000 AS STRING), 3, '0'), ' - runner:105 - ',
  CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'signup' THEN 'DEBUG' ELSE 'INFO' END, ' - ',
  CASE event_type WHEN 'click' THEN CONCAT('File p', CAST(user_id AS STRING), '.dat entered in DB, f_id=', CAST(event_id AS STRING))
    WHEN 'purchase' THEN CONCAT('Command: code_', CAST(user_id % 7 AS STRING), '.py took ', CAST(CAST(FLOOR(value) AS BIGINT) AS STRING), ' seconds')
    WHEN 'view' THEN CONCAT('moveToError /inc/f', CAST(event_id AS STRING), '.dat moved to /err')
    ELSE 'noise' END) AS value
FROM events""",
    "v_satellite": """SELECT CAST(r_regionkey AS BIGINT) AS satellite_id, r_name AS satellite_name, CAST(r_regionkey % 2 AS BIGINT) AS mission_id FROM region""",
    "v_mission": """SELECT DISTINCT CAST(r_regionkey % 2 AS BIGINT) AS mission_id, CONCAT('survey', CAST(r_regionkey % 2 AS STRING)) AS mission_name, '/data' AS rootdir, 'incoming' AS incoming_dir FROM region""",
    "v_instrument": """SELECT CAST(n_nationkey AS BIGINT) AS instrument_id, n_name AS instrument_name, CAST(n_regionkey AS BIGINT) AS satellite_id FROM nation""",
    "v_product_full": """SELECT p.product_id, p.product_name, CAST(p.instrument_id AS BIGINT) AS instrument_id, p.level,
  CASE WHEN p.product_id % 3 = 0 THEN '{SATELLITE}/{INSTRUMENT}/{PRODUCT}/{Y}/{m}'
       WHEN p.product_id % 3 = 1 THEN 'l{LEVEL}/{DATE}/{H}'
       ELSE 'flat' END AS relative_path,
  CONCAT('{PRODUCT}_', CASE WHEN p.product_id % 2 = 0 THEN '{Y}{m}{d}' ELSE '{DATE}' END, '_v{VERSION}.{nn}.dat') AS format,
  CONCAT('files of {PRODUCT} from {INSTRUMENT}') AS product_description
FROM v_product p""",
    "v_instrumentproductlink": """SELECT CAST(instrument_id AS BIGINT) AS instrument_id, product_id FROM v_product WHERE product_id % 10 <> 9
UNION ALL
SELECT CAST((instrument_id + 1) % 25 AS BIGINT), product_id FROM v_product WHERE product_id % 10 = 3""",
    "v_inspector": """SELECT product_id AS inspector_id, product_id AS product, product_id % 6 <> 5 AS active_code, TRUE AS newest_version,
  CONCAT('look_', product_name, '.py') AS filename, 'inspectors' AS relative_path, CONCAT('looks at ', product_name) AS description, CONCAT('kind=', product_name, ' deep=yes') AS arguments
FROM v_product""",
    "v_process_full": """SELECT process_id, output_product, output_timebase, CONCAT('make_', CAST(process_id AS STRING)) AS process_name,
  CASE WHEN process_id % 4 = 1 THEN '-d|{DATE}|{ROOTDIR}/aux|{CODEVERSION}' END AS extra_params
FROM v_process""",
    "v_code_full": """SELECT code_id, process_id, code_start_date, code_stop_date, interface_version, quality_version, revision_version,
  output_interface_version, active_code, newest_version, CONCAT('make_', CAST(process_id AS STRING), '.py') AS filename,
  'codes/v{CODEVERSION}' AS relative_path, CONCAT('code of process ', CAST(process_id AS STRING)) AS code_description,
  CONCAT('-i /data/in', CAST(process_id % 3 AS STRING), ' -m {CODEDIR}/mask -i {ROOTDIR}/x -d {DATE}') AS arguments
FROM v_code""",
    "v_file_flags": """SELECT f.*, e.event_type <> 'view' AS newest_version, f.utc_start_time + INTERVAL '36' HOUR AS file_create_date
FROM v_file f JOIN events e ON e.event_id = f.file_id""",
    "v_file_other": """SELECT file_id + 7 AS file_id, filename, utc_file_date, utc_start_time,
  CASE WHEN data_level = 2.0 THEN utc_stop_time + INTERVAL '1' HOUR ELSE utc_stop_time END AS utc_stop_time, data_level,
  interface_version, CAST(CASE WHEN product_id % 9 = 0 THEN quality_version + 1 ELSE quality_version END AS INT) AS quality_version,
  revision_version, CASE WHEN revision_version = 3 THEN NOT exists_on_disk ELSE exists_on_disk END AS exists_on_disk,
  product_id + 1000 AS product_id, CASE WHEN revision_version = 4 THEN CAST(NULL AS STRING) ELSE process_keywords END AS process_keywords
FROM v_file WHERE quality_version <> 4 OR exists_on_disk""",
    "v_product_other": """SELECT product_id + 1000 AS product_id, CASE WHEN product_id % 12 = 7 THEN CONCAT(product_name, 'x') ELSE product_name END AS product_name,
  instrument_id, CASE WHEN product_id % 5 = 0 THEN level + 0.5 ELSE level END AS level FROM v_product""",
    "v_filefilelink_other": """SELECT source_file + 7 AS source_file, resulting_file + 7 AS resulting_file FROM v_filefilelink
WHERE (source_file + resulting_file) % 10 <> 4""",
    "v_queue_bumped": """SELECT event_id AS file_id, CASE WHEN event_type = 'error' THEN 1 END AS version_bump FROM events
WHERE event_type IN ('error', 'purchase', 'signup')""",
    # Files under the names the planner gives; versions of a product and day follow each other.
    "v_file_plan": """SELECT file_id, CONCAT('p', CAST(product_id AS STRING), '_', REPLACE(CAST(utc_file_date AS STRING), '-', ''), '_v1.',
    CAST(quality_version AS STRING), '.', CAST(revision_version AS STRING), '.dat') AS filename,
  utc_file_date, utc_start_time, utc_stop_time, data_level, interface_version, quality_version, revision_version, exists_on_disk, product_id, process_keywords
FROM (SELECT file_id, utc_file_date, utc_start_time, utc_stop_time, data_level, 1 AS interface_version, CAST(FLOOR(n / 2) AS INT) AS quality_version,
    CAST(n % 2 AS INT) AS revision_version, exists_on_disk, product_id, process_keywords
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY product_id, utc_file_date ORDER BY file_id) - 1 AS n FROM v_file) numbered) versioned""",
    "v_product_plan": """SELECT product_id, product_name, CAST(instrument_id AS BIGINT) AS instrument_id, level, CONCAT('set', CAST(product_id % 4 AS STRING), '/{Y}') AS relative_path,
  '{PRODUCT}_{Y}{m}{d}_v{VERSION}.dat' AS format FROM v_product""",
    "v_link_plan": """SELECT CAST(instrument_id AS BIGINT) AS instrument_id, product_id FROM v_product""",
}

_NAME = re.compile(r"\b(v_[a-z_]+)\b")


def _needed(sql: str, found: dict[str, None]) -> None:
    for name in _NAME.findall(sql):
        if name in VIEWS and name not in found:
            _needed(VIEWS[name], found)
            found[name] = None


def oracle(sql: str) -> str:
    """The statement with every view it uses put in front as a WITH entry."""
    found: dict[str, None] = {}
    _needed(sql, found)
    entries = [f"{name} AS ({VIEWS[name]})" for name in found]
    body = sql.strip()
    lead = re.match(r"WITH\s+(RECURSIVE\s+)?", body)
    if lead:
        entries.append(body[lead.end():])
        return "WITH RECURSIVE " + ",\n".join(entries)
    return ("WITH " + ",\n".join(entries) + "\n" + body) if entries else body


class Inputs:
    """Lazy DataFrames of the given tables (`base`) and of the views (by attribute)."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._cache: dict[str, DataFrame] = {}

    def base(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._cache[name]

    def __getattr__(self, name: str) -> DataFrame:
        view = f"v_{name}"
        if view not in VIEWS:
            raise AttributeError(name)
        if view not in self._cache:
            sql = VIEWS[view]
            tables = {}
            for word in dict.fromkeys(re.findall(r"\b[a-z_]+\b", sql)):
                if re.search(rf"\b(FROM|JOIN)\s+{word}\b", sql):
                    tables[word] = getattr(self, word[2:]) if word in VIEWS else self.base(word)
            for word in tables:
                sql = re.sub(rf"\b(FROM|JOIN)\s+{word}\b", rf"\1 {{{word}}}", sql)
            self._cache[view] = self.spark.sql(_escape(sql, tables), **tables)
        return self._cache[view]


def _escape(sql: str, tables) -> str:
    """Double the braces of name templates, which `spark.sql` would read as arguments."""
    marks = {f"{{{t}}}": f"\0{i}\0" for i, t in enumerate(tables)}
    for mark, hidden in marks.items():
        sql = sql.replace(mark, hidden)
    sql = sql.replace("{", "{{").replace("}", "}}")
    for mark, hidden in marks.items():
        sql = sql.replace(hidden, mark)
    return sql
