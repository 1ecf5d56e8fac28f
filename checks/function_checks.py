"""Scalar functions over every row of the given tables."""

from pyspark.sql import functions as F

from checks.registry import query
from tidemark.functions import dates, templates, text, version
from tidemark.functions.version import version as make_version
from tidemark.functions.version import version_of

_TRIPLE = "regexp_extract(filename, '[vV](\\d+)\\.(\\d+)\\.(\\d+)\\.', {0})"


@query(
    "ver01_parse_version",
    """
    WITH t AS (SELECT event_id, props, split_part(CAST(value AS STRING), '.', 1) AS a,
                      CAST(event_id % 12 AS STRING) AS b, event_type FROM events),
    s AS (SELECT event_id, CASE WHEN event_type = 'error' THEN concat(a, '.', b)
                                ELSE concat(a, '.', b, '.3') END AS txt FROM t)
    SELECT event_id,
      CASE WHEN regexp_matches(txt, '^\\d+\\.\\d+\\.\\d+$') AND NOT starts_with(txt, '0.') THEN txt END AS parsed,
      CASE WHEN NOT regexp_matches(txt, '^\\d+\\.\\d+\\.\\d+$') THEN 'malformed'
           WHEN starts_with(txt, '0.') THEN 'interface starts at 1' END AS error
    FROM s
    """,
)
def _(t):
    whole = F.split(F.col("value").cast("string"), r"\.")[0]
    minor = (F.col("event_id") % 12).cast("string")
    txt = F.when(F.col("event_type") == "error", F.concat_ws(".", whole, minor)).otherwise(
        F.concat_ws(".", whole, minor, F.lit("3"))
    )
    return t.base("events").select(
        "event_id",
        version.format_version(version.parse_version(txt)).alias("parsed"),
        version.version_error(txt).alias("error"),
    )


@query(
    "ver02_compare_versions",
    """
    SELECT a.file_id,
      (a.interface_version, a.quality_version, a.revision_version) < (b.interface_version, b.quality_version, b.revision_version) AS below,
      (a.interface_version, a.quality_version, a.revision_version) = (b.interface_version, b.quality_version, b.revision_version) AS same
    FROM v_file a JOIN v_filefilelink l ON l.resulting_file = a.file_id JOIN v_file b ON b.file_id = l.source_file
    """,
)
def _(t):
    a = t.file.select("file_id", version_of().alias("va"))
    b = t.file.select(F.col("file_id").alias("source_file"), version_of().alias("vb"))
    return (
        a.join(t.filefilelink, F.col("file_id") == F.col("resulting_file"))
        .join(b, "source_file")
        .select("file_id", (F.col("va") < F.col("vb")).alias("below"), (F.col("va") == F.col("vb")).alias("same"))
    )


@query(
    "ver03_version_difference",
    """
    SELECT a.file_id, b.file_id AS source_file, a.interface_version - b.interface_version AS di,
      a.quality_version - b.quality_version AS dq, a.revision_version - b.revision_version AS dr
    FROM v_file a JOIN v_filefilelink l ON l.resulting_file = a.file_id JOIN v_file b ON b.file_id = l.source_file
    """,
)
def _(t):
    a = t.file.select("file_id", version_of().alias("va"))
    b = t.file.select(F.col("file_id").alias("source_file"), version_of().alias("vb"))
    diff = version.version_difference(F.col("va"), F.col("vb"))
    return (
        a.join(t.filefilelink, F.col("file_id") == F.col("resulting_file"))
        .join(b, "source_file")
        .select("file_id", "source_file", diff["interface"].alias("di"), diff["quality"].alias("dq"),
                diff["revision"].alias("dr"))
    )


@query(
    "ver04_next_version",
    """
    WITH d AS (SELECT f.*, CAST(file_id % 3 - 1 AS INT) AS di, quality_version - 2 AS dq, revision_version - 3 AS dr FROM v_file f),
    r AS (SELECT *, interface_version AS i0, quality_version AS q0, CASE WHEN dr > 0 THEN revision_version + 1 ELSE revision_version END AS r0 FROM d),
    q AS (SELECT *, CASE WHEN dq > 0 THEN q0 + 1 ELSE q0 END AS q1, CASE WHEN dq > 0 THEN 0 ELSE r0 END AS r1 FROM r),
    i AS (SELECT *, CASE WHEN di > 0 THEN i0 + 1 ELSE i0 END AS i2, CASE WHEN di > 0 THEN 0 ELSE q1 END AS q2, CASE WHEN di > 0 THEN 0 ELSE r1 END AS r2 FROM q)
    SELECT file_id, concat(interface_version + 1, '.0.0') AS up0, concat(interface_version, '.', quality_version + 1, '.0') AS up1,
      concat(interface_version, '.', quality_version, '.', revision_version + 1) AS up2, concat(i2, '.', q2, '.', r2) AS applied
    FROM i
    """,
)
def _(t):
    v = version_of()
    diff = F.struct(
        (F.col("file_id") % 3 - 1).alias("interface"),
        (F.col("quality_version") - 2).alias("quality"),
        (F.col("revision_version") - 3).alias("revision"),
    )
    return t.file.select(
        "file_id",
        *[version.format_version(version.next_version(v, p)).alias(f"up{p}") for p in (0, 1, 2)],
        version.format_version(version.apply_difference(v, diff)).alias("applied"),
    )


@query(
    "ver05_version_in_name",
    r"""
    SELECT file_id, concat(regexp_extract(filename, '[vV](\d+)\.(\d+)\.(\d+)\.', 1), '.', regexp_extract(filename, '[vV](\d+)\.(\d+)\.(\d+)\.', 2), '.',
        regexp_extract(filename, '[vV](\d+)\.(\d+)\.(\d+)\.', 3)) AS version, split_part(filename, 'v', 1) AS base
    FROM v_file
    """,
)
def _(t):
    name = F.col("filename")
    return t.file.select(
        "file_id",
        version.format_version(version.extract_version(name)).alias("version"),
        version.extract_base(name).alias("base"),
    )


# Names with good, impossible and out-of-period dates, from every order.
_DATED_SQL = """
SELECT o_orderkey, concat('run_', CAST(year(o_orderdate) + CASE o_orderkey % 4 WHEN 1 THEN 60 WHEN 2 THEN -40 ELSE 0 END AS STRING),
  strftime(o_orderdate, '%m'), lpad(CAST(1 + o_orderkey % 31 AS STRING), 2, '0'), '_x.dat') AS nm FROM orders
"""


def _dated_names(t):
    year = F.year("o_orderdate") + F.expr("CASE o_orderkey % 4 WHEN 1 THEN 60 WHEN 2 THEN -40 ELSE 0 END")
    return t.base("orders").select(
        "o_orderkey",
        F.concat(
            F.lit("run_"), year.cast("string"), F.date_format("o_orderdate", "MM"),
            F.lpad((1 + F.col("o_orderkey") % 31).cast("string"), 2, "0"), F.lit("_x.dat"),
        ).alias("nm"),
    )


@query(
    "dt01_day_in_name",
    "WITH n AS (" + _DATED_SQL + r"""), d AS (SELECT o_orderkey, CAST(try_strptime(nullif(regexp_extract(nm, '([12][90]\d\d[01]\d[0-3]\d)', 1), ''), '%Y%m%d') AS DATE) AS day FROM n)
    SELECT o_orderkey, CASE WHEN day >= DATE '1957-10-05' AND day <= DATE '2050-01-01' THEN day END AS day FROM d
    """,
)
def _(t):
    return _dated_names(t).select("o_orderkey", dates.extract_day(F.col("nm")).alias("day"))


@query(
    "dt02_month_in_name",
    "WITH n AS (" + _DATED_SQL + r"""), d AS (SELECT o_orderkey, CAST(try_strptime(concat(nullif(regexp_extract(nm, '([12][90]\d\d[01]\d)', 1), ''), '01'), '%Y%m%d') AS DATE) AS mon FROM n)
    SELECT o_orderkey, CASE WHEN mon >= DATE '1957-10-05' AND mon <= DATE '2050-01-01' THEN mon END AS mon FROM d
    """,
)
def _(t):
    return _dated_names(t).select("o_orderkey", dates.extract_month(F.col("nm")).alias("mon"))


@query(
    "dt03_valid_day",
    "WITH n AS (" + _DATED_SQL + ") SELECT o_orderkey, try_strptime(substr(nm, 5, 8), '%Y%m%d') IS NOT NULL AS valid FROM n",
)
def _(t):
    return _dated_names(t).select(
        "o_orderkey", dates.valid_day(F.substring("nm", 5, 8)).alias("valid")
    )


@query(
    "dt04_expand_days",
    """
    SELECT file_id, CAST(unnest(generate_series(CAST(utc_start_time AS DATE), CAST(utc_stop_time AS DATE), INTERVAL 1 DAY)) AS DATE) AS day FROM v_file
    """,
)
def _(t):
    return t.file.select(
        "file_id", F.explode(dates.days_between(F.col("utc_start_time"), F.col("utc_stop_time"))).alias("day")
    )


@query(
    "dt05_parse_dates",
    "WITH n AS (" + _DATED_SQL + """), s AS (SELECT o_orderkey, concat(substr(nm, 5, 4), '-', substr(nm, 9, 2), '-', substr(nm, 11, 2)) AS d, substr(nm, 5, 6) AS m FROM n)
    SELECT o_orderkey, CAST(try_strptime(d, '%Y-%m-%d') AS DATE) AS day, last_day(CAST(try_strptime(concat(m, '01'), '%Y%m%d') AS DATE)) AS month_end FROM s
    """,
)
def _(t):
    day = F.concat_ws("-", F.substring("nm", 5, 4), F.substring("nm", 9, 2), F.substring("nm", 11, 2))
    return _dated_names(t).select(
        "o_orderkey",
        dates.parse_day(day).alias("day"),
        dates.parse_month_end(F.substring("nm", 5, 6)).alias("month_end"),
    )


@query(
    "dt06_whole_seconds",
    """
    SELECT file_id, CAST(trunc(epoch_us(utc_start_time) / 1000000) AS BIGINT) AS unix_start,
      CAST(trunc(epoch_us(utc_stop_time - INTERVAL '70' YEAR) / 1000000) AS BIGINT) AS before_1970 FROM v_file
    """,
)
def _(t):
    return t.file.select(
        "file_id",
        dates.whole_seconds(F.col("utc_start_time")).alias("unix_start"),
        dates.whole_seconds(F.expr("utc_stop_time - INTERVAL '70' YEAR")).alias("before_1970"),
    )


@query(
    "cat05_date_bounds",
    """
    SELECT file_id, CAST(utc_file_date AS TIMESTAMP) AS first_moment,
      CAST(utc_file_date AS TIMESTAMP) + INTERVAL '86399999999' MICROSECOND AS last_moment, CAST(utc_stop_time AS DATE) AS day FROM v_file
    """,
)
def _(t):
    return t.file.select(
        "file_id",
        dates.as_moment(F.col("utc_file_date")).alias("first_moment"),
        dates.as_moment(F.col("utc_file_date"), end=True).alias("last_moment"),
        F.col("utc_stop_time").cast("date").alias("day"),
    )


@query(
    "str01_keywords",
    """
    SELECT a.file_id, b.file_id AS other,
      CASE WHEN b.data_level > 1 THEN split_part(b.process_keywords, '=', 2) ELSE split_part(a.process_keywords, '=', 2) END AS nnn,
      CASE WHEN b.data_level > 1 THEN NULL ELSE CAST(b.data_level AS STRING) END AS lev, CAST(a.product_id AS STRING) AS prod
    FROM v_file a JOIN v_filefilelink l ON l.resulting_file = a.file_id JOIN v_file b ON b.file_id = l.source_file
    """,
)
def _(t):
    mine = F.concat_ws(" ", F.col("process_keywords"), F.concat(F.lit("prod="), F.col("product_id")))
    theirs = F.when(
        F.col("data_level") > 1, F.concat(F.col("process_keywords"), F.lit(" stop lev="), F.col("data_level"))
    ).otherwise(F.concat(F.lit("lev="), F.col("data_level")))
    a = t.file.select("file_id", text.keyword_map(mine).alias("ka"))
    b = t.file.select(F.col("file_id").alias("other"), text.keyword_map(theirs).alias("kb"))
    merged = text.merge_keywords(F.array("ka", "kb"))
    return (
        a.join(t.filefilelink, F.col("file_id") == F.col("resulting_file"))
        .join(b, F.col("other") == F.col("source_file"))
        .select("file_id", "other", merged["nnn"].alias("nnn"), merged["lev"].alias("lev"), merged["prod"].alias("prod"))
    )


@query(
    "str02_truth_and_none",
    """
    WITH w AS (SELECT event_id, CASE event_id % 6 WHEN 0 THEN 'Yes' WHEN 1 THEN 'TRUE' WHEN 2 THEN 'none' WHEN 3 THEN 'y' WHEN 4 THEN '' ELSE event_type END AS word FROM events)
    SELECT event_id, word IN ('True', 'true', '1', 'Yes', 'yes', 'Y', 'y') AS truth, CASE WHEN word NOT IN ('', 'None', 'none', 'NONE') THEN word END AS kept FROM w
    """,
)
def _(t):
    word = F.expr(
        "CASE event_id % 6 WHEN 0 THEN 'Yes' WHEN 1 THEN 'TRUE' WHEN 2 THEN 'none' WHEN 3 THEN 'y' WHEN 4 THEN '' ELSE event_type END"
    )
    return t.base("events").select("event_id", text.is_true(word).alias("truth"), text.none_if(word).alias("kept"))


@query(
    "str03_flatten_and_chunk",
    """
    WITH n AS (SELECT file_id, row_number() OVER (ORDER BY filename) - 1 AS pos FROM v_file)
    SELECT file_id, CAST(floor(pos / 150) AS BIGINT) AS chunk, 3 AS flat FROM n
    """,
)
def _(t):
    from tidemark.operators.skew import number_rows

    numbered = number_rows(t.file.select("file_id", "filename"), ["filename"], "pos", start=0)
    nested = F.array(F.array("file_id", "pos"), F.array("pos"))
    return numbered.select(
        "file_id", F.floor(F.col("pos") / 150).alias("chunk"), F.size(F.flatten(nested)).alias("flat")
    )


@query(
    "tpl01_fill_names",
    """
    SELECT f.file_id, concat(p.product_name, '_', strftime(f.utc_file_date, '%Y%m%d'), '_v', f.interface_version, '.', f.quality_version, '.', f.revision_version, '.{nn}.dat') AS name,
      concat(strftime(f.utc_start_time, '%Y-%j-%b-%y-%H%M%S-'), lpad(CAST(CAST(floor((epoch_us(f.utc_start_time) % 1000000) / 1000) AS BIGINT) AS STRING), 3, '0'), '-',
        lpad(CAST(epoch_us(f.utc_start_time) % 1000 AS STRING), 3, '0')) AS stamp
    FROM v_file f JOIN v_product_full p ON p.product_id = f.product_id
    """,
)
def _(t):
    fields = {
        **templates.date_fields(F.col("utc_start_time")),
        "PRODUCT": F.col("product_name"),
        "VERSION": version.format_version(version_of()),
    }
    joined = t.file.join(t.product_full.select("product_id", "product_name", "format"), "product_id")
    return joined.select(
        "file_id",
        templates.fill(F.col("format"), fields).alias("name"),
        templates.fill(F.lit("{Y}-{j:03d}-{b}-{y}-{H}{M}{S}-{MILLI}-{MICRO}"), fields).alias("stamp"),
    )


@query(
    "tpl02_patterns",
    r"""
    SELECT product_id, concat(product_name, '_', CASE WHEN product_id % 2 = 0 THEN '((19|2\d)\d\d)((0\d|1[0-2]))([0-3]\d)' ELSE '((19|2\d)\d\d(0\d|1[0-2])[0-3]\d)' END,
      '_v(\d+\.\d+\.\d+).(\d\d).dat') AS pattern,
      CASE product_id % 3 WHEN 0 THEN '.*/.*/.*/((19|2\d)\d\d)/((0\d|1[0-2]))' WHEN 1 THEN 'l.*/((19|2\d)\d\d(0\d|1[0-2])[0-3]\d)/([0-2]\d)' ELSE 'flat' END AS folder,
      concat(product_name, '_') AS prefix
    FROM v_product_full
    """,
)
def _(t):
    known = {"PRODUCT": F.col("product_name")}
    filled = templates.fill(F.col("format"), known)
    return t.product_full.select(
        "product_id",
        templates.to_pattern(F.col("format"), known).alias("pattern"),
        templates.to_pattern(F.col("relative_path")).alias("folder"),
        templates.literal_prefix(filled).alias("prefix"),
    )


@query(
    "tpl03_fill_paths",
    """
    SELECT f.file_id, CASE p.product_id % 3
        WHEN 0 THEN concat('{SATELLITE}/{INSTRUMENT}/', p.product_name, '/', strftime(f.utc_file_date, '%Y/%m'))
        WHEN 1 THEN concat('l{LEVEL}/', strftime(f.utc_file_date, '%Y%m%d'), '/', strftime(f.utc_start_time, '%H')) ELSE 'flat' END AS folder
    FROM v_file f JOIN v_product_full p ON p.product_id = f.product_id
    """,
)
def _(t):
    joined = t.file.join(t.product_full.select("product_id", "product_name", "relative_path"), "product_id")
    folder = templates.substitute_path(
        F.col("relative_path"), F.col("utc_file_date"), F.col("utc_start_time"),
        version.format_version(version_of()), {"PRODUCT": F.col("product_name")},
    )
    return joined.select("file_id", folder.alias("folder"))


@query(
    "hash01_content_digest",
    "SELECT doc_id, sha1(text) AS digest FROM documents",
)
def _(t):
    from tidemark.sources.listing import content_digest

    return t.base("documents").select("doc_id", content_digest(F.col("text")).alias("digest"))


@query(
    "cat20_version_as_value",
    """
    SELECT file_id AS id, 'file' AS kind, concat(interface_version, '.', quality_version, '.', revision_version) AS version FROM v_file
    UNION ALL SELECT code_id, 'code', concat(interface_version, '.', quality_version, '.', revision_version) FROM v_code
    """,
)
def _(t):
    def shown(df, key, kind):
        return df.select(F.col(key).alias("id"), F.lit(kind).alias("kind"),
                         version.format_version(version_of()).alias("version"))

    return shown(t.file, "file_id", "file").unionByName(shown(t.code, "code_id", "code"))


@query(
    "cat19_minimum_version",
    """
    SELECT file_id FROM v_file WHERE (interface_version, quality_version, revision_version) >= (1, 3, 2)
    """,
)
def _(t):
    from tidemark.operators.catalogue import at_least_version

    return at_least_version(t.file, 1, 3, 2).select("file_id")
