import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from helpers import Small, ids
from tidemark.model import Catalogue
from tidemark.operators import audit, catalogue, coverage, edits, lineage, logs, workset
from tidemark.operators.trace import code_for_process, trace_products
from tidemark.plans import retention


@pytest.fixture(scope="module")
def small(spark):
    s = Small()
    a = s.product("raw")
    b = s.product("cooked", level=1, path="{SPACECRAFT}/{Y}")
    p, c = s.process("cook", b)
    s.link(a, p)
    files = {}
    for name, product in (("raw_20120101_v1.0.0", a), ("raw_20120101_v1.1.0", a), ("raw_20120103_v1.0.0", a),
                          ("cooked_20120101_v1.0.0", b), ("cooked_20120101_v1.1.0", b)):
        files[name] = s.file(name, product)
    s.file("raw_undated_v1.0.0", a)
    s.file("raw_undated_v1.2.0", a)
    s.made(4, 1, code=c)
    s.made(5, 2, code=c)
    return s.catalogue(spark)


def test_newest_groups_a_missing_date_as_one_key(small):
    assert ids(catalogue.newest(small.file)) == [2, 3, 5, 7]
    assert ids(catalogue.is_newest(small.file).where("is_newest")) == [2, 3, 5, 7]


def test_newest_is_taken_after_the_other_filters(small):
    early = small.replace(file=small.file.where("quality_version = 0"))
    assert ids(catalogue.select_files(early, product=1, newest_version=True, end_date="2012-01-02")) == [1]


def test_whole_seconds_keep_a_file_that_ends_within_the_second(spark):
    s = Small()
    a = s.product("raw")
    s.file("raw_20100101_v1.0.0", a, dt.datetime(2010, 1, 1), dt.datetime(2010, 1, 1, 23, 0, 0, 200000))
    c = s.catalogue(spark)
    late = dt.datetime(2010, 1, 1, 23, 0, 0, 600000)
    assert ids(catalogue.in_time_range(c.file, start_time=late)) == [1]
    assert ids(catalogue.in_time_range(c.file, start_time=late, whole_second=False)) == []
    assert ids(catalogue.in_time_range(c.file, "2010-01-01", "2010-01-01")) == [1]
    assert ids(catalogue.in_time_range(c.file, end_time="2009-12-31")) == []


def test_paths_are_filled(small):
    paths = {r.file_id: r.full_path for r in catalogue.full_paths(small.file, trace_products(small), "/data/").collect()}
    assert paths[5] == "/data/sat-a/2012/cooked_20120101_v1.1.0"
    assert paths[1] == "/data/store/raw_20120101_v1.0.0"


def test_code_of_a_day(spark):
    s = Small()
    p, first = s.process("x", None, "RUN", code_stop_date=dt.date(2012, 1, 10))
    second = s.code(p, code_start_date=dt.date(2012, 1, 10))
    c = s.catalogue(spark)
    days = spark.createDataFrame([(p, dt.date(2012, 1, d)) for d in (9, 10, 11)], "process_id bigint, day date")
    got = {r.day.day: (r.code_id, r.n_codes) for r in code_for_process(days, c.code).collect()}
    assert got == {9: (first, 1), 10: (None, 2), 11: (second, 1)}


def test_purge_leaves_nothing_dangling(spark, small):
    c = small.replace(
        processqueue=spark.createDataFrame([(4, None), (3, None)], "file_id bigint, version_bump smallint"),
        release=spark.createDataFrame([(4, "1"), (2, "1")], "file_id bigint, release_num string"),
    )
    left, gone = lineage.purge(c, spark.createDataFrame([(1,)], "file_id bigint"), recursive=True)
    assert ids(gone) == [1, 4]
    assert ids(left.file) == [2, 3, 5, 6, 7]
    assert ids(left.processqueue) == [3] and ids(left.release) == [2]
    assert left.filefilelink.collect() == [(2, 5)] and left.filecodelink.count() == 1
    kept, gone = lineage.purge(c, spark.createDataFrame([(1,)], "file_id bigint"))
    assert ids(gone) == [1] and kept.filefilelink.count() == 1


def test_retention_keeps_newest_released_their_inputs_and_old_roots(spark, small):
    c = small.replace(release=spark.createDataFrame([], "file_id bigint, release_num string"))
    assert ids(retention.retention_candidates(c, "2011-01-01")) == [1, 4, 6]
    released = c.replace(release=spark.createDataFrame([(4, "1")], "file_id bigint, release_num string"))
    assert ids(retention.retention_candidates(released, "2011-01-01")) == [6]
    # Roots dated up to the cutoff stay with all made from them; a file without a date has no age.
    assert ids(retention.retention_candidates(c, "2012-01-01")) == [6]


def test_reap_plan(spark, small):
    candidates = spark.createDataFrame([(1,), (4,)], "file_id bigint")
    paths = catalogue.full_paths(small.file, trace_products(small), "/data")
    rows = retention.reap_plan(candidates, paths, "files", "/data", archive="/old").collect()
    assert [(r.file_id, r.archive_path) for r in rows] == [
        (4, "/old/sat-a/2012/cooked_20120101_v1.0.0"), (1, "/old/store/raw_20120101_v1.0.0")]
    spared = retention.reap_plan(candidates, paths, "files", "/data", spare_last=True)
    assert ids(spared) == [1]
    assert retention.reap_plan(candidates, paths, "records", "/data").count() == 0
    with pytest.raises(ValueError):
        retention.reap_plan(candidates, paths, "records", "/data", archive="/old")


def test_version_table(small):
    long = coverage.version_by_day(small.file.where("utc_file_date IS NOT NULL"), small.product, extra_days=1)
    table = coverage.as_table(long, ["raw", "cooked"]).collect()
    assert [tuple(r) for r in table] == [
        (dt.date(2012, 1, 3), "1.0.0", None), (dt.date(2012, 1, 2), None, None), (dt.date(2012, 1, 1), "1.1.0", "1.1.0")]


def test_latest_view_dates_and_bases(spark):
    names = ["a_20120101_v1.0.0.d", "a_20120101_v1.2.0.d", "a_201201_v1.0.0.d", "a_20120131_v2.0.0.d", "plain.d",
             "a_20120120_v1.0.0.d"]
    frame = spark.createDataFrame([(n,) for n in names], "filename string")
    links = spark.createDataFrame([("a_20120101_v1.0.0.d",), ("a_20120120_v1.0.0.d",)], "filename string")
    got = {(r.filename, r.action) for r in coverage.latest_view(
        frame, links, "2012-01-01", "2012-01-31", today="2012-01-31", delay_days=1).collect()}
    assert got == {("a_20120101_v1.2.0.d", "add"), ("a_201201_v1.0.0.d", "add"), ("a_20120101_v1.0.0.d", "remove")}
    every = {r.filename for r in coverage.latest_view(frame, links).where("action = 'add'").collect()}
    assert every == {"a_20120101_v1.2.0.d", "a_201201_v1.0.0.d", "a_20120131_v2.0.0.d", "plain.d"}


def test_a_catalogue_does_not_differ_from_itself(small):
    for table in ("file", "product", "process", "code"):
        assert audit.compare_table(small, small, table).count() == 0
    assert audit.compare_lineage(small, small).count() == 0
    assert audit.compare_codes_of_files(small, small).count() == 0


def test_repeated_keys_are_counted_in_tasks_of_bounded_size(spark, monkeypatch):
    """However few bytes the rows have, a task gets a portion of them; the table is made once."""
    monkeypatch.setattr(audit, "COUNTED_ROWS", 10)
    pairs = [(i, i + 1) for i in range(45)] + [(3, 4), (3, 4), (None, 9), (None, 9)]
    links = spark.createDataFrame(pairs, "source_file bigint, resulting_file bigint").distinct().unionByName(
        spark.createDataFrame([(3, 4), (None, 9)], "source_file bigint, resulting_file bigint"))
    found = audit.table_violations(Catalogue(filefilelink=links), "filefilelink")
    unique = found.where("rule like 'unique%'")
    assert [(r.key, r.detail) for r in unique.collect()] == [("3|4", "2 rows")]
    plan = unique._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\(source_file#\d+L, resulting_file#\d+L, 5\), REPARTITION_BY_NUM", plan)
    assert not re.search(r"aggregate.*keys=\[source_file#\d+L, resulting_file#\d+L\], functions=\[\]", plan, re.I)


def test_rules_on_a_good_catalogue(small):
    assert [(r.table_name, r.rule) for r in audit.violations(small).collect()] == [
        ("file", "has_stop"), ("file", "has_start"), ("file", "has_stop"), ("file", "has_start")]


@pytest.mark.parametrize("given, edit, expected", [
    ("-i foobar -j foobar -k foobar", lambda c: edits.edit_flag_values(c, "-j", edits.Replace("bar", "baz")), "-i foobar -j foobaz -k foobar"),
    ("-i foobar -j foobar -k foobar -j goobar", lambda c: edits.edit_flag_values(c, "-j", edits.Replace("bar", "baz")),
     "-i foobar -j foobaz -k foobar -j goobaz"),
    ("-i foo -i bar -j baz", lambda c: edits.join_flag_values(c, "-i"), "-i foo,bar -j baz"),
    ("-i foo -i bar -j baz", lambda c: edits.join_flag_values(c, "-j"), "-i foo -i bar -j baz"),
    ("-i foo -j baz", lambda c: edits.join_flag_values(c, "-x"), "-i foo -j baz"),
    ("-i a -k x -i b -i c", lambda c: edits.join_flag_values(c, "-i"), "-i a,c,b -k x"),
    ("-i foo -j bar -k baz", lambda c: edits.edit_text(c, "arguments", edits.insert_before("foo", "test_")), "-i test_foo -j bar -k baz"),
    ("-i foo -j foobar -k baz", lambda c: edits.edit_text(c, "arguments", edits.insert_after("foo", "2")), "-i foo2 -j foo2bar -k baz"),
    ("-i foo -j foobar", lambda c: edits.edit_text(c, "arguments", edits.Replace("nothing", "2")), "-i foo -j foobar"),
    ("-i foo", lambda c: edits.edit_text(c, "arguments", edits.Replace("foo", "2"), F.col("arguments") == "-i bar"), "-i foo"),
    (None, lambda c: edits.edit_text(c, "arguments", edits.Replace("nothing", "2")), None),
    (None, lambda c: edits.join_flag_values(c, "-i"), None),
])
def test_edit_arguments(spark, given, edit, expected):
    df = spark.createDataFrame([(given,)], "arguments string")
    assert edit(df).first().arguments == expected


def test_an_edit_without_a_text_to_look_for_is_refused():
    for make in (lambda: edits.Replace("", "x"), lambda: edits.insert_before("", "x"), lambda: edits.insert_after("", "x")):
        with pytest.raises(ValueError):
            make()


def test_succession_needs_a_higher_version(spark):
    s = Small()
    p, old = s.process("x", None, "RUN")
    c = s.catalogue(spark)
    row = c.code.withColumns({"replaces": F.lit(old), "code_id": F.lit(9)})
    table, refused = edits.succeed_codes(c.code, row)
    assert [tuple(r) for r in refused.collect()] == [(9, old, "version is not above 1.0.0")]
    table, refused = edits.succeed_codes(c.code, row.withColumn("quality_version", F.lit(1).cast("smallint")))
    assert refused.count() == 0
    assert {r.code_id: (r.active_code, r.newest_version) for r in table.collect()} == {old: (False, False), 9: (True, True)}


def test_queue_rules(spark):
    queue = spark.createDataFrame([(1, None), (2, 1)], "file_id bigint, version_bump smallint")
    files = spark.createDataFrame([(1,), (2,), (3,)], "file_id bigint")
    asked = spark.createDataFrame([(1,), (3,), (3,), (9,)], "file_id bigint")
    assert ids(workset.push(queue, files, asked)) == [3]
    assert ids(workset.raw_add(queue, asked)) == [3, 9]
    assert ids(workset.remove(queue, asked)) == [2]
    assert workset.flush(queue).count() == 0
    assert workset.head(queue, -1).first().file_id == 2


def test_log_lines_of_other_forms(spark):
    lines = spark.createDataFrame([
        ("2024-01-01 10:00:00,250 - runner:253 - INFO - Command: make.py -i x starting",),
        ("2024-01-01 10:00:01,000 - runner:253 - INFO - running command: make.py -i y",),
        ("2024-01-01 10:00:02,000 - runner:105 - INFO - Command: make.py took 160.020385027 seconds",),
        ("  File \"x.py\", line 3, in y",),
        ("2024-01-01 10:00:03,000 - db:9 - ERROR - it - broke",),
    ], "value string")
    parsed = logs.parse_lines(lines)
    assert parsed.where("ts IS NULL").count() == 1
    first = logs.commands_run(parsed).collect()
    assert [(r.filename, r.ts) for r in first] == [("make.py", dt.datetime(2024, 1, 1, 10, 0, 0, 250000))]
    assert [tuple(r) for r in logs.run_times(parsed).select("code", "seconds").collect()] == [("make.py", 160.020385027)]
    assert [tuple(r) for r in logs.errors(parsed).select("codename", "error").collect()] == [("db:9", "it - broke")]
