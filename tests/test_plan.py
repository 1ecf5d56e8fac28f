"""Planning scenarios.  Each has products, processes and files of its own in one catalogue."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import Small, ids
from tidemark.functions.version import format_version, version
from tidemark.operators.catalogue import full_paths
from tidemark.operators.trace import trace_products
from tidemark.plans import reprocess
from tidemark.plans.reprocess import KEY, walk

START = dt.datetime


class Scenarios(Small):
    """Names each scenario's level 0 and level 1 product and remembers its triggers."""

    def __init__(self):
        super().__init__()
        self.triggers = {}
        self.process_of = {}

    def chain(self, name: str, timebase="DAILY", **link):
        a = self.product(f"{name} l0")
        b = self.product(f"{name} l1", level=1)
        p, code = self.process(f"{name} make", b if timebase != "RUN" else None, timebase)
        self.link(a, p, **link)
        self.process_of[name] = p
        return a, b, p, code


@pytest.fixture(scope="module")
def planned(spark):
    s = Scenarios()

    a, b, p, c = s.chain("simple")
    s.triggers["simple"] = s.file("simple_l0_20120101_v1.0.0", a)

    a, b, p, c = s.chain("current")
    f0 = s.file("current_l0_20120101_v1.0.0", a)
    s.made(s.file("current_l1_20120101_v1.0.0", b), f0, code=c)
    s.triggers["current"] = f0

    a, b, p, c = s.chain("newer")
    f0 = s.file("newer_l0_20120101_v1.0.0", a)
    s.made(s.file("newer_l1_20120101_v1.0.0", b), f0, code=c)
    s.triggers["newer"] = s.file("newer_l0_20120101_v1.1.0", a)
    s.triggers["stale"] = f0  # no longer newest: triggers nothing

    a, b, p, c = s.chain("revision")
    f0 = s.file("revision_l0_20120101_v1.0.0", a)
    s.made(s.file("revision_l1_20120101_v1.0.0", b), f0, code=c)
    s.triggers["revision"] = s.file("revision_l0_20120101_v1.0.1", a)

    a, b, p, c = s.chain("yesterday", yesterday=1)
    s.triggers["yesterday1"] = s.file("yesterday_l0_20120101_v1.0.0", a)
    s.triggers["yesterday2"] = s.file("yesterday_l0_20120102_v1.0.0", a)

    a, b, p, c = s.chain("tomorrow", tomorrow=1)
    s.triggers["tomorrow1"] = s.file("tomorrow_l0_20120101_v1.0.0", a)
    s.triggers["tomorrow2"] = s.file("tomorrow_l0_20120102_v1.0.0", a)

    a, b, p, c = s.chain("span")
    s.triggers["span1"] = s.file("span_l0_20120101_v1.0.0", a, START(2012, 1, 1, 1), START(2012, 1, 2, 1))
    s.triggers["span2"] = s.file("span_l0_20120102_v1.0.0", a, START(2012, 1, 2, 1), START(2012, 1, 3, 1))

    a, b, p, c = s.chain("early")
    s.triggers["early"] = s.file("early_l0_20120101_v1.0.0", a, START(2011, 12, 31, 23), START(2012, 1, 1, 23))

    a, b, p, c = s.chain("plot", timebase="RUN")
    s.file("plot_l0_20120101_v1.0.0", a, START(2012, 1, 1, 1), START(2012, 1, 2, 0, 59))
    s.triggers["plot"] = s.file("plot_l0_20120102_v1.0.0", a, START(2012, 1, 2, 1), START(2012, 1, 2, 0, 59) + dt.timedelta(days=1))

    a, b, p, c = s.chain("absent")
    s.file("absent_l0_20120101_v1.0.0", a, START(2012, 1, 1, 1), START(2012, 1, 2, 0, 59), exists=False)
    s.file("absent_l0_20120101_v1.1.0", a, START(2012, 1, 1, 1), START(2012, 1, 1, 23, 59))
    s.triggers["absent"] = s.file("absent_l0_20120102_v1.0.0", a, START(2012, 1, 2, 1), START(2012, 1, 2, 23, 59))

    a, b, p, c = s.chain("newcode")
    f0 = s.file("newcode_l0_20100101_v1.0.0", a)
    s.made(s.file("newcode_l1_20100101_v1.0.0", b), f0, code=c)
    s.rows["code"][c - 1].update(active_code=False, newest_version=False)
    s.code(p, (2, 0, 0))
    s.triggers["newcode"] = f0

    a, b, p, c = s.chain("oldcode")
    f0 = s.file("oldcode_l0_20100101_v1.0.0", a)
    retired = s.code(p, (1, 3, 0), active_code=False, newest_version=False)
    s.made(s.file("oldcode_l1_20100101_v1.0.0", b), f0, code=retired)
    s.triggers["oldcode"] = f0

    a, b, p, c = s.chain("nolink")  # the code link is missing and inferred
    f0 = s.file("nolink_l0_20100101_v1.0.0", a)
    s.made(s.file("nolink_l1_20100101_v1.0.0", b), f0)
    s.triggers["nolink"] = f0

    a, b, p, c = s.chain("orphan")  # an output without recorded inputs is made again
    s.triggers["orphan"] = s.file("orphan_l0_20100101_v1.0.0", a)
    s.made(s.file("orphan_l1_20100101_v1.0.0", b), code=c)

    a, b, p, c = s.chain("needs")
    extra = s.product("needs extra")
    s.link(extra, p)
    s.triggers["needs"] = s.file("needs_l0_20100101_v1.0.0", a)

    a, b, p, c = s.chain("may")
    extra = s.product("may extra")
    s.link(extra, p, optional=True)
    s.triggers["may"] = s.file("may_l0_20100101_v1.0.0", a)

    a, b, p, c = s.chain("words", timebase="FILE")
    s.rows["product"][b - 1]["format"] = "words_l1_{nnn}_{Y}{m}{d}_v{VERSION}"
    other = s.product("words other")
    s.link(other, p)
    s.triggers["words"] = s.file("words_l0_20100101_v1.0.0", a, process_keywords="nnn=001")
    s.file("words_other_20100101_v1.0.0", other, process_keywords="nnn=002")

    a, b, p, c = s.chain("weekly", timebase="WEEKLY")
    s.triggers["weekly"] = s.file("weekly_l0_20100101_v1.0.0", a)

    a, b, p, c = s.chain("bumped")
    f0 = s.file("bumped_l0_20100101_v1.0.0", a)
    s.made(s.file("bumped_l1_20100101_v1.0.0", b), f0, code=c)
    s.made(s.file("bumped_l1_20100101_v1.1.0", b), f0, code=c)

    a, b, p, c = s.chain("late")  # outside the period of the code
    s.rows["code"][c - 1]["code_stop_date"] = dt.date(2011, 1, 1)
    s.triggers["late"] = s.file("late_l0_20120101_v1.0.0", a)

    catalogue = s.catalogue(spark)
    rows = [(f, None) for f in sorted(set(s.triggers.values()))] + [(f0, 1) for f0 in [
        next(r["file_id"] for r in s.rows["file"] if r["filename"] == "bumped_l0_20100101_v1.0.0")]]
    queue = spark.createDataFrame(rows, "file_id bigint, version_bump smallint")
    plan = reprocess.plan_changes(catalogue, queue).select(
        *KEY, "inputs", "filename", "outcome", "runnable").collect()
    return s, catalogue, queue, plan


def rows_of(planned, name):
    s, _, _, plan = planned
    return sorted((r for r in plan if r.process_id == s.process_of[name]), key=lambda r: r.day)


def runs_of(planned, name):
    s = planned[0]
    names = {r["file_id"]: r["filename"] for r in s.rows["file"]}
    return [(r.filename, sorted(names[i].split("_l0_")[-1] for i in r.inputs)) for r in rows_of(planned, name) if r.runnable]


def test_one_daily_file_makes_another(planned):
    assert runs_of(planned, "simple") == [("simple_l1_20120101_v1.0.0", ["20120101_v1.0.0"])]


def test_up_to_date_output_is_not_made(planned):
    assert [r.outcome for r in rows_of(planned, "current")] == ["up to date"]


def test_newer_input_raises_quality_and_old_one_triggers_nothing(planned):
    assert runs_of(planned, "newer") == [("newer_l1_20120101_v1.1.0", ["20120101_v1.1.0"])]


def test_newer_revision_raises_revision(planned):
    assert runs_of(planned, "revision") == [("revision_l1_20120101_v1.0.1", ["20120101_v1.0.1"])]


def test_yesterday_is_taken_but_does_not_trigger(planned):
    assert runs_of(planned, "yesterday") == [
        ("yesterday_l1_20120101_v1.0.0", ["20120101_v1.0.0"]),
        ("yesterday_l1_20120102_v1.0.0", ["20120101_v1.0.0", "20120102_v1.0.0"]),
    ]


def test_tomorrow_is_taken_but_does_not_trigger(planned):
    assert runs_of(planned, "tomorrow") == [
        ("tomorrow_l1_20120101_v1.0.0", ["20120101_v1.0.0", "20120102_v1.0.0"]),
        ("tomorrow_l1_20120102_v1.0.0", ["20120102_v1.0.0"]),
    ]


def test_neighbour_days_trigger_on_request(planned, spark):
    s, catalogue, _, _ = planned
    queue = spark.createDataFrame([(s.triggers["yesterday1"], None)], "file_id bigint, version_bump smallint")
    cells = reprocess.affected(catalogue, queue, neighbours=True)
    assert sorted(r.day for r in cells.collect()) == [dt.date(2012, 1, 1), dt.date(2012, 1, 2)]


def test_files_that_span_days_feed_each_day(planned):
    assert runs_of(planned, "span") == [
        ("span_l1_20120101_v1.0.0", ["20120101_v1.0.0"]),
        ("span_l1_20120102_v1.0.0", ["20120101_v1.0.0", "20120102_v1.0.0"]),
        ("span_l1_20120103_v1.0.0", ["20120102_v1.0.0"]),
    ]


def test_data_before_midnight_make_the_day_before(planned):
    assert [f for f, _ in runs_of(planned, "early")] == ["early_l1_20111231_v1.0.0", "early_l1_20120101_v1.0.0"]


def test_run_timebase_goes_by_file_date_and_has_no_output(planned):
    s = planned[0]
    rows = {r.day: r for r in rows_of(planned, "plot") if r.runnable}
    row = rows[dt.date(2012, 1, 2)]
    assert row.inputs == [s.triggers["plot"]]
    assert row.filename == f"RUN_plot make_{s.triggers['plot']}"
    assert dt.date(2012, 1, 3) not in rows


def test_version_that_is_not_on_disk_is_no_input(planned):
    assert runs_of(planned, "absent") == [("absent_l1_20120102_v1.0.0", ["20120102_v1.0.0"])]


def test_interface_change_of_code_raises_quality(planned):
    assert [f for f, _ in runs_of(planned, "newcode")] == ["newcode_l1_20100101_v1.1.0"]


def test_older_code_is_an_error_and_ends(planned):
    assert [r.outcome for r in rows_of(planned, "oldcode")] == [
        "error: code is older than that of the existing output"]


def test_missing_code_link_is_inferred(planned):
    assert [r.outcome for r in rows_of(planned, "nolink")] == ["up to date"]


def test_output_without_inputs_on_record_runs_under_its_name(planned):
    row, = rows_of(planned, "orphan")
    assert (row.outcome, row.filename, row.runnable) == ("no parents", "orphan_l1_20100101_v1.0.0", True)


def test_required_and_optional_inputs(planned):
    assert [r.outcome for r in rows_of(planned, "needs")] == ["not runnable: required input missing"]
    assert [f for f, _ in runs_of(planned, "may")] == ["may_l1_20100101_v1.0.0"]


def test_file_timebase_keeps_inputs_with_the_triggers_keywords(planned):
    assert runs_of(planned, "words") == [("words_l1_001_20100101_v1.0.0", ["20100101_v1.0.0"])]


def test_other_timebases_are_refused(planned):
    assert [r.outcome for r in rows_of(planned, "weekly")] == ["not runnable: timebase not supported"]


def test_asked_bump_walks_past_existing_versions(planned):
    assert [f for f, _ in runs_of(planned, "bumped")] == ["bumped_l1_20100101_v1.2.0"]


def test_no_code_on_the_day(planned):
    assert [r.outcome for r in rows_of(planned, "late")] == ["not runnable: no active code"]


def test_choice_of_processes(planned):
    s, catalogue, queue, _ = planned
    cells = reprocess.affected(catalogue, queue, skip_run=True)
    assert s.process_of["plot"] not in {r.process_id for r in cells.collect()}
    only = reprocess.affected(catalogue, queue, only=[s.process_of["simple"]])
    assert {r.process_id for r in only.collect()} == {s.process_of["simple"]}


def test_range_plans_without_inputs_and_commands(spark):
    s = Small()
    out = s.product("trigger", level=2, form="trigger_{Y}{m}{d}_v{VERSION}.out")
    p, code = s.process("no input", out)
    s.rows["code"][0]["arguments"] = "-m {ROOTDIR}/t -c {CODEDIR}/x -v {CODEVERSION}"
    s.rows["code"][0]["relative_path"] = "codes_{CODEVERSION}"
    s.rows["process"][0]["extra_params"] = "-d|{DATE}"
    catalogue = s.catalogue(spark)
    chosen = catalogue.process.select("process_id")

    def names(**kw):
        return sorted(r.filename for r in reprocess.plan_range(catalogue, chosen, "2010-01-01", "2010-01-03", **kw).collect())

    fresh = [f"trigger_2010010{d}_v1.0.0.out" for d in (1, 2, 3)]
    assert names() == names(version_bump=1) == names(update=True) == fresh
    with pytest.raises(ValueError):
        reprocess.plan_range(catalogue, chosen, "2010-01-01", "2010-01-01", version_bump=1, update=True)

    runs = reprocess.plan_range(catalogue, chosen, "2010-01-01", "2010-01-01")
    runs = reprocess.with_arguments(catalogue, runs, "/data", "/codes")
    paths = full_paths(catalogue.file, trace_products(catalogue), "/data")
    assert reprocess.commands(runs, paths, "/tmp/out").first().command == [
        "/codes/codes_1.0.0/work.py", "-d", "20100101", "-m", "/data/t", "-c", "/codes/codes_1.0.0/x", "-v", "1.0.0",
        "/tmp/out/trigger_20100101_v1.0.0.out"]

    s.made(s.file("trigger_20100101_v1.0.0.out", out), code=code)
    catalogue = s.catalogue(spark)
    assert names()[0] == "trigger_20100101_v1.0.0.out"
    assert names(version_bump=1)[0] == "trigger_20100101_v1.1.0.out"
    assert names(version_bump=2)[0] == "trigger_20100101_v1.0.1.out"
    assert names(update=True) == fresh[1:]

    s.rows["code"][0].update(active_code=False, newest_version=False)
    s.code(p, (1, 1, 0), filename="new.py")
    catalogue = s.catalogue(spark)
    assert names()[0] == "trigger_20100101_v1.0.0.out"
    assert names(update=True)[0] == "trigger_20100101_v1.1.0.out"


def test_run_list_keeps_equal_and_equally_named_rows_once(spark):
    schema = ("process_id bigint, day date, keywords string, version_bump smallint, code_id bigint, output_product bigint,"
              "inputs array<bigint>, filename string, version string, data_level double, runnable boolean")
    day = dt.date(2020, 1, 1)
    rows = [
        (1, day, None, None, 1, 5, [1], "b", "1", 2.0, True), (1, day, None, 1, 1, 5, [1], "b", "1", 2.0, True),
        (2, day, None, None, 1, 5, [2], "b", "1", 2.0, True), (3, day, None, None, 1, 6, [1], "a", "1", 2.0, True),
        (4, day, None, None, 1, 6, [1], "", "1", 1.0, True), (5, day, None, None, 1, 6, [1], "", "1", 1.0, True),
        (6, day, None, None, 1, 6, [1], "c", "1", 1.0, False),
    ]
    got = [(r.process_id, r.filename) for r in reprocess.run_list(spark.createDataFrame(rows, schema)).collect()]
    assert sorted(got[:2]) == [(4, ""), (5, "")]
    assert got[2:] == [(3, "a"), (1, "b")]


def test_walks_of_any_length(spark):
    day = dt.date(2020, 1, 1)
    key = "process_id bigint, day date, keywords string, version_bump smallint"
    starts = spark.createDataFrame([(p, day, None, None) for p in range(1, 6)], key).withColumn("start", version(1, 0, 0))
    rows = []
    for p in range(1, 5):
        last = 3 * p
        for n in range(last):
            stop = {1: None, 2: "up to date", 3: "no parents", 4: "error: x"}[p] if n == last - 1 else None
            rows.append((p, day, None, None, n, None if stop else n + 1, stop))
    steps = spark.createDataFrame(rows, key + ", a int, b int, outcome string").select(
        "process_id", "day", "keywords", "version_bump", version(1, 0, F.col("a")).alias("version"),
        F.when(F.col("b").isNotNull(), version(1, 0, F.col("b"))).alias("next"), "outcome")

    out = walk(starts, steps).select("process_id", format_version(F.col("version")), "outcome")
    assert sorted(tuple(r) for r in out.collect()) == [
        (1, "1.0.3", "run"), (2, "1.0.5", "up to date"), (3, "1.0.8", "no parents"), (4, "1.0.11", "error: x"),
        (5, "1.0.0", "run")]


def test_reprocess_queues_newest_files_with_a_bump(spark):
    s = Small()
    a = s.product("raw")
    s.file("raw_20120101_v1.0.0", a)
    new = s.file("raw_20120101_v1.1.0", a)
    queued = s.file("raw_20120102_v1.0.0", a)
    s.add("processqueue", file_id=queued)
    catalogue = s.catalogue(spark)
    rows = reprocess.reprocess(catalogue, 2, product=a).collect()
    assert [(r.file_id, r.version_bump) for r in rows] == [(new, 2)]
    assert ids(reprocess.reprocess(catalogue, None, start_date="2012-01-02")) == []


def test_a_queue_of_one_file_prunes_the_file_scan(spark, tmp_path):
    from tidemark.sources import catalogue as source

    s = Small()
    raw, out = s.product("raw"), s.product("out", level=1)
    process, _ = s.process("make", out, "FILE")
    s.link(raw, process, yesterday=1)
    for month in range(1, 9):
        s.file(f"raw_20120{month}15_v1.0.0", raw)
    s.add("processqueue", file_id=3)
    c = s.catalogue(spark)
    source.write_table(c.file, "file", str(tmp_path))
    c = c.replace(file=source.read_tables(spark, str(tmp_path), ["file"]).file)
    queued = c.processqueue.join(c.file, "file_id")
    near = reprocess._near(c.file, queued)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(file_month" in near and "2012-03" in near and "product_id" in near.split("PushedFilters")[1]
    links = reprocess._links(c)
    serving = reprocess._serving(c.file, links, dt.date(2012, 3, 15), dt.date(2012, 3, 15))
    plan = serving._jdf.queryExecution().executedPlan().toString()
    assert "file_month" in plan.split("PartitionFilters")[1].split("]")[0] and "EqualTo(product_id" in plan
    assert [(r.filename, r.inputs) for r in reprocess.plan_changes(c, c.processqueue).where("runnable").collect()] == [
        ("out_20120315_v1.0.0", [3])]
    days = reprocess.plan_range(c, c.process, "2012-03-01", "2012-05-31")
    assert sorted(r.filename for r in days.collect()) == [f"out_20120{m}15_v1.0.0" for m in (3, 4, 5)]


def test_existing_names_meet_by_what_stands_before_the_version(spark):
    s = Small()
    out = s.product("out", form="x1.0.0_{Y}{m}{d}_v{VERSION}_{VERSION}")
    plain = s.product("plain", form="p_{Y}{m}{d}")
    for name, product in (("x1.0.0_20120101_v1.0.0_1.0.0", out), ("x1.0.0_20120101_v1.1.0_1.1.0", out),
                          ("y1.0.0_20120101_v1.0.0_1.0.0", out), ("p_20120101", plain)):
        s.file(name, product)
    c = s.catalogue(spark)
    rows = [(1, dt.date(2012, 1, 1), None, None, None, "DAILY", out, "x1.0.0_20120101_v{VERSION}_{VERSION}", 1),
            (2, dt.date(2012, 1, 1), None, None, None, "DAILY", plain, "p_20120101", 1)]
    plan = spark.createDataFrame(
        rows, "process_id bigint, day date, keywords string, version_bump smallint, reason string, timebase string, "
              "output_product bigint, name_template string, output_interface_version smallint")
    got = sorted((r.process_id, r.file_id, r.versioned) for r in reprocess.existing_outputs(c, plan).collect())
    files = {r.filename: r.file_id for r in c.file.collect()}
    assert got == sorted([(1, files["x1.0.0_20120101_v1.0.0_1.0.0"], True), (1, files["x1.0.0_20120101_v1.1.0_1.1.0"], True),
                          (2, files["p_20120101"], False)])


def test_run_list_reads_its_plan_once_and_takes_the_first_of_equal_rows(spark, tmp_path):
    schema = ("process_id bigint, day date, keywords string, version_bump smallint, code_id bigint, output_product bigint,"
              "inputs array<bigint>, filename string, version string, data_level double, runnable boolean")
    day = dt.date(2020, 1, 1)
    rows = [
        (1, day, "n=2", None, 1, 5, [1], "b", "1", 2.0, True), (1, day, "n=1", None, 1, 5, [1], "b", "1", 2.0, True),
        (4, day, "n=2", None, 1, 6, [1], None, "1", 1.0, True), (4, day, "n=1", None, 1, 6, [1], None, "1", 1.0, True),
        (4, day, None, None, 1, 6, [2], None, "1", 1.0, True),
    ]
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "plan"))
    runs = reprocess.run_list(spark.read.parquet(str(tmp_path / "plan")))
    assert sorted((r.filename or "", r.keywords or "", r.inputs) for r in runs.collect()) == [
        ("", "", [2]), ("", "n=1", [1]), ("b", "n=1", [1])]
    assert runs._jdf.queryExecution().sparkPlan().toString().count("FileScan parquet") == 1


def test_names_take_apart_only_keywords_that_may_fill_them(spark):
    s = Small()
    forms = ["{PRODUCT}_{Y:04d}{m}_{nnn}_v{VERSION}", "a{Y}{j}_{b}_{INSTRUMENT}", "plain", "{a{k}_{DATE}", "{}_{d}"]
    for n, form in enumerate(forms, 1):
        out = s.product(f"out{n}", form=form)
        s.process(f"make {n}", out)
    c = s.catalogue(spark)
    words = [["nnn=2"], ["nnn=1", "nnn=3"], ["other=1"], [None, "nnn=2"], ["Y=7 m=8"], ["a{k=5"], ["=6"], ["PRODUCT={Y}"], []]
    rows = [(p, dt.date(2012, 3, 4), None, None, "DAILY", None, [1], w) for p in range(1, 6) for w in words]
    plan = spark.createDataFrame(
        rows, "process_id bigint, day date, keywords string, version_bump smallint, timebase string, reason string, "
              "inputs array<bigint>, input_keywords array<string>")
    named = reprocess.with_output(c, plan)
    got = {(r.process_id, tuple(r.input_keywords)): r.name_template for r in named.collect()}

    def expected(form, given, product):
        filled = {}
        if None not in given:
            for text in given:
                for word in text.split():
                    filled[word.split("=")[0]] = word.split("=")[1]
        for k, v in filled.items():
            form = form.replace("{" + k + "}", v)
        for k, v in {"PRODUCT": product, "INSTRUMENT": "camera", "Y": "2012", "Y:04d": "2012", "m": "03", "b": "Mar",
                     "d": "04", "j": "064", "DATE": "20120304"}.items():
            form = form.replace("{" + k + "}", v)
        return form

    assert got == {(p, tuple(w)): expected(forms[p - 1], w, f"out{p}") for p in range(1, 6) for w in words}
    # What hangs on the product alone is filled before its rows are joined.
    plan = named._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" in plan and plan.index("AS name_template") < plan.index("AS _named")
