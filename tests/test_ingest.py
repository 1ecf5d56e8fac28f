import datetime as dt
import hashlib

import pandas as pd
import pytest

from helpers import Small, ids
from tidemark.operators import derive, ingest
from tidemark.operators.derive import rot13
from tidemark.operators.trace import trace_products
from tidemark.plans.rounds import process_queue, side_output
from tidemark.sources.listing import list_folder
from tidemark.streaming import ingest as streaming


def camera() -> Small:
    s = Small()
    s.product("cam", form="cam_{nn}_{Y}{m}{d}_v{VERSION}.dat", path="cam/{Y}", arguments="keyword=nn")
    s.product("mon", form="mon_{Y}{m}.dat", path="mon", arguments="period=month version=2.0.0")
    return s


NAMES = ["cam_01_20120101_v1.0.0.dat", "cam_02_20120101_v1.0.0.dat", "cam_01_20120231_v1.0.0.dat",
         "mon_201202.dat", "xcam_01_20120101_v1.0.0.dat", "cam_01_20110101_v1.0.0.dat"]


def listed(spark, names):
    return spark.createDataFrame(
        [(n, f"/in/{n}", dt.datetime(2024, 1, 1), "0" * 40) for n in names],
        "filename string, path string, modified timestamp_ntz, shasum string")


def test_batch_is_classified_checked_and_numbered(spark):
    s = camera()
    s.file("cam_01_20110101_v1.0.0.dat", 1, file_id=40)
    c = s.catalogue(spark)
    trace = trace_products(c)
    rules = ingest.inspection_rules(c, trace)
    out = ingest.ingest_batch(listed(spark, NAMES), c, rules, trace, "/data")
    rows = {r.filename: r for r in out.accepted.collect()}
    assert {n: r.file_id for n, r in rows.items()} == {"cam_01_20120101_v1.0.0.dat": 41, "mon_201202.dat": 42}
    cam, mon = rows["cam_01_20120101_v1.0.0.dat"], rows["mon_201202.dat"]
    assert cam.process_keywords == "nn=01" and cam.product_id == 1
    assert cam.utc_stop_time == dt.datetime(2012, 1, 1, 23, 59, 59, 999999)
    assert (mon.utc_file_date, mon.utc_stop_time) == (dt.date(2012, 2, 1), dt.datetime(2012, 2, 29, 23, 59, 59, 999999))
    assert (mon.interface_version, mon.quality_version) == (2, 0)
    assert {r.filename: r.reason for r in out.quarantine.collect()} == {
        "cam_02_20120101_v1.0.0.dat": "version twice in the batch",
        "cam_01_20120231_v1.0.0.dat": "incomplete: utc_file_date,utc_start_time,utc_stop_time",
        "xcam_01_20120101_v1.0.0.dat": "no inspector match",
        "cam_01_20110101_v1.0.0.dat": "name already in the catalogue",
    }
    assert ids(out.queue) == [41, 42]
    moves = {r.file_id: (r.full_path, r.needs_move) for r in out.moves.collect()}
    assert moves[41] == ("/data/cam/2012/cam_01_20120101_v1.0.0.dat", True)


def test_file_in_its_place_is_not_moved(spark):
    c = camera().catalogue(spark)
    trace = trace_products(c)
    name = "cam_01_20120101_v1.0.0.dat"
    listing = spark.createDataFrame(
        [(name, f"/data/cam/2012/{name}", dt.datetime(2024, 1, 1))], "filename string, path string, modified timestamp_ntz")
    out = ingest.ingest_batch(listing, c, ingest.inspection_rules(c, trace), trace, "/data")
    assert [r.needs_move for r in out.moves.collect()] == [False]


def test_unique_rule_can_be_replaced(spark):
    c = camera().catalogue(spark)
    trace = trace_products(c)
    out = ingest.ingest_batch(
        listed(spark, NAMES[:2]), c, ingest.inspection_rules(c, trace), trace, "/data",
        unique=("utc_file_date", "product_id", "process_keywords"))
    assert out.accepted.count() == 2 and out.quarantine.count() == 0


def test_first_inspector_in_order_claims(spark):
    s = Small()
    s.product("wide", form="{ANY}_{Y}{m}{d}_v{VERSION}.dat")
    s.product("narrow", form="cam_{Y}{m}{d}_v{VERSION}.dat")
    c = s.catalogue(spark)
    trace = trace_products(c)
    claimed, rest = ingest.classify(
        listed(spark, ["cam_20120101_v1.0.0.dat"]), ingest.inspection_rules(c, trace))
    assert [r.product_id for r in claimed.collect()] == [1] and rest.count() == 0


def test_user_inspector_sees_the_bytes(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"\x01\x02\x03")
    (tmp_path / "b.bin").write_bytes(b"\xff")

    def look(frame: pd.DataFrame) -> pd.DataFrame:
        claimed = frame[frame["content"].map(lambda b: b[0] < 128)]
        return pd.DataFrame({"filename": claimed["filename"], "size": claimed["content"].map(len)})

    rows = ingest.inspect_with(list_folder(spark, str(tmp_path), content=True), look, "filename string, size bigint")
    assert [tuple(r) for r in rows.collect()] == [("a.bin", 3)]


def two_steps():
    """Raw files joined per day with their neighbours, then turned; a RUN process reads the result."""
    s = Small()
    raw = s.product("raw", form="raw_{Y}{m}{d}_v{VERSION}.txt")
    cat = s.product("cat", level=1, form="cat_{Y}{m}{d}_v{VERSION}.txt")
    rot = s.product("rot", level=2, form="rot_{Y}{m}{d}_v{VERSION}.txt")
    join, _ = s.process("join", cat)
    s.link(raw, join, yesterday=1)
    turn, _ = s.process("turn", rot, "FILE")
    s.link(cat, turn)
    show, _ = s.process("show", None, "RUN")
    s.link(rot, show)
    texts = {}
    for d in (1, 2, 3):
        texts[s.file(f"raw_2016010{d}_v1.0.0.txt", raw)] = f"Line {d}"
    for f in texts:
        s.add("processqueue", file_id=f)
    return s, texts


def test_rounds_until_the_queue_is_empty(spark):
    def work(inputs, arguments, name):
        text = "\n".join(inputs["content"])
        if name.startswith("rot"):
            import codecs
            return codecs.encode(text, "rot13")
        if name.startswith("cat_20160103"):
            raise RuntimeError("disk full")
        return text

    s, texts = two_steps()
    c = s.catalogue(spark)
    rules = ingest.inspection_rules(c, trace_products(c))
    contents = spark.createDataFrame(list(texts.items()), "file_id bigint, content string")
    results = []
    done = process_queue(
        c, contents, work, rules, "/data", "/codes", "2024-01-01 00:00:00",
        on_results=lambda runs, res: results.append((sorted(r.filename for r in res.collect()),
                                                     {r.filename: r.error for r in derive.failed(res).collect()})))
    after, held, rounds = done.catalogue, done.contents, done.rounds
    assert [(r.filename, r.error, r.round) for r in done.failed.collect()] == [
        ("cat_20160103_v1.0.0.txt", "RuntimeError: disk full", 1)]
    assert done.quarantine.collect() == []
    text = {r.filename: r.content for r in after.file.join(held, "file_id").collect()}
    assert text["cat_20160101_v1.0.0.txt"] == "Line 1"
    assert text["cat_20160102_v1.0.0.txt"] == "Line 1\nLine 2"
    assert text["rot_20160102_v1.0.0.txt"] == "Yvar 1\nYvar 2"
    assert "cat_20160103_v1.0.0.txt" not in text
    assert results[0][1] == {"cat_20160103_v1.0.0.txt": "RuntimeError: disk full"}
    assert [len(names) for names, _ in results] == [3, 2, 2] and rounds == 3
    assert all(name.startswith("RUN_show_") for name in results[2][0])
    assert after.processqueue.count() == 0
    assert after.file.count() == 7
    names = {r.file_id: r.filename for r in after.file.collect()}
    links = {(names[r.resulting_file], names[r.source_file]) for r in after.filefilelink.collect()}
    assert ("cat_20160102_v1.0.0.txt", "raw_20160101_v1.0.0.txt") in links
    assert ("rot_20160101_v1.0.0.txt", "cat_20160101_v1.0.0.txt") in links
    assert after.filecodelink.count() == 4
    digest = {r.filename: r.shasum for r in after.file.collect()}
    assert digest["rot_20160101_v1.0.0.txt"] == hashlib.sha1(b"Yvar 1").hexdigest()

    # Planning the same inputs again finds the good outputs up to date and only the failed one open.
    from tidemark.plans.reprocess import plan_changes
    again = plan_changes(after, c.processqueue).select("filename", "outcome").collect()
    assert {r.filename: r.outcome for r in again} == {
        "cat_20160101_v1.0.0.txt": "up to date", "cat_20160102_v1.0.0.txt": "up to date",
        "cat_20160103_v1.0.0.txt": "run"}


def test_rounds_go_on_where_a_lost_driver_left_them(spark, tmp_path):
    def work(inputs, arguments, name):
        return "|".join(inputs["content"]) if len(inputs) else name

    s, texts = two_steps()
    c = s.catalogue(spark)
    rules = ingest.inspection_rules(c, trace_products(c))
    contents = spark.createDataFrame(list(texts.items()), "file_id bigint, content string")
    seen, journal = [], str(tmp_path / "journal")

    def watch(stop):
        def look(runs, results):
            seen.append(sorted(r.filename.split("_")[0] for r in results.collect()))
            if len(seen) == stop:
                raise KeyboardInterrupt("the driver is lost")
        return look

    def run(stop):
        return process_queue(c, contents, work, rules, "/data", "/codes", "2024-01-01 00:00:00", on_results=watch(stop), journal=journal)

    for stop in (2, 4):  # in the second round, then in the third
        with pytest.raises(KeyboardInterrupt):
            run(stop)
    done = run(None)
    # Only the rounds that were cut off ran twice.
    assert [names[0] for names in seen] == ["cat", "rot", "rot", "RUN", "RUN"]
    held = {r.filename: r.content for r in done.catalogue.file.join(done.contents, "file_id").collect()}
    assert len(held) == 9 and held["rot_20160102_v1.0.0.txt"] == "Line 1|Line 2"
    assert done.rounds == 3 and done.catalogue.processqueue.count() == 0
    assert done.catalogue.file.select("file_id").distinct().count() == done.catalogue.file.count() == 9
    assert done.catalogue.filecodelink.count() == 6
    printed = [(r.filename, r.round) for r in side_output(spark, journal).collect()]
    assert len(printed) == len(set(printed)) == 3 and {r for _, r in printed} == {3}


def test_user_inspectors_claim_in_their_turn(spark):
    s = Small()
    first = s.product("first", form="shared_{Y}{m}{d}_v{VERSION}.dat")
    second = s.product("second", form="odd")
    c = s.catalogue(spark)
    rules = ingest.inspection_rules(c, trace_products(c))
    listing = spark.createDataFrame(
        [("shared_20120101_v1.0.0.dat", "in/a", b"late"), ("blob.bin", "in/b", b"20120203"), ("empty.bin", "in/c", b"")],
        "filename string, path string, content binary").selectExpr("*", "TIMESTAMP_NTZ '2024-01-01 00:00:00' AS modified")

    def look(frame):
        import pandas as pd

        out = []
        for name, content in zip(frame["filename"], frame["content"]):
            text = bytes(content).decode()
            day = pd.Timestamp(text) if text.isdigit() else None
            out.append((name, 2, second, day and day.date(), 0.0, 1, 0, 0, day, day))
        return pd.DataFrame(out, columns=["filename", "inspector_id", "product_id", "utc_file_date", "data_level",
                                          "interface_version", "quality_version", "revision_version", "utc_start_time", "utc_stop_time"])

    inspected = ingest.inspect_with(
        listing, look, "filename string, inspector_id bigint, product_id bigint, utc_file_date date, data_level double, "
        "interface_version smallint, quality_version smallint, revision_version smallint, utc_start_time timestamp_ntz, utc_stop_time timestamp_ntz")
    claimed, left = ingest.classify(listing, rules, inspected)
    assert {r.filename: r.product_id for r in claimed.collect()} == {"shared_20120101_v1.0.0.dat": first, "blob.bin": second}
    assert {r.filename: r.reason for r in left.collect()} == {"empty.bin": "incomplete: utc_file_date,utc_start_time,utc_stop_time"}


def test_side_output_is_text_only(spark, tmp_path):
    results = spark.createDataFrame(
        [("RUN_a", "ok", None, "hello", "x"), ("RUN_b", "failed", "e", None, None)], derive.RESULT)
    derive.write_side_output(results, str(tmp_path / "side"))
    assert [r.value for r in spark.read.text(str(tmp_path / "side")).collect()] == ["hello"]
    for _ in range(2):  # a batch run again replaces its lines
        derive.write_side_output(results, str(tmp_path / "batches"), batch=7)
    assert [r.value for r in spark.read.text(str(tmp_path / "batches"), recursiveFileLookup=True).collect()] == ["hello"]
    assert {r.status: r.runs for r in derive.status_counts(results).collect()} == {"ok": 1, "failed": 1}


def test_lines_are_concatenated_in_name_order(spark, tmp_path):
    files = spark.createDataFrame([(1, "b"), (2, "a")], "file_id bigint, filename string")
    runs = spark.createDataFrame([("out", [1, 2])], "filename string, inputs array<bigint>")
    lines = spark.createDataFrame([(1, 0, "three"), (2, 0, "one"), (2, 1, "two")], "file_id bigint, line_no int, line string")
    made = derive.concatenate(derive.run_inputs(runs, files), lines)
    assert [r.line for r in made.orderBy("output", "input", "line_no").collect()] == ["one", "two", "three"]
    derive.write_outputs(made.withColumn("line", rot13(made.line)), str(tmp_path / "out"))
    written = sorted((tmp_path / "out" / "output=out").glob("*.txt"))
    assert "".join(p.read_text() for p in written).split() == ["bar", "gjb", "guerr"]


@pytest.mark.parametrize("per_batch", [None, 2])
def test_stream_gives_what_a_batch_gives(spark, tmp_path, per_batch):
    s = camera()
    s.process("work", s.product("out", level=1))
    s.link(1, 1)
    s.file("cam_01_20110101_v1.0.0.dat", 1, file_id=40)
    c = s.catalogue(spark)
    inbox, folder = tmp_path / "in", str(tmp_path / "tables")
    inbox.mkdir()
    for name in NAMES[:1] + NAMES[3:]:
        (inbox / name).write_text(name)
    streaming.start_folder(c, folder)
    tables = ["mission", "satellite", "instrument", "instrumentproductlink", "product", "inspector", "file",
              "process", "productprocesslink", "code", "filefilelink", "filecodelink", "processqueue"]
    query = streaming.ingest_stream(
        spark, str(inbox), folder, "/data", tables, str(tmp_path / "mark"), files_per_batch=per_batch)
    query.awaitTermination()
    after = streaming.read_folder(spark, folder, tables)
    assert sorted(r.filename for r in after.file.collect()) == sorted(
        ["cam_01_20110101_v1.0.0.dat", "cam_01_20120101_v1.0.0.dat", "mon_201202.dat"])
    assert after.file.select("file_id").distinct().count() == 3
    turned_away = streaming.read_output(spark, folder, "quarantine").collect()
    assert sorted(r.reason for r in turned_away) == ["name already in the catalogue", "no inspector match"]

    # The same batch once more, as after a failure, changes nothing.
    before = sorted(ids(after.file))
    listing = list_folder(spark, str(inbox), content=True).drop("content")
    if per_batch is None:
        streaming.take_incoming(folder, "/data", tables)(listing.withColumn("shasum", listing.filename), 0)
        assert ids(streaming.read_folder(spark, folder, tables).file) == before

    query = streaming.plan_stream(spark, folder, tables, str(tmp_path / "mark2"))
    query.awaitTermination()
    runs = streaming.read_output(spark, folder, "run_list", "plans")
    assert [r.filename for r in runs.collect()] == ["out_20120101_v1.0.0"]
