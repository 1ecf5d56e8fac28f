import datetime as dt
import hashlib
import json

import pytest

from helpers import Small, ids
from tidemark.model import TABLES, conform
from tidemark.operators import audit
from tidemark.operators.catalogue import full_paths, in_date_range
from tidemark.operators.ingest import not_ingested
from tidemark.operators.trace import trace_products
from tidemark.sources import catalogue as source
from tidemark.sources import listing, logs


def write_dump(folder):
    stamp = "2016-01-02T00:00:00.000000"
    dump = {
        "mission": [{"mission_id": 1, "mission_name": "m", "rootdir": ".", "incoming_dir": "in"}],
        "product": [{"product_id": 4, "product_name": "p", "instrument_id": 1, "relative_path": "L0", "level": 0.0,
                     "format": "{nnn}.raw"}],
        # An older dump: no yesterday and tomorrow columns, no unixtime table.
        "productprocesslink": [{"process_id": 1, "input_product_id": 4, "optional": False}],
        "file": [{"file_id": 1, "filename": "001.raw", "utc_file_date": stamp, "utc_start_time": stamp,
                  "utc_stop_time": "2016-01-03T00:00:00.250000", "data_level": 0.0, "interface_version": 1,
                  "quality_version": 0, "revision_version": 2, "file_create_date": "2018-05-11T19:29:29.551336",
                  "exists_on_disk": True, "product_id": 4, "process_keywords": "nnn=001"}],
        "processqueue": [],
    }
    path = folder / "dump.json"
    path.write_text(json.dumps(dump, indent=2))
    return str(path)


def test_dump_is_typed_and_older_forms_are_filled(spark, tmp_path):
    c = source.read_dump(spark, write_dump(tmp_path))
    row = c.file.first()
    assert row.utc_file_date == dt.date(2016, 1, 2)
    assert row.utc_stop_time == dt.datetime(2016, 1, 3, 0, 0, 0, 250000)
    assert (row.revision_version, row.exists_on_disk, row.quality_checked) == (2, True, False)
    assert [f.dataType for f in c.file.schema] == [f.dataType for f in TABLES["file"].schema]
    link = c.productprocesslink.first()
    assert (link.yesterday, link.tomorrow) == (0, 0)
    assert c.processqueue.count() == 0 and c.unixtime.count() == 0


def test_append_checks_the_rules(spark, tmp_path):
    s = Small()
    a = s.product("raw")
    s.file("raw_20120101_v1.0.0", a)
    c = s.catalogue(spark)
    folder = str(tmp_path / "tables")

    def row(**values):
        base = dict(c.file.first().asDict(), file_id=9, filename="raw_20120102_v1.0.0", utc_file_date=dt.date(2012, 1, 2))
        return spark.createDataFrame([{**base, **values}], TABLES["file"].schema)

    with pytest.raises(source.RuleViolation, match="references product"):
        source.append_rows(c, "file", row(product_id=77), folder)
    with pytest.raises(source.RuleViolation, match="unique filename"):
        source.append_rows(c, "file", row(filename="raw_20120101_v1.0.0"), folder)
    with pytest.raises(source.RuleViolation, match="utc_order"):
        source.append_rows(c, "file", row(utc_start_time=dt.datetime(2030, 1, 1)), folder)
    assert not (tmp_path / "tables").exists()

    source.write_table(c.file, "file", folder)
    source.append_rows(c, "file", row(), folder)
    back = source.read_tables(spark, folder, ["file"]).file
    assert ids(back) == [1, 9]
    pruned = in_date_range(back, "2012-01-02", "2012-01-31")
    assert ids(pruned) == [9]
    assert "file_month" in pruned._jdf.queryExecution().executedPlan().toString()


def test_stored_form_of_the_unique_rule_can_be_asked(spark):
    s = Small()
    a = s.product("raw")
    for i, comment in enumerate(["x", "x", None]):
        s.file(f"raw{i}_20120101_v1.0.0", a, quality_comment=comment)
    c = s.catalogue(spark)
    stored = ("utc_file_date", "product_id", "interface_version", "quality_comment", "revision_version")

    def rules(**kw):
        rows = audit.table_violations(c, "file", **kw).collect()
        return [(r.rule.split(",")[0], r.detail) for r in rows if r.rule.startswith("unique utc")]

    assert rules() == [("unique utc_file_date", "3 rows")]
    assert rules(unique=(stored,)) == [("unique utc_file_date", "2 rows")]


def test_listing_digest_and_audits(spark, tmp_path):
    root = tmp_path / "data"
    (root / "store").mkdir(parents=True)
    s = Small()
    a = s.product("raw")
    good, bad = b"good bytes", b"other bytes"
    for name, content in (("raw_20120101_v1.0.0", good), ("raw_20120102_v1.0.0", bad)):
        (root / "store" / name).write_bytes(content)
    s.file("raw_20120101_v1.0.0", a, shasum=hashlib.sha1(good).hexdigest())
    s.file("raw_20120102_v1.0.0", a, shasum="0" * 40)
    gone = s.file("raw_20120103_v1.0.0", a, shasum="1" * 40)
    c = s.catalogue(spark)
    found = listing.list_folder(spark, str(root), recursive=True, content=True)
    assert sorted(r.relative_path for r in found.select("relative_path").collect()) == [
        "store/raw_20120101_v1.0.0", "store/raw_20120102_v1.0.0"]
    files = full_paths(c.file, trace_products(c), str(root))
    digests = listing.with_digest(found)
    audited = {r.file_id: r.result for r in audit.checksum_audit(files, digests).collect()}
    assert audited == {2: 1, 3: 2}
    fresh = audit.refreshed_checksums(files, digests)
    assert {r.file_id: r.shasum for r in fresh.collect()}[2] == hashlib.sha1(bad).hexdigest()
    missing = audit.existence_audit(files, found)
    assert ids(missing) == [gone]
    fixed = audit.corrected_existence(files, missing)
    assert ids(fixed.where("exists_on_disk")) == [1, 2]
    assert ids(audit.existence_audit(files, found, from_id=4)) == []


def test_tree_scan_finds_what_is_not_ingested(spark, tmp_path):
    s = Small()
    one = s.product("one", form="{PRODUCT}/{Y}/prod1{Y}{m}{d}.txt", path="junk")
    two = s.product("two", form="prod2{Y}{m}{d}.txt", path="junk")
    s.file("prod120000101.txt", one)
    c = s.catalogue(spark)
    (tmp_path / "junk" / "one" / "2000").mkdir(parents=True)
    for name in ("one/2000/prod120000101.txt", "one/2000/prod120000102.txt", "one/2000/somethingelse.txt",
                 "prod219990501.txt", "another.txt"):
        (tmp_path / "junk" / name).write_text("x")
    found = listing.list_folder(spark, str(tmp_path), recursive=True)
    pairs = listing.product_files(found, listing.path_patterns(trace_products(c)))
    assert sorted((r.product_id, r.relative_path) for r in pairs.collect()) == [
        (one, "junk/one/2000/prod120000101.txt"), (one, "junk/one/2000/prod120000102.txt"),
        (two, "junk/prod219990501.txt")]
    assert sorted(r.filename for r in not_ingested(pairs, c.file).collect()) == [
        "prod120000102.txt", "prod219990501.txt"]


def test_empty_and_underscore_files_are_listed_and_exist(spark, tmp_path):
    root = tmp_path / "data"
    (root / "store" / "_deep").mkdir(parents=True)
    names = {"a.dat": b"x", "empty.dat": b"", "_u.dat": b"y" * 3_000_000, ".hidden": b"", "_deep/é b.dat": b"z"}
    for name, content in names.items():
        (root / "store" / name).write_bytes(content)
    found = listing.list_folder(spark, str(root), recursive=True, digest=True)
    got = {r.relative_path: (r.length, r.shasum) for r in found.collect()}
    assert got == {f"store/{n}": (len(c), hashlib.sha1(c).hexdigest()) for n, c in names.items()}
    flat = listing.list_folder(spark, f"file://{root}/store", content=True).collect()
    assert {r.filename: bytes(r.content) for r in flat} == {n: c for n, c in names.items() if "/" not in n}
    assert listing.list_folder(spark, str(root), "*.dat").collect() == []
    assert {r.filename for r in listing.list_folder(spark, str(root / "store"), "{a,_u}.d?t").collect()} == {"a.dat", "_u.dat"}
    files = spark.createDataFrame(
        [(i, n, f"{root}/store/{n}", True) for i, n in enumerate([*names, "gone.dat"])],
        "file_id int, filename string, full_path string, exists_on_disk boolean")
    assert [r.filename for r in audit.existence_audit(files, found).collect()] == ["gone.dat"]


def test_keys_are_compared_part_by_part(spark):
    schema = "a string, b string, v int"
    left = spark.createDataFrame([("a|b", "c", 1), (None, "x", 1), ("same", None, 1)], schema)
    right = spark.createDataFrame([("a", "b|c", 1), ("null", "x", 1), ("same", None, 2)], schema)
    got = sorted((r.key, r.attribute) for r in audit.compare_rows(left, right, ["a", "b"], ["v"]).collect())
    assert got == [("a|b|c", "only left"), ("a|b|c", "only right"), ("null|x", "only left"), ("null|x", "only right"), ("same|null", "v")]


def test_time_bounds_reach_the_scan(spark, tmp_path):
    from tidemark.operators.catalogue import in_time_range

    s = Small()
    a = s.product("raw")
    for d in range(1, 9):
        s.file(f"raw_2012010{d}_v1.0.0", a)
    source.write_table(s.catalogue(spark).file, "file", str(tmp_path))
    back = source.read_tables(spark, str(tmp_path), ["file"]).file
    cut = in_time_range(back, "2012-01-03", "2012-01-05")
    assert ids(cut) == [3, 4, 5]
    pushed = cut._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(utc_stop_time" in pushed and "LessThan(utc_start_time" in pushed


def test_incoming_glob(spark, tmp_path):
    for name in ("b.dat", "a.dat", "c.txt"):
        (tmp_path / name).write_text("x")
    assert [r.filename for r in listing.incoming(spark, str(tmp_path), "*.dat").collect()] == ["a.dat", "b.dat"]


def test_log_files_by_date(spark, tmp_path):
    for day in ("2024-01-01", "2024-01-02", "2024-01-05"):
        (tmp_path / f"run.log.{day}").write_text(f"{day} 10:00:00,000 - m:1 - INFO - hello\n")
    lines = logs.logs_between(logs.read_log_lines(spark, str(tmp_path)), "2024-01-02", "2024-01-04")
    assert [r.log_name for r in lines.collect()] == ["run.log.2024-01-02"]


def test_reports_are_written(spark, tmp_path):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    for form in ("parquet", "csv", "json"):
        source.write_report(df, str(tmp_path / form), form)
    assert spark.read.option("header", "true").csv(str(tmp_path / "csv")).first().b == "x"
    with pytest.raises(ValueError):
        source.write_report(df, str(tmp_path / "x"), "html")


def test_database_reader_needs_a_driver(spark):
    # No JDBC driver is at hand; the reader must reach Spark's JDBC source and fail there.
    with pytest.raises(Exception, match="(?i)driver|jdbc"):
        source.read_database(spark, "jdbc:sqlite:/nowhere.db", tables=["mission"])


def test_conform_orders_and_fills(spark):
    df = spark.createDataFrame([(1, 2, True)], "input_product_id int, process_id int, optional boolean")
    row = conform(df, "productprocesslink").first()
    assert tuple(row) == (2, 1, True, 0, 0)
    with pytest.raises(ValueError):
        from tidemark import Catalogue
        Catalogue(nothing=df)


def test_a_local_folder_is_listed_as_a_stream(spark, tmp_path, monkeypatch):
    """In portions, without the store's list of the whole folder; sizes and times as the store tells them."""
    from pyarrow import fs

    from tidemark.sources import listing

    (tmp_path / "sub").mkdir()
    for i in range(50):
        (tmp_path / f"f{i}").write_bytes(b"x" * i)
    (tmp_path / "sub" / "_in").write_bytes(b"")
    (tmp_path / "nowhere").symlink_to(tmp_path / "gone")
    told = {f.path: (f.type, f.size, f.mtime_ns) for f in fs.LocalFileSystem().get_file_info(fs.FileSelector(str(tmp_path)))}
    found = listing.entries_of(fs.LocalFileSystem(), str(tmp_path))
    assert iter(found) is found and {path: facts for path, *facts in found} == {p: list(facts) for p, facts in told.items()}
    monkeypatch.setattr(listing, "LISTED", 7)
    rows = {r.path: (r.length, r.modified) for r in listing.list_folder(spark, str(tmp_path), recursive=True).collect()}
    want = fs.LocalFileSystem().get_file_info(fs.FileSelector(str(tmp_path), recursive=True))
    assert rows == {f.path: (f.size, f.mtime.replace(tzinfo=None)) for f in want if f.type == fs.FileType.File}
