import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.sources import key_index
from tidemark.sources.key_index import KeyIndex
from tidemark.sources.listing import list_folder
from tidemark.sources.versions import Versions, published
from tidemark.streaming.incoming import IncomingReader, IncomingSource, Snapshots


def test_versions_stay_few_folders_and_readers_keep_theirs(spark, tmp_path):
    versions = Versions(spark, str(tmp_path), merge=4)
    pinned = None
    for batch in range(30):
        manifest = versions.append(batch, {"t": spark.range(batch, batch + 1).coalesce(1)})
        pinned = manifest if batch == 10 else pinned
        assert len(manifest.folders["t"]) <= 3 * 3
        assert len(versions.read("t", manifest).inputFiles()) <= 3 * 3
    assert sorted(r.id for r in versions.read("t", versions.manifest()).collect()) == list(range(30))
    assert sorted(r.id for r in versions.read("t", pinned).collect()) == list(range(11))
    assert [r.id for r in versions.added("t", 20).collect()] == [20]


def test_folders_of_two_hundred_batches(spark, tmp_path, monkeypatch):
    """The merging rule alone, without writing rows."""
    versions = Versions(spark, str(tmp_path))
    monkeypatch.setattr(versions, "_written", lambda table, rows: f"{table}/{np.random.randint(1 << 60)}")
    monkeypatch.setattr(versions, "_tasks", lambda rows: 1)

    class Nothing:
        def coalesce(self, n):
            return self

    versions.layouts["t"] = key_index.Layout(None, lambda spark, paths: Nothing())
    most = max(len(versions.append(batch, {"t": Nothing()}).folders["t"]) for batch in range(200))
    assert most <= 7 * 3


def test_a_crash_before_publishing_loses_and_repeats_nothing(spark, tmp_path, monkeypatch):
    versions = Versions(spark, str(tmp_path))
    versions.append(0, {"t": spark.range(3)}, {"n": 3})
    with monkeypatch.context() as patch:
        patch.setattr(versions, "_publish", lambda manifest: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            versions.append(1, {"t": spark.range(3, 5)}, {"n": 5})
    assert versions.read("t", versions.manifest()).count() == 3 and versions.manifest().numbers == {"n": 3}
    assert len(versions.unlisted()) == 1
    again = versions.append(1, {"t": spark.range(3, 5)}, {"n": 5})
    assert sorted(r.id for r in versions.read("t", again).collect()) == list(range(5)) and again.numbers == {"n": 5}
    # The batch once more, as by a stream that did not learn of its success.
    assert versions.append(1, {"t": spark.range(3, 5)}) == again
    assert published(str(tmp_path), "tables") == [0, 1]


def test_filters_never_miss_and_seldom_pass_in_vain():
    rng = np.random.default_rng(3)
    held, others = (rng.integers(-(2**63), 2**63 - 1, 5_000) for _ in range(2))
    made = key_index.filter_of(held)
    assert key_index.may_hold(made, held).all()
    assert key_index.may_hold(made, others).mean() < 0.03
    assert not key_index.may_hold(key_index.filter_of(held[:0]), others).any()


def test_a_batch_reads_only_the_buckets_of_its_names(spark, tmp_path):
    versions = Versions(spark, str(tmp_path))
    index = KeyIndex(versions, "file", {"name": ["filename"], "pair": ["day", "product"]}, buckets=64)
    files = spark.range(3_000).select(F.concat(F.lit("f"), "id").alias("filename"), (F.col("id") % 30).alias("day"), F.when(F.col("id") % 7 > 0, F.col("id")).alias("product"))
    manifest = versions.append(0, {"file": files, **index.rows(files)})
    asked = spark.createDataFrame([(f"f{i}",) for i in range(5)] + [(f"new{i}",) for i in range(5)] + [(None,)], "filename string")
    hashed = index._hashed(asked, "name").select("key", "hash", "bucket")
    touched = index.touched(hashed, "name", manifest)
    own = {r.bucket for r in hashed.collect()}
    assert {b for _, b in touched} <= own and len(touched) <= 7  # five that are there, hardly one of the new ones
    assert sorted(r.key for r in index.present_keys(asked, "name", manifest).collect()) == sorted(f'["f{i}"]' for i in range(5))
    read = index.present_keys(asked, "name", manifest).inputFiles()
    assert read and {int(p.split("bucket=")[1].split("/")[0]) for p in read if "bucket=" in p} <= own
    there, new = index.split(asked, "name", manifest)
    assert sorted(r.filename for r in there.collect()) == [f"f{i}" for i in range(5)]
    assert sorted((r.filename for r in new.collect()), key=str) == [None] + [f"new{i}" for i in range(5)] or new.count() == 6
    # As in SQL a null in a key never clashes; several columns count together.
    pairs = spark.createDataFrame([(1, 1), (1, None), (0, 0), (2, 1)], "day int, product int")
    assert [(r.day, r.product) for r in index.split(pairs, "pair", manifest)[0].collect()] == [(1, 1)]


def test_the_index_grows_and_merges_with_its_table(spark, tmp_path):
    versions = Versions(spark, str(tmp_path), merge=3)
    index = KeyIndex(versions, "file", {"name": ["filename"]}, buckets=4)
    for batch in range(7):
        rows = spark.createDataFrame([(f"b{batch}_{i}",) for i in range(20)] if batch != 2 else [], "filename string")
        manifest = versions.append(batch, index.rows(rows))
        assert len(manifest.folders["file_keys"]) <= 2 * 2 + 1
    asked = spark.createDataFrame([(f"b{b}_{i}",) for b in range(8) for i in (0, 19, 20)], "filename string")
    found = sorted(r.filename for r in index.split(asked, "name", manifest)[0].collect())
    assert found == sorted(f"b{b}_{i}" for b in (0, 1, 3, 4, 5, 6) for i in (0, 19))


def fill_folder(folder):
    (folder / "sub").mkdir(parents=True)
    content = {"a.dat": b"a" * 3_000_000, "_b.dat": b"b", ".c.dat": b"c", "empty.dat": b"", "sub/d e%20.dat": b"d", "other.txt": b"o"}
    for name, data in content.items():
        (folder / name).write_bytes(data)
    return content


def test_the_stream_takes_what_a_batch_takes(spark, tmp_path):
    inbox = tmp_path / "in"
    content = fill_folder(inbox)
    spark.dataSource.register(IncomingSource)
    got = []

    def run():
        reader = spark.readStream.format("tidemark_incoming").option("snapshots", str(tmp_path / "marks")).option("recursive", "true")
        reader = reader.option("glob", "*.dat").option("files_per_share", 2).option("archive", str(tmp_path / "done"))
        query = reader.load(str(inbox)).writeStream.foreachBatch(lambda rows, _: got.extend(rows.collect()))
        query.option("checkpointLocation", str(tmp_path / "mark")).trigger(availableNow=True).start().awaitTermination()

    listed = {r.path: r for r in list_folder(spark, str(inbox), "*.dat", recursive=True, digest=True).collect()}
    run()
    assert {(r.path, r.filename, r.relative_path, r.length, r.uri, r.shasum) for r in got} == {
        (r.path, r.filename, r.relative_path, r.length, r.uri, r.shasum) for r in listed.values()}
    assert len(got) == 5 and {r.shasum for r in got} == {hashlib.sha1(d).hexdigest() for n, d in content.items() if n != "other.txt"}


def test_snapshots_give_each_state_of_a_file_once(tmp_path):
    inbox = tmp_path / "in"
    fill_folder(inbox)
    options = {"path": str(inbox), "snapshots": str(tmp_path / "marks"), "files_per_batch": "2", "archive": str(tmp_path / "done")}
    reader = IncomingReader(options)

    def given(start, end):
        return sorted((r[0], r[2], r[4]) for share in reader.partitions({"snapshot": start}, {"snapshot": end}) for r in reader.read(share))

    assert reader.latestOffset() == {"snapshot": 2}  # five files, two a snapshot
    first = given(-1, 2)
    assert len(first) == 5 and first == given(-1, 2)
    assert IncomingReader(options).latestOffset() == {"snapshot": 2}  # after a restart, nothing new
    (inbox / "_b.dat").write_bytes(b"longer")
    (inbox / "a.dat").unlink()
    assert reader.latestOffset() == {"snapshot": 3} and [x[1:] for x in given(2, 3)] == [("_b.dat", 6)]
    assert len(Snapshots(options["snapshots"]).read(3)["old"]) == 3  # what is gone leaves the snapshots
    reader.commit({"snapshot": 3})
    assert sorted(p.name for p in (tmp_path / "done").iterdir()) == [".c.dat", "_b.dat", "empty.dat", "other.txt"]


def test_a_share_is_all_that_its_reader_meets(tmp_path):
    """However much was given out before, a task opens the mark and its own share."""
    inbox = tmp_path / "in"
    for name in ("b", "a/b", "a.x", "a/c/d", "a-", "ab"):
        (inbox / name).parent.mkdir(parents=True, exist_ok=True)
        (inbox / name).write_bytes(b"1")
    options = {"path": str(inbox), "snapshots": str(tmp_path / "marks"), "recursive": "true", "files_per_batch": "4", "files_per_share": "3"}
    reader = IncomingReader(options)
    assert reader.latestOffset() == {"snapshot": 1}
    (inbox / "a" / "b").write_bytes(b"22")
    (inbox / "z").write_bytes(b"1")
    assert reader.latestOffset() == {"snapshot": 2}
    for old in (tmp_path / "marks").glob("*.old"):
        old.unlink()
    shares = reader.partitions({"snapshot": -1}, {"snapshot": 2})
    before = [[r[:2] for r in reader.snapshots.share(s.number, s.share)] for s in shares]
    names = [[path.removeprefix(f"{inbox}/") for path, _size in share] for share in before]
    assert names == [["a-", "a.x", "a/b"], ["a/c/d"], ["ab", "b"], ["a/b", "z"]]
    assert [(r[0], r[3], r[4]) for r in reader.read(shares[3])] == [(2, "a/b", 2), (2, "z", 1)]
