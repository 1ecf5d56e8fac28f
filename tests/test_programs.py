"""Programs over files: bytes in and out, one file per output whatever happens to an attempt."""

import hashlib
import os

import pytest
from pyspark.sql import functions as F
from test_ingest import two_steps

from tidemark.operators import derive, ingest, programs
from tidemark.operators.programs import run_commands, run_programs
from tidemark.operators.trace import trace_products
from tidemark.plans.rounds import process_queue, side_output

RUNS = "filename string, inputs array<bigint>, params array<string>, arguments array<string>, code_path string"


def turned():
    """Made in place, so that it travels to the workers by value: the inputs' bytes backwards, by range."""

    def work(inputs, arguments, output):
        if "break" in arguments:
            output.write(b"half")
            raise RuntimeError("no space")
        for given in inputs:
            with given.open() as stream:
                size = stream.size()
            for at in range(size - 1, -1, -1):
                output.write(given.read_range(at, 1))

    return work


@pytest.fixture
def given(spark, tmp_path):
    source = tmp_path / "in put"
    source.mkdir()
    parts = {1: ("b.raw", bytes(range(256))), 2: ("a.raw", b""), 3: ("c#%?.raw", b"\xff\x00end")}
    rows = []
    for number, (name, data) in parts.items():
        (source / name).write_bytes(data)
        rows.append((number, name, f"file://{source}/{name}"))
    rows += [(4, "gone.raw", f"file://{source}/gone.raw"), (5, "unknown.raw", None)]
    return parts, spark.createDataFrame(rows, "file_id bigint, filename string, uri string")


def runs_of(spark, *rows):
    return spark.createDataFrame([(n, i, [], list(a), "/bin/sh") for n, i, *a in rows], RUNS)


def lying(folder):
    return {n: open(os.path.join(folder, n), "rb").read() for n in os.listdir(folder) if n != programs.ATTEMPTS}


def test_bytes_in_and_out(spark, given, tmp_path):
    parts, files = given
    out = str(tmp_path / "out")
    runs = runs_of(
        spark, ("x.bin", [3, 1, 2]), ("none.bin", []), ("null.bin", None), ("bad.bin", [1], "break"), ("gap.bin", [1, 4]),
        ("nowhere.bin", [5]), ("missing_row.bin", [9]), ("../up.bin", [1]), (None, [1]), ("_attempts", [1]))
    got = {r.filename: r for r in run_programs(runs, files, turned(), out).collect()}
    wanted = {"x.bin": parts[1][1][::-1] + parts[3][1][::-1], "none.bin": b"", "null.bin": b""}
    assert lying(out) == wanted
    assert os.listdir(os.path.join(out, programs.ATTEMPTS)) == []
    assert not os.path.exists(tmp_path / "up.bin")
    for name, data in wanted.items():
        assert got[name].status == "ok" and got[name].length == len(data)
        assert got[name].shasum == hashlib.sha1(data).hexdigest() and got[name].uri == f"file://{out}/{name}"
    assert got["bad.bin"].error == "RuntimeError: no space" and got["gap.bin"].error.startswith("FileNotFoundError")
    assert got["nowhere.bin"].error == "FileNotFoundError: no path of input 5"
    assert got["missing_row.bin"].error == "FileNotFoundError: no path of input 9"
    assert {got[n].status for n in ("../up.bin", None, "_attempts")} == {"failed"}
    assert len(got) == 10


def test_repeated_runs_replace_their_output(spark, given, tmp_path):
    _parts, files = given
    out = str(tmp_path / "out")

    def writing(word):
        return lambda inputs, arguments, output: output.write(word)

    runs = runs_of(spark, ("x.bin", [1]))
    run_programs(runs, files, writing(b"first"), out)
    assert run_programs(runs, files, writing(b"second"), out).first().shasum == hashlib.sha1(b"second").hexdigest()
    assert lying(out) == {"x.bin": b"second"}
    assert run_programs(runs.limit(0), files, writing(b"none"), str(tmp_path / "empty")).collect() == []
    assert not os.path.exists(tmp_path / "empty")


def test_a_rename_done_again_finds_itself_done(tmp_path):
    private, final = f"file://{tmp_path}/p", f"file://{tmp_path}/f"
    (tmp_path / "p").write_bytes(b"new")
    (tmp_path / "f").write_bytes(b"old")
    programs._place(private, final)
    programs._place(private, final)
    assert (tmp_path / "f").read_bytes() == b"new" and not (tmp_path / "p").exists()
    with pytest.raises(FileNotFoundError):
        programs._place(private, f"file://{tmp_path}/other")


def test_a_lost_attempt_of_an_unsteady_program_leaves_one_file(spark, given, tmp_path):
    # The first attempts write their file and then never return a row: what was taken is what lies there.
    _parts, files = given
    marks, area = str(tmp_path / "marks"), f"file://{tmp_path}/area"
    os.makedirs(marks)

    def unsteady(inputs, arguments, output):
        output.write(os.urandom(16))

    taken = []
    for _ in range(3):
        taken.append(programs._attempt("x.bin", [], [], unsteady, area))
    chosen = taken[1]
    programs._place(chosen[5], f"file://{tmp_path}/x.bin")
    assert hashlib.sha1((tmp_path / "x.bin").read_bytes()).hexdigest() == chosen[4]
    assert len({row[4] for row in taken}) == 3


def test_command_lines(spark, given, tmp_path):
    parts, files = given
    out = str(tmp_path / "out")
    script = tmp_path / "join.sh"
    script.write_text('word=$1; shift\n[ "$word" = stop ] && { echo "told to stop" >&2; exit 3; }\n'
                      '[ "$word" = idle ] && exit 0\nfor last; do :; done\n'
                      'printf %s "$word" > "$last"\nwhile [ $# -gt 1 ]; do cat "$1" >> "$last"; shift; done\n')
    rows = [("a.bin", [1, 2, 3], [str(script)], ["two words"], "/bin/sh"), ("b.bin", [1], [str(script)], ["stop"], "/bin/sh"),
            ("c.bin", [1], [str(script)], ["idle"], "/bin/sh"), ("d.bin", [1], [], [], str(tmp_path / "no_code"))]
    got = {r.filename: r for r in run_commands(spark.createDataFrame(rows, RUNS), files, out).collect()}
    assert lying(out) == {"a.bin": b"two words" + parts[1][1] + parts[3][1]}
    assert got["a.bin"].shasum == hashlib.sha1(lying(out)["a.bin"]).hexdigest()
    assert got["b.bin"].error == "RuntimeError: exit 3: told to stop"
    assert got["c.bin"].error == "FileNotFoundError: the program left no output"
    assert got["d.bin"].status == "failed" and got["d.bin"].error.startswith("FileNotFoundError")


def test_no_content_in_the_exchange(spark, given, tmp_path, monkeypatch):
    _parts, files = given
    plans = []

    def looked_at(frame, keep=programs.durable):
        plans.append(frame._jdf.queryExecution().executedPlan().toString())
        return keep(frame)

    monkeypatch.setattr(programs, "durable", looked_at)
    run_programs(runs_of(spark, ("x.bin", [1, 3])), files.withColumn("content", F.lit("cell")), turned(), str(tmp_path / "out"))
    assert len(plans) == 2 and all("content" not in plan for plan in plans)
    assert "REPARTITION_BY_NUM" in plans[0] and "Exchange" not in plans[1]


def test_rounds_over_files(spark, tmp_path):
    """The queue is emptied by programs over files; with a journal a second call finds all rounds done."""
    s, texts = two_steps()
    raw, out, journal = tmp_path / "raw", str(tmp_path / "out"), str(tmp_path / "journal")
    raw.mkdir()
    rows = []
    for number, text in texts.items():
        (raw / str(number)).write_bytes(b"\xff" + text.encode())
        rows.append((number, f"file://{raw}/{number}"))

    def work(inputs, arguments, output):
        for given in inputs:
            if given.filename == "raw_20160103_v1.0.0.txt":
                raise RuntimeError("disk full")
            for part in given.portions():
                output.write(part[::-1])

    c = s.catalogue(spark)
    rules = ingest.inspection_rules(c, trace_products(c))
    contents = spark.createDataFrame(rows, "file_id bigint, uri string")
    seen = []
    for _ in range(2):
        done = process_queue(
            c, contents, work, rules, "/data", "/codes", "2024-01-01 00:00:00", journal=journal, folder=out,
            on_results=lambda runs, results: seen.append(derive.succeeded(results).count()))
        uris = {r.filename: r.uri for r in done.catalogue.file.join(done.contents, "file_id").collect()}
        assert done.rounds == 3 and len(uris) == len(texts) + 4
        assert uris["rot_20160102_v1.0.0.txt"] == f"file://{out}/rot_20160102_v1.0.0.txt"
        assert [r.filename for r in done.failed.collect()] == ["cat_20160103_v1.0.0.txt"]
    assert seen == [2, 2, 2]
    held = lying(out)
    assert held["cat_20160102_v1.0.0.txt"] == b"1 eniL\xff2 eniL\xff"
    assert held["rot_20160102_v1.0.0.txt"] == b"\xffLine 2\xffLine 1"
    digests = {r.filename: r.shasum for r in done.catalogue.file.collect()}
    assert digests["rot_20160102_v1.0.0.txt"] == hashlib.sha1(held["rot_20160102_v1.0.0.txt"]).hexdigest()
    printed = side_output(spark, journal).collect()
    assert len(printed) == 2 and all(r.uri == f"file://{out}/{r.filename}" for r in printed)


def test_runs_go_through_a_task_as_a_stream(spark, monkeypatch, capsys):
    """Not one call of a worker a run: runs over the edges of portions, with gaps, failures and no inputs."""
    from tidemark.operators import derive

    monkeypatch.setattr(derive, "MADE", 4)
    runs = [(f"o{i}", list(range(i, i + i % 9))) for i in range(40)] + [("none", None), ("gap", [1, 99, None])]
    files = [(i, f"f{50 - i:02}", f"c{i}" if i % 5 else None) for i in range(50)]

    def code(inputs, arguments, name):
        if len(inputs) > 6:
            raise ValueError(name)
        return "|".join(f"{r.file_id}{r.filename}{r.content}" for r in inputs.itertuples())

    given = spark.createDataFrame(runs, "filename string, inputs array<bigint>")
    table = spark.createDataFrame(files, "file_id bigint, filename string, content string")
    made = derive.run_code(given, table.drop("content"), table.drop("filename"), code)
    made.explain()
    assert "MapInArrow" in (plan := capsys.readouterr().out) and "FlatMapGroups" not in plan
    got = {r.filename: (r.status, r.content) for r in made.collect()}
    facts = {i: (name, content) for i, name, content in files}
    want = {}
    for name, ids in runs:
        known = sorted((i for i in ids or [] if i in facts), key=lambda i: facts[i][0])
        known += [i for i in ids or [] if i is not None and i not in facts]
        text = "|".join(f"{i}{''.join(map(str, facts.get(i, (None, None))))}" for i in known)
        want[name] = ("failed", None) if len(known) > 6 else ("ok", text)
    assert got == want
