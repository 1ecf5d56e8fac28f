import hashlib
from collections import defaultdict

from llm_helpers import documents

from tidemark.llm.common import scratch
from tidemark.llm.exact_dedup import DigestIndex, drop_repeats

ROWS = [(1, "a"), (2, "b"), (3, "a"), (4, None), (5, ""), (6, "A"), (7, "a "), (7, "a "), (None, "b"), (None, "only null"), (8, "x" * 200_000), (9, "x" * 200_000)]


def plain(rows):
    ids = defaultdict(list)
    for i, t in rows:
        ids[t or ""].append(i)
    out = []
    for i, t in rows:
        keep = max((x for x in ids[t or ""] if x is not None), default=None)
        out.append((i, keep, len(ids[t or ""]), i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=str)


def result(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in df.collect()), key=str)


def test_nulls_ties_repeats_long_texts_and_clashing_columns(spark):
    index = DigestIndex(spark, scratch(spark, "t"), 4)
    assert result(index.add(documents(spark, ROWS, clash=True))) == plain(ROWS)


def test_empty_table(spark):
    index = DigestIndex(spark, scratch(spark, "t"), 4)
    assert index.add(documents(spark, [])).collect() == []
    assert index.rows().count() == 0


def test_the_index_persists_and_a_batch_can_be_repeated(spark):
    path = scratch(spark, "t")
    first = documents(spark, [(1, "a"), (2, "b"), (3, "a")])
    second = documents(spark, [(10, "b"), (11, "c"), (12, "c")])
    DigestIndex(spark, path, 4).add(first, "one")
    spark.sql(f"DROP TABLE {DigestIndex(spark, path, 4).table}")  # the files stay, as for a new session
    index = DigestIndex(spark, path, 4)
    got = {r.doc_id: (r.keep_id, r.known, r.kept) for r in index.add(second, "two").collect()}
    assert got == {10: (2, True, False), 11: (12, False, False), 12: (12, False, True)}
    again = {r.doc_id: (r.keep_id, r.known, r.kept) for r in index.add(second, "two").collect()}
    assert again == got
    assert sorted((r.keep_id, r.n_rows, r.batch) for r in index.rows().collect()) == [(2, 1, "one"), (3, 2, "one"), (12, 2, "two")]


def test_the_index_side_is_not_shuffled(spark):
    index = DigestIndex(spark, scratch(spark, "t"), 4)
    index.add(documents(spark, [(1, "a")]), "one")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        new = documents(spark, [(2, "b")]).selectExpr("sha2(text, 256) AS digest")
        plan = new.join(index.rows().hint("merge"), "digest", "left_anti")._jdf.queryExecution().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    physical = plan[plan.index("== Physical Plan =="):]
    assert "SortMergeJoin" in physical and physical.count("Exchange hashpartitioning") == 1


def test_kept_rows_have_all_columns_once(spark):
    docs = documents(spark, ROWS, clash=True)
    kept = drop_repeats(docs, DigestIndex(spark, scratch(spark, "t"), 4))
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(
        [(3, "a"), (2, "b"), (5, ""), (6, "A"), (7, "a "), (None, "only null"), (9, "x" * 200_000)], key=str
    )
