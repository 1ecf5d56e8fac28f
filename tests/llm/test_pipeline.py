import hashlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import tiktoken
from llm_helpers import CLASHES, documents, near_components, words

import corpus_pipeline
from tidemark.llm import toxicity
from tidemark.llm.bpe import load_ranks
from tidemark.llm.queries import ORACLES, QUERIES

DIR = "/root/testdata/sf0.001"


def rows_of(df):
    return [(r.doc_id, r.text, r.source) for r in df.select("doc_id", "text", "source").collect()]


def check_stages(spark, docs, folder):
    """Every stage against a plain version on what the stage before it kept."""
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "exact_dedup", "minhash_dedup", "mix_sources", "byte_bpe"]
    clean = stages["toxicity"](spark, docs, folder)
    model = toxicity.fit(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    bad = {r.doc_id for r in toxicity.score_documents(docs, model).where("predicted = 1").collect()}
    before = rows_of(docs)
    now = rows_of(clean)
    assert sorted(now, key=str) == sorted((r for r in before if r[0] not in bad), key=str)

    unique = stages["exact_dedup"](spark, clean, folder)
    best = {}
    for i, t, s in now:
        best[t or ""] = max([x for x in (best.get(t or ""), i) if x is not None], default=None)
    now = rows_of(unique)
    assert sorted(((i, t or "") for i, t, _ in now), key=str) == sorted(((i, t) for t, i in best.items()), key=str)

    apart = stages["minhash_dedup"](spark, unique, folder)
    pairs = [(i, t) for i, t, _ in now]
    keep = {i for i, n, c in near_components(pairs, 5, 80) if i == c}
    now = rows_of(apart)
    assert {i for i, _, _ in now} == keep and len(now) == len(keep)

    mixed = stages["mix_sources"](spark, apart, folder)
    assert mixed.columns == docs.columns
    sizes, taken = defaultdict(int), Counter()
    for _, t, s in now:
        sizes[s] += len(words(t))
    copies = Counter(rows_of(mixed))
    for (i, t, s), n in copies.items():
        assert (i, t, s) in now and n <= 2
        taken[s] += n * len(words(t))
    longest = max((len(words(t)) for _, t, _ in now), default=0)
    assert abs(sum(taken.values()) - 1.5 * sum(sizes.values())) <= longest * max(1, len(sizes))

    last = stages["byte_bpe"](spark, mixed, folder)
    ranks = load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = Counter()
    for (i, t, _), n in copies.items():
        ids = library.encode_ordinary(t or "")
        want[i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()] += n
    assert Counter(tuple(r) for r in last.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()) == want
    return want


def test_stages_and_run(spark):
    want = check_stages(spark, spark.read.parquet(f"{DIR}/documents.parquet"), DIR)
    got = corpus_pipeline.run(spark, DIR)
    assert Counter(tuple(r) for r in got.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()) == want


def test_odd_rows_and_clashing_columns(spark):
    rows = [(1, None, "a"), (2, "", None), (3, "one two three four five six", "a"), (4, "one two three four five six", "a"),
            (5, "One two three four five six", "b"), (5, "One two three four five six", "b"), (6, "z " * 30_000, None), (7, " ", "b")]
    check_stages(spark, documents(spark, rows, clash=True), DIR)
    assert set(CLASHES) <= set(documents(spark, rows, clash=True).columns)


def test_empty_table(spark):
    docs = documents(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, DIR)
    assert docs.collect() == []


def test_queries_have_the_columns_asked_for(spark):
    columns = {
        1: "doc_id keep_id group_size kept text_sha256", 2: "doc_id n_email n_ip n_card n_phone base_sha256 spans",
        3: "doc_id n_tokens ids_sha256 decoded_sha256", 4: "vec_id n_links component_id kept", 5: "doc_id held_out score predicted",
        6: "doc_id held_out lang_pred score", 7: "doc_id n_bytes n_tokens over_limit", 8: "doc_id n_shingles component_id kept",
        9: "doc_id n_bytes n_removed n_spans kept_sha256", 10: "doc_id size source_size target taken",
        11: "item_id rank doc_id score", 12: "query_id rank vec_id score", 13: "lang source part item value rank",
    }
    db = duckdb.connect()
    for table in ("documents", "embeddings", "benchmark"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DIR}/{table}.parquet'")
    for name, build in QUERIES.items():
        df = build(spark, DIR)
        number = int(name[2:].split("_")[0])
        wanted = columns[number].split()
        assert df.columns[:len(wanted)] == wanted
        got = [tuple(r) for r in df.collect()]
        table = "embeddings" if name.startswith("op4_") else "documents"
        assert number > 10 or len(got) == db.execute(f"SELECT count(*) FROM {table}").fetchone()[0]
        if name in ORACLES:
            cursor = db.execute(ORACLES[name])
            names = [d[0] for d in cursor.description]
            order = [names.index(c) for c in df.columns]
            assert sorted(got) == sorted(tuple(r[i] for i in order) for r in cursor.fetchall())
