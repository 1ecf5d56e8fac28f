import zlib

from llm_helpers import documents

from tidemark.llm import language


def test_held_out_accuracy_and_edges(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.fit(docs, train_rows=150)
    assert model.families == {"germanic": ["de", "en"], "romance": ["es", "fr"]}
    rows = language.predict_languages(docs, model).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert sum(r.lang_pred == r.lang for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)
    odd = [(1, None), (2, ""), (3, "123 !? \n"), (4, "the and that with this"), (4, "the and that with this"), (None, "x"), (5, "und der die nicht " * 30_000)]
    got = language.predict_languages(documents(spark, odd, clash=True), model).collect()
    found = {}
    for r in got:
        found.setdefault(r.doc_id, []).append((r.lang_pred, r.family))
    assert len(got) == len(odd) and found[1] == found[2] == found[3] == [("und", None)]
    assert found[4] == [("en", "germanic")] * 2 and found[5] == [("de", "germanic")]
    assert language.predict_languages(documents(spark, []), model).collect() == []


def test_portions_and_folds(spark, monkeypatch):
    whole = language.features("abc def " * 50)
    monkeypatch.setattr(language, "PORTION", 8)
    # Only the n-grams over the border of two portions are lost.
    assert whole @ language.features("abc def " * 50) > 0.95
    assert language.features("12 34") is None and language.features(None) is None
    held = [i for i in range(60) if zlib.crc32(str(i).encode()) % 4 == 2]
    rows = [(i, "aaa bbb" if i % 2 else "ccc ddd") for i in range(60)]
    docs = documents(spark, rows).selectExpr("doc_id", "text", f"IF(doc_id IN ({','.join(map(str, held))}), 'zz', IF(doc_id % 2 = 1, 'xa', 'xb')) AS lang")
    model = language.fit(docs, families={"xa": "f", "xb": "f"})
    assert model.families == {"f": ["xa", "xb"]}
    assert {r.lang_pred for r in language.predict_languages(docs.where("doc_id % 2 = 1"), model).collect()} == {"xa"}


def test_no_labels_and_one_language(spark):
    docs = documents(spark, [(i, f"text {i} words") for i in range(12)])
    unlabelled = docs.selectExpr("doc_id", "text", "CAST(NULL AS STRING) AS lang")
    assert {(r.lang_pred, r.score) for r in language.predict_languages(docs, language.fit(unlabelled)).collect()} == {("und", 0.0)}
    assert {(r.lang_pred, r.score) for r in language.predict_languages(docs, language.fit(docs)).collect()} == {("en", 1.0)}


def test_copies_and_null_texts_take_no_share_of_the_training(spark):
    rows = [(i, f"text {i % 6} words" if i % 3 else None) for i in range(2_000)]
    docs = documents(spark, rows)
    wanted = {r.text for r in docs.where("text is not null").select("text").distinct().collect()}
    assert {r.text for r in language._training(docs, "doc_id", "text", "lang", 10).collect()} == wanted
