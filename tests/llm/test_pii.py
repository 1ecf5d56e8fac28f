import hashlib
import math
import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from llm_helpers import documents

from tidemark.llm import pii

FORMS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain(text):
    out = []
    for kind, form in FORMS.items():
        for m in re.finditer(form, text):
            digits = re.sub("[^0-9]", "", m[0])
            doubled = [int(c) * (1 + i % 2) for i, c in enumerate(digits[::-1])]
            if kind == "ip":
                good = all(int(p) <= 255 for p in m[0].split("."))
            elif kind == "card":
                good = 12 <= len(digits) <= 19 and sum(n - 9 * (n > 9) for n in doubled) % 10 == 0
            else:
                good = kind == "email" or 9 <= len(digits) <= 15
            if good:
                out.append((kind, *m.span()))
    return sorted(out, key=lambda s: (s[1], list(FORMS).index(s[0])))


@settings(max_examples=1_500, deadline=None)
@given(st.text(alphabet="ab1239.@-+ ()%_é\n", max_size=60))
def test_any_text_as_the_plain_forms(text):
    assert pii.base_spans(text) == plain(text)


def test_chosen_texts():
    for text in (
        "a@b.c_d@e.f @x.y a@b a@b..c é.x@y.zz", "1.2.3.4.5.6.7.8 300.1.1.1 1.2.3.0255 0001.2.3.4", "4111 1111-1111 1111 and 4111111111111112",
        "+1 (377) 555-0271 +12 +49 30 1234567890123456", "4111111111111111 x@y.zz +4111111111111", "0" * 50_000 + "a@" * 10_000, "", "+" * 9_000,
    ):
        assert pii.base_spans(text) == plain(text)


def test_documents_with_terms_that_give_an_entity_away(spark):
    rows = [(i, f"please call mister Zorblat about this at z@mail.example or 10.0.0.{i} the") for i in range(6)]
    rows += [(100 + i, f"please call the {w} about this, mister") for i, w in enumerate(["shop", "bank", "school", "office"] * 10)]
    rows += [(200, None), (201, ""), (202, "x" * 100_000 + " 1.2.3.4"), (203, "9.9.9.9 " * 3_000), (None, "a@b.cc"), (204, "a@b.cc"), (204, "a@b.cc")]
    found = pii.personal_spans(documents(spark, rows, clash=True), with_text=True).collect()
    assert sorted(((r.doc_id, r.text) for r in found), key=str) == sorted(rows, key=str)
    for r in found:
        text = r.text or ""
        spans = [(pii.KINDS[s.kind], s.start, s.end) for s in r.spans]
        assert [s for s in spans if s[0] in FORMS] == plain(text)
        terms = {text[a:b] for k, a, b in spans if k not in FORMS}
        if r.doc_id is not None and r.doc_id < 6:
            assert "Zorblat" in terms and not terms & {"please", "call", "mister", "about", "this", "the"}
        elif r.doc_id is not None and 100 <= r.doc_id < 200:
            assert not terms
    clean = {r.doc_id: r.clean_text for r in pii.sanitise(documents(spark, rows[:46])).collect()}
    assert "Zorblat" not in clean[0] and "[email]" in clean[0] and "mister" in clean[0] and "z@mail" not in clean[0]
    assert clean[100] == rows[6][1]


def test_shares_and_shapes(spark):
    """A term met only with its entity conveys all of it; a shape that is common is harmless."""
    rows = [(i, "meet q@q.example Alpha") for i in range(4)] + [(50 + i, f"Name{'xyz'[i % 3]} Betas Gamma other") for i in range(60)]
    kinds = {}
    for r in pii.personal_spans(documents(spark, rows), with_text=True).collect():
        for s in r.spans:
            kinds.setdefault(r.text[s.start:s.end], set()).add(pii.KINDS[s.kind])
    assert kinds["Alpha"] == {"general"}  # any capitalised word of its length
    assert kinds["meet"] == {"removed"}  # no other short word without a capital
    assert pii.shape_of("Alpha") == "name2" and pii.shape_of("12") == "number1" and pii.shape_of("a1") == "code1"


def test_many_terms_are_joined_and_count_the_same(spark, monkeypatch):
    rows = [(i, "call Zorblat at z@mail.example now") for i in range(5)] + [(9 + i, "call now") for i in range(9)]
    few = sorted(str(r) for r in pii.personal_spans(documents(spark, rows)).collect())
    monkeypatch.setattr(pii, "TERM_SET", 0)
    assert sorted(str(r) for r in pii.personal_spans(documents(spark, rows)).collect()) == few


def test_terms_anywhere_in_the_entity_s_documents(spark):
    """Far from the value in every document, close to it in few, and mentioned more than once."""
    fill = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(i, f"z@mail.example {fill} Zorblat {fill} {'Quexit ' * (i < 3)}z@mail.example {fill} Quexit") for i in range(8)]
    rows += [(50 + i, f"{fill} Namely Betas Gammas") for i in range(60)]
    clean = {r.doc_id: r.clean_text for r in pii.sanitise(documents(spark, rows)).collect()}
    for i, text in rows:
        assert clean[i] == text.replace("z@mail.example", "[email]").replace("Zorblat", "[name2]").replace("Quexit", "[name2]")


def test_pairs_as_counted_document_by_document(spark):
    """All shares by plain counts over whole documents, some terms with several entities."""
    rng = random.Random(3)
    vocabulary = [f"{a}{b}" for a in ("kor", "Mal", "zif", "Tun", "x9") for b in ("a", "enta", "osity")]
    rows = []
    for i in range(120):
        who = rng.sample(range(12), rng.choice([0, 0, 1, 1, 2]))
        own = [vocabulary[(3 * w + j) % 15] for w in who for j in range(2)] + [f"only{w}" for w in who]
        said = own + rng.choices(vocabulary[10:], k=6) + [f"p{w}@q.example" for w in who] + ["common"] * 20
        rng.shuffle(said)
        rows.append((i, " ".join(said)))
    n_doc, held, words = len(rows), {}, {}
    for i, text in rows:
        held[i] = {pii.entity_of(k, text[a:b]) for k, a, b in pii.base_spans(text)}
        words[i] = {m[0] for m in pii.TERM.finditer(text)}
    lower, looks = ({i: {f(w) for w in words[i]} for i in words} for f in (str.lower, pii.shape_of))

    def share(entity, word, of):
        with_entity = [i for i in held if entity in held[i]]
        both, n_word = sum(word in of[i] for i in with_entity), sum(word in of[i] for i in of)
        return both, math.log(both * n_doc / (len(with_entity) * n_word)) / math.log(n_doc / len(with_entity)) if both else 0

    for r in pii.personal_spans(documents(spark, rows), with_text=True).collect():
        base, want = pii.base_spans(r.text), []
        for m in pii.TERM.finditer(r.text):
            if all(m.end() <= a or m.start() >= b for _, a, b in base):
                strict = [
                    share(e, pii.shape_of(m[0]), looks)[1] >= pii.THRESHOLD for e in held[r.doc_id]
                    for both, s in [share(e, m[0].lower(), lower)] if both >= pii.LEAST_JOINT and s >= pii.THRESHOLD
                ]
                want += [("removed" if any(strict) else "general", *m.span())] if strict else []
        assert [(pii.KINDS[s.kind], s.start, s.end) for s in r.spans if s.kind >= 4] == want


def test_empty_table(spark):
    assert pii.personal_spans(documents(spark, [])).collect() == []


def test_the_query_spells_spans(spark):
    row = pii.op2_personal_data(spark, "/root/testdata/sf0.001").where("n_email > 0").first()
    base = [s for s in row.spans.split(",") if s.split(":")[0] in FORMS]
    assert hashlib.sha256(",".join(base).encode()).hexdigest() == row.base_sha256


def test_the_query_counts_each_kind(spark, tmp_path):
    rows = [(0, "a@b.cc and c@d.ee, 1.2.3.4"), (1, "1.2.3.4 5.6.7.8 9.9.9.9 x@y.zz"), (2, "+1 (377) 555-0271, 4111 1111-1111 1111"),
            (3, "4111111111111111 +1 (377) 555-0271 +1 (377) 555-0272"), (4, None), (5, "none"), (None, "1.2.3.4 a@b.cc c@d.ee")]
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    found = {r.doc_id: r for r in pii.op2_personal_data(spark, str(tmp_path)).collect()}
    for doc_id, text in rows:
        base = plain(text or "")
        r = found[doc_id]
        assert [r[f"n_{kind}"] for kind in FORMS] == [sum(k == kind for k, _, _ in base) for kind in FORMS]
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base).encode()).hexdigest()
