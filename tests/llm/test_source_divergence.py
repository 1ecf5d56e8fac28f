import random
import re
from collections import Counter

from tidemark.llm import source_divergence as sd

SCHEMA = "doc_id bigint, text string, lang string, source string, gid string, `count` string"


def terms(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower)


def plain(rows, minimum=3, ranks=200):
    """All pairs of sources over all kept terms, by the formulas."""
    out = []
    rows = [(t or "", la or "", s or "") for t, la, s in rows]
    for lang in {la for _, la, _ in rows}:
        docs = [(Counter(terms(t)), s) for t, la, s in rows if la == lang]
        df = Counter(t for c, _ in docs for t in c)
        kept = sorted(t for t, n in df.items() if n >= minimum)
        sums = {s: Counter() for _, s in docs}
        for c, s in docs:
            sums[s].update({t: n for t, n in c.items() if df[t] >= minimum})
        masses = {}
        for s, c in [*sums.items(), (None, sum(sums.values(), Counter()))]:
            total = sum(c.values()) + len(kept)
            masses[s] = {t: 1 + 10**9 * (c[t] + 1) // total for t in kept}
        for s in sums:
            p = masses[s]
            pairs = [(-sum((p[t] - q[t]) ** 2 // q[t] for t in kept), o) for o, q in masses.items() if o not in (s, None)]
            mine = [(-((p[t] - masses[None][t]) ** 2 // masses[None][t]), t) for t in kept if sums[s][t] and p[t] > masses[None][t]]
            for part, found in (("pair", pairs), ("term", mine)):
                listed = sorted(found, key=lambda x: (x[0], x[1].encode()))
                out += [(lang, s, part, item, -v, r) for r, (v, item) in enumerate(listed, 1) if part == "pair" or r <= ranks]
    return sorted(out)


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(80)] + ["été", "É", "日本", "ﬀ", "😀"]
    rows = []
    for lang in ("en", "fr", "", None):
        for source in ("a", "b", "c", "", None, "é"):
            for _ in range(rng.randrange(1, 6)):
                weights = [1 + (hash((source, i)) % 5 == 0) * 4 for i in range(len(vocabulary))]
                rows.append((" ".join(rng.choices(vocabulary, weights, k=rng.choice([1, 8, 60]))) + " X1y", lang, source))
    rows += [(None, "en", "empty"), ("", "fr", "empty"), ("1 2 3", "de", "digits"), ("one two", "it", "alone"), (None, "de", "z")]
    rows += [rows[0]] * 3 + [("common " * 20_000, "en", "a")] * 3
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, *r, "x", "x") for i, r in enumerate(rows)], SCHEMA)


def found(spark, rows, **options):
    return sorted(map(tuple, sd.source_divergence(frame(spark, rows), **options).collect()))


def test_as_all_pairs_over_all_terms(spark, monkeypatch):
    rows = corpus(1)
    assert found(spark, rows) == plain(rows)
    # Small portions everywhere and one language at a time; few ranks with ties at the last.
    for name, value in (("ENTRIES", 40), ("PAIRS", 30), ("LISTED", 3), ("LANGUAGES", 1)):
        monkeypatch.setattr(sd, name, value)
    assert found(spark, rows, term_ranks=4) == plain(rows, ranks=4)


def test_empty_table_and_a_language_without_terms(spark):
    assert found(spark, []) == []
    assert found(spark, [(None, None, None)]) == []
    rows = [("a b", "x", "s"), ("c", "x", "t"), ("d", "x", None)]
    assert found(spark, rows) == plain(rows) and all(r[4] == 0 for r in found(spark, rows))
