"""Small tables and plain versions that the tests of this folder share."""

import hashlib
import re
from collections import defaultdict

import numpy as np

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Columns whose names the operators use themselves.
CLASHES = ["id", "node", "kept", "digest", "_row", "component", "size", "spans", "key", "place", "label", "Text2", "a b`c.d"]


def documents(spark, rows, clash=False):
    """`rows` of (doc_id, text) or (doc_id, text, source), with columns that clash if asked for."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
    schema = SCHEMA
    if clash:
        full = [(*r, *["x"] * len(CLASHES)) for r in full]
        schema += "".join(", `" + c.replace("`", "``") + "` string" for c in CLASHES)
    return spark.createDataFrame(full, schema)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def near_components(rows, width, percent):
    """[(id, set size, component)] by comparing all pairs; texts without words stand alone."""
    sets = []
    for _, text in rows:
        w = words(text)
        sets.append({tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))} if w else set())
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                parent[root(i)] = root(j)
    least = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        least[root(i)].append(doc_id)
    return [(doc_id, len(sets[i]), min((x for x in least[root(i)] if x is not None), default=None)) for i, (doc_id, _) in enumerate(rows)]


def removed_spans(texts, length):
    """For each text (n_bytes, n_removed, n_spans, digest of the rest): all windows side by side."""
    data = [(t or "").encode() for t in texts]
    seen = defaultdict(int)
    for d in data:
        for i in range(len(d) - length + 1):
            seen[d[i:i + length]] += 1
    out = []
    for d in data:
        cover = np.zeros(len(d), bool)
        for i in range(len(d) - length + 1):
            if seen[d[i:i + length]] > 1:
                cover[i:i + length] = True
        edges = np.diff(np.r_[0, cover.astype(int), 0])
        rest = np.frombuffer(d, np.uint8)[~cover].tobytes()
        out.append((len(d), int(cover.sum()), int((edges == 1).sum()), hashlib.sha256(rest).hexdigest()))
    return out


def key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)
