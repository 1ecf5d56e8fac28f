import hashlib
import random

import numpy as np
import pytest
from llm_helpers import documents, removed_spans

from tidemark.llm import suffix_dedup as sd


def texts(seed, length):
    rng = random.Random(seed)
    letters = "abcdé \n"
    fresh = lambda n: "".join(rng.choice(letters) for _ in range(n))
    shared = [fresh(length + rng.randrange(-40, 400)) for _ in range(4)]
    out = []
    for i in range(25):
        parts = [fresh(rng.randrange(0, 300))]
        for _ in range(rng.randrange(3)):
            piece = rng.choice(shared)
            cut = rng.randrange(0, 120)
            parts += [piece[cut:] if rng.random() < 0.5 else piece[:len(piece) - cut], fresh(rng.randrange(0, 50))]
        out.append("".join(parts))
    # A copy with one changed letter, a text that repeats itself, runs of one letter, and exact copies.
    long_ = fresh(1_500)
    out += [long_, long_[:700] + "X" + long_[701:], shared[0] + shared[0], "a" * (length - 1), "a" * length, "a" * (length + 60), "b" * length + "c" + "b" * length]
    out += [out[0], out[0], "", None, "short", shared[1][:length], shared[1][:length - 1]]
    return out


def check(spark, rows, length):
    found = sd.drop_repeated_spans(documents(spark, rows, clash=True), length).collect()
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), hashlib.sha256(bytes(r.kept)).hexdigest()) for r in found), key=str)
    want = [(i, *rest) for (i, _), rest in zip(rows, removed_spans([t for _, t in rows], length))]
    assert got == sorted(want, key=str)
    for r in found:
        assert sum(s.end - s.start for s in r.spans) == r.n_removed == r.n_bytes - len(r.kept)


@pytest.mark.parametrize("seed", [1, 2])
def test_as_all_windows_side_by_side(spark, seed):
    rows = list(enumerate(texts(seed, 400)))
    check(spark, rows + [(None, "q" * 500), (3, "z" * 450 + "y"), (3, "z" * 450 + "y")], 400)


def test_another_length(spark):
    check(spark, list(enumerate(texts(3, 350))), 350)


def test_empty_table_and_short_lengths(spark):
    assert sd.drop_repeated_spans(documents(spark, [])).collect() == []
    with pytest.raises(ValueError):
        sd.drop_repeated_spans(documents(spark, []), 300)


def test_portions_of_a_long_text_give_the_same_runs(monkeypatch):
    rng = random.Random(4)
    data = "".join(rng.choice("ab") for _ in range(5_000)).encode()
    powers = sd.Powers()

    def runs():
        place, low, high, gram = sd.anchors_of(data, 400, powers)
        seen = {}
        for p, a, b, g in zip(place, low, high, gram):
            old = seen.get(p, (a, b, g))
            seen[p] = (min(a, old[0]), max(b, old[1]), g)
        inner, outer = sd.cells_of(data, 400, np.array(list(seen)), np.zeros(len(seen), np.int64), 343, powers)
        return seen, inner.tolist(), outer.tolist()

    whole = runs()
    assert sum(b - a + 1 for a, b, _ in whole[0].values()) == len(data) - 399  # each window has one anchor
    monkeypatch.setattr(sd, "PORTION", 700)
    assert runs() == whole


def test_equal_strings_have_equal_hashes_anywhere():
    powers = sd.Powers()
    a, b = sd.Strings(b"xxabcabc", powers), sd.Strings(b"abc", powers)
    at = np.array([2, 5])
    assert set(a.hashes(at, at + 3).tolist()) == set(b.hashes(np.array([0]), np.array([3])).tolist())


def test_field_arithmetic_is_exact():
    rng = random.Random(7)
    a, b = ([rng.randrange(sd.PRIME) for _ in range(500)] + [0, 1, sd.PRIME - 1, sd.PRIME - 1] for _ in range(2))
    got = sd.times(np.array(a, np.uint64), np.array(b, np.uint64)).tolist()
    assert got == [x * y % sd.PRIME for x, y in zip(a, b)]
    powers = sd.Powers(12345678901234567)
    data = bytes(rng.randrange(256) for _ in range(300))
    start, end = np.array([0, 3, 250, 299]), np.array([300, 10, 300, 300])
    want = [sum((data[i] + 1) * pow(powers.multiplier, i - s, sd.PRIME) for i in range(s, e)) % sd.PRIME + 1 for s, e in zip(start.tolist(), end.tolist())]
    assert sd.RankedStrings(data, powers).hashes(start, end).tolist() == want


def built_to_collide(factors):
    """Two unlike ASCII strings with equal polynomials modulo 2^64 in any odd multiplier.

    The product of x^(2^k) - 1 for k below `factors` has coefficients -1, 0 and 1 and vanishes there.
    """
    coefficients = [1]
    for k in range(factors):
        longer = [0] * (len(coefficients) + 2**k)
        for i, c in enumerate(coefficients):
            longer[i] -= c
            longer[i + 2**k] += c
        coefficients = longer
    return bytes(109 + c for c in coefficients), b"m" * len(coefficients)


def test_texts_built_to_collide_keep_their_bytes(spark):
    x, y = built_to_collide(11)
    assert x != y and max(map(abs, (109 - b for b in x))) <= 4
    old = [((np.frombuffer(t, np.uint8).astype(np.uint64) + np.uint64(1)) * sd.Powers().upto(len(t))[0]).sum(dtype=np.uint64) for t in (x, y)]
    assert old[0] == old[1]
    rng = random.Random(3)
    fresh = lambda n: "".join(rng.choice("bcdf") for _ in range(n))
    rows = []
    for pair in range(10):
        left, right = fresh(200), fresh(200)
        for piece in (x.decode(), y.decode()):
            rows.append((len(rows), left + piece + right))
    check(spark, rows, 400)


def test_strings_that_only_hash_alike_are_not_removed(spark, monkeypatch):
    """Without the drawn multiplier's hash the digests alone keep unlike strings apart."""
    monkeypatch.setattr(sd, "drawn_multiplier", lambda: 1)  # any two strings with equal letters collide
    rng = random.Random(5)
    left, right = "".join(rng.choice("bc") for _ in range(500)), "".join(rng.choice("bc") for _ in range(500))
    middle = ["".join(rng.sample("abcdefghij", 10)) for _ in range(6)]
    rows = [(i, "u" * 100 + m + "v" * 300 + left[:40]) for i, m in enumerate(middle)] + [(9, left + right), (10, right + left)]
    found = sd.drop_repeated_spans(documents(spark, rows), 400).collect()
    want = {i: r for (i, _), r in zip(rows, removed_spans([t for _, t in rows], 400))}
    for r in found:
        assert r.n_removed <= want[r.doc_id][1]
