import hashlib
import random
import zlib
from fractions import Fraction

import pytest

from pathloom.llm.periodic_runs import collapse, find_runs, periodic_runs, segments
from pathloom.llm.queries import op12_periodic_runs


def plain_runs(words):
    """All runs by comparing every word with that at every lag; of one stretch, the smallest period."""
    found = {}
    for q in range(1, len(words) // 4 + 1):
        start = None
        for i in range(len(words) - q + 1):
            if i + q < len(words) and words[i] == words[i + q]:
                start = i if start is None else start
            elif start is not None:
                length = i + q - start
                if length >= max(6, 4 * q):
                    found.setdefault((start, length), q)
                start = None
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def planted(doc_id, text):
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def plain_row(doc_id, words):
    runs = plain_runs(words)
    drop = {i for s, n, q in runs for i in range(s + q, s + n)}
    top = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2])) if runs else (None,) * 3
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    kept = b" ".join(w for i, w in enumerate(words) if i not in drop)
    return (doc_id, len(runs), *top, 1000 * top[1] // top[2] if runs else None, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_random_words_against_every_lag():
    rng, hits = random.Random(2), 0
    for _ in range(4000):
        few, words = rng.choice([1, 2, 2, 3, 4, 8]), []
        while len(words) < rng.randrange(90):
            unit = [rng.randrange(few + 2) for _ in range(rng.randrange(1, 7))]
            words += (unit * 9)[:rng.randrange(1, 9 * len(unit))] if rng.random() < 0.5 else [rng.randrange(few) for _ in range(3)]
        words = [b"%d" % w for w in words]
        want = plain_runs(words)
        hits += len(want)
        assert find_runs(words) == want, words
    assert hits > 1000


def test_long_periods_and_nested_runs():
    rng = random.Random(3)
    unit = [b"a"] * 9 + [b"x", b"y"] * 5 + [b"%d" % rng.randrange(400) for _ in range(180)]
    words = [b"s%d" % i for i in range(50)] + unit * 6 + unit[:77] + [b"t"] * 8
    found = find_runs(words)
    assert (50, 6 * len(unit) + 77, len(unit)) in found and found == plain_runs(words)


def test_splitting_keeps_every_run_and_drops_ordinary_text():
    rng = random.Random(4)
    text = [b"%d" % min(rng.randrange(1, 3000) for _ in range(3)) for _ in range(3000)]
    words = text + [b"p", b"q", b"r"] * 5 + text
    numbers = {w: i for i, w in enumerate(dict.fromkeys(words))}
    import numpy as np
    left = segments(np.array([numbers[w] for w in words]))
    assert any(a <= 3000 and b >= 3015 for a, b in left) and sum(b - a for a, b in left) < 500


@pytest.mark.parametrize("words", [[b"a"] * 100_000, [b"%d" % (i // 4) for i in range(100_000)], [b"%d" % (i % 5000) for i in range(100_000)]])
def test_very_long_texts_end(words):
    found = find_runs(words)
    assert all(r[1] >= max(6, 4 * r[2]) for r in found) and len(found) == (0 if words[:2] == [b"0", b"0"] else 1)


def test_query_against_brute_force(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").collect()
    short = [d for d in docs if len((d.text or "").split()) < 3000]
    found = {r.doc_id: tuple(r) for r in op12_periodic_runs(spark, small).collect()}
    assert found.keys() == {d.doc_id for d in docs}
    want = {d.doc_id: plain_row(d.doc_id, planted(d.doc_id, d.text)) for d in short}
    assert {d: found[d] for d in want} == want and sum(w[1] > 0 for w in want.values()) > 3


def test_nulls_repeats_and_extra_columns(spark):
    rows = [(None, "a a a a a a b", 1, 1), (1, None, 2, 2), (2, "", 3, 3), (2, " \n ", 3, 3), (2, " \n ", 3, 3), (3, "x y x y x y x y x", 4, 4), (4, "é é " * 7, 5, 5),
            (5, "w " * 200_000 + "end", 6, 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs int, collapsed int")
    found = sorted((r.doc_id or 0, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periodic_runs(docs).collect())
    assert found == [(0, 7, [(0, 6, 1)], "a b"), (1, 0, [], ""), (2, 0, [], ""), (2, 0, [], ""), (2, 0, [], ""), (3, 9, [(0, 9, 2)], "x y"), (4, 7, [(0, 7, 1)], "é é"),
                     (5, 200_001, [(0, 200_000, 1)], "w end")]
    assert collapse([], []) == b"" and periodic_runs(docs.limit(0)).collect() == []
    with pytest.raises(ValueError):
        periodic_runs(docs, exponent=2)
