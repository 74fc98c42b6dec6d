import random

import pytest
import xxhash
from pyspark.sql import functions as F

from pathloom.llm.components import star_components
from pathloom.llm.queries import op1_simhash
from pathloom.llm.simhash import near_duplicates, near_links


def plain_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in lowered + " ":
        if c in " \t\n\x0b\x0c\r":
            words += [word] if word else []
            word = ""
        else:
            word += c
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_classes(fps):
    """Root per fingerprint, by comparing all pairs."""
    root = {f: f for f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for a in fps:
        for b in fps:
            if a < b and (a ^ b).bit_count() <= 4:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {f: find(f) for f in fps}


def plain(rows):
    fp = [plain_fingerprint(t) for _, t in rows]
    classes = plain_classes(sorted(set(fp)))
    least = {}
    for (d, _), f in zip(rows, fp):
        if d is not None:
            least[classes[f]] = min(least.get(classes[f], d), d)
    return sorted(((d, f"{f:016x}", least.get(classes[f])) for (d, _), f in zip(rows, fp)), key=repr)


def run(spark, rows):
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, fp string, component_id int")
    return sorted(map(tuple, near_duplicates(docs).collect()), key=repr)


def test_query_against_all_pairs(spark, small):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    assert sorted(map(tuple, op1_simhash(spark, small).collect()), key=repr) == plain(rows)


def test_nulls_ties_and_odd_texts(spark):
    long = " ".join(f"w{i}" for i in range(30000))
    rows = [(5, None), (3, ""), (9, " \t\n"), (None, "a b"), (7, "A B"), (7, "A B"), (None, "alone in here"), (8, "é ſ \x85 x"), (2, long), (1, long + " tail"),
            (11, "one two three four"), (12, "one two three"), (13, "ONE\x0btwo three\x0cfour")]
    assert run(spark, rows) == plain(rows)


def test_empty_table(spark):
    assert run(spark, []) == []


@pytest.mark.parametrize("slices", [1, 8])
def test_links_connect_exactly_the_near(spark, slices):
    rng = random.Random(slices)
    fps = {rng.getrandbits(64) for _ in range(60)}
    for f in sorted(fps)[:30]:
        for n in (1, 2, 3, 4, 4, 5, 6):
            g = f
            for b in rng.sample(range(64), n):
                g ^= 1 << b
            fps.add(g)
    table = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    links = [(r.a % 2**64, r.b % 2**64) for r in near_links(table, slices=slices).collect()]
    assert all((a ^ b).bit_count() <= 4 for a, b in links)
    root = {f: f for f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    assert {f: find(f) for f in fps} == plain_classes(sorted(fps))


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 50)] + [(200, 150), (7, 7), (1, 0)]
    found = {r.node: r.root for r in star_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(1, 41)}, **{100 + i: 100 for i in range(1, 50)}, 200: 150}


def test_fingerprint_equals_the_sql_hash(spark):
    text = "naïve words in ünicode"
    from pathloom.llm.simhash import fingerprint
    assert spark.range(1).select(F.xxhash64(F.lit(text))).first()[0] % 2**64 == fingerprint(text.encode())
