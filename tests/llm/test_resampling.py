import hashlib
import math
import re
import zlib
from collections import Counter

from pathloom.llm import resampling
from pathloom.llm.queries import op11_resampling
from pathloom.llm.resampling import Features, resample

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def features_of(text):
    words = words_of(text)
    return words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def bucket(feature, buckets=10_000):
    return zlib.crc32(feature.encode()) % buckets


def plain(docs, target, share=25, least=20, seed=7):
    """``{place: (doc_id, n_features, weight, score, rank)}`` from the definition."""
    s = Counter(bucket(f) for _, t in docs for f in features_of(t))
    t = Counter(bucket(f) for x in target for f in features_of(x))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log(float((t[b] + 1) * (all_s + 10_000)) / float((s[b] + 1) * (all_t + 10_000))))
    rows, order = [], []
    for at, (doc_id, text) in enumerate(docs):
        found = features_of(text)
        weight = sum(gain(bucket(f)) for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(found), weight, score, None])
        if len(words_of(text)) >= least:
            order.append((-score, doc_id is None, doc_id or 0, at))
    for rank, (*_, at) in enumerate(sorted(order)[:share * len(order) // 100]):
        rows[at][4] = rank + 1
    return sorted(map(tuple, rows), key=repr)


def test_query_against_the_definition(spark, small):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    found = sorted(map(tuple, op11_resampling(spark, small).select("doc_id", "n_features", "weight", "score", "rank").collect()), key=repr)
    assert found == plain(docs, target) and sum(r[4] is not None for r in found) > 20


def test_blocks_of_a_text_give_the_features_of_the_whole(monkeypatch):
    texts = ["one two  three-four 5é FIVE", "", " ", "x" * 50, "a b", "ÀB Çd\x00e", "word " * 30]
    for size in (1, 4, 9, 1 << 20):
        monkeypatch.setattr(resampling, "BLOCK_CHARS", size)
        for text in texts:
            count, buckets = Features()(text.encode())
            assert count == len(words_of(text)) and Counter(buckets.tolist()) == Counter(map(bucket, features_of(text))), (size, text)


def test_longer_windows():
    count, buckets = Features(longest=3, buckets=1000)(b"a b c d")
    want = ["a", "b", "c", "d", "a b", "b c", "c d", "a b c", "b c d"]
    assert count == 4 and Counter(buckets.tolist()) == Counter(bucket(f, 1000) for f in want)


def test_nulls_ties_repeats_and_extra_columns(spark):
    long = "alpha beta gamma delta " * 6
    rows = [(None, long, 1), (None, long + "x", 1), (1, None, 2), (2, "", 3), (3, "  ...  ", 4), (4, long, 5), (4, long, 5), (5, "zeta " * 100_000, 6)] + [(i, f"{long} {i % 3}", i) for i in range(10, 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, weight int")
    target = spark.createDataFrame([("alpha beta", 1), (None, 2), ("", 3)], "text string, n_words int")
    found = sorted(map(tuple, resample(docs, target).collect()), key=repr)
    assert found == plain([r[:2] for r in rows], ["alpha beta", None, ""])
    assert resample(docs.limit(0), target).collect() == []
    assert sorted(map(tuple, resample(docs, target.limit(0)).collect()), key=repr) == plain([r[:2] for r in rows], [])
    extra = resample(docs.withColumn("score", docs.weight).withColumn("n_words", docs.weight), target)
    assert extra.count() == len(rows)
