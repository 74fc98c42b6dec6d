import hashlib
import random

import numpy as np
import pytest

from pathloom.llm import suffix_dedup as S
from pathloom.llm.queries import ORACLES, op8_suffix_dedup
from tools.check_queries import table


def plain(docs, length=100):
    """Per document whether each byte goes, from all strings of the input in order."""
    seen, gone = set(), []
    for _, text in docs:
        flags = bytearray(len(text))
        for i in range(len(text) - length + 1):
            piece = text[i:i + length]
            if piece in seen:
                flags[i:i + length] = b"\1" * length
            seen.add(piece)
        gone.append(flags)
    return gone


def digests(docs, length=100):
    found = []
    for (doc_id, text), flags in zip(docs, plain(docs, length)):
        kept = bytes(c for c, f in zip(text, flags) if not f)
        spans = sum(1 for i, f in enumerate(flags) if f and (i == 0 or not flags[i - 1]))
        found.append((doc_id, len(text), len(text) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return found


def test_query_against_all_strings(spark, small):
    docs = sorted((r.doc_id, (r.text or "").encode()) for r in spark.read.parquet(f"{small}/documents.parquet").collect())
    assert sorted(map(tuple, op8_suffix_dedup(spark, small).collect())) == digests(docs)


def made(seed, count=60):
    rng = random.Random(seed)
    passages = ["".join(rng.choice("abc dé") for _ in range(rng.choice([60, 99, 100, 101, 130, 400, 900]))) for _ in range(8)]
    docs = []
    for i in range(count):
        parts = []
        for _ in range(rng.randrange(0, 5)):
            passage = rng.choice(passages)
            a = rng.randrange(0, 30)
            parts.append(passage[a:len(passage) - rng.randrange(0, 30)])
            parts.append("".join(rng.choice("xyz é") for _ in range(rng.choice([0, 1, 5, 200]))))
        docs.append((i, "".join(parts)))
    return docs + [(count, "ab" * 700), (count + 1, "b" + "ab" * 80), (count + 2, "z" * 100), (count + 3, "z" * 350), (count + 4, ""), (count + 5, "q" * 99)]


@pytest.mark.parametrize("flush", [40, 1 << 20])
def test_planted_passages(spark, monkeypatch, flush):
    # the same answers whether a task works off all runs at once or a few at a time
    monkeypatch.setattr(S, "FLUSH", flush)
    rows = made(flush)
    docs = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, d string").repartition(5)
    found = sorted((r.doc_id, r.n_bytes, r.n_bytes - len(r.kept), r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in S.remove_repeats(docs).collect())
    assert found == digests([(d, t.encode()) for d, t in rows])


def test_long_texts_in_segments(spark, monkeypatch):
    monkeypatch.setattr(S, "SEGMENT", 300)
    rng = random.Random(9)
    base = "".join(rng.choice("abcdefgh") for _ in range(2500))
    rows = [(1, base), (2, "xx" + base[100:1900] + "yy"), (3, base[:50] + base[600:2400]), (4, base)]
    found = [(r.doc_id, r.n_bytes, r.n_bytes - len(r.kept), r.n_spans, hashlib.sha256(r.kept).hexdigest())
             for r in S.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).orderBy("doc_id").collect()]
    assert found == digests([(d, t.encode()) for d, t in rows])


def segment_levels(monkeypatch, length):
    rng = np.random.default_rng(length)
    text = rng.integers(97, 99, 400).astype(np.uint8)
    sieve, size, whole, _ = S.levels(text, length)
    for names, n in ((sieve, size), (whole, length)):
        strings = [text[i:i + n].tobytes() for i in range(len(text) - n + 1)]
        assert len(names) >= len(strings)
        assert len(set(zip(names.tolist(), strings))) == len(set(strings)) == len(set(names[:len(strings)].tolist()))


@pytest.mark.parametrize("length", [16, 20, 31, 64, 100])
def test_identifiers_name_strings(monkeypatch, length):
    segment_levels(monkeypatch, length)


def test_nulls_repeated_rows_and_ties(spark):
    rng = random.Random(2)
    text = "".join(rng.choice("abcdef") for _ in range(180))
    tail = "".join(rng.choice("uvwéyz") for _ in range(60))
    rows = [(1, text, 180), (1, text, 180), (2, None, None), (None, text, 5), (3, text[:120] + tail, 1), (None, None, 7), (4, "ok", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    found = sorted(((r.doc_id, len(r.kept), r.n_spans) for r in S.remove_repeats(docs).collect()), key=repr)
    assert found == sorted([(1, 180, 0), (1, 180, 0), (2, 0, 0), (None, 0, 1), (3, len(tail.encode()), 1), (None, 0, 0), (4, 2, 0)], key=repr)
    cut = sorted(map(tuple, S.cut_repeats(docs).collect()), key=repr)
    assert cut == sorted([(1, text, 180), (1, text, 180), (2, None, None), (None, "", 0), (3, tail, 60), (None, None, 7), (4, "ok", 2)], key=repr)
    assert S.remove_repeats(docs.limit(0)).collect() == [] and S.cut_repeats(docs.limit(0)).collect() == []
    assert S.kept_bytes(b"0123456789", [5, 1, 3], [7, 3, 4]) == (b"04789", 2)


def test_query_agrees_with_sql(spark, con, small):
    found = op8_suffix_dedup(spark, small)
    want = con.execute(ORACLES["op8_suffix_dedup"])
    columns = [d[0] for d in want.description]
    assert sorted(columns) == sorted(found.columns)
    assert table(found.collect(), found.columns) == table(want.fetchall(), columns)
