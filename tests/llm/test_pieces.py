import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from pathloom.llm.pieces import Pieces, encode_decode
from pathloom.llm.queries import op3_pieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = ["", " ", "  ", "a", " a", "a ", "a  b   c ", "\n", "\t\n x", "a\x00b", "▁", "a▁▁b ▁", "é", "ａ①", "한국 漢字 🎈🎈", "​﻿", "<s></s><unk><0x0A>",
         "aaaaaaaaaaaaaaaaaaaaaaa", "=" * 301, " " * 77 + "x", "x" * 5000, "abab" * 900, "hello" * 50, "the" * 333 + " " + "1234567890" * 40, "é   ", "\U0010ffff"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def own():
    return Pieces(MODEL)


def test_odd_texts_as_the_library(library, own):
    for text in TEXTS:
        ids = library.encode(text)
        assert own.encode(text).tolist() == ids, text
        assert own.decode(own.encode(text)) == library.decode(ids), text


def test_random_texts_as_the_library(library, own):
    rng = random.Random(5)
    alphabets = ["ab ", "theing ", "abcdefghij  \n", "0123456789. ", "aàéß漢字🎈 ▁", "=-_*# \t", "AaBbTtHhEe' "]
    for n in range(4000):
        text = "".join(rng.choice(alphabets[n % len(alphabets)]) for _ in range(rng.randrange(1, 60)))
        assert own.encode(text).tolist() == library.encode(text), text


def test_backtracking_equals_plain_merging(own):
    rng = random.Random(6)
    for _ in range(1500):
        text = "".join(rng.choice("▁thereingsao") for _ in range(rng.randrange(1, 40)))
        assert own.split(text) == own.merge(text), text


def test_query_as_the_library(spark, small, library):
    rows = {r.doc_id: r for r in op3_pieces(spark, small).collect()}
    docs = spark.read.parquet(f"{small}/documents.parquet").collect()
    assert len(rows) == len(docs)
    for d in docs:
        ids = library.encode(d.text or "")
        assert rows[d.doc_id] == (d.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                                  hashlib.sha256(library.decode(ids).encode()).hexdigest())


def test_nulls_repeats_and_extra_columns(spark, library):
    rows = [(None, "a b", 1), (1, None, 2), (1, "x", 3), (1, "x", 3), (2, "word " * 40000, 4)]
    found = encode_decode(spark.createDataFrame(rows, "doc_id long, text string, ids int"), MODEL).orderBy(F.col("doc_id").asc_nulls_first(), F.length("decoded")).collect()
    assert [(r.doc_id, r.ids, r.decoded) for r in found] == [(d, library.encode(t or ""), t or "") for d, t, _ in rows]
    assert encode_decode(spark.createDataFrame([], "doc_id long, text string"), MODEL).collect() == []
