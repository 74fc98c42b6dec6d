import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from pathloom.llm.queries import op13_token_counts
from pathloom.llm.token_counts import Merges, count_tokens

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
TEXTS = ["", " ", "\n\t", "a", "don't we'll I'M", "<|endoftext|>", "a<|endoftext|>b <|StartOfText|><|startoftext|><|startoftext|", "x<|endoftext|>́y", "é é é ＡＢ ①",
         "ΑΣ σς İI ı", "a b c\x85d\x1ce", "\x00\x00a", "漢字かな 한국 🎈🎈‍", "=" * 3000, "aa" * 2000, "1234567890" * 30, "﻿x \U0010ffff", "word " * 5000]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


@pytest.fixture(scope="module")
def own():
    return Merges(VOCABULARY)


def size(library, text):
    return len(library.encode(text, add_special_tokens=False).ids)


def test_odd_texts_as_the_library(library, own):
    for text in TEXTS:
        assert own.count(text.encode()) == size(library, text), text[:60]


def test_random_texts_as_the_library(library, own):
    rng = random.Random(9)
    alphabets = ["ab'st're'll ", "theing ", "0123 a9", "aàéß漢字🎈 ́ e x", "=-_*# \t\x00\x1c\x85", "ΑΣσςİIıi ", "aB" * 3 + " "]
    for n in range(4000):
        text = "".join(rng.choice(alphabets[n % len(alphabets)]) if rng.random() < 0.95 else "<|endoftext|>" for _ in range(rng.randrange(60)))
        assert own.count(text.encode()) == size(library, text), text


def plain_merged(own, word):
    """Again and again the leftmost of the lowest-ranked pairs."""
    symbols = [own.inner[b] for b in word[:-1]] + [own.last[word[-1]]]
    while True:
        ranked = [(own.ranks[a << own.shift | b], i) for i, (a, b) in enumerate(zip(symbols, symbols[1:])) if a << own.shift | b in own.ranks]
        if not ranked:
            return len(symbols)
        rank, i = min(ranked)
        symbols[i:i + 2] = [own.joined[rank]]


def test_heap_equals_plain_merging(own):
    rng = random.Random(4)
    for _ in range(3000):
        word = "".join(rng.choice("thereingsaoé") for _ in range(rng.randrange(1, 40))).encode()
        assert own.merged(word) == plain_merged(own, word), word


def test_query_as_the_library(spark, small, library):
    found = {r.doc_id: tuple(r) for r in op13_token_counts(spark, small).collect()}
    docs = spark.read.parquet(f"{small}/documents.parquet").collect()
    want = {d.doc_id: (d.doc_id, len((d.text or "").encode()), n := size(library, d.text or ""), n > 2048) for d in docs}
    assert found == want and any(r[3] for r in want.values())


def test_nulls_repeats_and_extra_columns(spark, library):
    rows = [(None, "a b", 1, 1), (1, None, 2, 2), (1, "x", 3, 3), (1, "x", 3, 3), (2, "", 4, 4), (3, "word <|endoftext|> " * 40000, 5, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int, n_bytes int")
    found = sorted(((r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit) for r in count_tokens(docs, VOCABULARY, limit=1).collect()))
    assert found == sorted((d or 0, len((t or "").encode()), n := size(library, t or ""), n > 1) for d, t, *_ in rows)
    assert count_tokens(docs.limit(0), VOCABULARY).collect() == []
