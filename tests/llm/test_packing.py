import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from pathloom.llm.packing import SIZE, BytePairs, best_cuts, cut_places, pack
from pathloom.llm.queries import op9_packing

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


def ids_of(library, text):
    return [*library.encode(text or "", add_special_tokens=False).ids, 1]


def check(rows, docs, library, size=SIZE):
    """Every id in exactly one piece, sequences gapless; returns the share of padding."""
    texts = {}
    for d, t in docs:
        texts.setdefault(d, []).append(ids_of(library, t))
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert by_doc.keys() == texts.keys()
    for d, pieces in by_doc.items():
        if len(texts[d]) == 1:
            at = 0
            for r in sorted(pieces, key=lambda r: r.start):
                assert r.start == at and r.length > 0 and r.doc_tokens == len(texts[d][0])
                assert r.ids_crc32 == zlib.crc32(np.array(texts[d][0][at:at + r.length], "<u4").tobytes())
                at += r.length
            assert at == len(texts[d][0])
        else:
            assert sum(r.length for r in pieces) == sum(map(len, texts[d]))
    padding = total = 0
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= size
        padding += 0 if at & (at - 1) == 0 else size - at
        total += at
    return padding / max(1, total)


def test_ids_as_the_library(library):
    own, rng = BytePairs(VOCABULARY), random.Random(3)
    texts = ["", " ", "  ", "a  b", "a \nb", "a\n b", "a\n\n b c", "x ", "<|endoftext|> x<|endoftext|>", "<|endoftext|>", "a <|endoftext|><|endoftext|>  b  <|endoftext|>\n", "<|EndOfText|> <|endoftext|", "don't 's it’s", " a  b", "a\x85 b", "a \x1c b", "漢字 é 🎈", "12 34 5678", "\ta\t b"]
    alphabet = ["a", "the", " ", " ", "  ", "\n", "'s", "1", ".", "é", " ", "漢", "<|", "\t", "Z", "\x1c"]
    texts += ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 30))) for _ in range(3000)]
    for text in texts:
        assert own.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_query(spark, small, library):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    assert check(op9_packing(spark, small).collect(), docs, library) < 0.05


def plain_cost(places, penalty, size):
    best = [0] + [None] * (len(places) - 1)
    for j in range(1, len(places)):
        options = []
        for i in range(j):
            length = places[j] - places[i]
            if length <= size:
                options.append(best[i] + (0 if length & (length - 1) == 0 else size - length) + penalty[j])
        best[j] = min(options)
    return best[-1]


def test_cuts_are_the_cheapest():
    rng = random.Random(4)
    for _ in range(60):
        steps = [rng.randrange(1, 17) for _ in range(rng.randrange(1, 80))]
        places = np.cumsum([0, *steps])
        penalty = np.array([0, *[rng.choice([0, 3, 9]) for _ in steps]])
        cuts = best_cuts(places, penalty, 32)
        cost, at = 0, 0
        for c in cuts:
            length = c - at
            assert length <= 32
            cost += (0 if length & (length - 1) == 0 else 32 - length) + penalty[places.tolist().index(c)]
            at = c
        assert at == places[-1] and cost == plain_cost(places.tolist(), penalty.tolist(), 32)


def test_places_never_lie_far_apart():
    ids = np.array([7] * 5000 + [3] * 10, np.uint32)
    ends = np.zeros(8, bool)
    ends[3] = True
    places, penalty = cut_places(ids, ends, np.array([4000, 5010]))
    assert np.diff(places).max() <= 128 and penalty[places == 4000] == 0 and penalty[-1] == 0


def test_nulls_repeats_long_texts_and_blocks(spark, library, monkeypatch):
    docs = [(None, "a b c"), (None, None), (1, ""), (1, ""), (2, "word. " * 30000), (3, "x" * 50000), (4, "one two"), (4, "one three")]
    table = spark.createDataFrame([(d, t, 9) for d, t in docs], "doc_id long, text string, tie int")
    assert check(pack(table, VOCABULARY, ranges=1).collect(), docs, library) < 0.1
    small = pack(table, VOCABULARY, size=16, ranges=3).collect()
    check(small, docs, library, 16)
    assert pack(table.limit(0), VOCABULARY).collect() == []
