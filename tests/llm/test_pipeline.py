import random
import zlib

import corpus_pipeline
import numpy as np
import public_tokenizers
from test_packing import ids_of
from test_secret_scan import plain_base
from test_simhash import plain_classes, plain_fingerprint
from test_suffix_dedup import plain as plain_repeats
from tokenizers import Tokenizer

from pathloom.llm import quality
from pathloom.storage import freeze


def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


def test_stages_against_plain_ones(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    names = docs.columns
    before = {r.doc_id: r for r in docs.collect()}
    good = freeze(stage("quality_rules")(spark, docs, small))
    kept = {r.doc_id for r in quality.quality(docs).where("kept").collect()}
    rows = {r.doc_id: r for r in good.collect()}
    assert good.columns == names and rows.keys() == kept and all(rows[d] == before[d] for d in kept)

    one = freeze(stage("near_duplicates")(spark, good, small))
    fps = {d: plain_fingerprint(r.text) for d, r in rows.items()}
    classes = plain_classes(sorted(set(fps.values())))
    firsts = {}
    for d in sorted(rows):
        firsts.setdefault(classes[fps[d]], d)
    left = {r.doc_id: r for r in one.collect()}
    assert one.columns == names and left.keys() == set(firsts.values()) and all(left[d] == before[d] for d in left)

    cut = freeze(stage("repeated_strings")(spark, one, small))
    ordered = [(d, left[d].text.encode()) for d in sorted(left)]
    want = {d: bytes(c for c, f in zip(t, flags) if not f).decode("utf-8", "ignore") for (d, t), flags in zip(ordered, plain_repeats(ordered))}
    shorter = {r.doc_id: r for r in cut.collect()}
    assert cut.columns == names and {d: r.text for d, r in shorter.items()} == want
    assert all(r.n_chars == len(r.text) for d, r in shorter.items() if r.text != left[d].text)

    clean = freeze(stage("secrets")(spark, cut, small))
    final = {r.doc_id: r.text for r in clean.collect()}
    assert final.keys() == want.keys()
    for d, text in final.items():
        if not plain_base(want[d]) and text != want[d]:
            assert "[SECRET]" in text
        assert not plain_base(want[d]) or "[SECRET]" in text

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = stage("packing")(spark, clean, small).collect()
    got = {}
    for r in sorted(pieces, key=lambda r: (r.doc_id, r.start)):
        ids = ids_of(library, final[r.doc_id])
        assert r.start == got.get(r.doc_id, 0) and r.ids_crc32 == zlib.crc32(np.array(ids[r.start:r.start + r.length], "<u4").tobytes())
        got[r.doc_id] = r.start + r.length
    assert got == {d: len(ids_of(library, t)) for d, t in final.items()}


def test_odd_rows_and_columns(spark, tmp_path):
    rng = random.Random(8)

    def text(n=80):
        return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(3, 9))) for _ in range(n))

    first, second = text(), text()
    rows = [(1, first, "en", "s", 5, "a", 1), (1, first, "en", "s", 5, "a", 2), (None, first, None, None, None, "b", 3), (2, None, "en", "s", 0, "c", 4),
            (None, second, "de", None, 7, "d", 5), (None, second, "de", None, 7, "d", 5), (3, "", "xx", "t", 0, "e", 6), (4, text() + " password: abcdef123", "en", "s", 1, "f", 7),
            (5, text(40000), "en", "s", 9, "g", 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, key string, row int")
    for name, function in corpus_pipeline.STAGES[:-1]:
        docs = freeze(function(spark, docs, ""))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "key", "row"], name
        if name == "near_duplicates":
            assert sorted((r.doc_id or 0, r.text == first, r.text == second) for r in docs.collect()) == [(0, False, True), (1, True, False), (4, False, False), (5, False, False)]
    found = {r.doc_id: r.text for r in docs.collect()}
    assert found[4].endswith("[SECRET]") and found[1] == first
    assert corpus_pipeline.packing(spark, docs, "").count() > 4
    empty = docs.limit(0)
    for _, function in corpus_pipeline.STAGES[:-1]:
        empty = freeze(function(spark, empty, ""))
    assert corpus_pipeline.packing(spark, empty, "").collect() == []
