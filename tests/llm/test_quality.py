import re

from pathloom.llm import quality as Q
from pathloom.llm.queries import ORACLES, op7_quality
from tools.check_queries import table

BASE = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def plain(doc_id, text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    triples = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    inside = _inside(triples)
    n = len(words)
    return (doc_id, n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(inside), n < 50 or 100 * len(inside) > 50 * n)


def _inside(triples):
    count = {}
    for t in triples:
        count[t] = count.get(t, 0) + 1
    return {i + k for i, t in enumerate(triples) if count[t] > 1 for k in range(3)}


def test_query_counts_against_plain_ones(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").collect()
    found = op7_quality(spark, small)
    assert sorted(map(tuple, found.select(BASE).collect())) == sorted(plain(d.doc_id, d.text) for d in docs)
    kept = {r.doc_id: r for r in found.collect()}
    assert all(not r.kept for r in kept.values() if r.base_failed)


def test_clean_texts_stay_and_junk_goes(spark, small):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{small}/labels.parquet").collect()}
    found = {r.doc_id: r for r in op7_quality(spark, small).collect()}
    good = [found[d] for d, q in quality.items() if q == 1 and not found[d].base_failed]
    assert good and sum(r.kept for r in good) >= 0.97 * len(good) and docs


def test_odd_texts(spark):
    texts = [None, "", " \n\t", "a", "a b", "a b c", "a b c a b c", "x x x x x x", "l\nl\nl \n\nl", "é ä\x85b \x1c c", "#*$%&|<>é", "\na b\r\na b\r\n", "w " * 30000, "漢字 " * 60 + "🎈"]
    rows = [(i, t, "en", "s", "x", 1.0) for i, t in enumerate(texts)] + [(None, "a b c d", None, None, "x", 2.0)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, w string, symbol_share double")
    assert sorted(map(tuple, Q.quality(docs).select(BASE).collect()), key=repr) == sorted((plain(r[0], r[1]) for r in rows), key=repr)
    assert Q.quality(docs.limit(0)).collect() == [] and Q.keep_good(docs.limit(0)).collect() == []


def test_fences_follow_groups_and_rows_keep_their_columns(spark):
    import random
    rng = random.Random(1)

    def text(symbols, n=120):
        return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randrange(3, 9))) + ("#" if rng.random() < symbols else "") for _ in range(n))

    rows = [(i, text(0.0), "en", "plain") for i in range(300)] + [(1000 + i, text(0.9), "en", "code") for i in range(300)]
    rows += [(5000, text(0.9), "en", "plain"), (5001, text(0.9), "en", "code"), (5002, text(0.0), None, None), (5003, text(0.0), "xx", "tiny")]
    docs = spark.createDataFrame([(*r, 7) for r in rows], "doc_id long, text string, lang string, source string, symbol_share int")
    kept = {r.doc_id: r for r in Q.keep_good(docs).collect()}
    assert 5000 not in kept and {5001, 5002, 5003} <= kept.keys()
    assert len(kept) >= len(rows) - 6 and kept[5001].symbol_share == 7 and Q.keep_good(docs).columns == docs.columns


def test_query_agrees_with_sql(spark, con, small):
    want = con.execute(ORACLES["op7_quality"])
    found = op7_quality(spark, small)
    columns = [d[0] for d in want.description]
    assert sorted(columns) == sorted(found.columns)
    assert table(found.collect(), found.columns) == table(want.fetchall(), columns)
