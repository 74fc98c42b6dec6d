import base64
import gzip
import hashlib
import uuid

from pyspark.sql import functions as F

from pathloom.llm import warc
from pathloom.llm.queries import ORACLES, QUERIES
from pathloom.storage import work_folder
from tools.check_queries import table


def test_query_agrees_with_sql(spark, con, small):
    found = QUERIES["op5_warc"](spark, small)
    want = con.execute(ORACLES["op5_warc"])
    columns = [d[0] for d in want.description]
    assert sorted(columns) == sorted(found.columns)
    assert table(found.collect(), found.columns) == table(want.fetchall(), columns)


def digest(text):
    return base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()


def test_round_trip_of_odd_payloads(spark, monkeypatch):
    long = "0123456789é" * 60_000
    rows = [(1, "http://a/%41 b\r\nX: y", "same", "k"), (2, None, "same", "k"), (3, "ü", None, "k"), (4, "", "", "k"), (5, "u", long, "k"),
            (7, "u", long, "k"), (7, "u", long, "k"), (None, "u", "same", "k"), (None, "u", "lone", "k"), (8, "u", "\r\n\r\nWARC/1.1\r\n", "k")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest string")
    folder = f"{work_folder(spark)}/test-{uuid.uuid4().hex}"
    manifest = warc.write_archives(pages, folder)
    assert manifest.agg(F.sum("records")).first()[0] == len(rows)
    chunks = warc.read_chunks(manifest, folder).collect()
    texts = {}
    for c in sorted(chunks, key=lambda c: c.chunk_no):
        texts.setdefault((c.record_id, c.record_type, c.declared), []).append(bytes(c.data))
    assert b"".join(texts[5, "revisit", digest(long)]) == b""
    assert b"".join(texts[7, "response", digest(long)][::2]).decode() == long  # two equal records, chunk by chunk
    assert max(len(p) for p in texts[7, "response", digest(long)]) == warc.CHUNK
    assert {(c.record_id, c.url) for c in chunks} == {(r[0], r[1]) for r in rows}
    want = []
    for page, _, html, _ in rows:
        response = {"same": 2, "": 4, long: 7}.get(html or "")
        refers = response if page != response else None
        want.append((page, len((html or "").encode()), digest(html or ""), "revisit" if refers else "response", refers))
    assert sorted(map(tuple, warc.round_trip(pages).collect()), key=repr) == sorted(want, key=repr)


def test_files_are_plain_gzip_members(spark):
    folder = f"{work_folder(spark)}/test-{uuid.uuid4().hex}"
    manifest = warc.write_archives(spark.createDataFrame([(1, "http://x/", "<p>hi</p>")], "page_id long, url string, html string"), folder)
    data = gzip.open(manifest.first().path).read()
    assert data.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and data.endswith(b"\r\n\r\n<p>hi</p>\r\n\r\n")


def test_min_payload_and_empty_table(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], "page_id long, url string, html string")
    found = {r.page_id: (r.record_type, r.refers_to) for r in warc.round_trip(pages, min_payload=3).collect()}
    assert found == {1: ("response", None), 2: ("response", None), 3: ("revisit", 4), 4: ("response", None)}
    assert warc.round_trip(pages.limit(0)).collect() == []
