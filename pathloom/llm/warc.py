"""WARC archives as a chunked record table.

Writing: one gzip member per record, payloads fed to the compressor piece by piece. Of equal
payloads one record is the response, the others are revisits of it. Reading: archives are
streamed, and a record becomes rows of (record id, chunk number, bytes); the digest is carried
along the chunks and complete in the last row. Neither side holds more than a chunk of a
payload besides the row that Spark hands over.

Archives are written below the folder that the cluster shares, by pyarrow's file systems, which
take local, HDFS and object-store addresses. Every attempt of a task writes a file of its own,
and only files that the stored manifest names are read, so lost executors leave nothing behind
that is read twice.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathloom.storage import freeze, new_folder

CHUNK = 1 << 18  # bytes of a payload
READ = 1 << 16  # bytes of an archive
GZIP_LEVEL = 1
DATE = "2000-01-01T00:00:00Z"  # of all records, so that archives are reproducible
MANIFEST = "path string, records long"
MIN_PAYLOAD = 0

_END = b"\r\n"


def _open(folder: str, name: str = "") -> tuple[fs.FileSystem, str]:
    system, path = fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")
    return system, f"{path}/{name}" if name else path


def base32(hexadecimal: str) -> str:
    return base64.b32encode(bytes.fromhex(hexadecimal)).decode()


def head(record_id: int | None, url: str | None, kind: str, digest: str, refers_to: int | None, size: int) -> bytes:
    """The header lines of a record; ids and urls are escaped, absent ones left out."""
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if record_id is None else record_id}>", f"WARC-Date: {DATE}",
             f"WARC-Payload-Digest: sha1:{digest}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=~')}")
    if refers_to is not None:
        lines.append(f"WARC-Refers-To: <urn:page:{refers_to}>")
    if kind == "revisit":
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    return "\r\n".join([*lines, "Content-Type: text/html", f"Content-Length: {size}", "", ""]).encode()


def _write(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, records, path = None, 0, ""
        for batch in batches:
            if out is None and batch.num_rows:
                system, path = _open(folder, f"{uuid.uuid4().hex}.warc.gz")
                out = system.open_output_stream(path, compression=None)
                address = path
            columns = [batch.column(n) for n in ("page_id", "url", "html", "digest", "refers_to")]
            for record_id, url, html, digest, refers_to in zip(*columns):
                kind = "revisit" if refers_to.as_py() is not None else "response"
                payload = memoryview(html.as_buffer() or b"") if kind == "response" else memoryview(b"")
                packer = zlib.compressobj(GZIP_LEVEL, zlib.DEFLATED, 31)
                out.write(packer.compress(head(record_id.as_py(), url.as_py(), kind, base32(digest.as_py()), refers_to.as_py(), len(payload))))
                for at in range(0, len(payload), CHUNK):
                    out.write(packer.compress(payload[at:at + CHUNK]))
                out.write(packer.compress(_END + _END) + packer.flush())
                records += 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([address]), pa.array([records], pa.int64())], names=["path", "records"])

    return run


def write_archives(pages: DataFrame, folder: str, min_payload: int = MIN_PAYLOAD, page_id: str = "page_id",
                   url: str = "url", html: str = "html") -> DataFrame:
    """Write a record per row below ``folder`` and return the stored manifest of the files.

    Of records with equal payloads of at least ``min_payload`` bytes, the one with the largest
    id is the response and the others revisit it; rows that repeat the largest id are responses
    too. A null payload is empty. Rows without an id refer to the response, if there is one
    with an id, and are responses otherwise. An empty table gives an empty manifest.
    """
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"),
                        F.coalesce(F.col(html), F.lit("")).cast("binary").alias("html"))
    rows = rows.withColumn("digest", F.sha1("html"))
    large = F.octet_length("html") >= min_payload
    # combined before the shuffle; the join's hot digests are left to adaptive execution
    first = rows.where(large).groupBy("digest").agg(F.max("page_id").alias("response"), F.count("*").alias("n")).where("n > 1").drop("n")
    told = rows.join(first, "digest", "left").withColumn(
        "refers_to", F.when(large & ~F.col("page_id").eqNullSafe(F.col("response")), F.col("response")))
    system, path = _open(folder)
    system.create_dir(path, recursive=True)
    return freeze(told.select("page_id", "url", "html", "digest", "refers_to").mapInArrow(_write(folder), MANIFEST))


class _Source:
    """Bytes of one gzip member after the other, at most about a chunk at a time."""

    def __init__(self, file):
        self.file, self.raw, self.buffer, self.unpacker = file, b"", b"", None

    def _more(self) -> bool:
        """Unpack some more of the current member; False at its end."""
        while True:
            if self.unpacker is None or self.unpacker.eof:
                return False
            data = self.unpacker.unconsumed_tail or self.raw or self.file.read(READ)
            self.raw = b""
            if not data:
                raise ValueError("an archive ends within a record")
            piece = self.unpacker.decompress(data, CHUNK)
            if self.unpacker.eof:
                self.raw = self.unpacker.unused_data
            if piece:
                self.buffer += piece
                return True

    def next_member(self) -> bool:
        self.raw = self.raw or self.file.read(READ)
        self.unpacker, self.buffer = zlib.decompressobj(31), b""
        return bool(self.raw)

    def header(self) -> list[str]:
        while (end := self.buffer.find(b"\r\n\r\n")) < 0:
            if not self._more():
                raise ValueError("a record without a header end")
        lines, self.buffer = self.buffer[:end].decode().split("\r\n"), self.buffer[end + 4:]
        return lines

    def take(self, size: int) -> Iterator[bytes]:
        """``size`` bytes in chunks; all but the last are full."""
        while size:
            want = min(size, CHUNK)
            while len(self.buffer) < want:
                if not self._more():
                    raise ValueError("a record is shorter than its length")
            piece, self.buffer = self.buffer[:want], self.buffer[want:]
            size -= want
            yield piece

    def finish(self) -> None:
        while self._more():
            self.buffer = b""


CHUNKS = ("record_id long, url string, record_type string, refers_to long, declared string, chunk_no int, is_last boolean, "
          "n_bytes long, digest string, data binary")
_TYPES = pa.schema([("record_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("declared", pa.string()),
                    ("chunk_no", pa.int32()), ("is_last", pa.bool_()), ("n_bytes", pa.int64()), ("digest", pa.string()), ("data", pa.binary())])


def _record_chunks(source: _Source, with_data: bool) -> Iterator[tuple]:
    fields = dict(line.split(": ", 1) for line in source.header()[1:])

    def urn(name: str) -> int | None:
        number = fields.get(name, "").removeprefix("<urn:page:").removesuffix(">")
        return int(number) if number else None

    address = fields.get("WARC-Target-URI")
    own = (urn("WARC-Record-ID"), unquote(address) if address is not None else None, fields["WARC-Type"], urn("WARC-Refers-To"),
           fields["WARC-Payload-Digest"].removeprefix("sha1:"))
    size, digest, number = int(fields["Content-Length"]), hashlib.sha1(), 0
    left = size
    for piece in source.take(size):
        digest.update(piece)
        left -= len(piece)
        yield (*own, number, left == 0, len(piece), base64.b32encode(digest.digest()).decode() if left == 0 else None, piece if with_data else None)
        number += 1
    if not size:
        yield (*own, 0, True, 0, base64.b32encode(digest.digest()).decode(), b"" if with_data else None)
    source.finish()


def _read(folder: str, with_data: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, held = [], 0
                with _open(folder)[0].open_input_stream(path, compression=None) as file:
                    source = _Source(file)
                    while source.next_member():
                        for row in _record_chunks(source, with_data):
                            rows.append(row)
                            held += len(row[-1] or b"") + 200
                            if held > 8 * CHUNK:
                                yield _chunk_batch(rows)
                                rows, held = [], 0
                if rows:
                    yield _chunk_batch(rows)

    return run


def _chunk_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _TYPES)], schema=_TYPES)


def read_chunks(manifest: DataFrame, folder: str, with_data: bool = True) -> DataFrame:
    """The records of all archives of a manifest, in chunks: ``record_id, url, record_type,
    refers_to, declared`` (the digest in the header)``, chunk_no, is_last, n_bytes, digest``
    (of the whole payload, in the last chunk)`` , data``. Every record has a chunk, if empty.
    Without ``with_data`` the payload is digested but not returned."""
    files = manifest.select("path").repartition(max(1, manifest.count()))
    return files.mapInArrow(_read(folder, with_data), CHUNKS)


def archived(chunks: DataFrame) -> DataFrame:
    """Per record of a chunk table: ``page_id, payload_bytes, payload_digest, record_type,
    refers_to``; a revisit has the length and digest of the payload it stands for, found in the
    record that it refers to."""
    # only the last chunk has the digest; lengths of earlier chunks are full ones
    last = chunks.where("is_last").select(
        F.col("record_id").alias("page_id"), "record_type", "refers_to", "digest", "declared",
        (F.col("chunk_no").cast("long") * CHUNK + F.col("n_bytes")).alias("payload_bytes"))
    last = freeze(last)
    revisit = F.col("record_type") == "revisit"
    responses = last.where(~revisit & F.col("page_id").isNotNull()).groupBy(
        F.col("page_id").alias("refers_to"), F.col("digest").alias("declared")).agg(F.max("payload_bytes").alias("full_bytes"))
    return last.join(responses, ["refers_to", "declared"], "left").select(
        "page_id", F.when(revisit, F.col("full_bytes")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(~revisit, F.col("digest")).when(F.col("full_bytes").isNotNull(), F.col("declared")).alias("payload_digest"),
        "record_type", "refers_to")


def round_trip(pages: DataFrame, min_payload: int = MIN_PAYLOAD) -> DataFrame:
    """Write the pages to archives in the shared folder and read them back, one row per page."""
    folder = new_folder(pages.sparkSession, "warc")
    return archived(read_chunks(write_archives(pages, folder, min_payload), folder, with_data=False))
