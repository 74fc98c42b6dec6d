"""Importance resampling towards a target: hashed word features, bucket gains, perturbed scores.

An untrained ``Split`` pre-tokeniser cuts the lower-cased text into words with offsets; every
window of one or two neighbouring offset pairs is a feature, and its CRC names a bucket. Two
histograms, of all documents and of all target texts, give each bucket a gain, and a document
weighs the mean of its features' gains. Weights with a Gumbel draw hashed from the id put the
documents in order, and the first of them are drawn: sampling without replacement, the same in
every run.

At scale: texts are cut once, and the buckets of their features (two bytes each) are stored
between the two passes. Histograms are added up in each task before they are shuffled, so a hot
source or word costs nothing more, and are as long as there are buckets. Ranks come from one
range shuffle of scores and ids.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex
from tokenizers.pre_tokenizers import Split

from pathloom.operators.ordered import number_in_order
from pathloom.storage import freeze

BUCKETS = 10_000  # the bound of what the driver and every task hold
WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LONGEST = 2  # words of a feature
SHARE = 25  # per cent that are drawn
LEAST_WORDS = 20
SEED = 7
BLOCK_CHARS = 1 << 20  # of a text that are cut into words at once
ROWS = 512  # texts of one Arrow batch that is returned


def _blocks(text: str) -> Iterator[str]:
    """The text in pieces that end behind a space, which is no part of a word."""
    start = 0
    while len(text) - start > BLOCK_CHARS:
        end = text.find(" ", start + BLOCK_CHARS)
        if end < 0:
            break
        yield text[start:end + 1]
        start = end + 1
    yield text[start:]


class Features:
    """Buckets of the word windows of a text."""

    def __init__(self, words: str = WORDS, longest: int = LONGEST, buckets: int = BUCKETS):
        self.cut = Split(Regex(words), "removed", invert=True)
        self.longest, self.buckets = longest, buckets

    def __call__(self, text: bytes) -> tuple[int, np.ndarray]:
        """The number of words, and the bucket of every feature with its repeats."""
        count, tail, found = 0, [], [np.empty(0, np.uint32)]
        for block in _blocks(text.lower().decode()):  # of bytes: A-Z only
            words = [w.encode() for w, _ in self.cut.pre_tokenize_str(block)]
            count += len(words)
            found.append(self._windows(tail + words, len(tail)))
            tail = (tail + words)[1 - self.longest:] if self.longest > 1 else []
        return count, np.concatenate(found) % np.uint32(self.buckets)

    def _windows(self, words: list[bytes], old: int) -> np.ndarray:
        """CRCs of the windows that end behind the first ``old`` words."""
        joined, crc = memoryview(b" ".join(words)), zlib.crc32
        ends = (np.cumsum([len(w) + 1 for w in words], dtype=np.int64) - 1).tolist()
        starts = [0, *(e + 1 for e in ends[:-1])]
        found = []
        for size in range(1, self.longest + 1):
            first = max(0, old - size + 1)
            found += [crc(joined[a:b]) for a, b in zip(starts[first:], ends[first + size - 1:])]
        return np.array(found, np.uint32)


def _packed(buckets: int) -> np.dtype:
    """How bucket numbers are stored."""
    return np.dtype("<u2") if buckets <= 1 << 16 else np.dtype("<u4")


def bucketed(texts: DataFrame, keys: dict[str, Column], text: str = "text", buckets: int = BUCKETS, longest: int = LONGEST) -> DataFrame:
    """The ``keys``, ``n_words`` and the packed ``buckets`` of all features, for every text."""
    names = list(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, kind = Features(WORDS, longest, buckets), _packed(buckets)
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                found = [find(t) for t in batch.column("_text").to_pylist()]
                columns = [batch.column(n) for n in names]
                counts = pa.array([n for n, _ in found], pa.int64())
                yield pa.RecordBatch.from_arrays([*columns, counts, pa.array([b.astype(kind).tobytes() for _, b in found], pa.binary())],
                                                 names=[*names, "n_words", "buckets"])

    rows = texts.select(*[c.alias(n) for n, c in keys.items()], F.coalesce(F.col(text), F.lit("")).cast("binary").alias("_text"))
    kinds = [f"{n} {rows.schema[n].dataType.simpleString()}" for n in names]
    return rows.mapInArrow(run, ", ".join([*kinds, "n_words long", "buckets binary"]))


def histogram(rows: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``(bucket, n)`` over all rows of ``bucketed``; buckets without a feature are left out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for packed in batch.column(0).to_pylist():
                counts += np.bincount(np.frombuffer(packed, _packed(buckets)), minlength=buckets)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(counts[used])], names=["bucket", "n"])

    return rows.select("buckets").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Per bucket ``floor(1000 * ln((t + 1) * (S + buckets) / ((s + 1) * (T + buckets))))`` from the histograms of both;
    one number for each bucket comes to the driver."""
    counts = source.select("bucket", F.col("n").alias("s"), F.lit(0).alias("t")).unionByName(
        target.select("bucket", F.lit(0).alias("s"), F.col("n").alias("t")))
    found = counts.groupBy("bucket").agg(F.sum("s"), F.sum("t")).toArrow()
    s, t = np.zeros(buckets), np.zeros(buckets)
    at = found.column(0).to_numpy()
    s[at], t[at] = found.column(1).to_numpy(), found.column(2).to_numpy()
    share = (t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets))
    return np.floor(1000 * np.log(share)).astype(np.int64)


def _weights(rows: DataFrame, by_bucket: np.ndarray) -> DataFrame:
    """``doc_id, place, n_words, n_features, weight`` from stored buckets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = _packed(len(by_bucket))
        for batch in batches:
            features = [np.frombuffer(b, kind) for b in batch.column("buckets").to_pylist()]
            sums = [int(by_bucket[f].sum()) // len(f) if len(f) else 0 for f in features]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array([len(f) for f in features], pa.int64()), pa.array(sums, pa.int64())],
                names=["doc_id", "place", "n_words", "n_features", "weight"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", "place", "n_words", "buckets").mapInArrow(
        run, f"doc_id {kind}, place long, n_words long, n_features long, weight long")


def gumbel(doc_id: Column, seed: int = SEED) -> Column:
    """A Gumbel draw in thousandths, hashed from seed and id; a null id counts as an empty one."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def resample(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", target_text: str = "text",
             share: int = SHARE, least_words: int = LEAST_WORDS, seed: int = SEED, buckets: int = BUCKETS) -> DataFrame:
    """``(doc_id, n_features, weight, score, rank)`` per row of ``docs``: how much its features are of the target's
    kind, that weight with its draw, and its rank among the ``share`` per cent that are drawn (else null) of the
    documents with at least ``least_words`` words.

    Null, empty and wordless texts have no features and weight 0; they stay undrawn for any positive ``least_words``, but a
    target without features leaves all gains to the documents alone. Ties in the score go to the smaller id, null ids last;
    repeated rows are ranked once each, in any order. Other columns are not looked at, whatever their names. Texts
    are cut in blocks, so a very long one needs memory for its features only. An empty table gives an empty one.
    """
    keys = {"doc_id": F.col(doc_id), "place": F.monotonically_increasing_id()}
    cut = freeze(bucketed(docs, keys, text, buckets))
    by_bucket = gains(histogram(cut, buckets), histogram(bucketed(target, {}, target_text, buckets), buckets), buckets)
    scored = freeze(_weights(cut, by_bucket).withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed)))
    long = scored.where(F.col("n_words") >= least_words)
    drawn = share * long.count() // 100
    order = long.select("*", (-F.col("score")).alias("_falling"), F.col("doc_id").isNull().alias("_missing"))
    ranked = number_in_order(order, [], ["_falling", "_missing", "doc_id", "place"], "_at")
    rank = F.when(F.col("_at") < drawn, F.col("_at") + 1)
    names = ["doc_id", "n_features", "weight", "score"]
    short = scored.where(F.col("n_words") < least_words)
    return ranked.select(*names, rank.alias("rank")).unionByName(short.select(*names, F.lit(None).cast("long").alias("rank")))
