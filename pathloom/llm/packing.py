"""Packing documents into sequences, in order, by dynamic programming.

Documents follow each other in order of their ids. A window is a run of at most ``size``
tokens; its padding is what is missing to ``size``, or nothing where its length is a power of
two. Cuts are allowed at ends of documents (free), at ends of sentences and, inside long
sentences, at regular places (both at a penalty). The cheapest sum of padding and penalties up
to a cut ``j`` is

    best[j] = penalty[j] + size - p[j] + min(best[i] + p[i])   over i with p[j] - p[i] <= size

whose minimum slides to the right and is kept by a monotone queue, besides the few earlier
cuts at exactly a power of two.

The table is dealt to ranges of ids, so that only the last window of a range ends where the
text happens to end. Within a range, documents stream through blocks of bounded size; the last
window of a block is opened again with the next one. Tokens never leave the task.
"""

from __future__ import annotations

import json
import re
import zlib
from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SIZE = 2048
END_ID = 1  # after every document
BLOCK_TOKENS = 1 << 20
SENTENCE_PENALTY = 24
INNER_PENALTY = 160
INNER_STEP = 128  # tokens between cuts inside a long sentence
CACHED_WORDS = 400_000
CACHED_CHARS = 64

# How byte-level vocabularies cut a text, and the bytes they write as themselves.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PLAIN_BYTES = [*range(33, 127), *range(161, 173), *range(174, 256)]

SENTENCE_ENDS = (b".", b"!", b"?", "。".encode(), "！".encode(), "？".encode())
_SPACES = re.compile(r" \s| \Z")


class BytePairs:
    """Ids of a byte-level vocabulary file. A text is cut at the strings of its added tokens, which are one id each, first.

    Words repeat, so a text without doubled white space is cut before its spaces, which the
    vocabulary's own pattern does too, and words are looked up in a bounded cache.
    """

    def __init__(self, vocabulary: str):
        stored = json.load(open(vocabulary, encoding="utf-8"))
        added = stored.get("added_tokens", [])
        if any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
            raise ValueError("a vocabulary with plain added tokens is needed")
        self.added = {t["content"]: np.array([t["id"]], np.uint32) for t in added}
        self.cut = re.compile("|".join(f"({re.escape(t)})" for t in sorted(self.added, key=len, reverse=True)) or r"(?!)")
        others = [b for b in range(256) if b not in PLAIN_BYTES]
        byte = {chr(b): b for b in PLAIN_BYTES} | {chr(256 + n): b for n, b in enumerate(others)}
        ranks = {bytes(byte[c] for c in token): i for token, i in stored["model"]["vocab"].items() if token not in self.added}
        self.library = tiktoken.Encoding("stored", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.ends = np.zeros(max(ranks.values()) + 1, bool)
        for token, i in ranks.items():
            self.ends[i] = token.endswith(SENTENCE_ENDS) or b"\n" in token
        self.spaced = _Spaced(self.library)

    def encode(self, text: str) -> np.ndarray:
        if not self.cut.search(text):
            return self.ordinary(text)
        parts = [p for p in self.cut.split(text) if p]
        return np.concatenate([self.added[p] if p in self.added else self.ordinary(p) for p in parts])

    def ordinary(self, text: str) -> np.ndarray:
        """The ids of a text without added tokens."""
        if _SPACES.search(text):
            return np.array(self.library.encode_ordinary(text), np.uint32)
        words, spaced = text.split(" "), self.spaced
        first = self.library.encode_ordinary(words[0])
        return np.concatenate([np.array(first, np.uint32), np.frombuffer(b"".join([spaced[w] for w in words[1:]]), np.uint32)])


class _Spaced(dict):
    """Packed ids of a word with a space in front; bounded by starting anew."""

    def __init__(self, library: tiktoken.Encoding):
        super().__init__()
        self.library = library

    def __missing__(self, word: str) -> bytes:
        found = np.array(self.library.encode_ordinary(" " + word), np.uint32).tobytes()
        if len(word) <= CACHED_CHARS:
            if len(self) >= CACHED_WORDS:
                self.clear()
            self[word] = found
        return found


@lru_cache(1)
def byte_pairs(vocabulary: str) -> BytePairs:
    return BytePairs(vocabulary)


def cut_places(ids: np.ndarray, ends: np.ndarray, doc_ends: np.ndarray, size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """Places where a window may end, ascending, and their penalties. The start 0 is the first."""
    sentence = np.zeros(len(ids), bool)
    known = ids < len(ends)
    sentence[known] = ends[ids[known]]
    sentence[:-1] &= ~sentence[1:]
    places = np.union1d(np.flatnonzero(sentence) + 1, np.concatenate([[0], doc_ends]))
    step = min(INNER_STEP, size)
    long = np.flatnonzero(np.diff(places) > step)
    inner = [np.arange(places[g] + step, places[g + 1], step) for g in long]
    penalty = np.full(len(places), SENTENCE_PENALTY, np.int64)
    if inner:
        inner = np.concatenate(inner)
        places, penalty = np.concatenate([places, inner]), np.concatenate([penalty, np.full(len(inner), INNER_PENALTY)])
        order = np.argsort(places, kind="stable")
        places, penalty = places[order], penalty[order]
    penalty[np.isin(places, doc_ends, assume_unique=False)] = 0
    penalty[0] = 0
    return places, penalty


def best_cuts(places: np.ndarray, penalty: np.ndarray, size: int = SIZE) -> list[int]:
    """The cheapest cuts from the first to the last place; no two places lie further apart than
    ``size``."""
    exact: dict[int, list[int]] = {}  # earlier places at exactly a power of two
    step = 1
    while step < size:
        found = np.searchsorted(places, places - step)
        for j in np.flatnonzero((places >= step) & (places[found] == places - step)).tolist():
            exact.setdefault(j, []).append(int(found[j]))
        step *= 2
    p, cost = places.tolist(), penalty.tolist()
    best, last = [0] * len(p), [0] * len(p)
    queue = deque([(p[0], 0)])  # (best + p, place), ascending in both
    start = 0
    for j in range(1, len(p)):
        while p[j] - p[queue[0][1]] > size:
            queue.popleft()
        value, i = queue[0]
        value += size - p[j]
        for k in exact.get(j, ()):
            if best[k] < value:
                value, i = best[k], k
        best[j], last[j] = value + cost[j], i
        key = best[j] + p[j]
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, j))
    cuts, j = [], len(p) - 1
    while j > start:
        cuts.append(p[j])
        j = last[j]
    return cuts[::-1]


def _pack(vocabulary: str, size: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = byte_pairs(vocabulary)
        first_sequence = TaskContext.get().partitionId() << 36
        sequence, docs, tokens = 0, [], 0  # docs: (doc_id, ids that are left, start, all ids)

        def flush(final: bool) -> pa.RecordBatch | None:
            nonlocal sequence, docs, tokens
            ids = np.concatenate([d[1] for d in docs])
            doc_ends = np.cumsum([len(d[1]) for d in docs])
            doc_starts = np.concatenate([[0], doc_ends[:-1]])
            places, penalty = cut_places(ids, own.ends, doc_ends, size)
            cuts = best_cuts(places, penalty, size)
            until = cuts[-1] if final else (cuts[-2] if len(cuts) > 1 else 0)
            edges = np.union1d(np.concatenate([doc_starts, doc_ends]), np.concatenate([[0], cuts]))
            edges = edges[edges <= until]
            starts, stops = edges[:-1], edges[1:]
            at = np.searchsorted(doc_starts, starts, side="right") - 1
            window = np.searchsorted(cuts, starts, side="right")
            window_start = np.concatenate([[0], cuts])[window]
            base = np.array([d[2] for d in docs])
            total = np.array([d[3] for d in docs])
            raw = ids.astype("<u4")
            crc = [zlib.crc32(raw[a:b]) for a, b in zip(starts.tolist(), stops.tolist())]
            names = [docs[i][0] for i in at.tolist()]
            out = (names, starts - doc_starts[at] + base[at], stops - starts, crc, total[at], first_sequence + sequence + window, starts - window_start)
            sequence += len(cuts) if final else len(cuts) - 1
            rest = []
            for (name, left, start, whole), a, b in zip(docs, doc_starts.tolist(), doc_ends.tolist()):
                if b > until:
                    skip = max(0, until - a)
                    rest.append((name, left[skip:], start + skip, whole))
            docs, tokens = rest, len(ids) - until
            return out

        def batch_of(out, kind: pa.DataType) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(out[0], kind), *(pa.array(x, pa.int64()) for x in out[1:])],
                                              names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

        kind = None
        for batch in batches:
            kind = batch.column(0).type
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = np.append(own.encode(text), np.uint32(end_id))
                docs.append((name, ids, 0, len(ids)))
                tokens += len(ids)
                if tokens >= BLOCK_TOKENS:
                    yield batch_of(flush(False), kind)
        if docs:
            yield batch_of(flush(True), kind)

    return run


def pack(docs: DataFrame, vocabulary: str, size: int = SIZE, end_id: int = END_ID, doc_id: str = "doc_id",
         text: str = "text", ranges: int | None = None) -> DataFrame:
    """The pieces of all documents: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset``.

    Every id of a document, the end id included, lies in exactly one piece, and the pieces of a
    sequence follow each other without a gap. A null text counts as empty: its only id is the
    end id. Rows without an id come first; repeated rows are packed once each, and rows that
    share an id follow each other by their texts' hashes. An empty table gives an empty one.
    """
    if size & (size - 1):
        raise ValueError("size must be a power of two")
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    ranges = ranges or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(ranges, "doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return dealt.mapInArrow(_pack(vocabulary, size, end_id), f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, "
                                                             "sequence_id long, offset long")
