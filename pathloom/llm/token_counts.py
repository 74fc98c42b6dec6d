"""Token counts of a vocabulary with word ends, by byte-pair merging with a heap and a linked list.

A word starts as its bytes, the last of them marked as the end. The adjacent pair of the lowest
rank, leftmost first, is popped from a heap and merged; a linked list names the neighbours that
then form new pairs. The number of tokens is the number of symbols at the start minus the number
of merges, so no identifiers are put together.

White space never lies inside a token, so a text is cut at ASCII white space and the parts are
looked up in a bounded cache: words repeat. Parts beyond ASCII are normalised and cut by the
rules of the vocabulary file itself.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pathloom.llm.packing import PLAIN_BYTES

LIMIT = 2048
CACHED = 400_000  # parts, and words
CACHED_BYTES = 64  # longer ones are not kept

# The rules that the vocabulary files this module reads have to state, and the
# pattern among them as it works on lower-case ASCII.
NORMALIZERS = ["NFC", "Replace", "Lowercase"]
PRE_TOKENIZERS = ["Split", "ByteLevel"]
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
ASCII_WORDS = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\s0-9a-z]+")


class Merges:
    """One vocabulary file: ranks of adjacent symbols, and its rules for cutting a text."""

    def __init__(self, vocabulary: str):
        stored = json.load(open(vocabulary, encoding="utf-8"))
        model, special = stored["model"], stored["added_tokens"]
        split = stored["pre_tokenizer"]["pretokenizers"][0]
        if ([n["type"] for n in stored["normalizer"]["normalizers"]] != NORMALIZERS or split["pattern"] != {"Regex": SPLIT}
                or [p["type"] for p in stored["pre_tokenizer"]["pretokenizers"]] != PRE_TOKENIZERS
                or any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in special)):
            raise ValueError("a vocabulary of lower-case words with plain special tokens is needed")
        ids, end = model["vocab"], model["end_of_word_suffix"]
        others = [b for b in range(256) if b not in PLAIN_BYTES]
        self.byte = {chr(b): b for b in PLAIN_BYTES} | {chr(256 + n): b for n, b in enumerate(others)}
        self.inner = [ids[c] for c, _ in sorted(self.byte.items(), key=lambda x: x[1])]
        self.last = [ids[c + end] for c, _ in sorted(self.byte.items(), key=lambda x: x[1])]
        self.shift = max(ids.values()).bit_length()
        self.joined, self.ranks = [], {}
        for rank, (a, b) in enumerate(model["merges"]):
            self.joined.append(ids[a + b])
            self.ranks[ids[a] << self.shift | ids[b]] = rank
        self.special = re.compile(b"|".join(re.escape(t["content"].encode()) for t in sorted(special, key=lambda t: -len(t["content"]))))
        self.marks = {t["content"].encode()[:1] for t in special}
        self.library = Tokenizer.from_file(vocabulary)
        self.words, self.parts = _Bounded(self.merged), _Bounded(self.part)

    def merged(self, word: bytes) -> int:
        """Symbols of one word at the start minus its merges."""
        size, ranks, joined, shift = len(word), self.ranks, self.joined, self.shift
        symbols = [self.inner[b] for b in word]
        symbols[-1] = self.last[word[-1]]
        heap = [rank << 32 | i for i in range(size - 1) if (rank := ranks.get(symbols[i] << shift | symbols[i + 1])) is not None]
        if not heap:
            return size
        heapify(heap)
        before, after = list(range(-1, size - 1)), list(range(1, size + 1))
        count = size
        while heap:
            entry = heappop(heap)
            rank, a = entry >> 32, entry & 0xFFFFFFFF
            b = after[a]
            if b == size or symbols[a] < 0 or ranks.get(symbols[a] << shift | symbols[b]) != rank:
                continue  # one of the two was merged before
            symbols[a], symbols[b] = joined[rank], -1
            after[a] = c = after[b]
            count -= 1
            if c < size:
                before[c] = a
                if (rank := ranks.get(symbols[a] << shift | symbols[c])) is not None:
                    heappush(heap, rank << 32 | a)
            if (z := before[a]) >= 0 and (rank := ranks.get(symbols[z] << shift | symbols[a])) is not None:
                heappush(heap, rank << 32 | z)
        return count

    def part(self, part: bytes) -> int:
        """Tokens of a part without ASCII white space. A special token's string counts as one."""
        if any(mark in part for mark in self.marks) and (found := len(self.special.findall(part))):
            return found + sum(self.part(p) for p in self.special.split(part) if p)
        words = self.words
        if part.isascii():
            return sum([words[w] for w in ASCII_WORDS.findall(part.lower())])
        normal = self.library.normalizer.normalize_str(part.decode())
        cut = self.library.pre_tokenizer.pre_tokenize_str(normal)
        return sum([words[bytes([self.byte[c] for c in w])] for w, _ in cut])

    def count(self, text: bytes) -> int:
        """Tokens of a whole text."""
        parts = self.parts
        return sum([parts[p] for p in text.split()])  # at the six ASCII white-space characters


class _Bounded(dict):
    """Counts by bytes; bounded by starting anew."""

    def __init__(self, function):
        super().__init__()
        self.function = function

    def __missing__(self, key: bytes) -> int:
        found = self.function(key)
        if len(key) <= CACHED_BYTES:
            if len(self) >= CACHED:
                self.clear()
            self[key] = found
        return found


@lru_cache(1)
def merges(vocabulary: str) -> Merges:
    """The vocabulary of this process; executors load it once."""
    return Merges(vocabulary)


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = LIMIT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` per row of ``docs``: bytes in UTF-8, tokens
    without begin and end ids, and whether there are more than ``limit``.

    Null, empty and white texts have no tokens; a null one has no bytes. Null ids and repeated rows stay as
    they are, and other columns are not looked at, whatever their names. A text is handled whole, its longest
    part without white space in memory proportional to that part. An empty table gives an empty one.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = merges(vocabulary)
        for batch in batches:
            found = pa.array([own.count(t) for t in batch.column(1).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), found], names=["doc_id", "n_bytes", "n_tokens"])

    content = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = docs.select(F.col(doc_id).alias("doc_id"), content.alias("text"), F.octet_length(content).cast("long").alias("n_bytes"))
    counted = rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
