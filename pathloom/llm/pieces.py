"""SentencePiece BPE: exact encoding by backtracking over longest matches, and decoding.

A sequence of pieces is the merge-order encoding of a text if and only if every two adjacent
pieces are what merging their joined text gives. So the encoder walks forward with the longest
piece that an Aho-Corasick automaton finds at a position, keeps it if it is compatible with the
piece before, tries shorter ones if not, and steps back when none is left; a bitfield marks
positions from which no encoding goes on, so none is tried twice.

No piece has a space after another character, so a text falls apart in front of every run of
spaces. A part falls apart once more between two characters that follow each other in no piece,
such as a word and a line feed. What is left is encoded on its own and kept in a bounded cache;
words repeat, so most of them are looked up.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: the mark that stands for a space in pieces.
SPACE = "▁"

CACHED_PARTS = 800_000
CACHED_WORDS = 500_000
CACHED_CHARS = 64  # longer parts are not kept
CACHED_PAIRS = 1_000_000

_PARTS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


class Pieces:
    """One vocabulary: merges by score, leftmost first; unknown characters as UTF-8 bytes."""

    def __init__(self, model: str):
        library = sentencepiece.SentencePieceProcessor(model_file=model)
        size = library.get_piece_size()
        self.names = [library.id_to_piece(i) for i in range(size)]
        plain = [i for i in range(size) if not (library.is_control(i) or library.is_unknown(i) or library.is_byte(i))]
        self.ids = {self.names[i]: i for i in plain}
        self.scores = {self.names[i]: library.get_score(i) for i in plain}
        self.bytes = {int(self.names[i][3:5], 16): i for i in range(size) if library.is_byte(i)}
        self.texts = [b"" if library.is_control(i) else self.names[i].replace(SPACE, " ").encode() for i in range(size)]
        for byte, i in self.bytes.items():
            self.texts[i] = bytes([byte])
        if any(SPACE in n.lstrip(SPACE) for n in self.ids) or len(self.bytes) != 256:
            raise ValueError("a vocabulary with byte pieces and spaces only in front is needed")
        self.automaton = ahocorasick.Automaton()
        for name in self.ids:
            self.automaton.add_word(name, len(name))
        self.automaton.make_automaton()
        # per piece the longest shorter one that it starts with, or its first character
        self.shorter = {n: next((n[:k] for k in range(len(n) - 1, 1, -1) if n[:k] in self.ids), n[0]) for n in self.ids if len(n) > 1}
        self.neighbours = {a + b for n in self.ids for a, b in zip(n, n[1:])}
        self.compatible = lru_cache(CACHED_PAIRS)(self._compatible)
        self.encoded = _Encoded(self)

    def merge(self, text: str) -> list[str]:
        """Plain merging of a short text: again and again the leftmost of the best-scored adjacent pairs."""
        parts, score, none = list(text), self.scores.get, -math.inf
        pairs = [score(a + b, none) for a, b in zip(parts, parts[1:])]
        while pairs and (best := max(pairs)) > none:
            i = pairs.index(best)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i:
                pairs[i - 1] = score(parts[i - 1] + parts[i], none)
            if i < len(pairs):
                pairs[i] = score(parts[i] + parts[i + 1], none)
        return parts

    def _compatible(self, left: str, right: str) -> bool:
        if not left:
            return self.merge(right) == [right]
        return left + right not in self.scores and self.merge(left + right) == [left, right]

    def split(self, text: str) -> list[str]:
        """The pieces of a text; characters without a piece stay single. By backtracking: the longest piece of a position
        first, then its ever shorter prefixes that are pieces."""
        size = len(text)
        longest = [1] * size  # a character of its own always fits
        for end, length in self.automaton.iter(text):
            longest[end - length + 1] = length  # of one start, the longest ends last
        failed = bytearray(size // 8 + 1)  # bit i: no encoding goes on from position i
        compatible, shorter = self.compatible, self.shorter
        out: list[str] = []
        at, left, piece = 0, "", text[:longest[0]] if size else ""
        while at < size:
            while piece:
                end = at + len(piece)
                if not failed[end >> 3] >> (end & 7) & 1 and compatible(left, piece):
                    break
                piece = shorter.get(piece, "")
            if piece:
                out.append(piece)
                at, left = end, piece
                piece = text[at:at + longest[at]] if at < size else ""
            else:
                failed[at >> 3] |= 1 << (at & 7)
                last = out.pop()
                at -= len(last)
                left, piece = out[-1] if out else "", shorter.get(last, "")
        return out

    def part_ids(self, part: str) -> list[int]:
        """The ids of one part; a character without a piece becomes its UTF-8 bytes."""
        ids: list[int] = []
        for piece in self.split(part):
            known = self.ids.get(piece)
            ids += [known] if known is not None else [self.bytes[b] for b in piece.encode()]
        return ids

    def encode(self, text: str) -> np.ndarray:
        """The ids of the whole text, as the library gives them."""
        if not text:
            return np.empty(0, np.int32)
        marked = SPACE + text.replace(" ", SPACE)
        parts = _PARTS.findall(marked) if SPACE + SPACE in marked else [SPACE + w for w in marked.split(SPACE)[1:]]
        encoded = self.encoded
        return np.frombuffer(b"".join([encoded[p] for p in parts]), np.int32)

    def decode(self, ids: np.ndarray) -> str:
        """The text of the ids, without the space put in front."""
        texts = self.texts
        text = b"".join([texts[i] for i in ids.tolist()]).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


class _Encoded(dict):
    """Ids of parts as packed integers, and in ``words`` of what has no cut inside; both bounded by starting anew."""

    def __init__(self, own: Pieces):
        super().__init__()
        self.own, self.words = own, {}

    def __missing__(self, part: str) -> bytes:
        neighbours = self.own.neighbours
        cuts = [i for i in range(1, len(part)) if part[i - 1:i + 1] not in neighbours]
        found = b"".join([self._word(part[a:b]) for a, b in zip([0, *cuts], [*cuts, len(part)])])
        if len(part) <= CACHED_CHARS:
            if len(self) >= CACHED_PARTS:
                self.clear()
            self[part] = found
        return found

    def _word(self, word: str) -> bytes:
        found = self.words.get(word)
        if found is None:
            found = np.array(self.own.part_ids(word), np.int32).tobytes()
            if len(word) <= CACHED_CHARS:
                if len(self.words) >= CACHED_WORDS:
                    self.words.clear()
                self.words[word] = found
        return found


@lru_cache(1)
def pieces(model: str) -> Pieces:
    """The vocabulary of this process; executors load it once."""
    return Pieces(model)


def encode_decode(docs: DataFrame, model: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, ids, decoded)`` per row: the ids of the whole text without begin and end ids,
    and the text that they decode to.

    A null text counts as empty and has no ids. Null ids and repeated rows stay. A literal space
    mark in a text decodes to a space, as in the library. An empty table gives an empty one.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pieces(model)
        for whole in batches:
            for start in range(0, whole.num_rows, 512):
                batch = whole.slice(start, 512)
                ids = [own.encode(t) for t in batch.column(1).to_pylist()]
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids)))
                yield pa.RecordBatch.from_arrays([batch.column(0), lists, pa.array([own.decode(x) for x in ids], pa.string())],
                                                 names=["doc_id", "ids", "decoded"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>, decoded string")
