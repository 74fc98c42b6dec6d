"""Periodic runs of words, found by recursive frequency splitting and a scan of lags.

A run is a stretch of words with smallest period q, at least ``EXPONENT * q`` and ``SHORTEST``
words long, that no neighbouring word extends. Every word of a run occurs in it at least
``EXPONENT`` times. So a word that occurs more rarely within a segment lies in no run there and
splits the segment; the parts are split again until nothing changes. Ordinary text is gone by
then. In a surviving segment every lag q is scanned: a run holds a multiple of q from which two
periods agree with the two that start q later, so only multiples are looked at, by fingerprints
of prefixes. That is (words / q) places for lag q, about n log n in all. What agrees is compared
word by word and extended to both sides.

Splitting recounts only the smaller parts and takes them off the counts of the largest, so deep
recursions stay at about n log n, too.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EXPONENT = 4
SHORTEST = 6
ROWS = 512  # texts of one Arrow batch that is returned

# Factors that spread word numbers over 64 bits.
_SPREAD, _BASE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95)

RUN = "struct<start:bigint,length:bigint,period:bigint>"


def _stable(ids: list[int], lo: int, hi: int, least: int, shortest: int) -> Iterator[tuple[int, int]]:
    """The segments of ``ids[lo:hi]`` in which every word occurs at least ``least`` times."""
    places: dict[int, list[int]] = {}
    for i in range(lo, hi):
        places.setdefault(ids[i], []).append(i)
    counts = {w: len(p) for w, p in places.items()}
    work = [(lo, hi, counts, [w for w, n in counts.items() if n < least])]
    while work:
        lo, hi, counts, rare = work.pop()
        if not rare:
            yield lo, hi
            continue
        cuts = []
        for w in rare:
            first = bisect_left(places[w], lo)
            cuts += places[w][first:first + counts.pop(w)]
        cuts.sort()
        parts = [(a, b) for a, b in zip([lo, *(c + 1 for c in cuts)], [*cuts, hi]) if b > a]
        if not parts:
            continue
        largest = max(parts, key=lambda p: p[1] - p[0])
        touched = set()
        for a, b in parts:
            if (a, b) != largest:
                own = Counter(ids[a:b])
                for w, n in own.items():
                    counts[w] -= n
                touched.update(own)
                if b - a >= shortest:
                    work.append((a, b, own, [w for w, n in own.items() if n < least]))
        a, b = largest
        if b - a >= shortest:
            work.append((a, b, counts, [w for w in touched if 0 < counts[w] < least]))


def segments(ids: np.ndarray, exponent: int = EXPONENT, shortest: int = SHORTEST) -> list[tuple[int, int]]:
    """The segments that frequency splitting leaves, in order."""
    if len(ids) < shortest:
        return []
    rare = np.bincount(ids)[ids] < exponent
    edges = np.flatnonzero(np.diff(np.concatenate([[True], rare, [True]])))
    wide = edges.reshape(-1, 2)
    wide = wide[wide[:, 1] - wide[:, 0] >= shortest]
    if not len(wide):
        return []
    numbers = ids.tolist()
    return sorted(part for a, b in wide.tolist() for part in _stable(numbers, a, b, exponent, shortest))


def _groups(places: np.ndarray, lag: int) -> Iterator[tuple[int, int]]:
    """First and last of every chain of places that are ``lag`` apart."""
    ends = np.flatnonzero(np.diff(places) != lag)
    yield from zip(places[np.concatenate([[0], ends + 1])].tolist(), places[np.concatenate([ends, [len(places) - 1]])].tolist())


def scan_lags(ids: np.ndarray, exponent: int = EXPONENT, shortest: int = SHORTEST) -> list[tuple[int, int, int]]:
    """All runs ``(start, length, period)`` of a segment, by start and period."""
    size = len(ids)
    powers = np.full(size + 1, _BASE)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    values = (ids.astype(np.uint64) + np.uint64(1)) * _SPREAD
    prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum((values ^ (values >> np.uint64(29))) * powers[:-1])])
    runs: list[tuple[int, int, int]] = []
    cover = np.full(size, -1, np.int64)  # the last run found over a place
    for lag in range(1, size // exponent + 1):
        heads = prefix[::lag]
        two = heads[exponent - 2:] - heads[:2 - exponent]  # exponent - 2 periods from every multiple of the lag
        alike = np.flatnonzero(two[:-1] * powers[lag] == two[1:])
        if not len(alike):
            continue
        for first, last in _groups(alike * lag, lag):
            until = last + (exponent - 2) * lag
            known = cover[(first + until + lag) // 2]
            if known >= 0:  # inside a run whose period divides the lag
                start, length, period = runs[known]
                if lag % period == 0 and start <= first and until + lag <= start + length:
                    continue
            for a, b in _agreeing(ids, first, until, lag, exponent):
                back = np.flatnonzero(ids[max(0, a - lag):a] != ids[max(0, a - lag) + lag:a + lag])
                start = max(0, a - lag) + int(back[-1]) + 1 if len(back) else max(0, a - lag)
                more = np.flatnonzero(ids[b:min(size, b + 2 * lag) - lag] != ids[b + lag:min(size, b + 2 * lag)])
                end = (b + int(more[0]) if len(more) else min(size, b + 2 * lag) - lag) + lag
                if end - start >= max(shortest, exponent * lag):
                    cover[start:end] = len(runs)
                    runs.append((start, end - start, lag))
    return sorted(runs, key=lambda r: (r[0], r[2]))


def _agreeing(ids: np.ndarray, first: int, until: int, lag: int, exponent: int) -> list[tuple[int, int]]:
    """Ranges of at least ``exponent - 2`` periods within ``first`` to ``until`` whose words equal those ``lag`` later: the
    whole range, unless fingerprints were alike by chance."""
    differ = np.flatnonzero(ids[first:until] != ids[first + lag:until + lag])
    if not len(differ):
        return [(first, until)]
    edges = np.concatenate([[first - 1], differ + first, [until]]).tolist()
    return [(a + 1, b) for a, b in zip(edges, edges[1:]) if b - a - 1 >= (exponent - 2) * lag]


def find_runs(words: list[bytes], exponent: int = EXPONENT, shortest: int = SHORTEST) -> list[tuple[int, int, int]]:
    """All runs ``(start, length, period)`` of a list of words, by start and period."""
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    return [(a + start, length, period) for a, b in segments(ids, exponent, shortest)
            for start, length, period in scan_lags(ids[a:b], exponent, shortest)]


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words, joined by one space, without those that repeat the first period of a run."""
    if not runs:
        return b" ".join(words)
    drop = bytearray(len(words))
    for start, length, period in runs:
        drop[start + period:start + length] = b"\1" * (length - period)
    return b" ".join([w for w, d in zip(words, drop) if not d])


def periodic_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", exponent: int = EXPONENT,
                  shortest: int = SHORTEST) -> DataFrame:
    """``(doc_id, n_words, runs, collapsed)`` per row of ``docs``: all runs as an array of ``(start, length,
    period)`` in words, by start and period, and the text without the words of a run after its first period.

    Words are what ASCII white space parts; they are compared as they are. Null, empty and white texts have no
    words, no runs and an empty ``collapsed``. Null ids and repeated rows stay as they are, and other columns
    are not looked at, whatever their names. A text is handled whole, in memory proportional to its words. An
    empty table gives an empty one.
    """
    if exponent < 3:
        raise ValueError("runs of fewer than three periods are not found")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                sizes, found, kept = [], [], []
                for content in batch.column(1).to_pylist():
                    words = content.split()  # at the six ASCII white-space characters
                    runs = find_runs(words, exponent, shortest)
                    sizes.append(len(words))
                    found.append([{"start": s, "length": n, "period": q} for s, n, q in runs])
                    kept.append(collapse(words, runs).decode())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(sizes, pa.int64()), pa.array(found, kind), pa.array(kept, pa.string())],
                    names=["doc_id", "n_words", "runs", "collapsed"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_words bigint, runs array<{RUN}>, collapsed string")


def strongest(runs: Column) -> Column:
    """Of runs by start and period, the first with the greatest exact length / period; null without any."""
    better = lambda best, r: best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"])
    return F.aggregate(runs, F.lit(None).cast(RUN), lambda best, r: F.when(better(best, r), r).otherwise(best))


def with_planted_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, text)`` with periodic tails in the texts whose ``h = crc32(doc_id)`` is a multiple of ten.

    With ``g = h div 10`` and n words, those from ``a = g % n`` on repeat the original words from ``a`` with
    period ``1 + (n - a) div (3 + g % 8)``. A changed text has its words joined by one space; others, and those
    without an id or words, stay as they are.
    """
    h = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    words = F.filter(F.split(F.col(text), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    hit = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.when(h % 10 == 0, words).alias("words"), F.floor(h / 10).alias("g"))
    n = F.size("words").cast("long")
    a = F.pmod(F.col("g"), n)
    period = F.lit(1) + F.floor((n - a) / (F.lit(3) + F.col("g") % 8))
    source = lambda i: F.when(i < a, i).otherwise(a + F.pmod(i - a, period))
    planted = F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get(F.col("words"), source(i).cast("int"))), " ")
    return hit.select("doc_id", F.when(F.size("words") > 0, planted).otherwise(F.col("text")).alias("text"))
