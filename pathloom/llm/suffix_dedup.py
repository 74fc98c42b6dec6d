"""Removal of repeated byte strings by bucket-pointer refinement.

All positions of the corpus are sorted into buckets of equal strings of ``length`` bytes:
buckets of 8-grams first, then refined by the bucket identifiers at later offsets, 8 to 16, 32
and so on up to the whole length, each level from the one below it. As on a suffix array, only
buckets with several members are refined further, and those that are single are done.

Identifiers are derived from the content (64 bits), not handed out by a global sort, so every
task names the buckets of its own texts alike. Two shuffles tell which buckets are shared:

1. *Sieve.* Of every window of ``length`` bytes one position leads: the one whose bucket of
   half-length grams has the smallest identifier. Windows in a row with the same leader are one
   run, so a corpus of n bytes has about n / 35 runs. Runs are sorted by their leader's bucket.
   A single run is done. Runs of equal content are repeats of the earliest one, in whole.
2. *Refinement.* Where a bucket holds different runs, and only there, the windows themselves are
   sorted by the identifiers of their whole length.

Hot strings: each task first works off the runs (windows) that it sees itself and sends one for
each bucket, so a passage in a third of all documents is one small row per task. Shuffles carry
packed rows of 32 to 41 bytes instead of strings. Texts are joined by document, never grouped
by content. Windows are worked off in slices of their identifiers, one on disk at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathloom.storage import freeze, new_folder, shuffle_cleanup

LENGTH = 100
GRAM = 8
SEGMENT = 1 << 20  # window starts that are named at once
FLUSH = 1 << 20  # runs or windows that a task works off at once
BUCKET_BITS = 10
TASK_BYTES = 24 << 20
WINDOW_SLICES = 2
LAST = (1 << 63) - 1  # stands for a null id: after all others

_POSITION = np.uint64((1 << 24) - 1)
_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xD6E8FEB86659FD93)

RUN = np.dtype([("h", "<u8"), ("r", "<u8"), ("d", "<i8"), ("t", "<i8"), ("a", "<i4"), ("n", "<i4"), ("many", "u1")])
WINDOW = np.dtype([("h", "<u8"), ("r", "<u4"), ("d", "<i8"), ("t", "<i8"), ("a", "<i4")])
RANGE = np.dtype([("d", "<i8"), ("t", "<i8"), ("a", "<i4"), ("b", "<i4")])

# Packed rows: of one kind and bucket. Runs and windows are on their way, ranges are decided.
PACKED = "kind int, bucket int, rows binary"
SENT, CLOSED, OPEN = 0, 1, 2


def _mix(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The identifier of a bucket from those of its two parts; not symmetric."""
    with np.errstate(over="ignore"):
        z = x * _M1
        z ^= z >> np.uint64(29)
        z += (y ^ (y >> np.uint64(31))) * _M2
        z ^= z >> np.uint64(32)
        z *= _M3
        z ^= z >> np.uint64(30)
    return z


def levels(text: np.ndarray, length: int) -> tuple[np.ndarray, int, np.ndarray, np.ndarray]:
    """Bucket identifiers per position: of the sieve's grams with their size, and, for every
    window, of the whole length and 32 bits more of an independent one."""
    n = len(text)
    size = GRAM
    names = np.empty(n - size + 1, np.uint64)  # 8-grams are their own identifiers
    for shift in range(size):
        part = np.frombuffer(text[shift:shift + (n - shift) // size * size].tobytes(), "<u8")
        names[shift::size] = part[:len(names[shift::size])]
    sieve, sieve_size = _mix(names, names), size
    while 2 * size <= length:
        names = _mix(names[:-size], names[size:])
        size *= 2
        if 2 * size <= length:
            sieve, sieve_size = names, size
    rest = length - size
    first, second = (names[:len(names) - rest], names[rest:]) if rest else (names, names)
    return sieve, sieve_size, _mix(first, second), (_mix(second ^ _M3, first) >> np.uint64(32)).astype(np.uint32)


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    out, done = values, 1
    while done < width:
        step = min(done, width - done)
        out = np.minimum(out[:-step], out[step:])
        done += step
    return out


def runs_of(text: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Runs of windows with one leader in texts that lie next to each other: number of the text,
    first window, number of windows, leader's bucket, identifier of the run's content."""
    sieve, size, whole, _ = levels(text, length)
    keys = (sieve & ~_POSITION) | np.arange(len(sieve), dtype=np.uint64)  # leftmost of the smallest
    lead = (_sliding_min(keys, length - size + 1) & _POSITION).astype(np.int64)
    valid = np.zeros(len(lead) + 1, np.int8)
    fits = ends - starts >= length
    np.add.at(valid, starts[fits], 1)
    np.add.at(valid, (ends[fits] - length + 1), -1)
    valid = np.cumsum(valid[:-1], dtype=np.int8) > 0
    new = valid.copy()
    new[1:] &= ~valid[:-1] | (lead[1:] != lead[:-1])
    begin = np.flatnonzero(new)
    stop = valid.copy()
    stop[:-1] &= ~valid[1:] | (lead[1:] != lead[:-1])
    n = np.flatnonzero(stop) + 1 - begin
    leader = lead[begin]
    shape = (n.astype(np.uint64) << np.uint64(32)) | (leader - begin).astype(np.uint64)
    content = _mix(_mix(whole[begin], whole[begin + n - 1]), shape)
    return np.searchsorted(starts, begin, side="right") - 1, begin, n, sieve[leader], content


def _segments(texts: list[bytes], length: int) -> Iterator[tuple[list[int], list[int], bytes, list[int]]]:
    """Texts joined up to about ``SEGMENT`` bytes; longer texts in pieces that overlap by a
    window. Yields numbers of the texts, offsets of the pieces within them, the joined bytes and
    the pieces' lengths."""
    numbers, offsets, parts, held = [], [], [], 0
    for number, text in enumerate(texts):
        for at in range(0, max(1, len(text) - length + 1), SEGMENT):
            piece = text[at:at + SEGMENT + length - 1]
            if len(piece) < length:
                continue
            numbers.append(number)
            offsets.append(at)
            parts.append(piece)
            held += len(piece)
            if held >= SEGMENT:
                yield numbers, offsets, b"".join(parts), [len(p) for p in parts]
                numbers, offsets, parts, held = [], [], [], 0
    if parts:
        yield numbers, offsets, b"".join(parts), [len(p) for p in parts]


def merged(group: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unions of the ranges [a, b) within groups; touching ones become one."""
    order = np.lexsort((a, group))
    group, a, b = group[order], a[order], b[order]
    if not len(a):
        return group, a, b
    far = group << np.int64(32)
    reach = np.maximum.accumulate(far + b)
    first = np.concatenate([[True], (far + a)[1:] > reach[:-1]])
    last = np.concatenate([first[1:], [True]])
    return group[first], a[first], (reach - far)[last]


def _packed(rows: np.ndarray, hashes: np.ndarray, kind: int, bits: int) -> pa.RecordBatch:
    """Rows packed by the bucket of their hash."""
    with np.errstate(over="ignore"):
        bucket = ((hashes.astype(np.uint64) * _M1) >> np.uint64(64 - bits)).astype(np.int64)
    rows = rows[np.argsort(bucket, kind="stable")]
    sizes = np.bincount(bucket, minlength=1 << bits)
    used = np.flatnonzero(sizes)
    offsets = np.concatenate([[0], np.cumsum(sizes[used])]) * rows.dtype.itemsize
    packed = pa.Array.from_buffers(pa.binary(), len(used), [None, pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(rows.tobytes())])
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(used), kind, np.int32)), pa.array(used.astype(np.int32)), packed], names=["kind", "bucket", "rows"])


def _unpacked(column: pa.Array, dtype: np.dtype) -> list[np.ndarray]:
    return [np.frombuffer(x, dtype) for x in column.to_pylist()]


def _by_document(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Documents (d, t) and the unions of their ranges: number of the document, start, end."""
    keys, group = np.unique(rows[["d", "t"]], return_inverse=True)
    return keys, *merged(group.ravel().astype(np.int64), rows["a"].astype(np.int64), rows["b"].astype(np.int64))


def _range_batches(closed: np.ndarray, still_open: np.ndarray, bits: int) -> Iterator[pa.RecordBatch]:
    for kind, rows in ((CLOSED, closed), (OPEN, still_open)):
        if len(rows):
            keys, group, a, b = _by_document(rows)
            out = np.empty(len(a), RANGE)
            out["d"], out["t"], out["a"], out["b"] = keys["d"][group], keys["t"][group], a, b
            yield _packed(out, out["d"], kind, bits)


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per document of the ranges in a partition."""
    held = [rows for batch in batches for rows in _unpacked(batch.column("rows"), RANGE)]
    if held:
        keys, group, a, b = _by_document(np.concatenate(held))
        offsets = pa.array(np.concatenate([[0], np.cumsum(np.bincount(group, minlength=len(keys)))]).astype(np.int32))
        lists = [pa.ListArray.from_arrays(offsets, pa.array(x.astype(np.int32))) for x in (a, b)]
        yield pa.RecordBatch.from_arrays([pa.array(keys["d"]), pa.array(keys["t"]), *lists], names=["d", "t", "starts", "ends"])


def _sorted(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows by bucket, content and place, without repeats of one place; where a new bucket and
    where a new content begins."""
    rows = rows[np.argsort(rows["h"])]
    again = rows["h"][1:] == rows["h"][:-1]
    several = np.flatnonzero(np.concatenate([again, [False]]) | np.concatenate([[False], again]))
    shared = rows[several]  # few; only they need the full order
    rows[several] = shared[np.lexsort((shared["a"], shared["t"], shared["d"], shared["r"], shared["h"]))]
    bucket = np.concatenate([[True], rows["h"][1:] != rows["h"][:-1]])
    content = bucket | np.concatenate([[True], rows["r"][1:] != rows["r"][:-1]])
    fresh = content.copy()
    for name in ("d", "t", "a"):
        fresh[1:] |= rows[name][1:] != rows[name][:-1]
    return rows[fresh], bucket[fresh], content[fresh]


def _per_bucket(values: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    """For every row the sum of the values in its bucket."""
    begin = np.flatnonzero(bucket)
    return np.repeat(np.add.reduceat(values.astype(np.int64), begin), np.diff(np.append(begin, len(values))))


def _removed(rows: np.ndarray, length: int) -> np.ndarray:
    """The bytes that the windows of the rows cover."""
    out = _windows(rows)
    out["b"] += length - 1
    return out


def _windows(rows: np.ndarray) -> np.ndarray:
    """The windows of the rows, as ranges of their starts."""
    out = np.empty(len(rows), RANGE)
    out["d"], out["t"], out["a"] = rows["d"], rows["t"], rows["a"]
    out["b"] = rows["a"] + (rows["n"] if "n" in rows.dtype.names else 1)
    return out


def _sieve_map(length: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0

        def flush():
            rows, bucket, content = _sorted(np.concatenate(held))
            several = _per_bucket(content, bucket) > 1
            sent = rows[bucket]  # one for each bucket
            sent["many"] = several[bucket]
            yield _packed(sent, sent["h"], SENT, bits)
            yield from _range_batches(_removed(rows[~content], length), _windows(rows[content & several]), bits)

        for batch in batches:
            d, t = batch.column("d").to_numpy(), batch.column("t").to_numpy()
            for numbers, offsets, text, lengths in _segments(batch.column("text").to_pylist(), length):
                ends = np.cumsum(lengths)
                starts = ends - lengths
                part, begin, n, leader, content = runs_of(np.frombuffer(text, np.uint8), starts, ends, length)
                rows = np.empty(len(part), RUN)
                number = np.array(numbers)[part]
                rows["h"], rows["r"], rows["d"], rows["t"], rows["n"], rows["many"] = leader, content, d[number], t[number], n, 0
                rows["a"] = begin - starts[part] + np.array(offsets)[part]
                held.append(rows)
                count += len(rows)
                if count >= FLUSH:
                    yield from flush()
                    held, count = [], 0
        if count:
            yield from flush()

    return run


def _meet(dtype: np.dtype, length: int, bits: int):
    """Sorts what tasks have sent; whole partitions, whose size the number of tasks bounds."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            sent = pc.equal(batch.column("kind"), SENT)
            held += _unpacked(batch.column("rows").filter(sent), dtype)
            yield batch.filter(pc.invert(sent))
        if not held:
            return
        rows = np.concatenate(held)
        del held
        rows = rows[np.argsort(rows["h"], kind="stable")]
        same = rows["h"][1:] == rows["h"][:-1]
        rows = rows[np.concatenate([same, [False]]) | np.concatenate([[False], same])]
        if not len(rows):
            return
        rows, bucket, content = _sorted(rows)
        if "many" in dtype.names:
            many = rows["many"] > 0  # their tasks have opened all their runs already
            alike = (_per_bucket(content, bucket) == 1) & (_per_bucket(many, bucket) == 0)
            yield from _range_batches(_removed(rows[alike & ~content], length), _windows(rows[~alike & ~many]), bits)
        else:
            yield from _range_batches(_removed(rows[~content], length), np.empty(0, RANGE), bits)

    return run


def _window_map(length: int, slices: int, current: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0

        def flush():
            rows, _, content = _sorted(np.concatenate(held))
            yield _packed(rows[content], rows["h"][content], SENT, bits)
            yield from _range_batches(_removed(rows[~content], length), np.empty(0, RANGE), bits)

        for batch in batches:
            columns = [batch.column(n) for n in ("d", "t", "text", "starts", "ends")]
            for d, t, text, starts, ends in zip(*(c.to_pylist() for c in columns)):
                order = np.argsort(starts)
                starts, ends = np.array(starts)[order], np.array(ends)[order]
                for at in range(0, len(text) - length + 1, SEGMENT):
                    piece = text[at:at + SEGMENT + length - 1]
                    _, _, whole, more = levels(np.frombuffer(piece, np.uint8), length)
                    marks = np.zeros(len(whole) + 1, np.int32)
                    np.add.at(marks, np.clip(starts - at, 0, len(whole)), 1)
                    np.add.at(marks, np.clip(ends - at, 0, len(whole)), -1)
                    found = np.flatnonzero((np.cumsum(marks[:-1]) > 0) & (whole % np.uint64(slices) == current))
                    rows = np.empty(len(found), WINDOW)
                    rows["h"], rows["r"], rows["d"], rows["t"], rows["a"] = whole[found], more[found], d, t, found + at
                    held.append(rows)
                    count += len(rows)
                    if count >= FLUSH:
                        yield from flush()
                        held, count = [], 0
        if count:
            yield from flush()

    return run


def repeated_ranges(docs: DataFrame, length: int = LENGTH, slices: int = WINDOW_SLICES) -> DataFrame:
    """``(d, t, starts, ends)``: per document the byte ranges covered by a string of ``length``
    bytes that also starts earlier. ``docs`` has the order ``d`` (long, not null), the tie
    ``t`` (long) and the ``text`` as binary; rows that agree in d and t are one document."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // 30 * RUN.itemsize // TASK_BYTES)
    bits = max(BUCKET_BITS, (4 * tasks).bit_length())  # several buckets for each task

    def met(rows: DataFrame, dtype: np.dtype) -> DataFrame:
        return rows.repartition(tasks, "bucket").mapInArrow(_meet(dtype, length, bits), PACKED)

    def gathered(ranges: DataFrame) -> DataFrame:
        return ranges.repartition(tasks, "bucket").mapInArrow(_gather, "d long, t long, starts array<int>, ends array<int>")

    first = freeze(met(docs.where(F.octet_length("text") >= length).mapInArrow(_sieve_map(length, bits), PACKED), RUN))
    opened = freeze(docs.join(gathered(first.where(F.col("kind") == OPEN)), ["d", "t"]))
    target = new_folder(spark, "ranges")
    with shuffle_cleanup(spark):
        for current in range(slices):
            met(opened.mapInArrow(_window_map(length, slices, current, bits), PACKED), WINDOW).write.mode("append").parquet(target)
    second = spark.read.schema(PACKED).parquet(target)
    return gathered(first.where(F.col("kind") == CLOSED).unionByName(second))


def _keyed(docs: DataFrame, keep: dict, doc_id: str, text: str) -> DataFrame:
    whole = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST)).alias("d"), F.xxhash64(whole).alias("t"), whole.cast("binary").alias("text"),
                       *[c.alias(n) for n, c in keep.items()])


def kept_bytes(text: bytes, starts: list[int] | None, ends: list[int] | None) -> tuple[bytes, int]:
    """The text without the ranges, and how many runs of bytes went."""
    if not starts:
        return text, 0
    _, a, b = merged(np.zeros(len(starts), np.int64), np.array(starts, np.int64), np.array(ends, np.int64))
    edges = [0, *np.stack([a, b], axis=1).ravel().tolist(), len(text)]
    return b"".join([text[edges[i]:edges[i + 1]] for i in range(0, len(edges), 2)]), len(a)


def remove_repeats(docs: DataFrame, length: int = LENGTH, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, kept, n_bytes, n_spans)`` per row: the bytes of the text without every byte
    that a string of ``length`` bytes covers which also starts earlier, in a smaller doc_id or
    further left in the same text.

    Strings are judged on the input. A null text is empty. Rows without an id come after all
    others. Rows that share an id but not the text are ordered by a hash of the text; rows that
    share both are one document and are cut alike. An empty table gives an empty one.
    """
    whole = _keyed(docs, {"doc_id": F.col(doc_id)}, doc_id, text)
    ranges = repeated_ranges(whole.select("d", "t", "text"), length)
    kind = whole.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            found = [kept_bytes(*x) for x in zip(texts, batch.column("starts").to_pylist(), batch.column("ends").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([f[0] for f in found], pa.binary()), pa.array([len(t) for t in texts], pa.int64()),
                                              pa.array([f[1] for f in found], pa.int64())], names=["doc_id", "kept", "n_bytes", "n_spans"])

    joined = whole.join(ranges, ["d", "t"], "left").select("doc_id", "text", "starts", "ends")
    return joined.mapInArrow(run, f"doc_id {kind}, kept binary, n_bytes long, n_spans long")


def cut_repeats(docs: DataFrame, length: int = LENGTH, doc_id: str = "doc_id", text: str = "text", n_chars: str | None = "n_chars") -> DataFrame:
    """All rows and columns of ``docs`` with repeated strings cut out of ``text`` and
    ``n_chars``, if there is such a column, set to the new length. Characters that a cut leaves
    incomplete go too. Texts without a repeat, null texts among them, keep both."""
    names = docs.columns
    whole = _keyed(docs, {"row": F.struct(*[F.col(f"`{n}`") for n in names])}, doc_id, text)
    ranges = repeated_ranges(whole.select("d", "t", "text"), length)
    joined = whole.select("d", "t", "row").join(ranges, ["d", "t"], "left").select("row", "starts", "ends")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, starts, ends = batch.column("row"), batch.column("starts").to_pylist(), batch.column("ends").to_pylist()
            columns = [row.field(i) for i in range(len(names))]
            old = columns[names.index(text)]
            new = [kept_bytes(x.encode(), a, b)[0].decode("utf-8", "ignore") if a else x for x, a, b in zip(old.to_pylist(), starts, ends)]
            columns[names.index(text)] = pa.array(new, old.type)
            if n_chars in names:
                kept = columns[names.index(n_chars)]
                columns[names.index(n_chars)] = pa.array([len(x) if a else n for x, a, n in zip(new, starts, kept.to_pylist())], kept.type)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return joined.mapInArrow(run, docs.schema)
