"""SimHash near-duplicates by meet-in-the-middle ball hashing.

A 64-bit fingerprint has a bit set where more than half of its shingle hashes have it. Two
fingerprints at most ``radius`` bits apart have a common word at most ``radius / 2`` bits
from each, so every distinct fingerprint emits all words of its half ball (2 081 for radius
4), the words are shuffled, and fingerprints that meet in a word are linked.

At scale:

* Copies are one fingerprint before anything is emitted, so a word gathers at most as many
  fingerprints as a half ball has words, however hot a document is.
* All fingerprints that meet in a word are within the radius of each other, so a star from
  the smallest one keeps their links. What a task meets is thinned to a spanning forest, so it
  sends less than one link for each fingerprint it sees.
* Dense groups would form other stars in each word. They are found first, with half the radius
  and so a thirtieth of the words; members of large ones carry their group's label along, and a
  word links groups, not members. Fingerprints that the first step leaves apart are more than
  half the radius from each other, and only a few dozen such fit around a word.
* Words travel in packed blocks, one row per block and bucket. They are worked off in
  ``slices``: a slice is a pattern of parities of the word, which every fingerprint hits with
  an equal share of its ball. Only one slice is on disk at a time, and none is emitted twice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathloom.llm.components import star_components
from pathloom.storage import freeze, new_folder, shuffle_cleanup

RADIUS = 4
SHINGLE = 4
SEED = 42
SLICES = 8
BUCKET_BITS = 12
BLOCK = 4096  # fingerprints per packed block
TASK_BYTES = 32 << 20  # packed words per reducing task
WORD_BYTES = 10  # a word and the number of its mask; a label takes eight more
DENSE = 16  # members from which a group has a label

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The unsigned 64-bit SimHash of the whole text; 0 without words."""
    words = text.lower().split()  # for bytes: A-Z, and the six ASCII white-space characters
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, seed)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], seed) for a, b in zip(starts.tolist(), ends[shingle - 1:].tolist())], dtype="<u8")
    votes = np.zeros(64, np.int64)
    for part in range(0, len(hashes), 65536):
        bits = np.unpackbits(hashes[part:part + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, fp)`` for every row, fp as a signed long. A null text counts as empty."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(t) for t in batch.column(1).to_pylist()), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["doc_id", "fp"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, fp long")


def half_ball(radius: int) -> np.ndarray:
    """All masks of at most ``radius / 2`` (rounded up) set bits."""
    ball = {0}
    for _ in range((radius + 1) // 2):
        ball |= {mask | 1 << bit for mask in ball for bit in range(64)}
    return np.array(sorted(ball), np.uint64)


def _patterns(words: np.ndarray, slices: int) -> np.ndarray:
    """The parities that tell to which slice a word belongs; linear in the word."""
    checks = np.random.default_rng(slices).integers(0, 2**64, (slices - 1).bit_length(), np.uint64)
    found = np.zeros(len(words), np.int64)
    for bit, check in enumerate(checks):
        found |= (np.bitwise_count(words & check).astype(np.int64) & 1) << bit
    return found


WORDS = "bucket int, words binary, masks binary, labels binary"


def _emit(radius: int, slices: int, current: int, bits: int = BUCKET_BITS):
    """Words of fingerprints ``(fp, label)`` in packed blocks; no labels in blocks of fingerprints without one."""
    masks = half_ball(radius)
    mask_patterns = _patterns(masks, slices)

    def words_of(fps: np.ndarray, labels: np.ndarray | None) -> tuple[np.ndarray, ...]:
        own, words, numbers, marks = _patterns(fps, slices), [], [], []
        for pattern in range(slices):
            used, chosen = own == pattern, np.flatnonzero(mask_patterns == current ^ pattern)
            words.append((fps[used][:, None] ^ masks[chosen][None, :]).ravel())
            numbers.append(np.tile(chosen.astype(np.uint16), int(used.sum())))
            if labels is not None:
                marks.append(np.repeat(labels[used], len(chosen)))
        return np.concatenate(words), np.concatenate(numbers), np.concatenate(marks) if marks else np.empty(0, np.uint64)

    def blocks(fps: np.ndarray, labels: np.ndarray | None) -> Iterator[pa.RecordBatch]:
        for part in range(0, len(fps), BLOCK):
            words, numbers, marks = words_of(fps[part:part + BLOCK], None if labels is None else labels[part:part + BLOCK])
            bucket = (words * _MULTIPLIER) >> np.uint64(64 - bits)
            order = np.sort((bucket << np.uint64(40)) | np.arange(len(words), dtype=np.uint64))
            index = (order & np.uint64((1 << 40) - 1)).astype(np.int64)
            sizes = np.bincount((order >> np.uint64(40)).astype(np.int64), minlength=1 << bits)
            used = np.flatnonzero(sizes)
            offsets = np.concatenate([[0], np.cumsum(sizes[used])])
            yield pa.RecordBatch.from_arrays(
                [pa.array(used.astype(np.int32)), _binary(words[index], offsets), _binary(numbers[index], offsets),
                 _binary(marks, offsets * 0) if labels is None else _binary(marks[index], offsets)],
                names=["bucket", "words", "masks", "labels"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            with_label = batch.column(1).is_valid().to_numpy(zero_copy_only=False)
            yield from blocks(fps[~with_label], None)
            yield from blocks(fps[with_label], batch.column(1).drop_null().to_numpy(zero_copy_only=False).view(np.uint64))

    return run


def _binary(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """One binary value per range of ``offsets``."""
    at = pa.py_buffer((offsets * values.itemsize).astype(np.int32).tobytes())
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, at, pa.py_buffer(values.tobytes())])


def spanning_forest(u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Places of links ``(u, v)`` that connect what all of them connect, without a circle: in every round each
    component takes its first link that leads out, which at least halves their number."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    u, v, links = at[:len(u)], at[len(u):], np.arange(len(u))
    label, chosen = np.arange(len(nodes)), []
    while len(links):
        a, b = label[u[links]], label[v[links]]
        first = np.full(len(nodes), len(u))
        np.minimum.at(first, a, links)
        np.minimum.at(first, b, links)
        out = np.flatnonzero(first < len(u))
        taken = first[out]
        chosen.append(np.unique(taken))
        parent = np.arange(len(nodes))
        parent[out] = label[u[taken]] + label[v[taken]] - out  # the other end
        both = out[(parent[parent[out]] == out) & (out < parent[out])]
        parent[both] = both
        while (up := parent[parent]).tolist() != parent.tolist():
            parent = up
        label = parent[label]
        links = links[label[u[links]] != label[v[links]]]
    return np.sort(np.concatenate(chosen)) if chosen else links


def _collide(radius: int):
    masks = half_ball(radius)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, fps, groups = [], [], []
        for batch in batches:
            for word, number, label in zip(*(batch.column(n).to_pylist() for n in ("words", "masks", "labels"))):
                words.append(np.frombuffer(word, np.uint64))
                fps.append(words[-1] ^ masks[np.frombuffer(number, np.uint16)])
                groups.append(np.frombuffer(label, np.uint64) if label else fps[-1])
        if not words:
            return
        word, fp, group = np.concatenate(words), np.concatenate(fps), np.concatenate(groups)
        del words, fps, groups
        order = np.argsort(word)
        same = np.diff(word[order]) == 0
        order = order[np.concatenate([same, [False]]) | np.concatenate([[False], same])]
        word, fp, group = word[order], fp[order], group[order]
        order = np.lexsort((fp, group, word))  # one member stands for its group in a word
        word, fp, group = word[order], fp[order], group[order]
        new = np.ones(len(word), bool)
        new[1:] = (word[1:] != word[:-1]) | (group[1:] != group[:-1])
        word, fp, group = word[new], fp[new], group[new]
        starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]])) if len(word) else np.empty(0, np.int64)
        center = np.repeat(starts, np.diff(np.append(starts, len(word))))
        other = np.flatnonzero(center != np.arange(len(word)))
        center = center[other]
        near = np.bitwise_count(fp[center] ^ fp[other]) <= radius
        pairs, at = np.unique(np.stack([group[center[near]], group[other[near]]], axis=1), axis=0, return_index=True)
        kept = at[spanning_forest(pairs[:, 0], pairs[:, 1])]
        a, b = fp[center[near][kept]], fp[other[near][kept]]
        yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    return run


def _met(fps: DataFrame, n: int, radius: int, slices: int, target: str) -> None:
    """Append the links of ``n`` fingerprints ``(fp, label)`` to ``target``, slice by slice."""
    spark = fps.sparkSession
    per_slice = n * len(half_ball(radius)) * WORD_BYTES // slices
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-per_slice // TASK_BYTES))
    bits = max(BUCKET_BITS, (4 * tasks).bit_length())  # several buckets for each task
    with shuffle_cleanup(spark):
        for current in range(slices):
            words = fps.mapInArrow(_emit(radius, slices, current, bits), WORDS)
            met = words.repartition(tasks, "bucket").mapInArrow(_collide(radius), "a long, b long")
            met.write.mode("append").parquet(target)


def _labelled(fps: DataFrame, links: DataFrame) -> DataFrame:
    """``(fp, label)``: the root of the group that the links form, where it has at least ``DENSE`` members."""
    stars = freeze(star_components(links))
    dense = stars.groupBy("root").count().where(F.col("count") >= DENSE - 1).select("root")
    members = stars.join(dense, "root", "left_semi").select(F.col("node").alias("fp"), F.col("root").alias("label"))
    members = members.unionByName(dense.select(F.col("root").alias("fp"), F.col("root").alias("label")))
    return fps.join(members, "fp", "left")


def near_links(fps: DataFrame, radius: int = RADIUS, slices: int = SLICES) -> DataFrame:
    """Links ``(a, b)`` that connect all fingerprints (distinct longs in column ``fp``) at
    most ``radius`` bits apart: every such pair is linked by a path of listed links, and every
    listed link is such a pair. Stored, distinct up to repeats between slices and tasks. ``radius`` is even."""
    spark = fps.sparkSession
    if slices & (slices - 1) or radius % 2:
        raise ValueError("slices must be a power of two, and radius even")
    n = fps.count()
    tasks = max(spark.sparkContext.defaultParallelism, n // (16 * BLOCK))
    spread = freeze(fps.select("fp", F.lit(None).cast("long").alias("label")).repartition(tasks))
    target = new_folder(spark, "links")
    schema = "a long, b long"
    first = radius // 4 * 2  # the even radius up to half of it
    if first:
        _met(spread, n, first, 1, target)
        spread = freeze(_labelled(spread.select("fp"), spark.read.schema(schema).parquet(target)).repartition(tasks))
    _met(spread, n, radius, slices, target)
    return spark.read.schema(schema).parquet(target)


def _rooted(found: DataFrame, first: Column, radius: int, slices: int) -> DataFrame:
    """``(fp, first, root)`` per fingerprint: an aggregate of its rows and the fingerprint that
    stands for its component."""
    fps = freeze(found.groupBy("fp").agg(first.alias("first")))
    stars = star_components(near_links(fps, radius, slices))
    return fps.join(stars, fps["fp"] == stars["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", radius: int = RADIUS,
                    slices: int = SLICES) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` per row of ``docs``: the fingerprint as 16
    hexadecimal digits, and the smallest doc_id that links of at most ``radius`` bits reach.

    Null and empty texts, and texts of white space only, have fingerprint 0 and are linked like
    any other. Rows with a null doc_id are linked too, but a component only takes their id
    (null) if it has no other. Repeated rows stay repeated. An empty table gives an empty one.
    """
    found = freeze(fingerprints(docs, doc_id, text))
    rooted = _rooted(found, F.min("doc_id"), radius, slices)
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = freeze(rooted.join(least, "root").select("fp", "component_id"))
    return found.join(classes, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", radius: int = RADIUS,
             slices: int = SLICES) -> DataFrame:
    """One row of each component of near-duplicates, with all columns as they are.

    The row with the smallest doc_id stays; rows without an id come last, ties are decided by the SHA-256 of the text, a
    null text first, and of rows that agree in both any one stays. Null, empty and white texts are one component. Columns
    of any name may be there. An empty table gives an empty one.
    """
    names = docs.columns
    key = F.struct(F.col(doc_id).isNull().alias("missing"), F.col(doc_id).alias("id"), F.sha2(F.col(text), 256).alias("tie"))
    found = freeze(fingerprints(docs.select(key.alias("key"), F.col(text).alias("words")), "key", "words"))
    chosen = _rooted(found, F.min("doc_id"), radius, slices).groupBy("root").agg(F.min("first").alias("key"))
    # ids may be null within the key, so it is compared as a whole
    flat = lambda c: F.to_json(c, {"ignoreNullFields": "false"})
    counted = found.groupBy(flat(F.col("doc_id")).alias("key")).count()
    kept = freeze(counted.join(chosen.select(flat(F.col("key")).alias("key")), "key"))
    rows = docs.select(F.struct(*[F.col(f"`{n}`") for n in names]).alias("row"), flat(key).alias("key"))
    one = rows.join(kept.where("count = 1"), "key", "left_semi")
    repeated = kept.where("count > 1")
    if not repeated.isEmpty():
        one = one.unionByName(rows.join(repeated, "key", "left_semi").dropDuplicates(["key"]))
    return one.select(*[F.col("row")[n].alias(n) for n in names])
