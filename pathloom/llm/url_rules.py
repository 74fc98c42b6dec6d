"""URL rules by a sort-merge range join.

A host is keyed by its reversed labels, each followed by a dot, so that a host and all its
subdomains are one interval of keys: ``net.example.`` up to, not including, ``net.example/``.
URLs and rules are dealt to the same ranges of keys, sorted, and swept once: a stack holds the
rules whose interval is still open, nested hosts above the hosts they lie in. What the stack
offers is then compared by path; the longest rule wins.

Ranges are cut by (key, salt of the row id), so a host or even one url with a third of all rows
is spread over many ranges. A rule is copied to every range that its interval meets. The cuts
come from a sample and decide the balance only, never the result.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The rules of the query, and what holds without a rule.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
DEFAULT = "allow"

SAMPLE_PER_RANGE = 40  # sampled rows for each cut
RANGE_ROWS = 500_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(_url, instr(_url, '://') + 3)")).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def host_key(host: Column) -> Column:
    """Reversed labels, each followed by a dot."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def split_rule(rule: str) -> tuple[str, str]:
    """Host and path of a rule written as one string."""
    at = rule.find("/")
    return (rule, "") if at < 0 else (rule[:at], rule[at:])


def _cuts(keyed: DataFrame, rows: int, ranges: int) -> list[tuple[str, int]]:
    """At most ``ranges - 1`` cuts of (key, salt), from a sample of bounded size."""
    wanted = ranges * SAMPLE_PER_RANGE
    fraction = min(1.0, wanted / max(1, rows))
    sample = sorted(map(tuple, keyed.select("key", "salt").sample(fraction, seed=7).limit(2 * wanted).collect()))
    return sorted({sample[i * len(sample) // ranges] for i in range(1, ranges)}) if sample else []


def _place(cuts: list[tuple[str, int]]):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, salts = batch.column("key").to_pylist(), batch.column("salt").to_pylist()
            part = pa.array([bisect_right(cuts, pair) for pair in zip(keys, salts)], pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, part], names=[*batch.schema.names, "part"])

    return place


def _spread(cuts: list[tuple[str, int]]):
    """Copies every rule to the ranges that its interval meets."""
    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                end = row["key"][:-1] + "/"
                first, last = bisect_right(cuts, (row["key"], -(2**31))), bisect_left(cuts, (end, -(2**31)))
                rows += [row | {"part": part} for part in range(first, last + 1)]
            yield pa.RecordBatch.from_pylist(rows, schema=batch.schema.append(pa.field("part", pa.int32())))

    return spread


class _Open:
    """The rules of one host whose interval is open, by path."""

    def __init__(self, part: int, key: str):
        self.part, self.key, self.rules, self.lengths = part, key, {}, set()

    def holds(self, part: int, key: str) -> bool:
        return part == self.part and key.startswith(self.key)

    def add(self, path: str, rule: str, verdict: str) -> None:
        self.rules.setdefault(path, (rule, verdict))
        self.lengths.add(len(path))


def _longest(stack: list[_Open], path: str) -> tuple[str | None, str | None]:
    """The longest fitting rule of all open hosts; of equally long ones that of the deeper host."""
    best, size = (None, None), -1
    for host in stack:
        for length in host.lengths:
            if length <= len(path) and (hit := host.rules.get(path[:length])) and len(hit[0]) >= size:
                best, size = hit, len(hit[0])
    return best


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    stack: list[_Open] = []
    for batch in batches:
        found = {"at": [], "rule": [], "verdict": []}
        columns = [batch.column(n).to_pylist() for n in ("part", "key", "path", "rule", "verdict")]
        for at, (part, key, path, rule, verdict) in enumerate(zip(*columns)):
            while stack and not stack[-1].holds(part, key):
                stack.pop()
            if rule is not None:
                if not stack or stack[-1].key != key:
                    stack.append(_Open(part, key))
                stack[-1].add(path, rule, verdict)
                continue
            best = _longest(stack, path)
            found["at"].append(at)
            found["rule"].append(best[0])
            found["verdict"].append(best[1])
        kept = batch.select(["page_id", "host", "path"]).take(pa.array(found["at"], pa.int64()))
        yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(found["rule"], pa.string()), pa.array(found["verdict"], pa.string())],
                                         names=["page_id", "host", "path", "rule", "verdict"])


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str]] | DataFrame = RULES, default: str = DEFAULT,
               page_id: str = "page_id", url: str = "url", ranges: int | None = None) -> DataFrame:
    """``(page_id, host, path, rule, verdict)`` for every row of ``pages``.

    ``rules`` holds (verdict, rule) pairs or a table with these columns. A rule fits its host
    and all subdomains, if the path starts with the rule's. The longest rule wins; between two
    equally long ones that of the deeper host, between equal ones block before allow. Without a
    rule, ``rule`` is null and the verdict is ``default``. Null urls and urls without ``://``
    have empty host and path. Null ids and repeated rows stay. An empty table gives an empty one.
    """
    spark = pages.sparkSession
    host, path = url_parts(F.col("_url"))
    keyed = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("_url")).select(
        "page_id", host.alias("host"), path.alias("path"))
    keyed = keyed.select("page_id", "host", "path", host_key(F.col("host")).alias("key"), F.hash("page_id").alias("salt"))
    rows = pages.select(page_id).count()
    if ranges is None:
        ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), rows // RANGE_ROWS)
    cuts = _cuts(keyed, rows, ranges)

    if not isinstance(rules, DataFrame):
        rules = spark.createDataFrame([(v, r) for v, r in rules], "verdict string, rule string")
    split = rules.where("rule IS NOT NULL").select(
        "verdict", "rule", F.translate(F.regexp_extract("rule", "^([^/]*)", 1), _UPPER, _LOWER).alias("host"),
        F.regexp_extract("rule", r"^[^/]*(/[\s\S]*)?$", 1).alias("path"))
    split = split.select(F.lit(None).cast(keyed.schema["page_id"].dataType).alias("page_id"), "host", "path",
                         host_key(F.col("host")).alias("key"), F.lit(0).alias("salt"), "rule", "verdict")
    urls = keyed.select("*", F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict"))
    kind = keyed.schema["page_id"].dataType.simpleString()
    columns = f"page_id {kind}, host string, path string, key string, salt int, rule string, verdict string, part int"
    both = urls.mapInArrow(_place(cuts), columns).union(split.mapInArrow(_spread(cuts), columns))
    dealt = both.repartitionById(len(cuts) + 1, F.col("part")).sortWithinPartitions(
        "part", "key", F.col("rule").isNull(), F.col("verdict") != "block")
    judged = dealt.mapInArrow(_sweep, f"page_id {kind}, host string, path string, rule string, verdict string")
    return judged.withColumn("verdict", F.coalesce("verdict", F.lit(default)))
