"""Work in key order without ever handing one task an unbounded group.

Spark puts each window partition into one task, so a single busy pedestrian or
recording would decide the run time of a whole job. The helpers here keep the plain
window for ordinary groups and cut the few hot ones into pieces whose results are
stitched together exactly:

* ``running_totals``  - running sums (and so row numbers) over integer-ordered groups
* ``segments``        - row windows: pieces that overlap by the reach of the window
* ``number_in_order`` - consecutive ids over a total order, by one range shuffle
* ``totals_in_order`` - sums of all earlier rows over a total order, likewise
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pathloom.config import HOT_ROWS, NO_HOT_ROWS, SEGMENT_ROWS
from pathloom.storage import broadcast_if_small, freeze

# Blocks of blocks: one upper-level window holds at most this power of two of them.
UPPER_BITS = 16


def hot_groups(rows: DataFrame, keys: Sequence[str], hot_rows: int) -> DataFrame | None:
    """Groups above ``hot_rows`` rows with their size as ``_size``, or None if there is none,
    so that ordinary data keeps the ordinary plan.

    Counting reads the key columns only and combines on the map side. At most (all rows /
    hot_rows) groups qualify; the list is still counted before it is broadcast, for
    settings that make it long. With ``NO_HOT_ROWS`` nothing is counted.
    """
    if hot_rows >= NO_HOT_ROWS:
        return None
    sizes = freeze(rows.groupBy(*keys).agg(F.count("*").alias("_size")).where(F.col("_size") > hot_rows))
    return None if sizes.isEmpty() else broadcast_if_small(sizes)


def _block_offsets(blocks: DataFrame, group: list[str], names: list[str]) -> DataFrame:
    """Per block, the total of all earlier blocks of its group, in two levels."""
    blocks = blocks.withColumn("_upper", F.shiftright("_block", UPPER_BITS))
    inner = Window.partitionBy(*group, "_upper").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.partitionBy(*group).orderBy("_upper").rowsBetween(Window.unboundedPreceding, -1)
    uppers = blocks.groupBy(*group, "_upper").agg(*[F.sum(n).alias(n) for n in names])
    uppers = uppers.select(*group, "_upper", *[F.coalesce(F.sum(n).over(outer), F.lit(0)).alias(f"_u_{n}") for n in names])
    blocks = blocks.select(*group, "_upper", "_block",
                           *[F.coalesce(F.sum(n).over(inner), F.lit(0)).alias(f"_i_{n}") for n in names])
    return blocks.join(uppers, [*group, "_upper"]).select(
        *group, "_block", *[(F.col(f"_i_{n}") + F.col(f"_u_{n}")).alias(f"_before_{n}") for n in names])


def running_totals(rows: DataFrame, group: Sequence[str], key: str, totals: Mapping[str, Column],
                   ties: Sequence[str] = (), hot_rows: int | None = HOT_ROWS, block_bits: int = 12,
                   share: Sequence[str] = ()) -> DataFrame:
    """Add, for every entry of ``totals``, its sum over the group up to and including
    the row, in order of the integer ``key`` and then ``ties``.

    Groups above ``hot_rows`` (all of them for None) are split into blocks of
    ``2**block_bits`` key values. Columns in ``share`` become true for all rows of the
    same group and key as soon as one of them is.
    """
    group, ties, names = list(group), list(ties), list(totals)
    block = F.shiftright(F.col(key), block_bits)
    hot = None if hot_rows is None else hot_groups(rows, group, hot_rows)
    if hot_rows is not None and hot is None:
        whole = Window.partitionBy(*group).orderBy(key, *ties).rowsBetween(Window.unboundedPreceding, 0)
        return rows.select(*_shared(rows, share, [*group, key], ties), *[F.sum(v).over(whole).alias(n) for n, v in totals.items()])
    if hot is None:
        marked = in_blocks = rows.withColumn("_block", block)
    else:
        calm_block = F.lit(0).cast(rows.schema[key].dataType)
        marked = rows.join(hot, group, "left").withColumn(
            "_block", F.when(F.col("_size").isNotNull(), block).otherwise(calm_block)).drop("_size")
        in_blocks = rows.join(hot, group, "left_semi").withColumn("_block", block)
    parts = in_blocks.groupBy(*group, "_block").agg(*[F.sum(v).alias(n) for n, v in totals.items()])
    before = _block_offsets(parts, group, names)

    local = Window.partitionBy(*group, "_block").orderBy(key, *ties).rowsBetween(Window.unboundedPreceding, 0)
    out = marked.select(*_shared(rows, share, [*group, "_block", key], ties), "_block",
                        *[F.sum(v).over(local).alias(n) for n, v in totals.items()])
    out = out.join(before, [*group, "_block"], "left")
    return out.select(*rows.columns, *[(F.col(n) + F.coalesce(F.col(f"_before_{n}"), F.lit(0))).alias(n) for n in names])


def segments(rows: DataFrame, group: Sequence[str], key: str, ties: Sequence[str] = (),
             before: int = 0, after: int = 0, share: Sequence[str] = (), sizes_from: DataFrame | None = None,
             hot_rows: int = HOT_ROWS, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """Cut each ordered group into pieces for row windows that look at most ``before``
    rows back and ``after`` rows ahead.

    Adds ``seg`` (partition windows by the group and this), ``row_no`` (1-based place in
    the whole group) and ``own`` (False for the copies that only serve as context).
    Ordinary groups are one piece and are shuffled once, by the group. ``sizes_from`` is
    a cheaper table with the same rows per group, to find the hot ones from.
    """
    if max(before, after) >= segment_rows:
        raise ValueError("a segment must be longer than the reach of its window")
    group, ties = list(group), list(ties)
    hot = hot_groups(rows if sizes_from is None else sizes_from, group, hot_rows)
    calm = rows if hot is None else rows.join(hot, group, "left_anti")
    both = calm.select(*rows.columns, F.lit(0).cast("bigint").alias("seg"),
                       F.lit(None).cast("bigint").alias("row_no"), F.lit(True).alias("own"))
    if hot is not None:
        busy = running_totals(rows.join(hot, group, "left_semi"), group, key, {"row_no": F.lit(1)}, ties,
                              hot_rows=None, share=share)
        place = F.col("row_no") - 1
        home, spot = F.floor(place / F.lit(segment_rows)), F.pmod(place, F.lit(segment_rows))
        homes = F.array_compact(F.array(
            home,
            F.when((spot < after) & (home > 0), home - 1),
            F.when(spot >= segment_rows - before, home + 1)))
        busy = busy.withColumn("seg", F.explode(homes))
        both = both.unionByName(busy.select(*rows.columns, "seg", "row_no", (F.col("seg") == home).alias("own")))
    number = F.row_number().over(piece_window(group, key, ties)).cast("bigint")
    return both.select(*_shared(rows, share, [*group, "seg", key], ties), "seg",
                       number.alias("row_no") if hot is None else F.coalesce("row_no", number).alias("row_no"), "own")


def _shared(rows: DataFrame, share: Sequence[str], same: list[str], ties: list[str]) -> list[Column]:
    """The columns of ``rows``, those in ``share`` as the maximum over equal keys. Ordering
    by the ties keeps the one sort the other windows use."""
    peers = Window.partitionBy(*same).orderBy(*ties) if ties else Window.partitionBy(*same)
    peers = peers.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return [F.max(c).over(peers).alias(c) if c in share else F.col(c) for c in rows.columns]


def piece_window(group: Sequence[str], key: str, ties: Sequence[str] = ()):
    """The window to use on the result of ``segments``; the same everywhere, so that
    Spark shuffles and sorts once."""
    return Window.partitionBy(*group, "seg").orderBy(key, *ties)


def number_in_order(rows: DataFrame, group: Sequence[str], order: Sequence[str], name: str,
                    ties: Sequence[str] = ()) -> DataFrame:
    """Number the rows of each group 0, 1, 2 … in the given order; ``ties`` only orders rows
    that agree in all of it, which stay in one partition.

    One range shuffle sorts everything, hot groups included, into even partitions; a
    row's id is its place in its partition plus the rows of the group in earlier
    partitions. The sorted rows are written once, which fixes the partition borders.
    """
    group, order = list(group), list(order)
    placed = freeze(rows.repartitionByRange(*group, *order).sortWithinPartitions(*group, *order, *ties)
                    .withColumn("_at", F.monotonically_increasing_id()))
    placed = placed.withColumn("_part", F.shiftright("_at", 33))
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    heads = (placed.groupBy(*group, "_part").agg(F.min("_at").alias("_head"), F.count("*").alias("_rows"))
             .select(*group, "_part", (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_head")).alias("_shift")))
    return (placed.join(broadcast_if_small(heads), [*group, "_part"])
            .select(*rows.columns, (F.col("_at") + F.col("_shift")).alias(name)))


def totals_in_order(rows: DataFrame, group: Sequence[str], order: Sequence[str], value: str, name: str) -> DataFrame:
    """Add the sum of ``value`` over all earlier rows of the group in the given order. As for
    ``number_in_order``, partitions are summed on their own and shifted by the earlier ones."""
    group, order = list(group), list(order)
    placed = freeze(rows.repartitionByRange(*group, *order).withColumn("_part", F.spark_partition_id()))
    within = Window.partitionBy(*group, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = placed.groupBy(*group, "_part").agg(F.sum(value).alias("_sum")).select(
        *group, "_part", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_shift"))
    summed = placed.withColumn("_within", F.coalesce(F.sum(value).over(within), F.lit(0)))
    return summed.join(broadcast_if_small(parts), [*group, "_part"]).select(*rows.columns, (F.col("_within") + F.col("_shift")).alias(name))
