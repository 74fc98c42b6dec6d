"""Formats with one position per line.

A format says how a line splits into parts and which parts hold what; parsing is then
one projection over any number of files. Lines that do not parse are not lost: ``rejects``
returns them with a reason, and ``mode="FAILFAST"`` raises on the first.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pathloom.functions.geometry import whole
from pathloom.functions.text import clock_frame, file_stem, part, tokens


@dataclass(frozen=True)
class LineFormat:
    name: str
    separator: str
    frame: Callable[[Column], Column]
    pedestrian: Callable[[Column], Column]
    x: Callable[[Column], Column]
    y: Callable[[Column], Column]
    stride: int = 1
    # Lines that are no positions of ours are skipped, not rejected.
    wanted: Callable[[Column], Column] | None = None


def _whole(index: int) -> Callable[[Column], Column]:
    return lambda parts: whole(part(parts, index))


def _real(index: int) -> Callable[[Column], Column]:
    return lambda parts: part(parts, index).try_cast("double")


def _plain(name: str, separator: str) -> LineFormat:
    return LineFormat(name, separator, _whole(0), _whole(1), _real(2), _real(3))


# The place and the sessions of the two-session format, with the offset the
# second session adds to ids and frames so that they stay apart.
STATION_PLACE = "PIW"
STATION_SESSIONS = {"T07": 0, "T17": 100_000}


def _session(parts: Column) -> Column:
    stamp = F.right(part(tokens(part(parts, 0), ":"), 0), F.lit(3))
    known = F.when(F.lit(False), F.lit(0).cast("bigint"))
    for name, offset in STATION_SESSIONS.items():
        known = known.when(stamp == name, F.lit(offset).cast("bigint"))
    return known


def _station_line(parts: Column) -> Column:
    return ((F.size(parts) == 5) & (F.size(tokens(part(parts, 0), ":")) == 4)
            & (part(parts, 1) == STATION_PLACE) & _session(parts).isNotNull())


FORMATS: dict[str, LineFormat] = {f.name: f for f in (
    LineFormat("biwi", " ", lambda p: (part(p, 0).try_cast("double") - 1).try_cast("bigint"), _whole(1), _real(2), _real(4)),
    LineFormat("mot", ",", _whole(0), _whole(1), _real(7), _real(8), stride=2),
    LineFormat("cff", ";",
               lambda p: clock_frame(tokens(part(p, 0), ":"), _session(p)),
               lambda p: _session(p) + part(p, 4).try_cast("bigint"),
               lambda p: part(p, 2).try_cast("double") / 1000.0,
               lambda p: part(p, 3).try_cast("double") / 1000.0,
               stride=4, wanted=_station_line),
    _plain("spaced", " "),
    _plain("lcas", ","),
    _plain("controlled", r",\s*"),
    _plain("standard", "\t"),
)}


def with_dataset(lines: DataFrame, dataset: str | None, default: Column) -> DataFrame:
    if "dataset" in lines.columns:
        return lines
    return lines.withColumn("dataset", F.lit(dataset) if dataset else default)


def unreadable(*columns: str) -> Column:
    """Why a row cannot be used: the columns that should hold a number and do not; null if all do."""
    bad = F.concat_ws(", ", *[F.when(F.col(c).isNull() | F.isnan(F.col(c).cast("double")), c) for c in columns])
    return F.when(bad != "", F.concat(F.lit("not a number: "), bad))


def settle(tagged: DataFrame, name: str, mode: str = "FAILFAST") -> DataFrame:
    """The readable rows of a tagged table, one with ``value`` and ``reason``. An unreadable one is an error; with ``mode="DROP"`` it is left out."""
    if mode == "FAILFAST":
        bad = F.raise_error(F.concat(F.lit(f"{name}: "), F.col("reason"), F.lit(" in line: "), F.coalesce("value", F.lit(""))))
        return tagged.withColumn("dataset", F.when(F.col("reason").isNotNull(), bad.cast("string")).otherwise(F.col("dataset")))
    return tagged.where(F.col("reason").isNull())


def tag_lines(lines: DataFrame, fmt: str, dataset: str | None = None) -> DataFrame:
    """All lines of a format that may hold a position, parsed, with the ``reason`` where that fails."""
    spec = FORMATS[fmt]
    rows = with_dataset(lines, dataset, file_stem(F.col("path"))).withColumn("_parts", tokens(F.col("value"), spec.separator))
    if spec.wanted is not None:
        rows = rows.where(F.coalesce(spec.wanted(F.col("_parts")), F.lit(False)))
    parts = F.col("_parts")
    rows = rows.select("dataset", "path", "value", spec.frame(parts).alias("frame"), spec.pedestrian(parts).alias("pedestrian"),
                       spec.x(parts).alias("x"), spec.y(parts).alias("y"))
    return rows.withColumn("reason", unreadable("frame", "pedestrian", "x", "y"))


def thinned(rows: DataFrame, stride: int) -> DataFrame:
    """Tracks of the frames that a format keeps."""
    rows = rows if stride == 1 else rows.where(F.pmod("frame", F.lit(stride)) == 0)
    return rows.select("dataset", "frame", "pedestrian", "x", "y")


def parse_lines(lines: DataFrame, fmt: str, dataset: str | None = None, mode: str = "FAILFAST") -> DataFrame:
    """Lines (path, value) of a format to tracks, thinned as the format demands. The
    dataset is the given one, a ``dataset`` column of the lines, or the file's name. A malformed line is
    an error; with ``mode="DROP"`` it is left out, to be fetched by ``rejects``."""
    return thinned(settle(tag_lines(lines, fmt, dataset), fmt, mode), FORMATS[fmt].stride)


def rejects(lines: DataFrame, fmt: str, dataset: str | None = None) -> DataFrame:
    """The lines ``parse_lines`` leaves out because they do not parse, with the reason. ``tagged.read_tagged`` gives
    both from one scan, for every format."""
    return tag_lines(lines, fmt, dataset).where(F.col("reason").isNotNull()).select("dataset", "path", "value", "reason")


def text_lines(spark: SparkSession, glob: str) -> DataFrame:
    """The lines of all matching files, with the file they come from."""
    return spark.read.text(glob).select(F.col("_metadata.file_path").alias("path"), "value")


def read_lines(spark: SparkSession, glob: str, fmt: str, dataset: str | None = None, mode: str = "FAILFAST") -> DataFrame:
    return parse_lines(text_lines(spark, glob), fmt, dataset, mode)
