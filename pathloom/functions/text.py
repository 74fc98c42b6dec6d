"""Column expressions on file names and raw text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def tokens(value: Column, separator: str) -> Column:
    """Non-empty parts of a line; ``separator`` is a regular expression."""
    return F.filter(F.split(value, separator), lambda part: part != "")


def part(parts: Column, index: int) -> Column:
    """Part at a zero-based place, counted from the end if negative; NULL beyond the ends."""
    return F.try_element_at(parts, F.lit(index + 1 if index >= 0 else index))


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def path_id(path: Column) -> Column:
    """The number a file is named after, as in ``…/00000012.json``."""
    return F.regexp_extract(file_name(path), r"^(\d+)\.", 1).try_cast("bigint")


def file_stem(path: Column) -> Column:
    return F.regexp_replace(file_name(path), r"\.[^.]*$", "")


def folder(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -2)


def clock_frame(clock: Column, session: Column) -> Column:
    """Frame of an ``MM:SS:mmm`` clock: minutes count 1000, seconds 10, plus the first
    digit of the milliseconds, plus the offset of the session."""
    minute = part(clock, -3).try_cast("bigint")
    second = part(clock, -2).try_cast("bigint")
    tenth = F.substring(part(clock, -1), 1, 1).try_cast("bigint")
    return session + minute * 1000 + second * 10 + tenth
