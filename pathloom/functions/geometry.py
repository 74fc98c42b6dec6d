"""Column expressions on positions and ids."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def whole(value: Column) -> Column:
    """Text such as ``12.0`` to an integer, cutting the fraction; NULL if it is no number."""
    return value.try_cast("double").try_cast("bigint")


def scale(value: Column, factor: float) -> Column:
    return value * F.lit(float(factor))


def dist2(ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    dx, dy = ax - bx, ay - by
    return dx * dx + dy * dy


def dist(ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    return F.sqrt(dist2(ax, ay, bx, by))


def grid_cell(value: Column, size: float) -> Column:
    """Index of the grid cell that holds the coordinate (floor, also below zero)."""
    return F.floor(value / F.lit(float(size)))


def dot(ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    return ax * bx + ay * by


def turns_back(a: tuple[Column, Column], b: tuple[Column, Column], c: tuple[Column, Column]) -> Column:
    """True where the angle at ``b`` is below 90 degrees. A repeated point gives False."""
    return dot(a[0] - b[0], a[1] - b[1], c[0] - b[0], c[1] - b[1]) > 0


def within_angle(ax: Column, ay: Column, bx: Column, by: Column, degrees: float) -> Column:
    """True where two non-zero vectors point the same way up to ``degrees``."""
    la, lb = F.sqrt(dot(ax, ay, ax, ay)), F.sqrt(dot(bx, by, bx, by))
    limit = F.lit(math.cos(math.radians(degrees)))
    return (la > 0) & (lb > 0) & (dot(ax, ay, bx, by) >= limit * la * lb)


def cell_position(cell: Column) -> tuple[Column, Column]:
    """Ground-plane cell number to metres. The row part keeps its fraction."""
    x = F.lit(-3.0) + F.lit(0.025) * F.pmod(cell, F.lit(480)).cast("double")
    y = F.lit(-9.0) + F.lit(0.025) * (cell.cast("double") / F.lit(480.0))
    return x, y
