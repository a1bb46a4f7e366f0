"""Column expressions for geometry; nulls in, null out."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def cell(value: Column, size: float) -> Column:
    """Grid cell by rounding half to even, as numpy rounds."""
    return F.bround(value / size).cast("long")


def cross(u: tuple, v: tuple) -> tuple[Column, Column, Column]:
    return u[1] * v[2] - u[2] * v[1], u[2] * v[0] - u[0] * v[2], u[0] * v[1] - u[1] * v[0]


def dot(u: tuple, v: tuple) -> Column:
    return u[0] * v[0] + u[1] * v[1] + u[2] * v[2]


def minus(u: tuple, v: tuple) -> tuple[Column, Column, Column]:
    return u[0] - v[0], u[1] - v[1], u[2] - v[2]


def length(u: tuple) -> Column:
    return F.sqrt(dot(u, u))


def corner(name: str) -> tuple[Column, Column, Column]:
    """The columns ``<name>x, <name>y, <name>z`` of one triangle corner."""
    return F.col(f"{name}x"), F.col(f"{name}y"), F.col(f"{name}z")


def udim(u: Column, v: Column) -> Column:
    """Tile number of a texture place; null outside the ten by ten tiles."""
    inside = (u >= 0) & (u < 10) & (v >= 0) & (v < 10)
    return F.when(inside, (1001 + F.floor(u) + 10 * F.floor(v)).cast("int"))


def within(a: Column, b: Column, tol: float, mode: str = "inclusive") -> Column:
    """``inclusive``: difference at most tol plus 1e-9; ``strict``: below it; ``mm``: compared in whole millimetres."""
    gap = F.abs(a - b)
    if mode == "mm":
        return F.bround(gap * 1000) <= F.lit(round(tol * 1000))
    return gap < tol if mode == "strict" else gap <= tol + 1e-9


def overlap(lo1: Column, hi1: Column, lo2: Column, hi2: Column) -> Column:
    """Length that two intervals share, 0 if none."""
    return F.greatest(F.least(hi1, hi2) - F.greatest(lo1, lo2), F.lit(0.0))
