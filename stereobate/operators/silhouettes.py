"""Exact areas of what triangles cover in any view, and silhouettes of two models laid over each other.

The area of a union follows from its boundary alone: each triangle side gives the part of it that no other triangle
covers, and those parts, walked with the triangles on their left, enclose the union. A side is cut into pieces by grid
cells and meets only the triangles of a piece's own cell, so no pair of distant triangles is formed, no distinct
follows, and a window holds what covers one piece of one side.

Corners are integers (multiples of a grid step), so whether a side lies along another triangle's side is decided
exactly; coordinates may reach 10^9 steps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from stereobate.operators.spatial import cells

#: Views by name: the weights of x, y, z in the picture's two axes.
VIEWS = {"top": ((1.0, 0.0, 0.0), (0.0, 1.0, 0.0)), "front": ((1.0, 0.0, 0.0), (0.0, 0.0, 1.0)), "side": ((0.0, 1.0, 0.0), (0.0, 0.0, 1.0))}
FLAT = ["ax", "ay", "bx", "by", "cx", "cy"]


def _turn(ux: Column, uy: Column, vx: Column, vy: Column) -> Column:
    return ux * vy - uy * vx


def projected(tris: DataFrame, on: list[str], views: dict = VIEWS, step: float = 1e-3) -> DataFrame:
    """``on.., view, ax, ay, bx, by, cx, cy``: triangles (``ax..cz``) in each view, in whole steps and counter-clockwise.

    Triangles seen from their edge go, and equal ones come once (front and back of a body). Those with a null corner go.
    """
    axis = lambda w: F.struct(*[F.lit(float(v)).alias(c) for v, c in zip(w, "xyz")])
    listed = F.array(*[F.struct(F.lit(name).alias("view"), axis(u).alias("u"), axis(v).alias("v")) for name, (u, v) in views.items()])

    def at(corner: str, w: str) -> Column:
        return F.round(sum((F.col(f"_w.{w}.{c}") * F.col(f"{corner}{c}") for c in "xyz"), F.lit(0.0)) / step).cast("long")

    seen = tris.select(*on, *[f"{k}{c}" for k in "abc" for c in "xyz"], F.explode(listed).alias("_w"))
    seen = seen.select(*on, "_w.view", *[at(k, w).alias(f"{k}{'x' if w == 'u' else 'y'}") for k in "abc" for w in "uv"])
    p = [F.struct(F.col(f"{k}x").alias("x"), F.col(f"{k}y").alias("y")) for k in "abc"]
    turn = _turn(F.col("bx") - F.col("ax"), F.col("by") - F.col("ay"), F.col("cx") - F.col("ax"), F.col("cy") - F.col("ay"))
    seen = seen.withColumn("_p", F.when(turn > 0, F.array(*p)).when(turn < 0, F.array(p[0], p[2], p[1]))).where("_p is not null")
    # The least corner first, so that equal triangles are equal rows.
    least = F.array_position("_p", F.array_min("_p")).cast("int")
    order = F.when(least == 1, F.col("_p")).otherwise(F.concat(F.slice("_p", least, 4 - least), F.slice("_p", 1, least - 1)))
    ring = seen.select(*on, "view", order.alias("_p"))
    return ring.select(*on, "view", *[F.col("_p")[i][c].alias(f"{k}{c}") for i, k in enumerate("abc") for c in "xy"]).distinct()


def _sides_seen(met: DataFrame, keep: list[str]) -> DataFrame:
    """``keep..`` and, for each side of the triangle a, b, c: on which side of it p and q lie (``f0, f1``: positive within,
    0 on it) and whether it runs the way of p -> q (``same``)."""
    px, py, qx, qy = (F.col(c) for c in ("px", "py", "qx", "qy"))
    found = []
    for k, n in ("ab", "bc", "ca"):
        kx, ky = F.col(f"{k}x"), F.col(f"{k}y")
        dx, dy = F.col(f"{n}x") - kx, F.col(f"{n}y") - ky
        found += [_turn(dx, dy, px - kx, py - ky).alias(f"{k}_f0"), _turn(dx, dy, qx - kx, qy - ky).alias(f"{k}_f1"), (dx * (qx - px) + dy * (qy - py) > 0).alias(f"{k}_same")]
    return met.select(*keep, *found)


def _covering() -> Column:
    """The shares (lo, hi) of the side p -> q that the triangle covers; null where none, as for the side's own triangle.

    A side along one of the triangle's own, with the triangle on its other side, is covered by it (both lie inside the
    union). With the triangle on the same side just one of the two may count: the one whose triangle sorts first.
    """
    lows, highs, never = [F.col("lo")], [F.col("hi")], F.lit(False)
    for k in "abc":
        f0, f1 = F.col(f"{k}_f0"), F.col(f"{k}_f1")
        meets = f0.cast("double") / F.nullif(f0.cast("double") - f1.cast("double"), F.lit(0.0))
        lows.append(F.when((f0 <= 0) & (f1 > 0), meets).otherwise(F.lit(0.0)))
        highs.append(F.when((f0 > 0) & (f1 <= 0), meets).otherwise(F.lit(1.0)))
        along = (f0 == 0) & (f1 == 0)
        never = never | (~along & (f0 <= 0) & (f1 <= 0)) | (along & F.col(f"{k}_same") & ~F.col("first"))
    return F.when(~never, F.struct(F.greatest(*lows).alias("lo"), F.least(*highs).alias("hi")))


def outline(flat: DataFrame, on: list[str], size: int) -> DataFrame:
    """``on.., px, py, qx, qy, lo, hi, covered``: sides of the triangles ``flat`` (as ``projected`` gives them, each once),
    cut by cells of ``size`` steps into the shares [lo, hi] of the side, with the share that other triangles cover."""
    whole = F.struct(*FLAT)
    # From p to q, with r the third corner: the three name the side and its triangle.
    corners = ("px", "py", "qx", "qy", "rx", "ry")
    listed = F.array(*[F.struct(*[F.col(c).alias(n) for c, n in zip(FLAT[k:] + FLAT[:k], corners)]) for k in (0, 2, 4)])
    sides = flat.select(*on, whole.alias("own"), F.explode(listed).alias("s")).select(*on, "own", "s.*")
    boxed = sides
    for c in "xy":
        boxed = boxed.withColumn(f"{c}0", F.least(f"p{c}", f"q{c}")).withColumn(f"{c}1", F.greatest(f"p{c}", f"q{c}"))
    placed = cells(boxed, [("x0", "x1"), ("y0", "y1")], size, ["i", "j"])
    lows, highs = [F.lit(0.0)], [F.lit(1.0)]
    for c, k in (("x", "i"), ("y", "j")):
        p, d = F.col(f"p{c}"), F.col(f"q{c}") - F.col(f"p{c}")
        t0, t1 = ((F.col(k) + s) * size - p for s in (0, 1))
        share = lambda t, d=d: t.cast("double") / F.nullif(d, F.lit(0)).cast("double")
        lows.append(F.when(d > 0, share(t0)).when(d < 0, share(t1)).otherwise(F.lit(0.0)))
        highs.append(F.when(d > 0, share(t1)).when(d < 0, share(t0)).otherwise(F.lit(1.0)))
    pieces = placed.withColumn("lo", F.greatest(*lows)).withColumn("hi", F.least(*highs)).where("lo < hi").drop("x0", "x1", "y0", "y1")

    spread = flat
    for c in "xy":
        spread = spread.withColumn(f"{c}0", F.least(*[f"{k}{c}" for k in "abc"])).withColumn(f"{c}1", F.greatest(*[f"{k}{c}" for k in "abc"]))
    there = cells(spread, [("x0", "x1"), ("y0", "y1")], size, ["i", "j"]).select(*on, "i", "j", whole.alias("other"), *FLAT, "x0", "x1", "y0", "y1")
    # The side's own triangle meets it too: it covers nothing, and keeps the piece in the result.
    met = pieces.join(there, [*on, "i", "j"])
    for c in "xy":
        met = met.where((F.least(f"p{c}", f"q{c}") <= F.col(f"{c}1")) & (F.greatest(f"p{c}", f"q{c}") >= F.col(f"{c}0")))
    met = met.withColumn("first", F.col("other") < F.col("own")).withColumn("mine", F.col("other") == F.col("own"))
    # A side's pieces begin at different shares. Few columns go on: what meets a piece is sorted, and that is most of the work.
    piece = [*on, *corners, "lo"]
    kept = [*piece, "hi", "mine"]
    met = _sides_seen(met, [*kept, "first"]).select(*kept, _covering().alias("c"))
    # The explode of one keeps the filter here; else it would be pushed into the join and worked out again there.
    met = met.select(*kept, F.explode(F.array("c")).alias("c")).select(*kept, F.col("c.lo").alias("_from"), F.col("c.hi").alias("_to")).where("mine or _from < _to")
    before = Window.partitionBy(*piece).orderBy("_from", "_to").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.greatest(F.col("_from"), F.coalesce(F.max("_to").over(before), F.col("_from")))
    added = met.withColumn("new", F.greatest(F.col("_to") - reached, F.lit(0.0)))
    return added.groupBy(*piece).agg(F.first("hi").alias("hi"), F.coalesce(F.sum("new"), F.lit(0.0)).alias("covered")).drop("rx", "ry")


def union_area(flat: DataFrame, on: list[str], size: int, step: float = 1e-3) -> DataFrame:
    """``on.., area``: the area that the triangles of one ``on`` cover together, each place once.

    Coordinates are taken from the least corner of their ``on``, so far-off models lose no digits.
    """
    whole = Window.partitionBy(*on)
    low = {f"_{c}": F.min(F.least(*[f"{k}{c}" for k in "abc"])).over(whole) for c in "xy"}
    moved = flat.select(*on, *FLAT, *[v.alias(n) for n, v in low.items()]).select(*on, *[(F.col(c) - F.col(f"_{c[1]}")).alias(c) for c in FLAT])
    free = F.col("hi") - F.col("lo") - F.col("covered")
    part = _turn(F.col("px"), F.col("py"), F.col("qx"), F.col("qy")).cast("double") * free
    return outline(moved, on, size).groupBy(*on).agg((F.sum(part) / 2 * step * step).alias("area"))


def compare(tris: DataFrame, on: list[str], role: str, a, b, size: int, views: dict = VIEWS, step: float = 1e-3) -> DataFrame:
    """``on.., view, area_a, area_b, union_area, shared, apart, iou``: silhouettes of the two roles of each ``on``.

    ``shared`` is the area both cover, ``apart`` what just one does. A role without area counts 0; ``iou`` is null where
    neither has any.
    """
    by = [*on, "view", "_role"]
    flat = projected(tris.where(F.col(role).isin(a, b)).withColumn("_own", F.when(F.col(role) == a, "a").otherwise("b")), [*on, "_own"], views, step)
    both = flat.withColumn("_role", F.explode(F.array("_own", F.lit("u")))).select(*by, *FLAT).distinct()
    got = union_area(both, by, size, step).groupBy(*on, "view").agg(*[F.coalesce(F.max(F.when(F.col("_role") == r, F.col("area"))), F.lit(0.0)).alias(n) for r, n in (("a", "area_a"), ("b", "area_b"), ("u", "union_area"))])
    shared = F.col("area_a") + F.col("area_b") - F.col("union_area")
    return got.withColumn("shared", shared).withColumn("apart", F.col("union_area") - F.col("shared")).withColumn("iou", F.col("shared") / F.nullif(F.col("union_area"), F.lit(0.0)))
