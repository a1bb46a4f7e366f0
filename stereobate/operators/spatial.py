"""Intervals, boxes, nearest and covering rows. Joins go over cells or bounded rule tables, never over all pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from stereobate.functions.exprs import overlap
from stereobate.operators.topology import SALTS, cut

#: Rule tables (levels, ranges, masses of one site) up to this number of rows are broadcast.
RULE_ROWS = 100_000


def bounded(rules: DataFrame) -> DataFrame:
    """The rule table with a broadcast hint if its counted size allows one; else Spark chooses the join."""
    return F.broadcast(rules) if rules.limit(RULE_ROWS + 1).count() <= RULE_ROWS else rules


def bbox(points: DataFrame, by: list[str]) -> DataFrame:
    return points.groupBy(*by).agg(*[f(c).alias(f"{c}{i}") for c in "xyz" for i, f in enumerate((F.min, F.max))])


def to_storey(df: DataFrame, levels: DataFrame, z: str, on: list[str]) -> DataFrame:
    """Rows with the ``level`` of their own ``on`` (a model) whose span [elev, next elev) holds ``z``.

    Rows below the lowest level of their model have none and go.
    """
    ladder = Window.partitionBy(*on).orderBy("elev")
    spans = levels.select(*on, "level", F.col("elev").alias("_lo"), F.lead("elev", 1, float("inf")).over(ladder).alias("_hi"))
    met = df.join(bounded(spans), on)
    return met.where((F.col(z) >= F.col("_lo")) & (F.col(z) < F.col("_hi"))).drop("_lo", "_hi")


#: Where a shifted grid's borders lie, in cells: what is built stands mostly at round places, and on a border of two cells it
#: would lie in both.
OFF_ROUND = 0.382


def cells(df: DataFrame, ranges: list[tuple[str, str]], size: float, names: list[str], reach: float = 0.0, shift: float = 0.0) -> DataFrame:
    """A row for each grid cell that the row's box, grown by ``reach``, touches; the grid lies ``shift`` lower."""
    for (lo, hi), name in zip(ranges, names):
        first = F.floor((F.col(lo) - reach + shift) / size).cast("long")
        last = F.floor((F.col(hi) + reach + shift) / size).cast("long")
        df = df.withColumn(name, F.explode(F.sequence(first, last)))
    return df


def box_pairs(boxes: DataFrame, size: float, gap: float = 0.0, axes: str = "xyz", keep: tuple[str, ...] = ()) -> DataFrame:
    """``model_id, a, b`` (a < b): boxes that overlap or come within ``gap`` in every axis; ids are ``face_id``.

    Boxes meet in grid cells of ``size``; a pair counts in the cell of its shared low corner only, so that no
    distinct is needed. The columns ``keep`` of both come along as ``a_``.. and ``b_``..: pairs are many more than boxes,
    so nothing should be joined to them afterwards.
    """
    names = [f"c{c}" for c in axes]
    shift = OFF_ROUND * size
    placed = cells(boxes, [(f"{c}0", f"{c}1") for c in axes], size, names, gap / 2, shift)
    cols = [*[f"{c}{i}" for c in axes for i in "01"], *keep]
    left = placed.select("model_id", *names, F.col("face_id").alias("a"), *[F.col(c).alias(f"a_{c}") for c in cols])
    right = placed.select("model_id", *names, F.col("face_id").alias("b"), *[F.col(c).alias(f"b_{c}") for c in cols])
    met = left.join(right.hint("merge"), ["model_id", *names]).where("a < b")
    for c in axes:
        met = met.where((F.col(f"a_{c}0") - gap <= F.col(f"b_{c}1")) & (F.col(f"b_{c}0") - gap <= F.col(f"a_{c}1")))
        owner = F.floor((F.greatest(f"a_{c}0", f"b_{c}0") - gap / 2 + shift) / size)
        met = met.where(F.col(f"c{c}") == owner)
    return met.select("model_id", "a", "b", *[f"{k}_{c}" for c in keep for k in "ab"], *[overlap(F.col(f"a_{c}0"), F.col(f"a_{c}1"), F.col(f"b_{c}0"), F.col(f"b_{c}1")).alias(f"shared_{c}") for c in axes])


def outside(points: DataFrame, rects: DataFrame, tol: float) -> DataFrame:
    """Points that no rectangle (x0, x1, y0, y1), grown by ``tol``, holds."""
    held = (F.col("x") >= F.col("x0") - tol) & (F.col("x") <= F.col("x1") + tol) & (F.col("y") >= F.col("y0") - tol) & (F.col("y") <= F.col("y1") + tol)
    return points.join(bounded(rects.select("x0", "x1", "y0", "y1")), held, "left_anti")


def square_to_segment(x: Column, y: Column, px: Column, py: Column, qx: Column, qy: Column) -> Column:
    """The squared distance in the plane from (x, y) to the segment from p to q."""
    dx, dy = qx - px, qy - py
    t = F.coalesce(((x - px) * dx + (y - py) * dy) / F.nullif(dx * dx + dy * dy, F.lit(0.0)), F.lit(0.0))
    t = F.least(F.greatest(t, F.lit(0.0)), F.lit(1.0))
    ox, oy = x - px - t * dx, y - py - t * dy
    return ox * ox + oy * oy


def to_segment(x: Column, y: Column, px: Column, py: Column, qx: Column, qy: Column) -> Column:
    """Distance in the plane from (x, y) to the segment from p to q, to 9 digits, so that equal distances are equal."""
    dx, dy = qx - px, qy - py
    t = F.coalesce(((x - px) * dx + (y - py) * dy) / F.nullif(dx * dx + dy * dy, F.lit(0.0)), F.lit(0.0))
    t = F.least(F.greatest(t, F.lit(0.0)), F.lit(1.0))
    return F.round(F.hypot(x - px - t * dx, y - py - t * dy), 9)


def nearest(left: DataFrame, right: DataFrame, on: list[str], axes: list[tuple[str, str, str, str]], distance: Column, key: str, tie: list[str], size: float) -> DataFrame:
    """``on.., key, distance`` and the columns of ``right``: for each ``key`` the ``right`` row of the same ``on`` with the
    least ``distance``, then the least ``tie``. Rows without a ``right`` row of their ``on`` are left out.

    ``axes`` names the extents along each axis, of ``left`` and of ``right`` (low, high); ``distance`` is never less than
    the gap between the extents along one axis. The search goes over grids of cells of ``size``, twice that, and so on:
    each meets what lies within its reach, and a row is done where its best lies within the reach too, as nothing nearer
    can lie beyond. Only the others go on; the last grid reaches over all extents. A grid's cells grow with its reach, so
    a row lies in few cells of each. Pairs whose ``distance`` is null don't count.
    """
    cols = [c for c in right.columns if c not in on]
    right = cut(right)  # every grid reads it
    todo = cut((left.join(right.select(*on).distinct(), on, "left_semi") if on else left))
    ends = lambda df, lo, hi: [f(F.col(c)).alias(f"{c}_{i}") for i, (f, c) in enumerate(((F.min, lo), (F.max, hi)))]
    whole = 0.0
    for llo, lhi, rlo, rhi in axes:
        a, b = left.agg(*ends(left, llo, lhi)).first(), right.agg(*ends(right, rlo, rhi)).first()
        if a[0] is not None and b[0] is not None:
            whole = max(whole, a[1] - b[0], b[1] - a[0])
    done, reach = None, size
    while True:
        last = reach > whole
        names = [f"_c{i}" for i in range(len(axes))]
        at = cells(todo, [(x[0], x[1]) for x in axes], 2 * reach, names, reach)
        there = cells(right, [(x[2], x[3]) for x in axes], 2 * reach, names)
        # The least of structs sorts what it meets, so pairs that can't be the answer go before.
        if not on:  # few wide cells hold all: the rows of each are dealt over tasks, that no small size merges
            names = [*names, "_deal"]
            at = at.withColumn("_deal", F.pmod(F.xxhash64(key), F.lit(SALTS))).repartition(4 * SALTS, *names).hint("merge")
            there = there.withColumn("_deal", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
        met = at.join(there, [*on, *names])
        for llo, lhi, rlo, rhi in axes:
            met = met.where((F.col(llo) - F.col(rhi) <= reach) & (F.col(rlo) - F.col(lhi) <= reach))
        met = met.withColumn("distance", distance).where(F.col("distance").isNotNull() if last else F.col("distance") <= reach)
        best = met.groupBy(*on, key).agg(F.min_by(F.struct("distance", *cols), F.struct("distance", *tie)).alias("n")).select(*on, key, "n.*")
        best = cut(best)
        done = best if done is None else done.unionByName(best)
        if last:
            return done
        todo = cut(todo.join(best.select(*on, key), [*on, key], "left_anti"))
        if todo.isEmpty():
            return done
        reach *= 2


def nearest_wall(points: DataFrame, walls: DataFrame, on: list[str], half_width: float, slack: float, size: float) -> DataFrame:
    """``on.., point_id, wall, distance, fits``: the nearest wall among those whose span holds the element, else of all.

    ``points(on.., point_id, x, y)``, ``walls(on.., wall, px, py, qx, qy)``. A wall's span holds an element if the point,
    ``half_width`` to either side along the wall, lies between its ends to within ``slack``. Ties go to the smaller wall.
    A point that no span holds meets every wall of its ``on`` before that is known; such points are few.
    """
    boxed = walls.select(*on, "wall", "px", "py", "qx", "qy", F.least("px", "qx").alias("wx0"), F.greatest("px", "qx").alias("wx1"), F.least("py", "qy").alias("wy0"), F.greatest("py", "qy").alias("wy1"))
    c = F.col
    length = F.hypot(c("qx") - c("px"), c("qy") - c("py"))
    along = ((c("x") - c("px")) * (c("qx") - c("px")) + (c("y") - c("py")) * (c("qy") - c("py"))) / F.nullif(length, F.lit(0.0))
    fits = (along - half_width >= -slack) & (along + half_width <= length + slack)
    distance = to_segment(c("x"), c("y"), c("px"), c("py"), c("qx"), c("qy"))
    axes = [("x", "x", "wx0", "wx1"), ("y", "y", "wy0", "wy1")]
    spanned = nearest(points, boxed, on, axes, F.when(fits, distance), "point_id", ["wall"], size).where("distance is not null")
    rest = points.join(spanned.select(*on, "point_id"), [*on, "point_id"], "left_anti")
    any_ = nearest(rest, boxed, on, axes, distance, "point_id", ["wall"], size)
    shown = lambda df, held: df.select(*on, "point_id", "wall", "distance", F.lit(held).alias("fits"))
    return shown(spanned, True).unionByName(shown(any_, False))


def covers(points: DataFrame, polygons: DataFrame, size: float) -> DataFrame:
    """``point_id, face_id``: points strictly inside polygons by the crossing number, over plan cells of ``size``.

    ``polygons``: ``face_id, sides array<struct<x, y, x2, y2>>, x0, x1, y0, y1``; a ``face_id`` names one polygon. Points at
    one place and polygons of one shape are tested once; only what holds is then spread over all of them.
    """
    box = ["x0", "x1", "y0", "y1"]
    # The least face of a shape stands for it.
    faces = polygons.select("face_id", F.min("face_id").over(Window.partitionBy("sides", *box)).alias("shape"))
    shapes = polygons.groupBy("sides", *box).agg(F.min("face_id").alias("shape"))
    placed = cells(shapes, [("x0", "x1"), ("y0", "y1")], size, ["cx", "cy"])
    places = points.select("x", "y").distinct()
    at = places.withColumn("cx", F.floor(F.col("x") / size).cast("long")).withColumn("cy", F.floor(F.col("y") / size).cast("long"))
    met = at.join(placed, ["cx", "cy"]).where((F.col("x") >= F.col("x0")) & (F.col("x") <= F.col("x1")) & (F.col("y") >= F.col("y0")) & (F.col("y") <= F.col("y1")))
    x, y = F.col("x"), F.col("y")
    hits = F.filter("sides", lambda s: ((s["y"] > y) != (s["y2"] > y)) & (x < s["x"] + (y - s["y"]) / F.nullif(s["y2"] - s["y"], F.lit(0.0)) * (s["x2"] - s["x"])))
    held = met.where(F.size(hits) % 2 == 1).select("x", "y", "shape")
    return held.join(points, ["x", "y"]).select("point_id", "shape").join(faces, "shape").select("point_id", "face_id")


def top_surface(points: DataFrame, tris: DataFrame, size: float) -> DataFrame:
    """``point_id, z, face_id, extrapolated``: the highest triangle over each plan point.

    Where none is, the plane of the triangle nearest in plan is carried on to the point (``extrapolated``); ties go to the
    higher plane there, then to the smaller face. Upright triangles take no part. Points at one place are looked at once,
    and of level triangles with the same corners in plan only the highest.
    """
    places = points.groupBy("x", "y").agg(F.min("point_id").alias("point_id"))
    plan = ["ax", "ay", "bx", "by", "cx", "cy"]
    level = F.coalesce((F.col("az") == F.col("bz")) & (F.col("bz") == F.col("cz")), F.lit(False))
    highest = tris.where(level).groupBy(*plan, "az").agg(F.min("face_id").alias("face_id")).groupBy(*plan).agg(F.max_by("face_id", "az").alias("face_id"), F.max("az").alias("az"))
    tris = tris.where(~level).select("face_id", *plan, "az", "bz", "cz").unionByName(highest.select("face_id", *plan, "az", F.col("az").alias("bz"), F.col("az").alias("cz")))
    lo = lambda c: F.least(f"a{c}", f"b{c}", f"c{c}")
    hi = lambda c: F.greatest(f"a{c}", f"b{c}", f"c{c}")
    boxed = tris.select("face_id", *[f"{k}{c}" for k in "abc" for c in "xyz"], lo("x").alias("x0"), hi("x").alias("x1"), lo("y").alias("y0"), hi("y").alias("y1"))
    placed = cells(boxed, [("x0", "x1"), ("y0", "y1")], size, ["cx_", "cy_"])
    at = places.withColumn("cx_", F.floor(F.col("x") / size).cast("long")).withColumn("cy_", F.floor(F.col("y") / size).cast("long"))
    c = F.col
    d = (c("by") - c("cy")) * (c("ax") - c("cx")) + (c("cx") - c("bx")) * (c("ay") - c("cy"))
    u = ((c("by") - c("cy")) * (c("x") - c("cx")) + (c("cx") - c("bx")) * (c("y") - c("cy"))) / d
    v = ((c("cy") - c("ay")) * (c("x") - c("cx")) + (c("ax") - c("cx")) * (c("y") - c("cy"))) / d
    met = at.join(placed, ["cx_", "cy_"]).where(F.abs(d) > 1e-12).withColumn("u", u).withColumn("v", v).where("u >= 0 and v >= 0 and u + v <= 1")
    met = met.withColumn("z", c("u") * c("az") + c("v") * c("bz") + (1 - c("u") - c("v")) * c("cz"))
    best = met.groupBy("point_id").agg(F.max_by(F.struct("z", "face_id"), F.struct("z", (-c("face_id")).alias("f"))).alias("t"))
    over = best.select("point_id", "t.z", "t.face_id", F.lit(False).alias("extrapolated"))
    bare = places.join(best, "point_id", "left_anti")
    corner = lambda k: (c(f"{k}x"), c(f"{k}y"))
    off = F.round(F.sqrt(F.least(*[square_to_segment(c("x"), c("y"), *corner(p), *corner(q)) for p, q in ("ab", "bc", "ca")])), 9)
    sloped = boxed.where(F.abs((c("bx") - c("ax")) * (c("cy") - c("ay")) - (c("by") - c("ay")) * (c("cx") - c("ax"))) > 1e-12)
    plane = F.round(u * c("az") + v * c("bz") + (1 - u - v) * c("cz"), 9)
    met = nearest(bare, sloped, [], [("x", "x", "x0", "x1"), ("y", "y", "y0", "y1")], off, "point_id", [(-plane).alias("up"), F.col("face_id")], size)
    beside = met.join(places, "point_id").select("point_id", plane.alias("z"), "face_id", F.lit(True).alias("extrapolated"))
    found = over.unionByName(beside).join(places, "point_id").drop("point_id")
    return points.select("point_id", "x", "y").join(found, ["x", "y"]).select("point_id", "z", "face_id", "extrapolated")


def t_junctions(sides: DataFrame, vertices: DataFrame, size: float, tol: float) -> DataFrame:
    """``model_id, a, b, ax .. bz, vid``: vertices within ``tol`` of a side's interior that are not its ends.

    ``sides``: ``model_id, a, b`` with ends ``ax .. bz``, each once; ``vertices``: ``model_id, vid, x, y, z``, each once. A
    vertex lies in one cell, so a pair meets once and no distinct follows.
    """
    ends = [f"{k}{c}" for k in "ab" for c in "xyz"]
    shift = OFF_ROUND * size
    lo, hi = (lambda c: F.least(f"a{c}", f"b{c}")), (lambda c: F.greatest(f"a{c}", f"b{c}"))
    boxed = sides.select("model_id", "a", "b", *ends, *[f(c).alias(f"{c}{i}_") for c in "xyz" for i, f in enumerate((lo, hi))])
    placed = cells(boxed, [(f"{c}0_", f"{c}1_") for c in "xyz"], size, ["i", "j", "k"], tol, shift).select("model_id", "i", "j", "k", "a", "b", *ends)
    at = vertices.select("model_id", "vid", *"xyz", *[F.floor((F.col(c) + shift) / size).cast("long").alias(n) for c, n in zip("xyz", "ijk")])
    met = at.join(placed.hint("merge"), ["model_id", "i", "j", "k"]).where("vid <> a and vid <> b")
    for c in "xyz":
        met = met.where((F.col(c) >= lo(c) - tol) & (F.col(c) <= hi(c) + tol))
    d = [F.col(f"b{c}") - F.col(f"a{c}") for c in "xyz"]
    w = [F.col(c) - F.col(f"a{c}") for c in "xyz"]
    span = d[0] ** 2 + d[1] ** 2 + d[2] ** 2
    t = (w[0] * d[0] + w[1] * d[1] + w[2] * d[2]) / span
    off = sum(((w[i] - t * d[i]) ** 2 for i in range(1, 3)), (w[0] - t * d[0]) ** 2)
    return met.where(span > 0).where((t * F.sqrt(span) > tol) & ((1 - t) * F.sqrt(span) > tol) & (off <= tol * tol)).select("model_id", "a", "b", *ends, "vid")


def nested(outer: DataFrame, inner: DataFrame, on: list[str], tol: float, size: float) -> DataFrame:
    """Pairs where an inner interval box lies in an outer one, to within ``tol``; x and z ranges, ids ``outer``/``inner``.

    The outer's cells hold the inner's low corner, which lies in one cell, so that a pair meets once.
    """
    o = cells(outer, [("x0", "x1"), ("z0", "z1")], size, ["_i", "_k"], tol).select(*on, "_i", "_k", F.col("face_id").alias("outer"), *[F.col(c).alias(f"o_{c}") for c in ("x0", "x1", "z0", "z1")])
    i = inner.select(*on, *[F.floor(F.col(c) / size).cast("long").alias(n) for c, n in (("x0", "_i"), ("z0", "_k"))], F.col("face_id").alias("inner"), *[F.col(c).alias(f"i_{c}") for c in ("x0", "x1", "z0", "z1")])
    met = o.join(i, [*on, "_i", "_k"]).where("outer <> inner")
    for c in "xz":
        met = met.where((F.col(f"i_{c}0") >= F.col(f"o_{c}0") - tol) & (F.col(f"i_{c}1") <= F.col(f"o_{c}1") + tol))
    return met.select(*on, "outer", "inner")
