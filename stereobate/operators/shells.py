"""Faces as polygons in space: overlaps, crossings, open edges and loops, slabs, merged rectangles, and gates over them.

``faces``: ``model_id, face_id, pts array<struct<x, y, z>>``, convex and plane, with their boxes ``x0 .. z1``. Pairs meet in
grid cells and count in one owner cell; the kernels are expressions over the corner arrays, so nothing leaves the JVM.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from stereobate.functions.exprs import cross, dot, length, minus
from stereobate.operators.spatial import OFF_ROUND, box_pairs, cells
from stereobate.operators.topology import components, roots

AXES = "xyz"
SIDES = [f"{c}{i}" for c in AXES for i in "01"]


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def xyz(p: Column) -> tuple[Column, Column, Column]:
    return p["x"], p["y"], p["z"]


def following(items: Column, i: Column) -> Column:
    """The item after number ``i`` of a ring."""
    return F.get(items, (i + 1) % F.size(items))


def ring_sum(items: Column, term) -> Column:
    """The sum of ``term(item, next)`` round a ring."""
    return let(items, lambda ring: F.aggregate(F.transform(ring, lambda p, i: term(p, following(ring, i))), F.lit(0.0), lambda s, t: s + t))


def signed_area(ring: Column) -> Column:
    """Area of a plane ring of structs (u, v), positive where it turns left; the ring should be a column or bound."""
    return let(ring, lambda r: ring_sum(r, lambda p, q: p["u"] * q["v"] - q["u"] * p["v"]) / 2)


def clip_convex(ring: Column, window: Column) -> Column:
    """What of the plane ring lies in the convex window, which turns left; both are arrays of structs (u, v).

    The ring is cut by the line of each window side in turn.
    """

    def cut(poly: Column, side: Column) -> Column:
        off = lambda p: (side["q"]["u"] - side["p"]["u"]) * (p["v"] - side["p"]["v"]) - (side["q"]["v"] - side["p"]["v"]) * (p["u"] - side["p"]["u"])

        def ends(p: Column, q: Column, o: Column) -> Column:
            share = o["p"] / F.nullif(o["p"] - o["q"], F.lit(0.0))
            at = F.struct((p["u"] + share * (q["u"] - p["u"])).alias("u"), (p["v"] + share * (q["v"] - p["v"])).alias("v"))
            return F.filter(F.array(F.when((o["p"] >= 0) != (o["q"] >= 0), at), F.when(o["q"] >= 0, q)), lambda x: x.isNotNull())

        def piece(p: Column, i: Column) -> Column:
            return let(following(poly, i), lambda q: let(F.struct(off(p).alias("p"), off(q).alias("q")), lambda o: ends(p, q, o)))

        return F.flatten(F.transform(poly, piece))

    sides = let(window, lambda w: F.transform(w, lambda p, i: F.struct(p.alias("p"), following(w, i).alias("q"))))
    return F.aggregate(sides, ring, cut)


def with_planes(faces: DataFrame) -> DataFrame:
    """Adds the unit normal ``nx, ny, nz``, the offset ``d`` of the plane, and ``area``."""
    area = {"nx": ("y", "z"), "ny": ("z", "x"), "nz": ("x", "y")}
    vector = let(F.col("pts"), lambda ring: F.struct(*[(ring_sum(ring, lambda p, q, a=a, b=b: p[a] * q[b] - p[b] * q[a]) / 2).alias(k) for k, (a, b) in area.items()]))

    def plane(v: Column, size: Column) -> Column:
        n = tuple(v[k] / size for k in area)
        return F.struct(*[x.alias(k) for k, x in zip(area, n)], size.alias("area"), dot(n, xyz(F.col("pts")[0])).alias("d"))

    found = let(vector, lambda v: let(length(tuple(v[k] for k in area)), lambda size: F.when(size > 0, plane(v, size))))
    out = faces.select("*", F.explode(F.array(found)).alias("plane"))  # the explode of one: the filter doesn't work it out again
    return out.where("plane is not null").select(*faces.columns, "plane.*")


def _paired(faces: DataFrame, size: float, gap: float) -> DataFrame:
    """``model_id, a, b`` (a < b) and the planes of both, a_* and b_*, where the boxes come within ``gap``."""
    return box_pairs(with_planes(faces), size, gap, keep=("pts", "nx", "ny", "nz", "d"))


def _normal(k: str) -> tuple[Column, Column, Column]:
    return F.col(f"{k}_nx"), F.col(f"{k}_ny"), F.col(f"{k}_nz")


def overlaps(faces: DataFrame, tol: float, cos_min: float, area_min: float, size: float) -> DataFrame:
    """``model_id, a, b, area``: near-parallel faces closer than ``tol`` whose projections share ``area_min`` or more."""
    met = _paired(faces, size, tol).where(F.abs(dot(_normal("a"), _normal("b"))) > cos_min)
    met = met.where(F.abs(dot(_normal("a"), minus(xyz(F.col("b_pts")[0]), xyz(F.col("a_pts")[0])))) < tol)
    x, y, z = (F.abs(c) for c in _normal("a"))
    drop = F.when((x >= y) & (x >= z), 0).when(y >= z, 1).otherwise(2)
    flat = lambda pts: F.transform(pts, lambda p: F.when(drop == 0, F.struct(p["y"].alias("u"), p["z"].alias("v"))).when(drop == 1, F.struct(p["x"].alias("u"), p["z"].alias("v"))).otherwise(F.struct(p["x"].alias("u"), p["y"].alias("v"))))
    turned = lambda w: F.when(signed_area(w) >= 0, w).otherwise(F.reverse(w))
    # One expression with every array bound once: a filter on it may be computed twice, but not its parts again and again.
    area = let(flat(F.col("a_pts")), lambda ring: let(let(flat(F.col("b_pts")), turned), lambda w: F.abs(signed_area(clip_convex(ring, w)))))
    # The explode of one keeps the filter here; else it would be pushed into the join and worked out again there.
    return met.select("model_id", "a", "b", F.explode(F.array(area)).alias("area")).where(F.col("area") >= area_min)


def _inward(pts: Column, n: tuple) -> Column:
    """For each side of a face that turns left about ``n``: its start, and the unit vector from it into the face."""

    def one(p: Column, q: Column) -> Column:
        across = F.struct(*[x.alias(c) for c, x in zip(AXES, cross(n, minus(xyz(q), xyz(p))))])
        return let(across, lambda m: let(F.nullif(length(xyz(m)), F.lit(0.0)), lambda size: F.struct(p.alias("p"), *[(m[c] / size).alias(c) for c in AXES])))

    return let(pts, lambda ring: F.transform(ring, lambda p, i: let(following(ring, i), lambda q: one(p, q))))


def crossings(faces: DataFrame, min_len: float, edge_excl: float, size: float) -> DataFrame:
    """``model_id, a, b, length``: faces that cross along more than ``min_len``, ``edge_excl`` off their edges.

    The line of both planes is cut by the sides of either face, moved inwards; what is left of both is the crossing.
    """
    met = _paired(faces, size, 0.0)
    na, nb = _normal("a"), _normal("b")
    way = let(F.struct(*[w.alias(c) for c, w in zip(AXES, cross(na, nb))]), lambda w: F.struct(w.alias("w"), length(xyz(w)).alias("sine")))

    def line(s: Column) -> Column:
        """The unit direction w of the line of both planes, and a place o on it."""
        w, sine = xyz(s["w"]), s["sine"]
        of_a, of_b = cross(nb, w), cross(w, na)
        o = [((F.col("a_d") * of_a[k] + F.col("b_d") * of_b[k]) / sine**2).alias(c) for k, c in enumerate(AXES)]
        return F.struct(F.struct(*o).alias("o"), F.struct(*[(w[k] / sine).alias(c) for k, c in enumerate(AXES)]).alias("w"))

    def inside(k: str, at: Column) -> Column:
        """Where the line runs in face ``k``, moved inwards: lo and hi, null if nowhere."""
        # How deep the line's place lies behind each side, and how fast a point on the line goes deeper.
        cuts = F.transform(_inward(F.col(f"{k}_pts"), _normal(k)), lambda s: F.struct((dot(xyz(s), minus(xyz(at["o"]), xyz(s["p"]))) - edge_excl).alias("deep"), dot(xyz(s), xyz(at["w"])).alias("rate")))
        ends = lambda c, sign: F.transform(F.filter(c, lambda s: s["rate"] * sign > 1e-9), lambda s: -s["deep"] / s["rate"])
        beside = lambda c: F.forall(c, lambda s: (F.abs(s["rate"]) > 1e-9) | (s["deep"] >= 0))
        return let(cuts, lambda c: F.when(beside(c), F.struct(F.array_max(ends(c, 1)).alias("lo"), F.array_min(ends(c, -1)).alias("hi"))))

    both = lambda at: let(inside("a", at), lambda i: let(inside("b", at), lambda j: F.when(i.isNotNull() & j.isNotNull(), F.least(i["hi"], j["hi"]) - F.greatest(i["lo"], j["lo"]))))
    reach = let(way, lambda s: F.when(s["sine"] > 1e-6, let(line(s), both)))
    # The explode of one keeps the filter here; else it would be pushed into the join and worked out again there.
    return met.where(length(cross(na, nb)) > 1e-6).select("model_id", "a", "b", F.explode(F.array(reach)).alias("length")).where(F.col("length") > min_len)


def sides_of(faces: DataFrame) -> DataFrame:
    """``model_id, face_id, p, q``: the directed sides of the faces, with places as structs."""
    pts = F.col("pts")
    each = let(pts, lambda ring: F.transform(ring, lambda p, i: F.struct(p.alias("p"), following(ring, i).alias("q"))))
    return faces.select("model_id", "face_id", F.explode(each).alias("s")).select("model_id", "face_id", "s.p", "s.q")


def side_uses(faces: DataFrame) -> DataFrame:
    """``model_id, p, q, uses, winding, face_id``: undirected sides by place; ``face_id`` is the least of the faces."""
    forward = F.col("p") < F.col("q")
    return sides_of(faces).groupBy("model_id", F.least("p", "q").alias("p"), F.greatest("p", "q").alias("q")).agg(F.count("*").alias("uses"), F.sum(F.when(forward, 1).otherwise(-1)).alias("winding"), F.min("face_id").alias("face_id"))


def _distance(p: Column, pts: Column, n: tuple) -> Column:
    """From a place to a convex plane face."""
    inside = F.forall(_inward(pts, n), lambda s: dot(xyz(s), minus(xyz(p), xyz(s["p"]))) >= 0)
    height = F.abs(dot(n, minus(xyz(p), xyz(pts[0]))))

    def to_side(a: Column, b: Column) -> Column:
        d, w = minus(xyz(b), xyz(a)), minus(xyz(p), xyz(a))
        t = F.least(F.greatest(dot(w, d) / F.nullif(dot(d, d), F.lit(0.0)), F.lit(0.0)), F.lit(1.0))
        return let(t, lambda t: length(tuple(w[k] - t * d[k] for k in range(3))))

    return F.when(inside, height).otherwise(F.array_min(F.transform(pts, lambda a, i: let(following(pts, i), lambda b: to_side(a, b)))))


def uncovered_edges(faces: DataFrame, tol: float, size: float) -> DataFrame:
    """``model_id, face_id, p, q``: open sides whose ends and middle do not all lie within ``tol`` of one other face."""
    open_ = side_uses(faces).where("uses = 1").select("model_id", "face_id", "p", "q")
    low, high = (lambda c: F.least(F.col("p")[c], F.col("q")[c])), (lambda c: F.greatest(F.col("p")[c], F.col("q")[c]))
    boxed = open_.select("*", *[f(c).alias(f"{c}{i}") for c in AXES for i, f in enumerate((low, high))])
    names = ["ci", "cj", "ck"]
    ranges = [(f"{c}0", f"{c}1") for c in AXES]
    planes = with_planes(faces)
    shift = OFF_ROUND * size
    there = cells(planes, ranges, size, names, tol, shift).select("model_id", *names, F.col("face_id").alias("other"), "pts", "nx", "ny", "nz", "d", *[F.col(k).alias(f"o{k}") for k in SIDES])
    first = {n: F.floor((F.col(lo) + shift) / size).cast("long") for n, (lo, _) in zip(names, ranges)}  # a covering face reaches every cell of the side
    # A side lies in one cell, so what covers it is looked for there, until one face does: no pair leaves the join.
    met = [F.col(f"s.{k}") == F.col(f"t.{k}") for k in ("model_id", *names)] + [F.col("face_id") != F.col("other")]
    for c in AXES:  # both ends lie in the other's grown box, before anything is measured
        met += [F.col(f"{c}0") >= F.col(f"o{c}0") - tol, F.col(f"{c}1") <= F.col(f"o{c}1") + tol]
    n = (F.col("nx"), F.col("ny"), F.col("nz"))
    met += [F.abs(dot(n, xyz(F.col(k))) - F.col("d")) <= tol + 1e-6 for k in "pq"]  # nor off its plane
    middle = F.struct(*[((F.col("p")[c] + F.col("q")[c]) / 2).alias(c) for c in AXES])
    met += [_distance(p, F.col("pts"), n) <= tol + 1e-9 for p in (F.col("p"), middle, F.col("q"))]
    return boxed.withColumns(first).alias("s").join(there.alias("t").hint("merge"), reduce(and_, met), "left_anti").select("model_id", "face_id", "p", "q")


def open_loops(faces: DataFrame, levels: DataFrame, tol: float, gap: float) -> DataFrame:
    """``model_id, loop, corners, sides, z, kind``: the components of sides that one face only uses.

    kind: ``open`` (a corner without just two sides), ``tilted`` (not level), ``bottom`` (at the lowest level), ``plate`` (at
    another), ``foot`` (up to ``gap`` above one), else ``other``; ``levels(model_id, elev)`` are each model's own. ``loop`` numbers the components by a hash of a corner.
    """
    open_ = side_uses(faces).where("uses = 1")
    node = lambda c: F.xxhash64("model_id", c)
    ends = open_.select("model_id", F.explode(F.array("p", "q")).alias("p"))
    corners = ends.groupBy("model_id", "p").agg(F.count("*").alias("degree")).withColumn("node", node("p"))
    label = roots(open_.select(F.col("model_id").alias("g"), node("p").alias("a"), node("q").alias("b"))).withColumnRenamed("g", "model_id")
    placed = corners.join(label.hint("merge"), ["model_id", "node"], "left").withColumn("loop", F.coalesce("root", "node"))
    loops = placed.groupBy("model_id", "loop").agg(F.count("*").alias("corners"), (F.sum("degree") / 2).cast("long").alias("sides"), F.min(F.col("degree") == 2).alias("closed"), F.min("p.z").alias("z"), F.max("p.z").alias("top"))
    bounds = levels.groupBy("model_id").agg(F.sort_array(F.collect_list("elev")).alias("elevs"))  # a building's levels: a short list
    z = F.col("z")
    at = F.exists("elevs", lambda e: F.abs(z - e) <= tol)
    above = F.exists("elevs", lambda e: (z - e > tol) & (z - e <= gap))
    kind = F.when(~F.col("closed"), "open").when(F.col("top") - z > tol, "tilted").when(F.abs(z - F.col("elevs")[0]) <= tol, "bottom").when(at, "plate").when(above, "foot").otherwise("other")
    return loops.join(bounds, "model_id", "left").select("model_id", "loop", "corners", "sides", "z", kind.alias("kind"))


def pair_slabs(feet: DataFrame, plates: DataFrame, share: float, gap: tuple[float, float], size: float) -> DataFrame:
    """``model_id, foot, plate, shared``: level rectangles one to one, where each is the other's best.

    A plate lies ``gap`` above its foot, and they share at least ``share`` of the larger one. Best is by shared area, then
    by the smaller id.
    """
    side = lambda df, k: cells(df, [("x0", "x1"), ("y0", "y1")], size, ["ci", "cj"]).select("model_id", "ci", "cj", F.col("face_id").alias(k), *[F.col(c).alias(f"{k}_{c}") for c in ("x0", "x1", "y0", "y1", "z0")])
    met = side(feet, "foot").join(side(plates, "plate"), ["model_id", "ci", "cj"])
    c = F.col
    width = [F.least(f"foot_{k}1", f"plate_{k}1") - F.greatest(f"foot_{k}0", f"plate_{k}0") for k in "xy"]
    whole = lambda k: (c(f"{k}_x1") - c(f"{k}_x0")) * (c(f"{k}_y1") - c(f"{k}_y0"))
    met = met.where((width[0] > 0) & (width[1] > 0)).where(*[(c("plate_z0") - c("foot_z0")).between(*gap)])
    met = met.withColumn("shared", width[0] * width[1]).where(c("shared") >= share * F.greatest(whole("foot"), whole("plate"))).select("model_id", "foot", "plate", "shared").distinct()
    best = lambda key, other: F.row_number().over(Window.partitionBy("model_id", key).orderBy(F.desc("shared"), other))
    return met.withColumn("of_foot", best("foot", "plate")).withColumn("of_plate", best("plate", "foot")).where("of_foot = 1 and of_plate = 1").select("model_id", "foot", "plate", "shared")


def merge_rectangles(rects: DataFrame, on: list[str], seam: float, fill: float, section: bool, size: float) -> DataFrame:
    """Rectangles ``face_id, u0, u1, v0, v1`` of equal ``on`` that touch, merged: ``on, first, pieces, u0 .. v1, share, whole``.

    Pieces touch if they come within ``seam`` in both directions and meet over more than a point; with ``section`` they must
    have one extent in v, as pieces of one profile. ``whole`` is true where they fill their common rectangle to ``fill``
    without overlap; the others are left as they are.
    """
    ranges = [("u0", "u1"), ("v0", "v1")]
    placed = cells(rects, ranges, size, ["ci", "cj"], seam)
    side = lambda k: placed.select(*on, "ci", "cj", F.col("face_id").alias(k), *[F.col(c).alias(f"{k}_{c}") for c in ("u0", "u1", "v0", "v1")])
    met = side("a").join(side("b").hint("merge"), [*on, "ci", "cj"]).where("a < b")
    gap = [F.greatest(f"a_{c}0", f"b_{c}0") - F.least(f"a_{c}1", f"b_{c}1") for c in "uv"]
    met = met.where((gap[0] <= seam) & (gap[1] <= seam) & ((gap[0] < 0) | (gap[1] < 0)))
    for c, k in zip("uv", ("ci", "cj")):  # a pair counts in one cell
        met = met.where(F.col(k) == F.floor((F.greatest(f"a_{c}0", f"b_{c}0") - seam) / size))
    if section:
        met = met.where("a_v0 = b_v0 and a_v1 = b_v1")
    label = components(rects.select(F.col("face_id").alias("node")), met.select(F.xxhash64(*on).alias("on"), "a", "b"), within="on")
    area = (F.col("u1") - F.col("u0")) * (F.col("v1") - F.col("v0"))
    out = rects.join(label, F.col("face_id") == F.col("node")).groupBy(*on, F.col("component").alias("first")).agg(F.count("*").alias("pieces"), *[f(c).alias(c) for f, c in ((F.min, "u0"), (F.max, "u1"), (F.min, "v0"), (F.max, "v1"))], F.sum(area).alias("filled"))
    share = F.col("filled") / area
    return out.withColumn("share", share).withColumn("whole", F.col("share").between(fill, 2 - fill)).drop("filled")


def union_area(rects: DataFrame, on: list[str]) -> DataFrame:
    """``on, area``: what rectangles ``u0, u1, v0, v1`` of equal ``on`` cover together, by slabs between their ends in u."""
    ends = rects.select(*on, F.explode(F.array("u0", "u1")).alias("lo")).distinct()
    slabs = ends.withColumn("hi", F.lead("lo").over(Window.partitionBy(*on).orderBy("lo"))).where("hi is not null")
    held = slabs.join(rects, on).where("u0 <= lo and u1 >= hi")
    order = Window.partitionBy(*on, "lo").orderBy("v0", "v1")
    before = F.max("v1").over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.greatest(F.col("v1") - F.greatest(F.col("v0"), F.coalesce(before, F.col("v0"))), F.lit(0.0))
    return held.withColumn("fresh", fresh).groupBy(*on).agg(F.sum((F.col("hi") - F.col("lo")) * F.col("fresh")).alias("area"))


def box_parts(rects: DataFrame) -> DataFrame:
    """``part, axes, depths, is_box``: parts of axis-parallel rectangles (axis, depth, area and box) that are closed boxes.

    A box has just two depths along each of three axes, and the faces at either depth cover the box's own side together;
    what several of them cover counts once.
    """
    c = F.col
    extent = rects.groupBy("part").agg(*[f(x).alias(f"b{x}") for f, x in zip((F.min, F.max) * 3, SIDES)])
    span = {k: c(f"b{k}1") - c(f"b{k}0") for k in AXES}
    depth = F.when(c("axis") == 0, c("x0")).when(c("axis") == 1, c("y0")).otherwise(c("z0"))
    flat = [F.when(c("axis") == 0, c(a)).when(c("axis") == 1, c(b)).otherwise(c(d)) for a, b, d in (("y0", "x0", "x0"), ("y1", "x1", "x1"), ("z0", "z0", "y0"), ("z1", "z1", "y1"))]
    sides = rects.select("part", "axis", depth.alias("depth"), *[f.alias(k) for f, k in zip(flat, ("u0", "u1", "v0", "v1"))])
    at = union_area(sides, ["part", "axis", "depth"]).withColumnRenamed("area", "covered").join(extent, "part")
    side = F.when(c("axis") == 0, span["y"] * span["z"]).when(c("axis") == 1, span["x"] * span["z"]).otherwise(span["x"] * span["y"])
    per = at.groupBy("part", "axis").agg(F.count("*").alias("depths"), F.min(c("covered") >= side - 1e-9).alias("full"))
    return per.groupBy("part").agg(F.count("*").alias("axes"), F.max("depths").alias("depths"), ((F.count("*") == 3) & (F.max("depths") == 2) & (F.min("depths") == 2) & F.min("full")).alias("is_box"))


def face_gate(faces: DataFrame, most_side: float, least_side: float) -> DataFrame:
    """Per face: ``corners, quad, convex, longest, shortest, oversize, short``."""
    pts = F.col("pts")
    sizes = F.transform(pts, lambda p, i: length(minus(xyz(following(pts, i)), xyz(p))))
    planes = with_planes(faces)
    n = (F.col("nx"), F.col("ny"), F.col("nz"))
    turns = F.transform(pts, lambda p, i: dot(n, cross(minus(xyz(following(pts, i)), xyz(p)), minus(xyz(following(pts, i + 1)), xyz(following(pts, i))))))
    out = planes.select("model_id", "face_id", F.size("pts").alias("corners"), F.forall(turns, lambda t: t >= -1e-9).alias("convex"), F.array_max(sizes).alias("longest"), F.array_min(sizes).alias("shortest"))
    return out.withColumn("quad", F.col("corners") == 4).withColumn("oversize", F.col("longest") > most_side).withColumn("short", F.col("shortest") < least_side)


def surface_gate(faces: DataFrame, size: float, tol: float = 0.001, most_side: float = 0.75, least_side: float = 0.3) -> DataFrame:
    """One row for each model: counts of what a closed, clean surface has none of, and the verdict.

    ``faces, concave, oversize, short, duplicates, winding, multi_face, odd_ends, uncovered, overlaps, crossings, status``.
    """
    n = lambda cond: F.sum(F.when(cond, 1).otherwise(0)).cast("long")
    per_face = face_gate(faces, most_side, least_side).groupBy("model_id").agg(F.count("*").alias("faces"), n(~F.col("convex")).alias("concave"), n(F.col("oversize")).alias("oversize"), n(F.col("short")).alias("short"))
    same = faces.groupBy("model_id", F.array_sort("pts").alias("pts")).agg(F.count("*").alias("n")).groupBy("model_id").agg(F.sum(F.col("n") - 1).alias("duplicates"))
    uses = side_uses(faces)
    sides = uses.groupBy("model_id").agg(n((F.col("uses") == 2) & (F.col("winding") != 0)).alias("winding"), n(F.col("uses") > 2).alias("multi_face"))
    odd = uses.where("uses = 1").select("model_id", F.explode(F.array("p", "q")).alias("p")).groupBy("model_id", "p").agg(F.count("*").alias("n")).groupBy("model_id").agg(n(F.col("n") != 2).alias("odd_ends"))
    count = lambda df, name: df.groupBy("model_id").agg(F.count("*").alias(name))
    out = per_face
    for part in (same, sides, odd, count(uncovered_edges(faces, tol, size), "uncovered"), count(overlaps(faces, tol, 0.999999, 1e-7, size), "overlaps"), count(crossings(faces, 0.02, 0.003, size), "crossings")):
        out = out.join(part, "model_id", "left")
    counts = ["concave", "oversize", "short", "duplicates", "winding", "multi_face", "odd_ends", "uncovered", "overlaps", "crossings"]
    out = out.select("model_id", "faces", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts])
    return out.withColumn("status", F.when(sum((F.col(c) for c in counts[1:]), F.col(counts[0])) == 0, "pass").otherwise("fail"))
