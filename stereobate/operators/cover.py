"""What rectangles of several roles cover together: unions, differences and overlaps in a plane, and the profile gate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from stereobate.operators.spatial import cells


def covered(rects: DataFrame, on: list[str], roles: list[str], size: float) -> DataFrame:
    """``on.., u0, u1, v0, v1`` and a column for each role: disjoint pieces, with how many rectangles of it cover each.

    ``rects``: ``on.., role, u0, u1, v0, v1``. The plane is cut into tiles of ``size``; a tile into slabs at the sides of
    its rectangles, swept in v with a running count. A slab is one window group, so its size is that of a tile's
    content, never of the whole plane. Rectangles without area and roles not named cover nothing.
    """
    real = rects.where(F.col("role").isin(*roles) & (F.col("u0") < F.col("u1")) & (F.col("v0") < F.col("v1")))
    tile = [*on, "ti", "tj"]
    placed = cells(real.select(*on, "role", "u0", "u1", "v0", "v1"), [("u0", "u1"), ("v0", "v1")], size, ["ti", "tj"])
    inside = lambda c, t: F.least(F.greatest(F.col(c), F.col(t) * size), (F.col(t) + 1) * size)
    placed = placed.select(*tile, "role", inside("u0", "ti").alias("u0"), inside("u1", "ti").alias("u1"), inside("v0", "tj").alias("v0"), inside("v1", "tj").alias("v1")).where("u0 < u1 and v0 < v1")
    placed = placed.groupBy(*tile, "role", "u0", "u1", "v0", "v1").agg(F.count("*").alias("n"))
    # A tile's rectangles and the ends of its slabs are one row: no join, and no shuffle where rows lie by a column of ``on``.
    tiles = placed.groupBy(*tile).agg(F.collect_list(F.struct("role", "u0", "u1", "v0", "v1", "n")).alias("r"), F.sort_array(F.array_distinct(F.flatten(F.collect_list(F.array("u0", "u1"))))).alias("cuts"))
    spans = F.filter("cuts", lambda c: (c >= F.col("r.u0")) & (c <= F.col("r.u1")))
    each = tiles.select(*tile, "cuts", F.explode("r").alias("r")).select(*tile, "r.role", "r.v0", "r.v1", "r.n", spans.alias("c"))
    slabs = F.arrays_zip(F.slice("c", F.lit(1), F.size("c") - 1).alias("s0"), F.slice("c", F.lit(2), F.size("c") - 1).alias("s1"))
    met = each.select(*tile, "role", "v0", "v1", "n", F.explode(slabs).alias("s")).select(*tile, "s.s0", "s.s1", "role", F.explode(F.array(F.struct(F.col("v0").alias("v"), F.col("n")), F.struct(F.col("v1").alias("v"), (-F.col("n")).alias("n")))).alias("e"))
    steps = met.select(*tile, "s0", "s1", "e.v", *[F.when(F.col("role") == r, F.col("e.n")).otherwise(0).alias(r) for r in roles])
    steps = steps.groupBy(*tile, "s0", "s1", "v").agg(*[F.sum(r).alias(r) for r in roles])
    sweep = Window.partitionBy(*tile, "s0", "s1").orderBy("v")
    pieces = steps.select(*on, F.col("s0").alias("u0"), F.col("s1").alias("u1"), F.col("v").alias("v0"), F.lead("v").over(sweep).alias("v1"), *[F.sum(r).over(sweep).alias(r) for r in roles])
    return pieces.where("v1 is not null").where(" or ".join(f"{r} > 0" for r in roles))


def area(where: Column | None = None, times: Column | None = None) -> Column:
    """Summed area of pieces, of those ``where`` only, each counted ``times``."""
    value = (F.col("u1") - F.col("u0")) * (F.col("v1") - F.col("v0"))
    value = value if times is None else value * times
    return F.coalesce(F.sum(value if where is None else F.when(where, value)), F.lit(0.0))


def difference(rects: DataFrame, on: list[str], a: str, b: str, size: float) -> DataFrame:
    """``on.., u0, u1, v0, v1``: what of role ``a`` no rectangle of role ``b`` covers, as disjoint rectangles."""
    return covered(rects, on, [a, b], size).where(f"{a} > 0 and {b} = 0").select(*on, "u0", "u1", "v0", "v1")


def profile_gate(faces: DataFrame, profiles: DataFrame, openings: DataFrame, cuts: DataFrame, on: list[str], tol: float, size: float) -> DataFrame:
    """A verdict for each registered run: its faces against its profile.

    ``faces``: ``on.., u0, u1, v0, v1, off`` (distance from the run's plane) and ``facing`` (positive outwards);
    ``profiles`` and ``openings``: rectangles; ``cuts``: ``on.., axis ('u' or 'v'), at``, the registered coordinates. A
    face's coordinate snaps to the nearest cut within ``tol``; one with no cut so near is unregistered. Gives ``faces,
    off_plane, inward, extra_cuts, difference`` (area on one side only), ``overlap, opening_fill, status``: ``missing``
    where a run has no face, ``fail`` where any of them is not zero. Faces of no registered run come with ``unregistered``.
    """
    listed = cuts.groupBy(*on).agg(*[F.sort_array(F.collect_set(F.when(F.col("axis") == k, F.col("at")))).alias(f"{k}_cuts") for k in "uv"])
    met = faces.join(listed, on, "left")

    def near(c: str) -> Column:
        return F.array_min(F.transform(f"{c[0]}_cuts", lambda at: F.struct(F.abs(at - F.col(c)).alias("gap"), at.alias("at"))))

    ends = ["u0", "u1", "v0", "v1"]
    met = met.select(*on, "off", "facing", *ends, *[near(c).alias(f"near_{c}") for c in ends])
    extra = lambda c: F.coalesce(F.col(f"near_{c}.gap") > tol, F.lit(True))
    met = met.select(*on, "off", "facing", *[F.when(extra(c), F.col(c)).otherwise(F.col(f"near_{c}.at")).alias(c) for c in ends], sum((extra(c).cast("long") for c in ends), F.lit(0).cast("long")).alias("extra"))
    counts = met.groupBy(*on).agg(
        F.count("*").alias("faces"),
        F.count_if(F.coalesce(F.abs("off") >= tol, F.lit(True))).alias("off_plane"),
        F.count_if(F.coalesce(F.col("facing") <= 0, F.lit(True))).alias("inward"),
        F.sum("extra").alias("extra_cuts"),
    )
    sides = [df.select(*on, F.lit(role).alias("role"), *[F.col(c).cast("double").alias(c) for c in ends]) for role, df in (("face", met), ("profile", profiles), ("opening", openings))]
    pieces = covered(sides[0].unionByName(sides[1]).unionByName(sides[2]), on, ["face", "profile", "opening"], size)
    face, profile, opening = (F.col(c) > 0 for c in ("face", "profile", "opening"))
    wanted = profile & ~opening
    areas = pieces.groupBy(*on).agg(area(face != wanted).alias("difference"), area(F.col("face") > 1, F.col("face") - 1).alias("overlap"), area(face & opening).alias("opening_fill"))
    runs = profiles.select(*on).distinct().withColumn("registered", F.lit(True))
    out = runs.join(counts, on, "full").join(areas, on, "left")
    numbers = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("faces", "off_plane", "inward", "extra_cuts")]
    out = out.select(*on, "registered", *numbers, *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("difference", "overlap", "opening_fill")])
    bad = (F.col("off_plane") + F.col("inward") + F.col("extra_cuts") > 0) | (F.greatest("difference", "overlap", "opening_fill") > 1e-8)
    status = F.when(F.col("registered").isNull(), "unregistered").when(F.col("faces") == 0, "missing").when(bad, "fail").otherwise("pass")
    return out.withColumn("status", status).drop("registered")
