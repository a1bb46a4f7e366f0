"""Shape of islands of points: weighted means, covariances, principal axes with extents, and radius profiles."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from stereobate.functions.exprs import cross, dot
from stereobate.operators.shells import let

PAIRS = ["xx", "xy", "xz", "yy", "yz", "zz"]


def wmean(v: Column, w: Column) -> Column:
    """Mean weighted by ``w``; null where the weights sum to 0. Rows with a null in either are left out."""
    both = v.isNotNull() & w.isNotNull()
    return F.sum(v * w) / F.nullif(F.sum(F.when(both, w)), F.lit(0.0))


def cov3(x: Column, y: Column, z: Column) -> Column:
    """Sample covariances as a struct ``xx, xy, xz, yy, yz, zz``; null for fewer than two rows."""
    of = dict(zip("xyz", (x, y, z)))
    return F.struct(*[F.covar_samp(of[a], of[b]).alias(a + b) for a, b in PAIRS])


def _times(m: Column, v: tuple) -> tuple:
    rows = [(m["xx"], m["xy"], m["xz"]), (m["xy"], m["yy"], m["yz"]), (m["xz"], m["yz"], m["zz"])]
    return tuple(dot(r, v) for r in rows)


def _vec(v: tuple) -> Column:
    return F.struct(*[c.alias(k) for k, c in zip("xyz", v)])


def _of(v: Column) -> tuple:
    return v["x"], v["y"], v["z"]


def axes3(m: Column) -> Column:
    """Eigenvalues and unit eigenvectors of a symmetric matrix ``xx .. zz``: ``array<struct<value, x, y, z>>``, largest value first.

    The extreme value that stands further from the middle one comes from the cosine form of the cubic; its vector is the
    longest cross product of two rows of the shifted matrix. The other two follow from the plane across it by one
    rotation, so equal values still give perpendicular vectors. A multiple of the identity gives x, y, z; null gives null.
    """

    def solve(a: Column) -> Column:
        mean = (a["xx"] + a["yy"] + a["zz"]) / 3
        off = a["xy"] * a["xy"] + a["xz"] * a["xz"] + a["yz"] * a["yz"]
        spread = F.sqrt(((a["xx"] - mean) * (a["xx"] - mean) + (a["yy"] - mean) * (a["yy"] - mean) + (a["zz"] - mean) * (a["zz"] - mean) + 2 * off) / 6)
        return let(F.struct(mean.alias("q"), spread.alias("p")), lambda s: extreme(a, s))

    def extreme(a: Column, s: Column) -> Column:
        b = {k: (a[k] - s["q"] if k in ("xx", "yy", "zz") else a[k]) / s["p"] for k in PAIRS}
        det = b["xx"] * (b["yy"] * b["zz"] - b["yz"] * b["yz"]) - b["xy"] * (b["xy"] * b["zz"] - b["yz"] * b["xz"]) + b["xz"] * (b["xy"] * b["yz"] - b["yy"] * b["xz"])
        turn = F.acos(F.greatest(F.least(det / 2, F.lit(1.0)), F.lit(-1.0))) / 3
        # The cosine form's largest root stands apart where the determinant is positive, else its least.
        far = s["q"] + 2 * s["p"] * F.when(det >= 0, F.cos(turn)).otherwise(F.cos(turn + 2 * math.pi / 3))
        same = F.array(*[F.struct(s["q"].alias("value"), *[F.lit(float(k == j)).alias(j) for j in "xyz"]) for k in "xyz"])
        # A spread that rounding alone can give is none.
        return F.when(s["p"] <= F.abs(s["q"]) * 1e-15, same).otherwise(let(far, lambda e: vectors(a, e)))

    def vectors(a: Column, e: Column) -> Column:
        rows = [(a["xx"] - e, a["xy"], a["xz"]), (a["xy"], a["yy"] - e, a["yz"]), (a["xz"], a["yz"], a["zz"] - e)]
        found = [cross(rows[i], rows[j]) for i, j in ((0, 1), (1, 2), (2, 0))]
        longest = F.array_max(F.array(*[F.struct(dot(c, c).alias("n"), *[v.alias(k) for k, v in zip("xyz", c)]) for c in found]))
        unit = let(longest, lambda v: _vec(tuple(v[k] / F.sqrt(v["n"]) for k in "xyz")))
        return let(unit, lambda v: across(a, v))

    def across(a: Column, v: Column) -> Column:
        # A vector across v: v turned into the plane of its two larger components.
        u = F.when(F.abs(v["x"]) < F.abs(v["z"]), _vec((F.lit(0.0), -v["z"], v["y"]))).otherwise(_vec((-v["y"], v["x"], F.lit(0.0))))
        unit = let(u, lambda w: _vec(tuple(c / F.sqrt(dot(_of(w), _of(w))) for c in _of(w))))
        return let(unit, lambda u: let(_vec(cross(_of(v), _of(u))), lambda w: turned(a, v, u, w)))

    def turned(a: Column, v: Column, u: Column, w: Column) -> Column:
        uu, uw, ww = dot(_of(u), _times(a, _of(u))), dot(_of(u), _times(a, _of(w))), dot(_of(w), _times(a, _of(w)))
        angle = F.atan2(2 * uw, uu - ww) / 2

        def all_(t: Column) -> Column:
            first = tuple(F.cos(t) * p + F.sin(t) * q for p, q in zip(_of(u), _of(w)))
            second = tuple(F.cos(t) * q - F.sin(t) * p for p, q in zip(_of(u), _of(w)))
            return F.array(*[let(_vec(x), lambda x: F.struct(dot(_of(x), _times(a, _of(x))).alias("value"), *[x[k].alias(k) for k in "xyz"])) for x in (_of(v), first, second)])

        return F.sort_array(let(angle, all_), asc=False)

    return F.when(m["xx"].isNotNull() & m["zz"].isNotNull(), let(m, solve))


def islands(points: DataFrame, by: list[str]) -> DataFrame:
    """``by.., n, centre, axes, extents``: the box of each island's points ``by.., x, y, z`` along its principal axes.

    ``centre`` is the middle of that box, ``extents`` its lengths, in the order of ``axes``. Points with a null are left
    out; fewer than three points have no axes, their extents are 0 and their centre is the mean. The moments are partial
    aggregates; the second reading needs the few axes beside the points.
    """
    real = points.where("x is not null and y is not null and z is not null").select(*by, *[F.col(c).cast("double").alias(c) for c in "xyz"])
    x, y, z = (F.col(c) for c in "xyz")
    moments = real.groupBy(*by).agg(F.count("*").alias("n"), F.struct(*[F.avg(c).alias(c) for c in "xyz"]).alias("mean"), cov3(x, y, z).alias("m"))
    moments = moments.select(*by, "n", "mean", F.when(F.col("n") >= 3, axes3(F.col("m"))).alias("axes"))
    met = real.join(moments, by)
    along = [dot(_of(F.get("axes", F.lit(i))), tuple(F.col(c) - F.col(f"mean.{c}") for c in "xyz")) for i in range(3)]
    ends = met.select(*by, "n", "mean", "axes", *[a.alias(f"a{i}") for i, a in enumerate(along)]).groupBy(*by)
    ends = ends.agg(F.first("n").alias("n"), F.first("mean").alias("mean"), F.first("axes").alias("axes"), *[f(f"a{i}").alias(f"{k}{i}") for i in range(3) for k, f in (("lo", F.min), ("hi", F.max))])
    mid = [F.coalesce((F.col(f"lo{i}") + F.col(f"hi{i}")) / 2, F.lit(0.0)) for i in range(3)]
    centre = F.struct(*[(F.col(f"mean.{c}") + sum((m * F.coalesce(F.get("axes", F.lit(i))[c], F.lit(0.0)) for i, m in enumerate(mid)), F.lit(0.0))).alias(c) for c in "xyz"])
    return ends.select(*by, "n", centre.alias("centre"), "axes", F.array(*[F.coalesce(F.col(f"hi{i}") - F.col(f"lo{i}"), F.lit(0.0)) for i in range(3)]).alias("extents"))


def radius_profile(points: DataFrame, by: list[str], tall: float = 40.0, fine: float = 1.0, coarse: float = 5.0) -> DataFrame:
    """``by.., z0, n, r_min, r_max``: distances from the middle of each island's plan box, by bands of height.

    Bands are ``fine`` high, ``coarse`` for islands of ``tall`` or more; they start at the whole number below the lowest
    point. The highest point lies in the last band.
    """
    real = points.where("x is not null and y is not null and z is not null").select(*by, "x", "y", "z")
    box = real.groupBy(*by).agg(*[f(c).alias(f"{c}{i}") for c in "xyz" for i, f in enumerate((F.min, F.max))])
    box = box.select(*by, ((F.col("x0") + F.col("x1")) / 2).alias("mx"), ((F.col("y0") + F.col("y1")) / 2).alias("my"), F.floor("z0").cast("double").alias("base"), F.when(F.col("z1") - F.col("z0") < tall, fine).otherwise(coarse).alias("step"))
    met = real.join(box, by)
    band = F.col("base") + F.floor((F.col("z") - F.col("base")) / F.col("step")) * F.col("step")
    r = F.hypot(F.col("x") - F.col("mx"), F.col("y") - F.col("my"))
    return met.select(*by, band.alias("z0"), r.alias("r")).groupBy(*by, "z0").agg(F.count("*").alias("n"), F.min("r").alias("r_min"), F.max("r").alias("r_max"))
