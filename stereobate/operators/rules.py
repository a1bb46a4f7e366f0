"""Expressions over rows of meshes, files, images and packages, and rule sets that give findings.

A rule set returns ``key, rule, status, observed``; it never raises on a bad row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F


def transform(vertices: DataFrame, frames: DataFrame, on: str) -> DataFrame:
    """Places in the object's system: x' = m00 x + m01 y + m02 z + m03 and so on; ``frames`` has a row for each ``on``."""
    row = lambda r: F.col(f"m{r}0") * F.col("x") + F.col(f"m{r}1") * F.col("y") + F.col(f"m{r}2") * F.col("z") + F.col(f"m{r}3")
    out = vertices.join(frames, on)
    kept = [c for c in vertices.columns if c not in "xyz"]
    return out.select(*kept, *[row(r).alias(c) for r, c in enumerate("xyz")])


def determinant() -> Column:
    m = lambda r, c: F.col(f"m{r}{c}")
    return m(0, 0) * (m(1, 1) * m(2, 2) - m(1, 2) * m(2, 1)) - m(0, 1) * (m(1, 0) * m(2, 2) - m(1, 2) * m(2, 0)) + m(0, 2) * (m(1, 0) * m(2, 1) - m(1, 1) * m(2, 0))


def fix_winding(tris: DataFrame, frames: DataFrame, on: str) -> DataFrame:
    """Triangles under a mirroring frame run the other way: (a, b, c) becomes (c, b, a)."""
    mirrored = determinant() < 0
    out = tris.join(frames.select(on, mirrored.alias("_m")), on)
    return out.select(*[c for c in tris.columns if c not in ("a", "c")], F.when(F.col("_m"), F.col("c")).otherwise(F.col("a")).alias("a"), F.when(F.col("_m"), F.col("a")).otherwise(F.col("c")).alias("c"))


def wall_frame(points: DataFrame) -> DataFrame:
    """Along (s) and outward (t) coordinates of points on walls from (px, py) to (qx, qy); a null wall gives nulls."""
    dx, dy = F.col("qx") - F.col("px"), F.col("qy") - F.col("py")
    size = F.sqrt(dx * dx + dy * dy)
    x, y = F.col("x") - F.col("px"), F.col("y") - F.col("py")
    return points.withColumn("s", F.when(size > 0, (x * dx + y * dy) / size)).withColumn("t", F.when(size > 0, (x * dy - y * dx) / size))


def level_findings(helpers: DataFrame, least_gap: float = 0.001) -> DataFrame:
    """Problems of level helpers (model_id, name, elev): bad name, copy suffix, double name, too close, too few."""
    name = F.col("name")
    w = Window.partitionBy("model_id").orderBy("elev", "name")
    same = Window.partitionBy("model_id", "name")
    h = helpers.withColumn("_before", F.lag("elev").over(w)).withColumn("_same", F.count("*").over(same))
    tests = [("bad_name", ~name.rlike("^[A-Za-z0-9_]+$")), ("copy_suffix", name.rlike(r"\.\d{3}$")), ("double_name", F.col("_same") > 1), ("too_close", F.col("elev") - F.col("_before") < least_gap)]
    found = [h.where(cond).select("model_id", "name", F.lit(rule).alias("rule")) for rule, cond in tests]
    few = helpers.groupBy("model_id").count().where("count < 2").select("model_id", F.lit(None).cast("string").alias("name"), F.lit("too_few").alias("rule"))
    return reduce(DataFrame.unionByName, [*found, few])


def uv_issue(faces: DataFrame, margin: float) -> DataFrame:
    """``invalid`` (under three corners or no area), ``mirrored``, ``cross_tile``, ``margin`` or null, of faces with ``uv array<struct<u, v>>``."""
    uv = F.col("uv")
    n = F.size(uv)
    nxt = lambda i: F.get(uv, F.when(i + 1 == n, F.lit(0)).otherwise(i + 1))
    area = F.aggregate(F.transform(uv, lambda p, i: p["u"] * nxt(i)["v"] - nxt(i)["u"] * p["v"]), F.lit(0.0), lambda a, x: a + x) / 2
    u, v = F.transform(uv, lambda p: p["u"]), F.transform(uv, lambda p: p["v"])
    tile = (F.floor(F.array_min(u)) != F.floor(F.array_max(u))) | (F.floor(F.array_min(v)) != F.floor(F.array_max(v)))
    near = lambda x: F.exists(x, lambda c: (c - F.floor(c) < margin) | (F.ceil(c) - c < margin))
    issue = F.when((n < 3) | (F.abs(F.col("uv_area")) < 1e-12), "invalid").when(F.col("uv_area") < 0, "mirrored").when(tile, "cross_tile").when(near(u) | near(v), "margin")
    return faces.withColumn("uv_area", area).withColumn("issue", issue)


def texel_density(faces: DataFrame, pixels: int) -> DataFrame:
    """Pixels a metre by the ratio of texture to face area; null without either."""
    ok = (F.col("area") > 0) & (F.abs("uv_area") > 0)
    return faces.withColumn("density", F.when(ok, pixels * F.sqrt(F.abs("uv_area") / F.col("area"))))


def facade_side(boxes: DataFrame) -> DataFrame:
    """Side that a box faces, by its thinner plan extent and its place to the model's middle: W, E, S or N."""
    w = Window.partitionBy("model_id")
    midx, midy = (F.min("x0").over(w) + F.max("x1").over(w)) / 2, (F.min("y0").over(w) + F.max("y1").over(w)) / 2
    thin_x = F.col("x1") - F.col("x0") < F.col("y1") - F.col("y0")
    side = F.when(thin_x, F.when((F.col("x0") + F.col("x1")) / 2 < midx, "W").otherwise("E")).otherwise(F.when((F.col("y0") + F.col("y1")) / 2 < midy, "S").otherwise("N"))
    u0, u1 = F.when(thin_x, F.col("y0")).otherwise(F.col("x0")), F.when(thin_x, F.col("y1")).otherwise(F.col("x1"))
    return boxes.select("model_id", "face_id", side.alias("side"), u0.alias("u0"), u1.alias("u1"), "z0", "z1")


# Parts of paths that must not leave the machine, and those that may be published.
SENSITIVE = ("secret", "token", "password", "private")
LOCAL = ("tmp", "cache", "draft")
PROMOTE = ("en", "fr", "de", "es")


def classify_paths(files: DataFrame, path: str) -> DataFrame:
    """``sensitive``, ``local``, ``promote`` or ``review`` by the parts of the path; the first that fits."""
    parts = F.split(F.lower(F.col(path)), "[/?&=]")
    any_of = lambda names: F.arrays_overlap(parts, F.array(*map(F.lit, names)))
    return files.withColumn("place", F.when(any_of(SENSITIVE), "sensitive").when(any_of(LOCAL), "local").when(any_of(PROMOTE), "promote").otherwise("review"))


def decor_kind(decor: DataFrame) -> DataFrame:
    """``band`` (3 to 1 or wider), ``strip`` (1 to 3 or taller), else ``panel``; texture at projections up to 0.10 m."""
    ratio = F.col("w") / F.nullif(F.col("h"), F.lit(0.0))
    return decor.withColumn("kind", F.when(ratio >= 3, "band").when(ratio <= 1 / 3, "strip").otherwise("panel")).withColumn("texture", F.round("projection", 3) <= 0.10)


def opening_kind(openings: DataFrame) -> DataFrame:
    """``window`` if glass fills the height to 0.1 m; ``door`` if it stands on the floor and is of door size; else ``opening``."""
    glazed = F.col("glass_h").isNotNull() & (F.col("h") - F.col("glass_h") <= 0.1 + 1e-9)
    door = (F.col("sill") <= 0.1 + 1e-9) & F.col("h").between(1.9, 3.0) & F.col("w").between(0.7, 2.5)
    return openings.withColumn("kind", F.when(glazed, "window").when(door, "door").otherwise("opening"))


def findings(df: DataFrame, key: str, rules: dict[str, Column], observed: dict[str, Column] | None = None) -> DataFrame:
    """A finding for each row and rule: ``pass`` where the rule holds, ``fail`` where not, ``not_measured`` where it is null."""
    observed = observed or {}
    each = [F.struct(F.lit(name).alias("rule"), F.when(cond, "pass").when(~cond, "fail").otherwise("not_measured").alias("status"), observed.get(name, F.lit(None)).cast("string").alias("observed")) for name, cond in rules.items()]
    return df.select(F.col(key).alias("key"), F.explode(F.array(*each)).alias("f")).select("key", "f.*")


def package_facts(files: DataFrame, package: str, path: str, size: Column) -> DataFrame:
    """One row for each package: members, bytes, largest member, double paths and distinct kinds."""
    kind = F.regexp_extract(F.col(path), r"^https?://[^/]+/([^/]+)/", 1)
    return files.groupBy(package).agg(F.count("*").alias("members"), F.sum(size).alias("bytes"), F.max(size).alias("largest"), (F.count("*") - F.countDistinct(path)).alias("double_paths"), F.countDistinct(kind).alias("kinds"))


def map_sets(images: DataFrame, by: list[str], kind: str, needed: list[str]) -> DataFrame:
    """Image sets: which needed maps each slot and tile lacks, comma-joined, and whether it is whole."""
    have = images.groupBy(*by).agg(F.collect_set(kind).alias("_have"))
    lacks = F.array_except(F.array(*map(F.lit, needed)), "_have")
    return have.select(*by, F.array_join(F.array_sort(lacks), ",").alias("missing"), (F.size(lacks) == 0).alias("whole"))


def best_phase(faces: DataFrame, by: str, lo: str, hi: str, period: float, steps: int) -> DataFrame:
    """Offset out of ``steps`` in a period that keeps the faces' ends farthest from its borders: ``by, phase, margin``.

    Each face meets each offset: rows grow with the faces, the offsets are a fixed number.
    """
    phase = F.explode(F.sequence(F.lit(0), F.lit(steps - 1)))
    tried = faces.select(by, lo, hi).withColumn("phase", phase)
    edge = lambda c: F.pmod(F.col(c) + F.col("phase") * (period / steps), F.lit(period))
    margin = lambda c: F.least(edge(c), period - edge(c))
    least = tried.groupBy(by, "phase").agg(F.round(F.min(F.least(margin(lo), margin(hi))), 9).alias("margin"))
    return least.groupBy(by).agg(F.max(F.struct("margin", (-F.col("phase")).alias("p"))).alias("b")).select(by, (-F.col("b.p")).cast("long").alias("phase"), "b.margin")


def map_uv(points: DataFrame, scale: float, period: float) -> DataFrame:
    """Repeating texture places of points at whole periods: u, v in [0, period)."""
    wrap = lambda c: F.pmod(F.col(c) * scale, F.lit(period))
    return points.withColumn("u", wrap("x")).withColumn("v", wrap("y"))


def subdivide_counts(sides: DataFrame, most: float) -> DataFrame:
    """Cuts of each side so that no part is longer than ``most``: ``cuts = ceil(length / most)``, at least 1."""
    return sides.withColumn("cuts", F.greatest(F.ceil(F.round(F.col("length") / most, 9)), F.lit(1)).cast("long"))


def mutual_nearest(ends: DataFrame, by: str, place: str, most: float) -> DataFrame:
    """Pairs of neighbouring places on a line that are each other's nearest within ``most``: ``by, lo, hi``."""
    w = Window.partitionBy(by).orderBy(place)
    d = ends.select(by, place).distinct().withColumn("_n", F.lead(place).over(w)).withColumn("_p", F.lag(place).over(w))
    gap_n, gap_p = F.col("_n") - F.col(place), F.col(place) - F.col("_p")
    d = d.withColumn("_to_next", gap_n.isNotNull() & (gap_n <= most) & (gap_p.isNull() | (gap_n < gap_p))).withColumn("_to_prev", gap_p.isNotNull() & (gap_p <= most) & (gap_n.isNull() | (gap_p <= gap_n)))
    d = d.withColumn("_next_back", F.lead("_to_prev").over(w))
    return d.where("_to_next and _next_back").select(by, F.col(place).alias("lo"), F.col("_n").alias("hi"))
