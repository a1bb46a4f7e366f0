"""Rule sets over packages, scenes and images, openings over levels, captured coordinates, and a registry of checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window, functions as F

from stereobate.operators.rules import findings
from stereobate.operators.spatial import cells
from stereobate.operators.topology import components


def low_detail_package(files: DataFrame, least: int, most: int, parts: int) -> DataFrame:
    """Findings for packages ``files(package, name)`` of model files only: a ground, numbered parts, nothing foreign.

    Names are the package's own: ``<package>_Ground.fbx`` and ``<package>_01.fbx`` up to ``parts``.
    """
    c = F.col
    model = c("name").rlike(r"(?i)\.fbx$")
    ground = c("name") == F.concat("package", F.lit("_Ground.fbx"))
    number = F.regexp_extract("name", r"_([0-9]{2})\.fbx$", 1)
    part = (c("name") == F.concat("package", F.lit("_"), number, F.lit(".fbx"))) & number.try_cast("int").between(1, parts)
    n = lambda cond: F.sum(F.when(cond, 1).otherwise(0)).cast("long")
    facts = files.groupBy("package").agg(n(~model).alias("foreign"), n(model).alias("models"), n(ground).alias("grounds"), n(model & ~ground & ~F.coalesce(part, F.lit(False))).alias("misnamed"))
    rules = {"foreign": c("foreign") == 0, "count": c("models").between(least, most), "archive": c("package").rlike("^[A-Za-z0-9]+([-._][A-Za-z0-9]+)*$"), "ground": c("grounds") > 0, "names": c("misnamed") == 0}
    return findings(facts, "package", rules, {"foreign": c("foreign"), "count": c("models"), "names": c("misnamed")})


def pivot_rules(meshes: DataFrame, share: float = 0.1, tol: float = 0.001) -> DataFrame:
    """Findings for scenes: the main mesh at zero, its pivot near the middle of its box in x and y, one pivot for all.

    ``meshes``: ``scene, mesh, main, helper, lx, ly, lz, x0, x1, y0, y1``. Helpers have no rule; without a mesh marked main
    the first of the others by name is it.
    """
    c = F.col
    own = meshes.where(~c("helper"))
    first = own.groupBy("scene").agg(F.min_by(F.struct("lx", "ly", "lz", "x0", "x1", "y0", "y1"), F.struct(~c("main"), c("mesh"))).alias("m"))
    away = F.sqrt(sum(((c(f"l{k}") - c(f"m.l{k}")) ** 2 for k in "yz"), (c("lx") - c("m.lx")) ** 2))
    shifted = own.join(first, "scene").groupBy("scene").agg(F.sum(F.when(away > tol, 1).otherwise(0)).cast("long").alias("shifted"))
    off = lambda k: F.coalesce(F.abs((c(f"m.{k}0") + c(f"m.{k}1")) / 2 - c(f"m.l{k}")) / F.nullif(c(f"m.{k}1") - c(f"m.{k}0"), F.lit(0.0)), F.lit(0.0))
    facts = first.join(shifted, "scene").select("scene", "shifted", F.greatest(*[F.abs(c(f"m.l{k}")) for k in "xyz"]).alias("from_zero"), F.greatest(off("x"), off("y")).alias("off"))
    return findings(facts, "scene", {"at_zero": c("from_zero") <= tol, "centre": c("off") <= share, "shared": c("shifted") == 0}, {"shared": c("shifted")})


def atlas_rules(images: DataFrame, sizes: list[int], most_bytes: int, placeholder: int = 128) -> DataFrame:
    """Findings for atlases ``image, width, height, bytes, alpha, depth, colours``: size list, file limit, no alpha, 8 bit.

    A square of the placeholder's size is no atlas: it must have one colour and no alpha.
    """
    c = F.col
    flat = (c("width") == placeholder) & (c("height") == placeholder)
    size = F.when(flat, (c("colours") == 1) & ~c("alpha")).otherwise((c("width") == c("height")) & c("width").isin(sizes))
    return findings(images, "image", {"size": size, "bytes": c("bytes") <= most_bytes, "no_alpha": ~c("alpha"), "depth": c("depth") == 8}, {"bytes": c("bytes"), "depth": c("depth")})


def join_across_levels(openings: DataFrame, tol: float, gap: float) -> DataFrame:
    """Openings that continue one of the level below: ``model_id, first, parts, level, x0, x1, z0, z1``, a row for each chain.

    ``openings``: ``model_id, wall, level, face_id, x0, x1, z0, z1``. The upper stands on the lower's line within ``tol``, and
    at most ``gap`` above its head. A chain belongs to its lowest level; single openings are chains of one.
    """
    step = F.floor(F.col("x0") / tol).cast("long")
    cols = ["x0", "x1", "z0", "z1"]
    low = openings.select("model_id", "wall", "level", F.col("face_id").alias("a"), *[F.col(c).alias(f"a_{c}") for c in cols], F.explode(F.array(step - 1, step, step + 1)).alias("_step"))
    high = openings.select("model_id", "wall", (F.col("level") - 1).alias("level"), F.col("face_id").alias("b"), *[F.col(c).alias(f"b_{c}") for c in cols], step.alias("_step"))
    met = low.join(high, ["model_id", "wall", "level", "_step"])
    near = lambda c: F.abs(F.col(f"a_{c}") - F.col(f"b_{c}")) <= tol
    rise = F.col("b_z0") - F.col("a_z1")
    links = met.where(near("x0") & near("x1") & (rise >= -1e-9) & (rise <= gap)).select("a", "b")
    label = components(openings.select(F.col("face_id").alias("node")), links)
    named = openings.join(label, F.col("face_id") == F.col("node"))
    return named.groupBy("model_id", F.col("component").alias("first")).agg(F.count("*").alias("parts"), F.min("level").alias("level"), F.min("x0").alias("x0"), F.max("x1").alias("x1"), F.min("z0").alias("z0"), F.max("z1").alias("z1"))


def captured_uv(lines: DataFrame) -> DataFrame:
    """Captured coordinates from CSV lines ``capture, line`` (id, u, v): ``capture, rows, bad, ids, finite, status``.

    A capture passes if every line can be read, ids run from 0 without gaps or repeats, and all coordinates are finite.
    """
    r = F.from_csv("line", "id long, u double, v double", {"mode": "PERMISSIVE"})
    rows = lines.select("capture", r.alias("r"))
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    out = rows.groupBy("capture").agg(
        F.count("*").alias("rows"), F.sum(F.when(F.col("r.id").isNull(), 1).otherwise(0)).cast("long").alias("bad"), F.countDistinct("r.id").alias("ids"),
        F.sum(F.when(number(F.col("r.u")) & number(F.col("r.v")), 1).otherwise(0)).cast("long").alias("finite"), F.max("r.id").alias("_most"), F.min("r.id").alias("_least"),
    )
    whole = (F.col("bad") == 0) & (F.col("ids") == F.col("rows")) & (F.col("_least") == 0) & (F.col("_most") == F.col("rows") - 1) & (F.col("finite") == F.col("rows"))
    return out.withColumn("status", F.when(F.coalesce(whole, F.lit(False)), "pass").otherwise("fail")).drop("_most", "_least")


def match_triangles(expected: DataFrame, actual: DataFrame, tol: float) -> DataFrame:
    """``model_id, a, b, error``: triangles of two exports one to one, where each is the other's nearest.

    Both sides: ``model_id, face_id, kind, pts`` (three places). Pairs have one kind and centres at most ``tol`` apart; the
    error is the largest corner distance under the best of the three cyclic shifts, at most ``tol``. Equal errors go to the
    smaller ids.
    """
    # No corner is off by more than tol, so no centre is. Cells wide against tol: few actual triangles lie in more than one.
    size, reach = 16 * tol, 1.01 * tol

    def placed(df: DataFrame, key: str, around: float) -> DataFrame:
        at = [(F.col("pts")[0][c] + F.col("pts")[1][c] + F.col("pts")[2][c]) / 3 for c in "xyz"]
        out = df.select("model_id", "kind", F.col("face_id").alias(key), F.col("pts").alias(f"{key}_pts"), *[x.alias(f"m{k}") for k, x in enumerate(at)])
        return cells(out, [(f"m{k}", f"m{k}") for k in range(3)], size, ["c0", "c1", "c2"], around).withColumnsRenamed({f"m{k}": f"{key}_m{k}" for k in range(3)})

    met = placed(expected, "a", 0.0).join(placed(actual, "b", reach).hint("merge"), ["model_id", "kind", "c0", "c1", "c2"])
    for k in range(3):
        met = met.where(F.abs(F.col(f"a_m{k}") - F.col(f"b_m{k}")) <= reach)
    apart = lambda i, j: F.sqrt(sum(((F.col("a_pts")[i][c] - F.col("b_pts")[j][c]) ** 2 for c in "yz"), (F.col("a_pts")[i]["x"] - F.col("b_pts")[j]["x"]) ** 2))
    error = F.least(*[F.greatest(*[apart(i, (i + shift) % 3) for i in range(3)]) for shift in range(3)])
    met = met.select("model_id", "a", "b", error.alias("error")).where(F.col("error") <= tol)
    best = lambda key, other: F.row_number().over(Window.partitionBy("model_id", key).orderBy("error", other))
    return met.withColumn("_a", best("a", "b")).withColumn("_b", best("b", "a")).where("_a = 1 and _b = 1").drop("_a", "_b")


def triangle_report(expected: DataFrame, actual: DataFrame, pairs: DataFrame) -> DataFrame:
    """``model_id, expected, actual, matched, missing, extra, worst``: what ``match_triangles`` left over on either side."""
    count = lambda df, name: df.groupBy("model_id").agg(F.count("*").alias(name))
    found = pairs.groupBy("model_id").agg(F.count("*").alias("matched"), F.max("error").alias("worst"))
    out = count(expected, "expected").join(count(actual, "actual"), "model_id", "full").join(found, "model_id", "left").na.fill(0, ["expected", "actual", "matched"])
    return out.select("model_id", "expected", "actual", "matched", (F.col("expected") - F.col("matched")).alias("missing"), (F.col("actual") - F.col("matched")).alias("extra"), "worst")


class Checks:
    """Named checks: each takes the evidence tables it names and gives rows ``key, status``; one verdict comes out of each."""

    def __init__(self) -> None:
        self.known: dict[str, tuple[Callable[..., DataFrame], list[str]]] = {}

    def register(self, name: str, check: Callable[..., DataFrame], evidence: list[str]) -> None:
        if name in self.known:
            raise ValueError(f"check {name} is registered already")
        self.known[name] = (check, evidence)

    def run(self, tables: dict[str, DataFrame]) -> DataFrame:
        """``name, status, rows, reason``: fail if any row fails.

        A check without its evidence or without rows, and one that breaks while it is planned or while it runs, is
        ``not_measured`` with the reason; the others go on. Each check runs by itself, to one row.
        """
        session = next(iter(tables.values())).sparkSession
        verdicts = []
        for name, (check, evidence) in self.known.items():
            missing = [e for e in evidence if e not in tables]
            if missing:
                verdicts.append((name, "not_measured", 0, f"no {', '.join(missing)}"))
                continue
            try:
                failed = F.sum(F.when(F.col("status") == "fail", 1).otherwise(0))
                n, bad = check(*[tables[e] for e in evidence]).select("key", "status").agg(F.count("*"), failed).first()
                verdicts.append((name, "not_measured", 0, "no rows") if n == 0 else (name, "fail" if bad else "pass", n, None))
            except Exception as error:  # a check is the user's own code
                verdicts.append((name, "not_measured", 0, type(error).__name__))
        return session.createDataFrame(verdicts, "name string, status string, rows long, reason string")


__all__ = ["Checks", "atlas_rules", "captured_uv", "join_across_levels", "low_detail_package", "match_triangles", "pivot_rules", "triangle_report"]
