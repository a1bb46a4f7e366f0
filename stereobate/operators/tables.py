"""Joins, comparisons and merges of keyed tables: catalogues, evidence, registries, verdicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from stereobate.operators.spatial import bounded

# Ranks of finding statuses; the worst decides a stage.
RANK = {"pass": 0, "not_run": 1, "review": 2, "fail": 3}


def missing_extra(a: DataFrame, b: DataFrame, on: list[str]) -> DataFrame:
    """Keys that only one side has: ``on, side`` with ``missing`` (not in ``b``) or ``extra`` (not in ``a``)."""
    left, right = a.select(*on).distinct().withColumn("_a", F.lit(True)), b.select(*on).distinct().withColumn("_b", F.lit(True))
    return left.join(right, on, "full_outer").where("_a is null or _b is null").select(*on, F.when(F.col("_b").isNull(), "missing").otherwise("extra").alias("side"))


def referential(children: DataFrame, parents: DataFrame, on: list[str]) -> DataFrame:
    """Keys of children without a parent (``orphan``), parents without a child (``unused``), parents held twice (``double``)."""
    orphan = children.select(*on).distinct().join(parents.select(*on), on, "left_anti").withColumn("problem", F.lit("orphan"))
    unused = parents.select(*on).distinct().join(children.select(*on), on, "left_anti").withColumn("problem", F.lit("unused"))
    double = parents.groupBy(*on).count().where("count > 1").select(*on).withColumn("problem", F.lit("double"))
    return orphan.unionByName(unused).unionByName(double)


def trace_coverage(rules: DataFrame, trace: DataFrame, on: str) -> DataFrame:
    """How often each rule is traced, and the traces of no rule: every rule should be traced exactly once."""
    counted = trace.groupBy(on).agg(F.count("*").alias("traced"))
    out = rules.select(on).distinct().withColumn("_known", F.lit(True)).join(counted, on, "full_outer")
    n = F.coalesce("traced", F.lit(0)).cast("long")
    state = F.when(F.col("_known").isNull(), "unknown").when(n == 0, "untraced").when(n == 1, "ok").otherwise("repeated")
    return out.select(on, n.alias("traced"), state.alias("state"))


def bind_evidence(recorded: DataFrame, actual: DataFrame, on: str, facts: list[str]) -> DataFrame:
    """``on, state``: ``same``, ``changed``, ``gone`` or ``new``, by null-safe equality of the facts."""
    both = recorded.select(on, F.lit(True).alias("_r"), *[F.col(f).alias(f"_r_{f}") for f in facts]).join(actual.select(on, F.lit(True).alias("_a"), *[F.col(f).alias(f"_a_{f}") for f in facts]), on, "full_outer")
    same = F.lit(True)
    for f in facts:
        same = same & F.col(f"_r_{f}").eqNullSafe(F.col(f"_a_{f}"))
    return both.select(on, F.when(F.col("_a").isNull(), "gone").when(F.col("_r").isNull(), "new").when(same, "same").otherwise("changed").alias("state"))


def merge_registry(current: DataFrame, proposed: DataFrame, key: str, value: list[str], approved: Column) -> tuple[DataFrame, DataFrame]:
    """(merged, conflicts): approved rows stay as they are; a differing proposal for one is a conflict; else it wins."""
    c = current.select(key, *[F.col(v).alias(f"_c_{v}") for v in value], approved.alias("_ok"), F.lit(True).alias("_c"))
    p = proposed.select(key, *[F.col(v).alias(f"_p_{v}") for v in value], F.lit(True).alias("_p"))
    both = c.join(p, key, "full_outer")
    keep = F.col("_p").isNull() | F.coalesce("_ok", F.lit(False))
    merged = both.select(key, *[F.when(keep, F.col(f"_c_{v}")).otherwise(F.col(f"_p_{v}")).alias(v) for v in value])
    same = F.lit(True)
    for v in value:
        same = same & F.col(f"_c_{v}").eqNullSafe(F.col(f"_p_{v}"))
    conflicts = both.where(F.col("_c").isNotNull() & F.col("_p").isNotNull() & F.coalesce("_ok", F.lit(False)) & ~same).select(key, *[F.col(f"_p_{v}").alias(v) for v in value])
    return merged, conflicts


def apply_decisions(entries: DataFrame, decisions: DataFrame, key: str, status: str) -> tuple[DataFrame, DataFrame]:
    """(entries with the decided status, decisions of unknown keys)."""
    d = decisions.select(key, F.col(status).alias("_decided"))
    done = entries.join(d, key, "left").withColumn(status, F.coalesce("_decided", F.col(status))).drop("_decided")
    return done, decisions.join(entries.select(key), key, "left_anti")


def fold_verdict(findings: DataFrame, by: list[str], status: str = "status") -> DataFrame:
    """Worst status of each group with counts: pass 0 < not_run 1 < review 2 < fail 3."""
    rank = F.create_map(*[x for k, v in RANK.items() for x in (F.lit(k), F.lit(v))])[F.col(status)]
    out = findings.groupBy(*by).agg(F.max(rank).alias("_worst"), *[F.sum(F.when(F.col(status) == k, 1).otherwise(0)).cast("long").alias(f"n_{k}") for k in RANK])
    name = F.element_at(F.array(*[F.lit(k) for k in RANK]), F.col("_worst") + 1)
    return out.select(*by, name.alias("verdict"), *[f"n_{k}" for k in RANK])


def stage_plan(stages: DataFrame, folded: DataFrame, stage: str) -> DataFrame:
    """Every planned stage with its verdict; a stage without findings is ``not_run``."""
    return stages.join(folded, stage, "left").withColumn("verdict", F.coalesce("verdict", F.lit("not_run")))


def roll_up(checks: DataFrame, by: list[str], status: str = "status") -> DataFrame:
    """A run passes only if every check passes: ``passed, exit_code`` (0 pass, 1 any fail, 2 else) and counts."""
    n = lambda k: F.sum(F.when(F.col(status) == k, 1).otherwise(0)).cast("long")
    out = checks.groupBy(*by).agg(F.count("*").alias("checks"), n("pass").alias("passes"), n("fail").alias("fails"))
    code = F.when(F.col("fails") > 0, 1).when(F.col("passes") < F.col("checks"), 2).otherwise(0)
    return out.withColumn("passed", F.col("passes") == F.col("checks")).withColumn("exit_code", code)


def material_group(df: DataFrame, ranges: DataFrame, material: str) -> DataFrame:
    """``material_group`` of an id by range; 0 is ``unassigned``, an id of no range ``out_of_range``."""
    found = df.join(bounded(ranges), (F.col(material) >= F.col("first_id")) & (F.col(material) <= F.col("last_id")), "left").drop("first_id", "last_id")
    return found.withColumn("material_group", F.when(F.col(material) == 0, "unassigned").otherwise(F.coalesce("material_group", F.lit("out_of_range"))))


def assign_materials(df: DataFrame, by_mesh: DataFrame, by_slot: DataFrame) -> DataFrame:
    """Material of each row: that of its mesh name, else of its slot, else 0."""
    out = df.join(bounded(by_mesh), "mesh", "left").join(bounded(by_slot), "slot", "left")
    return out.withColumn("material", F.coalesce("mesh_material", "slot_material", F.lit(0))).drop("mesh_material", "slot_material")


def expand_instances(objects: DataFrame, types: DataFrame, on: str) -> DataFrame:
    """Placed objects with the rows of their type."""
    return objects.join(types, on)


def first_wins(df: DataFrame, key: list[str], order: list) -> DataFrame:
    """One row for each key: the first in the order."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where("_n = 1").drop("_n")


def budget(facts: DataFrame, limits: DataFrame, by: list[str], role: str, amount: str) -> DataFrame:
    """Sum of each group and role against its limit; a role without a limit is ``not_measured``."""
    out = facts.groupBy(*by, role).agg(F.sum(amount).alias("total")).join(bounded(limits), role, "left")
    return out.withColumn("status", F.when(F.col("most").isNull(), "not_measured").when(F.col("total") <= F.col("most"), "pass").otherwise("fail"))


def duplicate_files(files: DataFrame, content: str, most_bytes: int) -> DataFrame:
    """Contents up to a size that several files have: ``digest, files, bytes, first_id``."""
    sized = files.where(F.octet_length(content) <= most_bytes)
    return sized.groupBy(F.sha2(F.col(content), 256).alias("digest")).agg(F.count("*").alias("files"), F.max(F.octet_length(content)).cast("long").alias("bytes"), F.min("id").alias("first_id")).where("files > 1")


def usage_stats(log: DataFrame, known: DataFrame, name: str) -> DataFrame:
    """Uses of every known name (0: never used) and of names that aren't known (``other``)."""
    used = log.groupBy(name).agg(F.count("*").alias("uses"))
    out = known.select(name, F.lit(True).alias("_known")).join(used, name, "full_outer")
    uses = F.coalesce("uses", F.lit(0)).cast("long")
    return out.select(name, uses.alias("uses"), F.when(F.col("_known").isNull(), "other").when(uses == 0, "never").otherwise("known").alias("kind"))


def area_conservation(children: DataFrame, parents: DataFrame, on: str, tol: float) -> DataFrame:
    """Area of each parent against the sum of its children."""
    summed = children.groupBy(on).agg(F.sum("area").alias("child_area"), F.count("*").alias("children"))
    out = parents.select(on, F.col("area").alias("parent_area")).join(summed, on, "full_outer")
    gap = F.abs(F.coalesce("child_area", F.lit(0.0)) - F.coalesce("parent_area", F.lit(0.0)))
    return out.withColumn("kept", gap <= tol).withColumn("children", F.coalesce("children", F.lit(0)))


def exposed_faces(cells: DataFrame, axes: tuple[str, ...] = ("i", "j", "k")) -> DataFrame:
    """Occupied cells whose neighbour along an axis is free: ``model_id, axis, side, i, j, k``.

    One pass for each axis: along a line of cells, a gap before or after is a free neighbour.
    """
    parts = []
    for axis in axes:
        rest = [a for a in axes if a != axis]
        w = Window.partitionBy("model_id", *rest).orderBy(axis)
        seen = cells.select("model_id", *axes).distinct().withColumn("_p", F.lag(axis).over(w)).withColumn("_n", F.lead(axis).over(w))
        low = seen.where(F.col("_p").isNull() | (F.col("_p") < F.col(axis) - 1)).select("model_id", F.lit(axis).alias("axis"), F.lit(-1).alias("side"), *axes)
        high = seen.where(F.col("_n").isNull() | (F.col("_n") > F.col(axis) + 1)).select("model_id", F.lit(axis).alias("axis"), F.lit(1).alias("side"), *axes)
        parts += [low, high]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def cell_rectangles(cells: DataFrame) -> DataFrame:
    """Rectangles that cover the plan cells (i, j) of each model once: row runs, equal runs joined over rows."""
    row = Window.partitionBy("model_id", "j").orderBy("i")
    runs = cells.select("model_id", "i", "j").distinct().withColumn("_g", F.col("i") - F.row_number().over(row)).groupBy("model_id", "j", "_g").agg(F.min("i").alias("i0"), F.max("i").alias("i1"))
    col = Window.partitionBy("model_id", "i0", "i1").orderBy("j")
    joined = runs.withColumn("_h", F.col("j") - F.row_number().over(col))
    return joined.groupBy("model_id", "i0", "i1", "_h").agg(F.min("j").alias("j0"), F.max("j").alias("j1")).drop("_h")


def compare_values(a: DataFrame, b: DataFrame, on: list[str], value: str, tol: float) -> DataFrame:
    """Scalar rows of two specs: ``match``, ``no_match`` or ``deferred`` (one side lacks it); raw values decide."""
    both = a.select(*on, F.col(value).alias("left_value")).join(b.select(*on, F.col(value).alias("right_value")), on, "full_outer")
    gap = F.abs(F.col("left_value") - F.col("right_value"))
    return both.withColumn("verdict", F.when(gap.isNull(), "deferred").when(gap <= tol + 1e-9, "match").otherwise("no_match"))
