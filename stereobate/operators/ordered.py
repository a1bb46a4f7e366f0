"""Windows and ordered folds: clusters and runs on a line, rings, ledgers, sequences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def cluster_gap(df: DataFrame, by: list[str], lo: str, hi: str, tol: float) -> DataFrame:
    """Number (from 1) of the cluster of each interval: a new one begins where the gap to all before exceeds ``tol``."""
    order = Window.partitionBy(*by).orderBy(lo, hi)
    reach = F.max(hi).over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.when(reach.isNull() | (F.col(lo) - reach > tol), 1).otherwise(0)
    return df.withColumn("_fresh", fresh).withColumn("cluster", F.sum("_fresh").over(order.rowsBetween(Window.unboundedPreceding, 0))).drop("_fresh")


def merge_runs(df: DataFrame, by: list[str], lo: str, hi: str, tol: float) -> DataFrame:
    """Intervals joined over gaps up to ``tol``: ``by, cluster, lo, hi, parts``."""
    return cluster_gap(df, by, lo, hi, tol).groupBy(*by, "cluster").agg(F.min(lo).alias("lo"), F.max(hi).alias("hi"), F.count("*").alias("parts"))


def cluster_span(df: DataFrame, by: list[str], value: str, tol: float) -> DataFrame:
    """Clusters anchored at their first value: ``by, anchor, members``; a value over anchor + tol opens a new one.

    The anchor depends on all values before, so this folds over the distinct sorted values of each group.
    """
    values = F.array_sort(F.collect_set(value))
    empty = F.array().cast("array<double>")
    anchors = lambda v: F.aggregate(v, empty, lambda acc, x: F.when((F.size(acc) == 0) | (x - F.element_at(acc, -1) > tol), F.concat(acc, F.array(x))).otherwise(acc))
    found = df.groupBy(*by).agg(values.alias("v")).select(*by, anchors(F.col("v")).alias("anchors"))
    met = df.select(*by, F.col(value).alias("value")).join(found, by)
    anchor = F.array_max(F.filter("anchors", lambda a: a <= F.col("value")))
    return met.groupBy(*by, anchor.alias("anchor")).agg(F.count("*").alias("members"))


def height_spans(heights: DataFrame, by: list[str], z: str, least: float) -> DataFrame:
    """Gaps between neighbouring distinct heights of at least ``least`` and their middles: ``by, lo, hi, middle``."""
    order = Window.partitionBy(*by).orderBy(z)
    spans = heights.select(*by, z).distinct().select(*by, F.col(z).alias("lo"), F.lead(z).over(order).alias("hi"))
    return spans.where(F.col("hi") - F.col("lo") >= least).withColumn("middle", (F.col("lo") + F.col("hi")) / 2)


def ring_turns(ring: DataFrame, by: list[str], order: str) -> DataFrame:
    """Signed turn in degrees at each ring vertex (x, y), and twice the shoelace term of its outgoing side."""
    w = Window.partitionBy(*by).orderBy(order)
    last = Window.partitionBy(*by).orderBy(F.desc(order))
    nxt = {c: F.coalesce(F.lead(c).over(w), F.first(c).over(w)) for c in "xy"}
    prev = {c: F.coalesce(F.lag(c).over(w), F.first(c).over(last)) for c in "xy"}
    d = ring.select(*by, order, "x", "y", *[v.alias(f"{c}n") for c, v in nxt.items()], *[v.alias(f"{c}p") for c, v in prev.items()])
    ux, uy, vx, vy = F.col("x") - F.col("xp"), F.col("y") - F.col("yp"), F.col("xn") - F.col("x"), F.col("yn") - F.col("y")
    turn = F.degrees(F.atan2(ux * vy - uy * vx, ux * vx + uy * vy))
    return d.select(*by, order, turn.alias("turn"), (F.col("x") * F.col("yn") - F.col("xn") * F.col("y")).alias("term"))


def ring_area(ring: DataFrame, by: list[str], order: str) -> DataFrame:
    """Signed area of each ring; positive runs against the clock."""
    return ring_turns(ring, by, order).groupBy(*by).agg((F.sum("term") / 2).alias("area"))


def latest(df: DataFrame, by: list[str], order: list[Column]) -> DataFrame:
    """The first row of each group in the given order."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where("_n = 1").drop("_n")


def repeat_failures(attempts: DataFrame, by: list[str], order: str, reason: str) -> DataFrame:
    """Failed attempts whose reason is that of the attempt before: the stop rule."""
    w = Window.partitionBy(*by).orderBy(order)
    return attempts.withColumn("_before", F.lag(reason).over(w)).where(F.col(reason).isNotNull() & (F.col("_before") == F.col(reason))).drop("_before")


def last_before(events: DataFrame, by: list[str], order: list[str], is_mark: Column, value: Column, name: str) -> DataFrame:
    """Each event with the value of the last marked event strictly before it."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return events.withColumn(name, F.last(F.when(is_mark, value), ignorenulls=True).over(w))


def no_gaps(df: DataFrame, by: list[str], value: str, start: int | None = None) -> DataFrame:
    """``by, lo, hi, kinds, whole``: whether the distinct values run without gaps (from ``start``, if given)."""
    out = df.groupBy(*by).agg(F.min(value).alias("lo"), F.max(value).alias("hi"), F.countDistinct(value).alias("kinds"))
    whole = F.col("hi") - F.col("lo") + 1 == F.col("kinds")
    return out.withColumn("whole", whole if start is None else whole & (F.col("lo") == start))


def ordinals(df: DataFrame, by: list[str], order: list, fmt: str) -> DataFrame:
    """Stable ids ``<by>_<number>`` in the order of each group."""
    n = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("ordinal", F.format_string(fmt, *[F.col(c) for c in by], n))


def top_n(df: DataFrame, by: list[str], order: list, n: int) -> DataFrame:
    """The first ``n`` rows of each group, with their ``rank``."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order)).cast("long")).where(F.col("rank") <= n)


def smooth(grid: DataFrame, value: str, quantum: float) -> DataFrame:
    """Height field ``i, j, value``: the median of the 5x5 cells round each cell, to a multiple of ``quantum``."""
    step = F.explode(F.sequence(F.lit(-2), F.lit(2)))
    spread = grid.withColumn("di", step).withColumn("dj", step).select((F.col("i") + F.col("di")).alias("i"), (F.col("j") + F.col("dj")).alias("j"), value)
    middle = spread.groupBy("i", "j").agg(F.median(value).alias("m"))
    return grid.select("i", "j").join(middle, ["i", "j"]).select("i", "j", (F.bround(F.col("m") / quantum) * quantum).alias(value))


def gauge(events: DataFrame, by: list[str], order: list[str], is_reset: Column, amount: Column, thresholds: list[float]) -> DataFrame:
    """The first event of each stretch between resets at which the running amount reaches a threshold."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    placed = events.withColumn("stretch", F.sum(F.when(is_reset, 1).otherwise(0)).over(w)).withColumn("_amount", F.when(is_reset, 0.0).otherwise(amount))
    s = Window.partitionBy(*by, "stretch").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    run = placed.withColumn("total", F.sum("_amount").over(s)).withColumn("threshold", F.explode(F.array(*[F.lit(float(t)) for t in thresholds]))).where("total >= threshold")
    first = Window.partitionBy(*by, "stretch", "threshold").orderBy(*order)
    return run.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n", "_amount")


def expand_runs(floors: DataFrame, by: list[str], level: str, template: str) -> DataFrame:
    """Floors with the values of the last floor before them that is not typical: run-length coding undone.

    ``template`` is null on a floor that repeats the one before.
    """
    w = Window.partitionBy(*by).orderBy(level).rowsBetween(Window.unboundedPreceding, 0)
    return floors.withColumn(template, F.last(template, ignorenulls=True).over(w))


def collapse_runs(floors: DataFrame, by: list[str], level: str, value: str, tol: float) -> DataFrame:
    """Runs of neighbouring levels whose value is within ``tol`` of the one before and of the run's first.

    ``by, first_level, last_level, floors``. The run's first value is state, so this folds over sorted levels.
    """
    rows = floors.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct(F.col(level).cast("double").alias("l"), F.col(value).cast("double").alias("v")))).alias("f"))
    run = "array<struct<first:double,last:double,head:double,tail:double,n:bigint>>"

    def step(acc, x):
        top = F.element_at(acc, -1)
        fits = (F.size(acc) > 0) & (F.abs(x["v"] - top["tail"]) <= tol) & (F.abs(x["v"] - top["head"]) <= tol)
        more = F.struct(top["first"].alias("first"), x["l"].alias("last"), top["head"].alias("head"), x["v"].alias("tail"), (top["n"] + 1).alias("n"))
        new = F.struct(x["l"].alias("first"), x["l"].alias("last"), x["v"].alias("head"), x["v"].alias("tail"), F.lit(1).cast("long").alias("n"))
        return F.when(fits, F.concat(F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))), F.array(more))).otherwise(F.concat(acc, F.array(new))).cast(run)

    folded = rows.select(*by, F.explode(F.aggregate("f", F.array().cast(run), lambda a, x: F.when(F.size(a) == 0, F.array(F.struct(x["l"].alias("first"), x["l"].alias("last"), x["v"].alias("head"), x["v"].alias("tail"), F.lit(1).cast("long").alias("n"))).cast(run)).otherwise(step(a, x)))).alias("r"))
    return folded.select(*by, F.col("r.first").alias("first_level"), F.col("r.last").alias("last_level"), F.col("r.n").alias("floors"))


def numbered(df: DataFrame, groups: list[str], order: list[str], name: str) -> DataFrame:
    """``df`` with its place from 1 in the order of ``groups`` then ``order``, without one task that holds all rows.

    Rows are numbered inside a group; what comes before a group is a running sum over one row for each group.
    """
    sizes = df.groupBy(*groups).agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy(*groups).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inside = F.row_number().over(Window.partitionBy(*groups).orderBy(*order))
    return df.withColumn("_i", inside).join(sizes.withColumn("_before", before), groups).withColumn(name, (F.col("_i") + F.col("_before")).cast("long")).drop("_i", "_n", "_before")
