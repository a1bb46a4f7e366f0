"""One-to-one matching inside small groups, and potentials and clusters over links.

Matching needs a group's candidates together; groups are one storey, wall or object of a model, never a whole fleet.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from stereobate.operators.topology import components


def candidates(a: DataFrame, b: DataFrame, on: list[str], values: dict[str, float]) -> DataFrame:
    """Pairs (a_id, b_id) of equal ``on`` whose values differ by at most their tolerance, and the summed distance.

    Both sides meet in cells of the first value's tolerance and its neighbours, so that only close rows are compared.
    """
    first, tol = next(iter(values.items()))
    cell = F.floor(F.col(first) / tol).cast("long")
    left = a.select(*on, F.col("id").alias("a_id"), *[F.col(v).alias(f"a_{v}") for v in values], F.explode(F.array(cell - 1, cell, cell + 1)).alias("_cell"))
    right = b.select(*on, F.col("id").alias("b_id"), *[F.col(v).alias(f"b_{v}") for v in values], cell.alias("_cell"))
    met = left.join(right, [*on, "_cell"])
    gaps = [F.abs(F.col(f"a_{v}") - F.col(f"b_{v}")) for v in values]
    for gap, most in zip(gaps, values.values()):
        met = met.where(gap <= most + 1e-9)
    return met.select(*on, "a_id", "b_id", sum(gaps[1:], gaps[0]).alias("distance"))


def _layers(near: list[list[int]], mate_a: list[int], mate_b: list[int]) -> list[int] | None:
    """Distance of each a-node from the free ones over alternating edges, as far as the nearest free b-node; None if none is reached."""
    layer = [0 if m < 0 else -1 for m in mate_a]
    rim, ends = [u for u, m in enumerate(mate_a) if m < 0], False
    while rim and not ends:
        beyond = []
        for u in rim:
            for v in near[u]:
                owner = mate_b[v]
                ends |= owner < 0
                if owner >= 0 and layer[owner] < 0:
                    layer[owner] = layer[u] + 1
                    beyond.append(owner)
        rim = beyond
    return layer if ends else None


def largest_matching(near: list[list[int]], n_b: int) -> list[int]:
    """Hopcroft and Karp's matching: for each a-node its b-node or -1; ``near[u]`` lists the b-nodes that ``u`` may take."""
    mate_a, mate_b = [-1] * len(near), [-1] * n_b
    while (layer := _layers(near, mate_a, mate_b)) is not None:
        tried = [0] * len(near)
        for root in [u for u, m in enumerate(mate_a) if m < 0]:
            path = [root]
            while path:
                u = path[-1]
                if tried[u] == len(near[u]):
                    path.pop()
                    continue
                v = near[u][tried[u]]
                tried[u] += 1
                owner = mate_b[v]
                if owner < 0:
                    for x in path:  # every node of the path takes the edge it tried last
                        mate_a[x] = near[x][tried[x] - 1]
                        mate_b[mate_a[x]] = x
                    break
                if layer[owner] == layer[u] + 1:
                    path.append(owner)
    return mate_a


def _by_group(pairs: DataFrame, on: list[str], order: list[str], match) -> DataFrame:
    """``on, a_id, b_id``: the pairs of each ``on`` that ``match`` keeps of them, in ``order``: it takes the a_ids and b_ids
    and gives the numbers of pairs. A task reads its groups one after another, so a small group costs no call of its own."""
    cols = [*on, "a_id", "b_id"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None  # the last group of a batch may go on in the next
        for batch in batches:
            df = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            yield kept(df, ends := starts(df))
            rest = df.iloc[ends[-1] :] if ends else None
        if rest is not None and len(rest):
            yield kept(pd.concat([rest]).reset_index(drop=True), [0, len(rest)])

    def starts(df: pd.DataFrame) -> list[int]:
        """Where each group begins."""
        if not len(df):
            return []
        fresh = (df[on] != df[on].shift()).any(axis=1).to_numpy(copy=True) if on else np.zeros(len(df), bool)
        fresh[0] = True
        return np.flatnonzero(fresh).tolist()

    def kept(df: pd.DataFrame, ends: list[int]) -> pd.DataFrame:
        a, b, found = df.a_id.tolist(), df.b_id.tolist(), []
        for lo, hi in zip(ends, ends[1:]):
            found += [lo + i for i in match(a[lo:hi], b[lo:hi])]
        return df.iloc[found][cols]

    dealt = pairs.repartition(*on) if on else pairs.coalesce(1)
    return dealt.sortWithinPartitions(*on, *order).select(*cols).mapInPandas(run, pairs.select(*cols).schema)


def match_most(pairs: DataFrame, on: list[str]) -> DataFrame:
    """As many candidate pairs as possible with each id used once: ``on, a_id, b_id``."""

    def match(a: list, b: list) -> list[int]:
        a_no, b_no = {x: u for u, x in enumerate(dict.fromkeys(a))}, {x: v for v, x in enumerate(dict.fromkeys(b))}
        near: list[list[int]] = [[] for _ in a_no]
        place = {}
        for i, (x, y) in enumerate(zip(a, b)):
            near[a_no[x]].append(b_no[y])
            place[a_no[x], b_no[y]] = i
        return [place[u, v] for u, v in enumerate(largest_matching(near, len(b_no))) if v >= 0]

    return _by_group(pairs, on, ["a_id", "b_id"], match)


def match_greedy(pairs: DataFrame, on: list[str]) -> DataFrame:
    """Nearest pairs first, then by smaller ids, each id once: ``on, a_id, b_id``."""

    def match(a: list, b: list) -> list[int]:
        used_a, used_b, kept = set(), set(), []
        for i, (x, y) in enumerate(zip(a, b)):
            if x not in used_a and y not in used_b:
                used_a.add(x)
                used_b.add(y)
                kept.append(i)
        return kept

    return _by_group(pairs, on, ["distance", "a_id", "b_id"], match)


def merge_questions(old: DataFrame, new: DataFrame, on: list[str], values: dict[str, float], version: str) -> DataFrame:
    """Questions over versions: a matched one keeps its id and answer; old ones without a match are ``gone``; the rest get new ids."""
    pairs = match_greedy(candidates(old, new, on, values), on).select("a_id", "b_id")
    o = old.select(F.col("id").alias("a_id"), "answer")
    kept = new.select(F.col("id").alias("b_id")).join(pairs, "b_id", "left").join(o, "a_id", "left")
    fresh = kept.select(F.coalesce(F.col("a_id").cast("string"), F.concat(F.lit(f"{version}-"), F.col("b_id"))).alias("id"), "answer", F.when(F.col("a_id").isNull(), "new").otherwise("kept").alias("state"))
    gone = o.join(pairs, "a_id", "left_anti").select(F.col("a_id").cast("string").alias("id"), "answer", F.lit(f"gone {version}").alias("state"))
    return fresh.unionByName(gone)


def cell_clusters(cells: DataFrame, reach: int) -> DataFrame:
    """Plan cells (model_id, i, j) with the cluster of cells within ``reach``: its least cell's hash names it."""
    step = F.explode(F.sequence(F.lit(-reach), F.lit(reach)))
    own = cells.select("model_id", "i", "j").distinct()
    near = own.withColumn("di", step).withColumn("dj", step).select("model_id", (F.col("i") + F.col("di")).alias("i"), (F.col("j") + F.col("dj")).alias("j"), F.xxhash64("model_id", "i", "j").alias("a"))
    links = near.join(own.withColumn("b", F.xxhash64("model_id", "i", "j")), ["model_id", "i", "j"]).select("model_id", "a", "b").where("a < b")
    label = components(own.select(F.xxhash64("model_id", "i", "j").alias("node")), links, within="model_id")
    return own.withColumn("node", F.xxhash64("model_id", "i", "j")).join(label, "node").drop("node")


def ring_cuts(quads: DataFrame) -> DataFrame:
    """Cut count of each quad side, equal over opposite sides of neighbouring quads: ``a, b, cuts``.

    ``quads``: ``face_id, a, b, c, d`` and ``cuts`` of sides ab, bc, cd, da as array; opposite sides of a quad are
    linked, and each component takes its largest count.
    """
    key = lambda p, q: F.xxhash64(F.least(p, q), F.greatest(p, q))
    c = F.col
    sides = [("a", "b"), ("b", "c"), ("c", "d"), ("d", "a")]
    rows = quads.select(F.explode(F.array(*[F.struct(F.least(c(p), c(q)).alias("a"), F.greatest(c(p), c(q)).alias("b"), c("cuts")[i].alias("cuts")) for i, (p, q) in enumerate(sides)])).alias("s")).select("s.*")
    links = quads.select(key(c("a"), c("b")).alias("a"), key(c("c"), c("d")).alias("b")).unionByName(quads.select(key(c("b"), c("c")).alias("a"), key(c("d"), c("a")).alias("b")))
    own = rows.groupBy("a", "b").agg(F.max("cuts").alias("cuts")).withColumn("node", F.xxhash64("a", "b"))
    label = components(own.select("node"), links)
    placed = own.join(label, "node")
    most = placed.groupBy("component").agg(F.max("cuts").alias("most"))
    return placed.join(most, "component").select("a", "b", F.col("most").alias("cuts"))
