"""Nearest neighbours by a forest of random-projection trees.

The trees are fitted on a bounded sample of the distinct vectors; every vector is then put into one leaf of each tree.
A query walks all trees through one priority queue, the branch with the least distance to its splitting planes first,
until the leaves reached hold ``budget`` vectors. Leaf candidates are reranked by their exact cosine. The budget is
measured, not guessed: for a few queries the exact neighbours are found by one pass over all vectors, the forest is
walked until it meets them, and the budget is what the walks needed at the quantile ``RECALL``.

Equal vectors are one entry with their smallest ids, so a large group of copies costs as much as one vector. Leaves
are searched in cells of neighbouring leaves; cells over ``CELL_ROWS`` rows are split into parts and their queries go
to each part, so no cell meets in one task. Nothing is capped: leaves count whole.

Vectors that are null, empty, zero, or that hold null or non-finite components take no part, nor do rows without an id.
Vectors of different lengths have no cosine, so each length is searched for itself. Rows that share an id and a vector
are one. Ties go to the smaller id; cosines that agree to DECIMALS decimals are ties. Empty tables give an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from stereobate.llm._io import save

TREES, LEAF = 8, 192
#: What the driver holds: vectors of the sample that fits the trees, and the planes of all trees.
SAMPLE_BYTES, FOREST_BYTES = 8 << 20, 64 << 20
#: Cosines are ordered by so many decimals: what differs by less is rounding, so that ties go to the smaller id.
DECIMALS = 12
#: Queries on which the budget is measured, and the share of their true neighbours that it must reach.
MEASURED, RECALL = 48, 0.97
CELL_LEAVES, CELL_ROWS, QUERY_BLOCK = 16, 20_000, 128


class Forest:
    """Perfect binary trees in heap order: node i has children 2i+1 and 2i+2; normals and thresholds of each node."""

    def __init__(self, sample: np.ndarray, n: int, seed: int = 3):
        rng = np.random.default_rng(seed)
        most = np.log2(FOREST_BYTES / (4 * TREES * sample.shape[1]))
        self.depth = int(np.clip(np.ceil(np.log2(max(n, 1) / LEAF)), 0, max(0, min(most, np.log2(max(len(sample), 1) / 4)))))
        inner = (1 << self.depth) - 1
        dim = sample.shape[1]
        self.normals = np.zeros((TREES, inner, dim), np.float32)
        self.cuts = np.zeros((TREES, inner), np.float32)
        for t in range(TREES):
            inside = {0: np.arange(len(sample))}
            for node in range(inner):
                rows = inside.pop(node)
                if len(rows) > 1:
                    a, b = rng.choice(rows, 2, replace=False)
                    normal = sample[a] - sample[b]
                else:
                    normal = rng.normal(size=dim)
                if not np.any(normal):
                    normal = rng.normal(size=dim)
                normal = (normal / np.linalg.norm(normal)).astype(np.float32)
                side = sample[rows] @ normal
                self.normals[t, node], self.cuts[t, node] = normal, np.median(side) if len(rows) else 0
                inside[2 * node + 1], inside[2 * node + 2] = rows[side < self.cuts[t, node]], rows[side >= self.cuts[t, node]]

    def leaves(self, unit: np.ndarray) -> np.ndarray:
        """Leaf of each vector in each tree."""
        out = np.zeros((len(unit), TREES), np.int64)
        for t in range(TREES):
            node = np.zeros(len(unit), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (np.einsum("ij,ij->i", unit, self.normals[t][node]) >= self.cuts[t][node])
            out[:, t] = node - ((1 << self.depth) - 1)
        return out

    def search(self, unit: np.ndarray, sizes: np.ndarray, budget: int) -> Iterator[tuple[int, int, int]]:
        """(query, tree, leaf) of the leaves to look in; ``sizes[tree, leaf]`` is what a leaf holds."""
        inner = (1 << self.depth) - 1
        for q, vector in enumerate(unit):
            margins = self.normals @ vector - self.cuts
            queue, found = [(0.0, t, 0) for t in range(TREES)], 0
            while queue and found < budget:
                far, t, node = heapq.heappop(queue)
                while node < inner:
                    m = float(margins[t, node])
                    near = 2 * node + 1 + (m >= 0)
                    heapq.heappush(queue, (max(far, abs(m)), t, 4 * node + 3 - near))
                    node = near
                size = int(sizes[t, node - inner])
                if size:
                    found += size
                    yield q, t, node - inner


def _exact(shared, k: int):
    """The best ``k`` of each batch for each measured query, itself left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, q = shared.value
        for batch in batches:
            if batch.num_rows:
                x = batch.column("vector").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(batch.num_rows, -1)
                reps = batch.column("rep").to_numpy()
                cosine = (q @ x.T) / np.sqrt(np.einsum("ij,ij->i", x, x))
                cosine[names[:, None] == reps] = -np.inf
                best = np.argsort(-cosine, axis=1)[:, :k]
                raw = pa.array([x[i].tobytes() for i in best.ravel()], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(names, best.shape[1])), pa.array(np.take_along_axis(cosine, best, 1).ravel()), raw], ["query", "score", "raw"])

    return run


def _budget(forest: Forest, sizes: np.ndarray, queries: np.ndarray, truth: list[np.ndarray]) -> int:
    """Vectors that the walks of the queries pass before they meet the RECALL quantile of their true neighbours."""
    needed = []
    for q, near in zip(queries, truth):
        homes: dict[tuple[int, int], set[int]] = {}
        for i, row in enumerate(forest.leaves(near)):
            for t, leaf in enumerate(row):
                homes.setdefault((t, int(leaf)), set()).add(i)
        passed, open_ = 0, set(range(len(near)))
        for _, t, leaf in forest.search(q[None, :], sizes, int(sizes.sum()) + 1):
            passed += int(sizes[t, leaf])
            met = open_ & homes.get((t, int(leaf)), set())
            needed += [passed] * len(met)
            open_ -= met
            if not open_:
                break
    return int(np.quantile(needed, RECALL)) + 1 if needed else 1


def _vectors(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.float64).reshape(len(column), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    return (x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]).astype(np.float32)


def _placed(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if n:
                x = batch.column("vector").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1)
                leaf = shared.value.leaves(_unit(x)).ravel()
                raw = np.repeat(np.array([v.tobytes() for v in x], object), TREES)
                ids = np.repeat(batch.column("rep").to_numpy(), TREES)
                tree = np.tile(np.arange(TREES, dtype=np.int32), n)
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(raw, pa.binary()), pa.array(tree), pa.array(leaf.astype(np.int32))], ["rep", "raw", "tree", "leaf"])

    return run


def _asked(shared, sizes, budget: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = batch.column("vector").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(batch.num_rows, -1)
                hits = np.array(list(shared.value.search(_unit(x), sizes.value, budget)), np.int64).reshape(-1, 3)
                raw = np.array([v.tobytes() for v in x], object)[hits[:, 0]]
                yield pa.RecordBatch.from_arrays([pa.array(batch.column("rep").to_numpy()[hits[:, 0]]), pa.array(raw, pa.binary()), pa.array(hits[:, 1].astype(np.int32)), pa.array(hits[:, 2].astype(np.int32))], ["query", "raw", "tree", "leaf"])

    return run


def _best(name: np.ndarray, rep: np.ndarray, score: np.ndarray, most: int) -> np.ndarray:
    """Places of the ``most`` largest scores of each name, ties to the smaller rep."""
    order = np.lexsort((rep, -np.round(score, DECIMALS), name))
    held = name[order]
    begin = np.flatnonzero(np.concatenate(([True], held[1:] != held[:-1]))) if len(held) else np.zeros(0, int)
    place = np.arange(len(held)) - np.repeat(begin, np.diff(np.concatenate((begin, [len(held)]))))
    return order[place < most]


def _rerank(most: int):
    """The best candidates of each query in the leaves of one cell (a tree holds each vector once)."""

    def run(key, queries: pd.DataFrame, members: pd.DataFrame) -> pd.DataFrame:
        names, reps, scores = [], [], []
        held = {leaf: g for leaf, g in members.groupby("leaf")} if len(members) else {}
        for leaf, asked in queries.groupby("leaf") if len(queries) else ():
            if leaf not in held:
                continue
            rep, v = held[leaf].rep.to_numpy(), _vectors(held[leaf].raw)
            length = np.sqrt(np.einsum("ij,ij->i", v, v))
            k = min(most, len(rep))
            for at in range(0, len(asked), QUERY_BLOCK):
                block = asked.iloc[at : at + QUERY_BLOCK]
                q = _vectors(block.raw)
                cosine = (q @ v.T) / (length * np.sqrt(np.einsum("ij,ij->i", q, q))[:, None])
                # All that may tie with the k-th are scored exactly; the smaller ids among equals stay.
                i, j = np.nonzero(cosine >= np.partition(cosine, len(rep) - k, axis=1)[:, len(rep) - k, None] - 1e-9)
                exact = np.einsum("ij,ij->i", v[j], q[i]) / (length[j] * np.sqrt(np.einsum("ij,ij->i", q, q))[i])
                kept = _best(i, rep[j], exact, most)
                names.append(block["query"].to_numpy()[i[kept]])
                reps.append(rep[j[kept]])
                scores.append(exact[kept])
        if not names:
            return pd.DataFrame({"query": np.zeros(0, np.int64), "rep": np.zeros(0, np.int64), "score": np.zeros(0)})
        name, rep, score = np.concatenate(names), np.concatenate(reps), np.concatenate(scores)
        kept = _best(name, rep, score, most)
        return pd.DataFrame({"query": name[kept], "rep": rep[kept], "score": score[kept]})

    return run


def nearest(embeddings: DataFrame, is_query, k: int = 5, budget: int | None = None) -> DataFrame:
    """``embeddings(vec_id, embedding)`` -> ``(query_id, rank, vec_id, score)`` for the rows where ``is_query`` holds."""
    spark = embeddings.sparkSession
    e = F.col("embedding")
    clean = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), e.cast("array<double>").alias("embedding"), F.coalesce(is_query, F.lit(False)).alias("asked")).where("vec_id is not null and embedding is not null and size(embedding) > 0")
    clean = clean.where(F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(e, lambda x: x != 0))
    # Vectors have a cosine with those of their own length only; each length is searched for itself.
    lengths = sorted(r.d for r in clean.where("asked").select(F.size("embedding").alias("d")).distinct().collect())
    if not lengths:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return reduce(DataFrame.unionByName, [_nearest(clean.where(F.size("embedding") == d), d, k, budget) for d in lengths])


def _nearest(clean: DataFrame, dim: int, k: int, budget: int | None) -> DataFrame:
    spark = clean.sparkSession
    keys = [F.xxhash64("embedding").alias("k1"), F.xxhash64(F.lit(1), "embedding").alias("k2")]
    rows = save(clean.select("vec_id", "asked", *keys), "ids").dropDuplicates(["vec_id", "k1", "k2"])
    salt = F.pmod(F.xxhash64("vec_id"), F.lit(256))
    part = Window.partitionBy("k1", "k2", "salt").orderBy("vec_id")
    whole = Window.partitionBy("k1", "k2").orderBy("vec_id")
    first = rows.withColumn("salt", salt).withColumn("n", F.row_number().over(part)).where(F.col("n") <= k + 1).withColumn("n", F.row_number().over(whole)).where(F.col("n") <= k + 1)
    classes = save(first.groupBy("k1", "k2").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).withColumn("rep", F.col("ids")[0]), "classes")
    asked = rows.where("asked").groupBy("k1", "k2").agg(F.lit(True).alias("asked"))
    reps = clean.select(F.col("vec_id").alias("rep"), "embedding", *keys).join(classes.select("rep", "k1", "k2"), ["rep", "k1", "k2"], "left_semi").dropDuplicates(["rep", "k1", "k2"])
    reps = save(reps.join(asked, ["k1", "k2"], "left").select("rep", F.col("embedding").alias("vector"), F.coalesce("asked", F.lit(False)).alias("asked")), "reps")
    n = reps.count()
    chance = F.pmod(F.xxhash64("rep", F.lit(9)), F.lit(1 << 30)) / float(1 << 30)
    drawn = reps.where(chance < SAMPLE_BYTES / (8 * dim) / n).select("rep", "vector").sort("rep").toArrow()
    sample = drawn.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim) if drawn.num_rows else np.array([reps.sort("rep").first().vector])
    forest = Forest(_unit(sample), n)
    shared = spark.sparkContext.broadcast(forest)

    placed = save(reps.select("rep", "vector").mapInArrow(_placed(shared), "rep long, raw binary, tree int, leaf int"), "placed")
    counts = placed.groupBy("tree", "leaf").count().toPandas()  # a row for each leaf
    sizes = np.zeros((TREES, 1 << forest.depth), np.int64)
    sizes[counts.tree, counts.leaf] = counts["count"]
    if budget is None:
        some = reps.where("asked").orderBy(F.xxhash64("rep", F.lit(4))).limit(MEASURED).collect()
        asked_vectors = np.array([r.vector for r in some]) if some else np.zeros((0, dim))
        names = np.array([r.rep for r in some], np.int64)
        best = Window.partitionBy("query").orderBy(F.desc("score"))
        exact = reps.select("rep", "vector").mapInArrow(_exact(spark.sparkContext.broadcast((names, asked_vectors)), k), "query long, score double, raw binary")
        exact = exact.where("score > double('-infinity')").withColumn("n", F.row_number().over(best)).where(F.col("n") <= k).collect() if some else []
        truth = [[r.raw for r in exact if r["query"] == name] for name in names]
        held = [i for i, x in enumerate(truth) if x]
        budget = _budget(forest, sizes, _unit(asked_vectors[held]), [_unit(_vectors(truth[i])) for i in held]) if held else 1
    budget = max(budget, TREES * (k + 1))
    queries = reps.where("asked").select("rep", "vector").repartition(max(1, min(spark.sparkContext.defaultParallelism, n // 50_000 + 6)))
    hits = save(queries.mapInArrow(_asked(shared, spark.sparkContext.broadcast(sizes), budget), "query long, raw binary, tree int, leaf int"), "hits")

    cell = F.floor(F.col("leaf") / CELL_LEAVES).cast("int")
    cells = placed.groupBy("tree", cell.alias("cell")).agg(F.ceil(F.count("*") / F.lit(CELL_ROWS)).cast("int").alias("parts"))
    asked_cells = hits.groupBy("tree", cell.alias("cell")).agg(F.ceil(F.count("*") / F.lit(CELL_ROWS)).cast("int").alias("blocks"))
    both = F.broadcast(cells.join(asked_cells, ["tree", "cell"]))  # a row for CELL_LEAVES leaves
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    members = placed.withColumn("cell", cell).join(both, ["tree", "cell"]).withColumn("part", F.pmod(F.xxhash64("rep"), "parts").cast("int")).withColumn("block", spread("blocks"))
    wanted = hits.withColumn("cell", cell).join(both, ["tree", "cell"]).withColumn("block", F.pmod(F.xxhash64("query"), "blocks").cast("int")).withColumn("part", spread("parts"))
    by = ["tree", "cell", "part", "block"]
    found = wanted.select(*by, "leaf", "query", "raw").groupBy(*by).cogroup(members.select(*by, "leaf", "rep", "raw").groupBy(*by)).applyInPandas(_rerank(k + 1), "query long, rep long, score double")
    best = save(found.groupBy("query", "rep").agg(F.max("score").alias("score")), "best")
    top = Window.partitionBy("query").orderBy(F.desc(F.round("score", DECIMALS)), "vec_id")
    listed = best.join(classes.select("rep", "ids"), "rep").select("query", "score", F.explode("ids").alias("vec_id")).withColumn("n", F.row_number().over(top)).where(F.col("n") <= k + 1).drop("n")
    asking = rows.where("asked").join(classes.select("k1", "k2", F.col("rep").alias("query")), ["k1", "k2"]).select(F.col("vec_id").alias("query_id"), "query")
    ranks = Window.partitionBy("query_id").orderBy(F.desc(F.round("score", DECIMALS)), "vec_id")
    out = asking.join(listed, "query").where("query_id <> vec_id").withColumn("rank", F.row_number().over(ranks)).where(F.col("rank") <= k)
    return out.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
