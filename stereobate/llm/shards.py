"""Sharding by sampled splitters: nearly equal bytes in every shard, equal texts together where they fit.

The key of a row is (hash of its text, doc_id, a tie that tells equal rows apart). A size-weighted sample of keys gives
the quantile boundaries of many fine ranges. A boundary inside a group of equal texts, which only a group larger than a
range draws, also names a doc_id, and one inside a doc_id of that group a tie: so overfull ranges are subdivided,
however many rows are equal. The ranges' exact sizes and counts, one row each, then place every row in the running
total of bytes, which is cut into shards.

A null text has size 8 and the hash of an empty text. Rows without a doc_id come first in their group. Repeated rows
are placed one after another; which of them comes first makes no difference. An empty table gives an empty result.
Texts of any length are read in the JVM only; other columns are left alone. The driver holds OVERSAMPLE keys for each
range and at most MOST_RANGES ranges.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from stereobate.llm._io import save

#: Sampled keys for each range, and the most ranges; together they bound what the driver holds (about 8 MB).
OVERSAMPLE, MOST_RANGES = 32, 8192
#: A group of equal texts stays together while its bytes are at most this share of a shard.
WHOLE_GROUP = 0.02
LOWEST = -(1 << 63)


def _find(splits: list[tuple[int, int, int]]):
    """Range of each (group, doc_id, tie): the number of splitters at or below it."""
    groups = np.array([g for g, _, _ in splits], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            group = batch.column("group_key").to_numpy()
            low, at = np.searchsorted(groups, group, "left"), np.searchsorted(groups, group, "right")
            several = np.flatnonzero(at > low)
            ids = batch.column("doc_id").fill_null(LOWEST).to_numpy()[several].tolist()
            ties = batch.column("tie").to_numpy()[several].tolist()
            at[several] = [bisect_right(splits, (g, d, t), lo, hi) for g, d, t, lo, hi in zip(group[several].tolist(), ids, ties, low[several].tolist(), at[several].tolist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at.astype(np.int32))], [*batch.schema.names, "range"])

    return run


def _splitters(sample: list[tuple[int, int, int, int]], ranges: int, average: float) -> list[tuple[int, int, int]]:
    """Keys at the weighted quantiles. Only where one group fills several ranges does a splitter name a doc_id, and a tie
    only where one doc_id of a group does."""
    sample = sorted(sample)
    if not sample:
        return []
    weight = np.maximum(np.array([s for *_, s in sample], float), average).cumsum()
    picked = [sample[i][:3] for i in np.searchsorted(weight, weight[-1] * np.arange(1, ranges) / ranges).clip(0, len(sample) - 1)]
    out, before = set(), (None, None)
    for g, d, t in picked:
        out.add((g, d, t) if (g, d) == before else (g, d, LOWEST) if g == before[0] else (g, LOWEST, LOWEST))
        before = (g, d)
    return sorted(out)


def shard_by_bytes(documents: DataFrame, shards: int) -> DataFrame:
    """``documents(doc_id, text)`` -> ``(doc_id, size, text_crc32, shard, slot)``, one row for each row.

    Size is the text's UTF-8 bytes plus 8. Slots number the rows of a shard from 0 without gaps.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = save(documents.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("group_key"), F.xxhash64(F.monotonically_increasing_id()).alias("tie")), "keys")
    rows, total = keyed.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    ranges = int(min(max(shards * 8, rows // 50_000), MOST_RANGES))
    wanted = ranges * OVERSAMPLE
    chance = F.pmod(F.xxhash64("group_key", "doc_id", "tie", F.lit(11)), F.lit(1 << 30)) / float(1 << 30)
    drawn = keyed.where(chance * float(max(total, 1)) < F.col("size") * float(wanted))
    sample = [tuple(r) for r in drawn.select("group_key", F.coalesce("doc_id", F.lit(LOWEST)), "tie", "size").collect()]
    splits = _splitters(sample, ranges, total / wanted)

    cols = "doc_id long, size long, text_crc32 long, group_key long, tie long"
    ranged = save(keyed.mapInArrow(_find(splits), f"{cols}, range int"), "ranged")
    sizes = ranged.groupBy("range").agg(F.sum("size").alias("range_size")).toPandas().sort_values("range")
    starts = dict(zip(sizes["range"].tolist(), (sizes.range_size.cumsum() - sizes.range_size).tolist()))
    order = ["group_key", F.col("doc_id").asc_nulls_first(), "size", "text_crc32", "tie"]
    by_range = Window.partitionBy("range").orderBy(*order)
    before = by_range.rowsBetween(Window.unboundedPreceding, -1)
    group = Window.partitionBy("range", "group_key")
    spark = documents.sparkSession
    start = F.broadcast(spark.createDataFrame(list(starts.items()), "range int, start long"))
    placed = ranged.join(start, "range").withColumn("at", F.col("start") + F.coalesce(F.sum("size").over(before), F.lit(0)))
    placed = placed.withColumn("group_size", F.sum("size").over(group)).withColumn("group_at", F.min("at").over(group))
    per_shard = max(total, 1) / shards
    middle = F.when(F.col("group_size") <= WHOLE_GROUP * per_shard, F.col("group_at") + F.col("group_size") / 2).otherwise(F.col("at") + F.col("size") / 2)
    placed = placed.withColumn("shard", F.least(F.floor(middle / per_shard).cast("int"), F.lit(shards - 1)))
    placed = save(placed.select("doc_id", "size", "text_crc32", "group_key", "tie", "range", "at", "shard"), "placed")
    # Shards and ranges run in the same order, so the cells (shard, range) are few: at most ranges + shards.
    counts = placed.groupBy("shard", "range").agg(F.count("*").alias("n")).toPandas().sort_values(["shard", "range"])
    counts["first"] = counts.groupby("shard")["n"].cumsum() - counts["n"]
    first = F.broadcast(spark.createDataFrame([tuple(map(int, x)) for x in counts[["shard", "range", "first"]].to_numpy()], "shard int, range int, first long"))
    cell = Window.partitionBy("shard", "range").orderBy("at", *order)
    return placed.join(first, ["shard", "range"]).select("doc_id", "size", "text_crc32", "shard", (F.col("first") + F.row_number().over(cell) - 1).cast("long").alias("slot"))
