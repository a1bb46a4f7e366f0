"""Mixing sources to target weights over a time-varying curriculum, in DataFrame functions only.

Every source offers its documents as one stream of words in a fixed pseudo-random order (by the md5 of the doc_id).
A source's target is its share of the whole by weight, at most ``epochs`` times its size. Its weight schedule over the
training run is integrated; inverting the cumulative demand gives each word of the stream its position in the run,
and documents are range-sorted by position.

Running sums never meet a whole source in one task: the stream of a source is cut into ``CELLS`` cells by the leading
digits of the md5, sums run inside a cell, and cells are added up on a table of one row for each source and cell.

Null texts have size 0. The null source is a source of its own and comes last. Sources whose words are all taken up
to their cap keep the cap; an empty table gives an empty result. Repeated rows count as often as they occur.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from stereobate.llm._io import save

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
#: Weight of a source at the beginning and the end of the run, by its place in WEIGHTS: fading, even, growing.
SCHEDULES = ((1.5, 0.5), (1.0, 1.0), (0.5, 1.5))
CELL_DIGITS = 3


def _by_rank(values: tuple, rank: Column) -> Column:
    return F.element_at(F.array(*[F.lit(float(v)) for v in values]), (F.pmod(rank - 1, F.lit(len(values))) + 1).cast("int"))


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = 1.5, epochs: float = 2.0) -> DataFrame:
    """``sizes(source, source_size)`` -> the same with ``rank, weight, target``: one row for each source.

    Targets are the least of ``epochs`` times the size and ``level`` times the weight, where ``level`` makes them sum
    to ``share`` of all sizes. Its windows hold a row for each source, never documents.
    """
    everything = Window.partitionBy()
    by_room = Window.orderBy("room", "rank").rowsBetween(Window.unboundedPreceding, -1)
    ranked = (
        sizes.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
        .withColumn("weight", _by_rank(weights, F.col("rank")))
        .withColumn("cap", F.col("source_size") * F.lit(epochs))
        .withColumn("room", F.col("cap") / F.col("weight"))
    )
    left = F.lit(share) * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(by_room), F.lit(0.0))
    weight_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(by_room), F.lit(0.0))
    levelled = ranked.withColumn("level_here", left / weight_left)
    level = F.min(F.when(F.col("level_here") <= F.col("room"), F.struct("room", "rank", "level_here"))).over(everything)["level_here"]
    return levelled.withColumn("level", level).withColumn("target", F.coalesce(F.least("cap", F.col("level") * F.col("weight")), F.col("cap"))).select("source", "source_size", "rank", "weight", "target")


def inverse_demand(share_done: Column, first: Column, last: Column) -> Column:
    """Time in [0, 1] at which a schedule that runs linearly from ``first`` to ``last`` has asked for ``share_done``.

    The integral of the schedule up to t is first * t + (last - first) * t**2 / 2; this is its inverse, over its total.
    """
    asked = share_done * (first + last) / 2
    root = F.sqrt(F.greatest(first * first + 2 * (last - first) * asked, F.lit(0.0)))
    return F.when(share_done <= 0, F.lit(0.0)).otherwise(F.least(2 * asked / (first + root), F.lit(1.0)))


def plan(documents: DataFrame, weights: tuple = WEIGHTS, share: float = 1.5, epochs: int = 2, schedules: tuple = SCHEDULES, keep: bool = False) -> DataFrame:
    """One row for each document: ``doc_id, size, source_size, target, taken, position``.

    ``taken`` is the number of words that the mix takes of the document, repeats counted; over a source they sum to
    the rounded target. ``position`` is the time of its first word (null if none is taken). With ``keep`` all columns
    of ``documents`` come along, in struct column ``row``, and so does ``source``.
    """
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    cols = [F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"), key.alias("key")]
    if keep:
        cols.append(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"))
    sized = documents.select(*cols).withColumn("cell", F.substring("key", 1, CELL_DIGITS))
    if not keep:
        sized = save(sized, "sized")
    cells = save(sized.groupBy("source", "cell").agg(F.sum("size").alias("cell_size")), "cells")
    before = Window.partitionBy("source").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells_at = cells.select("source", "cell", F.coalesce(F.sum("cell_size").over(before), F.lit(0)).alias("cell_start"))
    sources = targets(cells.groupBy("source").agg(F.sum("cell_size").alias("source_size")), weights, share, epochs)
    at = cells_at.alias("c").join(F.broadcast(sources.alias("s")) if sources.count() <= 10_000 else sources.alias("s"), F.col("c.source").eqNullSafe(F.col("s.source")))
    at = at.select(F.col("c.source").alias("at_source"), F.col("c.cell").alias("at_cell"), "cell_start", "source_size", "target", "rank")
    inside = Window.partitionBy("source", "cell").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    run = sized.withColumn("in_cell", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    out = run.join(at, F.col("source").eqNullSafe(F.col("at_source")) & (F.col("cell") == F.col("at_cell")))
    start, limit = F.col("cell_start") + F.col("in_cell"), F.round("target").cast("long")
    takes = [F.least(F.greatest(limit - e * F.col("source_size") - start, F.lit(0)), F.col("size")) for e in range(epochs)]
    taken = takes[0]
    for x in takes[1:]:
        taken = taken + x
    time = inverse_demand(start / F.greatest("target", F.lit(1.0)), _by_rank([a for a, _ in schedules], F.col("rank")), _by_rank([b for _, b in schedules], F.col("rank")))
    out = out.withColumn("start", start).withColumn("takes", F.array(*takes)).withColumn("taken", taken).withColumn("position", F.when(F.col("taken") > 0, time))
    shown = ["doc_id", "size", "source_size", "target", "taken", "position"]
    return out.select(*shown, *(["start", "rank", "takes", "row"] if keep else []))


def range_sorted(planned: DataFrame) -> DataFrame:
    """Documents in training order; those of which nothing is taken come first."""
    return planned.orderBy("position", "doc_id")


def mixed(documents: DataFrame, schedules: tuple = SCHEDULES) -> DataFrame:
    """The training stream: each take of a document as a row with the columns of ``documents``, in training order.

    A document that the target cuts gives its first ``take`` words (with the white space before them), and n_chars is
    that text's length. Documents of which nothing is taken are not in the mix.
    """
    planned = plan(documents, schedules=schedules, keep=True)
    each = planned.select("*", F.posexplode("takes").alias("epoch", "take")).where("take > 0")
    done = (F.col("start") + F.col("epoch") * F.col("source_size")) / F.greatest("target", F.lit(1.0))
    each = each.withColumn("position", inverse_demand(done, _by_rank([a for a, _ in schedules], F.col("rank")), _by_rank([b for _, b in schedules], F.col("rank"))))
    head = F.array_join(F.slice(F.regexp_extract_all("row.text", F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0)), F.lit(1), F.col("take").cast("int")), "")
    text = F.when(F.col("take") < F.col("size"), head).otherwise(F.col("row.text"))
    ordered = each.orderBy("position", "doc_id", "epoch")
    cols = {c: F.col(f"row.`{c}`") for c in documents.columns}
    cols["text"] = text
    if "n_chars" in cols:
        cols["n_chars"] = F.when(F.col("take") < F.col("size"), F.length(head).cast(documents.schema["n_chars"].dataType)).otherwise(F.col("row.n_chars"))
    return ordered.select(*[v.alias(c) for c, v in cols.items()])
