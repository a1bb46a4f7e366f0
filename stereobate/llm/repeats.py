"""Passages that repeat across documents, by a sparse suffix array.

Suffixes are kept at minimisers only: a position whose hash of ``GRAM`` words is the least of ``SPAN`` neighbouring
ones. Both are chosen so that every passage of ``LEAST`` words holds, in both documents, a common minimiser with at
least ``KEY`` words of the passage behind it. Suffixes whose first ``KEY`` words occur in one document only are
dropped; the rest are range-sorted by content over the cluster. In the sorted array the suffixes that agree in ``r``
words behind their key are an interval; there each is compared with its neighbours from other documents in the order of
the words to its left, for every ``r``. That is the longest extension to the left for each one to the right, so every
window of LEAST words that another document holds is found. A key of more than ``CROWDED`` suffixes is not put in one
task: its windows are found by hashes of the left and right words, aggregated over the cluster, with equal results.

Texts that are equal byte for byte are one suffix source: their documents repeat as a whole. Words are lower-cased
(A-Z). Null and empty texts, and texts under ``LEAST`` words, repeat nothing. Rows that share a doc_id are one
document, rows without one take no part. Runs that repeat a few words are suffixes like others, so that they are found
in their full length. Long texts are read whole, a text of over a megabyte alone. Of several documents that hold a
passage the smallest found is named. An empty table gives an empty result; other columns are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from stereobate.llm._io import drop, save, small_batches
from stereobate.llm._text import chunks, grams, mix, word_hashes

LEAST, GRAM, SPAN = 50, 8, 24
KEY = LEAST - SPAN + 1
REACH = LEAST - KEY
ROWS_A_PARTITION, CROWDED = 40_000, 2_000
_SUFFIX = "key long, doc long, pos int, ahead binary, behind binary, n_ahead int, n_behind int"
_SPAN = "doc long, start int, end int, other long"


def _least_of_window(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Positions whose hash is the (leftmost) least in some window of SPAN that stays inside one text."""
    n = len(hashes) - SPAN + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    best, width = np.arange(len(hashes)), 1
    while width < SPAN:  # the least of twice as many positions, as far as SPAN
        step = min(width, SPAN - width)
        a, b = best[: len(best) - step], best[step:]
        best = np.where(hashes[b] < hashes[a], b, a)
        width += step
    text_end = np.repeat(first[1:], np.diff(first))
    inside = np.arange(n) + SPAN <= text_end[:n]
    return np.unique(best[:n][inside])


def _suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, doc, pos) of every suffix that is kept."""
    for batch in batches:
        ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
        for row, end, data, starts in chunks(batch.column("text")):
            hashes, at = word_hashes(data, starts)
            short, first = grams(hashes, at, GRAM, whole_if_short=False)
            long_, first_long = grams(hashes, at, KEY, whole_if_short=False)
            chosen = _least_of_window(short, first)
            text = np.searchsorted(first, chosen, "right") - 1
            pos = chosen - first[text]
            fits = pos < np.diff(first_long)[text]
            text, pos = text[fits], pos[fits]
            key = long_[first_long[text] + pos]
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(ids[row + text].astype(np.int64)), pa.array(pos.astype(np.int32))], ["key", "doc", "pos"])


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each kept suffix with the words behind its key and, from right to left, those before it (32-bit hashes)."""
    for batch in batches:
        for row, end, data, starts in chunks(batch.column("text")):
            hashes, at = word_hashes(data, starts)
            whole, first = grams(hashes, at, KEY, whole_if_short=False)
            small = np.maximum(mix(hashes + np.uint64(3)) >> np.uint64(32), np.uint64(1)).astype(">u4")  # 0: no word there
            lists = batch.column("positions").slice(row, end - row)
            pos = lists.flatten().to_numpy().astype(np.int64)
            text = np.repeat(np.arange(end - row), np.diff(lists.offsets.to_numpy()))
            fits = pos < np.diff(first)[text]
            pos, text = pos[fits], text[fits]
            here = (at[:-1][text] + pos)[:, None]
            ahead = here + KEY + np.arange(REACH)
            behind = here - 1 - np.arange(REACH)
            padded = np.concatenate((small, np.zeros(1, ">u4")))
            ahead = padded[np.where(ahead < at[1:][text][:, None], ahead, -1)]
            behind = padded[np.where(behind >= at[:-1][text][:, None], behind, -1)]
            ids = batch.column("doc_id").to_numpy()[row + text]
            yield pa.RecordBatch.from_arrays(
                [pa.array(whole[first[text] + pos].view(np.int64)), pa.array(ids), pa.array(pos.astype(np.int32)), pa.array([x.tobytes() for x in ahead], pa.binary()), pa.array([x.tobytes() for x in behind], pa.binary()), *(pa.array((x != 0).sum(axis=1).astype(np.int32)) for x in (ahead, behind))],
                ["key", "doc", "pos", "ahead", "behind", "n_ahead", "n_behind"],
            )


def _agree(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Number of leading words in which the rows agree; 0 stands for no word."""
    same = (x == y) & (x != 0)
    return np.where(same.all(axis=1), x.shape[1], same.argmin(axis=1))


def _longest_left(group: np.ndarray, doc: np.ndarray, rank: np.ndarray, behind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each suffix the most words to its left that one of another document in its group has too, and that suffix.

    ``rank`` orders the words to the left; the best is one of the two neighbours from other documents in that order.
    """
    order = np.lexsort((doc, rank, group))
    n, d, g = len(order), doc[order], group[order]
    change = np.flatnonzero((d[1:] != d[:-1]) | (g[1:] != g[:-1])) + 1
    begin, end = np.concatenate(([0], change)), np.concatenate((change, [n]))
    best, other = np.full(n, -1), np.full(n, -1)
    for beside, inside in ((begin - 1, begin > 0), (end, end < n)):
        beside = np.repeat(np.where(inside, beside, 0), end - begin)
        ok = np.repeat(inside, end - begin)
        ok &= g[beside] == g
        x, y = order[ok], order[beside[ok]]
        left = _agree(behind[x], behind[y])
        more = left > best[x]
        best[x[more]], other[x[more]] = left[more], y[more]
    return best, other


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of a partition sorted by key and the words behind it, that another document holds too."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    t = pa.Table.from_batches(held)
    key, doc, pos = (t.column(c).to_numpy() for c in ("key", "doc", "pos"))
    ahead, behind = (np.frombuffer(b"".join(t.column(c).to_pylist()), ">u4").reshape(len(key), -1) for c in ("ahead", "behind"))
    rank = np.unique(np.ascontiguousarray(behind).view(f"S{4 * REACH}").ravel(), return_inverse=True)[1]
    common = np.where(key[1:] == key[:-1], _agree(ahead[1:], ahead[:-1]), -1)
    seen, spans = np.full(len(key), -1), []
    for right in range(REACH, -1, -1):
        group = np.concatenate(([0], np.cumsum(common < right)))
        left, other = _longest_left(group, doc, rank, behind)
        hit = np.flatnonzero((left + right >= REACH) & (left > seen))
        seen[hit] = left[hit]
        spans.append((doc[hit], pos[hit] - left[hit], pos[hit] + KEY + right, doc[other[hit]]))
    d, s, e, o = (np.concatenate(x) for x in zip(*spans))
    yield pa.RecordBatch.from_arrays([pa.array(d), pa.array(s.astype(np.int32)), pa.array(e.astype(np.int32)), pa.array(o)], ["doc", "start", "end", "other"])


def _crowded_spans(rows: DataFrame) -> DataFrame:
    """The same spans for suffixes of crowded keys: windows with ``o`` words left of the key, grouped by their hash."""

    def window(o: int):
        there = (F.col("n_behind") >= o) & (F.col("n_ahead") >= REACH - o)
        words = [F.expr(f"substring(behind, 1, {4 * o})"), F.expr(f"substring(ahead, 1, {4 * (REACH - o)})")]
        return F.when(there, F.struct(F.lit(o).alias("o"), F.xxhash64("key", F.lit(o), *words).alias("h"), F.xxhash64(*words, "key").alias("h2")))

    each = rows.select("doc", "pos", F.explode(F.array(*[window(o) for o in range(REACH + 1)])).alias("w")).where("w is not null").select("doc", "pos", "w.*")
    shared = save(each.groupBy("h", "h2").agg(F.min("doc").alias("low"), F.max("doc").alias("high")).where("low <> high"), "windows")
    met = each.join(shared, ["h", "h2"]).withColumn("start", F.col("pos") - F.col("o"))
    return met.select("doc", "start", (F.col("start") + LEAST).alias("end"), F.when(F.col("doc") == F.col("low"), F.col("high")).otherwise(F.col("low")).alias("other"))


def repeated_passages(documents: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """``(doc_id, start_word, end_word, n_words, other_id)``: the passages of LEAST words or more that other documents hold.

    Passages of one document don't overlap: what touches is one passage. ``other_id`` is the smallest document that
    was found to hold a part of it. Copies of a whole text are one passage each.
    """
    docs = small_batches(documents).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("doc_id is not null and text is not null")
    texts = save(docs.select("doc_id", F.md5("text").alias("text_key"), F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).alias("n")).where(F.col("n") >= LEAST), "texts")
    classes = save(texts.groupBy("text_key").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")), "classes")
    copies = texts.join(classes.where("low <> high"), "text_key").select(F.col("doc_id").alias("doc"), F.lit(0).alias("start"), F.col("n").alias("end"), F.when(F.col("doc_id") == F.col("low"), F.col("high")).otherwise(F.col("low")).alias("other"))

    suffixes = save(docs.mapInArrow(_suffixes, "key long, doc long, pos int").join(classes.select(F.col("low").alias("doc")).distinct(), "doc", "left_semi"), "suffixes")
    shared = save(suffixes.groupBy("key").agg(F.min("doc").alias("low"), F.max("doc").alias("high"), F.count("*").alias("n")).where("low <> high").select("key", "n"), "shared")
    kept = suffixes.join(shared, "key", "left_semi").groupBy("doc").agg(F.sort_array(F.collect_set("pos")).alias("positions"))
    rows = save(docs.join(kept.withColumnRenamed("doc", "doc_id"), "doc_id").select("doc_id", "text", "positions").mapInArrow(_contexts, _SUFFIX), "contexts")
    drop(suffixes)
    # There is at most one crowded key for each CROWDED suffixes.
    many = F.broadcast(shared.where(F.col("n") > crowded).select("key"))
    n = max(1, -(-rows.count() // ROWS_A_PARTITION))
    sorted_ = rows.join(many, "key", "left_anti").repartitionByRange(n, "key").sortWithinPartitions("key", "ahead")
    found = save(sorted_.select("key", "doc", "pos", "ahead", "behind").mapInArrow(_neighbours, _SPAN), "spans")
    spans = found.unionByName(_crowded_spans(rows.join(many, "key", "left_semi"))).distinct().unionByName(copies)

    seen = Window.partitionBy("doc").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    runs = Window.partitionBy("doc").orderBy("start", "end")
    merged = spans.withColumn("new", F.when(F.col("start") <= F.max("end").over(seen), 0).otherwise(1)).withColumn("run", F.sum("new").over(runs))
    out = merged.groupBy("doc", "run").agg(F.min("start").alias("start_word"), F.max("end").alias("end_word"), F.min("other").alias("other_id"))
    return out.select(F.col("doc").alias("doc_id"), F.col("start_word").cast("long").alias("start_word"), F.col("end_word").cast("long").alias("end_word"), (F.col("end_word") - F.col("start_word")).cast("long").alias("n_words"), "other_id")
