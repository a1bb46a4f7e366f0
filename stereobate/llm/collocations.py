"""Phrase collocations by stripes: each prefix of words keys a counter of the words that follow it.

The stripes of one length come from one reading of the texts. A task counts, for each prefix in its texts, how often
which word follows in the same piece, and how often none that matters does (``OTHER``); such counters are merged
elementwise over the cluster. From the merged stripes come the extensions of a prefix with their counts, the prefix's
own total, and the largest count of an extension, which says whether a longer phrase takes the prefix up.

A phrase of k words reaches the least count only if both its parts of k - 1 words do. So the stripes of the next length
leave out prefixes and next words that are surely rare: the frequent phrases set bits in a table of bounded size that is
broadcast; a rare phrase that meets set bits by chance is counted and dropped after the merge, so results don't depend
on the table's size. A prefix that holds over one in HOT of all words is cut into SLICES by the next word's hash.
Merging streams over rows sorted by prefix and slice: Spark's sort may spill, and a task holds one batch and the
counter of one slice.

Counts are kept per ``lang`` (null is ``und``). Words are known by 64-bit hashes until the phrases are written out.
Null and empty texts have no words. Repeated rows count as often as they occur; ties go by the contract's order. Other
columns are left alone, texts are read whole, an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from stereobate.llm._io import save, small_batches
from stereobate.llm._text import LOWER, chunks, mix, prefix_hash, ranges, words

LONGEST, LEAST, TOP = 4, 30, 2000
BREAKS = np.zeros(256, bool)
BREAKS[[*b".,;:!?", 10, 11, 12, 13]] = True
GAP = BREAKS.copy()
GAP[[9, 32]] = True
OTHER = 0
#: Places of prefixes that a task counts before it hands over.
FLUSH = 1 << 21
HOT, SLICES, PARTS = 10_000, 64, 16
LEAST_BITS, MOST_BITS = 1 << 16, 1 << 27
_FACTOR = np.uint64(0xD6E8FEB86659FD93)


def _keys(langs: np.ndarray, columns: list[np.ndarray]) -> np.ndarray:
    """A 64-bit key of each row's language hash and words."""
    key = langs
    for c in columns:
        key = mix(key * _FACTOR + c)
    return key


def _lang_hashes(column: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct languages, each row's number among them, and their hashes."""
    coded = column.dictionary_encode()
    names = coded.dictionary
    hashes = np.array([int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little") for x in names.to_pylist()], np.uint64)
    return names, np.asarray(coded.indices), hashes


def _hashed(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end of each word, the first word of each text, and the words' hashes."""
    begin, end, at = words(data, starts, GAP)
    run, down = prefix_hash(LOWER[data])
    return begin, end, at, mix((run[end] - run[begin]) * down[begin])


def _words_counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stripes of the empty prefix: words of each language with their hash and count."""
    for batch in batches:
        names, codes, lang_hashes = _lang_hashes(batch.column("lang"))
        for row, _, data, starts in chunks(batch.column("text"), 4 << 20):
            begin, end, at, hashes = _hashed(data, starts)
            if not len(hashes):
                continue
            lang = np.repeat(codes[row : row + len(starts) - 1], np.diff(at))
            order = np.lexsort((hashes, lang))
            new = np.ones(len(order), bool)
            new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (lang[order][1:] != lang[order][:-1])
            first = np.flatnonzero(new)
            count = np.diff(np.append(first, len(order)))
            one = order[first]
            length = end[one] - begin[one]
            text = LOWER[data][ranges(begin[one], length)]
            offsets = np.concatenate(([0], np.cumsum(length))).astype(np.int64)
            strings = pa.LargeStringArray.from_buffers(len(one), pa.py_buffer(offsets), pa.py_buffer(text.tobytes())).cast(pa.string())
            yield pa.RecordBatch.from_arrays([names.take(pa.array(lang[one])), strings, pa.array(hashes[one].view(np.int64)), pa.array(count)], ["lang", "word", "hash", "f"])


def _held(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether both bits of each key are set."""
    mask = np.uint64(len(bits) * 8 - 1)
    out = np.ones(len(keys), bool)
    for shift in (0, 32):
        at = (keys >> np.uint64(shift)) & mask
        out &= (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return out


def _positions(mask: int):
    """Cells of 32 bits, and the bits in them, that the phrases' keys set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                _, codes, hashes = _lang_hashes(batch.column("lang"))
                matrix = np.asarray(batch.column("words").flatten()).view(np.uint64).reshape(batch.num_rows, -1)
                keys = _keys(hashes[codes], list(matrix.T))
                at = np.concatenate([(keys >> np.uint64(s)) & np.uint64(mask) for s in (0, 32)]).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(at >> 5), pa.array(np.int64(1) << (at & 31))], ["cell", "bit"])

    return run


def _bit_table(frequent: DataFrame) -> np.ndarray:
    """The bits of all frequent phrases, at most MOST_BITS of them; about sixteen for each phrase below that."""
    size = LEAST_BITS
    n = frequent.count()
    while size < min(16 * n, MOST_BITS):
        size *= 2
    cells = frequent.select("lang", "words").mapInArrow(_positions(size - 1), "cell long, bit long").groupBy("cell").agg(F.bit_or("bit").alias("bits")).toArrow()
    table = np.zeros(size // 32, np.uint32)
    table[np.asarray(cells["cell"])] = np.asarray(cells["bits"]).astype(np.uint32)
    return table.view(np.uint8)


def _stripes(shared, k: int):
    """Counters of the words after each prefix of ``k - 1`` words, as rows of (lang, words, slice, nexts, counts)."""

    def counted(names: pa.Array, held: list[tuple]) -> pa.RecordBatch:
        columns = [np.concatenate(x) for x in zip(*held)]
        held.clear()
        order = np.lexsort((columns[1], columns[0]))
        for i, c in enumerate(columns):  # one at a time, as a task's memory is small
            columns[i] = c[order]
        del order, c
        spread, nexts, part, lang, *prefix = columns
        stripe = np.ones(len(nexts), bool)
        stripe[1:] = (spread[1:] != spread[:-1]) | (lang[1:] != lang[:-1]) | (part[1:] != part[:-1])
        for p in prefix:
            stripe[1:] |= p[1:] != p[:-1]
        entry = stripe.copy()
        entry[1:] |= nexts[1:] != nexts[:-1]
        first = np.flatnonzero(entry)
        count = np.diff(np.append(first, len(nexts)))
        heads = np.flatnonzero(stripe)
        offsets = np.append(np.searchsorted(first, heads), len(first)).astype(np.int32)
        flat = np.stack([p[heads] for p in prefix], 1).ravel().view(np.int64)
        held = pa.ListArray.from_arrays(pa.array(np.arange(len(heads) + 1, dtype=np.int32) * (k - 1)), pa.array(flat))
        lists = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(x)) for x in (nexts[first].view(np.int64), count.astype(np.int32))]
        return pa.RecordBatch.from_arrays([names.take(pa.array(lang[heads])), held, pa.array(part[heads].astype(np.int32)), *lists], ["lang", "words", "slice", "nexts", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, hot = shared.value
        known: dict[str, int] = {}
        held: list[tuple] = []
        size = 0

        for batch in batches:
            names, codes, lang_hashes = _lang_hashes(batch.column("lang"))
            number = np.array([known.setdefault(x, len(known)) for x in names.to_pylist()], np.int32)
            for row, _, data, starts in chunks(batch.column("text")):
                begin, _, at, hashes = _hashed(data, starts)
                if len(hashes) < k - 1:
                    continue
                own = codes[row : row + len(starts) - 1]
                text = np.repeat(np.arange(len(own)), np.diff(at))
                piece = np.cumsum(BREAKS[data])[begin]
                together = lambda n: (text[n - 1 :] == text[: len(text) - n + 1]) & (piece[n - 1 :] == piece[: len(piece) - n + 1])
                starts_at = len(hashes) - k + 2  # of phrases of k - 1 words
                lang = own[text]
                keys = _keys(lang_hashes[lang][:starts_at], [hashes[j : j + starts_at] for j in range(k - 1)])
                good = together(k - 1) & _held(bits, keys)
                follows = np.zeros(starts_at, bool)
                follows[:-1] = together(k) & good[1:]
                i = np.flatnonzero(good)
                nexts = np.where(follows[i], hashes[np.minimum(i + k - 1, len(hashes) - 1)], np.uint64(OTHER))
                keys = keys[i]
                sliced = hot[np.minimum(np.searchsorted(hot, keys), len(hot) - 1)] == keys if len(hot) else np.zeros(len(i), bool)
                part = np.where(sliced, nexts % np.uint64(SLICES), np.uint64(0)).astype(np.int8)
                held.append((mix(keys + part.astype(np.uint64)), nexts, part, number[lang[i]], *(hashes[i + j] for j in range(k - 1))))
                size += len(i)
                if size >= FLUSH:
                    yield counted(pa.array(list(known), pa.string()), held)
                    size = 0
        if size:
            yield counted(pa.array(list(known), pa.string()), held)

    return run


def _merged(batches: Iterator[pa.RecordBatch], least: int, width: int) -> Iterator[pa.RecordBatch]:
    """Stripes sorted by (lang, words, slice) added elementwise: entries of at least ``least``, and each slice's total."""
    carry: pa.RecordBatch | None = None

    def added(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """First row of each stripe; stripe, next and count of each merged entry."""
        coded = np.asarray(batch.column("lang").dictionary_encode().indices)
        matrix = np.asarray(batch.column("words").flatten()).reshape(-1, width)
        part = np.asarray(batch.column("slice"))
        new = np.ones(batch.num_rows, bool)
        new[1:] = (coded[1:] != coded[:-1]) | (part[1:] != part[:-1]) | (matrix[1:] != matrix[:-1]).any(1)
        stripe = np.repeat(np.cumsum(new) - 1, np.asarray(batch.column("nexts").value_lengths()))
        nexts, counts = np.asarray(batch.column("nexts").flatten()), np.asarray(batch.column("counts").flatten())
        order = np.lexsort((nexts, stripe))
        stripe, nexts, counts = stripe[order], nexts[order], counts[order]
        entry = np.ones(len(order), bool)
        entry[1:] = (stripe[1:] != stripe[:-1]) | (nexts[1:] != nexts[:-1])
        at = np.flatnonzero(entry)
        return np.flatnonzero(new), stripe[at], nexts[at], np.add.reduceat(counts, at) if len(at) else counts

    def given(batch: pa.RecordBatch, rows: np.ndarray, stripe: np.ndarray, nexts: np.ndarray, counts: np.ndarray, floor: int) -> pa.RecordBatch:
        total = np.zeros(len(rows), np.int64)
        if floor:
            np.add.at(total, stripe, counts)
            kept = (counts >= floor) & (nexts != OTHER)
            stripe, nexts, counts = stripe[kept], nexts[kept], counts[kept]
        offsets = pa.array(np.searchsorted(stripe, np.arange(len(rows) + 1)).astype(np.int32))
        at = pa.array(rows)
        lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (nexts, counts)]
        return pa.RecordBatch.from_arrays([batch.column("lang").take(at), batch.column("words").take(at), batch.column("slice").take(at), *lists, pa.array(total)], ["lang", "words", "slice", "nexts", "counts", "total"])

    for batch in batches:
        if not batch.num_rows:
            continue
        batch = batch.select(["lang", "words", "slice", "nexts", "counts"])
        batch = batch.set_column(4, "counts", batch.column("counts").cast(pa.list_(pa.int64())))
        if carry is not None:
            batch = pa.Table.from_batches([carry, batch]).combine_chunks().to_batches()[0]
        rows, stripe, nexts, counts = added(batch)
        last = len(rows) - 1
        done = stripe < last
        if last:
            yield given(batch, rows[:last], stripe[done], nexts[done], counts[done], least)
        open_ = given(batch, rows[last:], stripe[~done] - last, nexts[~done], counts[~done], 0)
        carry = open_.select(["lang", "words", "slice", "nexts", "counts"])
    if carry is not None:
        rows, stripe, nexts, counts = added(carry)
        yield given(carry, rows, stripe, nexts, counts, least)


def stripes(texts: DataFrame, frequent: DataFrame, k: int, total: int, least: int) -> DataFrame:
    """Merged stripes of prefixes of ``k - 1`` words: ``lang, words, slice, nexts, counts, total``.

    ``frequent(lang, words, f)`` holds the phrases of ``k - 1`` words with at least ``least`` places.
    """
    bits = _bit_table(frequent)
    often = frequent.where(F.col("f") * HOT >= total).select("lang", "words").toArrow()  # at most HOT rows
    hot = np.zeros(0, np.uint64)
    if often.num_rows:
        _, codes, hashes = _lang_hashes(often["lang"].combine_chunks())
        hot = np.sort(_keys(hashes[codes], list(np.asarray(often["words"].combine_chunks().flatten()).view(np.uint64).reshape(often.num_rows, -1).T)))
    shared = texts.sparkSession.sparkContext.broadcast((bits, hot))
    mapped = small_batches(texts).mapInArrow(_stripes(shared, k), "lang string, words array<long>, slice int, nexts array<long>, counts array<int>")
    dealt = mapped.repartition("lang", "words", "slice").sortWithinPartitions("lang", "words", "slice")
    return dealt.mapInArrow(lambda batches: _merged(batches, least, k - 1), "lang string, words array<long>, slice int, nexts array<long>, counts array<long>, total long")


def _wide(c: Column) -> Column:
    return c.cast("decimal(20,0)")


def phrases(documents: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Words ``(lang, word, hash, f)``, frequent phrases ``(lang, words, f, next_most)`` and sums ``(lang, n)``.

    ``next_most`` is the largest count of a phrase that is one word longer at the right, from the phrase's own stripe.
    """
    texts = documents.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"))
    counted = small_batches(texts).mapInArrow(_words_counted, "lang string, word string, hash long, f long")
    known = save(counted.groupBy("lang", "word").agg(F.sum("f").alias("f"), F.first("hash").alias("hash")), "words")
    sums = save(known.groupBy("lang").agg(F.sum("f").alias("n")), "sums")
    total = int(sums.agg(F.sum("n")).first()[0] or 0)
    level = save(known.where(F.col("f") >= least).select("lang", F.array("hash").alias("words"), "f"), "frequent")
    out = None
    for k in range(2, LONGEST + 1):
        striped = save(stripes(texts, level, k, total, least), "stripes")
        most = striped.groupBy("lang", "words").agg(F.max(F.array_max("counts")).alias("next_most"))
        closed = level.join(most, ["lang", "words"], "left")
        out = closed if out is None else out.unionByName(closed)
        entries = striped.select("lang", "words", F.explode(F.arrays_zip("nexts", "counts")).alias("e"))
        level = save(entries.select("lang", F.concat("words", F.array("e.nexts")).alias("words"), F.col("e.counts").alias("f")), "frequent")
    return known, out.unionByName(level.withColumn("next_most", F.lit(None).cast("long"))), sums


def collocations(documents: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """Each language's ``top`` phrases: ``lang, rank, phrase, a, l, r, n, score``."""
    known, found, sums = phrases(documents, least)
    found = save(found, "phrases")
    longer = found.where(F.size("words") > 2).select("lang", F.slice("words", 2, F.size("words") - 1).alias("words"), "f")
    before = longer.groupBy("lang", "words").agg(F.max("f").alias("before_most"))
    parts = found.where(F.size("words") < LONGEST).select("lang", "words", "f")
    candidates = found.where(F.size("words") > 1).join(before.where(F.size("words") > 1), ["lang", "words"], "left").withColumnRenamed("f", "a")
    most = F.greatest(F.coalesce("next_most", F.lit(0)), F.coalesce("before_most", F.lit(0)))
    kept = candidates.where(_wide(most) * 100 < _wide(F.col("a")) * 80)
    cuts = kept.select("lang", "words", "a", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    cuts = cuts.withColumn("left", F.slice("words", F.lit(1), F.col("k"))).withColumn("right", F.slice("words", F.col("k") + 1, F.size("words") - F.col("k")))
    cuts = cuts.join(parts.select("lang", F.col("words").alias("left"), F.col("f").alias("l")), ["lang", "left"])
    cuts = cuts.join(parts.select("lang", F.col("words").alias("right"), F.col("f").alias("r")), ["lang", "right"])
    cuts = cuts.withColumn("score", F.expr("cast(cast(a as decimal(20,0)) * 2000000 as decimal(30,0)) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))"))
    scored = cuts.groupBy("lang", "words", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("s")).select("lang", "words", "a", "s.l", "s.r", "s.score")
    # In parts of a language first, so that the last step gets a bounded number of rows beside ties.
    near = scored.withColumn("part", F.pmod(F.xxhash64("words"), F.lit(PARTS)))
    for by in (["lang", "part"], ["lang"]):
        place = F.rank().over(Window.partitionBy(*by).orderBy(F.col("score").desc(), F.col("a").desc()))
        near = near.withColumn("place", place).where(F.col("place") <= top)
    near = save(near.drop("place", "part"), "near")
    spelled = near.select("lang", "words", F.posexplode("words").alias("pos", "hash")).join(known.select("lang", "hash", "word"), ["lang", "hash"])
    spelled = spelled.groupBy("lang", "words").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    in_order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    placed = near.join(spelled, ["lang", "words"]).withColumn("rank", F.row_number().over(in_order)).where(F.col("rank") <= top)
    return placed.join(sums, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
