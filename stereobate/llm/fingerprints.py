"""Threshold-scaled sketches of documents, in DataFrame functions only.

A text's shingles are its runs of five words (lower-cased A-Z, split at white space); a text of fewer words is one
shingle, one without words none. A shingle's hash is the first eleven hexadecimal digits of its MD5, and a sketch keeps
each hash below a fixed fraction (``LIMIT``, a quarter) of all: a set that does not depend on the other shingles, so
that the sketch of a union is the union of the sketches, and the share of one sketch that lies in another estimates the
share of the one text that lies in the other, however unequal they are. A text whose hashes all lie above the limit
keeps its least one as a stand-in; ``merged`` drops stand-ins beside hashes below the limit. A fingerprint is the sketch
as a string, sorted, eleven digits a hash; equal texts have equal fingerprints.

Likeness is the share of common hashes in the union (1 for two texts without words), containment the share of the
first's hashes that the second holds.

``edits`` lays each document beside the next by falling doc_id without one task that sees all: ids are cut into ranges
at approximate quantiles, a window runs inside a range, and each range's last document meets the first of the next
range through a table of one row for each range. An id that fills several ranges is dealt over them by its text's hash.
Rows with equal id follow each other by that hash, null ids come last. Null texts are empty. Repeated rows count each
for itself, of which order is free as they are the same. Other columns are left alone; an empty table gives an empty
result. Texts are read whole, whatever their length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

WORDS = 5
DIGITS = 11
#: Hashes are kept below this prefix: "4" is a quarter of all.
LIMIT = "4"
MOST_RANGES = 4096


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once."""
    return F.transform(F.array(value), body)[0]


def shingle_hashes(text: Column) -> Column:
    """The hash of every shingle."""
    lower = F.translate(F.coalesce(text.cast("string"), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.filter(F.split(lower, r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def hashes(ws: Column) -> Column:
        at = F.sequence(F.lit(1), F.greatest(F.size(ws) - (WORDS - 1), F.lit(1)))
        each = F.transform(at, lambda i: F.substring(F.md5(F.array_join(F.slice(ws, i, F.lit(WORDS)), " ")), 1, DIGITS))
        return F.when(F.size(ws) > 0, each).otherwise(F.array().cast("array<string>"))

    return _let(words, hashes)


def scaled(hashes: Column) -> Column:
    """The sketch of hashes: those below the limit, distinct and sorted, else the least one."""

    def kept(hs: Column) -> Column:
        least = F.when(F.size(hs) > 0, F.array(F.array_min(hs))).otherwise(hs)
        return _let(F.filter(hs, lambda h: h < LIMIT), lambda low: F.when(F.size(low) > 0, F.sort_array(F.array_distinct(low))).otherwise(least))

    return _let(hashes, kept)


def sketch(text: Column) -> Column:
    return scaled(shingle_hashes(text))


def fingerprint(sketched: Column) -> Column:
    return F.array_join(sketched, "")


def parsed(fingerprinted: Column) -> Column:
    """The sketch that a fingerprint shows."""
    at = F.sequence(F.lit(0), F.greatest(F.length(fingerprinted) / DIGITS - 1, F.lit(0)).cast("int"))
    cut = F.transform(at, lambda i: F.substr(fingerprinted, i * DIGITS + 1, F.lit(DIGITS)))
    return F.when(F.length(fingerprinted) > 0, cut).otherwise(F.array().cast("array<string>"))


def likeness(a: Column, b: Column) -> Column:
    """Common hashes of two sketches over all; 1 if both are empty."""
    both = F.size(F.array_intersect(a, b))
    whole = F.size(a) + F.size(b) - both
    return F.when(whole > 0, both / whole).otherwise(F.lit(1.0))


def containment(a: Column, b: Column) -> Column:
    """Share of the hashes of sketch ``a`` that ``b`` holds; 1 if ``a`` is empty."""
    return F.when(F.size(a) > 0, F.size(F.array_intersect(a, b)) / F.size(a)).otherwise(F.lit(1.0))


def merged(sketches: DataFrame, by: list[str], column: str = "sketch") -> DataFrame:
    """``sketches`` -> one row for each group ``by`` with the sketch of all its texts together.

    Hashes are made distinct by partial aggregates before they meet; a group's sketch is as long as its distinct hashes.
    """
    each = sketches.select(*by, F.explode_outer(column).alias("hash")).distinct()
    return each.groupBy(*by).agg(F.collect_set("hash").alias(column)).withColumn(column, scaled(F.col(column)))


def _at_or_below(bounds: list[int], value: Column, strictly: bool) -> Column:
    """How many of the sorted ``bounds`` lie below ``value``, or at it too, by halving."""
    listed = F.array(*[F.lit(b).cast("long") for b in bounds])
    steps = [1 << i for i in reversed(range(len(bounds).bit_length()))]

    def step(n: Column, s: Column) -> Column:
        held = F.try_element_at(listed, n + s)
        return F.when(held < value if strictly else held <= value, n + s).otherwise(n)

    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), step)


def edits(documents: DataFrame, ranges: int | None = None) -> DataFrame:
    """``doc_id, text, next_text`` and both texts' sketches; the next by falling doc_id, after the last comes the first."""
    spark = documents.sparkSession
    ranges = min(ranges or 8 * int(spark.conf.get("spark.sql.shuffle.partitions")), MOST_RANGES)
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    cuts = [i / ranges for i in range(1, ranges)]
    bounds = docs.agg(F.percentile_approx(F.coalesce("doc_id", F.lit(-(1 << 63))), F.array(*map(F.lit, cuts)), 20 * ranges)).first()[0] if cuts else []
    place = F.coalesce("doc_id", F.lit(-(1 << 63)))
    docs = docs.withColumn("place", place).withColumn("hash", F.xxhash64("text"))
    if bounds:
        low, high = _at_or_below(bounds, F.col("place"), True), _at_or_below(bounds, F.col("place"), False)
        part = F.floor((F.shiftrightunsigned("hash", 33) / float(1 << 31)) * (F.col("high") - F.col("low") + 1))
        docs = docs.withColumn("low", low).withColumn("high", high).withColumn("range", (F.col("low") + part).cast("int"))
    else:
        docs = docs.withColumn("range", F.lit(0))
    order = [F.col("place").desc(), F.shiftrightunsigned("hash", 33).desc(), F.col("hash").desc()]
    keys = docs.groupBy("range").agg(F.max(F.struct("place", F.shiftrightunsigned("hash", 33).alias("coarse"), "hash")).alias("k"))
    # At most a row for each range; the first one's turn comes after the last.
    downwards = Window.orderBy(F.col("range").desc())
    keys = keys.withColumn("before", F.coalesce(F.lag("range").over(downwards), F.min("range").over(Window.partitionBy())))
    heads = docs.join(F.broadcast(keys.select("range", "before", F.col("k.place").alias("place"), F.col("k.hash").alias("hash"))), ["range", "place", "hash"])
    heads = heads.select(F.col("before").alias("range"), F.col("text").alias("head")).dropDuplicates(["range"])
    heads = heads.withColumn("head", F.struct(F.col("head").alias("text"), sketch(F.col("head")).alias("sketch")))
    inside = Window.partitionBy("range").orderBy(*order)
    own = docs.select("range", "place", "hash", "doc_id", F.struct("text", sketch(F.col("text")).alias("sketch")).alias("own"))
    beside = own.select("range", "doc_id", "own", F.lead("own").over(inside).alias("after")).join(heads, "range")
    beside = beside.withColumn("after", F.coalesce("after", "head"))
    return beside.select("doc_id", F.col("own.text").alias("text"), F.col("own.sketch").alias("sketch"), F.col("after.text").alias("next_text"), F.col("after.sketch").alias("next_sketch"))


def fingerprints(documents: DataFrame) -> DataFrame:
    """Each document's fingerprint, its edited text's, and how like they and the next document's are.

    Edited: the last third (rounded down) of the code points gives way to the first as many, or all, of the next text.
    """
    third = F.floor(F.length("text") / 3).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), F.length("text") - third), F.substr("next_text", F.lit(1), third))
    both = edits(documents).withColumn("edited", edited)
    out = both.select("doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), "sketch", sketch(F.col("edited")).alias("edited_sketch"), "next_sketch")
    return out.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        fingerprint(F.col("sketch")).alias("fingerprint"),
        fingerprint(F.col("edited_sketch")).alias("edited_fingerprint"),
        likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
        containment(F.col("edited_sketch"), F.col("sketch")).alias("edited_held"),
        containment(F.col("sketch"), F.col("next_sketch")).alias("held_in_next"),
    )
