"""Benchmark decontamination by template canonicalisation, in DataFrame functions only.

A text is read in two ways: as its lower-case words, and as a template in which numbers, names and units are typed
placeholders. Windows of ``WINDOW`` words of either reading are hashed and hash-joined with those of the items. A
window that meets gives an alignment (item and shift); there the item is laid beside the document word by word, and
what counts as covered are runs of at least ``RUN`` equal words, so a changed word costs itself and no window round it.
In the template reading the slots must be consistent too: a filler of the item stands for one filler of the document
throughout, as a re-parameterised question replaces it everywhere. The literal reading needs no such proof.

A template window teaches only if it holds ``LITERALS`` words besides its placeholders; what is nearly all numbers is
still found by the literal reading. Names are capitalised words inside a sentence, or several in a row; a single one
that opens a sentence is a word like others, and in languages that capitalise nouns those are slots.

Null and empty texts match nothing. Items shorter than a window are matched as a whole, at their own length. Rows that
share a doc_id are judged together, and so are items that share an item_id. Ties between alignments go to the one that
starts first. Empty tables give an empty result. A long text is cut into slices of ``SLICE`` words for its windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from stereobate.llm._io import save

WINDOW, RUN, SLICE = 8, 4, 4096
#: Words of an item that one alignment must cover, or the share of a shorter item.
ENOUGH, SHARE = 13, 0.8
#: Literal words that a benchmark window of the template reading must hold; placeholders alone say nothing.
LITERALS = 3
#: Windows up to this number are broadcast (at 30 bytes each); more are joined by a shuffle.
BROADCAST_WINDOWS = 500_000

# What becomes a placeholder.
NAME = r"(?<=[\p{Ll}\p{Nd},;] )\p{Lu}\p{Ll}+|\b\p{Lu}\p{Ll}+(?= \p{Lu}\p{Ll})"
UNITS = """kg mg g km cm mm m mi ft in s ms min h hour hours minute minutes second seconds day days week weeks month months
 year years meter meters metre metres mile miles foot feet inch inches pound pounds dollar dollars cent cents euro euros
 percent liter liters litre litres usd eur gbp mph kmh""".split()
NUMBER_WORDS = """two three four five six seven eight nine ten eleven twelve twenty thirty forty fifty sixty seventy eighty
 ninety hundred thousand million zwei drei vier fünf sechs sieben acht neun zehn elf zwölf zwanzig hundert tausend dos tres
 cuatro cinco seis siete ocho nueve diez once doce veinte cien mil deux trois quatre cinq sept huit neuf dix onze douze
 vingt cent mille""".split()
MARK = "\x01"
TOKEN = r"\x01?[\p{L}\p{M}]+|[0-9]+(?:[.,:/][0-9]+)*|[\p{Nd}&&[^0-9]]+"
#: Kinds of placeholders; the kind of a literal word is null.
NAMED, NUMBER, UNIT = 1, 2, 3


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column, value) -> Column:
    """``array<struct<w, kind>>``: ``value`` of each lower-case word of a text, and what placeholder the word would be."""
    plain = F.translate(F.coalesce(text.cast("string"), F.lit("")), MARK, " ")
    found = F.regexp_extract_all(F.lower(F.regexp_replace(plain, NAME, f"{MARK}$0")), F.lit(TOKEN), F.lit(0))
    digit = lambda w: F.ascii(w).between(48, 57)

    def typed(words: Column, w: Column, i: Column) -> Column:
        name = F.ascii(w) == 1
        kind = F.when(name, NAMED).when(digit(w) | w.isin(NUMBER_WORDS), NUMBER).when(w.isin(UNITS) & digit(F.get(words, i - 1)), UNIT)
        return F.struct(value(F.when(name, F.substring(w, 2, 1 << 30)).otherwise(w)).alias("w"), kind.alias("kind"))

    return _let(found, lambda words: F.transform(words, lambda w, i: typed(words, w, i)))


def template_of(words: Column) -> Column:
    """The words with every name as one placeholder, its first word standing for all."""
    named = lambda x: x["kind"].eqNullSafe(NAMED)
    return F.filter(words, lambda x, i: ~(named(x) & (i > 0) & named(F.get(words, i - 1))))


def _literal_windows(hashes: Column, sizes: list[int]) -> Column:
    """``array<struct<n, hashes>>``: all windows of each size up to 15, built from those of 1, 2, 4 and 8 words."""

    def joined(x: Column, y: Column, shift: int) -> Column:
        return F.zip_with(x, F.slice(y, F.lit(shift + 1), F.size(y)), lambda a, b: F.xxhash64(a, b))

    def one(n: int, powers: list[Column]) -> Column:
        out, width = None, 0
        for bit, x in enumerate(powers):
            if n >> bit & 1:
                out, width = (x if out is None else joined(out, x, width)), width + (1 << bit)
        return F.struct(F.lit(n).alias("n"), F.slice(out, F.lit(1), F.greatest(F.size(out) - n + 1, F.lit(0))).alias("hashes"))

    def grow(powers: list[Column]) -> Column:
        if 1 << len(powers) > max(sizes):
            return F.array(*[one(n, powers) for n in sizes])
        return _let(joined(powers[-1], powers[-1], 1 << (len(powers) - 1)), lambda x: grow([*powers, x]))

    return _let(hashes, lambda x: grow([x]))


def _template_windows(words: Column, sizes: list[int]) -> Column:
    """``array<struct<kind, n, rows>>``, rows of (pos, hash): windows that hold a placeholder, at either end or inside; others are literal anyway."""
    slots = F.filter(F.transform(words, lambda x, i: F.when(x["kind"].isNotNull(), i)), lambda i: i.isNotNull())

    def of(n: int, t: Column, at: Column) -> Column:
        # A placeholder gives the windows that no placeholder before it lies in, so each comes once.
        since = lambda p, k: F.greatest(p - (n - 1), F.coalesce(F.get(at, k - 1) + 1, F.lit(0)), F.lit(0))
        each = F.flatten(F.transform(at, lambda p, k: _let(F.struct(since(p, k).alias("lo"), F.least(p, F.size(t) - n).alias("hi")), lambda s: F.when(s["lo"] <= s["hi"], F.sequence(s["lo"], s["hi"])).otherwise(F.array().cast("array<int>")))))
        return F.transform(each, lambda p: F.struct(p.alias("pos"), F.xxhash64(F.lit(True), F.slice(t, p + 1, F.lit(n))).alias("hash")))

    readings = F.transform(words, lambda x: F.coalesce(x["kind"].cast("long"), x["w"]))
    return _let(readings, lambda t: _let(slots, lambda at: F.array(*[F.struct(F.lit("t").alias("kind"), F.lit(n).alias("n"), of(n, t, at).alias("rows")) for n in sizes])))


def _windows(df: DataFrame, key: str, sizes: list[int]) -> DataFrame:
    """``key, kind, n, pos, hash`` for the windows of ``df(key, text)``; kind "v" is the literal reading, "t" the template."""
    read = df.select(key, words_of(F.col("text"), F.xxhash64).alias("x"))

    def slices(hashes: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(hashes) - 1, F.lit(0)), F.lit(SLICE))
        return F.transform(starts, lambda i: F.struct(i.alias("at"), F.slice(hashes, i + 1, F.lit(SLICE + max(sizes) - 1)).alias("part")))

    both = read.select(key, _let(F.col("x.w"), slices).alias("slices"), _let(template_of(F.col("x")), lambda t: _template_windows(t, sizes)).alias("t"))
    # The outer forms of explode keep the optimizer from adding a filter that computes the arrays a second time.
    cut = both.select(key, "t", F.posexplode_outer("slices").alias("k", "s")).select(key, F.when(F.col("k") == 0, F.col("t")).alias("t"), "s.at", "s.part")
    placed = lambda x: F.transform(x["hashes"], lambda h, i: F.struct((F.col("at") + i).alias("pos"), h.alias("hash")))
    parts = F.transform(_literal_windows(F.col("part"), sizes), lambda x: F.struct(F.lit("v").alias("kind"), x["n"].alias("n"), placed(x).alias("rows")))
    each = cut.select(key, F.explode_outer(F.when(F.col("t").isNull(), parts).otherwise(F.concat(parts, F.col("t")))).alias("x"))
    out = each.select(key, "x.kind", "x.n", F.explode_outer("x.rows").alias("r"))
    return out.where("r is not null").select(key, "kind", "n", "r.pos", "r.hash")


def _item_windows(items: DataFrame, sizes: list[int]) -> DataFrame:
    """``item_id, kind, n, item_pos, hash, len``: windows of the items (item_id, version, kind, words, text) that point to them."""
    own = F.when(F.col("len") >= WINDOW, WINDOW).otherwise(F.col("len"))
    found = _windows(items.where("kind = 'v'").select(F.struct("item_id", "version").alias("item"), "text"), "item", sizes)
    found = found.withColumnRenamed("pos", "item_pos").select("item.item_id", "item.version", "kind", "n", "item_pos", "hash")
    met = found.join(items.select("item_id", "version", "kind", "words", F.size("words").alias("len")), ["item_id", "version", "kind"]).where(F.col("n") == own)
    literals = F.size(F.filter(F.slice("words", F.col("item_pos") + 1, F.col("n")), lambda x: x["kind"].isNull()))
    return met.where((F.col("kind") == "v") | (literals >= F.least(F.lit(LITERALS), F.col("n") - 1))).select("item_id", "kind", "n", "item_pos", "hash", "len")


def _judged(laid: DataFrame) -> DataFrame:
    """Adds ``covered, slots, changed, holds`` to alignments with the item's words ``ours`` and the document's ``theirs``.

    ``theirs`` begins at the item's word ``lead``. Equality is written as a string of 0 and 1, from which short runs go.
    """
    there = lambda i: F.get("theirs", i - F.col("lead"))
    alike = lambda x, y: F.when(F.col("kind") == "v", x["w"] == y["w"]).otherwise(F.coalesce(x["kind"].cast("string"), x["w"]) == F.coalesce(y["kind"].cast("string"), y["w"]))
    mask = F.array_join(F.transform("ours", lambda x, i: F.when(alike(x, there(i)), "1").otherwise("0")), "")
    runs = F.col("mask")
    for n in range(1, RUN):
        runs = F.regexp_replace(runs, f"(?<!1)1{{{n}}}(?!1)", "0" * n)
    laid = laid.withColumn("mask", mask).withColumn("mask", F.when(F.col("len") >= RUN, runs).otherwise(F.col("mask")))
    covered = F.length(F.regexp_replace("mask", "0", ""))
    at = F.filter(F.sequence(F.lit(0), F.col("len") - 1), lambda i: (F.substring(F.col("mask"), i + 1, F.lit(1)) == "1") & F.get("ours", i)["kind"].isNotNull())
    slots = F.transform(at, lambda i: F.struct(F.struct(F.get("ours", i)["kind"], F.get("ours", i)["w"]).alias("ours"), F.struct(there(i)["kind"], there(i)["w"]).alias("theirs")))
    laid = laid.withColumn("covered", covered).withColumn("pairs", F.when(F.col("kind") == "t", slots).otherwise(F.slice(slots, 1, 0)))
    consistent = F.size(F.array_distinct("pairs")) == F.size(F.array_distinct("pairs.ours"))
    need = F.when(F.col("len") < WINDOW, F.col("len")).otherwise(F.least(F.lit(ENOUGH), F.ceil(F.col("len") * SHARE)))
    changed = F.size(F.filter("pairs", lambda p: p["ours"] != p["theirs"]))
    return laid.withColumn("slots", F.size("pairs")).withColumn("changed", changed).withColumn("holds", (F.col("covered") >= need) & consistent)


def leaks(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``(doc_id, item_id, item_words, covered, slots, changed)``: documents that hold a benchmark item.

    ``covered`` is the number of the item's words that stand on the best alignment in runs of RUN words or more,
    ``slots`` and ``changed`` its placeholders there and those whose filler differs from the item's.
    """
    text = F.col("text").cast("string").alias("text")
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text).where("doc_id is not null")
    word = lambda x: x
    both = F.array(*[F.struct(F.lit(k).alias("kind"), x.alias("words")) for k, x in (("v", F.col("read")), ("t", template_of(F.col("read"))))])
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), text).where("item_id is not null and text is not null").dropDuplicates()
    items = items.withColumn("version", F.xxhash64("text")).withColumn("read", words_of(F.col("text"), word))
    items = save(items.select("item_id", "version", "text", F.explode(both).alias("x")).select("item_id", "version", "text", "x.*").where("size(words) > 0"), "items")
    lengths = items.select(F.least(F.size("words"), F.lit(WINDOW)).alias("n")).distinct()
    sizes = sorted({WINDOW, *(r.n for r in lengths.collect())})  # at most WINDOW rows
    known = save(_item_windows(items, sizes).distinct(), "windows")
    few = known.count() <= BROADCAST_WINDOWS
    small = F.broadcast if few else (lambda df: df)

    met = _windows(docs, "doc_id", sizes).join(small(known), ["kind", "n", "hash"])
    aligned = save(met.select("doc_id", "item_id", "kind", "len", (F.col("pos") - F.col("item_pos")).alias("shift")).distinct(), "aligned")
    wanted = aligned.groupBy("doc_id", "kind").agg(F.collect_list(F.struct("item_id", "len", "shift")).alias("at"))
    read = docs.join(wanted, "doc_id").select("doc_id", "kind", "at", words_of(F.col("text"), word).alias("read"))
    read = read.select("doc_id", "kind", "at", F.when(F.col("kind") == "v", F.col("read")).otherwise(template_of(F.col("read"))).alias("words"))
    lead = lambda x: F.greatest(-x["shift"], F.lit(0))
    parts = F.transform("at", lambda x: F.struct(x["item_id"].alias("item_id"), x["len"].alias("len"), x["shift"].alias("shift"), lead(x).alias("lead"), F.slice("words", F.greatest(x["shift"], F.lit(0)) + 1, F.greatest(x["len"] - lead(x), F.lit(0))).alias("theirs")))
    laid = read.select("doc_id", "kind", F.explode(parts).alias("x")).select("doc_id", "kind", "x.*")
    ours = items.select("item_id", "kind", F.col("words").alias("ours"), F.size("words").alias("len"))
    judged = _judged(laid.join(small(ours), ["item_id", "kind", "len"])).where("holds")
    lengths = items.where("kind = 'v'").groupBy("item_id").agg(F.max(F.size("words")).cast("long").alias("item_words"))
    long_ = lambda c: F.col(c).cast("long").alias(c)
    best = F.max(F.struct(long_("covered"), long_("slots"), (-F.col("shift")).alias("order"), long_("changed")))
    out = judged.groupBy("doc_id", "item_id").agg(best.alias("b")).join(small(lengths), "item_id", "left")
    return out.select("doc_id", "item_id", F.coalesce("item_words", F.lit(0)).alias("item_words"), "b.covered", "b.slots", "b.changed")


def clean(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without any leaked item, with all their columns; rows without a doc_id stay."""
    return documents.join(leaks(documents, benchmark).select("doc_id").distinct(), "doc_id", "left_anti").select(documents.columns)
