"""Near-duplicate documents by MinHash: universal hash minima, banding, verification, components.

Every text becomes the set of its distinct 5-word shingles. Texts with the same set are one node from then on, so a
large group of copies costs as much as one text. Nodes that agree on all rows of a band meet in a bucket. First every
node of a bucket is compared with the two hubs of it, its smallest and its largest node; that is linear in the size of a
bucket, and most copies are linked by it. Then, in buckets whose other nodes lie in several components still, all
nodes of different components are compared, block by block. So every two nodes that share a band are compared or
are in one component already, whatever the size of the bucket; no size is treated in another way.

A comparison is of signatures first. With a hub they are one byte of each of the 96 minima that make the bands; at the
limit a pair fails there with a chance under one in a hundred million (``SLACK`` below the limit). Between components
they are ``BITS`` one-bit minima, made for the nodes of such buckets only: five deviations below the limit, one in three
million, so that a group of many texts that are nearly similar enough yields few pairs. Those that pass are compared on
their full sets, and only these links count. Components are found by alternating large-star and small-star.

Null and empty texts have no shingles and no links. Rows that share a doc_id are one node. A row without a doc_id
takes part in nothing: its component_id is null and it is kept. Other columns are left alone. Long texts are hashed
whole, a text of over a megabyte alone; an empty table gives an empty result. Ties have no influence on components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stereobate.llm._graph import components
from stereobate.llm._io import drop, save, small_batches
from stereobate.llm._text import chunks, grams, mix, word_hashes

BANDS, ROWS = 24, 4
#: Signatures agree in about the similarity's share of rows; so far below the limit a pair is not compared further.
SLACK = 0.25
BLOCK, BITS, DEVIATIONS = 512, 4096, 5
#: Ids of documents whose sets are wanted are broadcast up to this number (8 bytes each); beyond, they are joined.
BROADCAST_IDS = 2_000_000

_FINGERPRINT = "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>, signature binary"


def _coefficients(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers (odd) and addends of ``n`` multiply-shift hash functions."""
    seeds = mix(np.arange(1, 2 * n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return seeds[:n] | np.uint64(1), seeds[n:]


def _shingle_sets(data: np.ndarray, starts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, and where each text's begin."""
    found, first = grams(*word_hashes(data, starts), k, whole_if_short=True)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    order = np.lexsort((found, text))
    found, text = found[order], text[order]
    fresh = np.ones(len(found), bool)
    fresh[1:] = (found[1:] != found[:-1]) | (text[1:] != text[:-1])
    found, text = found[fresh], text[fresh]
    return found, np.searchsorted(text, np.arange(len(first)))


def _fingerprints(k: int):
    mul, add = _coefficients(BANDS * ROWS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            for row, end, data, starts in chunks(batch.column("text")):
                sets, first = _shingle_sets(data, starts, k)
                n = np.diff(first)
                held = np.flatnonzero(n)
                sig = np.zeros((len(n), BANDS * ROWS), np.uint32)
                a, b = np.zeros(len(n), np.uint64), np.zeros(len(n), np.uint64)
                if len(held):
                    cut = first[:-1][held]
                    for j in range(BANDS * ROWS):
                        sig[held, j] = np.minimum.reduceat(((sets * mul[j] + add[j]) >> np.uint64(32)).astype(np.uint32), cut)
                    a[held] = np.add.reduceat(mix(sets + np.uint64(1)), cut)
                    b[held] = np.bitwise_xor.reduceat(mix(sets ^ np.uint64(0x5851F42D4C957F2D)), cut)
                bands = np.zeros((len(n), BANDS), np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64)
                for r in range(ROWS):
                    bands = mix(bands * np.uint64(0xD6E8FEB86659FD93) + sig[:, r::ROWS])
                flat = pa.array(bands.view(np.int64).ravel())
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(row, end - row).cast(pa.int64()),
                        pa.array(n.astype(np.int64)),
                        pa.array(a.view(np.int64)),
                        pa.array(b.view(np.int64)),
                        pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1, dtype=np.int32) * BANDS), flat),
                        pa.array([x.tobytes() for x in (sig & np.uint32(255)).astype(np.uint8)], pa.binary()),
                    ],
                    ["doc_id", "n_shingles", "set_a", "set_b", "bands", "signature"],
                )

    return run


def _sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, starts in chunks(batch.column("text")):
                sets, first = _shingle_sets(data, starts, k)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(row, end - row).cast(pa.int64()), pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(sets.view(np.int64)))], ["node", "shingles"])

    return run


def _bits(k: int):
    """One bit of each of BITS minima of every text, packed."""
    mul, add = (x[BANDS * ROWS :] for x in _coefficients(BANDS * ROWS + BITS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, starts in chunks(batch.column("text")):
                sets, first = _shingle_sets(data, starts, k)
                held = np.flatnonzero(np.diff(first))
                bits = np.zeros((end - row, BITS), np.uint8)
                for j in range(BITS if len(held) else 0):
                    bits[held, j] = np.minimum.reduceat((sets * mul[j] + add[j]) >> np.uint64(32), first[:-1][held]) & np.uint64(1)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(row, end - row).cast(pa.int64()), pa.array([x.tobytes() for x in np.packbits(bits, axis=1)], pa.binary())], ["node", "bits"])

    return run


def _signatures(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), BANDS * ROWS)


def _alike(least: int):
    """Keeps pairs whose signatures agree in at least ``least`` rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = _signatures(batch.column("sig_node")), _signatures(batch.column("sig_hub"))
                yield batch.select(["node", "hub"]).filter(pa.array((x == y).sum(axis=1) >= least))

    return run


def _across(percent: int):
    """Pairs of different components in each block pair (band, l, r) of a sorted partition whose bits agree enough.

    Bits agree with chance (1 + similarity) / 2. A block pair holds about BLOCK rows of either side, so what waits for
    the next batch is bounded.
    """
    agree = (1 + percent / 100) / 2
    least = BITS * agree - DEVIATIONS * (BITS * agree * (1 - agree)) ** 0.5

    def pairs(band, side, node, component, sign, bands):
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        if len(left) and len(right):
            same = (sign[left] @ sign[right].T + BITS) / 2
            i, j = np.nonzero((same >= least) & (component[left][:, None] != component[right][None, :]))
            # A pair that meets in several buckets is named in the least of them only.
            i, j = left[i], right[j]
            first = np.array([min(bands[x] & bands[y]) == band for x, y in zip(i.tolist(), j.tolist())], bool)
            yield node[i[first]], node[j[first]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def done(table: pa.Table) -> pa.RecordBatch:
            side, node, component = (table.column(c).to_numpy() for c in ("side", "node", "component"))
            packed = np.frombuffer(b"".join(table.column("bits").to_pylist()), np.uint8).reshape(len(node), -1)
            group = np.stack([table.column(c).to_numpy() for c in ("band", "l", "r")])
            cuts = np.concatenate(([0], np.flatnonzero((group[:, 1:] != group[:, :-1]).any(axis=0)) + 1, [len(node)]))
            bands = [set(x) for x in table.column("bands").to_pylist()]
            found = [p for lo, hi in zip(cuts[:-1], cuts[1:]) for p in pairs(group[0, lo], side[lo:hi], node[lo:hi], component[lo:hi], np.unpackbits(packed[lo:hi], axis=1).astype(np.float32) * 2 - 1, bands[lo:hi])]
            a, b = (np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.int64) for i in (0, 1))
            both = np.unique(np.stack((np.maximum(a, b), np.minimum(a, b))), axis=1)
            return pa.RecordBatch.from_arrays([pa.array(both[0]), pa.array(both[1])], ["node", "hub"])

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                t = pa.Table.from_batches(held)
                last = np.stack([t.column(c).to_numpy() for c in ("band", "l", "r")])
                open_ = np.flatnonzero((last != last[:, -1:]).any(axis=0))
                whole = int(open_[-1]) + 1 if len(open_) else 0
                if whole:
                    yield done(t.slice(0, whole))
                held = t.slice(whole).to_batches()
        if held:
            yield done(pa.Table.from_batches(held))

    return run


def _with_signatures(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs (node, hub) with both signatures: the node's comes first, so that a hub's is not sent once for each pair."""
    sig = lambda c: nodes.select(F.col("node").alias(c), F.col("signature").alias(f"sig_{c}"))
    return pairs.join(sig("node"), "node").join(sig("hub"), "hub").select("node", "hub", "sig_node", "sig_hub")


def _texts_of(ids: DataFrame, docs: DataFrame) -> DataFrame:
    """The documents (doc_id, text) of ``ids(doc_id)``; few ids are broadcast, so that texts are not shuffled for them."""
    ids = save(ids, "ends")
    few = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    return docs.join(F.broadcast(ids) if few else ids, "doc_id", "left_semi").select("doc_id", "text")


def _verified(near: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """Those of the pairs (node, hub) whose full shingle sets are similar enough, as links (a, b) in the shared folder."""
    ends = near.select(F.col("node").alias("doc_id")).unionByName(near.select(F.col("hub").alias("doc_id"))).distinct()
    sets = save(_texts_of(ends, docs).mapInArrow(_sets(k), "node long, shingles array<long>"), "sets")
    of = lambda c, x: sets.select(F.col("node").alias(c), F.col("shingles").alias(x))
    held = near.join(of("node", "set_x"), "node").join(of("hub", "set_y"), "hub")
    # Full sets are compared row by row in the JVM: two long texts at a time, never a batch of them.
    both = F.size(F.array_intersect("set_x", "set_y"))
    alike = held.where(100 * both >= percent * (F.size("set_x") + F.size("set_y") - both))
    links = save(alike.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct(), "links")
    drop(sets)
    return links


def _open_blocks(member: DataFrame, labels: DataFrame, docs: DataFrame, k: int) -> DataFrame:
    """``band, l, r, side, node, component, bits, bands``: the block pairs of buckets that hold several components yet.

    Hubs have been compared already. The nodes of the largest component of a bucket meet those of all others, and
    these meet each other; each side is dealt into blocks of about BLOCK nodes.
    """
    others = member.where("node <> low and node <> high").select("band", "node").join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    sizes = others.groupBy("band", "component").agg(F.count("*").alias("size"))
    main = sizes.groupBy("band").agg(F.count("*").alias("components"), F.max(F.struct("size", "component")).alias("most"), F.sum("size").alias("total")).where("components > 1")
    main = save(main.select("band", F.col("most.component").alias("main"), F.ceil(F.col("total") / BLOCK).cast("int").alias("rb"), F.ceil((F.col("total") - F.col("most.size")) / BLOCK).cast("int").alias("lb")), "main")
    rows = save(others.join(main, "band"), "open")
    meets = save(rows.groupBy("node").agg(F.collect_set("band").alias("bands")), "meets")  # at most BANDS of each node
    bits = save(_texts_of(meets.select(F.col("node").alias("doc_id")), docs).mapInArrow(_bits(k), "node long, bits binary").join(meets, "node"), "bits")
    dealt = lambda n, seed: F.pmod(F.xxhash64("node", F.lit(seed)), F.col(n)).cast("int")
    every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    right = F.transform(every("lb"), lambda i: F.struct(F.lit(1).alias("side"), i.alias("l"), dealt("rb", 7).alias("r")))
    left = F.transform(every("rb"), lambda i: F.struct(F.lit(0).alias("side"), dealt("lb", 8).alias("l"), i.alias("r")))
    out = rows.join(bits, "node").withColumn("at", F.explode(F.when(F.col("component") == F.col("main"), right).otherwise(F.concat(left, right))))
    return out.select("band", "at.l", "at.r", "at.side", "node", "component", "bits", "bands")


def near_duplicates(documents: DataFrame, percent: int = 85, k: int = 5) -> DataFrame:
    """``documents(doc_id, text)`` -> ``(doc_id, n_shingles, component_id, kept)``, one row for each row.

    Links are pairs of documents with 100 * intersection >= percent * union of their shingle sets; a component is
    named by its smallest doc_id, and that document is kept.
    """
    docs = small_batches(documents).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    prints = save(docs.mapInArrow(_fingerprints(k), _FINGERPRINT), "prints")
    same = ["set_a", "set_b", "n_shingles"]
    first = prints.where("n_shingles > 0 and doc_id is not null").groupBy(*same).agg(F.min(F.struct("doc_id", "bands", "signature")).alias("x"))
    classes = save(first.select(*same, F.col("x.doc_id").alias("node"), "x.bands", "x.signature"), "classes")
    nodes = classes.select("node", "bands", "signature")

    banded = nodes.select("node", F.explode("bands").alias("band"))
    # Hubs are a table of their own, so that both sides of the join are dealt out and a crowded band can be split.
    hubs = save(banded.groupBy("band").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low <> high"), "hubs")
    member = save(banded.join(hubs, "band"), "buckets")
    star = member.select("node", F.explode(F.array("low", "high")).alias("hub")).where("node <> hub").distinct()
    least = int(np.ceil((percent / 100 - SLACK) * BANDS * ROWS))
    near = save(_with_signatures(star, nodes).mapInArrow(_alike(least), "node long, hub long"), "alike")
    links = _verified(near, docs, k, percent)
    labels = save(components(links), "labels")

    blocks = _open_blocks(member, labels, docs, k).repartition("band", "l", "r").sortWithinPartitions("band", "l", "r")
    more = save(blocks.mapInArrow(_across(percent), "node long, hub long").distinct(), "more")
    if not more.isEmpty():
        extra = _verified(more, docs, k, percent)
        # Only the components that the new links join are named again.
        name = lambda c: labels.select(F.col("node").alias(c), F.col("component").alias(f"of_{c}"))
        joined = extra.join(name("a"), "a", "left").join(name("b"), "b", "left").select(F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b")).where("a <> b")
        again = save(components(joined), "again").select(F.col("node").alias("component"), F.col("component").alias("now"))
        own = classes.select("node").distinct().join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
        labels = save(own.join(again, "component", "left").select("node", F.coalesce("now", "component").alias("component")), "labels")

    named = save(classes.join(labels, "node", "left").select(*same, F.coalesce("component", "node").alias("class_component")), "named")
    # A doc_id that occurs with several texts is one node, whichever text it was found by.
    out = prints.select("doc_id", *same).join(named, same, "left")
    component = F.coalesce("class_component", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
