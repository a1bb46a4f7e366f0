"""Ranked lexical search over an index whose documents are grouped by their length normaliser.

Documents with equal normaliser ``m`` make a stratum. Within a stratum a term's postings are ordered by its count ``tf``,
so that all postings of one (stratum, term, tf) share their impact, which is computed once. A term's first count in a
stratum bounds what it can give there; an item's bounds over its terms order the strata that it visits, and the visit
ends at the first stratum whose bound is under the score of the item's k-th document so far. No document is left out.

The index lies in the shared folder as one row for each document with a term: its normaliser's length, its terms and
their counts. A search deals it by (m, document) into ranges, so that a stratum of any size is split over tasks; a task
holds segments of at most SEGMENT_DOCS documents or SEGMENT_POSTINGS postings and, for each item, the k best so far. The
k best of all tasks are ranked by a window. Items come in blocks of about BLOCK_TERMS terms, each of which is broadcast.

Terms are known by 64-bit hashes. Null and empty texts have no terms: such documents count in nothing, such items find
nothing. Each row of the items is an item of its own and repeated documents are found as often as they occur; equal
scores go by doc_id, null ids last. Other columns are left alone, texts are read whole, an empty table finds nothing.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from stereobate.llm._io import save, small_batches
from stereobate.llm._text import chunks, ranges, word_hashes

GAP = np.array([not (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b > 127) for b in range(256)])
SEGMENT_DOCS, SEGMENT_POSTINGS = 1 << 15, 1 << 21
#: Terms of the items that one search takes.
BLOCK_TERMS = 500_000
#: Up to this many distinct terms of items, the index holds only those; beyond, every term. Results are the same.
FILTER_TERMS = 4_000_000
FIRST_VISIT = 1024


def _counted(shared):
    """Texts to ``(id, n, terms, tfs)``: the number of terms, the distinct ones (of ``shared``, if any) and their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value if shared is not None else None
        for batch in batches:
            for row, end, data, starts in chunks(batch.column("text")):
                hashes, at = word_hashes(data, starts, gap=GAP)
                hashes = hashes.view(np.int64)
                n = np.diff(at)
                doc = np.repeat(np.arange(len(n)), n)
                if known is not None:
                    held = known[np.minimum(np.searchsorted(known, hashes), len(known) - 1)] == hashes if len(known) else np.zeros(len(hashes), bool)
                    doc, hashes = doc[held], hashes[held]
                order = np.lexsort((hashes, doc))
                doc, hashes = doc[order], hashes[order]
                new = np.ones(len(doc), bool)
                new[1:] = (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])
                first = np.flatnonzero(new)
                tf = np.diff(np.append(first, len(doc)))
                offsets = np.concatenate(([0], np.cumsum(np.bincount(doc[first], minlength=len(n))))).astype(np.int32)
                lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (hashes[first], tf.astype(np.int64))]
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(row, end - row), pa.array(n.astype(np.int64)), *lists], ["id", "n", "terms", "tfs"])

    return run


def counted(texts: DataFrame, vocabulary: np.ndarray | None = None) -> DataFrame:
    """``texts(id, text)`` -> ``(id, n, terms, tfs)``, terms as hashes; with ``vocabulary`` (sorted) only those of it."""
    shared = None if vocabulary is None else texts.sparkSession.sparkContext.broadcast(vocabulary)
    return small_batches(texts.select("id", "text")).mapInArrow(_counted(shared), "id long, n long, terms array<long>, tfs array<long>")


class Segment:
    """Postings of some documents by (term, stratum, falling tf); runs of equal ones are groups with one impact."""

    def __init__(self, vocabulary: np.ndarray, m: np.ndarray, ids: np.ndarray, absent: np.ndarray, lengths: np.ndarray, terms: np.ndarray, tf: np.ndarray):
        doc = np.repeat(np.arange(len(m)), lengths)
        term = np.minimum(np.searchsorted(vocabulary, terms), len(vocabulary) - 1)
        held = vocabulary[term] == terms
        doc, term, tf = doc[held], term[held], tf[held]
        strata, stratum = np.unique(m, return_inverse=True)
        self.ids, self.absent, self.size = ids, absent, np.bincount(stratum, minlength=len(strata))
        at = stratum[doc]
        order = np.lexsort((doc, -tf, at, term))
        term, at, tf, self.doc = term[order], at[order], tf[order], doc[order]
        top = np.ones(len(term), bool)
        top[1:] = (term[1:] != term[:-1]) | (at[1:] != at[:-1])
        new = top.copy()
        new[1:] |= tf[1:] != tf[:-1]
        self.first = np.flatnonzero(new)
        self.count = np.diff(np.append(self.first, len(term)))
        self.stratum = at[self.first]
        tf = tf[self.first]
        self.impact = 1_000_000_000 * tf // (1000 * tf + 12 * strata[self.stratum])
        self.top = np.flatnonzero(top[self.first])
        self.groups_at = np.searchsorted(term[self.first], np.arange(len(vocabulary) + 1))
        self.tops_at = np.searchsorted(term[self.first][self.top], np.arange(len(vocabulary) + 1))
        self.score = np.zeros(len(m), np.int64)

    def search(self, terms: np.ndarray, weights: np.ndarray, best: tuple, k: int) -> tuple:
        """``best`` (scores, ids, absent ids) of an item, with this segment's documents."""
        bound = np.zeros(len(self.size), np.int64)
        for t, w in zip(terms, weights):
            tops = self.top[self.tops_at[t] : self.tops_at[t + 1]]
            bound[self.stratum[tops]] += w * self.impact[tops]
        order = np.argsort(-bound, kind="stable")
        docs = np.cumsum(self.size[order])
        at, visit = 0, FIRST_VISIT
        while at < len(order):
            least = max(1, int(best[0][-1]) if len(best[0]) == k else 1)  # a tie may still win by its id
            end = min(int(np.searchsorted(docs, (docs[at - 1] if at else 0) + visit)) + 1, int(np.searchsorted(-bound[order], -least, "right")))
            if end <= at:
                break
            chosen = np.zeros(len(order), bool)
            chosen[order[at:end]] = True
            self.score[:] = 0
            for t, w in zip(terms, weights):
                groups = np.arange(self.groups_at[t], self.groups_at[t + 1])
                groups = groups[chosen[self.stratum[groups]]]
                count = self.count[groups]
                self.score[self.doc[ranges(self.first[groups], count)]] += np.repeat(w * self.impact[groups], count)
            found = np.flatnonzero(self.score >= least)
            if len(found):
                scores, ids, absent = (np.concatenate(x) for x in zip(best, (self.score[found], self.ids[found], self.absent[found])))
                first = np.lexsort((ids, absent, -scores))[:k]
                best = scores[first], ids[first], absent[first]
            at, visit = end, visit * 4
        return best


def _segments(batches: Iterator[pa.RecordBatch], vocabulary: np.ndarray) -> Iterator[Segment]:
    held, docs, postings = [], 0, 0
    for batch in batches:
        ids, terms, tfs = batch.column("id"), batch.column("terms"), batch.column("tfs")
        absent = np.asarray(ids.is_null())
        held.append((np.asarray(batch.column("m")), np.asarray(ids.fill_null(0)), absent, np.asarray(terms.value_lengths()), np.asarray(terms.flatten()), np.asarray(tfs.flatten())))
        docs, postings = docs + len(absent), postings + len(held[-1][4])
        if docs >= SEGMENT_DOCS or postings >= SEGMENT_POSTINGS:
            yield Segment(vocabulary, *(np.concatenate(x) for x in zip(*held)))
            held, docs, postings = [], 0, 0
    if docs:
        yield Segment(vocabulary, *(np.concatenate(x) for x in zip(*held)))


def _searched(shared, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, items = shared.value
        none = np.zeros(0, np.int64)
        best = [(none, none, np.zeros(0, bool))] * len(items)
        for segment in _segments(batches, vocabulary):
            best = [segment.search(terms, weights, b, k) for (_, terms, weights), b in zip(items, best)]
        for (item, _, _), (scores, ids, absent) in zip(items, best):
            if len(scores):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(scores), item)), pa.array(ids, mask=absent), pa.array(scores)], ["item", "doc_id", "score"])

    return run


class Index:
    """The documents' lengths, terms and counts in the shared folder; ``vocabulary`` limits it to the terms asked for."""

    def __init__(self, documents: DataFrame, vocabulary: np.ndarray | None = None):
        texts = documents.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
        rows = save(counted(texts, vocabulary).where("n > 0"), "terms")
        self.n, self.words = (int(x or 0) for x in rows.agg(F.count("*"), F.sum("n")).first())
        m = F.lit(75) + F.expr(f"25 * n * {self.n}L div {max(self.words, 1)}L")
        self.rows = rows.where("size(terms) > 0").select("id", m.cast("long").alias("m"), "terms", "tfs")
        self.frequency = save(rows.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")), "frequency")

    def weight(self, df: int) -> int:
        return math.floor(1000 * math.log((2 * self.n + 2) / (2 * df + 1)))

    def search(self, items: DataFrame, k: int) -> DataFrame:
        """``items(item, terms, tfs)`` of one block -> ``(item, rank, doc_id, score)``, the k best of each."""
        spark = items.sparkSession
        asked = items.select(F.explode("terms").alias("term")).distinct()
        df = {r.term: r.df for r in self.frequency.join(asked, "term", "left_semi").collect()}
        vocabulary = np.array(sorted(df), np.int64)
        block = []
        for r in items.select("item", "terms", "tfs").collect():
            pairs = [(t, c * self.weight(df[t])) for t, c in zip(r.terms, r.tfs) if t in df]
            pairs = [(t, w) for t, w in pairs if w > 0]
            if pairs:
                block.append((r.item, np.searchsorted(vocabulary, [t for t, _ in pairs]), np.array([w for _, w in pairs], np.int64)))
        shared = spark.sparkContext.broadcast((vocabulary, block))
        dealt = self.rows.repartitionByRange("m", F.xxhash64("id", "terms")).sortWithinPartitions("m")
        found = (dealt if block else dealt.limit(0)).mapInArrow(_searched(shared, k), "item long, doc_id long, score long")
        best = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
        return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def ranked(documents: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """``items(item_id, text)`` -> ``(item_id, rank, doc_id, score)``: the ``k`` best documents with a score above 0."""
    numbered = save(items.select(F.monotonically_increasing_id().alias("id"), F.col("item_id"), F.col("text").cast("string").alias("text")), "items")
    asked = save(counted(numbered).withColumnRenamed("id", "item"), "asked")
    terms = asked.select(F.explode("terms").alias("term")).distinct().limit(FILTER_TERMS + 1)
    vocabulary = np.sort(np.array([r.term for r in terms.collect()], np.int64)) if terms.count() <= FILTER_TERMS else None
    index = Index(documents, vocabulary)
    blocks = -(-(asked.agg(F.sum(F.size("terms"))).first()[0] or 1) // BLOCK_TERMS)
    out = None
    for b in range(blocks):
        part = index.search(asked.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b), k)
        out = part if out is None else out.unionByName(part)
    named = numbered.select(F.col("id").alias("item"), "item_id")
    return out.join(named, "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
