"""Quality classifier: supervised subword embeddings.

A document is the average of learned vectors of its hashed features: words, character n-grams inside words, and pairs
of neighbouring words (a word that repeats the one before it gives one feature for all words). A softmax over the
average gives the label. The vectors and the softmax are trained by numpy stochastic gradient descent on a bounded,
documented sample of labelled rows; scoring then needs one weight for each bucket, since average and output are linear.

Null and empty texts score as a text without features. Labels other than 0 and 1, null labels, and labelled doc_ids
that several labels contradict teach nothing. Without any labelled row every score is 0.5. Equal texts score alike,
repeated rows each for itself; other columns of the documents never enter. Texts are scored whole, in runs of about a
megabyte, a longer one alone. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from stereobate.llm._io import small_batches
from stereobate.llm._text import _powers, chunks

BITS, DIM, EPOCHS, RATE = 17, 8, 12, 1.0
GRAMS = (3, 4, 5)
#: Training uses at most so many labelled rows, and of them at most so many bytes of text.
SAMPLE, SAMPLE_BYTES = 4000, 24 << 20
THRESHOLD = 0.3


def _features(data: np.ndarray, starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Groups of features: their buckets in the order of the texts, and where each text's begin."""
    codes = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    starts = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))[starts]
    lower = codes.astype(np.uint64) + np.uint64(32) * ((codes > 64) & (codes < 91))
    solid = (codes != 32) & ((codes < 9) | (codes > 13))
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1]
    last[:-1] &= ~solid[1:]
    inner = starts[(starts > 0) & (starts < len(codes))]
    first[inner] |= solid[inner]
    last[inner - 1] |= solid[inner - 1]
    begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    up, down = _powers(len(codes) + 1)
    run = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum((lower + np.uint64(1)) * up[: len(codes)], out=run[1:])

    def bucket(h: np.ndarray, kind: int) -> np.ndarray:
        return ((h * np.uint64(0x9E3779B97F4A7C15) + np.uint64(kind * 0xD6E8FEB86659FD93 % (1 << 64))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - BITS)).astype(np.int32)

    words, at = (run[end] - run[begin]) * down[begin], np.searchsorted(begin, starts)
    yield bucket(words, 1), at
    pair = np.ones(len(words), bool)
    pair[at[:-1][at[:-1] < len(words)]] = False
    second = np.flatnonzero(pair)
    both = np.where(words[second] == words[second - 1], np.uint64(1), words[second - 1] * np.uint64(0x94D049BB133111EB) + words[second])
    yield bucket(both, 2), np.searchsorted(second, at)
    inside = np.flatnonzero(solid)
    room = np.repeat(end, end - begin) - inside
    for n in GRAMS:
        here = inside[room >= n]
        yield bucket((run[here + n] - run[here]) * down[here], n), np.searchsorted(here, starts)


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct buckets of each labelled text and how often each occurs."""
    for batch in batches:
        for row, end, data, starts in chunks(batch.column("text")):
            groups = list(_features(data, starts))
            ids, times = [], []
            for i in range(end - row):
                found, n = np.unique(np.concatenate([b[at[i] : at[i + 1]] for b, at in groups]), return_counts=True)
                ids.append(found.astype(np.int32).tobytes())
                times.append(n.astype(np.int32).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("label").slice(row, end - row), pa.array(ids, pa.binary()), pa.array(times, pa.binary())], ["label", "ids", "times"])


def train(examples: list[tuple[int, np.ndarray, np.ndarray]], seed: int = 5) -> tuple[np.ndarray, float]:
    """Weight of each bucket and the bias, for the log-odds of label 1; by stochastic gradient descent."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (1 << BITS, DIM)).astype(np.float32)
    output, bias = rng.uniform(-1 / DIM, 1 / DIM, (DIM, 2)).astype(np.float32), np.zeros(2, np.float32)
    examples = [(y, ids, (n / n.sum()).astype(np.float32)) for y, ids, n in examples if len(n)]
    steps, step = max(1, EPOCHS * len(examples)), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(examples)):
            y, ids, share = examples[i]
            rate = RATE * (1 - step / steps)
            step += 1
            rows = vectors[ids]
            mean = share @ rows
            logits = mean @ output + bias
            error = np.exp(logits - logits.max())
            error /= error.sum()
            error[y] -= 1
            back = output @ error
            output -= rate * np.outer(mean, error)
            bias -= rate * error
            vectors[ids] = rows - (rate * len(share) ** 0.5) * np.outer(share, back)
    return vectors @ (output[:, 1] - output[:, 0]), float(bias[1] - bias[0])


def _score(shared, column: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = shared.value
        for batch in batches:
            for row, end, data, starts in chunks(batch.column("text")):
                total, count = np.zeros(end - row), np.zeros(end - row)
                for found, at in _features(data, starts):
                    run = np.concatenate(([0.0], np.cumsum(weights[found], dtype=np.float64)))
                    total += run[at[1:]] - run[at[:-1]]
                    count += np.diff(at)
                logit = np.clip(total / np.maximum(count, 1) + bias, -60, 60)
                kept = [batch.column(i).slice(row, end - row) for i in range(batch.num_columns)]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(1 / (1 + np.exp(-logit)))], [*batch.schema.names, column])

    return run


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(n))


def _fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The trained weights and bias, from all examples of the bounded sample."""
    examples = [(y.as_py(), np.frombuffer(i.as_py(), np.int32), np.frombuffer(t.as_py(), np.int32)) for b in batches for y, i, t in zip(*(b.column(c) for c in ("label", "ids", "times")))]
    examples.sort(key=lambda x: (x[1].tobytes(), x[2].tobytes(), x[0]))
    if examples:
        weights, bias = train(examples)
        yield pa.RecordBatch.from_arrays([pa.array([weights.astype(np.float32).tobytes()], pa.binary()), pa.array([bias])], ["weights", "bias"])


def fit(documents: DataFrame, labels: DataFrame) -> tuple[np.ndarray, float]:
    """Train on labelled documents outside fold 0 of 5: those first by a hash of their id, up to the bounds.

    Labels meet the documents before anything is bounded. A text that doesn't fit the rest of SAMPLE_BYTES is passed
    over, unless it would be the only one. Of several texts of one doc_id that of the least hash is taken. Training
    runs in one task over this bounded sample; the driver gets the weights only.
    """
    clear = labels.where("quality in (0, 1) and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").cast("int").alias("label"), F.max("quality").alias("most")).where("label = most").drop("most")
    docs = small_batches(documents).select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    ours = docs.where(fold(F.col("doc_id"), 5) != 0)
    sizes = ours.select("doc_id", F.octet_length("text").alias("size")).join(clear, "doc_id").groupBy("doc_id", "label").agg(F.max("size").alias("size"))
    chosen, left = [], SAMPLE_BYTES
    for r in sizes.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE).collect():  # three numbers a row
        if r["size"] <= left or not chosen:
            chosen, left = [*chosen, (r.doc_id, r.label)], max(left - r["size"], 0)
    if not chosen:
        return np.zeros(1 << BITS, np.float32), 0.0
    taught = F.broadcast(documents.sparkSession.createDataFrame(chosen, "doc_id long, label int"))
    one = ours.join(taught, "doc_id").groupBy("doc_id", "label").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    examples = one.select("label", "text").mapInArrow(_examples, "label int, ids binary, times binary")
    row = examples.coalesce(1).mapInArrow(_fitted, "weights binary, bias double").first()
    return np.frombuffer(row.weights, np.float32), row.bias


def score(documents: DataFrame, model: tuple[np.ndarray, float], column: str = "score") -> DataFrame:
    """All columns of every document and ``column``, the probability of label 1; ``column`` must be a new name."""
    if column in documents.columns:
        raise ValueError(f"documents have a column {column} already")
    shared = documents.sparkSession.sparkContext.broadcast(model)
    schema = StructType([*documents.schema.fields, StructField(column, DoubleType())])
    return small_batches(documents).mapInArrow(_score(shared, column), schema)


def quality(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` of every whole text."""
    model = fit(documents, labels)
    scored = score(documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), model).drop("text")
    return scored.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
