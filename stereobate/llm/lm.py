"""Scores of texts under a causal self-attention model over subword ids, trained in numpy.

Words are cut into the ids of a public tokenizer, each word behind a space, and an end token closes the text. One
layer of causal self-attention over a window of ids predicts the class of the next id; the class gives the id by its
share of the class over all training texts. Windows of ``WINDOW`` ids overlap by half, and each scores its second half
only, so every token is scored once with at least half a window of context. A word's probability mixes the product
over its ids with a whole-word reading, if it is one of the most frequent training words: the predicted probability
of its first id's class times the word's share of all training words of that class. The mixing weight is learned too.

All that is learned covers every training text: counts of words (a shuffle that grows with the input), of ids and of
all tokens, classes from what stands beside each id, the network, and the mixing weight. The network begins on a bounded
sample (``SAMPLE_BYTES``); from there every task goes on over its own training texts, and the networks are averaged by
what each has seen (an embedding by its uses), so the result depends on how texts lie in tasks. Before a task learns a
text, the text's words give the mixing weight their odds. The driver holds the sample, one network, and the ``FREQUENT``
most frequent words; the counts of all other words are joined to the documents' rare words by a shuffle. Words are known
by a 64-bit hash.

A null text is an empty text: its one token is the end. Rows without a doc_id are held out or not by the crc32 of an
empty id. Repeated rows are scored, and teach, each for itself. Without training texts the base has N = 0 and V = 0.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from stereobate.llm._io import save, small_batches
from stereobate.llm._text import LOWER, chunks, mix, prefix_hash, words

HALF, WINDOW = 16, 32
DIM, HIDDEN, CLASSES = 16, 32, 40
FREQUENT = 200_000
SAMPLE, SAMPLE_BYTES = 2000, 3 << 20
EPOCHS, BATCH, RATE = 2, 64, 4e-3
#: Contexts that tell classes apart, on either side; rounds of k-means; bins of the odds of a word as a whole, a 64th wide.
CONTEXTS, ROUNDS, BINS = 256, 15, 7680
MOST_SCORE = 30
CHUNK = 1 << 20
BLOCKS = 1024
END = np.uint64(0xE0D0E0D0E0D0E0D1)
MOST_CACHED = 300_000


def read_ranks(path: str) -> dict[bytes, int]:
    """The byte-pair ranks of a tokenizer file, one base64 token and its rank a line."""
    with open(path, "rb") as f:
        return {base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}


class Subwords:
    """Ids of words, cut once and kept while the worker lives; ``size`` is the end token's id."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import tiktoken

        self.coder = tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.size = max(ranks.values()) + 1
        self.opens = np.zeros(self.size + 1, bool)
        for token, i in ranks.items():
            self.opens[i] = token[:1] == b" "
        self.clear()

    def clear(self) -> None:
        self.place: dict[int, int] = {}
        self.begin, self.ids, self.used, self.known = np.zeros(1 << 16, np.int64), np.zeros(1 << 20, np.int32), 0, 0

    def look_up(self, hashes: np.ndarray, text: bytes, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each word's ids begin and end in ``self.ids``; ``text[first:last]`` is the word."""
        if len(self.place) > MOST_CACHED:
            self.clear()
        new = [i for i, h in enumerate(hashes.tolist()) if h not in self.place]
        if new:
            found = np.array(self.coder.encode_ordinary(" " + b" ".join([text[first[i] : last[i]] for i in new]).decode("utf-8")), np.int32)
            starts = np.flatnonzero(self.opens[found])
            while self.used + len(found) > len(self.ids):
                self.ids = np.concatenate((self.ids, np.zeros_like(self.ids)))
            while self.known + len(new) + 1 > len(self.begin):
                self.begin = np.concatenate((self.begin, np.zeros_like(self.begin)))
            self.ids[self.used : self.used + len(found)] = found
            self.begin[self.known : self.known + len(starts)] = starts + self.used
            for n, i in enumerate(new):
                self.place[int(hashes[i])] = self.known + n
            self.used, self.known = self.used + len(found), self.known + len(starts)
            self.begin[self.known] = self.used
        at = np.array([self.place[h] for h in hashes.tolist()], np.int64)
        return self.begin[at], self.begin[at + 1]


_SUBWORDS: dict[int, Subwords] = {}


def _subwords(shared) -> Subwords:
    ranks, pattern = shared.value
    if len(ranks) not in _SUBWORDS:
        _SUBWORDS.clear()
        _SUBWORDS[len(ranks)] = Subwords(ranks, pattern)
    return _SUBWORDS[len(ranks)]


def _parsed(data: np.ndarray, starts: np.ndarray, cut: Subwords):
    """Distinct words' hashes, their ids' begin and end; each word's distinct number; first word of each text."""
    low = LOWER[data]
    begin, end, at = words(data, starts)
    run, down = prefix_hash(low)
    hashes = mix((run[end] - run[begin]) * down[begin])
    distinct, first, number = np.unique(hashes, return_index=True, return_inverse=True)
    lo, hi = cut.look_up(distinct, low.tobytes(), begin[first], end[first])
    return distinct, lo, hi, number, at


def _spread(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """The concatenation of the ranges lo[i]:hi[i]."""
    n = hi - lo
    return np.repeat(lo - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())


def _counts(shared):
    """Counts of words by hash (kind 0), of ids (1) and of words by first id (2); summed over each partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = _subwords(shared)
        ids, firsts = np.zeros(cut.size + 1, np.int64), np.zeros(cut.size + 1, np.int64)
        held: list[tuple[np.ndarray, np.ndarray]] = []
        rows = 0

        def table(kind, key, n):
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(key), kind, np.int32)), pa.array(key), pa.array(n)], ["kind", "key", "n"])

        def merged():
            key, n = (np.concatenate(x) for x in zip(*held))
            distinct, number = np.unique(key, return_inverse=True)
            return distinct, np.bincount(number, weights=n).astype(np.int64)

        for batch in batches:
            for row, end, data, starts in chunks(batch.column("text"), CHUNK):
                distinct, lo, hi, number, _ = _parsed(data, starts, cut)
                n = np.bincount(number, minlength=len(distinct))
                ids += np.bincount(cut.ids[_spread(lo, hi)], weights=np.repeat(n, hi - lo), minlength=len(ids)).astype(np.int64)
                firsts += np.bincount(cut.ids[lo], weights=n, minlength=len(ids)).astype(np.int64)
                held.append((distinct, n))
                rows += end - row
                if sum(len(k) for k, _ in held) > 2_000_000:
                    held = [merged()]
                    if len(held[0][0]) > 1_000_000:
                        yield table(0, held[0][0].view(np.int64), held[0][1])
                        held = []
        ids[cut.size] += rows
        firsts[cut.size] += rows
        if held:
            key, n = merged()
            yield table(0, key.view(np.int64), n)
        seen = np.flatnonzero(ids)
        yield table(1, seen.astype(np.int64), ids[seen])
        seen = np.flatnonzero(firsts)
        yield table(2, seen.astype(np.int64), firsts[seen])
        yield table(0, np.array([END]).view(np.int64), np.array([rows], np.int64))

    return run


def _beside(shared, context: np.ndarray):
    """How often an id stands after (``col`` below CONTEXTS) or before one of the ids ``context``; summed over each partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = _subwords(shared)
        col = np.full(cut.size + 1, -1)
        col[context] = np.arange(len(context))
        keys, times = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def rows():
            return pa.RecordBatch.from_arrays([pa.array(keys // (2 * CONTEXTS)), pa.array((keys % (2 * CONTEXTS)).astype(np.int32)), pa.array(times)], ["id", "col", "n"])

        for batch in batches:
            for _, _, data, starts in chunks(batch.column("text"), CHUNK):
                _, lo, hi, number, at = _parsed(data, starts, cut)
                ends = np.concatenate(([0], np.cumsum((hi - lo)[number])))
                flat = np.insert(cut.ids[_spread(lo[number], hi[number])].astype(np.int64), ends[at[1:]], cut.size)
                last, this = flat[:-1], flat[1:]
                near = last != cut.size  # the end of a text is beside nothing of the next
                after, ahead = near & (col[last] >= 0), near & (col[this] >= 0)
                found = np.concatenate((this[after] * 2 * CONTEXTS + col[last[after]], last[ahead] * 2 * CONTEXTS + CONTEXTS + col[this[ahead]]))
                distinct, n = np.unique(found, return_counts=True)
                keys, number = np.unique(np.concatenate((keys, distinct)), return_inverse=True)
                times = np.bincount(number, weights=np.concatenate((times, n)), minlength=len(keys)).astype(np.int64)
                if len(keys) > 2_000_000:
                    yield rows()
                    keys, times = keys[:0], times[:0]
        yield rows()

    return run


def _vectors(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Ids and what stands beside each as the root of its shares."""
    lists = batch.column("beside")
    row = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
    pairs = lists.flatten()
    out = np.zeros((len(lists), 2 * CONTEXTS), np.float32)
    out[row, pairs.field("col").to_numpy()] = pairs.field("n").to_numpy()
    return batch.column("id").to_numpy(), np.sqrt(out / out.sum(1, keepdims=True))


def _nearest_class(beside: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return ((centre**2).sum(1) - 2 * beside @ centre.T).argmin(1)


def classes_of(beside: DataFrame, count: np.ndarray, seed: int = 1) -> np.ndarray:
    """A class for each id: k-means over ``beside(id, beside array<col, n>)``; unseen ids (``count`` 0) share the last class.

    The vectors stay in their tasks; sums of each class come back.
    """
    rng = np.random.default_rng(seed)
    seen = np.flatnonzero(count)
    k = min(CLASSES - 1, len(seen))
    weight = count.astype(np.float64) ** 0.5
    drawn = rng.choice(seen, k, replace=False, p=weight[seen] / weight[seen].sum())
    centre = np.zeros((k, 2 * CONTEXTS), np.float32)
    for r in beside.where(F.col("id").isin(drawn.tolist())).collect():
        for pair in r.beside:
            centre[drawn == r.id, pair.col] = pair.n
    centre = np.sqrt(centre / np.maximum(centre.sum(1, keepdims=True), 1))
    for _ in range(ROUNDS):

        def sums(batches: Iterator[pa.RecordBatch], centre=centre) -> Iterator[pa.RecordBatch]:
            total = np.zeros((k, 2 * CONTEXTS + 1))
            for batch in batches:
                ids, vectors = _vectors(batch)
                label = _nearest_class(vectors, centre)
                for c in range(k):
                    mine = label == c
                    total[c, :-1] += weight[ids[mine]] @ vectors[mine]
                    total[c, -1] += weight[ids[mine]].sum()
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(k)), pa.array(list(total))], ["c", "total"])

        total = np.zeros((k, 2 * CONTEXTS + 1))
        for r in beside.mapInArrow(sums, "c long, total array<double>").collect():
            total[r.c] += r.total
        moved = total[:, -1] > 0
        centre[moved] = total[moved, :-1] / total[moved, -1:]

    def labels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, vectors = _vectors(batch)
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(_nearest_class(vectors, centre).astype(np.int32))], ["id", "c"])

    out = np.full(len(count), CLASSES - 1, np.int32)
    out[seen] = (centre**2).sum(1).argmin()  # beside no context
    found = beside.mapInArrow(labels, "id long, c int").toPandas()  # at most one row for each id of the tokenizer
    out[found.id] = found.c
    return out


def _blocks(sequences: list[np.ndarray], end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Inputs of all windows as one padded stream, and each half window's place, targets and whether it is its text's first.

    A text's stream is half a window of padding, the end token, and its ids up to the next whole half window.
    """
    n = np.array([len(s) + 1 for s in sequences])
    halves = -(-n // HALF)
    length = HALF * (halves + 1)
    base = np.concatenate(([0], np.cumsum(length)))
    inputs = np.full(base[-1], end, np.int32)
    targets = np.full(base[-1], -1, np.int32)
    flat = np.concatenate(sequences) if len(sequences) else np.zeros(0, np.int32)
    at = _spread(base[:-1] + HALF, base[:-1] + HALF + n - 1)
    inputs[at + 1], targets[at] = flat, flat
    targets[base[:-1] + HALF + n - 1] = end
    first = np.concatenate(([0], np.cumsum(halves)))
    place = np.repeat(base[:-1] - HALF * first[:-1], halves) + HALF * np.arange(first[-1])
    opening = np.zeros(len(place), bool)
    opening[first[:-1]] = True
    return inputs, place, targets, opening


class Network:
    """One layer: embeddings, causal attention with learned relative biases, a hidden layer, class logits."""

    def __init__(self, size: int, seed: int = 2):
        rng = np.random.default_rng(seed)
        draw = lambda *shape: (rng.normal(size=shape) / np.sqrt(shape[0])).astype(np.float32)
        self.p = {"e": (rng.normal(size=(size, DIM)) * 0.3).astype(np.float32), "q": draw(DIM, DIM), "k": draw(DIM, DIM), "v": draw(DIM, DIM), "o": draw(DIM, DIM), "r": np.zeros(WINDOW, np.float32), "a": draw(DIM, HIDDEN), "b": draw(HIDDEN, DIM), "c": draw(DIM, CLASSES), "d": np.zeros(CLASSES, np.float32)}
        j, i = np.arange(WINDOW)[None, :], HALF + np.arange(HALF)[:, None]
        self.distance = np.clip(i - j, 0, WINDOW - 1)
        self.mask = np.where(j > i, np.float32(-1e4), np.float32(0))

    def forward(self, x: np.ndarray, opening: np.ndarray, keep: bool = False):
        """Class logits of the second halves of windows ``x`` (windows, WINDOW, DIM)."""
        p = self.p
        query, key, value = x[:, HALF:] @ (p["q"] / np.float32(DIM**0.5)), x @ p["k"], x @ p["v"]
        s = np.matmul(query, key.transpose(0, 2, 1))
        s += p["r"][self.distance] + self.mask
        s[opening, :, :HALF] = -1e4
        np.minimum(s, MOST_SCORE, out=s)
        w = np.exp(s, out=s)
        w /= w.sum(2, keepdims=True)
        mixed = np.matmul(w, value)
        h = x[:, HALF:] + mixed @ p["o"]
        up = np.maximum(h @ p["a"], 0)
        top = h + up @ p["b"]
        logits = top @ p["c"] + p["d"]
        return (logits, (x, query, key, value, w, mixed, h, up, top)) if keep else logits

    def gradients(self, logits, kept, opening, classes, valid):
        p, (x, query, key, value, w, mixed, h, up, top) = self.p, kept
        prob = np.exp(logits - logits.max(-1, keepdims=True))
        prob /= prob.sum(-1, keepdims=True)
        loss = -np.log(prob[np.arange(len(classes))[:, None], np.arange(HALF), classes] + 1e-9)[valid].mean()
        prob[np.arange(len(classes))[:, None], np.arange(HALF), classes] -= 1
        prob *= valid[..., None] / np.float32(valid.sum())
        flat = lambda z: z.reshape(-1, z.shape[-1])
        g = {"c": flat(top).T @ flat(prob), "d": flat(prob).sum(0)}
        d_top = prob @ p["c"].T
        g["b"] = flat(up).T @ flat(d_top)
        d_up = (d_top @ p["b"].T) * (up > 0)
        g["a"] = flat(h).T @ flat(d_up)
        d_h = d_top + d_up @ p["a"].T
        g["o"] = flat(mixed).T @ flat(d_h)
        d_mixed = d_h @ p["o"].T
        d_w, d_value = np.matmul(d_mixed, value.transpose(0, 2, 1)), np.matmul(w.transpose(0, 2, 1), d_mixed)
        d_s = w * (d_w - (d_w * w).sum(2, keepdims=True))
        g["r"] = np.bincount(self.distance.ravel(), weights=d_s.sum(0).ravel(), minlength=WINDOW).astype(np.float32)
        d_query, d_key = np.matmul(d_s, key), np.matmul(d_s.transpose(0, 2, 1), query)
        scale = np.float32(DIM**0.5)
        g["q"] = flat(x[:, HALF:]).T @ flat(d_query) / scale
        g["k"], g["v"] = flat(x).T @ flat(d_key), flat(x).T @ flat(d_value)
        d_x = d_key @ p["k"].T + d_value @ p["v"].T
        d_x[:, HALF:] += d_h + d_query @ p["q"].T / scale
        return loss, g, d_x

    def train(self, sequences: list[np.ndarray], classes: np.ndarray, end: int, seed: int = 4, epochs: int = EPOCHS, most: float = RATE) -> float:
        """Adam over shuffled windows; the loss of the last hundred steps."""
        rng = np.random.default_rng(seed)
        inputs, place, targets, opening = _blocks(sequences, end)
        moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.p.items()}
        losses, steps, step = [], epochs * -(-len(place) // BATCH), 0
        for _ in range(epochs):
            order = rng.permutation(len(place))
            for at in range(0, len(order), BATCH):
                here = order[at : at + BATCH]
                ids = inputs[place[here][:, None] + np.arange(WINDOW)]
                wanted = targets[place[here][:, None] + HALF + np.arange(HALF)]
                valid = wanted >= 0
                logits, kept = self.forward(self.p["e"][ids], opening[here], keep=True)
                loss, g, d_x = self.gradients(logits, kept, opening[here], classes[np.maximum(wanted, 0)], valid)
                losses.append(loss)
                step += 1
                rate = most * min(1, step / 50) * (1 - step / (steps + 1))
                for k, grad in g.items():
                    m, v = moments[k]
                    m += 0.1 * (grad - m)
                    v += 0.01 * (grad * grad - v)
                    self.p[k] -= np.float32(rate) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
                # Embeddings move by their own running scale, only where they were used.
                used, number = np.unique(ids, return_inverse=True)
                grad = np.zeros((len(used), DIM), np.float32)
                np.add.at(grad, number.ravel(), d_x.reshape(-1, DIM))
                v = moments["e"][1]
                v[used] += grad * grad
                self.p["e"][used] -= np.float32(10 * rate) * grad / (np.sqrt(v[used]) + 1e-6)
        return float(np.mean(losses[-100:])) if losses else 0.0

    def tables(self) -> dict[str, np.ndarray]:
        """What an id contributes to attention, for scoring: no position enters but the relative biases."""
        if "t" in self.__dict__:
            return self.t
        p = self.p
        t = {"q": p["e"] @ (p["q"] / np.float32(DIM**0.5)), "k": p["e"] @ p["k"], "v": p["e"] @ (p["v"] @ p["o"])}
        # Training cuts attention scores at MOST_SCORE; here that is needed only where they can get so large.
        self.cut_scores = np.sqrt((t["q"] ** 2).sum(1).max() * (t["k"] ** 2).sum(1).max()) + np.abs(p["r"]).max() > MOST_SCORE
        self.t = t
        return t

    def log_probability(self, inputs, place, targets, opening, classes, share) -> np.ndarray:
        """Natural log probability of each target of the padded stream (0 where there is none)."""
        p, t = self.p, self.tables()
        out = np.zeros(len(targets), np.float32)
        bias = p["r"][self.distance] + self.mask
        for at in range(0, len(place), BLOCKS):
            spot = place[at : at + BLOCKS, None] + np.arange(WINDOW)
            ids, wanted = inputs[spot], targets[spot[:, HALF:]]
            here = ids[:, HALF:]
            w = np.matmul(t["q"][here], t["k"][ids].transpose(0, 2, 1))
            w += bias
            if self.cut_scores:
                np.minimum(w, MOST_SCORE, out=w)
            w[opening[at : at + BLOCKS], :, :HALF] = -1e4
            np.exp(w, out=w)
            mixed = np.matmul(w, t["v"][ids])
            mixed /= w.sum(2, keepdims=True)
            h = (p["e"][here] + mixed).reshape(-1, DIM)
            up = h @ p["a"]
            np.maximum(up, 0, out=up)
            h += up @ p["b"]
            logits = h @ p["c"]
            logits += p["d"]
            wanted = wanted.ravel()
            ok = wanted >= 0
            wanted = np.maximum(wanted, 0)
            np.minimum(logits, 60, out=logits)
            picked = logits[np.arange(len(wanted)), classes[wanted]]
            total = np.log(np.exp(logits, out=logits) @ np.ones(CLASSES, np.float32))
            out[spot[:, HALF:].ravel()] = np.where(ok, picked - total + share[wanted], 0)
        return out


def _whole_words(logs: np.ndarray, first: np.ndarray, counts: np.ndarray, classes, share, by_class) -> np.ndarray:
    """Probability of each word as a whole, from its first id's log probability."""
    with np.errstate(over="ignore"):
        return np.exp(logs - share[first]) * counts / np.maximum(by_class[classes[first]], 1)


def _scores(shared, model):
    """Per text: tokens, the frequent words' part of the base, the model's score, and its other words with counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = _subwords(shared)
        network, classes, share, by_class, mixing, top_hash, top_count, end_count = model.value
        for batch in batches:
            for row, end, data, starts in chunks(batch.column("text"), CHUNK):
                distinct, lo, hi, number, at = _parsed(data, starts, cut)
                spot = np.minimum(np.searchsorted(top_hash, distinct), max(len(top_hash) - 1, 0))
                frequent = top_hash[spot] == distinct if len(top_hash) else np.zeros(len(distinct), bool)
                count = np.where(frequent, top_count[spot], 0) if len(top_hash) else np.zeros(len(distinct))
                sequences, n = [], hi - lo
                for i in range(end - row):
                    mine = number[at[i] : at[i + 1]]
                    sequences.append(cut.ids[_spread(lo[mine], hi[mine])])
                inputs, place, targets, opening = _blocks(sequences, cut.size)
                logs = network.log_probability(inputs, place, targets, opening, classes, share)[targets >= 0].astype(np.float64)
                # Targets run text by text: the ids of its words, then the end.
                lengths = np.insert(n[number], at[1:], 1)
                ends = np.cumsum(lengths)
                sums = np.concatenate(([0.0], np.cumsum(logs)))
                counts = np.insert(count[number].astype(np.float64), at[1:], end_count)
                own = _whole_words(logs[ends - lengths], np.insert(cut.ids[lo][number], at[1:], cut.size), counts, classes, share, by_class)
                logs = sums[ends] - sums[ends - lengths]
                score = np.logaddexp(np.log(1 - mixing) + logs, np.log(np.maximum(mixing * own, 1e-300))) / np.log(10)
                per_text = np.concatenate(([0], np.cumsum(np.diff(at) + 1)))
                run_score = np.concatenate(([0.0], np.cumsum(score)))
                run_base = np.concatenate(([0.0], np.cumsum(np.log10(counts + 1))))
                run_known = np.concatenate(([0], np.cumsum(counts > 0)))
                rare = ~frequent[number]
                text = np.repeat(np.arange(end - row), np.diff(at))[rare]
                order = np.lexsort((number[rare], text))
                text, word = text[order], number[rare][order]
                new = np.ones(len(text), bool)
                new[1:] = (text[1:] != text[:-1]) | (word[1:] != word[:-1])
                begin = np.flatnonzero(new)
                times = np.diff(np.concatenate((begin, [len(text)])))
                edge = np.searchsorted(text[begin], np.arange(end - row + 1)).astype(np.int32)
                kept = [batch.column(c).slice(row, end - row) for c in ("row", "doc_id")]
                part = lambda x: pa.array(x[per_text[1:]] - x[per_text[:-1]])
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.array(np.diff(per_text)), part(run_known), part(run_base), part(run_score), pa.ListArray.from_arrays(pa.array(edge), pa.array(distinct[word[begin]].view(np.int64))), pa.ListArray.from_arrays(pa.array(edge), pa.array(times.astype(np.int32)))],
                    ["row", "doc_id", "n_tokens", "known", "logs", "score", "rare", "times"],
                )

    return run


def _odds(network, classes, share, by_class, sequences, frequencies) -> np.ndarray:
    """How many words have which odds (log, in BINS) of the whole-word reading against the product over ids."""
    inputs, place, targets, opening = _blocks(sequences, len(classes) - 1)
    logs = network.log_probability(inputs, place, targets, opening, classes, share)[targets >= 0].astype(np.float64)
    lengths, counts, first = frequencies
    ends = np.cumsum(lengths)
    sums = np.concatenate(([0.0], np.cumsum(logs)))
    own = _whole_words(logs[ends - lengths], first, counts, classes, share, by_class)
    odds = np.log(np.maximum(own, 1e-300)) - (sums[ends] - sums[ends - lengths])
    return np.bincount(np.clip(np.floor(odds * 64) + BINS // 2, 0, BINS - 1).astype(np.int64), minlength=BINS)


def _mixing(odds: np.ndarray) -> float:
    """The mixing weight that serves the words of ``_odds`` best, by expectation maximization."""
    against = np.exp(-(np.arange(BINS) - BINS // 2 + 0.5) / 64)
    weight = 0.5
    for _ in range(20):
        weight = float(np.clip((odds / (1 + (1 - weight) / weight * against)).sum() / max(odds.sum(), 1), 0.01, 0.99))
    return weight


def _frequencies(cut: Subwords, parsed, top_hash, top_count, end_count):
    """Each text's ids; of all words and ends: how many ids, how frequent (0 but for the most frequent), the first id."""
    distinct, lo, hi, number, at = parsed
    spot = np.minimum(np.searchsorted(top_hash, distinct), max(len(top_hash) - 1, 0))
    count = np.where(top_hash[spot] == distinct, top_count[spot], 0) if len(top_hash) else np.zeros(len(distinct))
    words_of = [number[at[i] : at[i + 1]] for i in range(len(at) - 1)]
    lengths = np.insert((hi - lo)[number], at[1:], 1)
    counts = np.insert(count[number].astype(np.float64), at[1:], end_count)
    return [cut.ids[_spread(lo[mine], hi[mine])] for mine in words_of], (lengths, counts, np.insert(cut.ids[lo][number], at[1:], cut.size))


def _packed(p: dict[str, np.ndarray]) -> np.ndarray:
    """All but the embeddings as rows of DIM numbers."""
    flat = np.concatenate([p[k].ravel() for k in p if k != "e"]).astype(np.float64)
    return np.append(flat, np.zeros(-len(flat) % DIM)).reshape(-1, DIM)


#: What ``_taught`` gives: embeddings by id, then the rows of ``_packed``, times ``n`` of each; below 0 the bins of ``_odds``.
TAUGHT = "key long, n double, " + ", ".join(f"v{i} double" for i in range(DIM))


def _taught(shared, model):
    """A partition's own network, gone on from the model's over the partition's texts, and the odds of its words beforehand."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = _subwords(shared)
        start, classes, share, by_class, top_hash, top_count, end_count = model.value
        network = Network(cut.size + 1)
        network.p = {k: v.copy() for k, v in start.p.items()}
        uses, windows, odds = np.zeros(cut.size + 1), 0, np.zeros(BINS)
        for batch in batches:
            for _, _, data, starts in chunks(batch.column("text"), CHUNK):
                sequences, frequencies = _frequencies(cut, _parsed(data, starts, cut), top_hash, top_count, end_count)
                odds += _odds(network, classes, share, by_class, sequences, frequencies)
                network.train(sequences, classes, cut.size, epochs=1, most=RATE / 2)
                network.__dict__.pop("t", None)
                for s in sequences:
                    windows += -(-(len(s) + 1) // HALF)
                uses += np.bincount(np.concatenate(sequences), minlength=len(uses))
                uses[cut.size] += len(sequences)
        if windows == 0:
            return
        used, dense, bins = np.flatnonzero(uses), _packed(network.p), np.flatnonzero(odds)
        key = np.concatenate((used, cut.size + 1 + np.arange(len(dense)), -1 - bins))
        n = np.concatenate((uses[used], np.full(len(dense), float(windows)), odds[bins]))
        v = np.concatenate((network.p["e"][used], dense, np.zeros((len(bins), DIM)))) * n[:, None]
        yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n), *(pa.array(v[:, i]) for i in range(DIM))], ["key", "n", *(f"v{i}" for i in range(DIM))])

    return run


def taught(network: Network, rows) -> np.ndarray:
    """Put the mean of all that ``_taught`` gave into the network; the odds come back."""
    size = len(network.p["e"])
    odds = np.zeros(BINS)
    key, n = rows.key.to_numpy(np.int64), rows.n.to_numpy(np.float64)
    mean = rows[[f"v{i}" for i in range(DIM)]].to_numpy(np.float64) / n[:, None]
    odds[-1 - key[key < 0]] = n[key < 0]
    ids = (key >= 0) & (key < size)
    network.p["e"][key[ids]] = mean[ids]
    dense = np.zeros_like(_packed(network.p))
    dense[key[key >= size] - size] = mean[key >= size]
    dense, at = dense.ravel(), 0
    for k, old in network.p.items():
        if k != "e":
            network.p[k] = dense[at : at + old.size].reshape(old.shape).astype(np.float32)
            at += old.size
    return odds


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(7)) == 2


def lm_scores(documents: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """``documents(doc_id, text)`` -> ``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)``."""
    spark = documents.sparkSession
    shared = spark.sparkContext.broadcast((ranks, pattern))
    docs = small_batches(documents).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    training = docs.where(~held_out(F.col("doc_id")))
    counted = save(training.select("text").mapInArrow(_counts(shared), "kind int, key long, n long").groupBy("kind", "key").agg(F.sum("n").alias("n")).where("n > 0"), "counts")
    vocabulary = counted.where("kind = 0").select("key", "n")
    total, distinct = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    # The least count that leaves at most FREQUENT words: from the number of words for each count (few rows).
    bands = vocabulary.groupBy(F.least("n", F.lit(100_000)).alias("n")).count().toPandas().sort_values("n", ascending=False)
    fitting = bands[bands["count"].cumsum() <= FREQUENT]
    least = int(fitting["n"].min()) if len(fitting) else 1 << 62
    top = vocabulary.where(F.col("n") >= least).toPandas()
    order = np.argsort(top.key.to_numpy(np.int64).view(np.uint64))
    top_hash, top_count = top.key.to_numpy(np.int64).view(np.uint64)[order], top.n.to_numpy(np.int64)[order]

    cut = Subwords(ranks, pattern)
    first = training.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("draw"), F.coalesce(F.octet_length("text"), F.lit(0)).alias("size"))
    # Texts that don't fit the rest of the bound are passed over; the first is taken whatever its length.
    chosen, left = [], SAMPLE_BYTES
    for r in first.select("draw", "size").orderBy("draw").limit(SAMPLE).collect():
        if r["size"] <= left or not chosen:
            chosen, left = [*chosen, r.draw], max(left - r["size"], 0)
    wanted = F.broadcast(spark.createDataFrame([(d,) for d in chosen], "draw long").distinct())
    texts = [r.text or "" for r in first.join(wanted, "draw", "left_semi").orderBy("draw").limit(SAMPLE).select("text").collect()]
    end_count = int(top_count[np.searchsorted(top_hash, END)]) if END in top_hash else int(vocabulary.where(F.col("key") == int(np.array([END]).view(np.int64)[0])).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    ids, firsts = (counted.where(F.col("kind") == k).toPandas() for k in (1, 2))  # at most one row for each id of the tokenizer
    seen = np.zeros(cut.size + 1, np.int64)
    seen[ids.key] = ids.n
    network, weight, classes = Network(cut.size + 1), 0.5, (np.arange(cut.size + 1) % CLASSES).astype(np.int32)
    if seen.any():
        context = np.argsort(-seen, kind="stable")[:CONTEXTS]
        pairs = training.select("text").mapInArrow(_beside(shared, context[seen[context] > 0]), "id long, col int, n long").groupBy("id", "col").agg(F.sum("n").alias("n"))
        classes = classes_of(save(pairs.groupBy("id").agg(F.collect_list(F.struct("col", "n")).alias("beside")), "beside"), seen)
    id_count = seen + 0.1
    share = (np.log(id_count) - np.log(np.bincount(classes, weights=id_count, minlength=CLASSES))[classes]).astype(np.float32)
    by_class = np.bincount(classes[firsts.key.to_numpy(np.int64)], weights=firsts.n, minlength=CLASSES)
    if seen.any():
        sequences = []
        for _, _, data, starts in chunks(pa.array(texts, pa.string()), CHUNK):
            sequences += _frequencies(cut, _parsed(data, starts, cut), top_hash, top_count, end_count)[0]
        network.train(sequences, classes, cut.size)
        begun = spark.sparkContext.broadcast((network, classes, share, by_class, top_hash, top_count, end_count))
        each = training.select("text").mapInArrow(_taught(shared, begun), TAUGHT)
        weight = _mixing(taught(network, each.groupBy("key").agg(*[F.sum(c).alias(c) for c in each.columns[1:]]).toPandas()))
    network.__dict__.pop("t", None)  # each worker makes its own
    model = spark.sparkContext.broadcast((network, classes, share, by_class, weight, top_hash, top_count, end_count))

    schema = "row long, doc_id long, n_tokens long, known long, logs double, score double, rare array<long>, times array<int>"
    scored = save(docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text").mapInArrow(_scores(shared, model), schema), "scored")
    rare = scored.select("row", F.explode(F.arrays_zip("rare", "times")).alias("z")).select("row", F.col("z.rare").alias("key"), F.col("z.times").alias("times"))
    tail = rare.join(vocabulary.where(F.col("n") < least), "key").groupBy("row").agg(F.sum("times").alias("more"), F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("more_logs"))
    known = F.col("known") + F.coalesce("more", F.lit(0))
    base = F.col("logs") + F.coalesce("more_logs", F.lit(0.0)) - F.col("n_tokens") * F.log10(F.lit(float(total) + distinct + 1))
    return scored.join(tail, "row", "left").select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", known.cast("long").alias("n_known"), F.lit(int(total)).cast("long").alias("train_tokens"), base.alias("base_score"), "score")
