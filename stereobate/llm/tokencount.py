"""Token counts of a byte-pair tokenizer by a compiled finite-state transducer.

The transducer reads characters. After every character its running count is the number of tokens of the text so far,
and each transition carries the number by which that count changes. It rests on a property of byte-pair merging with
distinct priorities: a sequence of tokens is the tokenization of its text exactly if each two neighbours are the
tokenization of theirs. A state therefore holds, for each earlier position from which a token may still grow, the
place in the vocabulary's trie, the token that ends there and its count less the present one. States and transitions
are compiled when a text first needs them, and kept for the worker's life.

A batch of texts runs as many chunks at once. Two characters that no vocabulary entry holds side by side are a cut:
what follows does not depend on what came before. A chunk's state map is thus constant after its first cut, and all
chunks run from their cuts in parallel; then all heads before the cuts run from the states in which the previous
chunks ended. Chunks without a cut pass the map on, so that heads behind them take a further round. The counts of a
text's chunks are added by a prefix sum.

Spaces, the lowest and tied merges of this vocabulary, join from the left; what each adds to the count follows from
merging runs of each length up to the longest entry (16; a run of 15 takes two tokens, as no entry has that length). Null and empty texts
have no tokens. Repeated rows are counted each for itself; an empty table gives an empty result. Other columns are left
alone. A text of over ``BATCH_BYTES`` is read in parts, the compiled table holds at most ``MOST_CELLS`` cells.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stereobate.llm._io import small_batches
from stereobate.llm._text import chunks

SPACE = "▁"
CHUNK = 384
BATCH_BYTES = 1 << 20
#: Cells of the compiled table; a step that needs more drops all rows but those in use and compiles anew what it needs.
MOST_CELLS = 20_000_000
#: States that a worker keeps from one call to the next.
MOST_STATES = 300_000
#: Chunks that run side by side.
LANES = 4096
NONE = -1
#: States are told apart exactly by up to this many continuations of a trie node.
FEW = 16


def vocabulary(model_path: str) -> dict[str, float]:
    """Pieces of a sentencepiece model that match text, and their scores."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
    return {sp.id_to_piece(i): sp.get_score(i) for i in range(sp.vocab_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))}


class Transducer:
    """The compiled part of the transducer for one vocabulary."""

    def __init__(self, scores: dict[str, float]):
        self.scores = scores
        self.longest_run = max((len(p) for p in scores if set(p) == {SPACE}), default=1)
        self.pieces = list(scores)
        self.number = {p: i for i, p in enumerate(self.pieces)}
        self.children: list[dict[str, int]] = [{}]
        self.piece_at = [NONE]
        joined: dict[str, set[str]] = {}
        for piece, i in self.number.items():
            if set(piece) == {SPACE} and len(piece) > 1:
                continue
            for x, y in zip(piece, piece[1:]):
                joined.setdefault(x, set()).add(y)
            node = 0
            for c in piece:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.piece_at.append(NONE)
                node = self.children[node][c]
            self.piece_at[node] = i
        self.joined = joined
        # Classes of characters: 1 to 4, outside the vocabulary, by UTF-8 length; 5, entries that join nothing; then one each.
        self.chars = ["", "", "", "", "", ""] + sorted({SPACE, *joined, *(y for ys in joined.values() for y in ys)})
        code = np.arange(0x110000)
        self.char_class = (1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF)).astype(np.int32)
        for p in self.pieces:
            if len(p) == 1:
                self.char_class[ord(p)] = 5
        for i, c in enumerate(self.chars[6:], 6):
            self.char_class[ord(c)] = i
        self.char_class[0x20] = self.char_class[ord(SPACE)]
        self.column = np.full(len(self.chars), NONE, np.int32)
        self.column_class: list[int] = []
        self.fits: dict[tuple[int, int], bool] = {}
        self.histories: dict[int, tuple] = {}
        # What each space of a run, up to the longest that is one token, adds to the count; further ones begin anew.
        tokens = [0] + [len(self.merged(SPACE * n)[0]) for n in range(1, self.longest_run + 1)]
        self.run_step = [0, *np.diff(tokens).tolist()]
        self.continued: dict[int, list[int] | None] = {}
        self.stands: dict[tuple[int, int], int | None] = {}
        self.alike: dict[tuple, int] = {}
        self.clear()

    def clear(self) -> None:
        self.width = -(-max(64, len(self.column_class)) // 32) * 32
        self.states: list[tuple] = []
        self.state_number: dict[tuple, int] = {}
        self.most_rows = max(MOST_CELLS // self.width, 256)
        # A cell holds where the next state's row begins and, in its last five bits, the emitted count plus 16.
        self.table = np.full((min(1024, self.most_rows), self.width), NONE, np.int32)
        self.drop_rows()
        self.start = self.state((0, ((0, NONE, 0),)))
        self.first = self.run_state(1)

    def state(self, key: tuple) -> int:
        """Number of the state: (spaces at its end, ((trie node, token before it, count less the present one), ...))."""
        if key not in self.state_number:
            self.state_number[key] = len(self.states)
            self.states.append(key)
        return self.state_number[key]

    def drop_rows(self) -> None:
        """Forget the compiled transitions; states keep their numbers."""
        self.row_state: list[int] = []
        self.state_row: dict[int, int] = {}
        self.table[:] = NONE

    def row(self, state: int) -> int:
        """The table's row of a state, a new one if it has none."""
        if state not in self.state_row:
            if len(self.row_state) == len(self.table):
                more = min(len(self.table), self.most_rows - len(self.table))
                self.table = np.concatenate((self.table, np.full((more, self.width), NONE, np.int32)))
            self.state_row[state] = len(self.row_state)
            self.row_state.append(state)
        return self.state_row[state]

    def rows(self, states: np.ndarray) -> np.ndarray:
        """Where the rows of states begin in the flat table."""
        found, at = np.unique(states, return_inverse=True)
        return np.array([self.row(int(x)) for x in found], np.int64)[at] * self.width

    def run_state(self, spaces: int) -> int:
        spaces = (spaces - 1) % self.longest_run + 1
        return self.state((spaces, ((0, self.number[SPACE], 0), (self.children[0][SPACE], NONE, -self.run_step[spaces]))))

    def merged(self, text: str) -> tuple[list[str], list]:
        """The symbols that merging leaves of a text, and (score, first symbol, last symbol) after each merge."""
        parts = list(text)
        steps = [(np.inf, parts[0], parts[-1])]
        while True:
            best, at = None, 0
            for i in range(len(parts) - 1):
                score = self.scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                return parts, steps
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            steps.append((best, parts[0], parts[-1]))

    def history(self, piece: int) -> tuple[bool, list]:
        """How merging builds a piece: whether it does, and its steps."""
        if piece not in self.histories:
            parts, steps = self.merged(self.pieces[piece])
            self.histories[piece] = (len(parts) == 1, steps)
        return self.histories[piece]

    def fit(self, left: int, right: int) -> bool:
        """Whether the two tokens stay apart when their joined text is merged; NONE on the left always does.

        Both sides' merges take place in the order of their scores; the tokens fit unless a merge across their
        border is the best one at some time. Of equal merges the leftmost comes first.
        """
        whole, right_steps = self.history(right)
        if left == NONE or not whole:
            return whole
        pair = (left, right)
        if pair not in self.fits:
            left_steps = self.history(left)[1]
            i = j = 0
            while True:
                across = self.scores.get(left_steps[i][2] + right_steps[j][1])
                x = left_steps[i + 1][0] if i + 1 < len(left_steps) else -np.inf
                y = right_steps[j + 1][0] if j + 1 < len(right_steps) else -np.inf
                if across is not None and across > x and across >= y:
                    self.fits[pair] = False
                    break
                if x == y == -np.inf:
                    self.fits[pair] = True
                    break
                if x >= y:
                    i += 1
                else:
                    j += 1
        return self.fits[pair]

    def below(self, node: int) -> list[int] | None:
        """Pieces that continue a trie node, or None if there are many."""
        if node not in self.continued:
            found, todo = [], list(self.children[node].values())
            while todo and len(found) <= FEW:
                at = todo.pop()
                if self.piece_at[at] != NONE:
                    found.append(self.piece_at[at])
                todo += self.children[at].values()
            self.continued[node] = None if len(found) > FEW else found
        return self.continued[node]

    def growing(self, node: int, before: int) -> int | None:
        """A token that stands for ``before`` wherever only growth from ``node`` counts; None if nothing can grow."""
        if (node, before) not in self.stands:
            pieces = self.below(node)
            if pieces is None:
                self.stands[node, before] = before
            else:
                allowed = tuple(p for p in pieces if self.fit(before, p))
                self.stands[node, before] = self.alike.setdefault((node, allowed), before) if allowed else None
        return self.stands[node, before]

    def compile(self, row: int, column: int) -> None:
        spaces, entries = self.states[self.row_state[row]]
        kind = self.column_class[column]
        if kind < 5:
            to, emitted = self.start, kind
        elif kind == 5:
            to, emitted = self.start, 1
        elif self.chars[kind] == SPACE:
            to = self.run_state(spaces + 1)
            emitted = self.run_step[spaces % self.longest_run + 1]
        else:
            grown, token, count = [], None, None
            for node, before, less in entries:
                child = self.children[node].get(self.chars[kind])
                if child is None:
                    continue
                piece = self.piece_at[child]
                if token is None and piece != NONE and self.fit(before, piece):
                    token, count = piece, less + 1
                if self.children[child] and (before := self.growing(child, before)) is not None:
                    grown.append((child, before, less))
            emitted = count
            to = self.state((0, tuple(sorted([(0, token, 0), *((node, before, less - count) for node, before, less in grown)]))))
        to = self.row(to)
        self.table[row, column] = to * self.width << 5 | emitted + 16

    def columns(self, classes: np.ndarray) -> np.ndarray:
        """Table columns of character classes; new classes get one."""
        seen = np.flatnonzero(np.bincount(classes, minlength=len(self.column)))
        for c in seen[self.column[seen] == NONE]:
            self.column[c] = len(self.column_class)
            self.column_class.append(int(c))
        if len(self.column_class) > self.width:
            self.clear()
        n = len(self.column_class)
        self.beside = np.zeros((n, n), bool)
        for i, x in enumerate(self.column_class):
            for y in self.joined.get(self.chars[x], ()) if x > 5 else ():
                at = self.column[self.char_class[ord(y)]]
                if at != NONE:
                    self.beside[i, at] = True
        space = self.column[self.char_class[0x20]]
        if space != NONE:
            self.beside[space, space] = True
        return self.column[classes]

    def run(self, columns: np.ndarray, begin: np.ndarray, end: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Read ``columns[begin:end]`` of every lane from its state: the end states and the counts."""
        lanes = min(LANES, self.most_rows // 4)
        out = [self.run_lanes(columns, begin[i : i + lanes], end[i : i + lanes], state[i : i + lanes]) for i in range(0, len(begin), lanes)]
        return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64), np.zeros(0, np.int64))

    def run_lanes(self, columns: np.ndarray, begin: np.ndarray, end: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(begin - end, kind="stable")
        length = (end - begin)[order]
        if len(self.row_state) + 2 * len(order) > self.most_rows:
            self.drop_rows()
        at, row, count = begin[order], self.rows(state[order]), np.zeros(len(order), np.int64)
        live = len(length) - np.searchsorted(length[::-1], np.arange(length[0] if len(length) else 0), "right")
        cells = self.table.ravel()
        for step, n in enumerate(live):
            column = columns.take(at[:n] + step)
            to = cells.take(row[:n] + column)
            while to.min() < 0:
                missing = np.unique((row[:n] + column)[to < 0])
                if len(self.row_state) + len(missing) > self.most_rows:  # each needs one more row at most
                    held = np.array(self.row_state)[row // self.width]
                    self.drop_rows()
                    row = self.rows(held)
                    missing = np.unique(row[:n] + column)
                for c in missing:
                    self.compile(int(c) // self.width, int(c) % self.width)
                cells = self.table.ravel()
                to = cells.take(row[:n] + column)
            count[:n] += to & 31
            np.right_shift(to, 5, out=row[:n])
        out_state, out_count = np.empty_like(row), np.empty_like(count)
        out_state[order], out_count[order] = np.array(self.row_state)[row // self.width] if len(row) else row, count - 16 * length
        return out_state, out_count

    def counts(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Tokens of each text; a text that comes alone is read in parts, each from the state in which the one before ended."""
        if len(starts) != 2:
            return self.part(data, starts, None)[0]
        total, lo, key = np.zeros(1, np.int64), 0, None
        while lo < len(data):
            hi = min(lo + BATCH_BYTES, len(data))
            while hi < len(data) and data[hi] & 0xC0 == 0x80:
                hi -= 1
            n, key = self.part(data[lo:hi], np.array([0, hi - lo]), key)
            total, lo = total + n, hi
        return total

    def part(self, data: np.ndarray, starts: np.ndarray, key: tuple | None) -> tuple[np.ndarray, tuple | None]:
        """Tokens of each text and the last one's end state; with ``key`` the first text goes on from that state."""
        if len(self.states) > MOST_STATES:
            self.clear()
        codes = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        lead = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
        begins = lead[starts]
        out = np.zeros(len(starts) - 1, np.int64)
        if not len(codes):
            return out, key
        columns = self.columns(self.char_class[codes])
        cut = np.ones(len(codes) + 1, bool)
        cut[1:-1] = ~self.beside[columns[:-1], columns[1:]]
        length = np.diff(begins)
        parts = -(-length // CHUNK)
        text = np.repeat(np.arange(len(length)), parts)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(parts) - parts, parts)
        lo = begins[:-1][text] + nth * CHUNK
        hi = np.minimum(lo + CHUNK, begins[1:][text])
        cuts = np.flatnonzero(cut)
        body = np.minimum(cuts[np.searchsorted(cuts, lo)], hi)
        opening = nth == 0
        body[opening] = lo[opening]
        state, count = self.run(columns, body, hi, np.where(opening, self.first if key is None else self.state(key), self.start))
        if key is None:
            count += opening  # the space put before each text
        known = opening | (body < hi)  # chunks whose end state is final
        left = np.flatnonzero(~opening & (body > lo))
        while len(left):
            ready = known[left - 1]
            at = left[ready]
            head_state, head_count = self.run(columns, lo[at], body[at], state[at - 1])
            count[at] += head_count
            through = ~known[at]
            state[at[through]] = head_state[through]
            known[at] = True
            left = left[~ready]
        total = np.concatenate(([0], np.cumsum(count)))
        edge = np.concatenate(([0], np.cumsum(parts)))
        return total[edge[1:]] - total[edge[:-1]], self.states[int(state[-1])]


_COMPILED: dict[int, Transducer] = {}


def _count(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = shared.value
        key = hash(frozenset(scores.items()))
        if key not in _COMPILED:
            _COMPILED.clear()
            _COMPILED[key] = Transducer(scores)
        for batch in batches:
            for row, end, data, starts in chunks(batch.column("text"), BATCH_BYTES):
                n = _COMPILED[key].counts(data, starts)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(row, end - row).cast(pa.int64()), pa.array(np.diff(starts)), pa.array(n)], ["doc_id", "n_bytes", "n_tokens"])

    return run


def token_counts(documents: DataFrame, model_path: str, limit: int = 4096) -> DataFrame:
    """``documents(doc_id, text)`` -> ``(doc_id, n_bytes, n_tokens, over_limit)`` of every whole text.

    The vocabulary (some ten thousand entries) is read here and broadcast; executors need no tokenizer file.
    """
    shared = documents.sparkSession.sparkContext.broadcast(vocabulary(model_path))
    docs = small_batches(documents).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = docs.mapInArrow(_count(shared), "doc_id long, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
