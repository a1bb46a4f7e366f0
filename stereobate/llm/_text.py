"""Words and rolling hashes of text columns, computed with numpy over whole Arrow buffers.

Words are runs of bytes outside space, tab, line feed, vertical tab, form feed and carriage return.
Only A-Z is lower-cased. A null text is an empty text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = np.uint64(0x9E3779B97F4A7C55)
_BASE_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))
_POWERS: dict[str, np.ndarray] = {}
CHUNK_BYTES = 1 << 20


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least ``n`` of each."""
    if len(_POWERS.get("up", ())) < n:
        size = max(n, CHUNK_BYTES + 1)
        for name, base in (("up", _BASE), ("down", _BASE_INV)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"], _POWERS["down"]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every input bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one after another, and where each starts (one more entry than texts)."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[starts[0] : starts[-1]], starts - starts[0]


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, starts) for runs of rows of about ``limit`` bytes; a longer text comes alone."""
    data, starts = flat(column)
    row, n = 0, len(starts) - 1
    while row < n:
        end = max(row + 1, int(np.searchsorted(starts, starts[row] + limit, "right")) - 1)
        yield row, end, data[starts[row] : starts[end]], starts[row : end + 1] - starts[row]
        row = end


def words(data: np.ndarray, starts: np.ndarray, gap: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word in ``data``, and the first word of each text (one more entry than texts).

    ``gap`` says of each byte whether it stands between words.
    """
    solid = ~gap[data]
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1]
    last[:-1] &= ~solid[1:]
    inner = starts[(starts > 0) & (starts < len(data))]
    first[inner] |= solid[inner]
    last[inner - 1] |= solid[inner - 1]
    begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return begin, end, np.searchsorted(begin, starts)


def prefix_hash(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Running polynomial hash; the hash of ``data[i:j]`` is ``(run[j] - run[i]) * down[i]``."""
    up, down = _powers(len(data) + 1)
    run = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=run[1:])
    return run, down


def word_hashes(data: np.ndarray, starts: np.ndarray, lower: bool = True, gap: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word and the first word of each text."""
    begin, end, at = words(data, starts, gap)
    run, down = prefix_hash(LOWER[data] if lower else data)
    return mix((run[end] - run[begin]) * down[begin]), at


def ranges(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """``first[i], first[i] + 1, ...``, ``count[i]`` of each, one after another."""
    done = np.cumsum(count)
    return np.arange(done[-1] if len(done) else 0) + np.repeat(first - done + count, count)


def grams(hashes: np.ndarray, at: np.ndarray, k: int, whole_if_short: bool) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every ``k`` consecutive words of each text, and where each text's begin.

    With ``whole_if_short`` a text of 1 to k-1 words gives one hash of its whole sequence.
    """
    n = np.diff(at)
    counts = np.maximum(n - k + 1, 0)
    first = np.concatenate(([0], np.cumsum(counts)))
    text = np.repeat(np.arange(len(n)), counts)
    pos = at[:-1][text] + np.arange(first[-1]) - first[:-1][text]
    out = np.zeros(len(pos), np.uint64)
    for j in range(k):
        out = out * np.uint64(0xD6E8FEB86659FD93) + hashes[pos + j]
    out = mix(out)
    if whole_if_short and ((n > 0) & (n < k)).any():
        short = np.flatnonzero((n > 0) & (n < k))
        extra = np.zeros(len(short), np.uint64)
        for j in range(k - 1):
            held = n[short] > j
            extra[held] = extra[held] * np.uint64(0xD6E8FEB86659FD93) + hashes[at[short[held]] + j]
        extra = mix(extra ^ (n[short].astype(np.uint64) << np.uint64(56)))
        out = np.insert(out, first[short], extra)
        counts[short] = 1
        first = np.concatenate(([0], np.cumsum(counts)))
    return out, first
