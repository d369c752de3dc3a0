"""Vectorised word and shingle hashes of Arrow string columns (helpers inside Spark tasks).

Texts are hashed in pieces of about ``PIECE`` bytes, so that working memory does not follow the
length of a batch. A word's hash is a polynomial over random byte values, taken from prefix sums;
equal words have equal hashes in every task. Hashes have 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 18
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE_VALUES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[65:91] += 32
_LOWER_VALUES = _BYTE_VALUES[LOWERED]
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread each 64-bit value over all bits (a bijection)."""
    h = h ^ (h >> _U(30))
    h = h * _U(0xBF58476D1CE4E5B9)
    h = h ^ (h >> _U(27))
    h = h * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def _power_table(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, PIECE + 1)
        for k, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers


def _hash_words(data: np.ndarray, cuts: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word in ``data``, and each word's start; ``cuts`` are places where a new text begins."""
    if not len(data):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    inside = ~IS_SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    at = cuts[cuts < len(data)]
    first[at] = inside[at]
    starts = np.flatnonzero(first)
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    before = cuts[(cuts > 0) & (cuts <= len(data))] - 1
    last[before] = inside[before]
    ends = np.flatnonzero(last)
    up, down = _power_table(len(data) + 1)
    sums = (_LOWER_VALUES if lower else _BYTE_VALUES)[data]
    sums *= up[:len(data)]
    np.cumsum(sums, out=sums)
    total = sums[ends]
    total[starts > 0] -= sums[starts[starts > 0] - 1]
    return mix(total * down[starts]), starts


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; NULL is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)), offsets


def _piece_ends(data: np.ndarray) -> Iterator[tuple[int, int]]:
    """Pieces of one long text that end at white space (a longer word stays in one piece)."""
    start = 0
    while start < len(data):
        end = start + PIECE
        if end < len(data):
            spaces = np.flatnonzero(IS_SPACE[data[start:end]])
            if len(spaces):
                end = start + int(spaces[-1]) + 1
            else:
                while end < len(data) and not IS_SPACE[data[end]]:
                    end += 1
        end = min(end, len(data))
        yield start, end
        start = end


def word_runs(column: pa.Array, lower: bool = True) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For runs of rows: the first row, the hashes of their words, and each row's offset in these."""
    data, offsets = text_buffers(column)
    row, n = 0, len(offsets) - 1
    while row < n:
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + PIECE, "right")) - 1)
        stop = min(stop, n)
        lo, hi = int(offsets[row]), int(offsets[stop])
        if hi - lo > PIECE:  # one long text
            text = data[lo:hi]
            none = np.empty(0, np.int64)
            words = np.concatenate([_hash_words(text[a:b], none, lower)[0] for a, b in _piece_ends(text)])
            bounds = np.array([0, len(words)])
        else:
            cuts = offsets[row:stop + 1] - lo
            words, starts = _hash_words(data[lo:hi], cuts, lower)
            bounds = np.searchsorted(starts, cuts)
        yield row, words, bounds
        row = stop


def shingle_sets(column: pa.Array, k: int = 5, lower: bool = True) -> Iterator[tuple[int, np.ndarray]]:
    """Each row's number with its sorted distinct hashes of ``k``-word shingles.

    A text of fewer words has its whole word sequence as its one shingle, a text without words none.
    """
    factor = _U(0xD6E8FEB86659FD93)
    for row, words, bounds in word_runs(column, lower):
        n = len(words)
        grams = words.copy()
        for j in range(1, k):
            grams[:max(0, n - j)] = grams[:max(0, n - j)] * factor + words[j:]
        grams = mix(grams)
        for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
            if b - a >= k:
                yield row + i, np.unique(grams[a:b - k + 1])
            elif b > a:
                whole = _U(b - a)
                for w in words[a:b]:
                    whole = _U((int(whole) * int(factor) + int(w)) % (1 << 64))
                yield row + i, mix(np.array([whole], np.uint64))
            else:
                yield row + i, np.empty(0, np.uint64)


def sequence_hashes(words: np.ndarray, bounds: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit hash of each row's word sequence; rows without words have 0."""
    n = np.diff(bounds)
    place = np.arange(len(words)) - np.repeat(bounds[:-1], n)
    out = np.zeros(len(n), np.uint64)
    some = np.flatnonzero(n)
    if len(some):
        terms = mix(words ^ mix((place + 1).astype(np.uint64) * _U(_BASE) + _U(salt)))
        out[some] = mix(np.add.reduceat(terms, bounds[:-1][some]) + n[some].astype(np.uint64))
    return out


def stretch_hashes(words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each stretch ``words[start:end]``: equal stretches have equal hashes."""
    up, down = _power_table(len(words) + 1)
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(mix(words) * up[:len(words)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + mix((ends - starts).astype(np.uint64)))


def window_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of each run of ``width`` bytes."""
    n = len(data)
    up, down = _power_table(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[data] * up[:n], out=sums[1:])
    return mix((sums[width:] - sums[:-width]) * down[:n - width + 1])
