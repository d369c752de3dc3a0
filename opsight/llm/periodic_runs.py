"""Periodic runs of words by internal pattern matching.

A run is a stretch of consecutive words with smallest period q (words q apart are identical) of at least
``POWER`` * q and ``MIN_WORDS`` words that cannot be extended. A task takes whole texts, many short ones
at a time, and keeps for them a suffix array with the ranks of all blocks of 1, 2, 4, ... words (which
also tell how far two places agree) and a wavelet tree over it.

A run with a period q of b to 2b - 1 words, b a power of two, holds within its first 2b words one of the
blocks of b words on the grid of b, and that block occurs again q words on. So for each grid block, range
successor queries on the wavelet tree (the block's suffixes are a range of the suffix array) give its
occurrences b to 2b - 1 words later. One or two are candidates for the period as they are. Three or more are
an arithmetic progression of difference p, and the block then lies in a stretch of period p: the distance
between the ends of this stretch and of the progression's is the only candidate. Candidates are extended both ways.

Words are compared by their 64-bit hashes. NULL and empty texts have no words and no runs; rows without a
doc_id are treated like others; repeated rows give repeated result rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsight.llm.common import small_batches
from opsight.llm.hashing import mix, word_runs
from opsight.llm.wavelet import WaveletMatrix

POWER = 4
MIN_WORDS = 6
RUNS = "doc_id long, start long, length long, period long"
REPORT = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
          "runs_sha256 string, collapsed_sha256 string")


class BlockRanks:
    """Ranks of the blocks of 2**k words of some texts, up to the size at which no block repeats, and the
    suffix array. Blocks that reach over their text's end, or lie in different texts, never have equal ranks."""

    def __init__(self, words: np.ndarray, bounds: np.ndarray):
        n = len(words)
        owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        end = bounds[1:][owner]
        codes = mix(words ^ mix(owner.astype(np.uint64)))
        slots = np.argsort(codes)
        codes = codes[slots]
        first = np.r_[True, codes[1:] != codes[:-1]][:n]
        rank = np.empty(n + 1, np.int32)
        rank[slots] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
        rank[n] = -1
        self.levels = [rank]
        size = 1
        again = ~(first & np.r_[first[1:], True][:n])
        at = np.flatnonzero(again)  # the slots of blocks that occur again
        while len(at):
            place = slots[at]
            old = rank[place].astype(np.int64)
            far = place + size
            inside = far < end[place]
            follow = np.where(inside, rank[np.minimum(far, n)].astype(np.int64), -1)
            order = np.argsort(old * (n + 2) + follow, kind="stable")
            place, old, follow, inside = place[order], old[order], follow[order], inside[order]
            slots[at] = place
            new = np.r_[True, (old[1:] != old[:-1]) | (follow[1:] != follow[:-1])] | ~inside
            rank = rank.copy()
            rank[place] = at[np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))]
            again = ~(new & np.r_[new[1:], True])
            at = at[again]
            size *= 2
            if len(at):
                self.levels.append(rank)
        self.suffixes = slots

    def agree(self, i: np.ndarray, j: np.ndarray, back: bool = False) -> np.ndarray:
        """How many words from the different places ``i`` and ``j`` on (or before them) are the same."""
        i, j, start = i.copy(), j.copy(), i
        for k in range(len(self.levels) - 1, -1, -1):
            rank, size = self.levels[k], 1 << k
            if back:
                low = np.minimum(i, j) - size
                same = (low >= 0) & (rank[np.maximum(i - size, 0)] == rank[np.maximum(j - size, 0)])
                i[same] -= size
                j[same] -= size
            else:
                same = rank[i] == rank[j]
                i[same] += size
                j[same] += size
        return np.abs(i - start)


def periodic_stretches(words: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Start, end and period of each run in some texts, shape (runs, 3), places counted over all texts."""
    none = np.empty((0, 3), np.int64)
    n = len(words)
    longest = int(np.diff(bounds).max(initial=0))
    if longest < MIN_WORDS:
        return none
    ranks = BlockRanks(words, bounds)
    # only suffixes whose first word occurs again can be in a range that is asked for
    rank = ranks.levels[0][:n]
    kept = np.bincount(rank, minlength=n)[rank] > 1
    kept = kept[ranks.suffixes]
    slot = np.r_[0, np.cumsum(kept)]
    tree = WaveletMatrix(ranks.suffixes[kept], max(n - 1, 1))
    found = []
    for k, rank in enumerate(ranks.levels):
        b = 1 << k
        if POWER * b > longest:
            break
        block = np.arange(0, n, b)
        count = np.bincount(rank[:n], minlength=n)[rank[block]]
        block, count = block[count > 1], count[count > 1]
        if not len(block):
            continue
        lo = slot[rank[block]]
        hi = lo + count
        below = tree.count_below(lo, hi, block + b)
        within = tree.count_below(lo, hi, block + 2 * b) - below
        some = within > 0
        block, lo, hi, below, within = (x[some] for x in (block, lo, hi, below, within))
        one = tree.smallest(lo, hi, below)
        more = within > 1
        two = tree.smallest(lo[more], hi[more], below[more] + 1)
        many = within[more] > 2
        p = (two - one[more])[many]
        s, t = block[more][many], one[more][many]
        ends = s + p + ranks.agree(s, s + p), t + p + ranks.agree(t, t + p)
        single = within < 3
        s = np.concatenate([block[single], block[more][~many], s])
        q = np.concatenate([(one - block)[single], (two - block[more])[~many], ends[1] - ends[0]])
        good = (q >= b) & (q < 2 * b)
        s, q = s[good], q[good]
        # the last candidates' blocks need not occur there: such places agree on fewer words
        right = s + q + ranks.agree(s, s + q)
        left = s - ranks.agree(s, s + q, back=True)
        good = right - left >= np.maximum(MIN_WORDS, POWER * q)
        found.append(np.stack([left, right, q], 1)[good])
    found = np.unique(np.concatenate(found), axis=0) if found else none
    first = np.r_[True, (found[1:, :2] != found[:-1, :2]).any(1)][:len(found)]  # the smallest period of a stretch
    return found[first]


def planted_places(doc_id: int | None, n: int) -> np.ndarray | None:
    """The contract's made-up repetitions: which word stands at each place, None if the text stays as it is."""
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 or not n:
        return None
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    places = np.arange(n)
    places[a:] = a + (places[a:] - a) % p
    return places


def _text_runs(batch: pa.RecordBatch, planted: bool) -> Iterator[tuple[int, np.ndarray | None, np.ndarray]]:
    """Each row with its planted places and its runs (start, end, period)."""
    ids = batch.column(0).to_pylist()
    for row, words, bounds in word_runs(batch.column(1), lower=False):
        count = len(bounds) - 1
        places: list[np.ndarray | None] = [None] * count
        if planted:
            places = [planted_places(ids[row + k], int(bounds[k + 1] - bounds[k])) for k in range(count)]
            words = words.copy()
            for k, place in enumerate(places):
                if place is not None:
                    words[bounds[k]:bounds[k + 1]] = words[bounds[k]:bounds[k + 1]][place]
        runs = periodic_stretches(words, bounds)
        cuts = np.searchsorted(runs[:, 0], bounds)
        for k in range(count):
            own = runs[cuts[k]:cuts[k + 1]]
            yield row + k, places[k], np.stack([own[:, 0] - bounds[k], own[:, 1] - bounds[k], own[:, 2]], 1)


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0)
        for row, _, runs in _text_runs(batch, planted=False):
            if len(runs):
                yield pa.RecordBatch.from_arrays([ids.take(pa.array([row] * len(runs))), pa.array(runs[:, 0]),
                                                  pa.array(runs[:, 1] - runs[:, 0]), pa.array(runs[:, 2])],
                                                 [f.split()[0] for f in RUNS.split(", ")])


def _sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def _summary(runs: list[list[int]]) -> tuple[int | None, ...]:
    """Start, length, period and exponent in thousandths of the run with the greatest exponent."""
    best = None
    for start, end, q in runs:
        if best is None or (end - start) * best[2] > best[1] * q:
            best = (start, end - start, q)
    return (*best, 1000 * best[1] // best[2]) if best else (None,) * 4


def _reported(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts = batch.column(0).to_pylist(), batch.column(1)
        rows = []
        for row, places, runs in _text_runs(batch, planted=True):
            words = (texts[row].as_py() or "").encode().split()  # at the contract's six separators
            if places is not None:
                words = [words[k] for k in places.tolist()]
            runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))].tolist()
            if runs:
                dropped = np.zeros(len(words), bool)
                for start, end, q in runs:
                    dropped[start + q:end] = True
                words = [w for w, gone in zip(words, dropped.tolist()) if not gone]
            listed = "".join(f"{start},{end - start},{q}\n" for start, end, q in runs)
            rows.append((ids[row], len(runs), *_summary(runs), _sha(listed.encode()), _sha(b" ".join(words))))
        if rows:
            kinds = [pa.int64()] * 6 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                                             [f.split()[0] for f in REPORT.split(", ")])


def periodic_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, start, length, period``: every run of each text, in words."""
    with small_batches(docs.sparkSession):
        return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_listed, RUNS)


def run_report(docs: DataFrame) -> DataFrame:
    """The runs of each text with the planted repetitions: number, greatest exponent, and digests of all
    runs and of the text without the words that repeat the period before them."""
    with small_batches(docs.sparkSession):
        return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_reported, REPORT)
