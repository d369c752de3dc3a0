"""Repeated passages by a compressed FM-index for each shard.

A window is ``WINDOW`` consecutive words of one document; a word goes if it lies in a window whose words
also start earlier (smaller doc_id, or the same document and an earlier start). All windows are judged on the
input. Texts are cut into segments: stretches of windows whose smallest hash of five words stands at the same place;
this hash is the segment's key. So equal windows lie in different segments of equal keys, and only segments whose key
occurs again are looked at.

Equal segments are one entry with its first place; all other occurrences go whole. The entries are dealt to shards
by key. Each shard holds a suffix array's Burrows-Wheeler transform of its entries in a wavelet matrix; the
entries' windows are streamed through it by backward search, which extends a match leftwards while more
than one place has it. Windows that reach ``WINDOW`` words are reported where an earlier place is in their range.
A key with more than ``KEY_WORDS`` words of different segments does not fit a shard's share: its entries are cut into single
windows, which Spark groups as rows, so no shard is unbounded.

Words are compared by 64-bit hashes. Rows without a doc_id keep all words and take no part; NULL and empty
texts have no words. Rows that repeat a doc_id and its words are one document, each with its result; other
texts of the same doc_id are ordered by a hash of their words. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsight.llm.common import flag_rows, rows_in, shared_table, small_batches
from opsight.llm.hashing import mix, sequence_hashes, stretch_hashes, word_runs
from opsight.llm.wavelet import WaveletMatrix

WINDOW = 20
GRAM = 5  # words of the hashes of which a window's smallest is its key
SHARD_WORDS = 1 << 19
KEY_WORDS = 1 << 16
_QUERIES = 1 << 17
_U = np.uint64

SEGMENTS = "key long, content long, doc long, mark long, start long, n int"
ENTRIES = "shard int, doc long, mark long, start long, words binary"
COVERED = "doc long, mark long, start long, n int"
REPORT = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def _names(schema: str) -> list[str]:
    return [f.split()[0] for f in schema.split(", ")]


def window_keys(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The smallest hash of ``GRAM`` words in each window, and its first place there; windows may cross rows."""
    grams = words[:max(0, len(words) - GRAM + 1)].copy()
    for j in range(1, GRAM):
        grams = grams * _U(0xD6E8FEB86659FD93) + words[j:j + len(grams)]
    grams, size, width = mix(grams), WINDOW - GRAM + 1, 1
    at = np.arange(len(grams))
    while width < size:
        step = min(width, size - width)
        left, right = at[:max(0, len(at) - step)], at[step:]
        at = np.where(grams[left] <= grams[right], left, right)
        width += step
    return grams[at], at


def segments_of(words: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first window and number of windows of each segment of some rows."""
    n = max(0, len(words) - WINDOW + 1)
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[:n]
    at = np.flatnonzero(np.arange(n) + WINDOW <= bounds[1:][row])
    if not len(at):
        return at, at, at
    anchor = window_keys(words)[1][at]
    starts = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (at[1:] != at[:-1] + 1)])
    return row[at[starts]], at[starts], np.diff(np.r_[starts, len(at)])


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
        for at, words, bounds in word_runs(batch.column(1), lower=False):
            row, start, n = segments_of(words, bounds)
            if len(row):
                keys, marks = window_keys(words)[0][start], sequence_hashes(words, bounds)
                content = stretch_hashes(words, start, start + n + WINDOW - 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.view(np.int64)), pa.array(content.view(np.int64)), pa.array(ids[at + row]),
                     pa.array(marks[row].view(np.int64)), pa.array(start - bounds[row]), pa.array(n.astype(np.int32))], _names(SEGMENTS))


def _entry_words(shards: int):
    """The words of the wanted segments of each text; those of a hot key as single windows of shard -1."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for at, words, bounds in word_runs(batch.column(1), lower=False):
                marks = sequence_hashes(words, bounds).view(np.int64).tolist()
                for k, mark in enumerate(marks):
                    own = words[bounds[k]:bounds[k + 1]]
                    rows = []
                    for wanted in batch.column(2)[at + k].as_py() or ():
                        if wanted["mark"] == mark:
                            start, n = wanted["start"], wanted["n"]
                            if wanted["hot"]:
                                some = np.arange(start, start + n)
                                for i, h in zip(some.tolist(), stretch_hashes(own, some, some + WINDOW)):
                                    rows.append((-1, ids[at + k], mark, i, h.tobytes()))
                            else:
                                rows.append((wanted["key"] % shards, ids[at + k], mark, start, own[start:start + n + WINDOW - 1].tobytes()))
                    if rows:
                        kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], _names(ENTRIES))
    return run


def suffix_order(text: np.ndarray, separators: int) -> np.ndarray:
    """Suffix array of a text whose ``separators`` first codes each occur once, one of them at its end."""
    n = len(text)
    order = np.argsort(text, kind="stable")
    first = np.r_[True, text[order][1:] != text[order][:-1]]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    at = np.flatnonzero(~(first & np.r_[first[1:], True]))
    size = 1
    while len(at):
        place = order[at]
        key = rank[place] * n + rank[np.minimum(place + size, n - 1)]  # no suffix that is not alone yet reaches the end
        resort = np.argsort(key)
        place, key = place[resort], key[resort]
        order[at] = place
        new = np.r_[True, key[1:] != key[:-1]]
        after = at[np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))]
        rank[place] = after
        at = at[~(new & np.r_[new[1:], True])]
        size *= 2
    return order


class FMIndex:
    """Places of word sequences in some segments by backward search."""

    def __init__(self, words: np.ndarray, bounds: np.ndarray):
        count = len(bounds) - 1
        self.vocabulary, codes = np.unique(words, return_inverse=True)
        self.codes = codes.astype(np.int64) + 1  # 0 in the transform: a separator
        self.offset = bounds[:-1] + np.arange(count)  # of each segment in the text with separators
        text = np.empty(len(words) + count, np.int64)
        ends = bounds[1:] + np.arange(count)
        inside = np.ones(len(text), bool)
        inside[ends] = False
        text[inside] = self.codes + count - 1
        text[ends] = np.arange(count)
        self.suffixes = suffix_order(text, count)
        text = np.where(inside, text - count + 1, 0)
        self.tree = WaveletMatrix(text[self.suffixes - 1], len(self.vocabulary))
        symbols = np.arange(len(self.vocabulary) + 2)
        self.first = np.searchsorted(text[self.suffixes], symbols)
        self.base = self.tree.place(symbols[:-1], np.zeros(len(symbols) - 1, np.int64))

    def repeated(self, starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the ``size`` words from each of ``starts`` (places among the segments' words): which of them occur at
        more than one place, and their ranges of suffixes. A match is extended while it has more than one place."""
        code = self.codes[starts + size - 1]
        lo, hi = self.first[code], self.first[code + 1]
        live = np.arange(len(starts))
        for step in range(size - 2, -1, -1):
            some = hi - lo > 1
            live, lo, hi = live[some], lo[some], hi[some]
            code = self.codes[starts[live] + step]
            shift = self.first[code] - self.base[code]
            lo, hi = shift + self.tree.place(code, lo), shift + self.tree.place(code, hi)
        some = hi - lo > 1
        return live[some], lo[some], hi[some]


def covered_windows(words: np.ndarray, bounds: np.ndarray, doc: np.ndarray, mark: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Segment and place (in words, in its text) of each window that has an earlier place in the shard."""
    index = FMIndex(words, bounds)
    segment = np.repeat(np.arange(len(bounds) - 1), np.maximum(0, np.diff(bounds) - WINDOW + 1))
    counts = np.cumsum(np.r_[0, np.maximum(0, np.diff(bounds) - WINDOW + 1)])
    windows = np.arange(len(segment)) - counts[segment] + bounds[segment]
    parts = [index.repeated(windows[k:k + _QUERIES], WINDOW) for k in range(0, len(windows), _QUERIES)]
    live = np.concatenate([p[0] + k * _QUERIES for k, p in enumerate(parts)]) if parts else np.empty(0, np.int64)
    if not len(live):
        return live, live
    lo, hi = np.concatenate([p[1] for p in parts]), np.concatenate([p[2] for p in parts])
    ranges, which = np.unique(lo, return_inverse=True)
    sizes = np.empty(len(ranges), np.int64)
    sizes[which] = hi - lo
    owner = np.repeat(np.arange(len(ranges)), sizes)
    slots = ranges[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    places = index.suffixes[slots]
    held = np.searchsorted(index.offset, places, "right") - 1
    at = start[held] + places - index.offset[held]
    order = np.lexsort((at, mark[held], doc[held], owner))
    heads = order[np.r_[True, owner[order][1:] != owner[order][:-1]]]  # the earliest place of each range
    own = segment[live]
    place = start[own] + windows[live] - bounds[own]
    head = heads[which]
    later = (doc[own] != doc[held[head]]) | (mark[own] != mark[held[head]]) | (place != at[head])
    return own[later], place[later]


def _search(table: pa.Table) -> pa.Table:
    """The covered windows of one shard, as stretches."""
    table = table.combine_chunks()
    doc, mark, start = (table.column(c).to_numpy().astype(np.int64) for c in ("doc", "mark", "start"))
    held = table.column("words").combine_chunks()
    buffers = [np.frombuffer(w.as_buffer(), np.uint64) for w in held]
    bounds = np.cumsum([0, *map(len, buffers)])
    own, place = covered_windows(np.concatenate(buffers), bounds, doc, mark, start)
    order = np.lexsort((place, own))
    own, place = own[order], place[order]
    new = np.flatnonzero(np.r_[True, (own[1:] != own[:-1]) | (place[1:] != place[:-1] + 1)][:len(own)])
    sizes = np.diff(np.r_[new, len(own)]).astype(np.int32)
    return pa.Table.from_arrays([pa.array(doc[own[new]]), pa.array(mark[own[new]]), pa.array(place[new]), pa.array(sizes)], _names(COVERED))


def covered_stretches(docs: DataFrame) -> DataFrame:
    """``doc, mark, start, n``: stretches of ``n`` windows of ``docs(doc_id, text)`` that start earlier elsewhere too."""
    docs = docs.filter("doc_id is not null")
    segments = shared_table(docs.mapInArrow(_segments, SEGMENTS), "segments", "zstd")
    again = segments.groupBy("key").agg(F.count(F.lit(1)).alias("times")).filter("times > 1").select("key")
    candidates = shared_table(rows_in(segments, ["key"], shared_table(again, "keys"), unique=True), "candidates", "zstd")
    firsts = shared_table(candidates.groupBy("key", "content").agg(
        F.min(F.struct("doc", "mark", "start")).alias("at"), F.first("n").alias("n"), F.count(F.lit(1)).alias("times")), "firsts", "zstd")
    others = (candidates.join(firsts.filter("times > 1").select("key", "content", "at"), ["key", "content"])
              .filter("doc <> at.doc or mark <> at.mark or start <> at.start").select("doc", "mark", "start", "n"))
    # entries with other entries of the same key
    loads = firsts.groupBy("key").agg(F.sum(F.col("n") + (WINDOW - 1)).alias("load"))
    total = loads.agg(F.sum("load")).first()[0] or 0
    shards = max(1, -(-total // SHARD_WORDS))
    hot = shared_table(loads.filter(F.col("load") > KEY_WORDS).select("key"), "hot")
    flagged = firsts.join(hot.withColumn("hot", F.lit(True)), "key", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
    wanted = (flagged.groupBy(F.col("at.doc").alias("doc_id"))  # at most a document's own segments
              .agg(F.collect_list(F.struct("key", "at.mark", "at.start", "n", "hot")).alias("wanted")))
    wanted = shared_table(wanted, "wanted", "zstd")
    texts = flag_rows(docs, ["doc_id"], wanted, "maybe").filter("maybe").select("doc_id", "text").join(wanted, "doc_id")
    entries = shared_table(texts.mapInArrow(_entry_words(shards), ENTRIES).distinct(), "entries", "zstd")
    found = entries.filter("shard >= 0").groupBy("shard").applyInArrow(_search, COVERED)
    windows = entries.filter("shard < 0").select("words", "doc", "mark", "start")
    earliest = windows.groupBy("words").agg(F.min(F.struct("doc", "mark", "start")).alias("at"), F.count(F.lit(1)).alias("times")).filter("times > 1")
    single = (windows.join(earliest, "words").filter("doc <> at.doc or mark <> at.mark or start <> at.start")
              .select("doc", "mark", "start", F.lit(1).alias("n")))
    return others.unionByName(found).unionByName(single)


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words, words that go and the digest of the others for each text with its covered stretches."""
    for batch in batches:
        ids, texts, lists = batch.column(0), batch.column(1), batch.column(2)
        rows = []
        for at, words, bounds in word_runs(texts, lower=False):
            marks = sequence_hashes(words, bounds).view(np.int64).tolist()
            for k, mark in enumerate(marks):
                own = (texts[at + k].as_py() or "").encode().split()  # at the contract's six separators
                n = len(own)
                stretches = [(s["start"], s["n"]) for s in lists[at + k].as_py() or () if s["mark"] == mark]
                if stretches:
                    begins, sizes = np.array(stretches).T
                    change = np.zeros(n + 1, np.int64)
                    np.add.at(change, begins, 1)
                    np.add.at(change, begins + sizes + WINDOW - 1, -1)
                    gone = np.cumsum(change[:n]) > 0
                    own = [w for w, g in zip(own, gone.tolist()) if not g]
                rows.append((ids[at + k].as_py(), n, n - len(own), hashlib.sha256(b" ".join(own)).hexdigest()))
        if rows:
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], _names(REPORT))


def dedup_report(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` for each row of ``docs(doc_id, text)``."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    lists = (covered_stretches(docs).groupBy(F.col("doc").alias("doc_id"))
             .agg(F.collect_list(F.struct("mark", "start", "n")).alias("stretches")))  # a document's own ones
    lists = shared_table(lists, "stretches", "zstd")
    flagged = flag_rows(docs, ["doc_id"], lists, "maybe")
    plain = flagged.filter("not maybe or maybe is null").select("doc_id", "text", F.lit(None).cast(lists.schema["stretches"].dataType).alias("stretches"))
    joined = flagged.filter("maybe").join(lists, "doc_id", "left").select("doc_id", "text", "stretches")
    with small_batches(docs.sparkSession):
        return plain.unionByName(joined).mapInArrow(_kept, REPORT)
