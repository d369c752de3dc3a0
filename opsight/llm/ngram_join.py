"""N-gram Jaccard join by token-combination prefixes.

A document's set holds its distinct five-word shingles (lower case); two documents link when their
Jaccard similarity is at least 0.8. Shingles fall into classes by document frequency: unique, rare (at most
``RARE_DF`` documents) and frequent ones by powers of four. Sets are ordered by class, then hash, and
only a prefix is indexed: rare shingles singly, frequent ones as 2-combinations within hash groups, and
the prefix is extended by one shingle for each group it uses. If a prefix can lose all shingles
that similarity 0.8 allows to differ and still keep one signature, every similar pair shares a
signature; the pairs are then verified on their whole sets.

Rows without a doc_id get their own n_shingles and a NULL component. Texts that are NULL, empty or
without words have an empty set and link with nothing. Equal sets are one node; its id is the
smallest doc_id. Repeated rows give repeated result rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsight.llm.common import flag_rows, rows_not_in, shared_table, small_batches
from opsight.llm.components import links_from_buckets
from opsight.llm.hashing import mix, shingle_sets

RARE_DF = 16
_FLUSH = 1 << 19
_NARROW = 12  # bits of hash ranges whose shingles have few different upper parts
_U = np.uint64


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = np.zeros(batch.num_rows, np.int64)
        marks = np.zeros((batch.num_rows, 2), np.int64)
        for row, grams in shingle_sets(batch.column(1)):
            sizes[row] = len(grams)
            marks[row] = np.frombuffer(hashlib.blake2b(grams.tobytes(), digest_size=16).digest(), np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes), pa.array(marks[:, 0].copy()),
                                          pa.array(marks[:, 1].copy())], ["doc_id", "n_shingles", "d1", "d2"])


_TOKENS = "block long, bucket int, high binary, low binary, docs binary, ids binary, sizes binary"
_KNOWN = "block long, bucket int, high binary, low binary, kinds binary, docs binary, ids binary, sizes binary"
_POSTINGS = "sig long, id long, size long, rank long, usable long"


def _names(schema: str) -> list[str]:
    return [f.split()[0] for f in schema.split(", ")]


def _halves(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (tokens >> _U(32)).astype(np.uint16), tokens.astype(np.uint32)


def _packed_high(high: np.ndarray, bucket: int, bucket_bits: int) -> bytes:
    """The upper 16 bits of the sorted 48-bit tokens of a hash range. Where the range has many of them, these are
    numbers of tokens for each, byte plane by byte plane (all but the lowest are mostly zeros)."""
    if bucket_bits < _NARROW:
        counts = np.bincount(high - np.uint16(bucket << 16 >> bucket_bits), minlength=1 << 16 >> bucket_bits).astype(np.uint32)
        high = counts.view(np.uint8).reshape(-1, 4).T
    return high.tobytes()


def _unpacked_tokens(high: bytes, low: bytes, bucket: int, bucket_bits: int) -> np.ndarray:
    if bucket_bits < _NARROW:
        counts = np.ascontiguousarray(np.frombuffer(high, np.uint8).reshape(4, -1).T).view(np.uint32).ravel()
        upper = np.repeat(np.arange(len(counts), dtype=np.uint64) + _U(bucket << 16 >> bucket_bits), counts)
    else:
        upper = np.frombuffer(high, np.uint16).astype(np.uint64)
    return (upper << _U(32)) | np.frombuffer(low, np.uint32)


def _token_blocks(bucket_bits: int):
    """A task's documents in blocks: their shingles (the upper 48 bits) with the document's number in the block,
    sorted and cut into hash ranges; the first range holds the block's ids and set sizes."""
    def packed(block: int, ids: list[int], sets: list[np.ndarray]) -> pa.RecordBatch:
        t = np.concatenate(sets) >> _U(16)
        doc = np.repeat(np.arange(len(sets)), [len(x) for x in sets]).astype(np.uint16)
        order = np.argsort(t, kind="stable")
        t, doc = t[order], doc[order]
        bounds = np.searchsorted(t, np.arange((1 << bucket_bits) + 1, dtype=np.uint64) << _U(48 - bucket_bits))
        filled = np.flatnonzero(bounds[1:] > bounds[:-1])
        cut = [(bounds[b], bounds[b + 1]) for b in filled.tolist()]
        high, low = _halves(t)
        highs = [_packed_high(high[x:y], b, bucket_bits) for b, (x, y) in zip(filled.tolist(), cut)]
        head = [np.array(ids, np.int64).tobytes(), np.array([len(x) for x in sets], np.int64).tobytes()]
        return pa.RecordBatch.from_arrays(
            [pa.array([block] * len(cut), pa.int64()), pa.array(filled.astype(np.int32)),
             pa.array(highs, pa.binary()), *[pa.array([x[a:b].tobytes() for a, b in cut], pa.binary()) for x in (low, doc)],
             *[pa.array([h, *[None] * (len(cut) - 1)], pa.binary()) for h in head]], _names(_TOKENS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, ids, sets, n = TaskContext.get().partitionId() << 32, [], [], 0
        for batch in batches:
            own = batch.column(0).to_pylist()
            for row, grams in shingle_sets(batch.column(1)):
                if len(grams):
                    ids.append(own[row])
                    sets.append(grams)
                    n += len(grams)
                if n >= _FLUSH or len(ids) >= 1 << 16:
                    yield packed(block, ids, sets)
                    block, ids, sets, n = block + 1, [], [], 0
        if n:
            yield packed(block, ids, sets)
    return run


def _classified(rare_df: int, bucket_bits: int):
    """The shingles of each hash range that several documents have, with their class: 1 rare, then frequent by
    powers of four. Each block gets its own back; shingles of one document stay behind."""
    limits = np.array([1, *(rare_df * 4 ** k for k in range(20))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple]] = {}
        for batch in batches:
            for block, bucket, *rest in zip(*[c.to_pylist() for c in batch.columns]):
                held.setdefault(bucket, []).append((block, *rest))
        for bucket in sorted(held):
            rows = held.pop(bucket)
            tokens = [_unpacked_tokens(r[1], r[2], bucket, bucket_bits) for r in rows]
            every = np.concatenate(tokens)
            order = np.argsort(every, kind="stable")
            sorted_tokens = every[order]
            starts = np.flatnonzero(np.r_[True, sorted_tokens[1:] != sorted_tokens[:-1]])
            count = np.diff(np.r_[starts, len(every)])
            kinds = np.empty(len(every), np.uint8)
            kinds[order] = np.repeat(np.searchsorted(limits, count).astype(np.uint8), count)
            high, low = _halves(every)
            out, at = [], 0
            for r, own in zip(rows, tokens):
                here = slice(at, at + len(own))
                kind = kinds[here]
                at += len(own)
                again = kind > 0
                if again.any() or r[4] is not None:
                    out.append((r[0], bucket, _packed_high(high[here][again], bucket, bucket_bits), low[here][again].tobytes(), kind[again].tobytes(),
                                np.frombuffer(r[3], np.uint16)[again].tobytes(), r[4], r[5]))
            if out:
                kinds_of = [pa.int64(), pa.int32(), *[pa.binary()] * 6]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds_of)], _names(_KNOWN))
    return run


def combinations(common: np.ndarray, need: int, lower: int) -> list[np.ndarray]:
    """2-combinations within hash groups of the prefix of ``common`` that may lose ``need`` - 1 shingles."""
    out = []
    groups = _U(max(1, lower // 10))
    group = (common >> _U(7)) % groups
    # a group's shingles count from the second on: find where the prefix ends
    order = np.argsort(group, kind="stable")
    sorted_group = group[order]
    first = np.r_[True, sorted_group[1:] != sorted_group[:-1]]
    counts = np.empty(len(common), bool)
    counts[order] = ~first
    end = int(np.searchsorted(np.cumsum(counts), need)) + 1
    kept, kept_group = common[:end], group[:end]
    order = np.argsort(kept_group, kind="stable")
    kept, kept_group = kept[order], kept_group[order]
    for step in range(1, len(kept)):
        same = kept_group[step:] == kept_group[:-step]
        if not same.any():
            break
        out.append(mix(mix(kept[:-step][same] + _U(lower)) + kept[step:][same]))
    return out


def signatures(grams: np.ndarray, kind: np.ndarray, n: int) -> np.ndarray:
    """The signatures of a set of ``n`` shingles from those that other documents have, and their classes.

    ``need`` shingles of the prefix must remain countable: one more than may be missing in a partner.
    """
    need = n - (4 * n + 4) // 5 + 1 - (n - len(grams))
    order = np.lexsort((grams, kind))
    grams, kind = grams[order], kind[order]
    rare = int((kind == 1).sum())
    out = [grams[:min(rare, need)]]
    need -= len(out[0])
    if need > 0 and rare < len(grams):
        top = 1 << (n.bit_length() - 1)
        for lower in ([top, 2 * top] if 5 * n >= 8 * top else [top]):  # size bands that a partner may use
            out += combinations(grams[rare:], need, lower)
    return np.concatenate(out)


def _signed(bucket_bits: int):
    """The postings of each block's documents. A partner shares four fifths of a document's shingles at least, so
    those with fewer shingles that others have need none."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple]] = {}
        for batch in batches:
            for block, *rest in zip(*[c.to_pylist() for c in batch.columns]):
                held.setdefault(block, []).append(rest)
        for block in sorted(held):
            rows = held.pop(block)
            tokens = np.concatenate([_unpacked_tokens(r[1], r[2], r[0], bucket_bits) for r in rows])
            kinds, docs = (np.concatenate([np.frombuffer(r[k], t) for r in rows]) for k, t in ((3, np.uint8), (4, np.uint16)))
            ids, sizes = (np.frombuffer(next(r[k] for r in rows if r[k] is not None), np.int64) for k in (5, 6))
            usable = np.bincount(docs, minlength=len(ids))
            order = np.argsort(docs, kind="stable")
            bounds = np.r_[0, np.cumsum(usable)]
            found, owner, rank = [], [], []
            for k in np.flatnonzero(5 * usable >= 4 * sizes).tolist():
                own = order[bounds[k]:bounds[k + 1]]
                found.append(np.unique(signatures(tokens[own], kinds[own], int(sizes[k]))))
                owner.append(k)
                rank.append(int(sizes[k] - (kinds[own] > 1).sum()))
            if found:
                n = [len(x) for x in found]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(found).view(np.int64)),
                     *[pa.array(np.repeat(np.array(c, np.int64), n)) for c in (ids[owner], sizes[owner], rank, usable[owner])]], _names(_POSTINGS))
    return run


def postings_of(nodes: DataFrame, rare_df: int = RARE_DF) -> DataFrame:
    """``(sig, id, size, rank, usable)``: the prefix signatures of each document that may have a partner.

    Every shingle is shuffled once, as 6 bytes in sorted blocks, and counted in the task of its hash range
    (2 bytes there for each document of a shared shingle); only shared shingles go back to their block.
    """
    partitions = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bucket_bits = min(18, max(8, (4 * partitions - 1).bit_length()))
    blocks = nodes.select("doc_id", "text").mapInArrow(_token_blocks(bucket_bits), _TOKENS)
    known = blocks.repartition(partitions, "bucket").mapInArrow(_classified(rare_df, bucket_bits), _KNOWN)
    return known.repartition(partitions, "block").mapInArrow(_signed(bucket_bits), _POSTINGS)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low in range(0, batch.num_rows, 64):
            part = batch.slice(low, 64)
            grams = [g.view(np.int64) for _, g in shingle_sets(part.column(1))]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(grams, pa.list_(pa.int64())), part.column(2), part.column(3)],
                                             ["id", "grams", "as_a", "as_b"])


def verify_pairs(docs: DataFrame):
    """A function that compares the whole sets of pairs ``(a, b)``; Jaccard similarity 0.8 or more is a link."""
    def verify(pairs: DataFrame) -> DataFrame:
        # a set is shuffled only for the side of the pairs that it stands on
        ids = (pairs.select(F.col("a").alias("doc_id"), F.lit(True).alias("as_a"), F.lit(False).alias("as_b"))
               .union(pairs.select("b", F.lit(False), F.lit(True))).groupBy("doc_id").agg(F.max("as_a").alias("as_a"), F.max("as_b").alias("as_b")))
        texts = flag_rows(docs, ["doc_id"], ids, "maybe").filter("maybe").select("doc_id", "text").join(ids, "doc_id")
        sets = shared_table(texts.mapInArrow(_sets, "id long, grams array<long>, as_a boolean, as_b boolean"), "sets")
        own = {side: sets.filter(f"as_{side}").select(F.col("id").alias(side), F.col("grams").alias(f"grams_{side}")) for side in "ab"}
        both = (pairs.join(own["a"], "a").join(own["b"], "b")
                .select("a", "b", (F.size("grams_a") + F.size("grams_b")).alias("sizes"),
                        F.size(F.array_intersect("grams_a", "grams_b")).cast("long").alias("shared")))
        return (both.withColumn("link", F.expr("100 * shared >= 80 * (sizes - shared)"))
                .groupBy("a", "b").agg(F.max("shared").alias("shared"), F.max("link").alias("link")))
    return verify


def jaccard_components(docs: DataFrame, rare_df: int = RARE_DF) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for each row of ``docs(doc_id, text)``."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sizes = shared_table(docs.mapInArrow(_digests, "doc_id long, n_shingles long, d1 long, d2 long"), "sizes")
    groups = (sizes.filter("n_shingles > 0 and doc_id is not null").groupBy("d1", "d2")
              .agg(F.min("doc_id").alias("rep"), F.max("doc_id").alias("last")).filter("rep < last")
              .select("d1", "d2", "rep"))
    copies = shared_table(sizes.filter("n_shingles > 0").join(groups, ["d1", "d2"]).filter("doc_id > rep")
                          .select("doc_id", "rep").distinct(), "copies")
    flagged = flag_rows(docs.filter("doc_id is not null"), ["doc_id"], copies, "maybe")
    others = flagged.filter("maybe").drop("maybe").join(copies.select("doc_id"), "doc_id", "left_anti")
    # a repeated task must number its documents alike, so rows that were shuffled are sorted
    others = others.withColumn("mark", F.xxhash64("text")).sortWithinPartitions("doc_id", "mark").drop("mark")
    nodes = flagged.filter("not maybe").drop("maybe").unionByName(others)
    with small_batches(docs.sparkSession):
        postings = shared_table(postings_of(nodes, rare_df), "postings")
    found, _ = links_from_buckets(postings, verify_pairs(docs))
    reps = found.select(F.col("id").alias("rep"), "component")
    return (sizes.select("doc_id", "n_shingles").join(copies, "doc_id", "left")
            .withColumn("rep", F.coalesce("rep", "doc_id")).join(reps, "rep", "left")
            .select("doc_id", "n_shingles", F.coalesce("component", "rep").alias("component_id")))


def keep_one_per_group(docs: DataFrame) -> DataFrame:
    """The documents that are the first (smallest doc_id) of their group; rows without a doc_id stay."""
    drop = shared_table(jaccard_components(docs).filter("doc_id <> component_id").select("doc_id").distinct(), "drop")
    return rows_not_in(docs, ["doc_id"], drop)
