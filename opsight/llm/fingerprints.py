"""Threshold-scaled document fingerprints.

A text's shingles are its runs of ``WIDTH`` bytes in UTF-8 (A-Z lower-cased; the text's beginning follows its
end, so a text of n bytes has n of them). A fingerprint keeps every shingle hash below a fixed fraction of the
hash range. Sketches of any two documents share one threshold, so their intersection and union estimate
containment and Jaccard likeness whatever the two sizes, and the sketch of a union is the union of sketches.

A fingerprint is text: for each kept hash in order, 12 hexadecimal digits. Empty texts have an empty
fingerprint, and so may very short ones; the README has the errors by length. The likeness of two empty
fingerprints is 1 for equal texts, else 0.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opsight.llm.hashing import LOWERED, PIECE, window_hashes

WIDTH = 12
FRACTION = 1 / 8
RANGE_BYTES = 32 << 20  # of text in a range of documents
_DIGITS = np.frombuffer(b"0123456789abcdef", np.uint8)


def kept_hashes(text: str, fraction: float = FRACTION, width: int = WIDTH) -> np.ndarray:
    """The leading 48 bits of the text's shingle hashes under the threshold, sorted and distinct."""
    data = LOWERED[np.frombuffer(text.encode(), np.uint8)]
    n = len(data)
    if not n:
        return np.empty(0, np.uint64)
    data = np.concatenate([data, np.resize(data, width - 1)])
    limit = np.uint64(int(fraction * 2.0 ** 64) - 1) if fraction < 1 else ~np.uint64(0)
    found = []
    for low in range(0, n, PIECE):
        hashes = window_hashes(data[low:low + PIECE + width - 1], width)
        found.append(hashes[hashes <= limit] >> np.uint64(16))
    return np.unique(np.concatenate(found))


def to_text(kept: np.ndarray) -> str:
    parts = (kept[:, None] >> np.arange(44, -4, -4, dtype=np.uint64)) & np.uint64(15)
    return _DIGITS[parts.astype(np.intp)].tobytes().decode()


def from_text(text: str) -> np.ndarray:
    """The hashes of a fingerprint."""
    padded = np.zeros((len(text) // 12, 16), np.uint8)
    padded[:, 4:] = np.frombuffer(text.encode(), np.uint8).reshape(-1, 12)
    padded[:, :4] = 48
    value = np.where(padded >= 97, padded - 87, padded - 48).astype(np.uint64)
    return (value << np.arange(60, -4, -4, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)


def merge(a: str, b: str) -> str:
    """The fingerprint of two documents together."""
    return to_text(np.union1d(from_text(a), from_text(b)))


def containment(a: str, b: str) -> float:
    """The estimated share of the first document's shingles that the second has (0 for an empty first)."""
    x, y = from_text(a), from_text(b)
    return float(np.isin(x, y).mean()) if len(x) else 0.0


def likeness(x: np.ndarray, y: np.ndarray, equal: bool = False) -> float:
    """Estimated Jaccard similarity of two sorted distinct hash arrays."""
    if not len(x) and not len(y):
        return 1.0 if equal else 0.0
    both = np.concatenate((x, y))
    both.sort()
    shared = int(np.count_nonzero(both[1:] == both[:-1]))
    return shared / (len(both) - shared)


def edited_text(text: str, following: str) -> str:
    """``text`` with its last half replaced by the beginning of the following document's text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


_SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
           "near_edited double, near_next double, n_hashes long")


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (part, doc_id); a row without ``own`` only serves its predecessor."""
    before: tuple | None = None

    def described(rows: list[tuple]) -> pa.RecordBatch:
        texts = [r[2] for r in rows]
        edited = [edited_text(a[2], b[2]) for a, b in zip(rows, rows[1:])]
        kept, changed = [kept_hashes(t) for t in texts], [kept_hashes(t) for t in edited]
        out = []
        for k, (row, following) in enumerate(zip(rows, rows[1:])):
            if row[1]:
                out.append((row[0], len(row[2]), hashlib.sha256(edited[k].encode()).hexdigest(), to_text(kept[k]),
                            to_text(changed[k]), likeness(kept[k], changed[k], row[2] == edited[k]),
                            likeness(kept[k], kept[k + 1], row[2] == following[2]), len(kept[k])))
        columns = list(zip(*out)) if out else [()] * 8
        kinds = [pa.int64(), pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)],
                                          [f.split()[0] for f in _SCHEMA.split(", ")])

    for batch in batches:
        rows = list(zip(*[batch.column(k).to_pylist() for k in range(4)]))
        # a chain breaks where the part changes: its last row is the first document of the next part
        start = 0
        for k in range(len(rows) + 1):
            if k == len(rows) or k - start >= 256 or (k and rows[k][3] != rows[k - 1][3]):
                run = rows[start:k]
                if before is not None and run and before[3] == run[0][3]:
                    run = [before, *run]
                if len(run) > 1:
                    yield described(run)
                if run:
                    before = run[-1]
                start = k


def fingerprint_report(docs: DataFrame) -> DataFrame:
    """The fingerprint of every document and of its edited text, with the likenesses.

    Documents are cut into ranges of doc_id, one task each; the first document of a range is also
    sent to the range before it (the very first to the last range), so each text has its successor in
    its own task. Equal doc_ids stand in the order of their texts, rows without a doc_id come first.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    parts = max(1, -(-(docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // RANGE_BYTES))
    shares = [k / parts for k in range(1, parts)] or [0.5]
    cuts = sorted(set(docs.agg(F.percentile_approx("doc_id", shares, 100 * parts)).first()[0] or []))
    limits = F.array(*[F.lit(c) for c in cuts]).cast("array<long>")
    place = F.coalesce("doc_id", F.lit(-(1 << 63)))
    placed = docs.withColumn("place", place).withColumn(
        "part", F.size(F.filter(limits, lambda c: c < F.col("place"))))
    order = Window.orderBy("part")
    heads = placed.groupBy("part").agg(F.min("place").alias("place"))  # a row for each range
    heads = heads.select("place", F.coalesce(F.lag("part").over(order), F.max("part").over(
        order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("to"))
    tails = placed.join(F.broadcast(heads), "place").withColumn("part", F.col("to")).drop("to")
    rows = (placed.withColumn("own", F.lit(True)).unionByName(tails.withColumn("own", F.lit(False)))
            .repartition(parts, "part").sortWithinPartitions("part", F.col("own").desc(), "place", "text"))
    return rows.select("doc_id", "own", "text", "part").mapInArrow(_fingerprints, _SCHEMA)
