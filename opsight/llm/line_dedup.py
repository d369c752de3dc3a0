"""Fuzzy line dedup: SimHash blocks, edit similarity, one occurrence for each connected group.

A line's normal form is its sequence of units: lower-case words, the characters of scripts that write no
blanks, and the characters of a line that is one word. Equal normal forms are one line, whatever
their length. Different ones are linked when at most a tenth of the longer line's units differ (edit
similarity ``MIN_SIMILARITY``; under ten units that leaves equal lines only). Of each connected group, and so of
each normal form, one occurrence stays: the first by doc_id, then line number.

Candidates come from a SimHash of 512 bits over a line's distinct units, cut into ``BLOCKS`` blocks: by the
pigeonhole principle lines that differ in fewer bits than there are blocks agree in one. Beyond that the search is
probable, not certain; the README has its recall against brute force. The hash ranges of the blocks are
worked through by Spark tasks on packed arrays. Members of a block's list whose further bits differ little are one
bucket (a row for each member, no pairs) of the search by pivots, which leaves no pair of a bucket out but those
whose units differ in more places than a link allows, by bitmaps of the units.

Rows without a doc_id, NULL or empty texts, and lines without words pass unchanged and take no part. Rows
with the same doc_id are one document, and each of them keeps the first occurrence. A document that
loses its last line with words keeps an empty text in ``line_report`` and goes in ``without_repeated_lines``.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsight.llm.common import flag_rows, rows_in, shared_table, small_batches
from opsight.llm.components import links_from_buckets
from opsight.llm.hashing import IS_SPACE, mix, sequence_hashes, text_buffers, word_runs

MIN_SIMILARITY = 0.9
MIN_FUZZY = 10  # units: at fewer, one edit is more than the threshold allows
WORDS64 = 8  # of a SimHash
BLOCKS, BLOCK_BITS = 24, 21  # three blocks of each 64 bits
KEY_BITS = BLOCK_BITS + (BLOCKS - 1).bit_length()  # a block's number and bits
CHECK_BITS = 6  # of 32 further bits, that may differ in a candidate pair
LONG_LIST = 1024  # members of a block's list beyond which their check bits are not compared
_FLUSH = 1 << 17  # lines that a task holds, each form once
_U = np.uint64
_LINES_AT_ONCE = 1 << 13
_WAITING = 1 << 18  # units that a task collects before it hashes their lines
_LONG_LINE = 512  # units from which a line's bits are counted by itself, with the same result
# Thai, Lao, Burmese, Khmer, CJK with kana: scripts without blanks between words.
_BLANKLESS = re.compile("([\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u2e80-\u9fff\uf900-\ufaff\U00020000-\U0003ffff])")
_MAY_BE_BLANKLESS = np.zeros(256, bool)  # first bytes of these in UTF-8, among others
_MAY_BE_BLANKLESS[[*range(0xE0, 0xEA), 0xEF, 0xF0]] = True
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LINE_WITH_WORD = r"[^\x20\x09-\x0D][^\n]*"
_SALTS = np.random.default_rng(20240301).integers(1, 1 << 63, WORDS64, dtype=np.uint64) | np.uint64(1)


def _bits(units: np.ndarray) -> np.ndarray:
    """512 pseudorandom bits of each unit, shape (units, 8)."""
    out = units[:, None] * _SALTS
    out ^= out >> _U(32)
    out *= _U(0x94D049BB133111EB)
    out ^= out >> _U(29)
    return out


def _majority(units: np.ndarray, starts: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The bits that more than half of each line's ``n`` units have: counters are held bit by bit, one plane of all
    lines for each binary digit, and take the lines' units one after the other."""
    order = np.argsort(-n, kind="stable")  # the lines that still have units come first
    starts, size = starts[order], n[order]
    planes = np.zeros((int(size[0]).bit_length(), len(n), WORDS64), np.uint64)
    waiting: list[np.ndarray | None] = [None] * len(planes)  # two carries are added to a plane at once
    for k, live in enumerate(np.searchsorted(-size, -np.arange(int(size[0])), "left").tolist()):
        carry = _bits(units[starts[:live] + k])
        for level, plane in enumerate(planes):
            if waiting[level] is None:
                waiting[level] = carry
                break
            first, waiting[level] = waiting[level], None
            plane, some = plane[:len(first)], len(carry)
            both = plane & first
            plane ^= first
            both[:some] |= plane[:some] & carry
            plane[:some] ^= carry
            carry = both
    for level, carry in enumerate(waiting):
        if carry is not None:
            for plane in planes[level:]:
                both = plane[:len(carry)] & carry
                plane[:len(carry)] ^= carry
                carry = both
    more = np.zeros((len(n), WORDS64), np.uint64)
    same = ~more
    for k in range(len(planes) - 1, -1, -1):  # compare the counters with half of n
        half = np.where((size // 2 >> k) & 1, ~_U(0), _U(0))[:, None]
        more |= same & planes[k] & ~half
        same &= ~(planes[k] ^ half)
    out = np.empty_like(more)
    out[order] = more
    return out


def simhashes(words: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """512-bit SimHash of each line's distinct units as eight 64-bit numbers, shape (lines, 8).

    Each unit counts once: a separator or a word that fills a line must not decide all its bits.
    """
    out = np.zeros((len(bounds) - 1, WORDS64), np.uint64)
    for low in range(0, len(out), _LINES_AT_ONCE):
        own = bounds[low:low + _LINES_AT_ONCE + 1]
        line = np.repeat(np.arange(len(own) - 1, dtype=np.uint64), np.diff(own))
        keys = np.sort(line << _U(48) | words[own[0]:own[-1]] >> _U(16))
        keys = keys[np.r_[True, keys[1:] != keys[:-1]][:len(keys)]]
        places = np.searchsorted(keys, np.arange(len(own), dtype=np.uint64) << _U(48))
        n, units = np.diff(places), mix(keys & _U((1 << 48) - 1))
        short = np.flatnonzero((n > 0) & (n < _LONG_LINE))
        if len(short):
            out[low + short] = _majority(units, places[short], n[short])
        for k in np.flatnonzero(n >= _LONG_LINE).tolist():
            count = np.zeros(64 * WORDS64, np.int64)
            for a in range(places[k], places[k + 1], 4096):
                part = units[a:min(a + 4096, places[k + 1])]
                count += np.unpackbits(_bits(part).view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
            out[low + k] = np.packbits(count > n[k] // 2, bitorder="little").view(np.uint64)
    return out


def block_keys(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each SimHash its blocks, numbered, and 32 bits from another part beside each, shapes (lines, BLOCKS)."""
    shifts = (np.arange(3) * BLOCK_BITS).astype(np.uint64)
    blocks = (hashes[:, :, None] >> shifts) & _U((1 << BLOCK_BITS) - 1)
    keys = blocks.reshape(len(hashes), BLOCKS) | np.arange(BLOCKS, dtype=np.uint64) << _U(BLOCK_BITS)
    checks = np.repeat(np.roll(hashes, 4, axis=1), 3, axis=1) & _U((1 << 32) - 1)
    return keys.astype(np.uint32), checks.astype(np.uint32)


def _split_keys(keys: np.ndarray, bucket_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of each block key and what is left of the key in it, both from a permutation of all keys."""
    left = KEY_BITS - bucket_bits
    spread = keys.astype(np.uint64) * _U(0x9E3779B97F4A7C15) & _U((1 << KEY_BITS) - 1)
    return (spread >> _U(left)).astype(np.int32), (spread & _U((1 << left) - 1)).astype(_left_type(bucket_bits))


def _left_type(bucket_bits: int) -> type:
    return np.uint16 if KEY_BITS - bucket_bits <= 16 else np.uint32


def _split(column: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """All lines of a text column, the row of each, and its number in the row."""
    lists = pc.split_pattern(pc.fill_null(column.cast(pa.large_string()), ""), "\n")
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    rows = np.repeat(np.arange(len(sizes)), sizes)
    return lists.flatten(), rows, np.arange(len(rows)) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _slices(batch: pa.RecordBatch, texts: pa.Array, most: int = 1 << 20) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Parts of a batch and its texts of about ``most`` bytes of text."""
    size = 0
    start = 0
    for k, n in enumerate(pc.binary_length(texts).to_pylist()):
        size += n or 0
        if size >= most:
            yield batch.slice(start, k + 1 - start), texts.slice(start, k + 1 - start)
            start, size = k + 1, 0
    if start < batch.num_rows:
        yield batch.slice(start), texts.slice(start)


def _unit_lines(lines: pa.Array) -> pa.Array:
    """The lines with blanks between their units."""
    data, offsets = text_buffers(lines)
    low = int(offsets[0])
    data = data[low:int(offsets[-1])]
    wide = np.flatnonzero(_MAY_BE_BLANKLESS[data])
    wide = wide[(data[wide] != 0xE2) | (data[np.minimum(wide + 1, len(data) - 1)] >= 0xBA)]  # not the punctuation below U+2E80
    whole = pc.less(pc.find_substring(lines, " "), 0).to_numpy(zero_copy_only=False)
    changed, made = [], []
    for k in np.union1d(np.searchsorted(offsets - low, wide, "right") - 1, np.flatnonzero(whole & (np.diff(offsets) > 1))).tolist():
        x = before = lines[k].as_py()
        if not x.isascii() and _BLANKLESS.search(x):
            x = _BLANKLESS.sub(r" \1 ", x)
        if " " not in x and len(found := _WORD.findall(x)) == 1:
            x = " ".join(found[0])
        if x != before:
            changed.append(k)
            made.append(x)
    if not changed:
        return lines
    place = np.arange(len(lines))
    place[changed] = len(lines) + np.arange(len(made))
    return pa.concat_arrays([lines, pa.array(made, pa.large_string())]).take(pa.array(place))


def _line_hashes(lines: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each line's units, and their number."""
    runs = [(sequence_hashes(words, bounds), np.diff(bounds)) for _, words, bounds in word_runs(_unit_lines(lines))]
    return np.concatenate([np.empty(0, np.uint64), *[h for h, _ in runs]]), np.concatenate([np.empty(0, np.int64), *[n for _, n in runs]])


_LINES = "doc_id long, line int, h long"


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first occurrence in its row of each line with words, and a row with line -1 for each row that repeats one."""
    for batch, texts in (part for b in batches for part in _slices(b, b.column(1))):
        ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
        lines, rows, numbers = _split(texts)
        hashes, n = _line_hashes(lines)
        chosen = np.flatnonzero(n)
        _, first = np.unique(mix(hashes[chosen]) + rows[chosen].astype(np.uint64), return_index=True)
        again = np.unique(rows[np.delete(chosen, first)])
        chosen = chosen[np.sort(first)]
        if len(chosen):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.r_[ids[rows[chosen]], ids[again]]),
                 pa.array(np.r_[numbers[chosen], np.full(len(again), -1)].astype(np.int32)),
                 pa.array(np.r_[hashes[chosen].view(np.int64), np.zeros(len(again), np.int64)])], [f.split()[0] for f in _LINES.split(", ")])


def _block_lists(bucket_bits: int):
    """The blocks of each task's fuzzy lines, packed by bucket: rest of the key, line hash and check bits."""
    def packed(ids: np.ndarray, hashes: np.ndarray) -> Iterator[pa.RecordBatch]:
        every_key, every_check = block_keys(hashes)
        for low in range(0, BLOCKS, 6):
            keys, checks = every_key[:, low:low + 6].ravel(), every_check[:, low:low + 6].ravel()
            bucket, keys = _split_keys(keys, bucket_bits)
            order = np.argsort(bucket.astype(np.uint16) if bucket_bits <= 16 else bucket, kind="stable")
            bucket, keys, checks, own = bucket[order], keys[order], checks[order], ids[order // 6]
            starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
            cut = list(zip(starts.tolist(), [*starts[1:].tolist(), len(bucket)]))
            yield pa.RecordBatch.from_arrays([pa.array(bucket[starts]), *[pa.array([x[a:b].tobytes() for a, b in cut], pa.binary())
                                                                        for x in (keys, own, checks)]], ["bucket", "keys", "ids", "checks"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        held: list[tuple[np.ndarray, np.ndarray]] = []
        waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # line hashes, units, units of each line
        size = 0

        def hashed() -> None:
            ids, units, sizes = map(np.concatenate, zip(*waiting))
            held.append((ids, simhashes(units, np.r_[0, np.cumsum(sizes)])))
            waiting.clear()

        for batch, texts in (part for b in batches for part in _slices(b, b.column(0))):
            for _, words, bounds in word_runs(_unit_lines(_split(texts)[0])):
                n, hashes = np.diff(bounds), sequence_hashes(words, bounds)
                some = np.flatnonzero(n >= MIN_FUZZY)
                new = []
                for k, h in zip(some.tolist(), hashes[some].tolist()):
                    if h not in seen:
                        seen.add(h)
                        new.append(k)
                if new:
                    stays = np.zeros(len(n), bool)
                    stays[new] = True
                    waiting.append((hashes[stays], words[np.repeat(stays, n)], n[stays]))
                    size += len(waiting[-1][1])
                if size >= _WAITING:
                    hashed()
                    size = 0
            if len(seen) >= _FLUSH:
                if waiting:
                    hashed()
                    size = 0
                yield from packed(*map(np.concatenate, zip(*held)))
                seen.clear()
                held.clear()
        if waiting:
            hashed()
        if held:
            yield from packed(*map(np.concatenate, zip(*held)))
    return run


def candidate_lists(keys: np.ndarray, ids: np.ndarray, checks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Signature and member of each list to search: the members of a block's list that are connected by check bits
    that differ little, one row for each; lists of more than ``LONG_LIST`` members as a whole. The signature is a
    hash of the members, so lists of the same lines, which most of two versions' blocks make, are one."""
    order = np.argsort(keys.astype(np.uint64) << _U(64 - KEY_BITS) | ids >> _U(KEY_BITS))  # equal rows come together
    keys, ids, checks = keys[order], ids[order], checks[order]
    new = np.r_[True, (keys[1:] != keys[:-1]) | (ids[1:] != ids[:-1])][:len(keys)]
    keys, ids, checks = keys[new], ids[new], checks[new]
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]][:len(keys)])
    sizes = np.diff(np.r_[starts, len(keys)])
    size = np.repeat(sizes, sizes)
    group = np.where(size > LONG_LIST, np.repeat(starts, sizes), np.arange(len(keys)))
    at = np.flatnonzero((size > 1) & (size <= LONG_LIST))
    for step in range(1, LONG_LIST):
        at = at[at + step < len(keys)]
        at = at[keys[at] == keys[at + step]]
        if not len(at):
            break
        near = at[np.bitwise_count(checks[at] ^ checks[at + step]) <= CHECK_BITS]
        while len(near := near[group[near] != group[near + step]]):
            a, b = group[near], group[near + step]
            np.minimum.at(group, np.maximum(a, b), np.minimum(a, b))
            while (group[group] != group).any():
                group = group[group]
    some = np.flatnonzero(np.bincount(group, minlength=len(keys))[group] > 1)
    if not len(some):
        return ids[some], ids[some]
    some = some[np.argsort(group[some], kind="stable")]
    group, ids = group[some], ids[some]
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    sizes = np.diff(np.r_[starts, len(ids)])
    return np.repeat(mix(np.add.reduceat(mix(ids), starts) + sizes.astype(np.uint64)), sizes), ids


def _candidates(bucket_bits: int):
    kinds = (_left_type(bucket_bits), np.uint64, np.uint32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, ...]]] = {}
        for batch in batches:
            for bucket, *data in zip(*[c.to_pylist() for c in batch.columns]):
                held.setdefault(bucket, []).append(tuple(np.frombuffer(d, t) for d, t in zip(data, kinds)))
        for bucket in sorted(held):
            keys, ids, checks = (np.concatenate(c) for c in zip(*held.pop(bucket)))
            sigs, ids = candidate_lists(keys.astype(np.uint32) | np.uint32(bucket << KEY_BITS - bucket_bits), ids, checks)
            if len(sigs):
                yield pa.RecordBatch.from_arrays([pa.array(sigs.view(np.int64)), pa.array(ids.view(np.int64))], ["sig", "id"])
    return run


def unit_bitmaps(words: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A bitmap of each line's units, the k-th occurrence of one being a unit of its own, shape (lines, 8).

    Every bit that only one of two lines has is at least one unit that only this line has.
    """
    bits = np.zeros((len(bounds) - 1, 64 * WORDS64), np.uint8)
    line = np.repeat(np.arange(len(bits)), np.diff(bounds))
    order = np.lexsort((words, line))
    line, words = line[order], words[order]
    first = np.flatnonzero(np.r_[True, (line[1:] != line[:-1]) | (words[1:] != words[:-1])][:len(line)])
    occurrence = np.arange(len(line)) - np.repeat(first, np.diff(np.r_[first, len(line)]))
    bits[line, (mix(words + mix(occurrence.astype(np.uint64))) % _U(64 * WORDS64)).astype(np.int64)] = 1
    return np.packbits(bits, axis=1, bitorder="little").view(np.int64)


# What a link needs of the units' numbers and bitmaps: at least nine tenths of the longer line's units in common.
_MAY_LINK = " and ".join(f"10 * ({x}n - ({' + '.join(f'bit_count({x}bits[{k}] & ~{y}bits[{k}])' for k in range(WORDS64))})) >= 9 * greatest(n, o_n)"
                         for x, y in (("", "o_"), ("o_", "")))


def _unit_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The unit hashes of each text's wanted lines (their numbers and hashes), their number and bitmap."""
    for whole in batches:
        for batch, texts in _slices(whole, whole.column(0)):
            picked, expected = [], []
            for text, numbers, hashes in zip(texts.to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                own = (text or "").split("\n")
                for k, h in zip(numbers, hashes):
                    if k < len(own):  # another row may have the same doc_id
                        picked.append(own[k])
                        expected.append(h)
            expected = np.array(expected, np.int64)
            for at, words, bounds in word_runs(_unit_lines(pa.array(picked, pa.large_string()))):
                hashes = sequence_hashes(words, bounds).view(np.int64)
                chosen = hashes == expected[at:at + len(hashes)]
                if chosen.any():
                    n = np.diff(bounds)
                    own, ends = words[np.repeat(chosen, n)], np.r_[0, np.cumsum(n[chosen])]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(hashes[chosen]),
                         pa.array([own[a:b].tobytes() for a, b in zip(ends, ends[1:])], pa.binary()), pa.array(n[chosen].astype(np.int64)),
                         pa.array(unit_bitmaps(own, ends).tolist(), pa.list_(pa.int64()))], ["id", "units", "n", "bits"])


def edit_distance(a: list[int], b: list[int]) -> int:
    """Levenshtein distance of two sequences by bit-parallel rows (one big integer holds a column)."""
    while a and b and a[-1] == b[-1]:
        a, b = a[:-1], b[:-1]
    start = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    a, b = a[start:], b[start:]
    if not a or not b:
        return len(a) + len(b)
    places: dict[int, int] = {}
    for k, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << k
    every, top = (1 << len(a)) - 1, 1 << len(a) - 1
    up, down, score = every, 0, len(a)
    for y in b:
        equal = places.get(y, 0)
        same = (((equal & up) + up) ^ up) | equal | down
        right, left = down | ~(same | up) & every, up & same
        score += bool(right & top) - bool(left & top)
        right = right << 1 | 1
        down = right & same & every
        up = (left << 1 | ~(same | right)) & every
    return score


def similar(a: list[int], b: list[int]) -> bool:
    """Whether two lines' units have edit similarity ``MIN_SIMILARITY``."""
    longer = max(len(a), len(b))
    most = (1 - MIN_SIMILARITY) * longer + 1e-9
    # units that only one has need an edit each
    return longer - (Counter(a) & Counter(b)).total() <= most and edit_distance(a, b) <= most


def _edits_at_most(a: np.ndarray, b: np.ndarray) -> int:
    """An upper bound of the edit distance: no more units differ in place, or between the first and the last that do."""
    size = min(len(a), len(b))
    differ = np.flatnonzero(a[:size] != b[:size])
    if len(a) == len(b):
        return len(differ)
    if not len(differ):
        return max(len(a), len(b)) - size
    back = np.flatnonzero(a[len(a) - size:] != b[len(b) - size:])
    same = size - 1 - int(back[-1]) if len(back) else size  # units at the end that agree
    return max(len(a), len(b)) - min(size, int(differ[0]) + same)


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        link = []
        for pair in zip(batch.column(2), batch.column(3)):
            a, b = (np.frombuffer(v.as_buffer(), np.uint64) for v in pair)
            link.append(_edits_at_most(a, b) <= (1 - MIN_SIMILARITY) * max(len(a), len(b)) + 1e-9 or similar(a.tolist(), b.tolist()))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.nulls(len(link), pa.int64()),
                                          pa.array(link, pa.bool_())], ["a", "b", "shared", "link"])


def line_groups(docs: DataFrame, lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(h, component)`` of the lines of ``docs(doc_id, text)`` that are linked with other normal forms, and ``(h, at,
    rank)`` with the first occurrence of these and other candidates; ``lines`` lists the documents of each."""
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bucket_bits = min(18, max(10, (4 * partitions - 1).bit_length()))  # 16 bits of a key are left, or fewer
    lists = docs.select("text").mapInArrow(_block_lists(bucket_bits), "bucket int, keys binary, ids binary, checks binary")
    postings = shared_table(lists.repartition(partitions, "bucket").mapInArrow(_candidates(bucket_bits), "sig long, id long").distinct(), "postings")

    nodes = shared_table(postings.select(F.col("id").alias("h")).distinct(), "nodes")
    # the line of most documents is the pivot of its buckets: versions of it are near to it rather than to each other
    forms = shared_table(rows_in(lines, ["h"], nodes, unique=True).groupBy("h")
                         .agg(F.min(F.struct("doc_id", "line")).alias("at"), (-F.count(F.lit(1))).alias("rank")), "forms")
    wanted = forms.groupBy("at.doc_id").agg(F.collect_list(F.struct("at.line", "h")).alias("own"))  # a document's own lines
    wanted = shared_table(wanted.select("doc_id", F.col("own.line").alias("numbers"), F.col("own.h").alias("hashes")), "wanted")
    texts = (flag_rows(docs, ["doc_id"], wanted, "maybe").filter("maybe").select("doc_id", "text").join(wanted, "doc_id")
             .select("text", "numbers", "hashes"))
    units = shared_table(texts.mapInArrow(_unit_lists, "id long, units binary, n long, bits array<long>")
                         .groupBy("id").agg(*[F.first(c).alias(c) for c in ("units", "n", "bits")]), "units")

    def verify(pairs: DataFrame) -> DataFrame:
        both = (pairs.join(units.select(F.col("id").alias("a"), F.col("units").alias("units_a"), "n", "bits"), "a")
                .join(units.select(F.col("id").alias("b"), F.col("units").alias("units_b"), F.col("n").alias("o_n"), F.col("bits").alias("o_bits")), "b")
                .filter(_MAY_LINK).select("a", "b", "units_a", "units_b"))
        return both.mapInArrow(_compared, "a long, b long, shared long, link boolean")

    one = F.lit(1).cast("long")
    members = postings.join(forms.select(F.col("h").alias("id"), "rank"), "id").select("sig", "id", one.alias("size"), "rank", one.alias("usable"))
    found, _ = links_from_buckets(members, verify, star_rounds=2, details=units.select("id", "n", "bits"), may_link=_MAY_LINK, alone=False)
    return found.withColumnRenamed("id", "h"), forms


def repeated_lines(docs: DataFrame) -> DataFrame:
    """``(doc_id, numbers, hashes)``: each document's lines that occur earlier, in another document or another form,
    and line -1 if it repeats one of its own."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("doc_id is not null")
    with small_batches(docs.sparkSession):
        described = shared_table(docs.mapInArrow(_described, _LINES), "lines", "zstd")
    lines = described.filter("line >= 0")
    groups, forms = line_groups(docs, lines)
    linked = shared_table(forms.select("h", F.col("at.doc_id").alias("doc_id"), F.col("at.line").alias("line")).join(groups, "h"), "linked")
    heads = linked.groupBy("component").agg(F.min(F.struct("doc_id", "line", "h")).alias("head"))
    keeps = linked.join(heads, "component").select("h", F.col("head.doc_id").alias("keep_doc"), F.col("head.h").alias("keep_h"))
    copies = lines.groupBy("h").agg(F.min("doc_id").alias("keep_doc"), F.max("doc_id").alias("last")).filter("keep_doc < last")
    copies = copies.join(linked.select("h"), "h", "left_anti").select("h", "keep_doc", F.col("h").alias("keep_h"))
    keeps = shared_table(keeps.unionByName(copies), "keeps")
    gone = (flag_rows(lines, ["h"], keeps, "maybe").filter("maybe").drop("maybe").join(keeps, "h")
            .filter("doc_id <> keep_doc or h <> keep_h").select("doc_id", "line", "h"))
    gone = gone.unionByName(described.filter("line < 0").select("doc_id", "line", "h"))
    own = gone.groupBy("doc_id").agg(F.collect_list(F.struct("line", "h")).alias("own"))  # at most a document's own lines
    return own.select("doc_id", F.col("own.line").alias("numbers"), F.col("own.h").alias("hashes"))


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows without the lines that go, and how many lines went and how many with words are left."""
    for whole in batches:
        for batch, texts in _slices(whole, whole.column(0).field("text")):
            lines, rows, _ = _split(texts)
            first = np.r_[np.searchsorted(rows, np.arange(batch.num_rows)), len(lines)]
            stays = np.ones(len(lines), bool)
            given = pc.fill_null(pc.list_value_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(batch.num_rows), given)
            numbers, hashes = (c.flatten().to_numpy(zero_copy_only=False) for c in batch.columns[1:])
            repeats = np.zeros(batch.num_rows, bool)  # rows that must be looked through as a whole
            repeats[row[numbers < 0]] = True
            listed = ~repeats[row] & (numbers < np.diff(first)[row])  # another row may have the same doc_id
            at, expected = first[row[listed]] + numbers[listed], hashes[listed]
            found, _ = _line_hashes(lines.take(pa.array(at)))
            stays[at[found.view(np.int64) == expected]] = False
            every = np.flatnonzero(repeats[rows])
            if len(every):
                seen = set(zip(row[numbers >= 0].tolist(), hashes[numbers >= 0].tolist()))
                found, n = _line_hashes(lines.take(pa.array(every)))
                for i, key, some in zip(every.tolist(), zip(rows[every].tolist(), found.view(np.int64).tolist()), n.tolist()):
                    if some:
                        stays[i] = key not in seen
                        seen.add(key)
            data, offsets = text_buffers(lines)
            words = np.r_[0, np.cumsum(~IS_SPACE[data])]
            worded = np.bincount(rows[stays & (words[offsets[1:]] > words[offsets[:-1]])], minlength=batch.num_rows)
            removed = np.bincount(rows[~stays], minlength=batch.num_rows)
            made = texts.to_pylist()
            for k in np.flatnonzero(removed).tolist():
                own = np.flatnonzero(stays[first[k]:first[k + 1]]) + first[k]
                made[k] = "\n".join(lines.take(pa.array(own)).to_pylist()) if worded[k] else ""
            fields = list(batch.schema.field(0).type)
            columns = [batch.column(0).field(f.name) for f in fields]
            for k, f in enumerate(fields):
                if f.name == "text":
                    columns[k] = pa.array(made, f.type)
                elif f.name == "n_chars":
                    length = pc.utf8_length(pa.array(made, pa.string())).cast(f.type)
                    columns[k] = pc.if_else(pa.array(removed > 0), length, columns[k])
            yield pa.RecordBatch.from_arrays([pa.StructArray.from_arrays(columns, fields=fields), pa.array(removed), pa.array(worded)],
                                             ["row", "removed", "left"])


def deduplicated(docs: DataFrame) -> DataFrame:
    """``row, removed, left``: each row of ``docs`` with deduplicated ``text`` (``n_chars``, if there, follows it), and
    the numbers of lines that went and of lines with words that stayed."""
    gone = shared_table(repeated_lines(docs), "gone", "zstd")
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("doc_id"))
    flagged = flag_rows(packed, ["doc_id"], gone, "maybe")
    worded = F.regexp_count(F.coalesce("row.text", F.lit("")), F.lit(_LINE_WITH_WORD)).cast("long")
    sure = flagged.filter("not maybe or maybe is null").select("row", F.lit(0).cast("long").alias("removed"), worded.alias("left"))
    joined = flagged.filter("maybe").join(gone, "doc_id", "left").select("row", "numbers", "hashes")
    schema = T.StructType([T.StructField("row", packed.schema["row"].dataType), T.StructField("removed", T.LongType()),
                           T.StructField("left", T.LongType())])
    with small_batches(docs.sparkSession):
        return sure.unionByName(joined.mapInArrow(_kept, schema))


def line_report(docs: DataFrame) -> DataFrame:
    """``doc_id, n_removed, n_left, text``: each document without its repeated lines."""
    out = deduplicated(docs.select("doc_id", "text"))
    return out.select("row.doc_id", F.col("removed").alias("n_removed"), F.col("left").alias("n_left"), "row.text")


def without_repeated_lines(docs: DataFrame) -> DataFrame:
    """The documents without repeated lines; those that lost all their lines with words go."""
    return deduplicated(docs).filter("not (removed > 0 and left = 0)").select("row.*")
