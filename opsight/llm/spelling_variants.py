"""Spelling variants by a variable-length gram index.

Words are runs of Latin letters, lower-cased from A to Z, of at least ``MIN_CHARS`` code points and
``MIN_COUNT`` occurrences. Two words are near if one inserted, deleted or replaced code point turns one
into the other. A word's form is its near word of most occurrences (ties: smallest in code-point order)
if that has at least twice as many; its root is the last word on the way from form to form.

The index is a dictionary of variable-length grams, pruned by frequency: from each place of a word
(between two end marks) a gram of two code points grows while it is among the dictionary's frequent
grams, up to a limit that follows the word's length. Whether a gram ends depends on its own code points
only, so one edit affects no gram but those that cover its place; ``affected`` is the most that any place
has. Of a word's grams, rarest first, the first two that an edit leaves whole are therefore among the
first ``affected`` + 2, and they are the same two in the near word: the lists of all pairs of these are
merged by a join, and a pair of words is verified (and kept once) at the list of exactly those two.

NULL and empty texts have no words, tables without words give an empty result; documents without a
doc_id count under the id ``None``; repeated rows count as often as they occur. Other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsight.llm.common import shared_table

MIN_CHARS = 5
MIN_COUNT = 3
SHORTEST, LONGEST = 2, 8  # code points of a gram
FREQUENT = 32  # a gram of more words grows
# Entries of the gram dictionary at most (some 10 MB): with more frequent grams, the bound of frequency rises.
DICTIONARY = 1 << 17
MISSPELT = 97  # the contract's made-up misspellings: one of so many (document, run) pairs
_FLUSH = 1 << 18
_RUN = re.compile("[a-zÀ-ÿ]+")


def document_words(doc_id: int | None, text: str | None) -> dict[str, int]:
    """Occurrences of each run of a document, where the contract's checksum picks it without one code point."""
    start = zlib.crc32(f"{doc_id}:".encode())
    found: Counter = Counter()
    for run, n in Counter(_RUN.findall((text or "").encode().lower().decode())).items():
        h = zlib.crc32(run.encode(), start)
        if h % MISSPELT == 0:
            k = h % len(run)
            run = run[:k] + run[k + 1:]
        found[run] += n
    return found


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter = Counter()

    def rows() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            for word, n in document_words(doc_id, text.as_py()).items():
                if len(word) >= MIN_CHARS:
                    held[word] += n
            if len(held) >= _FLUSH:
                yield rows()
                held.clear()
    if held:
        yield rows()


def word_counts(docs: DataFrame) -> DataFrame:
    """``(word, n)``: the words and their occurrences."""
    counted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_counted, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= MIN_COUNT)


def gram_limit(n: int) -> int:
    """Code points of a gram at most, for pairs whose shorter word has ``n``: two grams beside an edit always remain."""
    return min(LONGEST, max(3, (n + 2) // 2))


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter = Counter()

    def rows() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["gram", "n"])

    for batch in batches:
        for word in batch.column(0).to_pylist():
            w = f"^{word}$"
            for size in range(SHORTEST, LONGEST):  # the longest grams cannot grow
                held.update([w[p:p + size] for p in range(len(w) - size + 1)])
            if len(held) >= _FLUSH:
                yield rows()
                held.clear()
    if held:
        yield rows()


def gram_dictionary(words: DataFrame) -> dict[str, int]:
    """The frequent grams with the number of places where they occur: ``DICTIONARY`` grams at most."""
    grams = (words.select("word").mapInArrow(_grams, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))
             .filter(F.col("n") > FREQUENT))
    grams = shared_table(grams, "grams")
    levels = sorted(((r.level, r["count"]) for r in grams.groupBy(F.expr("cast(floor(log2(n) * 4) as int)").alias("level")).count().collect()), reverse=True)
    total, least = 0, None
    for level, n in levels:  # the most frequent grams, as many as the dictionary holds
        if total + n > DICTIONARY:
            break
        total, least = total + n, level
    kept = grams.filter(F.expr("cast(floor(log2(n) * 4) as int)") >= least) if least is not None else grams.limit(0)
    return {r.gram: r.n for r in kept.collect()}  # DICTIONARY rows at most


def decompose(word: str, limit: int, frequent: dict[str, int]) -> list[tuple[int, int]]:
    """Start and end of each gram of ``^word$``."""
    w = f"^{word}$"
    out = []
    for p in range(len(w) - SHORTEST + 1):
        end, last = p + SHORTEST, min(len(w), p + limit)
        while end < last and w[p:end] in frequent:
            end += 1
        out.append((p, end))
    return out


def affected(grams: list[tuple[int, int]]) -> int:
    """The most grams that cover one place: what one edit can change."""
    most = first = 0
    for k, (p, _) in enumerate(grams):  # ends never fall, as every part of a frequent gram is frequent
        while grams[first][1] <= p:
            first += 1
        most = max(most, k - first + 1)
    return most


def postings_of(word: str, frequent: dict[str, int]) -> Iterator[tuple[str, bool, int, int, int]]:
    """Key, whether it is for partners of this length or more, the places of the two grams, and the places that
    all grams before the second one cover."""
    n, w = len(word), f"^{word}$"
    for limit in {gram_limit(n), gram_limit(max(MIN_CHARS, n - 1))}:
        grams = decompose(word, limit, frequent)
        order = sorted((frequent.get(w[p:e], 0).bit_length(), zlib.crc32(w[p:e].encode()), w[p:e], p, e) for p, e in grams)
        order = order[:affected(grams) + 2]
        for i, j in combinations(range(len(order)), 2):
            low, high = 0, len(w)
            for k in range(j):
                if k != i:
                    low, high = max(low, order[k][3]), min(high, order[k][4])
            if low < high:  # else no single edit changes all those
                (_, _, g, p, e), (_, _, h, q, f) = order[i], order[j]
                yield f"{limit} {g} {h}", limit == gram_limit(n), p << 31 | e, q << 31 | f, low << 31 | high


def _postings(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = shared.value
        for batch in batches:
            for low in range(0, batch.num_rows, 4096):
                part = batch.slice(low, 4096)
                rows = [(key, word, n, *places) for word, n in zip(part.column(0).to_pylist(), part.column(1).to_pylist())
                        for key, *places in postings_of(word, frequent)]
                if rows:
                    kinds = (pa.string(), pa.string(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64())
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                                                     ["key", "word", "n", "own", "one", "two", "skips"])
    return run


def near_pairs(words: DataFrame) -> DataFrame:
    """``(word, n, other, other_n)``: each pair of near words once, ``other`` no longer than ``word``."""
    frequent = words.sparkSession.sparkContext.broadcast(gram_dictionary(words))
    rows = (words.select("word", "n").mapInArrow(_postings(frequent), "key string, word string, n long, own boolean, one long, two long, skips long")
            .withColumn("key", F.xxhash64("key")))
    rows = shared_table(rows, "postings")
    other = rows.toDF(*[c if c == "key" else f"o_{c}" for c in rows.columns])

    def start(c):
        return f"cast(shiftright({c}, 31) as int)"

    def end(c):
        return f"cast({c} & 2147483647 as int)"

    def same(k):  # both agree in their first k code points, the mark included
        return f"left(word, {k} - 1) = left(o_word, {k} - 1)"

    # a gram left of the edit keeps its place, one on its right moves by the difference of the lengths
    whole = " and ".join(
        f"case when {start(c)} = {start('o_' + c)} and {same(end(c))} then true "
        f"else {start(c)} = {start('o_' + c)} + length(word) - length(o_word) and not {same(start(c))} end" for c in ("one", "two"))
    pairs = rows.join(other, "key").filter("o_own and (length(word) = length(o_word) and word < o_word or length(word) = length(o_word) + 1) "
                                           "and levenshtein(word, o_word, 1) = 1")
    # the grams skipped cover the edit: the first difference lies in all of them
    first = f"{same(start('skips'))} and not {same(end('skips'))}"
    return pairs.filter(f"{first} and {whole}").select("word", "n", F.col("o_word").alias("other"), F.col("o_n").alias("other_n"))


def with_roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` from ``(word, form)``: forms are followed by doubling steps; counts double at each, so it ends."""
    steps = shared_table(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        after = shared_table(steps.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                                        F.col("next").isNotNull().alias("moved")), "roots")
        steps = after.select("word", "root")
        if after.filter("moved").limit(1).count() == 0:
            return steps


def spelling_variants(docs: DataFrame) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for each word of ``docs(doc_id, text)``."""
    words = shared_table(word_counts(docs), "words")
    pairs = near_pairs(words)
    both = pairs.unionByName(pairs.select(F.col("other").alias("word"), F.col("other_n").alias("n"),
                                          F.col("word").alias("other"), F.col("n").alias("other_n")))
    near = (both.groupBy("word", "n").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("m"), "other")).alias("best"))
            .select("word", "n_near", F.expr("if(-best.m >= 2 * n, best.other, null)").alias("form"),
                    F.expr("if(-best.m >= 2 * n, -best.m, null)").alias("form_n")))
    near = shared_table(near, "near")
    roots = with_roots(near.filter("form is not null"))
    return (words.join(near, "word", "left").join(roots, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n"))
