"""SentencePiece BPE encoding by a merge-type prefix table.

For each prefix of a normalised word one token is stored: the last token of the prefix's encoding. An
Aho-Corasick automaton over the vocabulary gives the pieces that end at a position; a piece is the last
token exactly if it is compatible with the last token of the prefix before it, that is, if merging the
two pieces' characters by rank yields these two pieces again. The ids are recovered backwards from the
end. A sequence is the BPE encoding when every neighbouring pair is compatible, so no merge queue over
the word is needed.

Texts are cut where no merge can cross (before a run of spaces that follows other characters, and
around characters outside the vocabulary), and words are remembered within a task. The model file is a
parameter; its vocabulary is read with the sentencepiece library, which does no encoding here.

NULL is an empty text, whose ids are the end id alone. Characters outside the vocabulary become their
UTF-8 byte pieces.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
REMEMBERED = 150_000  # words kept by a Python worker in each of two generations, of at most 48 characters each
_ENCODERS: dict[str, PrefixTableEncoder] = {}


def default_model() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


class PrefixTableEncoder:
    """Encodes and decodes with a SentencePiece BPE model that has byte pieces and identity normalisation."""

    def __init__(self, model_file: str):
        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.pieces = [model.id_to_piece(k) for k in range(model.get_piece_size())]
        special = [model.is_control(k) or model.is_unknown(k) or model.is_byte(k) or model.is_unused(k)
                   for k in range(len(self.pieces))]
        self.byte_ids = {int(p[3:5], 16): k for k, p in enumerate(self.pieces) if model.is_byte(k)}
        self.id_bytes = {k: b for b, k in self.byte_ids.items()}
        self.end_id, self.unknown_id = model.eos_id(), model.unk_id()
        ids = {p: k for k, p in enumerate(self.pieces) if not special[k]}
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in ids):
            raise ValueError("pieces that cross a word boundary are not supported")
        order = {x: r for r, x in enumerate(sorted({model.get_score(k) for k in ids.values()}, reverse=True))}
        self.ranks = {p: order[model.get_score(k)] for p, k in ids.items()}
        self.automaton = ahocorasick.Automaton()
        for piece, k in ids.items():
            self.automaton.add_word(piece, (len(piece), piece, k))
        self.automaton.make_automaton()
        self.alphabet = {c for p in self.ranks for c in p}
        # cuts that no piece crosses: at spaces, around new lines, and between a letter and such a sign
        pairs = {p[k:k + 2] for p in ids for k in range(len(p) - 1)}
        crossed = {p[1] for p in pairs if p[0].isalpha()}
        signs = "".join(re.escape(c) for c in sorted(self.alphabet) if c.isascii() and not c.isalnum() and c not in crossed)
        line = "" if "\n" in self.alphabet else "\n"
        ends = f"(?=[{SPACE}{line}])|$" + (rf"|(?<=[^\W\d_])(?=[{signs}])" if signs else "")
        self.words = re.compile(f"{SPACE}*[^{SPACE}{line}]+?(?:{ends})|{SPACE}+" + (f"|{line}" if line else ""))
        self.control = {k for k, s in enumerate(special) if s and k not in self.id_bytes and k != self.unknown_id}
        self._compatible: dict[tuple[str, str], bool] = {}
        self._known: dict[str, tuple[int, str, str]] = {}
        self._older: dict[str, tuple[int, str, str]] = {}  # entries before the last change of generation

    def _merged(self, text: str) -> list[str]:
        """Pieces of a short string by merging the best-ranked neighbours, the leftmost first."""
        parts, rank, never = list(text), self.ranks.get, len(self.ranks)
        ranks = [rank(a + b, never) for a, b in zip(parts, parts[1:])]
        while ranks:
            best = min(ranks)
            if best == never:
                break
            k = ranks.index(best)
            parts[k] += parts.pop(k + 1)
            ranks.pop(k)
            if k:
                ranks[k - 1] = rank(parts[k - 1] + parts[k], never)
            if k < len(ranks):
                ranks[k] = rank(parts[k] + parts[k + 1], never)
        return parts

    def compatible(self, left: str, right: str) -> bool:
        """Whether the encoding of ``left + right`` is these two pieces (or ``right`` alone after nothing)."""
        key = (left, right)
        known = self._compatible.get(key)
        if known is None:
            if len(self._compatible) >= 2 * REMEMBERED:
                self._compatible.clear()
            known = self._compatible[key] = self._merged(left + right) == ([left, right] if left else [right])
        return known

    def encode_word(self, word: str) -> list[int]:
        """Ids of a normalised string by its prefix table."""
        n, compatible = len(word), self._compatible.get
        last: list[tuple[int, str, int] | None] = [None] * (n + 1)
        for end, match in self.automaton.iter(word):  # all pieces that end here, longest first
            end += 1
            if last[end] is not None:
                continue
            start = end - match[0]
            piece = match[1]
            if start == 0:
                if self.compatible("", piece):
                    last[end] = match
            else:
                before = last[start]
                if before is not None:
                    fits = compatible((before[1], piece))
                    if fits or (fits is None and self.compatible(before[1], piece)):
                        last[end] = match
                else:  # the prefix before ends in a character outside the vocabulary
                    if word[start - 1] not in self.alphabet and self.compatible("", piece):
                        last[end] = match
        ids: list[int] = []
        at = n
        while at:
            match = last[at]
            if match is None:
                ids += [self.byte_ids.get(b, self.unknown_id) for b in reversed(word[at - 1].encode("utf-8", "surrogatepass"))]
                at -= 1
            else:
                ids.append(match[2])
                at -= match[0]
        ids.reverse()
        return ids

    def _entry(self, word: str) -> tuple[int, str, str]:
        """Number of ids, ids as text (each followed by a space), and decoded text of a word. A word holds
        whole characters, so its byte pieces are decoded on their own."""
        entry = self._older.get(word)
        if entry is None:
            ids = self.encode_word(word)
            entry = (len(ids), "".join([f"{k} " for k in ids]), self._plain(ids))
        if len(word) <= 48:
            if len(self._known) >= REMEMBERED:
                self._older, self._known = self._known, {}
            self._known[word] = entry
        return entry

    def normalised(self, text: str) -> str:
        """Spaces become the space symbol, and a text begins with one (identity normalisation)."""
        return SPACE + text.replace(" ", SPACE) if text else ""

    def encode(self, text: str) -> list[int]:
        return [k for w in self.words.findall(self.normalised(text)) for k in self.encode_word(w)] + [self.end_id]

    def _plain(self, ids: list[int]) -> str:
        out: list[str] = []
        pending = bytearray()
        for k in ids:
            if k in self.id_bytes:
                pending.append(self.id_bytes[k])
                continue
            if pending:
                out.append(_utf8(pending))
                pending = bytearray()
            if k not in self.control:
                out.append(" ⁇ " if k == self.unknown_id else self.pieces[k].replace(SPACE, " "))
        if pending:
            out.append(_utf8(pending))
        return "".join(out)

    def decode(self, ids: list[int]) -> str:
        """Pieces joined, byte runs as UTF-8 (each invalid byte one replacement character), the space symbol
        as a space without the first one."""
        first = next((k for k in ids if k not in self.control), None)
        text = self._plain(ids)
        return text[1:] if first is not None and self.pieces[first].startswith(SPACE) else text

    def digest(self, text: str) -> tuple[int, str, str]:
        """Number of ids with the end id, SHA-256 of the ids, SHA-256 of the decoded text."""
        known = self._known  # frequent words are found here or, after a change of generation, by _entry
        entries = [known.get(w) or self._entry(w) for w in self.words.findall(self.normalised(text))]
        listed = "".join([e[1] for e in entries]) + str(self.end_id)
        decoded = "".join([e[2] for e in entries])[1:]  # without the space that normalisation put first
        return (sum([e[0] for e in entries]) + 1, hashlib.sha256(listed.encode()).hexdigest(),
                hashlib.sha256(decoded.encode("utf-8", "surrogatepass")).hexdigest())


def _utf8(data: bytearray) -> str:
    """Valid UTF-8 sequences as characters, every other byte as one replacement character."""
    out, at = [], 0
    while at < len(data):
        for size in (1, 2, 3, 4):
            try:
                out.append(bytes(data[at:at + size]).decode())
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            size = 1
        at += size
    return "".join(out)


def encoder(model_file: str) -> PrefixTableEncoder:
    """The worker's encoder of a model, built once."""
    if model_file not in _ENCODERS:
        _ENCODERS[model_file] = PrefixTableEncoder(model_file)
    return _ENCODERS[model_file]


def _digests(model_file: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(model_file)
        for batch in batches:
            rows = [own.digest(text.as_py() or "") for text in batch.column(1)]
            columns = list(zip(*rows)) if rows else [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.string(), pa.string()))]],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return run


def _ids(model_file: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(model_file)
        for batch in batches:
            ids = pa.array([own.encode(text.as_py() or "") for text in batch.column(1)], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], ["doc_id", "ids"])
    return run


def encoded(docs: DataFrame, model_file: str | None = None) -> DataFrame:
    """``(doc_id, ids)``: the ids of each whole text with the end id."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return docs.mapInArrow(_ids(model_file or default_model()), "doc_id long, ids array<int>")


def token_report(docs: DataFrame, model_file: str | None = None) -> DataFrame:
    """Number of ids and digests of the ids and of the text decoded from them, for each whole text."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return docs.mapInArrow(_digests(model_file or default_model()),
                           "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
