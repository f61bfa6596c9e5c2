"""Byte-level BPE: texts to token ids and back, by a contiguous rank array.

A text is cut into words as the vocabulary's file says (by the tokenizers library's pre-tokenizer, so
that letters and digits are those of its Unicode version) and every word is merged here. A word's parts
lie side by side in ``parts``; ``ranks`` holds, for each boundary between two parts, the rank of their
merge. The array is scanned for its least rank (the leftmost on a tie), that boundary is deleted and the
ranks beside it are looked up anew, until no boundary has a rank. Words are short, so the scan is cheaper
than any queue; a word of more than ``SCANNED`` bytes (a line of a picture, a run of one letter) holds the
same boundaries in a heap with links to the neighbours, which gives the same merges without n scans of n.

Distinct pieces between spaces are merged once for each task's memory; a cut before a space that a non-space
follows never divides a word. What is remembered is bounded by ``MEMO`` and changes no result.

NULL and empty texts have no ids and decode to the empty text. The string of a special token in a text
is that token, as in the library's default. Rows are independent: rows that repeat a doc_id or lack one come out
as often as they go in, an empty table gives an empty one, and other columns are not looked at.
"""

from __future__ import annotations

import heapq
import json
import os
import re
import struct
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCANNED = 96  # parts of a word whose ranks are scanned; longer words use a heap
MEMO = 200_000  # pieces remembered in each of two generations
MEMO_CHARS = 48  # longer pieces are merged whenever they are met
ROWS = 128  # texts handled at once
NONE = 1 << 62  # the rank of a boundary that no merge closes
LATIN = re.compile(r"[\x00-\xff]*")
# The words of a text of the first 256 characters; which of them are letters, digits and blanks is the same in every Unicode version.
LETTERS, DIGITS, BLANKS = "A-Za-zªµºÀ-ÖØ-öø-ÿ", "0-9²³¹¼½¾", "\\t-\\r \\x85\\xa0"
LATIN_WORDS = re.compile(
    f"'(?:[stmd]|re|ve|ll)| ?[{LETTERS}]+| ?[{DIGITS}]+| ?[^{BLANKS}{LETTERS}{DIGITS}]+|[{BLANKS}]+(?![^{BLANKS}])|[{BLANKS}]+"
)

ENCODED = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])
DECODED = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary()), ("decoded", pa.string())])


class Memo(dict):
    """Results for keys; when full, what was not met since the last time goes."""

    def __init__(self, make: Callable[[str], bytes]) -> None:
        super().__init__()
        self.make, self.old = make, {}

    def __missing__(self, key: str) -> bytes:
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= MEMO_CHARS:
            if len(self) >= MEMO:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value


class Bpe:
    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task is one core
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        self.vocabulary: dict[str, int] = described["model"]["vocab"]
        self.rank: dict[int, int] = {}  # of a left and a right id
        self.made: list[int] = []  # the id that a rank's merge makes
        for left, right in described["model"]["merges"]:
            self.rank[self.vocabulary[left] << 32 | self.vocabulary[right]] = len(self.made)
            self.made.append(self.vocabulary[left + right])
        self.special = {t["content"]: t["id"] for t in described["added_tokens"]}
        self.at_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.words = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        visible = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes shown as themselves in the vocabulary
        hidden = [b for b in range(256) if b not in visible]
        self.shown = {b: 256 + n for n, b in enumerate(hidden)}
        byte_of = {chr(b): b for b in visible} | {chr(256 + n): b for n, b in enumerate(hidden)}
        shown = {**self.vocabulary, **self.special}
        self.bytes_of = {i: self._raw(t, byte_of) for t, i in shown.items()}
        self.cut = re.compile(r" (?=\S)")
        self.word_ids = Memo(lambda word: struct.pack(f"<{len(w := self.merge(word))}I", *w))
        self.piece_ids = Memo(lambda piece: self._piece(" " + piece))

    @staticmethod
    def _raw(token: str, byte_of: dict[str, int]) -> bytes:
        return bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()

    def merge(self, word: str) -> list[int]:
        """Ids of one word, given in the vocabulary's characters."""
        parts = [self.vocabulary[c] for c in word]
        if len(parts) > SCANNED:
            return self._merge_long(parts)
        rank, made = self.rank.get, self.made
        ranks = [rank(a << 32 | b, NONE) for a, b in zip(parts, parts[1:], strict=False)]
        while ranks:
            low = min(ranks)
            if low == NONE:
                break
            i = ranks.index(low)
            parts[i] = made[low]
            del parts[i + 1], ranks[i]
            if i:
                ranks[i - 1] = rank(parts[i - 1] << 32 | parts[i], NONE)
            if i < len(ranks):
                ranks[i] = rank(parts[i] << 32 | parts[i + 1], NONE)
        return parts

    def _merge_long(self, parts: list[int]) -> list[int]:
        rank, made, n = self.rank.get, self.made, len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if (r := rank(a << 32 | b, NONE)) != NONE]
        heapq.heapify(heap)
        while heap:
            low, i = heapq.heappop(heap)
            j = after[i]
            if j >= n or parts[i] < 0 or rank(parts[i] << 32 | parts[j], NONE) != low:
                continue  # one of the two has been merged since
            parts[i], parts[j] = made[low], -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                if (r := rank(parts[i] << 32 | parts[after[i]], NONE)) != NONE:
                    heapq.heappush(heap, (r, i))
            if before[i] >= 0 and (r := rank(parts[before[i]] << 32 | parts[i], NONE)) != NONE:
                heapq.heappush(heap, (r, before[i]))
        return [p for p in parts if p >= 0]

    def _piece(self, text: str) -> bytes:
        if not LATIN.fullmatch(text):
            return b"".join([self.word_ids[word] for word, _ in self.words(text)])
        return b"".join([self.word_ids[w.encode().decode("latin-1").translate(self.shown)] for w in LATIN_WORDS.findall(text)])

    def _plain(self, text: str) -> bytes:
        if not text:
            return b""
        first, *rest = self.cut.split(text)
        return (self._piece(first) if first else b"") + b"".join(map(self.piece_ids.__getitem__, rest))

    def encode(self, text: str | None) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if not self.at_special or not self.at_special.search(text):
            return self._plain(text)
        parts = self.at_special.split(text)  # special tokens at the odd places
        return b"".join(struct.pack("<I", self.special[p]) if k % 2 else self._plain(p) for k, p in enumerate(parts))

    def decode(self, ids: bytes | None) -> str:
        """The text of ids; ids that are no token give nothing, bytes that are no UTF-8 give U+FFFD."""
        if not ids:
            return ""
        tokens = memoryview(ids).cast("I") if struct.pack("=I", 1) == struct.pack("<I", 1) else struct.unpack(f"<{len(ids) // 4}I", ids)
        try:
            raw = b"".join(map(self.bytes_of.__getitem__, tokens))
        except KeyError:
            raw = b"".join(self.bytes_of.get(t, b"") for t in tokens)
        return raw.decode("utf-8", "replace")


@lru_cache(maxsize=1)  # kept between the tasks of a worker process, and so is what it remembers
def vocabulary(path: str) -> Bpe:
    return Bpe(path)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids): ids of whole texts as binary, little-endian unsigned 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        for batch in batches:
            for k in range(0, len(batch), ROWS):
                rows = batch.slice(k, ROWS)
                ids = [bpe.encode(t) for t in rows.column(1).to_pylist()]
                columns = [rows.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, schema=ENCODED)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_tokens long, ids binary")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded): the texts of ids as :func:`encode` gives them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        for batch in batches:
            for k in range(0, len(batch), ROWS):
                rows = batch.slice(k, ROWS)
                texts = pa.array([bpe.decode(x) for x in rows.column(2).to_pylist()], pa.string())
                yield pa.RecordBatch.from_arrays([*rows.columns, texts], schema=DECODED)

    columns = encoded.select(F.col("doc_id").cast("long"), F.col("n_tokens").cast("long"), "ids")
    return columns.mapInArrow(run, "doc_id long, n_tokens long, ids binary, decoded string")


def report(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): digests of the ids and of the text they decode to."""
    both = decode(encode(docs, path), path)
    return both.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256")
    )
