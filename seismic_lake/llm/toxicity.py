"""Toxicity of documents by a learned lexicon, misspellings included.

``fit`` learns from labelled rows: words and word stems that occur in toxic texts and hardly in clean ones
(exact copies of a text count once) become the lexicon; a logistic curve turns a document's hits into a
score. ``score`` intersects a Levenshtein automaton of each word met with the trie of the lexicon, so a word
one edit away from a longer term, or one that begins one edit away from a longer stem, still is a hit. Only the
very words of clean training texts are excepted.
A hit counts less where the words around it mark a quotation: an opening and its closing mark on both sides within
the window, or a reporting word close before it. Learning and scoring cut words alike: runs of Unicode letters,
marks and digits of any length, lower-cased.

The one bound: at most about ``TRAIN_ROWS`` labelled rows, drawn by a hash of doc_id, are learned from; the lexicon
is what they give. A doc_id, or a text, that is labelled both toxic and clean counts as toxic. Scores read the text alone. NULL and empty texts have no
hits and get the base score; repeated rows are scored each by itself; with no labelled rows of both kinds
all scores are 0.
"""

from __future__ import annotations

import bisect
import re
import sys
import unicodedata
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seismic_lake.llm.common import ASCII_LOWER, WORD, text_blocks, word_hashes, words

TRAIN_ROWS = 20_000
SUPPORT = 4  # toxic training texts with a term, at least
PURITY = 0.03  # rate among clean texts over rate among toxic ones, at most
STEM = (4, 8)  # characters of a stem
FUZZY = 5  # characters of a term that may be misspelled
WINDOW = 6  # words on each side that tell quotation
QUOTED = 0.3  # what a quoted hit counts
THRESHOLD = 0.7
MEMO = 400_000
QUOTES = (("“", "”"), ("„", "“"), ("«", "»"))
REPORTING = frozenset("said says wrote writes called calls quote quoted quoting word words term terms phrase".split())


@dataclass
class Model:
    terms: list[tuple[str, bool, bool]] = field(default_factory=list)  # text, whole word (or stem), misspellings count
    intercept: float = -30.0
    slope: float = 0.0
    spared: frozenset[str] = frozenset()  # words of clean texts that are no misspellings


@cache
def _letters() -> np.ndarray:
    """For each code point whether it is a letter, mark or digit."""
    return np.fromiter((unicodedata.category(chr(c))[0] in "LMN" for c in range(sys.maxunicode + 1)), dtype=bool)


def inside_words(lower: np.ndarray) -> np.ndarray:
    """For each byte of UTF-8 text, A-Z lower-cased, whether it belongs to a letter, mark or digit."""
    inside = WORD[lower]
    at = np.flatnonzero(lower >= 0xC0)  # first bytes of characters beyond ASCII
    if not len(at):
        return inside
    lead = lower[at].astype(np.int32)
    more = 1 + (lead >= 0xE0) + (lead >= 0xF0)  # bytes that follow
    point = lead & (0x3F >> more)
    for k in range(1, 4):
        follows = lower[np.minimum(at + k, len(lower) - 1)] & 0x3F
        point = np.where(k <= more, point << 6 | follows, point)
    letter = _letters()[np.minimum(point, sys.maxunicode)]
    for k in range(4):
        inside[at[k <= more] + k] = letter[k <= more]
    return inside


def word_sets(texts: pa.Array) -> Iterator[set[str]]:
    """The distinct words of each text."""
    for _, _, data, offsets in text_blocks(texts):
        lower = ASCII_LOWER[data]
        blanked = np.where(inside_words(lower), lower, 32).astype(np.uint8).tobytes()
        for a, b in zip(offsets.tolist(), offsets[1:].tolist(), strict=False):
            yield set(blanked[a:b].decode().lower().split())


class Lexicon:
    """The terms as tries, searched with the Levenshtein automaton of a word (one edit).

    One edit leaves one half of a term as it is. From an unchanged first half a trie of second halves goes forwards,
    from an unchanged second half a trie of first halves goes backwards, so a search begins past the half it shares.
    """

    def __init__(self, terms: list[tuple[str, bool, bool]]) -> None:
        self.stems = {t for t, whole, _ in terms if not whole}
        self.whole = {t for t, whole, _ in terms if whole}
        self.lengths = sorted({len(t) for t in self.stems})
        fuzzy = [(t, whole) for t, whole, loose in terms if loose and len(t) >= FUZZY]
        # Whole word or stem, length of the term: tries by first half, by second half.
        self.tries: dict[bool, dict[int, tuple[dict, dict]]] = {True: {}, False: {}}
        for term, whole in fuzzy:
            forward, backward = self.tries[whole].setdefault(len(term), ({}, {}))
            head, tail = term[: len(term) // 2], term[len(term) // 2 :]
            _grow(forward.setdefault(head, {}), tail, "$$" if whole else "**")
            _grow(backward.setdefault(tail, {}), head[::-1], "$$")
        # By bytes, for many words at once: the first two and the last two, or two of a stem's second to fifth.
        heads = {t[:2] for t, _ in fuzzy} | {t[:2] for t in self.whole | self.stems}
        self.first, self.last = _pairs(t.encode()[:2] for t in heads), _pairs(t.encode()[-2:] for t, whole in fuzzy if whole)
        self.next = _pairs(t[2:5].encode()[:2] for t, whole in fuzzy if not whole)

    def possible(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Words that can be a hit, by their first, next and last two bytes; words that begin or end beyond ASCII are let through."""
        head = data[start].astype(np.int64) << 8 | data[np.minimum(start + 1, end - 1)]
        tail = data[np.maximum(end - 2, start)].astype(np.int64) << 8 | data[end - 1]
        at = [data[np.minimum(start + k, end - 1)].astype(np.int64) for k in range(1, 5)]
        beyond = (head | tail | at[1] | at[2] | at[3]) & 0x8080 > 0
        inner = np.any([self.next[a << 8 | b] for a, b in zip(at, at[1:], strict=False)], axis=0)
        return self.first[head] | self.last[tail] | inner | beyond

    def exact(self, word: str) -> bool:
        return word in self.whole or any(word[:n] in self.stems for n in self.lengths if n < len(word))

    def near(self, word: str) -> bool:
        """Whether a term, or a stem as its beginning, is at most one edit away."""
        for length in (len(word) - 1, len(word), len(word) + 1):
            if length in self.tries[True]:
                forward, backward = self.tries[True][length]
                half = length // 2
                if _within(forward.get(word[:half]), word[half:]) or _within(backward.get(word[half - length :]), word[: half - length][::-1]):
                    return True
        for length, (forward, backward) in self.tries[False].items():
            half, rest = length // 2, length - length // 2
            if _within(forward.get(word[:half]), word[half:]):
                return True
            if any(_within(backward.get(word[i : i + rest]), word[:i][::-1]) for i in (half - 1, half, half + 1)):
                return True
        return False


def _grow(node: dict, text: str, end: str) -> None:
    for char in text:
        node = node.setdefault(char, {})
    node[end] = {}


def _within(trie: dict | None, word: str) -> bool:
    """Whether an entry is at most one edit from the word, or from its beginning: states are (characters of the word read, edits made)."""
    if trie is None:
        return False
    n = len(word)
    open_ = [(trie, frozenset({(0, 0)}))]
    while open_:
        node, states = open_.pop()
        if "**" in node or "$$" in node and any(0 <= n - i <= 1 - e for i, e in states):
            return True
        for char, child in node.items():
            if len(char) > 1:
                continue
            after = set()
            for i, e in states:
                if i < n and word[i] == char:
                    after.add((i + 1, e))
                if not e:
                    after.add((i, 1))  # the term has one more
                    if i < n:
                        after.add((i + 1, 1))  # another character
                    if i + 1 < n and word[i + 1] == char:
                        after.add((i + 2, 1))  # the word has one more
            if after:
                open_.append((child, frozenset(after)))
    return False


def _pairs(two: Iterable[bytes]) -> np.ndarray:
    out = np.zeros(1 << 16, dtype=bool)
    out[[p[0] << 8 | p[-1] for p in two]] = True  # a single byte counts as two of it
    return out


class Scanner:
    """Weighted hits of texts; what a word is, is kept by its hash."""

    def __init__(self, terms: list[tuple[str, bool, bool]], spared: frozenset[str] = frozenset()) -> None:
        self.lexicon, self.spared, self.known = Lexicon(terms), spared, {}

    def _is_hit(self, word: bytes) -> bool:
        text = word.decode(errors="replace").lower()
        return self.lexicon.exact(text) or text not in self.spared and self.lexicon.near(text)

    def weights(self, texts: pa.Array) -> np.ndarray:
        out = []
        for _, _, data, offsets in text_blocks(texts):
            lower = ASCII_LOWER[data]
            start, end, at = words(inside_words(lower).view(np.uint8), offsets, np.array([False, True]))
            can = np.flatnonzero(self.lexicon.possible(lower, start, end))
            unique, first, which = np.unique(word_hashes(lower, start[can], end[can]), return_index=True, return_inverse=True)
            if len(self.known) > MEMO:
                self.known = {}
            flags = np.zeros(len(unique), dtype=bool)
            for k, (h, i) in enumerate(zip(unique.tolist(), can[first].tolist(), strict=True)):
                hit = self.known.get(h)
                if hit is None:
                    hit = self.known[h] = self._is_hit(lower[start[i] : end[i]].tobytes())
                flags[k] = hit
            total = np.zeros(len(offsets) - 1)
            for i in can[flags[which]].tolist():
                k = int(np.searchsorted(at, i, side="right")) - 1
                total[k] += self._weight(data, start, end, i, at[k], at[k + 1], offsets[k], offsets[k + 1])
            out.append(total)
        return np.concatenate(out) if out else np.zeros(0)

    def _weight(self, data, start, end, i, first, last, begin, stop) -> float:
        """What the hit at word i counts, by the words around it."""
        a, b = max(first, i - WINDOW), min(last, i + WINDOW + 1)
        before = data[start[a] if a > first else begin : start[i]].tobytes().decode(errors="replace")
        after = data[end[i] : end[b - 1] if b < last else stop].tobytes().decode(errors="replace")
        marked = any(before.count(a) > before.count(b) and b in after for a, b in QUOTES) or before.count('"') % 2 == 1 and '"' in after
        reported = not REPORTING.isdisjoint(re.findall(r"[a-z]+", before.lower())[-3:])
        return QUOTED if marked or reported else 1.0


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def training(documents: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """(text, toxic): the labelled rows to learn from, exact copies of a text once."""
    open_ = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~F.coalesce(held_out(F.col("doc_id")), F.lit(True)))
    open_ = open_.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    total = open_.count()
    drawn = open_.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int((1 << 30) * min(1.0, rows / max(total, 1))))
    # About `rows` pairs of numbers: the bound holds for any size of the tables.
    texts = documents.select("doc_id", "text").join(F.broadcast(drawn), "doc_id").where(F.length("text") > 0)
    return texts.groupBy("text").agg(F.max("toxic").alias("toxic"))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(toxic, feature): the distinct words and stems of each text; words end in '$'."""
    for batch in batches:
        toxic, found = batch.column("toxic").to_pylist(), []
        for words_ in word_sets(batch.column("text")):
            found.append([w + "$" for w in words_] + list({w[:n] for w in words_ for n in range(STEM[0], min(STEM[1], len(w) - 1) + 1)}))
        flags = pa.array([t for t, own in zip(toxic, found, strict=True) for _ in own], pa.int64())
        yield pa.RecordBatch.from_arrays([flags, pa.array([f for own in found for f in own], pa.string())], names=["toxic", "f"])


def lexicon(train: DataFrame) -> list[tuple[str, int, int]]:
    """(feature, toxic texts, clean texts) of what marks toxic texts; of at most ``TRAIN_ROWS`` texts."""
    sizes = {r["toxic"]: r["n"] for r in train.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not sizes.get(0) or not sizes.get(1):
        return []
    features = train.select("text", "toxic").mapInArrow(_features, "toxic long, f string")
    counts = features.groupBy("f").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c"))
    pure = counts.where((F.col("t") >= SUPPORT) & (F.col("c") / sizes[0] <= PURITY * F.col("t") / sizes[1]))
    return [tuple(r) for r in pure.orderBy(F.desc("t"), "f").collect()]


def terms(found: list[tuple[str, int, int]]) -> list[tuple[str, bool, bool]]:
    """The shortest stems that do, except where one word makes up nearly all of a stem."""
    texts = {f: t for f, t, _ in found}
    whole = sorted(f[:-1] for f in texts if f.endswith("$"))
    out: list[tuple[str, bool, bool]] = []
    stems: set[str] = set()
    for stem in sorted((f for f in texts if not f.endswith("$")), key=lambda f: (len(f), f)):
        if any(stem[:n] in stems for n in range(STEM[0], len(stem))):
            continue
        own = whole[bisect.bisect_left(whole, stem) : bisect.bisect_left(whole, stem + "\U0010ffff")]
        if max((texts[w + "$"] for w in own), default=0) < 0.8 * texts[stem]:
            stems.add(stem)
            out.append((stem, False, True))
    covered = {w for w in whole if any(w[:n] in stems for n in range(STEM[0], len(w)))}
    return out + [(w, True, True) for w in whole if w not in covered]


def fit(documents: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    train = training(documents, labels, rows).persist()
    try:
        chosen = terms(lexicon(train))
        if not chosen:
            return Model()
        # A word of clean texts is no misspelling; other misspellings of the same term are.
        lexicon_ = Lexicon(chosen)

        def variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                met = set().union(*word_sets(batch.column("text")))
                near = [w for w in met if not lexicon_.exact(w) and lexicon_.near(w)]
                yield pa.RecordBatch.from_arrays([pa.array(near, pa.string())], names=["w"])

        met = train.where("toxic = 0").select("text").mapInArrow(variants, "w string").distinct()
        spared = frozenset(r["w"] for r in met.collect())  # words of at most TRAIN_ROWS texts, an edit from a term

        def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            scanner = Scanner(chosen, spared)
            for batch in batches:
                weight = pa.array(scanner.weights(batch.column("text")))
                yield pa.RecordBatch.from_arrays([weight, batch.column("toxic").cast(pa.int32())], names=["weight", "toxic"])

        pairs = train.select("text", "toxic").mapInArrow(weigh, "weight double, toxic int")
        rows_ = pairs.groupBy("weight", "toxic").agg(F.count("*").alias("n")).collect()  # few distinct weights
        x = np.log1p(np.array([r["weight"] for r in rows_]))
        y = np.array([r["toxic"] for r in rows_], dtype=float)
        n = np.array([r["n"] for r in rows_], dtype=float)
        intercept, slope = logistic(x, y, n)
        return Model(chosen, intercept, slope, spared)
    finally:
        train.unpersist()


def logistic(x: np.ndarray, y: np.ndarray, n: np.ndarray, ridge: float = 0.5) -> tuple[float, float]:
    """Intercept and slope by Newton's method; the ridge keeps separable data finite."""
    beta, design = np.zeros(2), np.stack([np.ones_like(x), x], axis=1)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -35, 35)))
        gradient = design.T @ (n * (y - p)) - ridge * beta * [0, 1]
        hessian = (design * (n * p * (1 - p))[:, None]).T @ design + np.diag([1e-6, ridge])
        step = np.linalg.solve(hessian, gradient)
        beta = beta + np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0]), float(beta[1])


def scores(weights: np.ndarray, model: Model) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(model.intercept + model.slope * np.log1p(weights), -35, 35)))


def score(documents: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row."""
    id_type = documents.schema["doc_id"].dataType.simpleString()

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(model.terms, model.spared)
        for batch in batches:
            found = scores(scanner.weights(batch.column("text")), model)
            ids = batch.column("doc_id")
            held = [i is not None and zlib.crc32(str(i).encode()) % 3 == 1 for i in ids.to_pylist()]
            columns = [ids, pa.array(held), pa.array(found), pa.array((found >= THRESHOLD).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "score", "predicted"])

    return documents.select("doc_id", "text").mapInArrow(apply, f"doc_id {id_type}, held_out boolean, score double, predicted int")


def remove(documents: DataFrame, model: Model) -> DataFrame:
    """The rows below the threshold, all columns as they were."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(model.terms, model.spared)
        for batch in batches:
            yield batch.filter(pa.array(scores(scanner.weights(batch.column("text")), model) < THRESHOLD))

    return documents.mapInArrow(keep, documents.schema)
