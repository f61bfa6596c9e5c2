"""Benchmark decontamination with suffix arrays over the training text.

Every task lays its documents out in shards of a few megabytes. A shard's suffix array holds the word
suffixes that can begin a match at all: those whose first two words begin some benchmark window. All
benchmark suffixes ("windows" of ten words, or a whole shorter item) are binary-searched in the array;
the range found is every place in the shard where the window occurs. Windows that occur one word on
from each other chain up to the longest verbatim match, so a document's hits are the union of the
places. Documents are never shuffled: the benchmark comes to them in blocks of bounded size, one pass
over a partition for each block.

NULL and empty texts have no words, are never hit and are kept. Repeated rows are judged each by
itself. An empty benchmark hits nothing. Items without words have no windows. Other columns, whatever
their names, pass through :func:`remove` untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seismic_lake.llm.common import ASCII_LOWER, WORD, text_blocks, word_hashes, words

WINDOW = 10  # words
BENCHMARK_BLOCK = 16 << 20  # bytes of benchmark text broadcast at once
TOP = np.uint32(0xFFFFFFFF)


class Windows:
    """The distinct windows of a block of benchmark items, as rows of word numbers, and who has them."""

    def __init__(self, items: pa.Table, size: int = WINDOW) -> None:
        ids, texts = items.column(0).to_pylist(), items.column(1).combine_chunks()
        rows, owners, vocabulary = [], [], []
        for first, end, data, offsets in text_blocks(texts):
            data = ASCII_LOWER[data]
            start, stop, at = words(data, offsets, WORD)
            hashes = word_hashes(data, start, stop)
            vocabulary.append(np.unique(hashes))
            for k in range(first, end):
                own = hashes[at[k - first] : at[k - first + 1]]
                n = min(size, len(own))
                for i in range(len(own) - n + 1) if n else ():
                    rows.append(own[i : i + n])
                    owners.append(ids[k])
        self.size = size
        self.vocabulary = np.unique(np.concatenate(vocabulary)) if vocabulary else np.zeros(0, np.uint64)
        lengths = np.array([len(r) for r in rows], dtype=np.int64)
        table = np.zeros((len(rows), size), dtype=np.uint32)
        for k, r in enumerate(rows):
            table[k, : len(r)] = np.searchsorted(self.vocabulary, r) + 1  # 0: a word the benchmark lacks
        unique, which = np.unique(table, axis=0, return_inverse=True) if len(rows) else (table, np.zeros(0, int))
        which = which.reshape(-1)
        self.lower = unique
        self.length = np.zeros(len(unique), dtype=np.int64)
        self.length[which] = lengths
        self.upper = np.where(unique == 0, TOP, unique)
        pairs = sorted({(w, o) for w, o in zip(which.tolist(), owners, strict=True)}, key=lambda p: p[0])
        self.owners = np.array([o for _, o in pairs], dtype=object)
        self.first_owner = np.searchsorted(np.array([w for w, _ in pairs], dtype=np.int64), np.arange(len(unique) + 1))
        self.singles = np.unique(unique[self.length == 1, 0]) if len(unique) else np.zeros(0, np.uint32)
        self.pairs = np.unique(_pair(unique[:, 0], unique[:, 1])) if len(unique) and size > 1 else np.zeros(0, np.uint64)

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Word numbers in the benchmark's vocabulary, 0 for words it lacks."""
        if not len(self.vocabulary):
            return np.zeros(len(hashes), dtype=np.uint32)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at + 1, 0).astype(np.uint32)


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a.astype(np.uint64) << np.uint64(32)) | b.astype(np.uint64)


def _columns(table: np.ndarray) -> list[np.ndarray]:
    """Two word numbers to a 64-bit column, in the order of comparison."""
    if table.shape[1] % 2:
        table = np.concatenate([table, np.zeros((len(table), 1), np.uint32)], axis=1)
    return [_pair(table[:, i], table[:, i + 1]) for i in range(0, table.shape[1], 2)]


def suffix_array(numbers: np.ndarray, at: np.ndarray, windows: Windows) -> tuple[np.ndarray, list[np.ndarray]]:
    """Places whose suffix can begin a window, sorted by the suffix's first words, and those words.

    ``numbers``: the shard's words; ``at``: each text's first word, with a last entry. Suffixes end with
    their text.
    """
    n = len(numbers)
    following = np.zeros(n, dtype=np.uint32)
    following[:-1] = numbers[1:]
    last = at[1:][at[1:] > at[:-1]] - 1
    following[last] = 0
    can = np.isin(_pair(numbers, following), windows.pairs) | np.isin(numbers, windows.singles)
    place = np.flatnonzero(can & (numbers > 0))
    limit = at[np.searchsorted(at, place, side="right")]
    padded = np.concatenate([numbers, np.zeros(windows.size, np.uint32)])
    table = padded[place[:, None] + np.arange(windows.size)]
    table[place[:, None] + np.arange(windows.size) >= limit[:, None]] = 0
    columns = _columns(table)
    order = np.lexsort(columns[::-1])
    return place[order], [c[order] for c in columns]


def search(columns: list[np.ndarray], queries: list[np.ndarray], after: bool) -> np.ndarray:
    """For each query the first sorted row not below it (or, ``after``, above it): binary search."""
    low = np.zeros(len(queries[0]), dtype=np.int64)
    high = np.full(len(queries[0]), len(columns[0]), dtype=np.int64)
    while (open_ := low < high).any():
        middle = np.minimum((low + high) // 2, len(columns[0]) - 1)
        below = np.zeros(len(low), dtype=bool)
        tied = open_.copy()
        for column, query in zip(columns, queries, strict=True):
            value = column[middle]
            below |= tied & (value < query)
            tied &= value == query
        if after:
            below |= tied
        low = np.where(open_ & below, middle + 1, low)
        high = np.where(open_ & ~below, middle, high)
    return low


def occurrences(numbers: np.ndarray, at: np.ndarray, windows: Windows) -> tuple[np.ndarray, np.ndarray]:
    """(place, window) of every occurrence in a shard."""
    none = np.zeros(0, np.int64)
    if not len(windows.lower) or not len(numbers):
        return none, none
    place, columns = suffix_array(numbers, at, windows)
    if not len(place):
        return none, none
    low = search(columns, _columns(windows.lower), after=False)
    high = search(columns, _columns(windows.upper), after=True)
    many = np.maximum(high - low, 0)
    which = np.repeat(np.arange(len(many)), many)
    rank = np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many) + low[which]
    return place[rank], which


def shards(texts: pa.Array, windows: Windows) -> Iterator[list[tuple[int, list[tuple[int, int]], list]]]:
    """Per shard, for each text: words, stretches of hit words (end exclusive), items with windows in it."""
    for _, _, data, offsets in text_blocks(texts):
        data = ASCII_LOWER[data]
        start, stop, at = words(data, offsets, WORD)
        place, which = occurrences(windows.numbers(word_hashes(data, start, stop)), at, windows)
        length = windows.length[which]
        change = np.zeros(len(start) + 1, dtype=np.int64)
        np.add.at(change, place, 1)
        np.add.at(change, place + length, -1)
        hit = np.concatenate([[False], np.cumsum(change)[:-1] > 0, [False]])
        owner = np.searchsorted(at, place, side="right") - 1
        found: dict[int, set] = {}
        for text, window in np.unique(np.stack([owner, which], axis=1), axis=0) if len(place) else ():
            found.setdefault(int(text), set()).update(windows.owners[windows.first_owner[window] : windows.first_owner[window + 1]])
        rows = []
        for k in range(len(offsets) - 1):
            spans = []
            if k in found:
                own = np.concatenate([[False], hit[1 + at[k] : 1 + at[k + 1]], [False]])
                edges = np.flatnonzero(own[1:] != own[:-1]).reshape(-1, 2)
                spans = [(int(a), int(b)) for a, b in edges]
            rows.append((int(at[k + 1] - at[k]), spans, list(found.get(k, ()))))
        yield rows


def blocks(benchmark: DataFrame, block_bytes: int = BENCHMARK_BLOCK) -> Iterator[Windows]:
    """The benchmark's windows, a block of items of about ``block_bytes`` at a time through the driver."""
    items = benchmark.select("item_id", "text").where(F.col("text").isNotNull())
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // block_bytes) or 1
    for k in range(n):
        yield Windows(items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).toArrow())


def remove(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``documents`` that no benchmark window occurs in, all columns as they were."""
    for windows in blocks(benchmark):
        shared = documents.sparkSession.sparkContext.broadcast(windows)

        def keep(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                clean = [not spans for rows in shards(batch.column("text"), shared.value) for _, spans, _ in rows]
                yield batch.filter(pa.array(clean, pa.bool_()))

        documents = documents.mapInArrow(keep, documents.schema)
    return documents


def locate(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, n_words, spans, items) for each row: stretches of hit words and the items found, in any order."""
    docs = documents.select("doc_id", "text", F.lit(0).cast("long").alias("n_words"), F.expr("array()").cast("array<struct<start:long,end:long>>").alias("spans"), F.expr("array()").cast(f"array<{benchmark.schema['item_id'].dataType.simpleString()}>").alias("items"))
    schema = docs.schema
    for windows in blocks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(windows)

        def mark(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = [row for part in shards(batch.column("text"), shared.value) for row in part]
                spans = [_union(a, [(s["start"], s["end"]) for s in b]) for (_, a, _), b in zip(rows, batch.column("spans").to_pylist(), strict=True)]
                items = [sorted({*a, *b}, key=str) for (_, _, a), b in zip(rows, batch.column("items").to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"),
                        batch.column("text"),
                        pa.array([n for n, _, _ in rows], pa.int64()),
                        pa.array([[{"start": s, "end": e} for s, e in x] for x in spans], batch.schema.field("spans").type),
                        pa.array(items, batch.schema.field("items").type),
                    ],
                    schema=batch.schema,
                )

        docs = docs.mapInArrow(mark, schema)
    return docs.drop("text")


def _union(a: list[tuple[int, int]], b: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(a + b):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def report(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Digest columns per row of ``documents``."""
    names = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return locate(documents, benchmark).select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.encode(names, "UTF-8"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


