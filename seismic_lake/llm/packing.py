"""Best-fit packing of documents into sequences of a fixed number of tokens.

Lengths are whole numbers up to the capacity, so an instance of any size is the number of pieces of
each length: at most ``capacity`` counts, which is all the driver sees. On the counts, Martello-Toth
reduction fixes sets that dominate every alternative for their largest piece, many alike at once; what
is left is packed best fit, longest first. The result is a list of patterns (lengths in a sequence) and
how often each is used, again bounded by the capacity. Each piece gets its rank among the pieces of its
length (counted in spread groups, so a common length is no single task) and the rank says its place.

NULL and empty texts are one piece: the end id. Repeated rows are packed each by itself. No rows give
no sequences.
"""

from __future__ import annotations

import bisect
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from seismic_lake.llm.common import tasks, written
from seismic_lake.llm.encoder import word_bpe

CAPACITY = 2048
END = 0
ROWS = 256  # texts encoded at once

Pattern = tuple[int, list[tuple[int, int]]]  # times used, (length, how many) in order


def _sums(counts: dict[int, int], limit: int) -> int:
    """Bit s is set if some pieces add up to s, for s up to ``limit``."""
    reach, mask = 1, (1 << (limit + 1)) - 1
    for length, count in counts.items():
        if length > limit:
            continue
        left, step = min(count, limit // length), 1
        while left > 0:
            take = min(step, left)
            reach |= (reach << (take * length)) & mask
            left, step = left - take, step * 2
    return reach


def reduce(counts: dict[int, int], capacity: int) -> tuple[list[Pattern], dict[int, int]]:
    """Martello-Toth dominance: (patterns that some best packing has, counts left).

    For a piece j with room r beside it, let k be the longest other piece that fits. {j, k} dominates
    every set with j if no selection of the others has a sum over k and up to r: whatever stands with j
    elsewhere can change places with k. (k filling r exactly is the plain case; so is j alone, if
    nothing fits.) {j, k, b}, with b the longest that fits beside both, dominates if at most two can
    stand with j and no two pieces over b fit there: of any pair, the longer goes to k's place and the
    shorter to b's.
    """
    left = {length: n for length, n in counts.items() if n > 0}
    fixed: list[Pattern] = []

    def take(times: int, lengths: list[int]) -> None:
        fixed.append((times, [(x, lengths.count(x)) for x in dict.fromkeys(lengths)]))
        for x in lengths:
            left[x] -= times
            if not left[x]:
                del left[x]

    for j in sorted(counts, reverse=True):
        while left.get(j):
            room = capacity - j
            others = {x: n - (x == j) for x, n in left.items() if x <= room and n > (x == j)}
            if not others:
                take(left[j], [j])
                continue
            k = max(others)
            if k == room or not _sums(others, room) >> (k + 1):
                take(left[j] // 2 if k == j else min(left[j], left[k]), [j, k])
                continue
            others[k] -= 1
            rest = sorted(x for x, n in others.items() if n)
            fits = [x for x in rest if x <= room - k]
            others[k] += 1
            ascending = [x for x in sorted(others) for _ in range(min(3, others[x]))]
            if not fits or len(ascending) >= 3 and sum(ascending[:3]) <= room:
                break
            b = fits[-1]
            over = [x for x in ascending if x > b]
            if len(over) >= 2 and over[0] + over[1] <= room:
                break
            lengths = [j, k, b]
            take(min(left[x] // lengths.count(x) for x in lengths), lengths)
    return fixed, left


def best_fit(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Longest first, each into the fullest sequence that has room; sequences alike are kept as one entry."""
    open_: dict[int, list[list]] = defaultdict(list)  # room -> [times, content]
    rooms: list[int] = []

    def put(times: int, room: int, content: list[tuple[int, int]]) -> None:
        if not open_[room]:
            bisect.insort(rooms, room)
        open_[room].append([times, content])

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            at = bisect.bisect_left(rooms, length)
            if at == len(rooms):
                put(-(-left // (capacity // length)), capacity, [])
                continue
            room = rooms[at]
            times, content = open_[room].pop()
            if not open_[room]:
                rooms.remove(room)
            each = room // length
            full = min(times, left // each)
            if full:
                put(full, room - each * length, [*content, (length, each)])
                times, left = times - full, left - full * each
            if times and left:  # the last of them, in part
                put(1, room - left * length, [*content, (length, left)])
                times, left = times - 1, 0
            if times and content:
                put(times, room, content)
    return [(times, content) for group in open_.values() for times, content in group if content]


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    fixed, left = reduce(counts, capacity)
    return fixed + best_fit(left, capacity)


def places(patterns: list[Pattern]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """By length: first rank of each slot, the slot's first sequence, its offset."""
    slots: dict[int, list[list[int]]] = defaultdict(lambda: [[], [], []])
    ranks: dict[int, int] = defaultdict(int)
    sequence = 0
    for times, content in patterns:
        offset = 0
        for length, n in content:
            for _ in range(n):
                for column, value in zip(slots[length], (ranks[length], sequence, offset), strict=True):
                    column.append(value)
                ranks[length] += times
                offset += length
        sequence += times
    return {length: tuple(np.array(c, dtype=np.int64) for c in columns) for length, columns in slots.items()}


def pieces(documents: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): the ids of each document, the end id after them, cut at the capacity."""
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_bpe(vocabulary)
        for batch in batches:
            for k in range(0, len(batch), ROWS):
                rows = batch.slice(k, ROWS)
                ids, at = encoder.batch(rows.column("text").to_pylist())
                ids = np.insert(ids, at[1:], END).astype("<u4")
                at = (at + np.arange(len(at))).tolist()
                out: list[list] = [[], [], [], [], []]
                for doc_id, first, end in zip(rows.column("doc_id").to_pylist(), at, at[1:], strict=False):
                    for piece, start in enumerate(range(first, end, capacity)):
                        stop = min(start + capacity, end)
                        row = (doc_id, piece, start - first, stop - start, zlib.crc32(ids[start:stop].tobytes()))
                        for column, value in zip(out, row, strict=True):
                            column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema, strict=True)], schema=schema)

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


def pack(documents: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """The pieces of all documents with sequence_id and offset."""
    spark = documents.sparkSession
    cut = written(pieces(documents, vocabulary, capacity), "pieces")
    groups = 4 * tasks(spark)
    cut = cut.withColumn("group", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(groups)))
    sizes = cut.groupBy("length", "group").agg(F.count("*").alias("n"))
    before = W.partitionBy("length").orderBy("group").rowsBetween(W.unboundedPreceding, -1)
    sizes = sizes.select("length", "group", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    own = W.partitionBy("length", "group").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = cut.withColumn("own", F.row_number().over(own) - 1).join(sizes, ["length", "group"])
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most `capacity` rows
    slots = spark.sparkContext.broadcast(places(plan(counts, capacity)))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    fields = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            sequence, offset = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
            for x in np.unique(length):
                own = np.flatnonzero(length == x)
                first, base, at = slots.value[int(x)]
                slot = np.searchsorted(first, rank[own], side="right") - 1
                sequence[own], offset[own] = base[slot] + rank[own] - first[slot], at[slot]
            yield pa.RecordBatch.from_arrays([*(batch.column(f) for f in fields), pa.array(sequence), pa.array(offset)], names=[*fields, "sequence_id", "offset"])

    return ranked.select(*fields, (F.col("base") + F.col("own")).cast("long").alias("rank")).mapInArrow(place, schema)
