"""Importance resampling: the documents that look most like a target text, drawn by Gumbel scores.

Features are runs of one to ``longest`` consecutive words, hashed to ``buckets``. All documents and all target
texts are counted per bucket; a bucket's gain is the floored, scaled logarithm of its target share over its
documents' share (one is added to each count). A document's weight is the mean of the gains of its
features, looked up in one array per task; its score is the weight plus Gumbel noise drawn from a
hash of its id, so the highest scores are a sample without replacement in proportion to the weights.

The drawn ones are found without a global sort: scores are written once, then the cutoff is narrowed by
jobs that count exactly how many rows stand above a number, halving the range of scores (several
halvings a job), then the range of ids that tie with it, then that of the rows that repeat such an id. The
rows above the cutoff alone are dealt out by range and numbered within each range, the sizes of the ranges
before it added.

NULL texts have no words. Rows without doc_id draw the noise of an empty id and stand after those that have
one in a tie. Rows that repeat a doc_id are drawn each by itself; of equal ones those read first come first.
No documents give no rows; an empty target gives gains that only say how rare a bucket is; columns
other than doc_id and text are not looked at.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from seismic_lake.llm.common import tasks, written

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")  # on UTF-8 bytes, lower-cased: digits, letters, all beyond ASCII
REMEMBERED = 500_000  # words whose bucket a task keeps; bounds memory, changes no result
WORD_BYTES = 64  # longer words are hashed whenever they are met
ROWS = 128  # texts handled at once
HALVINGS = 5  # of the range in one counting job
PLACE = 33  # bits that Spark gives to a row's place in its partition
LAST_ID = (1 << 63) - 1


class Buckets(dict):
    """The bucket of a word."""

    def __init__(self, buckets: int) -> None:
        super().__init__()
        self.buckets = buckets

    def __missing__(self, word: bytes) -> int:
        bucket = zlib.crc32(word) % self.buckets
        if len(word) <= WORD_BYTES:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = bucket
        return bucket


@lru_cache(maxsize=4)
def _remembered(buckets: int) -> Buckets:
    return Buckets(buckets)


def features(text: str | None, longest: int, buckets: int) -> tuple[int, np.ndarray]:
    """Number of words, and buckets of all features, of a whole text; repeats included."""
    words = WORD.findall((text or "").encode().translate(LOWER))
    found = np.fromiter(map(_remembered(buckets).__getitem__, words), dtype=np.int64, count=len(words))
    if longest == 1:
        return len(words), found
    runs = [found]
    for n in range(2, longest + 1):
        runs.append(np.array([zlib.crc32(b" ".join(words[i : i + n])) % buckets for i in range(len(words) - n + 1)], dtype=np.int64))
    return len(words), np.concatenate(runs)


def _texts(column: pa.Array) -> Iterator[str | None]:
    for k in range(0, len(column), ROWS):
        yield from column.slice(k, ROWS).to_pylist()


def bucket_counts(texts: DataFrame, longest: int, buckets: int) -> np.ndarray:
    """How many features of all texts fall in each bucket; added up per task, then over tasks."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for text in _texts(batch.column(0)):
                np.add.at(total, features(text, longest, buckets)[1], 1)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(total[met])], names=["bucket", "n"])

    counted = texts.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, dtype=np.int64)
    for bucket, n in counted.collect():  # as many rows as buckets
        out[bucket] = n
    return out


def bucket_gains(documents: np.ndarray, target: np.ndarray, unit: int) -> np.ndarray:
    """floor(unit * ln(target's share / documents' share)) of each bucket, one added to each count."""
    n, s_all, t_all = len(documents), float(documents.sum()), float(target.sum())
    gains = [
        math.floor(unit * math.log((t + 1.0) * (s_all + n) / ((s + 1.0) * (t_all + n))))
        for s, t in zip(documents.tolist(), target.tolist(), strict=True)
    ]
    return np.array(gains, dtype=np.int64)


def gumbel(key: Column, seed: int, unit: int) -> Column:
    """Whole-numbered Gumbel noise from a hash of the seed and an id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    share = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-float(unit)) * F.log(-F.log(share))).cast("long")


def scores(docs: DataFrame, gains: np.ndarray, longest: int, seed: int, unit: int) -> DataFrame:
    """(doc_id, n_features, n_words, weight, score, row) of every document; ``row`` numbers the rows as they are read."""
    buckets = len(gains)
    schema = pa.schema([(c, pa.int64()) for c in ("doc_id", "n_features", "n_words", "weight")])

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_features, n_words, weight = (np.zeros(len(batch), dtype=np.int64) for _ in range(3))
            for k, text in enumerate(_texts(batch.column(1))):
                n_words[k], found = features(text, longest, buckets)
                n_features[k] = len(found)
                weight[k] = gains[found].sum() // len(found) if len(found) else 0
            columns = [batch.column(0), *(pa.array(x) for x in (n_features, n_words, weight))]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    weighed = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(weigh, "doc_id long, n_features long, n_words long, weight long")
    return weighed.withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed, unit)).withColumn("row", F.monotonically_increasing_id())


def least_reaching(rows: DataFrame, value: Column, low: int, high: int, wanted: int) -> tuple[int, int]:
    """The least v of ``low``..``high`` such that at least ``wanted`` rows have value <= v, and how many have value < v.

    Each job counts the rows up to 2**HALVINGS - 1 evenly spaced numbers at once; at ``high`` all rows count.
    """
    below = 0
    while low < high:
        steps = min(1 << HALVINGS, high - low + 1)
        pivots = sorted({low + (high - low + 1) * i // steps - 1 for i in range(1, steps)} - {low - 1})
        counts = rows.agg(*[F.count(F.when(value <= F.lit(p), 1)).alias(f"n{i}") for i, p in enumerate(pivots)]).first()
        reached = next((i for i, n in enumerate(counts) if n >= wanted), None)
        if reached is None:
            low, below = pivots[-1] + 1, counts[-1]
        else:
            high = pivots[reached]
            if reached:
                low, below = pivots[reached - 1] + 1, counts[reached - 1]
    return low, below


def cutoff(rows: DataFrame, keys: list[str], wanted: int) -> list[int]:
    """The key values of the last of the ``wanted`` smallest rows, in ascending order of ``keys`` (whole numbers, no NULL).

    The keys are settled one after another, each among the rows that tie in the keys before it.
    """
    values: list[int] = []
    tied = rows
    for key in keys:
        low, high = tied.agg(F.min(key), F.max(key)).first()
        value, below = least_reaching(tied, F.col(key), low, high, wanted)
        values.append(value)
        wanted -= below
        tied = tied.where(F.col(key) == value)
    return values


def up_to(keys: list[str], values: list[int]) -> Column:
    """Whether a row stands at or before ``values`` in ascending order of ``keys``."""
    reached: Column = F.lit(True)
    for key, value in reversed(list(zip(keys, values, strict=True))):
        reached = (F.col(key) < value) | ((F.col(key) == value) & reached)
    return reached


def numbered(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """``rows`` with their place (from 1) in ascending order of ``keys``, sorted within ranges only."""
    dealt = rows.repartitionByRange(tasks(rows.sparkSession), *keys).sortWithinPartitions(*keys)
    place = F.monotonically_increasing_id()
    placed = written(dealt.withColumns({"part": F.shiftright(place, PLACE), "place": place.bitwiseAND((1 << PLACE) - 1)}), "ranges")
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = placed.groupBy("part").agg(F.count("*").alias("n"))  # one row for each range
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return placed.join(parts, "part").withColumn(name, F.col("before") + F.col("place") + 1).drop("part", "place", "before")


def resample(
    docs: DataFrame,
    target: DataFrame,
    share: tuple[int, int] = (10, 100),
    longest: int = 1,
    buckets: int = 10_000,
    least_words: int = 20,
    seed: int = 2024,
    unit: int = 1000,
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank): ``rank`` 1, 2, ... for the drawn documents, NULL for the others.

    Of the documents with at least ``least_words`` words, floor(share[0] * n / share[1]) are drawn.
    """
    gains = bucket_gains(bucket_counts(docs, longest, buckets), bucket_counts(target, longest, buckets), unit)
    scored = scores(docs, gains, longest, seed, unit)
    scored = scored.withColumns({"down": -F.col("score"), "id": F.coalesce("doc_id", F.lit(LAST_ID)), "eligible": F.col("n_words") >= least_words})
    scored = written(scored.drop("n_words"), "scores")
    keys = ["down", "id", "row"]
    eligible = scored.where("eligible")
    wanted = share[0] * eligible.count() // share[1]
    columns = ["doc_id", "n_features", "weight", "score"]
    if not wanted:
        return scored.select(*columns, F.lit(None).cast("long").alias("rank"))
    drawn = F.col("eligible") & up_to(keys, cutoff(eligible.select(*keys), keys, wanted))
    ranked = numbered(scored.where(drawn), keys, "rank")
    return ranked.select(*columns, "rank").unionByName(scored.where(~drawn).select(*columns, F.lit(None).cast("long").alias("rank")))

