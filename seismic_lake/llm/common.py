"""Helpers shared by the text operators: the shared folder, text as byte blocks, words, id order."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seismic_lake import session
from seismic_lake.session import shared_folder  # noqa: F401

BLOCK_BYTES = 1 << 20  # text handled at once inside a task; numpy temporaries are a few dozen times that

MIX_A, MIX_B = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
BASE = 0x9E3779B97F4A7C15 | 1
BASE_INVERSE = pow(BASE, -1, 1 << 64)

ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[65:91] += 32
NOT_SPACE = np.ones(256, dtype=bool)  # [^\x20\x09-\x0D]
NOT_SPACE[[32, 9, 10, 11, 12, 13]] = False
WORD = np.zeros(256, dtype=bool)  # digits, lower-case letters, everything beyond ASCII
WORD[48:58] = WORD[97:123] = WORD[128:] = True


def written(df: DataFrame, name: str) -> DataFrame:
    return session.written(df, f"llm/{name}")


def tasks(spark: SparkSession, at_least: int = 1) -> int:
    return max(at_least, int(spark.conf.get("spark.sql.shuffle.partitions")))


def mix64(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit values."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(33))) * MIX_A
        x = (x ^ (x >> np.uint64(33))) * MIX_B
        return x ^ (x >> np.uint64(33))


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.ones(max(n, 1), dtype=np.uint64)
    filled, step = 1, base
    with np.errstate(over="ignore"):
        while filled < n:
            more = min(filled, n - filled)
            out[filled : filled + more] = out[:more] * np.uint64(step)
            filled += more
            step = step * step % (1 << 64)
    return out[:n]


class Powers:
    """Powers of BASE and of its inverse, grown on demand."""

    up, down = powers(BASE, 1), powers(BASE_INVERSE, 1)

    @classmethod
    def get(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            cls.up, cls.down = powers(BASE, n), powers(BASE_INVERSE, n)
        return cls.up, cls.down


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Sums to hash any stretch of ``data`` with :func:`stretch_hash`."""
    up, _ = Powers.get(len(data) + 1)
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=out[1:])
    return out


def stretch_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    _, down = Powers.get(len(sums))
    with np.errstate(over="ignore"):
        return mix64((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


def text_blocks(texts: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, UTF-8 bytes, offsets) of whole texts, about ``limit`` bytes at a time; NULL is empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    n = len(texts)
    if not n:
        return
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + n + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        end = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1)
        yield first, end, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


def words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of texts laid end to end, and each text's first word (with a last entry)."""
    inside = table[data]
    breaks = offsets[:-1][offsets[:-1] < len(data)]
    begins, ends = inside.copy(), inside.copy()
    if len(data):
        begins[1:] &= ~inside[:-1]
        begins[breaks] = inside[breaks]
        ends[:-1] &= ~inside[1:]
        before = breaks[breaks > 0] - 1
        ends[before] = inside[before]
    start = np.flatnonzero(begins)
    return start, np.flatnonzero(ends) + 1, np.searchsorted(start, offsets)


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return stretch_hash(prefix_hashes(data), start, end)


def id_bucket(docs: DataFrame, key: str, buckets: int) -> Column:
    """The range of ids a row is in, 0 to ``buckets`` - 1, by approximate quantiles of the ids.

    The bounds are at most ``buckets`` numbers; the same expression gives the same bucket in any
    later run of a task. NULL ids go first.
    """
    if buckets < 2:
        return F.lit(0)
    shares = [i / buckets for i in range(1, buckets)]
    bounds = docs.agg(F.percentile_approx(key, shares, 100 * buckets).alias("b")).first()["b"]
    bounds = F.array(*[F.lit(b) for b in sorted(set(bounds or []))]).cast("array<bigint>")
    return F.coalesce(F.size(F.filter(bounds, lambda b: b <= F.col(key))), F.lit(0))


def crc32_sql(text: str) -> str:
    """Unsigned crc32 of a text's UTF-8 bytes in DuckDB, which has none: by its definition, bit by bit."""
    octets = f"[('0x' || substr(hex(encode({text})), 2 * i - 1, 2))::BIGINT FOR i IN range(1, octet_length(encode({text})) + 1)]"
    eight_bits = "list_reduce(range(8), lambda r, k: CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END, xor(c, b))"
    return f"xor(4294967295::BIGINT, list_reduce({octets}, lambda c, b: {eight_bits}, 4294967295::BIGINT))"
