"""Token ids in files of bit planes.

A file holds the ids of a range of documents, in ascending order of doc_id, each document ended by
``END``. The ids are cut into chunks of ``CHUNK`` ids. A chunk is transposed into bit planes (plane b
holds bit b of every id, eight ids to a byte, first id in the highest bit; only planes that any id of the
chunk needs are kept) or, with ``planes="byte"``, byte planes; each plane is compressed by itself with
zstandard and the planes follow each other in ``data``. A file is a table of chunks, so its columns
are the chunk index: ``part`` and ``chunk`` (its place), ``first`` (ids before it in the part),
``n_ids``, ``sizes`` (bytes of each plane), ``docs`` (id, first place in the part and number of ids of
each document that has ids in the chunk). Spark's committer writes the table, so a lost executor
leaves no half file, and any Hadoop folder can hold it.

NULL and empty texts have the end id alone. Rows that repeat a doc_id are all written, next to each
other; rows without doc_id come first. No rows give an empty file.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from seismic_lake.llm.common import shared_folder, tasks
from seismic_lake.llm.encoder import byte_bpe

END = 2
CHUNK = 1 << 16
ROWS = 256  # texts encoded at once
SCHEMA = (
    "part int, chunk long, first long, n_ids int, width int, sizes array<int>, data binary, "
    "docs array<struct<doc_id:long,start:long,n:long>>"
)
CHUNK_TYPE = pa.schema(
    [
        ("part", pa.int32()),
        ("chunk", pa.int64()),
        ("first", pa.int64()),
        ("n_ids", pa.int32()),
        ("width", pa.int32()),
        ("sizes", pa.list_(pa.int32())),
        ("data", pa.binary()),
        ("docs", pa.list_(pa.struct([("doc_id", pa.int64()), ("start", pa.int64()), ("n", pa.int64())]))),
    ]
)


def to_planes(ids: np.ndarray, planes: str = "bit") -> tuple[int, list[bytes]]:
    """Bits to a plane, and the planes."""
    if planes == "byte":
        raw = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
        used = max(1, -(-int(ids.max()).bit_length() // 8))
        return 8, [np.ascontiguousarray(raw[:, k]).tobytes() for k in range(used)]
    used = max(1, int(ids.max()).bit_length())
    return 1, [np.packbits((ids >> np.uint32(b)).astype(np.uint8) & 1).tobytes() for b in range(used)]


def from_planes(width: int, planes: list[bytes], n: int) -> np.ndarray:
    ids = np.zeros(n, dtype=np.uint32)
    for k, plane in enumerate(planes):
        flat = np.frombuffer(plane, dtype=np.uint8)
        values = flat if width == 8 else np.unpackbits(flat, count=n)
        ids |= values.astype(np.uint32) << np.uint32(k * width)
    return ids


def write(documents: DataFrame, path: str, vocabulary: str, planes: str = "bit", level: int = 1, chunk: int = CHUNK) -> None:
    """Encode all texts and write them to ``path`` in ascending order of doc_id."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, pack = byte_bpe(vocabulary), zstandard.ZstdCompressor(level=level)
        part = TaskContext.get().partitionId()
        held, docs = np.zeros(0, dtype=np.uint32), []  # ids and documents not yet in a chunk
        number, first, total = 0, 0, 0

        def cut(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, docs, number, first
            while len(held) >= chunk or last and len(held):
                ids, held = held[:chunk], held[chunk:]
                end = first + len(ids)
                width, raw = to_planes(ids, planes)
                packed = [pack.compress(p) for p in raw]
                own = [d for d in docs if d["start"] < end]
                row = dict(part=part, chunk=number, first=first, n_ids=len(ids), width=width)
                row |= dict(sizes=[len(p) for p in packed], data=b"".join(packed), docs=own)
                yield pa.RecordBatch.from_pylist([row], schema=CHUNK_TYPE)
                docs = [d for d in docs if d["start"] + d["n"] > end]
                number, first = number + 1, end

        for batch in batches:
            for k in range(0, len(batch), ROWS):
                rows = batch.slice(k, ROWS)
                ids, at = encoder.batch(rows.column("text").to_pylist())
                ids = np.insert(ids, at[1:], END)
                at = at + np.arange(len(at))
                for doc_id, start, n in zip(rows.column("doc_id").to_pylist(), at[:-1].tolist(), np.diff(at).tolist(), strict=True):
                    docs.append({"doc_id": doc_id, "start": total + start, "n": n})
                total += len(ids)
                held = np.concatenate([held, ids])
                yield from cut(False)
        yield from cut(True)

    ordered = (
        documents.select(F.col("doc_id").cast("long"), "text")
        .repartitionByRange(tasks(documents.sparkSession), "doc_id")
        .sortWithinPartitions("doc_id", "text")
    )
    ordered.mapInArrow(encode, SCHEMA).write.option("compression", "uncompressed").parquet(path)


def chunk_ids(sizes: list[int], data: bytes, width: int, n: int) -> np.ndarray:
    unpack = zstandard.ZstdDecompressor()
    ends = np.cumsum(sizes).tolist()
    return from_planes(width, [unpack.decompress(data[e - s : e]) for s, e in zip(sizes, ends, strict=True)], n)


def _times(a: int, b: int) -> int:
    """Product of two polynomials modulo the checksum's (bits reflected)."""
    out = 0
    while b:
        if b & 0x80000000:
            out ^= a
        a = (a >> 1) ^ (0xEDB88320 if a & 1 else 0)
        b = (b << 1) & 0xFFFFFFFF
    return out


def joined_crc(a: int, b: int, n_bytes: int) -> int:
    """crc32 of two stretches end to end, from theirs and the second's length."""
    power, square, n = 0x80000000, 0x00800000, n_bytes  # x**0 and x**8
    while n:
        if n & 1:
            power = _times(power, square)
        square = _times(square, square)
        n >>= 1
    return _times(a, power) ^ b


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document in the files.

    Chunks are decoded where they are read; a document that crosses chunks is put together from the
    checksums of its stretches, not from its ids.
    """
    chunks = spark.read.schema(SCHEMA).parquet(path)
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = chunks.groupBy("part").agg(F.sum("n_ids").alias("ids"))  # a row for each task that wrote
    parts = parts.select("part", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, first = chunk_ids(row["sizes"], row["data"], row["width"], row["n_ids"]), row["first"]
                out = []
                for d in row["docs"]:
                    begin, end = max(d["start"], first), min(d["start"] + d["n"], first + row["n_ids"])
                    crc = zlib.crc32(ids[begin - first : end - first].astype("<u4").tobytes())
                    out.append(d | {"part": row["part"], "at": begin, "length": end - begin, "crc": crc})
                yield pa.RecordBatch.from_pylist(out, schema=stretch)

    stretch = pa.schema([(c, pa.int32() if c == "part" else pa.int64()) for c in ("part", "doc_id", "start", "n", "at", "length", "crc")])
    stretches = chunks.mapInArrow(decode, "part int, doc_id long, start long, n long, at long, length long, crc long")
    lists = stretches.groupBy("part", "start", "doc_id", "n").agg(F.array_sort(F.collect_list(F.struct("at", "length", "crc"))).alias("s"))

    def put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for stretches in batch.column("s").to_pylist():
                crc = stretches[0]["crc"]
                for s in stretches[1:]:
                    crc = joined_crc(crc, s["crc"], 4 * s["length"])
                out.append(crc)
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(out, pa.int64())], names=["part", "start", "doc_id", "n", "crc"])

    whole = lists.mapInArrow(put_together, "part int, start long, doc_id long, n long, crc long")
    return whole.join(parts, "part").select(
        "doc_id", (F.col("base") + F.col("start")).alias("start"), F.col("n").alias("n_tokens"), F.col("crc").alias("ids_crc32")
    )


def round_trip(documents: DataFrame, vocabulary: str) -> DataFrame:
    spark = documents.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/llm/tokens-{uuid.uuid4().hex}"
    write(documents, path, vocabulary)
    return read(spark, path)
