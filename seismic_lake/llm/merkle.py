"""A Merkle manifest of a dataset: digests of all rows, a tree over each group, a tree over the groups.

H is SHA-256 as lower-case hex, of texts laid end to end. A row's leaf is H of its columns, each as ``-`` if NULL,
else its length in UTF-8 bytes, ``:`` and its value. Within a group the leaves stand in ascending order; while there is
more than one node, every ``ARITY`` consecutive ones (the last run has fewer, even one) become their H. What
remains is the group's root, and the roots in ascending order of the group (NULL first, bytewise) have a tree likewise.

A tree is stored as blocks of ``HEIGHT`` levels. A block's nodes lie in one array in the van Emde Boas order: the
levels are split at half height, the top half is stored first and then each subtree hanging from it, each
recursively in the same order, so a walk between a leaf and the root touches few stretches of memory whatever
the size of a cache line or page is. :func:`address` is the arithmetic that finds a node; building a block and
reading the siblings of a proof both go by it. A block is the work of one group of at most ARITY**HEIGHT leaves; the
roots of a level's blocks are the leaves of the next level's, so a group that holds most rows is
many blocks, and the number of levels grows with the logarithm of the largest group.

Rows that lack the group or the order columns stand first. Rows that tie in order stand by their leaves, and equal
rows are each a leaf of their own. An empty table has no rows and no root; columns that are not named stay out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from seismic_lake.llm.common import tasks, written

ARITY = 8
HEIGHT = 4  # levels between a block's leaves and its root: at most 4,096 leaves and 4,681 nodes of 32 bytes
DIGEST = 32
PLACE = 33  # bits that Spark gives to a row's place in its partition

BLOCKS = "g string, size long, block long, n int, height int, root binary, nodes binary"
PATHS = "g string, i long, top array<struct<left:string,right:string>>, subroot string"
BLOCK_TYPE = pa.schema(
    [
        ("g", pa.string()),
        ("size", pa.int64()),
        ("block", pa.int64()),
        ("n", pa.int32()),
        ("height", pa.int32()),
        ("root", pa.binary()),
        ("nodes", pa.binary()),
    ]
)
SIDES = pa.struct([("left", pa.string()), ("right", pa.string())])
PATH_TYPE = pa.schema([("g", pa.string()), ("i", pa.int64()), ("top", pa.list_(SIDES)), ("subroot", pa.string())])


def nodes_of(levels: int) -> int:
    return (ARITY**levels - 1) // (ARITY - 1)


@lru_cache(maxsize=None)  # one entry for each (depth, levels), at most HEIGHT + 1 of each
def _addresses(depth: int, levels: int) -> np.ndarray:
    index = np.arange(ARITY**depth, dtype=np.int64)
    return address(depth, index, levels)


def address(depth: int, index: np.ndarray, levels: int) -> np.ndarray:
    """Where the nodes ``index`` of the level ``depth`` (0: the root) stand in a tree of ``levels`` levels."""
    if levels == 1:
        return np.zeros_like(index)
    top = levels // 2
    if depth < top:
        return address(depth, index, top)
    below = levels - top
    under = ARITY ** (depth - top)  # nodes of this level in one of the lower subtrees
    return nodes_of(top) + index // under * nodes_of(below) + address(depth - top, index % under, below)


def height_of(n: int) -> int:
    """Levels above ``n`` nodes until one remains."""
    height = 0
    while n > 1:
        n, height = -(-n // ARITY), height + 1
    return height


def digest(parts: list[bytes]) -> bytes:
    """H of digests: their hex texts laid end to end."""
    return hashlib.sha256(b"".join(parts).hex().encode()).digest()


def build_block(leaves: list[bytes], height: int) -> bytes:
    """The nodes of a tree of ``height`` levels above the leaves; places without a node are zeros."""
    levels = height + 1
    nodes = np.zeros((nodes_of(levels), DIGEST), dtype=np.uint8)
    row = leaves
    nodes[_addresses(height, levels)[: len(row)]] = np.frombuffer(b"".join(row), dtype=np.uint8).reshape(-1, DIGEST)
    for depth in range(height - 1, -1, -1):
        row = [digest(row[i : i + ARITY]) for i in range(0, len(row), ARITY)]
        nodes[_addresses(depth, levels)[: len(row)]] = np.frombuffer(b"".join(row), dtype=np.uint8).reshape(-1, DIGEST)
    return nodes.tobytes()


def paths(nodes: bytes, n: int, height: int) -> list[list[tuple[str, str]]]:
    """For each leaf of a block its siblings level by level, as the hex text before and after it in its run."""
    levels = height + 1
    table = np.frombuffer(nodes, dtype=np.uint8).reshape(-1, DIGEST)
    widths = [n]  # nodes of each level, leaves first
    for _ in range(height):
        widths.append(-(-widths[-1] // ARITY))
    above: list[list[tuple[str, str]]] = [[]]
    for depth in range(1, levels):
        width = widths[height - depth]
        texts = table[_addresses(depth, levels)[:width]].tobytes().hex()
        run = ARITY * DIGEST * 2
        own = []
        for parent, first in enumerate(range(0, len(texts), run)):
            siblings = texts[first : first + run]
            for k in range(0, len(siblings), DIGEST * 2):
                own.append([(siblings[:k], siblings[k + DIGEST * 2 :]), *above[parent]])
        above = own
    return above


def fold(leaf: str, path: list[tuple[str, str]]) -> str:
    """The root that a leaf and its siblings give."""
    for left, right in path:
        leaf = hashlib.sha256((left + leaf + right).encode()).hexdigest()
    return leaf


def leaf_of(columns: list[Column]) -> Column:
    """H of column values, each told apart from its neighbours by its length."""

    def part(c: Column) -> Column:
        text = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*[part(c) for c in columns]), 256)


def numbered(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` with ``i``, their place (from 0) in ascending order of ``keys`` (NULL first) within their group ``g``, and its ``size``.

    Rows are dealt to ranges of (g, keys), so a group that holds most rows is many ranges; a range's
    rows are counted by group, and the counts of the ranges before it are added.
    """
    # the last key sets apart rows that are equal in all others, so that they need not share a range
    order = ["g", *[F.col(k).asc_nulls_first() for k in keys], "row"]
    dealt = rows.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(tasks(rows.sparkSession), *order)
    place = F.monotonically_increasing_id()
    placed = dealt.sortWithinPartitions(*order).drop("row")
    placed = written(placed.withColumns({"part": F.shiftright(place, PLACE), "place": place.bitwiseAND((1 << PLACE) - 1)}), "ranges")
    counted = placed.groupBy("g", "part").agg(F.count("*").alias("n"), F.min("place").alias("first"))
    group = W.partitionBy("g")  # a row for each range that the group has rows in
    before = F.sum("n").over(group.orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    counted = counted.select("g", "part", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"), F.sum("n").over(group).alias("size"))
    return placed.join(counted, ["g", "part"]).withColumn("i", F.col("shift") + F.col("place")).drop("part", "place", "shift")


def _blocks(nodes: DataFrame, height: int) -> DataFrame:
    """The blocks above ``nodes`` (g, size, i, leaf), ``size`` being the number of nodes of the group."""
    width = ARITY**height

    def block(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("i")
        leaves, size = rows.column("leaf").to_pylist(), rows.column("size")[0].as_py()
        levels = height if size > width else height_of(size)
        stored = build_block(leaves, levels)
        row = {"g": rows.column("g")[:1].to_pylist(), "size": [size], "block": [rows.column("i")[0].as_py() // width], "n": [len(leaves)]}
        return pa.table(row | {"height": [levels], "root": [stored[:DIGEST]], "nodes": [stored]}, schema=BLOCK_TYPE)

    return nodes.groupBy("g", F.floor(F.col("i") / width)).applyInArrow(lambda rows: block(rows), BLOCKS)


def _forest(nodes: DataFrame, height: int) -> list[DataFrame]:
    """The blocks of a tree over each group, lowest level first.

    A group that fits one block ends there; the roots of the others' blocks are the next level's nodes.
    """
    largest = nodes.agg(F.max("size")).first()[0] or 0
    width, levels = ARITY**height, []
    while largest:
        levels.append(written(_blocks(nodes, height), "blocks"))
        if largest <= width:
            break
        size = F.ceil(F.col("size") / width).alias("size")
        nodes = levels[-1].where(F.col("size") > width).select("g", size, F.col("block").alias("i"), F.col("root").alias("leaf"))
        largest = -(-largest // width)
    return levels


def _roots(levels: list[DataFrame]) -> DataFrame:
    """(g, root) of each group, which is in the highest level that the group reaches."""
    every = reduce(DataFrame.unionAll, [blocks.select("g", F.lit(k).alias("k"), "root") for k, blocks in enumerate(levels)])
    return every.groupBy("g").agg(F.max_by("root", "k").alias("root"))


@dataclass(frozen=True)
class Manifest:
    """The rows with their places (g, i, leaf and what was kept), the blocks of the groups' trees and of the tree over the groups.

    ``tops`` (g, i, leaf, name) are the groups' roots; ``name`` is ``-`` for the group NULL, else ``=`` and its value.
    """

    rows: DataFrame
    groups: list[DataFrame]
    tops: DataFrame | None
    over: list[DataFrame]
    height: int

    def root(self) -> str | None:
        return _roots(self.over).first()["root"].hex() if self.over else None


def manifest(rows: DataFrame, group: str, order: list[str], leaf: Column, keep: dict[str, Column], height: int = HEIGHT) -> Manifest:
    """Digest all rows and build the trees; ``keep`` names what to carry along, such as an id.

    Each text is read once, and only digests and the kept columns are shuffled.
    """
    name = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("-"))
    keys = {f"key{k}": F.col(c) for k, c in enumerate(order)}
    columns = {"g": name, "leaf": F.unhex(leaf), **{f"kept_{n}": c for n, c in keep.items()}, **keys}
    hashed = written(rows.select(*[c.alias(n) for n, c in columns.items()]), "leaves")
    placed = written(numbered(hashed, [*keys, "leaf"]).drop(*keys), "placed")
    groups = _forest(placed.select("g", "size", "i", "leaf"), height)
    if not groups:
        return Manifest(placed, [], None, [], height)
    tops = _roots(groups).select(F.lit("").alias("g"), F.col("g").alias("name"), F.col("root").alias("leaf"))
    tops = written(numbered(tops, ["name"]), "tops")
    return Manifest(placed, groups, tops, _forest(tops.select("g", "size", "i", "leaf"), height), height)


def _below(blocks: DataFrame, height: int) -> DataFrame:
    """(g, i, top, subroot) of every leaf of blocks that have theirs: its path to the root of all."""
    width = ARITY**height

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                own = paths(row["nodes"], row["n"], row["height"])
                texts = [[{"left": a, "right": b} for a, b in path] + row["top"] for path in own]
                index = [row["block"] * width + k for k in range(row["n"])]
                out = {"g": [row["g"]] * row["n"], "i": index, "top": texts, "subroot": [row["subroot"]] * row["n"]}
                yield pa.RecordBatch.from_pydict(out, schema=PATH_TYPE)

    return blocks.mapInArrow(expand, PATHS)


def _descend(levels: list[DataFrame], entry: DataFrame, height: int) -> DataFrame:
    """The lowest blocks with ``top``, the path from their root to the root of all, and ``subroot``, their group's root.

    ``entry`` (g, top, subroot) has the path above each group's own root.
    """
    above = None
    for k in range(len(levels) - 1, -1, -1):
        blocks = levels[k]
        first = entry.select("g", F.lit(0).cast("long").alias("block"), "top", "subroot")
        if above is not None:  # groups that end at this level start here, the others come from the level above
            first = first.join(levels[k + 1].select("g"), "g", "left_anti")
            above = first.unionByName(above.withColumnRenamed("i", "block"))
        else:
            above = first
        blocks = blocks.join(above, ["g", "block"])
        if k:
            above = _below(blocks, height)
    return blocks


def prove(m: Manifest, claim: str | None = None, with_path: bool = False) -> DataFrame:
    """For every row its kept columns, ``leaf``, ``subroot``, ``proof_sha256`` (H of all siblings on the way to the root, lowest
    first) and ``folded_root``, the root that its siblings give for it; with ``with_path``, the siblings as well.

    ``claim`` names a kept column with another leaf (binary) to fold instead of the row's own.
    """
    spark, kept = m.rows.sparkSession, [c for c in m.rows.columns if c.startswith("kept_")]
    names = [c.removeprefix("kept_") for c in kept]
    types = [m.rows.schema[c].dataType.simpleString() for c in kept]
    schema = ", ".join([*map(" ".join, zip(names, types, strict=True)), "leaf string, subroot string, proof_sha256 string, folded_root string"])
    schema += ", path array<struct<left:string,right:string>>" if with_path else ""
    if not m.over:
        return spark.createDataFrame([], schema)
    start = spark.createDataFrame([("", [], "")], "g string, top array<struct<left:string,right:string>>, subroot string")
    tops = _below(_descend(m.over, start, m.height), m.height).select("i", "top")
    entry = m.tops.join(tops, "i").select(F.col("name").alias("g"), "top", F.lower(F.hex("leaf")).alias("subroot"))
    blocks = _descend(m.groups, written(entry, "entry"), m.height).withColumnRenamed("block", "b").drop("size")
    width = ARITY**m.height

    def follow(rows: pa.Table, block: pa.Table) -> pa.Table:
        there = block.to_pylist()[0]
        own, top = paths(there["nodes"], there["n"], there["height"]), [(p["left"], p["right"]) for p in there["top"]]
        leaves = rows.column("leaf").to_pylist()
        claims = rows.column(f"kept_{claim}").to_pylist() if claim else leaves
        proofs, folded, whole = [], [], []
        for i, claimed in zip(rows.column("i").to_pylist(), claims, strict=True):
            path = own[i % width] + top
            proofs.append(hashlib.sha256("".join([side for pair in path for side in pair]).encode()).hexdigest())
            folded.append(fold(claimed.hex(), path))
            if with_path:
                whole.append([{"left": a, "right": b} for a, b in path])
        out = {n: rows.column(c) for n, c in zip(names, kept, strict=True)}
        out |= {"leaf": [x.hex() for x in leaves], "subroot": [there["subroot"]] * len(leaves), "proof_sha256": proofs, "folded_root": folded}
        return pa.table(out | ({"path": pa.array(whole, PATH_TYPE.field("top").type)} if with_path else {}))

    rows = m.rows.withColumn("b", F.floor(F.col("i") / width))
    return rows.groupBy("g", "b").cogroup(blocks.groupBy("g", "b")).applyInArrow(lambda left, right: follow(left, right), schema)


COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def report(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every document, groups by ``lang``.

    Documents whose id's crc32 is divisible by three are held against the manifest with a text whose A-Z are lower-cased; a
    document without an id is not among them.
    """
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    text = F.when(tampered, F.translate("text", upper, lower)).otherwise(F.col("text"))
    leaf = leaf_of([F.col(c) for c in COLUMNS])
    claim = F.unhex(leaf_of([text if c == "text" else F.col(c) for c in COLUMNS]))
    m = manifest(docs, "lang", ["doc_id"], leaf, {"doc_id": F.col("doc_id").cast("long"), "claim": claim})
    root = F.lit(m.root()).cast("string")
    proven = prove(m, "claim")
    return proven.select("doc_id", "leaf", "subroot", root.alias("root"), "proof_sha256", "folded_root", (F.col("folded_root") == root).alias("verified"))
