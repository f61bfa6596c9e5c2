"""Near-duplicate documents by SetSketch registers, banded, estimated by likelihood, then verified.

A document is its set of distinct word shingles; sets with 100 * intersection >= 80 * union are linked.

1. ``sketches``: each set becomes ``REGISTERS`` registers. A register is the truncated exponent, to base
   ``BASE``, of the least of exponentially distributed values drawn for the set's elements. Registers of a
   union are the maxima of the registers, and equal with a chance close to the sets' likeness.
2. Documents with one and the same set stand behind one representative.
3. Bands of ``ROWS`` registers put likely partners into buckets; a pair of likeness 0.8 shares none of the
   ``BANDS`` bands with a chance of 1e-5.
4. Every member is held against one hub: of the members that meet most others, the one most of its buckets
   name, as a rule the base that its copies were made from.
5. Members of buckets that still hold several components meet by exact prefixes: with shingles in one order,
   common ones last, two linked sets share one of their first few, with enough of both sets left from there on
   to be linked. Large groups of a prefix are dealt to blocks. No candidate is dropped but by the likelihood of
   its registers (1e-7 odds against a likeness of 0.8) or by its exact sets.
6. Components come from alternating star joins on the verified links.

Words, shingles and links follow the caller's number of words. NULL and blank texts have the empty set and
are linked with nothing. Rows that repeat a doc_id share its component; rows without doc_id have none
(component NULL, kept). An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seismic_lake.llm.common import (
    ASCII_LOWER,
    BASE as HASH_BASE,
    NOT_SPACE,
    mix64,
    powers,
    text_blocks,
    word_hashes,
    words,
    written,
)

ROWS, BANDS = 7, 48  # likeness 0.8 shares a band with a chance of 1 - 1e-5, likeness 0.5 with one of 0.3
REGISTERS = ROWS * BANDS
BASE, RATE, TOP = 1.001, 20.0, (1 << 16) - 2
LIKENESS = 80  # percent
DOUBT = 14.0  # log likelihood a likeness of 0.8 may lie under the best one
BLOCK = 512  # members of a group on each side of a block
CELLS, ORDER_ROWS = 1 << 20, 20_000  # counts that put common shingles last, and about how many sets are counted
MULTIPLY = mix64(np.arange(1, REGISTERS + 1, dtype=np.uint64)) | np.uint64(1)
ADD = mix64(np.arange(1001, REGISTERS + 1001, dtype=np.uint64))


def shingle_hashes(data: np.ndarray, offsets: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """The distinct shingles of each text as sorted 64-bit hashes."""
    data = ASCII_LOWER[data]
    start, end, at = words(data, offsets, NOT_SPACE)
    hashes = word_hashes(data, start, end)
    weight = powers(HASH_BASE ^ 0x5555, size + 1)
    n = len(hashes)
    with np.errstate(over="ignore"):
        sums = np.zeros(max(n - size + 1, 0), dtype=np.uint64)
        for j in range(size):
            sums += hashes[j : j + len(sums)] * weight[j]
        sums = mix64(sums)
        for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            if b - a >= size:
                yield np.unique(sums[a : b - size + 1])
            elif b > a:
                short = (hashes[a:b] * weight[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a) * weight[size]
                yield mix64(np.array([short], dtype=np.uint64))
            else:
                yield np.zeros(0, dtype=np.uint64)


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """SetSketch registers of each set, one row each; empty sets have zeros."""
    out = np.zeros((len(sets), REGISTERS), dtype=np.uint16)
    full = [k for k, s in enumerate(sets) if len(s)]
    at = 0
    while at < len(full):  # a run of sets that fits the processor's cache
        end, size = at, 0
        while end < len(full) and (end == at or size + len(sets[full[end]]) <= 1 << 15):
            size += len(sets[full[end]])
            end += 1
        run = full[at:end]
        values = np.concatenate([sets[k] for k in run])
        starts = np.cumsum([0, *(len(sets[k]) for k in run[:-1])])
        least = np.empty((len(run), REGISTERS), dtype=np.uint64)
        with np.errstate(over="ignore"):
            for i in range(REGISTERS):
                least[:, i] = np.minimum.reduceat(values * MULTIPLY[i] + ADD[i], starts)
        # The least hash gives the least exponential value: -log(1 - u) / RATE grows with u.
        x = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**64) / RATE
        out[run] = np.clip(np.floor(1 - np.log(np.maximum(x, 1e-300)) / np.log(BASE)), 0, TOP + 1).astype(np.uint16)
        at = end
    return out


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union of two sets."""
    return np.maximum(a, b)


def _chance(x: np.ndarray) -> np.ndarray:
    return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)


def log_likelihood(j: np.ndarray, share: np.ndarray, more: np.ndarray, less: np.ndarray, same: np.ndarray) -> np.ndarray:
    """Of likeness j, given the first set's share of both sizes and how many registers are more, less, the same."""
    p, q = _chance(share - (1 - share) * j), _chance((1 - share) - share * j)
    tiny = 1e-12
    return more * np.log(np.maximum(p, tiny)) + less * np.log(np.maximum(q, tiny)) + same * np.log(np.maximum(1 - p - q, tiny))


def possible(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Whether a likeness of 0.8 or more is not ruled out by sizes and registers."""
    share = n_a / (n_a + n_b)
    more, less, same = (a > b).sum(1), (a < b).sum(1), (a == b).sum(1)
    most = np.minimum(share / (1 - share), (1 - share) / share)
    goal = LIKENESS / 100
    below = np.max([log_likelihood(np.minimum(j, most), share, more, less, same) for j in np.linspace(0, goal, 33)], axis=0)
    above = np.max([log_likelihood(np.minimum(j, most), share, more, less, same) for j in np.linspace(goal, 1, 9)], axis=0)
    return (100 * np.minimum(n_a, n_b) >= LIKENESS * np.maximum(n_a, n_b)) & (above >= below - DOUBT)


def sketches(documents: DataFrame, size: int) -> DataFrame:
    """(doc_id, n_shingles, set_a, set_b, sketch) of each row; set_a and set_b name the set."""
    schema = "doc_id long, n_shingles long, set_a long, set_b long, sketch binary"

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in text_blocks(batch.column("text")):
                sets = list(shingle_hashes(data, offsets, size))
                with np.errstate(over="ignore"):
                    a = np.array([s.sum(dtype=np.uint64) for s in sets], dtype=np.uint64)
                    b = np.array([mix64(s ^ np.uint64(HASH_BASE)).sum(dtype=np.uint64) for s in sets], dtype=np.uint64)
                columns = [
                    batch.column("doc_id").slice(first, end - first),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(a.view(np.int64)),
                    pa.array(b.view(np.int64)),
                    pa.array([row.tobytes() for row in registers(sets)], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_shingles", "set_a", "set_b", "sketch"])

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(draw, schema)


def _buckets(reps: DataFrame) -> DataFrame:
    """(bucket, rep) for every bucket with company."""
    bands = F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda i: F.xxhash64(i, F.substring(F.col("sketch"), i * (2 * ROWS) + 1, F.lit(2 * ROWS))),
    )
    members = reps.select("rep", F.explode(bands).alias("bucket"))
    shared = members.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket")
    return members.join(shared, "bucket", "left_semi")


def _size_classes() -> np.ndarray:
    """The least size of each class: sizes within 5 percent, small ones each by itself."""
    least = [1]
    while least[-1] < 1 << 40:
        least.append(max(least[-1] + 1, least[-1] * 21 // 20))
    return np.array(least, dtype=np.int64)


SIZE_CLASSES = _size_classes()


def prefix_keys(shingles: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of a set, its sides there and how many of its shingles are left from each on: any two sets of likeness 0.8 or more have a key in common.

    Shingles are taken in one order for all sets, by the count of their cell and then by hash. Sets of n and m
    shingles that are linked share c >= 4 (n + m) / 9 of them, hence one of the first n - c + 1 and m - c + 1.
    A key is such a shingle with the classes of both sizes; the other size is taken at its class's least. Under
    keys of two classes the smaller sets (side 1) and the greater ones (side 2) meet, else all (side 0). At the
    first shingle in common, c are left of both sets, which is tested with the sets' own sizes where they meet.
    """
    n = len(shingles)
    if not n:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int8), np.zeros(0, dtype=np.int64)
    shingles = shingles[np.lexsort((shingles, order[(shingles % np.uint64(CELLS)).astype(np.int64)]))]
    least, most = -(-LIKENESS * n // 100), 100 * n // LIKENESS
    own, low, high = (int(c) for c in np.searchsorted(SIZE_CLASSES, [n, least, most], side="right") - 1)
    out, sides, left = [], [], []
    with np.errstate(over="ignore"):
        for other in range(low, high + 1):
            both = n + max(least, int(SIZE_CLASSES[other]))
            common = -(-LIKENESS * both // (100 + LIKENESS))
            pair = np.uint64(min(own, other) * len(SIZE_CLASSES) + max(own, other) + 1)
            out.append(mix64(shingles[: max(n - common + 1, 0)] + mix64(np.array([pair], dtype=np.uint64))))
            sides.append(np.full(len(out[-1]), 0 if own == other else 1 if own < other else 2, dtype=np.int8))
            left.append(n - np.arange(len(out[-1]), dtype=np.int64))
    return np.concatenate(out), np.concatenate(sides), np.concatenate(left)


def _order(members: DataFrame, size: int) -> np.ndarray:
    """How many shingles fall to each cell, of about ``ORDER_ROWS`` sets. Any order gives the same links."""

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CELLS, dtype=np.int64)
        for batch in batches:
            for _, _, data, offsets in text_blocks(batch.column("text")):
                for s in shingle_hashes(data, offsets, size):
                    total[(s % np.uint64(CELLS)).astype(np.int64)] += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["cell", "n"])

    share = min(1.0, ORDER_ROWS / max(members.count(), 1))
    drawn = members.where(F.pmod(F.xxhash64("rep"), F.lit(1 << 30)) < int((1 << 30) * share)).select("text")
    found = drawn.mapInArrow(cells, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(CELLS, dtype=np.int32)
    out[found.column("cell").to_numpy()] = found.column("n").to_numpy()
    return out


def _prefixes(members: DataFrame, size: int) -> DataFrame:
    """(bucket, side, rep, component, size, left) for each prefix key of the members (rep, component, text)."""
    order = _order(members, size)

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in text_blocks(batch.column("text")):
                sets = list(shingle_hashes(data, offsets, size))
                found = [prefix_keys(s, order) for s in sets]
                many = [len(k) for k, _, _ in found]
                row = pa.array(np.repeat(np.arange(first, end), many))
                bucket, side, left = (np.concatenate(parts) for parts in zip(*found, strict=True))
                sizes = pa.array(np.repeat(np.array([len(s) for s in sets], dtype=np.int64), many))
                columns = [pa.array(bucket.view(np.int64)), pa.array(side), batch.column("rep").take(row), batch.column("component").take(row), sizes, pa.array(left)]
                yield pa.RecordBatch.from_arrays(columns, names=["bucket", "side", "rep", "component", "size", "left"])

    return members.select("rep", "component", "text").mapInArrow(keys, "bucket long, side byte, rep long, component long, size long, left long")


def _groups(members: DataFrame) -> DataFrame:
    """Of each bucket with several components: its members (of side 1, of side 2), largest component, members outside it."""
    count = lambda side: F.count_if(F.col("side") == side)
    sizes = members.groupBy("bucket", "component").agg(F.count("*").alias("n"), count(1).alias("low"), count(2).alias("high"))
    sizes = sizes.groupBy("bucket").agg(
        F.sum("n").alias("n"), F.sum("low").alias("low"), F.sum("high").alias("high"), F.max(F.struct("n", "component")).alias("m")
    )
    met = sizes.where("m.n < n AND (low + high = 0 OR low > 0 AND high > 0)")
    return met.select("bucket", "n", "low", "high", F.col("m.component").alias("most"), (F.col("n") - F.col("m.n")).alias("few"))


def _crossing(members: DataFrame, groups: DataFrame) -> DataFrame:
    """The pairs (a, b) of two components that meet in one of the groups and can be linked by what is left of both.

    Members outside the largest component are held against all they meet, and each group is cut into blocks on
    both sides: a row of the join is a pair of two components, but for those of the lesser components, and no
    key has more than about ``BLOCK`` rows a side.
    """
    placed = members.join(groups.select("bucket", "most", "few", "n", "low", "high"), "bucket")
    size = lambda zero, one, two: F.when(F.col("side") == 0, F.col(zero)).when(F.col("side") == 1, F.col(one)).otherwise(F.col(two))
    placed = placed.withColumns({"here": size("n", "low", "high"), "there": size("n", "high", "low")})
    cuts = lambda n: F.ceil(n / BLOCK).cast("int")
    part = lambda seed, n: F.pmod(F.xxhash64("rep", F.lit(seed)), cuts(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), cuts(n) - 1))
    few = lambda n: F.least(F.col("few"), F.col(n))
    other = F.when(F.col("side") == 0, 0).otherwise(3 - F.col("side")).cast("int")
    left = placed.where("component <> most").select(
        "bucket", F.col("side").cast("int").alias("side"), "most", F.col("rep").alias("a"), F.col("component").alias("x"), F.col("size").alias("n_a"), F.col("left").alias("left_a"), part(1, few("here")).alias("i"), every(F.col("there")).alias("j")
    )
    right = placed.select("bucket", other.alias("side"), F.col("rep").alias("b"), F.col("component").alias("y"), F.col("size").alias("n_b"), F.col("left").alias("left_b"), part(2, F.col("here")).alias("j"), every(few("there")).alias("i"))
    enough = F.least("left_a", "left_b") * (100 + LIKENESS) >= (F.col("n_a") + F.col("n_b")) * LIKENESS
    met = left.join(right, ["bucket", "side", "i", "j"]).where(F.expr("x <> y AND (y = most OR a < b)") & enough)
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _likely(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """The pairs (a, b) whose registers do not rule out a link."""
    side = lambda name: reps.select(F.col("rep").alias(name), F.col("n_shingles").alias(f"n_{name}"), F.col("sketch").alias(f"s_{name}"))
    both = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b")

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                s_a, s_b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint16).reshape(-1, REGISTERS) for c in ("s_a", "s_b"))
                n_a, n_b = (batch.column(c).to_numpy().astype(float) for c in ("n_a", "n_b"))
                keep = pa.array(possible(s_a, s_b, n_a, n_b))
                yield batch.select(["a", "b"]).filter(keep)

    return both.select("a", "b", "n_a", "n_b", "s_a", "s_b").mapInArrow(test, "a long, b long")


def _shingles(text: str, size: int) -> set[bytes]:
    found = (text or "").encode().lower().split()
    return {b" ".join(found[i : i + size]) for i in range(max(len(found) - size + 1, 1))} if found else set()


def _verified(pairs: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """The pairs whose full sets are linked. Pairs of one a come together, so its set is made once a task."""
    side = lambda name: texts.select(F.col("rep").alias(name), F.col("text").alias(f"t_{name}"))
    both = pairs.join(side("b"), "b").join(side("a"), "a").sortWithinPartitions("a")

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, own = None, set()
        for batch in batches:
            keep = []
            for a, t_a, t_b in zip(batch.column("a").to_pylist(), batch.column("t_a"), batch.column("t_b"), strict=True):
                if a != last:
                    last, own = a, _shingles(t_a.as_py(), size)
                other = _shingles(t_b.as_py(), size)
                common = len(own & other)
                keep.append(100 * common >= LIKENESS * (len(own) + len(other) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "t_a", "t_b").mapInArrow(test, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(node, component) for the nodes of the links (a, b): the least node reachable.

    Large-star and small-star steps in turn: every node hangs its greater, then its lesser neighbours on
    the least one it knows. Least neighbours are aggregates, so a node of any degree is no group.
    """
    edges = written(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    while _not_stars(edges):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
        edges = written(small.where("u <> v").distinct(), "edges")
    members = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return members.union(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _not_stars(edges: DataFrame) -> bool:
    """Whether a node hangs on two others, or on one that hangs itself."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("hangs"), F.lit(0).alias("holds"))
    ends = ends.union(edges.select("v", F.lit(0), F.lit(1))).groupBy("x").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds"))
    return bool(ends.where("hangs > 1 OR hangs > 0 AND holds > 0").limit(1).count())


def _hubs(buckets: DataFrame) -> DataFrame:
    """A pair (a, b) for each member and its hub: the hub most of its buckets name.

    A bucket names the member that meets most others, counted over all of that member's buckets.
    """
    sizes = buckets.groupBy("bucket").agg(F.count("*").alias("n"))
    meets = buckets.join(sizes, "bucket").groupBy("rep").agg((-F.sum("n")).alias("o"))
    hubs = buckets.join(meets, "rep").groupBy("bucket").agg(F.min(F.struct("o", F.col("rep").alias("hub"))).alias("h"))
    votes = buckets.join(hubs.select("bucket", "h.hub"), "bucket").where("rep <> hub").groupBy("rep", "hub").agg(F.count("*").alias("n"))
    best = votes.groupBy("rep").agg(F.max(F.struct("n", (-F.col("hub")).alias("h"))).alias("m"))
    return best.select(F.least(-F.col("m.h"), "rep").alias("a"), F.greatest(-F.col("m.h"), "rep").alias("b")).distinct()


def _open(buckets: DataFrame, found: DataFrame) -> DataFrame:
    """(rep, component) of the members of buckets that still hold more than one component."""
    named = buckets.join(found.withColumnRenamed("node", "rep"), "rep", "left")
    named = named.select("bucket", "rep", F.coalesce("component", "rep").alias("component"))
    split = named.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x < y").select("bucket")
    return named.join(split, "bucket", "left_semi").select("rep", "component").distinct()


def link(documents: DataFrame, size: int) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of ``documents``."""
    drawn = written(sketches(documents, size), "sketches")
    with_id = drawn.where("doc_id IS NOT NULL AND n_shingles > 0")
    reps = written(
        with_id.groupBy("set_a", "set_b").agg(F.min(F.struct("doc_id", "n_shingles", "sketch")).alias("m")).select(
            "set_a", "set_b", F.col("m.doc_id").alias("rep"), "m.n_shingles", "m.sketch"
        ),
        "sets",
    )
    buckets = written(_buckets(reps), "buckets")
    wanted = buckets.select("rep").distinct()
    texts = written(documents.select(F.col("doc_id").cast("long").alias("rep"), "text").join(wanted, "rep", "left_semi"), "texts")

    tried = written(_likely(_hubs(buckets), reps), "pairs")
    links = written(_verified(tried, texts, size), "links")
    found = components(links)
    keys = written(_prefixes(_open(buckets, found).join(texts, "rep"), size), "prefixes")
    pairs = _crossing(keys, written(_groups(keys), "groups")).join(tried, ["a", "b"], "left_anti")
    more = written(_verified(written(_likely(pairs, reps), "pairs"), texts, size), "links")
    if more.limit(1).count():
        found = components(links.union(more))

    named = reps.select("set_a", "set_b", "rep").join(found.withColumnRenamed("node", "rep"), "rep", "left")
    named = named.select("set_a", "set_b", F.coalesce("component", "rep").alias("component"))
    alone = drawn.where("doc_id IS NULL OR n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    linked = with_id.select("doc_id", "n_shingles", "set_a", "set_b").join(named, ["set_a", "set_b"])
    rows = linked.select("doc_id", "n_shingles", F.col("component").alias("component_id")).union(alone)
    return rows.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def remove(documents: DataFrame, size: int = 5) -> DataFrame:
    """One document of each component, all columns as they were; rows without doc_id stay."""
    dropped = link(documents, size).where("NOT kept").select(F.col("doc_id").alias("near_copy_id")).distinct()
    return documents.join(dropped, documents["doc_id"].cast("long") == dropped["near_copy_id"], "left_anti")
