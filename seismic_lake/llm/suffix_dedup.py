"""Removal of text that repeats verbatim, by suffix arrays.

Every byte that a string of ``LENGTH`` bytes covers goes if that string also starts anywhere else, in the
same text or another; matches stay inside a text and are judged on the input.

1. Anchors bring possible repeats together. The anchor of a window of LENGTH bytes is its gram of ``GRAMS[0]``
   bytes with the least hash, the leftmost of equal ones; equal windows have equal anchors, and about one position
   in 137 is one. An anchor's region is the stretch of text that its windows make up; a window is in one region.
2. Regions that are equal within their text, as in a run of one repeated unit, are told there, and one of them goes
   on. Anchors that occur once are done. Regions that are equal, byte for byte, are one class: if a class has
   two members, all its windows repeat, and no text has to move.
3. One region of each class goes to its anchor's shard where an anchor has several classes. A shard lays its regions
   out without overlap, in blocks; each block gets a suffix array by Larsson-Sadakane refinement and
   common prefixes by Kasai's walk (over many strips of the text in step). A suffix with LENGTH bytes in common with
   a neighbour in the array repeats. Blocks of one shard are merged by binary search of one's windows in
   the other's array.
4. An anchor with more than ``HOT`` classes is no shard of its own size: its regions are split by longer
   grams, and again, up to grams of LENGTH bytes, whose classes are the windows themselves.

Distinct texts are found through their classes, so exact copies never travel. NULL and empty texts, and
texts under LENGTH bytes, lose nothing; repeated rows are copies of each other (and so go, if long enough).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seismic_lake.llm.common import mix64, prefix_hashes, stretch_hash, text_blocks, written

LENGTH = 400
GRAMS = (128, 300, 370, LENGTH)  # bytes of an anchor, by level of splitting
HOT = 1500  # classes of an anchor that one shard takes
SHARD_BYTES = 512 << 10  # of regions, on average
BLOCK_BYTES = 1 << 20  # of a suffix array
STRIP = 256
PLACE = np.uint64((1 << 31) - 1)  # bits of a place in texts laid end to end
TEXT_BYTES = 1 << 20  # anchors are drawn from so much text at once

REGION = ["anchor", "same", "size", "u", "start"]


def sliding_least(x: np.ndarray, w: int) -> np.ndarray:
    """Least of x[i : i + w] for every i that has w values."""
    if len(x) < w:
        return x[:0]
    n = len(x)
    padded = np.concatenate([x, np.full(-n % w, np.iinfo(x.dtype).max, dtype=x.dtype)]).reshape(-1, w)
    ahead = np.minimum.accumulate(padded, axis=1).reshape(-1)
    back = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(back[: n - w + 1], ahead[w - 1 : n])


def anchors(data: np.ndarray, offsets: np.ndarray, gram: int) -> tuple[np.ndarray, ...]:
    """Of texts laid end to end, ascending: (anchor hash, region hash with the anchor's place in it, region start, region end)."""
    none = np.zeros(0, np.int64)
    if len(data) < LENGTH:
        return none.view(np.uint64), none.view(np.uint64), none, none
    sums = prefix_hashes(data)
    ends = np.repeat(offsets[1:], np.diff(offsets))  # of the text each byte is in
    at = np.arange(len(data) - gram + 1)
    grams = stretch_hash(sums, at, at + gram)
    # The place in the low bits makes the leftmost of equal grams the least; whatever bits of a hash are left, equal
    # windows have the same anchor.
    ranked = (grams & ~PLACE) | at.astype(np.uint64)
    ranked[at + gram > ends[: len(at)]] = np.iinfo(np.uint64).max
    least = sliding_least(ranked, LENGTH - gram + 1)
    window = np.flatnonzero(np.arange(len(least)) + LENGTH <= ends[: len(least)])
    place = (least[window] & PLACE).astype(np.int64)
    first = np.flatnonzero(np.diff(place, prepend=-1))
    start, end = window[first], window[np.append(first[1:], len(window))[: len(first)] - 1] + LENGTH
    place = place[first]
    same = mix64(stretch_hash(sums, start, end) + (place - start).astype(np.uint64))
    return grams[place], same, start, end


def repeated_within(same: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of regions by their hash and text: which are equal to another of their text, and which of those come after it."""
    order = np.lexsort((np.arange(len(same)), same, text))
    equal = (same[order[1:]] == same[order[:-1]]) & (text[order[1:]] == text[order[:-1]])
    often, later = np.zeros(len(same), dtype=bool), np.zeros(len(same), dtype=bool)
    often[order[1:]] = later[order[1:]] = equal
    often[order[:-1]] |= equal
    return often, later


class Stretches:
    """Bytes of several stretches laid end to end, with their suffix array; suffixes end with their stretch."""

    def __init__(self, parts: list[bytes]) -> None:
        self.sizes = np.array([len(p) for p in parts], dtype=np.int64)
        self.data = np.frombuffer(b"".join(parts) + bytes(16), dtype=np.uint8)
        self.n = int(self.sizes.sum())
        bounds = np.cumsum(self.sizes)
        self.end = np.repeat(bounds, self.sizes)
        self.begins = bounds - self.sizes
        word = np.zeros(self.n + 8, dtype=np.uint64)  # the eight bytes from each place, first byte highest
        for k in range(8):
            word[: self.n + 8] |= self.data[k : k + self.n + 8].astype(np.uint64) << np.uint64(56 - 8 * k)
        self.word = word
        self.order = self._suffixes()

    def _suffixes(self) -> np.ndarray:
        """Larsson-Sadakane: sort by the first bytes, then refine groups of ties by the rank twice as far on."""
        n = self.n
        place = np.arange(n)
        key = np.zeros(n, dtype=np.int64)
        for k in range(7):  # 0 stands for the end of a stretch
            byte = np.where(place + k < self.end, self.data[k : k + n].astype(np.int64) + 1, 0)
            key = key * 257 + byte
        order = np.argsort(key)
        rank = np.empty(n, dtype=np.int64)  # 1 + first slot of the group

        def groups(sorted_keys: np.ndarray, slots: np.ndarray) -> np.ndarray:
            new = np.ones(len(slots), dtype=bool)
            new[1:] = sorted_keys[1:] != sorted_keys[:-1]
            return slots[np.maximum.accumulate(np.where(new, np.arange(len(slots)), 0))]

        slots = np.arange(n)
        first = groups(key[order], slots)
        rank[order] = first + 1
        step = 7
        open_ = np.zeros(n, dtype=bool)  # slots in groups of ties
        tied = first[1:] == first[:-1]
        open_[1:] |= tied
        open_[:-1] |= tied
        while step < LENGTH and open_.any():
            slots = np.flatnonzero(open_)
            at = order[slots]
            ahead = at + step
            behind = np.where(ahead < self.end[at], rank[np.minimum(ahead, n - 1)], 0)
            own = rank[at]
            pairs = own * (n + 2) + behind
            by = np.argsort(pairs)
            order[slots] = at[by]
            first = groups(pairs[by], slots)
            rank[order[slots]] = first + 1
            tied = (first[1:] == first[:-1]) if len(first) > 1 else np.zeros(0, bool)
            still = np.zeros(len(slots), dtype=bool)
            still[1:] |= tied
            still[:-1] |= tied
            open_[slots] = still
            step *= 2
        return order

    def common(self) -> np.ndarray:
        """For each slot, the bytes its suffix shares with the one before, up to LENGTH: Kasai's walk.

        Going one place on in the text loses at most one shared byte, as long as the neighbour met there
        lies before in the array too (the order is refined up to LENGTH, and ends of stretches cut it short).
        Strips of the text are walked in step.
        """
        n = self.n
        slot = np.empty(n, dtype=np.int64)
        slot[self.order] = np.arange(n)
        before = np.full(n, -1, dtype=np.int64)
        before[self.order[1:]] = self.order[:-1]
        shared = np.zeros(n, dtype=np.int64)
        is_begin = np.zeros(n + 1, dtype=bool)
        is_begin[self.begins[self.sizes > 0]] = True
        length = np.zeros(-(-n // STRIP), dtype=np.int64)
        for k in range(min(STRIP, n)):
            i = np.arange(k, n, STRIP)
            length = length[: len(i)]
            j = before[i]
            if k:  # what was shared one place back holds if that neighbour, one place on, still lies before
                on = last[: len(i)] + 1
                holds = (last[: len(i)] >= 0) & (slot[np.minimum(on, n - 1)] < slot[i]) & ~is_begin[i] & (j >= 0)
                length = np.where(holds, np.maximum(length - 1, 0), 0)
            last = j
            most = np.minimum(np.minimum(self.end[i] - i, self.end[np.maximum(j, 0)] - j), LENGTH)
            most = np.where(j < 0, 0, most)
            active = np.flatnonzero(length < most)
            while len(active):
                a, b = i[active] + length[active], j[active] + length[active]
                more = leading(self.word[a] ^ self.word[b])
                length[active] += more
                active = active[(more == 8) & (length[active] < most[active])]
            length = np.minimum(length, most)
            shared[slot[i]] = length
        return shared

    def repeated(self) -> np.ndarray:
        """Which places begin a window that begins elsewhere in the stretches too."""
        out = np.zeros(self.n, dtype=bool)
        long_ = self.common() >= LENGTH
        out[self.order[long_]] = True
        out[self.order[np.flatnonzero(long_) - 1]] = True
        return out

    def find(self, other: Stretches) -> tuple[np.ndarray, np.ndarray]:
        """(own places, other's places) of windows in both: each window of ``other`` by binary search in the array."""
        query = np.flatnonzero(other.end - np.arange(other.n) >= LENGTH)
        known = np.sort(self.word[: self.n])
        query = query[known[np.minimum(np.searchsorted(known, other.word[query]), self.n - 1)] == other.word[query]]
        low, high = np.zeros(len(query), np.int64), np.full(len(query), self.n, np.int64)
        while len(query) and (low < high).any():
            middle = np.minimum((low + high) // 2, self.n - 1)
            below = self._below(self.order[middle], other, query)
            low, high = np.where((low < high) & below, middle + 1, low), np.where((low < high) & ~below, middle, high)
        inside = low < self.n
        query, at = query[inside], self.order[low[inside]]
        equal = self._compare(at, other, query)[1] >= LENGTH
        own = np.zeros(self.n, dtype=bool)
        own[at[equal]] = True
        return own, query[equal]

    def _compare(self, at: np.ndarray, other: Stretches, query: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(own suffix lies before the window, bytes in common)."""
        shared = np.zeros(len(at), dtype=np.int64)
        most = np.minimum(self.end[at] - at, LENGTH)
        active = np.arange(len(at))
        while len(active):
            more = leading(self.word[at[active] + shared[active]] ^ other.word[query[active] + shared[active]])
            shared[active] += more
            active = active[(more == 8) & (shared[active] < most[active])]
        shared = np.minimum(shared, most)
        ended = shared == most
        before = np.where(ended, most < LENGTH, self.data[at + shared] < other.data[query + np.minimum(shared, LENGTH - 1)])
        return before, shared

    def _below(self, at: np.ndarray, other: Stretches, query: np.ndarray) -> np.ndarray:
        return self._compare(at, other, query)[0]


def leading(difference: np.ndarray) -> np.ndarray:
    """Equal bytes at the front of eight, by the exclusive or of both."""
    out = np.zeros(len(difference), dtype=np.int64)
    for k in range(8):
        out += (difference >> np.uint64(56 - 8 * k)) == 0
    return out


def _laid_out(rows: list[tuple[int, int, bytes]]) -> list[tuple[int, int, bytes]]:
    """Regions (u, start, bytes) of one text that touch become one stretch."""
    out: list[list] = []
    for u, start, raw in sorted(rows, key=lambda r: (r[0], r[1], -len(r[2]))):
        if out and out[-1][0] == u and start <= out[-1][1] + len(out[-1][2]):
            out[-1][2] += raw[max(out[-1][1] + len(out[-1][2]) - start, 0) :]
        else:
            out.append([u, start, bytearray(raw)])
    return [(u, start, bytes(raw)) for u, start, raw in out]


def covered(flags: np.ndarray) -> np.ndarray:
    """(start, end) rows of the bytes that windows beginning at the flagged places cover."""
    begin = np.flatnonzero(flags)
    if not len(begin):
        return np.zeros((0, 2), np.int64)
    cut = np.flatnonzero(np.diff(begin) > LENGTH) + 1
    return np.stack([begin[np.concatenate([[0], cut])], begin[np.concatenate([cut - 1, [len(begin) - 1]])] + LENGTH], axis=1)


def shard_spans(rows: list[tuple[int, int, bytes]], block_bytes: int = BLOCK_BYTES) -> list[tuple[int, int, int]]:
    """(u, start, end) of the repeated bytes among the regions of a shard."""
    stretches = _laid_out(rows)
    blocks: list[list[tuple[int, int, bytes]]] = []
    size = block_bytes
    for s in stretches:
        if size + len(s[2]) > block_bytes and size:
            blocks.append([])
            size = 0
        blocks[-1].append(s)
        size += len(s[2])
    arrays = [Stretches([raw for _, _, raw in block]) for block in blocks]
    flags = [a.repeated() for a in arrays]
    for k, a in enumerate(arrays):
        for m in range(k + 1, len(arrays)):
            own, others = a.find(arrays[m])
            flags[k] |= own
            flags[m][others] = True
            # Every equal suffix of the block repeats too; its own array has flagged all but single ones.
    out = []
    for block, array, flag in zip(blocks, arrays, flags, strict=True):
        for (u, start, raw), begin in zip(block, array.begins.tolist(), strict=True):
            out += [(u, start + int(a), start + int(b)) for a, b in covered(flag[begin : begin + len(raw)])]
    return out


def _from_texts(documents: DataFrame) -> DataFrame:
    """A row for each text of LENGTH bytes or more: its number u, its key, its anchors and what repeats within it.

    Of regions that are equal the first is kept; all bytes of them are in ``from`` and ``to``.
    """
    schema = "u long, doc_id long, text_key binary, anchor array<long>, same array<long>, start array<int>, size array<int>, from array<int>, to array<int>"

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 36
        for batch in batches:
            ids, keys = batch.column("doc_id"), batch.column("text_key")
            for first, end, data, offsets in text_blocks(batch.column("text"), TEXT_BYTES):
                anchor, same, start, stop = anchors(data, offsets, GRAMS[0])
                text = np.searchsorted(offsets, start, side="right") - 1
                often, later = repeated_within(same, text)
                low, high, of = start[often], stop[often], text[often]
                new = np.ones(len(low), dtype=bool)  # regions of a text that touch become one stretch
                new[1:] = (of[1:] != of[:-1]) | (low[1:] > high[:-1])
                low, high, of = low[new], high[np.append(new[1:], True)] if len(new) else high, of[new]
                anchor, same, start, stop = anchor[~later], same[~later], start[~later], stop[~later]
                at = np.searchsorted(start, offsets)
                own = np.repeat(offsets[:-1], np.diff(at))
                lists, runs = pa.array(at, pa.int32()), pa.array(np.searchsorted(of, np.arange(end - first + 1)), pa.int32())
                n = end - first
                columns = [
                    pa.array(np.arange(number, number + n)),
                    ids.slice(first, n),
                    keys.slice(first, n),
                    pa.ListArray.from_arrays(lists, pa.array(anchor.view(np.int64))),
                    pa.ListArray.from_arrays(lists, pa.array(same.view(np.int64))),
                    pa.ListArray.from_arrays(lists, pa.array((start - own).astype(np.int32))),
                    pa.ListArray.from_arrays(lists, pa.array((stop - start).astype(np.int32))),
                    pa.ListArray.from_arrays(runs, pa.array((low - offsets[of]).astype(np.int32))),
                    pa.ListArray.from_arrays(runs, pa.array((high - offsets[of]).astype(np.int32))),
                ]
                number += n
                yield pa.RecordBatch.from_arrays(columns, names=["u", "doc_id", "text_key", "anchor", "same", "start", "size", "from", "to"])

    return documents.select("doc_id", "text_key", "text").where(F.octet_length("text") >= LENGTH).mapInArrow(draw, schema)


def _from_regions(regions: DataFrame, gram: int) -> DataFrame:
    """The regions (anchor, u, start, raw) of hot anchors split by longer grams, without their bytes.

    ``inside`` and ``of`` name the region split: its start and anchor.
    """

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 1000):
                rows = batch.slice(at, 1000)
                raw = rows.column("raw").to_pylist()
                offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
                anchor, same, start, end = anchors(np.frombuffer(b"".join(raw), np.uint8), offsets, gram)
                own = np.searchsorted(offsets, start, side="right") - 1
                first = rows.column("start").to_numpy()[own]
                columns = [
                    pa.array(anchor.view(np.int64)),
                    pa.array(same.view(np.int64)),
                    pa.array((end - start).astype(np.int32)),
                    pa.array(rows.column("u").to_numpy()[own]),
                    pa.array((first + start - offsets[own]).astype(np.int32)),
                    pa.array(first),
                    pa.array(rows.column("anchor").to_numpy()[own]),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=[*REGION, "inside", "of"])

    parts = regions.select("anchor", "u", "start", "raw").mapInArrow(draw, "anchor long, same long, size int, u long, start int, inside int, of long")
    # Rows that repeat a doc_id and its text bring a region more than once.
    return parts.groupBy(*REGION).agg(F.first("inside").alias("inside"), F.first("of").alias("of"))


def _shards(regions: DataFrame) -> DataFrame:
    """(u, start, end) of repeats among regions (anchor, u, start, raw), an anchor's regions in one shard."""
    total = regions.agg(F.sum(F.length("raw"))).first()[0] or 0
    n = max(1, -(-total // SHARD_BYTES))

    def spans(shard: pd.DataFrame) -> pd.DataFrame:
        rows = list(zip(shard["u"].tolist(), shard["start"].tolist(), shard["raw"].tolist(), strict=True))
        return pd.DataFrame(shard_spans(rows), columns=["u", "start", "end"])

    shards = regions.select(F.pmod(F.xxhash64("anchor"), F.lit(n)).alias("shard"), "u", "start", "raw")
    return shards.groupBy("shard").applyInPandas(spans, "u long, start int, end int")


def _texts_of(documents: DataFrame, rows: DataFrame, numbers: DataFrame) -> DataFrame:
    """``rows`` (.., u, start, size) with the bytes of their regions."""
    wanted = rows.join(numbers.select("u", F.col("doc_id").alias("id"), F.col("text_key").alias("key")), "u")
    lists = wanted.groupBy("id", "key").agg(F.collect_list(F.struct("anchor", "u", "start", "size", "hot")).alias("regions"))  # of one text
    texts = documents.select(F.col("doc_id").alias("id"), F.col("text_key").alias("key"), F.encode("text", "UTF-8").alias("bytes"))
    texts = texts.where(F.length("bytes") >= LENGTH)
    # Rows that repeat a doc_id and its text bring one region more than once; laying out makes them one.
    found = texts.join(lists, texts["id"].eqNullSafe(lists["id"]) & (texts["key"] == lists["key"])).select("bytes", F.explode("regions").alias("r"))
    cut = F.substring("bytes", F.col("r.start") + 1, F.col("r.size"))
    return found.select("r.anchor", "r.u", "r.start", "r.hot", cut.alias("raw"))


def spans(documents: DataFrame) -> DataFrame:
    """(doc_id, text_key, spans): repeated stretches of bytes of each distinct row that has any."""
    numbers = written(_from_texts(documents), "anchors")
    found = numbers.select(F.explode(F.arrays_zip("anchor", "same", "size", "start")).alias("a"), "u").select("a.*", "u")
    found = found.withColumns({"inside": F.lit(0), "of": F.lit(0).cast("long")})
    within = numbers.select("u", F.explode(F.arrays_zip("from", "to")).alias("s"))
    out = [within.select("u", F.col("s.from").alias("start"), F.col("s.to").alias("end"))]
    hot = None
    for level, gram in enumerate(GRAMS):
        if level:
            found = written(_from_regions(hot, gram), "splits")
        often = found.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor")
        regions = written(found.join(often, "anchor", "left_semi"), "regions")
        first = F.min(F.struct("u", "start", "inside", "of")).alias("first")
        classes = written(regions.groupBy("anchor", "same", "size").agg(F.count("*").alias("n"), first), "classes")
        several = classes.where(f"n > 1 AND size >= {LENGTH}").select("anchor", "same", "size")
        out.append(regions.join(several, ["anchor", "same", "size"], "left_semi").select("u", "start", (F.col("start") + F.col("size")).alias("end")))
        if level == len(GRAMS) - 1:
            break  # a class is a window here; what has one member is not repeated
        kinds = classes.groupBy("anchor").agg(F.count("*").alias("kinds")).where("kinds > 1")
        one = classes.join(kinds, "anchor").select("anchor", "first.*", "size", (F.col("kinds") > HOT).alias("hot"))
        if level:
            held = hot.select(F.col("anchor").alias("of"), "u", F.col("start").alias("inside"), F.col("raw").alias("whole"))
            one = one.join(held, ["of", "u", "inside"])
            one = one.withColumn("raw", F.substring("whole", F.col("start") - F.col("inside") + 1, F.col("size")))
        else:
            one = _texts_of(documents, one, numbers)
        one = written(one.select("anchor", "u", "start", "raw", "hot"), "one-of-each")
        out.append(_shards(one.where("NOT hot")))
        hot = one.where("hot")
        if not hot.limit(1).count():
            break
    all_ = out[0]
    for more in out[1:]:
        all_ = all_.union(more)
    named = all_.distinct().join(numbers.select("u", "doc_id", "text_key"), "u")
    return named.groupBy("doc_id", "text_key").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("spans"))


def report(documents: DataFrame) -> DataFrame:
    """Sizes, removed bytes and runs, and the digest of what is left, for each row."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.withColumn("text_key", F.unhex(F.md5(F.encode("text", "UTF-8"))))
    found = spans(docs).select(F.col("doc_id").alias("id"), F.col("text_key").alias("key"), "spans")
    joined = docs.join(found, docs["doc_id"].eqNullSafe(found["id"]) & (docs["text_key"] == found["key"]), "left")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, removed, runs, digests = [], [], [], []
            for text, own in zip(batch.column("text"), batch.column("spans"), strict=True):
                raw = text.as_py().encode()
                kept, last, gone, n = hashlib.sha256(), 0, 0, 0
                for start, end in merged([(s["start"], s["end"]) for s in own.as_py() or ()]):
                    kept.update(raw[last:start])
                    last, gone, n = end, gone + end - start, n + 1
                kept.update(raw[last:])
                for column, value in zip((sizes, removed, runs, digests), (len(raw), gone, n, kept.hexdigest()), strict=True):
                    column.append(value)
            columns = [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in (sizes, removed, runs)), pa.array(digests, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return joined.select("doc_id", "text", "spans").mapInArrow(digest, schema)


def merged(stretches: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(stretches):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out
