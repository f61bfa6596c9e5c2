"""Best partners in time and space, nearest first, however densely records stand.

Spots (records at exactly the same time and place) are laid along a space-filling curve within the cells of a
grid, and cut into blocks of at most ``BLOCK`` spots with the bounds of their times and places. What is
closer than what can then be told of whole blocks: a pair of blocks has a least score (no two of their spots
can be closer) and a greatest one (no two can be further apart). A block whose greatest score with some other
block is u needs no block whose least score with it is over u, so in a swarm only neighbouring blocks are ever
compared spot by spot. Scattered records are blocks of one, whose two scores are the same.

The blocks of a cell and those of the other side within reach of it are one row, so a task handles many
cells at once and a pair of records is never a row. In a cell with more than ``BLOCKS`` blocks of a side the blocks
that follow each other on the curve are tiles with bounds of their own. Each block first meets the tile of the other side
that is nearest to it, which tells how far it has to look; then only those tiles meet, and only with those of their
blocks, that may still hold a better partner. In a swarm a tile so meets its neighbours, however many others there are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seismic_lake.functions.times import MICROS
from seismic_lake.operators.proximity import CELL, Grid, Tolerance, in_blocks, own_cell, reachable_cells, slim
from seismic_lake.session import written
from seismic_lake.vocab import EARTH_RADIUS_KM

BLOCK = 32  # spots of a block
BLOCKS = 1024  # blocks of one side that meet in one group, and of a tile
NEAR = 2  # nearest blocks that tell a block how far to look
CURVE_BITS = 20  # of each of the curve's three coordinates: a cell is cut about a million times each way
PAIRS = 1 << 16  # pairs looked at together in a task: a dozen arrays of that length are held at once
RUN = 1 << 20  # pairs of blocks whose bounds are drawn in together
# Scores are ranked by whole billionths: far finer than any measurement, coarser than the last bits in
# which two machines' trigonometry may differ, so ties fall the same way everywhere.
SCORE_UNIT = 10**9
SLACK = 1e-8  # over a rank's width, and far over the rounding of a bound
UNBOUNDED = 2.0  # no score is greater
UNASKED = -1.0  # no score is less: the block's own best partners are not asked for

BOX = ["t0", "t1", "lat0", "lat1", "lon0", "lon1"]
SPOT = {"id": "string", "t": "long", "lat": "double", "lon": "double", "n": "long"}
ARROW = {"string": pa.string(), "long": pa.int64(), "double": pa.float64()}
ROUNDS = (2, 8, 24)  # nearest blocks that a block is compared with before its bounds are drawn in again
NONE = np.iinfo(np.int64).max


def _along_curve(grid: Grid) -> str:
    """A place's number on the curve through its cell: the bits of time, latitude and longitude in turn."""

    def spread(column: str, width: float) -> str:
        share = f"{column} / {width!r}D - floor({column} / {width!r}D)"
        bits = f"least(floor(({share}) * {1 << CURVE_BITS}), {(1 << CURVE_BITS) - 1})"
        # two zeros after each bit: halves, then quarters, and so on are moved apart
        for shift, mask in ((32, 0x1F00000000FFFF), (16, 0x1F0000FF0000FF), (8, 0x100F00F00F00F00F), (4, 0x10C30C30C30C30C3), (2, 0x1249249249249249)):
            bits = f"transform(array({bits}), x -> (x | shiftleft(x, {shift})) & {mask}L)[0]"
        return bits

    t, lat, lon = spread("s_t", grid.width), spread("s_lat", grid.lat_step), spread("s_lon", grid.lon_step)
    return f"{t} | shiftleft({lat}, 1) | shiftleft({lon}, 2)"


def _spots(side: DataFrame, p: str) -> DataFrame:
    """Records at exactly the same time and place are one spot: only the smallest id can be a mutual best."""
    spots = side.groupBy(f"{p}_t", f"{p}_lat", f"{p}_lon").agg(F.expr(f"min({p}_id) AS s_id"), F.expr("count(*) AS s_n"))
    return spots.toDF("s_t", "s_lat", "s_lon", "s_id", "s_n")


def _blocks(spots: DataFrame, grid: Grid) -> DataFrame:
    """(cell, tile, place in it, bounds, spots): spots of a cell that are neighbours on the curve, as lists.

    The spots are dealt out by ranges of (cell, curve), so a cell that holds most of them is many
    tasks' work, and cut into tiles and these into blocks where they lie. They are written, as tiles are told
    apart by where they were cut.
    """
    ordered = own_cell(spots, "s", grid).selectExpr("*", f"{_along_curve(grid)} AS _curve")
    order = [*CELL, "_curve", "s_t", "s_lat", "s_lon"]
    ordered = ordered.repartitionByRange(_partitions(spots), *order).sortWithinPartitions(*order)
    types = dict.fromkeys([*CELL, "tile", "k"], "long") | {c: "long" if c in BOX[:2] else "double" for c in BOX}
    types |= {c: f"array<{t}>" for c, t in SPOT.items()}
    block = pa.schema([(c, pa.list_(ARROW[SPOT[c]]) if c in SPOT else ARROW[t]) for c, t in types.items()])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tiles = TaskContext.get().partitionId() << 40
        for batch in batches:
            n = len(batch)
            if not n:
                continue
            cells = [batch.column(c).to_numpy(zero_copy_only=False) for c in CELL]
            curve = batch.column("_curve").to_numpy(zero_copy_only=False)
            new = np.ones(n, dtype=bool)
            new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in cells])
            leap = np.append(0, np.frexp((curve[1:] ^ curve[:-1]).astype(np.float64))[1])  # bits in which neighbours differ
            apart = new.copy()
            runs = np.append(np.flatnonzero(new), n)
            for k in np.flatnonzero(np.diff(runs) > BLOCK):
                # What lies before and after a great leap of the curve may be far apart: a tile ends at the
                # greatest, and a block at those out of a cell with room for a few blocks.
                low, high = runs[k], runs[k + 1]
                top = int(leap[low + 1 : high].max())
                new[low + 1 + int(leap[low + 1 : high].argmax())] = True
                apart[low + 1 : high] = leap[low + 1 : high] > top - int(np.log2((high - low) / BLOCK)) + 2
            apart |= new
            place = np.arange(n) - np.maximum.accumulate(np.where(apart, np.arange(n), 0))
            starts = np.flatnonzero(place % BLOCK == 0)
            nth = np.arange(len(starts))
            nth -= np.maximum.accumulate(np.where(new[starts], nth, 0))
            tile = tiles + np.cumsum(nth % BLOCKS == 0)
            tiles = int(tile[-1])
            columns = [pa.array(c) for c in (*(c[starts] for c in cells), tile, nth % BLOCKS)]
            for name in ("t", "lat", "lon"):
                values = batch.column(f"s_{name}").to_numpy(zero_copy_only=False)
                columns += [pa.array(np.minimum.reduceat(values, starts)), pa.array(np.maximum.reduceat(values, starts))]
            offsets = pa.array(np.append(starts, n), pa.int32())
            columns += [pa.ListArray.from_arrays(offsets, batch.column(f"s_{c}")) for c in SPOT]
            yield pa.RecordBatch.from_arrays(columns, schema=block)

    return written(ordered.mapInArrow(cut, ", ".join(f"{c} {t}" for c, t in types.items())), "nearest/blocks")


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


class _Met:
    """The blocks of both sides by the cells in which they meet, and the cells that are crowded."""

    def __init__(self, left: DataFrame, right: DataFrame, tol: Tolerance) -> None:
        grid, self.tol = Grid(tol), tol
        self.a = _blocks(_spots(slim(left, "a"), "a"), grid)
        self.b = reachable_cells(_blocks(_spots(slim(right, "b"), "b"), grid).drop(*CELL), BOX[::2], BOX[1::2], grid)
        count = [side.groupBy(*CELL).agg(F.count("*").alias(n)) for side, n in ((self.a, "m"), (self.b, "n"))]
        # a swarm reaches into cells where the other side has nothing: they are as crowded, though nothing meets there
        full = count[0].join(count[1], CELL, "full").where(f"greatest(m, n) > {BLOCKS}")
        self.full = written(full.selectExpr(*CELL, "m IS NOT NULL AND n IS NOT NULL AS meet"), "nearest/crowded")
        self.crowded = self.full.where("meet").select(*CELL)
        self.any_full, self.any_crowded = not self.full.isEmpty(), not self.crowded.isEmpty()

    def groups(self) -> DataFrame:
        """(a, b): the blocks of both sides that meet in a cell, those of a cell that is not crowded."""
        block = f"struct({', '.join([*BOX, f'{UNBOUNDED}D AS u', *SPOT])}) AS block"
        a, b = (side.selectExpr(*CELL, f"{of_a} AS of_a", block) for side, of_a in ((self.a, "true"), (self.b, "false")))
        few = a.unionByName(b).join(self.full, CELL, "left_anti") if self.any_full else a.unionByName(b)
        # a fixed number of partitions: groups are few bytes and much work, so they must not be merged by their bytes
        met = few.repartition(_partitions(few), *CELL).groupBy(*CELL)
        sides = met.agg(F.expr("collect_list(if(of_a, block, NULL)) AS a"), F.expr("collect_list(if(of_a, NULL, block)) AS b"))
        return sides.where("size(a) > 0 AND size(b) > 0").select("a", "b")

    def side(self, p: str) -> DataFrame:
        """The blocks of a side in crowded cells, their columns named for the side."""
        blocks = (self.a if p == "a" else self.b).join(self.crowded, CELL, "left_semi")
        return blocks.selectExpr(*CELL, f"tile AS {p}_tile", "k", *BOX, *SPOT)

    def tiles(self, p: str = "", limit: DataFrame | None = None) -> DataFrame:
        """(cell, both tiles, their bounds and numbers of records, least and greatest seconds and km): tiles within reach of each other.

        ``limit`` has for tiles of side ``p`` the score (_limit) up to which others are near enough. It is known where tiles
        are paired, so pairs beyond it, whose number grows with the square of a swarm, are neither kept nor shuffled.
        """

        def of(p: str) -> DataFrame:
            bounds = [F.expr(f"{'max' if c.endswith('1') else 'min'}({c}) AS {p}_{c}") for c in BOX]
            return self.side(p).groupBy(*CELL, f"{p}_tile").agg(*bounds, F.expr(f"sum(aggregate(n, 0L, (x, y) -> x + y)) AS {p}_n"))

        sides = {s: of(s) for s in ("a", "b")}
        if limit is not None:
            sides[p] = sides[p].join(limit, [c for c in limit.columns if c != "_limit"])
        a, b = in_blocks(sides["a"], sides["b"], CELL)
        pairs = a.join(b, [*CELL, "_x", "_y"]).selectExpr("*", *[f"{e} AS {c}" for c, e in _bounds("a_", "b_").items()])
        within = pairs.drop("_x", "_y").where(f"dt0 <= {float(self.tol.seconds)!r}D AND km0 <= {self.tol.km + SLACK!r}D")
        return within if limit is None else within.where(f"{self.score('dt0', 'km0')} <= _limit + {SLACK!r}D").drop("_limit")

    def score(self, seconds: str, km: str) -> str:
        return f"({seconds} / {float(self.tol.seconds)!r}D + {km} / {float(self.tol.km)!r}D)"


def _bounds(p: str, q: str) -> dict[str, str]:
    """SQL: the least and greatest seconds and kilometres between the bounds ``p`` and ``q``, as in _block_pairs."""

    def gap(low: str, high: str) -> tuple[str, str]:
        one, other = f"({p}{low} - {q}{high})", f"({q}{low} - {p}{high})"
        return f"greatest({one}, {other}, 0)", f"greatest(-{one}, -{other})"

    def km(lat: str, lon: str, cosines: list[str]) -> str:
        chord = f"pow(sin(radians({lat}) / 2), 2) + {cosines[0]} * {cosines[1]} * pow(sin(radians({lon}) / 2), 2)"
        return f"{2 * EARTH_RADIUS_KM!r}D * asin(least(1D, sqrt({chord})))"

    (dt0, dt1), (lat0, lat1), (near, far) = gap("t0", "t1"), gap("lat0", "lat1"), gap("lon0", "lon1")
    lon0 = f"least({near}, greatest(360D - {far}, 0D))"
    lon1 = f"(CASE WHEN {far} <= 180 THEN {far} WHEN {near} >= 180 THEN 360D - {near} ELSE 180D END)"
    ends = {s: f"(cos(radians({s}lat0)), cos(radians({s}lat1)))" for s in (p, q)}
    most = [f"(CASE WHEN {s}lat0 < 0 AND {s}lat1 > 0 THEN 1D ELSE greatest{ends[s]} END)" for s in (p, q)]
    km0, km1 = km(lat0, lon0, [f"least{ends[s]}" for s in (p, q)]), km(lat1, lon1, most)
    return {"dt0": f"{dt0} / {MICROS}D", "dt1": f"{dt1} / {MICROS}D", "km0": km0, "km1": km1}


class _Side:
    """The blocks of one side in some groups: ``groups`` and ``blocks`` have the first block of each group and the first spot of each block."""

    def __init__(self, lists: pa.ListArray | pa.Table) -> None:
        if isinstance(lists, pa.Table):  # one group's blocks as rows
            names = [c for c in (*BOX, "u", *SPOT) if c in lists.column_names]
            rows = pa.StructArray.from_arrays([lists.column(c).combine_chunks() for c in names], names)
            lists = pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows)
        self.groups = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        structs = lists.flatten()
        fields = {f.name: structs.field(k) for k, f in enumerate(structs.type)}
        box = {c: fields[c].to_numpy(zero_copy_only=False) for c in BOX}
        self.t0, self.t1, self.lat0, self.lat1, self.lon0, self.lon1 = (box[c] for c in BOX)
        self.u = fields["u"].to_numpy(zero_copy_only=False)  # no spot of the block needs a partner with a greater score
        ends = np.cos(np.radians(self.lat0)), np.cos(np.radians(self.lat1))
        self.cos0, self.cos1 = np.minimum(*ends), np.where((self.lat0 < 0) & (self.lat1 > 0), 1.0, np.maximum(*ends))
        self.blocks = fields["t"].offsets.to_numpy() - fields["t"].offsets[0].as_py()
        if "n" in fields:
            self.n = fields["n"].flatten().to_numpy(zero_copy_only=False)
        self.t, lat, lon = (fields[c].flatten().to_numpy(zero_copy_only=False) for c in ("t", "lat", "lon"))
        self.lat, self.lon, self.cos = np.radians(lat), np.radians(lon), np.cos(np.radians(lat))
        if "id" not in fields:  # where only scores are asked for
            return
        self.id = fields["id"].flatten()
        self.order = pc.sort_indices(self.id).to_numpy()
        self.place = np.empty_like(self.order)  # of each spot in the order of ids
        self.place[self.order] = np.arange(len(self.order), dtype=self.order.dtype)


def _runs(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """(first, last): runs of ``sizes`` that are at most ``most`` together, or a single one."""
    total = np.append(0, np.cumsum(sizes))
    first = 0
    while first < len(sizes):
        last = max(first + 1, int(np.searchsorted(total, total[first] + most, side="right")) - 1)
        yield first, last
        first = last


def _crossed(n_a: np.ndarray, n_b: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(which, i, j): all i < n_a[which] with all j < n_b[which], about PAIRS at a time; an i comes with all its j."""
    pairs = n_a.astype(np.int64) * n_b
    for first, last in _runs(pairs, PAIRS):
        if last == first + 1:
            n, step = int(n_b[first]), max(PAIRS // max(int(n_b[first]), 1), 1)
            for low in range(0, int(n_a[first]), step):
                place = np.arange(min(step, int(n_a[first]) - low) * n)
                yield np.full(len(place), first), low + place // n, place % n
            continue
        sizes = pairs[first:last]
        which = np.repeat(np.arange(first, last), sizes)
        place = np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        yield which, place // n_b[which], place % n_b[which]


def _km(lat: np.ndarray, lon: np.ndarray, cos_a: np.ndarray, cos_b: np.ndarray) -> np.ndarray:
    """Kilometres by the differences in radians and the cosines of the latitudes."""
    half_lat, half_lon = np.sin(lat / 2), np.sin(lon / 2)
    chord = half_lat * half_lat + cos_a * cos_b * half_lon * half_lon
    return 2 * EARTH_RADIUS_KM * np.arcsin(np.sqrt(np.minimum(chord, 1.0)))


def _block_pairs(a: _Side, b: _Side) -> Iterator[tuple[np.ndarray, ...]]:
    """Blocks that meet (x of a, y of b), their least and greatest seconds, least and greatest kilometres."""
    return _pairs_of_groups(a, b, 0, len(a.groups) - 1)


def _pairs_of_groups(a: _Side, b: _Side, first: int, last: int) -> Iterator[tuple[np.ndarray, ...]]:
    """As _block_pairs, of the groups from ``first`` to before ``last``."""
    groups_a, groups_b = a.groups[first : last + 1], b.groups[first : last + 1]
    for which, i, j in _crossed(np.diff(groups_a), np.diff(groups_b)):
        x, y = groups_a[which] + i, groups_b[which] + j

        def gap(low: str, high: str) -> tuple[np.ndarray, np.ndarray]:
            one, other = getattr(a, low)[x] - getattr(b, high)[y], getattr(b, low)[y] - getattr(a, high)[x]  # noqa: B023
            return np.maximum(np.maximum(one, other), 0), np.maximum(-one, -other)

        (dt0, dt1), (lat0, lat1), (near, far) = gap("t0", "t1"), gap("lat0", "lat1"), gap("lon0", "lon1")
        lon0 = np.minimum(near, np.maximum(360.0 - far, 0.0))  # the other way round the globe
        lon1 = np.where(far <= 180, far, np.where(near >= 180, 360.0 - near, 180.0))
        km0 = _km(np.radians(lat0), np.radians(lon0), a.cos0[x], b.cos0[y])
        km1 = _km(np.radians(lat1), np.radians(lon1), a.cos1[x], b.cos1[y])
        yield x, y, dt0 / MICROS, dt1 / MICROS, km0, km1


def _spot_pairs(a: _Side, b: _Side, x: np.ndarray, y: np.ndarray, tol: Tolerance) -> Iterator[tuple[np.ndarray, ...]]:
    """Pairs of spots of the blocks x and y that are within the tolerance, with their seconds and kilometres."""
    size_a, size_b = np.diff(a.blocks), np.diff(b.blocks)
    for which, i, j in _crossed(size_a[x], size_b[y]):
        yield from _within(a, b, a.blocks[x[which]] + i, b.blocks[y[which]] + j, tol)


def _within(a: _Side, b: _Side, p: np.ndarray, q: np.ndarray, tol: Tolerance) -> Iterator[tuple[np.ndarray, ...]]:
    near = np.abs(a.t[p] - b.t[q]) <= tol.seconds * MICROS
    p, q = p[near], q[near]
    km = _km(b.lat[q] - a.lat[p], b.lon[q] - a.lon[p], a.cos[p], b.cos[q])
    close = km <= tol.km
    p, q = p[close], q[close]
    yield p, q, np.abs(a.t[p] - b.t[q]) / MICROS, km[close]


def _worth(a: _Side, b: _Side, x: np.ndarray, y: np.ndarray, best: np.ndarray, bound: np.ndarray, tol: Tolerance) -> Iterator[tuple[np.ndarray, ...]]:
    """As _spot_pairs, without the spots of ``a`` that a whole block y can give nothing better than their ``best``.

    ``bound`` has for each block of b the worst score that its own spots still ask for.
    """
    size_a, size_b, one = np.diff(a.blocks), np.diff(b.blocks), np.ones(1, dtype=np.int64)
    lat0, lat1, lon0, lon1 = (np.radians(c) for c in (b.lat0, b.lat1, b.lon0, b.lon1))
    for which, i, _ in _crossed(size_a[x], np.broadcast_to(one, len(x))):
        p, at = a.blocks[x[which]] + i, y[which]
        dt = np.maximum(np.maximum(b.t0[at] - a.t[p], a.t[p] - b.t1[at]), 0) / MICROS
        lat = np.maximum(np.maximum(lat0[at] - a.lat[p], a.lat[p] - lat1[at]), 0)
        lon, low, high = a.lon[p], lon0[at], lon1[at]
        near, far = np.maximum(np.maximum(low - lon, lon - high), 0), np.maximum(high - lon, lon - low)
        least = dt / tol.seconds + _km(lat, np.minimum(near, np.maximum(2 * np.pi - far, 0)), a.cos[p], b.cos0[at]) / tol.km
        known = np.where(best[p] == NONE, UNBOUNDED, (best[p] >> 32) / SCORE_UNIT)
        left = least <= np.maximum(np.minimum(known, a.u[x[which]]), bound[at]) + SLACK
        p, at = p[left], at[left]
        for k, _, j in _crossed(np.broadcast_to(one, len(p)), size_b[at]):
            yield from _within(a, b, p[k], b.blocks[at[k]] + j, tol)


BEST = "of_a boolean, id string, other string, rank long, dt double, km double"
BEST_TYPE = pa.schema(
    [("of_a", pa.bool_()), ("id", pa.string()), ("other", pa.string()), ("rank", pa.int64()), ("dt", pa.float64()), ("km", pa.float64())]
)


def _in_order(keys: np.ndarray, least: np.ndarray) -> np.ndarray:
    """The place of each pair among those of its key, by ``least``."""
    order = np.lexsort((least, keys))
    new = np.append(True, keys[order][1:] != keys[order][:-1])
    place = np.empty(len(keys), dtype=np.int64)
    place[order] = np.arange(len(keys)) - np.maximum.accumulate(np.where(new, np.arange(len(keys)), 0))
    return place


def _search(a: _Side, b: _Side, tol: Tolerance, of_a: bool = True) -> Iterator[pa.RecordBatch]:
    """The best partner of each spot of either side in its groups; ``of_a`` names the side given first.

    Every block is first compared with the few that can be nearest, then with more, then with all that
    may still hold a better partner for some spot of either block than that spot has.
    """
    best_a, best_b = np.full(len(a.t), NONE), np.full(len(b.t), NONE)

    def worst(best: np.ndarray, side: _Side) -> np.ndarray:
        """Of each block the worst score that a spot has to beat."""
        ranks = np.maximum.reduceat(best, side.blocks[:-1])
        return np.where(ranks == NONE, UNBOUNDED, (ranks >> 32) / SCORE_UNIT)

    for run in _runs(np.diff(a.groups) * np.diff(b.groups), RUN):
        bound_a, bound_b, kept = a.u.copy(), b.u.copy(), []
        for x, y, dt0, dt1, km0, km1 in _pairs_of_groups(a, b, *run):
            all_within = (dt1 <= tol.seconds) & (km1 <= tol.km)
            greatest = np.where(all_within, dt1 / tol.seconds + km1 / tol.km, UNBOUNDED)
            np.minimum.at(bound_a, x, greatest)
            np.minimum.at(bound_b, y, greatest)
            least = dt0 / tol.seconds + km0 / tol.km
            left = (dt0 <= tol.seconds) & (km0 <= tol.km + SLACK) & (least <= np.maximum(bound_a[x], bound_b[y]) + SLACK)
            kept.append((x[left].astype(np.int32), y[left].astype(np.int32), least[left]))
        x, y, least = map(np.concatenate, zip(*kept, strict=True)) if kept else [np.empty(0, np.int32)] * 3
        left = least <= np.maximum(bound_a[x], bound_b[y]) + SLACK  # as the bounds are now, after all pairs
        x, y, least = x[left], y[left], least[left]
        first = np.minimum(_in_order(x, least), _in_order(y, least))
        for low, high in zip((0, *ROUNDS), (*ROUNDS, NONE), strict=True):
            bound_a, bound_b = np.minimum(bound_a, worst(best_a, a)), np.minimum(bound_b, worst(best_b, b))
            now = (first >= low) & (first < high) & (least <= np.maximum(bound_a[x], bound_b[y]) + SLACK)
            for p, q, dt, km in _worth(a, b, x[now], y[now], best_a, bound_b, tol):
                rank = np.floor((dt / tol.seconds + km / tol.km) * SCORE_UNIT + 0.5).astype(np.int64) << 32  # at most 2 billion
                for best, own, other, places in ((best_a, p, q, b.place), (best_b, q, p, a.place)):
                    found = rank | places[other].astype(np.int64)
                    better = found < best[own]
                    np.minimum.at(best, own[better], found[better])
    for first_side, best, own, other in ((of_a, best_a, a, b), (not of_a, best_b, b, a)):
        needed = np.repeat(own.u + SLACK, np.diff(own.blocks)) * SCORE_UNIT
        at = np.flatnonzero((best != NONE) & ((best >> 32) <= needed))
        to = other.order[best[at] & 0xFFFFFFFF].astype(np.int64)
        dt = np.abs(own.t[at] - other.t[to]) / MICROS
        km = _km(other.lat[to] - own.lat[at], other.lon[to] - own.lon[at], own.cos[at], other.cos[to])
        columns = [np.full(len(at), first_side), own.id.take(pa.array(at)), other.id.take(pa.array(to)), best[at] >> 32, dt, km]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=BEST_TYPE)


def _reach(a: _Side, b: _Side, tol: Tolerance) -> np.ndarray:
    """For each block of ``a`` a score that all its spots reach with some spot of ``b``, told by the nearest blocks."""
    reach, best = np.full(len(a.t0), UNBOUNDED), np.full(len(a.t), UNBOUNDED)
    for x, y, _, dt1, _, km1 in _block_pairs(a, b):
        greatest = dt1 / tol.seconds + km1 / tol.km
        within = (dt1 <= tol.seconds) & (km1 <= tol.km)
        np.minimum.at(reach, x[within], greatest[within])
        first = _in_order(x, greatest) < NEAR
        for p, _, dt, km in _spot_pairs(a, b, x[first], y[first], tol):
            np.minimum.at(best, p, dt / tol.seconds + km / tol.km)
    return np.minimum(reach, np.maximum.reduceat(best, a.blocks[:-1]))


def _reaches(met: _Met, p: str, q: str) -> DataFrame:
    """(tile, k, u) of side ``p``: how far the blocks in crowded cells have to look.

    A block meets the tile nearest to it, of which it sees the blocks that lie on the side of its own tile.
    What this leaves out makes a block look further than it has to, never less far.
    """
    own, keys, tol = [*CELL, f"{p}_tile"], [*CELL, f"{p}_tile", f"{q}_tile"], met.tol
    least, greatest = met.score("{dt0}", "{km0}"), met.score("{dt1}", "{km1}")
    limit = met.tiles().groupBy(*own).agg(F.min(F.expr(met.score("dt1", "km1"))).alias("_limit"))
    near = written(met.tiles(p, limit), "nearest/near")
    bounds = _bounds("", f"{q}_")
    within = f"{{dt1}} <= {float(tol.seconds)!r}D AND {{km1}} <= {float(tol.km)!r}D"
    reached = f"CASE WHEN {within} THEN {greatest} ELSE {UNBOUNDED}D END"
    seen = met.side(p).select(*own, "k", *BOX).join(near, own)
    # the nearest, and of those that the block lies in the one it fills best; numbers only, so nothing is sorted for it
    nearest = F.min_by(f"{q}_tile", F.expr(f"{least.format(**bounds)} + {greatest.format(**bounds)} / 1000"))
    first = seen.groupBy(*own, "k").agg(nearest.alias(f"{q}_tile"), F.min(F.expr(reached.format(**bounds))).alias("u"))
    met_first = written(first, "nearest/first")
    place = ["t", "lat", "lon"]
    mine = met.side(p).join(met_first, [*own, "k"]).select(*keys, "k", *BOX, "u", *place)
    width = met.score(*(_bounds(f"{p}_", f"{p}_")[c] for c in ("dt1", "km1")))
    margin = f"{least.format(**_bounds('', f'{p}_'))} <= {met.score('dt0', 'km0')} + {width} / 8"
    others = met.side(q).join(near.join(met_first.select(*keys).distinct(), keys, "left_semi"), [*CELL, f"{q}_tile"])
    others = others.where(margin).select(*keys, *BOX, F.lit(UNBOUNDED).alias("u"), *place)
    schema = pa.schema([(f"{p}_tile", pa.int64()), ("k", pa.int64()), ("u", pa.float64())])

    def reach(one: pa.Table, other: pa.Table) -> pa.Table:
        u = one.column("u").to_numpy()
        if len(one) and len(other):
            u = np.minimum(u, _reach(_Side(one), _Side(other), tol))
        return pa.Table.from_arrays([one.column(f"{p}_tile"), one.column("k"), pa.array(u)], schema=schema)

    parts = _partitions(near)
    both = mine.repartition(parts, *keys).groupBy(*keys).cogroup(others.repartition(parts, *keys).groupBy(*keys))
    found = both.applyInArrow(reach, f"{p}_tile long, k long, u double")
    # a block of b meets a in several cells, and has to look no further than in the best of them
    return written(found.groupBy(f"{p}_tile", "k").agg(F.min("u").alias("u")), "nearest/reach")


def _best_in_crowded(met: _Met) -> DataFrame:
    """The best partners in crowded cells: a block goes to the tiles in which it may find better ones than are known."""
    tol, found = met.tol, []
    least, parts, place = met.score("{dt0}", "{km0}"), _partitions(met.a), [c for c in SPOT if c != "n"]

    def searching(of_a: bool):
        def search(one: pa.Table, other: pa.Table) -> pa.Table:
            batches = _search(_Side(one), _Side(other), tol, of_a) if len(one) and len(other) else []
            return pa.Table.from_batches(batches, BEST_TYPE)

        return search

    for p, q in (("a", "b"), ("b", "a")):
        own, keys = [*CELL, f"{p}_tile"], [*CELL, f"{p}_tile", f"{q}_tile"]
        reach = _reaches(met, p, q)
        furthest = reach.groupBy(f"{p}_tile").agg(F.max("u").alias("_limit"))
        to = met.tiles(p, furthest).select(*keys, *[f"{q}_{c}" for c in BOX])
        going = met.side(p).join(reach, [f"{p}_tile", "k"]).join(to, own).where(f"{least.format(**_bounds('', f'{q}_'))} <= u + {SLACK!r}D")
        bounds = [F.expr(f"{'max' if c.endswith('1') else 'min'}({c}) AS g_{c}") for c in BOX]
        guests = written(going.groupBy(*keys).agg(*bounds, F.max("u").alias("g_u")), "nearest/guests")
        hosts = met.side(q).join(guests, [*CELL, f"{q}_tile"]).where(f"{least.format(**_bounds('', 'g_'))} <= g_u + {SLACK!r}D")
        one, other = (
            side.select(*keys, *BOX, u, *place).repartition(parts, *keys).groupBy(*keys)
            for side, u in ((going, F.col("u")), (hosts, F.lit(UNASKED).alias("u")))
        )
        found.append(one.cogroup(other).applyInArrow(searching(p == "a"), BEST))
    return found[0].unionByName(found[1])


def mutual_best(left: DataFrame, right: DataFrame, tol: Tolerance | None = None) -> DataFrame:
    """(a_id, b_id, dt, km, score): pairs in which each record is the other's best candidate.

    Ties go to the smaller id of the other side. A record whose best candidate prefers another
    stays unlinked. ``left`` and ``right`` need event_id, event_time, latitude, longitude.

    One pass for both sides: blocks meet in groups of bounded size, those that neither side needs are left out before
    any of their spots is looked at, and what is shuffled afterwards is a row for each spot.
    """
    tol = tol or Tolerance()

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _search(_Side(batch.column("a")), _Side(batch.column("b")), tol)

    met = _Met(left, right, tol)
    best = met.groups().mapInArrow(search, BEST)
    if met.any_crowded:
        best = best.unionByName(_best_in_crowded(met))
    best = best.groupBy("of_a", "id").agg(F.min(F.struct("rank", "other", "dt", "km")).alias("m"))
    a_id = F.when(F.col("of_a"), F.col("id")).otherwise(F.col("m.other"))
    b_id = F.when(F.col("of_a"), F.col("m.other")).otherwise(F.col("id"))
    named = best.select(a_id.alias("a_id"), b_id.alias("b_id"), "m.dt", "m.km")
    both = named.groupBy("a_id", "b_id").agg(F.count("*").alias("sides"), F.max("dt").alias("dt"), F.max("km").alias("km")).where("sides = 2")
    score = F.col("dt") / F.lit(float(tol.seconds)) + F.col("km") / F.lit(float(tol.km))
    return both.select("a_id", "b_id", "dt", "km", score.alias("score"))


def count_pairs(left: DataFrame, right: DataFrame, tol: Tolerance | None = None) -> DataFrame:
    """One row, ``pairs``: how many pairs of records are within the tolerance.

    Two blocks wholly within reach of each other count as the product of their sizes, and no pair of theirs is looked
    at; only on the rim are spots compared, and counted where they are compared.
    """
    tol = tol or Tolerance()

    def within(a: _Side, b: _Side) -> int:
        size_a, size_b = (np.add.reduceat(s.n, s.blocks[:-1]) for s in (a, b))
        total = 0
        for x, y, dt0, dt1, km0, km1 in _block_pairs(a, b):
            whole = (dt1 <= tol.seconds) & (km1 <= tol.km)
            total += int((size_a[x[whole]] * size_b[y[whole]]).sum())
            rim = (dt0 <= tol.seconds) & (km0 <= tol.km + SLACK) & ~whole
            total += sum(int((a.n[p] * b.n[q]).sum()) for p, q, *_ in _spot_pairs(a, b, x[rim], y[rim], tol))
        return total

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [within(_Side(batch.column("a")), _Side(batch.column("b")))]}, schema=counts)

    def count_tiles(a: pa.Table, b: pa.Table) -> pa.Table:
        return pa.Table.from_pydict({"n": [within(_Side(a), _Side(b)) if len(a) and len(b) else 0]}, schema=counts)

    counts = pa.schema([("n", pa.int64())])
    met = _Met(left, right, tol)
    counted = met.groups().mapInArrow(count, "n long")
    if met.any_crowded:
        limits = f"<= {float(tol.seconds)!r}D", f"<= {float(tol.km)!r}D"
        tiles, whole = met.tiles(), f"dt1 {limits[0]} AND km1 {limits[1]}"
        keys, parts, rim = [*CELL, "a_tile", "b_tile"], _partitions(tiles), tiles.where(f"NOT ({whole})")

        def on_rim(p: str, q: str):
            other = rim.select(*keys, *[f"{q}_{c}" for c in BOX])
            near = f"{{dt0}} {limits[0]} AND {{km0}} <= {tol.km + SLACK!r}D".format(**_bounds("", f"{q}_"))
            blocks = met.side(p).join(other, [*CELL, f"{p}_tile"]).where(near).select(*keys, *BOX, F.lit(UNBOUNDED).alias("u"), *SPOT)
            return blocks.repartition(parts, *keys).groupBy(*keys)

        compared = on_rim("a", "b").cogroup(on_rim("b", "a")).applyInArrow(count_tiles, "n long")
        counted = counted.unionByName(compared).unionByName(tiles.where(whole).selectExpr("a_n * b_n AS n"))
    return counted.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("pairs"))
