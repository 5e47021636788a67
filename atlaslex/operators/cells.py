"""Nearest centers through candidate lists.

The plane is cut into cells. Of each cell a list of the centers is kept that can be nearest to a point in it. A row finds its
cell by arithmetic, the cell's list by an equi-join, and the nearest center in that short list, so the cost of a row does not
grow with the number of centers.

Lists are made from the whole plane downwards: a cell's children can only have centers that it has itself. A center leaves a list
if another one is nearer at all four corners, and so, as the border between two centers is a straight line, in the whole cell. Those
nearest to the corners and to the middle are tried as such others. The first ``SPLITS`` halvings are the same everywhere. Each upper
cell is then cut into as many finer cells as its candidates ask for, and each finer one whose list is still long once more: cells
in a town are small, and a row finds its own by two look-ups.

Centers are the state of a model, as many as the caller asked clusters for. They and their lists are made on the driver, which holds
some dozen numbers for each center. While the lists are within ``BROADCAST_BYTES`` they go to every task, which compares a batch of rows
with their candidates at once; larger ones are a table that is joined by shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_type

from atlaslex.functions.geo import squared_degrees
from atlaslex.operators.lookup import BROADCAST_BYTES

# Rows and columns of the upper cells: 2 to this power. A cell is cut at most into 2 to the power of FINEST rows and columns, twice.
SPLITS, FINEST = 5, 6
ACROSS, FINE = 1 << SPLITS, 1 << FINEST
# Candidates in a list that is short enough, for each center wanted: on average in an upper cell, and at most before it is cut again.
SHORT, LONG = 6, 16
# The world's corners. Centers beyond them widen the plane; points beyond both read the whole list.
WORLD = (-90.0, -180.0, 90.0, 180.0)
# Rows that have a place.
PLACED = "lat is not null and lon is not null and not (isnan(lat) or isnan(lon))"
# A cell reaches that share of the plane farther than it is, so that rounding never moves a point out of it.
SLACK = 1e-9
# Pairs of a row and a candidate that a task holds at once.
STEP_PAIRS = 1 << 18


@dataclass
class Centers:
    """Number and place of every center, on the driver."""

    cluster: np.ndarray
    lat: np.ndarray
    lon: np.ndarray

    @staticmethod
    def of(table: DataFrame) -> Centers:
        """From a table (cluster, lat, lon); centers without a place are left out."""
        rows = table.selectExpr("cluster", "cast(lat as double) as lat", "cast(lon as double) as lon").where(PLACED).toArrow()
        return Centers(*(rows[c].to_numpy() for c in ("cluster", "lat", "lon")))

    def joined(self, others: Centers) -> Centers:
        """These and the others."""
        return Centers(*(np.concatenate([getattr(self, f), getattr(others, f)]) for f in ("cluster", "lat", "lon")))

    def __len__(self) -> int:
        return len(self.cluster)


@dataclass
class Lists:
    """Candidates of all cells, as pairs sorted by cell, and how cells are found.

    ``finer`` has the rows of cells in each upper cell, ``again`` and ``parts`` the finer cells that are cut again and into how many.
    """

    corner: tuple[float, float]
    size: tuple[float, float]
    finer: np.ndarray
    again: np.ndarray
    parts: np.ndarray
    key: np.ndarray
    center: np.ndarray


def _stays(starts: np.ndarray, corners: list[np.ndarray], middle: np.ndarray, wanted: int, slack: float) -> np.ndarray:
    """Which pairs of a cell and a center stay: fewer than ``wanted`` of those tried are nearer at all corners.

    Pairs come by cell, of which ``starts`` has the first ones; ``corners`` and ``middle`` have squared distances.
    """
    sizes = np.diff(np.concatenate([starts, [len(middle)]]))
    of = np.repeat(np.arange(len(starts)), sizes)
    gone = np.zeros(len(middle), dtype=bool)
    for probe in (middle, *corners):
        nearer, left = np.ones(len(middle), dtype=bool), probe.copy()
        for _ in range(wanted):
            least = np.flatnonzero(left == np.repeat(np.minimum.reduceat(left, starts), sizes))
            least = least[np.unique(of[least], return_index=True)[1]]
            other = np.repeat(least, sizes)
            for corner in corners:
                nearer &= corner > corner[other] + slack
            left[least] = np.inf
        gone |= nearer & (np.repeat(sizes, sizes) > wanted)
    return ~gone


def _starts(keys: np.ndarray) -> np.ndarray:
    """Places where a run of equal keys begins."""
    return np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))


class _Plane:
    """Pairs of a cell (row and column at a level of halvings) and a center that may be near it."""

    def __init__(self, centers: Centers, wanted: int):
        self.centers, self.wanted = centers, wanted
        self.corner = min(WORLD[0], centers.lat.min()), min(WORLD[1], centers.lon.min())
        self.size = max(WORLD[2], centers.lat.max()) - self.corner[0], max(WORLD[3], centers.lon.max()) - self.corner[1]
        self.slack = SLACK * max(self.size)

    def halved(self, level: np.ndarray, y: np.ndarray, x: np.ndarray, center: np.ndarray, *others: np.ndarray) -> list[np.ndarray]:
        """The pairs of the four quarters of every cell, without those that cannot be near; ``others`` come along."""
        part = np.tile(np.arange(4), len(y))
        level, y, x, center, *others = (np.repeat(v, 4) for v in (level + 1, y, x, center, *others))
        y, x = 2 * y + part // 2, 2 * x + part % 2
        order = np.lexsort((x, y, level))
        level, y, x, center, *others = (v[order] for v in (level, y, x, center, *others))
        share = np.ldexp(1.0, -level)
        tall, wide, slack = self.size[0] * share, self.size[1] * share, self.slack
        up, right = self.centers.lat[center] - (self.corner[0] + y * tall), self.centers.lon[center] - (self.corner[1] + x * wide)
        ups, rights = [(up - e) ** 2 for e in (-slack, tall + slack)], [(right - e) ** 2 for e in (-slack, wide + slack)]
        middle = (up - tall / 2) ** 2 + (right - wide / 2) ** 2
        new = (np.diff(level) != 0) | (np.diff(y) != 0) | (np.diff(x) != 0)
        starts = np.concatenate([[0], np.flatnonzero(new) + 1])
        stays = _stays(starts, [a + b for a in ups for b in rights], middle, self.wanted, slack)
        return [v[stays] for v in (level, y, x, center, *others)]

    def cut(self, level: np.ndarray, y: np.ndarray, x: np.ndarray, center: np.ndarray, group: np.ndarray):
        """Cuts the cells of each group alike, while its lists are long on average and its cells fewer than its candidates.

        Gives the groups, the rows of cells in each, and the pairs with the number of their cell.
        """
        groups, of = np.unique(group, return_inverse=True)
        candidates, rows = np.bincount(of), np.ones(len(groups), dtype=np.int64)
        done = []
        for depth in range(FINEST + 1):
            pairs = np.bincount(of, minlength=len(groups))
            further = (pairs > SHORT * self.wanted << 2 * depth) & (candidates > 1 << 2 * depth) & (depth < FINEST)
            rows[(pairs > 0) & ~further] = 1 << depth
            ends, inner = ~further[of], (1 << depth) - 1
            cell = (groups[of[ends]] * FINE + (y[ends] & inner)) * FINE + (x[ends] & inner)
            done.append((cell, level[ends], y[ends], x[ends], center[ends]))
            if ends.all():
                break
            level, y, x, center, of = self.halved(*(v[~ends] for v in (level, y, x, center, of)))
        return groups, rows, [np.concatenate(v) for v in zip(*done, strict=True)]


def candidate_lists(centers: Centers, wanted: int = 1) -> Lists:
    """Lists that have the ``wanted`` nearest centers of every point of a cell."""
    plane = _Plane(centers, wanted)
    zero = np.zeros(len(centers), dtype=np.int64)
    pairs = [zero, zero, zero, np.arange(len(centers))]
    for _ in range(SPLITS):
        pairs = plane.halved(*pairs)
    groups, rows, (cell, *pairs) = plane.cut(*pairs, pairs[1] * ACROSS + pairs[2])
    finer = np.ones(ACROSS * ACROSS, dtype=np.int64)
    finer[groups] = rows
    cells, of, sizes = np.unique(cell, return_inverse=True, return_counts=True)
    long = sizes[of] > LONG * wanted
    again, parts, (inner, *_, of_long) = plane.cut(*(v[long] for v in pairs), cell[long])
    # All cells have a number of the same depth; outside of the plane every center is a candidate.
    key = np.concatenate([np.full(len(centers), -1), cell[~long] * FINE * FINE, inner])
    center = np.concatenate([np.arange(len(centers)), pairs[3][~long], of_long])
    order = np.lexsort((centers.cluster[center], key))
    return Lists(plane.corner, plane.size, finer, again, parts, key[order], center[order])


def _with_cell(df: DataFrame, lists: Lists) -> DataFrame:
    """Adds ``_cell``: -1 outside of the plane, null without a place."""
    up = (F.col("lat") - lists.corner[0]) / (lists.size[0] / ACROSS)
    right = (F.col("lon") - lists.corner[1]) / (lists.size[1] / ACROSS)
    # Points on the far edges belong to the last cells.
    y, x = F.least(F.floor(up), F.lit(ACROSS - 1)), F.least(F.floor(right), F.lit(ACROSS - 1))
    finer = F.get(F.from_json(F.lit(str(lists.finer.tolist())), "array<int>"), (y * ACROSS + x).cast("int"))
    inside = up.between(0, ACROSS) & right.between(0, ACROSS) & F.expr(PLACED)
    place = F.when(inside, F.struct(((up - y) * finer).alias("up"), ((right - x) * finer).alias("right"), (y * ACROSS + x).alias("upper"), finer.alias("rows")))
    df = df.withColumn("_in", place)
    iy, ix = (F.least(F.floor(f"_in.{c}"), F.col("_in.rows") - 1) for c in ("up", "right"))
    key = (F.col("_in.upper") * FINE + iy) * FINE + ix
    fine = F.struct((F.col("_in.up") - iy).alias("up"), (F.col("_in.right") - ix).alias("right"), key.cast("long").alias("key"))
    df = df.withColumn("_in", F.when(F.col("_in").isNotNull(), fine)).withColumn("_fine", F.col("_in.key"))
    table = df.sparkSession.createDataFrame(pa.table({"_fine": lists.again, "_parts": lists.parts}), "_fine long, _parts long")
    df = df.join(F.broadcast(table), "_fine", "left")
    parts = F.coalesce("_parts", F.lit(1))
    jy, jx = (F.least(F.floor(F.col(f"_in.{c}") * parts), parts - 1) for c in ("up", "right"))
    placed = F.expr(PLACED)
    cell = F.when(F.col("_in").isNotNull(), (F.col("_in.key") * FINE + jy) * FINE + jx).when(placed, F.lit(-1)).cast("long")
    return df.withColumn("_cell", cell).drop("_in", "_fine", "_parts")


def _cell_of(lists: Lists, lat: np.ndarray, lon: np.ndarray) -> np.ndarray:
    """The same numbers for places inside of the plane, on the driver."""
    up, right = (lat - lists.corner[0]) / (lists.size[0] / ACROSS), (lon - lists.corner[1]) / (lists.size[1] / ACROSS)

    def inner(value: np.ndarray, rows: np.ndarray) -> np.ndarray:
        return np.minimum(np.floor(value), rows - 1).astype(np.int64)

    y, x = inner(up, ACROSS), inner(right, ACROSS)
    finer = lists.finer[y * ACROSS + x]
    up, right = (up - y) * finer, (right - x) * finer
    iy, ix = inner(up, finer), inner(right, finer)
    key = ((y * ACROSS + x) * FINE + iy) * FINE + ix
    parts = np.ones(len(key), dtype=np.int64)
    if len(lists.again):
        at = np.minimum(np.searchsorted(lists.again, key), len(lists.again) - 1)
        parts = np.where(lists.again[at] == key, lists.parts[at], 1)
    return (key * FINE + inner((up - iy) * parts, parts)) * FINE + inner((right - ix) * parts, parts)


def _list_table(df: DataFrame, lists: Lists, centers: Centers) -> DataFrame:
    starts = _starts(lists.key)
    offsets = pa.array(np.concatenate([starts, [len(lists.key)]]), pa.int32())
    fields = [pa.array(v[lists.center]) for v in (centers.cluster, centers.lat, centers.lon)]
    values = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(fields, ["cluster", "lat", "lon"]))
    return df.sparkSession.createDataFrame(pa.table({"_cell": lists.key[starts], "_listed": values}))


def _least(d: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least number of every run and the place of the first one that has it."""
    least = np.minimum.reduceat(d, starts)
    of = np.repeat(np.arange(len(starts)), sizes)
    hits = np.flatnonzero(d == least[of])
    return least, hits[_starts(of[hits])]


def _nearest_function(centers: Centers, lists: Lists, wanted: int):
    """An Arrow UDF from (lat, lon) to a struct ``d0, c0, d1, c1...``; not deterministic to Spark, so that it is evaluated once for all that read it."""
    starts = _starts(lists.key)
    keys, lengths = lists.key[starts], np.diff(np.concatenate([starts, [len(lists.key)]]))
    numbers, to_lat, to_lon = (v[lists.center] for v in (centers.cluster, centers.lat, centers.lon))
    plane = replace(lists, key=keys[:0], center=keys[:0])
    number = pa.array(centers.cluster).type

    def run(lat: pa.Array, lon: pa.Array) -> pa.Array:
        y, x = lat.to_numpy(zero_copy_only=False), lon.to_numpy(zero_copy_only=False)
        rows = np.flatnonzero(~(np.isnan(y) | np.isnan(x)))
        found = [(np.zeros(len(y)), np.ones(len(y), dtype=bool), np.zeros(len(y), dtype=np.int64)) for _ in range(wanted)]
        y, x = y[rows], x[rows]
        up, right = (y - plane.corner[0]) / (plane.size[0] / ACROSS), (x - plane.corner[1]) / (plane.size[1] / ACROSS)
        inside = np.flatnonzero((up >= 0) & (up <= ACROSS) & (right >= 0) & (right <= ACROSS))
        # The first list has all centers: that of places outside.
        at = np.zeros(len(rows), dtype=np.int64)
        cell = _cell_of(plane, y[inside], x[inside])
        place = np.minimum(np.searchsorted(keys, cell), len(keys) - 1)
        at[inside] = np.where(keys[place] == cell, place, 0)
        sizes = lengths[at]
        # Places by the pairs before them: a step has about STEP_PAIRS, and a row at least.
        step = (np.cumsum(sizes) - sizes) // STEP_PAIRS
        ends = [*_starts(step), len(rows)] if len(rows) else []
        for begin, end in zip(ends[:-1], ends[1:], strict=True):
            n = sizes[begin:end]
            first = np.cumsum(n) - n
            pair = np.arange(n.sum()) + np.repeat(starts[at[begin:end]] - first, n)
            north, east = np.repeat(y[begin:end], n) - to_lat[pair], np.repeat(x[begin:end], n) - to_lon[pair]
            d = north * north + east * east
            d[np.isnan(d)] = np.inf
            for rank, (value, missing, chosen) in enumerate(found):
                least, place = _least(d, first, n)
                value[rows[begin:end]], missing[rows[begin:end]], chosen[rows[begin:end]] = least, n <= rank, pair[place]
                d[place] = np.inf
        columns = [pa.array(v, mask=m) for value, m, chosen in found for v, m in ((value, m), (numbers[chosen], m))]
        return pa.StructArray.from_arrays(columns, names)

    names = [f"{c}{rank}" for rank in range(wanted) for c in "dc"]
    fields = [T.StructField(name, T.DoubleType() if name[0] == "d" else from_arrow_type(number)) for name in names]
    run.__annotations__ = {"lat": pa.Array, "lon": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, T.StructType(fields)).asNondeterministic()


def nearest(df: DataFrame, centers: Centers, lists: Lists, wanted: int = 1) -> DataFrame:
    """Adds ``_best``: the ``wanted`` nearest centers as (d, cluster), d being squared degrees; ties go by number."""
    lat, lon = F.col("lat"), F.col("lon")
    if 24 * len(lists.key) + 32 * len(_starts(lists.key)) <= BROADCAST_BYTES:
        near = _nearest_function(centers, lists, wanted)(lat.cast("double"), lon.cast("double"))
        ranks = [F.struct(F.col(f"_near.d{rank}").alias("d"), F.col(f"_near.c{rank}").alias("cluster")) for rank in range(wanted)]
        return df.withColumn("_near", near).withColumn("_best", F.array(*ranks)).drop("_near")

    def ranked(center: Column) -> Column:
        return F.struct(squared_degrees(lat, lon, center["lat"], center["lon"]).alias("d"), center["cluster"].alias("cluster"))

    joined = _with_cell(df, lists).join(_list_table(df, lists, centers), "_cell", "left")
    found = F.transform("_listed", ranked)
    best = F.array(F.array_min(found)) if wanted == 1 else F.slice(F.array_sort(found), 1, wanted)
    return joined.withColumn("_best", best).drop("_cell", "_listed")


def gaps(centers: Centers, lists: Lists) -> np.ndarray:
    """Distance of every center to the nearest other one; ``lists`` were made for two."""
    key = _cell_of(lists, centers.lat, centers.lon)
    first, last = np.searchsorted(lists.key, key), np.searchsorted(lists.key, key, side="right")
    mine = np.repeat(np.arange(len(centers)), last - first)
    at = np.arange(len(mine)) - np.repeat(np.cumsum(last - first) - (last - first), last - first) + np.repeat(first, last - first)
    other = lists.center[at]
    d = np.where(other == mine, np.inf, np.hypot(centers.lat[mine] - centers.lat[other], centers.lon[mine] - centers.lon[other]))
    found = np.full(len(centers), np.inf)
    np.minimum.at(found, mine, d)
    return found
