"""Points on the map, in degrees."""

from __future__ import annotations

from math import floor

from pyspark.sql import Column
from pyspark.sql import functions as F

# Continent numbers of the coarsest zoom level.
CONTINENTS = {
    0: "North America", 1: "South America", 2: "Asia", 3: "Oceania", 4: "Antarctica", 5: "Europe", 6: "Africa",
}


def in_world(lat: Column, lon: Column) -> Column:
    """Latitude and longitude within bounds, the bounds included."""
    return lat.between(-90, 90) & lon.between(-180, 180)


def continent(lat: Column, lon: Column) -> Column:
    """Continent number by straight border lines."""
    americas = F.when(lat < 13, F.lit(1)).otherwise(F.lit(0))
    asian_side = F.when((lon < 60) & (lat < 20), F.lit(6)).otherwise(F.lit(2))
    indian_ocean_side = F.when(lon < 70, F.lit(6)).otherwise(F.lit(3))
    east = F.when(lat > 0, asian_side).otherwise(indian_ocean_side)
    middle = F.when(lat > 35.8, F.lit(5)).otherwise(F.lit(6))
    return F.when(lat < -55, F.lit(4)).when(lon < -25, americas).when(lon > 35, east).otherwise(middle)


def continent_name(number: Column) -> Column:
    """Name of a continent number."""
    names = F.create_map(*[F.lit(x) for pair in CONTINENTS.items() for x in pair])
    return F.try_element_at(names, number)


# Bits of each axis of a place key.
KEY_BITS = 16
_STEPS = 1 << KEY_BITS


def _spread(value: Column) -> Column:
    """The bits of a number of ``KEY_BITS`` bits with a gap behind each."""
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        value = value.bitwiseOR(F.shiftleft(value, shift)).bitwiseAND(F.lit(mask).cast("long"))
    return value


def place_key(lat: Column, lon: Column) -> Column:
    """A number by which places near each other mostly lie together: the bits of both axes in turn. -1 outside of the world or without a place."""
    y = F.least(F.floor((lat + 90) * (_STEPS / 180)), F.lit(_STEPS - 1)).cast("long")
    x = F.least(F.floor((lon + 180) * (_STEPS / 360)), F.lit(_STEPS - 1)).cast("long")
    return F.when(in_world(lat, lon), F.shiftleft(_spread(y), 1).bitwiseOR(_spread(x))).otherwise(F.lit(-1)).cast("long")


def key_ranges(lat: tuple[float, float], lon: tuple[float, float], most: int = 24) -> list[tuple[int, int]]:
    """At most ``most`` ranges of place keys that hold all places of a box; they may hold more."""
    # The very arithmetic of the key, so that borders fall into the same step.
    low = [floor(min(max((v + o) * (_STEPS / s), 0), _STEPS - 1)) for v, o, s in ((lat[0], 90, 180), (lon[0], 180, 360))]
    high = [floor(min(max((v + o) * (_STEPS / s), -1), _STEPS - 1)) for v, o, s in ((lat[1], 90, 180), (lon[1], 180, 360))]
    outside = [] if lat[0] >= -90 and lat[1] <= 90 and lon[0] >= -180 and lon[1] <= 180 else [(-1, -1)]
    if low[0] > high[0] or low[1] > high[1]:
        return outside
    # Squares (first key, row, column, size) that the box cuts: the largest are quartered while there is room.
    whole, open_ = [], [(0, 0, 0, _STEPS)]
    while open_ and len(whole) + len(open_) + 3 <= most:
        open_.sort(key=lambda s: s[3])
        key, y, x, size = open_.pop()
        half = size // 2
        for part in range(4):
            at, row, column = key + part * half * half, y + part // 2 * half, x + part % 2 * half
            if row > high[0] or row + half - 1 < low[0] or column > high[1] or column + half - 1 < low[1]:
                continue
            inside = low[0] <= row and row + half - 1 <= high[0] and low[1] <= column and column + half - 1 <= high[1]
            (whole if inside or half == 1 else open_).append((at, row, column, half))
    ranges: list[tuple[int, int]] = []
    for key, _, _, size in sorted(whole + open_):
        if ranges and ranges[-1][1] + 1 == key:
            ranges[-1] = ranges[-1][0], key + size * size - 1
        else:
            ranges.append((key, key + size * size - 1))
    return outside + ranges


def squared_degrees(lat: Column, lon: Column, to_lat: Column, to_lon: Column) -> Column:
    """Squared Euclidean distance in degrees, the measure the clusters use."""
    return (lat - to_lat) * (lat - to_lat) + (lon - to_lon) * (lon - to_lon)
