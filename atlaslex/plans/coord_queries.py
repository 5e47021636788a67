"""Questions asked of the coordinate table. All are filters that reach the Parquet scan."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atlaslex.functions.geo import key_ranges


def in_box(coords: DataFrame, lat: tuple[float, float], lon: tuple[float, float]) -> DataFrame:
    """Titles within a box, borders included."""
    return coords.filter(F.col("lat").between(*lat) & F.col("lon").between(*lon)).select("title")


def placed_in_box(places: DataFrame, lat: tuple[float, float], lon: tuple[float, float]) -> DataFrame:
    """Rows within a box of a table that ``write_placed`` made: only parts of files whose keys fall into a few ranges are read."""
    ranges = [F.col("place_key").between(*r) for r in key_ranges(lat, lon)]
    within = reduce(lambda a, b: a | b, ranges, F.lit(False))
    return places.filter(within & F.col("lat").between(*lat) & F.col("lon").between(*lon)).drop("place_key")


def of_type(coords: DataFrame, kind: str) -> DataFrame:
    """(title, coords) of places of one type."""
    return coords.filter(F.col("type") == kind).select("title", "coords")


def title_contains(coords: DataFrame, part: str) -> DataFrame:
    """Places whose title contains ``part``."""
    return coords.filter(F.contains("title", F.lit(part))).select("title", "type", "lat", "lon")


def title_is(coords: DataFrame, title: str) -> DataFrame:
    """Places of one title."""
    return coords.filter(F.col("title") == title).select("title", "type", "lat", "lon")


def after_page(coords: DataFrame, page_id: int) -> DataFrame:
    """Rows of pages after ``page_id``."""
    return coords.filter(F.col("page_id") > page_id)


def ask(coords: DataFrame, sql: str, name: str = "coords") -> DataFrame:
    """Any SQL over the coordinate table, which it calls ``{name}``; the session's views are left alone."""
    return coords.sparkSession.sql(sql, **{name: coords})
