"""Symbols in articles, and where on the map they occur first."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atlaslex.functions.words import code_points
from atlaslex.operators.lookup import broadcast_if_small
from atlaslex.operators.page_lists import page_stats
from atlaslex.plans.geo_index import COORD_ROW, first_loaded, geo_pages, shown_in_title
from atlaslex.staging import stage

# Characters that are letters, currency or drawing signs in articles rather than symbols.
REMOVALS = (
    "\n #*-$−=Ἀ°Ῥὸ©ἔἸἀ™Ἄῦἴἱὰ→ἄᾴἰῖἝᾶῶὮὶὔἁῆ€ῷὐ─ἐ₨₽᾽ἡ∼∆₹₱ὄὴὁῴ"
    "Ἱ≈ῃ∗ἂἾἤὕὨ∟元ἜἘἑἕὼὈ円∀ῥ≥Ἠὺ♂®ὖὲἙἼ≤Ὁῳ¢┌Ἡ℃⋆Ὄ️╫₤ῇ῾Ἁᾷ↓└Ἅ√╡ὦ↔╟῎ᾱ╣│℉¥╦원⋅₳←╨▪Ἦὑ¤↑"
)


def removal_set(spark: SparkSession, characters: str = REMOVALS) -> DataFrame:
    """The characters left out, as rows ``(symbol)``."""
    return spark.range(1).select(F.explode(F.split(F.lit(characters), "")).alias("symbol")).distinct()


def _single(symbols: DataFrame) -> DataFrame:
    """Distinct single code points, of which there are 1,114,112 at most: a bound for broadcasts that no data exceeds."""
    return symbols.filter(F.char_length("symbol") == 1).select("symbol").distinct()


def wanted_symbols(symbols: DataFrame, removals: DataFrame) -> DataFrame:
    """Symbols without the removals."""
    return _single(symbols).join(F.broadcast(_single(removals)), "symbol", "left_anti")


def symbol_pages(pages: DataFrame, symbols: DataFrame) -> DataFrame:
    """Distinct (symbol, page_id) for pages ``(page_id, wikitext)``.

    A page contributes its distinct characters, found within its row.
    """
    characters = pages.select("page_id", F.explode(code_points(F.col("wikitext"))).alias("symbol"))
    return characters.join(F.broadcast(_single(symbols)), "symbol", "left_semi").select("symbol", "page_id")


def matched_symbols(pairs: DataFrame) -> DataFrame:
    """All symbols that occur anywhere."""
    return pairs.select("symbol").distinct()


def single_page_symbols(stats: DataFrame) -> DataFrame:
    """Symbols that occur on one page only."""
    return stats.filter("pagecount = 1")


def first_places(stats: DataFrame, coords: DataFrame) -> DataFrame:
    """(symbol, pagecount, page_id, title, lat, lon) of the first page of each symbol."""
    first = broadcast_if_small(stats.withColumnRenamed("first_page", "page_id"))
    return coords.select("page_id", "title", "lat", "lon").join(first, "page_id")


def usable(places: DataFrame) -> DataFrame:
    """Places that have a position: a missing one is null or lies on the meridian of 0."""
    return places.filter(F.col("lon").isNotNull() & (F.col("lon") != 0))


def usable_first_places(pairs: DataFrame, coords: DataFrame) -> DataFrame:
    """First places of distinct (symbol, page_id) rows, without those that have no position."""
    return usable(first_places(page_stats(pairs, "symbol"), coords))


def symbol_places(pages: DataFrame, coords: DataFrame, symbols: DataFrame, removals: DataFrame) -> DataFrame:
    """(symbol, pagecount, page_id, title, lat, lon) for symbols whose first page has a usable position."""
    return usable_first_places(symbol_pages(pages, wanted_symbols(symbols, removals)), coords)


def symbol_places_of_pages(pages: DataFrame, symbols: DataFrame, removals: DataFrame) -> DataFrame:
    """The same from pages (page_id, title, wikitext): they are scanned and their templates decoded once, for texts and positions."""
    found = stage(geo_pages(pages).selectExpr(*COORD_ROW, "wikitext"), "geo-pages")
    # The first of rows with the same id counts, for its text as well.
    shown = shown_in_title(first_loaded(found, None, []))
    return symbol_places(shown.select("page_id", "wikitext"), shown, symbols, removals)
