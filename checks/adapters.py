"""Article-like views over the supplied tables, as column lists that Spark and DuckDB both read.

The tables hold no coordinate templates, so each document is given one of six shapes by its id, and an article text
around it: template, reference, self-closed tag, category, language link and a "See also" tail.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from checks.registry import Tables

COORD = """case doc_id % 6
 when 0 then 'Coord|' || (doc_id*37 % 90) || '.' || (10 + doc_id % 90) || '|-' || (doc_id*53 % 180) || '.5|type:city|display=inline,title'
 when 1 then 'Coord|' || (doc_id*37 % 90) || '|' || (doc_id*13 % 60) || '|' || (doc_id*29 % 60) || '|N|' || (doc_id*53 % 180) || '|' || (doc_id*17 % 60) || '|' || (doc_id*31 % 60) || '|W|region:US-AK_type:adm1st|display=inline,title'
 when 2 then 'coord|' || (doc_id*37 % 90) || '|' || (doc_id*13 % 60) || '|S|' || (doc_id*53 % 180) || '|' || (doc_id*17 % 60) || '|E|name=Site ' || doc_id || '|display=title'
 when 3 then 'Coord|' || (doc_id*37 % 90) || ',5|S|' || (doc_id*53 % 180) || '|E|type:landmark| display=title'
 when 4 then 'Coord|' || (doc_id*37 % 90) || '|' || (doc_id*13 % 60) || '|' || (doc_id*29 % 60) || '|7|display=inline,title'
 else 'Coord|1d|2|url=http://x?a=' || doc_id || '|url=second' end"""

COORD_PAGE = ["doc_id as page_id", "'Doc ' || doc_id as title", "lang", "source", "text", f"{COORD} as coord"]
WIKITEXT = """'{{' || coord || '}} ' || text || ' <ref>note ' || source || '</ref><br/> [[Category:' || source || '|' || lang
 || ']] [[' || lang || ':Doc ' || page_id || ']] ==See also== tail'"""
WIKI_PAGE = ["page_id", "title", "lang", "source", f"{WIKITEXT} as wikitext"]

# Points of which some lie outside the world.
CUSTOMER_POINT = [
    "c_custkey as point_id", "cast(c_custkey % 200 - 100 as double) as lat", "cast(c_custkey * 7 % 400 - 200 as double) as lon",
    "c_mktsegment as word", "c_acctbal as tf_idf",
]

# Rectangles of the map at three sizes, standing in for fitted clusters where SQL has to follow.
GRID = [
    "cast(floor((lat + 90) / 15) * 24 + floor((lon + 180) / 15) as int) as cluster_193",
    "cast(floor((lat + 90) / 5) * 72 + floor((lon + 180) / 5) as int) as cluster_4000",
    "cast(floor((lat + 90) / 2) * 180 + floor((lon + 180) / 2) as int) as cluster_25000",
]

CENTERS = [
    (0, 0.0, 0.0), (1, 40.0, -100.0), (2, -15.0, -55.0), (3, 50.0, 10.0), (4, 35.0, 105.0), (5, -25.0, 135.0),
    (6, 60.5, -30.5), (7, 10.0, 20.0), (8, -30.0, 25.0), (9, 65.0, -150.0), (10, -80.0, 60.0), (11, 22.5, 78.5),
]

SYMBOLS = "%#$&*+@!éçß"
SYMBOL_REMOVALS = "#$*"


def coord_pages(t: Tables) -> DataFrame:
    """(page_id, title, lang, source, text, coord)"""
    return t.documents.selectExpr(*COORD_PAGE)


def wiki_pages(t: Tables) -> DataFrame:
    """(page_id, title, lang, source, wikitext)"""
    return coord_pages(t).selectExpr(*WIKI_PAGE)


def customer_points(t: Tables) -> DataFrame:
    """(point_id, lat, lon, word, tf_idf)"""
    return t.customer.selectExpr(*CUSTOMER_POINT)


def fixed_centers(t: Tables) -> DataFrame:
    """Twelve centers with a count of points seen before."""
    rows = [(c, lat, lon, c * 10) for c, lat, lon in CENTERS]
    return t.spark.createDataFrame(rows, "cluster int, lat double, lon double, n bigint")


def symbol_set(t: Tables, characters: str = SYMBOLS) -> DataFrame:
    """One row per character."""
    return t.spark.createDataFrame([(c,) for c in characters], "symbol string")
