"""Words on the map: significant words with the position of their article."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def geo_words(words: DataFrame, coords: DataFrame, titles: DataFrame | None = None) -> DataFrame:
    """Add ``lat`` and ``lon`` to significant words.

    With a ``page_id`` in ``words`` the join runs on it: at most the top words of one page share a key. Words read from
    a file know the article title only and go through ``titles``, which has one page per title.
    """
    points = coords.select("page_id", "lat", "lon")
    if "page_id" in words.columns:
        return words.join(points, "page_id")
    named = titles.join(points, "page_id").select(F.col("title").alias("article"), "page_id", "lat", "lon")
    return words.join(named, "article")


def geo_pages_words(best: DataFrame, coords: DataFrame) -> DataFrame:
    """(page_id, article, lat, lon, best): pages with their best words as an array, joined page by page; ``words_of_places`` lists the words."""
    return best.join(coords.select("page_id", "lat", "lon"), "page_id").select("page_id", "article", "lat", "lon", "best")


def words_of_places(placed: DataFrame) -> DataFrame:
    """(page_id, word, tf, article, df, tf_idf, lat, lon), as ``geo_words``."""
    return placed.select("page_id", "article", "lat", "lon", F.inline("best")).select("page_id", "word", "tf", "article", "df", "tf_idf", "lat", "lon")


def articles(words: DataFrame) -> DataFrame:
    """Distinct article names."""
    return words.select("article").distinct()
