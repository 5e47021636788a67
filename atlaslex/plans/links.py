"""Category membership and the same page in other languages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atlaslex.functions.links import categories, language_links, language_title
from atlaslex.operators.page_lists import page_lists


def category_pages(pages: DataFrame) -> DataFrame:
    """Distinct (category, page_id)."""
    return pages.select(F.explode(categories(F.col("wikitext"))).alias("category"), "page_id")


def category_map(pages: DataFrame) -> DataFrame:
    """Page lists in page order, one row for each part of a list."""
    return page_lists(category_pages(pages), "category")


def language_pages(pages: DataFrame) -> DataFrame:
    """(page_id, language, foreign_title) for every language link."""
    return pages.select("page_id", F.explode(language_links(F.col("wikitext"))).alias("language", "foreign_title"))


def same_page_in(pages: DataFrame, language: str) -> DataFrame:
    """(page_id, foreign_title) for all pages; NULL without a link to that language."""
    return pages.select("page_id", language_title(F.col("wikitext"), language).alias("foreign_title"))
