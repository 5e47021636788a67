"""Lists of page ids per key, in page order.

A symbol or category may occur on a third of all pages, so its list cannot be one array. The list is cut by page id into
ranges of ``RANGE`` ids: each array then holds at most ``RANGE`` ids whatever the data, and reading the ranges in order
gives the whole list.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

RANGE = 1_000_000


def page_lists(pairs: DataFrame, key: str, page: str = "page_id", size: int = RANGE) -> DataFrame:
    """Sorted page ids of each key per id range, one row for each part of a list.

    (key, pagecount, first_page, part, pages_from, pages): the first two are of the key's whole list, ``part`` counts its
    rows from 0. ``pairs`` holds distinct (key, page) rows. No row stands for a key: a list has as many parts as ranges.
    """
    start = F.floor(F.col(page) / F.lit(size)) * F.lit(size)
    parts = pairs.groupBy(key, start.cast("long").alias("pages_from")).agg(
        F.count(F.lit(1)).alias("_n"), F.sort_array(F.collect_list(page)).alias("pages")
    )
    # The rows of a key are as many as ranges of ids.
    whole = Window.partitionBy(key)
    return parts.select(
        key,
        F.sum("_n").over(whole).alias("pagecount"),
        F.min(F.get("pages", F.lit(0))).over(whole).alias("first_page"),
        (F.row_number().over(whole.orderBy("pages_from")) - 1).alias("part"),
        "pages_from",
        "pages",
    )


def page_stats(pairs: DataFrame, key: str, page: str = "page_id") -> DataFrame:
    """(key, pagecount, first_page): counted without building the lists."""
    return pairs.groupBy(key).agg(F.count(F.lit(1)).alias("pagecount"), F.min(page).alias("first_page"))


def expand_lists(lists: DataFrame, key: str, page: str = "page_id") -> DataFrame:
    """Back to (key, page) rows."""
    return lists.select(key, F.explode("pages").alias(page))
