"""Sets of page ids per key, as bitmaps where they are dense and as sorted lists where they are not.

A frequent symbol occurs on a third of all pages. Its pages are bits here, in bitmaps of ``BITS`` ids that are built before
the shuffle: a task hands on 4 KB for each key and bucket of ids, whatever the number of pages, so a frequent key is no heavier to
reduce than others. A key on few pages would waste such bitmaps; it keeps sorted lists by ranges of ``RANGE`` ids.
Which of both a key gets follows from its count: dense is at least one page in ``SPARSE`` ids of the span of all ids, where the
bitmap is smaller than the list. Counts, first pages, single pages and unions read no list of a dense key; ids come back at export.

A set is the rows ``(key, pages_from, n, first_page, pages, bitmap)`` of its key, of which ``pages`` or ``bitmap`` is null.
Pairs may repeat; a null key or page is no member; ids may have any sign. Without pairs there are no sets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from atlaslex.operators.lookup import broadcast_if_small
from atlaslex.staging import stage

#: Ids of a bitmap, which is what Spark's bitmap functions hold, and bytes of it.
BITS, BYTES = 1 << 15, 1 << 12
#: Ids of a range of the lists.
RANGE = 1 << 20
#: A list of longs takes as much as a bitmap at this many ids a page.
SPARSE = BITS // (BYTES // 8)

COLUMNS = ("pages_from", "n", "first_page", "pages", "bitmap")


def _range_start(page: Column, size: int) -> Column:
    """First id of the range of an id."""
    return (page - F.pmod(page, F.lit(size))).cast("long")


def page_sets(pairs: DataFrame, key: str, page: str = "page_id") -> DataFrame:
    """The sets of (key, page) rows; the pairs are read twice, so they should be a stored table."""
    pairs = pairs.select(key, F.col(page).cast("long").alias("page")).dropna()
    counts = stage(pairs.groupBy(key).agg(F.count("*").alias("n"), F.min("page").alias("low"), F.max("page").alias("high")), "set-counts")
    span = counts.agg(F.coalesce(F.max("high") - F.min("low") + 1, F.lit(1)).alias("ids")).first()["ids"]
    # At most SPARSE keys for every pair an id has on average, and measured before it is broadcast.
    dense = broadcast_if_small(counts.where(F.col("n") * SPARSE >= span).select(key))
    return _bitmaps(pairs.join(dense, key, "left_semi"), key).unionByName(_lists(pairs.join(dense, key, "left_anti"), key))


def _bitmaps(pairs: DataFrame, key: str) -> DataFrame:
    position = F.pmod(F.col("page"), F.lit(BITS)).cast("long")
    found = pairs.groupBy(key, _range_start(F.col("page"), BITS).alias("pages_from")).agg(
        F.min("page").alias("first_page"), F.bitmap_construct_agg(position).alias("bitmap")
    )
    return _bitmap_rows(found, key)


def _bitmap_rows(found: DataFrame, key: str) -> DataFrame:
    no_list = F.lit(None).cast("array<long>")
    return found.select(key, "pages_from", F.bitmap_count("bitmap").alias("n"), "first_page", no_list.alias("pages"), "bitmap")


def _lists(pairs: DataFrame, key: str) -> DataFrame:
    found = pairs.groupBy(key, _range_start(F.col("page"), RANGE).alias("pages_from")).agg(
        F.sort_array(F.collect_set("page")).alias("pages")
    )
    no_bitmap = F.lit(None).cast("binary")
    return found.select(
        key, "pages_from", F.size("pages").cast("long").alias("n"), F.element_at("pages", 1).alias("first_page"), "pages",
        no_bitmap.alias("bitmap"),
    )


def set_stats(sets: DataFrame, key: str) -> DataFrame:
    """(key, pagecount, first_page) without looking into bitmaps or lists."""
    return sets.groupBy(key).agg(F.sum("n").alias("pagecount"), F.min("first_page").alias("first_page"))


def union_sets(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """The pages of either side by key. Bitmaps are joined as bitmaps; a list joins them if its key is dense on the other side."""
    rows = left.unionByName(right)
    dense = broadcast_if_small(rows.where(F.col("bitmap").isNotNull()).select(key).distinct())
    listed = rows.where(F.col("bitmap").isNull()).select(key, F.explode("pages").alias("page"))
    bitmaps = rows.where(F.col("bitmap").isNotNull()).unionByName(_bitmaps(listed.join(dense, key, "left_semi"), key))
    merged = bitmaps.groupBy(key, "pages_from").agg(F.min("first_page").alias("first_page"), F.bitmap_or_agg("bitmap").alias("bitmap"))
    return _bitmap_rows(merged, key).unionByName(_lists(listed.join(dense, key, "left_anti"), key))


# Bytes of a bitmap that have a bit, and the bits of each: bit j of byte i stands for the id 8 * i + j of the bucket.
_IDS_OF_BITMAP = f"""
flatten(transform(
  filter(sequence(0, {BYTES - 1}), i -> substring(bitmap, i + 1, 1) <> X'00'),
  i -> transform(
    filter(sequence(0, 7), j -> getbit(cast(conv(hex(substring(bitmap, i + 1, 1)), 16, 10) AS bigint), j) = 1),
    j -> pages_from + 8 * i + j)))
"""


def listed_pages() -> Column:
    """Sorted ids of a row of a set, for exports."""
    return F.when(F.col("bitmap").isNull(), F.col("pages")).otherwise(F.expr(_IDS_OF_BITMAP))


def expand_sets(sets: DataFrame, key: str, page: str = "page_id") -> DataFrame:
    """Back to distinct (key, page) rows."""
    return sets.select(key, F.explode(listed_pages()).alias(page))


def lists_of_sets(sets: DataFrame, key: str) -> DataFrame:
    """The sets as page lists, one row for each part: (key, pagecount, first_page, part, pages_from, pages)."""
    whole = Window.partitionBy(key)
    return sets.select(
        key,
        F.sum("n").over(whole).alias("pagecount"),
        F.min("first_page").over(whole).alias("first_page"),
        (F.row_number().over(whole.orderBy("pages_from")) - 1).alias("part"),
        "pages_from",
        listed_pages().alias("pages"),
    )
