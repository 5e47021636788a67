"""From dump pages to the table of places.

``geo_pages`` is one scan without a shuffle: pages that mention a coordinate are parsed, the others dropped. Its output
keeps the page text beside the decoded position, so that later text stages read this table, filter on ``display`` at
the Parquet scan and need no join back to the dump.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atlaslex.functions.coords import KEYWORD_COLUMNS, decode_coord, keyword_map, mentions_coord, page_coord
from atlaslex.operators.lookup import broadcast_if_small
from atlaslex.operators.ranking import first_per_key
from atlaslex.staging import stage

# Fixed value: how the template says that the coordinate belongs to the article itself.
SHOWN_IN_TITLE = "inline,title"


@dataclass
class GeoIndex:
    """The three tables of the index."""

    pages: DataFrame
    coords: DataFrame
    titles: DataFrame


def _once(coord: Column) -> Column:
    """Generator of one row: template, position and keywords of a page, or of no row when the template is missing.

    A generator is where the optimizer stops: a filter on ``display`` is not pushed below it, so that the template is
    found once per page and not once per predicate.
    """
    return F.inline(_found(coord))


def _found(coord: Column) -> Column:
    """Template, position and keywords as an array of one entry, or of none."""
    return F.transform(
        F.filter(F.array(coord), lambda c: c.isNotNull() & (c != "")),
        lambda c: F.struct(c.alias("coords"), decode_coord(c).alias("_position"), keyword_map(c).alias("_keywords")),
    )


# The fixed columns of the coordinate table; the article title always replaces a keyword of that name.
COORD_ROW = [
    "coords", "_position.lat", "_position.lon", "page_id",
    *(f"coalesce({'title' if k == 'title' else f"try_element_at(_keywords, '{k}')"}, '') AS {k}" for k in KEYWORD_COLUMNS),
    "_position.parsed",
]


def explode_keywords(tags: DataFrame) -> DataFrame:
    """(page_id, title, coords) -> coordinate table with 4 + 21 columns, defaults filled, plus ``parsed``."""
    return tags.select("page_id", "title", _once(F.col("coords"))).selectExpr(*COORD_ROW)


def page_positions(tags: DataFrame) -> DataFrame:
    """(page_id, title, coords) -> (page_id, lat, lon) of the coordinate table, without its keywords."""
    found = F.transform(F.filter(F.array("coords"), lambda c: c.isNotNull() & (c != "")), decode_coord)
    return tags.select("page_id", F.inline(found)).select("page_id", "lat", "lon")


def geo_pages(pages: DataFrame, *others: str) -> DataFrame:
    """(page_id, title, wikitext, coords, _position, _keywords) and other columns of the pages with a coordinate template."""
    mentioning = pages.filter(mentions_coord(F.col("wikitext")))
    return mentioning.select("page_id", "title", "wikitext", *others, _once(page_coord(F.col("wikitext"))))


FOUND, MISSING, REJECTED = "found", "missing", "rejected"


def loaded_pages(parsed: DataFrame, *others: str) -> DataFrame:
    """All parsed records of pages that mention a coordinate, each with its ``state``: found, template missing, or rejected by the parser.

    Found pages have the columns of the coordinate table and their text, rejected ones their record.
    """
    rows = parsed.select("page_id", "title", "wikitext", "record", *others, F.inline_outer(_found(page_coord(F.col("wikitext")))))
    state = F.when(F.col("page_id").isNull(), F.lit(REJECTED)).when(F.col("coords").isNull(), F.lit(MISSING)).otherwise(F.lit(FOUND))
    rows = rows.withColumn("state", state)
    return rows.selectExpr(
        "state", *COORD_ROW, f"if(state = '{FOUND}', wikitext, null) as wikitext", f"if(state = '{REJECTED}', record, null) as record", *others
    )


def loaded_statistics(loaded: DataFrame, pages: int, coord_pages: int) -> DataFrame:
    """One row on a load: all pages it read, those mentioning a coordinate, what became of them, and the share mentioning one."""
    counted = loaded.agg(F.count_if(F.col("state") == FOUND).alias("successes"), F.count_if(F.col("state") == REJECTED).alias("rejected"))
    read = counted.select(F.lit(pages).cast("long").alias("pages"), F.lit(coord_pages).cast("long").alias("coord_pages"), "successes", "rejected")
    percent = F.round(F.try_divide(F.lit(100.0) * F.col("coord_pages"), "pages"), 2)
    return read.withColumns({"failures": F.col("coord_pages") - F.col("successes"), "percent": percent})


def shown_in_title(coords: DataFrame) -> DataFrame:
    """Places whose coordinate is shown both inline and in the title: the input of every text stage."""
    return coords.filter(F.col("display") == SHOWN_IN_TITLE)


def selected_pages(pages: DataFrame, coords: DataFrame) -> DataFrame:
    """Pages of the selected places, by page id: for places stored without text. ``text_pages`` needs no join."""
    return pages.join(shown_in_title(coords).select("page_id"), "page_id", "left_semi")


def text_pages(pages: DataFrame) -> DataFrame:
    """(page_id, title, wikitext) of the selected places in one pass over the dump, with no join."""
    display = F.try_element_at("_keywords", F.lit("display"))
    return geo_pages(pages).filter(display == SHOWN_IN_TITLE).select("page_id", "title", "wikitext")


def title_table(pages: DataFrame) -> DataFrame:
    """(title, page_id): a repeated title belongs to its first page."""
    return pages.filter(F.col("title").isNotNull()).groupBy("title").agg(F.min("page_id").alias("page_id"))


def load_order(pages: DataFrame) -> list[str]:
    """Columns that tell which of two pages was loaded first: file and position where the dump gives them."""
    return [c for c in ("dump_file", "dump_position") if c in pages.columns]


def first_loaded(found: DataFrame, existing: DataFrame | None, order: list[str]) -> DataFrame:
    """The first loaded page of every id that ``existing`` does not hold, with all columns; ``found`` is a stored table.

    Ties of the load order go by template and title. Rows of ids that come once, as nearly all do, are not shuffled: only
    the repeated ids are, and the rows that have one.
    """
    found = found.filter(F.col("page_id").isNotNull())
    if existing is not None:
        found = found.join(existing.select("page_id"), "page_id", "left_anti")
    counts = found.groupBy("page_id").agg(F.count(F.lit(1)).alias("n"))
    repeated = broadcast_if_small(stage(counts.filter("n > 1").select("page_id"), "repeated-ids"))
    once = found.join(repeated, "page_id", "left_anti")
    several = found.join(repeated, "page_id", "left_semi")
    return once.unionByName(first_per_key(several, "page_id", [F.col(c) for c in (*order, "coords", "title")]))


def build_geo_index(pages: DataFrame, existing: DataFrame | None = None) -> GeoIndex:
    """Index of a dump. Of a page id that comes several times, the first loaded page counts, in all three tables.

    With ``existing`` coordinate rows, pages already present keep their row and are not among ``pages``. The scan is
    stored once, without texts, and feeds all three tables.
    """
    order = load_order(pages)
    found = stage(geo_pages(pages, *order).drop("wikitext"), "geo-pages")
    found = first_loaded(found, existing, order).drop(*order)
    coords = found.selectExpr(*COORD_ROW)
    if existing is not None:
        coords = existing.unionByName(coords)
    titles = title_table(shown_in_title(coords).select("title", "page_id"))
    return GeoIndex(found.select("page_id", "title", "coords"), coords, titles)


def load_statistics(pages: DataFrame) -> DataFrame:
    """One row: pages, pages mentioning a coordinate, with and without a template, and the share mentioning one."""
    text = F.col("wikitext")
    flags = pages.select(mentions_coord(text).alias("mention"), F.coalesce(page_coord(text) != "", F.lit(False)).alias("tag"))
    count = F.count(F.lit(1))
    mentions = F.count_if("mention")
    return flags.agg(
        count.alias("pages"),
        mentions.alias("coord_pages"),
        F.count_if(F.col("mention") & F.col("tag")).alias("successes"),
        F.count_if(F.col("mention") & ~F.col("tag")).alias("failures"),
        F.round(F.try_divide(F.lit(100.0) * mentions, count), 2).alias("percent"),
    )


def page_index_of_title(wanted: DataFrame, titles: DataFrame) -> DataFrame:
    """(title, page_id) for asked titles; -1 when there is no such page."""
    return wanted.select("title").join(titles, "title", "left").withColumn("page_id", F.coalesce("page_id", F.lit(-1)))


def page_of_title(wanted: DataFrame, titles: DataFrame, pages: DataFrame) -> DataFrame:
    """(title, page_id, wikitext) for asked titles; -1 and null when there is no such page.

    Titles and ids are joined first, so of ``pages`` only the asked ones go beyond the join by id.
    """
    found = page_index_of_title(wanted, titles)
    asked = found.filter("page_id >= 0").select("page_id").distinct()
    texts = pages.select("page_id", "wikitext").join(asked, "page_id", "left_semi")
    return found.join(texts, "page_id", "left").select("title", "page_id", "wikitext")
