"""The stages as jobs over one folder: each reads the tables of the stages before it and writes its own.

    spark-submit -m atlaslex.jobs index  --dump hdfs:///dumps/enwiki --folder hdfs:///map
    spark-submit -m atlaslex.jobs words  --folder hdfs:///map
    spark-submit -m atlaslex.jobs places --folder hdfs:///map
    spark-submit -m atlaslex.jobs clusters --folder hdfs:///map --dictionary hdfs:///words.txt
    spark-submit -m atlaslex.jobs labels --folder hdfs:///map
    spark-submit -m atlaslex.jobs symbols --folder hdfs:///map --symbols hdfs:///symbols.txt
    spark-submit -m atlaslex.jobs keywords --folder hdfs:///map
    spark-submit -m atlaslex.jobs links --dump hdfs:///dumps/enwiki --folder hdfs:///map
    spark-submit -m atlaslex.jobs box --folder hdfs:///map --box 47,5,55,15
    spark-submit -m atlaslex.jobs ask --folder hdfs:///map --sql "select type, count(*) from {coords} group by type"
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from atlaslex.functions.coords import mentions_coord
from atlaslex.operators.page_sets import lists_of_sets, page_sets, set_stats
from atlaslex.operators.sampling import prefix_rows
from atlaslex.plans import clusters, coord_queries, geo_index, keywords, labels, links, places, significance, symbols
from atlaslex.session import cluster_session
from atlaslex.sinks import files
from atlaslex.sources.dump import leading_records, page_records, parsed_records, read_dump
from atlaslex.sources.tables import read_stage, read_symbol_set, read_word_set
from atlaslex.staging import path_exists, remove_stages, stage


def _load(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return read_stage(spark, f"{folder}/{table}")


def index(spark: SparkSession, folder: str, dump: str, share: float = 1.0) -> None:
    """Places with their text (``places``), titles, ``rejected`` pages, places by their position (``map``) and the load's ``statistics``.

    A rerun adds the pages that are not there yet. Of a page that comes twice, the first one loaded counts. The dump is
    scanned once: counts are observed on the way to one stored table, from which all others are made. With a ``share``, file
    splits are counted first and only the leading pages are parsed; the statistics are those of these pages.
    """
    records = page_records(spark, dump)
    if share < 1:
        records = leading_records(records, prefix_rows(share))
    seen = Observation("load")
    mentions = mentions_coord(F.col("value"))
    # The words of a template are the same in the XML record: pages without them are not even parsed.
    counted = records.observe(seen, F.count(F.lit(1)).alias("pages"), F.count_if(mentions).alias("coord_pages"))
    order = ["dump_file", "dump_position"]
    loaded = stage(geo_index.loaded_pages(parsed_records(counted.filter(mentions)), *order), "loaded")
    found = loaded.filter(F.col("state") == geo_index.FOUND).drop("state", "record")
    stored = f"{folder}/places"
    existing = _load(spark, folder, "places") if path_exists(spark, stored) else None
    geo_index.first_loaded(found, existing, order).drop(*order).write.mode("append").parquet(stored)
    places = _load(spark, folder, "places")
    shown = geo_index.shown_in_title(places)
    files.write_stage(geo_index.title_table(shown.select("title", "page_id")), f"{folder}/titles")
    files.write_placed(places.select("page_id", "title", "type", "display", "lat", "lon"), f"{folder}/map")
    rejected = loaded.filter(F.col("state") == geo_index.REJECTED)
    files.write_stage(rejected.select("record", *order), f"{folder}/rejected")
    read = seen.get
    files.write_stage(geo_index.loaded_statistics(loaded, read["pages"], read["coord_pages"]), f"{folder}/statistics")


def find_in_box(spark: SparkSession, folder: str, box: tuple[float, float, float, float], output: str = "answer") -> None:
    """Places within a box (south, west, north, east), borders included. The answer is a table of the folder."""
    south, west, north, east = box
    files.write_stage(coord_queries.placed_in_box(_load(spark, folder, "map"), (south, north), (west, east)), f"{folder}/{output}")


def link_pages(spark: SparkSession, folder: str, dump: str) -> None:
    """Category lists and language links of all pages of a dump."""
    pages = read_dump(spark, dump)
    files.write_stage(links.category_map(pages), f"{folder}/categories")
    files.write_stage(links.language_pages(pages), f"{folder}/language_links")


def ask(spark: SparkSession, folder: str, sql: str, output: str = "answer") -> None:
    """A SQL question about the places, which it calls ``{coords}``. The answer is a table of the folder."""
    files.write_stage(coord_queries.ask(_load(spark, folder, "places"), sql), f"{folder}/{output}")


def words(spark: SparkSession, folder: str, top: int = significance.TOP_WORDS) -> None:
    """Term counts, document frequencies and significant words of the places shown in the title."""
    shown = geo_index.shown_in_title(_load(spark, folder, "places"))
    files.write_stage(significance.term_counts(significance.plain_pages(shown)), f"{folder}/term_counts")
    counts = _load(spark, folder, "term_counts")
    files.write_stage(significance.doc_freq(counts), f"{folder}/doc_freq")
    best = significance.significant_words(counts, _load(spark, folder, "doc_freq"), top)
    files.write_stage(best, f"{folder}/tfidf")


def place_words(spark: SparkSession, folder: str) -> None:
    """Significant words with positions."""
    placed = places.geo_words(_load(spark, folder, "tfidf"), _load(spark, folder, "places"))
    files.write_stage(placed, f"{folder}/geo_words")


def cluster(
    spark: SparkSession, folder: str, dictionary: str, counts: tuple[int, ...] = clusters.CLUSTER_COUNTS, batches: bool = False
) -> None:
    """Dictionary words within the world, with their clusters, fitted on all places or on three draws of them."""
    known = read_word_set(spark, dictionary)
    files.write_stage(clusters.mappable_words(_load(spark, folder, "geo_words"), known), f"{folder}/mappable")
    files.write_stage(clusters.cluster_words(_load(spark, folder, "mappable"), counts, batches=batches), f"{folder}/clusters")


def label(spark: SparkSession, folder: str, zooms: tuple[str, ...] = labels.ZOOMS) -> None:
    """Labels and centers, as a table and as one CSV file per zoom level."""
    files.write_stage(labels.label_clusters(_load(spark, folder, "clusters"), zooms), f"{folder}/labels")
    files.write_labels(_load(spark, folder, "labels"), f"{folder}/labels_csv")


def find_symbols(spark: SparkSession, folder: str, symbol_file: str) -> None:
    """Symbols on the places shown in the title: page sets, counts and first places; lists only in the exports."""
    shown = geo_index.shown_in_title(_load(spark, folder, "places"))
    wanted = symbols.wanted_symbols(read_symbol_set(spark, symbol_file), symbols.removal_set(spark))
    files.write_stage(symbols.symbol_pages(shown, wanted), f"{folder}/symbol_pages")
    files.write_stage(page_sets(_load(spark, folder, "symbol_pages"), "symbol"), f"{folder}/symbol_sets")
    sets = _load(spark, folder, "symbol_sets")
    lists = lists_of_sets(sets, "symbol")
    files.write_symbol_pages(lists, f"{folder}/symbols_to_page")
    files.write_symbol_table(lists, f"{folder}/emoji_csv")
    files.write_symbol_places(symbols.usable(symbols.first_places(set_stats(sets, "symbol"), shown)), f"{folder}/symbol_places")


def profile_keywords(spark: SparkSession, folder: str) -> None:
    """How often templates use which keyword."""
    files.write_stage(keywords.keyword_usage(_load(spark, folder, "places").select("coords")), f"{folder}/keywords")


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="atlaslex.jobs")
    names = ["index", "words", "places", "clusters", "labels", "symbols", "keywords", "links", "ask", "box"]
    parser.add_argument("stage", choices=names)
    parser.add_argument("--folder", required=True)
    parser.add_argument("--dump")
    parser.add_argument("--share", type=float, default=1.0)
    parser.add_argument("--dictionary")
    parser.add_argument("--batches", action="store_true", help="clusters: mini-batch fit")
    parser.add_argument("--symbols")
    parser.add_argument("--sql")
    parser.add_argument("--box", help="south,west,north,east")
    parser.add_argument("--top", type=int, default=significance.TOP_WORDS)
    given = parser.parse_args(arguments)
    spark = cluster_session(f"atlaslex-{given.stage}")
    if given.stage == "index":
        index(spark, given.folder, given.dump, given.share)
    elif given.stage == "words":
        words(spark, given.folder, given.top)
    elif given.stage == "places":
        place_words(spark, given.folder)
    elif given.stage == "clusters":
        cluster(spark, given.folder, given.dictionary, batches=given.batches)
    elif given.stage == "labels":
        label(spark, given.folder)
    elif given.stage == "symbols":
        find_symbols(spark, given.folder, given.symbols)
    elif given.stage == "links":
        link_pages(spark, given.folder, given.dump)
    elif given.stage == "box":
        find_in_box(spark, given.folder, tuple(float(v) for v in given.box.split(",")))
    elif given.stage == "ask":
        ask(spark, given.folder, given.sql)
    else:
        profile_keywords(spark, given.folder)
    remove_stages(spark)


if __name__ == "__main__":
    main()
