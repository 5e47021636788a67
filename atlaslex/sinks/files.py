"""Writers for stage tables and exports. Every writer replaces the output of an earlier run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atlaslex.functions.geo import place_key

# Significant words of this many pages per file, fifty words each, as a batch size for exports.
ROWS_PER_FILE = 500_000
# Bytes of a row group of places, so that one is a small region.
PLACED_GROUP_BYTES = 4 << 20


def write_stage(df: DataFrame, path: str) -> None:
    """A stage table in Parquet."""
    df.write.mode("overwrite").parquet(path)


def write_placed(places: DataFrame, path: str, group_bytes: int = PLACED_GROUP_BYTES) -> None:
    """Places in the order of their place key, in small row groups: a box is a few ranges of keys, and so a few groups."""
    keyed = places.withColumn("place_key", place_key(F.col("lat"), F.col("lon")))
    # Places of one key, such as (0, 0), are dealt over several files too.
    order = ("place_key", *(F.xxhash64(c) for c in places.columns[:1]))
    ranged = keyed.repartitionByRange(*order).sortWithinPartitions("place_key")
    ranged.write.mode("overwrite").option("parquet.block.size", str(group_bytes)).parquet(path)


def write_word_file(words: DataFrame, path: str) -> None:
    """Significant words as CSV with header; the first column repeats the word as the index."""
    words.select(F.col("word").alias("idx"), "word", "tf", "article", "df", "tf_idf").write.mode("overwrite").options(
        header="true", quote='"', escape='"', maxRecordsPerFile=ROWS_PER_FILE
    ).csv(path)


def write_labels(labels: DataFrame, path: str) -> None:
    """(label, lat, lon) as one CSV file per zoom level, in folders ``zoom=...``.

    A zoom level has at most as many rows as clusters, so one file each is a bounded amount.
    """
    labels.select("zoom", "label", "lat", "lon").repartition("zoom").write.mode("overwrite").partitionBy("zoom").options(
        header="true", quote='"', escape='"'
    ).csv(path)


def write_symbol_table(lists: DataFrame, path: str) -> None:
    """Page lists of symbols (as JSON text) as CSV, one row per part, with the count of the symbol's whole list."""
    lists.select("symbol", F.to_json("pages").alias("pages"), "pagecount", "first_page", "part", "pages_from").write.mode(
        "overwrite"
    ).options(header="true", quote='"', escape='"').csv(path)


def write_symbol_pages(lists: DataFrame, path: str) -> None:
    """``{symbol: [pages]}`` JSON objects, one per line; the parts of a list follow each other in page order."""
    ordered = lists.repartitionByRange("symbol", "part").sortWithinPartitions("symbol", "part")
    ordered.select(F.to_json(F.create_map("symbol", "pages")).alias("value")).write.mode("overwrite").text(path)


def write_symbol_places(places: DataFrame, path: str) -> None:
    """``{title, coordsDecimal: {lat, lon}, page_name}`` records, one JSON object per line."""
    places.select(
        F.col("symbol").alias("title"), F.struct("lat", "lon").alias("coordsDecimal"), F.col("title").alias("page_name")
    ).write.mode("overwrite").json(path)


def write_dump(pages: DataFrame, path: str) -> None:
    """Pages as MediaWiki XML, for fixtures and exchange."""
    pages.select(
        F.col("page_id").alias("id"), "title", F.struct(F.struct(F.col("wikitext").alias("_VALUE")).alias("text")).alias("revision")
    ).write.mode("overwrite").format("xml").options(rowTag="page", rootTag="mediawiki").save(path)
