"""Article dumps in MediaWiki XML.

Spark's XML source reads one file in one task, and a dump may be a single file of many gigabytes. The end tag of a page
cannot occur inside a page (markup in the text is escaped), so the files are read as text records that end at it: plain
and bzip2 files are then split over all executors. Only records that may be of interest are parsed as XML.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from atlaslex.functions.links import dump_date, dump_language
from atlaslex.operators.lookup import broadcast_if_small
from atlaslex.staging import stage

PAGE_START, PAGE_END = "<page>", "</page>"
PARSE = {"rowTag": "page", "ignoreSurroundingSpaces": "false", "nullValue": "\u0000"}
PAGE_SCHEMA = "id bigint, title string, revision struct<text: struct<_VALUE: string>>"


# The place of a record: its file, the split's first byte, and a number that grows within the split.
PLACE = ("dump_file", "block", "row")


def read_dump(
    spark: SparkSession, path: str, wanted: Callable[[Column], Column] | None = None
) -> DataFrame:
    """(page_id, title, wikitext, language, dump_date, dump_file, dump_position) of the pages in the dump files under ``path``.

    ``wanted`` is a test on the raw page record, made before the record is parsed. ``dump_position`` grows with the page's
    place in its file. Pages that cannot be parsed are in ``rejected_pages``.
    """
    records = page_records(spark, path)
    parsed = parsed_records(records if wanted is None else records.filter(wanted(F.col("value"))))
    return parsed.filter(F.col("page_id").isNotNull()).drop("record")


def rejected_pages(spark: SparkSession, path: str, wanted: Callable[[Column], Column] | None = None) -> DataFrame:
    """(record, dump_file, dump_position) of the page records that are no XML or have no id."""
    records = page_records(spark, path)
    parsed = parsed_records(records if wanted is None else records.filter(wanted(F.col("value"))))
    return parsed.filter(F.col("page_id").isNull()).select("record", "dump_file", "dump_position")


def page_records(spark: SparkSession, path: str) -> DataFrame:
    """(value, dump_file, block, row) of every page record of the dump files, not parsed."""
    records = spark.read.option("lineSep", PAGE_END).text(path).select(
        "value", F.col("_metadata.file_path").alias("dump_file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    return records.filter(F.contains("value", F.lit(PAGE_START)))


def leading_records(records: DataFrame, n: int) -> DataFrame:
    """The first ``n`` of the page records, in the order of files and of places in them.

    Records are counted by file split, without parsing them. Splits before the mark are taken whole and only the records of the
    one that crosses it are numbered; later splits are dropped as raw text.
    """
    # One row per split: some bytes for each 64 MB of the dump, ordered in one task.
    order = Window.orderBy("dump_file", "block")
    counts = records.groupBy("dump_file", "block").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.withColumn("before", F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)))
    counts = counts.select("dump_file", "block", (F.lit(n) - F.coalesce("before", F.lit(0))).alias("left"), "n").filter("left > 0")
    splits = broadcast_if_small(stage(counts, "splits"))
    marked = records.join(splits, ["dump_file", "block"])
    whole = marked.filter("n <= left")
    crossing = marked.filter("n > left").withColumn("number", F.row_number().over(Window.partitionBy("dump_file", "block").orderBy("row")))
    return whole.select(records.columns).unionByName(crossing.filter("number <= left").select(records.columns))


def parsed_records(records: DataFrame) -> DataFrame:
    """(page_id, title, wikitext, language, dump_date, dump_file, dump_position, record); ``page_id`` is null where parsing failed."""
    raw = F.concat(F.lit(PAGE_START), F.substring_index("value", PAGE_START, -1), F.lit(PAGE_END))
    # One generator row per page: filters further up cannot make Spark parse a page twice.
    parsed = records.select(F.inline(F.array(F.from_xml(raw, PAGE_SCHEMA, PARSE))), *PLACE, raw.alias("record"))
    return parsed.select(
        F.col("id").alias("page_id"),
        "title",
        F.coalesce("revision.text._VALUE", F.lit("")).alias("wikitext"),
        dump_language(F.col("dump_file")).alias("language"),
        dump_date(F.col("dump_file")).alias("dump_date"),
        "dump_file",
        # Splits of a file in order, and rows of a split in order.
        F.struct("block", "row").alias("dump_position"),
        "record",
    )


def page_length(text: Column) -> Column:
    """Length of a page in characters."""
    return F.length(F.coalesce(text, F.lit("")))
