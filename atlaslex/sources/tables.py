"""Typed readers for stage tables, dictionaries and the files other tools hand over."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column names of the headerless city file.
CITY_COLUMNS = [
    "nn", "name", "name_ascii", "other_names", "lat", "lon", "a", "b", "c", "d", "e", "f", "g", "h", "i", "j", "k",
    "region", "date",
]
SIGNIFICANT_WORDS = "word string, tf bigint, article string, df bigint, tf_idf double"
CSV_TEXT = {"quote": '"', "escape": '"', "multiLine": "true"}


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table as it lies; the session's file settings decide on its splits."""
    return spark.read.parquet(path)


def read_stage(spark: SparkSession, path: str) -> DataFrame:
    """A stage table as written, all part files together."""
    return spark.read.parquet(path)


def read_word_file(spark: SparkSession, path: str) -> DataFrame:
    """Significant words from CSV with a header: an index column first, dropped again."""
    schema = "idx string, " + SIGNIFICANT_WORDS
    # Words such as "nan" and "null" are words: only an empty, unquoted field is missing.
    return spark.read.schema(schema).options(header="true", **CSV_TEXT).csv(path).drop("idx")


def read_cities(spark: SparkSession, path: str) -> DataFrame:
    """The 19-column city file: tab separated, no header, no quotes."""
    numbers = {"nn": T.LongType(), "lat": T.DoubleType(), "lon": T.DoubleType()}
    schema = T.StructType([T.StructField(c, numbers.get(c, T.StringType())) for c in CITY_COLUMNS])
    return spark.read.schema(schema).options(sep="\t", quote="").csv(path)


def cities_with_feature(cities: DataFrame) -> DataFrame:
    """Cities whose column ``f`` is present."""
    return cities.filter(F.col("f").isNotNull())


def read_word_set(spark: SparkSession, path: str) -> DataFrame:
    """Dictionary words, one per line, as distinct rows ``(word)``."""
    return spark.read.text(path).select(F.col("value").alias("word")).filter("word <> ''").distinct()


def read_symbol_set(spark: SparkSession, path: str) -> DataFrame:
    """Every character of a text file as distinct rows ``(symbol)``; line ends are no symbols."""
    characters = spark.read.text(path).select(F.explode(F.split("value", "")).alias("symbol"))
    return characters.filter("symbol <> ''").distinct()


def read_symbol_pages(spark: SparkSession, path: str) -> DataFrame:
    """(symbol, pages) from JSON objects that map symbols to page lists, one object per line; a long list has several lines."""
    objects = spark.read.text(path).select(F.from_json("value", "map<string,array<bigint>>").alias("m"))
    return objects.select(F.explode("m").alias("symbol", "pages"))
