"""Words that stand out in an article: term frequency over document frequency."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atlaslex.functions.markup import strip_markup
from atlaslex.functions.words import joined_bag, listed, word_counts
from atlaslex.operators.lookup import BROADCAST_BYTES, broadcast_if_small, heavy_keys, lookup_join
from atlaslex.operators.ranking import best_of_bags, leading_of_runs, top_per_group
from atlaslex.staging import stage

# Words of up to this many documents count as rare; words kept per article.
RARE_UP_TO = 10
TOP_WORDS = 50


def plain_pages(pages: DataFrame) -> DataFrame:
    """(page_id, title, text): markup removed."""
    return pages.select("page_id", "title", strip_markup(F.col("wikitext")).alias("text"))


def term_counts(pages: DataFrame, *others: str) -> DataFrame:
    """(page_id, title, word, tf) and other columns of pages ``(page_id, title, text)``, one row per page: no shuffle."""
    return pages.select("page_id", "title", *others, F.inline(word_counts(F.col("text"))))


def page_bags(pages: DataFrame, *others: str) -> DataFrame:
    """(page_id, title, words, tfs) and other columns of pages ``(page_id, title, text)``: the counts of a page stay in its row, its words as a ``joined_bag``.

    ``pages`` must be stored where their text is parsed by a generator: Spark does not take a Python function out of such a plan.
    """
    counted = pages.select("page_id", "title", *others, joined_bag(F.col("text")).alias("bag"))
    return counted.select("page_id", "title", *others, "bag.words", "bag.tfs")


def words_of_bags(bags: DataFrame, *others: str) -> DataFrame:
    """(word) and other columns: a row for every word of a page, as ``doc_freq`` counts them."""
    return bags.select(*others, F.explode(listed(F.col("words"))).alias("word"))


def counts_of_bags(bags: DataFrame) -> DataFrame:
    """(page_id, title, word, tf) of bags, as ``term_counts``."""
    counts = F.arrays_zip(listed(F.col("words")).alias("word"), F.col("tfs").alias("tf"))
    return bags.select("page_id", "title", F.inline(counts).alias("word", "tf"))


def doc_freq(counts: DataFrame, *others: Column) -> DataFrame:
    """(word, df): number of pages with the word, and other aggregates. ``counts`` has each word of a page once."""
    return counts.groupBy("word").agg(F.count(F.lit(1)).alias("df"), *others)


def doc_freq_of_bags(bags: DataFrame, marked: Column) -> DataFrame:
    """(word, df, marked): number of pages with the word, and whether ``marked`` holds on one of them.

    As ``doc_freq`` of ``words_of_bags``: an Arrow batch of stored bags is counted before its words become rows.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pieces = pc.split_pattern(batch["words"], " ")
            coded = pieces.flatten().dictionary_encode()
            code, known = coded.indices.to_numpy(), len(coded.dictionary)
            on = np.repeat(batch["marked"].to_numpy(zero_copy_only=False), pc.list_value_length(pieces).to_numpy())
            df, found = np.bincount(code, minlength=known), np.zeros(known, dtype=bool)
            found[code[on]] = True
            rows = pa.record_batch([coded.dictionary.cast(pa.string()), pa.array(df, pa.int64()), pa.array(found)], ["word", "df", "marked"])
            # A page without words.
            yield rows.filter(pc.not_equal(rows["word"], ""))

    parts = bags.select("words", F.coalesce(marked, F.lit(False)).alias("marked")).mapInArrow(counted, "word string, df bigint, marked boolean")
    return parts.groupBy("word").agg(F.sum("df").alias("df"), F.bool_or("marked").alias("marked"))


def usable_df(df: Column, threshold: int = RARE_UP_TO) -> Column:
    """Document frequency used for the score: -1 for rare and unknown words."""
    return F.when(df > threshold, df).otherwise(F.lit(-1)).cast("long")


def with_doc_freq(
    counts: DataFrame, frequencies: DataFrame, threshold: int = RARE_UP_TO, limit: int = BROADCAST_BYTES
) -> DataFrame:
    """Add ``df`` to every count.

    Only frequent words need to be looked up. If they fit a broadcast, the counts are not shuffled; otherwise the
    frequencies themselves tell which words are too heavy to shuffle (df is the number of rows a word has).
    """
    frequent = frequencies.filter(F.col("df") > threshold)
    joined = lookup_join(
        counts, frequent, "word", "left", hot=lambda: heavy_keys(frequent, "word", "df"), limit=limit
    )
    return joined.withColumn("df", usable_df(F.col("df"), threshold))


def score_words(counts: DataFrame, frequencies: DataFrame, threshold: int = RARE_UP_TO) -> DataFrame:
    """Add ``df`` and ``tf_idf = tf / df``; rare words score below zero."""
    return with_doc_freq(counts, frequencies, threshold).withColumn("tf_idf", F.col("tf") / F.col("df"))


def top_words(scored: DataFrame, n: int = TOP_WORDS) -> DataFrame:
    """The ``n`` best words per page, ties by word.

    Counts lie page by page, as they were written: most words leave before the ranking sorts the rest.
    """
    return top_words_of_rows(scored.where(leading_of_runs("page_id", "tf_idf", n)), n)


def top_words_of_rows(scored: DataFrame, n: int = TOP_WORDS) -> DataFrame:
    """As ``top_words``, for rows that lie anyhow."""
    best = top_per_group(scored, ["page_id"], [F.col("tf_idf").desc(), F.col("word")], n)
    return best.select("page_id", "word", "tf", F.col("title").alias("article"), "df", "tf_idf")


def significant_words(
    counts: DataFrame, frequencies: DataFrame, n: int = TOP_WORDS, threshold: int = RARE_UP_TO
) -> DataFrame:
    """(page_id, word, tf, article, df, tf_idf) of stored term counts and document frequencies."""
    return top_words(score_words(counts, frequencies, threshold), n)


def best_of_pages(
    bags: DataFrame, frequencies: DataFrame, n: int = TOP_WORDS, threshold: int = RARE_UP_TO, limit: int = BROADCAST_BYTES
) -> DataFrame:
    """(page_id, article, best) of stored bags and document frequencies: the ``n`` best words of a page as an array of (word, tf, df, tf_idf).

    The frequent words go to every task while their Arrow columns fit ``limit``, and a page is ranked where it lies: nothing is shuffled.
    Only pages whose id comes several times meet, as they share their ``n`` words. Beyond the limit counts are joined as rows.
    """
    frequent = frequencies.filter(F.col("df") > threshold).select("word", "df")
    # Offset, df and the word itself.
    size = frequent.agg(F.coalesce(F.sum(F.octet_length("word") + 12), F.lit(0))).first()[0]
    if size > limit:
        return _gathered(significant_words(counts_of_bags(bags), frequencies, n, threshold))
    entries = frequent.withColumn("df", F.col("df").cast("long")).toArrow()

    def ranked(some: DataFrame) -> DataFrame:
        return some.select("page_id", F.col("title").alias("article"), best_of_bags("words", "tfs", entries, n).alias("best"))

    several = stage(bags.groupBy("page_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("page_id"), "repeated-ids")
    if several.isEmpty():
        return ranked(bags)
    again = broadcast_if_small(several.withColumnRenamed("page_id", "_id"))
    same = F.col("page_id").eqNullSafe(F.col("_id"))
    parts = ranked(bags.join(again, same, "left_semi")).select("page_id", F.col("article").alias("title"), F.inline("best"))
    return ranked(bags.join(again, same, "left_anti")).unionByName(_gathered(top_words_of_rows(parts, n)))


def _gathered(words: DataFrame) -> DataFrame:
    """(page_id, article, best) of the rows of ``words``, ``n`` of a page at most."""
    return words.groupBy("page_id", "article").agg(F.collect_list(F.struct("word", "tf", "df", "tf_idf")).alias("best"))


def significant_words_of_pages(pages: DataFrame, n: int = TOP_WORDS, threshold: int = RARE_UP_TO) -> DataFrame:
    """The whole stage for pages ``(page_id, title, text)``: the text is read once, its counts are stored."""
    counts = stage(term_counts(pages), "term-counts")
    frequencies = stage(doc_freq(counts), "doc-freq")
    return significant_words(counts, frequencies, n, threshold)


def words_of_pages(best: DataFrame) -> DataFrame:
    """(page_id, word, tf, article, df, tf_idf): a row for each best word."""
    return best.select("page_id", "article", F.inline("best")).select("page_id", "word", "tf", "article", "df", "tf_idf")
