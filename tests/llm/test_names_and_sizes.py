"""Tables with clashing names and very long texts, through every operator that returns or reads whole tables."""

import time

import corpus_pipeline
import pytest
from atlaslex.llm import batches, bpe, licenses, mixing, multiset_hash, quality, simhash, suffix_dedup, url_filter
from pyspark.sql import functions as F

NAMES = ["measures", "_measures", "of", "_of", "drawn", "copy", "_copy", "judged", "fp", "value", "Copy_", "Fp_x"]


def test_unused_names(spark):
    table = spark.range(1).selectExpr("id", "id as `A`", "id as `_b`")
    assert batches.unused(table, "a", "b", "a", "ID") == ["_a", "b", "__a", "_ID"]


@pytest.mark.parametrize("keep", [quality.keep, mixing.mix, simhash.keep_one, suffix_dedup.remove])
def test_other_columns_come_back(spark, keep):
    text = "Some words of a document that the rules keep, as there are enough of them and none comes twice. " + " ".join(f"word{i}" for i in range(60))
    docs = spark.createDataFrame([(i, f"{text} {i * 7919 % 97} end{i}", "en", "s") for i in range(6)], "doc_id long, text string, lang string, source string")
    docs = docs.withColumns({name: F.concat(F.lit(f"{name} of "), "doc_id") for name in NAMES})
    rows = keep(docs)
    assert rows.columns == docs.columns
    found = rows.collect()
    assert found and all(r[name] == f"{name} of {r.doc_id}" for r in found for name in NAMES)


def test_other_columns_of_pages(spark):
    pages = spark.createDataFrame([(1, "http://a.net/x", "own"), (2, "http://a.com/de/x", "own")], "page_id long, url string, judged string")
    kept = url_filter.keep(pages.withColumn("_judged", F.lit("mine")))
    assert [tuple(r) for r in kept.collect()] == [(1, "http://a.net/x", "own", "mine")]


@pytest.fixture(scope="module")
def long_texts(spark):
    """A million bytes without a space, of one letter and of many, and as many of spaces."""
    rows = spark.range(5).select(
        F.col("id").alias("doc_id"), F.lit("s").alias("source"), F.lit("en").alias("lang"), F.lit(0).cast("long").alias("n_chars"),
        F.expr("case id when 0 then repeat('a', 1000000) when 1 then repeat(' ', 1000000) when 2 then repeat('é!', 300000)"
               " when 3 then array_join(transform(sequence(1, 300000), i -> char(97 + int(pmod(hash(i), 26)))), '') else 'short' end").alias("text"),
    )
    return rows.repartition(3)


@pytest.mark.parametrize("operator", [
    quality.ledger, mixing.plan, simhash.components, bpe.digests, licenses.find_notices, multiset_hash.edited, suffix_dedup.digests,
])
def test_very_long_texts(spark, long_texts, operator):
    start = time.monotonic()
    rows = operator(long_texts).collect()
    assert {r.doc_id for r in rows} == set(range(5)) and time.monotonic() - start < 120


def test_pipeline_stages_on_messy_rows(spark, messy, nothing):
    for table in (messy, nothing):
        docs = table
        for name, stage in corpus_pipeline.STAGES:
            rows = stage(spark, docs, "")
            if name != "bpe_encoding":
                assert rows.columns == table.columns
            assert rows.count() <= 2 * docs.count()
