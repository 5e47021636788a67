"""From raw documents to token ids: the stages of a training corpus.

Each stage takes (spark, docs, folder of the tables) and gives the documents that it keeps, with the columns of ``documents``;
the last one gives ids. ``run`` writes every stage's result as a table in the shared folder and reads it back, so a lost
executor never costs more than the stage at hand. What a stage stored on its way is removed when its result is written.

Defined cases, in all stages: a null text is an empty one (the quality rules reject it); texts may have any length; repeated
rows are judged as often as they stand there; of rows without ``doc_id`` one of each group of near copies stays; a null source is one of
its own; other columns, whatever their names, come out of the first four stages as they went in; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from atlaslex.llm import bpe, mixing, quality, simhash, suffix_dedup
from atlaslex.staging import intermediate_tables
from atlaslex.staging import stage as staged


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the newest policy keeps."""
    return quality.keep(docs, "v2")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of SimHash fingerprints that links of at most two differing bits connect."""
    return simhash.keep_one(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages of 100 bytes or more that stand in an earlier place as well."""
    return suffix_dedup.remove(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's rate says."""
    return mixing.mix(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``source``, the ids of the text and how many there are."""
    from pyspark.sql import functions as F

    encoded = bpe.encode(docs.select("doc_id", "source", "text"))
    return encoded.select("doc_id", "source", "ids", F.size("ids").cast("long").alias("n_tokens"))


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", near_duplicates),
    ("suffix_array_dedup", repeated_passages),
    ("mix_sources", mix_sources),
    ("bpe_encoding", token_ids),
]

#: SQL expresses neither components nor BPE in reasonable time; the tests follow the stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        with intermediate_tables(spark):
            docs = staged(stage(spark, docs, sf_dir), name, lasting=True)
    return docs
