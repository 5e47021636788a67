"""Mixing sources to target weights, with DataFrame operations only.

Tokens are aggregated per source; a source's repetition rate is its target over its size. Every document is emitted
``floor(rate)`` times and once more if a number drawn from a hash of seed and document is below the rate's fraction. So no
document moves to decide its copies, a rerun takes the same copies, and a source that holds a third of the rows is not
gathered anywhere: its documents meet its one rate.

Targets: sources share ``share`` times all tokens by weight; no target is above ``most`` times its source's size, and the excess is
shared by weight among the others until none is above. That is a water level L with target = min(most * size, L * weight),
found from the sources in the order in which they reach their limit.

Defined cases: a null source is a source of its own and comes last; a null or empty text has size 0 and adds nothing; a source of
size 0 has target 0 and rate 0; a null ``doc_id`` draws by its text. Equal rows draw alike. Texts may have any length. An empty table gives an empty
result. Other columns pass through ``mix`` untouched.

Driver and broadcast: one row per source is aggregated and, as Spark measures it, broadcast or shuffled. Sources are the
names of corpora; they are ranked in one small task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from atlaslex.llm.batches import unused
from atlaslex.staging import stage

SHARE, MOST, SEED = 1.5, 2.0, 7

#: Weights of the sources in their order, repeating.
WEIGHTS = (3, 1, 2)

WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: str | Column = "text") -> Column:
    """Words of a text, as a long; 0 for null."""
    # A word and what follows it become one character: counting needs no array of the words.
    start = F.regexp_replace(text, r"^[\x20\x09-\x0D]+", "")
    return F.coalesce(F.length(F.regexp_replace(start, r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*", "w")), F.lit(0)).cast("long")


def ordered_weights(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Adds ``weight``: the weights repeat over the sources by code point, null last."""
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    listed = F.array(*(F.lit(float(w)) for w in weights))
    return sizes.withColumn("weight", F.get(listed, place % len(weights)))


def targets(sizes: DataFrame, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``source``, ``source_size``, ``target`` and ``rate`` from one row per source with ``source_size`` and ``weight``."""
    limit = F.col("source_size") * most
    order = (F.col("source_size") / F.col("weight")).asc(), F.col("source").asc_nulls_last()
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    after = Window.orderBy(*order).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    left = F.sum("source_size").over(whole) * share - F.coalesce(F.sum(limit).over(before), F.lit(0.0))
    # If all sources before this one are full, the rest is shared at this level; past the right place it only falls.
    levels = sizes.withColumn("level", left / F.sum("weight").over(after))
    reached = F.col("level") * F.col("weight") <= limit
    level = F.max(F.when(reached, F.col("level"))).over(whole)
    target = F.round(F.least(limit, F.coalesce(level * F.col("weight"), limit)), 6)
    return levels.select(
        "source", "source_size", target.alias("target"),
        F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(0.0).alias("rate"),
    )


def draw(seed: int = SEED) -> Column:
    """A number in [0, 1) that depends on seed and document only."""
    name = F.coalesce(F.col("doc_id").cast("string"), F.md5(F.coalesce(F.col("text").cast("binary"), F.lit(b""))))
    digest = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), name).cast("binary")), 1, 8)
    return F.conv(digest, 16, 10).cast("double") / float(2**32)


def copies(rate: str = "rate", drawn: str = "draw") -> Column:
    """``floor(rate)`` and one more where the draw is below the fraction."""
    floor = F.floor(rate)
    return (floor + F.when(F.col(drawn) < F.col(rate) - floor, 1).otherwise(0)).cast("int")


def plan(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = SEED) -> DataFrame:
    """``doc_id``, ``source``, ``size``, ``source_size``, ``target``, ``rate``, ``copies`` and ``taken`` of every document.

    Words are counted once: three narrow columns are staged, which both the sums and the copies are read from.
    """
    sized = stage(docs.select("doc_id", "source", n_words().alias("size"), draw(seed).alias("draw")), "sizes")
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    rates = targets(ordered_weights(sizes, weights), share, most).withColumnRenamed("source", "of")
    joined = sized.join(rates, F.col("source").eqNullSafe(F.col("of")), "left").drop("of")
    counted = joined.withColumn("copies", copies())
    return counted.select(
        "doc_id", "source", "size", "source_size", "target", "rate", "copies", (F.col("size") * F.col("copies")).alias("taken")
    )


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = SEED) -> DataFrame:
    """The mixed corpus: every document as often as its copies say, with the columns it had. No text is shuffled."""
    sizes = docs.groupBy("source").agg(F.sum(n_words()).alias("source_size"))
    rates = targets(ordered_weights(sizes, weights), share, most)
    of, drawn, copy = unused(docs, "of", "drawn", "copy")
    rates = stage(rates.select(F.struct("source", "rate").alias(of)), "rates")
    joined = docs.join(rates, docs["source"].eqNullSafe(rates[f"{of}.source"]), "left").withColumn(drawn, draw(seed))
    return joined.withColumn(copy, F.explode(F.array_repeat(F.lit(1), copies(f"{of}.rate", drawn)))).drop(of, drawn, copy)
