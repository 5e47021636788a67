"""Clusters of words at four zoom levels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atlaslex.functions.geo import continent, in_world
from atlaslex.operators.kmeans import fit_kmeans, minibatch_step, nearest_center, spread_seeds, weighted_points
from atlaslex.operators.lookup import lookup_join
from atlaslex.operators.sampling import sample_rows
from atlaslex.staging import stage

# Clusters per zoom level beside the continents.
CLUSTER_COUNTS = (193, 4000, 25_000)
# How often a mini-batch fit draws, and how many rows.
DRAWS, DRAWN_ROWS = 3, 100_000


def mappable_words(words: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Words within the world's bounds that the dictionary knows (exact, case-sensitive)."""
    return lookup_join(words.filter(in_world(F.col("lat"), F.col("lon"))), dictionary, "word", "left_semi")


def mappable_by_frequency(words: DataFrame, frequencies: DataFrame, threshold: int) -> DataFrame:
    """As ``mappable_words``, for words with ``df`` and a stored dictionary ``(word, df)``.

    Frequent words, which most rows have, are looked up among the frequent ones only: these are few enough for a broadcast long after the
    dictionary is not. Rare ones (``df`` below zero) are looked up among the rare.
    """
    parts = (words.filter("df > 0"), frequencies.filter(F.col("df") > threshold)), (words.filter("df < 0"), frequencies.filter(F.col("df") <= threshold))
    frequent, rare = (mappable_words(rows, known.select("word")) for rows, known in parts)
    return frequent.unionByName(rare)


def kept_share(words: DataFrame, dictionary: DataFrame) -> DataFrame:
    """One row: rows, rows the dictionary knows, and their percentage."""
    marked = lookup_join(words, dictionary.select("word", F.lit(True).alias("known")), "word", "left")
    return marked.agg(F.count(F.lit(1)).alias("words"), F.count("known").alias("kept")).withColumn(
        "percent", F.lit(100.0) * F.round(F.try_divide("kept", "words"), 4)
    )


def fitted_centers(words: DataFrame, points: DataFrame, k: int, seed: int = 0, batches: bool = False) -> DataFrame:
    """Centers ``(cluster, lat, lon)`` for words with the stored weighted places ``points``, by Lloyd's rounds or by mini-batches."""
    return minibatch_fit(words, k, seed=seed) if batches else fit_kmeans(points, k, seed)


def cluster_words(
    words: DataFrame, counts: tuple[int, ...] = CLUSTER_COUNTS, fit_rows: int | None = None, seed: int = 0, batches: bool = False
) -> DataFrame:
    """Add ``cluster_7`` and ``cluster_<k>`` for each k to a stored table of mappable words.

    Each k is fitted on all places, equal ones merged to one weighted point, or on a draw of ``fit_rows`` rows if that is
    given, or on three draws by mini-batches. The words of an article share one place: clusters are assigned to the places,
    one row per page, and joined to the words by page. There is no join on coordinates, which a third of the pages may
    share. No words give no rows.
    """
    sample = words if fit_rows is None else sample_rows(words, fit_rows, ["page_id", "word"], seed)
    points = stage(weighted_points(sample), "fit-points")
    pages = words.select("page_id", "lat", "lon").distinct()
    pages = pages.withColumn("cluster_7", continent(F.col("lat"), F.col("lon")))
    for k in counts:
        pages = nearest_center(pages, fitted_centers(sample, points, k, seed, batches), f"cluster_{k}")
    names = ["cluster_7", *[f"cluster_{k}" for k in counts]]
    return words.join(stage(pages, "page-clusters"), ["page_id", "lat", "lon"]).select(*words.columns, *names)


def minibatch_clusters(words: DataFrame, start: DataFrame, draws: int = DRAWS, rows: int | None = None, seed: int = 0) -> DataFrame:
    """Center table ``(cluster, lat, lon, n)`` after ``draws`` mini-batch updates from the centers ``start``.

    Every draw is all rows, or ``rows`` of them drawn with another seed each time.
    """
    centers = start
    for number in range(draws):
        batch = words if rows is None else sample_rows(words, rows, ["page_id", "word"], seed + number)
        centers = stage(minibatch_step(batch, centers), "centers")
    return centers


def minibatch_fit(words: DataFrame, k: int, draws: int = DRAWS, rows: int = DRAWN_ROWS, seed: int = 0) -> DataFrame:
    """Center table ``(cluster, lat, lon, n)`` of a mini-batch fit that finds its own start.

    ``draws`` times ``rows`` rows are drawn, each time with another seed; the first draw gives the starting centers too, by
    k-means||. Without words there are no centers.
    """
    first = sample_rows(words, rows, ["page_id", "word"], seed)
    seeds = spread_seeds(stage(weighted_points(first), "seed-points"), k, seed)
    return minibatch_clusters(words, seeds, draws, rows, seed)
