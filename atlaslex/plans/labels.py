"""One label and one center per cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from atlaslex.functions.words import capitalized
from atlaslex.operators.ranking import leading_by_bound, top_per_group
from atlaslex.operators.sampling import score
from atlaslex.operators.unique_labels import unique_labels
from atlaslex.staging import stage

# Zoom levels in the order in which they choose labels; candidates looked at per cluster.
ZOOMS = ("7", "193", "4000", "25000")
CANDIDATES = 6
# Fixed value: words of a cluster whose mean is its center, where centers are sampled.
SAMPLE = 1000
# Sums of doubles depend on their order: rounded scores keep the ranks the same on every run.
SCORE_DIGITS = 9


def by_zoom(clustered: DataFrame, zooms: tuple[str, ...] = ZOOMS) -> DataFrame:
    """One row per word, place and zoom level: (zoom, cluster, word, tf_idf, lat, lon)."""
    pairs = F.array(
        *[F.struct(F.lit(z).alias("zoom"), F.col(f"cluster_{z}").cast("int").alias("cluster")) for z in zooms]
    )
    return clustered.select(
        F.inline(pairs), "word", F.col("tf_idf").cast("double").alias("tf_idf"), "lat", "lon"
    ).filter(F.col("cluster").isNotNull())


def word_stats(zoomed: DataFrame) -> DataFrame:
    """Sums per (zoom, cluster, word). Coordinates are summed along, so the centers need no second pass over the words."""
    return zoomed.groupBy("zoom", "cluster", "word").agg(
        F.sum("tf_idf").alias("tf_idf"),
        F.count(F.lit(1)).alias("ones"),
        F.sum("lat").alias("sum_lat"),
        F.sum("lon").alias("sum_lon"),
    )


def ranked_words(stats: DataFrame, n: int = CANDIDATES) -> DataFrame:
    """The ``n`` best words per cluster by ``tf_idf * ln(ones)``; rows without a word are no candidates."""
    return _first_words(_scored(stats), n)


def _scored(stats: DataFrame) -> DataFrame:
    return stats.filter(F.col("word").isNotNull()).withColumn("score", F.round(F.col("tf_idf") * F.log("ones"), SCORE_DIGITS))


def _first_words(scored: DataFrame, n: int) -> DataFrame:
    return top_per_group(scored, ["zoom", "cluster"], [F.col("score").desc(), F.col("word")], n)


def word_scores(clustered: DataFrame, zooms: tuple[str, ...] = ZOOMS) -> DataFrame:
    """(zoom, cluster, word, score) of clustered words, as ``ranked_words`` scores them, without coordinates: these need a row per cluster only."""
    return _scored(word_stats(by_zoom(clustered, zooms))).select("zoom", "cluster", "word", "score")


def best_scored(scores: DataFrame, n: int = CANDIDATES) -> DataFrame:
    """As ``ranked_words``, for stored ``word_scores``: most words of a cluster leave unsorted."""
    return _first_words(leading_by_bound(scores, ["zoom", "cluster"], "score", "word", n), n)


def centers(stats: DataFrame) -> DataFrame:
    """(zoom, cluster, lat, lon): mean position of all rows of a cluster."""
    rows = F.sum("ones")
    return stats.groupBy("zoom", "cluster").agg(
        (F.sum("sum_lat") / rows).alias("lat"), (F.sum("sum_lon") / rows).alias("lon")
    )


def cluster_means(zoomed: DataFrame) -> DataFrame:
    """As ``centers``, where no sums of words are wanted: every task sends a row per cluster on."""
    return zoomed.groupBy("zoom", "cluster").agg(F.avg("lat").alias("lat"), F.avg("lon").alias("lon"))


def cell_means(clustered: DataFrame, zooms: tuple[str, ...] = ZOOMS) -> DataFrame:
    """As ``centers``, of clustered words: rows are added up by all their clusters first, so that few are listed by zoom level."""
    names = [f"cluster_{z}" for z in zooms]
    cells = clustered.groupBy(*names).agg(F.sum("lat").alias("sum_lat"), F.sum("lon").alias("sum_lon"), F.count(F.lit(1)).alias("ones"))
    pairs = F.array(*[F.struct(F.lit(z).alias("zoom"), F.col(n).cast("int").alias("cluster")) for z, n in zip(zooms, names, strict=True)])
    return centers(cells.select(F.inline(pairs), "sum_lat", "sum_lon", "ones").filter(F.col("cluster").isNotNull()))


def cluster_samples(clustered: DataFrame, n: int = SAMPLE, seed: int = 0, zooms: tuple[str, ...] = ZOOMS) -> DataFrame:
    """(zoom, cluster, page_id, word, lat, lon): up to ``n`` words of every cluster, those with the smallest hash of page, word and seed.

    A cluster of up to ``n`` words comes whole. Every task sends at most ``n`` words of a cluster on.
    """
    pairs = F.array(*[F.struct(F.lit(z).alias("zoom"), F.col(f"cluster_{z}").cast("int").alias("cluster")) for z in zooms])
    drawn = clustered.withColumn("score", score(["page_id", "word"], seed))
    rows = drawn.select(F.inline(pairs), "page_id", "word", "lat", "lon", "score").filter(F.col("cluster").isNotNull())
    return top_per_group(rows, ["zoom", "cluster"], [F.col("score"), F.col("page_id"), F.col("word")], n).drop("score", "rank")


def sampled_centers(samples: DataFrame) -> DataFrame:
    """(zoom, cluster, lat, lon): mean position of the sample of each cluster."""
    return samples.groupBy("zoom", "cluster").agg(F.avg("lat").alias("lat"), F.avg("lon").alias("lon"))


def priority(zooms: tuple[str, ...] = ZOOMS):
    """A number that orders clusters by zoom level, then cluster."""
    level = F.array_position(F.array(*[F.lit(z) for z in zooms]), F.col("zoom"))
    return level * F.lit(1 << 40).cast(T.LongType()) + F.col("cluster")


def chosen_labels(ranked: DataFrame, zooms: tuple[str, ...] = ZOOMS) -> DataFrame:
    """(zoom, cluster, word): unique where the candidates allow it."""
    candidates = ranked.select(
        priority(zooms).alias("prio"), "zoom", "cluster", (F.col("rank") - 1).alias("choice"), "word"
    )
    chosen = unique_labels(candidates.select("prio", "choice", "word"))
    names = candidates.filter("choice = 0").select("prio", "zoom", "cluster")
    return names.join(chosen, "prio").select("zoom", "cluster", "word")


def label_table(labels: DataFrame, middle: DataFrame) -> DataFrame:
    """(zoom, cluster, label, lat, lon) with capitalized labels."""
    return labels.join(middle, ["zoom", "cluster"]).select(
        "zoom", "cluster", capitalized(F.col("word")).alias("label"), "lat", "lon"
    )


def label_clusters(clustered: DataFrame, zooms: tuple[str, ...] = ZOOMS, sample: int | None = None) -> DataFrame:
    """The map labels of clustered words, at the mean of all words of a cluster or of a ``sample`` of them."""
    ranked = stage(best_scored(stage(word_scores(clustered, zooms), "word-scores")), "label-candidates")
    middle = cell_means(clustered, zooms) if sample is None else sampled_centers(cluster_samples(clustered, sample, zooms=zooms))
    return label_table(chosen_labels(ranked, zooms), middle)
