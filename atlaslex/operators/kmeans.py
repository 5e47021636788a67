"""Clusters of points on the (lat, lon) plane.

Centers are a table ``(cluster, lat, lon)`` or ``(cluster, lat, lon, n)`` with as many rows as clusters were asked for; points are a stored
table ``(lat, lon, weight)`` of different places. Nearest centers are found through ``cells``.

* ``fit_kmeans``: Lloyd's rounds. In the first ones, where most points change, all points look for their center and nothing is stored
  but the centers. The others have distance bounds. A point keeps an upper bound of the distance to its own center and a lower
  bound of that to any other; both are shifted by how far centers moved, and only points whose bounds meet look at a
  list of candidates again. Every such round is a stage table, so a lost executor costs a round at most.
* ``spread_seeds``: k-means||, which draws far points with a higher chance, some times in parallel.
* ``minibatch_step``: one update of mini-batch k-means.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from atlaslex.functions.geo import squared_degrees
from atlaslex.operators.cells import PLACED, Centers, candidate_lists, gaps, nearest
from atlaslex.operators.sampling import sample_rows, score
from atlaslex.staging import stage

# Bounds that are nearer to each other than this, in degrees, count as meeting: rounding never decides.
MARGIN = 1e-9
# Rounds in which all points look for their center: cheaper than to store bounds while most of them meet.
PLAIN_ROUNDS = 3
# Rounds of k-means||, and candidates that one of them draws for each center asked for.
SEED_ROUNDS, DRAWN = 4, 0.5
# Lloyd's rounds over the drawn candidates, which are few.
SEED_ITERATIONS = 5
# A place as two whole numbers, which all engines write alike.
PLACE = ("cast(round(lat * 1000000) as bigint)", "cast(round(lon * 1000000) as bigint)")


def weighted_points(rows: DataFrame) -> DataFrame:
    """(lat, lon, weight): equal points merged, so that a fit sees every place once."""
    return rows.groupBy("lat", "lon").agg(F.count(F.lit(1)).cast("double").alias("weight"))


def _table(spark: SparkSession, centers: Centers, **others: np.ndarray) -> DataFrame:
    columns = {"cluster": pa.array(centers.cluster, pa.int32()), "lat": centers.lat, "lon": centers.lon, **others}
    return spark.createDataFrame(pa.table(columns), "cluster int, lat double, lon double" + "".join(f", {n} double" for n in others))


def _numbered(rows: DataFrame) -> Centers:
    """Centers from rows in order."""
    found = rows.select("lat", "lon").toArrow()
    return Centers(np.arange(found.num_rows), found["lat"].to_numpy(), found["lon"].to_numpy())


def drawn_starts(points: DataFrame, k: int, seed: int = 0) -> Centers:
    """Up to ``k`` different places drawn by a hash of place and seed, numbered in the order of their draw."""
    keyed = points.where(PLACED).selectExpr("lat", "lon", f"{PLACE[0]} as y", f"{PLACE[1]} as x")
    drawn = sample_rows(keyed, k, ["y", "x"], seed)
    return _numbered(drawn.orderBy(score(["y", "x"], seed), "lat", "lon"))


def nearest_center(df: DataFrame, centers: DataFrame, name: str = "cluster") -> DataFrame:
    """Add the nearest center of a table (ties: lowest number); null for rows without a place, and where there are no centers.

    Rows are neither multiplied nor shuffled while the candidate lists fit a broadcast.
    """
    kind = centers.schema["cluster"].dataType
    found = Centers.of(centers)
    if not len(found):
        return df.withColumn(name, F.lit(None).cast(kind))
    return nearest(df, found, candidate_lists(found)).withColumn(name, F.col("_best")[0]["cluster"].cast(kind)).drop("_best")


def _bounds(df: DataFrame, centers: Centers, lists) -> DataFrame:
    """(lat, lon, weight, cluster, upper, lower) by looking at the candidates."""
    found = nearest(df, centers, lists, 2)
    best = F.col("_best")
    lower = F.coalesce(F.sqrt(F.get(best, F.lit(1))["d"]), F.lit(float("inf")))
    return found.select("lat", "lon", "weight", best[0]["cluster"].cast("int").alias("cluster"), F.sqrt(best[0]["d"]).alias("upper"), lower.alias("lower"))


def _means(state: DataFrame, centers: Centers) -> Centers:
    """Every center at the mean of its points; one without points stays."""
    weighted = [F.sum(F.col("weight") * F.col(axis)).alias(axis) for axis in ("lat", "lon")]
    sums = state.groupBy("cluster").agg(*weighted, F.sum("weight").alias("weight")).toArrow()
    of, weight = sums["cluster"].to_numpy(), sums["weight"].to_numpy()
    moved = Centers(centers.cluster, centers.lat.copy(), centers.lon.copy())
    moved.lat[of], moved.lon[of] = sums["lat"].to_numpy() / weight, sums["lon"].to_numpy() / weight
    return moved


def _shifted(state: DataFrame, before: Centers, centers: Centers) -> DataFrame:
    """The state after centers moved: bounds shifted, and those points looked at again whose bounds meet."""
    lists = candidate_lists(centers, 2)
    drift = np.hypot(centers.lat - before.lat, centers.lon - before.lon)
    moves = _table(state.sparkSession, centers, drift=drift, half=gaps(centers, lists) / 2)
    moves = moves.withColumnsRenamed({"lat": "to_lat", "lon": "to_lon"})
    judged = state.join(F.broadcast(moves), "cluster")
    lower = F.col("lower") - float(drift.max())
    bound = F.greatest(lower, F.col("half"))
    upper = F.col("upper") + F.col("drift")
    own = F.sqrt(squared_degrees(F.col("lat"), F.col("lon"), F.col("to_lat"), F.col("to_lon")))
    tight = F.when(upper + MARGIN >= bound, own).otherwise(upper)
    judged = judged.select("lat", "lon", "weight", "cluster", tight.alias("upper"), lower.alias("lower"), (tight + MARGIN >= bound).alias("meet"))
    stay = judged.where("not meet").drop("meet")
    return stay.unionByName(_bounds(judged.where("meet").select("lat", "lon", "weight"), centers, lists))


def lloyd(points: DataFrame, starts: Centers, iterations: int = 10, assigned: bool = True) -> tuple[Centers, DataFrame | None]:
    """Centers after ``iterations`` rounds from ``starts``, and, if ``assigned``, the stored points with their ``cluster`` among these.

    The result is that of the plain method, which compares every point with every center in every round. Points without a
    place are left out. Ends early when no center moves.
    """
    placed, state, centers = points.where(PLACED), None, starts
    for number in range(iterations):
        before = centers
        if number < PLAIN_ROUNDS:
            near = nearest(placed, before, candidate_lists(before))
            centers = _means(near.select("lat", "lon", "weight", F.col("_best")[0]["cluster"].alias("cluster")), before)
        else:
            if state is None:
                state = stage(_bounds(placed, before, candidate_lists(before, 2)), "bounds")
            centers = _means(state, before)
        if np.array_equal(before.lat, centers.lat) and np.array_equal(before.lon, centers.lon):
            break
        if state is not None and (assigned or number < iterations - 1):
            state = stage(_shifted(state, before, centers), "bounds")
    if assigned and state is None:
        state = stage(_bounds(placed, centers, candidate_lists(centers, 2)), "bounds")
    return centers, state if assigned else None


def fit_kmeans(points: DataFrame, k: int, seed: int = 0, iterations: int = 10) -> DataFrame:
    """Centers ``(cluster, lat, lon)`` of k-means on weighted points, from starts drawn by hash.

    Fewer than ``k`` centers come back when there are fewer different points; no points give no centers.
    """
    starts = drawn_starts(points, k, seed)
    centers = lloyd(points, starts, iterations, assigned=False)[0] if len(starts) else starts
    return _table(points.sparkSession, centers)


def cost(points: DataFrame, centers: DataFrame) -> float:
    """Weighted sum of squared distances to the nearest centers."""
    found = Centers.of(centers)
    rows = nearest(points, found, candidate_lists(found))
    return rows.agg(F.sum(F.col("weight") * F.col("_best")[0]["d"])).first()[0] or 0.0


def drawn_candidates(points: DataFrame, k: int, seed: int = 0, rounds: int = SEED_ROUNDS, drawn: float = DRAWN) -> Centers:
    """Candidates of k-means||: one drawn place, then ``rounds`` times about ``drawn * k`` places.

    A place is drawn if a number from a hash of place, seed and round is below ``drawn * k`` times its share of the cost. Costs are
    kept in a stage table and compared with the candidates of the last round only. About ``rounds * drawn * k`` candidates
    come to the driver.
    """
    candidates = latest = drawn_starts(points, 1, seed)
    if not len(candidates):
        return candidates
    away = points.where(PLACED).withColumn("d", F.lit(float("inf")))
    for number in range(rounds):
        found = nearest(away, latest, candidate_lists(latest))
        away = stage(found.withColumn("d", F.least("d", F.col("_best")[0]["d"])).drop("_best"), "distances")
        total = away.agg(F.sum(F.col("weight") * F.col("d"))).first()[0]
        if not total:
            break
        chance = F.col("weight") * F.col("d") * (drawn * k) / total
        places = [F.expr(p) for p in PLACE]
        chosen = away.where(score(places, seed + 1 + number) < chance).select("lat", "lon").orderBy("lat", "lon")
        latest = _numbered(chosen)
        if not len(latest):
            break
        latest.cluster = latest.cluster + len(candidates)
        candidates = candidates.joined(latest)
    if len(candidates) >= k:
        return candidates
    # So few places are far that chance left too few: the first drawn ones fill up.
    more, known = drawn_starts(points, 2 * k, seed), set(zip(candidates.lat, candidates.lon, strict=True))
    new = np.array([place not in known for place in zip(more.lat, more.lon, strict=True)], dtype=bool)
    new &= np.cumsum(new) <= k - len(candidates)
    return candidates.joined(Centers(len(candidates) + np.arange(new.sum()), more.lat[new], more.lon[new]))


def _spread(lat: np.ndarray, lon: np.ndarray, weight: np.ndarray, k: int) -> np.ndarray:
    """Numbers of up to ``k`` candidates: the heaviest one, then always the one with the largest weight times squared distance to the others chosen."""
    chosen = [int(weight.argmax())] if len(weight) else []
    away = np.full(len(weight), np.inf)
    while len(chosen) < min(k, len(weight)):
        last = chosen[-1]
        away = np.minimum(away, (lat - lat[last]) * (lat - lat[last]) + (lon - lon[last]) * (lon - lon[last]))
        mass = weight * away
        if not mass.max() > 0:
            break
        chosen.append(int(mass.argmax()))
    return np.array(chosen, dtype=np.int64)


def spread_seeds(points: DataFrame, k: int, seed: int = 0) -> DataFrame:
    """``k`` starting centers ``(cluster, lat, lon, n)`` with ``n`` 0: k-means|| and Lloyd's rounds over its weighted candidates.

    Each candidate weighs as much as the points it is nearest to. The rounds start from candidates that are heavy and far apart (ties: by
    place), so that small groups far from all others get a center. Fewer come back only where there are fewer different points.
    """
    candidates = drawn_candidates(points, k, seed)
    spark = points.sparkSession
    if len(candidates):
        found = nearest(points, candidates, candidate_lists(candidates)).groupBy(F.col("_best")[0]["cluster"].alias("cluster")).agg(F.sum("weight").alias("weight"))
        weighted = stage(_table(spark, candidates).join(found, "cluster").select("lat", "lon", "weight"), "candidates")
        # Some candidates for each center asked for: the driver and one task hold them.
        rows = weighted.orderBy("lat", "lon").toArrow()
        lat, lon, weight = (rows[c].to_numpy() for c in ("lat", "lon", "weight"))
        of = _spread(lat, lon, weight, k)
        candidates = lloyd(weighted, Centers(np.arange(len(of)), lat[of], lon[of]), SEED_ITERATIONS, assigned=False)[0]
    return _table(spark, candidates).withColumn("n", F.lit(0).cast("long"))


def minibatch_step(points: DataFrame, centers: DataFrame) -> DataFrame:
    """One mini-batch update: every center moves to the mean of all points it has seen so far.

    ``points`` has (lat, lon); ``centers`` has (cluster, lat, lon, n) with n the points seen before this batch.
    """
    assigned = nearest_center(points.select("lat", "lon"), centers, "cluster")
    batch = assigned.groupBy("cluster").agg(
        F.sum("lat").alias("sum_lat"), F.sum("lon").alias("sum_lon"), F.count(F.lit(1)).alias("m")
    )
    moved = centers.join(F.broadcast(batch), "cluster", "left")
    seen = F.col("n") + F.col("m")

    def move(axis: str) -> Column:
        return F.when(F.col("m").isNull(), F.col(axis)).otherwise(
            F.col(axis) + (F.col(f"sum_{axis}") - F.col("m") * F.col(axis)) / seen
        )

    return moved.select(
        "cluster", move("lat").alias("lat"), move("lon").alias("lon"), F.coalesce(seen, F.col("n")).alias("n")
    )
