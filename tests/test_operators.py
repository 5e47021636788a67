"""Building blocks on small tables, compared with brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from atlaslex.operators import cells, kmeans, lookup, page_lists, page_sets, ranking, sampling, unique_labels, upsert
from atlaslex.plans import clusters
from atlaslex.plans.geo_index import load_statistics
from atlaslex.staging import stage


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_lookup_join_split_equals_plain(spark, how):
    # One key holds a third of the rows; some keys are unknown, some are NULL.
    keys = ["hot"] * 1000 + [f"k{i % 700}" for i in range(2000)] + [None] * 5
    rows = spark.createDataFrame(list(enumerate(keys)), "i int, key string")
    entries = spark.createDataFrame([("hot", 1)] + [(f"k{i}", i) for i in range(0, 900, 2)], "key string, v int")
    plain = rows.join(entries, "key", how)
    split = lookup.lookup_join(rows, entries, "key", how, hot=lambda: lookup.hot_keys(rows, "key", 10), limit=0)
    assert sorted(map(str, split.collect())) == sorted(map(str, plain.collect()))
    default = lookup.lookup_join(rows, entries, "key", how, limit=0)
    assert sorted(map(str, default.collect())) == sorted(map(str, plain.collect()))
    hot = spark.createDataFrame([("hot",)], "key string").select(F.xxhash64("key")).first()[0]
    assert [r["_hash"] for r in lookup.hot_keys(rows, "key", 10).collect()] == [hot]


def test_long_keys_can_be_hot(spark):
    long = "x" * 2000
    rows = spark.createDataFrame([(i, long if i % 2 else f"k{i}") for i in range(2000)], "i int, key string")
    assert lookup.hot_keys(rows, "key", 10).count() == 1
    entries = spark.createDataFrame([(long, 1), ("k2", 2)], "key string, v int")
    assert lookup.lookup_join(rows, entries, "key", hot=lambda: lookup.hot_keys(rows, "key", 10), limit=0).count() == 1001


def test_broadcast_is_measured(spark):
    df = spark.range(1000).select(F.repeat(F.lit("x"), 100).alias("t"))
    assert lookup.estimated_bytes(df) >= 100_000
    assert lookup.broadcast_if_small(df, 1000) is df
    lists = spark.range(10).select(F.array_repeat(F.lit("word"), 10_000).alias("a"), F.struct(F.repeat(F.lit("y"), 500).alias("s")).alias("b"))
    assert lookup.estimated_bytes(lists) >= 10 * (10_000 * 4 + 500)


def test_number_rows(spark):
    ids = random.Random(3).sample(range(10**6), 500)
    df = spark.createDataFrame([(i,) for i in ids], "id long").repartition(7)
    numbered = {r.id: r.n for r in ranking.number_rows(df, "id", "n").collect()}
    assert numbered == {v: n for n, v in enumerate(sorted(ids))}
    got = sampling.contiguous_slice(df, 100, 25, "id")
    assert sorted(r.id for r in got.collect()) == sorted(ids)[100:125]
    assert sampling.random_slice(df, 10, "id", seed=5).count() == 10


def test_top_of_many_rows(spark):
    df = spark.range(20_000).selectExpr("id % 2 as g", "id", "(id * 7919) % 20011 as v")
    for n in (3, 1500):
        got = {(r.g, r.id, r.rank) for r in ranking.top_per_group(df, ["g"], [F.col("v").desc(), F.col("id")], n).collect()}
        expected = set()
        for g in (0, 1):
            best = sorted(((i * 7919) % 20011, -i) for i in range(g, 20_000, 2))[::-1][:n]
            expected |= {(g, -i, k + 1) for k, (_, i) in enumerate(best)}
        assert got == expected


def test_sample_rows(spark):
    df = spark.range(10_000)
    one = sampling.sample_rows(df, 300, ["id"], seed=1)
    ids = {r.id for r in one.collect()}
    assert len(ids) == 300
    assert ids == {r.id for r in sampling.sample_rows(df.repartition(3), 300, ["id"], seed=1).collect()}
    assert ids != {r.id for r in sampling.sample_rows(df, 300, ["id"], seed=2).collect()}
    assert sampling.sample_rows(df, 20_000, ["id"]).count() == 10_000
    # A fair draw: both halves of the ids are hit about equally.
    assert 100 < sum(i < 5000 for i in ids) < 200


def test_prefix_share(spark):
    df = spark.range(0, 1000, 3).withColumnRenamed("id", "page_id")
    assert sorted(r.page_id for r in sampling.prefix_share(df, 0.01, estimate=1000).collect()) == list(range(0, 33, 3))
    assert sampling.prefix_share(df, 1.0).count() == df.count()


def test_page_lists(spark):
    pairs = spark.createDataFrame([("a", i) for i in (5, 1, 12, 11, 30)] + [("b", 10)], "s string, page_id long")
    lists = page_lists.page_lists(pairs, "s", size=10)
    assert sorted(tuple(r) for r in lists.select("s", "part", "pagecount", "first_page", "pages_from", "pages").collect()) == [
        ("a", 0, 5, 1, 0, [1, 5]), ("a", 1, 5, 1, 10, [11, 12]), ("a", 2, 5, 1, 30, [30]), ("b", 0, 1, 10, 10, [10])
    ]
    assert sorted(page_lists.expand_lists(lists, "s").collect()) == sorted(pairs.collect())
    assert sorted(tuple(r) for r in page_lists.page_stats(pairs, "s").collect()) == [("a", 5, 1), ("b", 1, 10)]


def test_upserts(spark):
    old = spark.createDataFrame([("a", 1)], "k string, v int")
    new = spark.createDataFrame([("a", 9), ("b", 3), ("b", 2), (None, 4)], "k string, v int")
    assert sorted(upsert.insert_if_absent(old, new, "k", [F.col("v")]).collect()) == [("a", 1), ("b", 2)]
    table = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "k string, v int, w string")
    changes = spark.createDataFrame([("b", None), ("c", 5)], "k string, v int")
    assert sorted(upsert.update_by_key(table, changes, "k", ["v"]).collect()) == [("a", 1, "x"), ("b", None, "y")]
    twice = changes.union(changes).union(spark.createDataFrame([("b", 7), (None, 1), ("a", 5)], "k string, v int"))
    assert sorted(upsert.update_by_key(table, twice, "k", ["v"], [F.col("v").desc()]).collect()) == [("a", 5, "x"), ("b", 7, "y")]
    assert sorted(upsert.update_by_key(table, twice.filter("v = 7 or k = 'a'"), "k", ["v"]).collect()) == [("a", 5, "x"), ("b", 7, "y")]
    filled = upsert.with_defaults(changes, {"v": 0, "note": ""})
    assert sorted(tuple(r) for r in filled.collect()) == [("b", 0, ""), ("c", 5, "")]


def greedy(candidates):
    """Labels chosen one cluster after the other."""
    used, chosen = set(), {}
    for prio in sorted(candidates):
        listed = candidates[prio]
        free = [w for w in listed if len(w) > 1 and w not in used]
        chosen[prio] = free[0] if free else listed[-1]
        used.add(chosen[prio])
    return chosen


def run_labels(spark, candidates):
    rows = [(p, i, w) for p, listed in candidates.items() for i, w in enumerate(listed)]
    return {r.prio: r.word for r in unique_labels.unique_labels(spark.createDataFrame(rows, "prio long, choice int, word string")).collect()}


def test_unique_labels_case(spark):
    given = {1: ["xx", "yy"], 2: ["xx", "yy"], 3: ["xx", "yy"], 4: ["a", "b2"]}
    assert run_labels(spark, given) == {1: "xx", 2: "yy", 3: "yy", 4: "b2"}


def test_unique_labels_random(spark):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(150)] + ["a", "b"]
    given = {p: rng.sample(vocabulary, rng.randint(1, 6)) for p in range(400)}
    assert run_labels(spark, given) == greedy(given)
    # Every cluster wants the same words in the same order: the longest chain of refusals.
    chain = {p: [f"w{i}" for i in range(6)] for p in range(60)}
    assert run_labels(spark, chain) == greedy(chain)


def test_settled_clusters_leave_the_rounds(spark, monkeypatch):
    rng = random.Random(9)
    # Words of a region: near clusters want the same ones, far ones do not.
    given = {p: rng.sample([f"r{p // 40}w{i}" for i in range(60)], 6) for p in range(1200)}
    sizes, before = [], unique_labels.stage

    def counted(df, name):
        table = before(df, name)
        if name == "label-state":
            sizes.append(table.count())
        return table

    monkeypatch.setattr(unique_labels, "stage", counted)
    assert run_labels(spark, given) == greedy(given)
    assert sizes[0] == 1200 and sizes == sorted(sizes, reverse=True) and sizes[1] < 900 and sum(sizes[1:]) < 4 * sizes[0]


def plain_lloyd(points, starts, rounds):
    """Every point against every center in every round."""
    at, weight, centers = points[:, :2], points[:, 2], starts.copy()

    def nearest():
        d = (at[:, :1] - centers[:, 0]) ** 2 + (at[:, 1:] - centers[:, 1]) ** 2
        return d.argmin(axis=1), d

    for _ in range(rounds):
        of, _ = nearest()
        total = np.bincount(of, weight, len(centers))
        for axis in (0, 1):
            centers[:, axis] = np.where(total > 0, np.bincount(of, weight * at[:, axis], len(centers)) / np.maximum(total, 1e-300), centers[:, axis])
    return centers, *nearest()


def made_points(rng, n, kind):
    """Places: spread evenly, in dense towns, or on a lattice full of ties."""
    if kind == "even":
        at = np.column_stack([rng.uniform(-90, 90, n), rng.uniform(-180, 180, n)])
    elif kind == "towns":
        town = rng.uniform((-60, -150), (60, 150), (12, 2))
        at = town[rng.integers(0, 12, n)] + rng.normal(0, 0.3, (n, 2)) * rng.exponential(1, (n, 1))
    else:
        at = np.column_stack([rng.integers(-20, 20, n) * 1.0, rng.integers(-20, 20, n) * 1.0])
    at = np.unique(at, axis=0)
    return np.column_stack([at, rng.integers(1, 9, len(at))])


def table_of(spark, points):
    return stage(spark.createDataFrame(points.tolist(), "lat double, lon double, weight double"), "points")


@pytest.mark.parametrize(("kind", "n", "k"), [("even", 1500, 1), ("even", 1500, 25), ("towns", 4000, 300), ("lattice", 1500, 90), ("even", 200, 500)])
def test_bounded_rounds_are_plain_lloyd(spark, kind, n, k):
    points = made_points(np.random.default_rng(k), n, kind)
    table = table_of(spark, points)
    starts = kmeans.drawn_starts(table, k, seed=3)
    assert len(starts) == min(k, len(points)) == len(set(zip(starts.lat, starts.lon, strict=True)))
    centers, state = kmeans.lloyd(table, starts, 6)
    expected, of, d = plain_lloyd(points, np.column_stack([starts.lat, starts.lon]), 6)
    assert np.allclose(np.column_stack([centers.lat, centers.lon]), expected, atol=1e-9)
    given = {(r.lat, r.lon): r.cluster for r in state.collect()}
    assert len(given) == len(points)
    for i, (lat, lon, _) in enumerate(points):
        # Rounding may tell between centers that are as near as each other.
        assert given[lat, lon] == of[i] or abs(d[i, given[lat, lon]] - d[i, of[i]]) < 1e-9
    fitted = kmeans.fit_kmeans(table, k, seed=3, iterations=6)
    assert kmeans.cost(table, fitted) == pytest.approx((points[:, 2] * d.min(axis=1)).sum(), abs=1e-6)


def test_settled_points_are_not_looked_at_again(spark, monkeypatch):
    points = made_points(np.random.default_rng(1), 6000, "towns")
    table, looked, before = table_of(spark, points), [], kmeans._bounds

    def counted(df, centers, lists):
        looked.append(df.count())
        return before(df, centers, lists)

    monkeypatch.setattr(kmeans, "_bounds", counted)
    kmeans.lloyd(table, kmeans.drawn_starts(table, 60), 8)
    assert looked[0] == len(points) and min(looked[-3:]) < len(points) / 3


def test_first_rounds_store_no_points(spark, monkeypatch):
    """Three rounds give the plain method's centers, and write nothing but the draw of their starts."""
    points = made_points(np.random.default_rng(7), 3000, "towns")
    table, stored, before = table_of(spark, points), [], kmeans.stage
    monkeypatch.setattr(kmeans, "stage", lambda df, name: stored.append(name) or before(df, name))
    starts = kmeans.drawn_starts(table, 40, seed=1)
    at = np.column_stack([starts.lat, starts.lon])
    for rounds in (1, 3, 5):
        fitted = np.array([tuple(r)[1:] for r in kmeans.fit_kmeans(table, 40, seed=1, iterations=rounds).orderBy("cluster").collect()])
        assert np.allclose(fitted, plain_lloyd(points, at, rounds)[0], atol=1e-9)
        assert stored.count("bounds") == max(0, rounds - kmeans.PLAIN_ROUNDS)
        stored.clear()


@pytest.mark.parametrize("wanted", [1, 2])
def test_nearest_in_batches_is_nearest_by_join(spark, monkeypatch, wanted):
    """Ties, few centers, places outside of the plane and rows without a place, in steps of few pairs."""
    rng = np.random.default_rng(9)
    at = [(float(a), float(b)) for a, b in rng.integers(-9, 9, (400, 2))]
    rows = [(i, *p) for i, p in enumerate([*at, (500.0, 3.0), (-300.0, 900.0), (90.0, 180.0), (None, 1.0), (2.0, float("nan"))])]
    # At infinity all centers are as far: there is a first one by number, but no second nearest.
    rows += [(len(rows), float("inf"), 1.0)] if wanted == 1 else []
    df = spark.createDataFrame(rows, "id int, lat double, lon double").repartition(3)
    for k in (1, 2, 60):
        place = np.array([at[i] for i in rng.integers(0, 400, k)])
        centers = cells.Centers(np.arange(k, dtype=np.int32)[::-1].copy(), place[:, 0].copy(), place[:, 1].copy())
        lists, found = cells.candidate_lists(centers, wanted), []
        for limit, pairs in ((-1, 1 << 18), (1 << 26, 1 << 18), (1 << 26, 7)):
            monkeypatch.setattr(cells, "BROADCAST_BYTES", limit)
            monkeypatch.setattr(cells, "STEP_PAIRS", pairs)
            best = cells.nearest(df, centers, lists, wanted).select("id", *(F.get("_best", F.lit(i)).getField(f) for i in range(wanted) for f in ("d", "cluster")))
            found.append(sorted((tuple(r) for r in best.collect()), key=lambda r: r[0]))
        assert found[0] == found[1] == found[2] and len(found[0]) == len(rows)


def test_candidate_lists_hold_the_nearest():
    rng = np.random.default_rng(2)
    for kind in ("even", "towns", "lattice"):
        at = made_points(rng, 3000, kind)
        centers = cells.Centers(np.arange(len(at)), at[:, 0].copy(), at[:, 1].copy())
        lists = cells.candidate_lists(centers, 2)
        listed = lists.key >= 0
        assert listed.sum() < 60 * len(at)
        d = np.hypot(at[:, :1] - at[:, 0], at[:, 1:2] - at[:, 1])
        np.fill_diagonal(d, np.inf)
        assert np.allclose(cells.gaps(centers, lists), d.min(axis=1))


def test_spread_seeds(spark):
    """Far groups of very different weight all get a center, which a plain draw would not give them."""
    rng = np.random.default_rng(3)
    groups = [(0, 0, 3000), (50, 100, 12), (-50, 120, 12), (60, -140, 12), (-60, -120, 12)]
    points = np.vstack([np.column_stack([rng.normal((lat, lon), 0.5, (n, 2)), np.ones(n)]) for lat, lon, n in groups])
    table = table_of(spark, points)
    seeds = [(r.lat, r.lon) for r in kmeans.spread_seeds(table, 10, seed=1).collect()]
    assert 5 <= len(seeds) <= 10
    assert all(min(np.hypot(a - lat, b - lon) for a, b in seeds) < 3 for lat, lon, _ in groups)
    few = table_of(spark, np.array([[1.0, 2.0, 1.0], [3.0, 4.0, 1.0], [5.0, 6.0, 9.0]]))
    assert kmeans.spread_seeds(few, 3).count() == 3 and kmeans.spread_seeds(few, 7).count() == 3
    none = few.where("false")
    assert kmeans.spread_seeds(none, 3).count() == 0 and kmeans.fit_kmeans(none, 3).count() == 0


def test_points_without_a_place(spark):
    rows = [(1.0, 2.0, 1.0), (None, 2.0, 1.0), (1.0, float("nan"), 1.0), (200.0, 400.0, 1.0)]
    table = stage(spark.createDataFrame(rows, "lat double, lon double, weight double"), "points")
    centers = kmeans.fit_kmeans(table, 5)
    assert sorted((r.lat, r.lon) for r in centers.collect()) == [(1.0, 2.0), (200.0, 400.0)]
    found = kmeans.nearest_center(table, centers.where("lat < 100")).collect()
    number = centers.where("lat < 100").first().cluster
    assert sorted(str(r.cluster) for r in found) == sorted([str(number)] * 2 + ["None"] * 2)


def test_minibatch_fit(spark):
    rng = np.random.default_rng(4)
    town = rng.uniform((-60, -150), (60, 150), (8, 2))
    at = town[rng.integers(0, 8, 3000)] + rng.normal(0, 0.4, (3000, 2))
    words = spark.createDataFrame([(i, f"w{i % 7}", *p) for i, p in enumerate(at.tolist())], "page_id long, word string, lat double, lon double")
    words = stage(words, "words")
    one = clusters.minibatch_fit(words, 8, rows=1000, seed=2).collect()
    assert sum(r.n for r in one) == 3000 and len(one) == 8
    assert sorted(one) == sorted(clusters.minibatch_fit(words, 8, rows=1000, seed=2).collect())
    assert all(min(np.hypot(r.lat - a, r.lon - b) for r in one) < 1 for a, b in town)
    named = clusters.cluster_words(words.withColumn("tf_idf", F.lit(0.5)), (8,), batches=True)
    assert named.count() == 3000 and named.select("cluster_8").distinct().count() == 8


def test_nearest_of_very_many_centers(spark):
    """More centers than any fixed limit, points outside of their box, ties by number, and no centers at all."""
    centers = spark.range(60_000).selectExpr("cast(id as int) as cluster", "(id % 300) * 0.4 - 60 as lat", "floor(id / 300) * 0.8 - 80 as lon")
    rng = random.Random(8)
    points = [(i, rng.uniform(-90, 90), rng.uniform(-180, 180)) for i in range(300)] + [(300, -60.0 + 0.2, -80.0 + 0.4), (301, 0.0, 0.0)]
    df = spark.createDataFrame(points, "page_id long, lat double, lon double")
    table = [(r.cluster, r.lat, r.lon) for r in centers.collect()]
    lats, lons = (np.array([c[i] for c in table], dtype=float) for i in (1, 2))
    for row in kmeans.nearest_center(df, centers).collect():
        d = (lats - row.lat) ** 2 + (lons - row.lon) ** 2
        assert d[row.cluster] == pytest.approx(d.min(), abs=1e-12)
    assert {r.cluster for r in kmeans.nearest_center(df, centers.filter("false")).collect()} == {None}
    three = spark.createDataFrame([(4, 1.0, 1.0), (2, 1.0, 1.0), (3, -1.0, -1.0)], "cluster int, lat double, lon double")
    assert {r.cluster for r in kmeans.nearest_center(df.filter("page_id = 301"), three).collect()} == {2}


def test_minibatch_step(spark):
    points = spark.createDataFrame([(1.0, 1.0), (3.0, 1.0), (50.0, 50.0)], "lat double, lon double")
    centers = spark.createDataFrame([(0, 0.0, 0.0, 2), (1, 60.0, 60.0, 1), (2, -80.0, 0.0, 4)], "cluster int, lat double, lon double, n long")
    moved = {r.cluster: (r.lat, r.lon, r.n) for r in kmeans.minibatch_step(points, centers).collect()}
    assert moved == {0: (1.0, 0.5, 4), 1: (55.0, 55.0, 2), 2: (-80.0, 0.0, 4)}


def test_no_words_no_clusters(spark):
    empty = spark.createDataFrame([], "page_id long, word string, lat double, lon double, tf_idf double")
    assert clusters.cluster_words(empty, counts=(5,)).collect() == []
    dictionary = spark.createDataFrame([("w",)], "word string")
    assert tuple(clusters.kept_share(empty, dictionary).first()) == (0, 0, None)
    pages = spark.createDataFrame([], "page_id long, wikitext string")
    assert load_statistics(pages).first().percent is None


def test_cluster_words_keeps_rows(spark):
    rng = random.Random(6)
    # A third of the pages share the point (0, 0).
    rows = []
    for page in range(90):
        lat, lon = (0.0, 0.0) if page % 3 == 0 else (rng.uniform(-90, 90), rng.uniform(-180, 180))
        rows += [(page, f"w{rng.randint(0, 20)}-{i}", lat, lon, 0.5) for i in range(rng.randint(1, 5))]
    words = spark.createDataFrame(rows, "page_id long, word string, lat double, lon double, tf_idf double")
    clustered = clusters.cluster_words(words, counts=(5, 9), fit_rows=100)
    assert clustered.columns == [*words.columns, "cluster_7", "cluster_5", "cluster_9"]
    assert sorted(clustered.select(*words.columns).collect()) == sorted(words.collect())
    zero = clustered.filter("lat = 0 and lon = 0").select("cluster_5", "cluster_9").distinct().count()
    assert zero == 1


def test_page_sets(spark):
    """Dense and sparse keys, ids of any sign at the bounds of buckets, repeats and nulls."""
    dense = [*range(-70_000, 70_000, 37), -1, 0, 1, 32767, 32768, -32768, -32769]
    rows = [("dense", i) for i in dense] + [("sparse", i) for i in (5, -40_000, 69_999, 5)] + [("one", 7), (None, 1), ("dense", None)]
    pairs = spark.createDataFrame(rows, "s string, page_id long")
    sets = stage(page_sets.page_sets(pairs, "s"), "sets")
    kinds = {r.s: r.is_map for r in sets.selectExpr("s", "bitmap is not null as is_map").collect()}
    assert kinds == {"dense": True, "sparse": False, "one": False}
    expected = {"dense": sorted(set(dense)), "sparse": [-40_000, 5, 69_999], "one": [7]}
    found = {}
    for r in page_sets.expand_sets(sets, "s").collect():
        found.setdefault(r.s, []).append(r.page_id)
    assert {k: sorted(v) for k, v in found.items()} == expected
    stats = {r.s: (r.pagecount, r.first_page) for r in page_sets.set_stats(sets, "s").collect()}
    assert stats == {k: (len(v), v[0]) for k, v in expected.items()}
    lists = page_sets.lists_of_sets(sets, "s").orderBy("s", "part").collect()
    assert [(r.pagecount, r.first_page) for r in lists if r.part == 0] == [(len(expected[k]), expected[k][0]) for k in sorted(expected)]
    assert [i for r in lists if r.s == "dense" for i in r.pages] == expected["dense"]
    assert page_sets.page_sets(pairs.limit(0), "s").collect() == []


def test_page_sets_are_reduced_before_the_shuffle(spark):
    """A key on all pages is one bitmap for each task and bucket, not a row for each page."""
    pairs = spark.range(0, 300_000, 1, 4).selectExpr("'x' as s", "id as page_id")
    sets = page_sets.page_sets(pairs, "s")
    assert sets.selectExpr("sum(n)", "count(*)").first() == (300_000, 10)
    plan = sets._jdf.queryExecution().executedPlan().toString()
    assert "partial_bitmap_construct_agg" in plan


def test_union_of_page_sets(spark):
    left = [("dense", i) for i in range(0, 3000, 2)] + [("few", 1), ("left", 9)]
    right = [("dense", i) for i in (3, 2999, 500_000)] + [("few", 1), ("few", 2), ("right", 400_000)]
    made = [stage(page_sets.page_sets(spark.createDataFrame(rows, "s string, page_id long"), "s"), "sets") for rows in (left, right)]
    assert made[0].where("bitmap is not null and s = 'dense'").count() == 1
    assert made[1].where("bitmap is not null and s = 'dense'").count() == 0
    both = stage(page_sets.union_sets(*made, "s"), "union")
    assert sorted((r.s, r.page_id) for r in page_sets.expand_sets(both, "s").collect()) == sorted({*left, *right})
    assert {r.s: r.pagecount for r in page_sets.set_stats(both, "s").collect()} == {"dense": 1503, "few": 2, "left": 1, "right": 1}


def test_most_rows_leave_before_the_ranking(spark):
    """Rows of a group that lie together: the best stay, with ties and values that are no numbers, wherever a batch ends."""
    rng = random.Random(11)
    rows = [(None if g == 3 else g, float(rng.randint(0, 40)), i) for g in range(30) for i in range(400)]
    rows += [(50, float("nan"), 0), (50, None, 1), (50, 7.0, 2), (50, 8.0, 3), (50, 9.0, 4)]
    df = spark.createDataFrame(rows, "g int, v double, i int").coalesce(1)
    kept = df.where(ranking.leading_of_runs("g", "v", 3)).collect()
    assert len(kept) < len(rows) / 5

    def best(table):
        return sorted(map(str, ranking.top_per_group(table, ["g"], [F.col("v").desc(), F.col("i")], 3).collect()))

    assert best(df) == best(spark.createDataFrame(kept, df.schema))
