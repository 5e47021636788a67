"""Places in the order of their key, the keyed store, and loads in one scan."""

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from atlaslex import jobs
from atlaslex.functions.geo import key_ranges, place_key
from atlaslex.operators.store import FOLDER, FOLDERS, KeyedStore
from atlaslex.plans.coord_queries import placed_in_box
from atlaslex.sinks.files import write_placed
from atlaslex.sources import dump, tables
from atlaslex.staging import intermediate_tables, path_exists, stage
from test_jobs import article, write_dump


def boxes(rng, n):
    yield from [((-90, 90), (-180, 180)), ((0, 0), (0, 0)), ((-200, -100), (0, 1)), ((-100, 100), (170, 200)), ((90, 90), (180, 180)), ((5, 4), (0, 1))]
    for _ in range(n):
        lat, lon = sorted(rng.choice([rng.uniform(-90, 90), rng.randint(-90, 90)]) for _ in range(2)), sorted(rng.uniform(-180, 180) for _ in range(2))
        yield tuple(lat), tuple(lon)


def test_key_ranges_hold_their_box(spark):
    rng = random.Random(1)
    points = [(rng.choice([rng.uniform(-90, 90), float(rng.randint(-90, 90))]), rng.choice([rng.uniform(-180, 180), float(rng.randint(-180, 180))])) for _ in range(3000)]
    points += [(90.0, 180.0), (-90.0, -180.0), (95.0, 0.0), (0.0, 181.0), (None, 1.0), (float("nan"), 1.0)]
    keyed = [tuple(r) for r in spark.createDataFrame(points, "lat double, lon double").withColumn("key", place_key(F.col("lat"), F.col("lon"))).collect()]
    assert [key for *_, key in keyed[-4:]] == [-1] * 4 and max(k for *_, k in keyed) == (1 << 32) - 1
    read = []
    for lat, lon in boxes(rng, 60):
        ranges = key_ranges(lat, lon)
        assert len(ranges) <= 26 and all(a <= b for a, b in ranges) and all(b < c for (_, b), (c, _) in zip(ranges, ranges[1:], strict=False))
        for y, x, key in keyed:
            if y is not None and lat[0] <= y <= lat[1] and lon[0] <= x <= lon[1]:
                assert any(a <= key <= b for a, b in ranges)
        inside = sum(lat[0] <= y <= lat[1] and lon[0] <= x <= lon[1] for y, x, _ in keyed if y is not None)
        read.append((sum(any(a <= k <= b for a, b in ranges) for *_, k in keyed), inside))
    assert sum(r for r, _ in read) < 2 * sum(i for _, i in read)


def rows_read(df):
    """Rows that the scan of an executed plan gave, after row groups were skipped."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_a_box_reads_few_row_groups(spark, tmp_path):
    places = spark.range(200_000).selectExpr("id as page_id", "(id * 7919) % 17999 / 100D - 90 as lat", "(id * 104729) % 35999 / 100D - 180 as lon")
    write_placed(places, str(tmp_path / "map"), group_bytes=1 << 16)
    stored = spark.read.parquet(str(tmp_path / "map"))
    found = placed_in_box(stored, (40.0, 42.0), (-3.0, 1.0))
    expected = places.filter("lat between 40 and 42 and lon between -3 and 1")
    assert sorted(found.collect()) == sorted(expected.collect()) and expected.count() > 5
    assert "place_key" in found._jdf.queryExecution().executedPlan().toString().split("PushedFilters")[1]
    assert rows_read(found) < 20_000
    one_place = spark.range(5000).selectExpr("id as page_id", "0D as lat", "0D as lon")
    write_placed(one_place.union(places.limit(100)), str(tmp_path / "hot"))
    assert placed_in_box(spark.read.parquet(str(tmp_path / "hot")), (0, 0), (0, 0)).count() >= 5000
    assert placed_in_box(stored, (5, 4), (0, 1)).count() == 0


def folder_files(path):
    return {str(f.relative_to(path)): f.stat().st_mtime_ns for f in Path(path).rglob("*.parquet")}


def test_a_store_reads_and_writes_only_touched_ranges(spark, tmp_path):
    path = str(tmp_path / "store")
    store = KeyedStore(spark, path, "k", span=100)
    assert store.read() is None
    store.update(spark.createDataFrame([(1, "x")], "k long, v string"), ["v"], [F.col("v")])
    assert store.read() is None
    store.insert(spark.range(1000).selectExpr("id as k", "'old' as v"), [F.col("v")])
    before = folder_files(path)
    store.insert(spark.createDataFrame([(305, "new"), (1001, "b"), (1001, "a"), (None, "z")], "k long, v string"), [F.col("v")])
    after = folder_files(path)
    assert before.items() <= after.items() and {name.split("/")[0] for name in after.keys() - before.keys()} == {f"{FOLDER}=10"}
    assert {r.k: r.v for r in store.read().filter("k in (305, 1001)").collect()} == {305: "old", 1001: "a"}
    changes = [(7, "first", 2), (7, "last", 1), (250, None, 1), (99_999, "unknown", 1), (None, "z", 1)]
    store.update(spark.createDataFrame(changes, "k long, v string, at int"), ["v"], [F.col("at").desc()])
    changed = {name.split("/")[0] for name in after.items() ^ folder_files(path).items() for name in [name[0]]}
    assert changed == {f"{FOLDER}=0", f"{FOLDER}=2"}
    rows = {r.k: r.v for r in store.read().collect()}
    assert len(rows) == store.read().count() == 1001 and rows[7] == "first" and rows[250] is None and rows[8] == "old"
    plan = store.ranges([3])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and f"{FOLDER}" in plan.split("PartitionFilters")[1].split("]")[0]


def test_a_store_has_few_folders_and_files(spark, tmp_path):
    """Ranges widen with the first rows, the width is kept with the store, and a folder gets one file by each write."""
    path = str(tmp_path / "store")
    store = KeyedStore(spark, path, "k", span=5)
    rows = spark.range(0, 20_000, 1, 8).selectExpr("id - 5000 as k", "'old' as v").repartition(8)
    store.insert(rows.filter("k % 2 = 0"), [F.col("v")])
    folders = {name.split("/")[0] for name in folder_files(path)}
    assert 16 <= len(folders) <= FOLDERS and len(folder_files(path)) == len(folders)
    # Whatever width it is opened with.
    again = KeyedStore(spark, path, "k", span=320)
    again.insert(rows.withColumn("v", F.lit("new")), [F.col("v")])
    before = folder_files(path)
    assert {name.split("/")[0] for name in before} == folders and len(before) == 2 * len(folders)
    again.update(spark.createDataFrame([(-1, "x"), (99_999, "y")], "k long, v string"), ["v"], [F.col("v")])
    after = folder_files(path)
    assert len(after) == len(before) - 1 and len({name.split("/")[0] for name in after.keys() - before.keys()}) == 1
    found = {r.k: r.v for r in again.read().collect()}
    assert again.read().columns == ["k", "v"] and again.read().count() == len(found) == 20_000
    assert all(v == ("x" if k == -1 else "new" if k % 2 else "old") for k, v in found.items())


def test_a_store_of_keys_far_apart(spark, tmp_path):
    store = KeyedStore(spark, str(tmp_path / "store"), "k", span=50)
    keys = [(-1) ** i * i**3 * 1_000_003 for i in range(2000)]
    store.insert(spark.createDataFrame([(k, "v") for k in keys], "k long, v string"), [F.col("v")])
    store.insert(spark.createDataFrame([(k, "w") for k in keys], "k long, v string"), [F.col("v")])
    assert len({name.split("/")[0] for name in folder_files(store.path)}) <= FOLDERS
    assert sorted(tuple(r) for r in store.read().collect()) == sorted((k, "v") for k in set(keys))


def test_a_load_scans_the_dump_once(spark, tmp_path, monkeypatch):
    folder, source = str(tmp_path / "map"), tmp_path / "dump"
    write_dump(source, [article(i) for i in range(1, 41)] + [(50, "No place", "river"), (51, "Broken", "{{coord|1|2"), (52, "Bad & title", "coord")])
    scans, parse = [], dump.parsed_records
    monkeypatch.setattr(jobs, "parsed_records", lambda records: scans.append(1) or parse(records))
    jobs.index(spark, folder, str(source))
    assert len(scans) == 1
    found = tables.read_stage(spark, f"{folder}/statistics").first()
    assert (found.pages, found.coord_pages, found.successes, found.rejected, found.failures) == (43, 42, 40, 1, 2)
    assert tables.read_stage(spark, f"{folder}/map").count() == 40
    jobs.find_in_box(spark, folder, (9.5, 9.5, 12, 12))
    assert sorted(r.title for r in tables.read_stage(spark, f"{folder}/answer").collect()) == ["Town 10", "Town 11", "Town 12"]


@pytest.mark.parametrize("split", ["64m", "8k"])
def test_a_share_is_the_leading_pages(spark, tmp_path, split):
    source = tmp_path / "dump"
    write_dump(source, [article(i) for i in range(1, 200)])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        for n in (1, 20, 57, 199, 500):
            records = dump.leading_records(dump.page_records(spark, str(source)), n)
            assert sorted(r.page_id for r in dump.parsed_records(records).collect()) == list(range(1, min(n, 199) + 1))
        folder = str(tmp_path / "map")
        jobs.index(spark, folder, str(source), share=29.5 / 21_000_000)
        found = tables.read_stage(spark, f"{folder}/statistics").first()
        assert (found.pages, found.coord_pages, found.successes, found.failures, found.percent) == (30, 30, 30, 0, 100.0)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_intermediate_tables_are_removed(spark):
    with intermediate_tables(spark):
        middle = stage(spark.range(3), "middle")
        result = stage(middle, "result", lasting=True)
        path = middle.inputFiles()[0].rsplit("/", 1)[0]
        assert path_exists(spark, path)
    assert not path_exists(spark, path) and result.count() == 3
