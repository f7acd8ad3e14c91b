"""Tiles, threshold top-k, bucketed wide join and the stacked key audit."""

import os
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from parcelflow.functions.columns import LAT_RANGE, LNG_RANGE
from parcelflow.operators import checks
from parcelflow.operators.checks import ColumnTest, failing_rows, key_failures
from parcelflow.plans import copartitioned, marts, tiles, top_types
from parcelflow.session import scratch_path
from tests.test_upkeep import same


def points(spark, n=3000, seed=1):
    rng = random.Random(seed)
    rows = [(str(i), rng.uniform(*LAT_RANGE), rng.uniform(*LNG_RANGE), rng.randint(1, 9), i % 7 == 0)
            for i in range(n)]
    rows += [("sw", LAT_RANGE[0], LNG_RANGE[0], 1, False), ("ne", LAT_RANGE[1], LNG_RANGE[1], 1, True)]
    return spark.createDataFrame(rows, "pin string, latitude double, longitude double, "
                                 "total_violations long, ever_dangerous_building boolean")


def test_morton_code_interleaves(spark):
    top = (1 << tiles.DEPTH) - 1
    rows = tiles.clustered_points(points(spark, 200)).select(
        "*", tiles._cell("longitude", *LNG_RANGE).alias("x"),
        tiles._cell("latitude", *LAT_RANGE).alias("y")).collect()
    for r in rows:
        assert r.code == sum((r.x >> i & 1) << 2 * i | (r.y >> i & 1) << 2 * i + 1 for i in range(16))
    assert {(r.x, r.y) for r in rows if r.pin in ("sw", "ne")} == {(0, 0), (top, top)}


@pytest.mark.parametrize("most", [4, 64, 100_000])
def test_code_ranges_hold_every_point_of_a_box(spark, most):
    rng = random.Random(5)
    coded = tiles.clustered_points(points(spark)).collect()
    for _ in range(20):
        a, b = sorted(rng.uniform(38.7, 39.6) for _ in "ab")
        c, d = sorted(rng.uniform(-95.0, -94.2) for _ in "ab")
        ranges = tiles.code_ranges(tiles.Box(a, c, b, d), most)
        inside = [r for r in coded if a <= r.latitude <= b and c <= r.longitude <= d]
        assert all(any(x <= r.code <= y for x, y in ranges) for r in inside)
        assert all(p[1] < q[0] for p, q in zip(ranges, ranges[1:], strict=False))
    assert tiles.code_ranges(tiles.Box(10, 10, 11, 11)) == []
    assert tiles.code_ranges(tiles.Box(38, -96, 40, -94)) == [(0, (1 << 32) - 1)]


def test_a_box_filter_prunes_row_groups(spark, scratch):
    path = f"{scratch}/points"
    tiles.clustered_points(points(spark, 20_000)).write.option("parquet.block.size", 1 << 14).option(
        "parquet.page.size", 1 << 12).parquet(path)
    box = tiles.Box(39.0, -94.6, 39.08, -94.52)
    ranges, groups, hit = tiles.code_ranges(box), 0, 0
    for name in os.listdir(path):
        if name.endswith(".parquet"):
            meta = pq.ParquetFile(f"{path}/{name}").metadata
            at = meta.schema.to_arrow_schema().get_field_index("code")
            for g in range(meta.num_row_groups):
                s = meta.row_group(g).column(at).statistics
                groups += 1
                hit += any(s.min <= y and x <= s.max for x, y in ranges)
    assert groups >= 20 and hit <= groups // 4
    found = tiles.in_box(spark.read.parquet(path), box)
    spark.conf.set("spark.sql.maxMetadataStringLength", 100_000)
    try:
        plan = tiles.in_box(spark.read.parquet(path), box)._jdf.queryExecution().executedPlan()
        assert "GreaterThanOrEqual(code" in plan.toString().split("PushedFilters", 1)[1]
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    everything = spark.read.parquet(path).where(
        F.col("latitude").between(39.0, 39.08) & F.col("longitude").between(-94.6, -94.52))
    same(found, everything)
    assert found.count() > 100


def test_tiles_of_every_zoom_add_up(spark):
    coded = tiles.clustered_points(points(spark))
    found = tiles.heatmap(tiles.tile_rollup(coded), [0, 3, 10]).collect()
    for z in (0, 3, 10):
        mine = [r for r in found if r.zoom == z]
        assert sum(r.properties for r in mine) == 3002
        assert all(0 <= r.tile_x < 1 << z and 0 <= r.tile_y < 1 << z for r in mine)
    with pytest.raises(ValueError):
        tiles.heatmap(tiles.tile_rollup(coded, 5), [6], 5)


def wide_rows(spark, types, n=6000, seed=3):
    rng = random.Random(seed)
    names = [None, *(f"type {i}" for i in range(types))]
    weights = [1 / (i + 1) for i in range(len(names))]
    picked = rng.choices(names, weights, k=n)
    rows = [(f"200{5 + i % 3}-{1 + i % 12:02d}-{1 + i % 28:02d}", str(i % 4), t)
            for i, t in enumerate(picked)]
    return spark.createDataFrame(rows, "day string, council_district string, short_label string").select(
        F.to_date("day").alias("date_found"), F.year(F.to_date("day")).cast("long").alias("year"),
        "council_district", "short_label")


def test_threshold_top_k_stops_early_and_is_exact(spark):
    import datetime as dt

    from parcelflow.plans.serving import live_top_types

    wide = wide_rows(spark, 300)
    cells = top_types.type_cells(wide)
    for scope in (None, "2", (None, dt.date(2005, 3, 9), dt.date(2006, 7, 4)),
                  ("1", dt.date(2006, 2, 3), dt.date(2006, 2, 20))):
        for k, depth in ((3, 2), (20, 4), (1000, 8)):
            got = top_types.top_types(cells, wide, scope, k, depth)
            same(got.rows, live_top_types(wide, scope, k))
            assert got.read <= got.entries
    early = top_types.top_types(cells, wide, None, 1, 4)
    assert early.read < early.entries / 2
    empty = wide.where("false")
    assert top_types.top_types(top_types.type_cells(empty), empty).rows.count() == 0


def test_wide_join_moves_no_fact_row(spark, small_models):
    m = small_models
    path = scratch_path(spark, "buckets-test")
    stored = copartitioned.StoredFact.write(m.fact_violation, f"{path}/fact", 8)
    about = copartitioned.stored_attributes(m.dim_property, m.fact_property_lifecycle,
                                            f"{path}/about", 8)
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        joined = copartitioned.joined([stored], about)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange hashpartitioning" not in plan
        assert plan.count("BroadcastExchange") == 2  # the hot keys, and what is known of them
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    same(copartitioned.wide_table([stored], about, m.dim_violation_type, m.dim_council_district),
         marts.mart_dashboard(m.fact_violation, m.dim_violation_type, m.dim_council_district,
                              m.dim_property, m.fact_property_lifecycle))
    # a later session finds the same buckets at the path
    again = copartitioned.Buckets.attach(spark, stored.cold.path, "property_sk", 8)
    same(again.read(spark).select(*stored.cold.read(spark).columns), stored.cold.read(spark))
    with pytest.raises(ValueError, match="buckets"):
        copartitioned.wide_table([stored], copartitioned.Buckets(about.path, "property_sk", 4,
                                                                 about.table),
                                 m.dim_violation_type, m.dim_council_district)


KEY_TESTS = [
    ColumnTest("child", "k", "relationships", ("parent", "k")),
    ColumnTest("child", "k2", "relationships", ("parent", "k")),
    ColumnTest("parent", "k", "unique"), ColumnTest("child", "k", "unique"),
    ColumnTest("child", "id", "unique"), ColumnTest("other", "k", "relationships", ("parent", "k")),
]


@pytest.mark.parametrize("bits", [64, 3, 1])
def test_key_audit_against_each_test_alone(spark, bits):
    # with few bits nearly all keys share a hash: those are counted again by value
    rng = random.Random(bits)
    some = lambda n, most: [rng.choice([None, *(f"key {i}" for i in range(most))]) for _ in range(n)]
    tables = {
        "parent": spark.createDataFrame([(k,) for k in some(40, 30)], "k string"),
        "child": spark.createDataFrame(list(zip(range(200), some(200, 60), some(200, 30), strict=True)),
                                       "id long, k string, k2 string"),
        "other": spark.createDataFrame([], "k string"),
    }
    alone = [failing_rows(t, tables[t.model], tables[t.parent[0]] if t.parent else None).count()
             for t in KEY_TESTS]
    assert key_failures(tables.__getitem__, KEY_TESTS, bits) == alone
    assert alone[0] and alone[2] and not alone[4]


def test_all_key_tests_of_a_build_take_one_exchange_of_keys(spark, small_models):
    tests = [t for t in checks.COLUMN_TESTS if t.kind in ("unique", "relationships")]
    assert len(tests) == 16
    assert key_failures(lambda n: getattr(small_models, n), tests) == [0] * 16
    domains = checks._domains(tests)
    assert ("dim_property", "property_sk") in domains
    assert domains["dim_property", "property_sk"][1:] == [
        ("fact_violation", "property_sk"), ("fact_property_lifecycle", "property_sk")]
