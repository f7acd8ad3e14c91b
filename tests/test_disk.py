"""What the queries write and shuffle: packed feeds, narrow joins, no table they don't need."""

import datetime as dt
import glob
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from parcelflow.functions import AS_OF_DEFAULT
from parcelflow.operators import hot_keys, salted_lookup_join
from parcelflow.plans import marts, serving, top_types
from parcelflow.plans.build import Models, TableStore
from parcelflow.session import scratch_path, stored
from parcelflow.sources import landing, testdata
from tests.conftest import SF_SMALL
from tests.test_models import arch, build, listed, live
from tests.test_plans import plan_of
from tests.test_upkeep import same


@pytest.fixture()
def fresh(spark, small_models, scratch):
    """Models of which nothing is stored yet."""
    store = TableStore(spark, scratch_path(spark, "disk", os.path.basename(scratch)))
    return Models(small_models.raw, AS_OF_DEFAULT, store=store)


def codecs(path: str) -> set[str]:
    parts = glob.glob(f"{path.removeprefix('file:')}/**/*.parquet", recursive=True)
    return {pq.ParquetFile(p).metadata.row_group(0).column(0).compression
            for p in parts if pq.ParquetFile(p).metadata.num_row_groups}


def test_a_written_feed_is_packed_in_short_files(spark, fresh, monkeypatch):
    monkeypatch.setattr(entry, "models", lambda *_: fresh)
    monkeypatch.setattr(entry, "FEED_LINES", 700)
    path = entry._write_feed(spark, SF_SMALL)
    files = glob.glob(f"{path}/part-*")
    lines = [spark.read.text(f).count() for f in files]
    feed = fresh.raw["npd_violations"]
    assert files and all(f.endswith(".lz4") for f in files)
    assert max(lines) <= 700 and sum(lines) == feed.count()
    landed = landing.read_all_text(spark, path)
    same(landed.select(*feed.columns), feed)


def test_landed_tables_are_packed(spark, fresh, scratch, monkeypatch):
    monkeypatch.setattr(entry, "models", lambda *_: fresh)
    path = entry._write_feed(spark, SF_SMALL)
    landed = landing.land_registry(spark, [landing.Feed("npd_violations", path)], f"{scratch}/raw")
    same(landed["npd_violations"].select(*fresh.raw["npd_violations"].columns),
         fresh.raw["npd_violations"])
    assert codecs(f"{scratch}/raw") == {"ZSTD"}


def test_the_join_of_the_feeds_keeps_days_and_is_packed(spark):
    kinds = dict(testdata._violation_base(spark, SF_SMALL).dtypes)
    assert kinds["l_shipdate"] == kinds["o_orderdate"] == "date"
    files = testdata.raw_feeds(spark, SF_SMALL)["npd_violations"].inputFiles()
    assert codecs(os.path.dirname(files[0])) == {"ZSTD"}


@pytest.mark.parametrize("name", ["stored_top_types", "stored_top_types_odd_days"])
def test_stored_top_types_write_no_wide_table(spark, fresh, small_models, monkeypatch, name):
    monkeypatch.setattr(entry, "models", lambda *_: fresh)
    got = entry.queries()[name](spark, SF_SMALL)
    same(got, serving.live_top_types(small_models.mart_dashboard, entry.STORED_QUERIES[name][2]))
    assert not set(fresh.store._draft.folders) & {
        "mart_dashboard", "dim_property", "int_property_rollup", "fact_property_lifecycle"}


def odd_models(spark, *, listing: bool):
    """A property that is named as the added member, codes and pins of all kinds, copies."""
    twice = live(violationid="x", pin="P2", ordinance="9-1")
    named = [] if listing else [live(violationid="u", pin="UNKNOWN", ordinance="48-30")]
    return build(spark, [live(), twice, twice, *named, live(violationid="y", pin=" "),
                         live(violationid="z", pin=None, ordinance=" ", computed_region_9t2m_phkm=None),
                         live(violationid="w", pin="P3", ordinance="UNKNOWN", incident_location=None)],
                 [arch(), arch(id="h2", pin=None, council_district="", ordinance="7-7")],
                 [listed(), *([listed(pin="UNKNOWN")] if listing else [])],
                 labels=[("48-30", "Weeds"), ("48-30", "Tall weeds"), ("7-7", None)])


@pytest.mark.parametrize("listing", [False, True])
def test_top_types_of_a_property_named_unknown(spark, listing):
    m = odd_models(spark, listing=listing)
    m.__dict__["int_violations_unioned"] = stored(m.int_violations_unioned, "history")
    wide, cells, rows = (stored(x, "odd") for x in (m.mart_dashboard, m.type_cells, m.labelled_violations))
    assert wide.count() > m.fact_violation.count()  # its rows meet two properties
    for scope in (None, ("UNKNOWN", dt.date(2019, 5, 1), dt.date(2020, 1, 1)),
                  (None, dt.date(2020, 1, 2), dt.date(2020, 1, 2))):
        same(top_types.top_types(cells, rows, scope).rows, serving.live_top_types(wide, scope))


def off_the_fact(m):
    return marts.mart_dashboard(m.fact_violation, m.dim_violation_type, m.dim_council_district,
                                m.dim_property, m.fact_property_lifecycle)


def test_the_wide_table_stores_nothing_for_itself_alone(spark, fresh, small_models):
    same(fresh.mart_dashboard, small_models.mart_dashboard)
    same(fresh.mart_dashboard, off_the_fact(small_models))
    assert set(fresh.store._draft.folders) == {
        "mart_dashboard", "int_violations_unioned", "int_property_rollup", "dim_violation_type",
        "dim_council_district"}


def test_the_wide_table_moves_a_violation_once(spark, small_models):
    m = small_models
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = plan_of(marts.mart_dashboard_of_violations(
            m.distinct_violations, m.dim_violation_type.limit(0), m.dim_council_district.limit(0),
            m.dim_property, m.fact_property_lifecycle))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    moved = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x and "_salt#" in x]
    assert len([x for x in moved if "REPARTITION_BY_COL" in x]) == 1  # the violations
    assert len(moved) == 2  # and what is known of the properties
    assert "violation_pk#" not in "".join(x for x in plan.splitlines() if "Exchange hash" in x)


@pytest.mark.parametrize("listing", [False, True])
def test_the_wide_table_of_odd_rows(spark, listing):
    m = odd_models(spark, listing=listing)
    m.__dict__["int_violations_unioned"] = stored(m.int_violations_unioned, "history")
    same(m.mart_dashboard, off_the_fact(m))


def test_hot_keys_are_found_without_shuffling_every_key(spark):
    rows = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 7 == 0, "b").when(
            F.col("id") % 11 != 0, F.concat(F.lit("k"), F.col("id"))).alias("k"), "id")
    hot = hot_keys(rows, "k", 8)
    n = dict(rows.groupBy("k").count().collect())
    assert {r.k: r.salts for r in hot.collect() if r.k} == {
        k: -(-c * 8 // 6000) for k, c in n.items() if k and c * 8 > 6000}
    assert len([k for k in n if k]) > 2000
    assert "array_contains" in hot._jdf.queryExecution().optimizedPlan().toString()
    assert hot_keys(rows.where("false"), "k", 8).count() == 0


def test_salted_join_of_rows_that_come_twice(spark):
    rows = spark.createDataFrame([("a", i % 40) for i in range(160)] + [("b", 1), ("b", 1), (None, 2)],
                                 "k string, v int")
    dim = spark.createDataFrame([("a", 1.0), ("c", 2.0)], "k string, x double")
    same(salted_lookup_join(rows, dim, "k", "v", 4, distinct=True),
         rows.distinct().join(dim, "k", "left"))
