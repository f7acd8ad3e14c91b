"""What the stored-metric, snapshot, bucket and landing queries move and read as tables grow."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from parcelflow.functions import AS_OF_DEFAULT
from parcelflow.functions.columns import point_coordinates, row_hash
from parcelflow.plans import copartitioned, distributions, facts, history, pin_bitmaps, serving, upkeep
from parcelflow.plans.build import Models, TableStore
from parcelflow.session import scratch_path, stored
from parcelflow.sources import testdata
from tests.conftest import SF_SMALL
from tests.test_models import arch, build, live
from tests.test_plans import plan_of
from tests.test_upkeep import close, same


@pytest.fixture()
def fresh(spark, small_models, scratch):
    """Models of which nothing is stored yet."""
    store = TableStore(spark, scratch_path(spark, "scale", os.path.basename(scratch)))
    return Models(small_models.raw, AS_OF_DEFAULT, store=store)


def test_the_wide_rows_of_the_feeds_are_not_shuffled(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = plan_of(testdata._violation_base(spark, SF_SMALL))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    last = next(x for x in plan.splitlines() if "Exchange hashpartitioning" in x)
    assert "l_orderkey" in last  # the last join is that of line items and orders


def test_stored_sets_and_district_mart_write_no_wide_table(fresh, small_models):
    same(fresh.mart_council_district, small_models.mart_council_district)
    assert fresh.pin_sets.by_flags().count()
    written = set(fresh.store._draft.folders)
    assert {"distinct_violations", "pin_months"} <= written
    assert not written & {"mart_dashboard", "fact_violation"}


def test_stored_sets_of_hand_built_rows(spark):
    twice = live(violationid="x", pin="P2")
    m = build(spark, [live(), twice, twice, live(violationid="y", pin=" "),
                      live(violationid="z", pin="P3", computed_region_9t2m_phkm=None)],
              [arch(), arch(id="h2", pin=None, council_district="")], [])
    for scope in (None, "3", "UNKNOWN", (None, dt.date(2020, 1, 2), dt.date(2020, 1, 2)),
                  ("3", dt.date(2019, 5, 1), dt.date(2020, 1, 1))):
        same(pin_bitmaps.kpis(m.pin_sets, scope), serving.live_kpis(m.mart_dashboard, scope))
        same(pin_bitmaps.funnel(m.pin_sets, scope), serving.live_funnel(m.mart_dashboard, scope))
        same(distributions.live_resolution(m.days_distribution, m.distinct_violations, m.as_of, scope),
             serving.live_resolution(m.mart_dashboard, scope))


@pytest.mark.parametrize("name", ["stored_resolution", "stored_resolution_district_4_odd_days"])
def test_stored_resolution_writes_no_wide_table(spark, fresh, small_models, monkeypatch, name):
    monkeypatch.setattr(entry, "models", lambda *_: fresh)
    got = entry.queries()[name](spark, SF_SMALL)
    same(got, serving.live_resolution(small_models.mart_dashboard, entry.STORED_QUERIES[name][2]))
    assert not set(fresh.store._draft.folders) & {"mart_dashboard", "fact_violation"}


def test_a_fact_key_is_shuffled_as_bytes(small_models):
    rows = small_models.int_violations_unioned
    distinct = facts.distinct_violations(rows, AS_OF_DEFAULT)
    assert dict(distinct.dtypes)["violation_pk"] == "binary"
    inside = rows.where(F.col("date_found").between(F.lit(dt.date(2005, 1, 1)), F.lit(AS_OF_DEFAULT)))
    same(facts.fact_rows(distinct).select("violation_pk"), inside.select(
        row_hash(history.HISTORY_COLUMNS).alias("violation_pk")).distinct())


def test_rollup_takes_one_exchange(small_models):
    plan = plan_of(history.int_property_rollup(small_models.int_violations_unioned))
    assert plan.count("Exchange hashpartitioning") == 1


def test_live_states_and_digests_come_off_one_read(small_models):
    rows = small_models.int_violations_unioned
    drop = rows.where("source_system = 'energov'")
    kept = []
    start = upkeep.SnapshotUpkeep.start(rows.where("source_system = 'historical'"), drop,
                                        lambda df, name: kept.append(name) or stored(df, name))
    assert kept == ["archive_states", "live_states", "total_states"]
    same(start.digests, upkeep.pin_digests(drop))
    same(start.live, upkeep.pin_states(drop))


def test_the_drop_is_stored_before_the_refresh_reads_it(spark, fresh, monkeypatch):
    read = []
    monkeypatch.setattr(entry, "models", lambda *_: fresh)
    refresh = upkeep.SnapshotUpkeep.refresh
    monkeypatch.setattr(upkeep.SnapshotUpkeep, "refresh",
                        lambda self, rows: read.append(rows) or refresh(self, rows))
    got = entry.queries()["rollup_after_refresh"](spark, SF_SMALL)
    assert all("live-drop" in f for f in read[0].inputFiles())
    same(close(got), close(history.int_property_rollup(fresh.int_violations_unioned)))


def test_a_point_is_parsed_once(spark):
    points = spark.createDataFrame([('{"coordinates":[1,2]}',), ('{"coordinates":[1]} x',), ("[]",),
                                    ('{"coordinates":"no"}',), (None,)], "p string")
    found = points.select(point_coordinates("p").alias("c"))
    assert [r.c for r in found.collect()] == [["1", "2"], None, None, None, None]
    plan = points.select(point_coordinates("p").alias("c"))._jdf.queryExecution().optimizedPlan()
    assert plan.toString().count("from_json(") == 1


def test_buckets_move_digests_as_bytes(spark, small_models, scratch):
    rows = small_models.fact_violation.select("property_sk", "violation_pk", "days_open")
    plain, packed = (copartitioned.Buckets.write(rows, scratch_path(spark, os.path.basename(scratch), n),
                                                 "property_sk", 4, digests)
                     for n, digests in (("a", []), ("b", ["property_sk", "violation_pk"])))
    same(packed.read(spark).select(*rows.columns), rows)
    at = lambda b: sorted(
        (r.file[-20:-15], r.n) for r in b.read(spark).groupBy(F.regexp_extract(
            F.input_file_name(), r"(_\d{5})\.c\d+", 1).alias("file")).count().withColumnRenamed("count", "n").collect())
    assert at(plain) == at(packed) and len(at(packed)) == 4
