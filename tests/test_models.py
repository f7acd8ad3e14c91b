"""Model semantics on hand-built feed rows (FIXTURES.md §3) and invariants."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from parcelflow.plans.build import Models
from parcelflow.plans.staging import CURRENT_RAW, DANGEROUS_RAW, HISTORICAL_RAW

AS_OF = dt.date(2021, 1, 1)


def raw(spark, cols, rows):
    return spark.createDataFrame([tuple(r.get(c) for c in cols) for r in rows],
                                 ", ".join(f"{c} string" for c in cols))


def live(**kw):
    base = {"violationid": "v1", "casenumber": "c1", "pin": "P1", "ordinance": "48-30",
            "description": "weeds", "chapter": "48", "date_found": "2020-01-02T00:00:00.000",
            "computed_region_9t2m_phkm": "3",
            "incident_location": '{"type":"Point","coordinates":[-94.5,39.1]}'}
    base.update(kw)
    return base


def arch(**kw):
    base = {"id": "h1", "case_id": "k1", "pin": "P1", "ordinance": "48-30 C.O.",
            "violation_description": "weeds", "chapter": "48",
            "violation_entry_date": "2019-05-01T00:00:00.000", "council_district": "3",
            "latitude": "39.2", "longitude": "-94.6", "status": "Open"}
    base.update(kw)
    return base


def listed(**kw):
    base = {"pin": "P1", "casenumber": "D1", "case_opened": "2020-06-01T00:00:00.000",
            "statusofcase": "Open", "council_district": "3",
            "case_location": '{"type":"Point","coordinates":[-94.5,39.1]}'}
    base.update(kw)
    return base


def build(spark, lives, archs, lists, labels=(("48-30", "Weeds"),)):
    feeds = {
        "npd_violations": raw(spark, CURRENT_RAW, lives),
        "historical_violations": raw(spark, HISTORICAL_RAW, archs),
        "dangerous_buildings": raw(spark, DANGEROUS_RAW, lists),
        "violation_labels": spark.createDataFrame(list(labels),
                                                  "violation_code string, short_label string"),
    }
    return Models(feeds, AS_OF)


def rows(df, *cols, order=None):
    d = df.select(*cols)
    return [tuple(r) for r in (d.orderBy(*(order or cols)).collect())]


def test_resolution_cleaning(spark):
    m = build(spark, [
        live(violationid="a", date_resolved="2020-01-01T00:00:00.000"),  # before found
        live(violationid="b", date_resolved="2020-01-02T00:00:00.000"),  # same day
        live(violationid="c", date_found=None, date_resolved="2020-01-05"),  # found unknown
    ], [arch(id="d", status="Closed")], [])  # closed without a date
    got = rows(m.int_violations_unioned, "violation_id", "date_resolved", "is_resolved",
               "days_open")
    assert got == [("a", None, False, 365), ("b", dt.date(2020, 1, 2), True, 0),
                   ("c", None, None, None), ("d", None, False, 611)]
    # staging still calls the archive row resolved (status), cleaning does not
    assert rows(m.stg_violations_historical, "is_resolved") == [(True,)]
    assert m.fact_violation.count() == 3  # NULL found date is out of the fact
    assert m.int_property_rollup.first().total_violations == 4  # ...but in the rollup


def test_fact_dedup_and_bounds(spark):
    dup = live(violationid="x")
    m = build(spark, [dup, dup, live(violationid="x", chapter="other"),
                      live(violationid="old", date_found="2004-12-31"),
                      live(violationid="future", date_found="2021-01-02")], [], [])
    fv = m.fact_violation
    assert fv.count() == 2  # exact duplicate collapses, same id different row stays
    assert fv.select("violation_pk").distinct().count() == 2
    assert m.int_property_rollup.first().total_violations == 5


def test_recent_attributes_and_ties(spark):
    m = build(spark, [
        live(violationid="1", date_found="2020-01-01", street_address="old st"),
        live(violationid="2", date_found="2020-03-01", street_address="new st"),
        live(violationid="3", date_found="2020-03-01", street_address="tie st"),
    ], [arch(neighborhood="Zeta"), arch(id="h2", neighborhood="Alpha")], [])
    r = m.int_property_rollup.first()
    # same day: larger violation_id wins (tie-breaker), neighborhood is MAX
    assert (r.street_address, r.neighborhood) == ("tie st", "Zeta")
    assert r.first_violation_date == dt.date(2019, 5, 1)
    assert r.distinct_violation_types == 1  # '48-30' and '48-30 C.O.' unify


def test_representative_description(spark):
    m = build(spark, [live(violationid="1", description="b text"),
                      live(violationid="2", description=None),
                      live(violationid="3", ordinance="56-1", description="z")], [], [])
    got = rows(m.dim_violation_type, "violation_code", "violation_description", "short_label")
    assert got == [("48-30", None, "Weeds"), ("56-1", "z", "56-1"),
                   ("UNKNOWN", "Unknown / uncoded", "UNKNOWN")]


def test_bounding_box_and_listing(spark):
    m = build(spark, [
        live(violationid="1", pin="A", incident_location='{"coordinates":[-94.9,38.8]}'),
        live(violationid="2", pin="B", incident_location='{"coordinates":[-94.3,39.5]}'),
        live(violationid="3", pin="C", incident_location='{"coordinates":[-95.0,39.0]}'),
    ], [], [
        listed(pin=" A ", casenumber="D1", case_opened="2020-06-01"),
        listed(pin="A", casenumber="D2", case_opened="2020-06-01", statusofcase="To DEMOLISH"),
        listed(pin="A", casenumber="D9", case_opened="2019-01-01"),
        listed(pin="Z", casenumber="D3", statusofcase=None),
        listed(pin="  ", casenumber="D4"),
    ])
    dp = {r.pin: (r.latitude, r.longitude) for r in m.dim_property.collect()}
    assert dp == {"A": (38.8, -94.9), "B": (39.5, -94.3), "C": (None, None), "Z": (39.1, -94.5),
                  "UNKNOWN": (None, None)}
    st = {r.pin: (r.case_number, r.is_demolition_status)
          for r in m.stg_dangerous_buildings.collect()}
    assert st == {"A": ("D2", True), "Z": ("D3", None)}
    lc = {r.pin: (r.current_stage, r.is_demolition_status, r.ever_dangerous_building)
          for r in m.fact_property_lifecycle.collect()}
    assert lc == {"A": ("demolition", True, True), "B": ("single_violation", False, False),
                  "C": ("single_violation", False, False)}  # Z listed only: not in snapshot


def test_unknown_members_and_blank_district(spark):
    m = build(spark, [live(violationid="1", pin=" ", computed_region_9t2m_phkm=" ",
                           ordinance=None)], [], [])
    f = m.mart_dashboard.first()
    assert (f.pin, f.council_district, f.violation_code) == ("UNKNOWN", "UNKNOWN", "UNKNOWN")
    assert f.current_stage is None  # no snapshot row for the UNKNOWN property
    assert rows(m.dim_council_district, "council_district", "district_label") == [
        ("UNKNOWN", "Unknown")]


def test_literal_unknown_pin_collapses(spark):
    # a data row identical to the UNKNOWN member must not appear twice
    same = listed(pin="UNKNOWN", casenumber="D1", case_location=None, council_district="UNKNOWN")
    m = build(spark, [], [], [same])
    assert m.dim_property.where(F.col("pin") == "UNKNOWN").count() == 1
    other = dict(same, address="1 Main St")
    m2 = build(spark, [], [], [other])
    assert m2.dim_property.where(F.col("pin") == "UNKNOWN").count() == 2  # attrs differ
    assert build(spark, [], [], []).dim_property.count() == 1


def test_empty_funnel(spark):
    m = build(spark, [], [], [])
    got = rows(m.mart_blight_funnel, "stage_order", "property_count",
               "pct_of_violation_properties")
    assert got == [(1, 0, 1.0), (2, 0, None), (3, 0, None), (4, 0, None)]


def test_invariants(small_models):
    m = small_models
    assert m.mart_dashboard.count() == m.fact_violation.count()
    any_row = m.mart_blight_funnel.where("stage_order = 1").first().property_count
    assert any_row == m.fact_property_lifecycle.count()
    feeds = m.stg_violations_current.count() + m.stg_violations_historical.count()
    assert m.int_violations_unioned.count() == feeds
    assert m.mart_dashboard.select("violation_pk").distinct().count() == m.fact_violation.count()


def test_checks_pass(small_models):
    from parcelflow.operators.checks import SINGULAR, test_summary

    failures = {(r.model, r.column_name, r.test): r.failures
                for r in test_summary(lambda n: getattr(small_models, n)).collect()}
    assert len(failures) == 37
    assert all(v == 0 for v in failures.values()), {k: v for k, v in failures.items() if v}
    for key, (model, fn, sev) in SINGULAR.items():
        n = fn(getattr(small_models, model)).count()
        assert n == 0 or sev == "warn", key


@pytest.mark.parametrize("partitions", [1, 4, 16])
def test_salted_join_equals_plain_join(spark, partitions):
    from parcelflow.operators import salted_lookup_join

    hot = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 700)  # a third on one key
    big = spark.range(3000).select(hot.cast("string").alias("k"),
                                   F.col("id").cast("string").alias("v"))
    dim = spark.range(500).select(F.col("id").cast("string").alias("k"),
                                  (F.col("id") * 10).alias("a"))
    got = salted_lookup_join(big, dim, "k", "v", partitions=partitions)
    want = big.join(dim, "k", "left")
    assert got.count() == 3000
    assert got.exceptAll(want.select(*got.columns)).count() == 0


def test_salts_follow_the_share_of_a_key(spark):
    from parcelflow.operators import hot_keys

    big = spark.range(1000).select(F.when(F.col("id") < 500, 0).otherwise(F.col("id")).alias("k"))
    assert [tuple(r) for r in hot_keys(big, "k", 16).collect()] == [(0, 8)]
    assert hot_keys(big, "k", 1).count() == 0


def test_feed_keep_drop_counts(spark):
    m = build(spark, [live(violationid="a"), live(violationid=None), live(violationid="b")],
              [arch(id=None), arch(id="h9")],
              [listed(pin="P1"), listed(pin=None), listed(pin=" \t"), listed(pin="P2")])
    raw = m.raw
    kept = m.stg_violations_current.count() + m.stg_violations_historical.count()
    dropped = (raw["npd_violations"].where("violationid IS NULL").count()
               + raw["historical_violations"].where("id IS NULL").count())
    assert kept + dropped == raw["npd_violations"].count() + raw["historical_violations"].count()
    assert (kept, dropped) == (3, 2)
    assert m.stg_dangerous_buildings.count() == 2  # NULL and blank pins dropped


def test_dashboard_metrics_for_an_empty_district(small_models):
    from parcelflow.plans import serving
    wide = small_models.mart_dashboard
    f = serving.live_funnel(wide, "no-such-district").orderBy("stage_order").collect()
    assert [r.property_count for r in f] == [0, 0, 0, 0]
    k = serving.live_kpis(wide, "no-such-district").first()
    assert (k.properties, k.pct_escalated, k.total_violations) == (0, None, 0)
    assert serving.live_trend(wide, "no-such-district").count() == 0


def test_presentation_order(small_models):
    from parcelflow.plans.serving import presented
    rows = presented("mart_violations_trend", small_models.mart_violations_trend).collect()
    keys = [(r.year, r.source_system) for r in rows]
    assert keys == sorted(keys)


def test_district_only_in_dropped_rows_has_null_volume(spark):
    # D-12: the district appears only on a row the fact drops (found before 2005)
    m = build(spark, [live(violationid="1"),
                      live(violationid="2", pin="P9", computed_region_9t2m_phkm="7",
                           date_found="2004-06-01")], [], [])
    got = {r.council_district: (r.total_violations, r.median_days_to_resolve)
           for r in m.mart_council_district.collect()}
    assert got["7"] == (None, None)
    assert got["3"][0] == 1


def test_future_resolution_counts_as_resolved(spark):
    # D-13: no upper bound on the resolution date
    m = build(spark, [live(date_resolved="2030-01-01")], [], [])
    r = m.fact_violation.first()
    assert (r.is_resolved, r.days_open) == (True, (dt.date(2030, 1, 1) - dt.date(2020, 1, 2)).days)


def test_violation_key_is_snapshot_scoped(spark):
    # D-4: days_open is part of the row, so an open row's key moves with as_of
    rows = [live(violationid="open"), live(violationid="done", date_resolved="2020-02-01")]
    feeds = build(spark, rows, [], []).raw
    a = {r.violation_id: r.violation_pk for r in Models(feeds, AS_OF).fact_violation.collect()}
    b = {r.violation_id: r.violation_pk
         for r in Models(feeds, dt.date(2021, 6, 1)).fact_violation.collect()}
    assert a["done"] == b["done"] and a["open"] != b["open"]


def test_accepted_values_counts_distinct_values(spark):
    from parcelflow.operators.checks import ColumnTest, failing_rows, test_summary
    df = spark.createDataFrame([("a",), ("x",), ("x",), ("y",), (None,)], "v string")
    t = ColumnTest("m", "v", "accepted_values", values=("a",))
    assert failing_rows(t, df).count() == 2
    s = test_summary(lambda _: df, [t, ColumnTest("m", "v", "not_null")]).collect()
    assert {(r.test, r.failures) for r in s} == {("accepted_values", 2), ("not_null", 1)}


def test_median_by_matches_duckdb(spark):
    import random

    import duckdb

    from parcelflow.operators import median_by
    rnd = random.Random(7)
    rows = [(rnd.choice("abcd"), rnd.choice([None] + list(range(30)))) for _ in range(2000)]
    rows += [("e", None), ("f", 5), ("g", 1), ("g", 2), ("h", 1), ("h", 2), ("h", 3), ("h", 100)]
    df = spark.createDataFrame(rows, "k string, v long")
    con = duckdb.connect()
    con.execute("CREATE TABLE t (k VARCHAR, v BIGINT)")
    con.executemany("INSERT INTO t VALUES (?, ?)", rows)
    for interpolate, fn in ((False, "quantile_disc(v, 0.5)"), (True, "median(v)")):
        got = {r.k: r.m for r in median_by(df, ["k"], "v", "m", interpolate).collect()}
        want = dict(con.execute(f"SELECT k, {fn} FROM t GROUP BY k").fetchall())
        assert got == want


def test_median_in_buckets_matches_duckdb(spark):
    import random

    import duckdb

    from parcelflow.operators import median_in_buckets
    rnd = random.Random(11)
    rows = [(rnd.choice(["a", "b", None]), rnd.choice([None, rnd.gauss(0, 1e6), rnd.random()]))
            for _ in range(3000)]
    rows += [("c", 1e300), ("c", -1e300), ("d", 2.5), ("e", None)] + [("f", 7.0)] * 50 + [("f", 1.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    con = duckdb.connect()
    con.execute("CREATE TABLE t (k VARCHAR, v DOUBLE)")
    con.executemany("INSERT INTO t VALUES (?, ?)", rows)
    for interpolate, fn in ((False, "quantile_disc(v, 0.5)"), (True, "median(v)")):
        got = {r.k: r.m for r in median_in_buckets(df, ["k"], "v", "m", interpolate,
                                                   buckets=8).collect()}
        want = dict(con.execute(f"SELECT k, {fn} FROM t WHERE v IS NOT NULL GROUP BY k").fetchall())
        assert got == want


def test_build_stops_at_a_failed_check(small_models):
    from parcelflow.operators.checks import CheckFailed, build_checks
    from parcelflow.plans import faults

    class Broken:
        def __getattr__(self, name):
            table = getattr(small_models, name)
            return faults.faulty_fact_violation(table) if name == "fact_violation" else table

    report = []
    checks = build_checks(report)
    with pytest.raises(CheckFailed, match="not_null:fact_violation.property_sk"):
        checks(Broken(), "fact_violation")  # values and assertions, with the table
    with pytest.raises(CheckFailed, match="unique:fact_violation.violation_pk"):
        checks.finish(Broken())  # keys, before anything is published
    failed = {name for name, _, n in report if n}
    assert {"unique:fact_violation.violation_pk", "not_null:fact_violation.property_sk",
            "relationships:fact_violation.council_district_sk",
            "assert_no_negative_days_open"} <= failed
