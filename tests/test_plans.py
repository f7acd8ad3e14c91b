"""Plan-shape guards: the properties the design relies on at scale."""

import datetime as dt

from parcelflow.functions import AS_OF_DEFAULT
from parcelflow.plans import dims, distributions, facts, history, marts, pin_bitmaps, serving


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_fact_date_window_reaches_the_scan(small_models):
    p = plan_of(facts.fact_violation(small_models.int_violations_unioned, AS_OF_DEFAULT))
    assert "PushedFilters: [IsNotNull(date_found), GreaterThanOrEqual(date_found" in p


def test_no_window_no_cartesian(small_models):
    # "row number 1 per key" must be a partial aggregate, never a window sort
    m = small_models  # stored inputs; each model below is planned from them
    for df in (history.int_property_rollup(m.int_violations_unioned),
               dims.dim_violation_type(m.int_violations_unioned, m.violation_labels),
               m.stg_dangerous_buildings,
               marts.mart_dashboard(m.fact_violation, m.dim_violation_type,
                                    m.dim_council_district, m.dim_property,
                                    m.fact_property_lifecycle),
               marts.mart_top_violation_types(m.fact_violation, m.dim_violation_type)):
        p = plan_of(df)
        assert "Window" not in p
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_medians_use_the_stored_distribution(small_models):
    # no fact scan; the only window is over the (key, value) histogram
    m = small_models
    for df in (distributions.council_district(
                   m.days_distribution, m.pin_sets.by_district(), m.fact_property_lifecycle,
                   m.dim_council_district),
               distributions.resolution_time(m.days_distribution, m.dim_council_district),
               distributions.violations_trend(m.days_distribution, AS_OF_DEFAULT)):
        p = plan_of(df)
        assert "percentile_disc" not in p and "violation_pk" not in p
        assert "Window [sum(_c#" in p and "fact_violation" not in p


def test_bitmaps_read_whole_months_and_only_the_odd_days(small_models):
    m = small_models
    months, odd = m.pin_sets.parts(("3", dt.date(2006, 3, 17), dt.date(2008, 6, 11)))
    assert "(month#" in (p := plan_of(months)) and ">= 200604" in p and "<= 200805" in p
    assert sorted({r.month for r in odd.select("month").distinct().collect()}) == [200603, 200806]
    assert "mart_dashboard" not in plan_of(pin_bitmaps.funnel(m.pin_sets))
    assert m.pin_sets.parts((None, dt.date(2006, 3, 1), dt.date(2008, 5, 31)))[1] is None


def test_dashboard_is_salted_and_broadcasts_only_the_hot_keys(small_models):
    m = small_models
    wide = marts.mart_dashboard(m.fact_violation, m.dim_violation_type, m.dim_council_district,
                                m.dim_property, m.fact_property_lifecycle)
    logical = wide._jdf.queryExecution().optimizedPlan().toString()
    assert "xxhash64(violation_pk" in logical
    hints = [x for x in logical.splitlines() if "strategy=broadcast" in x]
    assert hints and all("Join LeftOuter, (property_sk" in x for x in hints)
    assert len(hints) == 2  # the hot keys, at either side


def test_fact_shuffles_only_its_output_columns(small_models):
    p = plan_of(facts.fact_violation(small_models.int_violations_unioned, AS_OF_DEFAULT))
    exchange = next(x for x in p.splitlines() if "Exchange hashpartitioning" in x)
    assert "violation_pk" in exchange and "street_address" not in exchange


def test_hotspots_take_top_k_before_joining(small_models):
    m = small_models
    p = plan_of(marts.mart_blight_hotspots(m.fact_property_lifecycle, m.dim_property))
    assert "TakeOrderedAndProject(limit=200" in p
    assert "SortMergeJoin" not in p  # the 200 rows are broadcast, dim_property is not shuffled


def test_scope_reaches_the_stored_wide_table(small_models):
    scope = ("3", dt.date(2006, 1, 1), dt.date(2007, 6, 30))
    p = plan_of(serving.live_kpis(small_models.mart_dashboard, scope))
    assert "EqualTo(council_district,3)" in p
    assert "PartitionFilters: [isnotnull(year" in p
