"""

Every registered query reads the given tables through the feed binding
(``parcelflow.sources.testdata``) and runs the whole model chain on Spark;
nothing is sampled or capped except where a top-k is the feature.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow import oracle
from parcelflow.operators import checks
from parcelflow.plans import (
    cleaning, copartitioned, distributions, events, faults, history, pin_bitmaps, serving, staging, tiles,
    top_types, upkeep,
)
from parcelflow.functions import AS_OF_DEFAULT, surrogate_key
from parcelflow.plans.build import Models, TableStore
from parcelflow.session import apply_engine_conf, input_state, scratch_path, stored
from parcelflow.sources import landing, testdata

try:
    import corpus_pipeline
    from parcelflow.llm import registry as llm
except ModuleNotFoundError as missing:  # the driver also tests without these two
    if missing.name not in ("corpus_pipeline", "parcelflow.llm"):
        raise
    llm = None

SMOKE_DIR = "/root/testdata/sf0.001"


_BUILT: dict[tuple, Models] = {}


def models(spark: SparkSession, sf_dir: str) -> Models:
    """The models over the given tables, as the build stores them: a table is
    written when the first query needs it, into the shared folder, and read by
    all later queries of the application over the same input."""
    apply_engine_conf(spark)
    key = (spark.sparkContext.applicationId, sf_dir, input_state(spark, sf_dir))
    if key not in _BUILT:
        store = TableStore(spark, scratch_path(spark, "queries", uuid.uuid4().hex))
        _BUILT[key] = Models(testdata.raw_feeds(spark, sf_dir), AS_OF_DEFAULT, store=store)
    return _BUILT[key]


def _second_drop(spark: SparkSession, sf_dir: str) -> upkeep.SnapshotUpkeep:
    """The states built on an earlier drop and an earlier day, then kept up with the
    given one (K5, K12)."""
    m = models(spark, sf_dir)
    if "upkeep" not in m.__dict__:
        early = AS_OF_DEFAULT - dt.timedelta(days=90)
        live = lambda raw, day: history.reconciled(
            staging.stg_violations_current(raw), day)
        feed = m.raw["npd_violations"]
        first = upkeep.SnapshotUpkeep.start(
            history.reconciled(m.stg_violations_historical, early),
            live(testdata.earlier_live_drop(feed), early), stored)
        m.__dict__["upkeep"] = first.refresh(stored(live(feed, m.as_of), "live-drop"))
    return m.__dict__["upkeep"]


def _snapshot_after_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = models(spark, sf_dir)
    return _second_drop(spark, sf_dir).snapshot(m.int_dangerous_building_by_pin, m.as_of)


def _copartitioned(third_in_one: bool):
    """The wide table off the stored archive and live parts of the fact (C5); or with a
    third of the rows and more under one property."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        m = models(spark, sf_dir)
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        path = scratch_path(spark, "buckets", uuid.uuid4().hex)
        fact = m.fact_rows.drop("date_sk")  # the wide table has the date itself
        if third_in_one:
            fact = fact.withColumn("property_sk", F.when(
                F.col("violation_id").rlike("-[12]$"), surrogate_key(F.lit("UNKNOWN")))
                .otherwise(F.col("property_sk")))
        parts = [copartitioned.StoredFact.write(fact.where(test), f"{path}/{name}", buckets)
                 for name, test in (("archive", "source_system = 'historical'"),
                                    ("live", "source_system <> 'historical'"))]
        attributes = copartitioned.stored_attributes(
            m.dim_property, m.fact_property_lifecycle, f"{path}/attributes", buckets)
        return copartitioned.wide_table(parts, attributes, m.dim_violation_type,
                                        m.dim_council_district)
    return run


MAP_BOX = tiles.Box(south=39.05, west=-94.62, north=39.31, east=-94.405)
MAP_ZOOMS = [4, 7, 10]
MAP_QUERIES = {
    "heatmap_tiles": lambda spark, sf_dir: tiles.heatmap(
        models(spark, sf_dir).point_tiles, MAP_ZOOMS),
    "points_in_box": lambda spark, sf_dir: tiles.in_box(
        models(spark, sf_dir).clustered_points, MAP_BOX).drop("code"),
}


UPKEEP_QUERIES = {
    "wide_off_buckets": _copartitioned(False),
    "wide_off_buckets_hot_property": _copartitioned(True),
    "snapshot_after_refresh": _snapshot_after_refresh,
    "rollup_after_refresh": lambda spark, sf_dir: _second_drop(spark, sf_dir).rollup(AS_OF_DEFAULT),
    "snapshot_changes": lambda spark, sf_dir: _second_drop(spark, sf_dir).change_report(),
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the property funnel, raw feeds → history → rollup → snapshot."""
    return models(spark, SMOKE_DIR).mart_blight_funnel


# Models registered under their own name.
MODEL_QUERIES = [
    "stg_violations_current", "stg_violations_historical", "stg_dangerous_buildings",
    "int_violations_unioned", "int_property_rollup", "int_dangerous_building_by_pin",
    "dim_property", "dim_council_district", "dim_violation_type",
    "fact_violation", "fact_property_lifecycle",
    "mart_blight_funnel", "mart_blight_hotspots", "mart_council_district", "mart_dashboard",
    "mart_property_points", "mart_resolution_time", "mart_top_violation_types",
    "mart_violations_trend", "adhoc_repeat_offenders", "calendar_violations",
]


def _model_query(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return getattr(models(spark, sf_dir), name)
    run.__name__ = name
    return run


# Live dashboard metrics (L1-L9): key -> (serving function, oracle kind, scope).
RANGE = (dt.date(2006, 1, 1), dt.date(2008, 6, 30))
DASHBOARD_QUERIES = {
    "dashboard_funnel": (serving.live_funnel, "funnel", None),
    "dashboard_funnel_district_3": (serving.live_funnel, "funnel", "3"),
    "dashboard_kpis": (serving.live_kpis, "kpis", None),
    "dashboard_kpis_district_2": (serving.live_kpis, "kpis", "2"),
    "dashboard_trend": (serving.live_trend, "trend", None),
    "dashboard_top_types": (serving.live_top_types, "top_types", None),
    "dashboard_resolution": (serving.live_resolution, "resolution", None),
    "dashboard_heatmap": (serving.live_heatmap, "heatmap", None),
    "dashboard_stages": (serving.live_stage_distribution, "stages", None),
    "dashboard_stages_district_5": (serving.live_stage_distribution, "stages", "5"),
    "dashboard_kpis_2006_to_2008": (serving.live_kpis, "kpis", (None, *RANGE)),
    "dashboard_trend_district_4_2006_to_2008": (serving.live_trend, "trend", ("4", *RANGE)),
}

# Metrics off the stored serving tables (pin bitmaps, distribution): key -> (function,
# oracle kind, scope).  The last range begins and ends inside a month.
ODD_RANGE = (dt.date(2006, 3, 17), dt.date(2008, 6, 11))
SHORT_RANGE = (dt.date(2007, 2, 10), dt.date(2007, 3, 20))
STORED_QUERIES = {
    "stored_funnel": (pin_bitmaps.funnel, "funnel", None),
    "stored_funnel_district_3": (pin_bitmaps.funnel, "funnel", "3"),
    "stored_kpis": (pin_bitmaps.kpis, "kpis", None),
    "stored_kpis_2006_to_2008": (pin_bitmaps.kpis, "kpis", (None, *RANGE)),
    "stored_kpis_district_2_odd_days": (pin_bitmaps.kpis, "kpis", ("2", *ODD_RANGE)),
    "stored_funnel_odd_days": (pin_bitmaps.funnel, "funnel", (None, *ODD_RANGE)),
    "stored_funnel_no_whole_month": (pin_bitmaps.funnel, "funnel", (None, *SHORT_RANGE)),
    "stored_stages": (pin_bitmaps.stage_distribution, "stages", None),
    "stored_stages_district_5": (pin_bitmaps.stage_distribution, "stages", "5"),
    "stored_top_types": (top_types.top_types, "top_types", None),
    "stored_top_types_district_3": (top_types.top_types, "top_types", "3"),
    "stored_top_types_odd_days": (top_types.top_types, "top_types", (None, *ODD_RANGE)),
    "stored_resolution": (distributions.live_resolution, "resolution", None),
    "stored_resolution_district_4_odd_days": (distributions.live_resolution, "resolution",
                                              ("4", *ODD_RANGE)),
}

# Generic column tests, grouped by layer (Q1-Q4).
TEST_GROUPS = {
    "dq_staging": ["stg_violations_current", "stg_violations_historical",
                   "stg_dangerous_buildings"],
    "dq_dimensions": ["dim_property", "dim_council_district", "dim_violation_type", "dim_date"],
    "dq_facts": ["fact_violation", "fact_property_lifecycle"],
    "dq_marts": ["mart_blight_funnel", "mart_council_district", "mart_top_violation_types",
                 "mart_property_points", "mart_dashboard"],
}

# Singular assertions (Q5-Q7): key -> (model, oracle WHERE clause).
SINGULAR_WHERE = {
    "assert_no_negative_days_open": "days_open < 0",
    "assert_resolved_after_found": ("date_resolved IS NOT NULL AND date_found IS NOT NULL "
                                    "AND date_resolved < date_found"),
    "assert_dangerous_after_first_violation": (
        "dangerous_building_date IS NOT NULL AND first_violation_date IS NOT NULL "
        "AND dangerous_building_date < first_violation_date"),
}


def _dashboard_query(fn, scope):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(models(spark, sf_dir).mart_dashboard, scope)
    return run


def _stored_query(fn, scope):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        m = models(spark, sf_dir)
        if fn is distributions.live_resolution:
            return fn(m.days_distribution, m.distinct_violations, m.as_of, scope)
        if fn is top_types.top_types:
            return fn(m.type_cells, m.labelled_violations, scope, first_depth=4).rows
        return fn(m.pin_sets, scope)
    return run


def _scorecards(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = models(spark, sf_dir)
    return serving.scorecards(m.mart_blight_funnel, m.mart_council_district)


def _test_group(names):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        m = models(spark, sf_dir)
        return checks.test_summary(lambda n: getattr(m, n), models=names)
    return run


def _singular(key):
    model_name, fn, _ = checks.SINGULAR[key]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(getattr(models(spark, sf_dir), model_name))
    return run


def _land_all_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing (A2-A6) on the live feed derived from the given tables.

    The feed is written as NDJSON (NULL fields are omitted, so keys vary by
    record; the district key carries its raw ``:@`` spelling), then landed
    back as an all-text table by the two-pass reader.
    """
    apply_engine_conf(spark)
    return landing.read_all_text(spark, _write_feed(spark, sf_dir))


#: Lines of one file of a written feed: its text is packed, and a packed file has one reader.
FEED_LINES = 500_000


def _write_feed(spark: SparkSession, sf_dir: str) -> str:
    feed = models(spark, sf_dir).raw["npd_violations"].withColumnRenamed(
        "computed_region_9t2m_phkm", ":@computed_region_9t2m_phkm")
    path = scratch_path(spark, "landing", uuid.uuid4().hex)
    (feed.select(*[F.col(f"`{c}`") for c in feed.columns]).write
     .option("maxRecordsPerFile", FEED_LINES).json(path, compression="lz4"))
    return path


def _land_registry_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registry lands a live and a frozen feed, then refreshes: the live
    table is replaced, not appended to, the frozen one is left out (A7-A9)."""
    apply_engine_conf(spark)
    path, root = _write_feed(spark, sf_dir), scratch_path(spark, "raw", uuid.uuid4().hex)
    feeds = [landing.Feed("npd_violations", path), landing.Feed("archive", path, "frozen")]
    landing.land_registry(spark, feeds, root, include_frozen=True)
    return landing.land_registry(spark, feeds, root)["npd_violations"]


def _marts_presented(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored district mart in display order, with its place."""
    return serving.with_place("mart_council_district",
                              models(spark, sf_dir).mart_council_district)


def _events_query(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        apply_engine_conf(spark)
        return fn(testdata.read_table(spark, sf_dir, "events"))
    return run


def _listed_without_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = models(spark, sf_dir)
    return events.listed_without_violations(m.stg_dangerous_buildings, m.int_property_rollup)


def _cleaning(kind):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        apply_engine_conf(spark)
        raw = models(spark, sf_dir).raw
        if kind == "ordinance_codes":
            return cleaning.ordinance_codes(raw["npd_violations"], raw["historical_violations"])
        if kind == "numeric_texts":
            return cleaning.numeric_texts(testdata.read_table(spark, sf_dir, "part"))
        if kind == "point_coordinates":
            return cleaning.point_coordinates_of(raw["npd_violations"],
                                                 raw["dangerous_buildings"])
        return cleaning.date_texts(raw["npd_violations"], raw["historical_violations"])
    return run


EVENT_QUERIES = {
    "latest_event_per_user": events.latest_event_per_user,
    "event_prop_scalar": events.event_prop_scalar,
    "events_by_month": events.events_by_month,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out: dict[str, Callable[[SparkSession, str], DataFrame]] = {
        name: _model_query(name) for name in MODEL_QUERIES}
    for key, (fn, _, scope) in DASHBOARD_QUERIES.items():
        out[key] = _dashboard_query(fn, scope)
    for key, (fn, _, scope) in STORED_QUERIES.items():
        out[key] = _stored_query(fn, scope)
    out["dashboard_scorecards"] = _scorecards
    for key, names in TEST_GROUPS.items():
        out[key] = _test_group(names)
    for key in SINGULAR_WHERE:
        out[key] = _singular(key)
    out["dq_faults"] = lambda spark, sf_dir: faults.fault_summary(models(spark, sf_dir))
    out["land_all_text"] = _land_all_text
    out["land_registry_twice"] = _land_registry_twice
    out["numeric_texts"] = _cleaning("numeric_texts")
    out["marts_presented"] = _marts_presented
    out |= UPKEEP_QUERIES | MAP_QUERIES
    for key, fn in EVENT_QUERIES.items():
        out[key] = _events_query(fn)
    out["listed_without_violations"] = _listed_without_violations
    for key in ("ordinance_codes", "point_coordinates", "date_texts"):
        out[key] = _cleaning(key)
    if llm:
        out |= llm.QUERIES | {"pipeline": corpus_pipeline.run}
    return out


def oracle_sql() -> dict[str, str]:
    out = {name: oracle.sql_for(name) for name in MODEL_QUERIES if name in oracle.MODELS}
    out["calendar_violations"] = oracle.calendar_violations_sql()
    for key, (_, kind, scope) in DASHBOARD_QUERIES.items():
        out[key] = oracle.live_sql(kind, scope)
    for key, (_, kind, scope) in STORED_QUERIES.items():
        out[key] = oracle.live_sql(kind, scope)
    out["dashboard_scorecards"] = oracle.scorecards_sql()
    for key, names in TEST_GROUPS.items():
        out[key] = oracle.test_summary_sql([t for t in checks.COLUMN_TESTS if t.model in names])
    for key, where in SINGULAR_WHERE.items():
        out[key] = oracle.singular_sql(checks.SINGULAR[key][0], where)
    out["dq_faults"] = oracle.faults_sql()
    out["land_all_text"] = oracle.sql_for("npd_violations")
    out["land_registry_twice"] = oracle.sql_for("npd_violations")
    out["marts_presented"] = oracle.presented_sql()
    out["snapshot_after_refresh"] = oracle.sql_for("fact_property_lifecycle")
    out["rollup_after_refresh"] = oracle.sql_for("int_property_rollup")
    out["heatmap_tiles"] = oracle.heatmap_tiles_sql(MAP_ZOOMS)
    out["points_in_box"] = oracle.points_in_box_sql(MAP_BOX)
    out["wide_off_buckets"] = oracle.sql_for("mart_dashboard")
    out["wide_off_buckets_hot_property"] = oracle.hot_property_sql()
    out["snapshot_changes"] = oracle.snapshot_changes_sql()
    out.update(oracle.EVENTS_SQL)
    out["listed_without_violations"] = oracle.listed_without_violations_sql()
    out.update(oracle.CLEANING_SQL)
    if llm:
        out |= llm.ORACLE_SQL
        if corpus_pipeline.ORACLE_SQL:
            out["pipeline"] = corpus_pipeline.ORACLE_SQL
    return out
