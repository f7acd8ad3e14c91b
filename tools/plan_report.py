"""Physical-plan summary of every model, built on stored upstream tables.

For each model: shuffles (Exchange hashpartitioning / rangepartitioning /
round-robin), broadcasts, aggregate operators, sorts, joins, and whether a
filter reaches a scan.  Pass the folder of a target that ``parcelflow build``
wrote.

    python tools/plan_report.py ROOT/TARGET
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

COUNTED = {
    "shuffles": r"Exchange (hashpartitioning|rangepartitioning|RoundRobinPartitioning|SinglePartition)",
    "broadcasts": r"BroadcastExchange",
    "hash_aggs": r"\bHashAggregate\(",
    "object_hash_aggs": r"ObjectHashAggregate\(",
    "sort_aggs": r"SortAggregate\(",
    "sorts": r"\+- Sort \[|^Sort \[",
    "smj": r"SortMergeJoin",
    "bhj": r"BroadcastHashJoin",
    "pushed_filter_scans": r"PushedFilters: \[[^\]]",
}


def main() -> None:
    from parcelflow.functions import AS_OF_DEFAULT
    from parcelflow.plans import dims, distributions, facts, history, marts, pin_bitmaps
    from parcelflow.plans import tiles, top_types
    from parcelflow.session import local_session
    from parcelflow.sources.publish import Published

    if len(sys.argv) != 2:
        sys.exit("usage: plan_report.py ROOT/TARGET  (a folder that `parcelflow build` wrote)")
    spark = local_session(8, 16, app="plan-report")
    published = Published(spark, sys.argv[1])
    manifest = published.manifest()

    def t(name):
        return published.read(name, manifest)

    def sets():
        return pin_bitmaps.PinSets(t("pin_months"), t("pin_days"), t("pin_flags"))

    built = {
        "int_property_rollup": lambda: history.int_property_rollup(t("int_violations_unioned")),
        "dim_council_district": lambda: dims.dim_council_district(t("int_violations_unioned")),
        "fact_violation": lambda: facts.fact_violation(t("int_violations_unioned"), AS_OF_DEFAULT),
        "mart_blight_funnel": lambda: marts.mart_blight_funnel(t("fact_property_lifecycle")),
        "mart_blight_hotspots": lambda: marts.mart_blight_hotspots(
            t("fact_property_lifecycle"), t("dim_property")),
        "days_distribution": lambda: distributions.days_distribution(
            facts.fact_rows(t("distinct_violations"))),
        "mart_council_district": lambda: distributions.council_district(
            t("days_distribution"), sets().by_district(), t("fact_property_lifecycle"),
            t("dim_council_district")),
        "mart_dashboard": lambda: marts.mart_dashboard(
            t("fact_violation"), t("dim_violation_type"), t("dim_council_district"),
            t("dim_property"), t("fact_property_lifecycle")),
        "mart_property_points": lambda: marts.mart_property_points(
            t("fact_property_lifecycle"), t("dim_property")),
        "mart_resolution_time": lambda: distributions.resolution_time(
            t("days_distribution"), t("dim_council_district")),
        "mart_top_violation_types": lambda: marts.mart_top_violation_types(
            t("fact_violation"), t("dim_violation_type")),
        "mart_violations_trend": lambda: distributions.violations_trend(
            t("days_distribution"), AS_OF_DEFAULT),
        "pin_numbers": lambda: pin_bitmaps.pin_numbers(
            t("dim_property"), t("fact_property_lifecycle")),
        "pin_days": lambda: pin_bitmaps.pin_days(t("distinct_violations"), t("pin_numbers")),
        "pin_months": lambda: pin_bitmaps.pin_months(t("pin_days")),
        "type_cells": lambda: top_types.type_cells(t("mart_dashboard")),
        "point_tiles": lambda: tiles.tile_rollup(tiles.clustered_points(t("mart_property_points"))),
        "stored funnel": lambda: pin_bitmaps.funnel(sets(), "3"),
    }
    print(f"{'model':28s} " + " ".join(f"{k:>10s}" for k in COUNTED))
    for name, make in built.items():
        plan = make()._jdf.queryExecution().executedPlan().toString()
        counts = [len(re.findall(p, plan, flags=re.M)) for p in COUNTED.values()]
        print(f"{name:28s} " + " ".join(f"{c:>10d}" for c in counts))
    spark.stop()


if __name__ == "__main__":
    main()
