"""Intermediate models: one violation history, per-property rollup (K4-K6)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.functions import days_between

HISTORY_COLUMNS = [
    "violation_id", "case_number", "pin", "source_system", "street_address",
    "full_address", "zip_code", "council_district", "neighborhood", "latitude",
    "longitude", "chapter", "ordinance", "violation_code", "violation_description",
    "date_found", "date_to_comply", "status_raw", "date_resolved", "is_resolved",
    "days_open",
]


def int_violations_unioned(current: DataFrame, historical: DataFrame,
                           as_of: dt.date) -> DataFrame:
    """Both feeds stacked, resolutions before the found date nulled, aged (K4).

    ``as_of`` stands in for the build day.  ``is_resolved`` is recomputed
    from the dates alone and is NULL when the found date is unknown.
    """
    return reconciled(current.unionByName(historical), as_of)


def reconciled(u: DataFrame, as_of: dt.date) -> DataFrame:
    """Rows of one or more feeds as the history has them."""
    found, res = F.col("date_found"), F.col("date_resolved")
    valid = res >= found
    keep = [c for c in u.columns if c not in ("date_resolved", "is_resolved")]
    cleaned = u.select(*keep, F.when(valid, res).alias("date_resolved"),
                       (res.isNotNull() & valid).alias("is_resolved"))
    return cleaned.withColumn(
        "days_open", days_between("date_found", F.coalesce("date_resolved", F.lit(as_of))))


ROLLUP_COLUMNS = [
    "pin", "first_violation_date", "last_violation_date", "total_violations",
    "distinct_violation_types", "resolved_violations", "avg_days_open",
    "street_address", "full_address", "zip_code", "council_district",
    "neighborhood", "latitude", "longitude",
]
_RECENT_ATTRS = ["street_address", "full_address", "zip_code", "council_district",
                 "latitude", "longitude"]


def int_property_rollup(history: DataFrame) -> DataFrame:
    """One row per pin: milestones, counters, most recent attributes (K5).

    One partial aggregate, so a hot pin is reduced on the map side, and one
    exchange of one row for each pin of a map task.  The most recent row is a max
    over (date_found, source_system, violation_id, attrs).  The codes of a pin are a
    set, bounded by the ordinance codes; counting them as (pin, code) rows would take
    two more exchanges, of nearly as many rows as violations.
    """
    base = history.where(F.col("pin").isNotNull() & (F.col("pin") != ""))
    order = ["date_found", "source_system", "violation_id", *_RECENT_ATTRS]
    rollup = base.groupBy("pin").agg(
        F.min("date_found").alias("first_violation_date"),
        F.max("date_found").alias("last_violation_date"),
        F.count(F.lit(1)).alias("total_violations"),
        F.size(F.collect_set("violation_code")).cast("bigint").alias("distinct_violation_types"),
        F.count_if("is_resolved").alias("resolved_violations"),
        F.avg("days_open").alias("avg_days_open"),
        F.max("neighborhood").alias("neighborhood"),
        F.max(F.struct(*order)).alias("_recent"),
    )
    return rollup.select(
        *[F.col(f"_recent.{c}").alias(c) if c in _RECENT_ATTRS else F.col(c)
          for c in ROLLUP_COLUMNS])


def int_dangerous_building_by_pin(dangerous: DataFrame) -> DataFrame:
    """The listing milestone per pin (K6)."""
    return dangerous.select(
        "pin", F.col("case_opened").alias("dangerous_building_date"),
        "status_of_case", "is_demolition_status")
