"""The stored distribution of days open (D9, D16): what the district, resolution and trend
marts and the live median read in place of the fact (K15, K18, K20, L7).

One row for each month, district, feed, and value: for a resolved violation the days
it took, for an open one the day it was found, whose age the build day gives.  So rows of
further violations merge by adding counts, whatever day they are built on, and a table
of a third of all violations of one district holds no more rows for it than days.
The table is stored by year and ordered by district.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.functions import safe_divide, surrogate_key, year_of
from parcelflow.operators import median_of, value_histogram
from parcelflow.plans.pin_bitmaps import Scope, month_of, on_days, split_range, within

KEYS = ["year", "month", "council_district_sk", "source_system", "is_resolved", "value"]


def days_distribution(fact: DataFrame) -> DataFrame:
    """KEYS and ``violations``: a partial aggregate of six columns of the fact."""
    value = F.when(F.col("is_resolved"), F.col("days_open")).otherwise(
        F.unix_date("date_found").cast("bigint"))
    return fact.select(
        year_of("date_found").alias("year"), month_of("date_found").alias("month"),
        "council_district_sk", "source_system", "is_resolved", value.alias("value")).groupBy(
        *KEYS).agg(F.count(F.lit(1)).alias("violations"))


def merged(*distributions: DataFrame) -> DataFrame:
    """One distribution of several sets of violations."""
    both = distributions[0]
    for more in distributions[1:]:
        both = both.unionByName(more)
    return both.groupBy(*KEYS).agg(F.sum("violations").alias("violations"))


def aged(distribution: DataFrame, as_of: dt.date) -> DataFrame:
    """The distribution with ``days_open`` on a build day, in place of the value."""
    days = F.when(F.col("is_resolved"), F.col("value")).otherwise(
        F.unix_date(F.lit(as_of)).cast("bigint") - F.col("value"))
    return distribution.select("*", days.alias("days_open")).drop("value")


def council_district(distribution: DataFrame, properties: DataFrame, lifecycle: DataFrame,
                     dim_district: DataFrame) -> DataFrame:
    """Volume, properties, escalation and resolution time per district (K15); the
    distinct properties come from the stored bitmaps."""
    key = "council_district_sk"
    h = value_histogram(
        distribution.select(key, "violations",
                            F.when(F.col("is_resolved"), F.col("value")).alias("resolved_days")),
        [key], "resolved_days", weight="violations")
    v = h.groupBy(key).agg(F.sum("_rows").alias("total_violations"),
                           median_of("resolved_days").alias("median_days_to_resolve"))
    lc = lifecycle.groupBy(key).agg(
        F.count_if("ever_dangerous_building").alias("dangerous_building_count"),
        safe_divide(F.count_if("ever_dangerous_building"), F.count(F.lit(1)))
        .alias("pct_escalated_to_dangerous"))
    d = dim_district.select(key, "council_district", "district_label")
    return (d.join(v, key, "left").join(lc, key, "left").join(properties, "council_district", "left")
            .select("council_district", "district_label", "total_violations",
                    "distinct_properties", "dangerous_building_count",
                    "pct_escalated_to_dangerous", "median_days_to_resolve"))


def resolution_time(distribution: DataFrame, dim_district: DataFrame) -> DataFrame:
    """Median and mean days to resolve per year and district, resolved only (K18).  A year
    and district without a resolved violation have NULLs."""
    keys = ["year", "council_district_sk"]
    days = F.when(F.col("is_resolved"), F.col("value"))
    h = value_histogram(distribution.select(*keys, "violations", days.alias("resolved_days")), keys,
                        "resolved_days", {"_days": F.col("resolved_days") * F.col("violations")},
                        weight="violations")
    per = h.groupBy(*keys).agg(
        median_of("resolved_days").alias("median_days_to_resolve"),
        F.try_divide(F.sum("_days").cast("double"), F.sum("_c")).alias("avg_days_to_resolve"))
    d = dim_district.select("council_district_sk", "council_district")
    return per.join(d, "council_district_sk").select(
        "year", "council_district", "median_days_to_resolve", "avg_days_to_resolve")


def violations_trend(distribution: DataFrame, as_of: dt.date) -> DataFrame:
    """Violations, resolved count and median age per year and feed."""
    keys = ["year", "source_system"]
    resolved = F.when(F.col("is_resolved"), F.col("violations")).otherwise(0)
    h = value_histogram(aged(distribution, as_of), keys, "days_open", {"_resolved": resolved},
                        weight="violations")
    return h.groupBy(*keys).agg(
        F.sum("_rows").alias("total_violations"),
        F.sum("_resolved").cast("bigint").alias("resolved_violations"),
        median_of("days_open").alias("median_days_open"))


def live_resolution(distribution: DataFrame, violations: DataFrame, as_of: dt.date,
                    scope: Scope | str | None = None) -> DataFrame:
    """Interpolated median of days open per year (L7) under any scope: whole months off
    the distribution, the odd days at the ends of a date range off the distinct
    violations, of which only those days are read."""
    district, first, last = scope if isinstance(scope, tuple) else (scope, None, None)
    whole, odd = split_range(first, last)
    low, high = whole or (None, None)
    here = F.lit(whole is not None) & within("month", low, high) & within(
        "year", low and low // 100, high and high // 100)
    if district is not None:
        here = here & (F.col("council_district_sk") == surrogate_key(F.lit(district)))
    rows = aged(distribution.where(here), as_of).select("year", "days_open", "violations")
    if odd:
        days = on_days(odd)
        if district is not None:
            days = days & (F.col("council_district") == district)
        rows = rows.unionByName(violations.where(days).select(
            year_of("date_found").alias("year"), "days_open",
            F.lit(1).cast("bigint").alias("violations")))
    return (value_histogram(rows, ["year"], "days_open", weight="violations").groupBy("year")
            .agg(median_of("days_open", interpolate=True).alias("median_days_open")))
