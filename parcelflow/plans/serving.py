"""Live dashboard metrics on the wide table.

Each takes ``mart_dashboard`` and a scope: a council district, or a triple of
district, first and last day, each of which may be None.  The filter is applied
before aggregating and reaches the Parquet scan of the stored wide table.

Distinct-pin counts are computed by first reducing to one row per pin (a
partial aggregate keyed by pin), then counting flags: one shuffle instead of
the row expansion Spark uses for several COUNT DISTINCTs in one aggregate.
A pin counts for a flag when any of its rows has the flag, exactly as
``COUNT(DISTINCT IF(flag, pin, NULL))``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelflow.functions import safe_divide
from parcelflow.operators import median_by, top_k, unpivot


Scope = tuple[str | None, dt.date | None, dt.date | None]


def scoped(wide: DataFrame, scope: Scope | str | None) -> DataFrame:
    """The rows of a district and of a date range (first and last day, both
    included); either may be open.  A date bound also bounds the year, the
    directory column of the stored table."""
    district, first, last = scope if isinstance(scope, tuple) else (scope, None, None)
    if district is not None:
        wide = wide.where(F.col("council_district") == district)
    if first is not None:
        wide = wide.where((F.col("date_found") >= F.lit(first)) & (F.col("year") >= first.year))
    if last is not None:
        wide = wide.where((F.col("date_found") <= F.lit(last)) & (F.col("year") <= last.year))
    return wide


def _per_pin(wide: DataFrame) -> DataFrame:
    return wide.groupBy("pin").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.max(F.col("total_violations") >= 2).alias("is_repeat"),
        F.max("ever_dangerous_building").alias("is_dangerous"),
        F.max(F.col("current_stage") == "demolition").alias("is_demolition"),
    )


def live_funnel(wide: DataFrame, scope: Scope | str | None = None) -> DataFrame:
    """Cumulative funnel as four distinct-pin counts (L1)."""
    p = _per_pin(scoped(wide, scope)).where(F.col("pin").isNotNull())
    t = p.agg(F.count(F.lit(1)).alias("a"), F.count_if("is_repeat").alias("r"),
              F.count_if("is_dangerous").alias("d"), F.count_if("is_demolition").alias("m"))
    rows = [[F.lit(i + 1).cast("bigint"), F.lit(s), F.col(c)] for i, (s, c) in enumerate(
        [("Any violation", "a"), ("Repeat violations", "r"), ("Dangerous building", "d"),
         ("Demolition", "m")])]
    return unpivot(t, rows, ["stage_order", "stage", "property_count"])


def live_kpis(wide: DataFrame, scope: Scope | str | None = None) -> DataFrame:
    """Properties, share escalated, total violations (L2, L3, L4) in one pass."""
    p = _per_pin(scoped(wide, scope))
    has_pin = F.col("pin").isNotNull()
    return p.agg(
        F.count_if(has_pin).alias("properties"),
        safe_divide(F.count_if(has_pin & F.col("is_dangerous")), F.count_if(has_pin))
        .alias("pct_escalated"),
        F.coalesce(F.sum("n_rows"), F.lit(0)).cast("bigint").alias("total_violations"),
    )


def live_trend(wide: DataFrame, scope: Scope | str | None = None) -> DataFrame:
    """Violations per year."""
    return scoped(wide, scope).groupBy("year").agg(F.count(F.lit(1)).alias("violations"))


def live_top_types(wide: DataFrame, scope: Scope | str | None = None, n: int = 20) -> DataFrame:
    """Most frequent short labels."""
    c = scoped(wide, scope).groupBy("short_label").agg(F.count(F.lit(1)).alias("violations"))
    return top_k(c, n, [F.col("violations").desc(), F.col("short_label").asc_nulls_first()])


def live_resolution(wide: DataFrame, scope: Scope | str | None = None) -> DataFrame:
    """Interpolated median of days open per year, all rows."""
    w = scoped(wide, scope).select("year", "days_open")
    return median_by(w, ["year"], "days_open", "median_days_open", interpolate=True)


def live_heatmap(wide: DataFrame, scope: Scope | str | None = None) -> DataFrame:
    """Violation count and distinct properties per point."""
    w = scoped(wide, scope)
    per = w.groupBy("lat_lng", "pin").agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy("lat_lng").agg(
        F.sum("n").cast("bigint").alias("violations"),
        F.count_if(F.col("pin").isNotNull()).alias("properties"))


def live_stage_distribution(wide: DataFrame, scope: Scope | str | None = None) -> DataFrame:
    """Distinct properties per current stage, mutually exclusive."""
    w = scoped(wide, scope).where(F.col("pin").isNotNull())
    return (w.select("current_stage", "pin").distinct()
            .groupBy("current_stage").agg(F.count(F.lit(1)).alias("properties")))


def scorecards(funnel: DataFrame, council: DataFrame) -> DataFrame:
    """Headline numbers read off the narrow marts."""
    f = funnel.agg(
        F.max(F.when(F.col("stage_order") == 1, F.col("property_count"))).alias("properties_cited"),
        F.max(F.when(F.col("stage") == "Repeat violations",
                     F.col("pct_of_violation_properties"))).alias("repeat_rate"),
        F.max(F.when(F.col("stage") == "Dangerous building",
                     F.col("pct_of_violation_properties"))).alias("pct_escalated"))
    c = council.agg(F.sum("total_violations").cast("bigint").alias("total_violations"))
    return _one_row_pair(f, c)


def _one_row_pair(a: DataFrame, b: DataFrame) -> DataFrame:
    """Side by side columns of two one-row aggregates (scalar subquery)."""
    return a.select("*", *[b.select(c).scalar().alias(c) for c in b.columns])


# Presentation order of the stored marts (F4): applied when a mart is read for
# display, not before writing it, so no range shuffle is spent on storage.
# Column and direction.
PRESENTATION_ORDER = {
    "mart_council_district": [("total_violations", "desc nulls last"), ("council_district", "asc")],
    "mart_resolution_time": [("year", "asc"), ("council_district", "asc")],
    "mart_violations_trend": [("year", "asc"), ("source_system", "asc")],
    "mart_blight_funnel": [("stage_order", "asc")],
    "mart_blight_hotspots": [("total_violations", "desc"), ("pin", "asc")],
    "mart_top_violation_types": [("violation_count", "desc"), ("violation_code", "asc")],
}
DIRECTIONS = {"asc": F.asc, "desc": F.desc, "desc nulls last": F.desc_nulls_last}


def display_order(name: str) -> list[Column]:
    return [DIRECTIONS[direction](column)
            for column, direction in PRESENTATION_ORDER.get(name, [])]


def presented(name: str, mart: DataFrame) -> DataFrame:
    """A stored mart in its display order."""
    order = display_order(name)
    return mart.orderBy(*order) if order else mart


def with_place(name: str, mart: DataFrame) -> DataFrame:
    """A mart with ``place``, the row's position in the display order.  For the
    narrow marts only: their rows are as few as districts, years and codes."""
    order = Window.orderBy(*display_order(name))
    return mart.withColumn("place", F.row_number().over(order).cast("bigint"))
