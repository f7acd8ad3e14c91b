"""The model operators applied to the ``events`` table.

The same building blocks as the property models — latest row per key,
JSON scalar extraction with a safe cast, year/month grouping with a
discrete median — on a second source, so each is exercised on its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.functions import safe_double
from parcelflow.operators import anti_join, latest_per_key, median_in_buckets


def latest_event_per_user(events: DataFrame) -> DataFrame:
    """Most recent event per user; ties broken by the larger event id."""
    return latest_per_key(events, ["user_id"], ["ts", "event_id"], ["event_type", "value"])


def event_prop_scalar(events: DataFrame, key: str = "k") -> DataFrame:
    """A scalar at a JSON path of ``props``, cast safely to DOUBLE."""
    return events.select("event_id",
                         safe_double(F.get_json_object("props", f"$.{key}")).alias(f"prop_{key}"))


def events_by_month(events: DataFrame) -> DataFrame:
    """Events per year, month and type with a discrete median value."""
    e = events.select(F.year("ts").cast("bigint").alias("year"),
                      F.month("ts").cast("bigint").alias("month"), "event_type", "value")
    keys = ["year", "month", "event_type"]
    return (e.groupBy(*keys).agg(
                F.count(F.lit(1)).alias("events"),
                F.count_if(F.col("value") > 10).alias("events_over_10"))
            .join(median_in_buckets(e, keys, "value", "median_value"), keys, "left"))


def listed_without_violations(dangerous: DataFrame, rollup: DataFrame) -> DataFrame:
    """Listed properties that have no violation on record."""
    return anti_join(dangerous, rollup, "pin").select(
        "pin", "case_number", "case_opened", "status_of_case", "is_demolition_status")
