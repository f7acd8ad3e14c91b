"""Staging: type and clean each raw all-text feed (K1-K3)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.functions import (
    clean_trim, coord_at, normalize_code, null_as, point_coordinates, safe_date,
    safe_double,
)
from parcelflow.functions.columns import DEMOLITION_WORDS
from parcelflow.operators import latest_per_key

CURRENT_RAW = ["violationid", "casenumber", "pin", "street_address", "full_address",
               "postalcode", "computed_region_9t2m_phkm", "incident_location",
               "chapter", "ordinance", "description", "date_found", "date_to_comply",
               "date_resolved", "vio_status", "case_status"]
HISTORICAL_RAW = ["id", "case_id", "pin", "address", "zip_code", "council_district",
                  "neighborhood", "latitude", "longitude", "chapter", "ordinance",
                  "violation_description", "violation_entry_date", "case_opened",
                  "case_closed", "status"]
DANGEROUS_RAW = ["pin", "casenumber", "address", "location", "zip_code",
                 "council_district", "case_location", "case_opened", "statusofcase"]


def conform_raw(raw: DataFrame, needed: Iterable[str]) -> DataFrame:
    """Add any read column a feed never carried as a NULL text column.

    A landed table only has the keys some record had; a feed that stops
    sending a field must not break staging.
    """
    have = set(raw.columns)
    missing = [c for c in needed if c not in have]
    return raw.select("*", *[null_as("string").alias(c) for c in missing]) if missing else raw


def stg_violations_current(raw: DataFrame) -> DataFrame:
    """Live feed conformed to the unified shape (K1)."""
    # The point is parsed once, in its own projection (Catalyst keeps a
    # non-trivial expression from being duplicated into both coordinates).
    r = conform_raw(raw, CURRENT_RAW).withColumn("_coords", point_coordinates("incident_location"))
    resolved = safe_date("date_resolved")
    return r.where(F.col("violationid").isNotNull()).select(
        F.col("violationid").cast("string").alias("violation_id"),
        F.col("casenumber").cast("string").alias("case_number"),
        clean_trim("pin").alias("pin"),
        F.lit("energov").alias("source_system"),
        F.col("street_address"),
        F.col("full_address"),
        F.col("postalcode").alias("zip_code"),
        clean_trim("computed_region_9t2m_phkm").alias("council_district"),
        null_as("string").alias("neighborhood"),
        coord_at("_coords", 1).alias("latitude"),
        coord_at("_coords", 0).alias("longitude"),
        F.col("chapter"),
        F.col("ordinance"),
        normalize_code("ordinance").alias("violation_code"),
        F.col("description").alias("violation_description"),
        safe_date("date_found").alias("date_found"),
        safe_date("date_to_comply").alias("date_to_comply"),
        resolved.alias("date_resolved"),
        F.coalesce("vio_status", "case_status").alias("status_raw"),
        resolved.isNotNull().alias("is_resolved"),
    )


def stg_violations_historical(raw: DataFrame) -> DataFrame:
    """Archive feed conformed to the unified shape (K2)."""
    r = conform_raw(raw, HISTORICAL_RAW)
    closed = safe_date("case_closed")
    return r.where(F.col("id").isNotNull()).select(
        F.col("id").cast("string").alias("violation_id"),
        F.col("case_id").cast("string").alias("case_number"),
        clean_trim("pin").alias("pin"),
        F.lit("historical").alias("source_system"),
        F.col("address").alias("street_address"),
        F.col("address").alias("full_address"),
        F.col("zip_code"),
        clean_trim("council_district").alias("council_district"),
        F.col("neighborhood"),
        safe_double("latitude").alias("latitude"),
        safe_double("longitude").alias("longitude"),
        F.col("chapter"),
        F.col("ordinance"),
        normalize_code("ordinance").alias("violation_code"),
        F.col("violation_description"),
        F.coalesce(safe_date("violation_entry_date"), safe_date("case_opened")).alias("date_found"),
        null_as("date").alias("date_to_comply"),
        closed.alias("date_resolved"),
        F.col("status").alias("status_raw"),
        (closed.isNotNull() | (F.lower("status") == "closed")).alias("is_resolved"),
    )


def stg_dangerous_buildings(raw: DataFrame) -> DataFrame:
    """The dangerous-building list, newest listing per pin.

    Newest = latest ``case_opened``, then the larger case number as text;
    the remaining columns close the order so the pick is deterministic.
    """
    r = conform_raw(raw, DANGEROUS_RAW).withColumn("_coords", point_coordinates("case_location"))
    pin = clean_trim("pin")
    typed = r.where(F.col("pin").isNotNull() & (pin != "")).select(
        pin.alias("pin"),
        F.col("casenumber").cast("string").alias("case_number"),
        F.col("address").alias("street_address"),
        F.col("location").alias("full_address"),
        F.col("zip_code"),
        clean_trim("council_district").alias("council_district"),
        coord_at("_coords", 1).alias("latitude"),
        coord_at("_coords", 0).alias("longitude"),
        safe_date("case_opened").alias("case_opened"),
        F.col("statusofcase").alias("status_of_case"),
    )
    newest = latest_per_key(
        typed, ["pin"],
        order_cols=["case_opened", "case_number", "street_address", "full_address",
                    "zip_code", "council_district", "latitude", "longitude", "status_of_case"],
        value_cols=[])
    status = F.lower("status_of_case")
    demolition = None
    for word in DEMOLITION_WORDS:
        hit = status.contains(word)
        demolition = hit if demolition is None else (demolition | hit)
    return newest.select(
        "pin", "case_number", "street_address", "full_address", "zip_code",
        "council_district", null_as("string").alias("neighborhood"), "latitude",
        "longitude", "case_opened", "status_of_case",
        demolition.alias("is_demolition_status"),
    )


__all__ = ["conform_raw",
           "stg_violations_current", "stg_violations_historical", "stg_dangerous_buildings"]
