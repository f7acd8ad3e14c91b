"""Facts: violation transactions and the per-property accumulating snapshot."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.functions import SPINE_START, days_between, row_hash, surrogate_key
from parcelflow.plans.history import HISTORY_COLUMNS


def unknown_if_blank(c: str) -> F.Column:
    return F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit("UNKNOWN"))


def fact_violation(history: DataFrame, as_of: dt.date,
                   start: dt.date = SPINE_START) -> DataFrame:
    """One row per distinct violation record found in [start, as_of]."""
    return fact_rows(distinct_violations(history, as_of, start))


def distinct_violations(history: DataFrame, as_of: dt.date,
                        start: dt.date = SPINE_START) -> DataFrame:
    """The fact's rows before their keys are hashed.

    ``violation_pk`` is a hash of the whole row, so equal rows have equal output rows:
    the hash is taken first, and only the 10 columns here are compared and
    shuffled, not the 21 columns of the history.  What the other keys are hashed from is
    shorter than they are, and this one's 16 bytes than its 32 digits.
    """
    return violation_rows(history, as_of, start).distinct()


def violation_rows(history: DataFrame, as_of: dt.date,
                   start: dt.date = SPINE_START) -> DataFrame:
    """The rows of :func:`distinct_violations`, each as often as the history has it."""
    found = F.col("date_found")
    window = history.where(found.isNotNull() & (found >= F.lit(start))
                           & (found <= F.lit(as_of)))
    return window.select(
        F.unhex(row_hash(HISTORY_COLUMNS)).alias("violation_pk"),
        unknown_if_blank("pin").alias("pin"),
        F.coalesce("violation_code", F.lit("UNKNOWN")).alias("violation_code"),
        unknown_if_blank("council_district").alias("council_district"),
        "violation_id", "source_system", "date_found", "date_resolved", "days_open",
        "is_resolved",
    )


def fact_rows(distinct: DataFrame) -> DataFrame:
    """The fact (K11) as a projection of :func:`distinct_violations`."""
    return distinct.select(
        F.lower(F.hex("violation_pk")).alias("violation_pk"),
        surrogate_key("pin").alias("property_sk"),
        surrogate_key("violation_code").alias("violation_type_sk"),
        surrogate_key("council_district").alias("council_district_sk"),
        surrogate_key("date_found").alias("date_sk"),
        "violation_id", "source_system", "date_found", "date_resolved", "days_open",
        "is_resolved",
    )


def fact_property_lifecycle(rollup: DataFrame, dangerous_by_pin: DataFrame) -> DataFrame:
    """Accumulating snapshot: one row per cited pin, milestones and stage."""
    d = dangerous_by_pin.withColumn("_listed", F.lit(True))
    j = rollup.join(d, "pin", "left")
    listed = F.col("_listed").isNotNull()
    demolition = F.coalesce("is_demolition_status", F.lit(False))
    return j.select(
        surrogate_key("pin").alias("property_sk"),
        surrogate_key(unknown_if_blank("council_district")).alias("council_district_sk"),
        "pin", "first_violation_date", "last_violation_date", "total_violations",
        "distinct_violation_types", "resolved_violations", "avg_days_open",
        listed.alias("ever_dangerous_building"),
        "dangerous_building_date",
        demolition.alias("is_demolition_status"),
        days_between("first_violation_date", "dangerous_building_date")
        .alias("days_first_violation_to_dangerous"),
        F.when(demolition, F.lit("demolition"))
         .when(listed, F.lit("dangerous_building"))
         .when(F.col("total_violations") >= 2, F.lit("repeat_violations"))
         .otherwise(F.lit("single_violation")).alias("current_stage"),
    )
