"""Dimensions, each with an UNKNOWN member so fact keys always resolve."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.functions import SPINE_START, in_bbox, surrogate_key
from parcelflow.operators import add_unknown_member, anti_join, first_per_key

PROPERTY_ATTRS = ["pin", "street_address", "full_address", "zip_code", "council_district",
                  "neighborhood", "latitude", "longitude"]


def dim_property(rollup: DataFrame, dangerous: DataFrame) -> DataFrame:
    """Every pin with violations, every listed-only pin, and UNKNOWN (K7).

    The two data branches are unique by pin and disjoint (anti join), so the
    UNION DISTINCT reduces to a duplicate check of the UNKNOWN row.
    Coordinates outside the bounding box are nulled together.
    """
    cited = rollup.select(*PROPERTY_ATTRS)
    listed_only = anti_join(dangerous, rollup, "pin").select(*PROPERTY_ATTRS)
    props = add_unknown_member(cited.unionByName(listed_only),
                               {"pin": "UNKNOWN", "council_district": "UNKNOWN"})
    inside = in_bbox("latitude", "longitude")
    return props.select(
        surrogate_key("pin").alias("property_sk"),
        "pin", "street_address", "full_address", "zip_code", "council_district",
        "neighborhood",
        F.when(inside, F.col("latitude")).alias("latitude"),
        F.when(inside, F.col("longitude")).alias("longitude"),
    )


def dim_council_district(history: DataFrame) -> DataFrame:
    """Districts seen in the history plus UNKNOWN, with a label (K8)."""
    cd = F.col("council_district")
    seen = history.select("council_district").where(cd.isNotNull() & (cd != ""))
    unknown = history.sparkSession.createDataFrame([("UNKNOWN",)], "council_district string")
    districts = seen.unionByName(unknown).distinct()
    return districts.select(
        surrogate_key("council_district").alias("council_district_sk"),
        "council_district",
        F.when(cd == "UNKNOWN", F.lit("Unknown"))
         .otherwise(F.concat(F.lit("District "), cd)).alias("district_label"),
    )


def dim_violation_type(history: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per normalized code plus UNKNOWN, with a chart label (K9).

    The representative row per code is the smallest description (NULL
    first), then the smallest chapter; duplicates do not change a minimum,
    so no DISTINCT pass is needed first.
    """
    coded = history.where(F.col("violation_code").isNotNull())
    picked = first_per_key(coded, ["violation_code"], ["violation_description", "chapter"], [])
    picked = picked.select("violation_code", "chapter", "violation_description")
    unknown = history.sparkSession.createDataFrame(
        [("UNKNOWN", None, "Unknown / uncoded")],
        "violation_code string, chapter string, violation_description string")
    p = picked.unionByName(unknown)
    lbl = labels.select("violation_code", "short_label")
    return p.join(lbl, "violation_code", "left").select(
        surrogate_key("violation_code").alias("violation_type_sk"),
        "violation_code", "chapter", "violation_description",
        F.coalesce("short_label", "violation_code").alias("short_label"),
    )


def dim_date(spark: SparkSession, as_of: dt.date, start: dt.date = SPINE_START) -> DataFrame:
    """One row per day from ``start`` to ``as_of`` inclusive."""
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(start), F.lit(as_of))).alias("date_day"))
    d = F.col("date_day")
    return days.select(
        surrogate_key(d).alias("date_sk"), d,
        F.year(d).cast("bigint").alias("year"),
        F.quarter(d).cast("bigint").alias("quarter"),
        F.month(d).cast("bigint").alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
    )
