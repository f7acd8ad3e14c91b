"""Analytic marts (K13-K21); the district, resolution and trend marts are in
``distributions``.

Shapes chosen for scale: aggregate before joining to a dimension, take the
top-k before joining its attributes (the k rows are then a broadcast of a
proven size), join the two property-grain tables to each other before the
violation fact meets them, and salt the fact's hot properties.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.functions import lat_lng, safe_divide, year_of
from parcelflow.operators import salted_lookup_join, top_k, unpivot


def mart_blight_funnel(lifecycle: DataFrame) -> DataFrame:
    """Cumulative funnel: any → repeat → dangerous → demolition."""
    t = lifecycle.agg(
        F.count(F.lit(1)).alias("n_any"),
        F.count_if(F.col("total_violations") >= 2).alias("n_repeat"),
        F.count_if("ever_dangerous_building").alias("n_dangerous"),
        F.count_if("is_demolition_status").alias("n_demolition"),
    )
    rows = []
    for order, stage, n in ((1, "Any violation", "n_any"), (2, "Repeat violations", "n_repeat"),
                            (3, "Dangerous building", "n_dangerous"),
                            (4, "Demolition", "n_demolition")):
        share = F.lit(1.0) if order == 1 else safe_divide(n, "n_any")
        rows.append([F.lit(order).cast("bigint"), F.lit(stage), F.col(n), share])
    return unpivot(t, rows, ["stage_order", "stage", "property_count",
                             "pct_of_violation_properties"])


def _top_properties(lifecycle: DataFrame, dim_property: DataFrame, n: int,
                    lc_cols: list[str], pr_cols: list[str]) -> DataFrame:
    """Top ``n`` snapshot rows by total_violations (ties: pin), then their
    property attributes through a broadcast of the ``n`` rows.

    Every snapshot property is in ``dim_property`` (same rollup), so taking
    the top rows before the inner join gives the same rows as after it.
    """
    top = top_k(lifecycle.select("property_sk", *lc_cols), n,
                [F.col("total_violations").desc(), F.col("pin").asc()])
    pr = dim_property.select("property_sk", *pr_cols)
    return pr.join(F.broadcast(top), "property_sk")


def mart_blight_hotspots(lifecycle: DataFrame, dim_property: DataFrame, n: int = 200) -> DataFrame:
    """Top 200 repeat-offender properties."""
    j = _top_properties(lifecycle, dim_property, n,
                        ["pin", "total_violations", "ever_dangerous_building", "current_stage"],
                        ["street_address", "council_district", "neighborhood", "latitude",
                         "longitude"])
    return j.select("pin", "street_address", "council_district", "neighborhood", "latitude",
                    "longitude", "total_violations", "ever_dangerous_building", "current_stage")


def adhoc_repeat_offenders(lifecycle: DataFrame, dim_property: DataFrame, n: int = 50) -> DataFrame:
    """Top 50 properties with address and district from the property."""
    j = _top_properties(lifecycle, dim_property, n,
                        ["pin", "total_violations", "current_stage", "ever_dangerous_building"],
                        ["street_address", "council_district"])
    return j.select("pin", "street_address", "council_district", "total_violations",
                    "current_stage", "ever_dangerous_building")


def mart_top_violation_types(fact: DataFrame, dim_type: DataFrame, n: int = 20) -> DataFrame:
    """The 20 most common codes, share of all violations, mean age."""
    counts = fact.groupBy("violation_type_sk").agg(
        F.count(F.lit(1)).alias("violation_count"),
        F.avg("days_open").alias("avg_days_open"))
    grand = counts.select(F.sum("violation_count")).scalar()
    t = dim_type.where(F.col("violation_code") != "UNKNOWN").select(
        "violation_type_sk", "violation_code", "short_label", "chapter", "violation_description")
    j = counts.join(t, "violation_type_sk").select(
        "violation_code", "short_label", "chapter", "violation_description", "violation_count",
        safe_divide("violation_count", grand).alias("pct_of_total"), "avg_days_open")
    return top_k(j, n, [F.col("violation_count").desc(), F.col("violation_code").asc()])


def mart_property_points(lifecycle: DataFrame, dim_property: DataFrame) -> DataFrame:
    """Geocoded properties with their snapshot weight for the map."""
    pr = dim_property.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    lc = lifecycle.select("property_sk", "total_violations", "current_stage",
                          "ever_dangerous_building")
    return lc.join(pr, "property_sk").select(
        "pin", "street_address", "council_district", "neighborhood", "latitude", "longitude",
        lat_lng("latitude", "longitude").alias("lat_lng"),
        "total_violations", "current_stage", "ever_dangerous_building")


def mart_dashboard(fact: DataFrame, dim_type: DataFrame, dim_district: DataFrame,
                   dim_property: DataFrame, lifecycle: DataFrame,
                   partitions: int | None = None) -> DataFrame:
    """One wide row per violation with type, district, property and stage.

    The property and snapshot tables share a grain and are joined first; the
    fact meets them in one shuffle join, salted where a property holds more
    than an even partition (the UNKNOWN property that all blank pins map to is
    one such).  The type and district dimensions are stored tables in every
    build, so Spark broadcasts them by their file size or, beyond that, splits
    a hot code's partition.
    """
    f = salted_lookup_join(fact, property_attributes(dim_property, lifecycle), "property_sk",
                           salt_from="violation_pk", partitions=partitions, how="left")
    return wide_rows(f, dim_type, dim_district)


def mart_dashboard_of_violations(violations: DataFrame, dim_type: DataFrame,
                                 dim_district: DataFrame, dim_property: DataFrame,
                                 lifecycle: DataFrame, partitions: int | None = None) -> DataFrame:
    """:func:`mart_dashboard` off the rows that the fact is hashed from
    (``facts.violation_rows``), which may repeat: the raw keys are joined on, shorter than
    their digests, and equal rows are dropped in the shuffle of the property join."""
    f = salted_lookup_join(violations, property_attributes(dim_property, lifecycle, "pin"), "pin",
                           salt_from="violation_pk", partitions=partitions, how="left", distinct=True)
    return wide_rows(f.withColumn("violation_pk", F.lower(F.hex("violation_pk"))), dim_type,
                     dim_district, "violation_code", "council_district")


def property_attributes(dim_property: DataFrame, lifecycle: DataFrame,
                        key: str = "property_sk") -> DataFrame:
    """What the wide table tells of a property, under its key or under its pin."""
    attributes = ["pin", "street_address", "neighborhood", "latitude", "longitude"]
    prop = dim_property.select(*dict.fromkeys([key, *attributes]))
    lc = lifecycle.select(key, "current_stage", "ever_dangerous_building", "total_violations")
    return prop.join(lc, key, "left")


def wide_rows(f: DataFrame, dim_type: DataFrame, dim_district: DataFrame,
              type_key: str = "violation_type_sk",
              district_key: str = "council_district_sk") -> DataFrame:
    """The wide rows of fact rows that have their property's attributes."""
    vt = dim_type.select(*dict.fromkeys([type_key, "violation_code", "short_label", "chapter",
                                         "violation_description"]))
    cd = dim_district.select(*dict.fromkeys([district_key, "council_district", "district_label"]))
    wide = f.join(vt, type_key, "left").join(cd, district_key, "left")
    return wide.select(
        "violation_pk", "violation_id", "source_system", "date_found",
        year_of("date_found").alias("year"), "date_resolved", "days_open", "is_resolved",
        "violation_code", "short_label", "chapter", "violation_description",
        "council_district", "district_label", "pin", "street_address", "neighborhood",
        "latitude", "longitude",
        F.when(F.col("latitude").isNotNull() & F.col("longitude").isNotNull(),
               lat_lng("latitude", "longitude")).alias("lat_lng"),
        "current_stage", "ever_dangerous_building", "total_violations",
    )


def calendar_violations(dim_date: DataFrame, fact: DataFrame) -> DataFrame:
    """Every spine day with its calendar attributes and violations found that
    day (0 when none): the date dimension joined to the fact on ``date_sk``
    (K10).  The fact is aggregated per day before the join."""
    per_day = fact.groupBy("date_sk").agg(F.count(F.lit(1)).alias("violations"))
    return (dim_date.join(per_day, "date_sk", "left")
            .select("date_sk", "date_day", "year", "quarter", "month", "month_name",
                    F.coalesce("violations", F.lit(0)).cast("bigint").alias("violations")))
