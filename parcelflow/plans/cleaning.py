"""The cleaning helpers applied alone over whole raw feeds.

Staging hides each helper inside a 20-column projection; these queries show
what each does to every distinct raw value it meets, with how often.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.functions import (
    coord_at, normalize_code, point_coordinates, safe_date, safe_double,
)


def ordinance_codes(live: DataFrame, archive: DataFrame) -> DataFrame:
    """Raw ordinance text → unified violation code, with row counts."""
    both = live.select("ordinance").unionByName(archive.select("ordinance"))
    return (both.groupBy("ordinance").agg(F.count(F.lit(1)).alias("rows"))
            .select("ordinance", normalize_code("ordinance").alias("violation_code"), "rows"))


def point_coordinates_of(live: DataFrame, listed: DataFrame) -> DataFrame:
    """Every distinct point text of both feeds → (latitude, longitude)."""
    pts = (live.select(F.col("incident_location").alias("point"))
           .unionByName(listed.select(F.col("case_location").alias("point")))
           .groupBy("point").agg(F.count(F.lit(1)).alias("rows"))
           .withColumn("_c", point_coordinates("point")))
    return pts.select("point", coord_at("_c", 1).alias("latitude"),
                      coord_at("_c", 0).alias("longitude"), "rows")


def date_texts(live: DataFrame, archive: DataFrame) -> DataFrame:
    """Every distinct raw date text of both feeds → DATE or NULL (I4)."""
    texts = (live.select(F.col("date_found").alias("text"))
             .unionByName(live.select(F.col("date_resolved").alias("text")))
             .unionByName(archive.select(F.col("violation_entry_date").alias("text")))
             .unionByName(archive.select(F.col("case_closed").alias("text"))))
    return (texts.groupBy("text").agg(F.count(F.lit(1)).alias("rows"))
            .select("text", safe_date("text").alias("parsed"), "rows"))


def numeric_texts(part: DataFrame) -> DataFrame:
    """Number-like texts made of the part sizes, clean and dirty, → DOUBLE or
    NULL (H9): plain, hex, with a digit separator, exponent, white space around,
    type suffix, beyond the range, and no number at all."""
    size = F.col("p_size").cast("string")
    forms = [size, F.concat(F.lit("0x"), size, F.lit("p3")), F.concat(size, F.lit("_0")),
             F.concat(size, F.lit("e2")), F.concat(F.lit(" -"), size, F.lit(".5\n")),
             F.concat(size, F.lit("d")), F.concat(size, F.lit("e999"))]
    text = F.col("p_brand")
    for k, form in enumerate(forms):
        text = F.when(F.col("p_partkey") % 8 == k, form).otherwise(text)
    return (part.select(text.alias("text")).groupBy("text").agg(F.count(F.lit(1)).alias("rows"))
            .select("text", safe_double("text").alias("parsed"), "rows"))
