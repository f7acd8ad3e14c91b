"""The curated violation-code -> short-label lookup (A10)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SEED_SCHEMA = "violation_code string, short_label string"

# --- Fixed values: the curated label seed, in its natural order ------------
VIOLATION_LABELS = [
    ("48-25", "Animal feces"),
    ("48-30", "Weeds / overgrowth"),
    ("48-32", "Trash / debris"),
    ("56-132 (B)", "Exterior walls"),
    ("56-133", "Roofing disrepair"),
    ("48-27", "Unlicensed vehicle"),
    ("48-28", "Improper parking"),
    ("56-573", "Vacant - unregistered"),
    ("56-132 (C)", "Exterior surface"),
    ("56-135", "Awning disrepair"),
    ("56-352", "Rental - unregistered"),
    ("56-93", "Loose baluster"),
    ("56-113", "Accessory structure"),
    ("56-114", "Fence / wall"),
    ("56-132", "Exterior surface"),
    ("56-132 (A)", "Missing siding"),
    ("48-46(c)", "Graffiti"),
    ("48-35", "RV / boat parking"),
    ("48-29", "Hazardous tree"),
    ("48-68 (3)", "Trash in right-of-way"),
    ("48-31", "Open structure"),
    ("56-189", "Drain obstructed"),
    ("56-163", "Dirty ceiling"),
    ("56-134", "Weatherproofing"),
]
# -----------------------------------------------------------------------------


def builtin_labels(spark: SparkSession) -> DataFrame:
    """The seed as a DataFrame (24 rows, one partition)."""
    return spark.createDataFrame(VIOLATION_LABELS, SEED_SCHEMA).coalesce(1)


def read_labels_csv(spark: SparkSession, path: str) -> DataFrame:
    """Load an edited seed CSV with an explicit schema (no inference)."""
    return (spark.read.schema(SEED_SCHEMA).option("header", True)
            .option("mode", "FAILFAST").csv(path))
