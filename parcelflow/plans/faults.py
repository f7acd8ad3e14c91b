"""The checks over models with planted faults.

Each fault follows from the row itself, so it grows with the input: records
found on the first of a month arrive twice; by month, keys go missing, lose
their parent, ages turn negative, resolutions precede the violation; single
violations take a stage nobody knows.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.operators import checks

NULL_KEY, ORPHAN, NEGATIVE, EARLY = 2, 3, 4, 5  # months
UNKNOWN_STAGE = "moved"

#: The column tests that meet the faults, on the faulty tables.
TESTS = [replace(t, model=f"faulty_{t.model}") for t in checks.COLUMN_TESTS
         if t.model == "fact_violation"
         or (t.model == "fact_property_lifecycle" and t.kind != "relationships")]
SINGULAR = {k: f"faulty_{model}" for k, (model, _, severity) in checks.SINGULAR.items()
            if severity == "error"}


def faulty_fact_violation(fact: DataFrame) -> DataFrame:
    month = F.month("date_found")
    f = fact.withColumns({
        "property_sk": F.when(month != NULL_KEY, F.col("property_sk")),
        "council_district_sk": F.when(month == ORPHAN, "orphan")
        .otherwise(F.col("council_district_sk")),
        "days_open": F.when(month == NEGATIVE, -1).otherwise(F.col("days_open")),
    })
    return f.unionByName(f.where(F.dayofmonth("date_found") == 1))


def faulty_fact_property_lifecycle(lifecycle: DataFrame) -> DataFrame:
    return lifecycle.withColumn("current_stage", F.when(
        F.col("total_violations") == 1, UNKNOWN_STAGE).otherwise(F.col("current_stage")))


def faulty_int_violations_unioned(history: DataFrame) -> DataFrame:
    return history.withColumn("date_resolved", F.when(
        F.month("date_found") == EARLY, F.date_add("date_found", -1))
        .otherwise(F.col("date_resolved")))


def faulty_tables(models) -> dict[str, DataFrame]:
    """Table name -> DataFrame, for the faulty models and their parents."""
    return {
        "faulty_fact_violation": faulty_fact_violation(models.fact_violation),
        "faulty_fact_property_lifecycle":
            faulty_fact_property_lifecycle(models.fact_property_lifecycle),
        "faulty_int_violations_unioned":
            faulty_int_violations_unioned(models.int_violations_unioned),
    } | {t.parent[0]: getattr(models, t.parent[0]) for t in TESTS if t.parent}


def fault_summary(models) -> DataFrame:
    """One row per check over the faulty tables: model, column_name, test,
    severity, failures."""
    tables = faulty_tables(models)
    out = checks.test_summary(tables.__getitem__, TESTS)
    for key, model in SINGULAR.items():
        _, rows, severity = checks.SINGULAR[key]
        out = out.unionByName(rows(tables[model]).agg(F.count("*").alias("failures")).select(
            F.lit(model).alias("model"), F.lit("").alias("column_name"),
            F.lit(key).alias("test"), F.lit(severity).alias("severity"), "failures"))
    return out
