"""Data-quality checks (Q1-Q7).

A check yields offending rows (for unique and accepted_values: one row per
offending value); zero rows passes.  ``warn`` failures are
reported, ``error`` failures stop a build.  For the summary, every
not_null and accepted_values test of one table runs in one aggregate pass, and
all unique and relationships tests together in one grouped count of key hashes
(:func:`key_failures`).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ColumnTest:
    model: str
    column: str
    kind: str  # not_null | unique | relationships | accepted_values
    parent: tuple[str, str] | None = None
    values: tuple[str, ...] = field(default_factory=tuple)
    severity: str = "error"

    @property
    def name(self) -> str:
        return f"{self.kind}:{self.model}.{self.column}"


def _t(model, column, *kinds, parent=None, values=()):
    return [ColumnTest(model, column, k, parent, tuple(values)) for k in kinds]


STAGE_VALUES = ("single_violation", "repeat_violations", "dangerous_building", "demolition")

# The generic tests that the modelled project declares, per model
# and column.
COLUMN_TESTS: list[ColumnTest] = [
    *_t("stg_violations_current", "violation_id", "not_null"),
    *_t("stg_violations_current", "source_system", "accepted_values", values=("energov",)),
    *_t("stg_violations_historical", "violation_id", "not_null"),
    *_t("stg_violations_historical", "source_system", "accepted_values", values=("historical",)),
    *_t("stg_dangerous_buildings", "pin", "not_null", "unique"),
    *_t("dim_property", "property_sk", "unique", "not_null"),
    *_t("dim_council_district", "council_district_sk", "unique", "not_null"),
    *_t("dim_violation_type", "violation_type_sk", "unique", "not_null"),
    *_t("dim_date", "date_sk", "unique", "not_null"),
    *_t("fact_violation", "violation_pk", "unique", "not_null"),
    *_t("fact_violation", "property_sk", "not_null"),
    *_t("fact_violation", "property_sk", "relationships", parent=("dim_property", "property_sk")),
    *_t("fact_violation", "violation_type_sk", "relationships",
        parent=("dim_violation_type", "violation_type_sk")),
    *_t("fact_violation", "council_district_sk", "relationships",
        parent=("dim_council_district", "council_district_sk")),
    *_t("fact_violation", "date_sk", "not_null"),
    *_t("fact_violation", "date_sk", "relationships", parent=("dim_date", "date_sk")),
    *_t("fact_property_lifecycle", "property_sk", "unique", "not_null"),
    *_t("fact_property_lifecycle", "property_sk", "relationships",
        parent=("dim_property", "property_sk")),
    *_t("fact_property_lifecycle", "council_district_sk", "relationships",
        parent=("dim_council_district", "council_district_sk")),
    *_t("fact_property_lifecycle", "current_stage", "accepted_values", values=STAGE_VALUES),
    *_t("mart_blight_funnel", "stage_order", "unique", "not_null"),
    *_t("mart_council_district", "council_district", "not_null"),
    *_t("mart_top_violation_types", "violation_code", "not_null"),
    *_t("mart_property_points", "pin", "unique", "not_null"),
    *_t("mart_property_points", "lat_lng", "not_null"),
    *_t("mart_dashboard", "violation_pk", "unique", "not_null"),
    *_t("mart_dashboard", "council_district", "not_null"),
]


def failing_rows(test: ColumnTest, df: DataFrame, parent: DataFrame | None = None) -> DataFrame:
    """Offending rows of one generic test (NULLs pass unique/values/relationships)."""
    c = F.col(test.column)
    if test.kind == "not_null":
        return df.where(c.isNull())
    if test.kind == "accepted_values":  # one row per distinct unexpected value
        return (df.where(c.isNotNull() & ~c.isin(*test.values)).groupBy(test.column)
                .agg(F.count(F.lit(1)).alias("n_records")))
    if test.kind == "unique":
        return (df.where(c.isNotNull()).groupBy(test.column)
                .agg(F.count(F.lit(1)).alias("n_records")).where("n_records > 1"))
    if test.kind == "relationships":
        pcol = test.parent[1]
        keys = parent.select(F.col(pcol).alias(test.column))
        return df.where(c.isNotNull()).join(keys, test.column, "left_anti")
    raise ValueError(test.kind)


def _scan_failures(df: DataFrame, tests: list[ColumnTest]) -> list[int]:
    """Failures of a table's not_null and accepted_values tests, in one pass."""
    aggs = []
    for i, t in enumerate(tests):
        c = F.col(t.column)
        if t.kind == "not_null":  # failing rows
            aggs.append(F.count_if(c.isNull()).alias(f"f{i}"))
        else:  # failing distinct values
            aggs.append(F.count_distinct(F.when(~c.isin(*t.values), c)).alias(f"f{i}"))
    return list(df.agg(*aggs).first())


Key = tuple[str, str]
#: Bits of the hash that keys are grouped by (fewer only in tests).
KEY_BITS = 64


def _hashes(column: str, bits: int = KEY_BITS) -> tuple[Column, Column]:
    """The hash that keys are grouped by, and one that tells collisions apart."""
    c = F.col(column).cast("string")
    return F.shiftrightunsigned(F.xxhash64(c), 64 - bits), F.xxhash64(F.lit("second"), c)


def _domains(tests: list[ColumnTest]) -> dict[Key, list[Key]]:
    """For each column that is unique or a parent: itself, then the columns whose values
    must be among its own."""
    out: dict[Key, list[Key]] = {}
    for t in tests:
        own = (t.model, t.column) if t.kind == "unique" else t.parent
        held = out.setdefault(own, [own])
        if t.kind == "relationships" and (t.model, t.column) not in held:
            held.append((t.model, t.column))
    return out


def key_failures(tables: Callable[[str], DataFrame], tests: list[ColumnTest],
                 bits: int = KEY_BITS) -> list[int]:
    """Failures of unique and relationships tests: all of them by one exchange of keys.

    Every table is read once and gives a (domain, slot, hash) row for each of its tested
    keys; the rows of all tables are stacked and counted by domain and hash, with
    partial aggregates, so a key of a third of all rows arrives as one row a task.  A
    hash that a domain's own column has twice is a repeated key, one that it lacks is
    an orphan of the slots that have it.  Where two keys share a hash (a second one
    tells), the tests of their domain count these keys again by value."""
    if not tests:
        return []
    domains = _domains(tests)
    number = {d: i for i, d in enumerate(domains)}
    slots = max(map(len, domains.values()))
    rows = []
    for model in {m: None for held in domains.values() for m, _ in held}:
        emitted = [F.struct(F.lit(number[d]).alias("domain"), F.lit(slot).alias("slot"),
                            F.col(c).isNotNull().alias("known"), _hashes(c, bits)[0].alias("h"),
                            _hashes(c, bits)[1].alias("h2"))
                   for d, held in domains.items() for slot, (m, c) in enumerate(held) if m == model]
        rows.append(tables(model).select(F.inline(F.array(*emitted))).where("known"))
    counted = reduce(DataFrame.unionByName, rows).groupBy("domain", "h").agg(
        *[F.count_if(F.col("slot") == s).alias(f"n{s}") for s in range(slots)],
        (F.min("h2") != F.max("h2")).alias("mixed"))
    aggs = []
    for i, t in enumerate(tests):
        own = (t.model, t.column) if t.kind == "unique" else t.parent
        here = (F.col("domain") == number[own]) & ~F.col("mixed")
        if t.kind == "unique":
            aggs.append(F.count_if(here & (F.col("n0") > 1)).alias(f"f{i}"))
        else:
            n = F.col(f"n{domains[own].index((t.model, t.column))}")
            aggs.append(F.coalesce(F.sum(F.when(here & (F.col("n0") == 0), n)), F.lit(0))
                        .alias(f"f{i}"))
    shared = F.collect_set(F.when(F.col("mixed"), F.col("domain"))).alias("shared")  # of few domains
    found = counted.agg(*aggs, shared).first()
    out = list(found)[:-1]
    for i, t in enumerate(tests):
        own = (t.model, t.column) if t.kind == "unique" else t.parent
        if number[own] in found.shared:
            clash = counted.where(F.col("mixed") & (F.col("domain") == number[own])).select("h")
            some = lambda df, c: df.where(F.col(c).isNotNull()).withColumn(
                "h", _hashes(c, bits)[0]).join(clash, "h", "left_semi").drop("h")  # noqa: B023
            parent = some(tables(t.parent[0]), t.parent[1]) if t.parent else None
            out[i] += failing_rows(t, some(tables(t.model), t.column), parent).count()
    return out


def test_summary(tables: Callable[[str], DataFrame], tests: list[ColumnTest] = COLUMN_TESTS,
                 models: list[str] | None = None) -> DataFrame:
    """One row per test: model, column_name, test, severity, failures."""
    pick = [t for t in tests if models is None or t.model in models]
    spark = tables(pick[0].model).sparkSession
    return spark.createDataFrame(
        [(t.model, t.column, t.kind, t.severity, n) for t, n in failures_of(tables, pick)],
        "model string, column_name string, test string, severity string, failures bigint")


def failures_of(tables: Callable[[str], DataFrame],
                tests: list[ColumnTest]) -> list[tuple[ColumnTest, int]]:
    """Each test with its failures; what comes to the driver is one number a test."""
    scans = [t for t in tests if t.kind in ("not_null", "accepted_values")]
    keys = [t for t in tests if t.kind in ("unique", "relationships")]
    found = dict(zip(keys, key_failures(tables, keys), strict=True))
    for model in {t.model: None for t in scans}:
        here = [t for t in scans if t.model == model]
        found |= zip(here, _scan_failures(tables(model), here), strict=True)
    return [(t, found[t]) for t in tests]


# ---- singular assertions (Q5-Q7) --------------------------------------------


def assert_no_negative_days_open(fact_violation: DataFrame) -> DataFrame:
    return fact_violation.where(F.col("days_open") < 0)


def assert_resolved_after_found(history: DataFrame) -> DataFrame:
    return history.where(F.col("date_resolved").isNotNull() & F.col("date_found").isNotNull()
                         & (F.col("date_resolved") < F.col("date_found")))


def assert_dangerous_after_first_violation(lifecycle: DataFrame) -> DataFrame:
    """Warn only: the list and the violations are independent sources."""
    return lifecycle.where(F.col("dangerous_building_date").isNotNull()
                           & F.col("first_violation_date").isNotNull()
                           & (F.col("dangerous_building_date") < F.col("first_violation_date")))


SINGULAR = {
    "assert_no_negative_days_open": ("fact_violation", assert_no_negative_days_open, "error"),
    "assert_resolved_after_found": ("int_violations_unioned", assert_resolved_after_found, "error"),
    "assert_dangerous_after_first_violation": (
        "fact_property_lifecycle", assert_dangerous_after_first_violation, "warn"),
}


class CheckFailed(RuntimeError):
    pass


class build_checks:  # noqa: N801 - called like a function
    """What ``plans.build.build`` calls with each table after it is written: the tests of
    its values and its assertions; and, once all tables are there and before they are
    published, :meth:`finish`, the key tests of all tables in one exchange.  An
    error-severity failure stops the build, warnings are recorded."""

    def __init__(self, report: list | None = None, tests: list[ColumnTest] = COLUMN_TESTS):
        self.report, self.tests = [] if report is None else report, tests

    def _record(self, name: str, rows: list[tuple[str, str, int]]) -> None:
        self.report.extend(rows)
        errors = [r for r in rows if r[2] and r[1] == "error"]
        if errors:
            raise CheckFailed(f"{name}: {errors}")

    def _run(self, models, tests: list[ColumnTest]) -> list[tuple[str, str, int]]:
        return [(t.name, t.severity, n)
                for t, n in failures_of(lambda m: getattr(models, m), tests)]

    def __call__(self, models, name: str) -> None:
        values = [t for t in self.tests if t.model == name
                  and t.kind in ("not_null", "accepted_values")]
        rows = self._run(models, values) if values else []
        rows += [(key, sev, fn(getattr(models, name)).count())
                 for key, (model, fn, sev) in SINGULAR.items() if model == name]
        self._record(name, rows)

    def finish(self, models) -> None:
        self._record("keys", self._run(models, [t for t in self.tests
                                                if t.kind in ("unique", "relationships")]))
