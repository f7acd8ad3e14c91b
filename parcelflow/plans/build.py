"""Wiring of the models, lazily (for single queries) or materialized (builds).

``Models`` holds every model as a DataFrame built on first use.  With
``store`` unset, each model is a lazy plan over the raw feeds (Catalyst
inlines the whole chain, like views).  With ``store`` set, the tables the
warehouse would materialize are written once as Parquet and read back, which
also cuts the lineage for what follows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from parcelflow.functions import SPINE_START
from parcelflow.plans import (
    dims, distributions, facts, history, marts, pin_bitmaps, staging, tiles, top_types,
)
from parcelflow.sources.publish import Draft, Manifest, Published

# Build order with the layer of each materialized table; the
# intermediates are stored too, because several models read each of them.
LAYERS = {
    "int_violations_unioned": "intermediate",
    "int_property_rollup": "intermediate",
    "dim_property": "dims",
    "dim_council_district": "dims",
    "dim_violation_type": "dims",
    "dim_date": "dims",
    "distinct_violations": "intermediate",
    "fact_violation": "facts",
    "fact_property_lifecycle": "facts",
    "mart_dashboard": "marts",
    "pin_numbers": "serving",
    "pin_days": "serving",
    "pin_months": "serving",
    "pin_flags": "serving",
    "days_distribution": "serving",
    "type_cells": "serving",
    "mart_blight_funnel": "marts",
    "mart_blight_hotspots": "marts",
    "mart_council_district": "marts",
    "mart_property_points": "marts",
    "point_tiles": "serving",
    "mart_resolution_time": "marts",
    "mart_top_violation_types": "marts",
    "mart_violations_trend": "marts",
}


# Layout of stored tables: (directory column or None, sort column).  The wide serving
# table is read with a date range and a council-district filter.  Years are
# bounded by the fact's date window, so they make the directories; district is
# free text of the feeds, so it only orders the rows inside the files, where
# row-group and page statistics prune it.  Rows are rebalanced by both before the write:
# AQE splits a hot district's partition and joins small ones, which bounds the
# number of files.  The EVEN tables lie in even partitions by their last join already,
# and are too wide to shuffle once more for that: a file a year and partition, sorted.
# The points lie in ranges of their Morton code (``tiles``).  The fact is ordered by found date inside the files its DISTINCT leaves, so that a date
# window prunes row groups without a shuffle of its own.
LAYOUT = {
    "mart_dashboard": ("year", "council_district"),
    "pin_days": ("month", "council_district"),
    "pin_months": ("month", "council_district"),
    "days_distribution": ("year", "council_district_sk"),
    "type_cells": ("year", "place"),
    "distinct_violations": (None, "date_found"),
    "fact_violation": (None, "date_found"),
}
EVEN = {"mart_dashboard"}


# Models kept lazy, like views: computed inside whatever reads them.
VIEWS = ["stg_violations_current", "stg_violations_historical", "stg_dangerous_buildings",
         "int_dangerous_building_by_pin"]


class TableStore:
    """The tables of one target (A8, A11, A12), below ``root/<target>``.

    What a run writes goes into a version of its own, at ``<layer>/<name>`` there, and is
    read back from it; :meth:`publish` makes the whole set visible at once.  A store that
    has written nothing reads the set published when it read its first table, to the end.
    """

    def __init__(self, spark: SparkSession, root: str, target: str = "dev"):
        self.spark, self.root, self.target = spark, root.rstrip("/"), target
        self.published = Published(spark, f"{self.root}/{target}")

    @cached_property
    def _draft(self) -> Draft:
        return self.published.draft()

    @cached_property
    def _manifest(self) -> Manifest:
        return self.published.manifest()

    def path(self, name: str) -> str:
        """Where this run writes ``name``."""
        return self._draft.path(name, f"{LAYERS.get(name, 'misc')}/{name}")

    def write(self, name: str, df: DataFrame) -> DataFrame:
        place = f"{LAYERS.get(name, 'misc')}/{name}"
        folder, order = LAYOUT.get(name, (None, None))
        if folder:
            dealt = df if name in EVEN else df.hint("rebalance", folder, order)
            laid = dealt.sortWithinPartitions(folder, order)
            laid.write.partitionBy(folder).option("compression", "zstd").parquet(self.path(name))
        else:
            laid = df.sortWithinPartitions(order) if order else df
            laid.write.option("compression", "zstd").parquet(self.path(name))
        self._draft.add(name, df, place)
        # Read back with the written schema: partition values keep their
        # type (no inference) and the column order is the model's.
        return self.spark.read.schema(df.schema).parquet(self.path(name)).select(*df.columns)

    def publish(self) -> Manifest:
        """Switch readers of the target to the tables of this run."""
        return self._draft.publish()

    def read(self, name: str) -> DataFrame:
        """A published table."""
        return self.published.read(name, self._manifest)


class Models:
    def __init__(self, raw: dict[str, DataFrame], as_of: dt.date,
                 start: dt.date = SPINE_START, store: TableStore | None = None):
        """``store`` set: tables are written when first used, and read back."""
        self.raw, self.as_of, self.start, self.store = raw, as_of, start, store
        self.spark = next(iter(raw.values())).sparkSession

    def _keep(self, name: str, df: DataFrame) -> DataFrame:
        return df if self.store is None else self.store.write(name, df)

    def _stored_or(self, name: str, plan: Callable[[], DataFrame]) -> DataFrame:
        """A table that an earlier use has stored, or else its plan."""
        return self.__dict__[name] if name in self.__dict__ else plan()

    # staging (views)
    @cached_property
    def stg_violations_current(self) -> DataFrame:
        return staging.stg_violations_current(self.raw["npd_violations"])

    @cached_property
    def stg_violations_historical(self) -> DataFrame:
        return staging.stg_violations_historical(self.raw["historical_violations"])

    @cached_property
    def stg_dangerous_buildings(self) -> DataFrame:
        return staging.stg_dangerous_buildings(self.raw["dangerous_buildings"])

    @cached_property
    def violation_labels(self) -> DataFrame:
        return self.raw["violation_labels"]

    # intermediate
    @cached_property
    def int_violations_unioned(self) -> DataFrame:
        return self._keep("int_violations_unioned", history.int_violations_unioned(
            self.stg_violations_current, self.stg_violations_historical, self.as_of))

    @cached_property
    def int_property_rollup(self) -> DataFrame:
        return self._keep("int_property_rollup",
                          history.int_property_rollup(self.int_violations_unioned))

    @cached_property
    def int_dangerous_building_by_pin(self) -> DataFrame:
        return history.int_dangerous_building_by_pin(self.stg_dangerous_buildings)

    # dimensions
    @cached_property
    def dim_property(self) -> DataFrame:
        return self._keep("dim_property", dims.dim_property(self.int_property_rollup,
                                                            self.stg_dangerous_buildings))

    @cached_property
    def dim_council_district(self) -> DataFrame:
        return self._keep("dim_council_district",
                          dims.dim_council_district(self.int_violations_unioned))

    @cached_property
    def dim_violation_type(self) -> DataFrame:
        return self._keep("dim_violation_type", dims.dim_violation_type(
            self.int_violations_unioned, self.violation_labels))

    @cached_property
    def dim_date(self) -> DataFrame:
        return self._keep("dim_date", dims.dim_date(self.spark, self.as_of, self.start))

    # facts
    @cached_property
    def distinct_violations(self) -> DataFrame:
        return self._keep("distinct_violations", facts.distinct_violations(
            self.int_violations_unioned, self.as_of, self.start))

    @cached_property
    def fact_rows(self) -> DataFrame:
        """The fact, hashed as it is read."""
        return facts.fact_rows(self.distinct_violations)

    @cached_property
    def fact_violation(self) -> DataFrame:
        return self._keep("fact_violation", self.fact_rows)

    @cached_property
    def fact_property_lifecycle(self) -> DataFrame:
        return self._keep("fact_property_lifecycle", facts.fact_property_lifecycle(
            self.int_property_rollup, self.int_dangerous_building_by_pin))

    # serving tables
    @cached_property
    def pin_numbers(self) -> DataFrame:
        return self._keep("pin_numbers", pin_bitmaps.pin_numbers(
            self.dim_property, self.fact_property_lifecycle))

    @cached_property
    def pin_days(self) -> DataFrame:
        return self._keep("pin_days", pin_bitmaps.pin_days(
            self.distinct_violations, self.pin_numbers))

    @cached_property
    def pin_months(self) -> DataFrame:
        return self._keep("pin_months", pin_bitmaps.pin_months(self.pin_days))

    @cached_property
    def pin_flags(self) -> DataFrame:
        return self._keep("pin_flags", pin_bitmaps.pin_flags(self.pin_numbers))

    @cached_property
    def pin_sets(self) -> pin_bitmaps.PinSets:
        return pin_bitmaps.PinSets(self.pin_months, self.pin_days, self.pin_flags)

    @cached_property
    def days_distribution(self) -> DataFrame:
        return self._keep("days_distribution",
                          distributions.days_distribution(self.fact_rows))

    @cached_property
    def type_cells(self) -> DataFrame:
        return self._keep("type_cells", top_types.type_cells(self.labelled_violations))

    @cached_property
    def labelled_violations(self) -> DataFrame:
        return top_types.labelled(
            self.distinct_violations, self.dim_violation_type, top_types.unknown_properties(
                self.int_violations_unioned, self.stg_dangerous_buildings))

    @cached_property
    def clustered_points(self) -> DataFrame:
        """The property points with their Morton code, as they are stored."""
        return self._keep("mart_property_points", tiles.clustered_points(
            marts.mart_property_points(self.fact_property_lifecycle, self.dim_property)))

    @cached_property
    def point_tiles(self) -> DataFrame:
        return self._keep("point_tiles", tiles.tile_rollup(self.clustered_points))

    # marts
    @cached_property
    def mart_blight_funnel(self) -> DataFrame:
        return self._keep("mart_blight_funnel",
                          marts.mart_blight_funnel(self.fact_property_lifecycle))

    @cached_property
    def mart_blight_hotspots(self) -> DataFrame:
        return self._keep("mart_blight_hotspots", marts.mart_blight_hotspots(
            self.fact_property_lifecycle, self.dim_property))

    @cached_property
    def mart_council_district(self) -> DataFrame:
        return self._keep("mart_council_district", distributions.council_district(
            self.days_distribution, self.pin_sets.by_district(), self.fact_property_lifecycle,
            self.dim_council_district))

    @cached_property
    def mart_dashboard(self) -> DataFrame:
        # It reads these three once and little of them: they are read where they are stored
        # already, else they are part of this table's plan, not stored for it.
        violations = self._stored_or("distinct_violations", lambda: facts.violation_rows(
            self.int_violations_unioned, self.as_of, self.start))
        properties = self._stored_or("dim_property", lambda: dims.dim_property(
            self.int_property_rollup, self.stg_dangerous_buildings))
        lifecycle = self._stored_or("fact_property_lifecycle", lambda: facts.fact_property_lifecycle(
            self.int_property_rollup, self.int_dangerous_building_by_pin))
        return self._keep("mart_dashboard", marts.mart_dashboard_of_violations(
            violations, self.dim_violation_type, self.dim_council_district, properties, lifecycle))

    @cached_property
    def mart_property_points(self) -> DataFrame:
        return self.clustered_points.drop("code")

    @cached_property
    def mart_resolution_time(self) -> DataFrame:
        return self._keep("mart_resolution_time", distributions.resolution_time(
            self.days_distribution, self.dim_council_district))

    @cached_property
    def mart_top_violation_types(self) -> DataFrame:
        return self._keep("mart_top_violation_types", marts.mart_top_violation_types(
            self.fact_violation, self.dim_violation_type))

    @cached_property
    def mart_violations_trend(self) -> DataFrame:
        return self._keep("mart_violations_trend", distributions.violations_trend(
            self.days_distribution, self.as_of))

    @cached_property
    def calendar_violations(self) -> DataFrame:
        return marts.calendar_violations(self.dim_date, self.fact_violation)

    @cached_property
    def adhoc_repeat_offenders(self) -> DataFrame:
        return marts.adhoc_repeat_offenders(self.fact_property_lifecycle, self.dim_property)


def build(raw: dict[str, DataFrame], as_of: dt.date, root: str, target: str = "dev",
          start: dt.date = SPINE_START, checks=None) -> Models:
    """Materialize every table in dependency order (the ordered build), then publish them
    at once.

    ``checks`` (see ``parcelflow.operators.checks``) runs after each table; an
    error-severity failure stops the build before downstream tables.  The key tests of
    all tables run at the end, in one exchange, before anything is published.  A build that
    stops, for whatever reason, leaves the target's published tables as they were.
    """
    spark = next(iter(raw.values())).sparkSession
    m = Models(raw, as_of, start, TableStore(spark, root, target))
    if checks is not None:  # staging stays lazy (views) but is tested first
        for name in VIEWS:
            checks(m, name)
    for name in LAYERS:
        getattr(m, name)
        if checks is not None:
            checks(m, name)
    if checks is not None:
        checks.finish(m)
    m.store.publish()
    return m
