"""Distinct properties under any district and date range, from stored bitmaps
(L1-L3, L9, D15; the distinct count of K15).

Properties get dense numbers, so that sets of them are bitmaps of 32,768 bits: one for
each month, district and range of numbers (a bucket), ready when a scope is asked for.
Properties that agree in every flag of the dashboard (repeat, dangerous, stage) are
numbered together from the start of a bucket, so a bucket has one set of flags, and a
distinct count by flag is the sum of the bit counts of the merged bitmaps of its
buckets.  Whole months of a date range come from the bitmaps; the odd days at its ends
from the days table, of which only those months are read.  The wide table is not read.

    pin_numbers   pin, flags, bucket, position
    pin_days      month, date_found, council_district, bucket, position, violations
    pin_months    month, council_district, bucket, bits, violations

``pin_days`` and ``pin_months`` are stored by month and ordered by district.  A bucket's
bitmaps merge as partial aggregates of 4 KB, however many violations stand behind them.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelflow.functions import safe_divide
from parcelflow.operators import unpivot

#: Bits of one bitmap: what ``bitmap_construct_agg`` builds.
BITS = 32_768
FLAGS = ["is_repeat", "is_dangerous", "current_stage"]
#: Properties that one task numbers.
SHARD = 1_000_000

Scope = tuple[str | None, dt.date | None, dt.date | None]


def month_of(day: Column | str) -> Column:
    """Year and month as one whole number, 201007."""
    return (F.year(day) * 100 + F.month(day)).cast("int")


def pin_numbers(dim_property: DataFrame, lifecycle: DataFrame, shard: int = SHARD,
                properties: int | None = None) -> DataFrame:
    """pin, FLAGS, bucket and position of every property.

    Pins are dealt by hash into shards of about ``shard`` and numbered inside each by a
    window; how many a shard holds of each set of flags says where its numbers begin
    (a window over shards x flag sets, not over properties)."""
    lc = lifecycle.select("pin", (F.col("total_violations") >= 2).alias("is_repeat"),
                          F.col("ever_dangerous_building").alias("is_dangerous"), "current_stage")
    pins = dim_property.select("pin").join(lc, "pin", "left")  # what property_sk is hashed from
    if properties is None:
        properties = dim_property.count()
    shards = max(1, -(-properties // shard))
    dealt = pins.select("pin", *FLAGS, F.pmod(F.xxhash64("pin"), F.lit(shards)).alias("shard"))
    key = F.to_json(F.struct(*FLAGS), {"ignoreNullFields": "false"}).alias("flags")
    placed = dealt.select("*", key).select("*", (F.row_number().over(
        Window.partitionBy("flags", "shard").orderBy("pin")) - 1).alias("place"))
    sizes = dealt.select("shard", key).groupBy("flags", "shard").agg(F.count(F.lit(1)).alias("n"))
    upto = Window.partitionBy("flags").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    inside = sizes.select("flags", "shard", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("skip"))
    before = Window.orderBy("flags").rowsBetween(Window.unboundedPreceding, -1)
    starts = (sizes.groupBy("flags").agg(F.ceil(F.sum("n") / F.lit(BITS)).alias("buckets"))
              .select("flags", F.coalesce(F.sum("buckets").over(before), F.lit(0)).alias("start")))
    offsets = inside.join(starts, "flags").select(
        "flags", "shard", (F.col("start") * BITS + F.col("skip")).alias("offset"))
    number = F.col("place") + F.col("offset")
    return placed.join(offsets, ["flags", "shard"]).select(
        "pin", *FLAGS, F.floor(number / BITS).cast("int").alias("bucket"),
        F.pmod(number, F.lit(BITS)).cast("bigint").alias("position"))


def pin_days(violations: DataFrame, numbers: DataFrame) -> DataFrame:
    """Each property's violations of a day and district, counted before the join, so
    that the property of all blank pins has few rows there.  Pin, district and day are
    all it takes: rows of the wide table, or the distinct violations it is made of."""
    counted = violations.groupBy("date_found", "council_district", "pin").agg(
        F.count(F.lit(1)).alias("violations"))
    return counted.join(numbers.select("pin", "bucket", "position"), "pin", "left").select(
        month_of("date_found").alias("month"), "date_found", "council_district", "bucket",
        "position", "violations")


def bitmaps(days: DataFrame, *keys: str) -> DataFrame:
    return days.groupBy(*keys).agg(F.bitmap_construct_agg("position").alias("bits"),
                                   F.sum("violations").alias("violations"))


def pin_months(days: DataFrame) -> DataFrame:
    return bitmaps(days, "month", "council_district", "bucket")


def pin_flags(numbers: DataFrame) -> DataFrame:
    """bucket and its FLAGS: one row for 32,768 properties."""
    return numbers.select("bucket", *FLAGS).distinct()


Days = tuple[dt.date, dt.date]


def split_range(first: dt.date | None,
                last: dt.date | None) -> tuple[tuple[int | None, int | None] | None, list[Days]]:
    """The first and last whole month of a range of days (None: open; None for both when
    no month is whole), and the ranges of the odd days beside them."""
    day = dt.timedelta(days=1)
    start, end = first, last
    if first is not None and first.day > 1:
        start = (first.replace(day=1) + 32 * day).replace(day=1)
    if last is not None and (last + day).day > 1:
        end = last.replace(day=1) - day
    if start is not None and end is not None and start > end:
        return None, [(first, last)] if first <= last else []
    odd = [(first, start - day)] if first != start else []
    odd += [(end + day, last)] if last != end else []
    number = lambda d: None if d is None else d.year * 100 + d.month
    return (number(start), number(end)), odd


def within(column: str, low: int | None, high: int | None) -> Column:
    """``column`` from ``low`` to ``high``, either open."""
    test = F.lit(True)
    if low is not None:
        test = test & (F.col(column) >= low)
    if high is not None:
        test = test & (F.col(column) <= high)
    return test


def on_days(ranges: list[Days], part: str | None = None, number=None) -> Column:
    """Found on one of the days; ``part`` is the directory column, if there is one, of
    which ``number`` gives a day's value, so that only the folders of these days are read."""
    test = F.lit(False)
    for start, end in ranges:
        found = F.col("date_found").between(F.lit(start), F.lit(end))
        if part:
            found = found & F.col(part).between(number(start), number(end))
        test = test | found
    return test


class PinSets:
    """Sets of properties by scope, off the stored tables."""

    def __init__(self, months: DataFrame, days: DataFrame, flags: DataFrame):
        self.months, self.days, self.flags = months, days, flags

    def parts(self, scope: Scope | str | None) -> tuple[DataFrame, DataFrame | None]:
        """The bitmaps of the whole months of a scope, and the days table's rows of its
        odd days (None without such days)."""
        district, first, last = scope if isinstance(scope, tuple) else (scope, None, None)
        here = F.lit(True) if district is None else F.col("council_district") == district
        whole, odd = split_range(first, last)
        months = self.months.where(here & (F.lit(False) if whole is None else
                                           within("month", *whole)))
        if not odd:
            return months, None
        number = lambda d: d.year * 100 + d.month
        return months, self.days.where(here & on_days(odd, "month", number))

    def merged(self, scope: Scope | str | None, *keys: str) -> DataFrame:
        """``keys``, bucket, properties, violations of a scope."""
        months, odd = self.parts(scope)
        sets = months.select(*keys, "bucket", "bits", "violations")
        if odd is not None:
            sets = sets.unionByName(bitmaps(odd, *keys, "bucket"))
        return sets.groupBy(*keys, "bucket").agg(
            F.bitmap_count(F.bitmap_or_agg("bits")).alias("properties"),
            F.sum("violations").alias("violations"))

    def by_flags(self, scope: Scope | str | None = None) -> DataFrame:
        """FLAGS, properties, violations: one row for each set of flags."""
        return self.merged(scope).join(self.flags, "bucket", "left").groupBy(*FLAGS).agg(
            F.sum("properties").alias("properties"), F.sum("violations").alias("violations"))

    def by_district(self) -> DataFrame:
        """council_district, distinct_properties."""
        return self.merged(None, "council_district").groupBy("council_district").agg(
            F.sum("properties").cast("bigint").alias("distinct_properties"))


def _sum_if(flag: Column | str, name: str) -> Column:
    flag = F.col(flag) if isinstance(flag, str) else flag
    return F.coalesce(F.sum(F.when(flag, F.col("properties"))), F.lit(0)).cast("bigint").alias(name)


def funnel(sets: PinSets, scope: Scope | str | None = None) -> DataFrame:
    """Cumulative funnel (L1)."""
    t = sets.by_flags(scope).agg(
        _sum_if(F.lit(True), "a"), _sum_if("is_repeat", "r"), _sum_if("is_dangerous", "d"),
        _sum_if(F.col("current_stage") == "demolition", "m"))
    rows = [[F.lit(i + 1).cast("bigint"), F.lit(s), F.col(c)] for i, (s, c) in enumerate(
        [("Any violation", "a"), ("Repeat violations", "r"), ("Dangerous building", "d"),
         ("Demolition", "m")])]
    return unpivot(t, rows, ["stage_order", "stage", "property_count"])


def kpis(sets: PinSets, scope: Scope | str | None = None) -> DataFrame:
    """Properties, share escalated, total violations (L2-L4)."""
    t = sets.by_flags(scope).agg(
        _sum_if(F.lit(True), "properties"), _sum_if("is_dangerous", "escalated"),
        F.coalesce(F.sum("violations"), F.lit(0)).cast("bigint").alias("total_violations"))
    return t.select("properties", safe_divide("escalated", "properties").alias("pct_escalated"),
                    "total_violations")


def stage_distribution(sets: PinSets, scope: Scope | str | None = None) -> DataFrame:
    """Distinct properties by current stage."""
    return (sets.by_flags(scope).groupBy("current_stage").agg(
        F.sum("properties").cast("bigint").alias("properties")).where("properties > 0"))
