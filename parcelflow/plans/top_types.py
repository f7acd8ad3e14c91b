"""The most frequent types of any scope without counting it again.

For each month and district (a cell) the types' counts are stored in descending order.
The top k of a scope come off the cells' heads by a threshold algorithm: read the first
``depth`` entries of every cell, count the types seen there in all cells of the scope,
and add up the counts at which the heads end: no type that was not seen can have more
than that sum.  When the k-th count is above it, the answer is exact; else the
depth doubles, until the cells are read whole.  Odd days at the ends of a date range are
counted from the rows of those days alone, as one more cell.  Day, district and label are
all it takes: rows of the wide table, or :func:`labelled` violations, for which no wide
table is built.

Types are few in a city's ordinances; the work saved grows with their number, as in
feeds with free codes.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelflow.functions import year_of
from parcelflow.operators import top_k
from parcelflow.plans.dims import dim_property
from parcelflow.plans.history import int_property_rollup
from parcelflow.plans.pin_bitmaps import Scope, month_of, on_days, split_range, within
from parcelflow.session import stored

CELL = ["month", "council_district"]
FIRST_DEPTH = 32
UNKNOWN = "UNKNOWN"


def unknown_properties(history: DataFrame, dangerous: DataFrame) -> int:
    """Rows that the property dimension has for UNKNOWN: a feed may hold a property of
    that name beside the added member.  All others have one row each, by the rollup and
    the anti join; so only the rows of this pin are read."""
    mine = F.col("pin") == UNKNOWN
    some = dim_property(int_property_rollup(history.where(mine)), dangerous.where(mine))
    return some.where(mine).count()


def labelled(violations: DataFrame, dim_type: DataFrame, unknown: int) -> DataFrame:
    """What is counted of the wide table, off the distinct violations: year, date_found,
    council_district and short_label.  Where the property dimension has ``unknown`` rows for
    UNKNOWN, the wide table has as many for each violation without a pin."""
    copies = F.when(F.col("pin") == UNKNOWN, F.lit(unknown)).otherwise(F.lit(1))
    if unknown > 1:
        violations = violations.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies)))
    return (violations.select("violation_code", "date_found", "council_district")
            .join(dim_type.select("violation_code", "short_label"), "violation_code", "left")
            .select(year_of("date_found").alias("year"), "date_found", "council_district",
                    "short_label"))


def type_cells(wide: DataFrame) -> DataFrame:
    """year, CELL, place (from 1, by descending count), short_label, violations."""
    counts = wide.groupBy("year", month_of("date_found").alias("month"), "council_district",
                          "short_label").agg(F.count(F.lit(1)).alias("violations"))
    order = Window.partitionBy("year", *CELL).orderBy(
        F.desc("violations"), F.asc_nulls_first("short_label"))
    return counts.withColumn("place", F.row_number().over(order))


@dataclass(frozen=True)
class TopTypes:
    """The answer, and what it took: the depth reached, entries read off the heads, and
    all entries of the scope."""
    rows: DataFrame
    depth: int
    read: int
    entries: int


def _best(counts: DataFrame, k: int) -> DataFrame:
    return top_k(counts, k, [F.col("violations").desc(), F.col("short_label").asc_nulls_first()])


def top_types(cells: DataFrame, wide: DataFrame, scope: Scope | str | None = None, k: int = 20,
              first_depth: int = FIRST_DEPTH) -> TopTypes:
    district, first, last = scope if isinstance(scope, tuple) else (scope, None, None)
    whole, odd = split_range(first, last)
    low, high = whole or (None, None)
    here = (F.lit(whole is not None) & within("month", low, high)
            & within("year", low and low // 100, high and high // 100))
    mine = F.lit(True) if district is None else F.col("council_district") == district
    lists = cells.where(here & mine).select(*CELL, "place", "short_label", "violations")
    if odd:
        rows = wide.where(on_days(odd, "year", lambda d: d.year) & mine)
        edge = rows.groupBy("short_label").agg(F.count(F.lit(1)).alias("violations"))
        placed = edge.select(  # one more cell; its types are as few as types are
            F.lit(0).alias("month"), F.lit(None).cast("string").alias("council_district"),
            F.row_number().over(Window.orderBy(F.desc("violations"), F.asc_nulls_first(
                "short_label"))).alias("place"), "short_label", "violations")
        lists = lists.unionByName(stored(placed, "odd-days"))
    size = lists.agg(F.count(F.lit(1)).alias("n"), F.max("place").alias("deepest")).first()
    depth = first_depth
    while True:
        heads = lists.where(F.col("place") <= depth)
        seen = heads.select("short_label").distinct()
        counts = stored(lists.join(seen, lists["short_label"].eqNullSafe(seen["short_label"]),
                                   "left_semi").groupBy("short_label").agg(
                                       F.sum("violations").alias("violations")), "seen-types")
        ends = lists.where(F.col("place") == depth).agg(
            F.coalesce(F.sum("violations"), F.lit(0))).first()[0]
        best = _best(counts, k)
        kth = best.agg(F.count(F.lit(1)).alias("n"), F.min("violations").alias("least")).first()
        read_whole = depth >= (size.deepest or 0)
        # a type not seen has at most what the heads end at, in all cells together
        if read_whole or (kth.n == k and kth.least > ends):
            return TopTypes(best, depth, size.n if read_whole else heads.count(), size.n)
        depth *= 2
