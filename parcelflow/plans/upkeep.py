"""Upkeep of the accumulating snapshot from one drop of the live feed to the next.

The snapshot is kept as a mergeable state per pin: first and last date, counters, the
set of codes, the most recent row, and digests of the pin's rows.  A state does not
depend on the build day: the age of open violations is kept as their number and the
sum of their found days, so that a later day only changes the projection.

There is one state a feed.  The archive never changes, so its state is computed once;
the live feed is replaced by each drop, so:

1. the new drop's rows are digested per pin (a few sums of row hashes);
2. pins whose digest differs from the stored one are new, changed or gone;
3. only their rows of the new drop are aggregated to states, only their states of the
   archive are read, and only their snapshot rows are replaced.

Nothing of the stored history is read again.  A feed that sends only additions needs
no digests: :func:`absorbed` merges the state of the new rows into the stored one.

Defined results: rows with a NULL or empty pin have no state, as in the rollup; a pin
that leaves the live feed keeps its archive state, or goes when it has none; equal rows
count each time; a drop equal to the stored one changes nothing.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelflow.plans.facts import fact_property_lifecycle
from parcelflow.plans.history import _RECENT_ATTRS, HISTORY_COLUMNS, ROLLUP_COLUMNS

#: What a row is told apart by: all of it but its age, which the build day gives.
HASHED = [c for c in HISTORY_COLUMNS if c != "days_open"]
#: A 64-bit hash is summed in pieces, so that no sum of up to 2^43 rows overflows.
PIECE_BITS = 20
DIGEST = ["live_rows", "digest_low", "digest_mid", "digest_high"]
_ORDER = ["date_found", "source_system", "violation_id", *_RECENT_ATTRS]

#: Columns of a state that merge by a plain aggregate, and how.
_MERGED: dict[str, Callable[[str], Column]] = {
    "first_violation_date": F.min, "last_violation_date": F.max, "total_violations": F.sum,
    "resolved_violations": F.sum, "closed_days": F.sum, "closed_rows": F.sum,
    "open_rows": F.sum, "open_found_days": F.sum, "neighborhood": F.max, "recent": F.max,
}
STATE_COLUMNS = ["pin", *_MERGED, "codes"]


def _cited(history: DataFrame) -> DataFrame:
    return history.where(F.col("pin").isNotNull() & (F.col("pin") != ""))


def pin_digests(history: DataFrame) -> DataFrame:
    """pin and DIGEST: the number of its rows and sums of their hashes, the same for
    the same rows in any order.  Fixed-width sums: partial on the map side."""
    return _cited(history).groupBy("pin").agg(*_digest())


def _digest() -> list[Column]:
    nulls = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in HASHED])
    h = F.xxhash64(*HASHED, nulls)  # a NULL leaves the hash as it is
    piece = lambda k: F.sum(F.shiftrightunsigned(h, k * PIECE_BITS).bitwiseAND(
        F.lit((1 << PIECE_BITS) - 1)))
    return [F.count(F.lit(1)).alias("live_rows"),
            *[piece(k).alias(n) for k, n in enumerate(DIGEST[1:])]]


def pin_states(history: DataFrame, digests: bool = False) -> DataFrame:
    """The state (STATE_COLUMNS) of every pin of ``history``; with ``digests``, its DIGEST
    too, in the same read.

    A pin's set of codes is bounded by the ordinance codes, whatever its rows."""
    closed = F.col("date_resolved").isNotNull()
    found = F.unix_date("date_found")
    return _cited(history).groupBy("pin").agg(
        F.min("date_found").alias("first_violation_date"),
        F.max("date_found").alias("last_violation_date"),
        F.count(F.lit(1)).alias("total_violations"),
        F.count_if("is_resolved").alias("resolved_violations"),
        F.coalesce(F.sum(F.when(closed, F.unix_date("date_resolved") - found)), F.lit(0))
        .cast("bigint").alias("closed_days"),
        F.count(F.when(closed, found)).alias("closed_rows"),
        F.count(F.when(~closed, found)).alias("open_rows"),
        F.coalesce(F.sum(F.when(~closed, found)), F.lit(0)).cast("bigint")
        .alias("open_found_days"),
        F.max("neighborhood").alias("neighborhood"),
        F.max(F.struct(*_ORDER)).alias("recent"),
        F.array_sort(F.collect_set("violation_code")).alias("codes"),
        *(_digest() if digests else []),
    ).select(*STATE_COLUMNS, *(DIGEST if digests else []))


def absorbed(*states: DataFrame) -> DataFrame:
    """One state a pin out of the states of several sets of rows."""
    both = reduce(DataFrame.unionByName, [s.select(*STATE_COLUMNS) for s in states])
    return both.groupBy("pin").agg(
        *[how(c).alias(c) for c, how in _MERGED.items()],
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("codes")))).alias("codes"),
    ).select(*STATE_COLUMNS)


def rollup_of(states: DataFrame, as_of: dt.date) -> DataFrame:
    """The property rollup (K5) on a build day: a projection of the states."""
    aged = F.col("closed_rows") + F.col("open_rows")
    days = (F.col("closed_days") + F.col("open_rows") * F.unix_date(F.lit(as_of))
            - F.col("open_found_days"))
    derived = {
        "distinct_violation_types": F.size("codes").cast("bigint"),
        "avg_days_open": F.try_divide(days.cast("double"), aged.cast("double")),
    } | {c: F.col(f"recent.{c}") for c in _RECENT_ATTRS}
    return states.select(*[derived.get(c, F.col(c)).alias(c) for c in ROLLUP_COLUMNS])


def snapshot_of(states: DataFrame, dangerous_by_pin: DataFrame, as_of: dt.date) -> DataFrame:
    """The accumulating snapshot (K12) on a build day."""
    return fact_property_lifecycle(rollup_of(states, as_of), dangerous_by_pin)


def compared(stored_digests: DataFrame, new_digests: DataFrame) -> DataFrame:
    """pin, ``change``: new, changed, gone or same, of the live feed's pins, and the new
    drop's DIGEST (NULL for a pin that is gone)."""
    old = stored_digests.select("pin", *[F.col(c).alias(f"old_{c}") for c in DIGEST])
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"old_{c}")) for c in DIGEST])
    change = (F.when(F.col("old_live_rows").isNull(), "new").when(F.col("live_rows").isNull(), "gone")
              .when(same, "same").otherwise("changed"))
    return old.join(new_digests, "pin", "full").select("pin", change.alias("change"), *DIGEST)


class SnapshotUpkeep:
    """The stored states, and the step from one drop to the next.

    ``keep(df, name)`` writes a table and returns it as read back; a drop's tables
    replace the stored ones only in the returned object, so a run that fails leaves the
    stored ones as they are.
    """

    def __init__(self, archive: DataFrame, live: DataFrame, total: DataFrame, digests: DataFrame,
                 keep: Callable[[DataFrame, str], DataFrame], changes: DataFrame | None = None):
        self.archive, self.live, self.total, self.digests = archive, live, total, digests
        self.keep, self.changes = keep, changes

    @classmethod
    def start(cls, archive_rows: DataFrame, live_rows: DataFrame,
              keep: Callable[[DataFrame, str], DataFrame]) -> SnapshotUpkeep:
        archive = keep(pin_states(archive_rows), "archive_states")
        live = keep(pin_states(live_rows, digests=True), "live_states")
        return cls(archive, live.select(*STATE_COLUMNS), keep(absorbed(archive, live), "total_states"),
                   live.select("pin", *DIGEST), keep)

    def refresh(self, live_rows: DataFrame) -> SnapshotUpkeep:
        """The states after ``live_rows`` has replaced the live feed.  They are read
        twice; rows that are costly to derive are given stored."""
        changes = self.keep(compared(self.digests, pin_digests(live_rows)), "changes")
        touched = self.keep(changes.where("change != 'same'").select("pin", "change"), "touched")
        pins = touched.select("pin")
        fresh = self.keep(pin_states(live_rows.join(
            touched.where("change != 'gone'").select("pin"), "pin", "left_semi")), "fresh_states")
        live = self.keep(self.live.join(pins, "pin", "left_anti").unionByName(fresh), "live_states")
        again = absorbed(self.archive.join(pins, "pin", "left_semi"), fresh)
        total = self.keep(self.total.join(pins, "pin", "left_anti").unionByName(again),
                          "total_states")
        digests = self.keep(changes.where("change != 'gone'").select("pin", *DIGEST),
                            "live_digests")
        return SnapshotUpkeep(self.archive, live, total, digests, self.keep, changes)

    def rollup(self, as_of: dt.date) -> DataFrame:
        return rollup_of(self.total, as_of)

    def snapshot(self, dangerous_by_pin: DataFrame, as_of: dt.date) -> DataFrame:
        return snapshot_of(self.total, dangerous_by_pin, as_of)

    def change_report(self) -> DataFrame:
        """Pins and rows of the new drop by kind of change."""
        return self.changes.groupBy("change").agg(
            F.count(F.lit(1)).alias("pins"),
            F.coalesce(F.sum("live_rows"), F.lit(0)).cast("bigint").alias("live_rows"))
