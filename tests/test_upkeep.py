"""Snapshot states: merging, change detection, and what a refresh reads."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from parcelflow.functions import AS_OF_DEFAULT
from parcelflow.plans import history, upkeep
from parcelflow.plans.distributions import days_distribution, merged
from parcelflow.plans.pin_bitmaps import BITS, pin_numbers, split_range
from parcelflow.session import stored


@pytest.fixture(scope="module")
def rows(small_models):
    return stored(small_models.int_violations_unioned, "upkeep-rows")


def same(a, b):
    assert a.columns == b.columns
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def close(df):
    return df.withColumn("avg_days_open", F.round("avg_days_open", 9))


def test_states_of_parts_merge_to_the_state_of_all(rows):
    parts = [rows.where(F.pmod(F.xxhash64("violation_id"), F.lit(3)) == k) for k in range(3)]
    same(upkeep.absorbed(*[upkeep.pin_states(p) for p in parts]), upkeep.pin_states(rows))


def test_one_state_serves_every_build_day(rows):
    states = upkeep.pin_states(rows)
    raw = rows.drop("days_open")
    for day in (AS_OF_DEFAULT, dt.date(2020, 2, 29)):
        again = history.reconciled(raw, day).select(*rows.columns)
        same(close(upkeep.rollup_of(states, day)), close(history.int_property_rollup(again)))


def test_digests_tell_rows_with_swapped_nulls_apart(rows):
    one = rows.where("pin != ''").limit(1)
    a = one.withColumns({"zip_code": F.lit("x"), "council_district": F.lit(None).cast("string")})
    b = one.withColumns({"zip_code": F.lit(None).cast("string"), "council_district": F.lit("x")})
    da, db = (upkeep.pin_digests(d.select(*rows.columns)).first() for d in (a, b))
    assert da != db
    twice = upkeep.pin_digests(one.unionAll(one)).first()
    assert twice != upkeep.pin_digests(one).first()


def test_refresh_equals_a_new_start(rows):
    archive = rows.where("source_system = 'historical'")
    live = rows.where("source_system = 'energov'")
    key = F.xxhash64("pin")
    second = (live.where(F.pmod(key, F.lit(5)) != 0)  # gone
              .unionByName(live.where(F.pmod(key, F.lit(7)) == 1))  # counted twice
              .unionByName(live.limit(3).withColumn("pin", F.lit("brand new"))))
    first = upkeep.SnapshotUpkeep.start(archive, live, stored)
    after, anew = first.refresh(second), upkeep.SnapshotUpkeep.start(archive, second, stored)
    same(after.total, anew.total)
    same(after.live, anew.live)
    same(after.digests, anew.digests)
    kinds = {r.change: r.pins for r in after.change_report().collect()}
    assert set(kinds) == {"new", "changed", "gone", "same"} and kinds["new"] == 1
    # the next step starts from the refreshed states, back to the first drop
    same(after.refresh(live).total, first.total)
    untouched = after.refresh(second)
    assert {r.change for r in untouched.change_report().collect()} == {"same"}
    same(untouched.total, after.total)


def test_refresh_from_and_to_an_empty_feed(rows):
    archive, live = rows.where("source_system = 'historical'"), rows.where("source_system = 'energov'")
    empty = live.where("false")
    start = upkeep.SnapshotUpkeep.start(archive, empty, stored)
    full = start.refresh(live)
    same(full.total, upkeep.absorbed(upkeep.pin_states(archive), upkeep.pin_states(live)))
    same(full.refresh(empty).total, upkeep.pin_states(archive))


def test_only_touched_pins_of_the_archive_are_read(rows):
    seen = []

    def keep(df, name):
        seen.append((name, df))
        return stored(df, name)

    archive, live = rows.where("source_system = 'historical'"), rows.where("source_system = 'energov'")
    start = upkeep.SnapshotUpkeep.start(archive, live, keep)
    one = live.where("pin != ''").select("pin").first().pin
    seen.clear()
    after = start.refresh(live.where(F.col("pin") != one).unionByName(
        live.where(F.col("pin") == one).withColumn("status_raw", F.lit("Moved"))))
    assert [(r.change, r.pins) for r in after.change_report().where("change != 'same'").collect()] == [
        ("changed", 1)]
    fresh = dict(seen)["fresh_states"]
    assert [r.pin for r in fresh.select("pin").collect()] == [one]
    plan = dict(seen)["total_states"]._jdf.queryExecution().optimizedPlan().toString()
    assert "int_violations" not in plan and "violation-base" not in plan  # states only


def test_dense_numbers_and_one_set_of_flags_a_bucket(small_models):
    m = small_models
    for shard in (50, 1_000_000):
        found = pin_numbers(m.dim_property, m.fact_property_lifecycle, shard).collect()
        assert len(found) == m.dim_property.count()
        assert len({(r.bucket, r.position) for r in found}) == len(found)
        assert all(0 <= r.position < BITS for r in found)
        flags = {}
        for r in found:
            flags.setdefault(r.bucket, set()).add((r.is_repeat, r.is_dangerous, r.current_stage))
        assert all(len(f) == 1 for f in flags.values())
        for bucket in flags:  # dense: a bucket's positions leave no gap
            places = sorted(r.position for r in found if r.bucket == bucket)
            assert places == list(range(len(places)))


def test_split_range():
    d = dt.date
    assert split_range(None, None) == ((None, None), [])
    assert split_range(d(2006, 1, 1), d(2006, 12, 31)) == ((200601, 200612), [])
    assert split_range(d(2006, 1, 2), None) == ((200602, None), [(d(2006, 1, 2), d(2006, 1, 31))])
    assert split_range(None, d(2006, 2, 27)) == ((None, 200601), [(d(2006, 2, 1), d(2006, 2, 27))])
    assert split_range(d(2006, 2, 3), d(2006, 2, 9)) == (None, [(d(2006, 2, 3), d(2006, 2, 9))])
    assert split_range(d(2006, 2, 3), d(2006, 3, 9)) == (None, [(d(2006, 2, 3), d(2006, 3, 9))])
    assert split_range(d(2006, 3, 9), d(2006, 2, 3)) == (None, [])
    whole, odd = split_range(d(2005, 12, 15), d(2006, 2, 28))
    assert whole == (200601, 200602) and odd == [(d(2005, 12, 15), d(2005, 12, 31))]


def test_distributions_of_parts_merge(small_models):
    fact = small_models.fact_violation
    parts = [fact.where(F.pmod(F.xxhash64("violation_pk"), F.lit(2)) == k) for k in (0, 1)]
    same(merged(*map(days_distribution, parts)), days_distribution(fact))
