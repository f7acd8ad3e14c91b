"""Landing of NDJSON feeds, the registry, and the streaming refresh."""

import json
import os

import pytest

from parcelflow.sources.landing import (
    Feed, LandingError, column_name, land_registry, read_all_text, survey,
)
from parcelflow.sources.publish import Published, PublishError
from parcelflow.streaming import refresh_feed


def write_lines(path, records, name="part-0.json"):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as fh:
        for r in records:
            fh.write((r if isinstance(r, str) else json.dumps(r)) + "\n")
    return path


def land(spark, source, root, table="t"):
    return land_registry(spark, [Feed(table, source)], root)[table]


def rows(spark, root, table="t"):
    return sorted(tuple(r) for r in Published(spark, root).read(table).collect())


def test_column_name():
    assert column_name(":@computed_region_9t2m_phkm") == "computed_region_9t2m_phkm"
    assert column_name("9a") == "_9a"
    assert column_name("Case Number") == "case_number"
    assert column_name("É9_x-") == "_9_x" and column_name("::") == ""


def test_survey_counts_lines_and_broken_ones(spark, scratch):
    src = write_lines(f"{scratch}/in", [{"b": 1}, "", {"a": None}, "{}", "nope", "  "])
    found = survey(spark, src)
    assert (found.keys, found.lines, found.broken) == (["a", "b"], 4, 1)
    with pytest.raises(LandingError, match="over 1 different keys"):
        survey(spark, src, most_keys=1)
    for i, (lines, counts) in enumerate((([" "], (0, 0)), (["nope"], (1, 1)), (["{}"], (1, 0)))):
        none = survey(spark, write_lines(f"{scratch}/none{i}", lines))
        assert none.keys == [] and (none.lines, none.broken) == counts
    with pytest.raises(LandingError, match="no record has a key"):
        land(spark, write_lines(f"{scratch}/blank", ["{}"]), f"{scratch}/raw")


def test_all_text_landing(spark, scratch):
    src = write_lines(f"{scratch}/in", [
        '{"a": 1.50, ":@computed_region_9t2m_phkm": "3", "9a": "x", '
        '"loc": {"type": "Point", "coordinates": [-94.5, 39.1]}}',
        {"a": None, "b": True, "lst": [1, 2]},
        "",
    ])
    df = read_all_text(spark, src)
    assert df.columns == ["_9a", "a", "b", "computed_region_9t2m_phkm", "loc", "lst"]
    assert all(t == "string" for _, t in df.dtypes)
    rows = {r["_9a"]: r.asDict() for r in df.collect()}
    assert rows["x"]["a"] == "1.50"
    assert json.loads(rows["x"]["loc"])["coordinates"] == [-94.5, 39.1]
    assert rows[None]["b"] == "true" and json.loads(rows[None]["lst"]) == [1, 2]


def test_key_collision_is_an_error(spark, scratch):
    src = write_lines(f"{scratch}/in", [{"a b": "1"}, {"a_b": "2"}])
    with pytest.raises(LandingError):
        read_all_text(spark, src)


def test_empty_feed_keeps_old_table(spark, scratch):
    root = f"{scratch}/raw"
    land(spark, write_lines(f"{scratch}/good", [{"k": "1"}, {"k": "2"}]), root)
    with pytest.raises(LandingError, match="no rows"):
        land(spark, write_lines(f"{scratch}/empty", [" "]), root)
    assert rows(spark, root) == [("1",), ("2",)]


def test_registry_skips_frozen(spark, scratch):
    live = write_lines(f"{scratch}/live", [{"k": "1"}])
    frozen = write_lines(f"{scratch}/frozen", [{"k": "1"}, {"k": "2"}])
    feeds = [Feed("historical_violations", frozen, "frozen"), Feed("npd_violations", live)]
    got = land_registry(spark, feeds, f"{scratch}/raw")
    assert set(got) == {"npd_violations"}
    got = land_registry(spark, feeds, f"{scratch}/raw", include_frozen=True)
    assert got["historical_violations"].count() == 2


@pytest.mark.parametrize("broken", ['{"k": "2"', '{"k": "2"} x', '[1]', '"text"', "k=2"])
@pytest.mark.parametrize("last", [True, False])
def test_broken_line_stops_the_landing(spark, scratch, broken, last):
    root = f"{scratch}/raw"
    land(spark, write_lines(f"{scratch}/good", [{"k": "1"}, {"k": "2"}]), root)
    lines = [{"k": "1"}, broken] if last else [broken, {"k": "1"}]
    with pytest.raises(LandingError, match="1 lines are no JSON object"):
        land(spark, write_lines(f"{scratch}/bad", lines), root)
    assert rows(spark, root) == [("1",), ("2",)]
    assert os.listdir(f"{root}/manifests").count("00000001.json") == 1


def test_landing_again_replaces_all_feeds_at_once(spark, scratch):
    root = f"{scratch}/raw"
    one = [Feed("a", write_lines(f"{scratch}/a1", [{"k": "1"}, {"k": "2"}])),
           Feed("b", write_lines(f"{scratch}/b1", [{"k": "3"}])),
           Feed("old", write_lines(f"{scratch}/old", [{"k": "9"}]), "frozen")]
    land_registry(spark, one, root, include_frozen=True)
    held = Published(spark, root).manifest()
    # the second feed is broken: neither is replaced
    two = [Feed("a", write_lines(f"{scratch}/a2", [{"z": "4"}])),
           Feed("b", write_lines(f"{scratch}/b2", ["broken"])), one[2]]
    with pytest.raises(LandingError):
        land_registry(spark, two, root)
    assert rows(spark, root, "a") == [("1",), ("2",)] and rows(spark, root, "b") == [("3",)]
    write_lines(f"{scratch}/b2", [{"k": "5"}])
    land_registry(spark, two, root)
    assert rows(spark, root, "a") == [("4",)] and rows(spark, root, "b") == [("5",)]
    assert rows(spark, root, "old") == [("9",)]  # not landed again, still there
    # who holds the manifest of before reads the tables of before
    assert Published(spark, root).read("a", held).count() == 2


def test_two_scans_a_feed(spark, scratch):
    """The event log of a landing: each feed is scanned twice, blank lines and all."""
    import subprocess
    import sys

    src = write_lines(f"{scratch}/in", [{"k": str(i)} for i in range(50)])
    os.makedirs(f"{scratch}/events")
    code = f"""
from pyspark.sql import SparkSession
from parcelflow.session import ENGINE_CONF
b = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
     .config("spark.eventLog.enabled", "true").config("spark.eventLog.compress", "false")
     .config("spark.eventLog.rolling.enabled", "false")
     .config("spark.eventLog.dir", "file://{scratch}/events"))
for k, v in ENGINE_CONF.items():
    b = b.config(k, v)
spark = b.getOrCreate()
from parcelflow.sources.landing import Feed, land_registry
land_registry(spark, [Feed("t", "{src}")], "{scratch}/raw")
spark.stop()
"""
    here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", code], check=True, timeout=300, cwd=here,
                   capture_output=True)
    (log,) = os.listdir(f"{scratch}/events")
    read = 0
    with open(f"{scratch}/events/{log}") as fh:
        for line in fh:
            event = json.loads(line)
            if event.get("Event") == "SparkListenerTaskEnd" and event.get("Task Metrics"):
                read += event["Task Metrics"]["Input Metrics"]["Records Read"]
    assert read == 2 * 50


def test_streaming_refresh_lands_the_newest_drop(spark, scratch):
    drops, root = f"{scratch}/drops", f"{scratch}/raw"
    write_lines(drops, [{"k": "1"}, {"k": "2"}], "week1.json")
    assert refresh_feed(spark, drops, root, "npd") == 2
    for week, day in (("week2.json", 1), ("week3.json", 2)):  # two drops in one run
        write_lines(drops, [{"k": week}], week)
        os.utime(f"{drops}/{week}", (2e9 + day, 2e9 + day))
    assert refresh_feed(spark, drops, root, "npd") == 1
    assert rows(spark, root, "npd") == [("week3.json",)]
    # nothing new: the table stays as it is
    assert refresh_feed(spark, drops, root, "npd") == 0
    assert rows(spark, root, "npd") == [("week3.json",)]


def test_refresh_from_the_command_line(spark, scratch, capsys):
    from parcelflow.__main__ import main

    write_lines(f"{scratch}/drops", [{"k": "1"}], "a.json")
    args = ["refresh", "--drops", f"{scratch}/drops", "--table", "live", "--raw", f"{scratch}/raw"]
    assert main(args) == 0 and "1 rows of a new drop" in capsys.readouterr().out
    assert main(args) == 0 and "no new drop" in capsys.readouterr().out


def write_tables(draft, spark, value, names=("a", "b")):
    for name in names:
        df = spark.range(3).selectExpr("id", f"'{value}' as v")
        df.write.parquet(draft.path(name))
        draft.add(name, df)


def test_a_run_killed_at_any_step_leaves_the_old_set(spark, scratch):
    root = f"{scratch}/t"
    published = Published(spark, root)
    write_tables(first := published.draft(), spark, "old")
    first.publish()
    values = lambda: {r.v for n in ("a", "b") for r in Published(spark, root).read(n).collect()}
    write_tables(published.draft(), spark, "new", ["a"])  # killed between two tables
    assert values() == {"old"}
    write_tables(draft := published.draft(), spark, "new")  # killed before the manifest
    assert values() == {"old"}
    with open(f"{root}/manifests/{draft.version}.new", "w") as fh:  # killed while writing it
        fh.write('{"version": ')
    assert values() == {"old"}
    os.remove(f"{root}/manifests/{draft.version}.new")
    draft.publish()
    assert values() == {"new"}


def test_publishing_twice_at_the_same_time_fails_once(spark, scratch):
    published = Published(spark, f"{scratch}/t")
    write_tables(one := published.draft(), spark, "one")
    write_tables(two := published.draft(), spark, "two")
    one.publish()
    with pytest.raises(PublishError, match="another run"):
        two.publish()
    assert {r.v for r in published.read("a").collect()} == {"one"}
    with pytest.raises(PublishError, match="no published table"):
        published.read("zzz")


def test_expiry_keeps_what_manifests_name(spark, scratch):
    published = Published(spark, f"{scratch}/t")
    for k in range(4):
        write_tables(draft := published.draft(), spark, f"v{k}", ["a"] if k else ["a", "b"])
        draft.publish(carry=True)
    assert published.expire(keep=2) == []  # younger than a day
    gone = published.expire(keep=2, least_age_hours=0)
    assert len(gone) == 1  # the first holds b still, the last two are kept
    assert {r.v for r in published.read("a").collect()} == {"v3"}
    assert {r.v for r in published.read("b").collect()} == {"v0"}
