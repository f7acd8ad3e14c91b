"""The command line: build from the test tables, then serve a metric."""

import json

from parcelflow.__main__ import main


def test_build_then_serve(spark, scratch, capsys):
    from tests.conftest import SF_SMALL
    assert main(["build", "--test-tables", SF_SMALL, "--out", f"{scratch}/wh",
                 "--target", "ci"]) == 0
    assert "40 checks run" in capsys.readouterr().out
    assert main(["serve", "--out", f"{scratch}/wh", "--target", "ci", "--metric", "kpis",
                 "--district", "3"]) == 0
    row = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert row["total_violations"] > 0 and row["properties"] > 0
    assert main(["serve", "--out", f"{scratch}/wh", "--target", "ci", "--metric", "kpis",
                 "--from", "2006-01-01", "--to", "2006-12-31"]) == 0
    year = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert main(["serve", "--out", f"{scratch}/wh", "--target", "ci", "--metric", "trend"]) == 0
    trend = [json.loads(x) for x in capsys.readouterr().out.strip().splitlines()]
    assert {"year": 2006, "violations": year["total_violations"]} in trend
    assert main(["serve", "--out", f"{scratch}/wh", "--target", "ci",
                 "--mart", "mart_council_district"]) == 0
    shown = [json.loads(x)["total_violations"]
             for x in capsys.readouterr().out.strip().splitlines()]
    assert shown == sorted(shown, key=lambda n: -(n or 0))
    assert main(["serve", "--out", f"{scratch}/wh", "--target", "ci", "--scorecards"]) == 0
    cards = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert cards["total_violations"] == sum(t["violations"] for t in trend)
