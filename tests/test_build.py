"""The ordered build: every table written once, checks after each."""

import os

from parcelflow.functions import AS_OF_DEFAULT
from parcelflow.operators.checks import build_checks
from parcelflow.plans.build import LAYERS, TableStore, build
from parcelflow.sources import testdata
from parcelflow.sources.seeds import VIOLATION_LABELS, builtin_labels, read_labels_csv
from tests.conftest import SF_SMALL


def test_ordered_build_with_checks(spark, scratch):
    report = []
    m = build(testdata.raw_feeds(spark, SF_SMALL), AS_OF_DEFAULT, f"{scratch}/out", "ci",
              checks=build_checks(report))
    for name in LAYERS:
        assert os.path.isdir(m.store.path(name)), name
        assert "/ci/versions/" in m.store.path(name)
    # what was built is published, and read back from one manifest
    back = TableStore(spark, f"{scratch}/out", "ci")
    assert back.read("mart_dashboard").columns == m.mart_dashboard.columns
    assert back.read("fact_violation").count() == m.fact_violation.count()
    names = {r[0] for r in report}
    assert len(report) == 40  # 37 column tests + 3 singular assertions
    assert "assert_dangerous_after_first_violation" in names  # warn-only, reported
    assert all(n == 0 for key, sev, n in report if sev == "error")
    # one directory a year, whatever the districts' texts are
    folders = [d for d in os.listdir(m.store.path("mart_dashboard")) if "=" in d]
    assert folders and all(d.startswith("year=20") for d in folders)


def test_failed_build_leaves_the_published_tables(spark, scratch, monkeypatch):
    from parcelflow.plans import dims
    from parcelflow.sources.publish import Published

    raw = testdata.raw_feeds(spark, SF_SMALL)
    store = TableStore(spark, f"{scratch}/out", "prod")
    store.write("dim_date", spark.range(7).toDF("date_sk"))
    store.publish()

    def lost(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(dims, "dim_council_district", lost)
    try:
        build(raw, AS_OF_DEFAULT, f"{scratch}/out", "prod")
        raise AssertionError
    except RuntimeError as e:
        assert str(e) == "lost"
    now = Published(spark, f"{scratch}/out/prod")
    assert list(now.manifest().folders) == ["dim_date"] and now.read("dim_date").count() == 7


def test_seed_csv_round_trip(spark, scratch):
    path = f"{scratch}/labels"
    builtin_labels(spark).write.option("header", True).csv(path)
    back = read_labels_csv(spark, path)
    assert sorted(tuple(r) for r in back.collect()) == sorted(VIOLATION_LABELS)
    assert back.select("violation_code").distinct().count() == len(VIOLATION_LABELS)


def test_no_folder_is_made_up(spark, monkeypatch):
    import pytest

    from parcelflow import session

    class Unset:
        class conf:
            get = staticmethod(lambda key, default=None: default)

        class sparkContext:
            getCheckpointDir = staticmethod(lambda: None)

    with pytest.raises(session.SharedFolderError, match="spark.checkpoint.dir"):
        session.checkpoint_root(Unset)


def test_queries_share_the_stored_tables(spark):
    from __spark_entry__ import models
    from parcelflow.session import input_state

    assert models(spark, SF_SMALL) is models(spark, SF_SMALL)
    state = input_state(spark, SF_SMALL)
    assert any(name == "orders.parquet" and size > 0 for name, size, _ in state)
