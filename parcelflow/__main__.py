"""Command line: land feeds, build every table, read dashboard metrics.

    python -m parcelflow land  --registry feeds.json --raw ROOT [--include-frozen]
    python -m parcelflow refresh --drops FOLDER --table npd_violations --raw ROOT
    python -m parcelflow build --raw ROOT --out ROOT [--target dev] --as-of 2026-12-01
    python -m parcelflow build --test-tables /root/testdata/sf0.01 --out ROOT
    python -m parcelflow serve --out ROOT [--target dev] --metric funnel [--district 3]
                               [--from 2020-01-01] [--to 2020-12-31]
    python -m parcelflow serve --out ROOT --mart mart_council_district
    python -m parcelflow serve --out ROOT --scorecards

``feeds.json`` is a list of ``{"table": ..., "source": ..., "mode": "live"|"frozen"}``.
The session comes from ``spark-submit`` (or a local one when run directly).
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from pyspark.sql import DataFrame, SparkSession

from parcelflow.functions import AS_OF_DEFAULT
from parcelflow.session import apply_engine_conf

METRICS = ("funnel", "kpis", "trend", "top_types", "resolution", "heatmap", "stages")
MARTS = ("mart_blight_funnel", "mart_blight_hotspots", "mart_council_district",
         "mart_resolution_time", "mart_top_violation_types", "mart_violations_trend")


def _spark() -> SparkSession:
    return apply_engine_conf(SparkSession.builder.appName("parcelflow").getOrCreate())


def _raw_feeds(spark: SparkSession, args) -> dict:
    from parcelflow.sources import testdata
    from parcelflow.sources.publish import Published
    from parcelflow.sources.seeds import builtin_labels, read_labels_csv

    if args.test_tables:
        return testdata.raw_feeds(spark, args.test_tables)
    published = Published(spark, args.raw)
    manifest = published.manifest()  # one set of feeds, whatever is landed meanwhile
    feeds = {t: published.read(t, manifest) for t in
             ("npd_violations", "historical_violations", "dangerous_buildings")}
    feeds["violation_labels"] = (read_labels_csv(spark, args.labels) if args.labels
                                 else builtin_labels(spark))
    return feeds


def _served(spark: SparkSession, args) -> DataFrame:
    """The metric, mart in display order or scorecards that ``serve`` asks for."""
    from parcelflow.plans import pin_bitmaps, serving
    from parcelflow.plans.build import TableStore

    store = TableStore(spark, args.out, args.target)
    if args.scorecards:
        return serving.scorecards(store.read("mart_blight_funnel"),
                                  store.read("mart_council_district"))
    if args.mart:
        return serving.presented(args.mart, store.read(args.mart))
    scope = (args.district, args.first, args.last)
    sets = {"funnel": pin_bitmaps.funnel, "kpis": pin_bitmaps.kpis,
            "stages": pin_bitmaps.stage_distribution}
    if args.metric in sets:  # distinct properties: off the stored bitmaps
        tables = [store.read(t) for t in ("pin_months", "pin_days", "pin_flags")]
        return sets[args.metric](pin_bitmaps.PinSets(*tables), scope)
    metric = {"trend": serving.live_trend, "top_types": serving.live_top_types,
              "resolution": serving.live_resolution, "heatmap": serving.live_heatmap}[args.metric]
    return metric(store.read("mart_dashboard"), scope)


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="parcelflow")
    sub = ap.add_subparsers(dest="cmd", required=True)
    land = sub.add_parser("land")
    land.add_argument("--registry", required=True)
    land.add_argument("--raw", required=True)
    land.add_argument("--include-frozen", action="store_true")
    r = sub.add_parser("refresh")
    r.add_argument("--drops", required=True)
    r.add_argument("--table", required=True)
    r.add_argument("--raw", required=True)
    b = sub.add_parser("build")
    src = b.add_mutually_exclusive_group(required=True)
    src.add_argument("--raw")
    src.add_argument("--test-tables")
    b.add_argument("--labels")
    b.add_argument("--out", required=True)
    b.add_argument("--target", default="dev")
    b.add_argument("--as-of", type=dt.date.fromisoformat, default=None)
    s = sub.add_parser("serve")
    s.add_argument("--out", required=True)
    s.add_argument("--target", default="dev")
    what = s.add_mutually_exclusive_group(required=True)
    what.add_argument("--metric", choices=METRICS)
    what.add_argument("--mart", choices=MARTS)
    what.add_argument("--scorecards", action="store_true")
    s.add_argument("--district")
    s.add_argument("--from", dest="first", type=dt.date.fromisoformat)
    s.add_argument("--to", dest="last", type=dt.date.fromisoformat)
    args = ap.parse_args(argv)
    spark = _spark()

    if args.cmd == "land":
        from parcelflow.sources.landing import Feed, land_registry
        with open(args.registry) as fh:
            feeds = [Feed(**f) for f in json.load(fh)]
        for table, df in land_registry(spark, feeds, args.raw, args.include_frozen).items():
            print(f"{table}: landed {len(df.columns)} text columns")
        return 0

    if args.cmd == "refresh":
        from parcelflow.streaming import refresh_feed
        rows = refresh_feed(spark, args.drops, args.raw, args.table)
        print(f"{args.table}: {rows} rows of a new drop" if rows else f"{args.table}: no new drop")
        return 0

    if args.cmd == "build":
        from parcelflow.operators.checks import build_checks
        from parcelflow.plans.build import build
        as_of = args.as_of or (AS_OF_DEFAULT if args.test_tables else dt.date.today())
        report: list = []
        build(_raw_feeds(spark, args), as_of, args.out, args.target,
              checks=build_checks(report))
        for name, severity, failures in report:
            if failures:
                print(f"{severity.upper()} {name}: {failures}")
        print(f"built {args.target} as of {as_of}: {len(report)} checks run")
        return 0

    for row in _served(spark, args).toLocalIterator():  # a partition at a time
        print(json.dumps(row.asDict(), default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
