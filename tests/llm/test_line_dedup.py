"""Operator 1: spread, the doubtful zone, and awkward rows."""

from collections import defaultdict

from pyspark.sql import functions as F

from parcelflow.llm.line_dedup import remove_boilerplate, site_spread
from tests.llm.cases import DOCUMENTS, documents, empty


def brute(rows, min_sites):
    sites = defaultdict(set)
    for _, text, _, source in rows:
        for line in (text or "").split("\n"):
            if source is not None:
                sites[line.strip(" ")].add(source)
    bad = {x for x, s in sites.items() if x and len(s) >= min_sites}
    out = []
    for i, text, _, _ in rows:
        lines = [] if text is None else text.split("\n")
        kept = [x for x in lines if x.strip(" ") not in bad]
        out.append((i, len(lines), len(lines) - len(kept), None if text is None else "\n".join(kept)))
    return out


def rows_of(found):
    return [tuple(r) for r in found.select("row.doc_id", "n_lines", "n_removed", "row.text").collect()]


def test_awkward_rows_against_brute_force(spark):
    for min_sites in (1, 2, 3, 9):
        found = remove_boilerplate(documents(spark), min_sites)
        assert sorted(map(repr, rows_of(found))) == sorted(map(repr, brute(DOCUMENTS, min_sites)))
    assert found.select("row.*").columns == documents(spark).columns
    assert remove_boilerplate(empty(spark)).count() == 0


def test_positions_and_whole_removal(spark):
    lines = ["x", "a", "x", "", " x ", "b", "x"]
    rows = [(k, "\n".join(lines if k else ["x", "x"]), "en", f"s{k}") for k in range(4)]
    assert sorted(rows_of(remove_boilerplate(documents(spark, rows), 4))) == sorted(brute(rows, 4))
    one = rows_of(remove_boilerplate(documents(spark, [(1, "x", "en", "a")]), 1))
    assert one == [(1, 1, 1, "")]


def test_exact_counts_near_the_threshold(spark):
    # sites per line around the threshold: the sketch alone would err on some
    min_sites, widths = 400, [1, 350, 390, 398, 399, 400, 401, 402, 410, 500, 900]
    lines = spark.createDataFrame([(h, n) for h, n in enumerate(widths)], "h long, n int").select(
        "h", F.explode(F.sequence(F.lit(1), "n")).alias("site")).withColumn(
        "site", F.col("site").cast("string"))
    found = {r.h for r in site_spread(lines.union(lines), min_sites).collect()}
    assert found == {h for h, n in enumerate(widths) if n >= min_sites}
