"""Randomized agreement of the Spark helpers with the oracle's SQL helpers.

Arbitrary short strings over an alphabet rich in the characters the helpers
care about (digits, separators, whitespace, suffix letters, JSON
punctuation) go through the Spark ``Column`` helper and the DuckDB
expression the oracle uses; both must give the same value.
"""

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from parcelflow import oracle
from parcelflow.functions import (
    clean_trim, coord_at, normalize_code, point_coordinates, safe_date, safe_double,
)

ALPHABET = "0123456789-.:T eEdDfF\t\nCOco/x_+npi"
texts = st.lists(st.one_of(st.none(), st.text(alphabet=ALPHABET, max_size=14)),
                 min_size=1, max_size=60)
date_like = st.lists(st.one_of(st.none(), st.from_regex(
    r"\A[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}(T[0-9:.]{0,12}|\n)?\Z", fullmatch=True)), min_size=1,
    max_size=40)
num_like = st.lists(st.one_of(st.none(), st.from_regex(
    r"\A[ ]?[+-]?(0x)?[0-9]{0,3}_?(\.[0-9]{0,3})?([eEp][0-9]{1,3})?[dDfF]?[ \n]?x?\Z", fullmatch=True)),
    min_size=1, max_size=40)


def _both(spark, values, spark_fn, sql_fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    got = {r.i: r.y for r in df.select("i", spark_fn(F.col("x")).alias("y")).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE t (i INTEGER, x VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?, ?)", list(enumerate(values)))
    want = dict(con.execute(f"SELECT i, {sql_fn('x')} FROM t").fetchall())
    return got, want


@settings(max_examples=15, deadline=None)
@given(texts)
def test_trim_agrees(spark, values):
    got, want = _both(spark, values, clean_trim, oracle.trim_ws)
    assert got == want


@settings(max_examples=15, deadline=None)
@given(texts)
def test_normalize_agrees(spark, values):
    got, want = _both(spark, values, normalize_code, oracle.norm_code)
    assert got == want


@settings(max_examples=15, deadline=None)
@given(st.one_of(texts, date_like))
def test_safe_date_agrees(spark, values):
    got, want = _both(spark, values, safe_date, oracle.to_date)
    assert got == want


@settings(max_examples=15, deadline=None)
@given(num_like)
def test_safe_double_agrees(spark, values):
    got, want = _both(spark, values, safe_double, oracle.to_double)
    assert got == want


points = st.lists(st.one_of(st.none(), st.from_regex(
    r'\A ?(\{"coordinates":\[(-94\.5|1e3|null|"7"),(39\.1|"x")\]\}){1,2}[ ,x\]\n]{0,2}\Z',
    fullmatch=True)), min_size=1, max_size=40)


@settings(max_examples=15, deadline=None)
@given(points)
def test_point_agrees(spark, values):
    for i in (0, 1):
        got, want = _both(spark, values, lambda c: coord_at(point_coordinates(c), i),
                          lambda x: oracle.point_coord(x, i))
        assert got == want
