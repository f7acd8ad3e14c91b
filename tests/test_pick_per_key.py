"""latest/first row per key against a brute-force sort on random fixtures.

Equivalent to ROW_NUMBER() OVER (PARTITION BY k ORDER BY a, b DESC NULLS LAST)
= 1 (latest) and ASC NULLS FIRST (first) when the order is total.
"""

from hypothesis import given, settings
from hypothesis import strategies as st

from parcelflow.operators import first_per_key, latest_per_key

rows_st = st.lists(
    st.tuples(st.sampled_from(["p", "q", "r"]),
              st.one_of(st.none(), st.integers(0, 3)),
              st.one_of(st.none(), st.sampled_from(["x", "y", "z"])),
              st.one_of(st.none(), st.integers(0, 2))),
    min_size=1, max_size=40)


def _rank(row):
    return tuple((v is not None, v) for v in row[1:])  # NULL below any value


@settings(max_examples=12, deadline=None)
@given(rows_st)
def test_pick_matches_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "k string, a int, b string, c int")
    latest = {r.k: (r.a, r.b, r.c) for r in
              latest_per_key(df, ["k"], ["a", "b", "c"], []).collect()}
    first = {r.k: (r.a, r.b, r.c) for r in
             first_per_key(df, ["k"], ["a", "b", "c"], []).collect()}
    for k in {r[0] for r in rows}:
        group = [r for r in rows if r[0] == k]
        assert latest[k] == max(group, key=_rank)[1:]
        assert first[k] == min(group, key=_rank)[1:]
