"""Edge rows for the Column helpers (FIXTURES.md §3)."""

import datetime as dt

from pyspark.sql import functions as F

from parcelflow.functions import (
    clean_trim, coord_at, days_between, lat_lng, normalize_code,
    point_coordinates, row_hash, safe_date, safe_divide, safe_double, surrogate_key,
)


def one_col(spark, values, fn, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(fn(F.col("x"))).collect()]


def test_safe_date(spark):
    got = one_col(spark, ["2022-07-25T00:00:00.000", "2022-7-5", "2022", "2022-07",
                          "2022-7-25T00", "07/25/2022", "", None, "2022-02-30",
                          "2022-07-2\n", "\n2022-7-2"], safe_date)
    assert got == [dt.date(2022, 7, 25), dt.date(2022, 7, 5), None, None, None, None, None,
                   None, None, None, None]


def test_safe_double(spark):
    got = one_col(spark, ["39.1", "1e3", "1.0d", "1f", "abc", "", None, "-94.25"], safe_double)
    assert got == [39.1, 1000.0, None, None, None, None, None, -94.25]
    dirt = ["0x1p3", "1_0", "nan", "Infinity", "1e999", " 7.\n", ".5", "+2", "1 2", "."]
    assert one_col(spark, dirt, safe_double) == [None, None, None, None, None, 7.0, 0.5, 2.0,
                                                 None, None]


def test_point_both_forms(spark):
    pts = ['{"type":"Point","coordinates":[-94.5,39.1]}', '{"coordinates":[]}',
           '{"coordinates":[null, null]}', '{"coordinates":[[1,2],[3,4]]}', "{bad json",
           '{"type":"Polygon"}', None, '{"coordinates":["-94.5","39.25"]}']
    pts += ['{"coordinates":[-94.5,39.1]} x', '{"coordinates":[1,2]},{"coordinates":[3,4]}',
            '{"coordinates":[1,2]}]', '[{"coordinates":[1,2]}]', ' {"coordinates":[5,6]}\n']
    lat = one_col(spark, pts, lambda c: coord_at(point_coordinates(c), 1))
    lng = one_col(spark, pts, lambda c: coord_at(point_coordinates(c), 0))
    rest = [None, None, None, None]
    assert lat == [39.1, None, None, None, None, None, None, 39.25, *rest, 6.0]
    assert lng == [-94.5, None, None, None, None, None, None, -94.5, *rest, 5.0]


def test_normalize_code(spark):
    got = one_col(spark, ["48-30 C.O.", "C.O. 48-30", "48-30 c.o.", "48-30 C.o.", "C.O.",
                          None, " 48-30\t"], normalize_code)
    assert got == ["48-30", "48-30", "48-30", "48-30 C.o.", None, None, "48-30"]


def test_trim_all_whitespace(spark):
    assert one_col(spark, ["\t 123 \n", " x", "", None], clean_trim) == ["123", "x", "", None]


def test_days_between_and_divide(spark):
    df = spark.createDataFrame([(dt.date(2020, 1, 1), dt.date(2020, 1, 31), 3, 0),
                                (None, dt.date(2020, 1, 1), 1, 2)],
                               "a date, b date, n long, d long")
    r = df.select(days_between("a", "b").alias("x"), safe_divide("n", "d").alias("y")).collect()
    assert [(x.x, x.y) for x in r] == [(30, None), (None, 0.5)]


def test_surrogate_key_and_hash(spark):
    import hashlib
    df = spark.createDataFrame([("UNKNOWN", dt.date(2020, 6, 1)), (None, None)], "p string, d date")
    r = df.select(surrogate_key("p").alias("a"), surrogate_key("d").alias("b"),
                  row_hash(["p", "d"]).alias("h")).collect()
    assert r[0].a == hashlib.md5(b"UNKNOWN").hexdigest()
    assert r[0].b == hashlib.md5(b"2020-06-01").hexdigest()  # DATE hashes as YYYY-MM-DD
    assert r[1].a == hashlib.md5(b"_dbt_utils_surrogate_key_null_").hexdigest()
    assert r[0].h == hashlib.md5(b'{"p":"UNKNOWN","d":"2020-06-01"}').hexdigest()
    assert r[1].h == hashlib.md5(b'{"p":null,"d":null}').hexdigest()


def test_lat_lng_null_propagates(spark):
    df = spark.createDataFrame([(39.1, -94.5), (None, -94.5)], "a double, b double")
    assert [r[0] for r in df.select(lat_lng("a", "b")).collect()] == ["39.1,-94.5", None]
