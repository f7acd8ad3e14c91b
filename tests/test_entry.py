"""The driver contract: entry smoke run and oracle agreement at sf0.001."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries

from tests.compare import TABLES, digest

MODEL_QUERIES = [k for k in queries() if not k.startswith("op") and k != "pipeline"]


def test_entry(spark):
    df = entry(spark)
    rows = df.collect()
    assert [r.stage_order for r in sorted(rows, key=lambda r: r.stage_order)] == [1, 2, 3, 4]


def test_registry_complete():
    q, o = ({k for k in d if not k.startswith("op") and k != "pipeline"}
            for d in (queries(), oracle_sql()))
    assert o == q  # every query of the reference's operators has its SQL
    assert len(q) == 74


@pytest.fixture(scope="module")
def duck():
    from tests.conftest import SF_SMALL
    import os
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.mark.parametrize("name", MODEL_QUERIES)
def test_matches_oracle(spark, duck, name):
    from tests.conftest import SF_SMALL
    df = queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]
