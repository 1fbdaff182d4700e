"""Every query of the entry point against its oracle, on the small tables where they are there."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

SMALL = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")


def rows(df):
    def one(v):
        if v is None or isinstance(v, float) and math.isnan(v) or str(v) in ("NaT", "<NA>"):
            return None
        if hasattr(v, "tolist"):
            v = v.tolist()
        return round(float(v), 6) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)

    df = df[sorted(df.columns)]
    return sorted(map(repr, (tuple(one(v) for v in r) for r in df.itertuples(index=False, name=None))))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.sql("SET timezone = 'UTC'")
    for name in os.listdir(SMALL):
        con.sql(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM read_parquet('{SMALL}/{name}')")
    return con


@pytest.mark.parametrize("name", sorted(n for n in entry.oracle_sql() if not n.startswith("p4")))
def test_oracle(spark, duck, name):
    got, want = entry.queries()[name](spark, SMALL).toPandas(), duck.sql(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_oracle_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
