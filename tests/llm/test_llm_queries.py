import os

import duckdb
import pytest

from groundmill.llm import queries

SMALL = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in os.listdir(SMALL):
        con.sql(f"CREATE VIEW {t.split('.')[0]} AS SELECT * FROM read_parquet('{SMALL}/{t}')")
    want = con.sql(queries.ORACLES[name]).fetchall()
    got = queries.QUERIES[name](spark, SMALL)
    names = [d[0] for d in con.sql(queries.ORACLES[name]).description]
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(want)


@pytest.mark.parametrize(("name", "columns"), [
    ("p1_found", ["key_a", "key_b"]), ("p3_found", ["meaning_a", "meaning_b"]), ("p6_found", ["source_table", "row_key", "pii_type", "char_start", "char_end"]), ("p7_ids", ["doc_id", "ids"]), ("p8_shares", None), ("p9_found", ["doc_id", "subject"]),
])
def test_queries_run(spark, name, columns):
    df = queries.QUERIES[name](spark, SMALL)
    assert (columns is None or df.columns == columns) and df.count() > 0
