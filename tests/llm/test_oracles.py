import duckdb
import pytest

from callsift.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", [n for n, (_, sql) in QUERIES.items() if sql])
def test_query_equals_its_sql(spark, name):
    run, sql = QUERIES[name]
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = db.execute(sql)
    columns = [c[0] for c in want.description]
    rows = sorted(map(str, want.fetchall()))
    got = run(spark, SF)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(str(tuple(r)) for r in got.select(columns).collect()) == rows
