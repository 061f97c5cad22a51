"""The corpus queries that SQL can express, against DuckDB on the driver's smallest tables."""

import os

import pytest

from tariffloom.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables")
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_twin(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    cur = con.execute(ORACLE[name])
    names = [d[0] for d in cur.description]
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(names)
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(cur.fetchall())
