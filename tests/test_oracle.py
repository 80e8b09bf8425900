"""Every registered query against its DuckDB oracle on the smallest tables
(the driver repeats this at sf0.01); rows-only queries must run."""

import pytest

from quarry.plans import ORACLE, QUERIES, load_all
from tools.oracle_check import duck_rows, key, spark_rows

load_all()
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    import duckdb

    from quarry.sources.tables import TABLES
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    scols, srows = spark_rows(QUERIES[name](spark, SF))
    if name not in ORACLE:
        assert scols
        return
    dcols, drows = duck_rows(duck, ORACLE[name])
    assert scols == dcols
    assert sorted(srows, key=key) == sorted(drows, key=key)
