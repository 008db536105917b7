"""Every registered query of the engine against its SQL, on the smallest tables where they are at hand."""

from pathlib import Path

import duckdb
import pytest

from quillstone.plans import registry

TABLES = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    if not TABLES.is_dir():
        pytest.skip("the test tables are not here")
    con = duckdb.connect()
    for p in TABLES.glob("*.parquet"):
        con.sql(f"create view {p.stem} as select * from read_parquet('{p}')")
    return con


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, duck, name):
    got = registry.queries()[name](spark, str(TABLES)).toPandas()
    if name not in registry.oracle_sql():
        assert len(got)
        return
    want = duck.sql(registry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    rows = lambda df: sorted(map(tuple, df[sorted(df.columns)].astype(str).values.tolist()))
    assert rows(got) == rows(want)


def test_entry(spark):
    if not TABLES.is_dir():
        pytest.skip("the test tables are not here")
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 4
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
