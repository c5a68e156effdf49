import duckdb
import pytest

from docloom import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", registry.NAMES)
def test_query_agrees_with_sql(spark, db, name):
    got = registry.queries()[name](spark, SF).toPandas()
    assert len(got.columns)
    if name in registry.SQL:
        want = db.execute(registry.SQL[name]).df()
        cols = sorted(got.columns)
        assert cols == sorted(want.columns)
        assert sorted(map(str, got[cols].itertuples(index=False, name=None))) == sorted(map(str, want[cols].itertuples(index=False, name=None)))


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
