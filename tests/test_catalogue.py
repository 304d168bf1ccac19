"""Every query with SQL against DuckDB on the smallest tables."""

import duckdb
import pytest

from saltmarsh.plans import catalogue

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    shown = lambda v: repr(round(v, 9)) if isinstance(v, float) else str(v)
    return sorted(tuple(shown(r[i]) for i in order) for r in values)


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_equals_sql(spark, db, name):
    df = catalogue.queries()[name](spark, SF)
    ran = db.execute(catalogue.oracle_sql()[name])
    columns = [d[0] for d in ran.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows(df.columns, df.collect()) == rows(columns, ran.fetchall())


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_forest_has_a_metric(spark):
    found = {r["metric"]: r["value"] for r in catalogue.queries()["forest_regression"](spark, SF).collect()}
    assert found["r2"] < 1 and found["mae"] > 0
