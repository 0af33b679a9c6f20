import math
import os

import duckdb
import pytest

import __spark_entry__
from curata.plans import catalog

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, float):
        return round(value, 6)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_same_rows_as_sql(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    found = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    cursor = duck.execute(catalog.ORACLE_SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    wanted = sorted((tuple(plain(r[k]) for k in order) for r in cursor.fetchall()), key=repr)
    assert found == wanted


def test_entry_runs(spark):
    assert __spark_entry__.entry(spark).count() >= 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
