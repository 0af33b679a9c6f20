import math

import duckdb
import pytest

from curata.llm import catalog

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_same_rows_as_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = catalog.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    plain = lambda v: None if v is None or (isinstance(v, float) and math.isnan(v)) else round(v, 9) if isinstance(v, float) else v
    found = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    cursor = con.execute(catalog.ORACLE_SQL[name])
    names = [d[0] for d in cursor.description]
    order = [names.index(c) for c in columns]
    assert found == sorted((tuple(plain(r[k]) for k in order) for r in cursor.fetchall()), key=repr)


def test_pipeline_runs(spark):
    import corpus_pipeline

    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 0 and "ids_crc32" in out.columns
