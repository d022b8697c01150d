"""The corpus queries that SQL can express, against DuckDB."""

import duckdb
import pandas as pd
import pytest

from skyquarry.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_its_sql(spark, small, name):
    db = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "embeddings"):
        db.execute(f"create view {t} as select * from '{small}/{t}.parquet'")
    want, got = db.execute(queries.ORACLE_SQL[name]).df(), queries.QUERIES[name](spark, small).toPandas()
    assert sorted(want.columns) == sorted(got.columns)
    rows = lambda df: sorted(tuple("null" if pd.isna(x) else str(int(x)) if isinstance(x, float) else str(x) for x in r) for r in df[sorted(df.columns)].itertuples(index=False))
    assert rows(want) == rows(got)
