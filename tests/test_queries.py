"""Every query with SQL gives the rows of its SQL in DuckDB; no cone join is a nested loop."""

import duckdb
import pandas as pd
import pytest

from skyquarry.plans import domain_queries, more_queries  # noqa: F401
from skyquarry.plans import queries as q

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

#: Their values are checked by brute force in test_values.py and test_levels.py.
CHECKED = {"nwise_groups", "ephem_spline", "segment", "segment_levels", "gauss_fit", "poly_pointing", "moving_refined", "hash_sample"}


def rows(df):
    df = df.reindex(sorted(df.columns), axis=1).astype(object)
    return sorted(tuple("null" if pd.isna(x) else repr(float(x) + 0.0) if isinstance(x, (int, float)) and not isinstance(x, bool) else str(x) for x in r) for r in df.itertuples(index=False))


@pytest.fixture(scope="module")
def duck(small):
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"create view {t} as select * from '{small}/{t}.parquet'")
    return db


@pytest.mark.parametrize("name", sorted(q.QUERIES))
def test_query(spark, duck, small, name):
    got = q.QUERIES[name](spark, small)
    if name not in q.ORACLE_SQL:
        if name not in CHECKED:
            assert got.limit(1).count() == 1 and got.columns
        return
    want = duck.execute(q.ORACLE_SQL[name]).df()
    got = got.toPandas()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", ["cone_all", "cone_closest", "sift_default", "pairwise_xmatch", "nn_flag", "recovery_match"])
def test_cone_joins_are_equi_joins(spark, small, name):
    plan = q.QUERIES[name](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_entry_counts(spark):
    import __spark_entry__ as e

    counts = {r["class"]: r["count"] for r in e.entry(spark).groupBy("class").count().collect()}
    assert counts == {"transient": 72, "source": 63, "noise": 15}
    assert set(e.oracle_sql()) <= set(e.queries())
