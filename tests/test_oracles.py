"""Every registered catalogue query against its SQL in DuckDB."""

import duckdb
import pandas as pd
import pytest

from lumencat.plans.chain_queries import register as _register  # noqa: F401  (its queries join the others)
from lumencat.plans.queries import ORACLES, QUERIES

TABLES = "region nation customer supplier part orders lineitem events embeddings".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, sf_dir, name):
    mine = QUERIES[name](spark, sf_dir).toPandas()
    if name not in ORACLES:
        assert len(mine)
        return
    columns = sorted(mine.columns)
    theirs = duck.sql(ORACLES[name]).df()
    assert sorted(theirs.columns) == columns
    both = [d[columns].sort_values(columns, ignore_index=True) for d in (mine, theirs)]
    pd.testing.assert_frame_equal(*both, check_dtype=False, rtol=0, atol=1e-9)


def test_entry_point(spark):
    import __spark_entry__ as e

    assert {*e.oracle_sql()} <= {*e.queries()} and {*QUERIES} <= {*e.queries()}
    assert e.entry(spark).columns == ["step_no", "step", "N_tot", "z_mean"]
