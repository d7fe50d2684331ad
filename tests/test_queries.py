"""Every registered query against its DuckDB oracle on the smallest scale."""

import duckdb
import pytest

import __spark_entry__ as E
from tests.oracle_check import TABLES, digest, pandas_rows

from .conftest import SF001


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[-1] == "followers_count"


@pytest.mark.parametrize("name", sorted(set(E.queries()) - set(E.LLM_QUERIES)))
def test_query_matches_oracle(spark, con, name):
    sdf = pandas_rows(E.queries()[name](spark, SF001))
    sql = E.oracle_sql().get(name)
    if sql is None:
        assert len(sdf) > 0 and not sdf.isna().all().any()
        return
    odf = con.execute(sql).fetchdf()
    assert digest(sdf)[:3] == digest(odf)[:3]
