"""Every catalogued query against its DuckDB oracle on the smallest tables."""

import duckdb
import pytest

from conftest import SF_SMALL

import __spark_entry__ as entry
from tools.check_oracle import TABLES, value_hash

QUERIES = entry.queries()
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    import os
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_an_oracle_or_is_documented():
    from starmart.plans.catalog import QUERIES as warehouse

    no_oracle = set(warehouse) - set(ORACLES)
    assert no_oracle == {"smote_oversample", "forest_scores"}
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    got = QUERIES[name](spark, SF_SMALL).toPandas()
    exp = con.execute(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(exp.columns)
    assert len(got) == len(exp)
    assert value_hash(got, 6) == value_hash(exp, 6)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["year", "month", "category_name", "total_sales", "n_lines"]
    assert df.count() > 0
