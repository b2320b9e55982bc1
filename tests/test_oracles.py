"""Every registered query with an SQL oracle equals DuckDB on the same parquet (sf0.01).

Queries without an oracle (model fits, streams) are run for row counts and a
stable schema.
"""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries

from .conftest import SF_MEDIUM
from .oracle_compare import compare, duck

ORACLES = oracle_sql()
ROWS_ONLY = sorted(set(queries()) - set(ORACLES))


@pytest.fixture(scope="module")
def con():
    return duck(SF_MEDIUM)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, con, name):
    r = compare(spark, con, SF_MEDIUM, name, queries()[name], ORACLES[name])
    assert r["ok"], r.get("why")


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_rows_only_queries_run(spark, name):
    df = queries()[name](spark, "/root/testdata/sf0.001")
    assert df.count() >= 1 and len(df.columns) >= 2


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns == ["review_id", "review_combined", "label", "rating_numeric", "country"]
    assert df.count() > 0
