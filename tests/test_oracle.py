"""Every registered query with an oracle equals DuckDB on the same parquet
(sf0.001; the driver repeats this at sf0.01), and every rows-only query runs."""

import pytest

import __spark_entry__ as E
from panelgap.testing import compare, duckdb_conn
from tests.conftest import SF_SMALL

ORACLES = E.oracle_sql()
QUERIES = E.queries()
ROWS_ONLY = sorted(set(QUERIES) - set(ORACLES))


@pytest.fixture(scope="module")
def con():
    return duckdb_conn(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(QUERIES[name](spark, SF_SMALL), con, ORACLES[name])
    assert ok, f"{name}: {msg}"


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_rows_only_query_runs(spark, name):
    assert QUERIES[name](spark, SF_SMALL).count() > 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["position", "entity_name", "pct_ref", "pct_sev", "gap_pp", "vs_bench_pp",
                          "pct_excluded", "inclusion_group"]
