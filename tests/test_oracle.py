"""Every registered query against its DuckDB statement (small scale factor)."""

import pytest

import __spark_entry__ as entry_mod
from compare import compare

from conftest import SMALL

QUERIES = entry_mod.queries()
ORACLE = entry_mod.oracle_sql()
CHECKED = sorted(ORACLE)


@pytest.mark.parametrize("name", CHECKED)
def test_query_matches_oracle(spark, duck_small, name):
    r = compare(QUERIES[name](spark, SMALL), duck_small, ORACLE[name])
    assert r["cols_match"], r
    assert r["rows_spark"] == r["rows_oracle"], r
    assert r["hash_match"], r


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and rows[0].n_users > 0
