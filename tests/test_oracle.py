"""Every registered query against its DuckDB SQL, as the driver checks it."""

import pytest

import __spark_entry__ as E
from ledgerlens.plans import registry
from tests.conftest import SF_CHECK
from tests.oracle_check import compare

# the library's own queries; those of the training-data subpackage have tests of their own
QUERIES = {name: E.queries()[name] for name in registry.QUERIES}
SQL = E.oracle_sql()


def test_every_query_has_oracle_sql():
    assert set(QUERIES) <= set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, name):
    res = compare(spark, name, QUERIES[name], SQL[name], SF_CHECK)
    assert res["cols_match"], res
    assert res["spark_rows"] == res["oracle_rows"], res
    assert res["values_match"], res


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == ["mes", "nombreterritorio"]
