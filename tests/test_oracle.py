"""Every catalogue query against its DuckDB oracle on the smallest tables
(the driver runs the same check at sf0.01): same columns, types and row
count, and bit-identical values (no float tolerance).  Every query of the
library has an oracle, but for the forest, which draws rows at random and is
tested by its own (tests/test_booster.py)."""

import pytest

import oracle_check
from oracle_check import compare, duck

oracle_check.STRICT = True
from conftest import SF_SMALL

import __spark_entry__ as E
from civica.plans import catalogue

QUERIES = catalogue.queries()
SQL = catalogue.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, QUERIES[name], SQL[name], SF_SMALL)
    assert r["ok"], r
    assert r["rows"] > 0
    assert "types" not in r, r


def test_every_query_has_sql():
    assert set(QUERIES) - set(SQL) == {"forest_predict"}
    assert set(QUERIES) <= set(E.queries()) and set(SQL) <= set(E.oracle_sql())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["annee", "code_region", "categorie", "voix"]
    assert df.count() > 0
