"""Every registered query with an oracle matches DuckDB at sf0.01."""

import pytest

import __spark_entry__ as entry_mod
from frames import SF_ORACLE
from oracle import compare, duck

ORACLES = entry_mod.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_ORACLE)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, con, name):
    df = entry_mod.queries()[name](spark, SF_ORACLE)
    ok, msg = compare(df, con, ORACLES[name])
    assert ok, msg


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(entry_mod.queries())


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert df.columns == entry_mod.entry(spark).columns
