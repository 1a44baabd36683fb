"""Every registered query against its SQL, and the entry file itself."""

import pytest

import __spark_entry__ as entry
from oracle import ROOT, compare, connection

ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connection(f"{ROOT}/sf0.001")


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, con, name):
    rows, extra, missing = compare(spark, con, entry.queries()[name], ORACLE[name], f"{ROOT}/sf0.001")
    assert not extra and not missing, (list(extra.items())[:3], list(missing.items())[:3])
