"""Every registered query with SQL against that SQL; the others must give rows."""

from __future__ import annotations

import pytest
from compare import difference, oracle

import __spark_entry__ as wiring

QUERIES, ORACLE = wiring.queries(), wiring.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_agrees_with_sql(spark, sf_dir, con, name):
    assert difference(spark, con, QUERIES[name], ORACLE[name], sf_dir) is None


@pytest.mark.parametrize("name", sorted(QUERIES.keys() - ORACLE.keys()))
def test_gives_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry_has_rows(spark, sf_dir):
    assert wiring.entry(spark).count() > 0


def test_every_oracle_has_its_query():
    assert ORACLE.keys() <= QUERIES.keys()
