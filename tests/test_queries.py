"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="the test tables are not here")


@pytest.fixture(scope="module")
def tables():
    from verify import oracle

    return oracle(SF)


def core() -> list[str]:
    from larkspur.plans import registry

    return list(registry.queries())


@pytest.mark.parametrize("name", core())
def test_query(spark, tables, name):
    from verify import compare

    assert compare(spark, tables, name, SF).startswith(("equal", "rows only"))


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_every_sql_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
