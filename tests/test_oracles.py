"""Every query against its DuckDB form, all rows and all columns."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry
from boxoffice.catalog import ENTRIES
from tests.conftest import SF
from tools.check_oracles import compare, duck


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_sql():
    assert all(e.sql for e in ENTRIES.values())


@pytest.mark.parametrize("name", sorted(ENTRIES))
def test_same_rows(spark, con, name):
    assert compare(ENTRIES[name].run(spark, SF), con, ENTRIES[name].sql) is None


def test_entry(spark):
    out = entry(spark)
    assert out.columns == ["eventID", "name", "new_customers"]
    assert out.count() >= 5
