from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from boxoffice.catalog.bindings import Tables  # noqa: E402
from boxoffice.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", partitions=4, app="tests")
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def tables(spark):
    return Tables(spark, SF)


@pytest.fixture
def rows(spark):
    """Make a frame from tuples and a schema text."""

    def make(data, schema):
        return spark.createDataFrame(data, schema)

    return make


def values(df, *columns):
    """All rows as a sorted list of tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda t: tuple(map(str, t)))
