from __future__ import annotations

import pytest

#: Rows that every operator must take: nulls, empties, a very long text, ties, repeated rows.
LONG = "lorem ipsum dolor sit amet consectetur " * 40_000
ODD = [
    (1, "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"),
    (1, "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"),
    (2, " Alpha\tbeta gamma delta epsilon zeta eta theta iota kappa lambda mu "),
    (3, None),
    (4, ""),
    (5, " \n\t "),
    (None, "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"),
    (None, None),
    (6, "word"),
    (7, "\u00e9t\u00e9 \u00c9T\u00c9 \U0001f600 <|endoftext|> \u00a0x\u2028y\x1cz \x00 end"),
    (8, LONG),
]


@pytest.fixture(scope="session")
def odd(spark):
    """ODD with further columns whose names the operators use themselves."""
    rows = [(i, t, "x", 1, None, True) for i, t in ODD]
    schema = "doc_id long, text string, row string, ref int, kept_text string, kept boolean"
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("false")


@pytest.fixture(scope="session")
def small(spark):
    """The documents of the smallest test folder, as (doc_id, text)."""
    from tests.conftest import SF

    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    return [(r[0], r[1]) for r in rows]
