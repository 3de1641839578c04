"""Declared data checks. A check returns its failures, so an empty result means it passed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def null_rows(df: DataFrame, column: str) -> DataFrame:
    """Rows in which ``column`` is null."""
    return df.where(F.col(column).isNull())


def duplicates(df: DataFrame, column: str) -> DataFrame:
    """Non-null values that occur more than once, with their count."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1")
    )


def failures(name: str, failing: DataFrame) -> DataFrame:
    """``(check, failures)`` for one check."""
    return failing.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(name).alias("check"), "failures"
    )


def schema_report(df: DataFrame, declared: T.StructType) -> DataFrame:
    """For each declared column: is it present, and how many of its values are null?"""
    present = [n for n in declared.fieldNames() if n in df.columns]
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count(F.col(n)).alias(n) for n in present]
    )
    rows = [
        F.struct(
            F.lit(n).alias("column"),
            F.lit(int(n in present)).alias("present"),
            (F.col("_rows") - F.col(n) if n in present else F.col("_rows")).alias("nulls"),
        )
        for n in declared.fieldNames()
    ]
    return counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def conforms(df: DataFrame, declared: T.StructType) -> bool:
    """Whether all declared columns are there; extra ones do not matter."""
    return set(declared.fieldNames()) <= set(df.columns)
