"""Joins.

No side is broadcast by hint unless its size has a fixed bound (the calendar, parameter
tables). For all others Spark compares the size with its broadcast threshold, from file
statistics before and from shuffle statistics during the run, and otherwise shuffles;
skewed partitions of such a join are split by adaptive execution.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from boxoffice.functions.dates import key_to_date


def not_in(df: DataFrame, column: str, values: DataFrame, value_column: str) -> DataFrame:
    """``column NOT IN (SELECT value_column FROM values)`` with its null rules.

    One null among the values empties the result, and a null in ``column`` only passes if
    there are no values at all. Spark's own plan for the SQL form always broadcasts the
    values; here they are anti-joined by key, and the null rules are one scalar: 0 without
    values, 1 with values, 2 with a null among them.
    """
    v = values.select(F.col(value_column).alias("_value"))
    some = F.count(F.lit(1)) > 0
    nulls = F.count(F.lit(1)) > F.count("_value")
    state = v.agg(F.when(nulls, 2).when(some, 1).otherwise(0)).scalar()
    known = v.where(F.col("_value").isNotNull())
    kept = df.join(known, F.col(column) == F.col("_value"), "left_anti")
    return kept.where(state + F.col(column).isNull().cast("int") <= 1)


def in_values(df: DataFrame, column: str, values: DataFrame, value_column: str) -> DataFrame:
    """``column IN (SELECT ...)``: a semi join."""
    v = values.select(F.col(value_column).alias("_value"))
    return df.join(v, F.col(column) == F.col("_value"), "left_semi")


def with_membership(
    df: DataFrame, column: str, values: DataFrame, value_column: str, name: str
) -> DataFrame:
    """Add ``name``: whether ``column`` occurs among the values (false for null)."""
    v = values.select(F.col(value_column).alias("_value")).where("_value is not null").distinct()
    joined = df.join(v, F.col(column) == F.col("_value"), "left")
    return joined.withColumn(name, F.col("_value").isNotNull()).drop("_value")


def lookup(df: DataFrame, key: str, dim: DataFrame, dim_key: str, take: dict[str, str]) -> DataFrame:
    """Left join ``take`` (column to new name) of a dimension with unique ``dim_key``."""
    d = dim.select(
        F.col(dim_key).alias("_dim_key"), *[F.col(c).alias(new) for c, new in take.items()]
    )
    return df.join(d, F.col(key) == F.col("_dim_key"), "left").drop("_dim_key")


def star_join(
    fact: DataFrame,
    events: DataFrame | None = None,
    customers: DataFrame | None = None,
    tickets: DataFrame | None = None,
    phases: DataFrame | None = None,
    calendar: DataFrame | None = None,
) -> DataFrame:
    """Fact rows with the attributes of the given dimensions, many to one.

    Calendar filters reach the fact by its creation date. Phases hang off tickets.
    """
    out = fact
    if events is not None:
        out = lookup(out, "eventID", events, "id", {"name": "eventName", "location": "location"})
    if customers is not None:
        out = lookup(
            out, "customerID", customers, "id", {"gender": "gender", "ageGroup": "ageGroup"}
        )
    if tickets is not None:
        out = lookup(
            out, "ticketID", tickets, "id", {"distance": "distance", "phaseID": "phaseID"}
        )
        if phases is not None:
            out = lookup(out, "phaseID", phases, "phaseID", {"phase": "phase"})
    if calendar is not None:
        days = {"yearMonthInt": "yearMonthInt", "year": "year", "dayOfWeekInt": "dayOfWeekInt"}
        out = lookup(out, "creationDateID", F.broadcast(calendar), "dateID", days)
    return out


def lookup_date(df: DataFrame, key: str, name: str) -> DataFrame:
    """The date of a ``yyyymmdd`` key. The calendar maps each key to that very date."""
    return df.withColumn(name, key_to_date(F.col(key)))


def by_role(
    customers: DataFrame, calendar: DataFrame, role: str, take: Sequence[str]
) -> DataFrame:
    """Customers joined to the calendar by the chosen date key (an inactive relationship)."""
    days = F.broadcast(calendar.select(F.col("dateID").alias(role), *take))
    return customers.join(days, role, "inner")


def fill_from_previous(
    df: DataFrame, column: str, keys: Sequence[str], order: Sequence[Column]
) -> DataFrame:
    """Fill a null from the row before it within its key, one step back only."""
    before = F.lag(column).over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn(column, F.coalesce(F.col(column), before))
