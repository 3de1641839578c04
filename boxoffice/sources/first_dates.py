"""First dates per customer, kept as a table and moved on by each day's orders.

Whether a customer is new depends on their first purchase ever, which a cohort query otherwise finds in
all past orders. Here it is a row per customer (and per further column whose filter also holds for
the past: a payment method, an event), merged from the orders of each load. A load
reads its own orders and the stored rows of their customers, and writes only rows whose dates
came or moved; the order of loads does not matter, and loading the same orders again writes nothing.

A minimum cannot be taken back from the orders of a day. For orders that were withdrawn or changed,
``correct_first_dates`` takes the customers concerned and finds their dates in their own
orders again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boxoffice.operators.metrics import is_ok
from boxoffice.session import stable
from boxoffice.sources.changes import changed_keys, replace_keys, touched
from boxoffice.sources.sinks import add_version, current_table, loads


def first_dates(orders: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """customerID, ``keep``, first_order (of any status) and first_bought (null without a purchase).

    Orders without a customer, a date or a value in ``keep`` belong to nobody's past.
    """
    key = ["customerID", *keep]
    bought = is_ok() & F.col("creationDateID").isNotNull()
    return (
        orders.dropna(subset=[*key, "creationDate"])
        .groupBy(*key)
        .agg(
            F.min("creationDate").alias("first_order"),
            F.min(F.when(bought, F.col("creationDate"))).alias("first_bought"),
        )
    )


def merge_first_dates(orders: DataFrame, path: str, keep: Sequence[str] = ()) -> int:
    """Bring the table at ``path`` up to date with further orders; returns the rows written."""
    spark, key = orders.sparkSession, ["customerID", *keep]
    found = first_dates(orders, keep)
    if not any(r["rows"] for r in loads(spark, path)):
        return add_version(found, path)
    known = current_table(spark, path).toDF(*key, "_order", "_bought")
    moved = F.col("_order").isNull() | (F.col("first_order") < F.col("_order"))
    moved = moved | (F.col("first_bought") < F.coalesce("_bought", F.date_add("first_bought", 1)))
    rows = found.join(known, key, "left").where(moved)
    # least() passes over an absent date.
    rows = stable(
        rows.select(
            *key,
            F.least("first_order", "_order").alias("first_order"),
            F.least("first_bought", "_bought").alias("first_bought"),
        )
    )
    if rows.isEmpty():
        return 0
    return replace_keys(rows, rows.select(*key), path)


def correct_first_dates(customers: DataFrame, orders: DataFrame, path: str, keep: Sequence[str] = ()) -> int:
    """Find the dates of ``customers`` (customerID) in ``orders`` again; returns the rows written.

    ``orders`` are all orders as they are now. Only those of the customers are grouped.
    """
    spark, key = orders.sparkSession, ["customerID", *keep]
    customers = customers.select("customerID").distinct()
    now = stable(first_dates(touched(orders, "customerID", customers), keep))
    was = touched(current_table(spark, path), "customerID", customers)
    changed = stable(changed_keys(was, now, key))
    if changed.isEmpty():
        return 0
    return replace_keys(touched(now, key, changed), changed, path)


def first_bought(spark: SparkSession, path: str, keep: Sequence[str] = ()) -> DataFrame:
    """customerID, ``keep``, first_ever: what cohort functions take for the first purchases."""
    rows = current_table(spark, path).where("first_bought IS NOT NULL")
    return rows.select("customerID", *keep, F.col("first_bought").alias("first_ever"))


def first_ordered(spark: SparkSession, path: str, keep: Sequence[str] = ()) -> DataFrame:
    """customerID, ``keep``, earliest: the first order of any status."""
    return current_table(spark, path).select("customerID", *keep, F.col("first_order").alias("earliest"))
