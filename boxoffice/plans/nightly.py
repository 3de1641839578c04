"""One nightly run: dumps to raw tables, raw tables to models, the declared checks, and the
report's star schema from its extract files."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from boxoffice.operators import quality
from boxoffice.plans import bi_tables, models, raw, schemas
from boxoffice.sources.csv_tables import AuditedCsv, read_csv
from boxoffice.sources.json_array import CountedDump
from boxoffice.sources.sinks import current_table, materialize, overwrite_load, write_range_partitioned

# Raw table, folder of its dump, declared columns, cleaning.
LOADS: list[tuple[str, str, T.StructType, Callable[[DataFrame], DataFrame] | None]] = [
    ("raw_sale_orders", "sale_orders", schemas.SALE_ORDERS, None),
    ("raw_order_items", "order_items", schemas.ORDER_ITEMS, None),
    ("raw_order_attendant", "order_attendant", schemas.ORDER_ATTENDANT, None),
    ("raw_customers", "customers", schemas.CUSTOMERS, raw.raw_customers),
    ("raw_organizers", "sale_order_events", schemas.SALE_ORDER_EVENTS, raw.raw_organizers),
    ("raw_order_events", "sale_order_events", schemas.SALE_ORDER_EVENTS, raw.raw_order_events),
    ("raw_events", "events", schemas.EVENTS, raw.raw_events),
    ("raw_login", "login", schemas.LOGIN, raw.raw_login),
]

# Tables kept in range partitions, with the key of their partitions.
PARTITIONED = {
    "stg_orders": "date_id",
    "stg_customers": "last_login_date_id",
    "bi_customers": "last_login_date_id",
}

NOT_NULL = [("stg_orders", "order_id"), ("stg_events", "id")]
UNIQUE = [("stg_organizers", "id"), ("stg_customers", "id")]


@dataclass
class Run:
    rows: dict[str, int] = field(default_factory=dict)
    failures: dict[str, int] = field(default_factory=dict)


def load_raw(spark: SparkSession, dumps: str, out: str) -> dict[str, int]:
    """Replace every raw table from its dump; returns the rows loaded per table."""
    rows = {}
    for table, folder, schema, clean in LOADS:
        dump = CountedDump(spark, f"{dumps}/{folder}", schema)
        loaded = clean(dump.rows) if clean else dump.rows
        rows[table] = overwrite_load(loaded, f"{out}/{table}", verify=dump.verify)
    return rows


def build_models(spark: SparkSession, out: str, countries: DataFrame) -> None:
    """Build every model from stored tables, so that each is computed once."""

    def stored(name: str) -> DataFrame:
        return current_table(spark, f"{out}/{name}")

    def keep(name: str, df: DataFrame) -> DataFrame:
        if name in PARTITIONED:
            write_range_partitioned(df, f"{out}/{name}", PARTITIONED[name])
            return stored(name).drop("bucket")
        return materialize(df, f"{out}/{name}")

    orders, items = stored("raw_sale_orders"), stored("raw_order_items")
    keep("stg_organizers", models.stg_organizers(stored("raw_organizers")))
    events = keep("stg_events", models.stg_events(stored("raw_order_events"), stored("raw_events")))
    stg_orders = keep("stg_orders", models.stg_orders(orders, items, events))
    customers = keep(
        "stg_customers",
        models.stg_customers(stored("raw_customers"), stored("raw_login"), countries),
    )
    keep("stg_product", models.stg_product(items, orders, events))
    keep("bi_orders", models.bi_orders(items, orders, stored("raw_order_attendant"), events))
    keep("bi_customers", models.bi_customers(stg_orders, customers))


def check(spark: SparkSession, out: str) -> dict[str, int]:
    """Failing rows or values of each declared check."""
    found = [
        quality.failures(f"not_null {t}.{c}", quality.null_rows(current_table(spark, f"{out}/{t}"), c))
        for t, c in NOT_NULL
    ] + [
        quality.failures(f"unique {t}.{c}", quality.duplicates(current_table(spark, f"{out}/{t}"), c))
        for t, c in UNIQUE
    ]
    return {r["check"]: r["failures"] for r in reduce(DataFrame.unionByName, found).collect()}


def run_nightly(spark: SparkSession, dumps: str, out: str, countries: DataFrame) -> Run:
    """Load, build, check. Running it again with the same dumps gives the same tables."""
    rows = load_raw(spark, dumps, out)
    build_models(spark, out, countries)
    return Run(rows, check(spark, out))


# Extract file of the report, its columns and its encoding.
EXTRACTS = {
    "events": (schemas.CSV_EVENTS, "UTF-8"),
    "tickets": (schemas.CSV_TICKETS, "1252"),
    "customers": (schemas.CSV_CUSTOMERS, "UTF-8"),
    "orders": (schemas.CSV_ORDERS, "1252"),
}


def load_extracts(
    spark: SparkSession, extracts: str, out: str, allowed: dict[str, dict[str, int]] | None = None
) -> dict[str, dict[str, int]]:
    """Replace the table of every extract; returns rows, and odd lines by kind, per extract.

    An extract with more odd lines than ``allowed`` (per extract and kind; none by default) leaves
    its table as it was and raises MalformedLines.
    """
    found = {}
    for name, (schema, encoding) in EXTRACTS.items():
        lines = AuditedCsv(spark, f"{extracts}/{name}", schema, encoding)
        most = (allowed or {}).get(name, {})
        overwrite_load(lines.rows, f"{out}/{name}", verify=lambda: lines.verify(**most))
        found[name] = lines.counts()
    return found


def build_report(
    spark: SparkSession, extracts: str, out: str, cutoff: dt.date, as_of: dt.date, loaded: bool = False
) -> None:
    """Prepare the fact, the four dimensions and the calendar, and keep them as tables.

    ``extracts`` has the files, or with ``loaded`` the tables that ``load_extracts`` made of them.
    The fact comes first: the events' ticket totals and the range of the calendar are
    read from the stored one.
    """
    files = {
        name: current_table(spark, f"{extracts}/{name}") if loaded else read_csv(spark, f"{extracts}/{name}", schema, encoding)
        for name, (schema, encoding) in EXTRACTS.items()
    }
    fact = materialize(bi_tables.fact_orders(files["orders"]), f"{out}/fact_orders")
    tables = {
        "dim_events": bi_tables.dim_events(files["events"], fact, cutoff),
        "dim_tickets": bi_tables.dim_tickets(files["tickets"]),
        "dim_ticket_phase": bi_tables.dim_ticket_phase(files["tickets"]),
        "dim_customers": bi_tables.dim_customers(files["customers"], as_of),
        "dim_calendar": bi_tables.dim_calendar(bi_tables.calendar_bounds(fact), as_of),
    }
    for name, df in tables.items():
        materialize(df, f"{out}/{name}")
