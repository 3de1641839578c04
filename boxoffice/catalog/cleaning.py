"""B: cleaning on the way into the raw tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxoffice.catalog.bindings import Tables
from boxoffice.catalog.oracle import title
from boxoffice.catalog.register import query
from boxoffice.functions.dates import parse_date
from boxoffice.functions.text import replace_text, title_case
from boxoffice.operators.dedup import keep_first, keep_latest
from boxoffice.plans import raw, schemas
from boxoffice.session import scratch_path
from boxoffice.sources.json_array import CountedDump, write_json_arrays
from boxoffice.sources.sinks import current_table, overwrite_load


@query("B01_parse_mixed_date_coerce", "SELECT code, CAST(birthday AS VARCHAR) AS birthday FROM raw_customers")
def mixed_dates(t: Tables) -> DataFrame:
    return t.dump_customers().select(
        "code", parse_date(F.col("birthday"), 2026).alias("birthday")
    )


# Forms of a date as a Spark pattern, and how many days the reading may drop: to the month's or year's first.
_FORMS = [
    "yyyy-MM-dd", "yyyy-MM-dd HH:mm", "MM/dd/yyyy HH:mm:ss", "yyyy-MM-dd HH:mm:ss.SSSSSS", "yyyy-MM-dd'T'HH:mm:ss'Z'",
    "yyyyMMdd", "d-MMM-yyyy", "' 'yyyy-MM-dd' '", "MMM yyyy", "yyyy-MM", "yyyy", "MM/dd/yyyy hh:mm a", "E, dd MMM yyyy",
    "EEEE d MMMM yyyy", "MMMM d, yyyy", "yyyy.MM.dd", "yyyy MM dd", "MMM-dd-yyyy", "yyyy/MMM/d", "dd MMM yyyy HH:mm:ss'+07:00'",
    "'born' yyyy-MM-dd", "yyyy'_'MM'_'dd", "M/d/yyyy", "yyyyMMddHHmmss",
]


@query(
    "B01_date_forms",
    """SELECT code, CAST(CASE WHEN k % 24 IN (20, 21) THEN NULL WHEN k % 24 IN (8, 9) THEN date_trunc('month', born)
  WHEN k % 24 = 10 THEN date_trunc('year', born) ELSE born END AS DATE)::VARCHAR AS birthday
FROM (SELECT CAST(c_custkey AS VARCHAR) AS code, c_custkey AS k,
  DATE '1950-01-01' + CAST(c_custkey * 37 % 20000 AS INTEGER) AS born FROM customer)""",
)
def date_forms(t: Tables) -> DataFrame:
    """Birthdays written in two dozen forms, two of which are no dates, read back."""
    k = F.col("c_custkey")
    born = F.date_add(F.lit(dt.date(1950, 1, 1)), (k * 37 % 20000).cast("int")).cast("timestamp_ntz")
    text = F.element_at(F.array(*[F.date_format(born, f) for f in _FORMS]), (k % len(_FORMS) + 1).cast("int"))
    written = t.read("customer").select(k.cast("string").alias("code"), text.alias("birthday"))
    return written.select("code", parse_date(F.col("birthday"), 2026).alias("birthday"))


@query("B02_substring_replace", "SELECT code, nationality FROM raw_customers")
def replaced_text(t: Tables) -> DataFrame:
    return t.dump_customers().select(
        "code", replace_text(F.col("nationality"), "vietnam", "VN").alias("nationality")
    )


@query(
    "B03_title_case",
    f"SELECT event_id, {title('event_name_en')} AS event_name, {title('merchant_name_en')} AS merchant_name "
    "FROM dump_order_events",
)
def titles(t: Tables) -> DataFrame:
    return t.dump_order_events().select(
        "event_id",
        title_case(F.col("event_name_en")).alias("event_name"),
        title_case(F.col("merchant_name_en")).alias("merchant_name"),
    )


@query(
    "B04_dedup_by_key",
    """SELECT merchant_id, event_id, time_en FROM (SELECT *, row_number() OVER (PARTITION BY merchant_id
  ORDER BY event_id, time_en) AS rn FROM dump_order_events) WHERE rn = 1""",
)
def one_per_key(t: Tables) -> DataFrame:
    rows = t.dump_order_events().select("merchant_id", "event_id", "time_en")
    return keep_first(rows, ["merchant_id"])


@query("B05_dedup_by_composite_key", "SELECT event_id, merchant_id, time_en FROM raw_order_events")
def one_per_two_keys(t: Tables) -> DataFrame:
    return keep_first(t.dump_order_events(), ["event_id", "merchant_id"]).select(
        "event_id", "merchant_id", "time_en"
    )


@query(
    "B06_latest_record_per_key",
    """SELECT customer_code, type, CAST(created_at AS VARCHAR) AS created_at,
  CAST(updated_at AS VARCHAR) AS updated_at FROM raw_login""",
)
def latest_login(t: Tables) -> DataFrame:
    typed = t.dump_login().withColumns(
        {c: F.col(c).cast("timestamp_ntz") for c in ("created_at", "updated_at")}
    )
    return keep_latest(typed, "customer_code", "updated_at")


@query(
    "B07_parse_datetime_strict",
    "SELECT event_id, CAST(start_date AS VARCHAR) AS start_date, CAST(end_date AS VARCHAR) AS end_date FROM raw_events",
)
def strict_datetimes(t: Tables) -> DataFrame:
    return raw.raw_events(t.dump_events()).select("event_id", "start_date", "end_date")


def _loaded(t: Tables, dump: DataFrame, schema, name: str, clean=None) -> DataFrame:
    """Dump to JSON arrays; scan, count, clean and load in one pass; read the loaded table."""
    source, target = scratch_path(t.spark, f"{name}-dump"), scratch_path(t.spark, name)
    write_json_arrays(dump, source)
    found = CountedDump(t.spark, source, schema)
    overwrite_load(clean(found.rows) if clean else found.rows, target, verify=found.verify)
    return current_table(t.spark, target)


@query(
    "B08_raw_sale_orders",
    """SELECT code, event_id, customer_code, order_status, order_type, payment_method,
  CAST(created_at AS VARCHAR) AS created_at, CAST(purchased_at AS VARCHAR) AS purchased_at, merchant_id
FROM sale_orders""",
)
def raw_sale_orders(t: Tables) -> DataFrame:
    return _loaded(t, t.sale_orders(), schemas.SALE_ORDERS, "raw-sale-orders")


@query(
    "B09_raw_order_items",
    """SELECT id, order_code, product_id, quantity, CAST(subtotal AS DOUBLE) AS subtotal,
  CAST(discount_amount AS DOUBLE) AS discount_amount, CAST(grand_total AS DOUBLE) AS grand_total,
  product_name_en, ticket_phase_name_en FROM order_items""",
)
def raw_order_items(t: Tables) -> DataFrame:
    return _loaded(t, t.order_items(), schemas.ORDER_ITEMS, "raw-order-items")


@query("B10_raw_order_attendant", "SELECT item_id, order_code, product_id, category_en FROM attendants")
def raw_order_attendant(t: Tables) -> DataFrame:
    return _loaded(t, t.attendants(), schemas.ORDER_ATTENDANT, "raw-order-attendant")


@query(
    "B11_raw_customers",
    """SELECT code, is_activated, nationality, CAST(birthday AS VARCHAR) AS birthday,
  CAST(created_at AS VARCHAR) AS created_at, CAST(last_login_at AS VARCHAR) AS last_login_at FROM raw_customers""",
)
def raw_customers(t: Tables) -> DataFrame:
    return _loaded(t, t.dump_customers(), schemas.CUSTOMERS, "raw-customers", raw.raw_customers)


@query(
    "B12_raw_organizers",
    f"SELECT merchant_id, min({title('merchant_name_en')}) AS merchant_name_en FROM dump_order_events GROUP BY merchant_id",
)
def raw_organizers(t: Tables) -> DataFrame:
    return _loaded(
        t, t.dump_order_events(), schemas.SALE_ORDER_EVENTS, "raw-organizers", raw.raw_organizers
    )


@query(
    "B13_raw_events",
    """SELECT event_id, event_name, event_type, CAST(start_date AS VARCHAR) AS start_date,
  CAST(end_date AS VARCHAR) AS end_date FROM raw_events""",
)
def raw_events(t: Tables) -> DataFrame:
    return _loaded(t, t.dump_events(), schemas.EVENTS, "raw-events", raw.raw_events)


@query(
    "B14_raw_order_events",
    "SELECT event_id, event_name_en, merchant_id, merchant_name_en, time_en FROM raw_order_events",
)
def raw_order_events(t: Tables) -> DataFrame:
    return _loaded(
        t, t.dump_order_events(), schemas.SALE_ORDER_EVENTS, "raw-order-events", raw.raw_order_events
    )


@query(
    "B15_raw_login",
    """SELECT customer_code, type, CAST(created_at AS VARCHAR) AS created_at,
  CAST(updated_at AS VARCHAR) AS updated_at FROM raw_login""",
)
def raw_login(t: Tables) -> DataFrame:
    return _loaded(t, t.dump_login(), schemas.LOGIN, "raw-login", raw.raw_login)
