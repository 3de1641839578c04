"""A: reading dumps and extracts, replacing tables, range partitions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boxoffice.catalog.bindings import Tables
from boxoffice.catalog.register import query
from boxoffice.functions.dates import date_key
from boxoffice.plans import models, raw, schemas
from boxoffice.session import scratch_path
from boxoffice.sources import parameters
from boxoffice.sources.changes import merge_load
from boxoffice.sources.csv_tables import AuditedCsv, read_csv, write_csv
from boxoffice.sources.json_array import read_json_array, write_json_arrays
from boxoffice.sources.sinks import (
    current_table,
    load_metrics,
    materialize,
    overwrite_load,
    read_key_range,
    with_range_bucket,
    write_range_partitioned,
)


@query(
    "A01_json_array_scan",
    """SELECT code, event_id, customer_code, order_status, order_type, payment_method,
  CAST(created_at AS VARCHAR) AS created_at, CAST(purchased_at AS VARCHAR) AS purchased_at, merchant_id
FROM sale_orders""",
)
def json_array_scan(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "sale-orders-dump")
    write_json_arrays(t.sale_orders().withColumn("not_declared", F.lit(1)), path)
    return read_json_array(t.spark, path, schemas.SALE_ORDERS)


@query(
    "A03_overwrite_load",
    "SELECT code, merchant_id, event_id FROM sale_orders",
)
def replaced(t: Tables) -> DataFrame:
    """Loads twice, in another column order first; the second load replaces the first."""
    path = scratch_path(t.spark, "sale-orders")
    schema = T.StructType.fromDDL("code string, merchant_id bigint, event_id bigint")
    rows = t.sale_orders().select("event_id", "code", "merchant_id")
    overwrite_load(rows, path, schema)
    overwrite_load(rows, path, schema)
    return current_table(t.spark, path)


@query(
    "A04_load_row_count",
    """SELECT * FROM (
  SELECT 'sale_orders' AS "table", 1 AS run_date, (SELECT count(*) FROM orders WHERE o_orderdate < DATE '1998-01-01') AS rows,
    CAST(NULL AS BIGINT) AS previous_rows, CAST(NULL AS BIGINT) AS change
  UNION ALL SELECT 'sale_orders', 2, (SELECT count(*) FROM orders),
    (SELECT count(*) FROM orders WHERE o_orderdate < DATE '1998-01-01'), (SELECT count(*) FROM orders WHERE o_orderdate >= DATE '1998-01-01'))""",
)
def row_counts(t: Tables) -> DataFrame:
    """Day one has the orders of the first three years, day two has all."""
    path = scratch_path(t.spark, "counted")
    every = t.sale_orders().select("code", "created_at")
    first = overwrite_load(every.where("created_at < '1998-01-01'"), path)
    second = overwrite_load(every, path)
    loads = t.spark.createDataFrame(
        [("sale_orders", 1, first), ("sale_orders", 2, second)],
        "table string, run_date int, rows bigint",
    )
    return load_metrics(loads)


@query(
    "A04_changes_load",
    """SELECT code, event_id, status, CAST(w.rows AS BIGINT) AS written_last FROM (
  SELECT code, event_id, CASE WHEN CAST(code AS BIGINT) % 10 = 1 THEN 'paid' ELSE order_status END AS status
  FROM sale_orders WHERE CAST(code AS BIGINT) % 12 <> 0),
  (SELECT count(*) AS rows FROM sale_orders WHERE CAST(code AS BIGINT) % 10 = 1 AND CAST(code AS BIGINT) % 12 <> 0
    AND order_status <> 'paid') AS w""",
)
def changed_rows(t: Tables) -> DataFrame:
    """Three dumps of the orders. The last changes some and lacks some; only the changed ones are written."""
    path, code = scratch_path(t.spark, "changes"), F.col("code").cast("long")
    every = t.sale_orders().select("code", "event_id", F.col("order_status").alias("status"))
    paid = F.when(code % 10 == 1, "paid").otherwise(F.col("status"))
    merge_load(every.where("event_id < 150"), path, ["code"])
    merge_load(every, path, ["code"])
    written, _ = merge_load(every.where(code % 12 != 0).withColumn("status", paid), path, ["code"])
    return current_table(t.spark, path).withColumn("written_last", F.lit(written).cast("long"))


@query(
    "A05_csv_scan",
    """SELECT id, name, location, type, CAST(CAST(date AS TIMESTAMP) AS VARCHAR) AS date,
  CAST(CAST(ticket_open_date2 AS TIMESTAMP) AS VARCHAR) AS ticket_open_date2,
  CAST(CAST(ticket_close_date AS TIMESTAMP) AS VARCHAR) AS ticket_close_date, target FROM csv_events""",
)
def csv_scan(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "events-csv")
    write_csv(t.csv_events(), path)
    return read_csv(t.spark, path, schemas.CSV_EVENTS)


@query(
    "A05_line_audit",
    """SELECT id, name, CASE WHEN id % 5 = 2 THEN NULL ELSE CAST(CAST(ticket_close_date AS TIMESTAMP) AS VARCHAR) END AS ticket_close_date,
  CASE WHEN id % 5 IN (2, 3) THEN NULL ELSE target END AS target, CAST(n.lines AS BIGINT) AS lines,
  CAST(n.l AS BIGINT) AS long, CAST(n.s AS BIGINT) AS short, CAST(n.u AS BIGINT) AS unreadable FROM csv_events,
  (SELECT count(*) AS lines, count(*) FILTER (id % 5 = 1) AS l, count(*) FILTER (id % 5 = 2) AS s,
    count(*) FILTER (id % 5 = 3) AS u FROM csv_events) AS n""",
)
def line_audit(t: Tables) -> DataFrame:
    """A damaged extract of the events: a fifth each of long, short and unreadable lines. All rows are kept."""
    path, table = scratch_path(t.spark, "damaged-csv"), scratch_path(t.spark, "damaged")
    fields = [F.col(c).cast("string") for c in schemas.CSV_EVENTS.fieldNames()]
    kind, whole = F.col("id") % 5, F.concat_ws(",", *fields)
    line = (
        F.when(kind == 1, F.concat(whole, F.lit(",more")))
        .when(kind == 2, F.concat_ws(",", *fields[:-2]))
        .when(kind == 3, F.concat_ws(",", *fields[:-1], F.lit("many")))
        .otherwise(whole)
    )
    t.csv_events().select(line.alias(",".join(schemas.CSV_EVENTS.fieldNames()))).write.option("header", True).option(
        "sep", "\t"
    ).option("quote", "").csv(path)
    lines = AuditedCsv(t.spark, path, schemas.CSV_EVENTS)
    overwrite_load(lines.rows, table)
    counts = [F.lit(lines.counts()[kind]).cast("long").alias(kind) for kind in ("lines", "long", "short", "unreadable")]
    return current_table(t.spark, table).select("id", "name", "ticket_close_date", "target", *counts)


@query(
    "A06_warehouse_view_scan",
    """SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS "dateID", CAST(d AS VARCHAR) AS date,
  CAST(isodow(d) AS INTEGER) AS "dayOfWeekInt", strftime(d, '%Y%m') AS "yearMonthInt" FROM cal""",
)
def view_scan(t: Tables) -> DataFrame:
    """The calendar kept as a table with warehouse names, read back and renamed."""
    path = scratch_path(t.spark, "calendar")
    names = {"date_id": "dateID", "day_of_week_int": "dayOfWeekInt", "year_month_int": "yearMonthInt"}
    stored = t.calendar().select("date", *[F.col(new).alias(old) for old, new in names.items()])
    view = materialize(stored, path).withColumnsRenamed(names)
    return view.select("dateID", "date", "dayOfWeekInt", "yearMonthInt")


@query(
    "A07_literal_table",
    """SELECT d.days, count(*) AS orders FROM orders
JOIN (VALUES (3), (7), (14), (30), (60)) AS d(days)
  ON CAST(o_orderdate AS DATE) >= (SELECT max(CAST(o_orderdate AS DATE)) FROM orders) - d.days
GROUP BY d.days""",
)
def literal_table(t: Tables) -> DataFrame:
    """Orders inside each period of the day-period table, from one pass over the orders.

    Orders are counted per day first, so the parameter table meets at most one row a day.
    """
    orders = t.read("orders").select(F.to_date("o_orderdate").alias("d"))
    last = orders.agg(F.max("d")).scalar()
    ages = orders.select(F.date_diff(last, F.col("d")).alias("age")).groupBy("age").count()
    lengths = parameters.periods(t.spark, parameters.DAY_PERIODS)
    longest = max(parameters.DAY_PERIODS)
    covered = ages.where(F.col("age") <= longest).select(
        "count", F.explode(F.sequence("age", F.lit(longest))).alias("days")
    )
    return covered.join(F.broadcast(lengths), "days").groupBy("days").agg(F.sum("count").alias("orders"))


@query(
    "A08_table_materialize",
    """SELECT merchant_id AS id, any_value(merchant_name_en) AS organizer_name FROM
(SELECT merchant_id, array_to_string(list_transform(regexp_extract_all(merchant_name_en, '([\\p{L}]+|[^\\p{L}]+)'),
  lambda w: upper(w[1]) || lower(w[2:])), '') AS merchant_name_en FROM dump_order_events) GROUP BY merchant_id""",
)
def materialized(t: Tables) -> DataFrame:
    model = models.stg_organizers(raw.raw_organizers(t.dump_order_events()))
    return materialize(model, scratch_path(t.spark, "stg-organizers"))


_BUCKET = """CASE WHEN date_id >= 19950000 AND date_id < 20020101
  THEN CAST(floor((date_id - 19950000) / 15.0) AS INTEGER) ELSE -1 END"""


@query(
    "A09_int_range_partition",
    f"""SELECT bucket, count(*) AS rows, min(date_id) AS lo, max(date_id) AS hi
FROM (SELECT date_id, {_BUCKET} AS bucket FROM (SELECT CAST(strftime(purchased_at, '%Y%m%d') AS INTEGER) AS date_id
FROM sale_orders)) GROUP BY bucket""",
)
def range_buckets(t: Tables) -> DataFrame:
    rows = t.sale_orders().select(date_key(F.col("purchased_at")).alias("date_id"))
    return (
        with_range_bucket(rows, "date_id", 19950000, 20020101, 15)
        .groupBy("bucket")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.min("date_id").alias("lo"),
            F.max("date_id").alias("hi"),
        )
    )


@query(
    "A09_pruned_range_read",
    """SELECT code, date_id FROM (SELECT code, CAST(strftime(purchased_at, '%Y%m%d') AS INTEGER) AS date_id
FROM sale_orders) WHERE date_id BETWEEN 19970310 AND 19970620""",
)
def pruned_read(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "by-date-range")
    rows = t.sale_orders().select("code", date_key(F.col("purchased_at")).alias("date_id"))
    limits = {"start": 19950000, "end": 20020101, "width": 15}
    write_range_partitioned(rows, path, "date_id", **limits)
    found = read_key_range(t.spark, path, "date_id", 19970310, 19970620, **limits)
    return found.select("code", "date_id")
