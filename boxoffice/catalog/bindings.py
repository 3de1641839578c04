"""The ticketing tables, derived from the order tables of the test data."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boxoffice.functions.dates import date_key
from boxoffice.functions.numbers import to_units
from boxoffice.plans import bi_tables, models, raw

CUTOFF = dt.date(2000, 1, 1)
AS_OF = dt.date(2001, 8, 1)

# The columns of the test tables. A declared schema spares a look into the files.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
}

PHASE_TEXTS = [
    "super bird",
    "Early Bird Ticket",
    "Standard",
    "General Price",
    "supper late",
    "gr late",
    "flash sale",
    "presales",
    "VIP (late)",
    "Package X",
]
EVENT_SUFFIXES = [" marathon", " night run-5km", " test", " demo", " gala"]


def _after(start: Column, seconds: Column) -> Column:
    return start + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))


def _pick(c: Column, texts: list[str]) -> Column:
    out = F.when(F.lit(False), F.lit(""))
    for i, text in enumerate(texts):
        out = out.when(c % len(texts) == i, text)
    return out


class Tables:
    """Lazy frames over one data folder; only what a query touches is read."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def read(self, name: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet")

    # Star schema

    def fact(self) -> DataFrame:
        rows = self.read("lineitem").join(self.read("orders"), F.expr("l_orderkey = o_orderkey"))
        created, bought = F.to_date("o_orderdate"), F.to_date("l_shipdate")
        return rows.select(
            F.col("l_orderkey").alias("id"),
            F.col("o_custkey").alias("customerID"),
            F.col("l_partkey").alias("ticketID"),
            F.col("l_suppkey").alias("eventID"),
            F.col("l_quantity").cast("bigint").alias("totalTickets"),
            to_units(F.col("l_extendedprice")).alias("grossUnits"),
            F.col("l_discount").alias("discount"),
            F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("orderStatus"),
            F.col("o_orderpriority").alias("paymentMethod"),
            created.alias("creationDate"),
            bought.alias("purchaseDate"),
            date_key(created).alias("creationDateID"),
            date_key(bought).alias("purchaseDateID"),
            ((F.col("l_orderkey") * 7 + F.col("l_linenumber")) % 24).cast("int").alias("todSort"),
        )

    def csv_events(self) -> DataFrame:
        k = F.col("s_suppkey")
        opened = F.lit(dt.date(1995, 1, 1))
        return (
            self.read("supplier")
            .join(self.read("nation"), F.expr("s_nationkey = n_nationkey"))
            .select(
                k.alias("id"),
                F.col("s_name").alias("name"),
                F.col("n_name").alias("location"),
                F.when(k % 2 == 0, "run").otherwise("ride").alias("type"),
                F.date_add(F.lit(dt.date(1998, 3, 1)), (200 * (k % 7)).cast("int")).alias("date"),
                F.date_add(opened, (k % 30).cast("int")).alias("ticket_open_date2"),
                F.date_add(F.lit(dt.date(1998, 1, 1)), (200 * (k % 7)).cast("int")).alias(
                    "ticket_close_date"
                ),
                (1000 + 100 * (k % 7)).alias("target"),
            )
        )

    def events(self) -> DataFrame:
        return bi_tables.named_events(self.csv_events(), CUTOFF)

    def csv_tickets(self) -> DataFrame:
        k = F.col("p_partkey")
        return self.read("part").select(
            k.alias("_"),
            k.alias("ticket_id"),
            (k % 10).alias("event_id"),
            F.col("p_type").alias("distance"),
            (1 + F.col("p_size") % 5).cast("bigint").alias("phase_id"),
            F.floor("p_retailprice").alias("price"),
        )

    def tickets(self) -> DataFrame:
        return bi_tables.dim_tickets(self.csv_tickets())

    def phases(self) -> DataFrame:
        return bi_tables.dim_ticket_phase(self.csv_tickets())

    def csv_customers(self) -> DataFrame:
        k = F.col("c_custkey")
        made = F.date_add(F.lit(dt.date(1995, 1, 1)), (k * 7 % 2000).cast("int"))
        created = _after(made.cast("timestamp_ntz"), k * 61 % 86400)
        return (
            self.read("customer")
            .join(self.read("nation"), F.expr("c_nationkey = n_nationkey"))
            .join(self.read("region"), F.expr("n_regionkey = r_regionkey"))
            .select(
                k.alias("customer_id"),
                F.col("c_name").alias("first_name"),
                F.lit("").alias("last_name"),
                F.concat(F.lit("c"), k.cast("string"), F.lit("@mail")).alias("email"),
                F.date_add(F.lit(dt.date(1950, 1, 1)), (k * 37 % 20000).cast("int")).alias(
                    "date_of_birth"
                ),
                F.lit("").alias("street_address"),
                F.col("n_name").alias("city"),
                F.col("r_name").alias("state"),
                F.when(k % 2 == 0, "Female").otherwise("Male").alias("gender"),
                created.alias("created_at"),
                created.alias("updated_at"),
                _after(created, k * 4057 % 8640000).alias("last_login_at"),
            )
        )

    def customers(self) -> DataFrame:
        return bi_tables.dim_customers(self.csv_customers(), AS_OF)

    def csv_orders(self) -> DataFrame:
        k, n = F.col("l_orderkey"), F.col("l_linenumber")
        created = _after(F.col("o_orderdate"), k * 137 % 86400)
        return (
            self.read("lineitem")
            .join(self.read("orders"), F.expr("l_orderkey = o_orderkey"))
            .select(
                k.alias("order_id"),
                F.col("o_custkey").alias("customer_id"),
                F.col("l_partkey").alias("ticket_id"),
                F.col("l_suppkey").alias("event_id"),
                F.col("l_quantity").cast("bigint").alias("total_tickets"),
                F.when(F.col("o_orderstatus") == "F", "succeeded")
                .otherwise("failed")
                .alias("order_status"),
                F.col("o_orderpriority").alias("payment_method"),
                created.alias("created_at"),
                _after(created, (k * 7 + n * 611) % 7200).alias("completed_at"),
                F.lit(None).cast("timestamp_ntz").alias("cancelled_at"),
                F.floor("l_extendedprice").alias("price"),
                F.col("l_discount").alias("discount"),
            )
        )

    def calendar(self) -> DataFrame:
        return bi_tables.dim_calendar(self.calendar_bounds(), AS_OF)

    def calendar_bounds(self) -> DataFrame:
        ends = self.read("orders").agg(
            F.to_date(F.min("o_orderdate")).alias("creationDate"),
            F.to_date(F.max("o_orderdate")).alias("purchaseDate"),
        )
        shipped = self.read("lineitem").agg(
            F.to_date(F.min("l_shipdate")).alias("creationDate"),
            F.to_date(F.max("l_shipdate")).alias("purchaseDate"),
        )
        return bi_tables.calendar_bounds(ends.union(shipped))

    # Raw dumps

    def sale_orders(self) -> DataFrame:
        k = F.col("o_orderkey")
        created = _after(F.col("o_orderdate"), k * 977 % 86400)
        return self.read("orders").select(
            k.cast("string").alias("code"),
            (k % 200).alias("event_id"),
            F.col("o_custkey").cast("string").alias("customer_code"),
            F.when(F.col("o_orderstatus") == "F", models.SUCCESS)
            .when(F.col("o_orderstatus") == "O", "cho_thanh_toan")
            .otherwise("da_huy")
            .alias("order_status"),
            F.when(k % 2 == 0, "online_order").otherwise("offline_order").alias("order_type"),
            F.lower(F.replace("o_orderpriority", F.lit("-"), F.lit("_"))).alias("payment_method"),
            created.alias("created_at"),
            F.when(k % 13 != 0, _after(created, k * 7 % 1500 - 300)).alias("purchased_at"),
            F.when(k % 11 != 0, k % 10).alias("merchant_id"),
        )

    def order_items(self) -> DataFrame:
        k = F.col("p_partkey")
        subtotal = F.col("l_extendedprice").cast("decimal(18,4)")
        off = (subtotal * F.col("l_discount").cast("decimal(6,4)")).cast("decimal(18,4)")
        name = (
            F.when(k % 17 == 0, "")
            .when(F.col("l_linenumber") == 1, F.col("p_name"))
            .otherwise(F.concat("p_name", F.lit(" - "), _pick(k, PHASE_TEXTS)))
        )
        return (
            self.read("lineitem")
            .join(self.read("part"), F.expr("l_partkey = p_partkey"))
            .select(
                (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
                F.col("l_orderkey").cast("string").alias("order_code"),
                k.alias("product_id"),
                F.col("l_quantity").cast("bigint").alias("quantity"),
                subtotal.alias("subtotal"),
                off.alias("discount_amount"),
                (subtotal - off).cast("decimal(18,4)").alias("grand_total"),
                name.alias("product_name_en"),
                F.col("p_type").alias("ticket_phase_name_en"),
            )
        )

    def attendants(self) -> DataFrame:
        k = F.col("l_partkey")
        return (
            self.read("lineitem")
            .where("l_returnflag <> 'N'")
            .select(
                (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("item_id"),
                F.col("l_orderkey").cast("string").alias("order_code"),
                k.alias("product_id"),
                F.concat(F.lit("Category "), (k % 4).cast("string")).alias("category_en"),
            )
            .distinct()
        )

    def dump_order_events(self) -> DataFrame:
        k = F.col("p_partkey")
        day = F.date_add(F.lit(dt.date(2023, 1, 1)), (k % 360).cast("int"))
        time = (
            F.when(k % 28 == 0, "99/99/2023")
            .when(k % 4 == 0, F.date_format(day, "dd/MM/yyyy"))
            .when(k % 4 == 1, F.date_format(day, "dd MMM yyyy"))
            .when(k % 4 == 2, F.date_format(day, "dd MMM, yyyy"))
            .otherwise(F.concat(F.lit("01 - "), F.date_format(day, "dd MMM,  yyyy")))
        )
        merchant = F.when(k % 10 == 9, "Test merchant").otherwise(
            F.concat(F.lit("o'neil run-club 10km "), (k % 10).cast("string"))
        )
        rows = (
            self.read("part")
            .where("p_type <> 'PROMO'")
            .select(
                k.alias("event_id"),
                F.concat("p_name", _pick(k, EVENT_SUFFIXES)).alias("event_name_en"),
                (k % 10).alias("merchant_id"),
                merchant.alias("merchant_name_en"),
                time.alias("time_en"),
                "p_type",
            )
        )
        again = rows.where("p_type = 'LARGE'").withColumn("time_en", F.lit("to be announced"))
        return rows.unionByName(again).drop("p_type")

    def dump_events(self) -> DataFrame:
        k = F.col("p_partkey")
        day = F.date_add(F.lit(dt.date(2023, 1, 1)), (k % 360).cast("int"))
        return (
            self.read("part")
            .where("p_type <> 'SMALL'")
            .select(
                k.alias("event_id"),
                F.concat("p_name", _pick(k, EVENT_SUFFIXES)).alias("event_name"),
                F.lower("p_type").alias("event_type"),
                F.concat(day.cast("string"), F.lit(" 06:30:00")).alias("start_date"),
                F.concat(F.date_add(day, 1).cast("string"), F.lit(" 18:00:00")).alias("end_date"),
            )
        )

    def dump_customers(self) -> DataFrame:
        k = F.col("c_custkey")
        born = F.date_add(F.lit(dt.date(1950, 1, 1)), (k * 37 % 20000).cast("int"))
        made = F.date_add(F.lit(dt.date(2020, 1, 1)), (k * 7 % 1500).cast("int"))
        created = _after(made.cast("timestamp_ntz"), k * 61 % 86400)
        birthday = (
            F.when(k % 4 == 0, born.cast("string"))
            .when(k % 4 == 1, F.date_format(born, "dd/MM/yyyy"))
            .when(k % 4 == 2, F.date_format(born, "dd MMM yyyy"))
            .otherwise("n/a")
        )
        return (
            self.read("customer")
            .join(self.read("nation"), F.expr("c_nationkey = n_nationkey"))
            .select(
                k.cast("string").alias("code"),
                (k % 2).cast("int").alias("is_activated"),
                F.when(k % 7 == 0, "vietnam").otherwise(F.col("n_name")).alias("nationality"),
                birthday.alias("birthday"),
                created.alias("created_at"),
                F.when(k % 5 != 0, _after(created, k * 4057 % 8640000)).alias("last_login_at"),
            )
        )

    def countries(self) -> DataFrame:
        return self.read("nation").where("n_regionkey <= 2").select(F.col("n_name").alias("alpha2_code"))

    def dump_login(self) -> DataFrame:
        k, ts = F.col("event_id"), F.col("ts")
        return self.read("events").select(
            F.when(k % 97 != 0, F.col("user_id").cast("string")).alias("customer_code"),
            F.col("event_type").alias("type"),
            (ts - F.expr("interval 1 hour")).cast("string").alias("created_at"),
            F.when(k % 211 != 0, ts.cast("string")).alias("updated_at"),
        )

    # Raw and staged tables

    def raw_events(self) -> DataFrame:
        return raw.raw_events(self.dump_events())

    def raw_order_events(self) -> DataFrame:
        return raw.raw_order_events(self.dump_order_events())

    def stg_events(self) -> DataFrame:
        return models.stg_events(self.raw_order_events(), self.raw_events())

    def stg_orders(self) -> DataFrame:
        return models.stg_orders(self.sale_orders(), self.order_items(), self.stg_events())

    def stg_customers(self) -> DataFrame:
        return models.stg_customers(
            raw.raw_customers(self.dump_customers()),
            raw.raw_login(self.dump_login()),
            self.countries(),
        )
