"""C and J: projections, predicates and joins on the bound tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxoffice.catalog.bindings import Tables
from boxoffice.catalog.oracle import measures
from boxoffice.catalog.register import query
from boxoffice.functions.text import extract_or_null, lacks_words
from boxoffice.operators.joins import (
    by_role,
    in_values,
    lookup_date,
    not_in,
    star_join,
    with_membership,
)
from boxoffice.operators.metrics import kpi, measures_without_filters, single_values, without_filters
from boxoffice.plans import models, raw
from boxoffice.session import stable


@query("C01_project_rename", "SELECT c_custkey AS id, c_name AS customer_name, c_mktsegment AS segment FROM customer")
def project_rename(t: Tables) -> DataFrame:
    names = {"c_custkey": "id", "c_name": "customer_name", "c_mktsegment": "segment"}
    return t.read("customer").withColumnsRenamed(names).select(*names.values())


@query(
    "C02_case_when",
    """SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'F' THEN CAST(CAST(o_totalprice AS DECIMAL(18,4)) AS DOUBLE)
  ELSE 0 END AS paid, CASE o_orderstatus WHEN 'F' THEN 'Complete' WHEN 'O' THEN 'Open' ELSE 'Other' END AS state FROM orders""",
)
def case_when(t: Tables) -> DataFrame:
    state = F.col("o_orderstatus")
    return t.read("orders").select(
        F.col("o_orderkey").alias("id"),
        F.when(state == "F", F.col("o_totalprice").cast("decimal(18,4)")).otherwise(0).alias("paid"),
        F.when(state == "F", "Complete").when(state == "O", "Open").otherwise("Other").alias("state"),
    )


@query(
    "C03_like_filter",
    """SELECT event_id, event_name_en FROM dump_order_events
WHERE lower(event_name_en) NOT LIKE '%test%' AND lower(merchant_name_en) NOT LIKE '%test%'""",
)
def like_filter(t: Tables) -> DataFrame:
    keep = lacks_words(F.col("event_name_en"), "test") & lacks_words(F.col("merchant_name_en"), "test")
    return t.dump_order_events().where(keep).select("event_id", "event_name_en")


@query(
    "C04_regex_filter",
    f"""SELECT event_id, event_name_en FROM dump_order_events
WHERE regexp_matches(lower(event_name_en), '{models.SPORTS}')""",
)
def regex_filter(t: Tables) -> DataFrame:
    sports = F.lower("event_name_en").rlike(models.SPORTS)
    return t.dump_order_events().where(sports).select("event_id", "event_name_en")


@query(
    "C05_not_null_filter",
    """SELECT product_id, count(*) AS n FROM order_items JOIN sale_orders ON order_code = code
WHERE merchant_id IS NOT NULL AND product_name_en <> '' GROUP BY product_id""",
)
def not_null_filter(t: Tables) -> DataFrame:
    items = t.order_items().where(F.col("product_name_en") != "")
    orders = t.sale_orders().where(F.col("merchant_id").isNotNull())
    joined = items.join(orders, items["order_code"] == orders["code"])
    return joined.groupBy("product_id").agg(F.count(F.lit(1)).alias("n"))


@query(
    "C06_in_list",
    """SELECT code, CASE WHEN merchant_id NOT IN (1, 2, 3) THEN 'OTHERS' ELSE CAST(merchant_id AS VARCHAR) END AS merchant
FROM sale_orders""",
)
def in_list(t: Tables) -> DataFrame:
    merchant = F.col("merchant_id")
    label = F.when(~merchant.isin(1, 2, 3), "OTHERS").otherwise(merchant.cast("string"))
    return t.sale_orders().select("code", label.alias("merchant"))


@query(
    "C07_cast",
    """SELECT o_orderkey AS id, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, CAST(o_orderkey AS VARCHAR) AS code,
  TRY_CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS priority, TRY_CAST(o_orderpriority AS BIGINT) AS not_a_number FROM orders""",
)
def casts(t: Tables) -> DataFrame:
    priority = F.col("o_orderpriority")
    return t.read("orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderdate").cast("date").alias("day"),
        F.col("o_orderkey").cast("string").alias("code"),
        F.substring(priority, 1, 1).try_cast("bigint").alias("priority"),
        priority.try_cast("bigint").alias("not_a_number"),
    )


@query(
    "C08_null_default",
    """SELECT code, coalesce(type, 'Website') AS account_type FROM raw_customers
LEFT JOIN raw_login ON code = customer_code""",
)
def null_default(t: Tables) -> DataFrame:
    login = raw.raw_login(t.dump_login()).select(F.col("customer_code").alias("code"), "type")
    rows = t.dump_customers().select("code").join(login, "code", "left")
    return rows.select("code", F.coalesce("type", F.lit("Website")).alias("account_type"))


@query(
    "C09_filter_context",
    """SELECT "eventID", "paymentMethod", CAST(profit AS DOUBLE) AS profit,
  CAST(sum(profit) OVER (PARTITION BY "eventID") AS DOUBLE) AS profit_all_payments,
  CAST(sum(profit) OVER (PARTITION BY "paymentMethod") AS DOUBLE) AS profit_all_events,
  CAST(sum(profit) OVER () AS DOUBLE) AS profit_selected
FROM (SELECT "eventID", "paymentMethod", sum(gross - dval) FILTER (WHERE "orderStatus" = 1) AS profit
  FROM fact WHERE "creationDateID" >= 19980101 GROUP BY ALL)""",
)
def filter_context(t: Tables) -> DataFrame:
    """A filter kept for all values, and filters on payment, event or both taken away."""
    selected = kpi(
        t.fact(), ["profit"], ["eventID", "paymentMethod"], F.col("creationDateID") >= 19980101
    )
    return without_filters(
        stable(selected),
        "profit",
        {
            "profit_all_payments": ["eventID"],
            "profit_all_events": ["paymentMethod"],
            "profit_selected": [],
        },
    )


def _margins(where: str, keys: str, suffix: str) -> str:
    return f"""(SELECT {keys}{measures("profit_margin", "avg_profit_per_order")} FROM fact WHERE {where} GROUP BY ALL) {suffix}"""


@query(
    "C09_ratio_contexts",
    f"""SELECT g."eventID", g."paymentMethod", g.profit_margin, g.avg_profit_per_order,
  a.profit_margin AS profit_margin_all_payments, a.avg_profit_per_order AS avg_profit_per_order_all_payments,
  b.profit_margin AS profit_margin_all_events, b.avg_profit_per_order AS avg_profit_per_order_all_events,
  c.profit_margin AS profit_margin_selected, c.avg_profit_per_order AS avg_profit_per_order_selected
FROM {_margins('"creationDateID" >= 19970601', '"eventID", "paymentMethod", ', "g")}
JOIN {_margins('"creationDateID" >= 19970601', '"eventID", ', "a")} ON g."eventID" = a."eventID"
JOIN {_margins('"creationDateID" >= 19970601', '"paymentMethod", ', "b")} ON g."paymentMethod" = b."paymentMethod"
CROSS JOIN {_margins('"creationDateID" >= 19970601', "", "c")}""",
)
def ratio_contexts(t: Tables) -> DataFrame:
    """Ratios under filters taken away, each from the sums of its own context."""
    return measures_without_filters(
        t.fact().where(F.col("creationDateID") >= 19970601),
        ["profit_margin", "avg_profit_per_order"],
        ["eventID", "paymentMethod"],
        {"all_payments": ["eventID"], "all_events": ["paymentMethod"], "selected": []},
    )


@query(
    "C10_single_value_guard",
    """SELECT "customerID", CASE WHEN count(DISTINCT "paymentMethod") = 1 THEN min("paymentMethod") END AS "paymentMethod",
  CASE WHEN count(DISTINCT "orderStatus") = 1 THEN min("orderStatus") END AS "orderStatus" FROM fact GROUP BY 1""",
)
def single_value_guard(t: Tables) -> DataFrame:
    return single_values(t.fact(), ["paymentMethod", "orderStatus"], ["customerID"])


@query(
    "J01_left_equi_join",
    """SELECT c_custkey AS id, o_orderkey AS order_id FROM customer LEFT JOIN orders ON c_custkey = o_custkey""",
)
def left_equi_join(t: Tables) -> DataFrame:
    rows = t.read("customer").join(t.read("orders"), F.expr("c_custkey = o_custkey"), "left")
    return rows.select(F.col("c_custkey").alias("id"), F.col("o_orderkey").alias("order_id"))


@query(
    "J02_left_composite_join",
    """SELECT oi.id, oi.product_id, oa.category_en AS category FROM order_items oi
LEFT JOIN attendants oa ON oi.id = oa.item_id AND oi.product_id = oa.product_id""",
)
def left_composite_join(t: Tables) -> DataFrame:
    present = t.attendants().select(
        F.col("item_id").alias("id"), "product_id", F.col("category_en").alias("category")
    )
    items = t.order_items().select("id", "product_id")
    return items.join(present, ["id", "product_id"], "left")


@query(
    "J03_inner_equi_join",
    "SELECT code, count(*) AS items, CAST(sum(quantity) AS BIGINT) AS quantity FROM sale_orders JOIN order_items ON code = order_code GROUP BY code",
)
def inner_equi_join(t: Tables) -> DataFrame:
    """Items are summed per order before they meet the orders."""
    items = t.order_items().groupBy(F.col("order_code").alias("code")).agg(
        F.count(F.lit(1)).alias("items"), F.sum("quantity").alias("quantity")
    )
    return t.sale_orders().select("code").join(items, "code")


@query(
    "J04_self_join_many_to_many",
    """SELECT a.product_id, a.event_id, a.product_name, p.phase FROM names a
JOIN (SELECT DISTINCT product_id, CASE WHEN regexp_matches(product_name, '.* - (.*)')
  THEN regexp_extract(product_name, '.* - (.*)', 1) END AS phase FROM names) p ON a.product_id = p.product_id""",
    names="""SELECT DISTINCT product_id, event_id, trim(upper(product_name_en)) AS product_name
FROM order_items JOIN sale_orders ON order_code = code
WHERE product_name_en <> '' AND event_id IN (SELECT id FROM stg_events)""",
)
def self_join(t: Tables) -> DataFrame:
    """Each product name with every phase that occurs in the names of its product."""
    names = models.named_products(t.order_items(), t.sale_orders(), t.stg_events())
    phase = extract_or_null(F.col("product_name"), ".* - (.*)").alias("phase")
    return names.join(names.select("product_id", phase).distinct(), "product_id")


@query(
    "J05_semi_join",
    "SELECT code, event_id FROM sale_orders WHERE event_id IN (SELECT id FROM stg_events) AND merchant_id IS NOT NULL",
)
def semi_join(t: Tables) -> DataFrame:
    orders = t.sale_orders().where(F.col("merchant_id").isNotNull()).select("code", "event_id")
    return in_values(orders, "event_id", t.stg_events(), "id")


@query(
    "J06_null_aware_anti_join",
    """SELECT 'no null among values' AS case_name, code, merchant_id FROM sale_orders
  WHERE merchant_id NOT IN (SELECT merchant_id FROM dump_order_events WHERE merchant_id < 7)
UNION ALL SELECT 'a null among values', code, merchant_id FROM sale_orders
  WHERE merchant_id NOT IN (SELECT nullif(merchant_id, 3) FROM dump_order_events)
UNION ALL SELECT 'no values', code, merchant_id FROM sale_orders
  WHERE merchant_id NOT IN (SELECT merchant_id FROM dump_order_events WHERE merchant_id > 99)""",
)
def null_aware_anti_join(t: Tables) -> DataFrame:
    orders = t.sale_orders().select("code", "merchant_id")
    dump = t.dump_order_events().select("merchant_id")
    cases = {
        "no null among values": dump.where("merchant_id < 7"),
        "a null among values": dump.select(F.nullif("merchant_id", F.lit(3)).alias("merchant_id")),
        "no values": dump.where("merchant_id > 99"),
    }
    parts = [
        not_in(orders, "merchant_id", values, "merchant_id").select(
            F.lit(name).alias("case_name"), "code", "merchant_id"
        )
        for name, values in cases.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "J07_existence_join",
    """SELECT code, nationality, CASE WHEN nationality IN (SELECT alpha2_code FROM countries) THEN 1 ELSE 0 END AS is_country
FROM raw_customers""",
)
def existence_join(t: Tables) -> DataFrame:
    people = raw.raw_customers(t.dump_customers()).select("code", "nationality")
    return with_membership(people, "nationality", t.countries(), "alpha2_code", "is_country")


@query(
    "J08_star_join",
    f"""SELECT location, distance, phase, "ageGroup", gender, year, {measures("total_orders", "tickets", "profit")}
FROM (SELECT f.*, ev.location, part.p_type AS distance, CAST(year(f."creationDate") AS INTEGER) AS year, c."ageGroup", c.gender,
  CASE 1 + p_size % 5 WHEN 1 THEN 'Super Early Bird' WHEN 2 THEN 'Early Bird' WHEN 3 THEN 'Standard' WHEN 4 THEN 'Late' ELSE 'Others' END AS phase
  FROM fact f LEFT JOIN ev ON f."eventID" = ev.id LEFT JOIN cust c ON f."customerID" = c.id LEFT JOIN part ON f."ticketID" = p_partkey)
GROUP BY ALL""",
)
def star(t: Tables) -> DataFrame:
    joined = star_join(
        t.fact(), t.events(), t.customers(), t.tickets(), t.phases(), t.calendar()
    )
    by = ["location", "distance", "phase", "ageGroup", "gender", "year"]
    return kpi(joined, ["total_orders", "tickets", "profit"], by)


@query(
    "J09_role_playing_date_join",
    """SELECT 'creationDateID' AS role, c."yearMonthInt", count(*) AS accounts FROM
  (SELECT strftime(created_at, '%Y%m') AS "yearMonthInt" FROM csv_customers) c GROUP BY ALL
UNION ALL SELECT 'lastLoginDateID', strftime(last_login_at, '%Y%m'), count(*) FROM csv_customers
  WHERE CAST(last_login_at AS DATE) IN (SELECT d FROM cal) GROUP BY ALL""",
)
def role_playing(t: Tables) -> DataFrame:
    people, days = t.customers(), t.calendar()
    parts = [
        by_role(people, days, role, ["yearMonthInt"])
        .groupBy(F.lit(role).alias("role"), "yearMonthInt")
        .agg(F.count(F.lit(1)).alias("accounts"))
        for role in ("creationDateID", "lastLoginDateID")
    ]
    return parts[0].unionByName(parts[1])


@query(
    "J10_value_lookup",
    """SELECT "eventID", max("creationDateID") AS last_id, CAST(max("creationDate") AS VARCHAR) AS last_date FROM fact GROUP BY 1""",
)
def value_lookup(t: Tables) -> DataFrame:
    last = t.fact().groupBy("eventID").agg(F.max("creationDateID").alias("last_id"))
    return lookup_date(last, "last_id", "last_date")
