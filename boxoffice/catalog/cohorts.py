"""H: new and repeat customers. The SQL forms compare each context with all past orders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxoffice.catalog.bindings import Tables
from boxoffice.catalog.oracle import PROFIT, TICKETS, div
from boxoffice.catalog.register import query
from boxoffice.functions.dates import month_start
from boxoffice.operators import cohorts as c
from boxoffice.session import scratch_path, stable
from boxoffice.sources.first_dates import first_bought, first_ordered, merge_first_dates


def with_ym(fact: DataFrame, date: str = "creationDate") -> DataFrame:
    return fact.withColumn("ym", F.year(date) * 100 + F.month(date))


_ORDER = ("customerID", "eventID", "orderStatus", "creationDate", "creationDateID", "grossUnits", "discount")


def joined_orders(t: Tables, *more: str) -> DataFrame:
    """The columns of the fact that the loads and their figures read, joined and written once for all of them."""
    return stable(t.fact().select(*_ORDER, *more))


def by_month_loads(fact: DataFrame, keep: tuple[str, ...] = ()) -> str:
    """The table of first dates after three loads, the middle one late; returns its path."""
    path = scratch_path(fact.sparkSession, "first-dates")
    until, since = F.col("creationDateID") < 19950000, F.col("creationDateID") >= 19970000
    for part in (until, since, ~until & ~since):
        merge_first_dates(fact.where(part), path, keep)
    return path


def event_months(t: Tables, sums: tuple[str, ...] = ()) -> DataFrame:
    """Customers per event and month, the contexts of most cohort queries."""
    return c.customer_contexts(with_ym(t.fact()), ["eventID", "ym"], sums)


_AMOUNTS = ("s_gross", "s_discount", "s_tickets")


_CTES = {
    "fm": 'SELECT *, CAST(year("creationDate") * 100 + month("creationDate") AS INTEGER) AS ym FROM fact',
    "ctx": 'SELECT "eventID", ym, min("creationDate") AS start FROM fm GROUP BY ALL',
    "cur": f"""SELECT "eventID", ym, "customerID", {TICKETS} AS tickets, {PROFIT} AS profit,
  sum(dval) FILTER (WHERE "orderStatus" = 1) AS discount FROM fm WHERE "orderStatus" = 1 GROUP BY ALL""",
    "tagged": """SELECT cur.*, EXISTS (SELECT 1 FROM okf p WHERE p."customerID" = cur."customerID"
  AND p."creationDate" < ctx.start) AS past FROM cur JOIN ctx ON cur."eventID" = ctx."eventID" AND cur.ym = ctx.ym""",
    "by_payment": """SELECT DISTINCT "eventID", "paymentMethod", "customerID" FROM okf""",
}


@query(
    "H01_new_customers",
    """SELECT "eventID", ym, count(*) FILTER (WHERE NOT past) AS new_customers FROM tagged GROUP BY ALL HAVING new_customers > 0""",
    **_CTES,
)
def new_customers(t: Tables) -> DataFrame:
    counts = c.cohort_counts(event_months(t), ["eventID", "ym"])
    return counts.where("new_customers IS NOT NULL").select("eventID", "ym", "new_customers")


@query(
    "H01_customers_from_first_dates",
    """SELECT "eventID", ym, nullif(count(*) FILTER (WHERE NOT past), 0) AS new_customers,
  nullif(count(*) FILTER (WHERE past), 0) AS repeat_customers, count(*) AS total_customers FROM tagged GROUP BY ALL""",
    **_CTES,
)
def customers_from_first_dates(t: Tables) -> DataFrame:
    """New and repeat customers of all months, with first purchases from the stored table."""
    fact = joined_orders(t)
    contexts = c.customer_contexts(with_ym(fact), ["eventID", "ym"], ())
    first_ever = first_bought(t.spark, by_month_loads(fact))
    return c.cohort_counts(contexts, ["eventID", "ym"], first_ever=first_ever)


@query(
    "H01_by_payment_from_first_dates",
    """SELECT b."eventID", b."paymentMethod", nullif(count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM okf p
  WHERE p."customerID" = b."customerID" AND p."paymentMethod" = b."paymentMethod" AND p."creationDate" < x.start)), 0) AS new_customers
FROM by_payment b JOIN (SELECT "eventID", "paymentMethod", min("creationDate") AS start FROM fact GROUP BY ALL) x
  ON b."eventID" = x."eventID" AND b."paymentMethod" = x."paymentMethod" GROUP BY ALL""",
    **_CTES,
)
def by_payment_from_first_dates(t: Tables) -> DataFrame:
    """The stored table has one row per customer and payment method here."""
    by, keep, fact = ["eventID", "paymentMethod"], ("paymentMethod",), joined_orders(t, "paymentMethod")
    first_ever = first_bought(t.spark, by_month_loads(fact, keep), keep)
    counts = c.cohort_counts(c.customer_contexts(fact, by, ()), by, keep, first_ever)
    return counts.select("eventID", "paymentMethod", "new_customers")


@query(
    "H01_new_customers_by_payment",
    """SELECT b."eventID", b."paymentMethod", nullif(count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM okf p
  WHERE p."customerID" = b."customerID" AND p."paymentMethod" = b."paymentMethod" AND p."creationDate" < x.start)), 0) AS new_customers
FROM by_payment b JOIN (SELECT "eventID", "paymentMethod", min("creationDate") AS start FROM fact GROUP BY ALL) x
  ON b."eventID" = x."eventID" AND b."paymentMethod" = x."paymentMethod" GROUP BY ALL""",
    **_CTES,
)
def new_customers_by_payment(t: Tables) -> DataFrame:
    """The filter on the payment method also holds for the past orders."""
    by = ["eventID", "paymentMethod"]
    counts = c.cohort_counts(c.customer_contexts(t.fact(), by, ()), by, keep=["paymentMethod"])
    return counts.select("eventID", "paymentMethod", "new_customers")


@query(
    "H02_repeat_customers",
    """SELECT "eventID", ym, count(*) FILTER (WHERE past) AS repeat_customers FROM tagged GROUP BY ALL HAVING repeat_customers > 0""",
    **_CTES,
)
def repeat_customers(t: Tables) -> DataFrame:
    counts = c.cohort_counts(event_months(t), ["eventID", "ym"])
    return counts.where("repeat_customers IS NOT NULL").select("eventID", "ym", "repeat_customers")


def _value_sql(kind: str) -> str:
    test = "NOT past" if kind == "new" else "past"
    return f"""SELECT "eventID", ym, CAST(sum(profit) FILTER (WHERE {test}) AS DOUBLE) AS {kind}_value,
  CAST(sum(tickets) FILTER (WHERE {test}) AS BIGINT) AS {kind}_tickets,
  CAST(sum(discount) FILTER (WHERE {test}) AS DOUBLE) AS {kind}_discount FROM tagged GROUP BY ALL"""


@query("H03_new_customers_value", _value_sql("new"), **_CTES)
def new_value(t: Tables) -> DataFrame:
    values = c.cohort_value(event_months(t, _AMOUNTS), ["eventID", "ym"])
    return values.select("eventID", "ym", "new_value", "new_tickets", "new_discount")


@query("H04_repeat_customers_value", _value_sql("repeat"), **_CTES)
def repeat_value(t: Tables) -> DataFrame:
    values = c.cohort_value(event_months(t, _AMOUNTS), ["eventID", "ym"])
    return values.select("eventID", "ym", "repeat_value", "repeat_tickets", "repeat_discount")


_PERIOD = """SELECT "eventID", ym, sum(gross - dval) FILTER (WHERE "orderStatus" = 1) AS v FROM fm
WHERE NOT EXISTS (SELECT 1 FROM fact p WHERE p."customerID" = fm."customerID" AND p."eventID" = fm."eventID"
  AND p."creationDate" < date_trunc('month', fm."creationDate")) GROUP BY ALL"""


@query(
    "H05_total_new_customers_value",
    'SELECT "eventID", ym, CAST(v AS DOUBLE) AS total_new_customers_value FROM fresh',
    fresh=_PERIOD,
    **_CTES,
)
def total_new_value(t: Tables) -> DataFrame:
    return c.period_cohort_value(
        event_months(t, _AMOUNTS[:2]), ["eventID"], "ym", month_start(F.col("first_order"))
    )


@query(
    "H06_avg_new_customer_value",
    f"""SELECT coalesce(n."eventID", fresh."eventID") AS "eventID", coalesce(n.ym, fresh.ym) AS ym, new_customers,
  CAST(v AS DOUBLE) AS total_new_customers_value, {div("v", "new_customers", "0")} AS avg_new_customers_value
FROM (SELECT "eventID", ym, nullif(count(*) FILTER (WHERE NOT past), 0) AS new_customers FROM tagged GROUP BY ALL) n
FULL JOIN fresh ON n."eventID" = fresh."eventID" AND n.ym = fresh.ym""",
    fresh=_PERIOD,
    **_CTES,
)
def avg_new_value(t: Tables) -> DataFrame:
    return c.avg_new_customer_value(
        event_months(t, _AMOUNTS[:2]), ["eventID"], "ym", month_start(F.col("first_order"))
    )


@query(
    "H06_value_from_first_dates",
    f"""SELECT coalesce(n."eventID", fresh."eventID") AS "eventID", coalesce(n.ym, fresh.ym) AS ym, new_customers,
  CAST(v AS DOUBLE) AS total_new_customers_value, {div("v", "new_customers", "0")} AS avg_new_customers_value
FROM (SELECT "eventID", ym, nullif(count(*) FILTER (WHERE NOT past), 0) AS new_customers FROM tagged
  WHERE ym >= 199701 GROUP BY ALL) n
FULL JOIN (SELECT * FROM fresh WHERE ym >= 199701) fresh ON n."eventID" = fresh."eventID" AND n.ym = fresh.ym""",
    fresh=_PERIOD,
    **_CTES,
)
def value_from_first_dates(t: Tables) -> DataFrame:
    """The months of a late selection: orders before it are read by the stored tables only."""
    fact = joined_orders(t)
    late = with_ym(fact.where(F.col("creationDateID") >= 19970101))
    contexts = c.customer_contexts(late, ["eventID", "ym"], _AMOUNTS[:2])
    return c.avg_new_customer_value(
        contexts,
        ["eventID"],
        "ym",
        month_start(F.col("first_order")),
        first_bought(t.spark, by_month_loads(fact)),
        first_ordered(t.spark, by_month_loads(fact, ("eventID",)), ["eventID"]),
    )


@query(
    "H07_new_users",
    "SELECT CAST(strftime(created_at, '%Y%m') AS INTEGER) AS ym, count(DISTINCT customer_id) AS new_users FROM csv_customers GROUP BY 1",
)
def new_users(t: Tables) -> DataFrame:
    return c.new_users(t.customers(), F.floor(F.col("creationDateID") / 100).cast("int"), "ym")


@query(
    "H08_new_users_who_purchased",
    """SELECT ym, count(DISTINCT "customerID") AS new_users_who_purchased FROM fm JOIN cust ON "customerID" = cust.id
WHERE "orderStatus" = 1 AND cust."creationDateID" // 100 = ym GROUP BY ym""",
    **_CTES,
)
def new_users_bought(t: Tables) -> DataFrame:
    return c.new_users_who_purchased(
        t.fact(),
        t.customers(),
        F.floor(F.col("creationDateID") / 100).cast("int"),
        F.floor(F.col("creationDateID") / 100).cast("int"),
        "ym",
    )


def _share(kind: str, name: str) -> str:
    part, whole = f"{kind}_{name}", f"total_{name}"
    return f"{div(part, f'greatest({part}, {whole})')} AS {kind}_{name}_share"


def _sign(name: str) -> str:
    return f"CAST(sign(coalesce(new_{name}, 0) - coalesce(repeat_{name}, 0)) AS INTEGER) AS {name}_sign"


_KINDS = ("customers", "value", "tickets", "discount")


@query(
    "H09_new_vs_repeat_share",
    f"""SELECT "eventID", {", ".join(_share(k, n) for n in _KINDS for k in ("new", "repeat"))},
  {", ".join(_sign(n) for n in _KINDS)} FROM (SELECT "eventID",
  nullif(count(*) FILTER (WHERE NOT past), 0) AS new_customers, nullif(count(*) FILTER (WHERE past), 0) AS repeat_customers,
  count(*) AS total_customers, """
    + ", ".join(
        f"sum({col}) FILTER (WHERE {'NOT ' if k == 'new' else ''}past) AS {k}_{n}"
        for n, col in (("value", "profit"), ("tickets", "tickets"), ("discount", "discount"))
        for k in ("new", "repeat")
    )
    + """, sum(profit) AS total_value, sum(tickets) AS total_tickets, sum(discount) AS total_discount
FROM (SELECT b.*, EXISTS (SELECT 1 FROM okf p WHERE p."customerID" = b."customerID" AND p."creationDate" < x.start) AS past
  FROM (SELECT "eventID", "customerID", sum("totalTickets") AS tickets, sum(gross - dval) AS profit, sum(dval) AS discount
    FROM okf GROUP BY ALL) b
  JOIN (SELECT "eventID", min("creationDate") AS start FROM fact GROUP BY ALL) x ON b."eventID" = x."eventID") GROUP BY ALL)""",
)
def new_vs_repeat(t: Tables) -> DataFrame:
    contexts = c.customer_contexts(t.fact(), ["eventID"], _AMOUNTS)
    shares = c.new_vs_repeat(c.cohort_summary(contexts, ["eventID"]))
    keep = [x for x in shares.columns if x.endswith(("_share", "_sign"))]
    return shares.select("eventID", *keep)


@query(
    "H10_metric_by_gender",
    f"""SELECT "eventID", female, male, total, {div("female", "greatest(female, total)")} AS female_share,
  {div("male", "greatest(male, total)")} AS male_share
FROM (SELECT "eventID", CAST(sum("totalTickets") FILTER (WHERE gender = 'Female') AS BIGINT) AS female,
  CAST(sum("totalTickets") FILTER (WHERE gender = 'Male') AS BIGINT) AS male, CAST(sum("totalTickets") AS BIGINT) AS total
  FROM okf LEFT JOIN cust ON "customerID" = cust.id GROUP BY 1)""",
)
def metric_by_gender(t: Tables) -> DataFrame:
    out = c.metric_by_gender(t.fact(), t.customers(), "s_tickets", ["eventID"])
    out = c.share_against(out, "female", "total", "female_share")
    return c.share_against(out, "male", "total", "male_share")


_BY_GENDER = ("complete_orders", "tickets", "revenue", "discount", "profit", "total_orders")


@query(
    "H10_measures_by_gender",
    " UNION ALL ".join(
        f"""SELECT "eventID", '{name}' AS metric, female, male, total, female / nullif(greatest(female, total), 0) AS female_share,
  male / nullif(greatest(male, total), 0) AS male_share FROM (SELECT "eventID",
  CAST(sum(v) FILTER (WHERE gender = 'Female') AS DOUBLE) AS female, CAST(sum(v) FILTER (WHERE gender = 'Male') AS DOUBLE) AS male,
  CAST(sum(v) AS DOUBLE) AS total FROM (SELECT "eventID", gender, {value} AS v FROM fact LEFT JOIN cust ON "customerID" = cust.id) GROUP BY 1)"""
        for name, value in (
            ("complete_orders", 'CASE WHEN "orderStatus" = 1 THEN 1 END'),
            ("tickets", 'CASE WHEN "orderStatus" = 1 THEN "totalTickets" END'),
            ("revenue", 'CASE WHEN "orderStatus" = 1 THEN gross END'),
            ("discount", 'CASE WHEN "orderStatus" = 1 THEN dval END'),
            ("profit", 'CASE WHEN "orderStatus" = 1 THEN gross - dval END'),
            ("total_orders", "1"),
        )
    ),
)
def measures_by_gender(t: Tables) -> DataFrame:
    """Orders, tickets, amounts and profit of women and men, from one aggregation of the fact."""
    return c.measures_by_gender(t.fact(), t.customers(), _BY_GENDER, ["eventID"])
