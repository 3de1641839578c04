"""K and D: measures, their selection and their long form."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxoffice.catalog.bindings import Tables
from boxoffice.catalog.oracle import MEASURE_SQL, dbl, div, measures
from boxoffice.catalog.register import query
from boxoffice.functions.dates import month_index
from boxoffice.operators import metrics as m
from boxoffice.operators.distinct import kpi_levels
from boxoffice.operators.joins import lookup_date
from boxoffice.operators.timeintel import previous_month
from boxoffice.session import stable
from boxoffice.sources import parameters

# Key, measures and grouping of the plain measures.
PLAIN = [
    ("K01_total_orders", ["total_orders"], ["eventID"]),
    ("K02_complete_orders", ["complete_orders"], ["eventID", "paymentMethod"]),
    ("K03_completion_rate", ["completion_rate"], ["customerID"]),
    ("K04_tickets", ["tickets"], ["ticketID"]),
    ("K05_revenue", ["revenue"], ["eventID"]),
    ("K06_discount", ["discount"], ["eventID"]),
    ("K07_profit", ["profit"], ["eventID", "paymentMethod"]),
    ("K08_profit_margin", ["profit_margin"], ["customerID"]),
    ("K09_avg_tickets_per_order", ["avg_tickets_per_order"], ["customerID"]),
    ("K10_avg_revenue_per_order", ["avg_revenue_per_order"], ["customerID"]),
    ("K11_avg_profit_per_order", ["avg_profit_per_order"], ["customerID"]),
    (
        "K12_avg_discount_value_per_order",
        ["avg_discount_value_per_order", "avg_discount_value"],
        ["customerID"],
    ),
    ("K13_avg_discount_pct", ["avg_discount_pct"], ["customerID"]),
    ("K14_avg_profit_per_ticket", ["avg_profit_per_ticket"], ["customerID"]),
    ("K15_total_customers", ["total_customers"], ["eventID"]),
    ("K16_avg_orders_per_customer", ["avg_orders_per_customer"], ["eventID"]),
    ("K20_events_with_sales", ["events_with_sales"], ["creationDateID"]),
    ("kpi_bundle", list(MEASURE_SQL), ["paymentMethod"]),
    ("kpi_totals", list(MEASURE_SQL), []),
]


def _register(key: str, names: list[str], by: list[str]) -> None:
    groups = "".join(f'"{g}", ' for g in by)
    sql = f"SELECT {groups}{measures(*names)} FROM fact" + (" GROUP BY ALL" if by else "")
    query(key, sql)(lambda t: m.kpi(t.fact(), names, by))


for _key, _names, _by in PLAIN:
    _register(_key, _names, _by)


@query(
    "K17_pct_of_target",
    f"""SELECT "eventID", tickets, target, {div("tickets", "target")} AS pct_of_target FROM
(SELECT "eventID", CAST(sum("totalTickets") FILTER (WHERE "orderStatus" = 1) AS BIGINT) AS tickets FROM fact
  WHERE "creationDateID" <= (SELECT max("purchaseDateID") FROM fact) GROUP BY 1) LEFT JOIN ev ON "eventID" = id""",
)
def pct_of_target(t: Tables) -> DataFrame:
    return m.pct_of_target(t.fact(), t.events())


@query(
    "K18_sales_date_bounds",
    """SELECT "paymentMethod", min("creationDateID") AS "first_creationDateID", max("creationDateID") AS "last_creationDateID",
  min("purchaseDateID") AS "first_purchaseDateID", max("purchaseDateID") AS "last_purchaseDateID" FROM fact GROUP BY 1""",
)
def date_bounds(t: Tables) -> DataFrame:
    return m.sales_date_bounds(t.fact(), ["paymentMethod"])


@query(
    "K19_event_ticket_total",
    """SELECT id, name, tickets FROM ev LEFT JOIN (SELECT "eventID", CAST(sum("totalTickets") AS BIGINT) AS tickets
FROM okf GROUP BY 1) ON id = "eventID" """,
)
def event_tickets(t: Tables) -> DataFrame:
    return m.event_ticket_total(t.events().select("id", "name"), t.fact())


@query(
    "K21_buyers_by_gender",
    """SELECT "eventID", gender, count(DISTINCT "customerID") AS buyers FROM okf JOIN cust ON "customerID" = cust.id GROUP BY ALL""",
)
def buyers_by_gender(t: Tables) -> DataFrame:
    return m.buyers_by_gender(t.fact(), t.customers(), ["eventID"])


@query(
    "K23_months_selected",
    """SELECT "customerID", count(DISTINCT strftime("creationDate", '%Y%m')) AS months FROM fact GROUP BY 1""",
)
def months_selected(t: Tables) -> DataFrame:
    return m.months_selected(t.fact(), ["customerID"])


_LEVELS = [["eventID", "paymentMethod"], ["eventID"], ["paymentMethod"], []]
_LEVEL_METRICS = ["total_customers", "avg_orders_per_customer", "events_with_sales", "tickets", "profit_margin"]


@query(
    "K15_customer_levels",
    f"""SELECT "eventID", "paymentMethod",
  CASE grouping("eventID") * 2 + grouping("paymentMethod") WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 2 ELSE 3 END AS level,
  {measures(*_LEVEL_METRICS)} FROM fact GROUP BY GROUPING SETS (("eventID", "paymentMethod"), ("eventID"), ("paymentMethod"), ())""",
)
def customer_levels(t: Tables) -> DataFrame:
    """Distinct customers and events at four levels, from bitmaps set in one pass."""
    return kpi_levels(t.fact(), _LEVEL_METRICS, _LEVELS)


@query("K24_distinct_rows", 'SELECT DISTINCT "customerID", "eventID", "paymentMethod" FROM fact')
def distinct_rows(t: Tables) -> DataFrame:
    return t.fact().select("customerID", "eventID", "paymentMethod").distinct()


_SELECTED = " UNION ALL ".join(
    f"""SELECT '{slicer}' AS slicer, {position} AS position, "eventID", {dbl(MEASURE_SQL[name])} AS value FROM fact GROUP BY "eventID" """
    for slicer, choice in (
        ("summary", m.SUMMARY_CHOICE),
        ("sales", m.SALES_CHOICE),
        ("scatter", m.SCATTER_CHOICE),
    )
    for position, name in choice.items()
)


@query("D01_metric_selector", _SELECTED)
def metric_selector(t: Tables) -> DataFrame:
    """Every choice of the three slicers, from one aggregation of the fact."""
    choices = {"summary": m.SUMMARY_CHOICE, "sales": m.SALES_CHOICE, "scatter": m.SCATTER_CHOICE}
    names = sorted({n for c in choices.values() for n in c.values()})
    wide = m.kpi(t.fact(), names, ["eventID"])
    picked = F.array(
        *[
            F.struct(
                F.lit(slicer).alias("slicer"),
                F.lit(position).alias("position"),
                F.col(m.selected(choice, position)).cast("double").alias("value"),
            )
            for slicer, choice in choices.items()
            for position in choice
        ]
    )
    return wide.select("eventID", F.explode(picked).alias("p")).select("eventID", "p.*")


def _long_sql(keys: str, rows: list[tuple], where: str = "") -> str:
    return " UNION ALL ".join(
        f"""SELECT {keys}, '{name}' AS name, '{metric}' AS metric, {position} AS position, {group} AS "group",
  {dbl(MEASURE_SQL[metric])} AS value FROM fact GROUP BY ALL"""
        for name, metric, position, group in rows
    )


@query("D02_field_parameter", _long_sql('"paymentMethod"', parameters.SUMMARY_METRICS))
def field_parameter(t: Tables) -> DataFrame:
    """All twelve entries of the summary table, as rows, from one aggregation."""
    wide = m.kpi(t.fact(), m.SUMMARY_NAMES, ["paymentMethod"])
    params = parameters.summary_metrics(t.spark)
    return m.long_metrics(wide, ["paymentMethod"], params, m.SUMMARY_NAMES)


_SALES_VALUES = [p[1] for p in parameters.SALES_METRICS if not p[1].endswith("_vs_pm")]
_SALES_BASE = [v for v in m.SALES_CHOICE.values()]


@query(
    "D02_sales_table",
    "SELECT ym, name, p.metric, position, \"group\", visible, value FROM (SELECT ym, metric, value FROM ("
    + " UNION ALL ".join(f"SELECT ym, '{n}' AS metric, {dbl(n)} AS value FROM months" for n in _SALES_VALUES)
    + " UNION ALL "
    + " UNION ALL ".join(
        f"""SELECT c.ym, '{n}_vs_pm', CASE WHEN p.{n} IS NULL OR p.{n} = 0 THEN 0
  ELSE (coalesce({dbl("c." + n)}, 0) - {dbl("p." + n)}) / {dbl("p." + n)} END FROM months c LEFT JOIN monthly p ON p.mi = c.mi - 1"""
        for n in _SALES_BASE
    )
    + ")) v JOIN (VALUES "
    + ", ".join(f"('{a}', '{b}', {c}, {d}, {e})" for a, b, c, d, e in parameters.SALES_METRICS)
    + ') p(name, metric, position, "group", visible) ON v.metric = p.metric',
    monthly=f"""SELECT year("creationDate") * 100 + month("creationDate") AS ym,
  year("creationDate") * 12 + month("creationDate") AS mi,
  {measures("complete_orders", "completion_rate", "tickets", "avg_tickets_per_order", "revenue", "avg_revenue_per_order")},
  {measures("discount", "avg_discount_value_per_order", "profit", "profit_margin")} FROM fact GROUP BY ALL""",
    months="""SELECT c.ym, c.mi, m.* EXCLUDE (ym, mi) FROM (SELECT DISTINCT year(d) * 100 + month(d) AS ym, year(d) * 12 + month(d) AS mi FROM cal) c
  LEFT JOIN monthly m ON m.mi = c.mi LEFT JOIN monthly p ON p.mi = c.mi - 1 WHERE m.complete_orders IS NOT NULL OR p.complete_orders IS NOT NULL""",
)
def sales_table(t: Tables) -> DataFrame:
    """The fifteen entries of the sales table per month, with changes on the month before."""
    fact = t.fact().withColumn("month", month_index(F.col("creationDate")))
    wide = m.kpi(fact, _SALES_VALUES, ["month"])
    wide = wide.select("month", *[F.col(c).cast("double").alias(c) for c in _SALES_VALUES])
    moved = previous_month(stable(wide), t.calendar(), _SALES_BASE)
    changes = moved.withColumnsRenamed({f"{name}_pct": f"{name}_vs_pm" for name in _SALES_BASE})
    names = [p[1] for p in parameters.SALES_METRICS]
    ym = F.floor((F.col("month") - 1) / 12) * 100 + (F.col("month") - 1) % 12 + 1
    long = m.long_metrics(changes, ["month"], parameters.sales_metrics(t.spark), names)
    return long.withColumn("ym", ym).drop("month")


@query(
    "D03_metric_parity_filter",
    _long_sql('"paymentMethod"', [p for p in parameters.SUMMARY_METRICS if p[2] % 2 == 0]),
)
def metric_parity(t: Tables) -> DataFrame:
    params = m.even_positions(parameters.summary_metrics(t.spark))
    names = [p[1] for p in parameters.SUMMARY_METRICS if p[2] % 2 == 0]
    wide = m.kpi(t.fact(), names, ["paymentMethod"])
    return m.long_metrics(wide, ["paymentMethod"], params, names)


@query(
    "D04_event_status_label",
    f"""SELECT "eventID", "paymentMethod", complete_orders, CASE WHEN complete_orders IS NOT NULL THEN
  CASE WHEN "isOpening" = 0 THEN '⬤ Closed' ELSE '⬤ Opening' END END AS status
FROM (SELECT "eventID", "paymentMethod", {measures("complete_orders")} FROM fact GROUP BY ALL) LEFT JOIN ev ON "eventID" = id""",
)
def event_status(t: Tables) -> DataFrame:
    per_event = m.kpi(t.fact(), ["complete_orders"], ["eventID", "paymentMethod"])
    return m.event_status(per_event, t.events(), "complete_orders")


@query(
    "J10_last_sale_by_payment",
    """SELECT "paymentMethod", CAST(max("purchaseDate") AS VARCHAR) AS last_sale FROM fact GROUP BY 1""",
)
def last_sale(t: Tables) -> DataFrame:
    bounds = m.sales_date_bounds(t.fact(), ["paymentMethod"])
    return lookup_date(bounds, "last_purchaseDateID", "last_sale").select("paymentMethod", "last_sale")


