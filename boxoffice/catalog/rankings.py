"""S, Q and F: ranks, shares, top lists, data checks, labels."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxoffice.catalog.bindings import Tables
from boxoffice.catalog.oracle import MEASURE_SQL, OK, PROFIT, dbl, div, measures
from boxoffice.catalog.register import query
from boxoffice.functions.labels import compact_number, percent, share_label, trend_label
from boxoffice.operators import metrics as m
from boxoffice.operators import quality as q
from boxoffice.operators import ranking as r
from boxoffice.operators import timeintel as w
from boxoffice.operators.cohorts import cohort_counts, customer_contexts, first_purchases, tagged_buyers
from boxoffice.operators.joins import star_join
from boxoffice.plans import raw, schemas
from boxoffice.session import stable

_RANKED = ["complete_orders", "tickets", "discount", "profit"]


def event_kpi(t: Tables, names: list[str]) -> DataFrame:
    """Measures per event name. Orders are summed by event key before the name is joined."""
    sums = m.base_sums(t.fact(), names, ["eventID"])
    named = star_join(sums, events=t.events()).withColumnRenamed("eventName", "name")
    return m.finish(m.add_up(named, ["name"]), names)


_EV = {
    "evk": f"""SELECT name, {measures(*_RANKED)}, {MEASURE_SQL["avg_profit_per_order"]} AS avg_profit_per_order,
  {MEASURE_SQL["profit_margin"]} AS profit_margin, {PROFIT} AS dprofit FROM fact JOIN ev ON "eventID" = ev.id GROUP BY name""",
    "newc": """SELECT f."eventID", count(DISTINCT f."customerID") AS new_customers FROM okf f
  JOIN (SELECT "eventID", min("creationDate") AS s FROM fact GROUP BY 1) x ON f."eventID" = x."eventID"
  JOIN (SELECT "customerID", min("creationDate") AS d FROM okf GROUP BY 1) y ON f."customerID" = y."customerID"
  WHERE y.d >= x.s GROUP BY 1""",
    "evd": f"""SELECT ev.name AS "eventName", p_type AS distance, {MEASURE_SQL["complete_orders"]} AS complete_orders,
  {PROFIT} AS profit FROM fact f JOIN ev ON "eventID" = ev.id JOIN part ON "ticketID" = p_partkey GROUP BY ALL""",
}


@query(
    "S01_rank_events",
    " UNION ALL ".join(
        f"SELECT '{n}' AS metric, name, {dbl(n)} AS value, dense_rank() OVER (ORDER BY {n} DESC NULLS LAST, name) AS rank FROM evk"
        for n in _RANKED
    ),
    **_EV,
)
def rank_events(t: Tables) -> DataFrame:
    return r.rank_metrics(event_kpi(t, _RANKED), _RANKED, "name")


@query(
    "S01_rank_events_by_new_customers",
    """SELECT name, new_customers, dense_rank() OVER (ORDER BY new_customers DESC NULLS LAST, name) AS rank
FROM (SELECT DISTINCT name FROM ev) LEFT JOIN newn USING (name)""",
    **_EV,
    nfact='SELECT name, fact.* FROM fact JOIN ev ON ev.id = "eventID"',
    newn="""SELECT name, count(DISTINCT "customerID") AS new_customers FROM nfact
  JOIN (SELECT name, min("creationDate") AS s FROM nfact GROUP BY 1) USING (name)
  JOIN (SELECT "customerID", min("creationDate") AS d FROM okf GROUP BY 1) USING ("customerID")
  WHERE "orderStatus" = 1 AND d >= s GROUP BY 1""",
)
def rank_events_by_new_customers(t: Tables) -> DataFrame:
    """All event names; those that won no customer come last.

    Events of one name are one context, so a customer of two of them counts once.
    """
    contexts = customer_contexts(t.fact(), ["eventID"], ())
    named = star_join(contexts, events=t.events()).withColumnRenamed("eventName", "name")
    dates = ("first_order", "first_bought")
    by_name = named.groupBy("name", "customerID").agg(*[F.min(d).alias(d) for d in dates])
    tagged = tagged_buyers(by_name, ["name"], first_ever=first_purchases(contexts))
    won = tagged.groupBy("name").agg(F.sum(F.when(F.col("is_new"), F.col("buyers"))).alias("new_customers"))
    names = t.events().select("name").distinct()
    return r.rank_by(stable(names.join(won, "name", "left")), "new_customers", "name")


def event_distance_sums(t: Tables, *names: str) -> tuple[DataFrame, list[str]]:
    """Base sums by event name and distance, summed by the keys before the names are joined.

    Both levels of the hierarchy use them, so they are written once.
    """
    wanted = [*names, "complete_orders"]
    sums = m.base_sums(t.fact(), wanted, ["eventID", "ticketID"])
    named = star_join(sums, events=t.events(), tickets=t.tickets())
    return stable(m.add_up(named, ["eventName", "distance"])), m.needed_sums(wanted)


@query(
    "S02_hierarchical_rank",
    """SELECT "eventName", NULL AS distance, CAST(profit AS DOUBLE) AS profit,
  dense_rank() OVER (ORDER BY profit DESC NULLS LAST, "eventName") AS rank FROM
  (SELECT "eventName", sum(profit) AS profit FROM evd GROUP BY 1)
UNION ALL SELECT "eventName", distance, CAST(profit AS DOUBLE),
  dense_rank() OVER (PARTITION BY "eventName" ORDER BY profit DESC NULLS LAST, distance) FROM evd""",
    **_EV,
)
def hierarchical_rank(t: Tables) -> DataFrame:
    inner, sums = event_distance_sums(t, "profit")
    return r.hierarchical_rank(inner, sums, "profit")


_BOTH_LEVELS = ["profit", "complete_orders"]


@query(
    "S02_hierarchical_ranks",
    " UNION ALL ".join(
        f"""SELECT '{n}' AS metric, 0 AS level, "eventName", NULL AS distance, {dbl(n)} AS value,
  dense_rank() OVER (ORDER BY {n} DESC NULLS LAST, "eventName") AS rank FROM
  (SELECT "eventName", sum({n}) AS {n} FROM evd GROUP BY 1)
UNION ALL SELECT '{n}', 1, "eventName", distance, {dbl(n)},
  dense_rank() OVER (PARTITION BY "eventName" ORDER BY {n} DESC NULLS LAST, distance) FROM evd"""
        for n in _BOTH_LEVELS
    ),
    **_EV,
)
def hierarchical_ranks(t: Tables) -> DataFrame:
    inner, sums = event_distance_sums(t, *_BOTH_LEVELS)
    return r.hierarchical_ranks(inner, sums, _BOTH_LEVELS)


@query(
    "S03_share_of_total",
    f"""SELECT "eventName", NULL AS distance, CAST(profit AS DOUBLE) AS profit,
  CASE WHEN complete_orders IS NOT NULL THEN {div("profit", "sum(profit) OVER ()", "0")} END AS share FROM
  (SELECT "eventName", sum(profit) AS profit, sum(complete_orders) AS complete_orders FROM evd GROUP BY 1)
UNION ALL SELECT "eventName", distance, CAST(profit AS DOUBLE),
  CASE WHEN complete_orders IS NOT NULL THEN {div("profit", 'sum(profit) OVER (PARTITION BY "eventName")', "0")} END FROM evd""",
    **_EV,
)
def share_of_total(t: Tables) -> DataFrame:
    inner, sums = event_distance_sums(t, "profit")
    return r.hierarchical_share(inner, sums, "profit")


@query(
    "S04_share_by_payment",
    f"""SELECT "eventID", "paymentMethod", CAST(profit AS DOUBLE) AS profit,
  {div("profit", 'sum(profit) OVER (PARTITION BY "eventID")')} AS share
FROM (SELECT "eventID", "paymentMethod", {PROFIT} AS profit FROM fact GROUP BY ALL)""",
)
def share_by_payment(t: Tables) -> DataFrame:
    per_payment = m.kpi(t.fact(), ["profit"], ["eventID", "paymentMethod"])
    return r.share(per_payment, "profit", ["eventID"])


@query(
    "S05_share_by_gender",
    f"""SELECT "paymentMethod", gender, tickets, {div("tickets", 'sum(tickets) OVER (PARTITION BY "paymentMethod")')} AS share
FROM (SELECT "paymentMethod", gender, CAST(sum("totalTickets") AS BIGINT) AS tickets FROM okf LEFT JOIN cust ON "customerID" = cust.id GROUP BY ALL)""",
)
def share_by_gender(t: Tables) -> DataFrame:
    sums = m.base_sums(t.fact(), ["tickets"], ["paymentMethod", "customerID"])
    named = star_join(sums, customers=t.customers())
    per_gender = m.finish(m.add_up(named, ["paymentMethod", "gender"]), ["tickets"])
    return r.share(per_gender, "tickets", ["paymentMethod"])


@query(
    "S06_topn_events",
    """SELECT "eventID", name, new_customers FROM (SELECT "eventID", name, new_customers,
  rank() OVER (ORDER BY new_customers DESC) AS rk FROM newc JOIN ev ON "eventID" = id) WHERE rk <= 5""",
    **_EV,
)
def topn_events(t: Tables) -> DataFrame:
    """The stored query: five events with the most new customers, ties kept."""
    contexts = customer_contexts(t.fact(), ["eventID"], ())
    counts = cohort_counts(contexts, ["eventID"]).select("eventID", "new_customers")
    best = r.top_n(stable(counts), "new_customers", 5)
    return star_join(best, events=t.events()).select(
        "eventID", F.col("eventName").alias("name"), "new_customers"
    )


@query(
    "S07_median_across_events",
    "SELECT median(CAST(profit AS DOUBLE)) AS median_profit FROM evk WHERE profit IS NOT NULL",
    **_EV,
)
def median_across_events(t: Tables) -> DataFrame:
    return r.median_of(stable(event_kpi(t, ["profit"]).select("profit")), "profit")


@query(
    "S07_median_of_customers",
    f"""SELECT median(CAST(profit AS DOUBLE)) AS median_profit FROM
(SELECT "customerID", {PROFIT} AS profit FROM fact GROUP BY 1) WHERE profit IS NOT NULL""",
)
def median_of_customers(t: Tables) -> DataFrame:
    """The median over a list that grows with the table."""
    return r.median_of(stable(m.kpi(t.fact(), ["profit"], ["customerID"]).select("profit")), "profit")


@query(
    "S08_above_average_flag",
    """SELECT name, avg_profit_per_order, round(avg(avg_profit_per_order) OVER (), 6) AS average,
  CASE WHEN round(avg_profit_per_order, 0) >= round(avg(avg_profit_per_order) OVER (), 0) THEN 1 ELSE 0 END AS above_average FROM evk""",
    **_EV,
)
def above_average(t: Tables) -> DataFrame:
    flagged = r.above_average(event_kpi(t, ["avg_profit_per_order"]), "avg_profit_per_order")
    return flagged.withColumn("average", F.round("average", 6))


@query(
    "S09_margin_band",
    f"""SELECT "customerID", profit_margin, CASE WHEN profit_margin >= 0.8 THEN '>= 80%' WHEN profit_margin >= 0.6 THEN '60% - 69%' WHEN profit_margin < 0.6 THEN '< 60%' END AS segment
FROM (SELECT "customerID", {measures("profit_margin")} FROM fact GROUP BY 1)""",
)
def margin_band(t: Tables) -> DataFrame:
    per_customer = m.kpi(t.fact(), ["profit_margin"], ["customerID"])
    return per_customer.withColumn("segment", r.margin_band(F.col("profit_margin")))


@query(
    "S10_is_group_max",
    """SELECT "eventID", "paymentMethod", CAST(profit AS DOUBLE) AS profit,
  CASE WHEN profit = max(profit) OVER (PARTITION BY "eventID") THEN 1 ELSE 0 END AS is_max
FROM (SELECT "eventID", "paymentMethod", sum(gross - dval) FILTER (WHERE "orderStatus" = 1) AS profit FROM fact GROUP BY ALL)""",
)
def is_group_max(t: Tables) -> DataFrame:
    per_payment = m.kpi(t.fact(), ["profit"], ["eventID", "paymentMethod"])
    return r.is_group_max(per_payment, "profit", ["eventID"])


@query(
    "S10_age_group_peaks",
    """SELECT "eventID", "ageGroup", CAST(profit AS DOUBLE) AS profit, tickets,
  CASE WHEN profit = max(profit) OVER (PARTITION BY "eventID") THEN 1 ELSE 0 END AS is_max_profit,
  CASE WHEN tickets = max(tickets) OVER (PARTITION BY "eventID") THEN 1 ELSE 0 END AS is_max_tickets
FROM (SELECT "eventID", "ageGroup", sum(gross - dval) FILTER (WHERE "orderStatus" = 1) AS profit,
  CAST(sum("totalTickets") FILTER (WHERE "orderStatus" = 1) AS BIGINT) AS tickets
  FROM fact JOIN cust ON "customerID" = cust.id GROUP BY ALL)""",
)
def age_group_peaks(t: Tables) -> DataFrame:
    """The age group that leads its event, by profit and by tickets."""
    sums = m.base_sums(t.fact(), ["profit", "tickets"], ["eventID", "customerID"])
    ages = t.customers().select(F.col("id").alias("customerID"), "ageGroup")
    per_group = m.finish(m.add_up(sums.join(ages, "customerID"), ["eventID", "ageGroup"]), ["profit", "tickets"])
    return r.are_group_max(stable(per_group), ["profit", "tickets"], ["eventID"])


@query(
    "S11_ordered_string_agg",
    """SELECT "eventID", count(*) AS months, string_agg(strftime(mon, '%B %Y'), ', ' ORDER BY mon DESC) FILTER (WHERE rn <= 2) AS latest
FROM (SELECT *, row_number() OVER (PARTITION BY "eventID" ORDER BY mon DESC) AS rn FROM
  (SELECT DISTINCT "eventID", CAST(date_trunc('month', "creationDate") AS DATE) AS mon FROM fact)) GROUP BY 1""",
)
def latest_months(t: Tables) -> DataFrame:
    return r.latest_months(t.fact(), ["eventID"])


@query(
    "S12_sparkline_points",
    """SELECT "paymentMethod", string_agg(x || ',' || (40 - coalesce(y, 0)), ' ' ORDER BY date) AS points FROM
(SELECT s."paymentMethod", date, CAST(floor(120 * (CAST(date - d0 AS DOUBLE) / CAST(d1 - d0 AS DOUBLE))) AS BIGINT) AS x,
  CAST(floor(40 * (CAST(v - v0 AS DOUBLE) / CAST(v1 - v0 AS DOUBLE))) AS BIGINT) AS y
  FROM ser s JOIN (SELECT "paymentMethod", min(date) AS d0, max(date) AS d1, min(v) AS v0, max(v) AS v1 FROM ser GROUP BY 1) e
  ON s."paymentMethod" = e."paymentMethod") GROUP BY 1""",
    ser=f"""SELECT "paymentMethod", "purchaseDate" AS date, {dbl(PROFIT)} AS v FROM fact GROUP BY ALL""",
)
def sparkline(t: Tables) -> DataFrame:
    dated = t.fact().withColumn("date", F.col("purchaseDate"))
    series = m.kpi(dated, ["profit"], ["paymentMethod", "date"])
    return r.sparkline_points(series, "profit", ["paymentMethod"])


@query(
    "S13_target_progress",
    f"""SELECT "eventID", tickets, target, {div("tickets", "greatest(tickets, target)")} AS actual_fill,
  {div("target", "greatest(tickets, target)")} AS target_mark
FROM (SELECT "eventID", CAST(sum("totalTickets") FILTER (WHERE {OK}) AS BIGINT) AS tickets FROM fact GROUP BY 1) JOIN ev ON "eventID" = id""",
)
def target_progress(t: Tables) -> DataFrame:
    targets = t.events().select(F.col("id").alias("eventID"), "target")
    sold = m.kpi(t.fact(), ["tickets"], ["eventID"]).join(targets, "eventID")
    return r.target_progress(sold, "tickets", "target")


@query(
    "S14_sort",
    """SELECT o_orderkey AS id, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, o_custkey AS customer FROM orders
ORDER BY o_orderdate DESC, o_custkey DESC, o_orderkey""",
)
def sort(t: Tables) -> DataFrame:
    rows = t.read("orders").select(
        F.col("o_orderkey").alias("id"),
        F.to_date("o_orderdate").alias("day"),
        F.col("o_custkey").alias("customer"),
    )
    return rows.orderBy(F.col("day").desc(), F.col("customer").desc(), "id")


def _buyers(t: Tables, lo: int, hi: int) -> DataFrame:
    """Buyers of a stretch of days; 0 begins with the first order."""
    return t.fact().where(m.is_ok() & F.col("creationDateID").between(lo, hi)).select("customerID")


def _set_sql(op: str) -> str:
    part = 'SELECT "customerID" FROM okf WHERE "creationDateID" BETWEEN {} AND {}'
    return f"{part.format(19990101, 19990331)} {op} {part.format(0, 19981231)}"


@query("S15_union_distinct", _set_sql("UNION"))
def union_distinct(t: Tables) -> DataFrame:
    return _buyers(t, 19990101, 19990331).union(_buyers(t, 0, 19981231)).distinct()


@query("S16_intersect", _set_sql("INTERSECT"))
def intersect(t: Tables) -> DataFrame:
    return _buyers(t, 19990101, 19990331).intersect(_buyers(t, 0, 19981231))


@query("S17_except", _set_sql("EXCEPT"))
def except_(t: Tables) -> DataFrame:
    return _buyers(t, 19990101, 19990331).subtract(_buyers(t, 0, 19981231))


@query(
    "Q01_not_null_check",
    """SELECT 'stg_orders.order_id' AS "check", count(*) AS failures FROM stg_orders WHERE order_id IS NULL
UNION ALL SELECT 'stg_orders.date_id', count(*) FROM stg_orders WHERE date_id IS NULL
UNION ALL SELECT 'stg_events.id', count(*) FROM stg_events WHERE id IS NULL
UNION ALL SELECT 'stg_events.start_date', count(*) FROM stg_events WHERE start_date IS NULL""",
)
def not_null_check(t: Tables) -> DataFrame:
    """The two declared checks, and two on columns that do hold nulls."""
    tables = {"stg_orders": t.stg_orders(), "stg_events": t.stg_events()}
    checks = [("stg_orders", "order_id"), ("stg_orders", "date_id"), ("stg_events", "id"), ("stg_events", "start_date")]
    parts = [q.failures(f"{n}.{c}", q.null_rows(tables[n], c)) for n, c in checks]
    return reduce(DataFrame.unionByName, parts)


_DUP = "SELECT '{0}.{1}' AS \"check\", count(*) AS failures FROM (SELECT {1} FROM {0} WHERE {1} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)"


@query(
    "Q02_unique_check",
    " UNION ALL ".join(
        [
            _DUP.format("stg_customers", "id"),
            _DUP.format("order_items", "id"),
            _DUP.format("stg_organizers", "id"),
        ]
    ),
)
def unique_check(t: Tables) -> DataFrame:
    """The two declared checks, and one on a column with repeated values."""
    organizers = raw.raw_organizers(t.dump_order_events()).withColumnRenamed("merchant_id", "id")
    parts = [
        q.failures(f"{name}.id", q.duplicates(df, "id"))
        for name, df in (
            ("stg_customers", t.stg_customers()),
            ("order_items", t.order_items()),
            ("stg_organizers", organizers),
        )
    ]
    return reduce(DataFrame.unionByName, parts)


@query(
    "Q03_schema_check",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", 1 AS present, count(*) FILTER (WHERE {c} IS NULL) AS nulls FROM sale_orders"
        for c in schemas.SALE_ORDERS.fieldNames()
        if c != "order_type"
    )
    + " UNION ALL SELECT 'order_type', 0, count(*) FROM sale_orders",
)
def schema_check(t: Tables) -> DataFrame:
    """Sale orders against their declared schema, after one column got lost."""
    return q.schema_report(t.sale_orders().drop("order_type"), schemas.SALE_ORDERS)


def _kpi_label(v: str) -> str:
    def scaled(unit: int, keep: int, digits: int, mark: str) -> str:
        number = f"printf('%.{digits}f', CAST(round({v}, {keep}) AS DOUBLE) / {unit})"
        return f"regexp_replace({number}, '^0\\.', '.') || '{mark}'"

    return (
        f"'$' || CASE WHEN {v} < 1000000 THEN {scaled(1000, -2, 1, 'K')} "
        f"WHEN {v} < 1000000000 THEN {scaled(1000000, -4, 2, 'M')} ELSE {scaled(10**9, -7, 2, 'B')} END"
    )


_COUNT = "CASE WHEN round({v}, 0) = 0 THEN '' ELSE format('{{:,}}', CAST(round({v}, 0) AS BIGINT)) END"


@query(
    "F01_compact_number",
    f"""SELECT "eventID", {_kpi_label("p")} AS kpi_label, {_kpi_label("small")} AS small_label,
  {_COUNT.format(v="t")} AS count_label, '$' || {_COUNT.format(v="small")} AS money_label, printf('%.0f', round(share * 100, 0)) || '%' AS share_label
FROM (SELECT "eventID", p, CAST(p / 1000 AS DECIMAL(28,4)) AS small, t, CAST(CAST(p AS DOUBLE) / CAST(sum(p) OVER () AS DOUBLE) AS DECIMAL(28,10)) AS share
  FROM (SELECT "eventID", CAST({PROFIT} AS DECIMAL(28,4)) AS p, CAST(sum("totalTickets") FILTER (WHERE {OK}) AS DECIMAL(28,4)) AS t FROM fact GROUP BY 1))""",
)
def compact_numbers(t: Tables) -> DataFrame:
    per_event = r.share(m.kpi(t.fact(), ["profit", "tickets"], ["eventID"]), "profit", empty=0)
    small = (F.col("profit").cast("double") / 1000).cast("decimal(28,4)")
    return per_event.select(
        "eventID",
        compact_number(F.col("profit"), "kpi").alias("kpi_label"),
        compact_number(small, "kpi").alias("small_label"),
        compact_number(F.col("tickets"), "count").alias("count_label"),
        compact_number(small, "money").alias("money_label"),
        percent(F.col("share")).alias("share_label"),
    )


@query(
    "F02_trend_label",
    f"""SELECT CAST(date AS VARCHAR) AS date, CASE WHEN pct > 0 THEN '▲ ' || pl || ' (' || cl || ')' WHEN pct = 0 THEN '—'
  WHEN pct < 0 THEN '▼ ' || pl || ' (' || cl || ')' END AS label FROM
(SELECT date, pct, printf('%.0f', round(CAST(abs(pct) AS DECIMAL(28,10)) * 100, 0)) || '%' AS pl, {_kpi_label("a")} AS cl
  FROM (SELECT c.date, CAST(abs(CAST(coalesce(c.v, 0) - coalesce(p.v, 0) AS DECIMAL(28,4))) AS DECIMAL(28,4)) AS a,
    CASE WHEN p.v IS NULL OR p.v = 0 THEN 0 ELSE (coalesce(c.v, 0) - p.v) / p.v END AS pct
    FROM (SELECT d AS date, v FROM cal LEFT JOIN dv ON dv.date = d) c LEFT JOIN dv p ON p.date = c.date - 1 WHERE c.v IS NOT NULL OR p.v IS NOT NULL))""",
    dv=f"""SELECT "creationDate" AS date, {dbl(PROFIT)} AS v FROM fact GROUP BY 1""",
)
def trend_labels(t: Tables) -> DataFrame:
    dated = t.fact().withColumn("date", F.col("creationDate"))
    daily = m.kpi(dated, ["profit"], ["date"]).withColumn("v", F.col("profit").cast("double"))
    moved = w.shift_days(stable(daily.select("date", "v")), t.calendar(), ["v"], "day", -1, "previous_")
    moved = w.compare(moved, "v", "previous_v")
    size = F.abs(F.col("change").cast("decimal(28,4)"))
    return moved.select("date", trend_label(F.col("pct"), compact_number(size, "kpi")).alias("label"))


@query(
    "F01_share_labels",
    f"""SELECT "eventID", "paymentMethod", '$' || CASE WHEN p < 1000 THEN printf('%.0f', CAST(round(p, 0) AS DOUBLE))
  WHEN p < 1000000 THEN printf('%.0f', CAST(round(p, -3) AS DOUBLE) / 1000) || 'K'
  WHEN p < 1000000000 THEN printf('%.2f', CAST(round(p, -4) AS DOUBLE) / 1000000) || 'M'
  ELSE printf('%.2f', CAST(round(p, -7) AS DOUBLE) / 1000000000) || 'B' END
  || ' | ' || printf('%.0f', CAST(round(CAST(share AS DECIMAL(28,10)) * 100, 0) AS DOUBLE)) || '%' AS label
FROM (SELECT "eventID", "paymentMethod", CAST(profit AS DECIMAL(28,4)) AS p,
  {div("profit", 'sum(profit) OVER (PARTITION BY "eventID")')} AS share
  FROM (SELECT "eventID", "paymentMethod", {PROFIT} AS profit FROM fact GROUP BY ALL))""",
)
def share_labels(t: Tables) -> DataFrame:
    """Profit by payment method with its share, as shown next to the bars."""
    shares = share_by_payment(t)
    label = share_label(F.col("profit"), F.col("share"), money=True)
    return shares.select("eventID", "paymentMethod", label.alias("label"))


@query(
    "S09_scatter_segments",
    f"""SELECT name, CASE WHEN profit_margin >= 0.8 THEN 1 WHEN profit_margin >= 0.6 THEN 2 ELSE 3 END AS margin_segment,
  CASE WHEN round(avg_profit_per_order, 0) >= round(avg(avg_profit_per_order) OVER (), 0) THEN 4 ELSE 5 END AS value_segment FROM evk""",
    **_EV,
)
def scatter_segments(t: Tables) -> DataFrame:
    """The legend entry of each event in both colour modes of the scatter chart."""
    per_event = event_kpi(t, ["profit_margin", "avg_profit_per_order"])
    flagged = r.above_average(per_event, "avg_profit_per_order")
    return flagged.select("name", *r.scatter_segments(F.col("profit_margin"), F.col("above_average")))
