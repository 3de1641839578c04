"""W: period comparisons, running totals, moving averages, markers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxoffice.catalog.bindings import Tables
from boxoffice.catalog.cohorts import with_ym
from boxoffice.catalog.oracle import MEASURE_SQL, OK, dbl, div, measures
from boxoffice.catalog.register import query
from boxoffice.functions.dates import month_index
from boxoffice.functions.labels import SINCE, overall_label
from boxoffice.functions.numbers import divide
from boxoffice.operators import cohorts as c
from boxoffice.operators import metrics as m
from boxoffice.operators import timeintel as w
from boxoffice.operators.joins import star_join
from boxoffice.session import stable
from boxoffice.sources.parameters import MOVING_DAYS, MOVING_MONTHS

# The eight figures on the cards of the report.
CARD = [
    "profit",
    "tickets",
    "complete_orders",
    "profit_margin",
    "avg_tickets_per_order",
    "completion_rate",
    "new_customers",
    "avg_new_customers_value",
]
_FROM_SUMS = CARD[:6]


def daily(t: Tables, names: list[str], by: tuple[str, ...] = ()) -> DataFrame:
    dated = t.fact().withColumn("date", F.col("creationDate"))
    return m.kpi(dated, names, [*by, "date"])


def daily_card(t: Tables) -> DataFrame:
    """The card figures per day.

    The frame has one row per day and is written, because every comparison uses it twice.
    """
    wide = daily(t, _FROM_SUMS).join(c.new_customers_by_day(t.fact()), "date", "left")
    worth = divide(F.col("total_new_customers_value"), F.col("new_customers"), 0)
    known = F.coalesce("complete_orders", "new_customers", "starters").isNotNull()
    wide = wide.withColumn("avg_new_customers_value", F.when(known, worth))
    return stable(wide.select("date", *CARD))


_DAILY = {
    "daily": f"""SELECT "creationDate" AS date, count(*) AS n_rows,
  {measures("complete_orders", "tickets", "revenue", "discount", "profit", "profit_margin", "avg_tickets_per_order", "completion_rate")}
FROM fact GROUP BY 1""",
    "first_ok": 'SELECT "customerID", min("creationDate") AS d FROM okf GROUP BY 1',
    "first_any": 'SELECT "customerID", min("creationDate") AS d FROM fact GROUP BY 1',
    "card": f"""SELECT d.*, new_customers, CASE WHEN n.date IS NULL AND v.date IS NULL THEN NULL
    ELSE {div("v.v", "new_customers", "0")} END AS avg_new_customers_value FROM daily d
  LEFT JOIN (SELECT "creationDate" AS date, nullif(count(DISTINCT okf."customerID") FILTER (WHERE first_ok.d = "creationDate"), 0) AS new_customers
    FROM okf JOIN first_ok ON okf."customerID" = first_ok."customerID" GROUP BY 1) n ON d.date = n.date
  LEFT JOIN (SELECT "creationDate" AS date, sum(gross - dval) FILTER (WHERE {OK}) AS v FROM fact
    JOIN first_any ON fact."customerID" = first_any."customerID" AND first_any.d = "creationDate" GROUP BY 1) v ON d.date = v.date""",
}


def _previous_sql(step: str) -> str:
    columns = ", ".join(f"p.{name} AS previous_{name}" for name in CARD)
    known = " OR ".join(f"{side}.{name} IS NOT NULL" for name in CARD for side in ("c", "p"))
    return f"""SELECT CAST(d AS VARCHAR) AS date, {columns} FROM cal LEFT JOIN card c ON c.date = d
LEFT JOIN card p ON p.date = CAST(d - INTERVAL 1 {step} AS DATE) WHERE {known}"""


def _previous(t: Tables, unit: str) -> DataFrame:
    moved = w.shift_days(daily_card(t), t.calendar(), CARD, unit, -1, "previous_")
    return moved.select("date", *[f"previous_{name}" for name in CARD])


@query("W01_previous_day", _previous_sql("DAY"), **_DAILY)
def previous_day(t: Tables) -> DataFrame:
    return _previous(t, "day")


@query("W02_previous_year", _previous_sql("YEAR"), **_DAILY)
def previous_year(t: Tables) -> DataFrame:
    return _previous(t, "year")


_SHIFTED = ["complete_orders", "tickets", "revenue", "discount", "profit", "profit_margin", "completion_rate"]


def _moved_sql(step: str) -> str:
    return f"""SELECT ym, {measures(*_SHIFTED)} FROM fact JOIN (SELECT DISTINCT CAST(strftime(d, '%Y%m') AS INTEGER) AS ym,
  CAST(d - INTERVAL 1 {step} AS DATE) AS d FROM cal WHERE CAST(d - INTERVAL 1 {step} AS DATE) IN (SELECT d FROM cal)) b
ON "creationDate" = b.d GROUP BY ym"""


def _moved(t: Tables, unit: str) -> DataFrame:
    dated = t.fact().withColumn("date", F.col("creationDate"))
    sums = m.base_sums(dated, _SHIFTED, ["date"])
    days = t.calendar().withColumn("ym", F.col("yearMonthInt").cast("int"))
    return w.shift_period(sums, days, ["ym"], _SHIFTED, unit, -1)


@query("W02_previous_year_by_month", _moved_sql("YEAR"))
def previous_year_by_month(t: Tables) -> DataFrame:
    return _moved(t, "year")


@query("W03_previous_month_shift", _moved_sql("MONTH"))
def previous_month_shift(t: Tables) -> DataFrame:
    return _moved(t, "month")


@query(
    "W04_mom_change",
    f"""SELECT "eventID", month, c.profit, p.profit AS profit_previous,
  CASE WHEN c.profit IS NOT NULL OR p.profit IS NOT NULL THEN coalesce(c.profit, 0) - coalesce(p.profit, 0) END AS profit_change,
  {div("(coalesce(c.profit, 0) - p.profit)", "p.profit", "0")} AS profit_pct,
  CAST(sign(coalesce(c.profit, 0) - coalesce(p.profit, 0)) AS INTEGER) AS profit_sign
FROM (SELECT DISTINCT "eventID" FROM fact) CROSS JOIN (SELECT DISTINCT CAST(year(d) * 12 + month(d) AS INTEGER) AS month FROM cal) a
LEFT JOIN monthly c USING ("eventID", month) LEFT JOIN (SELECT "eventID", month + 1 AS month, profit FROM monthly) p USING ("eventID", month)
WHERE c.profit IS NOT NULL OR p.profit IS NOT NULL""",
    monthly=f"""SELECT "eventID", CAST(year("creationDate") * 12 + month("creationDate") AS INTEGER) AS month, {dbl(MEASURE_SQL["profit"])} AS profit
FROM fact GROUP BY ALL""",
)
def mom_change(t: Tables) -> DataFrame:
    fact = t.fact().withColumn("month", month_index(F.col("creationDate")))
    monthly = m.kpi(fact, ["profit"], ["eventID", "month"])
    monthly = monthly.withColumn("profit", F.col("profit").cast("double"))
    return w.previous_month(stable(monthly), t.calendar(), ["profit"], ["eventID"])


_PROFIT_DAYS = {
    "pd": f"""SELECT "creationDate" AS date, sum(gross - dval) FILTER (WHERE {OK}) AS profit,
  CAST(sum("totalTickets") FILTER (WHERE {OK}) AS BIGINT) AS tickets FROM fact GROUP BY 1""",
    "pde": f"""SELECT "eventID", "creationDate" AS date, sum(gross - dval) FILTER (WHERE {OK}) AS profit FROM fact GROUP BY ALL""",
    "dense": "SELECT d AS date, profit FROM cal LEFT JOIN pd ON d = pd.date",
    "yoy": """SELECT d AS date, c.profit, p.profit AS sply FROM cal LEFT JOIN pd c ON c.date = d
  LEFT JOIN pd p ON p.date = CAST(d - INTERVAL 1 YEAR AS DATE) WHERE c.profit IS NOT NULL OR p.profit IS NOT NULL""",
}


@query(
    "W05_ytd",
    """SELECT CAST(date AS VARCHAR) AS date, CAST(sum(profit) OVER (PARTITION BY year(date) ORDER BY date) AS DOUBLE) AS ytd FROM dense""",
    **_PROFIT_DAYS,
)
def ytd(t: Tables) -> DataFrame:
    dense = t.calendar().select("date").join(daily(t, ["profit"]), "date", "left")
    return w.to_date(dense, "profit", "year").select("date", "ytd")


@query(
    "W06_qtd",
    """SELECT "eventID", CAST(date AS VARCHAR) AS date, CAST(qtd AS DOUBLE) AS qtd FROM
(SELECT "eventID", d AS date, sum(profit) OVER (PARTITION BY "eventID", year(d), quarter(d) ORDER BY d) AS qtd
  FROM (SELECT DISTINCT "eventID" FROM pde) CROSS JOIN cal LEFT JOIN (SELECT "eventID", date AS d, profit FROM pde) USING ("eventID", d))
WHERE qtd IS NOT NULL""",
    **_PROFIT_DAYS,
)
def qtd(t: Tables) -> DataFrame:
    """Per event, on every day from the first completed order of a quarter to its end."""
    series = daily(t, ["profit"], ("eventID",)).where("profit IS NOT NULL")
    running = w.to_date(series, "profit", "quarter", ["eventID"]).select("eventID", "date", "qtd")
    return w.until_next(running, "quarter", ["eventID"])


def _avg(n: int, order: str, part: str = "") -> str:
    over = f"OVER ({part} ORDER BY {order} RANGE BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN count(profit) {over} > 0 THEN CAST(sum(profit) {over} AS DOUBLE) / count(profit) {over} END AS avg_{n}"


@query(
    "W07_moving_avg_day",
    f"""SELECT CAST(date AS VARCHAR) AS date, CAST(profit AS DOUBLE) AS profit,
  {", ".join(_avg(n, "date - DATE '1970-01-01'") for n in (3, 7, 15, 24, 30))} FROM pd""",
    **_PROFIT_DAYS,
)
def moving_avg_day(t: Tables) -> DataFrame:
    return w.moving_avg(daily(t, ["profit"]), "profit", MOVING_DAYS)


@query(
    "W08_moving_avg_month",
    f"""SELECT "eventID", month, CAST(profit AS DOUBLE) AS profit,
  {", ".join(_avg(n, "month", 'PARTITION BY "eventID"') for n in (3, 6, 9, 12))} FROM
(SELECT "eventID", CAST(year("creationDate") * 12 + month("creationDate") AS INTEGER) AS month, sum(gross - dval) FILTER (WHERE {OK}) AS profit
  FROM fact GROUP BY ALL)""",
)
def moving_avg_month(t: Tables) -> DataFrame:
    fact = t.fact().withColumn("month", month_index(F.col("creationDate")))
    monthly = m.kpi(fact, ["profit"], ["eventID", "month"])
    return w.moving_avg(monthly, "profit", MOVING_MONTHS, "month", ["eventID"])


_CHANGE = "CASE WHEN {v} IS NOT NULL OR {p} IS NOT NULL THEN coalesce({v}, 0) - coalesce({p}, 0) END"
_CHANGE_NN = "(coalesce({v}, 0) - coalesce({p}, 0))"


def _compare(v: str, p: str) -> str:
    change = _CHANGE.format(v=v, p=p)
    pct = f"CASE WHEN {p} IS NULL OR {p} = 0 THEN 0 ELSE ({change}) / {p} END"
    return f"{change} AS change, {pct} AS pct, CAST(sign(coalesce({pct}, 0)) AS INTEGER) AS sign"


def _long(metrics: list[str], source: str) -> str:
    names = ", ".join(f"'{n}'" for n in metrics)
    return f"SELECT date, unnest([{names}]) AS metric, unnest([{', '.join(dbl(n) for n in metrics)}]) AS value FROM {source}"


def _compared(metrics: list[str], steps: dict[str, str]) -> dict[str, str]:
    """Named subqueries: ``long`` must hold the values, ``compared`` has them beside earlier ones."""
    arms = " ".join(f"WHEN '{name}' THEN CAST(d - INTERVAL 1 {step} AS DATE)" for name, step in steps.items())
    return {
        "axis": f"""SELECT d AS date, metric, versus, CASE versus {arms} END AS then_ FROM cal
  CROSS JOIN (SELECT unnest([{", ".join(f"'{n}'" for n in metrics)}]) AS metric) CROSS JOIN (SELECT unnest([{", ".join(f"'{n}'" for n in steps)}]) AS versus)""",
        "compared": f"""SELECT a.date, a.metric, versus, c.value, p.value AS previous, {_compare("c.value", "p.value")} FROM axis a
  LEFT JOIN long c ON c.metric = a.metric AND c.date = a.date LEFT JOIN long p ON p.metric = a.metric AND p.date = a.then_
  WHERE c.value IS NOT NULL OR p.value IS NOT NULL""",
    }


_CARD_STEPS = {"PD": "DAY", "PY": "YEAR"}
_CARD_COMPARED = {**_DAILY, "long": _long(CARD, "card"), **_compared(CARD, _CARD_STEPS)}
_COMPARED_SQL = "SELECT CAST(date AS VARCHAR) AS date, * EXCLUDE (date) FROM compared"


def _compare_cards(t: Tables) -> DataFrame:
    return w.kpi_comparison(daily_card(t), t.calendar(), CARD, {"PD": ("day", -1), "PY": ("year", -1)})


@query("W09_kpi_comparison", _COMPARED_SQL, **_CARD_COMPARED)
def kpi_comparison(t: Tables) -> DataFrame:
    return _compare_cards(t)


_SALES = list(m.SALES_CHOICE.values())


@query(
    "W09_sales_comparison",
    _COMPARED_SQL,
    **{
        **_DAILY,
        "long": _long(_SALES, "daily"),
        **_compared(_SALES, {"PD": "DAY", "PM": "MONTH", "PY": "YEAR"}),
    },
)
def sales_comparison(t: Tables) -> DataFrame:
    """The five sales measures against the day before and the same day a month and a year back."""
    shifts = {"PD": ("day", -1), "PM": ("month", -1), "PY": ("year", -1)}
    return w.kpi_comparison(stable(daily(t, _SALES)), t.calendar(), _SALES, shifts)


# The dates that a reader of the report has selected: all years with sales. Many events have no order on the ends.
SELECTED = (dt.date(1995, 1, 1), dt.date(2001, 12, 31))
_PICKED = {
    **_PROFIT_DAYS,
    "chosen": f"SELECT DATE '{SELECTED[0]}' AS d0, DATE '{SELECTED[1]}' AS d1",
    "pdp": "SELECT pd.* FROM pd CROSS JOIN chosen WHERE date BETWEEN d0 AND d1",
    "pdep": "SELECT pde.* FROM pde CROSS JOIN chosen WHERE date BETWEEN d0 AND d1",
    "trend": f"""SELECT "eventID", d0, d1, av, bv, {_compare("bv", "av")} FROM (SELECT "eventID", any_value(d0) AS d0, any_value(d1) AS d1,
  sum(CAST(profit AS DOUBLE)) FILTER (WHERE date = d0) AS av, sum(CAST(profit AS DOUBLE)) FILTER (WHERE date = d1) AS bv
  FROM pdep CROSS JOIN chosen GROUP BY 1)""",
}


@query(
    "W10_overall_trend",
    """SELECT "eventID", CAST(d0 AS VARCHAR) AS first_date, CAST(d1 AS VARCHAR) AS last_date,
  av AS first_value, bv AS last_value, change, pct, sign FROM trend""",
    **_PICKED,
)
def overall_trend(t: Tables) -> DataFrame:
    series = daily(t, ["profit"], ("eventID",)).withColumn("v", F.col("profit").cast("double"))
    return w.overall_trend(series, "v", *SELECTED, by=["eventID"])


@query(
    "W11_extremum_markers",
    """SELECT CAST(date AS VARCHAR) AS date, CAST(profit AS DOUBLE) AS profit,
  CASE WHEN date = (SELECT min(date) FROM pdp WHERE profit = hi) THEN CAST(hi AS DOUBLE) END AS peak,
  CASE WHEN date = (SELECT min(date) FROM pdp WHERE profit = lo) THEN CAST(lo AS DOUBLE) END AS low,
  CASE WHEN date IN (d0, d1) THEN CAST(hi AS DOUBLE) * 1.5 END AS upper_line,
  CASE WHEN date = d0 THEN CAST(hi AS DOUBLE) * -0.5 END AS first_marker,
  CASE WHEN date = d1 THEN CAST(hi AS DOUBLE) * -0.5 END AS last_marker,
  strftime(d0, '%d/%m/%Y') AS first_label, strftime(d1, '%d/%m/%Y') AS last_label
FROM (SELECT d AS date, profit, d0, d1 FROM cal CROSS JOIN chosen LEFT JOIN pdp ON d = pdp.date WHERE pdp.date IS NOT NULL OR d IN (d0, d1)),
  (SELECT max(profit) AS hi, min(profit) AS lo FROM pdp)""",
    **_PICKED,
)
def markers(t: Tables) -> DataFrame:
    return w.markers(stable(daily(t, ["profit"])), "profit", *SELECTED)


@query(
    "W11_extremum_markers_by_event",
    """SELECT p."eventID", CAST(date AS VARCHAR) AS date, CAST(profit AS DOUBLE) AS peak FROM pdep p JOIN
(SELECT a."eventID", min(a.date) AS d FROM pdep a JOIN (SELECT "eventID", max(profit) AS hi FROM pdep GROUP BY 1) b
  ON a."eventID" = b."eventID" AND a.profit = b.hi GROUP BY 1) x ON p."eventID" = x."eventID" AND p.date = x.d""",
    **_PICKED,
)
def event_peaks(t: Tables) -> DataFrame:
    per_event = stable(daily(t, ["profit"], ("eventID",)))
    marked = w.markers(per_event, "profit", *SELECTED, by=["eventID"])
    return marked.where("peak IS NOT NULL").select("eventID", "date", "peak")


_LAST = " UNION ALL ".join(
    [
        f"""SELECT 'created' AS basis, {n} AS n, count(*) AS orders, min("creationDateID") AS lo, max("creationDateID") AS hi FROM fact
  WHERE "creationDate" >= (SELECT max("creationDate") FROM fact) - {n}"""
        for n in (3, 7, 14, 30, 60)
    ]
    + [
        f"""SELECT 'purchased', {n}, count(*), min("creationDateID"), max("creationDateID") FROM fact
  WHERE "creationDate" BETWEEN (SELECT max("purchaseDate") FROM fact) - {n} AND (SELECT max("purchaseDate") FROM fact)"""
        for n in (7, 30, 180)
    ]
    + ["""SELECT 'purchased', 0, count(*), min("creationDateID"), max("creationDateID") FROM fact"""]
)


@query("W12_last_n_days_filter", _LAST)
def last_n_days(t: Tables) -> DataFrame:
    """Both filters at several lengths; orders are counted per day before the filter.

    Both keep dates of creation: the first back from the last of them, the second back from
    the last purchase.
    """
    days = t.fact().groupBy("creationDate", "creationDateID")
    per_day = stable(days.agg(F.count(F.lit(1)).alias("orders"), F.max("purchaseDate").alias("bought")))
    bought = per_day.agg(F.max("bought")).scalar()
    parts = []
    for basis, last, lengths in (("created", None, (3, 7, 14, 30, 60)), ("purchased", bought, (7, 30, 180, 0))):
        for n in lengths:
            kept = w.last_n_days(per_day, n, zero_is_all=basis == "purchased", last=last)
            parts.append(
                kept.agg(
                    F.lit(basis).alias("basis"),
                    F.lit(n).alias("n"),
                    F.coalesce(F.sum("orders"), F.lit(0)).alias("orders"),
                    F.min("creationDateID").alias("lo"),
                    F.max("creationDateID").alias("hi"),
                )
            )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query(
    "W13_visible_date_flag",
    """SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS "dateID", CAST(d AS VARCHAR) AS date,
  CASE WHEN d IN (SELECT "creationDate" FROM fact) THEN 1 ELSE 0 END AS visible FROM cal""",
)
def visible_dates(t: Tables) -> DataFrame:
    return w.visible_dates(t.calendar(), t.fact())


@query(
    "W14_event_active_dates",
    """SELECT "eventID", CAST(d AS VARCHAR) AS date FROM cal JOIN (SELECT "eventID", min("purchaseDate") AS lo,
  max("purchaseDate") AS hi FROM fact GROUP BY 1) ON d BETWEEN lo AND hi""",
)
def active_dates(t: Tables) -> DataFrame:
    return w.event_active_dates(t.fact())


_YOY = "CASE WHEN coalesce(profit, 0) = 0 THEN 0 ELSE coalesce(profit, 0) - coalesce(sply, 0) END"


@query(
    "W15_yoy_bounds",
    f"""SELECT CAST(date AS VARCHAR) AS date, CAST(profit AS DOUBLE) AS profit, CAST(sply AS DOUBLE) AS sply_profit,
  CAST(CASE WHEN {_YOY} > 0 THEN profit ELSE sply END AS DOUBLE) AS positive_upper,
  CAST(CASE WHEN {_YOY} < 0 THEN sply ELSE profit END AS DOUBLE) AS negative_upper FROM yoy""",
    **_PROFIT_DAYS,
)
def yoy_bounds(t: Tables) -> DataFrame:
    return w.yoy_bounds(_profit_and_last_year(t), "profit", "sply_profit")


def _profit_and_last_year(t: Tables) -> DataFrame:
    series = stable(daily(t, ["profit"]))
    return w.shift_days(series, t.calendar(), ["profit"], "year", -1, "sply_")


@query(
    "W16_group_max_scale",
    """SELECT CAST(date AS VARCHAR) AS date, CAST(max(greatest(profit, sply)) OVER (PARTITION BY year(date) * 12 + month(date)) AS DOUBLE) * 0.125 AS day_scale,
  CAST(max(profit) OVER () AS DOUBLE) * 1.75 AS line_scale FROM yoy""",
    **_PROFIT_DAYS,
)
def day_scale(t: Tables) -> DataFrame:
    moved = _profit_and_last_year(t).select(
        "date",
        "profit",
        month_index(F.col("date")).alias("month"),
        F.greatest("profit", "sply_profit").alias("upper"),
    )
    out = w.group_max_scale(moved, "upper", ["month"], 0.125, "day_scale")
    out = w.group_max_scale(out, "profit", [], 1.75, "line_scale")
    return out.select("date", "day_scale", "line_scale")


@query(
    "W16_moving_avg_scale",
    f"""SELECT CAST(date AS VARCHAR) AS date, max(avg_7) OVER (PARTITION BY year(date) * 12 + month(date)) * 1.125 AS scale
FROM (SELECT date, {_avg(7, "date - DATE '1970-01-01'")} FROM pd)""",
    **_PROFIT_DAYS,
)
def moving_avg_scale(t: Tables) -> DataFrame:
    series = w.moving_avg(daily(t, ["profit"]), "profit", [7])
    series = series.withColumn("month", month_index(F.col("date")))
    return w.group_max_scale(stable(series), "avg_7", ["month"], 1.125).select("date", "scale")


@query(
    "W16_age_group_scale",
    """SELECT "eventID", "ageGroup", tickets, max(tickets) OVER (PARTITION BY "eventID") * CAST(1.5 AS DOUBLE) AS scale
FROM (SELECT "eventID", "ageGroup", CAST(sum("totalTickets") AS BIGINT) AS tickets FROM okf JOIN cust ON "customerID" = cust.id GROUP BY ALL)""",
)
def age_group_scale(t: Tables) -> DataFrame:
    aged = star_join(t.fact().where(m.is_ok()), customers=t.customers())
    per_group = m.kpi(aged, ["tickets"], ["eventID", "ageGroup"])
    return w.group_max_scale(per_group, "tickets", ["eventID"], 1.5)


@query(
    "W16_scatter_scale",
    """SELECT "eventID", CAST(max(greatest(tickets, revenue)) AS DOUBLE) * 0.125 AS scale FROM
(SELECT "eventID", "creationDate", sum("totalTickets") AS tickets, sum(gross) AS revenue FROM okf GROUP BY ALL) GROUP BY 1""",
)
def scatter_scale(t: Tables) -> DataFrame:
    """The greater of two chosen measures per day, and its maximum per event."""
    days = daily(t, ["tickets", "revenue"], ("eventID",))
    upper = days.withColumn("upper", F.greatest("tickets", "revenue"))
    tops = upper.groupBy("eventID").agg((F.max("upper").cast("double") * 0.125).alias("scale"))
    return tops.where("scale IS NOT NULL")


@query(
    "W18_heatmap_dow_hour",
    f"""SELECT CAST(isodow("creationDate") AS INTEGER) AS "dayOfWeekInt", "todSort", {MEASURE_SQL["profit"]} AS profit,
  {MEASURE_SQL["complete_orders"]} AS complete_orders FROM fact GROUP BY ALL""",
)
def heatmap(t: Tables) -> DataFrame:
    return w.heatmap(t.fact(), ["profit", "complete_orders"])


@query(
    "H02_customers_by_month",
    """SELECT ym, new_customers, repeat_customers, total_customers FROM (SELECT ym,
  nullif(count(*) FILTER (WHERE first_ok.d >= s), 0) AS new_customers, nullif(count(*) FILTER (WHERE first_ok.d < s), 0) AS repeat_customers,
  count(*) AS total_customers FROM (SELECT DISTINCT strftime("creationDate", '%Y%m')::INT AS ym, "customerID" FROM okf)
  JOIN first_ok USING ("customerID") JOIN (SELECT strftime("creationDate", '%Y%m')::INT AS ym, min("creationDate") AS s FROM fact GROUP BY 1)
  USING (ym) GROUP BY ym)""",
    **_DAILY,
)
def monthly_customers(t: Tables) -> DataFrame:
    return c.cohort_counts(c.customer_contexts(with_ym(t.fact()), ["ym"]), ["ym"])


def _fmt(number: str, digits: int = 0) -> str:
    return f"printf('%.{digits}f', CAST(round(CAST({number} AS DECIMAL(28,10)) * 100, {digits}) AS DOUBLE)) || '%'"


def _grouped(number: str) -> str:
    whole = f"round(CAST({number} AS DECIMAL(28,4)), 0)"
    return f"CASE WHEN {whole} = 0 THEN '' ELSE format('{{:,}}', CAST({whole} AS BIGINT)) END"


def _scaled(v: str, unit: int, keep: int, digits: int, mark: str) -> str:
    number = f"printf('%.{digits}f', CAST(round({v}, {keep}) AS DOUBLE) / {unit})"
    return f"regexp_replace({number}, '^0\\.', '.') || '{mark}'"


def _body(metric: str, versus: str) -> str:
    size = "CAST(abs(change) AS DECIMAL(28,4))"
    since = SINCE[versus]
    if metric == "profit":
        kpi = (
            f"CASE WHEN {size} < 1000000 THEN {_scaled(size, 1000, -2, 1, 'K')} "
            f"WHEN {size} < 1000000000 THEN {_scaled(size, 10**6, -4, 2, 'M')} ELSE {_scaled(size, 10**9, -7, 2, 'B')} END"
        )
        return f"{_fmt('abs(pct)')} || ' ($' || {kpi} || ')'"
    if metric in ("tickets", "complete_orders", "new_customers"):
        return f"{_fmt('abs(pct)')} || ' (' || {_grouped('change')} || ')'"
    if metric == "avg_tickets_per_order":
        return _fmt("abs(pct)")
    if metric == "profit_margin":
        return f"{_fmt('abs(change)', 1)} || '{since}'"
    if metric == "completion_rate":
        return f"{_fmt('abs(change)', 1)} || '{since} (' || {_fmt('previous', 1)} || ')'"
    sign = "CASE WHEN change < 0 THEN '-$' ELSE '$' END"
    return f"{_fmt('abs(pct)')} || ' (' || {sign} || {_grouped('abs(change)')} || '){since}'"


_BODY = "CASE " + " ".join(
    f"WHEN metric = '{metric}' AND versus = '{versus}' THEN {_body(metric, versus)}"
    for metric in CARD
    for versus in SINCE
) + " END"


@query(
    "F02_card_labels",
    f"""SELECT CAST(date AS VARCHAR) AS date, metric, versus, CASE WHEN pct > 0 THEN '▲ ' || body WHEN pct = 0 THEN '—'
  WHEN pct < 0 THEN '▼ ' || body END AS label FROM (SELECT *, {_BODY} AS body FROM compared)""",
    **_CARD_COMPARED,
)
def card_labels(t: Tables) -> DataFrame:
    return w.with_card_labels(_compare_cards(t)).select("date", "metric", "versus", "label")


@query(
    "F02_overall_trend_label",
    f"""SELECT "eventID", CASE WHEN pct > 0 THEN '▲ ' || body WHEN pct = 0 THEN 'No Change' WHEN pct < 0 THEN '▼ ' || body END AS label
FROM (SELECT *, {_grouped("CAST(abs(pct) AS DECIMAL(28,10)) * 100")} || '% | $' || {_grouped("abs(change)")} AS body FROM trend)""",
    **_PICKED,
)
def overall_trend_label(t: Tables) -> DataFrame:
    trend = overall_trend(t)
    label = overall_label(F.col("pct"), F.col("change"), money=True)
    return trend.select("eventID", label.alias("label"))
