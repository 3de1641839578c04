"""DuckDB versions of the derived tables, as named subqueries."""

from __future__ import annotations

import re

from boxoffice.catalog.bindings import AS_OF, CUTOFF, EVENT_SUFFIXES, PHASE_TEXTS
from boxoffice.plans import models

CTES: dict[str, str] = {}


def _phase_case(texts: list[str], key: str) -> str:
    arms = " ".join(f"WHEN {key} % {len(texts)} = {i} THEN '{t}'" for i, t in enumerate(texts))
    return f"CASE {arms} END"


CTES["fact"] = """
SELECT l_orderkey AS id, o_custkey AS "customerID", l_partkey AS "ticketID", l_suppkey AS "eventID",
  CAST(l_quantity AS BIGINT) AS "totalTickets",
  CAST(l_extendedprice AS DECIMAL(18,4)) AS gross, CAST(l_discount AS DECIMAL(6,4)) AS discount,
  CAST(CAST(l_extendedprice AS DECIMAL(18,4)) * CAST(l_discount AS DECIMAL(6,4)) AS DECIMAL(18,4)) AS dval,
  CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS "orderStatus", o_orderpriority AS "paymentMethod",
  CAST(o_orderdate AS DATE) AS "creationDate", CAST(l_shipdate AS DATE) AS "purchaseDate",
  CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS "creationDateID",
  CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER) AS "purchaseDateID",
  CAST((l_orderkey * 7 + l_linenumber) % 24 AS INTEGER) AS "todSort"
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

CTES["okf"] = 'SELECT * FROM fact WHERE "orderStatus" = 1'

CTES["csv_events"] = """
SELECT s_suppkey AS id, s_name AS name, n_name AS location,
  CASE WHEN s_suppkey % 2 = 0 THEN 'run' ELSE 'ride' END AS type,
  DATE '1998-03-01' + CAST(200 * (s_suppkey % 7) AS INTEGER) AS date,
  DATE '1995-01-01' + CAST(s_suppkey % 30 AS INTEGER) AS ticket_open_date2,
  DATE '1998-01-01' + CAST(200 * (s_suppkey % 7) AS INTEGER) AS ticket_close_date,
  1000 + 100 * (s_suppkey % 7) AS target
FROM supplier JOIN nation ON s_nationkey = n_nationkey"""

CTES["ev"] = f"""
SELECT id, name, location, type, date, ticket_open_date2 AS "openDate", ticket_close_date AS "closeDate", target,
  CASE WHEN ticket_close_date > DATE '{CUTOFF}' THEN 1 ELSE 0 END AS "isOpening"
FROM csv_events"""

CTES["csv_tickets"] = """
SELECT p_partkey AS ticket_id, p_partkey % 10 AS event_id, p_type AS distance,
  CAST(1 + p_size % 5 AS BIGINT) AS phase_id, CAST(floor(p_retailprice) AS BIGINT) AS price
FROM part"""

CTES["csv_customers"] = """
SELECT *, created_at + to_seconds(customer_id * 4057 % 8640000) AS last_login_at FROM (
SELECT c_custkey AS customer_id, DATE '1950-01-01' + CAST(c_custkey * 37 % 20000 AS INTEGER) AS date_of_birth,
  n_name AS city, r_name AS state, CASE WHEN c_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender,
  CAST(DATE '1995-01-01' + CAST(c_custkey * 7 % 2000 AS INTEGER) AS TIMESTAMP)
    + to_seconds(c_custkey * 61 % 86400) AS created_at
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

CTES["cust"] = f"""
SELECT customer_id AS id, date_of_birth AS dob, city, state, gender,
  CAST(strftime(created_at, '%Y%m%d') AS INTEGER) AS "creationDateID",
  CAST(strftime(last_login_at, '%Y%m%d') AS INTEGER) AS "lastLoginDateID",
  strftime(created_at, '%H:%M:%S') AS "creationTime", strftime(last_login_at, '%H:%M:%S') AS "lastLoginTime",
  age, CASE WHEN age >= 70 THEN '70 and Above' WHEN age >= 60 THEN '60 - 69' WHEN age >= 50 THEN '50 - 59'
    WHEN age >= 40 THEN '40 - 49' WHEN age >= 30 THEN '30 - 39' WHEN age >= 25 THEN '25 - 29'
    WHEN age >= 16 THEN '16 - 24' ELSE 'Others' END AS "ageGroup"
FROM (SELECT *, CAST(ceil((DATE '{AS_OF}' - date_of_birth) / 365.0) AS INTEGER) AS age FROM csv_customers)"""

CTES["csv_orders"] = """
SELECT *, created_at + to_seconds((order_id * 7 + n * 611) % 7200) AS completed_at FROM (
SELECT l_orderkey AS order_id, o_custkey AS customer_id, l_partkey AS ticket_id, l_suppkey AS event_id,
  CAST(l_quantity AS BIGINT) AS total_tickets, l_linenumber AS n,
  CASE WHEN o_orderstatus = 'F' THEN 'succeeded' ELSE 'failed' END AS order_status,
  o_orderpriority AS payment_method, o_orderdate + to_seconds(l_orderkey * 137 % 86400) AS created_at,
  CAST(floor(l_extendedprice) AS BIGINT) AS price, l_discount AS discount
FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

CTES["cal"] = """
SELECT CAST(unnest(generate_series(date_trunc('year', lo), date_trunc('year', hi) + INTERVAL 1 YEAR - INTERVAL 1 DAY,
  INTERVAL 1 DAY)) AS DATE) AS d
FROM (SELECT least((SELECT min(o_orderdate) FROM orders), (SELECT min(l_shipdate) FROM lineitem)) AS lo,
  greatest((SELECT max(o_orderdate) FROM orders), (SELECT max(l_shipdate) FROM lineitem)) AS hi)"""

CTES["sale_orders"] = """
SELECT *, CASE WHEN k % 13 <> 0 THEN created_at + to_seconds(k * 7 % 1500 - 300) END AS purchased_at FROM (
SELECT o_orderkey AS k, CAST(o_orderkey AS VARCHAR) AS code, o_orderkey % 200 AS event_id,
  CAST(o_custkey AS VARCHAR) AS customer_code,
  CASE o_orderstatus WHEN 'F' THEN 'dat_hang_thanh_cong' WHEN 'O' THEN 'cho_thanh_toan' ELSE 'da_huy' END AS order_status,
  CASE WHEN o_orderkey % 2 = 0 THEN 'online_order' ELSE 'offline_order' END AS order_type,
  lower(replace(o_orderpriority, '-', '_')) AS payment_method,
  o_orderdate + to_seconds(o_orderkey * 977 % 86400) AS created_at,
  CASE WHEN o_orderkey % 11 <> 0 THEN o_orderkey % 10 END AS merchant_id
FROM orders)"""

CTES["order_items"] = f"""
SELECT *, CAST(subtotal - discount_amount AS DECIMAL(18,4)) AS grand_total FROM (
SELECT l_orderkey * 10 + l_linenumber AS id, CAST(l_orderkey AS VARCHAR) AS order_code, p_partkey AS product_id,
  CAST(l_quantity AS BIGINT) AS quantity, CAST(l_extendedprice AS DECIMAL(18,4)) AS subtotal,
  CAST(CAST(l_extendedprice AS DECIMAL(18,4)) * CAST(l_discount AS DECIMAL(6,4)) AS DECIMAL(18,4)) AS discount_amount,
  CASE WHEN p_partkey % 17 = 0 THEN '' WHEN l_linenumber = 1 THEN p_name
    ELSE p_name || ' - ' || {_phase_case(PHASE_TEXTS, "p_partkey")} END AS product_name_en,
  p_type AS ticket_phase_name_en
FROM lineitem JOIN part ON l_partkey = p_partkey)"""

CTES["attendants"] = """
SELECT DISTINCT l_orderkey * 10 + l_linenumber AS item_id, CAST(l_orderkey AS VARCHAR) AS order_code,
  l_partkey AS product_id, 'Category ' || CAST(l_partkey % 4 AS VARCHAR) AS category_en
FROM lineitem WHERE l_returnflag <> 'N'"""

CTES["dump_order_events_once"] = f"""
SELECT event_id, event_name_en, merchant_id, merchant_name_en, p_type,
  CASE WHEN event_id % 28 = 0 THEN '99/99/2023'
    WHEN event_id % 4 = 0 THEN strftime(day, '%d/%m/%Y') WHEN event_id % 4 = 1 THEN strftime(day, '%d %b %Y')
    WHEN event_id % 4 = 2 THEN strftime(day, '%d %b, %Y') ELSE '01 - ' || strftime(day, '%d %b,  %Y') END AS time_en
FROM (SELECT p_partkey AS event_id, p_type, p_name || {_phase_case(EVENT_SUFFIXES, "p_partkey")} AS event_name_en,
    p_partkey % 10 AS merchant_id,
    CASE WHEN p_partkey % 10 = 9 THEN 'Test merchant'
      ELSE 'o''neil run-club 10km ' || CAST(p_partkey % 10 AS VARCHAR) END AS merchant_name_en,
    DATE '2023-01-01' + CAST(p_partkey % 360 AS INTEGER) AS day
  FROM part WHERE p_type <> 'PROMO')"""

CTES["dump_order_events"] = """
SELECT * EXCLUDE (p_type) FROM dump_order_events_once
UNION ALL SELECT event_id, event_name_en, merchant_id, merchant_name_en, 'to be announced'
FROM dump_order_events_once WHERE p_type = 'LARGE'"""

CTES["dump_events"] = f"""
SELECT p_partkey AS event_id, p_name || {_phase_case(EVENT_SUFFIXES, "p_partkey")} AS event_name,
  lower(p_type) AS event_type, DATE '2023-01-01' + CAST(p_partkey % 360 AS INTEGER) AS day
FROM part WHERE p_type <> 'SMALL'"""

CTES["dump_customers"] = """
SELECT *, CASE WHEN k % 5 <> 0 THEN created_at + to_seconds(k * 4057 % 8640000) END AS last_login_at,
  CASE WHEN k % 4 = 0 THEN CAST(born AS VARCHAR) WHEN k % 4 = 1 THEN strftime(born, '%d/%m/%Y')
    WHEN k % 4 = 2 THEN strftime(born, '%d %b %Y') ELSE 'n/a' END AS birthday FROM (
SELECT c_custkey AS k, CAST(c_custkey AS VARCHAR) AS code, CAST(c_custkey % 2 AS INTEGER) AS is_activated,
  CASE WHEN c_custkey % 7 = 0 THEN 'vietnam' ELSE n_name END AS nationality,
  DATE '1950-01-01' + CAST(c_custkey * 37 % 20000 AS INTEGER) AS born,
  CAST(DATE '2020-01-01' + CAST(c_custkey * 7 % 1500 AS INTEGER) AS TIMESTAMP)
    + to_seconds(c_custkey * 61 % 86400) AS created_at
FROM customer JOIN nation ON c_nationkey = n_nationkey)"""

CTES["countries"] = "SELECT n_name AS alpha2_code FROM nation WHERE n_regionkey <= 2"

CTES["dump_login"] = """
SELECT CASE WHEN event_id % 97 <> 0 THEN CAST(user_id AS VARCHAR) END AS customer_code, event_type AS type,
  ts - INTERVAL 1 HOUR AS created_at, CASE WHEN event_id % 211 <> 0 THEN ts END AS updated_at
FROM events"""


def title(expr: str) -> str:
    return (
        f"array_to_string(list_transform(regexp_extract_all({expr}, '([\\p{{L}}]+|[^\\p{{L}}]+)'), "
        "lambda w: upper(w[1]) || lower(w[2:])), '')"
    )


CTES["raw_customers"] = """
SELECT code, is_activated, replace(nationality, 'vietnam', 'VN') AS nationality,
  CAST(coalesce(try_strptime(birthday, '%Y-%m-%d'), try_strptime(birthday, '%m/%d/%Y'),
    try_strptime(birthday, '%d/%m/%Y'), try_strptime(birthday, '%d %b %Y')) AS DATE) AS birthday, created_at, last_login_at
FROM dump_customers"""

CTES["raw_events"] = f"""
SELECT event_id, {title("event_name")} AS event_name, {title("event_type")} AS event_type,
  CAST(day AS TIMESTAMP) + INTERVAL 6 HOUR + INTERVAL 30 MINUTE AS start_date,
  CAST(day AS TIMESTAMP) + INTERVAL 42 HOUR AS end_date FROM dump_events"""

CTES["raw_order_events"] = """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY event_id, merchant_id
  ORDER BY event_name_en NULLS FIRST, merchant_name_en NULLS FIRST, time_en NULLS FIRST) AS rn
FROM dump_order_events) WHERE rn = 1"""

CTES["raw_login"] = """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY customer_code
  ORDER BY updated_at DESC NULLS FIRST, type DESC NULLS LAST, created_at DESC NULLS LAST) AS rn
FROM dump_login WHERE customer_code IS NOT NULL) WHERE rn = 1"""

def _parsed(text: str) -> str:
    """The first accepted date form that fits; each form is strict about its digits."""
    duck = {"dd/MM/yyyy": "%d/%m/%Y", "dd MMM yyyy": "%d %b %Y", "dd MMM, yyyy": "%d %b, %Y"}
    tries = ", ".join(
        f"CASE WHEN regexp_matches({text}, '{form}') THEN try_strptime({text}, '{duck[spark]}') END"
        for form, spark in models.EVENT_DATES
    )
    return f"CAST(coalesce({tries}) AS DATE)"


CTES["stg_organizers"] = f"""
SELECT merchant_id AS id, min({title("merchant_name_en")}) AS organizer_name FROM dump_order_events GROUP BY ALL"""

# What the orders' dump says of an event; a span of days counts by its last one.
CTES["ordered"] = f"""
SELECT event_id AS id, merchant_id AS organizer_id, event_name_en AS event_name,
  if(regexp_matches(lower(event_name_en), '{models.SPORTS}'), 'Sports', 'Others') AS event_type, day AS start_date, day + 2 AS end_date
FROM (SELECT *, {_parsed("last_day")} AS day FROM (SELECT *, if(contains(time_en, '-'),
  nullif(regexp_replace(regexp_extract(time_en, ' - (.+)', 1), '[, ]{{2,}}', ' ', 'g'), ''), time_en) AS last_day FROM raw_order_events))
WHERE position('test' IN lower(merchant_name_en)) = 0 AND position('test' IN lower(event_name_en)) = 0"""

# An event is described by its own dump; the orders' dump adds those that it lacks.
CTES["stg_events"] = """
SELECT id, event_name, event_type, organizer_id, start_date, end_date FROM ordered ANTI JOIN raw_events ON event_id = id
UNION
SELECT event_id, own.event_name, own.event_type, organizer_id, own.start_date::DATE, own.end_date::DATE
FROM ordered RIGHT JOIN raw_events own ON id = event_id WHERE NOT regexp_matches(own.event_name, 'demo|email|test', 'i')"""

# Orders that count, with everything that depends on the order alone.
CTES["known_orders"] = f"""
SELECT o.*, CAST(order_status = '{models.SUCCESS}' AS INTEGER) AS paid,
  CAST(strftime(purchased_at, '%Y%m%d') AS INTEGER) AS date_id, strftime(purchased_at, '%I %p') AS order_tod,
  upper(replace(payment_method, '_', ' ')) AS payment_label, upper(replace(order_type, '_', ' ')) AS type_label,
  date_sub('minute', purchased_at, created_at) AS minutes_back, date_sub('minute', created_at, purchased_at) AS minutes,
  date_sub('second', created_at, purchased_at) AS seconds
FROM sale_orders o SEMI JOIN stg_events e ON o.event_id = e.id WHERE merchant_id IS NOT NULL"""

CTES["stg_orders"] = """
SELECT date_id, code AS order_id, event_id, customer_code AS customer_id, quantity, paid * subtotal AS gross_revenue,
  paid * discount_amount AS discount, paid * grand_total AS net_revenue, order_status, payment_label AS payment_method,
  if(minutes_back NOT BETWEEN 0 AND 15, 0, minutes_back) AS checkout_time, order_tod
FROM order_items JOIN known_orders ON code = order_code"""



def _day_and_hour(time: str, name: tuple[str, str]) -> str:
    """A time as its day number and its hour label, named after it."""
    number = f"year({time}) * 10000 + month({time}) * 100 + day({time})"
    return f"CAST({number} AS INTEGER) AS {name[0]}, strftime({time}, '%I %p') AS {name[1]}"


CTES["stg_customers"] = f"""
SELECT id, is_activated, ifnull(type, 'Website') AS account_type, alpha2_code AS nationality, birthday,
  {_day_and_hour("created_at", ("creation_date_id", "created_at_tod"))},
  {_day_and_hour("last_login_at", ("last_login_date_id", "last_login_tod"))}
FROM (SELECT code AS id, * EXCLUDE (code) FROM raw_customers) LEFT JOIN countries ON alpha2_code = nationality
LEFT JOIN (SELECT customer_code AS id, type FROM raw_login) USING (id)"""

# Base sums as SQL, over rows of the fact.
OK = '"orderStatus" = 1'
N_OK = f"nullif(count(*) FILTER (WHERE {OK}), 0)"
TICKETS = f'sum("totalTickets") FILTER (WHERE {OK})'
GROSS = f"sum(gross) FILTER (WHERE {OK})"
DISCOUNT = f"sum(dval) FILTER (WHERE {OK})"
PROFIT = f"sum(gross - dval) FILTER (WHERE {OK})"
CUSTOMERS = f'nullif(count(DISTINCT "customerID") FILTER (WHERE {OK}), 0)'


def dbl(expr: str) -> str:
    return f"CAST({expr} AS DOUBLE)"


def div(num: str, den: str, default: str = "NULL") -> str:
    """Division that gives ``default`` for an absent or zero denominator."""
    return (
        f"CASE WHEN ({den}) IS NULL OR ({den}) = 0 THEN {default} "
        f"ELSE {dbl(num)} / {dbl(den)} END"
    )


MEASURE_SQL = {
    "total_orders": "nullif(count(*), 0)",
    "complete_orders": N_OK,
    "completion_rate": div(N_OK, "count(*)", "0"),
    "tickets": f"CAST({TICKETS} AS BIGINT)",
    "revenue": dbl(GROSS),
    "discount": dbl(DISCOUNT),
    "profit": dbl(PROFIT),
    "profit_margin": div(PROFIT, GROSS),
    "avg_tickets_per_order": div(TICKETS, N_OK, "0"),
    "avg_revenue_per_order": div(GROSS, N_OK, "0"),
    "avg_profit_per_order": div(PROFIT, N_OK, "0"),
    "avg_discount_value_per_order": div(DISCOUNT, N_OK, "0"),
    "avg_discount_value": div(DISCOUNT, N_OK),
    "avg_discount_pct": div(f"sum(discount) FILTER (WHERE {OK})", f"count(discount) FILTER (WHERE {OK})"),
    "avg_profit_per_ticket": div(PROFIT, TICKETS, "0"),
    "total_customers": CUSTOMERS,
    "avg_orders_per_customer": f"CAST(ceil({div('count(*)', CUSTOMERS, '0')}) AS BIGINT)",
    "events_with_sales": 'nullif(count(DISTINCT "eventID"), 0)',
}


def measures(*names: str) -> str:
    return ", ".join(f"{MEASURE_SQL[n]} AS {n}" for n in names)


def sql(body: str, **extra: str) -> str:
    """``body`` with all named subqueries it needs, directly or through others."""
    known = {**CTES, **extra}
    wanted: set[str] = set()

    def visit(text: str) -> None:
        for name in known:
            if name not in wanted and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
                wanted.add(name)
                visit(known[name])

    visit(body)
    ordered: list[str] = []

    def place(name: str) -> None:
        if name in ordered:
            return
        for other in known:
            if other != name and re.search(rf"\b(FROM|JOIN)\s+{other}\b", known[name]):
                place(other)
        ordered.append(name)

    for name in known:
        if name in wanted:
            place(name)
    if not ordered:
        return body.strip()
    parts = ",\n".join(f"{n} AS ({known[n].strip()})" for n in ordered)
    return f"WITH {parts}\n{body.strip()}"
