"""The scalable forms against literal or brute-force forms of the same rule."""

from __future__ import annotations

import random

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from boxoffice.catalog.cohorts import event_months, with_ym
from boxoffice.catalog.time_series import daily
from boxoffice.functions.numbers import sum_units
from boxoffice.operators import cohorts, joins, metrics, ranking, timeintel
from boxoffice.plans import models
from tests.conftest import values


def test_cohorts_equal_set_operations(tables):
    """EXCEPT and INTERSECT of customer sets for each of a few event months."""
    fact = with_ym(tables.fact()).cache()
    counts = cohorts.cohort_counts(event_months(tables), ["eventID", "ym"])
    sample = counts.orderBy(F.col("total_customers").desc(), "eventID", "ym").limit(6).collect()
    for row in sample:
        here = fact.where((F.col("eventID") == row["eventID"]) & (F.col("ym") == row["ym"]))
        start = here.agg(F.min("creationDate")).first()[0]
        current = here.where("orderStatus = 1").select("customerID").distinct()
        past = fact.where((F.col("orderStatus") == 1) & (F.col("creationDate") < start)).select("customerID")
        assert (row["new_customers"] or 0) == current.subtract(past).count()
        assert (row["repeat_customers"] or 0) == current.intersect(past).count()


def test_product_phases_equal_the_window_form(tables):
    products = models.named_products(tables.order_items(), tables.sale_orders(), tables.stg_events())
    paired = products.join(models.product_phases(products), "product_id")
    order = [F.col("product_name").asc(), F.col("phase").asc_nulls_last()]
    filled = joins.fill_from_previous(paired, "phase", ["product_id", "event_id"], order)
    literal = filled.select(
        "product_id", "event_id", "product_name", models.canonical_phase(F.col("phase")).alias("phase")
    ).distinct()
    ours = models.stg_product(tables.order_items(), tables.sale_orders(), tables.stg_events())
    assert values(ours) == values(literal)


def test_product_phases_on_odd_names(rows):
    """Products with only absent phases, with an unclosed bracket, and with many phases."""
    products = rows(
        [(1, 1, "A"), (1, 1, "B"), (1, 2, "A"), (2, 1, "X - (OPEN"), (2, 1, "X"), (3, 1, "Y - STANDARD"), (3, 1, "Y - (LATE)"), (3, 1, "Y"), (3, 2, "Y - Q")],
        "product_id long, event_id long, product_name string",
    )
    items = products.select(
        F.concat_ws("-", "product_id", "event_id", "product_name").alias("order_code"),
        "product_id",
        F.col("product_name").alias("product_name_en"),
    )
    orders = products.select(
        F.concat_ws("-", "product_id", "event_id", "product_name").alias("code"), "event_id"
    )
    events = products.select(F.col("event_id").alias("id")).distinct()
    paired = products.join(models.product_phases(products), "product_id")
    order = [F.col("product_name").asc(), F.col("phase").asc_nulls_last()]
    filled = joins.fill_from_previous(paired, "phase", ["product_id", "event_id"], order)
    literal = filled.select(
        "product_id", "event_id", "product_name", models.canonical_phase(F.col("phase")).alias("phase")
    ).distinct()
    assert values(models.stg_product(items, orders, events)) == values(literal)


def test_numbering_equals_a_window(rows):
    rng = random.Random(5)
    df = rows([(i, rng.choice([1, 1, 1, 2, 3, None])) for i in range(500)], "id int, v int")
    order = [F.col("v").desc_nulls_last(), F.col("id").asc()]
    ours = values(ranking.numbered(df, order), "id", "place")
    assert ours == values(df.select("id", F.row_number().over(Window.orderBy(*order)).alias("place")))


def test_top_n_equals_rank(rows):
    rng = random.Random(6)
    df = rows([(i, rng.randint(1, 9)) for i in range(60)], "id int, v int")
    for n in (1, 5, 17):
        place = F.rank().over(Window.orderBy(F.col("v").desc()))
        literal = df.withColumn("r", place).where(F.col("r") <= n).drop("r")
        assert values(ranking.top_n(df, "v", n)) == values(literal)


def test_median_equals_percentile(rows):
    rng = random.Random(7)
    df = rows([(rng.choice([1.5, 1.5, rng.random()]),) for _ in range(101)], "v double")
    assert ranking.median_of(df, "v").first()[0] == df.agg(F.median("v")).first()[0]


def test_previous_day_equals_lag_on_a_dense_axis(tables):
    series = daily(tables, ["tickets"])
    dense = tables.calendar().select("date").join(series, "date", "left")
    before = F.lag("tickets").over(Window.orderBy("date")).alias("p_tickets")
    lagged = dense.select("date", "tickets", before)
    lagged = lagged.where("tickets IS NOT NULL OR p_tickets IS NOT NULL").drop("tickets")
    moved = timeintel.shift_days(series, tables.calendar(), ["tickets"], "day", -1, "p_")
    assert values(moved, "date", "p_tickets") == values(lagged)


def test_totals_equal_windows(tables):
    df = metrics.kpi(tables.fact(), ["tickets"], ["eventID", "paymentMethod"])
    ours = metrics.total_of(df, "tickets", ["eventID"], "t")
    window = df.withColumn("t", F.sum("tickets").over(Window.partitionBy("eventID")))
    assert values(ours) == values(window)


def test_unit_sums_equal_decimal_sums(tables):
    fact = metrics.with_amounts(tables.fact())
    exact = F.sum((F.col("grossUnits") / 10_000).cast("decimal(18,4)"))
    row = fact.agg(sum_units(F.col("grossUnits")).alias("a"), exact.alias("b")).first()
    assert row["a"] == row["b"]


def test_price_times_tickets_gives_the_amounts(tables):
    from boxoffice.plans.bi_tables import fact_orders

    fact = fact_orders(tables.csv_orders())
    got = metrics.kpi(fact, ["revenue", "discount"]).first()
    paid = F.col("orderStatus") == 1
    gross = F.col("totalTickets") * F.col("price")
    row = fact.where(paid).agg(F.sum(gross).alias("r"), F.sum(gross * F.col("discount")).alias("d")).first()
    assert int(got["revenue"]) == row["r"]
    assert abs(float(got["discount"]) - row["d"]) < 1e-3


def test_coarser_sums_equal_direct_ones(tables):
    names = ["complete_orders", "tickets", "profit_margin", "completion_rate"]
    fine = metrics.base_sums(tables.fact(), names, ["eventID", "paymentMethod"])
    up = metrics.finish(metrics.add_up(fine, ["eventID"]), names)
    assert values(up) == values(metrics.kpi(tables.fact(), names, ["eventID"]))


def test_ranks_inside_groups_equal_a_window(rows):
    rng = random.Random(8)
    data = {(rng.choice("aaab"), f"n{i}"): rng.choice([None, 1, 2, 2]) for i in range(200)}
    df = rows([(k, n, v) for (k, n), v in data.items()], "k string, name string, v int")
    order = Window.partitionBy("k").orderBy(F.col("v").desc_nulls_last(), F.col("name").asc())
    literal = df.withColumn("rank", F.dense_rank().over(order))
    assert values(ranking.rank_within(df, "v", "name", ["k"]), *literal.columns) == values(literal)


def test_single_values_equal_distinct_counts(tables):
    fact = tables.fact()
    ours = metrics.single_values(fact, ["paymentMethod", "orderStatus"], ["id"])
    one = [
        F.when(F.count_distinct(c) == 1, F.min(c)).alias(c) for c in ("paymentMethod", "orderStatus")
    ]
    assert values(ours) == values(fact.groupBy("id").agg(*one))
