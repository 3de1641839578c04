"""Small fixtures for rules that are easy to get wrong."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from boxoffice.functions import dates, labels, numbers, text
from boxoffice.operators import cohorts, dedup, joins, metrics, ranking, timeintel
from boxoffice.plans import bi_tables, models, raw
from tests.conftest import values

D = dt.date
TS = dt.datetime


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


# Absent values


@pytest.mark.parametrize(
    "num, den, default, expected",
    [(1, 2, 0, 0.5), (1, 0, 0, 0.0), (1, None, 0, 0.0), (None, 2, 0, None), (1, 0, None, None)],
)
def test_divide(spark, num, den, default, expected):
    c = numbers.divide(F.lit(num).cast("bigint"), F.lit(den).cast("bigint"), default)
    assert one(spark, c) == expected


def test_change_against_nothing(rows):
    series = rows([("a", 5.0, None), ("b", None, 4.0), ("c", None, None), ("d", 3.0, 0.0)], "k string, v double, p double")
    got = {r["k"]: (r["change"], r["pct"], r["sign"]) for r in timeintel.compare(series, "v", "p").collect()}
    assert got == {"a": (5.0, 0.0, 0), "b": (-4.0, -1.0, -1), "c": (None, 0.0, 0), "d": (3.0, 0.0, 0)}


def test_month_change_takes_its_sign_from_the_change(rows):
    start = 2024 * 12
    monthly = rows([(start + 1, None), (start + 2, 5.0), (start + 3, 5.0), (start + 5, 1.0)], "month int, v double")
    calendar = rows([(D(2024, m, d),) for m in range(1, 6) for d in (1, 2)], "date date")
    moved = timeintel.previous_month(monthly, calendar, ["v"]).collect()
    got = {r["month"] - start: (r["v_change"], r["v_pct"], r["v_sign"]) for r in moved}
    # April has no rows but follows March; June is outside the calendar, January has nothing.
    assert got == {2: (5.0, 0.0, 1), 3: (0.0, 0.0, 0), 4: (-5.0, -1.0, -1), 5: (1.0, 0.0, 1)}


def test_month_after_the_last_row_of_a_group(rows):
    start = 2024 * 12
    monthly = rows([("a", start + 1, 5.0), ("b", start + 3, 2.0)], "k string, month int, v double")
    calendar = rows([(D(2024, m, 1),) for m in range(1, 4)], "date date")
    moved = timeintel.previous_month(monthly, calendar, ["v"], ["k"])
    got = values(moved, "k", "month", "v", "v_previous")
    assert got == [("a", start + 1, 5.0, None), ("a", start + 2, None, 5.0), ("b", start + 3, 2.0, None)]


# Exact sums


def test_units_sum_exactly(rows):
    amounts = [10**11 + 1, -7, 3, 2**40, -(2**41), 99999]
    df = rows([(a,) for a in amounts], "u bigint")
    got = df.agg(numbers.sum_units(F.col("u")).alias("s")).first()["s"]
    assert got * 10_000 == sum(amounts)


def test_units_sum_beyond_a_long(spark):
    """The total of the units is past 2^63; the sum is still exact."""
    big = spark.range(20).select(F.lit(10**18).alias("u"))
    assert int(big.agg(numbers.sum_units(F.col("u")).alias("s")).first()["s"]) == 20 * 10**14


# Text and dates


def test_title_case(spark):
    assert one(spark, text.title_case(F.lit("o'neil 10km run-fest ĐÀ nẵng"))) == "O'Neil 10Km Run-Fest Đà Nẵng"


@pytest.mark.parametrize(
    "written, expected",
    [
        ("05/03/2023", D(2023, 3, 5)),
        ("05 Mar 2023", D(2023, 3, 5)),
        ("05 Mar, 2023", D(2023, 3, 5)),
        ("03 - 05 Mar, 2023", D(2023, 3, 5)),
        ("03 - 05 Mar,  2023", D(2023, 3, 5)),
        ("99/99/2023", None),
        ("5/3/2023", None),
        ("soon", None),
        ("2023-03-05", None),
    ],
)
def test_event_date(spark, written, expected):
    assert one(spark, models.event_date(F.lit(written))) == expected


@pytest.mark.parametrize(
    "written, expected",
    [
        ("1990-02-01", D(1990, 2, 1)),
        ("01/02/1990", D(1990, 1, 2)),
        ("05/03/1990", D(1990, 5, 3)),
        ("25/03/1990", D(1990, 3, 25)),
        ("1990-05-03T10:00:00", D(1990, 5, 3)),
        ("1990-05-03 10:00:00", D(1990, 5, 3)),
        ("May 3, 1990", D(1990, 5, 3)),
        ("3 May 1990", D(1990, 5, 3)),
        ("1990/05/03", D(1990, 5, 3)),
        ("01 Feb 1990", D(1990, 2, 1)),
        ("13/13/1990", None),
        ("n/a", None),
        (None, None),
    ],
)
def test_mixed_birthdays(spark, written, expected):
    c = F.lit(written).cast("string")
    assert one(spark, dates.parse_mixed(c, raw.BIRTHDAY_FORMATS)) == expected


def test_hour_labels(spark):
    hours = [TS(2024, 1, 1, h) for h in (0, 1, 11, 12, 13, 23)]
    got = [one(spark, dates.hour_label(F.lit(h))) for h in hours]
    assert got == ["12 AM", "01 AM", "11 AM", "12 PM", "01 PM", "11 PM"]


def test_durations_do_not_depend_on_the_time_zone(spark):
    """Just before two to just after three, in a night that lacks the hour between in one zone."""
    start, end = (F.lit(f"1999-04-04 {t}").cast("timestamp_ntz") for t in ("01:59:00.9", "03:01:00.1"))
    key = "spark.sql.session.timeZone"
    before = spark.conf.get(key)
    try:
        for zone in ("UTC", "America/Los_Angeles"):
            spark.conf.set(key, zone)
            assert one(spark, dates.whole_seconds(start, end)) == 3719
            assert one(spark, dates.whole_minutes(start, end)) == 61
            assert one(spark, dates.whole_minutes(end, start)) == -61
    finally:
        spark.conf.set(key, before)


def test_strict_datetimes_fail(rows):
    bad = rows([(1, "x", "y", "2023-99-01", "2023-01-02")], "event_id long, event_name string, event_type string, start_date string, end_date string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        raw.raw_events(bad).collect()


@pytest.mark.parametrize(
    "name, expected",
    [
        ("A - SUPER BIRD", "SUPER EARLY BIRD"),
        ("A - EARLY BIRD TICKET", "EARLY BIRD"),
        ("A - VÉ TIÊU CHUẨN", "REGULAR"),
        ("A - ĐĂNG KÝ SIÊU SỚM", "SUPER EARLY BIRD"),
        ("A - ĐĂNG KÝ SIÊU TRỄ", "SUPER LATE"),
        ("A - ĐĂNG KÝ TRỄ", "LATE"),
        ("A - B (LATE)", "LATE"),
        ("A - B (VIP)", "OTHERS"),
        ("A - B (OPEN", None),
        ("A - LATE GROUP", "OTHERS"),
        ("A - GR LATE", "LATE"),
        ("A - LATE GR", "OTHERS"),
        ("A - GENERAL PRICE", "REGULAR"),
        ("A - REGULAR", "REGULAR"),
        ("A - STANDARD", "REGULAR"),
        ("A - PRESALES", "PRE-SALES"),
        ("A - BLACK FRIDAY", "FLASH SALES"),
        ("A - SOMETHING", "OTHERS"),
        ("NO DASH", None),
    ],
)
def test_phase_names(spark, name, expected):
    phase = models.clean_phase(F.trim(text.extract_or_null(F.lit(name), ".* - (.*)")))
    assert one(spark, models.canonical_phase(phase)) == expected


def test_sports_words_match_inside_words(spark):
    got = [one(spark, F.lit(n).rlike(models.SPORTS)) for n in ("trip", "tracer", "gala")]
    assert got == [True, True, False]


# De-duplication


def test_latest_record_prefers_a_missing_update_time(rows):
    login = rows(
        [("1", "old", TS(2024, 1, 1)), ("1", "new", TS(2024, 1, 2)), ("2", "dated", TS(2024, 1, 1)), ("2", "undated", None), (None, "x", TS(2024, 1, 1))],
        "customer_code string, type string, updated_at timestamp_ntz",
    )
    got = values(dedup.keep_latest(login, "customer_code", "updated_at"), "customer_code", "type")
    assert got == [("1", "new"), ("2", "undated")]


def test_first_record_takes_the_least_row(rows):
    df = rows([(1, "b"), (1, "a"), (2, None), (2, "c"), (None, "z")], "k int, v string")
    assert values(dedup.keep_first(df, ["k"])) == [(1, "a"), (2, None), (None, "z")]


# Joins


def test_not_in_follows_sql(rows, spark):
    left = rows([(1,), (2,), (None,)], "a int")
    for data in ([(1,)], [(1,), (None,)], [], [(None,)], [(7,)]):
        right = rows(data, "b int")
        left.createOrReplaceTempView("l")
        right.createOrReplaceTempView("r")
        expected = values(spark.sql("SELECT a FROM l WHERE a NOT IN (SELECT b FROM r)"))
        assert values(joins.not_in(left, "a", right, "b")) == expected, data


def test_membership_of_null_is_false(rows):
    left = rows([("VN",), ("XX",), (None,)], "c string")
    codes = rows([("VN",), ("VN",), (None,)], "code string")
    got = values(joins.with_membership(left, "c", codes, "code", "ok"))
    assert got == [(None, False), ("VN", True), ("XX", False)]


def test_events_without_name_are_dropped(rows):
    order_events = rows(
        [(1, "a run", 1, "m", "05/03/2023"), (2, None, 1, "m", "05/03/2023"), (3, "b", 1, None, "05/03/2023"), (4, "My Test", 1, "m", "")],
        "event_id long, event_name_en string, merchant_id long, merchant_name_en string, time_en string",
    )
    events = rows(
        [(9, "demo day", "x", None, None), (8, None, "x", None, None), (7, "race", "Run", TS(2023, 1, 1), TS(2023, 1, 2))],
        "event_id long, event_name string, event_type string, start_date timestamp_ntz, end_date timestamp_ntz",
    )
    got = values(models.stg_events(order_events, events))
    assert got == [
        (1, "a run", "Sports", 1, D(2023, 3, 5), D(2023, 3, 7)),
        (7, "race", "Run", None, D(2023, 1, 1), D(2023, 1, 2)),
    ]


def test_a_registered_event_without_id_hides_all_order_events(rows):
    order_events = rows([(1, "a", 1, "m", "05/03/2023")], "event_id long, event_name_en string, merchant_id long, merchant_name_en string, time_en string")
    schema = "event_id long, event_name string, event_type string, start_date timestamp_ntz, end_date timestamp_ntz"
    events = rows([(None, "x", "y", None, None), (5, "z", "y", None, None)], schema)
    assert [r[0] for r in values(models.stg_events(order_events, events), "id")] == [5, None]


# Models


def _orders(rows, created, purchased):
    return rows(
        [("1", 1, "c", models.SUCCESS, "online_order", "e_wallet", created, purchased, 1)],
        "code string, event_id long, customer_code string, order_status string, order_type string, payment_method string, created_at timestamp_ntz, purchased_at timestamp_ntz, merchant_id long",
    )


def _items(rows):
    return rows(
        [(1, "1", 5, 2, 10, 1, 9, "A - B", "x")],
        "id long, order_code string, product_id long, quantity long, subtotal long, discount_amount long, grand_total long, product_name_en string, ticket_phase_name_en string",
    )


@pytest.mark.parametrize(
    "purchased, staged, mart",
    [
        (TS(2024, 1, 1, 10, 7, 59), 0, 7),
        (TS(2024, 1, 1, 10, 15, 0), 0, 15),
        (TS(2024, 1, 1, 10, 15, 1), 0, 0),
        (TS(2024, 1, 1, 9, 52, 30), 7, 0),
        (TS(2024, 1, 1, 9, 40, 0), 0, 0),
        (None, None, 0),
    ],
)
def test_checkout_minutes_count_in_opposite_directions(rows, purchased, staged, mart):
    orders, items = _orders(rows, TS(2024, 1, 1, 10, 0, 0), purchased), _items(rows)
    events = rows([(1,)], "id long")
    attendants = rows([(1, "1", 5, "cat")], "item_id long, order_code string, product_id long, category_en string")
    assert models.stg_orders(orders, items, events).first()["checkout_time"] == staged
    assert models.bi_orders(items, orders, attendants, events).first()["checkout_time"] == mart


def test_rollup_counts_item_rows(rows):
    orders = rows([("c", models.SUCCESS, 2, 9)] * 3 + [("c", "other", 5, 9), ("d", "other", 1, 1)], "customer_id string, order_status string, quantity long, net_revenue long")
    assert values(models.customer_rollup(orders)) == [("c", 3, 6, 27), ("d", 0, 0, 0)]


def test_minutes_part_of_a_duration(rows):
    start = TS(2024, 1, 1, 23, 30)
    orders = rows(
        [(1, 1, 1, 1, 1, "succeeded", "p", start, start + dt.timedelta(hours=1, minutes=5), None, 5, 0.5)],
        "order_id long, customer_id long, ticket_id long, event_id long, total_tickets long, order_status string, payment_method string, created_at timestamp_ntz, completed_at timestamp_ntz, cancelled_at timestamp_ntz, price long, discount double",
    )
    got = bi_tables.fact_orders(orders).first()
    assert (got["checkoutTime"], got["creationDateID"], got["purchaseDateID"], got["purchaseTOD"], got["todSort"]) == (5, 20240101, 20240102, "12 AM", 0)


@pytest.mark.parametrize(
    "dob, age, group",
    [(D(2000, 1, 1), 25, "25 - 29"), (D(1950, 1, 1), 76, "70 and Above"), (D(2015, 1, 1), 10, "Others"), (None, None, "Others")],
)
def test_age(spark, dob, age, group):
    c = bi_tables.age_on(F.lit(dob).cast("date"), F.lit(D(2024, 12, 20)))
    label, _ = bi_tables.age_group(F.col("age"))
    row = spark.range(1).select(c.alias("age")).select("age", label.alias("g")).first()
    assert (row["age"], row["g"]) == (age, group)


def test_calendar_has_every_day(spark):
    bounds = spark.range(1).select(F.lit(D(2024, 1, 1)).alias("lo"), F.lit(D(2025, 12, 31)).alias("hi"))
    cal = bi_tables.dim_calendar(bounds, D(2025, 1, 15))
    assert cal.count() == 366 + 365 and len(cal.columns) == 21
    leap = cal.where("dateID = 20240229").first()
    assert (leap["dayOfWeekInt"], leap["currMonthOffset"], leap["currQuarterOffset"], leap["currYearOffset"], leap["yearQuarterTxt"]) == (4, -11, -4, -1, "2024 Q1")


# Series


def test_leap_day_moves_to_february_28(rows):
    daily = rows([(D(2023, 2, 28), 1), (D(2024, 2, 28), 2), (D(2024, 2, 29), 3)], "date date, v int")
    got = values(timeintel.shift_days(daily, daily, ["v"], "year", -1, "p_"), "date", "p_v")
    assert got == [(D(2023, 2, 28), None), (D(2024, 2, 28), 1), (D(2024, 2, 29), 1)]


def test_day_without_sales_shows_the_day_before(rows):
    daily = rows([(D(2024, 1, 1), 4), (D(2024, 1, 3), 6)], "date date, v int")
    calendar = rows([(D(2024, 1, d),) for d in range(1, 7)], "date date")
    got = values(timeintel.shift_days(daily, calendar, ["v"], "day", -1, "p_"), "date", "v", "p_v")
    assert got == [(D(2024, 1, 1), 4, None), (D(2024, 1, 2), None, 4), (D(2024, 1, 3), 6, None), (D(2024, 1, 4), None, 6)]


def test_year_without_sales_is_compared_with_the_year_before(rows):
    daily = rows([(D(2023, 12, 31), 4)], "date date, v int")
    calendar = rows([(D(2023, 12, 31),), (D(2024, 12, 30),), (D(2024, 12, 31),)], "date date")
    got = timeintel.kpi_comparison(daily, calendar, ["v"], {"PD": ("day", -1), "PY": ("year", -1)})
    assert values(got, "date", "versus", "value", "previous", "change", "pct", "sign") == [
        (D(2023, 12, 31), "PD", 4.0, None, 4.0, 0.0, 0),
        (D(2023, 12, 31), "PY", 4.0, None, 4.0, 0.0, 0),
        (D(2024, 12, 31), "PY", None, 4.0, -4.0, -1.0, -1),
    ]


def test_running_total_holds_until_the_next_sale_or_the_end(rows):
    series = rows([(D(2024, 3, 29), 1), (D(2024, 4, 29), 2), (D(2024, 6, 29), 3)], "date date, qtd int")
    got = values(timeintel.until_next(series, "quarter"), "date", "qtd")
    assert got[:4] == [(D(2024, 3, 29), 1), (D(2024, 3, 30), 1), (D(2024, 3, 31), 1), (D(2024, 4, 29), 2)]
    assert got[-3:] == [(D(2024, 6, 28), 2), (D(2024, 6, 29), 3), (D(2024, 6, 30), 3)]
    assert len(got) == 3 + 61 + 2


def test_trend_of_a_selection_that_starts_before_the_first_sale(rows):
    daily = rows([("a", D(2024, 1, 2), 4.0), ("a", D(2024, 1, 5), 6.0), ("b", D(2024, 1, 1), 4.0), ("b", D(2024, 1, 5), 2.0), ("c", D(2024, 2, 1), 1.0)], "k string, date date, v double")
    got = timeintel.overall_trend(daily, "v", D(2024, 1, 1), D(2024, 1, 5), ["k"])
    assert values(got, "k", "first_value", "last_value", "change", "pct", "sign") == [("a", None, 6.0, 6.0, 0.0, 0), ("b", 4.0, 2.0, -2.0, -0.5, -1)]


def test_new_customers_by_day(rows):
    orders = rows(
        [("x", D(2024, 1, 1), 0, 100), ("x", D(2024, 1, 2), 1, 200), ("y", D(2024, 1, 2), 1, 300), ("y", D(2024, 1, 2), 1, 50), ("y", D(2024, 1, 3), 1, 70), (None, D(2024, 1, 2), 1, 9)],
        "customerID string, creationDate date, orderStatus int, grossUnits long",
    ).withColumn("discount", F.lit(0.0))
    got = values(cohorts.new_customers_by_day(orders), "date", "new_customers", "starters", "total_new_customers_value")
    assert [(d, n, s, v if v is None else float(v)) for d, n, s, v in got] == [(D(2024, 1, 1), None, 1, None), (D(2024, 1, 2), 2, 1, 0.035)]


def test_two_days_that_move_to_one_count_once(spark, rows):
    days = [D(2023, 2, 27), D(2023, 2, 28), D(2024, 2, 28), D(2024, 2, 29)]
    calendar = rows([(d, d.year * 100 + d.month) for d in days], "date date, ym int")
    sums = rows([(D(2023, 2, 28), 7)], "date date, s_tickets long")
    got = timeintel.shift_period(sums, calendar, ["ym"], ["tickets"], "year", -1)
    assert values(got) == [(202402, 7)]


def test_moving_average_ignores_days_without_value(rows):
    daily = rows([(D(2024, 1, 1), 10), (D(2024, 1, 2), None), (D(2024, 1, 3), 20), (D(2024, 1, 6), 5)], "date date, v int")
    got = values(timeintel.moving_avg(daily, "v", [3]), "date", "avg_3")
    assert [g[1] for g in got] == [10.0, 10.0, 15.0, 5.0]


def test_last_n_days_has_n_plus_one_days(rows):
    df = rows([(D(2024, 1, d),) for d in range(1, 11)], "creationDate date")
    assert timeintel.last_n_days(df, 3).count() == 4
    assert timeintel.last_n_days(df, 0, zero_is_all=True).count() == 10
    assert timeintel.last_n_days(df, 0).count() == 1
    kept = timeintel.last_n_days(df, 2, last=F.lit(D(2024, 1, 8)))
    assert sorted(r.creationDate.day for r in kept.collect()) == [6, 7, 8]


def test_markers_take_the_earliest_of_equal_peaks(rows):
    daily = rows([(D(2024, 1, 1), 2), (D(2024, 1, 2), 9), (D(2024, 1, 3), 9), (D(2024, 1, 4), 2), (D(2024, 1, 5), None)], "date date, v int")
    got = timeintel.markers(daily, "v", D(2024, 1, 1), D(2024, 1, 5)).collect()
    assert [r["date"] for r in got if r["peak"] is not None] == [D(2024, 1, 2)]
    assert [r["date"] for r in got if r["low"] is not None] == [D(2024, 1, 1)]
    assert {r["date"] for r in got if r["upper_line"] is not None} == {D(2024, 1, 1), D(2024, 1, 5)}


def test_markers_stand_on_the_dates_of_the_selection(rows):
    daily = rows([("a", D(2024, 1, 2), 8), ("a", D(2024, 1, 9), 99)], "k string, date date, v int")
    got = timeintel.markers(daily, "v", D(2024, 1, 1), D(2024, 1, 5), ["k"])
    assert values(got, "date", "v", "peak", "upper_line", "first_marker", "last_marker") == [
        (D(2024, 1, 1), None, None, 12.0, -4.0, None),
        (D(2024, 1, 2), 8, 8, None, None, None),
        (D(2024, 1, 5), None, None, 12.0, None, -4.0),
    ]


def test_yoy_bounds(rows):
    df = rows([("up", 5, 3), ("down", 3, 5), ("zero", 0, 4), ("none", None, 4), ("first", 4, None)], "k string, v int, p int")
    got = {r["k"]: (r["positive_upper"], r["negative_upper"]) for r in timeintel.yoy_bounds(df, "v", "p").collect()}
    assert got == {"up": (5, 5), "down": (5, 5), "zero": (4, 0), "none": (4, None), "first": (4, 4)}


# Ranking and selection


def test_top_n_keeps_ties_at_the_last_place(rows):
    df = rows([("a", 9), ("b", 8), ("c", 7), ("d", 7), ("e", 7), ("f", 6), ("g", None)], "k string, v int")
    assert [r[0] for r in values(ranking.top_n(df, "v", 3), "k")] == list("abcde")
    assert ranking.top_n(df, "v", 50).count() == 6


def test_ranks_put_absent_values_last(rows):
    df = rows([("b", 5.0), ("a", 5.0), ("c", None), ("d", 6.0)], "name string, v double")
    got = {r["name"]: r["rank"] for r in ranking.rank_by(df, "v", "name").collect()}
    assert got == {"d": 1, "a": 2, "b": 3, "c": 4}


@pytest.mark.parametrize("data, median", [([1, 2, 3], 2.0), ([1, 2, 3, 10], 2.5), ([5, 5, 5, None], 5.0)])
def test_median(rows, data, median):
    df = rows([(v,) for v in data], "v int")
    assert ranking.median_of(df, "v").first()[0] == median


def test_single_value(rows):
    df = rows([(1, "a"), (1, "a"), (2, "a"), (2, "b"), (3, "a"), (3, None)], "k int, c string")
    got = df.groupBy("k").agg(metrics.single_value(F.col("c")).alias("c"))
    assert values(got) == [(1, "a"), (2, None), (3, None)]


# Labels


@pytest.mark.parametrize(
    "value, style, expected",
    [
        (1234, "kpi", "$1.2K"),
        (500, "kpi", "$.5K"),
        (999_949, "kpi", "$999.9K"),
        (1_234_567, "kpi", "$1.23M"),
        (2_500_000_000, "kpi", "$2.50B"),
        (999, "label", "$999"),
        (12_345, "label", "$12K"),
        (12_345, "money", "$12,345"),
        (-12_345, "money", "-$12,345"),
        (0, "count", ""),
        (1_234_567, "count", "1,234,567"),
    ],
)
def test_compact_numbers(spark, value, style, expected):
    assert one(spark, labels.compact_number(F.lit(value), style)) == expected


@pytest.mark.parametrize(
    "pct, expected", [(0.125, "▲ 13% (x)"), (0.0, "—"), (-0.5, "▼ 50% (x)"), (None, None)]
)
def test_trend_labels(spark, pct, expected):
    assert one(spark, labels.trend_label(F.lit(pct).cast("double"), F.lit("x"))) == expected


@pytest.mark.parametrize(
    "pct, change, expected",
    [
        (0.99, 1234.0, "▲ 99% | $1,234"),
        (12.345, 1234.0, "▲ 1,235% | $1,234"),
        (-0.5, -20.0, "▼ 50% | $20"),
        (0.001, 3.0, "▲ % | $3"),
        (0.0, 0.0, "No Change"),
    ],
)
def test_overall_labels(spark, pct, change, expected):
    assert one(spark, labels.overall_label(F.lit(pct), F.lit(change), money=True)) == expected


# Cohorts


FACT = "customerID long, eventID long, ticketID long, paymentMethod string, orderStatus int, creationDate date, creationDateID int, totalTickets long, price long, discount double"


def _fact(rows, data):
    """(customer, event, payment, status, day of January)"""
    return rows(
        [(c, e, 1, p, s, D(2024, 1, d), 20240100 + d, 1, 10, 0.5) for c, e, p, s, d in data], FACT
    )


def test_context_starts_with_orders_of_any_status(rows):
    """Customer 1 bought elsewhere on day 2; event 7 opened on day 1 with a failed order."""
    fact = _fact(rows, [(9, 7, "x", 0, 1), (1, 8, "x", 1, 2), (1, 7, "x", 1, 3), (2, 8, "x", 1, 2), (2, 9, "x", 1, 5)])
    got = {r["eventID"]: (r["new_customers"], r["repeat_customers"]) for r in cohorts.cohort_counts(cohorts.customer_contexts(fact, ["eventID"]), ["eventID"]).collect()}
    assert got == {7: (1, None), 8: (2, None), 9: (None, 1)}


def test_payment_filter_holds_for_the_past(rows):
    fact = _fact(rows, [(1, 7, "cash", 1, 1), (1, 8, "card", 1, 3)])
    by = ["eventID", "paymentMethod"]
    contexts = cohorts.customer_contexts(fact, by)
    kept = cohorts.cohort_counts(contexts, by, ["paymentMethod"]).where("eventID = 8").first()
    lifted = cohorts.cohort_counts(contexts, by).where("eventID = 8").first()
    assert (kept["new_customers"], lifted["new_customers"]) == (1, None)


def test_period_value_counts_failed_orders_as_history(rows):
    fact = _fact(rows, [(1, 7, "x", 0, 1), (1, 7, "x", 1, 3), (2, 7, "x", 1, 3)]).withColumn("day", F.col("creationDate"))
    contexts = cohorts.customer_contexts(fact, ["eventID", "day"])
    got = cohorts.period_cohort_value(contexts, ["eventID"], "day", F.col("day"))
    assert values(got.where("day = '2024-01-03'"), "total_new_customers_value")[0][0] == 5


def test_share_of_an_empty_total_is_absent(spark, rows):
    from boxoffice.operators.ranking import share

    df = rows([("a", 3.0), ("a", 1.0), ("b", 0.0), ("c", None)], "g string, v double")
    got = {(r.g, r.v): r.share for r in share(df, "v", ["g"]).collect()}
    assert got == {("a", 3.0): 0.75, ("a", 1.0): 0.25, ("b", 0.0): None, ("c", None): None}
    assert {r.share for r in share(df, "v", ["g"], empty=0).collect()} == {0.75, 0.25, 0.0}


def test_machine_local_folders_are_refused_without_a_local_master():
    from types import SimpleNamespace

    from boxoffice.session import shared_dir

    for master in ("", "spark://host:7077", "local-cluster[2,1,1024]", "yarn"):
        conf = SimpleNamespace(get=lambda k, d=None, m=master: m if k == "spark.master" else d)
        with pytest.raises(ValueError):
            shared_dir(SimpleNamespace(conf=conf))
