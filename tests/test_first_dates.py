"""First dates kept as a table, against what all past orders say."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from boxoffice.catalog import cohorts as catalog
from boxoffice.catalog.bindings import Tables
from boxoffice.functions.dates import month_start
from boxoffice.operators import cohorts
from boxoffice.sources.first_dates import correct_first_dates, first_bought, first_dates, first_ordered, merge_first_dates
from boxoffice.sources import sinks
from boxoffice.sources.sinks import current_table
from tests.conftest import SF, values

SCHEMA = (
    "id long, customerID long, eventID long, totalTickets long, price long, discount double, orderStatus int, "
    "creationDate date, creationDateID int, ym int"
)


def order(number, customer, event, day, ok=1, tickets=1):
    key = day.year * 10000 + day.month * 100 + day.day if day else None
    return (number, customer, event, tickets, 100, 0.1, ok, day, key, key // 100 if key else None)


def history(count=600, seed=5):
    """Customer 1 has a third of the orders; some rows lack a customer, an event or a date."""
    rng = random.Random(seed)
    out = []
    for i in range(count):
        customer = rng.choice([1, rng.randrange(2, 60), rng.randrange(2, 60)])
        day = dt.date(2024, 1, 1) + dt.timedelta(days=rng.randrange(120))
        row = order(i, customer, rng.randrange(4), day, int(rng.random() < 0.6), rng.randrange(1, 4))
        out.append(row)
    out += [order(9001, None, 1, dt.date(2024, 1, 2)), order(9002, 70, None, dt.date(2024, 1, 3)), order(9003, 71, 2, None)]
    return out


@pytest.fixture(scope="module")
def facts(spark):
    return spark.createDataFrame(history(), SCHEMA)


def loaded(facts, path, parts, keep=()):
    return [merge_first_dates(facts.where(p), str(path), keep) for p in parts]


@pytest.mark.parametrize("keep", [(), ("eventID",)])
def test_loads_in_any_order_equal_the_whole(spark, tmp_path, facts, keep):
    parts = ["ym = 202402", "ym = 202404", "ym = 202401 or ym is null", "ym = 202403", "ym = 202402"]
    written = loaded(facts, tmp_path, parts, keep)
    assert values(current_table(spark, str(tmp_path))) == values(first_dates(facts, keep))
    assert written[-1] == 0


def test_a_day_writes_only_what_it_moves(spark, tmp_path, rows):
    old = [order(c, c, 1, dt.date(2024, 1, 1)) for c in range(300)]
    new = [
        order(1000, 5, 1, dt.date(2024, 1, 2)),  # known, later
        order(1001, 6, 1, dt.date(2023, 12, 1), ok=0),  # an earlier order, no earlier purchase
        order(1002, 500, 1, dt.date(2024, 1, 2)),  # new
        order(1003, 501, 1, dt.date(2024, 1, 2), ok=0),  # new, buys nothing
    ]
    assert loaded(rows(old, SCHEMA), tmp_path, ["true"]) == [300]
    assert loaded(rows(new, SCHEMA), tmp_path, ["true"]) == [3]
    got = {r[0]: tuple(r)[1:] for r in current_table(spark, str(tmp_path)).where("customerID in (5, 6, 500, 501)").collect()}
    day = dt.date
    assert got == {
        5: (day(2024, 1, 1), day(2024, 1, 1)),
        6: (day(2023, 12, 1), day(2024, 1, 1)),
        500: (day(2024, 1, 2), day(2024, 1, 2)),
        501: (day(2024, 1, 2), None),
    }


def test_a_purchase_after_a_failed_order(spark, tmp_path, rows):
    failed, bought = order(1, 7, 1, dt.date(2024, 1, 1), ok=0), order(2, 7, 1, dt.date(2024, 2, 1))
    assert loaded(rows([failed], SCHEMA), tmp_path, ["true"]) == [1]
    assert loaded(rows([bought], SCHEMA), tmp_path, ["true"]) == [1]
    assert values(first_bought(spark, str(tmp_path))) == [(7, dt.date(2024, 2, 1))]


def test_withdrawn_orders(spark, tmp_path, rows):
    before = [order(1, 1, 1, dt.date(2024, 1, 1)), order(2, 1, 1, dt.date(2024, 2, 1)), order(3, 2, 1, dt.date(2024, 1, 5))]
    before += [order(10 + c, 10 + c, 1, dt.date(2024, 1, 1)) for c in range(50)]
    after = [r for r in before if r[0] not in (1, 3)]
    loaded(rows(before, SCHEMA), tmp_path, ["true"])
    gone = rows([(1,), (2,), (12,)], "customerID long")
    # Customer 1 moves, customer 2 is nobody any more, customer 12 stays as it was.
    assert correct_first_dates(gone, rows(after, SCHEMA), str(tmp_path)) == 1
    assert values(current_table(spark, str(tmp_path))) == values(first_dates(rows(after, SCHEMA)))


def test_no_orders(spark, tmp_path, rows):
    assert loaded(rows([], SCHEMA), tmp_path, ["true", "true"]) == [0, 0]
    assert first_bought(spark, str(tmp_path)).count() == 0


def test_a_month_needs_no_past_orders(spark, tmp_path, facts):
    """Figures of one month from its own folder and the stored dates equal those of the whole history."""
    root = str(tmp_path / "fact")
    facts.write.partitionBy("ym").parquet(root)
    # The state is a little ahead of the month, which does not change the month's figures.
    merge_first_dates(facts, str(tmp_path / "all"))
    merge_first_dates(facts, str(tmp_path / "event"), ("eventID",))
    first_ever = first_bought(spark, str(tmp_path / "all"))
    earliest = first_ordered(spark, str(tmp_path / "event"), ("eventID",))

    by, start = ["eventID", "ym"], month_start(F.col("first_order"))
    past = cohorts.customer_contexts(facts, by)
    month = spark.read.parquet(root).where("ym = 202403")
    assert {f.split("ym=")[1].split("/")[0] for f in month.inputFiles() if "ym=202403" in f} == {"202403"}
    now = cohorts.customer_contexts(month, by)
    pairs = [
        (cohorts.cohort_counts(now, by, first_ever=first_ever), cohorts.cohort_counts(past, by)),
        (cohorts.cohort_value(now, by, first_ever=first_ever), cohorts.cohort_value(past, by)),
        (
            cohorts.new_vs_repeat(cohorts.cohort_summary(now, by, first_ever=first_ever)),
            cohorts.new_vs_repeat(cohorts.cohort_summary(past, by)),
        ),
        (
            cohorts.avg_new_customer_value(now, ["eventID"], "ym", start, first_ever, earliest),
            cohorts.avg_new_customer_value(past, ["eventID"], "ym", start),
        ),
    ]
    for got, expected in pairs:
        assert values(got) == values(expected.where("ym = 202403"))
        assert got.count() > 0
        read = "".join(got.inputFiles())
        assert "ym=202401" not in read and "ym=202402" not in read


def test_measures_by_gender(rows):
    fact = rows([order(1, 1, 1, dt.date(2024, 1, 1), tickets=2), order(2, 2, 1, dt.date(2024, 1, 1)),
                 order(3, 3, 1, dt.date(2024, 1, 1)), order(4, 1, 2, dt.date(2024, 1, 1), ok=0)], SCHEMA)
    people = rows([(1, "Female"), (2, "Male"), (3, None)], "id long, gender string")
    got = cohorts.measures_by_gender(fact, people, ["profit", "complete_orders"], ["eventID"])
    assert values(got.select("eventID", "metric", "female", "male", "total", "female_share")) == [
        (1, "complete_orders", 1.0, 1.0, 3.0, 1 / 3),
        (1, "profit", 180.0, 90.0, 360.0, 0.5),
        (2, "complete_orders", None, None, None, None),
        (2, "profit", None, None, None, None),
    ]


@pytest.mark.parametrize(
    "name", ["value_from_first_dates", "customers_from_first_dates", "by_payment_from_first_dates"]
)
def test_loads_and_figures_join_the_orders_once(spark, name):
    calls = []

    class Counted(Tables):
        def fact(self):
            calls.append(1)
            return super().fact()

    assert getattr(catalog, name)(Counted(spark, SF)).count() > 0
    assert len(calls) == 1


def test_rows_of_the_last_load_do_not_meet_the_keys(spark, tmp_path, rows):
    path, empty = str(tmp_path), rows([], "k long, v long")
    sinks.add_version(empty, path)
    change = rows([(1, 10), (None, 20)], "k long, v long")
    sinks.add_version(change, path, changed=change.select("k"))
    only = current_table(spark, path)
    assert "Exchange" not in only._jdf.queryExecution().executedPlan().toString()
    assert values(only) == [(1, 10), (None, 20)]
    later = rows([(2, 30)], "k long, v long")
    sinks.add_version(later, path, changed=rows([(2,), (None,)], "k long"))
    assert values(current_table(spark, path)) == [(1, 10), (2, 30)]
    # A load that only takes rows away.
    sinks.add_version(empty, path, changed=rows([(1,)], "k long"))
    assert values(current_table(spark, path)) == [(2, 30)]
    assert values(current_table(spark, path, load=2)) == [(1, 10), (None, 20)]


def test_a_first_load_without_orders(spark, tmp_path, facts):
    assert loaded(facts, tmp_path, ["false", "true", "ym = 202402"]) == [0, first_dates(facts).count(), 0]
    assert [r["kind"] for r in sinks.loads(spark, str(tmp_path))] == ["full", "full"]
