"""A third of all orders belong to one customer, a third to one event: results stay whole."""

from __future__ import annotations

import datetime as dt
import random
from collections import defaultdict

import pytest

from boxoffice.operators import cohorts, metrics, ranking
from tests.test_semantics import FACT


@pytest.fixture(scope="module")
def orders():
    rng = random.Random(11)
    out = []
    for i in range(3000):
        customer = 1 if i % 3 == 0 else rng.randint(2, 400)
        event = 1 if i % 3 == 1 else rng.randint(2, 60)
        day = dt.date(2024, 1, 1) + dt.timedelta(days=rng.randint(0, 200))
        key = day.year * 10000 + day.month * 100 + day.day
        out.append((customer, event, 1, "x", rng.randint(0, 1), day, key, rng.randint(1, 3), 10, 0.1))
    return out


@pytest.fixture(scope="module")
def fact(spark, orders):
    return spark.createDataFrame(orders, FACT).repartition(6).cache()


def test_measures(orders, fact):
    tickets, customers = defaultdict(int), defaultdict(set)
    for c, e, _, _, status, _, _, n, _, _ in orders:
        if status:
            tickets[e] += n
            customers[e].add(c)
    got = metrics.kpi(fact, ["tickets", "total_customers"], ["eventID"]).collect()
    assert {r["eventID"]: r["tickets"] for r in got if r["tickets"]} == dict(tickets)
    assert {r["eventID"]: r["total_customers"] for r in got if r["total_customers"]} == {
        e: len(s) for e, s in customers.items()
    }


def test_cohorts(orders, fact):
    start, first, buyers = {}, {}, defaultdict(set)
    for c, e, _, _, status, day, *_ in orders:
        start[e] = min(start.get(e, day), day)
        if status:
            first[c] = min(first.get(c, day), day)
            buyers[e].add(c)
    expected = {
        e: (sum(first[c] >= start[e] for c in s) or None, sum(first[c] < start[e] for c in s) or None)
        for e, s in buyers.items()
    }
    counts = cohorts.cohort_counts(cohorts.customer_contexts(fact, ["eventID"]), ["eventID"])
    assert {r["eventID"]: (r["new_customers"], r["repeat_customers"]) for r in counts.collect()} == expected


def test_ranks_with_a_third_of_equal_values(spark):
    data = [(f"n{i:04d}", 7 if i % 3 == 0 else i) for i in range(900)]
    df = spark.createDataFrame(data, "name string, v int").repartition(5)
    expected = {n: k for k, (n, _) in enumerate(sorted(data, key=lambda t: (-t[1], t[0])), 1)}
    assert {r["name"]: r["rank"] for r in ranking.rank_by(df, "v", "name").collect()} == expected
    sevens = sum(v == 7 for _, v in data)
    assert ranking.top_n(df.where("v <= 7"), "v", 2).count() == sevens
