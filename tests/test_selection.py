"""Medians by selection, distinct counts by bitmaps, contexts by grouping sets."""

from __future__ import annotations

import datetime as dt
import random
import statistics
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from boxoffice.operators import distinct, metrics, ranking
from tests.conftest import values

SCHEMA = "customerID long, eventID long, paymentMethod string, totalTickets long, price long, discount double, orderStatus int, creationDate date, creationDateID int"


def orders(count, seed=1):
    """Event 1 has a third of the orders; ids of customers lie on both sides of bitmap borders."""
    rng = random.Random(seed)
    ids = [-40000, -1, 0, 1, 32767, 32768, 32769, 65537, 10**12, 10**12 + 1, None]
    return [
        (rng.choice(ids), rng.choice([1, 1, rng.randrange(2, 50), None]), rng.choice(["card", "cash", None]), rng.randrange(1, 5),
         rng.randrange(10, 99), 0.1, int(rng.random() < 0.5), dt.date(2024, 1, 1), rng.choice([20240101, 20240101, None]))
        for _ in range(count)
    ]


@pytest.mark.parametrize(
    "data",
    [
        [3.0], [1.0, 2.0], [5.0, 1.0, 3.0], [7.0] * 5000, [0.0] * 900 + [1.0] * 900, [1.0] * 901 + [2.0] * 900,
        [float(i) for i in range(1501)], [10.0 ** (i % 300 - 150) for i in range(2000)],
        [-1e308, 1e308, 0.0, 1e-308] * 400, [1.0] * 1200 + [float(i) for i in range(2, 400)],
    ],
)
def test_median(rows, data):
    shuffled = random.Random(3).sample(data, len(data))
    df = rows([(v,) for v in [*shuffled, None, float("nan")]], "v double").repartition(3)
    expected = statistics.median(data)
    # The second call narrows in several rounds with a coarse sketch.
    for few, accuracy in ((1 << 16, 10_000), (8, 50)):
        assert ranking.median_of(df, "v", few, accuracy).first()[0] == expected


def test_median_of_nothing(rows):
    assert ranking.median_of(rows([(None,)], "v double"), "v").collect() == [(None,)]


def test_median_does_not_sort_or_move_rows(spark):
    df = spark.range(0, 200_000, 1, 6).select((F.col("id") * 7919 % 200_003).alias("v"))
    out = ranking.median_of(df, "v", few=1000)
    text = out._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in text and "Sort [" not in text
    assert out.first()[0] == statistics.median(i * 7919 % 200_003 for i in range(200_000))


LEVELS = [["eventID", "paymentMethod"], ["eventID"], ["paymentMethod"], []]


def test_levels_equal_counts_of_their_own(rows):
    fact = rows(orders(1500), SCHEMA)
    names = ["total_customers", "events_with_sales", "avg_orders_per_customer", "tickets", "profit"]
    got = distinct.kpi_levels(fact, names, LEVELS)
    for number, level in enumerate(LEVELS):
        expected = metrics.kpi(fact, names, level)
        assert values(got.where(F.col("level") == number), *level, *names) == values(expected, *level, *names)


def test_levels_read_the_fact_without_multiplying_it(rows):
    fact = rows(orders(50), SCHEMA)
    counted = {n: c() for n, c in metrics.DISTINCT_IDS.items()}
    parts = distinct.bitmaps(fact, counted, ["eventID"], {"n_rows": F.count(F.lit(1))})
    text = parts._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in text and text.count("Exchange") == 1


def test_a_group_with_one_id_is_a_small_row(rows):
    """What a task sorts grows with the ids of a group, not with the range they come from."""
    data = [(c, c % 7, "card", 1, 10, 0.1, 1, dt.date(2024, 1, 1), 20240101) for c in range(0, 90_000, 1_000)]
    counted = {n: c() for n, c in metrics.DISTINCT_IDS.items()}
    parts = distinct.bitmaps(rows(data, SCHEMA), counted, ["eventID", "paymentMethod"], {"n_rows": F.count(F.lit(1))})
    sizes = [F.max(F.length(F.col(f"{n}_bits").cast("string"))).alias(n) for n in counted]
    assert max(parts.agg(*sizes).first()) < 100


def test_levels_at_the_borders_of_bitmaps(rows):
    ids = [b * 8192 + d for b in (-2, -1, 0, 1, 5, 10**11) for d in (-1, 0, 1, 8191)]
    data = [(i, e, None, 1, 10, 0.1, 1, dt.date(2024, 1, 1), 20240101) for i in [*ids, *ids, None] for e in (1, 2, None)]
    fact = rows(data, SCHEMA)
    got = distinct.kpi_levels(fact, ["total_customers"], [["eventID"], []])
    assert {r.total_customers for r in got.collect()} == {len(set(ids))} and got.count() == 4


def test_levels_of_no_orders(rows):
    got = distinct.kpi_levels(rows([], SCHEMA), ["total_customers", "tickets"], [["eventID"], []])
    assert values(got) == [(None, 1, None, None)]


def test_dense_ids(rows):
    df = rows([("b",), ("a",), ("c",), ("b",), (None,)], "k string")
    assert values(distinct.dense_ids(df, "k", "n"), "k", "n") == [("a", 1), ("b", 2), ("c", 3)]


def test_contexts(rows):
    """A null event or method is a group of its own, unlike a filter that was taken away."""
    fact = rows(orders(400, seed=2), SCHEMA)
    by, names = ["eventID", "paymentMethod"], ["profit_margin", "tickets"]
    kept = {"event": ["eventID"], "method": ["paymentMethod"], "all": [], "same": by}
    got = metrics.measures_without_filters(fact, names, by, kept)
    base = {(r.eventID, r.paymentMethod): r for r in metrics.kpi(fact, names, by).collect()}
    contexts = {n: {tuple(r[k] for k in keys): r for r in metrics.kpi(fact, names, keys).collect()} for n, keys in kept.items()}
    found = got.collect()
    assert len(found) == len(base)
    for r in found:
        assert r.tickets == base[r.eventID, r.paymentMethod].tickets
        for n, keys in kept.items():
            expected = contexts[n][tuple(r[k] for k in keys)]
            assert (r[f"tickets_{n}"], r[f"profit_margin_{n}"]) == (expected.tickets, expected.profit_margin)


def test_contexts_refuse_distinct_counts(rows):
    with pytest.raises(ValueError, match="distinct"):
        metrics.measures_without_filters(rows([], SCHEMA), ["total_customers"], ["eventID"], {"all": []})


@pytest.fixture
def written(monkeypatch):
    """The plans of all frames that are written while ranks are taken."""
    plans, write = [], ranking.stable

    def note(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df)

    monkeypatch.setattr(ranking, "stable", note)
    return plans


def by_value(entries):
    """Ranks of (name, value): greatest first, absent last, ties by name, an absent name first."""
    order = sorted(entries, key=lambda e: (e[1] is None, -(e[1] or 0), e[0] is not None, e[0] or ""))
    return {name: place for place, (name, _) in enumerate(order, 1)}


def test_ranks_of_several_metrics_take_one_exchange(rows, written):
    rng, big = random.Random(5), 2**53
    # Neighbours that are equal as doubles, a third of equal values, absent values.
    data = [
        (f"n{i:04d}", big + rng.randrange(9), 7.5 if i % 3 == 0 else rng.random(), Decimal(i % 5) / 100 if i % 7 else None, i % 4)
        for i in range(1200)
    ]
    metrics = ["big", "part", "money", "few"]
    df = rows(data, "name string, big long, part double, money decimal(20,2), few int").repartition(5)
    got = ranking.rank_metrics(df, metrics, "name").collect()
    assert len(written) == 1 and written[0].count("rangepartitioning") == 1
    assert len(got) == len(data) * len(metrics)
    for i, m in enumerate(metrics, 1):
        assert {r["name"]: r["rank"] for r in got if r["metric"] == m} == by_value([(d[0], d[i]) for d in data])
    assert {r["value"] for r in got if r["metric"] == "few"} == {0.0, 1.0, 2.0, 3.0}


def test_ranks_of_no_rows(rows):
    empty = rows([], "name string, v int, w double")
    assert ranking.rank_metrics(empty, ["v", "w"], "name").collect() == []


def test_both_levels_of_several_metrics_take_one_exchange(rows, written, monkeypatch):
    rng = random.Random(6)
    # The first event has a third of the distances; one event and one distance have no name.
    data = [("hot", f"d{i:03d}", rng.randrange(50), rng.choice([None, 1.0, 2.5])) for i in range(300)]
    data += [(e, d, rng.randrange(9), 1.0) for e in ["a", "b", None, *(f"e{i}" for i in range(100))] for d in ["x", "y", None]]
    inner = rows(data, "eventName string, distance string, v long, w double").repartition(4)
    monkeypatch.setattr(ranking, "finish", lambda df, names: df)
    got = ranking.hierarchical_ranks(inner, ["v", "w"], ["v", "w"]).collect()
    assert len(written) == 1 and written[0].count("rangepartitioning") == 1
    for i, m in enumerate(["v", "w"], 2):
        totals, inside = {}, {}
        for d in data:
            inside.setdefault(d[0], []).append((d[1], d[i]))
        for event, entries in inside.items():
            known = [v for _, v in entries if v is not None]
            totals[event] = sum(known) if known else None
        events = {r["eventName"]: r["rank"] for r in got if (r["metric"], r["level"]) == (m, 0)}
        assert events == by_value(totals.items())
        for event, entries in inside.items():
            mine = {r["distance"]: r["rank"] for r in got if (r["metric"], r["level"], r["eventName"]) == (m, 1, event)}
            assert mine == by_value(entries)
