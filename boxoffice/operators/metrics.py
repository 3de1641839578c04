"""The sales measures, computed from one set of base sums.

Every measure is an expression over a few sums. ``base_sums`` takes just the sums that
the requested measures need, in one grouping; sums can be added up again to a coarser
grain with ``add_up`` before ``finish`` turns them into measures.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxoffice.functions.dates import month_index
from boxoffice.functions.numbers import UNITS, divide, null_if_zero, round_up, sum_units, to_units
from boxoffice.session import stable
from boxoffice.sources import parameters


def is_ok() -> Column:
    """Whether an order was completed."""
    return F.col("orderStatus") == 1


def with_amounts(fact: DataFrame) -> DataFrame:
    """Add the gross amount and the discount of each row in whole ten-thousandths.

    A fact that already holds ``grossUnits`` needs no ``price``.
    """
    if "grossUnits" not in fact.columns:
        fact = fact.withColumn("grossUnits", F.col("totalTickets") * F.col("price") * UNITS)
    gross = F.col("grossUnits")
    return fact.withColumn("discountUnits", F.floor(gross * F.col("discount") + 0.5))


def _when_ok(c: Column) -> Column:
    return F.when(is_ok(), c)


# Sums over fact rows. All but the distinct count can be added up to a coarser grain.
SUMS: dict[str, Callable[[], Column]] = {
    "n_rows": lambda: F.count(F.lit(1)),
    "n_ok": lambda: F.sum(_when_ok(F.lit(1))),
    "s_tickets": lambda: F.sum(_when_ok(F.col("totalTickets"))),
    "s_gross": lambda: sum_units(_when_ok(F.col("grossUnits"))),
    "s_discount": lambda: sum_units(_when_ok(F.col("discountUnits"))),
    "s_rate": lambda: sum_units(_when_ok(to_units(F.col("discount")))),
    "n_rate": lambda: F.count(_when_ok(F.col("discount"))),
}
DISTINCT_IDS: dict[str, Callable[[], Column]] = {
    "n_customers": lambda: F.when(is_ok() & F.col("creationDateID").isNotNull(), F.col("customerID")),
    "n_events": lambda: F.col("eventID"),
}
DISTINCT: dict[str, Callable[[], Column]] = {
    "n_customers": lambda: F.count_distinct(DISTINCT_IDS["n_customers"]()),
    "n_events": lambda: F.count_distinct(DISTINCT_IDS["n_events"]()),
}


@dataclass(frozen=True)
class Measure:
    needs: tuple[str, ...]
    value: Callable[[Mapping[str, Column]], Column]


MEASURES: dict[str, Measure] = {
    "total_orders": Measure(("n_rows",), lambda s: null_if_zero(s["n_rows"])),
    "complete_orders": Measure(("n_ok",), lambda s: s["n_ok"]),
    "completion_rate": Measure(
        ("n_ok", "n_rows"), lambda s: divide(s["n_ok"], s["n_rows"], 0)
    ),
    "tickets": Measure(("s_tickets",), lambda s: s["s_tickets"]),
    "revenue": Measure(("s_gross",), lambda s: s["s_gross"]),
    "discount": Measure(("s_discount",), lambda s: s["s_discount"]),
    "profit": Measure(("s_gross", "s_discount"), lambda s: s["s_gross"] - s["s_discount"]),
    "profit_margin": Measure(
        ("s_gross", "s_discount"), lambda s: divide(s["s_gross"] - s["s_discount"], s["s_gross"])
    ),
    "avg_tickets_per_order": Measure(
        ("s_tickets", "n_ok"), lambda s: divide(s["s_tickets"], s["n_ok"], 0)
    ),
    "avg_revenue_per_order": Measure(
        ("s_gross", "n_ok"), lambda s: divide(s["s_gross"], s["n_ok"], 0)
    ),
    "avg_profit_per_order": Measure(
        ("s_gross", "s_discount", "n_ok"),
        lambda s: divide(s["s_gross"] - s["s_discount"], s["n_ok"], 0),
    ),
    "avg_discount_value_per_order": Measure(
        ("s_discount", "n_ok"), lambda s: divide(s["s_discount"], s["n_ok"], 0)
    ),
    "avg_discount_value": Measure(
        ("s_discount", "n_ok"), lambda s: divide(s["s_discount"], s["n_ok"])
    ),
    "avg_discount_pct": Measure(
        ("s_rate", "n_rate"), lambda s: divide(s["s_rate"], s["n_rate"])
    ),
    "avg_profit_per_ticket": Measure(
        ("s_gross", "s_discount", "s_tickets"),
        lambda s: divide(s["s_gross"] - s["s_discount"], s["s_tickets"], 0),
    ),
    "total_customers": Measure(("n_customers",), lambda s: null_if_zero(s["n_customers"])),
    "avg_orders_per_customer": Measure(
        ("n_rows", "n_customers"), lambda s: round_up(divide(s["n_rows"], s["n_customers"], 0))
    ),
    "events_with_sales": Measure(("n_events",), lambda s: null_if_zero(s["n_events"])),
}

# The measure behind each position of a slicer.
SUMMARY_CHOICE = {1: "complete_orders", 2: "tickets", 3: "discount", 4: "profit"}
SALES_CHOICE = {1: "complete_orders", 2: "tickets", 3: "revenue", 4: "discount", 5: "profit"}
SCATTER_CHOICE = {0: "tickets", 1: "revenue", 2: "discount", 3: "profit"}


def needed_sums(metrics: Iterable[str]) -> list[str]:
    wanted = {s for m in metrics for s in MEASURES[m].needs}
    return [s for s in [*SUMS, *DISTINCT] if s in wanted]


def base_sums(fact: DataFrame, metrics: Sequence[str], by: Sequence[str | Column] = ()) -> DataFrame:
    """The sums that ``metrics`` need, one row per ``by`` group, in one aggregation."""
    exprs = {**SUMS, **DISTINCT}
    sums = [exprs[s]().alias(s) for s in needed_sums(metrics)]
    return with_amounts(fact).groupBy(*by).agg(*sums)


def add_up(sums: DataFrame, by: Sequence[str | Column] = ()) -> DataFrame:
    """Add base sums up to a coarser grain. Distinct counts cannot be added up."""
    names = [c for c in sums.columns if c in SUMS]
    return sums.groupBy(*by).agg(*[F.sum(c).alias(c) for c in names])


def finish(sums: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Replace base sums by the measures."""
    have = {c: F.col(c) for c in sums.columns}
    keys = [c for c in sums.columns if c not in SUMS and c not in DISTINCT]
    return sums.select(*keys, *[MEASURES[m].value(have).alias(m) for m in metrics])


def kpi(
    fact: DataFrame,
    metrics: Sequence[str],
    by: Sequence[str | Column] = (),
    where: Column | None = None,
) -> DataFrame:
    """The measures per group: one scan, one aggregation for any number of them."""
    rows = fact if where is None else fact.where(where)
    return finish(base_sums(rows, metrics, by), metrics)


def total_of(df: DataFrame, metric: str, keys: Sequence[str], name: str) -> DataFrame:
    """``df`` with the sum of ``metric`` over the rows that share ``keys``.

    The rows are aggregated first and joined back; with no keys the sum is one scalar. So
    a group of any size is never gathered in one task, as a window would do.
    """
    return without_filters(df, metric, {name: keys})


def max_of(df: DataFrame, metric: str, keys: Sequence[str], name: str) -> DataFrame:
    """Like ``total_of`` with the maximum."""
    if not keys:
        return df.withColumn(name, df.agg(F.max(metric)).scalar())
    tops = df.groupBy(*keys).agg(F.max(metric).alias(name))
    return _join_back(df, tops, keys, name)


def _join_back(df: DataFrame, groups: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    g = groups.select(*[F.col(k).alias(f"_{k}") for k in keys], name)
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return df.join(g, same, "left").drop(*[f"_{k}" for k in keys])


def without_filters(df: DataFrame, metric: str, remaining: Mapping[str, Sequence[str]]) -> DataFrame:
    """``metric`` next to its values under fewer filters.

    ``remaining`` maps a new column to the grouping columns whose filter still holds for
    it; all others are taken away. Each is an aggregation of ``df`` itself, so a frame
    that is costly to compute should be written first.
    """
    out = df
    for name, keys in remaining.items():
        if keys:
            groups = df.groupBy(*keys).agg(F.sum(metric).alias(name))
            out = _join_back(out, groups, keys, name)
        else:
            out = out.withColumn(name, df.agg(F.sum(metric)).scalar())
    return out


def measures_without_filters(
    fact: DataFrame, metrics: Sequence[str], by: Sequence[str], remaining: Mapping[str, Sequence[str]]
) -> DataFrame:
    """Measures per ``by`` group next to their values under fewer filters, as ``<metric>_<name>``.

    ``remaining`` maps a name to those of the ``by`` columns whose filter still holds. Unlike
    ``without_filters``, which adds a metric up, each context's measure is made from its own base sums, so
    ratios are right too. The fact is aggregated once; the sums of all contexts
    follow from that in one aggregation by grouping sets, which is written, a row per group and context.
    """
    sets = [list(by), *[list(keys) for keys in remaining.values()]]
    sums = base_sums(fact, metrics, by)
    names = [c for c in sums.columns if c in SUMS]
    if len(names) < len(needed_sums(metrics)):
        raise ValueError("distinct counts cannot be added up; see operators.distinct")
    unique = [list(s) for s in dict.fromkeys(tuple(s) for s in sets)]
    added = sums.groupingSets([[F.col(c) for c in s] for s in unique], *[F.col(c) for c in by])
    added = stable(added.agg(F.grouping_id().alias("_set"), *[F.sum(c).alias(c) for c in names]))

    def context(keys: Sequence[str]) -> DataFrame:
        number = sum(1 << (len(by) - 1 - i) for i, c in enumerate(by) if c not in keys)
        return finish(added.where(F.col("_set") == number).select(*keys, *names), metrics)

    out = context(by)
    for name, keys in remaining.items():
        values = context(keys).withColumnsRenamed({m: f"{m}_{name}" for m in metrics})
        if keys:
            same = F.lit(True)
            for k in keys:
                values = values.withColumnRenamed(k, f"_{k}")
                same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
            out = out.join(values, same, "left").drop(*[f"_{k}" for k in keys])
        else:
            for m in metrics:
                out = out.withColumn(f"{m}_{name}", values.select(f"{m}_{name}").scalar())
    return out


def single_value(c: Column) -> Column:
    """The value of ``c`` if the group has exactly one, else null. No distinct is needed."""
    return F.when((F.min(c) == F.max(c)) & (F.count(c) == F.count(F.lit(1))), F.min(c))


def single_values(df: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    """``single_value`` of several columns per group.

    Repeated combinations go first: grouping keys may be texts in a hash aggregation,
    while a minimum of texts needs sorted input, which then is short.
    """
    combinations = df.select(*by, *columns).distinct()
    return combinations.groupBy(*by).agg(*[single_value(F.col(c)).alias(c) for c in columns])


def selected(choice: Mapping[int, str], position: int) -> str:
    """The measure a slicer position stands for."""
    return choice[position]


def long_metrics(
    wide: DataFrame, keys: Sequence[str], params: DataFrame, metrics: Sequence[str]
) -> DataFrame:
    """Measures as rows, joined to their label, position and group."""
    values = [F.col(m).cast("double").alias(m) for m in metrics]
    long = wide.select(*keys, *values).unpivot(list(keys), list(metrics), "metric", "value")
    return long.join(F.broadcast(params), "metric")


def even_positions(params: DataFrame) -> DataFrame:
    """Entries of a metric table at even positions."""
    return params.where(F.col("position") % 2 == 0)


def pct_of_target(fact: DataFrame, events: DataFrame) -> DataFrame:
    """Tickets created up to the last purchase date of all, as a share of the event target.

    Sums and last purchases are taken per event and day in one pass; the bound is applied to those.
    """
    days = with_amounts(fact).groupBy("eventID", "creationDateID")
    days = stable(days.agg(SUMS["s_tickets"]().alias("s_tickets"), F.max("purchaseDateID").alias("last")))
    last = days.agg(F.max("last")).scalar()
    sold = finish(add_up(days.where(F.col("creationDateID") <= last), ["eventID"]), ["tickets"])
    targets = events.select(F.col("id").alias("eventID"), "target")
    return sold.join(targets, "eventID", "left").select(
        "eventID", "tickets", "target", divide(F.col("tickets"), F.col("target")).alias("pct_of_target")
    )


def event_ticket_total(events: DataFrame, fact: DataFrame) -> DataFrame:
    """The event dimension with its total of tickets sold."""
    sold = kpi(fact, ["tickets"], ["eventID"]).withColumnRenamed("eventID", "_event")
    return events.join(sold, F.col("id") == F.col("_event"), "left").drop("_event")


def sales_date_bounds(fact: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """First and last creation and purchase date keys."""
    return fact.groupBy(*by).agg(
        *[
            f(c).alias(f"{name}_{c}")
            for c in ("creationDateID", "purchaseDateID")
            for name, f in (("first", F.min), ("last", F.max))
        ]
    )


def buyers_by_gender(fact: DataFrame, customers: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Distinct buyers per gender.

    Buyers are made distinct before they meet the customer table, so a customer with very
    many orders is one row in the join.
    """
    buyers = fact.where(is_ok()).select(*by, "customerID").distinct()
    people = customers.select(F.col("id").alias("customerID"), "gender")
    return (
        buyers.join(people, "customerID")
        .groupBy(*by, "gender")
        .agg(F.count(F.lit(1)).alias("buyers"))
    )


def months_selected(fact: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Number of year-months with fact rows."""
    month = month_index(F.col("creationDate"))
    return fact.groupBy(*by).agg(F.count_distinct(month).alias("months"))


def event_status(df: DataFrame, events: DataFrame, metric: str) -> DataFrame:
    """``Opening`` or ``Closed`` for events whose metric has a value."""
    state = events.select(F.col("id").alias("eventID"), "isOpening")
    label = F.when(F.col("isOpening") == 0, "⬤ Closed").otherwise("⬤ Opening")
    return (
        df.join(state, "eventID", "left")
        .withColumn("status", F.when(F.col(metric).isNotNull(), label))
        .drop("isOpening")
    )


SUMMARY_NAMES = [m[1] for m in parameters.SUMMARY_METRICS]
