"""New and repeat customers.

A customer is *repeat* in a context (an event in a month, say) if they bought before the
first order of that context, and *new* otherwise. Written with sets, this needs one
EXCEPT or INTERSECT per context. Here it is a comparison of two dates: the customer's
first purchase and the first order date of the context.

All cohort figures start from ``customer_contexts``, one row per context and customer. It
reads the fact once and is written to the shared folder, since each figure uses it three
times. Where first dates are kept as a table (``sources.first_dates``), the figures of a month take
them from there, and the contexts are those of that month alone. A customer or an event with a third of all orders is reduced to such rows on the
map side, before anything is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxoffice.functions.numbers import divide
from boxoffice.operators.metrics import MEASURES, SUMS, add_up, base_sums, is_ok, with_amounts
from boxoffice.session import stable


def customer_contexts(
    fact: DataFrame, by: Sequence[str], sums: Sequence[str] = tuple(SUMS)
) -> DataFrame:
    """Per context and customer: the first order, the first purchase, and base sums.

    ``by`` are the context columns. ``sums`` are those that later figures need.
    """
    bought = is_ok() & F.col("creationDateID").isNotNull()
    return stable(
        with_amounts(fact)
        .groupBy(*by, "customerID")
        .agg(
            F.min("creationDate").alias("first_order"),
            F.min(F.when(bought, F.col("creationDate"))).alias("first_bought"),
            *[SUMS[s]().alias(s) for s in sums],
        )
    )


def first_purchases(contexts: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The day of each customer's first purchase ever."""
    bought = contexts.where("first_bought IS NOT NULL")
    return bought.groupBy("customerID", *keep).agg(F.min("first_bought").alias("first_ever"))


def tagged_buyers(
    contexts: DataFrame,
    by: Sequence[str],
    keep: Sequence[str] = (),
    first_ever: DataFrame | None = None,
) -> DataFrame:
    """Buyers per context and day of their first purchase ever, with ``is_new``.

    ``keep`` is the part of ``by`` whose filter also holds for the past purchases (a
    payment method, a gender), while filters on event, ticket and date do not. The first
    date of a context counts orders of any status. ``first_ever`` is given where the
    contexts do not hold all purchases.

    ``buyers`` and the sums are taken per day before the start of the context is joined.
    So also a context with a third of all customers is only as many rows as there are
    days, and is combined on the map side.
    """
    sums = [c for c in contexts.columns if c in SUMS]
    if first_ever is None:
        first_ever = first_purchases(contexts, keep)
    days = (
        contexts.where("first_bought IS NOT NULL")
        .join(first_ever, ["customerID", *keep])
        .groupBy(*by, "first_ever")
        .agg(F.count(F.lit(1)).alias("buyers"), *[F.sum(c).alias(c) for c in sums])
    )
    start = F.min("first_order").alias("context_start")
    if by:
        dated = days.join(contexts.groupBy(*by).agg(start), list(by))
    else:
        dated = days.withColumn("context_start", contexts.agg(start).scalar())
    return dated.withColumn("is_new", F.col("first_ever") >= F.col("context_start"))


def _is(kind: str) -> Column:
    if kind not in ("new", "repeat"):
        raise ValueError(f"unknown kind {kind!r}")
    return F.col("is_new") if kind == "new" else ~F.col("is_new")


def _count_columns() -> list[Column]:
    return [
        F.sum(F.when(_is("new"), F.col("buyers"))).alias("new_customers"),
        F.sum(F.when(_is("repeat"), F.col("buyers"))).alias("repeat_customers"),
        F.sum("buyers").alias("total_customers"),
    ]


def _value_columns() -> list[Column]:
    profit = F.col("s_gross") - F.col("s_discount")
    amounts = {"value": profit, "tickets": F.col("s_tickets"), "discount": F.col("s_discount")}
    split = [
        F.sum(F.when(_is(kind), c)).alias(f"{kind}_{name}")
        for kind in ("new", "repeat")
        for name, c in amounts.items()
    ]
    return split + [F.sum(c).alias(f"total_{name}") for name, c in amounts.items()]


def cohort_counts(
    contexts: DataFrame, by: Sequence[str], keep: Sequence[str] = (), first_ever: DataFrame | None = None
) -> DataFrame:
    """``new_customers``, ``repeat_customers`` and ``total_customers`` per context.

    A context without buyers has no row: its counts are absent, not zero.
    """
    return tagged_buyers(contexts, by, keep, first_ever).groupBy(*by).agg(*_count_columns())


def cohort_value(
    contexts: DataFrame, by: Sequence[str], keep: Sequence[str] = (), first_ever: DataFrame | None = None
) -> DataFrame:
    """Profit, tickets and discount of new and of repeat customers per context.

    Only the event filter is lifted for past purchases: pass ticket columns that are part
    of ``by`` in ``keep`` as well.
    """
    return tagged_buyers(contexts, by, keep, first_ever).groupBy(*by).agg(*_value_columns())


def cohort_summary(
    contexts: DataFrame, by: Sequence[str], keep: Sequence[str] = (), first_ever: DataFrame | None = None
) -> DataFrame:
    """Counts and values together, for contexts without ticket columns."""
    tagged = tagged_buyers(contexts, by, keep, first_ever)
    return tagged.groupBy(*by).agg(*_count_columns(), *_value_columns())


def period_cohort_value(
    contexts: DataFrame, by: Sequence[str], period: str, period_start: Column, earliest: DataFrame | None = None
) -> DataFrame:
    """Profit of customers without any earlier order, of any status, before the period.

    ``contexts`` are by ``by`` and ``period``. Unlike ``cohort_value`` the filters in
    ``by`` hold for the earlier orders too, and the bound is the first calendar date of
    the period (an expression over ``contexts``) instead of the first order in it.
    ``earliest`` (per customer and ``by``) is given where the contexts do not hold all orders.
    """
    if earliest is None:
        earliest = contexts.groupBy("customerID", *by).agg(F.min("first_order").alias("earliest"))
    # Only what the sum takes goes through the join.
    profit = (F.col("s_gross") - F.col("s_discount")).alias("profit")
    fresh = contexts.select("customerID", *by, period, period_start.alias("start"), profit)
    return (
        fresh.join(earliest, ["customerID", *by])
        .where(F.col("earliest") >= F.col("start"))
        .groupBy(*by, period)
        .agg(F.sum("profit").alias("total_new_customers_value"))
    )


def avg_new_customer_value(
    contexts: DataFrame,
    by: Sequence[str],
    period: str,
    period_start: Column,
    first_ever: DataFrame | None = None,
    earliest: DataFrame | None = None,
) -> DataFrame:
    """Value of new customers in the period divided by the number of new customers."""
    value = period_cohort_value(contexts, by, period, period_start, earliest)
    counts = cohort_counts(contexts, [*by, period], first_ever=first_ever).select(*by, period, "new_customers")
    return counts.join(value, [*by, period], "full").withColumn(
        "avg_new_customers_value",
        divide(F.col("total_new_customers_value"), F.col("new_customers"), 0),
    )


def new_customers_by_day(fact: DataFrame) -> DataFrame:
    """Per date: customers who buy for the first time, those who order for the first time
    (``starters``), and the profit of the latter on that day.

    The context is the day itself, so only the first dates of each customer count. Rows are
    summed per customer and day, then per customer; nothing of that is written.
    """
    known = fact.where("customerID IS NOT NULL AND creationDate IS NOT NULL")
    days = (
        with_amounts(known)
        .groupBy("customerID", "creationDate")
        .agg(*[SUMS[s]().alias(s) for s in ("n_ok", "s_gross", "s_discount")])
    )
    profit = (F.col("s_gross") - F.col("s_discount")).alias("profit")
    firsts = days.groupBy("customerID").agg(
        F.min(F.struct(F.col("creationDate").alias("date"), profit)).alias("start"),
        F.min(F.when(F.col("n_ok") > 0, F.col("creationDate"))).alias("bought"),
    )
    # Both dates of a customer as rows, so that the customers are formed once.
    either = F.array(
        F.struct(F.col("start.date").alias("date"), F.lit(True).alias("starts")),
        F.struct(F.col("bought").alias("date"), F.lit(False).alias("starts")),
    )
    dated = firsts.select(F.explode(either).alias("e"), "start.profit").select("e.*", "profit")
    return (
        dated.where("date IS NOT NULL")
        .groupBy("date")
        .agg(
            F.sum(F.when(~F.col("starts"), 1)).alias("new_customers"),
            F.sum(F.when(F.col("starts"), 1)).alias("starters"),
            F.sum(F.when(F.col("starts"), F.col("profit"))).alias("total_new_customers_value"),
        )
    )


def new_users(customers: DataFrame, period: Column, name: str) -> DataFrame:
    """Accounts per creation period."""
    return customers.groupBy(period.alias(name)).agg(F.count_distinct("id").alias("new_users"))


def new_users_who_purchased(
    fact: DataFrame, customers: DataFrame, bought_in: Column, created_in: Column, name: str
) -> DataFrame:
    """Accounts that bought in the very period in which they were created."""
    buyers = fact.where(is_ok()).select(F.col("customerID").alias("id"), bought_in.alias(name))
    accounts = customers.select("id", created_in.alias(name))
    both = buyers.distinct().join(accounts, ["id", name], "left_semi")
    return both.groupBy(name).agg(F.count(F.lit(1)).alias("new_users_who_purchased"))


def share_against(df: DataFrame, part: str, whole: str, name: str) -> DataFrame:
    """``part`` as a share of the greater of ``part`` and ``whole``."""
    return df.withColumn(name, divide(F.col(part), F.greatest(F.col(part), F.col(whole))))


def new_vs_repeat(counts_and_values: DataFrame) -> DataFrame:
    """Shares of new and repeat customers in count, value, tickets and discount.

    ``*_sign`` is 1 where the new ones are ahead, -1 where the repeat ones are, else 0.
    """
    out = counts_and_values
    for name in ("customers", "value", "tickets", "discount"):
        for kind in ("new", "repeat"):
            out = share_against(out, f"{kind}_{name}", f"total_{name}", f"{kind}_{name}_share")
        new = F.coalesce(F.col(f"new_{name}"), F.lit(0))
        repeat = F.coalesce(F.col(f"repeat_{name}"), F.lit(0))
        out = out.withColumn(f"{name}_sign", F.signum((new - repeat).cast("double")).cast("int"))
    return out


def metric_by_gender(
    fact: DataFrame, customers: DataFrame, sum_name: str, by: Sequence[str]
) -> DataFrame:
    """A base sum split into ``female`` and ``male`` per group, with the total.

    Orders are summed per customer first; only those sums meet the customer table.
    """
    per_customer = with_amounts(fact).groupBy(*by, "customerID").agg(SUMS[sum_name]().alias("v"))
    people = customers.select(F.col("id").alias("customerID"), "gender")
    return (
        per_customer.join(people, "customerID", "left")
        .groupBy(*by)
        .agg(
            F.sum(F.when(F.col("gender") == "Female", F.col("v"))).alias("female"),
            F.sum(F.when(F.col("gender") == "Male", F.col("v"))).alias("male"),
            F.sum("v").alias("total"),
        )
    )


def measures_by_gender(
    fact: DataFrame, customers: DataFrame, metrics: Sequence[str], by: Sequence[str]
) -> DataFrame:
    """Measures per group as rows: metric, ``female``, ``male``, ``total`` and both shares.

    The metrics are those whose sums can be added up. All their sums are taken once per
    customer; the sums of each gender, and of customers of neither, are finished into measures on their own,
    so that measures such as profit need no column of theirs in the fact.
    """
    per_customer = base_sums(fact, metrics, [*by, "customerID"])
    sums = [c for c in per_customer.columns if c in SUMS]
    people = customers.select(F.col("id").alias("customerID"), "gender")
    split = add_up(per_customer.join(people, "customerID", "left"), [*by, "gender"])
    whole = [F.sum(c).alias(c) for c in sums]
    sides = {
        "female": [F.sum(F.when(F.col("gender") == "Female", F.col(c))).alias(c) for c in sums],
        "male": [F.sum(F.when(F.col("gender") == "Male", F.col(c))).alias(c) for c in sums],
        "total": whole,
    }
    wide = split.groupBy(*by).agg(*[F.struct(*columns).alias(side) for side, columns in sides.items()])
    values = F.array(
        *[
            F.struct(
                F.lit(name).alias("metric"),
                *[
                    MEASURES[name].value({c: F.col(side)[c] for c in sums}).cast("double").alias(side)
                    for side in sides
                ],
            )
            for name in metrics
        ]
    )
    long = wide.select(*by, F.explode(values).alias("m")).select(*by, "m.*")
    long = share_against(long, "female", "total", "female_share")
    return share_against(long, "male", "total", "male_share")
