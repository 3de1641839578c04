"""Period comparisons, running totals, moving averages and date markers.

Comparisons are made for the dates of the calendar, not of the fact: a day or month without
rows shows what it is compared with, and is left out only if that is absent as well.

Windows appear only over series that are already aggregated to days or months. Such a
series has at most one row per calendar day and group, whatever the size of the fact, so
also a window without partition keys sorts a few thousand rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from boxoffice.functions.dates import month_index, shift_date
from boxoffice.functions.labels import CARD_TEXTS, SINCE, arrow, card_label, card_parts
from boxoffice.functions.numbers import difference, divide
from boxoffice.operators.metrics import add_up, finish, kpi, max_of


def shift_days(
    daily: DataFrame, calendar: DataFrame, values: Sequence[str], unit: str, n: int, prefix: str
) -> DataFrame:
    """Each calendar date with its values and those of the date ``n`` units away.

    ``daily`` has one row per ``date``. Dates that have none of ``values``, neither of
    their own nor of the other date, are left out.
    """
    before = daily.select(
        F.col("date").alias("_then"), *[F.col(v).alias(f"{prefix}{v}") for v in values]
    )
    then = shift_date(F.col("date"), unit, n)
    dense = calendar.select("date").join(daily, "date", "left")
    moved = dense.join(before, then == F.col("_then"), "left").drop("_then")
    known = [F.col(name).isNotNull() for v in values for name in (v, f"{prefix}{v}")]
    return moved.where(F.greatest(*known))


def shift_period(
    sums: DataFrame,
    calendar: DataFrame,
    period: Sequence[str],
    metrics: Sequence[str],
    unit: str,
    n: int,
    by: Sequence[str] = (),
) -> DataFrame:
    """Measures of each period, with its dates moved by ``n`` units.

    The set of dates is moved and the measures are computed again from base sums; a ratio
    is never moved as a number. Two dates that move to the same one count once, and dates
    outside the calendar are dropped. ``sums`` are base sums by ``by`` and ``date``.
    """
    days = calendar.select("date")
    bridge = (
        calendar.select(*period, shift_date(F.col("date"), unit, n).alias("date"))
        .distinct()
        .join(days, "date", "left_semi")
    )
    moved = sums.join(F.broadcast(bridge), "date")
    return finish(add_up(moved, [*period, *by]), metrics)


def previous_month(
    monthly: DataFrame, calendar: DataFrame, values: Sequence[str], by: Sequence[str] = ()
) -> DataFrame:
    """Each calendar month with its values, those of the month before, and the changes.

    A month without rows follows from the month before it, so no product of months and
    groups is formed. Months outside the calendar, and those without any of ``values`` on
    either side, are left out.

    For each value ``v`` there are ``v_previous``, ``v_change``, ``v_pct`` and ``v_sign``.
    The sign follows the change itself, so a value after an empty month rises by 0 %.
    """
    before = monthly.select(
        *by,
        (F.col("month") + 1).alias("month"),
        *[F.col(v).alias(f"{v}_previous") for v in values],
    )
    months = calendar.select(month_index(F.col("date")).alias("month")).distinct()
    joined = monthly.join(before, [*by, "month"], "full").join(months, "month", "left_semi")
    joined = joined.where(
        F.greatest(*[F.col(name).isNotNull() for v in values for name in (v, f"{v}_previous")])
    )
    out = []
    for v in values:
        change = difference(F.col(v), F.col(f"{v}_previous"))
        out += [
            change.alias(f"{v}_change"),
            divide(change, F.col(f"{v}_previous"), 0).alias(f"{v}_pct"),
            F.signum(F.coalesce(change.cast("double"), F.lit(0.0))).cast("int").alias(f"{v}_sign"),
        ]
    return joined.select("*", *out)


def to_date(daily: DataFrame, value: str, unit: str, by: Sequence[str] = ()) -> DataFrame:
    """Running total of ``value`` since the start of the year or quarter."""
    part = [F.year("date")] + ([F.quarter("date")] if unit == "quarter" else [])
    name = {"year": "ytd", "quarter": "qtd"}[unit]
    running = (
        Window.partitionBy(*by, *part).orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    )
    return daily.withColumn(name, F.sum(value).over(running))


def until_next(series: DataFrame, unit: str, by: Sequence[str] = ()) -> DataFrame:
    """Each row on all days until the next row of its group, or the end of its year or quarter.

    ``unit`` names the period, as for ``to_date``: a running total stays the same on days
    without rows and starts again with the period.
    """
    months = {"year": 12, "quarter": 3}[unit]
    start = F.trunc("date", unit)
    following = F.lead("date").over(Window.partitionBy(*by, start).orderBy("date"))
    until = F.coalesce(following, F.add_months(start, months))
    days = F.explode(F.sequence("date", F.date_sub("_until", 1))).alias("date")
    others = [c for c in series.columns if c != "date"]
    return series.withColumn("_until", until).select(*others, days)


def moving_avg(
    series: DataFrame, value: str, lengths: Sequence[int], unit: str = "day", by: Sequence[str] = ()
) -> DataFrame:
    """Mean of ``value`` over the last N days or months, one column per N.

    ``series`` has the days (``date``) or months (``month``) with fact rows. Periods
    without a value do not count in the mean; periods without fact rows get no row. All
    lengths share one sort.
    """
    place = F.unix_date("date") if unit == "day" else F.col("month")
    out = series
    for n in lengths:
        frame = Window.partitionBy(*by).orderBy(place).rangeBetween(-(n - 1), 0)
        mean = divide(F.sum(value).over(frame), F.count(value).over(frame))
        out = out.withColumn(f"avg_{n}", mean)
    return out


def compare(df: DataFrame, value: str, previous: str) -> DataFrame:
    """Change, percent change and direction of a value against a previous one.

    Absent values count as 0; the percentage is 0 if there is nothing to compare with,
    and the direction follows the percentage.
    """
    change = difference(F.col(value), F.col(previous))
    pct = divide(change, F.col(previous), 0)
    return df.select(
        "*",
        change.alias("change"),
        pct.alias("pct"),
        F.signum(F.coalesce(pct, F.lit(0.0))).cast("int").alias("sign"),
    )


def kpi_comparison(
    daily: DataFrame,
    calendar: DataFrame,
    metrics: Sequence[str],
    previous: dict[str, tuple[str, int]],
) -> DataFrame:
    """All measures against earlier dates, as rows of ``(date, metric, versus, ...)``.

    ``previous`` maps the name of a comparison to its unit and shift. There is a row for
    each calendar date that has a value or a previous one.
    """
    doubles = [F.col(m).cast("double").alias(m) for m in metrics]
    long = daily.select("date", *doubles).unpivot(["date"], list(metrics), "metric", "value")
    shifts = F.explode(
        F.array(
            *[
                F.struct(F.lit(name).alias("versus"), shift_date(F.col("date"), u, n).alias("then"))
                for name, (u, n) in previous.items()
            ]
        )
    )
    every = F.explode(F.array(*[F.lit(name) for name in metrics]))
    axis = calendar.select("date", every.alias("metric")).select("date", "metric", shifts.alias("s"))
    axis = axis.select("date", "metric", "s.versus", "s.then")
    before = long.select(F.col("date").alias("then"), "metric", F.col("value").alias("previous"))
    both = axis.join(long, ["date", "metric"], "left").join(before, ["then", "metric"], "left")
    both = both.where("value IS NOT NULL OR previous IS NOT NULL").drop("then")
    return compare(both, "value", "previous")


def with_card_labels(compared: DataFrame) -> DataFrame:
    """Rows of ``kpi_comparison`` with the label that a card shows."""
    body = F.when(F.lit(False), F.lit(""))
    for metric in CARD_TEXTS:
        for versus in SINCE:
            here = (F.col("metric") == metric) & (F.col("versus") == versus)
            body = body.when(here, card_label(metric, versus))
    parts = card_parts()
    return compared.withColumns(parts).withColumn("label", arrow(F.col("pct"), body)).drop(*parts)


def overall_trend(
    series: DataFrame, value: str, first: dt.date, last: dt.date, by: Sequence[str] = ()
) -> DataFrame:
    """The value on the last date of a selection against the value on its first date.

    ``first`` and ``last`` are calendar dates. A group without rows on one of them has no
    value there; groups without rows in the selection are left out.
    """
    at = [F.col("date") == F.lit(d) for d in (first, last)]
    ends = series.where(F.col("date").between(first, last)).groupBy(*by).agg(
        F.lit(first).alias("first_date"),
        F.lit(last).alias("last_date"),
        F.max(F.when(at[0], F.col(value))).alias("first_value"),
        F.max(F.when(at[1], F.col(value))).alias("last_value"),
    )
    return compare(ends, "last_value", "first_value")


def markers(
    series: DataFrame, value: str, first: dt.date, last: dt.date, by: Sequence[str] = ()
) -> DataFrame:
    """Peak, low and the outer dates of a series, marked on their rows.

    ``first`` and ``last`` are the calendar dates of the selection; they get a row in each
    group even where the series has none. Of several equal peaks or lows the earliest is
    marked. ``upper_line`` is 1.5 times the maximum on the first and last date,
    ``first_marker`` and ``last_marker`` lie at minus half of it.
    """
    v = F.col(value)
    series = series.where(F.col("date").between(first, last))
    known = F.when(v.isNotNull(), F.struct((-v).alias("n"), F.col("date").alias("d")))
    lowest = F.when(v.isNotNull(), F.struct(v.alias("n"), F.col("date").alias("d")))
    ends = series.groupBy(*by).agg(
        F.max(v).alias("max_value"),
        F.min(v).alias("min_value"),
        F.min(known).getField("d").alias("peak_date"),
        F.min(lowest).getField("d").alias("low_date"),
    )
    outer = F.explode(F.array_distinct(F.array(F.lit(first), F.lit(last)))).alias("date")
    rows = series.join(ends.select(*by, outer), [*by, "date"], "full")
    if by:
        joined = rows.join(ends, list(by))
    else:
        end = ends.select(F.struct("*").alias("e")).scalar()
        joined = rows.withColumn("e", end).select("*", "e.*").drop("e")
    date, top = F.col("date"), F.col("max_value").cast("double")
    at_first, at_last = date == F.lit(first), date == F.lit(last)
    return joined.select(
        *series.columns,
        F.when(date == F.col("peak_date"), F.col("max_value")).alias("peak"),
        F.when(date == F.col("low_date"), F.col("min_value")).alias("low"),
        F.when(at_first | at_last, top * 1.5).alias("upper_line"),
        F.when(at_first, top * -0.5).alias("first_marker"),
        F.when(at_last, top * -0.5).alias("last_marker"),
        F.date_format(F.lit(first), "dd/MM/yyyy").alias("first_label"),
        F.date_format(F.lit(last), "dd/MM/yyyy").alias("last_label"),
    )


def last_n_days(
    df: DataFrame,
    n: int,
    date: str = "creationDate",
    zero_is_all: bool = False,
    last: Column | None = None,
) -> DataFrame:
    """Rows from the last date back to ``n`` days before it, both ends included.

    ``last`` may come from elsewhere, as the last purchase for dates of creation; rows after
    it are left out. By default it is the greatest ``date``.
    """
    if zero_is_all and n == 0:
        return df
    if last is None:
        last = df.agg(F.max(date)).scalar()
    return df.where(F.col(date).between(F.date_sub(last, n), last))


def visible_dates(calendar: DataFrame, fact: DataFrame) -> DataFrame:
    """Calendar dates with a flag: does the fact have rows created on that date?"""
    used = fact.select(F.col("creationDateID").alias("dateID")).distinct()
    used = used.withColumn("visible", F.lit(1))
    return (
        calendar.select("dateID", "date")
        .join(used, "dateID", "left")
        .withColumn("visible", F.coalesce("visible", F.lit(0)))
    )


def event_active_dates(fact: DataFrame) -> DataFrame:
    """Every date from an event's first to its last purchase."""
    ends = fact.groupBy("eventID").agg(
        F.min("purchaseDate").alias("first"), F.max("purchaseDate").alias("last")
    )
    return ends.select("eventID", F.explode(F.sequence("first", "last")).alias("date"))


def yoy_bounds(df: DataFrame, value: str, previous: str) -> DataFrame:
    """Upper edges of the rise and the fall of a value against the same date a year ago."""
    v, p = F.col(value), F.col(previous)
    diff = F.when(F.coalesce(v, F.lit(0)) == 0, F.lit(0)).otherwise(difference(v, p))
    return df.select(
        "*",
        F.when(diff > 0, v).otherwise(p).alias("positive_upper"),
        F.when(diff < 0, p).otherwise(v).alias("negative_upper"),
    )


def group_max_scale(
    df: DataFrame, metric: str, keys: Sequence[str], factor: float, name: str = "scale"
) -> DataFrame:
    """The maximum of ``metric`` in each ``keys`` group times ``factor``."""
    top = max_of(df, metric, keys, "_top")
    return top.withColumn(name, F.col("_top").cast("double") * factor).drop("_top")


def heatmap(fact: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Measures by day of week (Monday = 1) and hour of purchase."""
    day = (F.weekday("creationDate") + 1).alias("dayOfWeekInt")
    return kpi(fact, metrics, [day, "todSort"])
