"""Ranks, shares, top lists and bands.

A rank over all events cannot be one window: that would sort the whole list in one task.
``numbered`` ranks with a range partitioning instead, and ``top_n`` finds the value of the
n-th place first.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from boxoffice.functions.numbers import divide
from boxoffice.operators.metrics import finish, max_of, total_of
from boxoffice.session import stable


#: ``monotonically_increasing_id`` has the row's place in its partition in the lower 33 bits.
_PLACE_BITS = 33


def _placed(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """``df`` in ranges of the order, written once, with the place of each row in ``_at``.

    Range borders are sampled once. Each range is put in order by one task, and ``_at`` holds the
    range and the place in it, so nothing that reads the written rows has to sort or move them.
    """
    inside = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return stable(inside.withColumn("_at", F.monotonically_increasing_id()))


def _with_place(placed: DataFrame, name: str) -> DataFrame:
    """Turn ``_at`` into places 1, 2, 3, ... over all ranges."""
    place = F.col("_at").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)) + 1
    # One row per shuffle partition, so this window is as small as the cluster.
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(F.shiftright("_at", _PLACE_BITS).alias("_range"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    return (
        placed.withColumn("_range", F.shiftright("_at", _PLACE_BITS))
        .join(F.broadcast(offsets), "_range")
        .withColumn(name, (F.col("_before") + place).cast("long"))
        .drop("_range", "_before", "_at")
    )


def numbered(df: DataFrame, order: Sequence[Column], name: str = "place") -> DataFrame:
    """Number the rows 1, 2, 3, ... in the given order, in parallel.

    Rows are range-partitioned, numbered inside each range, and shifted by the sizes of
    the ranges before it. The placement is written once, so that both uses see the same
    one. Equal sort keys land in one range: make the order total.
    """
    return _with_place(_placed(df, order), name)


def rank_by(df: DataFrame, metric: str, name: str, rank: str = "rank") -> DataFrame:
    """Dense rank by ``metric`` descending, then ``name`` ascending; no value ranks last.

    ``df`` has one row per ``name``, so the order is total and dense ranks are places.
    """
    return numbered(df, [F.col(metric).desc_nulls_last(), F.col(name).asc()], rank)


def rank_within(
    df: DataFrame, metric: str, name: str, keys: Sequence[str], rank: str = "rank"
) -> DataFrame:
    """Dense rank by ``metric`` descending, then ``name``, inside each ``keys`` group.

    ``df`` has one row per ``keys`` and ``name``. The rows of all groups are numbered in
    one order; the rank is the distance to the first place of the group. So a group with
    much of the list is spread over several ranges like any other part of it. An absent
    key is a group like any other.
    """
    order = [F.col(k).asc() for k in keys]
    order += [F.col(metric).desc_nulls_last(), F.col(name).asc()]
    return _from_first(numbered(df, order, "_place"), keys, rank)


def _from_first(placed: DataFrame, keys: Sequence[str], rank: str) -> DataFrame:
    """Replace ``_place`` by the distance to the first place of the row's group, from 1."""
    first = placed.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.min("_place").alias("_first"))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    distance = (F.col("_place") - F.col("_first") + 1).alias(rank)
    return placed.join(first, same).select(*[c for c in placed.columns if c != "_place"], distance)


def _one_per_metric(df: DataFrame, metrics: Sequence[str], keep: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """A row per metric and row of ``df``: ``keep``, the metric's position, and its value.

    The value stands in the column of its own type, ``_v0``, ``_v1``, ..., since a common type
    could make different values equal. Returns the frame and the names of these columns.
    """
    types = list(dict.fromkeys(df.schema[m].dataType for m in metrics))
    slots = [f"_v{i}" for i in range(len(types))]
    entries = []
    for i, m in enumerate(metrics):
        own = [F.when(F.lit(df.schema[m].dataType == t), F.col(m)).otherwise(F.lit(None)).cast(t).alias(s) for s, t in zip(slots, types)]
        entries.append(F.struct(F.lit(i).alias("_metric"), *own))
    return df.select(*keep, F.inline(F.array(*entries))), slots


def _named_values(ranked: DataFrame, metrics: Sequence[str], slots: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """``metric`` by name and ``value`` as a double, from position and typed value."""
    names = F.array(*[F.lit(m) for m in metrics])
    value = F.coalesce(*[F.col(s).cast("double") for s in slots])
    return ranked.select(F.get(names, F.col("_metric")).alias("metric"), *keep, value.alias("value"), "rank")


def _value_order(slots: Sequence[str]) -> list[Column]:
    # Of one metric all values stand in one slot, so the others do not change its order.
    return [F.col(s).desc_nulls_last() for s in slots]


def rank_metrics(df: DataFrame, metrics: Sequence[str], name: str) -> DataFrame:
    """``rank_by`` for several metrics: metric, ``name``, value (double), rank.

    ``df`` has one row per ``name``. The rows of all metrics are put in order by one exchange
    and written once, however many metrics there are. Ranks follow the exact values.
    """
    long, slots = _one_per_metric(df, metrics, [name])
    placed = _placed(long, [F.col("_metric"), *_value_order(slots), F.col(name).asc()])
    # Where each metric begins: one row per metric, so the join is small on that side.
    numbers = _with_place(placed, "_place")
    return _named_values(_after_metric(numbers, placed), metrics, slots, [name])


def _after_metric(numbers: DataFrame, placed: DataFrame) -> DataFrame:
    """Ranks from places: every metric's rows follow those of the metrics before it."""
    before = Window.orderBy("_metric").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("_metric")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_metric", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    )
    joined = numbers.join(F.broadcast(starts), "_metric")
    return joined.withColumn("rank", F.col("_place") - F.col("_start")).drop("_place", "_start")


def hierarchical_ranks(inner: DataFrame, sums: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Events ranked among events and distances inside their event, for several metrics.

    ``inner`` has base sums by ``eventName`` and ``distance``. Returns metric, level (0 for
    events, 1 for distances), eventName, distance, value (double), rank; event rows have no
    distance. Both levels of all metrics are numbered in one order, written once.
    """
    event_sums = inner.groupBy("eventName").agg(*[F.sum(s).alias(s) for s in sums])
    events = finish(event_sums, metrics).withColumn("distance", F.lit(None).cast("string"))
    levels = events.withColumn("level", F.lit(0)).unionByName(finish(inner, metrics).withColumn("level", F.lit(1)))
    keep = ["level", "eventName", "distance"]
    long, slots = _one_per_metric(levels, metrics, keep)
    group = F.when(F.col("level") == 1, F.col("eventName"))
    member = F.when(F.col("level") == 1, F.col("distance")).otherwise(F.col("eventName"))
    order = [F.col("_metric"), F.col("level"), group.asc(), *_value_order(slots), member.asc()]
    numbers = _with_place(_placed(long, order), "_place")
    # All events of a metric are one group: their first place is one row, not a key to join on.
    tops = numbers.where("level = 0")
    first = tops.groupBy("_metric").agg(F.min("_place").alias("_first"))
    ranked = tops.join(F.broadcast(first), "_metric").withColumn("rank", F.col("_place") - F.col("_first") + 1)
    below = _from_first(numbers.where("level = 1"), ["_metric", "eventName"], "rank")
    both = ranked.drop("_place", "_first").unionByName(below)
    return _named_values(both, metrics, slots, keep)


def hierarchical_rank(inner: DataFrame, sums: Sequence[str], metric: str) -> DataFrame:
    """``hierarchical_ranks`` of one metric: eventName, distance, the metric, rank."""
    both = hierarchical_ranks(inner, sums, [metric])
    return both.select("eventName", "distance", F.col("value").alias(metric), "rank")


def share(
    df: DataFrame,
    metric: str,
    parent: Sequence[str] = (),
    name: str = "share",
    empty: float | None = None,
) -> DataFrame:
    """``metric`` divided by its total over the rows with the same ``parent``.

    ``empty`` is the share where that total is absent or zero; by default there is none.
    """
    return total_of(df, metric, parent, "_total").select(
        *df.columns, divide(F.col(metric), F.col("_total"), empty).alias(name)
    )


def hierarchical_share(inner: DataFrame, sums: Sequence[str], metric: str) -> DataFrame:
    """Share of each event in all events, and of each distance in its event.

    Only rows with completed orders have a share.
    """
    wanted = [metric, "complete_orders"] if metric != "complete_orders" else [metric]
    event_sums = inner.groupBy("eventName").agg(*[F.sum(s).alias(s) for s in sums])
    events = share(finish(event_sums, wanted), metric, empty=0)
    distances = share(finish(inner, wanted), metric, ["eventName"], empty=0)
    both = events.withColumn("distance", F.lit(None).cast("string")).unionByName(distances)
    return both.select(
        "eventName",
        "distance",
        metric,
        F.when(F.col("complete_orders").isNotNull(), F.col("share")).alias("share"),
    )


def top_n(df: DataFrame, metric: str, n: int) -> DataFrame:
    """The ``n`` greatest rows, with all rows tied at the last place.

    The value at place ``n`` comes from a distributed top-n; rows at or above it are kept
    by a filter, however many there are.
    """
    highest = df.where(F.col(metric).isNotNull()).select(metric).orderBy(F.col(metric).desc())
    bound = highest.limit(n).agg(F.min(metric)).scalar()
    return df.where(F.col(metric) >= bound)


#: So many values at most are put in order in one task, and the accuracy of a narrowing round.
_FEW, _ACCURACY = 1 << 16, 10_000


def nth_value(values: DataFrame, place: int, rows: int, few: int = _FEW, accuracy: int = _ACCURACY) -> float:
    """The value at ``place`` (from 1) of the ``rows`` doubles in column ``v``, found by selection.

    A sketch gives two pivots close below and above the place. The rows under, between, over and equal to
    them are counted, and the next round looks at the part with the place, without the pivots. As a
    rule that leaves some four in ``accuracy`` of the rows a round, however the values lie; ``few``
    that are left are put in order in one task. Rows are never sorted or moved before that.
    """
    v, slack = F.col("v"), 2 / accuracy
    while rows > few:
        wanted = [max(0.0, place / rows - slack), min(1.0, place / rows + slack)]
        lo, hi = values.agg(F.percentile_approx("v", wanted, accuracy)).first()[0]
        tests = [v < lo, v == lo, (v > lo) & (v < hi), (v == hi) & (v > lo)]
        sizes = list(values.agg(*[F.count_if(t) for t in tests]).first())
        sizes.append(rows - sum(sizes))
        part = 0
        while place > sizes[part]:
            place -= sizes[part]
            part += 1
        if part in (1, 3):
            return lo if part == 1 else hi
        values, rows = values.where([*tests, v > hi][part]), sizes[part]
    return values.agg(F.get(F.sort_array(F.collect_list("v")), F.lit(place - 1))).first()[0]


def median_of(df: DataFrame, metric: str, few: int = _FEW, accuracy: int = _ACCURACY) -> DataFrame:
    """The exact median of ``metric`` over all rows that have a value; NaN is none.

    ``df`` is read some times (see ``nth_value``), so write one that is costly to compute.
    """
    v, name = F.col("v"), f"median_{metric}"
    values = df.select(F.col(metric).cast("double").alias("v")).where("v IS NOT NULL AND NOT isnan(v)")
    rows = values.count()
    if not rows:
        return values.agg(F.min("v").alias(name))
    low = nth_value(values, (rows + 1) // 2, rows, few, accuracy)
    if rows % 2:
        return values.where(v == low).agg(F.min("v").alias(name))
    # The other middle row is equal, or the next greater one.
    upper = F.when(F.count_if(v <= low) > rows // 2, F.lit(low)).otherwise(F.min(F.when(v > low, v)))
    return values.agg(((upper + F.lit(low)) / 2).alias(name))


def above_average(df: DataFrame, metric: str) -> DataFrame:
    """Mean of ``metric`` over the rows, and whether a row reaches it after rounding.

    The rows are written, so that what they are computed from is read once.
    """
    df = stable(df)
    mean = df.agg(F.avg(metric)).scalar()
    return df.withColumn("average", mean).withColumn(
        "above_average", (F.round(metric, 0) >= F.round("average", 0)).cast("int")
    )


def margin_band(margin: Column) -> Column:
    """The legend segment of a profit margin."""
    return (
        F.when(margin >= 0.8, ">= 80%").when(margin >= 0.6, "60% - 69%").when(margin < 0.6, "< 60%")
    )


def scatter_segments(margin: Column, above: Column) -> list[Column]:
    """Legend positions of a margin and of an above-average flag."""
    return [
        F.when(margin >= 0.8, 1).when(margin >= 0.6, 2).otherwise(3).alias("margin_segment"),
        F.when(above == 1, 4).otherwise(5).alias("value_segment"),
    ]


def is_group_max(df: DataFrame, metric: str, keys: Sequence[str] = ()) -> DataFrame:
    """Flag the rows whose metric is the greatest of their group."""
    top = max_of(df, metric, keys, "_top")
    same = (F.col(metric) == F.col("_top")).cast("int")
    return top.withColumn("is_max", F.coalesce(same, F.lit(0))).drop("_top")


def are_group_max(df: DataFrame, metrics: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """``is_max_<metric>`` for several metrics, with one join for all of their maxima.

    ``df`` is used twice: write one that is costly to compute. A null key is a group like any other.
    """
    tops = df.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(*[F.max(c).alias(f"_top_{c}") for c in metrics])
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    flags = [F.coalesce((F.col(c) == F.col(f"_top_{c}")).cast("int"), F.lit(0)).alias(f"is_max_{c}") for c in metrics]
    return df.join(tops, same).select(*df.columns, *flags)


def latest_months(fact: DataFrame, by: Sequence[str], n: int = 2) -> DataFrame:
    """Number of months with orders, and the names of the latest ``n``, newest first."""
    first = F.trunc("creationDate", "month")
    months = fact.select(*by, first.alias("month")).distinct()
    newest = Window.partitionBy(*by).orderBy(F.col("month").desc())
    placed = months.withColumn("place", F.row_number().over(newest))
    label = F.when(F.col("place") <= n, F.date_format("month", "MMMM yyyy"))
    listed = placed.select(*by, "place", label.alias("label"))
    in_order = F.array_sort(
        F.collect_list(F.when(F.col("label").isNotNull(), F.struct("place", "label")))
    )
    return listed.groupBy(*by).agg(
        F.count(F.lit(1)).alias("months"),
        F.array_join(in_order.getField("label"), ", ").alias("latest"),
    )


def sparkline_points(
    series: DataFrame, value: str, by: Sequence[str], width: int = 120, height: int = 40
) -> DataFrame:
    """``x,y`` points of each group's series in date order, scaled to a box.

    A group has at most one point per calendar day, so its text has a fixed bound.
    """
    v = F.col(value).cast("double")
    ends = series.groupBy(*by).agg(
        F.min("date").alias("d0"),
        F.max("date").alias("d1"),
        F.min(v).alias("v0"),
        F.max(v).alias("v1"),
    )
    x = F.floor(
        width * divide(F.date_diff("date", "d0"), F.date_diff("d1", "d0"))
    )
    y = F.floor(height * divide(F.col("v") - F.col("v0"), F.col("v1") - F.col("v0")))
    point = F.concat(
        F.coalesce(F.col("x").cast("string"), F.lit("")),
        F.lit(","),
        (F.lit(height) - F.coalesce(F.col("y"), F.lit(0))).cast("string"),
    )
    return (
        series.withColumn("v", v)
        .join(ends, list(by))
        .select(*by, "date", x.alias("x"), y.alias("y"))
        .groupBy(*by)
        .agg(
            F.array_join(
                F.array_sort(F.collect_list(F.struct("date", point.alias("p")))).getField("p"), " "
            ).alias("points")
        )
    )


def target_progress(df: DataFrame, actual: str, target: str) -> DataFrame:
    """Actual and target as shares of the greater of both."""
    top = F.greatest(F.col(actual), F.col(target))
    return df.select(
        "*",
        divide(F.col(actual), top).alias("actual_fill"),
        divide(F.col(target), top).alias("target_mark"),
    )
