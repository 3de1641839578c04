"""Exact distinct counts by bitmaps, which can be merged to coarser groups.

Several distinct counts in one aggregation multiply the rows before the first shuffle, and a count by
event says nothing about the count over all events. Here the ids of a group are bits: an id gives the
number of a bitmap and a place in it, one aggregation sets the bits and takes all sums on the way, and a
coarser group joins the bitmaps of its parts. So the fact is read once for all levels of a
hierarchy.

A bitmap covers 8,192 neighbouring ids and is kept as the list of its places that are set, two bytes each:
before the first shuffle most groups have a few ids in a task, and 4 KB for each of them would fill the
memory of the tasks that sort them. A group needs no more bitmaps than it has ids, and fewer if its ids
lie close together; ``dense_ids`` numbers those that do not. Bitmaps of one group lie in different tasks; a
group with a third of all rows is one row per map task and bitmap.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxoffice.operators.metrics import DISTINCT_IDS, SUMS, finish, needed_sums, with_amounts
from boxoffice.operators.ranking import numbered
from boxoffice.session import stable


# Ids to a bitmap, as a power of two. It bounds what a task holds for one group: at most so many places.
_WIDTH = 13


def dense_ids(df: DataFrame, column: str, name: str) -> DataFrame:
    """The distinct values of ``column`` with numbers ``name`` from 1 on, without gaps."""
    return numbered(df.select(column).dropna().distinct(), [F.col(column).asc()], name)


def bitmaps(
    df: DataFrame, counted: Mapping[str, Column], by: Sequence[str], sums: Mapping[str, Column]
) -> DataFrame:
    """``by``, the sums, and per counted name the number ``_at`` of a bitmap and the places set in it, ``_bits``.

    A group has a row for each combination of bitmap numbers it needs. A null id sets no bit.
    """
    ids = {name: c.cast("bigint") for name, c in counted.items()}
    at = [F.shiftright(c, _WIDTH).alias(f"{name}_at") for name, c in ids.items()]
    place = {name: c.bitwiseAND(F.lit((1 << _WIDTH) - 1)).cast("smallint") for name, c in ids.items()}
    bits = [F.collect_set(c).alias(f"{name}_bits") for name, c in place.items()]
    return df.groupBy(*by, *at).agg(*[c.alias(n) for n, c in sums.items()], *bits)


def merged(parts: DataFrame, names: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Sums and distinct counts of coarser groups from ``bitmaps``; ``parts`` should be written."""
    sums = [c for c in parts.columns if c in SUMS]
    out = parts.groupBy(*by).agg(F.count(F.lit(1)).alias("_parts"), *[F.sum(c).alias(c) for c in sums])
    for name in names:
        places = parts.select(*by, f"{name}_at", F.explode(f"{name}_bits").alias("_place"))
        joined = places.groupBy(*by, f"{name}_at").agg(F.size(F.collect_set("_place")).alias("n"))
        if not by:
            out = out.withColumn(name, F.coalesce(joined.agg(F.sum("n")).scalar(), F.lit(0)))
            continue
        counts = joined.groupBy(*[F.col(k).alias(f"_{k}") for k in by]).agg(F.sum("n").alias(name))
        same = F.lit(True)
        for k in by:
            same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
        out = out.join(counts, same, "left").drop(*[f"_{k}" for k in by]).withColumn(name, F.coalesce(name, F.lit(0)))
    return out.drop("_parts")


def kpi_levels(
    fact: DataFrame, metrics: Sequence[str], levels: Sequence[Sequence[str]]
) -> DataFrame:
    """The measures for each of several groupings, from one pass over the fact.

    All grouping columns, null where a level does not group by them, then ``level`` (its number in
    ``levels``) and the measures. Any measure can be asked for, those with distinct counts included.
    """
    columns = list(dict.fromkeys(c for level in levels for c in level))
    needed = needed_sums(metrics)
    counted = {n: DISTINCT_IDS[n]() for n in needed if n in DISTINCT_IDS}
    sums = {n: SUMS[n]() for n in needed if n in SUMS}
    parts = stable(bitmaps(with_amounts(fact), counted, columns, sums))
    out = None
    for number, level in enumerate(levels):
        rows = finish(merged(parts, list(counted), level), metrics)
        keys = [F.col(c) if c in level else F.lit(None).cast(parts.schema[c].dataType).alias(c) for c in columns]
        rows = rows.select(*keys, F.lit(number).alias("level"), *metrics)
        out = rows if out is None else out.unionByName(rows)
    return out
