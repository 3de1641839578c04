"""What changed between two states of a table, and loads that write no more than that.

A dump is always whole, but from one night to the next few of its rows differ. Both states are
reduced to one row per key with two sums: of signs (new rows count 1, old ones -1) and of signed row
hashes. A key is unchanged if both are zero. This takes one shuffle of one small row per key and task, with no
join of the two states, and a key may have any number of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxoffice.session import stable
from boxoffice.sources.sinks import add_version, current_table, loads

#: A table is written whole again once its changes hold this share of its rows.
COMPACT_AT = 0.5


def changed_keys(old: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """The keys whose rows differ between ``old`` and ``new``, as sets with counts.

    Keys that came or went are among them. Null keys are keys like any other. Rows are compared
    by 128 bits of hash over all columns of ``new``.
    """
    columns = sorted(new.columns)

    def signed(df: DataFrame, sign: int) -> DataFrame:
        hashes = [
            (F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in columns]).cast("decimal(20,0)") * sign).alias(f"_h{seed}")
            for seed in (1, 2)
        ]
        return df.select(*key, F.lit(sign).alias("_sign"), *hashes)

    totals = signed(new, 1).unionByName(signed(old.select(*new.columns), -1)).groupBy(*key)
    totals = totals.agg(*[F.sum(c).alias(c) for c in ("_sign", "_h1", "_h2")])
    return totals.where("_sign <> 0 or _h1 <> 0 or _h2 <> 0").select(*key)


def _match(columns: Sequence[str]) -> Column:
    pairs = [F.col(f"`{c}`").eqNullSafe(F.col(f"_touched_{i}")) for i, c in enumerate(columns)]
    return reduce(lambda a, b: a & b, pairs)


def touched(df: DataFrame, columns: str | Sequence[str], keys: DataFrame) -> DataFrame:
    """The rows of ``df`` whose ``columns`` are one of ``keys``; null equals null."""
    columns = [columns] if isinstance(columns, str) else list(columns)
    named = keys.toDF(*[f"_touched_{i}" for i in range(len(columns))])
    return df.join(named, _match(columns), "left_semi")


def all_keys(*frames: DataFrame, names: Sequence[str]) -> DataFrame:
    """The distinct union of key frames, written, as several rebuilds go by it."""
    return stable(reduce(DataFrame.union, [f.toDF(*names) for f in frames]).distinct())


def replace_keys(
    rows: DataFrame,
    changed: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    verify: Callable[[], None] | None = None,
) -> int:
    """Put ``rows``, which are all rows of the ``changed`` keys, over the table; returns the rows written.

    Once the changes since the last full version add up to much of it, the result is written
    as a full version, which readers then need not put together.
    """
    spark = rows.sparkSession
    done = add_version(rows, path, partition_by, verify, changed)
    entries = loads(spark, path)
    last_full = max(i for i, r in enumerate(entries) if r["kind"] == "full")
    if sum(r["rows"] for r in entries[last_full + 1 :]) > COMPACT_AT * entries[last_full]["rows"]:
        add_version(current_table(spark, path), path, partition_by)
    return done


def merge_load(
    new: DataFrame,
    path: str,
    key: Sequence[str],
    partition_by: Sequence[str] = (),
    verify: Callable[[], None] | None = None,
) -> tuple[int, DataFrame]:
    """Bring the table at ``path`` to the rows of ``new``; returns rows written and changed keys.

    ``new`` is read twice, for the comparison and for the rows of the changed keys, and never
    written whole, except by the first load.
    """
    spark = new.sparkSession
    if not loads(spark, path):
        written = add_version(new, path, partition_by, verify)
        return written, current_table(spark, path).select(*key).distinct()
    changed = stable(changed_keys(current_table(spark, path), new, key))
    return replace_keys(touched(new, key, changed), changed, path, partition_by, verify), changed
