"""One row per key.

Both operators use ``row_number() = 1``, which Spark cuts down on the map side (a window
group limit) before the shuffle: a key that holds a third of all rows sends one row per
task, not its whole group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def keep_first(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column] | None = None
) -> DataFrame:
    """The first row of each key.

    Stored rows have no order of their own, so ``order`` says which one is first; by
    default all columns ascending. Null keys form one group.
    """
    order = order or [F.col(c).asc_nulls_first() for c in df.columns]
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).where("_place = 1").drop("_place")


def keep_latest(df: DataFrame, key: str, updated: str) -> DataFrame:
    """The most recently updated row of each non-null key.

    A row without update time counts as the most recent one. Ties go to the row with the
    greatest other columns.
    """
    rest = [F.col(c).desc_nulls_last() for c in df.columns if c not in (key, updated)]
    known = df.where(F.col(key).isNotNull())
    return keep_first(known, [key], [F.col(updated).desc_nulls_first(), *rest])
