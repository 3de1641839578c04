"""Collects the queries; turns results into types that both engines print alike."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boxoffice.catalog.bindings import Tables
from boxoffice.catalog.oracle import sql as with_ctes


@dataclass(frozen=True)
class Entry:
    build: Callable[[Tables], DataFrame]
    sql: str | None

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        return wire(self.build(Tables(spark, folder)))


ENTRIES: dict[str, Entry] = {}


def query(
    name: str, sql: str | None = None, **ctes: str
) -> Callable[[Callable[[Tables], DataFrame]], Callable[[Tables], DataFrame]]:
    """Register a query under ``name``; ``ctes`` are subqueries of its SQL form only."""

    def add(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in ENTRIES:
            raise ValueError(f"{name} is registered twice")
        ENTRIES[name] = Entry(build, with_ctes(sql, **ctes) if sql else None)
        return build

    return add


def wire(df: DataFrame) -> DataFrame:
    """Decimals as doubles, flags as 0 and 1, dates and times as text."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.BooleanType):
            c = c.cast("int")
        elif isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = c.cast("string")
        out.append(c.alias(f.name))
    return df.select(*out)
