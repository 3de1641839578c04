"""JSON dumps in which one file holds one array of objects.

A dump is read once. Every declared column is read as a variant, which tells an absent key
(no value at all) from a JSON null (a value), and is then cast to its declared type. So the
check for absent keys and the load are one scan. A file is parsed by one task and its records are in
that task's memory together: dumps of large tables should come as many files in one folder.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boxoffice.session import stable


class MissingColumn(ValueError):
    """A declared column is absent from a record."""


def _variants(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    read = T.StructType([T.StructField(name, T.VariantType()) for name in schema.fieldNames()])
    return spark.read.schema(read).option("multiLine", True).option("mode", "FAILFAST").json(path)


def _typed(field: T.StructField) -> Column:
    """The value in its declared type: a JSON null is null, a value that does not fit is an error.

    A text column takes any value: numbers and booleans as text, objects and arrays as JSON.
    """
    return F.variant_get(F.col(f"`{field.name}`"), "$", field.dataType.simpleString()).alias(field.name)


def _absent(name: str) -> Column:
    return F.col(f"`{name}`").isNull()


def missing_columns(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """``(column, records)``: declared columns and the number of records that lack them."""
    counts = [F.struct(F.lit(n).alias("column"), F.count_if(_absent(n)).alias("records")) for n in schema.fieldNames()]
    counted = _variants(spark, path, schema).agg(F.array(*counts).alias("c"))
    return counted.select(F.inline("c")).where("records > 0")


def read_json_array(
    spark: SparkSession, path: str, schema: T.StructType, strict: bool = True
) -> DataFrame:
    """Read array files with a declared schema; other keys are dropped.

    With ``strict`` a record that lacks a declared column fails the job that reads it, and the
    error names the column, whichever columns that job asks for.
    """
    found = _variants(spark, path, schema)
    if strict:
        first = reduce(
            lambda rest, n: F.when(_absent(n), F.lit(n)).otherwise(rest), reversed(schema.fieldNames()), F.lit(None).cast("string")
        )
        message = F.concat(F.lit(f"{path}: a record lacks "), first)
        # A filter that keeps every row it does not fail on: it cannot be pruned like a column.
        found = found.where(F.when(first.isNull(), True).otherwise(F.raise_error(message).cast("boolean")))
    return found.select(*[_typed(f) for f in schema.fields])


class CountedDump:
    """A dump whose absent keys are counted by the very job that reads it.

    ``rows`` is the typed frame. After one action has read it to the end, ``verify`` raises
    MissingColumn if any record lacked a declared column, with the number of such records for each.
    Absent values are nulls in ``rows``: write them where they can be thrown away.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.path, self._seen = path, Observation()
        self._names = {f"lack_{i}": n for i, n in enumerate(schema.fieldNames())}
        counts = [F.count_if(_absent(n)).alias(key) for key, n in self._names.items()]
        observed = _variants(spark, path, schema).observe(self._seen, *counts)
        self.rows = observed.select(*[_typed(f) for f in schema.fields])

    def lacking(self) -> dict[str, int]:
        return {n: self._seen.get[key] for key, n in self._names.items() if self._seen.get[key]}

    def verify(self) -> None:
        lacking = self.lacking()
        if lacking:
            raise MissingColumn(f"{self.path}: records lack {lacking}")


def write_json_arrays(df: DataFrame, path: str, records_per_file: int = 10_000) -> None:
    """Write ``df`` as many gzipped array files of at most ``records_per_file`` records.

    The records are written once, compressed like the files, and cut into blocks by their place in the written files.
    So a block never grows with the data, no key decides its size, and a task that is run
    again after a lost executor cuts the same blocks.
    """
    options = {"ignoreNullFields": "false"}
    record = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), options)
    blocks = (
        stable(df.select(record.alias("record")), "zstd")
        .select(
            "record",
            F.col("_metadata.file_name").alias("file"),
            F.floor(F.col("_metadata.row_index") / records_per_file).alias("block"),
        )
        # A scan task may hold parts of very many blocks, which an aggregation there would sort and spill.
        .repartition("file", "block")
        .groupBy("file", "block")
        .agg(F.array_join(F.collect_list("record"), ",").alias("body"))
        .select(F.concat(F.lit("["), "body", F.lit("]")).alias("value"))
    )
    blocks.write.mode("overwrite").option("maxRecordsPerFile", 1).text(path, compression="gzip")
