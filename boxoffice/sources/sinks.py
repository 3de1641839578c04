"""Writing tables: schema-enforced full replacement, row counts, range partitions.

A table is a folder of versions and a log of loads. A load writes a new version folder to its end
and then adds one row to the log; readers follow the log. A version is the full table, or
the rows of those keys that have changed since the version before. So a load that fails, at any
point, leaves the table as it was, and a job that is reading an older version can finish. The
log row is one file that Spark's commit makes visible as a whole; nothing is renamed or
overwritten, which also holds on object stores. One writer per table at a time is assumed.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

# The range partitions of the three date-keyed tables.
DATE_KEY_START, DATE_KEY_END, DATE_KEY_WIDTH = 20200000, 20250101, 15


_LOG = "load bigint, kind string, folder string, rows bigint, key array<string>, columns string"


class NoTable(ValueError):
    """Nothing has been loaded to this path."""


def loads(spark: SparkSession, path: str) -> list[Row]:
    """All loads of a table, oldest first, one short row each.

    load, kind (full or change), folder, rows written, key of a change, columns (the schema as JSON).
    """
    files, log = _file_system(spark, f"{path}/loads")
    if not files.exists(log):
        return []
    return sorted(spark.read.schema(_LOG).parquet(f"{path}/loads").collect(), key=lambda r: (r["load"], r["folder"]))


def _file_system(spark: SparkSession, path: str) -> tuple:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), where


def add_version(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    verify: Callable[[], None] | None = None,
    changed: DataFrame | None = None,
) -> int:
    """Write ``df`` as a new version, make it the current one, and return the rows written.

    ``verify`` is called between the two steps; if it raises, the table stays as it was.
    With ``changed``, a frame of keys, the version holds the rows of these keys only: it
    replaces what the versions before have for them, which may be nothing, or leaves nothing.
    """
    spark = df.sparkSession
    before = loads(spark, path)
    number = before[-1]["load"] + 1 if before else 1
    folder = f"versions/{number:08d}-{uuid.uuid4().hex}"
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    counted.write.partitionBy(*partition_by).parquet(f"{path}/{folder}/rows")
    if changed is not None:
        changed.write.parquet(f"{path}/{folder}/keys")
    if verify is not None:
        verify()
    rows = seen.get["rows"]
    kind, key = ("full", []) if changed is None else ("change", changed.columns)
    entry = spark.createDataFrame([(number, kind, folder, rows, key, df.schema.json())], _LOG).coalesce(1)
    entry.write.mode("append").parquet(f"{path}/loads")
    return rows


def current_table(spark: SparkSession, path: str, load: int | None = None) -> DataFrame:
    """The rows of the newest version, or of the table as it was after ``load``.

    Versions that hold changes are put over the last full one: a row counts if no later version
    names its key. All changed keys meet the rows in one join, however many loads there were; the
    rows of the last change are current as they are and do not take part, and no version without rows is read.
    """
    entries = [r for r in loads(spark, path) if load is None or r["load"] <= load]
    full = [i for i, r in enumerate(entries) if r["kind"] == "full"]
    if not full:
        raise NoTable(path)
    base, changes = entries[full[-1]], entries[full[-1] + 1 :]
    # The columns come from the log: an empty version may have no file to take them from.
    schema = T.StructType.fromJson(json.loads(base["columns"]))

    def rows_of(entry: Row) -> DataFrame:
        return spark.read.schema(schema).parquet(f"{path}/{entry['folder']}/rows")

    if not changes:
        return rows_of(base)
    newest = rows_of(changes[-1])
    before = [r for r in (base, *changes[:-1]) if r["rows"]]
    if not before:
        return newest
    key, columns = changes[0]["key"], newest.columns
    key_schema = T.StructType([newest.schema[k] for k in key])
    rows = reduce(DataFrame.unionByName, [rows_of(r).withColumn("_load", F.lit(r["load"])) for r in before])
    named = []
    for r in changes:
        keys = spark.read.schema(key_schema).parquet(f"{path}/{r['folder']}/keys")
        named.append(keys.withColumn("_load", F.lit(r["load"])))
    last = reduce(DataFrame.unionByName, named).groupBy(*key).agg(F.max("_load").alias("_last"))
    last = last.select("_last", *[F.col(k).alias(f"_key_{i}") for i, k in enumerate(key)])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_key_{i}")) for i, k in enumerate(key)])
    current = F.col("_load") == F.coalesce("_last", F.lit(base["load"]))
    return rows.join(last, same, "left").where(current).select(*columns).unionByName(newest)


def drop_old_versions(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Delete all version folders but those of the last ``keep`` full loads and what follows them.

    Folders of failed loads go too. Not to be called while a load or a reader of an old version is running.
    """
    entries = loads(spark, path)
    full = [i for i, r in enumerate(entries) if r["kind"] == "full"]
    kept = {r["folder"] for r in entries[full[-keep:][0] :]} if full else set()
    files, root = _file_system(spark, f"{path}/versions")
    if not files.exists(root):
        return []
    old = [s.getPath() for s in files.listStatus(root) if f"versions/{s.getPath().getName()}" not in kept]
    for folder in old:
        files.delete(folder, True)
    return sorted(folder.getName() for folder in old)


def overwrite_load(
    df: DataFrame, path: str, schema: T.StructType | None = None, verify: Callable[[], None] | None = None
) -> int:
    """Replace the table at ``path`` and return the number of rows written.

    With ``schema`` the frame is reordered and cast to it; a missing or wrongly typed
    column fails before anything is written. The count is taken during the write. The rows before
    stay the current ones until all of the new ones are written and ``verify`` has passed.
    """
    return add_version(df if schema is None else df.to(schema), path, verify=verify)


def materialize(df: DataFrame, path: str) -> DataFrame:
    """Keep a model result as a table and go on from the table."""
    overwrite_load(df, path)
    return current_table(df.sparkSession, path)


def load_metrics(loads: DataFrame, run: str = "run_date", table: str = "table") -> DataFrame:
    """Rows per table and run with the change since the run before.

    ``loads`` has one row per table and run, so a window over one table stays small.
    """
    before = F.lag("rows").over(Window.partitionBy(table).orderBy(run))
    return loads.withColumn("previous_rows", before).withColumn(
        "change", F.col("rows") - F.col("previous_rows")
    )


def range_bucket(
    c: Column,
    start: int = DATE_KEY_START,
    end: int = DATE_KEY_END,
    width: int = DATE_KEY_WIDTH,
) -> Column:
    """Number of the range ``[start + k*width, start + (k+1)*width)`` that holds ``c``.

    Null and values outside ``[start, end)`` share bucket -1.
    """
    inside = (c >= start) & (c < end)
    return F.when(inside, F.floor((c - start) / width)).otherwise(F.lit(-1)).cast("int")


def with_range_bucket(
    df: DataFrame,
    column: str,
    start: int = DATE_KEY_START,
    end: int = DATE_KEY_END,
    width: int = DATE_KEY_WIDTH,
) -> DataFrame:
    return df.withColumn("bucket", range_bucket(F.col(column), start, end, width))


def range_placed(
    df: DataFrame,
    column: str,
    start: int = DATE_KEY_START,
    end: int = DATE_KEY_END,
    width: int = DATE_KEY_WIDTH,
) -> DataFrame:
    """The rows with their bucket, dealt out as they are to be written.

    Rows are range-partitioned by bucket and a hash of their content, so a bucket that holds
    much of the table becomes as many files and tasks as its share of the partitions. The
    hash is a function of the row and comes out the same when a task is run again.
    """
    bucketed = with_range_bucket(df, column, start, end, width)
    salt = F.xxhash64(*df.columns).alias("_salt")
    return bucketed.select("*", salt).repartitionByRange("bucket", "_salt").drop("_salt")


def write_range_partitioned(
    df: DataFrame,
    path: str,
    column: str,
    start: int = DATE_KEY_START,
    end: int = DATE_KEY_END,
    width: int = DATE_KEY_WIDTH,
) -> None:
    """Replace the table by one folder per bucket."""
    add_version(range_placed(df, column, start, end, width), path, ["bucket"])


def read_key_range(
    spark: SparkSession,
    path: str,
    column: str,
    lo: int,
    hi: int,
    start: int = DATE_KEY_START,
    end: int = DATE_KEY_END,
    width: int = DATE_KEY_WIDTH,
) -> DataFrame:
    """Rows with ``lo <= column <= hi``, reading only the folders that can hold them."""
    key = F.col(column)
    rows = current_table(spark, path).where((key >= lo) & (key <= hi))
    inside_lo, inside_hi = max(lo, start), min(hi, end - 1)
    folders = F.lit(False)
    if inside_lo <= inside_hi:
        folders = F.col("bucket").between((inside_lo - start) // width, (inside_hi - start) // width)
    if lo < start or hi >= end:
        folders = folders | (F.col("bucket") == -1)
    return rows.where(folders)
