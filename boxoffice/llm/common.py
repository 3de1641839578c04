"""Small helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema
from pyspark.sql.types import StructType

#: The bytes that separate words: space, tab, line feed, vertical tab, form feed, carriage return.
WHITESPACE = b"\x20\x09\x0a\x0b\x0c\x0d"


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def row_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """Names a row by its content, so that a decision can be joined back to it.

    Rows with equal id and equal text get the same key: they count as one document and get
    the same decision. A null id is a value like any other.
    """
    return F.xxhash64(F.col(id_col), F.col(text_col))


def id_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the two columns an operator reads, so that further columns cannot clash."""
    return docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.col(f"`{text_col}`").cast("string").alias("text"),
    )


def utf8_parts(column: pa.Array, limit: int = 4 << 20) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Consecutive rows of a string column as (first row, bytes, row starts).

    A part holds rows of about ``limit`` bytes together, at least one row; null is empty.
    ``row starts`` has one more entry than the part has rows.
    """
    column = column.cast(pa.large_string()).fill_null("")
    if len(column) == 0:
        return
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(starts, starts[first] + limit, "right")) - 1)
        last = min(last, len(column))
        yield first, whole[starts[first] : starts[last]], starts[first : last + 1] - starts[first]
        first = last


def pack_rows(payload: np.ndarray, counts: np.ndarray) -> pa.Array:
    """A binary column: row i holds the next ``counts[i]`` items of ``payload``."""
    width = payload.dtype.itemsize
    offsets = np.concatenate(([0], np.cumsum(counts, dtype=np.int64))) * width
    if offsets[-1] > 2**31 - 1:
        raise ValueError("one Arrow batch holds more than 2 GiB; lower maxRecordsPerBatch")
    return pa.Array.from_buffers(
        pa.binary(),
        len(counts),
        [None, pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(payload.tobytes())],
    )


def rows_to_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)


def spark_schema(schema: pa.Schema) -> StructType:
    return from_arrow_schema(schema)
