"""Token ids as patched frame-of-reference blocks.

A shard file holds the ids of consecutive documents. They are cut into blocks of 128: the
block's minimum is taken off, the differences are packed with as many bits as a percentile
of them needs, and what does not fit is stored as exceptions (place and high bits). The file
also holds the start of every block, so that any range of ids is read without the rest, and
a table of its documents.

File layout, little-endian: magic ``PFR1``, uint32 block count, uint32 document count, uint64
id count; per block uint64 start, uint32 minimum, uint8 width, uint8 exception count; per
document int64 id, uint8 whether the id is known, uint64 id count; then the blocks, each the
packed low bits, the exceptions' places (uint8) and their high bits (uint32).

Scale. Documents are range-partitioned by id and encoded in order, so a shard is a run of
consecutive documents. Rows of one id are told apart by a hash of their text, so that an id
(null above all) that many rows have is dealt to several tasks. Only one number per shard,
its count of ids, is needed to place every document in the whole sequence.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from boxoffice.llm.common import id_and_text, rows_to_batch, shuffle_partitions, spark_schema
from boxoffice.llm.tokens import encoder
from boxoffice.session import scratch_path

BLOCK = 128
MAGIC = b"PFR1"
_HEAD = struct.Struct("<4sIIQ")
_BLOCK = np.dtype([("start", "<u8"), ("least", "<u4"), ("width", "u1"), ("exceptions", "u1")])
_DOC = np.dtype([("doc_id", "<i8"), ("known", "u1"), ("n", "<u8")])
#: Ids, or documents, after which a shard is closed.
SHARD_IDS, SHARD_DOCS = 1 << 20, 1 << 16
#: Pieces of text that a worker remembers, in each of two generations.
_REMEMBER = 450_000


class Shard(NamedTuple):
    doc_ids: list[int | None]
    counts: np.ndarray
    ids: np.ndarray


def write_shard(doc_ids: list[int | None], counts: list[int], ids: np.ndarray, percentile: int = 90) -> bytes:
    """The bytes of a shard file; ``counts`` says how many of ``ids`` each document has."""
    n = len(ids)
    blocks = -(-n // BLOCK)
    padded = np.zeros(blocks * BLOCK, np.uint32)
    padded[:n] = ids
    if n % BLOCK:
        padded[n:] = ids[n - 1]
    grid = padded.reshape(blocks, BLOCK)
    least = grid.min(axis=1) if blocks else np.zeros(0, np.uint32)
    rest = grid - least[:, None]
    place = min(BLOCK - 1, BLOCK * percentile // 100)
    chosen = np.partition(rest, place, axis=1)[:, place].astype(np.int64) if blocks else np.zeros(0, np.int64)
    width = np.ceil(np.log2(chosen + 1)).astype(np.uint8)
    outlier = (rest.astype(np.uint64) >> width[:, None].astype(np.uint64)).astype("<u4")
    table = np.zeros(blocks, _BLOCK)
    table["least"], table["width"] = least, width
    table["exceptions"] = (outlier > 0).sum(axis=1)
    packed: list[bytes] = [b""] * blocks
    for w in np.unique(width[width > 0]):
        at = np.flatnonzero(width == w)
        bits = np.unpackbits(rest[at].astype("<u4", copy=False).view(np.uint8).reshape(len(at), BLOCK, 4), axis=2, bitorder="little")
        rows = np.packbits(bits[:, :, :w].reshape(len(at), -1), axis=1, bitorder="little")
        for i, row in zip(at, rows):
            packed[i] = row.tobytes()
    block, place_in = np.nonzero(outlier)
    places, high = place_in.astype(np.uint8).tobytes(), outlier[block, place_in].tobytes()
    ends = np.cumsum(table["exceptions"], dtype=np.int64)
    for i, end in zip(np.flatnonzero(table["exceptions"]).tolist(), ends[table["exceptions"] > 0].tolist()):
        first = end - int(table["exceptions"][i])
        packed[i] += places[first:end] + high[4 * first : 4 * end]
    docs = np.zeros(len(doc_ids), _DOC)
    docs["doc_id"] = [0 if d is None else d for d in doc_ids]
    docs["known"] = [d is not None for d in doc_ids]
    docs["n"] = counts
    first = _HEAD.size + table.nbytes + docs.nbytes
    if blocks:
        table["start"] = first + np.concatenate(([0], np.cumsum([len(p) for p in packed])[:-1]))
    head = _HEAD.pack(MAGIC, blocks, len(doc_ids), n)
    return b"".join([head, table.tobytes(), docs.tobytes(), *packed])


def _tables(file: bytes) -> tuple[np.ndarray, np.ndarray, int]:
    magic, blocks, docs, n = _HEAD.unpack_from(file)
    if magic != MAGIC:
        raise ValueError("not a shard of token blocks")
    table = np.frombuffer(file, _BLOCK, blocks, _HEAD.size)
    return table, np.frombuffer(file, _DOC, docs, _HEAD.size + table.nbytes), n


def _unpack(file: bytes, table: np.ndarray) -> np.ndarray:
    """The ids of the blocks that ``table`` lists, one row per block."""
    out = np.zeros((len(table), BLOCK), np.int64)
    raw = np.frombuffer(file, np.uint8)
    starts = table["start"].astype(np.int64)
    for w in np.unique(table["width"][table["width"] > 0]):
        at = np.flatnonzero(table["width"] == w)
        size = BLOCK * int(w) // 8
        bits = np.unpackbits(raw[starts[at][:, None] + np.arange(size)], axis=1, bitorder="little")
        whole = np.zeros((len(at), BLOCK, 32), np.uint8)
        whole[:, :, :w] = bits.reshape(len(at), BLOCK, int(w))
        out[at] = np.packbits(whole, axis=2, bitorder="little").view("<u4")[:, :, 0]
    patched = np.flatnonzero(table["exceptions"])
    count = table["exceptions"][patched].astype(np.int64)
    if len(patched):
        # Places follow the packed bits of their block, high bits follow its places.
        first = starts[patched] + BLOCK // 8 * table["width"][patched].astype(np.int64)
        block = np.repeat(np.arange(len(patched)), count)
        order = np.arange(len(block)) - (np.cumsum(count) - count)[block]
        high = raw[((first + count)[block] + 4 * order)[:, None] + np.arange(4)].view("<u4")[:, 0].astype(np.int64)
        out[patched[block], raw[first[block] + order]] |= high << table["width"][patched][block].astype(np.int64)
    return out + table["least"].astype(np.int64)[:, None]


def read_shard(file: bytes) -> Shard:
    table, docs, n = _tables(file)
    ids = _unpack(file, table).reshape(-1)[:n]
    known = [int(d) if k else None for d, k in zip(docs["doc_id"], docs["known"])]
    return Shard(known, docs["n"].astype(np.int64), ids.astype("<u4"))


def read_range(file: bytes, first: int, last: int) -> np.ndarray:
    """Ids ``first`` to ``last`` (without) of a shard, from the blocks that hold them."""
    table, _, n = _tables(file)
    last = min(last, n)
    if first >= last:
        return np.zeros(0, "<u4")
    a, b = first // BLOCK, -(-last // BLOCK)
    found = _unpack(file, table[a:b]).reshape(-1)
    return found[first - a * BLOCK : last - a * BLOCK].astype("<u4")


_FILES = pa.schema(
    [
        ("first_id", pa.int64()),
        ("first_key", pa.int64()),
        ("shard", pa.int64()),
        ("n_ids", pa.int64()),
        ("file", pa.binary()),
    ]
)


def write_token_files(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int | None,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> None:
    """Encode whole texts and write shard files in ascending id order below ``path``.

    ``path`` is a Parquet table with a row per shard: the file's bytes, its count of ids and
    what orders it (first document, and number within the partition). Null ids come first,
    rows of one id are ordered by a hash of their text; a null text is empty.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, shard, origin = encoder(tokenizer_path, _REMEMBER), 0, None
        names: list[int | None] = []
        held: list[np.ndarray] = []
        n = 0

        def close() -> pa.RecordBatch:
            file = write_shard(names, [len(x) for x in held], np.concatenate(held))
            return rows_to_batch([(*origin, shard, n, file)], _FILES)

        for batch in batches:
            keys = batch.column(2).to_pylist()
            for doc_id, text, key in zip(batch.column(0).to_pylist(), batch.column(1), keys):
                origin = origin or (doc_id, key)
                names.append(doc_id)
                held.append(one.encode(text.as_py(), end_id))
                n += len(held[-1])
                if n >= SHARD_IDS or len(names) == SHARD_DOCS:
                    yield close()
                    names, held, n, shard = [], [], 0, shard + 1
        if names:
            yield close()

    rows = id_and_text(docs, id_col, text_col).withColumn("key", F.xxhash64("text"))
    order = [F.asc_nulls_first("doc_id"), F.asc("key")]
    parts = shuffle_partitions(docs.sparkSession)
    ordered = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    ordered.mapInArrow(encode, spark_schema(_FILES)).write.parquet(path)


_DOCS = pa.schema(
    [
        ("first_id", pa.int64()),
        ("first_key", pa.int64()),
        ("shard", pa.int64()),
        ("doc_id", pa.int64()),
        ("in_shard", pa.int64()),
        ("ids", pa.binary()),
    ]
)
_SHARD = ["first_id", "first_key", "shard"]


def read_token_files(files: DataFrame) -> DataFrame:
    """A row per document from the files' bytes: its shard, doc_id, in_shard, ids (uint32).

    ``in_shard`` counts the shard's ids before the document.
    """

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for *key, file in zip(*(batch.column(i).to_pylist() for i in range(3)), batch.column(3)):
                shard = read_shard(file.as_py())
                ends = np.cumsum(shard.counts)
                for i in range(0, len(ends), 1024):
                    part = zip(shard.doc_ids[i : i + 1024], shard.counts[i : i + 1024], ends[i : i + 1024])
                    rows = [(*key, d, int(e - c), shard.ids[e - c : e].tobytes()) for d, c, e in part]
                    yield rows_to_batch(rows, _DOCS)

    return files.select(*_SHARD, "file").mapInArrow(decode, spark_schema(_DOCS))


def with_starts(rows: DataFrame, files: DataFrame) -> DataFrame:
    """Adds ``start``, the ids of all files and documents before, and drops the shard's names.

    Counts of ids are summed per range partition first; only those sums, a row for each
    partition that wrote files, are added up in one task.
    """
    counts = files.select(*_SHARD, "n_ids")
    origin = ["first_id", "first_key"]
    everything = Window.orderBy(F.asc_nulls_first("first_id"), "first_key")
    above = Window.unboundedPreceding, -1
    totals = counts.groupBy(*origin).agg(F.sum("n_ids").alias("all_ids"))
    totals = totals.select(*origin, F.sum("all_ids").over(everything.rowsBetween(*above)).alias("outer"))
    inside = Window.partitionBy(*origin).orderBy("shard").rowsBetween(*above)
    shards = counts.select(*_SHARD, F.sum("n_ids").over(inside).alias("inner"))
    for table, names in ((totals, origin), (shards, _SHARD)):
        table = table.select([F.col(c).alias(f"t_{c}") for c in names] + table.columns[len(names) :])
        match = F.lit(True)
        for c in names:
            match = match & F.col(c).eqNullSafe(F.col(f"t_{c}"))
        rows = rows.join(table, match, "left").drop(*[f"t_{c}" for c in names])
    start = F.coalesce("outer", F.lit(0)) + F.coalesce("inner", F.lit(0)) + F.col("in_shard")
    return rows.withColumn("start", start).drop(*_SHARD, "in_shard", "outer", "inner")


def token_table(docs: DataFrame, tokenizer_path: str, end_id: int | None) -> DataFrame:
    """Write the files to the shared folder and open them."""
    spark = docs.sparkSession
    path = scratch_path(spark, "token-files")
    write_token_files(docs, tokenizer_path, end_id, path)
    return spark.read.parquet(path)
