"""Nearest neighbours by inner product, found by counting collisions in sorted projections.

Vectors are laid on a sphere so that a larger inner product is a smaller distance: rows become
(x / M, sqrt(1 - |x|^2 / M^2)) with M the greatest norm, queries (q / |q|, 0). A block of rows
is projected on ``projections`` random directions, and each projection is kept as a sorted
array. A query opens a window around its own value in every array, of a half width in proportion to a
radius; the radius grows step by step (virtual rehashing: the arrays stay, the windows widen),
and only the newly covered ends of the windows are counted. A row that lies in the windows of at least
``threshold`` arrays is verified by its inner product.

Stop rule. The threshold is the greatest count that a row at just the radius reaches with
probability 1 - ``miss`` (binomial, as a projected difference is normal with the distance as
its deviation). The search of a block ends when its k-th verified distance is within the
radius: whoever is nearer than that has been counted past the threshold with at least that
probability. After k rows are verified the next radius is never wider than the k-th distance, so the last
step is no wider than needed. There is no cap on candidates. When the radius covers the whole sphere,
all rows left are verified, so that a query gets all rows if there are fewer than k.

Scale. Rows and queries are dealt into blocks by a hash of their ids and every pair of blocks
is one group of a cogroup, of bounded size, whatever the data; a group of like vectors is spread over all blocks.
Each pair of blocks gives k rows per query at most, and the best k of them are taken by a
window that Spark limits before the shuffle. Only the length and greatest norm come to the driver. Row
blocks are sent once per query block and the other way round, so larger blocks mean less traffic: choose
them as large as a task's memory allows (a row takes about 8 * (dimension + 2 * projections) bytes).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boxoffice.llm.common import rows_to_batch, spark_schema

_SHAPE = pa.schema([("d", pa.int64()), ("n", pa.int64()), ("norm", pa.float64())])
_FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

#: Count of a row that has been verified: so low that no window lifts it to a threshold.
_DONE = -(1 << 14)


def usable(embedding: Column) -> Column:
    """True for vectors with no null or non-finite component and at least one that is not zero."""
    top, bottom = F.array_max(embedding), F.array_min(embedding)
    # Not found, in an array with a null, is null and not false.
    whole = ~F.array_contains(embedding, F.lit(float("nan")))
    finite = (top < float("inf")) & (bottom > -float("inf"))
    return F.coalesce(whole & finite & ((top != 0) | (bottom != 0)), F.lit(False))


def vectors_of(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """id and vec (array of doubles) of all rows whose vector takes part."""
    picked = rows.select(
        F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("vec")
    )
    return picked.where(usable(F.col("vec")))


def directions(dimension: int, projections: int, seed: int = 11) -> np.ndarray:
    """Unit directions as columns, orthogonal within groups of ``dimension``, times sqrt(dimension).

    The projection of a difference then has the difference's length as its deviation.
    """
    rng = np.random.default_rng(seed)
    widths = [min(dimension, projections - done) for done in range(0, projections, dimension)]
    groups = [np.linalg.qr(rng.standard_normal((dimension, width)))[0] for width in widths]
    return np.concatenate(groups, axis=1) * math.sqrt(dimension)


def threshold(projections: int, width: float, miss: float) -> int:
    """The greatest count that a row at just the radius reaches with probability 1 - miss."""
    p = math.erf(width / math.sqrt(2))
    below = 0.0
    for count in range(projections + 1):
        below += math.comb(projections, count) * p**count * (1 - p) ** (projections - count)
        if below > miss:
            return count
    return projections


def _norms(vectors: np.ndarray) -> np.ndarray:
    top = np.abs(vectors).max(axis=1)
    return top * np.linalg.norm(vectors / top[:, None], axis=1)


def _shapes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number and greatest norm of the vectors of each length, batch by batch."""
    for batch in batches:
        column = batch.column("vec")
        sizes = np.diff(np.asarray(column.offsets))
        out = []
        for size in np.unique(sizes):
            picked = column.take(pa.array(np.flatnonzero(sizes == size))).flatten()
            norms = _norms(np.asarray(picked, np.float64).reshape(-1, size))
            out.append((int(size), len(norms), float(norms.max())))
        yield rows_to_batch(out, _SHAPE)


class SortedProjections:
    """A block of rows as one sorted array per projection."""

    def __init__(self, vectors: np.ndarray, norm: float, axes: np.ndarray):
        self.vectors, self.norm, self.axes = vectors, norm, axes
        scaled = vectors / norm
        rest = np.sqrt(np.maximum(0.0, 1.0 - np.einsum("ij,ij->i", scaled, scaled)))
        keys = (np.column_stack((scaled, rest)) @ axes).T.astype(np.float32)
        self.order = np.argsort(keys, axis=1)
        self.keys = np.take_along_axis(keys, self.order, axis=1)

    def windows(self, at: np.ndarray, half: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last place (exclusive) of the window of every query, by projection."""
        low = [np.searchsorted(keys, at[:, j] - half, "left") for j, keys in enumerate(self.keys)]
        high = [np.searchsorted(keys, at[:, j] + half, "right") for j, keys in enumerate(self.keys)]
        return np.array(low), np.array(high)

    def newly_covered(self, low: list[int], old_low: list[int], old_high: list[int], high: list[int]) -> np.ndarray:
        """How often each row lies in the ends by which the windows have widened."""
        ends = [order[a:b] for order, a, b in zip(self.order, low, old_low) if a < b]
        ends += [order[a:b] for order, a, b in zip(self.order, old_high, high) if a < b]
        if not ends:
            return np.zeros(len(self.vectors), np.int16)
        return np.bincount(np.concatenate(ends), minlength=len(self.vectors)).astype(np.int16)

    def nearest(
        self, queries: np.ndarray, own: list[np.ndarray], k: int, width: float, least: int, start: float, growth: float
    ) -> list[tuple[np.ndarray, np.ndarray]]:
        """Verified places and their scores for every query; ``own`` are the places it must not find."""
        lengths = _norms(queries)
        at = np.column_stack((queries / lengths[:, None], np.zeros(len(queries)))) @ self.axes
        at = at.astype(np.float32)
        low, _ = self.windows(at, np.float32(0))
        high = low.copy()
        counts = np.zeros((len(queries), len(self.vectors)), np.int16)
        for q, places in enumerate(own):
            counts[q, places] = _DONE
        found = [(np.empty(0, np.int64), np.empty(0)) for _ in queries]
        radius, active = np.full(len(queries), start), np.arange(len(queries))
        while len(active):
            wide = self.windows(at[active], (radius[active] * width).astype(np.float32))
            # Never narrower than before, so that nothing is counted twice.
            new_low, new_high = np.minimum(wide[0], low[:, active]), np.maximum(wide[1], high[:, active])
            ongoing = np.ones(len(active), bool)
            for i, q in enumerate(active):
                whole = radius[q] >= 2.0
                if not whole:
                    counts[q] += self.newly_covered(new_low[:, i].tolist(), low[:, q].tolist(), high[:, q].tolist(), new_high[:, i].tolist())
                fresh = np.flatnonzero(counts[q] >= (0 if whole else least))
                counts[q, fresh] = _DONE
                # A sum over each row alone, so that equal vectors have equal scores wherever they stand.
                scores = (self.vectors[fresh] * queries[q]).sum(axis=1)
                found[q] = np.concatenate((found[q][0], fresh)), np.concatenate((found[q][1], scores))
                reach = _reach(found[q][1], k, self.norm, lengths[q])
                ongoing[i] = not whole and reach > radius[q]
                radius[q] = min(radius[q] * growth, reach, 2.0)
            low[:, active], high[:, active] = new_low, new_high
            active = active[ongoing]
        return found


def _reach(scores: np.ndarray, k: int, norm: float, length: float) -> float:
    """Distance of the k-th best of the verified rows."""
    if len(scores) < k:
        return math.inf
    best = np.partition(scores, len(scores) - k)[len(scores) - k]
    return math.sqrt(max(0.0, 2.0 - 2.0 * best / norm / length))


def _matrix(table: pa.Table, dimension: int) -> np.ndarray:
    column = table.column("vec").combine_chunks()
    return np.asarray(column.flatten(), np.float64).reshape(-1, dimension)


def nearest_neighbours(
    queries: DataFrame,
    rows: DataFrame,
    k: int = 20,
    projections: int = 64,
    width: float = 1.2,
    miss: float = 0.05,
    start: float = 0.25,
    growth: float = 1.3,
    rows_per_block: int = 32768,
    queries_per_block: int = 512,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` rows found with the largest inner product.

    Nearest first, ties to the smaller vec_id (null last); the score is the inner product of the
    vectors as given, in double precision. A query finds all rows but those with its own id. Vectors that
    are null, all zero, or hold a null or non-finite component take no part, nor do those
    that are not of the most frequent length of ``rows`` (ties: the smaller length). A query
    needs an id; rows that repeat a query's id are one query, with the smallest of their vectors. Repeated
    rows are rows of their own. Further columns are not read.

    ``width`` is the half width of a window in radii, ``miss`` the chance that a row at the last
    radius is not counted far enough; nearer rows are missed more rarely. Directions are orthogonal, so
    where the dimension is not much larger than the number of ``projections`` counts vary less
    than the bound assumes, and a greater ``miss`` still finds nearly all: measure it.
    """
    spark = rows.sparkSession
    base = vectors_of(rows, id_col, vector_col)
    sizes = base.select("vec").mapInArrow(_shapes, spark_schema(_SHAPE)).groupBy("d")
    shape = sizes.agg(F.sum("n").alias("n"), F.max("norm").alias("norm"))
    shape = shape.orderBy(F.desc("n"), "d").first()
    if shape is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dimension, norm = shape["d"], shape["norm"]
    base = base.where(F.size("vec") == dimension)
    asked = vectors_of(queries, id_col, vector_col).where((F.size("vec") == dimension) & F.col("id").isNotNull())
    asked = asked.groupBy("id").agg(F.min("vec").alias("vec"))
    row_blocks = -(-shape["n"] // rows_per_block)
    query_blocks = max(1, -(-asked.count() // queries_per_block))

    def dealt(df: DataFrame, blocks: int, name: str, others: int, other: str) -> DataFrame:
        block = F.pmod(F.xxhash64("id", "vec"), F.lit(blocks)).cast("int").alias(name)
        every = F.explode(F.sequence(F.lit(0), F.lit(others - 1))).alias(other)
        return df.select("id", "vec", block, every).groupBy("row_block", "query_block")

    axes = directions(dimension + 1, projections)
    least = threshold(projections, width, miss)

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            return _FOUND.empty_table()
        ids, asked_ids = left.column("id").combine_chunks(), right.column("id").to_numpy()
        named = np.asarray(ids.is_valid())
        numbers = np.asarray(ids.fill_null(0))
        by_id = np.argsort(numbers, kind="stable")
        first, last = (np.searchsorted(numbers[by_id], asked_ids, side) for side in ("left", "right"))
        own = [places[named[places]] for places in (by_id[a:b] for a, b in zip(first, last))]
        block = SortedProjections(_matrix(left, dimension), norm, axes)
        found = block.nearest(_matrix(right, dimension), own, k, width, least, start, growth)
        parts = []
        for query, (places, scores) in zip(asked_ids, found):
            best = np.lexsort((numbers[places], ~named[places], -scores))[:k]
            parts.append((np.full(len(best), query), ids.take(pa.array(places[best])), scores[best]))
        columns = [np.concatenate([p[0] for p in parts]), pa.concat_arrays([p[1] for p in parts]), np.concatenate([p[2] for p in parts])]
        return pa.Table.from_arrays([pa.array(c, t) if isinstance(c, np.ndarray) else c for c, t in zip(columns, _FOUND.types)], schema=_FOUND)

    cells = dealt(base, row_blocks, "row_block", query_blocks, "query_block").cogroup(
        dealt(asked, query_blocks, "query_block", row_blocks, "row_block")
    )
    found = cells.applyInArrow(search, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
