from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from boxoffice.llm import nearest
from boxoffice.llm.queries import QUERIES
from tests.conftest import SF

SCHEMA = "vec_id long, embedding array<double>"


def by_hand(data, queries, k):
    """Exact answer over (id, vector) pairs: query id to [(score, id)], best first."""
    out = {}
    for q, v in queries:
        scored = [(float((np.array(x) * np.array(v)).sum()), i) for i, x in data if i != q]
        scored.sort(key=lambda s: (-s[0], s[1] is None, s[1] or 0))
        out[q] = scored[:k]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        rows = out.setdefault(r.query_id, [])
        assert r.rank == len(rows) + 1
        rows.append((r.score, r.vec_id))
    return out


def recall(got, exact):
    hits = sum(len({i for _, i in got.get(q, [])} & {i for _, i in best}) for q, best in exact.items())
    return hits / sum(map(len, exact.values()))


def test_recall_on_the_test_table(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    data = [(r.vec_id, r.embedding) for r in rows]
    exact = by_hand(data, [x for x in data if x[0] % 20 == 0], 20)
    got = found(QUERIES["op11_nearest"](spark, SF))
    assert set(got) == set(exact) and all(len(x) == 20 for x in got.values())
    assert recall(got, exact) >= 0.95
    scores = {(q, i): s for q, best in by_hand(data, [x for x in data if x[0] % 20 == 0], 500).items() for s, i in best}
    assert all(abs(scores[q, i] - s) < 1e-12 for q, best in got.items() for s, i in best)


def test_unequal_norms_in_several_blocks(spark):
    """The largest inner product is not the smallest distance; blocks are small on purpose."""
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((30, 24))
    data = [
        (i, (rng.lognormal(0, 0.7) * (centres[i % 30] + 0.4 * rng.standard_normal(24))).tolist()) for i in range(3000)
    ]
    df = spark.createDataFrame(data, SCHEMA).repartition(4)
    asked = df.where("vec_id % 50 = 0")
    exact = by_hand(data, [x for x in data if x[0] % 50 == 0], 10)
    got = found(nearest.nearest_neighbours(asked, df, k=10, rows_per_block=512, queries_per_block=16))
    assert recall(got, exact) >= 0.95


def test_ties_copies_and_few_rows(spark):
    """500 copies of one vector: the smallest ids are found, however the copies are dealt."""
    copy, other = [1.0, 2.0, -1.0], [0.5, -2.0, 1.0]
    data = [(i, copy) for i in range(500)] + [(1000, other)]
    df = spark.createDataFrame(data, SCHEMA).repartition(4)
    asked = df.where("vec_id in (0, 40, 1000)")
    assert found(nearest.nearest_neighbours(asked, df, rows_per_block=64)) == by_hand(data, [data[0], data[40], data[-1]], 20)
    few = df.where("vec_id in (1, 2, 1000)")
    exact = by_hand([data[1], data[2], data[-1]], [data[1]], 20)
    assert found(nearest.nearest_neighbours(few.where("vec_id = 1"), few)) == exact


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    data = [
        (0, [1.0, 0.0]),
        (20, None),
        (40, []),
        (60, [0.0, 0.0]),
        (80, [nan, 1.0]),
        (100, [None, 1.0]),
        (120, [inf, 1.0]),
        (140, [1.0, 2.0, 3.0]),  # not of the most frequent length
        (160, [1e200, 1e200]),
        (180, [1e-200, 0.0]),
        (None, [2.0, 1.0]),
        (7, [-1.0, 0.0]),
        (7, [-1.0, 0.0]),  # a repeated row is a row of its own
        (0, [0.0, 1.0]),  # the query's id again: one query, with the smaller vector
    ]
    df = spark.createDataFrame(data, SCHEMA)
    asked = df.where("vec_id % 20 = 0")
    got = found(nearest.nearest_neighbours(asked, df))
    sound = [(i, v) for i, v in data if (i, v) not in data[1:8] and i not in (20, 40, 60, 80, 100, 120, 140)]
    queries = [(0, [0.0, 1.0]), (160, [1e200, 1e200]), (180, [1e-200, 0.0])]
    assert got == by_hand(sound, queries, 20)
    clash = df.select("*", F.lit(1).alias("id"), F.lit(2).alias("vec"), F.lit(3).alias("rank"), F.lit(4).alias("row_block"))
    assert found(nearest.nearest_neighbours(clash.where("vec_id % 20 = 0"), clash)) == got


def test_no_rows(spark):
    df = spark.createDataFrame([(1, [1.0]), (20, None)], SCHEMA)
    assert nearest.nearest_neighbours(df.where("false"), df).count() == 0
    assert nearest.nearest_neighbours(df, df.where("false")).count() == 0
    assert nearest.nearest_neighbours(df.where("vec_id % 20 = 0"), df).count() == 0


def test_long_vectors(spark):
    rng = np.random.default_rng(1)
    data = [(i, rng.standard_normal(3000).tolist()) for i in range(60)]
    df = spark.createDataFrame(data, SCHEMA)
    exact = by_hand(data, data[:1] + data[20:21] + data[40:41], 20)
    assert recall(found(nearest.nearest_neighbours(df.where("vec_id % 20 = 0"), df)), exact) >= 0.9


def test_windows_are_counted_once():
    """What is counted step by step is what the last windows hold."""
    rng = np.random.default_rng(2)
    vectors = rng.standard_normal((200, 8))
    block = nearest.SortedProjections(vectors, float(np.linalg.norm(vectors, axis=1).max()), nearest.directions(9, 16))
    at = rng.standard_normal((1, 16)).astype(np.float32)
    low, _ = block.windows(at, np.float32(0))
    high, counts = low.copy(), np.zeros(200, int)
    for half in (0.1, 0.4, 1.0):
        new_low, new_high = block.windows(at, np.array([half], np.float32))
        counts += block.newly_covered(new_low[:, 0], low[:, 0], high[:, 0], new_high[:, 0])
        low, high = new_low, new_high
        keys = np.empty((200, 16), np.float32)
        for j in range(16):
            keys[block.order[j], j] = block.keys[j]
        assert (counts == (np.abs(keys - at) <= np.float32(half)).sum(axis=1)).all()
