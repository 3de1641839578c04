"""Repeated byte strings, by merging sorted suffixes of many shards.

Every byte goes that lies in a string of ``LENGTH`` bytes which also starts anywhere else,
overlaps and the same document included. Strings never cross documents.

Sparse suffixes. Suffixes are taken at anchors only: a position is an anchor if the hash of the
``GRAM`` bytes there is the first smallest of ``SPAN`` neighbours. Two equal strings have the
same anchors where those neighbours lie inside the string. So a window (a string of LENGTH
bytes) is judged at its first anchor from ``SPAN - 1`` bytes on, and that anchor's core (the
bytes around it that every window judged there holds) is equal for equal windows.

Merging. Anchors are shuffled by the hash of their core; a core that occurs once makes no
window repeat. Of anchors with equal reach (all the bytes of all windows judged there) one
stands for all, and their windows are known to repeat. If that settles a core, it is done.
For the others, each shard (the documents of one task) sends the bytes to the right and left
of the core in sorted order, and the shards' orders are merged by refinement: after round k
the interleave is right for the first k bytes, suffixes that share them form an interval, and
the next round only parts the intervals by one more byte; no suffixes are compared again. A
window repeats if its anchor shares an interval of the right depth with another one on both
sides.

Scale. Hashes of anchors (one in about 65 bytes) are shuffled once, packed by task; texts are
shuffled only for documents with repeated cores. Copies collapse before bytes are sent, so a
group of thousands sends one reach.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxoffice.llm.common import id_and_text, row_key, rows_to_batch, shuffle_partitions, spark_schema, utf8_parts
from boxoffice.session import stable

LENGTH, SPAN, GRAM = 400, 128, 16
#: A window that starts ``d`` bytes before its anchor has NEAR <= d <= FAR.
NEAR, FAR = SPAN - 1, 2 * SPAN - 2
#: The core reaches from LEFT bytes before the anchor to RIGHT bytes after it.
LEFT, RIGHT = NEAR, LENGTH - FAR
#: Bytes of the reach on either side of the core.
SIDE = FAR - NEAR
_MIX = np.random.default_rng(23).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))


def _scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


class Rolling:
    """64-bit hashes of any stretches of some bytes."""

    def __init__(self, data: np.ndarray):
        power = np.full(len(data) + 1, _BASE)
        power[0] = 1
        self._sums = np.concatenate(([np.uint64(0)], np.cumsum(_MIX[data] * np.cumprod(power)[:-1], dtype=np.uint64)))
        power[1:] = _INVERSE
        self._back = np.cumprod(power)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _scramble((self._sums[end] - self._sums[start]) * self._back[start] + (end - start).astype(np.uint64))


def anchors(data: np.ndarray, starts: np.ndarray, roll: Rolling) -> np.ndarray:
    """Positions of all anchors in rows of bytes; short rows have none."""
    n = len(data) - GRAM + 1
    if n < SPAN:
        return np.zeros(0, np.int64)
    at = np.arange(n)
    least = (roll.of(at, at + GRAM) & np.uint64(0xFFFFFFFF00000000)) | at.astype(np.uint64)
    width = 1
    while width < SPAN:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    first = np.arange(len(least))
    end = starts[np.searchsorted(starts, first, "right")]
    inside = first + SPAN - 1 + GRAM <= end
    return np.unique(least[inside] & np.uint64(0xFFFFFFFF)).astype(np.int64)


def judged(data: np.ndarray, starts: np.ndarray, roll: Rolling) -> tuple[np.ndarray, ...]:
    """Row, anchor and the range of window starts (first, last) judged at each anchor."""
    p = anchors(data, starts, roll)
    row = np.searchsorted(starts, p, "right") - 1
    low, high = starts[row], starts[row + 1]
    before = np.concatenate(([-1], p[:-1]))
    before = np.where(np.concatenate(([-1], row[:-1])) == row, before, low - FAR - 2)
    # A window is judged at its first anchor from NEAR bytes on.
    first = np.maximum(np.maximum(p - FAR, before - NEAR + 1), low)
    last = np.minimum(p - NEAR, high - LENGTH)
    use = first <= last
    return row[use], p[use], first[use], last[use]


def _shards(bits: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per fragment of core hashes and shard, and one with the shard's documents."""
    number = TaskContext.get().partitionId() << 24
    for batch in batches:
        ids, keys = batch.column(0).to_pylist(), batch.column(2).to_pylist()
        for top, data, starts in utf8_parts(batch.column(1)):
            roll = Rolling(data)
            row, p, first, last = judged(data, starts, roll)
            core = roll.of(p - LEFT, p + RIGHT)
            # Anchors are alike if the windows judged there are, and lie alike.
            reach = _scramble(roll.of(first, last + LENGTH) ^ ((p - first).astype(np.uint64) << np.uint64(20)) ^ (last - first).astype(np.uint64))
            fragment = (core >> np.uint64(64 - bits)).astype(np.int64)
            order = np.lexsort((reach, core))
            cut = np.searchsorted(fragment[order], np.arange((1 << bits) + 1))
            names = []
            for i in range(len(starts) - 1):
                text = data[starts[i] : starts[i + 1]].tobytes()
                names.append((ids[top + i], keys[top + i], len(text), hashlib.sha256(text).hexdigest()))
            out: list[tuple] = [(number, number % (1 << bits), None, None, None, names)]
            for f in range(1 << bits):
                a, b = cut[f], cut[f + 1]
                if a < b:
                    at = order[a:b]
                    place = np.stack([row[at], p[at] - starts[row[at]]], axis=1).astype("<i8")
                    out.append((number, f, core[at].tobytes(), reach[at].tobytes(), place.tobytes(), None))
            for i in range(0, len(out), 64):
                yield rows_to_batch([(*r[:5], [dict(zip(_NAMES, n)) for n in r[5]] if r[5] is not None else None) for r in out[i : i + 64]], _SHARD)
            number += 1


_NAMES = ("doc_id", "row", "n_bytes", "sha256")
_NAME = pa.struct([("doc_id", pa.int64()), ("row", pa.int64()), ("n_bytes", pa.int64()), ("sha256", pa.string())])
_SHARD = pa.schema(
    [
        ("shard", pa.int64()),
        ("fragment", pa.int32()),
        ("core", pa.binary()),
        ("reach", pa.binary()),
        ("place", pa.binary()),
        ("docs", pa.list_(_NAME)),
    ]
)
#: What is known of an anchor: all its windows repeat, or its bytes must be merged, or both.
_REPEATS, _SEND = 1, 2
_STATE = pa.schema([("shard", pa.int64()), ("place", pa.binary()), ("state", pa.binary()), ("docs", pa.list_(_NAME))])


def _cores(table: pa.Table) -> pa.Table:
    """One fragment: anchors whose core occurs again, and what that settles."""
    rows = [r for r in table.to_pylist()]
    out = [(r["shard"], None, None, r["docs"]) for r in rows if r["docs"] is not None]
    rows = [r for r in rows if r["docs"] is None]
    if rows:
        core = np.concatenate([np.frombuffer(r["core"], np.uint64) for r in rows])
        reach = np.concatenate([np.frombuffer(r["reach"], np.uint64) for r in rows])
        _, at, many = np.unique(core, return_inverse=True, return_counts=True)
        pair = np.stack([at.astype(np.uint64), reach], axis=1)
        _, one, kind, same = np.unique(pair, axis=0, return_index=True, return_inverse=True, return_counts=True)
        kind = kind.reshape(-1)
        repeats = same[kind] > 1
        kinds_of = np.bincount(at[one], minlength=len(many))
        alone = np.bincount(at, ~repeats, len(many)) > 0
        standing = np.zeros(len(core), bool)
        standing[one] = True
        send = standing & alone[at] & (kinds_of[at] > 1)
        state = (repeats * _REPEATS + send * _SEND).astype(np.uint8)
        done = 0
        for r in rows:
            n = len(r["core"]) // 8
            mine = state[done : done + n]
            place = np.frombuffer(r["place"], "<i8").reshape(-1, 2)[mine > 0]
            done += n
            if len(place):
                out.append((r["shard"], place.tobytes(), mine[mine > 0].tobytes(), None))
    return pa.Table.from_batches([rows_to_batch(out, _STATE)])


_DOC = pa.schema([*_NAME, ("at", pa.list_(pa.int64())), ("state", pa.binary())])


def _documents(table: pa.Table) -> pa.Table:
    """The documents of one shard with the anchors that matter, ascending."""
    rows = table.to_pylist()
    (names,) = (r["docs"] for r in rows if r["docs"] is not None)
    rows = [r for r in rows if r["docs"] is None]
    place = np.concatenate([np.zeros((0, 2), "<i8"), *(np.frombuffer(r["place"], "<i8").reshape(-1, 2) for r in rows)])
    state = np.concatenate([np.zeros(0, np.uint8), *(np.frombuffer(r["state"], np.uint8) for r in rows)])
    order = np.lexsort((place[:, 1], place[:, 0]))
    place, state = place[order], state[order]
    cut = np.searchsorted(place[:, 0], np.arange(len(names) + 1))
    out = []
    for i, d in enumerate(names):
        mine = slice(cut[i], cut[i + 1])
        out.append((*(d[k] for k in _NAMES), place[mine, 1].tolist(), state[mine].tobytes()))
    return pa.Table.from_batches([rows_to_batch(out, _DOC)])


_REACH = pa.schema(
    [
        ("fragment", pa.int64()),
        ("doc_id", pa.int64()),
        ("row", pa.int64()),
        ("core", pa.int64()),
        ("at", pa.int64()),
        ("first", pa.int64()),
        ("last", pa.int64()),
        ("left", pa.binary()),
        ("right", pa.binary()),
    ]
)


def _reaches(fragments: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes beside the core of every anchor that must be merged, sorted in each shard."""
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            data = np.frombuffer((r["text"] or "").encode(), np.uint8)
            roll = Rolling(data)
            ends = np.array([0, len(data)])
            _, p, first, last = judged(data, ends, roll)
            wanted = np.frombuffer(r["state"], np.uint8) & _SEND > 0
            pick = np.flatnonzero(np.isin(p, np.array(r["at"], np.int64)[wanted]))
            core = roll.of(p[pick] - LEFT, p[pick] + RIGHT)
            for i, c in zip(pick, core.astype(np.int64)):
                a, b = int(first[i]), int(last[i]) + LENGTH
                left, right = data[a : p[i] - LEFT].tobytes(), data[p[i] + RIGHT : b].tobytes()
                rows.append((int(c) % fragments, r["doc_id"], r["row"], int(c), int(p[i]), a, int(last[i]), left[::-1], right))
        rows.sort(key=lambda r: (r[0], r[8]))
        for i in range(0, len(rows), 4096):
            yield rows_to_batch(rows[i : i + 4096], _REACH)


def interleave(start: np.ndarray, suffixes: list[bytes], depth: int) -> np.ndarray:
    """Intervals of suffixes by depth, shape (depth + 1, suffixes).

    ``start`` are intervals at depth 0. Round k parts each interval by byte k; a suffix that
    has ended is an interval of its own, so it shares none. Order is refined, never redone:
    a round places suffixes stably by (interval, byte).
    """
    n = len(suffixes)
    chars = np.full((n, depth), -1, np.int64)
    for row, s in zip(chars, suffixes):
        row[: min(depth, len(s))] = np.frombuffer(s[:depth], np.uint8)
    out = np.empty((depth + 1, n), np.int64)
    order = np.argsort(start, kind="stable")
    interval = start.astype(np.int64)
    out[0] = interval
    for k in range(depth):
        # Within intervals, which are runs of ``order``, the next byte decides.
        key = interval[order] * 512 + chars[order, k] + 1
        place = np.argsort(key, kind="stable")
        order, key = order[place], key[place]
        parts = np.r_[True, (key[1:] != key[:-1]) | (chars[order[1:], k] < 0)] if n else np.zeros(0, bool)
        interval = np.empty(n, np.int64)
        interval[order] = np.cumsum(parts)
        out[k + 1] = interval
    return out


_FOUND = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("starts", pa.list_(pa.int64()))])


def _merged(table: pa.Table) -> pa.Table:
    """One fragment: window starts that repeat, of the anchors that were sent."""
    rows = table.to_pylist()
    _, core = np.unique(np.array([r["core"] for r in rows]), return_inverse=True)
    right = interleave(core, [r["right"] for r in rows], SIDE)
    left = interleave(core, [r["left"] for r in rows], SIDE)
    at, first, last = (np.array([r[k] for r in rows]) for k in ("at", "first", "last"))
    found: list[list[int]] = [[] for _ in rows]
    for d in range(NEAR, FAR + 1):
        # A window that starts d bytes before the anchor.
        use = np.flatnonzero((at - d >= first) & (at - d <= last))
        if len(use) < 2:
            continue
        pair = np.stack([left[d - LEFT, use], right[LENGTH - d - RIGHT, use]], axis=1)
        _, which, count = np.unique(pair, axis=0, return_inverse=True, return_counts=True)
        for i in use[count[which.reshape(-1)] > 1]:
            found[i].append(int(at[i]) - d)
    out = [(r["doc_id"], r["row"], f) for r, f in zip(rows, found) if f]
    return pa.Table.from_batches([rows_to_batch(out, _FOUND)])


_OUT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_bytes", pa.int64()),
        ("n_removed", pa.int64()),
        ("n_spans", pa.int64()),
        ("kept_sha256", pa.string()),
        ("removed", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))),
    ]
)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            data = np.frombuffer((r["text"] or "").encode(), np.uint8)
            _, p, first, last = judged(data, np.array([0, len(data)]), Rolling(data))
            all_ = np.array(r["at"], np.int64)[np.frombuffer(r["state"], np.uint8) & _REPEATS > 0]
            known = np.isin(p, all_)
            a = np.concatenate([first[known], np.array(r["starts"] or [], np.int64)])
            b = np.concatenate([last[known] + LENGTH, np.array(r["starts"] or [], np.int64) + LENGTH])
            depth = np.bincount(a, minlength=len(data) + 1) - np.bincount(b, minlength=len(data) + 1)
            gone = np.cumsum(depth)[: len(data)] > 0
            edge = np.flatnonzero(np.diff(np.concatenate(([0], gone, [0]))))
            spans = [dict(start=int(s), length=int(e - s)) for s, e in zip(edge[::2], edge[1::2])]
            sha = hashlib.sha256(data[~gone].tobytes()).hexdigest()
            out.append((r["doc_id"], len(data), int(gone.sum()), len(spans), sha, spans))
        for i in range(0, len(out), 1024):
            yield rows_to_batch(out[i : i + 1024], _OUT)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, removed.

    ``removed`` lists the removed runs as (start, length) in bytes, ascending. A null text is
    empty; a text shorter than ``LENGTH`` keeps all. Repeated rows repeat each other's
    strings, each row has a result. Null ids are ids like others. An empty table gives an
    empty result. Other columns are not read.
    """
    spark = docs.sparkSession
    partitions = shuffle_partitions(spark)
    bits = max(5, (2 * partitions - 1).bit_length())
    rows = id_and_text(docs, id_col, text_col).select("doc_id", "text", row_key().alias("row"))
    shards = rows.mapInArrow(lambda b: _shards(bits, b), spark_schema(_SHARD))
    states = shards.groupBy("fragment").applyInArrow(_cores, spark_schema(_STATE))
    found = stable(states.groupBy("shard").applyInArrow(_documents, spark_schema(_DOC)))
    clean = found.where("size(at) = 0").select(
        "doc_id",
        "n_bytes",
        F.lit(0).cast("long").alias("n_removed"),
        F.lit(0).cast("long").alias("n_spans"),
        F.col("sha256").alias("kept_sha256"),
        F.array().cast("array<struct<start:bigint,length:bigint>>").alias("removed"),
    )
    # Repeated rows have equal states in number; one state serves them all.
    marked = found.where("size(at) > 0").select(F.col("doc_id").alias("m_doc"), F.col("row").alias("m_row"), F.struct("at", "state").alias("s"))
    marked = marked.groupBy("m_doc", "m_row").agg(F.collect_list("s").alias("s"))
    marked = marked.select("m_doc", "m_row", _joined_at(), _joined_state())
    same = (F.col("row") == F.col("m_row")) & F.col("doc_id").eqNullSafe(F.col("m_doc"))
    held = stable(rows.join(marked, same).select("doc_id", "row", "text", "at", "state"))
    reaches = held.where(F.expr("locate(X'02', state) > 0 or locate(X'03', state) > 0")).dropDuplicates(["doc_id", "row"])
    reaches = reaches.mapInArrow(lambda b: _reaches(4 * partitions, b), spark_schema(_REACH))
    windows = reaches.groupBy("fragment").applyInArrow(_merged, spark_schema(_FOUND))
    starts = windows.groupBy(F.col("doc_id").alias("w_doc"), F.col("row").alias("w_row")).agg(F.flatten(F.collect_list("starts")).alias("starts"))
    met = (F.col("row") == F.col("w_row")) & F.col("doc_id").eqNullSafe(F.col("w_doc"))
    cut = held.join(starts, met, "left").select("doc_id", "text", "at", "state", "starts").mapInArrow(_cut, spark_schema(_OUT))
    return clean.unionByName(cut)


def _joined_at():
    return F.flatten(F.transform("s", lambda x: x["at"])).alias("at")


def _joined_state():
    return F.unhex(F.array_join(F.transform("s", lambda x: F.hex(x["state"])), "")).alias("state")
