"""Hierarchical packing of documents into sequences of several context sizes.

A document's ids are first cut into whole windows of the longest tier; what remains is routed
to the shortest tier that holds it. Every tier is packed best fit, longest piece first. Gaps
of long windows are then filled from the shorter tiers: the longest piece that still fits,
and at last a cut piece that fills the gap to the end. Sequences are dealt to step groups so
that each group gets about the same number of ids.

Scale. Documents are packed in pools of ``pool_ids`` ids, where they are read and without a
shuffle. All sequences of a pool are full but at most one, which bounds the padding by one
window per pool. A pool is the unit that one task holds; a document with more ids than a
pool is cut into whole windows as it comes.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from boxoffice.llm.common import id_and_text, spark_schema
from boxoffice.llm.tokens import encoder

#: Context sizes of the tiers, in ids.
TIERS = (256, 512, 1024, 2048)


class Piece(NamedTuple):
    """``length`` ids of document ``doc`` (a number within the pool) from ``start``."""

    doc: int
    start: int
    length: int


@dataclass
class Window:
    size: int
    pieces: list[Piece] = field(default_factory=list)
    gap: int = -1

    def __post_init__(self) -> None:
        if self.gap < 0:
            self.gap = self.size

    def put(self, piece: Piece) -> None:
        self.pieces.append(piece)
        self.gap -= piece.length


class _Shelf:
    """Pieces by length; gives the longest that fits."""

    def __init__(self) -> None:
        self._lengths: list[int] = []
        self._pieces: dict[int, list[Piece]] = {}

    def add(self, piece: Piece) -> None:
        if piece.length not in self._pieces:
            insort(self._lengths, piece.length)
            self._pieces[piece.length] = []
        self._pieces[piece.length].append(piece)

    def take(self, most: int) -> Piece | None:
        at = bisect_left(self._lengths, most + 1) - 1
        return self._pop(at) if at >= 0 else None

    def longest(self) -> Piece | None:
        return self._pop(len(self._lengths) - 1) if self._lengths else None

    def _pop(self, at: int) -> Piece:
        length = self._lengths[at]
        piece = self._pieces[length].pop()
        if not self._pieces[length]:
            del self._pieces[length], self._lengths[at]
        return piece


def pack_pool(lengths: list[int], tiers: tuple[int, ...] = TIERS) -> list[Window]:
    """Windows for documents of the given lengths; every id lies in exactly one piece."""
    longest = tiers[-1]
    windows: list[Window] = []
    shelves = {t: _Shelf() for t in tiers}
    for doc, n in enumerate(lengths):
        whole = n // longest * longest
        for start in range(0, whole, longest):
            windows.append(Window(longest))
            windows[-1].put(Piece(doc, start, longest))
        if n > whole:
            tier = next(t for t in tiers if n - whole <= t)
            shelves[tier].add(Piece(doc, whole, n - whole))
    for i in range(len(tiers) - 1, -1, -1):
        while piece := shelves[tiers[i]].longest():
            window = Window(tiers[i])
            window.put(piece)
            for tier in reversed(tiers[: i + 1]):
                while window.gap and (more := shelves[tier].take(window.gap)):
                    window.put(more)
            while window.gap and (more := next((p for t in tiers[: i + 1] if (p := shelves[t].longest())), None)):
                # No whole piece fits: cut one, and route its rest anew.
                cut = min(window.gap, more.length)
                window.put(Piece(more.doc, more.start, cut))
                rest = Piece(more.doc, more.start + cut, more.length - cut)
                if rest.length:
                    shelves[next(t for t in tiers if rest.length <= t)].add(rest)
            windows.append(window)
    return windows


def step_groups(windows: list[Window], groups: int) -> list[int]:
    """A group per window: longest first, always to the group with the fewest ids."""
    load = [(0, g) for g in range(groups)]
    chosen = [0] * len(windows)
    for i in sorted(range(len(windows)), key=lambda i: windows[i].gap - windows[i].size):
        ids, group = heapq.heappop(load)
        chosen[i] = group
        heapq.heappush(load, (ids + windows[i].size - windows[i].gap, group))
    return chosen


_PIECE = pa.struct(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("offset", pa.int64()),
        ("doc_tokens", pa.int64()),
    ]
)
_OUT = pa.schema(
    [
        ("sequence_id", pa.int64()),
        ("tier", pa.int32()),
        ("step_group", pa.int32()),
        ("n_ids", pa.int32()),
        ("input_ids", pa.binary()),
        ("pieces", pa.list_(_PIECE)),
    ]
)


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int | None,
    tiers: tuple[int, ...] = TIERS,
    pool_ids: int = 1 << 22,
    groups: int = 8,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per sequence: sequence_id, tier, step_group, n_ids, input_ids, pieces.

    ``input_ids`` are uint32, little-endian, without padding; a trainer pads a sequence that
    is shorter than its tier. ``pieces`` lists what lies where. A null text is empty and, with
    an end id, one id long; a document without ids has no piece. Repeated rows and ids are
    packed row by row. An empty table gives no sequences. Other columns are not read.
    """
    if list(tiers) != sorted(set(tiers)):
        raise ValueError("tiers must ascend")

    def emit(pool: list[tuple[int | None, np.ndarray]], first: int) -> Iterator[pa.RecordBatch]:
        windows = pack_pool([len(ids) for _, ids in pool], tiers)
        chosen = step_groups(windows, groups)
        for at in range(0, len(windows), 512):
            rows = []
            for i in range(at, min(at + 512, len(windows))):
                window, parts, pieces, offset = windows[i], [], [], 0
                for p in window.pieces:
                    doc_id, ids = pool[p.doc]
                    parts.append(ids[p.start : p.start + p.length])
                    pieces.append((doc_id, p.start, p.length, offset, len(ids)))
                    offset += p.length
                data = np.concatenate(parts).astype("<u4").tobytes()
                rows.append((first + i, window.size, chosen[i], offset, data, pieces))
            columns = list(zip(*rows))
            names = [f.name for f in _PIECE]
            columns[5] = [[dict(zip(names, p)) for p in ps] for ps in columns[5]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, _OUT.types)], schema=_OUT
            )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, held, pool = encoder(tokenizer_path), 0, []
        number = TaskContext.get().partitionId() << 36
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = one.encode(text.as_py(), end_id)
                pool.append((doc_id, ids))
                held += len(ids)
                if held >= pool_ids or len(pool) == 1 << 16:
                    yield from emit(pool, number)
                    number += 1 << 24  # more than a pool has sequences
                    held, pool = 0, []
        if pool:
            yield from emit(pool, number)

    return id_and_text(docs, id_col, text_col).mapInArrow(pack, spark_schema(_OUT))
