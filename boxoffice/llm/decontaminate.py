"""Benchmark passages in documents: q-gram lemma filter, then banded alignment.

A document holds a benchmark item if some window of ``WINDOW`` characters of the item, wherever
it starts, is within its edit budget (a tenth of its length) of some stretch of the text. By
the q-gram lemma such a stretch shares at least ``length + 1 - Q * (edits + 1)`` q-grams with
the window, all on diagonals that differ by no more than twice the budget. So the q-grams that
a text shares with an item are put into overlapping bands of diagonals; every window that has
as many of them in a band as the bound asks is verified, by plain comparison where its q-grams
follow each other on one diagonal and by an alignment within the band elsewhere.

Items under ``LEAST_CHARS`` characters have no budget worth filtering. On demand (``short``)
they are looked for as they are, between word bounds.

Texts are compared in lower case (A-Z, and capitals from U+00C0 to U+00DE), every run of white
space as one space. Places are reported in code points of the original text.

Scale. Documents are read once, where they lie, whole, without a shuffle; long ones in parts
that overlap by more than a window. The benchmark is taken in slices of a bounded number of
characters; each slice is sent to the tasks and passed over the documents, so a larger
benchmark means more slices, not larger ones.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxoffice.llm.common import utf8_parts

Q = 8
WINDOW = 80
#: Items with fewer characters are matched only exactly, and only on demand.
LEAST_CHARS = 24
#: Diagonals in one cell; a band is two neighbouring cells. At least twice the edit budget.
_CELL = 16
SLICE_CHARS = 4_000_000
_PART = 1 << 20
#: Longer items are indexed in pieces of so many window starts.
_PIECE = 1 << 16
_BITS = 22


def edit_budget(length: int) -> int:
    """A tenth of the length, and no more than the q-gram lemma can filter."""
    return max(0, min(length // 10, (length - Q) // Q))


def plain(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Compared form of code points, and where each character stood. 0 separates texts."""
    lower = codes.copy()
    capital = ((codes >= 65) & (codes <= 90)) | ((codes >= 0xC0) & (codes <= 0xDE) & (codes != 0xD7))
    lower[capital] += 32
    space = (codes == 32) | ((codes >= 9) & (codes <= 13))
    lower[space] = 32
    keep = np.ones(len(codes), bool)
    keep[1:] = ~(space[1:] & space[:-1])
    at = np.flatnonzero(keep)
    return lower[at], at


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint32)


def grams(chars: np.ndarray) -> np.ndarray:
    """A number for each q-gram: equal q-grams have equal numbers (not the reverse)."""
    if len(chars) < Q:
        return np.zeros(0, np.uint64)
    byte = ((chars ^ (chars >> 8) ^ (chars >> 16)) & 0xFF).astype(np.uint64)
    two = byte[:-1] | (byte[1:] << np.uint64(8))
    four = two[:-2] | (two[2:] << np.uint64(16))
    return four[:-4] | (four[4:] << np.uint64(32))


def item_chars(text: str | None) -> np.ndarray:
    """An item's compared form."""
    return plain(code_points((text or "").strip(" \t\n\v\f\r").replace("\0", " ")))[0]


def item_windows(text: str | None) -> list[np.ndarray]:
    """All windows of an item's compared form."""
    chars = item_chars(text)
    if len(chars) < LEAST_CHARS:
        return []
    return [chars[s : s + WINDOW] for s in range(max(0, len(chars) - WINDOW) + 1)]


@dataclass
class BandIndex:
    """The q-grams of items: which piece of an item and where, by gram."""

    item: np.ndarray  # of each piece
    chars: np.ndarray  # pieces one after the other
    begin: np.ndarray  # of each piece in chars
    size: np.ndarray
    gram: np.ndarray  # sorted, one for each posting
    piece: np.ndarray
    place: np.ndarray
    short: list[tuple[int, np.ndarray]]  # items that are matched as they are

    @classmethod
    def of(cls, items: list[tuple[int | None, str | None]], short: bool = False) -> BandIndex:
        found, exact = [], []
        for i, (_, text) in enumerate(items):
            chars = item_chars(text)
            if len(chars) >= LEAST_CHARS:
                starts = range(0, max(1, len(chars) - WINDOW + 1), _PIECE)
                found += [(i, chars[s : s + _PIECE + WINDOW - 1]) for s in starts]
            elif short and len(chars):
                exact.append((i, chars))
        size = np.array([len(c) for _, c in found], np.int64)
        each = [grams(c) for _, c in found]
        gram = np.concatenate(each) if each else np.zeros(0, np.uint64)
        piece = np.repeat(np.arange(len(found)), [len(g) for g in each]).astype(np.int64)
        place = np.concatenate([np.arange(len(g)) for g in each]) if each else np.zeros(0, np.int64)
        order = np.argsort(gram, kind="stable")
        chars = np.concatenate([c for _, c in found]) if found else np.zeros(0, np.uint32)
        item = np.array([i for i, _ in found], np.int64)
        return cls(item, chars, np.cumsum(size) - size, size, gram[order], piece[order], place[order], exact)

    def prepare(self) -> None:
        """What a task works out once."""
        self.table = np.zeros(1 << _BITS, bool)
        self.distinct, self.first, self.count = np.unique(self.gram, return_index=True, return_counts=True)
        self.table[_slot(self.distinct)] = True
        self.length = np.minimum(self.size, WINDOW)
        self.edits = np.array([edit_budget(n) for n in self.length], np.int64)
        self.bound = self.length + 1 - Q * (self.edits + 1)
        # Added to diagonals, so that none is negative and a cell comes before the first.
        self.shift = _CELL * (int(self.size.max(initial=0)) // _CELL + 2)
        self.words = _word_hashes(self.short)

    def hits(self, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(piece, place, shifted diagonal) of shared q-grams in bands that reach the bound."""
        key = grams(chars)
        at = np.flatnonzero(self.table[_slot(key)])
        slot = np.searchsorted(self.distinct, key[at])
        slot[slot == len(self.distinct)] = 0
        real = self.distinct[slot] == key[at] if len(self.distinct) else np.zeros(len(at), bool)
        at, slot = at[real], slot[real]
        n = self.count[slot]
        posting = np.repeat(self.first[slot] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
        piece, place = self.piece[posting], self.place[posting]
        diagonal = np.repeat(at, n) - place + self.shift
        cells, of, counts = np.unique((piece << 40) | (diagonal // _CELL), return_inverse=True, return_counts=True)
        # A band is a cell with the one after it, whether or not either has hits.
        beside = np.zeros((2, len(cells)), np.int64)
        if len(cells) > 1:
            next_to = cells[1:] == cells[:-1] + 1
            beside[0, :-1], beside[1, 1:] = np.where(next_to, counts[1:], 0), np.where(next_to, counts[:-1], 0)
        full = (counts + beside.max(axis=0) >= self.bound[cells >> 40])[of]
        return piece[full], place[full], diagonal[full]

    def exact(self, chars: np.ndarray, piece, place, diagonal) -> Iterator[tuple[int, int, int, int]]:
        """(piece, first place, shifted diagonal, characters) of equal stretches of a window or more."""
        order = np.lexsort((place, diagonal, piece))
        piece, place, diagonal = piece[order], place[order], diagonal[order]
        if len(piece) == 0:
            return
        new = np.r_[True, (piece[1:] != piece[:-1]) | (diagonal[1:] != diagonal[:-1]) | (place[1:] != place[:-1] + 1)]
        first = np.flatnonzero(new)
        reach = np.diff(np.append(first, len(piece))) + Q - 1
        for f, n in zip(first, reach):
            if n < self.length[piece[f]]:
                continue
            at, there = place[f] + diagonal[f] - self.shift, self.begin[piece[f]] + place[f]
            # Unequal q-grams may have equal numbers; such stretches are left to the alignment.
            if np.array_equal(chars[at : at + n], self.chars[there : there + n]):
                yield int(piece[f]), int(place[f]), int(diagonal[f]), int(n)

    def candidates(self, piece, place, diagonal, equal) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(piece, start of the window, first diagonal of the band) of windows that reach the bound.

        Without those that ``exact`` has found in the band.
        """
        if len(piece) == 0:
            return piece, place, diagonal
        bands, places = int(diagonal.max()) // _CELL + 2, int(self.size.max()) + 1
        own = np.unique((piece * bands + diagonal // _CELL) * places + place)
        # The band one cell earlier counts if it has hits of its own in that cell; if not,
        # the cell's own band has all of them.
        before = own - places
        cells = np.unique(own // places)
        at = np.minimum(np.searchsorted(cells, before // places), len(cells) - 1)
        keys = np.unique(np.concatenate([own, before[cells[at] == before // places]]))
        group, where = keys // places, keys % places
        of = group // bands
        last = np.arange(len(keys)) + self.bound[of] - 1
        inside = last < len(keys)
        last = np.minimum(last, len(keys) - 1)
        span = self.length[of] - Q
        full = inside & (group[last] == group) & (where[last] - where <= span)
        low = np.maximum(0, where[last] - span)[full]
        high = np.minimum(where, (self.size - self.length)[of])[full]
        n = high - low + 1
        start = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
        windows = np.unique(np.repeat(group[full], n) * places + start)
        done = [
            (p * bands + d // _CELL - back) * places + np.arange(s, s + m - self.length[p] + 1)
            for p, s, d, m in equal
            for back in (0, 1)
        ]
        if done:
            windows = np.setdiff1d(windows, np.concatenate(done), assume_unique=False)
        group, start = windows // places, windows % places
        return group // bands, start, group % bands * _CELL - self.shift

    def shorts(self, chars: np.ndarray, opens: bool, ends: bool) -> Iterator[tuple[int, int, int]]:
        """(item, first character, end) of short items between word bounds.

        Unless the text ``opens`` or ``ends`` with ``chars``, a place at that edge is left to
        the part beside it.
        """
        if not self.words:
            return
        word = _word_table()[chars]
        bound = np.r_[opens, ~(word[1:] & word[:-1]), ends] if len(chars) else np.zeros(1, bool)
        power, back = _powers(len(chars))
        total = np.concatenate(([np.uint64(0)], np.cumsum((chars.astype(np.uint64) + np.uint64(1)) * power)))
        for n, (hashes, items) in self.words.items():
            at = np.flatnonzero(bound[: max(0, len(bound) - n)] & bound[n:])
            if len(at) == 0:
                continue
            value = (total[at + n] - total[at]) * back[at]
            low, high = np.searchsorted(hashes, value, "left"), np.searchsorted(hashes, value, "right")
            for j in np.flatnonzero(high > low):
                for k in range(low[j], high[j]):
                    item, text = items[k]
                    if np.array_equal(chars[at[j] : at[j] + n], text):
                        yield item, int(at[j]), int(at[j]) + n


#: Any odd number and its inverse: sums of characters times powers of it name stretches.
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)


@lru_cache(maxsize=4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_BASE, _BACK):
        each = np.full(max(1, n), base, np.uint64)
        each[0] = 1
        out.append(np.multiply.accumulate(each)[:n])
    return out[0], out[1]


def _word_hashes(short: list[tuple[int, np.ndarray]]) -> dict[int, tuple[np.ndarray, list[tuple[int, np.ndarray]]]]:
    """By length: hashes in order, and their items."""
    out: dict[int, list] = {}
    for item, chars in short:
        value = ((chars.astype(np.uint64) + np.uint64(1)) * _powers(len(chars))[0]).sum(dtype=np.uint64)
        out.setdefault(len(chars), []).append((int(value), item, chars))
    sets = {n: sorted(x, key=lambda y: y[:2]) for n, x in out.items()}
    return {n: (np.array([v for v, _, _ in x], np.uint64), [(i, c) for _, i, c in x]) for n, x in sets.items()}


@lru_cache(maxsize=1)
def _word_table() -> np.ndarray:
    """For each code point: is it a letter or digit?"""
    return np.array([chr(i).isalnum() for i in range(0x110000)], bool)


def _slot(key: np.ndarray) -> np.ndarray:
    return ((key * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _BITS)).astype(np.int64)


def align(
    patterns: np.ndarray, lengths: np.ndarray, limits: np.ndarray, regions: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Least edit distance of each pattern to any stretch of its region, and the stretch's end.

    A pair is given up when it can no longer stay within its limit; its distance is then some
    number above it.
    """
    n, width = regions.shape
    best, end = np.full(n, 1 << 14), np.zeros(n, np.int64)
    left = np.arange(n)  # who may still stay within the limit
    # A column for each pair. A 0 ends a text, so no stretch may hold one.
    text = regions.T
    price = np.where(text == 0, 100, 1).astype(np.int16)
    steps = np.concatenate([np.zeros((1, n), np.int16), np.cumsum(price, axis=0, dtype=np.int16)])
    row = np.zeros((width + 1, n), np.int16)
    for i in range(int(lengths.max(initial=0))):
        miss = np.where(text != patterns[left, i], price, np.int16(0))
        new = np.empty_like(row)
        new[0] = i + 1
        np.minimum(row[:-1] + miss, row[1:] + np.int16(1), out=new[1:])
        row = np.minimum.accumulate(new - steps, axis=0) + steps
        least = row.min(axis=0)
        done = lengths[left] == i + 1
        if done.any():
            at = left[done]
            best[at], end[at] = least[done], row[:, done].argmin(axis=0)
        go = ~done & (least <= limits[left])
        if done.any() or i % 8 == 7:
            left, text, price, steps, row = left[go], text[:, go], price[:, go], steps[:, go], row[:, go]
            if len(left) == 0:
                break
    return best, end


def leaks(
    index: BandIndex, chars: np.ndarray, owner: np.ndarray, opens: bool = True, ends: bool = True
) -> Iterator[tuple[int, int, int, int, int, int]]:
    """(row, item, first character, end, end of the closest window, distance) of verified windows.

    ``chars`` are texts one after the other with a 0 after each, ``owner`` the row of each
    character. Windows that follow each other without an edit come as one stretch. The first
    character is the end less the window's length.
    """
    for item, first, stop in index.shorts(chars, opens, ends):
        yield int(owner[first]), item, first, stop, stop, 0
    found = index.hits(chars)
    equal = list(index.exact(chars, *found))
    for piece, place, diagonal, n in equal:
        first = place + diagonal - index.shift
        yield int(owner[first]), int(index.item[piece]), first, first + n, first + int(index.length[piece]), 0
    pieces, starts, diagonals = index.candidates(*found, equal)
    width = 2 * _CELL + WINDOW + 2 * (WINDOW // 10)
    for a in range(0, len(pieces), 2048):
        w, s = pieces[a : a + 2048], starts[a : a + 2048]
        start = diagonals[a : a + 2048] + s - WINDOW // 10
        at = start[:, None] + np.arange(width)
        inside = (at >= 0) & (at < len(chars))
        regions = np.where(inside, chars[np.clip(at, 0, max(0, len(chars) - 1))], 0)
        place = (index.begin[w] + s)[:, None] + np.arange(WINDOW)
        patterns = index.chars[np.minimum(place, len(index.chars) - 1)]
        best, end = align(patterns, index.length[w], index.edits[w], regions)
        for j in np.flatnonzero(best <= index.edits[w]):
            stop = int(start[j] + end[j])
            first = max(0, stop - int(index.length[w[j]]))
            yield int(owner[stop - 1]), int(index.item[w[j]]), first, stop, stop, int(best[j])


_HIT = "array<struct<item_id:bigint,start:bigint,length:bigint,distance:int>>"
_HITS = pa.list_(
    pa.struct([("item_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("distance", pa.int32())])
)
_FOUND = ["leaks", "regions"]


def _slices(benchmark: DataFrame) -> Iterator[list[tuple[int | None, str | None]]]:
    """The benchmark in parts of about ``SLICE_CHARS`` characters, one at a time."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    items = items.where("text is not null").distinct()
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-int(total) // SLICE_CHARS)
    for k in range(n):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).collect()
        yield sorted(((r["item_id"], r["text"]) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def with_leaks(rows: DataFrame, benchmark: DataFrame, text_col: str = "text", short: bool = False) -> DataFrame:
    """``row`` (a struct of all columns of ``rows``), ``leaks`` and ``regions``, row by row.

    ``leaks`` has for each benchmark item that the text holds its closest window: item_id,
    start and length in code points of the text, edit distance. ``regions`` has, for the same
    items, all stretches that verified windows cover, in order of item and start: windows that
    overlap or touch are one region, with the least distance among them. A stretch that was
    aligned begins its window's length before its end. Nothing leaks into a null or
    empty text, nor from items that are null or empty, nor, unless ``short``, from those under
    ``LEAST_CHARS``; repeated items count once, items of one id together.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
    out = rows.select(row.alias("row"), F.col(f"`{text_col}`").cast("string").alias("text"), *[F.array().cast(_HIT).alias(c) for c in _FOUND])
    spark = rows.sparkSession
    schema = f"row {out.schema['row'].dataType.simpleString()}, text string, leaks {_HIT}, regions {_HIT}"
    for items in _slices(benchmark):
        index = spark.sparkContext.broadcast(BandIndex.of(items, short))
        names = spark.sparkContext.broadcast([i for i, _ in items])
        out = out.mapInArrow(_finder(index, names), schema)
    return out.select("row", *_FOUND)


def _united(spans: Iterable[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Maximal (start, end, least distance) of spans that overlap or touch."""
    out: list[tuple[int, int, int]] = []
    for start, end, distance in sorted(spans):
        if out and start <= out[-1][1]:
            first, last, least = out[-1]
            out[-1] = (first, max(last, end), min(least, distance))
        else:
            out.append((start, end, distance))
    return out


def _finder(index_, names_):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, names = index_.value, names_.value
        index.prepare()
        for batch in batches:
            held: list[dict] = [{} for _ in range(batch.num_rows)]
            spans: list[dict] = [{} for _ in range(batch.num_rows)]
            for first, data, starts in utf8_parts(batch.column(1), _PART):
                for row, number, start, length, window, distance in _part(index, data, starts):
                    hit = (distance, start, window)
                    item = names[number]
                    held[first + row][item] = min(hit, held[first + row].get(item, hit))
                    spans[first + row].setdefault(item, []).append((start, start + length, distance))
            by_id = lambda x: sorted(x.items(), key=lambda y: (y[0] is None, y[0] or 0))
            close = [[dict(item_id=i, start=s, length=n, distance=d) for i, (d, s, n) in by_id(x)] for x in held]
            whole = [
                [dict(item_id=i, start=s, length=e - s, distance=d) for i, x in by_id(y) for s, e, d in _united(x)]
                for y in spans
            ]
            columns = [batch.column(0), batch.column(1)]
            for place, new in ((2, close), (3, whole)):
                if any(batch.column(place).value_lengths().to_pylist()):
                    new = [a + b for a, b in zip(batch.column(place).to_pylist(), new)]
                columns.append(pa.array(new, _HITS))
            yield pa.RecordBatch.from_arrays(columns, names=["row", "text", *_FOUND])

    return find


def _part(index: BandIndex, data: np.ndarray, starts: np.ndarray) -> Iterator[tuple[int, int, int, int, int, int]]:
    """Hits (row, item, start, length, length of the closest window, distance) in consecutive rows of UTF-8 bytes."""
    codes = code_points(data.tobytes().decode("utf-8", "replace"))
    lead = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    begin = lead[starts]
    # A 0 after each row keeps q-grams from crossing; a 0 inside a text counts as a space.
    codes = np.insert(np.where(codes == 0, 32, codes), begin[1:], 0).astype(np.uint32)
    begin = begin + np.arange(len(begin))
    chars, at = plain(codes)
    owner = np.searchsorted(begin, at, "right") - 1
    step, overlap = _PART, 4 * WINDOW
    seen = set()
    for a in range(0, max(1, len(chars)), step):
        b = min(len(chars), a + step + overlap)
        for row, item, first, stop, close, distance in leaks(index, chars[a:b], owner[a:b], a == 0, b == len(chars)):
            start = max(int(at[a + first]), int(begin[row]))
            length, window = (int(at[a + x - 1]) + 1 - start for x in (stop, close))
            hit = (row, item, start - int(begin[row]), length, window, distance)
            if hit not in seen:
                seen.add(hit)
                yield hit


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", short: bool = False
) -> DataFrame:
    """One row per document: doc_id, contaminated, n_items, leaks, regions (see ``with_leaks``)."""
    picked = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return with_leaks(picked, benchmark, short=short).select(
        F.col("row.doc_id").alias("doc_id"),
        (F.size("leaks") > 0).alias("contaminated"),
        F.size("leaks").cast("long").alias("n_items"),
        *_FOUND,
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, short: bool = False) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark passage, with all their columns."""
    return with_leaks(docs, benchmark, short=short).where(F.size("leaks") == 0).select("row.*")
