"""Exact duplicates: Patricia tries whose terminal nodes name the owner of a text.

Texts are equal when they are identical after all white space of ``[\\x20\\x09-\\x0D]`` is
taken out. Rows are dealt to tasks by length and content hash of that normal form; each task
inserts the full byte strings into a compressed radix trie. A terminal node keeps the best
row seen so far, which is the text's owner.

Scale. Copies meet twice. Each task first inserts the rows it reads into a trie of its own,
so that of a group of copies only one string per task is shuffled, however large the group
is; the string is written once to the shared folder, and rows refer to it by a number. The
second tries, one per partition, see each string once per first task. Both have a memory
bound: the heaviest subtree is moved to a file of the task and finished later on its own.
"""

from __future__ import annotations

import hashlib
import os
import pickle
import tempfile
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxoffice.llm.common import WHITESPACE, id_and_text, rows_to_batch, shuffle_partitions, spark_schema
from boxoffice.session import stable

#: Bytes of strings that a task's trie may hold before subtrees are spilled.
TRIE_BYTES = 128 << 20
_CHUNK_BYTES, _CHUNK_ROWS = 8 << 20, 8192


class _Node:
    __slots__ = ("children", "label", "value")

    def __init__(self, label: bytes, value: Any = None):
        self.label, self.value, self.children = label, value, {}


class PatriciaTrie:
    """Byte strings in a compressed radix trie; equal strings have their values merged.

    ``merge(old, new)`` must not depend on the order of insertions. When the strings held
    exceed ``limit`` bytes, the heaviest subtree under the root is written to a temporary
    file; strings that belong to it follow it there, and ``items`` finishes one spilled
    subtree at a time. A spilled subtree that is itself too large is spilled again below
    its common prefix.
    """

    def __init__(self, merge: Callable[[Any, Any], Any], limit: int = TRIE_BYTES, depth: int = 0):
        self._merge, self._limit, self._depth = merge, limit, depth
        self._root = _Node(b"")
        self._weight: dict[int, int] = {}
        self._files: dict[int, Any] = {}
        self.spills = 0

    def insert(self, text: bytes, value: Any) -> None:
        branch = text[self._depth] if len(text) > self._depth else -1
        if branch in self._files:
            pickle.dump((text, value), self._files[branch])
            return
        self._weight[branch] = self._weight.get(branch, 0) + self._add(text, value)
        if branch >= 0 and sum(self._weight.values()) > self._limit:
            self._spill()

    def _add(self, text: bytes, value: Any) -> int:
        """Insert below the root; returns the bytes that are now held in addition."""
        node, at = self._root, 0
        while True:
            if at == len(text):
                node.value = value if node.value is None else self._merge(node.value, value)
                return 0
            child = node.children.get(text[at])
            if child is None:
                node.children[text[at]] = _Node(text[at:], value)
                return len(text) - at + 200
            label = child.label
            if text.startswith(label, at):
                node, at = child, at + len(label)
                continue
            low, high = 1, min(len(label), len(text) - at)
            while low < high:  # longest common prefix by halving
                middle = (low + high + 1) // 2
                if label[:middle] == text[at : at + middle]:
                    low = middle
                else:
                    high = middle - 1
            parted = _Node(label[:low])
            child.label = label[low:]
            parted.children[child.label[0]] = child
            node.children[text[at]] = parted
            node, at = parted, at + low
            if at == len(text):
                node.value = value
                return 200
            node.children[text[at]] = _Node(text[at:], value)
            return len(text) - at + 400

    def _spill(self) -> None:
        heavy = max((b for b in self._weight if b >= 0), key=self._weight.get)
        file = tempfile.TemporaryFile()  # gone with the task
        for text, value in self._walk(lambda b: b == heavy):
            pickle.dump((text, value), file)
        self._cut(heavy)
        self._files[heavy] = file
        self._weight[heavy] = 0
        self.spills += 1

    def _parent(self) -> tuple[_Node, bytes]:
        """The node at which strings part by their byte at ``depth``, and the prefix above."""
        node, prefix = self._root, b""
        while len(prefix) < self._depth:
            (child,) = node.children.values()
            if len(prefix) + len(child.label) > self._depth:
                break
            node, prefix = child, prefix + child.label
        return node, prefix

    def _cut(self, branch: int) -> None:
        node, prefix = self._parent()
        for first, child in list(node.children.items()):
            if (prefix + child.label)[self._depth] == branch:
                del node.children[first]

    def _walk(self, wanted: Callable[[int], bool]) -> Iterator[tuple[bytes, Any]]:
        stack = [(self._root, b"")]
        while stack:
            node, prefix = stack.pop()
            text = prefix + node.label
            if len(text) > self._depth and not wanted(text[self._depth]):
                continue
            if node.value is not None and (len(text) > self._depth or wanted(-1)):
                yield text, node.value
            stack += [(child, text) for child in node.children.values()]

    def items(self) -> Iterator[tuple[bytes, Any]]:
        """Every string once, with its merged value. The trie is used up."""
        yield from self._walk(lambda b: b not in self._files)
        self._root = _Node(b"")
        for file in self._files.values():
            yield from self._spilled(file)

    def _spilled(self, file: Any) -> Iterator[tuple[bytes, Any]]:
        def read() -> Iterator[tuple[bytes, Any]]:
            file.seek(0)
            while True:
                try:
                    yield pickle.load(file)
                except EOFError:
                    return

        common: bytes | None = None
        for text, _ in read():
            if common is None:
                common = text
            elif not text.startswith(common):
                common = os.path.commonprefix([common, text])
        # Deeper than the byte that all share, so every level has smaller subtrees.
        below = PatriciaTrie(self._merge, self._limit, len(common or b""))
        for text, value in read():
            below.insert(text, value)
        file.close()
        yield from below.items()


def _better(a: tuple, b: tuple) -> tuple:
    """Values are (code points, doc_id, row, count, refs): most code points, then smallest id."""
    first = min(a, b, key=lambda v: (-v[0], v[1] is None, v[1] or 0, v[2]))
    a[4].extend(b[4])
    return (*first[:3], a[3] + b[3], a[4])


def _own_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per document, and the string with the first of equal rows in this chunk."""
    base, row = TaskContext.get().partitionId() << 33, 0

    def chunk(rows: list[tuple]) -> pa.RecordBatch:
        trie = PatriciaTrie(_better)
        for row_id, doc_id, points, text in rows:
            trie.insert(text, (points, doc_id, row_id, 1, [row_id]))
        own = {}
        for text, value in trie.items():
            for row_id in value[4]:
                own[row_id] = (value, text if row_id == value[2] else None)
        out = []
        for row_id, doc_id, points, _ in rows:
            value, text = own[row_id]
            string = (None,) * 4
            if text is not None:
                string = (value[3], text, len(text), hashlib.sha256(text).hexdigest())
            out.append((row_id, doc_id, value[2], points, *string))
        return rows_to_batch(out, _OWN)

    rows, held = [], 0
    for batch in batches:
        ids, texts = batch.column(0).to_pylist(), batch.column(1)
        points = pc.fill_null(pc.utf8_length(texts), 0).to_pylist()
        for i, text in enumerate(texts.cast(pa.binary())):
            normal = (text.as_py() or b"").translate(None, WHITESPACE)
            rows.append((base + row, ids[i], points[i], normal))
            row, held = row + 1, held + len(normal)
            if held > _CHUNK_BYTES or len(rows) == _CHUNK_ROWS:
                yield chunk(rows)
                rows, held = [], 0
    if rows:
        yield chunk(rows)


_OWN = pa.schema(
    [
        ("row_id", pa.int64()),
        ("doc_id", pa.int64()),
        ("ref", pa.int64()),
        ("n_chars", pa.int64()),
        ("count", pa.int64()),
        ("normal", pa.binary()),
        ("n_bytes", pa.int64()),
        ("text_sha256", pa.string()),
    ]
)


def _owners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Insert a partition's strings and name the owner of each row's string."""
    trie, hashes = PatriciaTrie(_better), {}
    for batch in batches:
        for r in batch.to_pylist():
            hashes[r["ref"]] = r["text_sha256"]
            trie.insert(r["normal"], (r["n_chars"], r["doc_id"], r["ref"], r["count"], [r["ref"]]))
    out = []
    for _, (_, doc_id, row_id, count, refs) in trie.items():
        for ref in refs:
            out.append((ref, doc_id, row_id, count, hashes[ref]))
            if len(out) == 10_000:
                yield rows_to_batch(out, _OWNERS)
                out = []
    if out:
        yield rows_to_batch(out, _OWNERS)


_OWNERS = pa.schema(
    [
        ("ref", pa.int64()),
        ("keep_id", pa.int64()),
        ("keep_row", pa.int64()),
        ("group_size", pa.int64()),
        ("text_sha256", pa.string()),
    ]
)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, n_chars.

    Of equal texts the row with the most code points stays, then the one with the smallest
    id (null last), then the first row. A null text is empty; all empty texts are one group.
    Repeated rows are copies like any other, so exactly one of them stays. An empty table
    gives an empty result. Other columns of ``docs`` are not read.
    """
    spark = docs.sparkSession
    own = stable(
        id_and_text(docs, id_col, text_col).mapInArrow(
            _own_rows, spark_schema(_OWN)
        )
    )
    owners = (
        own.where("normal is not null")
        .select("ref", "doc_id", "n_chars", "count", "normal", "n_bytes", "text_sha256")
        .repartition(shuffle_partitions(spark), "n_bytes", "text_sha256")
        .mapInArrow(
            _owners, spark_schema(_OWNERS)
        )
    )
    return (
        own.select("row_id", "doc_id", "ref", "n_chars")
        .join(owners, "ref")
        .select(
            "doc_id",
            "keep_id",
            "group_size",
            (F.col("row_id") == F.col("keep_row")).alias("kept"),
            "text_sha256",
            "n_chars",
        )
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that own their text, with all their columns.

    Of rows that are equal in id and text one stays.
    """
    verdicts = exact_dedup(docs).where("kept").select("doc_id", "n_chars", "text_sha256")
    bare = F.translate(F.coalesce("text", F.lit("")), WHITESPACE.decode(), "")
    keys = {
        "doc_id": F.col("row.doc_id").cast("long"),
        "n_chars": F.length(F.coalesce("row.text", F.lit(""))).cast("long"),
        "text_sha256": F.sha2(F.col("bare").cast("binary"), 256),
    }
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), bare.alias("bare"))
    rows = rows.select("row", *[c.alias(f"k_{n}") for n, c in keys.items()])
    match = F.lit(True)
    for n in keys:
        match = match & F.col(f"k_{n}").eqNullSafe(F.col(n))
    kept = rows.join(verdicts, match, "left_semi")
    return kept.dropDuplicates(["k_doc_id", "k_n_chars", "k_text_sha256"]).select("row.*")
