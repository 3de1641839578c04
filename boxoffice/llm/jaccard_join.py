"""Documents whose word n-grams overlap, by vertical partitioning.

A document is the set of its n-grams (a document with fewer words: its whole sequence). The
n-grams have one global order, which is cut into fragments; every set is cut the same way, so
a fragment holds a segment of each set. Overlaps of two sets are counted in every fragment on
its own and summed per pair.

The order. An n-gram is a 64-bit hash; the leading bits name its fragment, so fragments are
even whatever the texts are. Within a fragment n-grams are ranked from rare to frequent. The
order by (rank, fragment) is the one in which prefixes are taken.

Candidates. Two sets with similarity t share an n-gram among the first
``n - ceil(t * n) + 1`` of each, and what follows their first common one must still be long
enough for the overlap that t asks of the two sizes. N-grams of one document alone link
nothing, so only prefixes' repeated n-grams are looked at; they are few.

Groups. Sets that are equal become one class first. Then the members of each prefix n-gram
are compared with one of them, the hub (the set with the fewest n-grams of its own): every set
with its best hub first, and with its other hubs if it is not in their component then. Only
then are members outside the hub's component compared with the
rest, and only if their components differ. So a group of copies costs rows in proportion to
its size, not all its pairs, and no link that could join two components is left out. That is
``jaccard_groups``. ``jaccard_join`` returns the links themselves: it verifies every candidate
pair of classes, so a group of n differing near copies costs, and gives, up to n * (n - 1) / 2
pairs.

Scale. Texts are read once. The n-grams are shuffled once, packed as arrays (a row for each
fragment and batch of documents, not for each n-gram), and what comes back are the ranks of
the repeated ones. The number of fragments follows ``spark.sql.shuffle.partitions``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxoffice.llm.common import id_and_text, row_key, rows_to_batch, shuffle_partitions, spark_schema
from boxoffice.llm.components import components
from boxoffice.session import stable

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_BATCH_GRAMS = 1 << 20
#: Hashes of words that a task remembers, to save time only.
_REMEMBER = 300_000


class GramHasher:
    """Sorted 64-bit hashes of a text's distinct word n-grams."""

    def __init__(self, words: int):
        self._words, self._known = words, {}

    def __call__(self, text: bytes) -> np.ndarray:
        words, known = text.translate(_LOWER).split(), self._known
        if not words:
            return np.zeros(0, np.uint64)
        if len(known) > _REMEMBER:
            known.clear()
        hashes = np.empty(len(words), np.uint64)
        for i, w in enumerate(words):
            h = known.get(w)
            if h is None:
                h = xxhash.xxh3_64_intdigest(w)
                if len(known) <= _REMEMBER:
                    known[w] = h
            hashes[i] = h
        n = min(self._words, len(words))
        out = np.full(len(words) - n + 1, n, np.uint64)
        for j in range(n):
            out = (out ^ hashes[j : len(words) - n + 1 + j]) * np.uint64(0x9FB21C651E98DF25)
            out ^= out >> np.uint64(29)
        out *= np.uint64(0xD6E8FEB86659FD93)
        out ^= out >> np.uint64(32)
        return np.unique(out)


_DOC = np.dtype([("doc_id", "<i8"), ("known", "u1"), ("row", "<i8"), ("n", "<i8"), ("digest", "V16")])
_BATCH = pa.schema(
    [
        ("batch", pa.int64()),
        ("fragment", pa.int32()),
        ("counts", pa.binary()),
        ("grams", pa.binary()),
        ("docs", pa.binary()),
    ]
)


def _segments(words: int, bits: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per fragment and batch of documents, and one with the documents themselves."""
    hasher, number = GramHasher(words), TaskContext.get().partitionId() << 24
    held: list[np.ndarray] = []
    docs: list[tuple[int | None, int]] = []
    n = 0

    def close() -> Iterator[pa.RecordBatch]:
        sizes = np.array([len(x) for x in held], np.int64)
        grams = np.concatenate(held) if held else np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(len(held)), sizes)
        fragment = (grams >> np.uint64(64 - bits)).astype(np.int64)
        order = np.argsort(fragment, kind="stable")
        grams, owner, cut = grams[order], owner[order], np.searchsorted(fragment[order], np.arange((1 << bits) + 1))
        names = np.zeros(len(docs), _DOC)
        names["doc_id"] = [0 if d is None else d for d, _ in docs]
        names["known"] = [d is not None for d, _ in docs]
        names["row"] = [r for _, r in docs]
        names["n"] = sizes
        names["digest"] = [np.void(hashlib.blake2b(x.tobytes(), digest_size=16).digest()) for x in held]
        rows: list[tuple] = [(number, number % (1 << bits), None, None, names.tobytes())]
        for f in range(1 << bits):
            a, b = cut[f], cut[f + 1]
            if a < b:
                counts = np.bincount(owner[a:b], minlength=len(held)).astype("<u4")
                rows.append((number, f, counts.tobytes(), grams[a:b].tobytes(), None))
        for i in range(0, len(rows), 64):
            yield rows_to_batch(rows[i : i + 64], _BATCH)

    for batch in batches:
        ids, keys = batch.column(0).to_pylist(), batch.column(2).to_pylist()
        for doc_id, text, key in zip(ids, batch.column(1).cast(pa.binary()), keys):
            held.append(hasher(text.as_py() or b""))
            docs.append((doc_id, key))
            n += len(held[-1])
            if n >= _BATCH_GRAMS or len(docs) == 1 << 14:
                yield from close()
                held, docs, n, number = [], [], 0, number + 1
    if docs:
        yield from close()



def _ranked(table: pa.Table) -> pa.Table:
    """One fragment: n-grams of one document only are dropped, the others become ranks.

    Ranks go from rare to frequent; ties are in the order of the hashes.
    """
    rows = table.to_pylist()
    own = [r for r in rows if r["docs"] is not None]
    rows = [r for r in rows if r["docs"] is None]
    out = [(r["batch"], r["fragment"], None, None, r["docs"]) for r in own]
    if rows:
        grams = [np.frombuffer(r["grams"], np.uint64) for r in rows]
        _, inverse, count = np.unique(np.concatenate(grams), return_inverse=True, return_counts=True)
        repeated = count > 1
        order = np.argsort(np.where(repeated, count, np.iinfo(np.int64).max), kind="stable")
        rank = np.empty(len(count), np.int64)
        rank[order] = np.arange(len(count))
        at = 0
        for r, g in zip(rows, grams):
            mine = inverse[at : at + len(g)]
            at += len(g)
            keep = repeated[mine]
            if not keep.any():
                continue
            counts = np.frombuffer(r["counts"], "<u4")
            owner = np.repeat(np.arange(len(counts)), counts)[keep]
            left = np.bincount(owner, minlength=len(counts)).astype("<u4")
            ranks = rank[mine[keep]].astype("<u4")
            out.append((r["batch"], r["fragment"], left.tobytes(), ranks.tobytes(), None))
    return pa.Table.from_batches([rows_to_batch(out, _BATCH)])


_SET = pa.schema(
    [
        ("node", pa.int64()),
        ("doc_id", pa.int64()),
        ("row", pa.int64()),
        ("n", pa.int64()),
        ("own", pa.int64()),
        ("digest", pa.binary()),
        ("prefix", pa.list_(pa.int64())),
        ("segments", pa.list_(pa.list_(pa.int64()))),
    ]
)
#: Parts of the order in which the overlaps of candidate pairs are counted, one after another.
_PARTS = 2


def _sets(percent: int, bits: int, table: pa.Table) -> pa.Table:
    """The documents of one batch, with the repeated n-grams of those that may have a link."""
    rows = table.to_pylist()
    (names,) = (np.frombuffer(r["docs"], _DOC) for r in rows if r["docs"] is not None)
    owners, codes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for r in rows:
        if r["docs"] is None:
            counts = np.frombuffer(r["counts"], "<u4")
            owners.append(np.repeat(np.arange(len(counts)), counts))
            codes.append((np.frombuffer(r["grams"], "<u4").astype(np.int64) << bits) | r["fragment"])
    owner, code = np.concatenate(owners), np.concatenate(codes)
    order = np.lexsort((code, owner))
    owner, code = owner[order], code[order]
    cut = np.searchsorted(owner, np.arange(len(names) + 1))
    batch, out = rows[0]["batch"], []
    for i, d in enumerate(names):
        n, mine = int(d["n"]), code[cut[i] : cut[i + 1]]
        own = n - len(mine)
        head = max(0, n - -(-n * percent // 100) + 1 - own) if n else 0
        prefix = mine[:head]
        segments = [mine[mine % _PARTS == g].tolist() for g in range(_PARTS)] if len(prefix) else None
        known = int(d["doc_id"]) if d["known"] else None
        out.append(((batch << 14) | i, known, int(d["row"]), n, own, bytes(d["digest"]), prefix.tolist(), segments))
    return pa.Table.from_batches([rows_to_batch(out, _SET)])


def _possible(percent: int) -> Column:
    """Whether the sizes, and what follows the common n-gram, allow the similarity."""
    smaller, larger = F.least("x_n", "y_n"), F.greatest("x_n", "y_n")
    left = F.least(F.col("x_n") - F.col("x_pos"), F.col("y_n") - F.col("y_pos"))
    both = F.col("x_n") + F.col("y_n")
    return (100 * smaller >= percent * larger) & ((100 + percent) * left >= percent * both)


def _overlaps(pairs: DataFrame, segments: DataFrame, percent: int) -> DataFrame:
    """The pairs (x, y, x_n, y_n) that reach the similarity, and how many n-grams they share.

    Overlaps are counted part by part of the order and summed per pair. A pair goes on to the
    next part only if what is left of both sets could still make up the overlap it needs.
    """
    counted = pairs.select("x", "y", "x_n", "y_n", F.lit(0).cast("long").alias("shared"))
    for part in range(_PARTS):
        for side in ("x", "y"):
            mine = segments.where(F.col("part") == part).select(
                F.col("node").alias(side), F.col("segment").alias(f"{side}_segment"), F.col("after").alias(f"{side}_after")
            )
            counted = counted.join(mine, side)
        most = F.col("shared") + F.size(F.array_intersect("x_segment", "y_segment"))
        counted = counted.select("x", "y", "x_n", "y_n", most.alias("shared"), F.least("x_after", "y_after").alias("after"))
        needed = percent * (F.col("x_n") + F.col("y_n"))
        counted = counted.where((100 + percent) * (F.col("shared") + F.col("after")) >= needed)
    return counted.select("x", "y", "x_n", "y_n", "shared")


def _linked(pairs: DataFrame, segments: DataFrame, percent: int) -> DataFrame:
    return _overlaps(pairs, segments, percent).select(F.col("x").alias("a"), F.col("y").alias("b"))


def _classes(
    docs: DataFrame, words: int, percent: int, id_col: str, text_col: str
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents with their class, segments of class representatives, and their prefix postings."""
    spark = docs.sparkSession
    bits = max(5, (4 * shuffle_partitions(spark) - 1).bit_length())
    rows = id_and_text(docs, id_col, text_col).select("doc_id", "text", row_key().alias("row"))
    kind = spark_schema(_BATCH)
    cut = rows.mapInArrow(lambda batches: _segments(words, bits, batches), kind)
    ranked = cut.groupBy("fragment").applyInArrow(_ranked, kind)
    sets = stable(ranked.groupBy("batch").applyInArrow(lambda t: _sets(percent, bits, t), spark_schema(_SET)))

    # Equal sets have no n-gram of their own unless they are alone.
    equal = sets.where("own = 0 and n > 0").groupBy("digest").agg(F.min("node").alias("class"))
    nodes = sets.select("node", "doc_id", "row", "n", F.when((F.col("own") == 0) & (F.col("n") > 0), F.col("digest")).alias("digest"))
    nodes = stable(
        nodes.join(equal, "digest", "left").select("node", "doc_id", "row", "n", F.coalesce("class", "node").alias("class"))
    )
    alone = nodes.where("node = class").select("node")
    linkable = sets.where("size(prefix) > 0").join(alone, "node", "left_semi")
    # With each segment goes how many repeated n-grams the later ones hold.
    later = F.transform("segments", lambda _, i: F.aggregate(F.slice("segments", i + 2, _PARTS), F.lit(0).cast("long"), lambda n, s: n + F.size(s)))
    segments = linkable.select("node", F.posexplode(F.arrays_zip("segments", later.alias("after"))).alias("part", "s"))
    segments = segments.select("node", "part", F.col("s.segments").alias("segment"), F.col("s.after").alias("after"))
    postings = stable(
        linkable.select("node", "n", "own", F.posexplode("prefix").alias("at", "gram")).select(
            "gram", "node", "n", "own", (F.col("own") + F.col("at")).alias("pos")
        )
    )
    return nodes, segments, postings


def jaccard_join(
    docs: DataFrame,
    words: int = 5,
    percent: int = 80,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per link between two classes: x_class, y_class, x_shingles, y_shingles, shared, x_docs, y_docs.

    A class is the documents of one set; ``x_class`` and ``y_class`` are their ``class_id`` as
    in ``jaccard_groups``, which has the members, x the smaller one (null last). All pairs of
    different sets that reach the similarity are there; each stands for ``x_docs * y_docs``
    pairs of documents. Members of one class are linked without a row. Texts without words
    link nothing.
    """
    nodes, segments, postings = _classes(docs, words, percent, id_col, text_col)
    x, y = (
        postings.select("gram", *[F.col(c).alias(f"{side}_{c}" if c != "node" else side) for c in ("node", "n", "pos")])
        for side in ("x", "y")
    )
    pairs = x.join(y, "gram").where("x < y").where(_possible(percent)).select("x", "y", "x_n", "y_n").distinct()
    links = _overlaps(pairs, segments, percent)
    of = stable(nodes.groupBy("class").agg(F.min("doc_id").alias("id"), F.count("*").alias("docs")))
    for side in ("x", "y"):
        links = links.join(of.select(F.col("class").alias(side), F.col("id").alias(f"{side}_id"), F.col("docs").alias(f"{side}_docs")), side)
    ends = [
        F.struct(F.col(f"{s}_id").isNull().alias("late"), F.col(f"{s}_id").alias("id"), F.col(s).alias("node"), F.col(f"{s}_n").alias("n"), F.col(f"{s}_docs").alias("docs"))
        for s in ("x", "y")
    ]
    both = links.select("shared", F.array_sort(F.array(*ends)).alias("e"))
    low, high = F.col("e")[0], F.col("e")[1]
    return both.select(
        low["id"].alias("x_class"),
        high["id"].alias("y_class"),
        low["n"].alias("x_shingles"),
        high["n"].alias("y_shingles"),
        "shared",
        low["docs"].alias("x_docs"),
        high["docs"].alias("y_docs"),
    )


def jaccard_groups(
    docs: DataFrame,
    words: int = 5,
    percent: int = 80,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, class_id, first, row.

    ``component_id`` is the smallest id that can be reached by links (similarity of at least
    ``percent`` hundredths), the document's own included; ``class_id`` is the smallest id with
    an equal set. ``first`` marks one row of each component, the one with the smallest id
    (null last). A text without words, or null, has no n-grams, links nothing and is a
    component of its own. Null ids are smaller than no id, so a component of them alone has
    the id null. Repeated rows have equal sets, so they are in one component; ``row`` is
    ``row_key()`` of the document. An empty table gives an empty result. Other columns are
    not read.
    """
    nodes, segments, postings = _classes(docs, words, percent, id_col, text_col)
    hubs = postings.groupBy("gram").agg(
        F.min(F.struct("own", "n", "node", "pos")).alias("hub"), F.count("*").alias("members")
    )
    hubs = hubs.where("members > 1").select(
        "gram", F.col("hub.own").alias("y_own"), F.col("hub.node").alias("y"), F.col("hub.n").alias("y_n"), F.col("hub.pos").alias("y_pos")
    )
    x = postings.select("gram", F.col("node").alias("x"), F.col("n").alias("x_n"), F.col("pos").alias("x_pos"))
    spokes = stable(x.join(hubs, "gram").where("x != y").where(_possible(percent)))
    # The best hub of each set first: a pair for each set, and most components are there.
    near = spokes.groupBy("x", "x_n").agg(F.min(F.struct("y_own", "y_n", "y")).alias("hub"))
    links = stable(_linked(near.select("x", F.col("hub.y").alias("y"), "x_n", F.col("hub.y_n").alias("y_n")), segments, percent))
    # Then the other hubs, for sets that are not in their component yet.
    others = spokes.select("x", "y", "x_n", "y_n").distinct()
    known = components(links)
    for side in ("x", "y"):
        mine = known.select(F.col("node").alias(side), F.col("component").alias(f"{side}_comp"))
        others = others.join(mine, side, "left").withColumn(f"{side}_comp", F.coalesce(f"{side}_comp", side))
    links = stable(links.union(_linked(others.where("x_comp != y_comp").select("x", "y", "x_n", "y_n"), segments, percent)))
    first = components(links)

    # What the hub's component does not hold is compared with every other component's members.
    label = F.coalesce("component", "node")
    placed = stable(postings.join(first, "node", "left").withColumn("comp", label))
    hub_comp = placed.select(F.col("node").alias("y"), "gram", F.col("comp").alias("hub_comp"))
    centre = hubs.select("gram", "y").join(hub_comp, ["gram", "y"]).select("gram", "hub_comp", F.col("y").alias("hub"))
    outer = placed.join(centre, "gram").where("comp != hub_comp")
    outer = outer.select("gram", F.col("node").alias("x"), F.col("n").alias("x_n"), F.col("pos").alias("x_pos"), F.col("comp").alias("x_comp"), "hub")
    inner = placed.select("gram", F.col("node").alias("y"), F.col("n").alias("y_n"), F.col("pos").alias("y_pos"), F.col("comp").alias("y_comp"))
    rest = outer.join(inner, "gram").where("x_comp != y_comp and y != hub").where(_possible(percent))
    turned = F.col("x") > F.col("y")
    rest = rest.select(
        F.least("x", "y").alias("x"),
        F.greatest("x", "y").alias("y"),
        F.when(turned, F.col("y_n")).otherwise(F.col("x_n")).alias("x_n"),
        F.when(turned, F.col("x_n")).otherwise(F.col("y_n")).alias("y_n"),
    ).distinct()
    more = stable(_linked(rest, segments, percent))
    final = components(links.union(more)) if not more.isEmpty() else first

    final = final.select(F.col("node").alias("class"), "component")
    members = nodes.join(final, "class", "left").withColumn("component", F.coalesce("component", "class"))
    members = stable(members)
    order = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "node")
    by_class = members.groupBy("class").agg(F.min("doc_id").alias("class_id"))
    by_component = members.groupBy("component").agg(F.min(order).alias("least"))
    return (
        members.join(by_component, "component")
        .join(by_class, "class")
        .select(
            "doc_id",
            F.col("n").alias("n_shingles"),
            F.col("least.doc_id").alias("component_id"),
            "class_id",
            (F.col("node") == F.col("least.node")).alias("first"),
            "row",
        )
    )


def drop_near_copies(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One document of each component of ``docs``, with all its columns.

    Rows that are equal in id and text are one document and stay or go together.
    """
    first = jaccard_groups(docs, words, percent).where("first").select(F.col("doc_id").alias("f_doc"), F.col("row").alias("f_row"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole"))
    rows = rows.select("whole", row_key("whole.doc_id", "whole.text").alias("k_row"))
    same = (F.col("k_row") == F.col("f_row")) & F.col("whole.doc_id").eqNullSafe(F.col("f_doc"))
    return rows.join(first, same, "left_semi").select("whole.*")
