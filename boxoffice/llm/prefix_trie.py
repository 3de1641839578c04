"""The trie of conversation prefixes, built by halving depths (van Emde Boas recursion).

A sequence is a conversation; a node of depth d is a distinct run of first d turns, and every
sequence that starts with it is a member. Depths 0 to 2^k - 1 are cut at half: the prefixes of
length 2^(k-1) are named, the upper trie and the forests below the cut are cut at half again,
and so on. All pieces of one size are handled in the same round, so there are k rounds and not
one per depth. A depth t is the cut of exactly one piece: t = lo + 2^i, where 2^i is its lowest
set bit and ``lo`` the top of the piece, named in an earlier round. Two sequences share the node
at t if they share the node at ``lo`` and the turns between, whose digests are combined into
one (two 64-bit values over SHA-256 digests and their places). The name of a node is its smallest
member.

Totals go the other way, from the smallest pieces up: when both halves of a piece are done,
what the forest below a cut node adds up to is grafted onto that node's ancestors in the
upper half. So a node's subtree is summed in at most k steps.

Scale. Every table has one row per turn or node and is written to the shared folder once per
round; rounds at depths that few sequences reach touch only those. Naming takes minima on the
map side, so a prefix that many sequences share is a row per task, and the join that brings
the name back has one row on the other side, which adaptive execution can split. Turns are numbered
by range partitions, so one sequence may be spread over many tasks. The digest over the ends of
a node needs its ids in order: ids are joined in bounded chunks and streamed through the digest,
never held as a list. Only the greatest length is brought to the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boxoffice.session import stable

#: Ids are joined to texts in chunks of 2^12 values.
_CHUNK_BITS = 12


def turn_digest(role: Column, text: Column) -> Column:
    """Tells (role, text) pairs apart: the length of the role keeps the two from running into each other."""
    return F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)


def numbered_turns(rows: DataFrame) -> DataFrame:
    """conv_id, pos (from 0), digest, n_bytes (of the text) of every turn.

    ``rows`` has conv_id, turn, role, text. Order: turn (null first), then role, then text; null role and text
    are empty; repeated rows are turns of their own. Rows without a conv_id belong to no conversation
    and are left out. Rows are sorted in range partitions; a conversation in several of them
    is numbered on from the partitions before.
    """
    read = rows.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    order = [F.col("conv_id").asc(), F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("text").asc()]
    placed = read.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = stable(
        placed.select(
            "conv_id",
            F.spark_partition_id().alias("part"),
            F.monotonically_increasing_id().alias("at"),
            F.unhex(turn_digest(F.col("role"), F.col("text"))).alias("digest"),
            F.octet_length("text").cast("long").alias("n_bytes"),
        )
    )
    # One row per conversation and partition that holds some of it.
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = placed.groupBy("conv_id", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    runs = runs.withColumn("shift", F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first"))
    placed = placed.join(runs.select("conv_id", "part", "shift"), ["conv_id", "part"])
    return stable(placed.select("conv_id", (F.col("at") + F.col("shift")).alias("pos"), "digest", "n_bytes"))


def share_openings(turns: DataFrame, family: int = 5, longest: int = 8) -> tuple[DataFrame, DataFrame]:
    """Conversations that open like the first of their family: (ids, turns).

    Conversation c takes the first h turns of conversation c - c % ``family`` (all if it has
    fewer, none if it is absent), with h = crc32(decimal c) % (``longest`` + 1), and goes on with its own turns
    after its first h. ``ids`` has every conv_id, also those left without a turn.
    """
    convs = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("own"))
    convs = convs.select(
        "conv_id",
        (F.col("conv_id") - F.col("conv_id") % family).alias("base"),
        (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (longest + 1)).alias("h"),
        "own",
    )
    bases = convs.where("conv_id = base").select(F.col("conv_id").alias("b_id"), F.col("own").alias("b_own"))
    convs = stable(
        convs.join(bases, convs.base == bases.b_id, "left").select(
            "conv_id", "base", "h", F.least("h", F.coalesce("b_own", F.lit(0))).alias("opening")
        )
    )
    first = turns.where(F.col("pos") < longest).select(F.col("conv_id").alias("from_id"), "pos", "digest", "n_bytes")
    opened = convs.join(first, convs.base == first.from_id).where("pos < h").select("conv_id", "pos", "digest", "n_bytes")
    own = turns.join(convs, "conv_id").where("pos >= h")
    own = own.select("conv_id", (F.col("pos") - F.col("h") + F.col("opening")).alias("pos"), "digest", "n_bytes")
    return convs.select("conv_id"), opened.unionByName(own)


def _lowest_bit(depth: Column) -> Column:
    return depth.bitwiseAND(-depth)


def _level(depth: Column) -> Column:
    """The place of the lowest set bit."""
    return F.bit_count(_lowest_bit(depth) - 1)


def _cut_digests(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """For each sequence and depth t: conv_id, t, d1, d2 of the turns since the top of t's piece.

    A turn lies in the lower half of those pieces, one per size at most, that its place has a zero bit for; pieces
    whose cut lies past the end of the sequence are not made.
    """
    placed = turns.join(lengths, "conv_id")
    sizes = F.transform(F.sequence(F.lit(0), F.length(F.bin("n")) - 1), lambda i: F.call_function("shiftleft", F.lit(1).cast("bigint"), i))
    each = placed.select("conv_id", "pos", "digest", "n", F.explode(sizes).alias("size"))
    each = each.withColumn("lo", F.col("pos") - F.col("pos") % F.col("size")).withColumn("t", F.col("lo") + F.col("size"))
    each = each.where((F.col("t") <= F.col("n")) & (F.col("lo").bitwiseAND(F.col("size")) == 0))
    place = F.col("pos") - F.col("lo")
    return each.groupBy("conv_id", "t").agg(
        F.bit_xor(F.xxhash64(place, "digest", F.lit(1))).alias("d1"),
        F.bit_xor(F.xxhash64(place, "digest", F.lit(2))).alias("d2"),
    )


def name_prefixes(ids: DataFrame, turns: DataFrame) -> tuple[DataFrame, int]:
    """conv_id, t, node (its smallest member), n_bytes of turn t for all depths t >= 0, and the number of rounds.

    ``ids`` names every sequence, ``turns`` has conv_id, pos, digest, n_bytes with gapless
    places from 0.
    """
    turns = stable(turns)
    lengths = turns.groupBy("conv_id").agg((F.max("pos") + 1).alias("n"))
    last = turns.select(F.col("conv_id"), (F.col("pos") + 1).alias("t"), "n_bytes")
    cuts = stable(_cut_digests(turns, lengths).join(last, ["conv_id", "t"]).withColumn("level", _level(F.col("t"))))
    longest = cuts.agg(F.max("t")).first()[0] or 0
    rounds = int(longest).bit_length()
    zero = F.lit(0).cast("long")
    root = F.lit(ids.agg(F.min("conv_id")).first()[0]).cast("long")
    named = stable(ids.select("conv_id", zero.alias("t"), root.alias("node"), zero.alias("n_bytes")))
    for level in range(rounds - 1, -1, -1):
        here = cuts.where(F.col("level") == level).withColumn("lo", F.col("t") - (1 << level))
        # Tops of this round's pieces are multiples of twice their half.
        tops = named.where(F.col("t") % (2 << level) == 0).select("conv_id", F.col("t").alias("lo"), F.col("node").alias("top"))
        placed = here.join(tops, ["conv_id", "lo"]).select("conv_id", "t", "n_bytes", "top", "d1", "d2")
        placed = stable(placed)
        key = ["top", "t", "d1", "d2"]
        names = placed.groupBy(*key).agg(F.min("conv_id").alias("node"))
        named = named.unionByName(stable(placed.join(names, key).select("conv_id", "t", "node", "n_bytes")))
    return named, rounds


def _streamed_sha256(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of comma-joined chunks; a node's chunks follow each other, in order."""
    key, running = None, None
    schema = pa.schema([("node", pa.int64()), ("depth", pa.int64()), ("ends_sha256", pa.string())])
    for batch in batches:
        done = []
        for node, depth, ids in zip(*(batch.column(c).to_pylist() for c in ("node", "depth", "ids"))):
            if (node, depth) == key:
                running.update(b",")
            else:
                if key is not None:
                    done.append((*key, running.hexdigest()))
                key, running = (node, depth), hashlib.sha256()
            running.update(ids.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), schema.types)], schema=schema)
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip((*key, running.hexdigest()), schema.types)], schema=schema)


def _end_digests(named: DataFrame) -> DataFrame:
    """node, depth, ends_sha256 of the nodes at which sequences end."""
    ends = named.groupBy("conv_id").agg(F.max(F.struct("t", "node")).alias("end"))
    ends = ends.select("conv_id", F.col("end.node").alias("node"), F.col("end.t").alias("depth"))
    # A chunk holds ids of one range of 2^_CHUNK_BITS values, so no more than these.
    chunk = F.shiftright("conv_id", _CHUNK_BITS)
    chunks = ends.groupBy("node", "depth", chunk.alias("chunk")).agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
    chunks = chunks.select("node", "depth", "chunk", F.array_join(F.transform("ids", lambda i: i.cast("string")), ",").alias("ids"))
    return (
        chunks.repartition("node", "depth")
        .sortWithinPartitions("node", "depth", "chunk")
        .mapInArrow(_streamed_sha256, "node long, depth long, ends_sha256 string")
    )


def _graft(nodes: DataFrame, named: DataFrame, rounds: int) -> DataFrame:
    """node, depth, n_leaves, saved: totals over subtrees.

    ``nodes`` has node, depth, leaf (1 for childless nodes), saved (its own).
    """
    own = nodes.select("node", "depth", F.col("leaf").alias("n_leaves"), "saved")
    cut = nodes.where("depth > 0").select(F.col("node").alias("low"), F.col("depth").alias("low_depth"))
    up = cut.withColumn("depth", F.explode(F.sequence(F.col("low_depth") - _lowest_bit(F.col("low_depth")), F.col("low_depth") - 1)))
    paths = named.select(F.col("conv_id").alias("low"), F.col("t").alias("depth"), "node")
    # The name of a node is one of its members, so that member's path leads to its ancestors.
    up = stable(up.join(paths, ["low", "depth"]).withColumn("level", _level(F.col("low_depth"))))
    totals = own
    for level in range(rounds):
        forests = totals.where((F.col("depth") > 0) & (_level(F.col("depth")) == level)).groupBy("node", "depth")
        forests = forests.agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved"))
        forests = forests.select(F.col("node").alias("low"), F.col("depth").alias("low_depth"), "n_leaves", "saved")
        added = up.where(F.col("level") == level).join(forests, ["low", "low_depth"]).groupBy("node", "depth")
        totals = totals.unionByName(stable(added.agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved"))))
    return totals.groupBy("node", "depth").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved"))


def prefix_trie(ids: DataFrame, turns: DataFrame) -> DataFrame:
    """One row per node of the trie of all sequences.

    conv_id (smallest member), depth, parent_conv_id (null for the root), n_convs, n_children, n_leaves (childless nodes in
    the subtree), saved_tokens (over the subtree, (members - 1) times the bytes of a node's last
    text), ends_sha256 (of the ids that end there, ascending, joined by commas).

    ``ids`` (conv_id, each once) names all sequences, also those without turns, which are
    members of the root only; ``turns`` has conv_id, pos, digest, n_bytes. An empty table
    has no node, not even a root.
    """
    named, rounds = name_prefixes(ids, turns)
    members = stable(
        named.groupBy("node", F.col("t").alias("depth")).agg(F.count(F.lit(1)).alias("n_convs"), F.max("n_bytes").alias("n_bytes"))
    )
    above = named.select(F.col("conv_id").alias("node"), (F.col("t") + 1).alias("depth"), F.col("node").alias("parent"))
    linked = stable(members.join(above, ["node", "depth"], "left"))
    children = linked.where("depth > 0").groupBy(F.col("parent").alias("node"), (F.col("depth") - 1).alias("depth"))
    linked = linked.join(children.agg(F.count(F.lit(1)).alias("n_children")), ["node", "depth"], "left")
    nodes = stable(
        linked.select(
            "node",
            "depth",
            "parent",
            "n_convs",
            F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
            F.col("n_children").isNull().cast("long").alias("leaf"),
            ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved"),
        )
    )
    whole = nodes.drop("leaf", "saved").join(_graft(nodes, named, rounds), ["node", "depth"])
    whole = whole.join(_end_digests(named), ["node", "depth"], "left")
    return whole.select(
        F.col("node").alias("conv_id"),
        "depth",
        F.col("parent").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )
