from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from boxoffice.llm import prefix_trie


def rebuilt(rows):
    """conv_id to its list of (role, text), opening like the first of its family."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(turns)] for c, turns in own.items()}
    out = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        out[c] = own.get(base, [])[:h] + own[c][h:]
    return out


def by_hand(convs):
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    below = {}
    for path in sorted(members, key=len, reverse=True):
        own = (len(members[path]) - 1) * len(path[-1][1].encode()) if path else 0
        leaves = sum(below[k][0] for k in children[path]) if children[path] else 1
        below[path] = (leaves, own + sum(below[k][1] for k in children[path]))
    rows = []
    for path, ids in members.items():
        ends = sorted(c for c in ids if len(convs[c]) == len(path))
        rows.append(
            (
                min(ids),
                len(path),
                min(members[path[:-1]]) if path else None,
                len(ids),
                len(children[path]),
                *below[path],
                hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
            )
        )
    return sorted(rows, key=lambda r: (r[1], r[0]))


def trie(df):
    ids, turns = prefix_trie.share_openings(prefix_trie.numbered_turns(df))
    return sorted((tuple(r) for r in prefix_trie.prefix_trie(ids, turns).collect()), key=lambda r: (r[1], r[0]))


SCHEMA = "conv_id long, turn long, role string, text string"


def test_random_conversations(spark):
    rng = random.Random(5)
    rows = []
    for c in range(120):
        for t in range(rng.choice([1, 2, 3, 5, 9, 17, 33])):
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", rng.choice(["a", "bb", "éé"]) if t < 5 else rng.choice("xyz")))
    rng.shuffle(rows)
    assert trie(spark.createDataFrame(rows, SCHEMA).repartition(5)) == by_hand(rebuilt(rows))


def test_odd_rows(spark):
    rows = [
        (0, None, None, None),
        (0, 1, "user", "hi"),
        (0, 1, "user", "hi"),  # a repeated row is a turn of its own
        (0, 1, "assistant", "hi"),  # a tie
        (1, 5, "user", ""),
        (1, None, "", None),
        (5, 0, "u", "ser"),
        (6, 0, "us", "er"),  # other turn, same letters
        (-1, 0, "user", "negative"),
        (-6, 0, "user", "negative"),
        (7, 0, "user", "base 5 is there"),
        (12, 0, "user", "base 10 is absent"),
        (13, 0, "user", "base 10 is absent"),
        (2**40, 0, "user", "far"),
        (None, 0, "user", "no conversation"),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    assert trie(df) == by_hand(rebuilt(rows))
    clash = df.select("*", F.lit(1).alias("pos"), F.lit(2).alias("digest"), F.lit(3).alias("node"), F.lit(4).alias("t"))
    assert trie(clash) == by_hand(rebuilt(rows))


def test_no_rows(spark):
    assert trie(spark.createDataFrame([], SCHEMA)) == []


def test_one_long_and_one_hot_conversation(spark):
    """300 turns in one conversation with a very long text, and 6,000 conversations that are copies."""
    long = [(20_000, t, "user", f"turn {t % 7}" if t else "lorem " * 100_000) for t in range(300)]
    hot = [(c, t, "user", "same") for c in range(0, 30_000, 5) for t in range(3) if c != 20_000]
    rows = long + hot
    found = trie(spark.createDataFrame(rows, SCHEMA).repartition(4))
    assert found == by_hand(rebuilt(rows))
    assert max(r[1] for r in found) == 300


def test_places_across_partitions(spark):
    """A conversation with most rows is numbered over several range partitions."""
    rows = [(1, t, "user", "x") for t in range(5_000)] + [(2, 0, "user", "y")]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = prefix_trie.numbered_turns(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(r.pos for r in placed if r.conv_id == 1) == list(range(5_000))
    assert [r.pos for r in placed if r.conv_id == 2] == [0]
