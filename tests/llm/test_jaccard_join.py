from __future__ import annotations

import random
from itertools import combinations

import pytest

from boxoffice.llm.components import components
from boxoffice.llm.jaccard_join import drop_near_copies, jaccard_groups, jaccard_join
from tests.llm.conftest import ODD


def shingles(text, n=5):
    words = bytes(text or "", "utf8").lower().split() if (text or "").isascii() else "".join(
        c.lower() if "A" <= c <= "Z" else c for c in text or ""
    ).encode().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1)))


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 80 * len(sets[a] | sets[b]):
            parent[root(a)] = root(b)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        known = [x for x in (least.get(root(i)), doc_id) if x is not None]
        least[root(i)] = min(known) if known else None
    return sorted(((d, len(s), least[root(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def result(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str)


def near(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return words


def test_same_components_as_all_pairs(spark):
    rng = random.Random(5)
    common = [f"c{i}" for i in range(40)]
    rows = []
    for group in range(12):
        base = [f"g{group}x{i}" for i in range(rng.randint(6, 90))] + common * (group % 2)
        chain = base
        for _ in range(14):
            # Chains of changes, so that components hold pairs that are not linked themselves.
            chain = near(rng, base if rng.random() < 0.5 else chain, rng.randint(0, 3))
            rows.append((len(rows), " ".join(chain)))
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    want = brute(rows)
    assert result(jaccard_groups(docs)) == want
    assert 12 < len({c for _, _, c in want}) < 120
    kept = drop_near_copies(docs).collect()
    assert sorted(r.doc_id for r in kept) == sorted({c for _, _, c in want})


@pytest.mark.parametrize("cut", [80, 81, 79])
def test_threshold_is_exact(spark, cut):
    # 9 shared of 11 in all is above 80 %, 8 of 10 is 80 % exactly, 8 of 11 is below.
    words = [f"a{i}" for i in range(13)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:-1] + ["z"])), (3, " ".join(words[:12])), (4, " ".join(["q"] + words[1:]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    if cut == 80:
        assert result(jaccard_groups(docs)) == brute(rows)
    else:
        sizes = {len(shingles(t)) for _, t in rows}
        assert sizes == {8, 9} and jaccard_groups(docs, percent=cut).count() == 4


def test_test_table(spark, small):
    docs = spark.createDataFrame(small, "doc_id long, text string").repartition(5)
    assert result(jaccard_groups(docs)) == brute(small)


def test_odd_rows(odd, none):
    assert result(jaccard_groups(odd)) == brute(ODD)
    assert jaccard_groups(none).collect() == []
    kept = drop_near_copies(odd)
    assert kept.columns == odd.columns
    # The repeated row stays or goes as one; it holds the smallest id, so both rows stay.
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "1", "3", "4", "5", "6", "7", "8", "None"]
    assert drop_near_copies(none).collect() == []


def test_components(spark):
    rng = random.Random(2)
    path = [(i, i + 1) for i in range(100, 160)]
    star = [(500, i) for i in range(501, 540)]
    links = path + star + [(7, 7), (900, 800), (800, 900), (800, 900)]
    rng.shuffle(links)
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {i: 100 for i in range(100, 161)} | {i: 500 for i in range(500, 540)} | {800: 800, 900: 800}
    assert got == want


def test_join_returns_every_link_inside_a_group_too(spark, odd, none):
    rng = random.Random(8)
    rows = []
    for group in range(5):
        base = [f"g{group}x{i}" for i in range(rng.randint(120, 200))] + ["c"] * (group % 2)
        rows += [" ".join(near(rng, base, rng.randint(0, 2))) for _ in range(12)]
    rows += rows[::5] + [None, "", "word"]
    rows = [(i, t) for i, t in enumerate(rows)] + [(None, rows[0])]
    classes = {}
    for i, t in rows:
        classes.setdefault(shingles(t), []).append(i)
    least = {s: min(i for i in ids if i is not None) for s, ids in classes.items()}
    want = []
    for a, b in combinations(sorted(classes, key=least.get), 2):
        both = len(a & b)
        if both and 100 * both >= 80 * len(a | b):
            want.append((least[a], least[b], len(a), len(b), both, len(classes[a]), len(classes[b])))
    got = jaccard_join(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert sorted(map(tuple, got.collect())) == sorted(want)
    # More links than any tree over the classes has: those inside a component are there.
    assert len(want) > len(classes)
    assert jaccard_join(odd).collect() == [] and jaccard_join(none).collect() == []
