from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from boxoffice.llm.exact_dedup import PatriciaTrie, drop_copies, exact_dedup
from tests.llm.conftest import ODD


def brute(rows):
    groups = defaultdict(list)
    for n, (i, t) in enumerate(rows):
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), i is None, i or 0, n))
    out = []
    for text, members in groups.items():
        best = min(members)
        keep = None if best[1] else best[2]
        sha = hashlib.sha256(text.encode()).hexdigest()
        out += [(None if m[1] else m[2], keep, len(members), sha) for m in members]
    return sorted(out, key=str), len(groups)


def check(df, rows):
    got = df.collect()
    want, groups = brute(rows)
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == want
    kept = [r for r in got if r.kept]
    assert len(kept) == groups == len({r.text_sha256 for r in kept})
    assert all(r.doc_id == r.keep_id for r in kept)


def test_odd_rows(odd):
    check(exact_dedup(odd), ODD)


def test_test_table(spark, small):
    check(exact_dedup(spark.createDataFrame(small, "doc_id long, text string").repartition(5)), small)


def test_empty(none):
    assert exact_dedup(none).collect() == []
    assert drop_copies(none).columns == none.columns


def test_kept_rows_have_all_columns(odd):
    out = drop_copies(odd)
    assert out.columns == odd.columns
    texts = [re.sub(r"[\x20\x09-\x0D]", "", r.text or "") for r in out.collect()]
    assert len(texts) == len(set(texts)) == brute(ODD)[1]


def add(a, b):
    return a + b


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab", max_size=9)), st.sampled_from([1, 300, 900, 1 << 20]))
def test_trie_merges_equal_strings_whatever_is_spilled(texts, limit):
    trie, want = PatriciaTrie(add, limit), defaultdict(int)
    for t in texts:
        trie.insert(t.encode(), 1)
        want[t.encode()] += 1
    found = list(trie.items())
    assert len(found) == len(want) and dict(found) == want


def test_trie_spills_by_subtree_and_stays_exact():
    rng = random.Random(1)
    pool = [b"shared prefix " + rng.randbytes(rng.randint(0, 40)) for _ in range(300)]
    trie, want = PatriciaTrie(add, 4000), defaultdict(int)
    for _ in range(3000):
        t = rng.choice(pool)
        trie.insert(t, 1)
        want[t] += 1
    assert trie.spills > 0
    assert dict(trie.items()) == want
