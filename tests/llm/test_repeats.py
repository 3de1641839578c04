from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from boxoffice.llm.repeats import LENGTH, interleave, remove_repeats
from tests.llm.conftest import LONG, ODD


def brute(rows):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(t[i : i + LENGTH] for t in texts for i in range(len(t) - LENGTH + 1))
    out = []
    for (doc_id, _), t in zip(rows, texts):
        gone = bytearray(len(t) + 1)
        for i in range(len(t) - LENGTH + 1):
            if seen[t[i : i + LENGTH]] > 1:
                gone[i : i + LENGTH] = b"\x01" * LENGTH
        spans = [i for i in range(len(t)) if gone[i] and not (i and gone[i - 1])]
        kept = bytes(c for c, g in zip(t, gone) if not g)
        out.append((doc_id, len(t), sum(gone), len(spans), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def result(df):
    out = df.collect()
    for r in out:
        assert sum(s.length for s in r.removed) == r.n_removed and len(r.removed) == r.n_spans
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out), key=str)


def noise(rng, n):
    return "".join(rng.choice("abcdefgh \né") for _ in range(n))


@pytest.mark.parametrize("seed", [1, 2])
def test_planted_passages(spark, seed):
    rng = random.Random(seed)
    base = noise(rng, 3000)
    rows = []
    for i in range(60):
        # Passages of about the length that counts, that begin and end anywhere.
        a = rng.randrange(2000)
        part = base[a : a + rng.choice([350, 380, 399, 400, 401, 420, 500, 900])]
        rows.append((i, noise(rng, rng.randrange(300)) + part + noise(rng, rng.randrange(300)) + part[: rng.randrange(600)]))
    rows += [(100, base), (101, base), (102, "ab" * 600), (103, "x" * 900), (104, base[:1500] + "!" + base[1501:])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert result(remove_repeats(docs)) == brute(rows)


def test_test_table(spark, small):
    docs = spark.createDataFrame(small, "doc_id long, text string").repartition(5)
    assert result(remove_repeats(docs)) == brute(small)


def test_odd_rows(spark, odd, none):
    short = [(i, t) for i, t in ODD if t is not LONG] + [(8, LONG[:5000])]
    short += [(9, LONG[7:1200] + "e"), (9, LONG[7:1200] + "e"), (None, LONG[50:700])]
    frame = spark.createDataFrame([(i, t, 1) for i, t in short], "doc_id long, text string, state int").repartition(3)
    assert result(remove_repeats(frame)) == brute(short)
    whole = [r for r in remove_repeats(odd).collect() if r.doc_id == 8]
    assert [(r.n_bytes, r.n_removed) for r in whole] == [(len(LONG), len(LONG))]
    assert remove_repeats(none).collect() == []


def test_interleave_is_the_order_of_the_suffixes():
    rng = np.random.default_rng(0)
    suffixes = [bytes(rng.integers(97, 99, rng.integers(0, 9), dtype=np.uint8)) for _ in range(200)]
    start = rng.integers(0, 3, 200)
    found = interleave(start, suffixes, 6)
    for k in range(7):
        for i in range(0, 200, 7):
            for j in range(200):
                alike = i == j or (start[i] == start[j] and len(suffixes[i]) >= k <= len(suffixes[j]) and suffixes[i][:k] == suffixes[j][:k])
                assert (found[k, i] == found[k, j]) == alike
