from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from boxoffice.llm import packing, token_blocks
from boxoffice.llm.tokens import Encoder
from tests.llm.conftest import ODD

WORD, BYTE = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))
PLAIN = {p: Tokenizer.from_file(p) for p in (WORD, BYTE)}
OWN = {p: Encoder(p, remember=50) for p in (WORD, BYTE)}


@pytest.mark.parametrize("path", [WORD, BYTE])
@settings(max_examples=400, deadline=None)
@given(st.text(st.sampled_from("aA'st \n\u00c9\u00ffre.,<"), max_size=24))
def test_plain_pieces_give_the_ids_of_the_whole(path, text):
    assert OWN[path].encode(text).tolist() == PLAIN[path].encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_whole_texts_of_the_test_table(path, small):
    for _, text in small:
        assert OWN[path].encode(text).tolist() == PLAIN[path].encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("path", [WORD, BYTE])
@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("aA'st \t\n\r\x0b\x0c\x1c\x85\u00a0\u2028\u30001\u00e9\u0301!<|>.\U0001f600\u01c5"), max_size=30))
def test_pieces_give_the_ids_of_the_whole(path, text):
    assert OWN[path].encode(text).tolist() == PLAIN[path].encode(text, add_special_tokens=False).ids


def ids_of(path, text, end):
    return PLAIN[path].encode(text or "", add_special_tokens=False).ids + [end]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=400), max_size=5))
def test_blocks_give_the_ids_back(docs):
    ids = np.array([i for d in docs for i in d], "<u4")
    names = [None if i == 1 else i - 3 for i in range(len(docs))]
    file = token_blocks.write_shard(names, [len(d) for d in docs], ids)
    shard = token_blocks.read_shard(file)
    assert shard.doc_ids == names and shard.counts.tolist() == [len(d) for d in docs]
    assert shard.ids.tolist() == ids.tolist()
    for a, b in ((0, 1), (100, 300), (127, 129), (len(ids) - 1, len(ids))):
        a = max(0, a)
        assert token_blocks.read_range(file, a, b).tolist() == ids[a:b].tolist()


def test_blocks_are_smaller_than_plain_ids():
    rng = np.random.default_rng(0)
    ids = np.where(rng.random(100_000) < 0.05, rng.integers(0, 49_000, 100_000), rng.integers(300, 900, 100_000))
    assert len(token_blocks.write_shard([1], [len(ids)], ids.astype("<u4"))) < 2 * len(ids)


def digests(spark, docs):
    files = token_blocks.token_table(docs, WORD, 2)
    rows = token_blocks.read_token_files(files)
    return token_blocks.with_starts(rows, files).collect()


def test_files_hold_documents_in_order(spark, small, monkeypatch):
    docs = spark.createDataFrame(small, "doc_id long, text string").repartition(7)
    monkeypatch.setattr(token_blocks, "SHARD_IDS", 3000)
    got = sorted(digests(spark, docs), key=lambda r: r.doc_id)
    at = 0
    for r, (doc_id, text) in zip(got, sorted(small)):
        want = ids_of(WORD, text, 2)
        assert (r.doc_id, r.start, np.frombuffer(r.ids, "<u4").tolist()) == (doc_id, at, want)
        at += len(want)
    assert len(got) == len(small)


def test_token_files_of_odd_rows(spark, odd, none):
    got = sorted(digests(spark, odd), key=lambda r: r.start)
    assert sorted(map(str, (r.doc_id for r in got))) == sorted(str(i) for i, _ in ODD)
    keys = [(r.doc_id is not None, r.doc_id or 0) for r in got]
    assert keys == sorted(keys)
    assert got[0].start == 0
    for a, b in zip(got, got[1:]):
        assert b.start == a.start + len(a.ids) // 4
    want = sorted((str(i), ids_of(WORD, t, 2)) for i, t in ODD)
    assert sorted((str(r.doc_id), np.frombuffer(r.ids, "<u4").tolist()) for r in got) == want
    assert digests(spark, none) == []


def test_registered_query_matches_the_plain_tokenizer(spark, small):
    from boxoffice.llm.queries import QUERIES
    from tests.conftest import SF

    got = {r.doc_id: r for r in QUERIES["op2_token_blocks"](spark, SF).collect()}
    at = 0
    for doc_id, text in sorted(small):
        ids = ids_of(WORD, text, 2)
        r = got.pop(doc_id)
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert not got


def put_together(sequences):
    docs = {}
    for s in sequences:
        ids, at = np.frombuffer(s.input_ids, "<u4"), 0
        assert s.n_ids == len(ids) <= s.tier
        for p in s.pieces:
            assert p.offset == at and p.length > 0
            docs.setdefault(p.doc_id, []).append((p.start, ids[at : at + p.length].tolist(), p.doc_tokens))
            at += p.length
        assert at == len(ids)
    return docs


def test_packing_holds_every_id_once(spark, small):
    docs = spark.createDataFrame(small, "doc_id long, text string").repartition(2)
    out = packing.pack_documents(docs, BYTE, 1).collect()
    assert len({s.sequence_id for s in out}) == len(out)
    found = put_together(out)
    for doc_id, text in small:
        want, pieces = ids_of(BYTE, text, 1), sorted(found.pop(doc_id))
        assert [i for _, ids, _ in pieces for i in ids] == want
        assert all(n == len(want) for _, _, n in pieces)
    assert not found
    n = sum(s.n_ids for s in out)
    padded = sum(s.n_ids if s.n_ids & (s.n_ids - 1) == 0 else 2048 for s in out)
    assert padded - n <= 2 * 2048  # a window per task


def test_packing_odd_rows(odd, none):
    out = packing.pack_documents(odd, BYTE, 1, pool_ids=500).collect()
    found = put_together(out)
    assert sum(len(ids) for ps in found.values() for _, ids, _ in ps) == sum(len(ids_of(BYTE, t, 1)) for _, t in ODD)
    assert packing.pack_documents(none, BYTE, 1).collect() == []


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 9000), max_size=60))
def test_windows_are_full_but_one(lengths):
    windows = packing.pack_pool(lengths)
    covered = [[] for _ in lengths]
    for w in windows:
        assert sum(p.length for p in w.pieces) == w.size - w.gap <= w.size
        for p in w.pieces:
            covered[p.doc].append((p.start, p.start + p.length))
    for n, spans in zip(lengths, covered):
        ends = [0, *(x for s in sorted(spans) for x in s), n]
        assert all(a == b for a, b in zip(ends[::2], ends[1::2]))
    assert sum(w.gap > 0 for w in windows) <= 1
    groups = packing.step_groups(windows, 3)
    load = [sum(w.size - w.gap for w, g in zip(windows, groups) if g == k) for k in range(3)]
    assert max(load) - min(load) <= 2048


def test_letters_that_gain_a_mark_in_lower_case():
    for path in (WORD, BYTE):
        plain = Tokenizer.from_file(path)
        for text in ("DİYARBAKIR ve İ. Çelik", "İ, K", "Iİ! İI?", "İİ...", "aİ b"):
            assert Encoder(path).encode(text).tolist() == plain.encode(text, add_special_tokens=False).ids


def test_random_texts_with_a_small_memory():
    rng = random.Random(1)
    letters = list("abcABCéÉñßİıÅø漢字かΣςσжЖ😀'’-–.,!?%&#*()[]<>|/\\_019 \t\n\r\x0b\x0c\x85\xa0\x1c\x00\u0301\u0307ǅﬁ")
    letters += [" "] * 15 + list("abcdefghij") * 3
    for path in (WORD, BYTE):
        plain, own = Tokenizer.from_file(path), Encoder(path, remember=100)
        for _ in range(10_000):
            text = "".join(rng.choices(letters, k=rng.randrange(40)))
            assert own.encode(text).tolist() == plain.encode(text, add_special_tokens=False).ids, text
