from __future__ import annotations

import random
import re

import numpy as np
import pytest

from boxoffice.llm import decontaminate as d
from tests.llm.conftest import LONG, ODD


def closest(window, text):
    """Least edit distance of the window to any stretch of the text (all of it, plainly)."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(window):
        new = [i + 1]
        for j, t in enumerate(text):
            new.append(min(row[j] + (c != t), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def brute(text, items):
    chars = d.plain(d.code_points((text or "").replace("\0", " ")))[0].tolist()
    return sorted(
        {i for i, t in items for w in d.item_windows(t) if closest(w.tolist(), chars) <= d.edit_budget(len(w))}
    )


def changed(rng, text, n):
    chars = list(text)
    for _ in range(n):
        at = rng.randrange(len(chars))
        kind = rng.randrange(3)
        if kind == 0:
            chars[at] = rng.choice("qxz ")
        elif kind == 1:
            del chars[at]
        else:
            chars.insert(at, rng.choice("qxz"))
    return "".join(chars)


@pytest.fixture(scope="module")
def items(spark):
    from tests.conftest import SF

    return [(r[0], r[1]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()][:6]


def found(spark, rows, items):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    bench = spark.createDataFrame(items, "item_id long, text string")
    return {r.doc_id: r for r in d.find_leaks(docs, bench).collect()}


def test_same_items_as_full_alignment(spark, items, small):
    rng = random.Random(3)
    rows = []
    for n in range(40):
        base = rng.choice(small)[1][:300]
        item = rng.choice(items)[1]
        part = item if n % 2 else item[: rng.randint(60, 140)]
        at = rng.randint(0, len(base))
        rows.append((n, base[:at] + changed(rng, part, rng.randint(0, 14)).upper() + base[at:]))
    got = found(spark, rows, items)
    for n, text in rows:
        assert sorted(x.item_id for x in got[n].leaks) == brute(text, items), n
    assert 10 < sum(r.contaminated for r in got.values()) < 40


def test_places(spark, items):
    text = "\u00e9 \n " * 30 + items[0][1].replace(" ", "  \n") + " tail"
    (leak,) = found(spark, [(1, text)], items)[1].leaks
    stretch = text[leak.start : leak.start + leak.length]
    assert leak.item_id == items[0][0] and leak.distance == 0
    assert stretch in text and len(re.sub(r"\s+", " ", stretch)) == 80


def test_clean_documents_are_left_alone(spark, small):
    from tests.conftest import SF

    bench = [(r[0], r[1]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = found(spark, small, bench)
    norm = {i: "".join(map(chr, d.plain(d.code_points(t))[0])) for i, t in bench}
    for doc_id, text in small:
        plain = "".join(map(chr, d.plain(d.code_points(text))[0]))
        whole = {i for i, t in norm.items() if t.strip() in plain}
        assert whole <= {x.item_id for x in got[doc_id].leaks}
        assert all(brute(text[max(0, x.start - 50) : x.start + x.length + 50], [b for b in bench if b[0] == x.item_id]) for x in got[doc_id].leaks)


def test_no_document_ends_inside_a_leak(spark, items):
    half = items[0][1]
    rows = [(n, half[:60] if n % 2 else half[60:120]) for n in range(20)]
    assert not any(r.contaminated for r in found(spark, rows, items).values())


def test_long_texts_and_slices(spark, items, monkeypatch):
    rows = [(1, LONG + items[0][1]), (2, LONG), (3, LONG[: (1 << 20) - 100] + items[1][1] + LONG)]
    for size in (d.SLICE_CHARS, 900):
        monkeypatch.setattr(d, "SLICE_CHARS", size)
        got = found(spark, rows, items)
        assert [[x.item_id for x in got[i].leaks] for i in (1, 2, 3)] == [[items[0][0]], [], [items[1][0]]]


def test_odd_rows(spark, odd, none, items):
    odd_items = [*items, items[0], (None, "alpha beta gamma delta epsilon zeta eta theta iota kappa"), (None, None), (9, ""), (9, "word")]
    bench = spark.createDataFrame(odd_items, "item_id long, text string")
    got = d.find_leaks(odd, bench).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in ODD)
    assert sorted(str(r.doc_id) for r in got if r.contaminated) == ["1", "1", "2", "None"]
    assert d.find_leaks(none, bench).collect() == []
    assert not any(r.contaminated for r in d.find_leaks(odd, bench.where("false")).collect())
    kept = d.drop_contaminated(odd, bench)
    assert kept.columns == odd.columns and kept.count() == len(ODD) - 4


def test_budget_and_bound():
    assert [d.edit_budget(n) for n in (80, 24, 40)] == [8, 2, 4]
    assert all(n + 1 - d.Q * (d.edit_budget(n) + 1) >= 1 for n in range(24, 81))
    assert np.all(d.plain(d.code_points("A \t B"))[0] == d.code_points("a b"))


def one_item(items):
    return [(i, "".join(map(chr, d.item_chars(t)))) for i, t in items if len(t) > 230][:1]


def test_quotes_may_start_anywhere_in_an_item(spark, items):
    ((item, text),) = bench = one_item(items)
    starts = range(len(text) - 79)
    quotes = [(s, f"zq jx vk wq {text[s : s + 80]} qz xj kv qw") for s in starts]
    got = found(spark, quotes, bench)
    assert [s for s in starts if [x.item_id for x in got[s].leaks] != [item]] == []
    # Eight edits far apart, the first and the last at the edges.
    apart = {0, 11, 22, 33, 44, 55, 66, 79}
    worn = [(s, "".join("§" if k in apart else c for k, c in enumerate(text[s : s + 80]))) for s in starts]
    got = found(spark, worn, bench)
    assert [s for s in starts if not got[s].contaminated] == []


def test_short_items_stand_between_word_bounds(spark, items):
    bench = [(1, "Blue  whale"), (2, "42"), (3, "(x)"), (4, "été"), (None, "end"), (5, " "), *((9, t) for _, t in one_item(items))]
    rows = [(1, "a BLUE\nwhale, 42"), (2, "blue whales 421 142 weekend étés"), (3, "f(x)=42."), (4, "ÉTÉ end"), (5, None), (6, "")]
    rows += [(7, "a" * (1 << 20) + " " + "b" * 1000 + " blue whale"), (8, "x" * ((1 << 20) - 3) + "blue whale" + " y" * 300)]
    docs, few = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string")
    got = {r.doc_id: [(x.item_id, x.start, x.length, x.distance) for x in r.leaks] for r in d.find_leaks(docs, few, short=True).collect()}
    assert got[1] == [(1, 2, 10, 0), (2, 14, 2, 0)] and got[2] == []
    assert got[3] == [(2, 5, 2, 0), (3, 1, 3, 0)] and got[4] == [(4, 0, 3, 0), (None, 4, 3, 0)]
    assert got[5] == got[6] == got[8] == [] and [x[0] for x in got[7]] == [1]
    assert {r.doc_id for r in d.drop_contaminated(docs, few, short=True).collect()} == {2, 5, 6, 8}
    assert not any(r.contaminated for r in d.find_leaks(docs, few).collect())


def test_long_items_are_indexed_in_pieces(spark, items, monkeypatch):
    ((item, text),) = bench = one_item(items)
    monkeypatch.setattr(d, "_PIECE", 50)
    quotes = [(s, f"zq jx vk {text[s : s + 80]} qz xj") for s in range(0, len(text) - 79, 7)]
    assert all(r.contaminated for r in found(spark, quotes, bench).values())


def test_regions_cover_all_that_was_copied(spark, items):
    ((item, text),) = bench = one_item(items)
    other = next(b for b in items if b[0] != item)
    worn = text[:110] + "§" + text[111:]
    foreign = " zq jx vk wq" * 20
    rows = [(1, f"{foreign} {text} {foreign} {text[20:130]}{foreign}"), (2, f"{foreign} {worn}{foreign}"), (3, f"{text} {other[1]}"), (4, foreign)]
    got = {i: found(spark, rows, [*bench, other])[i] for i in range(1, 5)}
    cut = lambda n: [(x.item_id, rows[n - 1][1][x.start : x.start + x.length], x.distance) for x in got[n].regions]
    (a, whole, da), (b, part, db) = cut(1)
    assert a == b == item and da == db == 0 and text in whole and text[20:130] in part
    # The windows at the edges may lie within the budget with some foreign characters.
    assert len(whole) <= len(text) + 16 and len(part) <= 110 + 16
    ((_, stretch, distance),) = cut(2)
    assert worn in stretch and len(stretch) <= len(worn) + 16 and distance == 0
    assert sorted({x.item_id for x in got[3].regions}) == sorted([item, other[0]]) == sorted(x.item_id for x in got[3].leaks)
    assert got[1].n_items == 1 and len(got[1].leaks) == 1 and got[4].regions == []
