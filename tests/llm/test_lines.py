from __future__ import annotations

import re

import pytest

from boxoffice.llm.lines import line_dedup
from boxoffice.llm.queries import QUERIES
from tests.llm.conftest import ODD

LINE = "This line has more than forty characters, in all of its forms."


def normal(unit):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in unit)
    return re.sub(r"[\x20\x09-\x0D]+", " ", low).strip(" ")


def brute(rows, mark="\n", least=1):
    seen, out = set(), []
    for i, t in rows:
        kept, removed, at = [], [], 0
        for n, unit in enumerate((t or "").split(mark)):
            key = normal(unit)
            if len(key) >= least and key in seen:
                removed.append((n, at, len(unit)))
            else:
                kept.append(unit)
            if len(key) >= least:
                seen.add(key)
            at += len(unit) + len(mark)
        out.append((i, len(kept) + len(removed), len(removed), removed, mark.join(kept)))
    return out


def result(df):
    return [(r.doc_id, r.n_units, r.n_removed, [tuple(x) for x in r.removed], r.kept_text) for r in df.collect()]


@pytest.mark.parametrize("unit,mark", [("line", "\n"), ("paragraph", "\n\n")])
def test_test_table(spark, small, unit, mark):
    docs = spark.createDataFrame(small, "doc_id long, text string").repartition(5)
    assert sorted(result(line_dedup(docs, unit))) == sorted(brute(sorted(small), mark))


def test_earliest_occurrence_stays(spark):
    rows = [(2, f"{LINE}\nshort\n {LINE.upper()}"), (1, f"a\n{LINE}\nshort"), (3, f"{LINE}\n{LINE}"), (None, LINE)]
    got = sorted(result(line_dedup(spark.createDataFrame(rows, "doc_id long, text string"))), key=str)
    want = sorted(brute([rows[1], rows[0], rows[2], rows[3]]), key=str)
    assert got == want
    assert {r[0]: r[2] for r in got} == {1: 0, 2: 3, 3: 2, None: 1}


def test_repeated_rows_get_one_decision(spark):
    rows = [(1, LINE), (1, LINE), (2, LINE), (2, LINE)]
    got = result(line_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)))
    assert sorted((r[0], r[2]) for r in got) == [(1, 0), (1, 0), (2, 1), (2, 1)]


def test_odd_rows(odd, none):
    got = result(line_dedup(odd))
    assert sorted(str(r[0]) for r in got) == sorted(str(i) for i, _ in ODD)
    by_id = {r[0]: r for r in got if r[0] is not None}
    assert by_id[1][2] == 0 and by_id[2][2] == 1 and by_id[3][1:] == (1, 0, [], "")
    assert by_id[5][4] == " \n\t " and by_id[8][2] == 0
    assert line_dedup(none).collect() == []


def test_registered_query_without_floor(spark, small):
    from tests.conftest import SF

    got = {r.doc_id: (r.n_units, r.n_removed, r.removed) for r in QUERIES["op6_line_dedup_any_length"](spark, SF).collect()}
    want = {
        i: (units, gone, " ".join(":".join(map(str, s)) for s in spans))
        for i, units, gone, spans, _ in brute(sorted(small), least=1)
    }
    assert got == want
    removed = [len(normal(small_text[a : a + n])) for i, small_text in small for _, a, n in (map(int, s.split(":")) for s in got[i][2].split())]
    assert 1 <= min(removed) < 40
