from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from boxoffice.llm import fim
from tests.llm.conftest import LONG, ODD


def by_hand(doc_id, text):
    text = text or ""
    n = len(text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", text
    if h[3] % 100 < 20:
        return n, "spm", f"<S>{text[b:]}<P>{text[:a]}<M>{text[a:b]}"
    return n, "psm", f"<P>{text[:a]}<S>{text[b:]}<M>{text[a:b]}"


TRICKY = [
    (20, "a <P> mark"),
    (21, "<S>"),
    (22, "x<M>"),
    (23, "<P<S<M" * 50),
    (24, "<" * 600),
    (25, "$1 $2 \\1 \\E \\Q ${a}"),
    (26, "line\r\nline line\u0085line\x0b\x0c" * 40),
    (27, "\U0001f600" * 257),
    (28, "é" * 512),
    (29, "ab" * 128),
]


def rows(spark):
    more = TRICKY + [(1000 + i, "P>S>M><"[: i % 8] + "wörd \U0001f680 " * i + "<PSM"[: i % 5]) for i in range(150)]
    return ODD + more


def test_equal_to_slices(spark):
    data = rows(spark)
    out = fim.fill_in_middle(spark.createDataFrame(data, "doc_id long, text string").repartition(3))
    found = out.withColumn("back", fim.restore(F.col("output"), F.col("form"))).collect()
    assert sorted(map(str, ((r.doc_id, r.n, r.form, r.output) for r in found))) == sorted(
        map(str, ((i, *by_hand(i, t)) for i, t in data))
    )
    assert all(r.back == r.text for r in found)
    assert {r.form for r in found} == {"plain", "psm", "spm"}
    assert max(r.n for r in found) == len(LONG)


def test_odd_columns_and_no_rows(odd, none):
    assert fim.fill_in_middle(odd).count() == len(ODD)
    assert fim.fill_in_middle(none).count() == 0
    clash = odd.withColumn("n", F.lit(1)).withColumn("form", F.lit("x")).withColumn("output", F.lit("y")).withColumn("_x", F.lit(2))
    assert fim.fill_in_middle(clash).where("form = 'x' or output = 'y'").count() == 0


def test_words_as_units(spark):
    docs = spark.createDataFrame([(i, "one two  three\nfour " * 5) for i in range(40)], "doc_id long, text string")
    out = fim.fill_in_middle(docs, unit=r"(?:\s*+\S++\s*+)", plain_percent=0, spm_percent=50)
    found = out.withColumn("back", fim.restore(F.col("output"), F.col("form"))).collect()
    assert all(r.n == 20 and r.back == r.text for r in found)
    assert {r.form for r in found} == {"psm", "spm"}
    for r in found:
        middle = r.output.split("<M>")[1]
        assert len(middle.split()) == r.cut_b - r.cut_a


def test_no_shuffle_and_no_python(odd):
    plan = fim.fill_in_middle(odd.coalesce(1))._jdf.queryExecution().explainString(odd.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
    assert "Python" not in plan and "Arrow" not in plan
    assert "hashpartitioning" not in plan and "rangepartitioning" not in plan
