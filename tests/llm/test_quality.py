from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import functions as F

from boxoffice.llm import quality
from tests.llm.conftest import LONG, ODD


def bag(text):
    data = np.frombuffer(text.encode(), np.uint8)
    return quality.passages(data, np.array([0, len(data)]))[0]


def test_rows_are_encoded_on_their_own():
    texts = [t or "" for _, t in ODD[:-1]] + ["a b " * 700, "", "x"]
    data = "".join(texts).encode()
    starts = np.concatenate(([0], np.cumsum([len(t.encode()) for t in texts])))
    vectors, owner = quality.passages(np.frombuffer(data, np.uint8), starts)
    for i, t in enumerate(texts):
        assert np.allclose(vectors[owner == i], bag(t)), t[:30]


def test_long_texts_are_scored_in_parts():
    model = quality.fit(np.random.default_rng(0).random((40, quality.WIDTH)), np.arange(40), np.arange(40) % 2.0)
    text = ("Some words, and 1 more!! " * 3000 + "UPPER " * 500) * 40
    data = np.frombuffer(text.encode(), np.uint8)
    starts = np.array([0, len(data)])
    assert len(data) > quality._STEP * quality.PASSAGE
    vectors, owner = quality.passages(data, starts)
    got, count = quality.score_rows(model, data, starts)
    assert np.allclose(got, model.score(vectors, owner, 1)) and count[0] == len(vectors)


def test_gradients_lead_to_a_fit():
    rng = np.random.default_rng(1)
    owner = np.repeat(np.arange(200), 4)
    vectors, target = rng.normal(size=(800, 6)), np.arange(200) % 2.0
    vectors[::4, 2] += 4 * (1 - target)  # one passage of a poor document shows it
    model = quality.fit(vectors, owner, target)
    assert ((model.score(vectors, owner, 200) > 0.5) == target).mean() > 0.95


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    out = quality.score_documents(docs, labels)
    assert out.count() == docs.count()
    rows = out.join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    rows = [r for r in rows if r.held_out]
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.95
    good = [r.score for r in rows if r.quality]
    poor = [r.score for r in rows if not r.quality]
    assert np.mean([[g > p for g in good] for p in poor]) > 0.97


def test_held_out_labels_do_not_matter(spark):
    folder = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    turned = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (quality.score_documents(docs, x).orderBy("doc_id").collect() for x in (labels, turned))
    assert a == b


def test_odd_rows(spark, odd, none):
    some = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (3, 0), (8, 1), (6, 0)], "doc_id long, quality int")
    got = quality.score_documents(odd, some).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in ODD)
    assert all(0 <= r.score <= 1 for r in got)
    same = [r.score for r in got if r.doc_id == 1]
    assert same[0] == same[1]
    assert {r.score for r in quality.score_documents(odd, some.where("false")).collect()} == {0.5}
    assert quality.score_documents(none, some).collect() == []
    kept = quality.keep_good(odd, some.where("false"))
    assert kept.columns == odd.columns and kept.count() == len(ODD)
    assert len(bag(LONG)) == len(LONG) // 512 + 1


def test_the_fit_takes_all_passages(spark, monkeypatch):
    clean = "The band plays its second concert in the old town hall tonight, and seats are left. " * 420
    texts = {1: clean + "$$ BUY !!! 99 " * 600, 2: clean, 3: LONG, 4: "", 6: "word"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(2)
    labels = spark.createDataFrame([(i, i % 2) for i in texts], "doc_id long, quality int")
    held = []
    monkeypatch.setattr(quality, "fit", lambda vectors, owner, target, seed: held.append((vectors, owner, target)))
    quality.learn(docs, labels)
    ((vectors, owner, target),) = held
    used = {r.doc_id for r in docs.where(~quality.held_out(F.col("doc_id"))).collect()}
    assert {1, 3} & used and len(target) == len(used)
    bags = sorted(vectors[owner == i].astype(np.float32).tobytes() for i in range(len(target)))
    assert bags == sorted(bag(texts[i]).tobytes() for i in used)
    assert max(len(bag(texts[i])) for i in used) > 64
