from __future__ import annotations

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from conftest import SMALL
from helpers import documents
from pyspark.sql import functions as F

from earshot.llm import classifier
from earshot.llm.common import table

MIDDLE = SMALL.replace("sf0.001", "sf0.01")


def test_held_out_accuracy(spark):
    docs, labels = table(spark, MIDDLE, "documents"), table(spark, MIDDLE, "labels")
    held = F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0
    model = classifier.fit(docs, labels.where(~held))
    scored = classifier.score_documents(docs, model).join(labels.where(held), "doc_id")
    rows = scored.select("score", "quality").collect()
    right = [(r["score"] >= classifier.GOOD) == (r["quality"] == 1) for r in rows]
    assert len(rows) > 80 and np.mean(right) > 0.95
    good = [r["score"] for r in rows if r["quality"] == 1]
    assert np.mean([s >= classifier.GOOD for s in good]) > 0.97


def test_views_teach_each_other():
    draw = np.random.default_rng(1)
    n = 2000
    truth = (draw.random(n) < 0.7).astype(float)
    text = np.stack([truth * 2 + draw.normal(size=n), draw.normal(size=n)], axis=1)
    meta = np.stack([truth * 3 + draw.normal(size=n), draw.normal(size=n)], axis=1)
    model = classifier.co_train(text[:80], meta[:80], truth[:80], text[80:1000], meta[80:1000])
    a, b, both = (((s >= 0.5) == truth)[1000:].mean() for s in model.scores(text, meta))
    assert both >= max(a, b) - 0.01 and both > 0.9
    alone = classifier.co_train(text[:80], meta[:80], truth[:80], text[:0], meta[:0])
    assert alone.text is not None


@pytest.mark.parametrize("labels", [[], [1.0] * 20, [0.0] * 20])
def test_without_both_classes_the_share_is_the_score(labels):
    x = np.zeros((len(labels), 2))
    model = classifier.co_train(x, x, np.array(labels), x, x)
    expected = float(np.mean(labels)) if labels else 1.0
    assert set(model.scores(np.zeros((3, 2)), np.zeros((3, 2)))[2]) == {expected}


def test_text_features_do_not_depend_on_chunks():
    texts = ["The cat. " * k for k in (1, 5, 200)] + [None, "", " ", "\n\n", "a\na\nb\na", "é" * 3000, "Shti " * 40]
    whole = classifier.text_features(pa.array(texts, pa.string()))
    single = np.vstack([classifier.text_features(pa.array([t], pa.string())) for t in texts])
    assert np.allclose(whole, single)
    lines = classifier.text_features(pa.array(["a\na\nb\na"]))[0]
    assert lines[-2] == 0.5
    assert classifier.text_features(pa.array(["Shti " * 40]))[0][-5] == pytest.approx(39 / 40)


def test_features_of_many_texts_need_little_memory(monkeypatch):
    texts = pa.array(["Some words\nof a line, and more.\n" * k for k in range(1, 400)])
    tracemalloc.start()
    found = classifier.text_features(texts)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 40e6
    monkeypatch.setattr(classifier, "CHUNK_BYTES", 1 << 30)
    assert (classifier.text_features(texts) == found).all()


def test_awkward_rows(spark):
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0), (2, "x " * 60_000, "xx", None, -5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.withColumn("score", F.lit("old")).withColumn("scores", F.lit("s"))
    labels = spark.createDataFrame([(1, 1), (1, None), (2, 7), (None, 0)], "doc_id long, quality int")
    got = classifier.score_documents(docs, classifier.fit(docs, labels))
    assert got.count() == 4 and dict(got.dtypes)["score"] == "double"
    assert got.where("score IS NULL").count() == 0
    empty = documents(spark, [])
    assert classifier.score_documents(empty, classifier.fit(empty, labels.limit(0))).count() == 0
