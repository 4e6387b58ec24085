"""Held-out accuracy on the labelled documents, and that held-out labels and ids are not used."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import compression_quality, conv_toxicity, labelled
from ledgerlake.llm.common import held_out

FOLDER = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(f"{FOLDER}/labels.parquet")


def held_out_rows(scores, labels, label):
    rows = scores.filter("held_out").join(labels, "doc_id").select("predicted", label).collect()
    return np.array([[r[0], r[1]] for r in rows])


def test_quality(tables):
    docs, labels = tables
    got = held_out_rows(compression_quality.quality_scores(docs, compression_quality.train(docs, labels)), labels, "quality")
    assert (got[:, 0] == got[:, 1]).mean() > 0.96
    assert got[got[:, 1] == 1, 0].mean() > 0.98 and got[got[:, 1] == 0, 0].mean() < 0.15


def test_toxicity(tables):
    docs, labels = tables
    model = conv_toxicity.train(docs, labels)
    assert set(model.cuts) >= {"", "en"}
    got = held_out_rows(conv_toxicity.toxicity_scores(docs, model), labels, "toxic")
    assert got[got[:, 1] == 1, 0].mean() > 0.88 and got[got[:, 1] == 0, 0].mean() < 0.02


def test_held_out_labels_do_not_matter(spark, tables):
    docs, labels = tables
    docs = docs.limit(600)
    flipped = labels.withColumns({c: F.when(held_out(), 1 - labels[c]).otherwise(labels[c]) for c in ("quality", "toxic")})
    a, b = (compression_quality.train(docs, x) for x in (labels, flipped))
    assert a.good == b.good and a.bad == b.bad and (a.terms == b.terms).all()
    a, b = (conv_toxicity.train(docs, x) for x in (labels, flipped))
    assert (a.table == b.table).all() and (a.out == b.out).all() and a.cuts == b.cuts


def test_gradient_of_the_network():
    """One step lowers the loss of what it saw."""
    texts = [b"good day to you all here", b"you are scum and trash", b"a fine day", b"what trash you write"] * 8
    y = np.array([0, 1, 0, 1] * 8)
    model = conv_toxicity.fit(texts, y)
    p = conv_toxicity.scores(model, texts)
    assert p[y == 1].min() > 0.7 > 0.3 > p[y == 0].max()


def test_threshold():
    s, y = np.array([0.1, 0.2, 0.3, 0.8, 0.9]), np.array([0, 0, 0, 1, 1])
    assert 0.3 < conv_toxicity.threshold(s, y) < 0.8
    assert conv_toxicity.threshold(s, np.zeros(5, int)) == conv_toxicity.CUT


def test_every_labelled_text_counts(spark, monkeypatch):
    monkeypatch.setattr(labelled, "PER_CLASS", 20)
    monkeypatch.setattr(conv_toxicity, "TASK_TEXTS", 100)
    rows = [(i, ("vile " if i % 2 else "kind ") + f"word{i} " * (6000 if i % 100 == 0 else 3), "en") for i in range(1200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = docs.select("doc_id", (docs.doc_id % 2).cast("int").alias("toxic"))
    learnt = labelled.learnt(docs, labels, "toxic", more=("lang",))
    counts, n = conv_toxicity.bucket_counts(learnt)
    assert n.sum() == learnt.count() == docs.filter(~held_out()).count()
    assert counts[:, conv_toxicity._bucket(b"vile")].tolist() == [0, n[1]] and counts[:, conv_toxicity._bucket(b"kind")].tolist() == [n[0], 0]
    model = conv_toxicity.train(docs, labels)
    assert sum(c.sum() for c in conv_toxicity.score_counts(learnt, model).values()) == n.sum()
    got = held_out_rows(conv_toxicity.toxicity_scores(docs, model), labels, "toxic")
    assert (got[:, 0] == got[:, 1]).all()


def shuffles_of_texts(plan) -> int:
    children = plan.children()
    own = plan.nodeName() == "Exchange" and "text#" in plan.output().toString()
    return own + sum(shuffles_of_texts(children.apply(i)) for i in range(children.size()))


def test_texts_to_learn_from_are_shuffled_once(spark, monkeypatch):
    """However large the labels are, so what is shuffled does not grow faster than the texts."""
    monkeypatch.setattr(conv_toxicity, "TASK_TEXTS", 100)
    docs = spark.createDataFrame([(i, f"word{i} here", "en") for i in range(900)] + [(7, "another text", None), (None, "no id", "en")], "doc_id long, text string, lang string")
    labels = docs.select("doc_id", (docs.doc_id % 2).cast("int").alias("toxic")).filter("doc_id < 800")
    plans, written = [], conv_toxicity.materialize

    def seen(df, purpose):
        plans.append(df)
        return written(df, purpose)

    monkeypatch.setattr(conv_toxicity, "materialize", seen)
    for threshold in ("-1", "10485760"):
        with_conf = {"spark.sql.autoBroadcastJoinThreshold": threshold, "spark.sql.adaptive.enabled": "false"}
        before = {k: spark.conf.get(k) for k in with_conf}
        try:
            for k, v in with_conf.items():
                spark.conf.set(k, v)
            conv_toxicity.train(docs, labels)
            assert shuffles_of_texts(plans[-1]._jdf.queryExecution().executedPlan()) == 1
            got = sorted(r["doc_id"] for r in plans[-1].collect())
        finally:
            for k, v in before.items():
                spark.conf.set(k, v)
        assert got == sorted(r["doc_id"] for r in docs.filter(~held_out() & F.col("doc_id").isNotNull() & (F.col("doc_id") < 800)).collect())
