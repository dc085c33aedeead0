import zlib

import numpy as np

from flowguard.llm.quality_classifier import (Model, _forward, fit_classifier, passage_features, score_documents,
                                              score_texts, train)
from flowguard.llm.queries import op4_quality_classifier
from tests.llm.util import SF01, read


def test_held_out_quality(spark):
    got = {r["doc_id"]: r for r in op4_quality_classifier(spark, SF01).collect()}
    labels = {r["doc_id"]: r["quality"] for r in read(spark, "labels", SF01).collect()}
    assert set(got) == {r["doc_id"] for r in read(spark, "documents", SF01).collect()}
    for i, r in got.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    fold = [(got[i]["score"], got[i]["predicted"], q) for i, q in labels.items() if i in got and got[i]["held_out"]]
    good = [s for s, _, q in fold if q == 1]
    bad = [s for s, _, q in fold if q == 0]
    auc = np.mean([(g > b) + (g == b) / 2 for g in good for b in bad])
    assert auc > 0.95
    assert np.mean([p == q for _, p, q in fold]) > 0.93
    assert np.mean([p for _, p, q in fold if q == 1]) > 0.97


def test_gradient_direction_and_attention():
    """The label sits in one passage of each bag: attention has to find it."""
    rng = np.random.default_rng(0)
    x, owner, label = [], [], []
    for b in range(300):
        y = b % 2
        rows = rng.normal(size=(5, 12))
        rows[:, 0] = 0
        k = rng.integers(5)
        rows[k, 0], rows[k, 1] = 3, (2 if y else -2)
        x.append(rows), owner.extend([b] * 5), label.append(y)
    x, owner, label = np.concatenate(x).astype(np.float32), np.array(owner), np.array(label, np.float32)
    m = train(x, owner, label, epochs=60)
    *_, a, _, p = _forward(m, (x - m.mean) / m.scale, owner)
    assert np.mean((p > 0.5) == label) > 0.97
    assert a[x[:, 0] == 3].mean() > 0.4 > 1 / 5


def test_edge_rows_and_no_labels(spark):
    rows = [(1, None), (2, ""), (3, "good words are here " * 40), (None, "x"), (5, "!! ## " * 90), (5, "!! ## " * 90),
            (6, "é" * 30000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS _score", "'q' AS label")
    labels = spark.createDataFrame([(1, 0), (2, 0), (3, 1), (3, 1), (5, 0), (None, 1), (9, 1), (6, None)], "doc_id long, quality int")
    model = fit_classifier(df, labels)
    assert isinstance(model, Model)
    got = score_documents(df, model, keep=["label", "_score"]).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 and r["label"] == "q" and r["_score"] == 1 for r in got)
    assert len({r["score"] for r in got if r["doc_id"] == 5}) == 1
    assert fit_classifier(df, labels.limit(0)) is None
    assert {r["score"] for r in score_documents(df, None).collect()} == {0.5}
    assert score_documents(df.limit(0), model).collect() == []
    # a text scores the same alone and beside others
    texts = [t for _, t in rows]
    assert np.allclose(score_texts(model, texts), [score_texts(model, [t])[0] for t in texts], atol=1e-5)


def test_passages():
    x, owner = passage_features(["a " * 250, "", "b"], 100)
    assert owner.tolist() == [0, 0, 0, 1, 2] and not x[3].any()


def test_training_set_is_bounded(spark, monkeypatch):
    """Rows that repeat an id give one bag, and long texts do not exceed the passages."""
    from flowguard.llm import quality_classifier as q
    seen = []
    monkeypatch.setattr(q, "train", lambda x, owner, label: seen.append((len(x), len(label))))
    rows = [(1, f"copy {i}") for i in range(400)] + [(2, "a " * 250), (3, "b " * 100), (4, "c " * 900), (5, "d")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 6)], "doc_id long, quality int")
    fit_classifier(df, labels)
    fit_classifier(df, labels, passages=6)
    assert seen == [(15, 5), (6, 4)]
