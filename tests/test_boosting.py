import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier, OneVsRest
from pyspark.sql import functions as F

from flowguard.operators import boosting, models, validate
from flowguard.sources.files import scratch_path

FEATS = ["good", "fair", "noise"]


def softmax(f):
    e = np.exp(f - f.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def brute_fit(x, y, k, rounds, depth, rate):
    """Friedman's algorithm with exact cuts at every midpoint; one list of leaf values per row."""
    prior = np.log([np.mean(y == c) for c in range(k)])
    f = np.tile(prior, (len(y), 1))
    losses = []

    def grow(rows, r, h, level):
        value = (k - 1) / k * r[rows].sum() / h[rows].sum()
        best = (1e-12, None)
        if level < depth:
            for j in range(x.shape[1]):
                v = np.unique(x[rows, j])
                for c in (v[1:] + v[:-1]) / 2:
                    left = rows[x[rows, j] <= c]
                    right = rows[x[rows, j] > c]
                    gain = len(left) * len(right) / len(rows) * (r[left].mean() - r[right].mean()) ** 2
                    if gain > best[0] * (1 + 1e-12):
                        best = (gain, (left, right))
        if best[1] is None:
            return [(rows, value)]
        return grow(best[1][0], r, h, level + 1) + grow(best[1][1], r, h, level + 1)

    for _ in range(rounds):
        p = softmax(f)
        losses.append(-np.log(p[np.arange(len(y)), y]).mean())
        for c in range(k):
            r = (y == c) - p[:, c]
            for rows, value in grow(np.arange(len(y)), r, p[:, c] * (1 - p[:, c]), 0):
                f[rows, c] += rate * value
    return softmax(f), losses


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(7)
    y = rng.integers(0, 3, 180)
    x = np.stack([y * 2 + rng.normal(0, 0.7, 180), (y == 1) + rng.normal(0, 0.8, 180), rng.normal(0, 1, 180)], axis=1).round(2)
    rows = [(i, *map(float, v), "abc"[c]) for i, (v, c) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id long, good double, fair double, noise double, y string").cache(), x, y


def probabilities(model, df):
    rows = models.class_probabilities(model, models.score(model, df), ["id"]).collect()
    out = {}
    for r in rows:
        out.setdefault(r["id"], {})[r["class"]] = r["probability"]
    return np.array([[out[i][c] for c in "abc"] for i in sorted(out)])


def test_equals_plain_boosting(table):
    df, x, y = table
    m = models.fit_pipeline(df, FEATS, "y", models.make_estimator("boosting", maxIter=6, maxDepth=2))
    want, losses = brute_fit(x, y, 3, 6, 2, 0.1)
    assert np.abs(probabilities(m, df) - want).max() < 1e-9
    assert np.allclose(m.stages[-2].lossHistory, losses)


def test_loss_falls_each_round_and_a_saved_model_scores_the_same(spark, table):
    df, _, _ = table
    m = models.fit_pipeline(df.repartition(5), FEATS, "y", models.make_estimator("boosting", maxIter=12))
    loss = m.stages[-2].lossHistory
    assert len(loss) == 12 and all(b < a for a, b in zip(loss, loss[1:]))
    imp = dict(validate.importance_table(m, FEATS))
    assert abs(sum(imp.values()) - 1) < 1e-9 and imp["good"] == max(imp.values())
    p = probabilities(m, df)
    assert np.abs(p.sum(axis=1) - 1).max() < 1e-9 and (p >= 0).all()
    path = models.save_model(m, scratch_path(spark, "t-boost"))
    again, _ = models.load_model(path)
    assert (probabilities(again, df) == p).all()
    hits = models.score(again, df).where(F.col("y") == F.col(models.PRED_LABEL)).count()
    assert hits > 160


def test_odd_tables(spark, table):
    df, _, _ = table
    est = lambda **p: models.make_estimator("boosting", maxIter=3, **p)
    one = models.fit_pipeline(df.where("y = 'a'"), FEATS, "y", est())
    assert {r[models.PRED_LABEL] for r in models.score(one, df).collect()} == {"a"}
    gaps = df.withColumn("good", F.when(F.col("id") % 5 == 0, F.lit(float("nan"))).otherwise(F.col("good"))).withColumn("_scores0", F.lit(1))
    m = models.fit_pipeline(gaps, FEATS, "y", est(subsamplingRate=0.7, minInstancesPerNode=5, minSamplesSplit=20))
    assert models.score(m, gaps).where("prediction is null").count() == 0
    assert models.score(m, gaps.limit(0)).count() == 0 and "_scores0" in models.score(m, gaps).columns
    a, b = (models.fit_pipeline(gaps, FEATS, "y", est(subsamplingRate=0.5)).stages[-2].lossHistory for _ in range(2))
    assert a == b
    flat = df.withColumn("good", F.lit(1.0)).withColumn("fair", F.lit(2.0)).withColumn("noise", F.lit(0.0))
    assert models.score(models.fit_pipeline(flat, FEATS, "y", est()), flat).count() == 180
    with pytest.raises(ValueError, match="no rows"):
        boosting.SoftmaxBoosting(labelCol="l").fit(spark.createDataFrame([], "features array<double>, l double"))


def learners():
    return {"logreg": lambda: models.make_estimator("logreg", n_rows=180, maxIter=15),
            "boosting": lambda: models.make_estimator("boosting", maxIter=5),
            "forest": lambda: models.make_estimator("forest", numTrees=10, maxDepth=4),
            "one against rest": lambda: OneVsRest(labelCol=models.LABEL_IDX, featuresCol=models.FEATURES,
                                                  classifier=GBTClassifier(maxIter=2, maxDepth=2))}


@pytest.mark.parametrize("name", list(learners()))
def test_importances_of_any_learner(table, name):
    df, _, _ = table
    factory = learners()[name]
    wide = df.withColumn("noise", F.col("noise") / 1000)      # a small unit makes a large coefficient
    imp = dict(validate.importance_table(models.fit_pipeline(wide, FEATS, "y", factory()), FEATS, wide))
    assert min(imp, key=imp.get) == "noise" and max(imp, key=imp.get) == "good"
    if name in ("logreg", "boosting"):
        ranking, _ = validate.rfecv(wide, "id", "y", FEATS, factory, min_features=1, cv=2)
        rank = {r["feature"]: r["ranking"] for r in ranking.collect()}
        assert rank["noise"] == max(rank.values()) and rank["good"] == 1
    if name == "logreg":
        res = {r["method"]: r for r in validate.compare_selectors(wide, "id", "y", FEATS, factory, cv=2, min_features=1,
                                                                  n_repeats=2).collect()}
        assert res["importance_median"]["n_features"] == 2 and all(r["cv_f1"] > 0.7 for r in res.values())


def test_a_learner_without_importances_is_permuted(table):
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import SQLTransformer
    df, _, _ = table
    rule = SQLTransformer(statement=f"SELECT *, CASE WHEN good < 1 THEN 'a' WHEN good < 3 THEN 'b' ELSE 'c' END AS {models.PRED_LABEL} FROM __THIS__")
    same = SQLTransformer(statement="SELECT * FROM __THIS__")
    model = PipelineModel([same, same, rule])
    imp = dict(validate.importance_table(model, FEATS, df, "id", "y"))
    assert imp["good"] > 0.3 and imp["fair"] == imp["noise"] == 0
    with pytest.raises(ValueError, match="no importances"):
        validate.importance_table(model, FEATS)
    with pytest.raises(ValueError, match="no class probabilities"):
        models.class_probabilities(model, df, ["id"])
