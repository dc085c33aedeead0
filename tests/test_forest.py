import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.sql import functions as F

from flowguard.operators import forest, models
from flowguard.sources.files import scratch_path

FEATS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(0, 1, (3000, 3))
    y = np.where(x[:, 0] + 0.5 * x[:, 1] > 0.4, "p", np.where(x[:, 1] > 0, "q", "r"))
    return spark.createDataFrame([(i, *map(float, r), str(c)) for i, (r, c) in enumerate(zip(x, y))],
                                 "id long, a double, b double, c double, y string").cache()


def accuracy(m, df):
    return models.score(m, df).select(F.avg((F.col("y") == F.col(models.PRED_LABEL)).cast("int"))).first()[0]


def test_grown_tree_equals_plain_program():
    rng = np.random.default_rng(1)
    bins, y, w = rng.integers(0, 6, (2, 200)), rng.integers(0, 3, 200), rng.integers(1, 4, 200)
    feature, cut, child, share, _ = forest.grow(bins.astype("<u2"), y, w, 3, 6, 2, 4, 3, 0.0, [1])

    def check(node, rows, depth):
        sums = np.bincount(y[rows], w[rows], 3)
        assert np.allclose(share[node], sums / sums.sum())
        best = (1e-9, -1, -1)
        for f in range(2):
            for c in range(5):
                l, r = rows[bins[f, rows] <= c], rows[bins[f, rows] > c]
                if w[l].sum() < 3 or w[r].sum() < 3:
                    continue
                gini = lambda s: (np.bincount(y[s], w[s], 3) ** 2).sum() / w[s].sum()
                best = max(best, (gini(l) + gini(r) - gini(rows), f, c))
        if depth == 4 or best[1] < 0:
            assert feature[node] == -1
            return
        l = rows[bins[feature[node], rows] <= cut[node]]
        r = rows[bins[feature[node], rows] > cut[node]]
        gini = lambda s: (np.bincount(y[s], w[s], 3) ** 2).sum() / w[s].sum()
        assert abs(gini(l) + gini(r) - gini(rows) - best[0]) < 1e-9
        check(child[node], l, depth + 1)
        check(child[node] + 1, r, depth + 1)
    check(0, np.arange(200), 0)


@pytest.mark.parametrize("small", [250_000, 150])
def test_forest_learns_as_mllib_in_one_task_or_many(spark, rows, small, monkeypatch):
    """With a low bound the upper levels are cut by histograms of all tasks; either way the driver holds
    no tree of a node below the bound."""
    monkeypatch.setattr(forest, "SMALL_ROWS", small)
    monkeypatch.setattr(forest, "TASK_ROWS", 700)
    train, test = rows.where("id % 3 != 0"), rows.where("id % 3 = 0")
    m = models.fit_pipeline(train, FEATS, "y", models.make_estimator("forest", numTrees=20, maxDepth=8))
    plain = models.fit_pipeline(train, FEATS, "y", RandomForestClassifier(labelCol=models.LABEL_IDX, numTrees=20, maxDepth=8, seed=42))
    assert accuracy(m, test) > accuracy(plain, test) - 0.02 > 0.85
    imp, theirs = m.stages[-2].featureImportances.toArray(), plain.stages[-2].featureImportances.toArray()
    assert abs(imp.sum() - 1) < 1e-9 and np.abs(imp - theirs).max() < 0.1
    again = models.fit_pipeline(train, FEATS, "y", models.make_estimator("forest", numTrees=20, maxDepth=8))
    got = [[tuple(r["rawPrediction"]) for r in models.score(x, test).orderBy("id").select("rawPrediction").collect()] for x in (m, again)]
    assert got[0] == got[1]
    tops = sum(len(t["tree"][0]) for t in __import__("json").loads(m.stages[-2].getOrDefault("parts"))["tops"])
    assert tops == 20 if small > 3000 else 20 < tops < 20 * 60
    path = scratch_path(spark, "t-forest")
    models.save_model(m, path)
    back, _ = models.load_model(path)
    assert [tuple(r["rawPrediction"]) for r in models.score(back, test).orderBy("id").select("rawPrediction").collect()] == got[0]


def test_features_a_node():
    got = [forest.features_a_node(s, 10, 5) for s in ("auto", "all", "sqrt", "log2", "onethird", "0.3", "4", "40", 0.05)]
    assert got == [4, 10, 4, 4, 4, 3, 4, 10, 1] and forest.features_a_node("auto", 10, 1) == 10
    with pytest.raises(ValueError):
        forest.features_a_node("2.5", 10, 5)


def test_missing_values_constant_features_and_one_class(spark):
    df = spark.createDataFrame([(i, float("nan") if i % 2 else float(i), 1.0, "x" if i % 2 else "y") for i in range(60)], "id long, a double, b double, y string")
    m = models.fit_pipeline(df, ["a", "b"], "y", models.make_estimator("forest", numTrees=5, maxDepth=3, featureSubsetStrategy="all"))
    assert accuracy(m, df) == 1.0 and list(m.stages[-2].featureImportances) == [1.0, 0.0]
    one = models.fit_pipeline(df.where("y = 'x'"), ["b"], "y", models.make_estimator("forest", numTrees=3))
    assert accuracy(one, df.where("y = 'x'")) == 1.0
