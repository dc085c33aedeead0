import pytest
from pyspark.sql import functions as F

from flowguard.operators import models, resample
from flowguard.sources.files import scratch_path


def _score3(spark, n=200):
    import numpy as np
    rng = np.random.default_rng(0)
    rows = []
    for i in range(n):
        y = i % 3
        rows.append((i, *[float(v) for v in rng.normal(y, 1.0, 10)], str(y)))
    return spark.createDataFrame(rows, "id long, " + ", ".join(f"f{j} double" for j in range(10))
                                 + ", label string")


FEATS = [f"f{j}" for j in range(10)]


def test_roundtrip_and_probabilities(spark):
    df = _score3(spark)
    m = models.fit_pipeline(df, FEATS, "label", models.make_estimator("forest", numTrees=10,
                                                                      maxDepth=4))
    path = scratch_path(spark, "t-model")
    models.save_model(m, path, {"name": "rf", "accuracy": 0.9})
    m2, meta = models.load_model(path)
    assert meta["name"] == "rf" and "saved_at" in meta
    a = [r[0] for r in models.score(m, df).orderBy("id").select(models.PRED_LABEL).collect()]
    b = [r[0] for r in models.score(m2, df).orderBy("id").select(models.PRED_LABEL).collect()]
    assert a == b
    probs = models.class_probabilities(m2, models.score(m2, df), ["id"])
    sums = probs.groupBy("id").agg(F.sum("probability").alias("s")).collect()
    assert len(sums) == 200 and all(abs(r["s"] - 1) < 1e-9 for r in sums)
    assert models.model_classes(m2) == ["0", "1", "2"]


def test_missing_model(spark):
    with pytest.raises(FileNotFoundError):
        models.load_model("/tmp/flowguard-no-such-model-dir")


def test_population_scaler(spark):
    df = _score3(spark, 100)
    m = models.fit_pipeline(df, FEATS, "label", models.make_estimator("logreg", n_rows=100,
                                                                      maxIter=50), scale=True)
    from pyspark.ml.functions import vector_to_array
    arr = models.score(m, df).select(vector_to_array("features").alias("a"))
    stats = arr.select(F.avg(F.col("a")[0]).alias("m"), F.stddev_pop(F.col("a")[0]).alias("s")).first()
    assert abs(stats["m"]) < 1e-9 and abs(stats["s"] - 1) < 1e-9


def test_smote_counts_and_interpolation(spark):
    rows = [(i, float(i), float(i % 4), "A") for i in range(40)] + \
           [(100 + i, 50.0 + i, 3.0 * i, "B") for i in range(8)]
    df = spark.createDataFrame(rows, "id long, x double, y double, c string")
    out = resample.smote(df, "id", "c", ["x", "y"], k=5, seed=1)
    counts = {r["c"]: r["count"] for r in out.groupBy("c").count().collect()}
    assert counts == {"A": 40, "B": 40}
    synth = out.where("synthetic").collect()
    assert len(synth) == 32
    for r in synth:   # on a segment between two B points: inside their bounding box
        assert 50.0 <= r["x"] <= 57.0 and 0.0 <= r["y"] <= 21.0


def test_knn_matches_brute_force(spark):
    import numpy as np
    rng = np.random.default_rng(5)
    pts = rng.normal(0, 1, size=(60, 4))
    rows = [(i, *map(float, p), "A" if i < 40 else "B") for i, p in enumerate(pts)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, d double, k string")
    got = {(r["key"], r["nn_rank"]): r["nn_key"]
           for r in resample.knn_within_class(df, "id", "k", ["a", "b", "c", "d"], 5).collect()}
    for i in range(60):
        same = [j for j in range(60) if j != i and (j < 40) == (i < 40)]
        order = sorted(same, key=lambda j: (float(np.sqrt(((pts[i] - pts[j]) ** 2).sum())), j))
        assert [got[(i, r)] for r in range(1, 6)] == order[:5]
