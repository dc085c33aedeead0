"""Steps whose cost must not grow faster than the rows."""
import numpy as np
from pyspark.sql import functions as F

from flowguard.operators import boosting, models, resample, validate
from flowguard.sources import files


def test_positions_map_back():
    for n in (1, 2, 7, 100, 5000):
        keys = validate.position_keys(3, "f", 1)
        to = validate.permuted_positions(np.arange(n), n, keys)
        assert validate.permuted_positions(to, n, keys, inverse=True).tolist() == list(range(n))


def test_permutation_joins_rows_without_broadcast(spark, monkeypatch):
    """A table of rows is never collected for a join, however small it looks."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import SQLTransformer
    rule = SQLTransformer(statement=f"SELECT *, IF(a > 50, 'y', 'n') AS {models.PRED_LABEL} FROM __THIS__")
    plans = []
    plain = validate.checkpointed

    def seen(df):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString() + df._jdf.queryExecution().sparkPlan().toString())
        return plain(df)
    monkeypatch.setattr(validate, "checkpointed", seen)
    df = spark.range(200).select("id", F.col("id").cast("double").alias("a"), F.when(F.col("id") > 50, "y").otherwise("n").alias("c"))
    got = validate.permutation_importance(PipelineModel([rule, rule]), df, "id", "c", ["a"], n_repeats=2).collect()
    assert got[0]["importance_mean"] > 0.2
    scored = [p for p in plans if "_new" in p or "new#" in p]
    assert scored and all("SortMergeJoin [_pos" in p for p in scored)


def test_boosting_tasks_follow_the_rows(spark, monkeypatch):
    """Tasks of a round do not follow the number of shuffle partitions."""
    df = spark.range(3000).selectExpr("CAST(id % 17 AS DOUBLE) AS a", "IF(id % 17 > 8, 'x', 'y') AS c")
    made = []
    plain = boosting.checkpointed

    def seen(d):
        out = plain(d)
        made.append(out.rdd.getNumPartitions())
        return out
    monkeypatch.setattr(boosting, "checkpointed", seen)
    spark.conf.set("spark.sql.shuffle.partitions", "50")
    try:
        models.fit_pipeline(df, ["a"], "c", models.make_estimator("boosting", maxIter=1))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert made[0] <= spark.sparkContext.defaultParallelism


def test_files_grow_without_tasks(spark, monkeypatch):
    """Files of exactly ``file_rows`` rows, many a task."""
    monkeypatch.setattr(files, "TASK_ROWS", 1000)
    df = spark.range(5000).selectExpr("id", "CAST(id % 3 AS INT) AS day")
    path = files.write_parquet(df, files.scratch_path(spark, "t-grow"), ["day"], file_rows=20)
    per = spark.read.parquet(path).groupBy("day", F.col("_metadata.file_name").alias("f")).count().collect()
    assert max(r["count"] for r in per) == 20 and len(per) == 84 + 84 + 84
    assert len({r["f"].split("-")[1] for r in per}) <= 6


def test_nearest_is_exact_where_products_cancel():
    rng = np.random.default_rng(2)
    y = np.concatenate([rng.normal(0, 1e-4, (60, 3)) + 1e7, np.repeat(rng.normal(0, 1, (2, 3)), 20, axis=0)])
    x = y[::3] + 0.0
    i, j, d = resample._nearest(x, np.arange(100)[::3], y, np.arange(100), 4)
    for r in range(len(x)):
        far = np.sqrt(((x[r] - y) ** 2).sum(axis=1))
        far[3 * r] = np.inf
        want = sorted(range(100), key=lambda c: (far[c], c))[:4]
        mine = sorted((b, a) for a, b in zip(j[i == r], d[i == r]))[:4]
        assert [c for _, c in mine] == want and np.allclose([v for v, _ in mine], far[want], rtol=0, atol=0)


def test_rows_with_missing_values_have_no_neighbours_and_hide_none():
    y = np.array([[0.0, 0], [1, 0], [np.nan, 0], [3, 0], [np.inf, 0]])
    i, j, d = resample._nearest(y, np.arange(5), y, np.arange(5), 2)
    assert list(zip(i.tolist(), j.tolist())) == [(0, 1), (0, 3), (1, 0), (1, 3), (3, 1), (3, 0)] and d.tolist() == [1, 3, 1, 2, 2, 3]
