import numpy as np
import pytest
from pyspark.sql import functions as F

from flowguard.operators import drift, jobs, metrics, models, profile, scale
from flowguard.sources import files
from flowguard.streaming.drift_stream import read_reports, start_drift_stream

FEATS = ["a", "b"]


@pytest.fixture(scope="module")
def labelled(spark):
    rng = np.random.default_rng(2)
    rows = [(i, float(rng.normal(i % 3, 0.5)), float(rng.normal()), str(i % 3)) for i in range(150)]
    return spark.createDataFrame(rows, "id long, a double, b double, y string").cache()


@pytest.fixture(scope="module")
def model_path(spark, labelled):
    m = models.fit_pipeline(labelled, FEATS, "y", models.make_estimator("forest", numTrees=5, maxDepth=3))
    return models.save_model(m, files.scratch_path(spark, "t-m"), {"name": "f"})


def test_score_job(spark, labelled, model_path):
    src, out = files.scratch_path(spark, "t-in"), files.scratch_path(spark, "t-out")
    files.write_csv(labelled.drop("y"), src)
    scored, summary = jobs.score_job(spark, model_path, src, out, schema=labelled.drop("y").schema, features=FEATS)
    assert scored.columns == ["id", "a", "b", "prediction"] and scored.count() == 150
    assert summary.agg(F.sum("count")).first()[0] == 150
    assert files.load_csv_files(spark, out, schema=scored.schema, keep_source=False).count() == 150
    with pytest.raises(FileNotFoundError):
        jobs.score_job(spark, model_path, src + "-no", out)
    with pytest.raises(FileNotFoundError):
        jobs.score_job(spark, model_path + "-no", src, out)
    model, _ = models.load_model(model_path)
    with pytest.raises(TypeError):
        jobs.score_frame(model, [[1, 2]])
    with pytest.raises(ValueError):
        jobs.score_frame(model, labelled.drop("a"), FEATS)


def test_prepare_bundle(spark, labelled):
    path = files.scratch_path(spark, "t-bundle")
    data, fitted = jobs.prepare_bundle(labelled, "id", "y", FEATS, path, n_trees=5, max_depth=3)
    again, pipe = jobs.load_bundle(spark, path)
    assert again.count() == data.count() == 150 and len(pipe.stages) == len(fitted.stages) == 2
    train = again.where("split = 'train'")
    s = train.agg(F.avg("a").alias("m"), F.stddev_pop("a").alias("s")).first()
    assert abs(s["m"]) < 1e-9 and abs(s["s"] - 1) < 1e-9


def test_evaluation_runs_the_model_once(spark, labelled, model_path):
    model, _ = models.load_model(model_path)
    calls = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def same(x):
        calls.add(1)
        return x
    scored = models.score(model, labelled, "y").withColumn("p", same(models.PRED_LABEL))
    out = {(r["section"], r["row"], r["col"]): r["value"] for r in metrics.evaluate(scored, "y", "p").collect()}
    assert calls.value == 150
    rows = models.score(model, labelled, "y").select("y", models.PRED_LABEL).collect()
    assert out["macro", "all", "accuracy"] == sum(a == b for a, b in rows) / 150
    assert sum(v for (s, _, _), v in out.items() if s == "matrix") == 150
    ev = metrics.MacroEvaluator("y", "p", "accuracy")
    assert abs(ev.evaluate(scored) - out["macro", "all", "accuracy"]) < 1e-12


def test_null_and_nan_rules(spark):
    df = spark.createDataFrame([(1, 1.0, None), (2, float("nan"), None), (3, None, None)], "id long, x double, z double")
    info = {r["column"]: (r["non_null"], r["nulls"]) for r in profile.column_profile(df).collect()}
    assert info == {"id": (3, 0), "x": (1, 2), "z": (0, 3)}
    d = {r["column"]: r["count"] for r in profile.describe_numeric(df, ["x", "z"]).collect()}
    assert d == {"x": 1, "z": 0}
    from flowguard.operators.clean import downcast_plan
    big = spark.createDataFrame([(2 ** 62 + 1, 1.5), (0, float("nan"))], "n long, f double")
    assert {r["column"]: r["out_type"] for r in downcast_plan(big).collect()} == {"n": "bigint", "f": "float"}
    ks = {r["feature"]: r for r in drift.ks_drift(df, df, ["x", "z"]).collect()}
    assert (ks["z"]["n_ref"], ks["z"]["statistic"], ks["z"]["is_drifted"]) == (0, None, False)
    y = spark.createDataFrame([("a",)] * 8 + [(None,)] * 4, "y string")
    r = drift.chi2_drift(y, y, "y").first()
    assert r["statistic"] == 0 and not r["has_drift"] and r["n_classes"] == 2


def test_wide_correlation_equals_pairs(spark, monkeypatch):
    rng = np.random.default_rng(4)
    x = rng.normal(0, 1, (80, 4)) + [1e6, 0, 5, -3]
    x[:, 2] += x[:, 1]
    rows = [tuple(None if rng.random() < 0.1 else float(v) for v in r) for r in x]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    pairs = {tuple(r)[:2]: r["corr"] for r in profile.value_corr(df, list("abcd")).collect()}
    monkeypatch.setattr(profile, "WIDE_COLUMNS", 2)
    gram = {tuple(r)[:2]: r["corr"] for r in profile.value_corr(df, list("abcd")).collect()}
    import pandas as pd
    want = pd.DataFrame(rows, columns=list("abcd"), dtype=float).corr()
    assert set(pairs) == set(gram)
    assert all(abs(v - want.loc[k[0], k[1]]) < 1e-9 for k, v in gram.items())
    with pytest.raises(ValueError):
        profile.factorize(spark.createDataFrame([(1, "x"), (1, "y")], "k long, v string"), "k", ["v"])


def test_scaling_uses_train_only(spark, labelled):
    a, b, _ = scale.scale_features(labelled.where("id < 100"), labelled.where("id >= 100"), FEATS)
    s = a.agg(F.avg("a").alias("m"), F.stddev_pop("a").alias("s")).first()
    assert abs(s["m"]) < 1e-9 and abs(s["s"] - 1) < 1e-9 and b.count() == 50


def test_monitor_goes_on_after_a_restart(spark, labelled):
    path = files.scratch_path(spark, "t-hist")
    for want in (1, 2):
        mon = drift.DriftMonitor(labelled, FEATS, "y", history_path=path)
        assert mon.check(labelled).first()["batch_number"] == want
    mon.check(labelled, batch_id=2)
    got = spark.read.parquet(path)
    assert sorted(r["batch_number"] for r in got.collect()) == [1, 2]
    assert not any(r["needs_retraining"] for r in got.collect())


def test_stream_reports_and_replay(spark, labelled):
    src = files.scratch_path(spark, "t-stream")
    cur = labelled.withColumn("day", F.lit(1)).unionByName(
        labelled.withColumn("a", F.col("a") + 10).withColumn("y", F.lit("0")).withColumn("day", F.lit(2)))
    cur.coalesce(1).write.parquet(src)
    out = files.scratch_path(spark, "t-rep")
    for _ in range(2):      # a second start without its checkpoint replays the micro-batch
        stream = spark.readStream.schema(cur.schema).parquet(src)
        start_drift_stream(stream, labelled, FEATS, "day", out, files.scratch_path(spark, "t-ck"),
                           label_col="y").awaitTermination()
    feats = {(r["day"], r["feature"]): r["is_drifted"] for r in read_reports(spark, out).collect()}
    assert feats == {(1, "a"): False, (1, "b"): False, (2, "a"): True, (2, "b"): False}
    assert read_reports(spark, out).count() == 4
    days = {r["day"]: (r["data_drift"], r["prediction_drift"], r["needs_retraining"])
            for r in read_reports(spark, out, "batches").collect()}
    assert days == {1: (False, False, False), 2: (True, True, True)}


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 0, 1)])
def test_a_day_over_three_micro_batches(spark, order):
    """Parts of both days in every file: the last report of a day equals the batch check of the
    whole day, whatever the order; earlier ones do not stand."""
    ref = spark.range(100).selectExpr("CAST(id AS DOUBLE) AS x", "CAST(id % 3 AS STRING) AS y")
    cur = ref.selectExpr("x", "y", "1 AS day", "CAST(x / 34 AS INT) AS part").unionByName(
        ref.selectExpr("x + 60 AS x", "'0' AS y", "2 AS day", "CAST(x / 34 AS INT) AS part")).unionByName(
        spark.createDataFrame([(1.0, "0", None, 1)], "x double, y string, day int, part int"))
    src, out, ck = (files.scratch_path(spark, f"t-parts{i}") for i in range(3))
    for p in order:
        cur.where(f"part = {p}").drop("part").coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(cur.drop("part").schema).parquet(src)
        start_drift_stream(stream, ref, ["x"], "day", out, ck, label_col="y", compact_every=2).awaitTermination()
    got = read_reports(spark, out, batch_col="day")
    want = drift.ks_drift(ref, cur, ["x"], batch_col="day")
    assert sorted(map(tuple, got.select(want.columns).collect())) == sorted(map(tuple, want.collect()))
    assert read_reports(spark, out).count() == 6
    batches = {r["day"]: r for r in read_reports(spark, out, "batches", "day").collect()}
    chi = {r["day"]: r for r in drift.chi2_drift(ref, cur.where("day is not null"), "y", "day").collect()}
    assert {d: (r["data_drift"], r["needs_retraining"]) for d, r in batches.items()} == {1: (False, False), 2: (True, True)}
    assert all(abs(batches[d]["chi2_statistic"] - chi[d]["statistic"]) < 1e-9 for d in (1, 2))


def test_count_state_replays_and_compacts(spark):
    from flowguard.streaming.drift_stream import CountState
    path = files.scratch_path(spark, "t-state")
    state = CountState(spark, path, "day", ["label"], "n", compact_every=2)

    def add(epoch, rows):
        df = spark.createDataFrame(rows, "day int, label string, n long")
        return sorted(map(tuple, state.add(epoch, df, df.select("day").distinct()).collect()))
    assert add(0, [(1, "a", 2), (2, None, 5)]) == [(1, "a", 2), (2, None, 5)]
    assert add(1, [(1, "a", 1), (1, "b", 1)]) == [(1, "a", 3), (1, "b", 1)]
    assert add(2, [(2, None, 1)]) == [(2, None, 6)]
    assert add(1, [(1, "a", 1), (1, "b", 1)]) == [(1, "a", 3), (1, "b", 1)]      # replayed after epoch 2
    assert add(3, [(1, "b", 4)]) == [(1, "a", 3), (1, "b", 5)]
    assert state._folders("upto") == [1, 3]


def test_density_error_is_below_a_thousandth_of_the_peak(spark):
    """Against the exact sum over all rows."""
    rng = np.random.default_rng(8)
    values = np.concatenate([10 ** rng.normal(0, 0.3, 700), 10 ** rng.normal(2, 0.1, 300)])
    df = spark.createDataFrame([(float(v), 5.0) for v in values] + [(-1.0, 5.0), (None, 5.0)], "x double, one double")
    got = profile.binned_kde(df, ["x", "one"]).collect()
    lv = np.log10(values)
    bw = lv.std(ddof=1) * len(lv) ** -0.2
    rows = sorted((r["x"], r["density"]) for r in got if r["feature"] == "x")
    exact = [np.exp(-0.5 * ((x - lv) / bw) ** 2).sum() / (len(lv) * bw * np.sqrt(2 * np.pi)) for x, _ in rows]
    assert len(rows) == 100 and max(abs(d - e) for (_, d), e in zip(rows, exact)) < 1e-3 * max(exact)
    assert all(r["density"] is None for r in got if r["feature"] == "one")


def test_factorize_with_one_value_on_half_of_the_rows(spark):
    """The common value's rows meet its code in several parts; codes are those of the plain join."""
    rows = [(i, "common" if i % 2 else (None if i % 10 == 0 else f"v{i % 37}")) for i in range(1000)]
    df = spark.createDataFrame(rows, "k long, v string")
    plain = {r["k"]: r["v"] for r in profile.factorize(df, "k", ["v"]).collect()}
    dealt = {r["k"]: r["v"] for r in profile.factorize(df, "k", ["v"], hot_rows=50).collect()}
    seen, want = {}, {}
    for k, v in rows:
        want[k] = -1 if v is None else seen.setdefault(v, len(seen))
    assert plain == dealt == want
    from flowguard.plans.joins import uneven_join
    left = df.withColumnRenamed("v", "key").repartition(3)
    right = spark.createDataFrame([("common", 1), ("v1", 2), ("none", 3)], "key string, code int")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        out = uneven_join(left, right, ["key"], "left", hot_rows=50)
        per_task = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        assert out.count() == 1000 and max(per_task) < 200        # the common value alone has 500 rows
        assert uneven_join(left, right, ["key"], hot_rows=50).count() == left.join(right, "key").count()
    finally:
        for name in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold"):
            spark.conf.unset(name)
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    with pytest.raises(ValueError):
        uneven_join(left, right, ["key"], "right")


def test_clustered_write_bounds_files(spark):
    df = spark.range(2000).selectExpr("id", "CAST(IF(id < 1500, 1, id % 4) AS INT) AS day", "CAST(IF(id = 3, NULL, id) AS STRING) AS s").repartition(7)
    path = files.write_parquet(df, files.scratch_path(spark, "t-clu"), ["day"], file_rows=100)
    back = spark.read.parquet(path)
    per = {r["day"]: (r["n"], r["f"]) for r in back.groupBy("day").agg(
        F.count("id").alias("n"), F.countDistinct(F.col("_metadata.file_path")).alias("f")).collect()}
    want = {r["day"]: r["count"] for r in df.groupBy("day").count().collect()}
    assert {d: n for d, (n, _) in per.items()} == want and back.count() == 2000
    assert all(f <= -(-n // 100) for n, f in per.values()) and per[1][1] > 5
    files.write_parquet(df, path, file_rows=500)
    assert spark.read.parquet(path).select(F.col("_metadata.file_path")).distinct().count() <= 4
    files.write_parquet(df.limit(0), path, ["day"], file_rows=500)


def test_score_stream_replays(spark, labelled, model_path):
    from flowguard.streaming.score_stream import running_summary, scored_rows, start_score_job
    src, out = files.scratch_path(spark, "t-ss"), files.scratch_path(spark, "t-so")
    rows = labelled.drop("y")
    rows.repartition(4).write.parquet(src)
    for _ in range(2):      # a start without its checkpoint replays every micro-batch
        stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2).parquet(src)
        start_score_job(stream, model_path, out, files.scratch_path(spark, "t-sc"), FEATS).awaitTermination()
    batch, summary = jobs.score_job(spark, model_path, rows, files.scratch_path(spark, "t-sb"), features=FEATS)
    got = scored_rows(spark, out, batch.schema)
    assert sorted(map(tuple, got.select("id", "prediction").collect())) == sorted(map(tuple, batch.select("id", "prediction").collect()))
    assert sorted(map(tuple, running_summary(spark, out).collect())) == sorted(map(tuple, summary.collect()))
    with pytest.raises(ValueError):
        start_score_job(stream.drop("a"), model_path, out, out + "-c", FEATS)
    with pytest.raises(FileNotFoundError):
        start_score_job(stream, model_path + "-no", out, out + "-c", FEATS)
