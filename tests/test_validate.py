import numpy as np
import pytest
from pyspark.ml.feature import SQLTransformer

from flowguard.operators import models, split, validate

FEATS = [f"f{i}" for i in range(6)]


@pytest.fixture(scope="module")
def wide(spark):
    rng = np.random.default_rng(0)
    rows = []
    for i in range(240):
        y = i % 2
        x = rng.normal(0, 1, 6)
        x[0] += 3 * y
        x[1] -= 2 * y
        rows.append((i, i // 48, *map(float, x), "yes" if y else "no"))
    return spark.createDataFrame(rows, "id long, Day int, " + ", ".join(f"{f} double" for f in FEATS) + ", y string").cache()


def forest():
    return models.make_estimator("forest", numTrees=8, maxDepth=4, seed=1)


def test_cross_validation_is_seeded(spark, wide):
    runs = [validate.cross_validate(wide, "id", "y", FEATS, forest, k=3, seed=42) for _ in range(2)]
    a, b = [sorted(map(tuple, r[0].collect())) for r in runs]
    assert a == b and len(a) == 3 and sum(r[1] for r in a) == 240
    summary = {r["metric"]: r for r in runs[0][1].collect()}
    assert summary["accuracy"]["mean"] > 0.85 and summary["accuracy"]["n_folds"] == 3


def test_walk_forward(spark, wide):
    steps, summary = validate.walk_forward_scores(wide, "Day", "y", FEATS, forest, 2)
    rows = sorted(steps.collect(), key=lambda r: r["step"])
    assert [(r["test_day"], r["train_size"], r["test_size"]) for r in rows] == [(2, 96, 48), (3, 144, 48), (4, 192, 48)]
    assert abs(summary.first()["mean"] - np.mean([r["score"] for r in rows])) < 1e-9
    assert validate.walk_forward_scores(wide.where("Day < 2"), "Day", "y", FEATS, forest, 2)[1].first()["n_steps"] == 0
    with pytest.raises(ValueError):
        validate.walk_forward_scores(wide, "nope", "y", FEATS, forest)


def test_importance_and_rfecv(spark, wide):
    sel = {r["feature"]: r["selected"] for r in validate.select_by_importance(wide, "y", FEATS, 20, 5).collect()}
    assert sel["f0"] and sum(sel.values()) == 3
    ranking, scores = validate.rfecv(wide, "id", "y", FEATS, forest, min_features=4, cv=2, scoring="accuracy")
    rank = {r["feature"]: r["ranking"] for r in ranking.collect()}
    assert rank["f0"] == 1 and min(rank.values()) == 1
    assert {r["n_features"] for r in scores.collect()} == {4, 5, 6}
    with pytest.raises(ValueError):
        validate.rfecv(wide, "id", "y", FEATS, forest, scoring="roc")


def test_permutation_importance_equals_brute_force(spark, wide):
    rule = SQLTransformer(statement=f"SELECT *, CASE WHEN f0 > 1.5 THEN 'yes' ELSE 'no' END AS {models.PRED_LABEL} FROM __THIS__")
    from pyspark.ml import PipelineModel
    got = {r["feature"]: r for r in validate.permutation_importance(
        PipelineModel([rule, rule]), wide, "id", "y", FEATS, n_repeats=4, seed=9).collect()}
    rows = sorted(wide.collect(), key=lambda r: r["id"])
    truth = np.array([r["y"] == "yes" for r in rows])
    f0 = np.array([r["f0"] for r in rows])
    base = np.mean((f0 > 1.5) == truth)
    drops = []
    for r in range(4):
        order = validate.permuted_positions(np.arange(240), 240, validate.position_keys(9, "f0", r))
        assert sorted(order) == list(range(240))
        drops.append(base - np.mean((f0[order] > 1.5) == truth))
    assert abs(got["f0"]["importance_mean"] - np.mean(drops)) < 1e-9
    assert abs(got["f0"]["importance_std"] - np.std(drops)) < 1e-9 and got["f0"]["rank"] == 1
    assert all(got[f]["importance_mean"] == 0 and not got[f]["selected"] for f in FEATS[1:])


def test_positions_are_permuted_at_random():
    keys = validate.position_keys(42, "f", 0)
    for n in (0, 1, 2, 3, 7, 10, 100, 101, 5000):
        assert sorted(validate.permuted_positions(np.arange(n), n, keys)) == list(range(n))
    n = 4000
    # a value that grows with the position, and one with a period, are shuffled: no correlation
    # with the value before, and neighbours do not stay at one distance
    corr, steps = [], set()
    for r in range(20):
        to = validate.permuted_positions(np.arange(n), n, validate.position_keys(1, "f", r))
        corr.append(np.corrcoef(np.arange(n), to)[0, 1])
        wave = np.sin(np.arange(n) / 50)
        corr.append(np.corrcoef(wave, wave[to])[0, 1])
        steps.add(len(set(np.diff(to).tolist())))
    assert max(map(abs, corr)) < 0.08 and abs(np.mean(corr)) < 0.02 and min(steps) > 1500
    # places are hit evenly: the mean of where one position goes is the middle
    first = [int(validate.permuted_positions(np.array([0]), n, validate.position_keys(2, "g", r))[0]) for r in range(300)]
    assert abs(np.mean(first) - n / 2) < n / 8 and len(set(first)) > 250


def test_compare_reports_no_features(spark, wide, monkeypatch):
    monkeypatch.setattr(validate, "permutation_importance", lambda *a, **k: spark.createDataFrame(
        [("f0", False)], "feature string, selected boolean"))
    res = {r["method"]: r for r in validate.compare_selectors(wide, "id", "y", FEATS, forest, cv=2, min_features=5).collect()}
    assert (res["permutation"]["n_features"], res["permutation"]["cv_f1"]) == (0, None)
    assert res["importance_median"]["n_features"] == 3 and 0 <= res["rfecv"]["cv_f1"] <= 1


def test_random_search_forest_boosting_and_callable(spark, wide):
    space = {"n_estimators": [2, 4], "max_depth": [2, 3]}
    for kind in ("forest", "boosting", lambda n_estimators, max_depth: models.make_estimator(
            "forest", numTrees=n_estimators, maxDepth=max_depth)):
        res, best = validate.random_search(wide, "id", "y", FEATS, kind, space, n_iter=2, cv=2, scoring="accuracy")
        rows = res.collect()
        assert sorted(r["rank"] for r in rows) == [1, 2] and all(0 <= r["mean_val"] <= 1 for r in rows)
        assert models.score(best, wide).count() == 240
    assert validate.draw_settings(validate.BOOSTING_SPACE, 5, 1) == validate.draw_settings(validate.BOOSTING_SPACE, 5, 1)
    assert len(validate.draw_settings(space, 20)) == 4


def test_split_refuses_null_labels_and_moves_no_rows_for_quotas(spark, wide):
    from pyspark.sql import functions as F
    with pytest.raises(ValueError):
        split.stratified_split(wide.withColumn("y", F.when(F.col("id") > 5, F.col("y"))), "y", "id")
    with pytest.raises(ValueError):
        split.permute_column(wide.withColumn("id", F.lit(1)), "id", "f0")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = split.stratified_split(wide, "y", "id")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    # rows meet the quotas and the offsets by broadcast; what is exchanged on the label
    # are the (block, class) totals
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") >= 2


def test_random_search_query_runs_the_whole_search(spark, tmp_path, monkeypatch):
    """The registered query tries as many settings and folds as the operator does by default; only its trees are
    made small here."""
    import duckdb
    import __spark_entry__ as ent
    rows = [(i, "a B 1\n" * (1 + i % 7), 6 * (1 + i % 7)) for i in range(60)]
    spark.createDataFrame(rows, "doc_id long, text string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, int(i % 7 > 2)) for i in range(60)], "doc_id long, quality long").write.parquet(str(tmp_path / "labels.parquet"))
    plain, made = models.make_estimator, []

    def small(kind, **p):
        made.append(p)
        return plain(kind, **{**p, "numTrees": 1, "maxDepth": 2})
    monkeypatch.setattr(models, "make_estimator", small)
    got = ent.queries()["random_search"](spark, str(tmp_path)).orderBy("setting_id")
    want = duckdb.sql(ent.oracle_sql()["random_search"]).fetchall()
    assert [tuple(r) for r in got.collect()] == sorted(want) and len(want) == 20
    drawn = validate.draw_settings(validate.FOREST_SPACE, 20, 42)
    assert len({str(d) for d in drawn}) == 20 and all(validate.spark_params("forest", d) in made for d in drawn)


@pytest.mark.parametrize("small", [250_000, 60])
def test_forests_of_a_search_score_as_single_fits(spark, wide, small, monkeypatch):
    """Forests that share the rows of a fold have the scores of a forest fitted and scored by itself, grown together or
    (above the bound) each by itself; a class the fitted rows lack counts as missed."""
    from pyspark.sql import functions as F
    from flowguard.operators import forest as trees
    from flowguard.operators import metrics
    monkeypatch.setattr(trees, "SMALL_ROWS", small)
    rare = wide.withColumn("y", F.when(F.col("id") == 7, "rare").otherwise(F.col("y")))
    space = {"n_estimators": [3, 5], "max_depth": [2, 4], "min_samples_leaf": [1, 3]}
    res, best = validate.random_search(rare, "id", "y", FEATS, "forest", space, n_iter=2, cv=2, scoring="accuracy")
    got = {r["setting_id"]: r for r in res.collect()}
    folded = split.stratified_folds(rare, "y", "id", 2, 42).cache()
    for sid, setting in enumerate(validate.draw_settings(space, 2, 42)):
        scores = {"val": [], "train": []}
        for i in range(2):
            tr, te = folded.where(F.col("fold") != i), folded.where(F.col("fold") == i)
            m = models.fit_pipeline(tr, FEATS, "y", models.make_estimator("forest", **validate.spark_params("forest", setting)))
            for side, rows in (("val", te), ("train", tr)):
                scores[side].append(metrics.macro_metrics(models.score(m, rows, "y"), "y", models.PRED_LABEL).first()["accuracy"])
        assert abs(got[sid]["mean_val"] - np.mean(scores["val"])) < 1e-12
        assert abs(got[sid]["mean_train"] - np.mean(scores["train"])) < 1e-12
    assert models.score(best, rare).count() == 240
