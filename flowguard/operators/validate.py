"""Driver loops whose every fit and score is a distributed Spark job: k-fold
cross-validation, walk-forward by day, importance selection, recursive feature
elimination, permutation importance, method comparison and random search.

The loop itself stays on the driver (a few fits, 2-4 at a time from a thread
pool); the data never does. A scored side is reduced to its count table
(``metrics.cells``) at once, so a model runs once per side; every score of the loop
comes from the union of those small tables.
"""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

import pandas as pd
from pyspark import StorageLevel
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowguard.functions.columns import q
from flowguard.operators import forest, metrics, models, split
from flowguard.plans.prefix import row_number
from flowguard.session import checkpointed

EstimatorFactory = Callable[[], object]
SCORE_COLS = ["accuracy", "precision_macro", "recall_macro", "f1_macro"]


def _union(dfs: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), dfs)


def _pmap(fn, items, workers: int = 3):
    with ThreadPoolExecutor(max_workers=max(1, min(workers, len(items)))) as ex:
        return list(ex.map(fn, items))


def _fit(train, features, label_col, factory, scale=False):
    return models.fit_pipeline(train, features, label_col, factory(), scale)


def _counts(model, df, label_col, **tags) -> DataFrame:
    """Count table of a scored side: tags..., label, prediction, count."""
    c = metrics.cells(models.score(model, df, label_col), label_col, models.PRED_LABEL)
    for name, value in tags.items():
        c = c.withColumn(name, F.lit(value))
    return c


def check_scoring(scoring: str) -> str:
    if scoring not in SCORE_COLS:
        raise ValueError(f"unknown scoring {scoring!r}; one of {SCORE_COLS}")
    return scoring


def _score_of(counts: DataFrame, scoring: str) -> float:
    row = metrics.macro_metrics(None, counts=counts).first()
    return float(row[scoring]) if row is not None and row[scoring] is not None else 0.0


# ------------------------------------------------------------ V5 cross-validation

def cross_validate(df: DataFrame, key_col: str, label_col: str, features: Sequence[str],
                   factory: EstimatorFactory, k: int = 5, seed: int = 42,
                   folded: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(per-fold scores, summary): fold, n, accuracy, precision_macro,
    recall_macro, f1_macro; then metric, mean, std (population), n_folds.
    Same seed, same folds, same numbers."""
    own = folded is None
    if own:
        folded = split.stratified_folds(df, label_col, key_col, k, seed).persist(StorageLevel.MEMORY_AND_DISK)

    def one(i):
        m = _fit(folded.where(F.col("fold") != i), features, label_col, factory)
        return _counts(m, folded.where(F.col("fold") == i), label_col, fold=i)

    counts = _union(_pmap(one, list(range(k))))
    if own:
        folded.unpersist()
    per_fold = metrics.macro_metrics(None, by=["fold"], counts=counts)
    return per_fold, metrics.fold_summary(per_fold, SCORE_COLS)


# ------------------------------------------------------------ V4 walk-forward

def walk_forward_scores(df: DataFrame, day_col: str, label_col: str, features: Sequence[str],
                        factory: EstimatorFactory, min_train_days: int = 2,
                        scoring: str = "f1_macro") -> tuple[DataFrame, DataFrame]:
    """(steps, summary). Step i trains on the i sorted days before day i and
    scores that day; ``scoring`` 'f1_macro', anything else accuracy. Summary:
    mean and population std of the step scores (0 if no step). The days are the steps
    of the loop, one fit each, so their list is on the driver."""
    for c in (day_col, label_col):
        if c not in df.columns:
            raise ValueError(f"column {c!r} not found")
    days = [r[0] for r in df.where(q(day_col).isNotNull()).select(q(day_col)).distinct().orderBy(q(day_col)).collect()]
    steps = list(range(min_train_days, len(days)))
    metric = "f1_macro" if scoring == "f1_macro" else "accuracy"
    spark = df.sparkSession
    if not steps:
        empty = spark.createDataFrame([], "step int, test_day long, train_size long, "
                                          "test_size long, score double")
        return empty, spark.createDataFrame([(0.0, 0.0, 0)], "mean double, std double, n_steps int")
    data = df.persist(StorageLevel.MEMORY_AND_DISK)

    def one(i):
        m = _fit(data.where(q(day_col) < days[i]), features, label_col, factory)
        return _counts(m, data.where(q(day_col) == days[i]), label_col, step=i - min_train_days + 1)

    counts = _union(_pmap(one, steps))
    per = metrics.macro_metrics(None, by=["step"], counts=counts)
    folds = checkpointed(split.walk_forward_folds(data.where(q(day_col).isNotNull()), day_col, min_train_days).select(
        "step", "test_day", "train_size", "test_size"))
    data.unpersist()
    out = folds.join(per.select("step", F.col(metric).alias("score")), "step")
    summary = out.agg(F.avg("score").alias("mean"), F.stddev_pop("score").alias("std"),
                      F.count(F.lit(1)).alias("n_steps"))
    return out, summary


# ------------------------------------------------------------ F1 importance selection

def _spread(model, features: Sequence[str], train: DataFrame | None) -> list[float]:
    """Population std of every feature as the learner saw it: 1 behind the pipeline's scaler, and
    where no table is given."""
    if train is None or any(isinstance(s, models.PopulationScalerModel) for s in model.stages):
        return [1.0] * len(features)
    row = train.agg(*[F.stddev_pop(q(f)).alias(f"s{i}") for i, f in enumerate(features)]).first()
    return [float(v or 0.0) for v in row]


def _learner_importances(learner, spread: Sequence[float]) -> list[float] | None:
    """One number a feature: the learner's own importances; of a linear one the norm over classes
    of its coefficients, each for a step of one std; of a one-against-rest learner the
    mean of its members' shares. None if it has none of these."""
    if hasattr(learner, "models"):
        members = [_learner_importances(m, spread) for m in learner.models]
        if not members or any(m is None for m in members):
            return None
        shares = [[v / (sum(m) or 1.0) for v in m] for m in members]
        return [sum(col) / len(shares) for col in zip(*shares)]
    if hasattr(learner, "featureImportances"):
        return [float(x) for x in learner.featureImportances.toArray()]
    if hasattr(learner, "coefficientMatrix"):
        rows = learner.coefficientMatrix.toArray()
    elif hasattr(learner, "coefficients"):
        rows = [learner.coefficients.toArray()]
    else:
        return None
    return [float(sum((r[i] * s) ** 2 for r in rows) ** 0.5) for i, s in enumerate(spread)]


def importance_table(model, features: Sequence[str], train: DataFrame | None = None, key_col: str | None = None,
                     label_col: str | None = None, n_repeats: int = 5, seed: int = 42) -> list[tuple[str, float]]:
    """(feature, importance) of any fitted pipeline, one number per feature.

    ``train`` gives linear learners the features' spread (without it their coefficients are taken
    as they are). A learner with neither importances nor coefficients gets permutation
    importances on ``train``, for which ``key_col`` and ``label_col`` are needed.
    """
    learner = model.stages[-2]
    linear = not hasattr(learner, "featureImportances")
    imp = _learner_importances(learner, _spread(model, features, train if linear else None))
    if imp is None:
        if train is None or key_col is None or label_col is None:
            raise ValueError(f"{type(learner).__name__} has no importances; give the table, key and label to permute")
        rows = permutation_importance(model, train, key_col, label_col, features, n_repeats, seed).collect()
        found = {r["feature"]: float(r["importance_mean"]) for r in rows}
        imp = [found[f] for f in features]
    return list(zip(features, imp))


def select_by_importance(train: DataFrame, label_col: str, features: Sequence[str],
                         n_trees: int = 100, max_depth: int = 15, seed: int = 42,
                         threshold: str | float = "median", factory: EstimatorFactory | None = None,
                         key_col: str | None = None, model=None) -> DataFrame:
    """feature, importance, selected: importances of a forest (or of ``factory``'s
    learner, or of a fitted ``model``) on the training side; keep importance >= median (or >= a
    number). ``key_col`` is needed for learners whose importances are permuted."""
    import statistics
    if model is None:
        learner = factory() if factory is not None else models.make_estimator(
            "forest", numTrees=n_trees, maxDepth=max_depth, seed=seed)
        model = models.fit_pipeline(train, features, label_col, learner)
    imp = importance_table(model, features, train, key_col, label_col, seed=seed)
    cut = statistics.median(v for _, v in imp) if threshold == "median" else float(threshold)
    rows = [(f, v, v >= cut) for f, v in imp]
    return train.sparkSession.createDataFrame(rows, "feature string, importance double, "
                                                    "selected boolean")


# ------------------------------------------------------------ F2 RFECV

def rfecv(df: DataFrame, key_col: str, label_col: str, features: Sequence[str],
          factory: EstimatorFactory, min_features: int = 5, cv: int = 3, seed: int = 42,
          scoring: str = "f1_macro", full_model=None) -> tuple[DataFrame, DataFrame]:
    """(ranking, scores). In each fold the weakest feature (lowest importance, whatever the
    learner: see ``importance_table``)
    is dropped one at a time down to ``min_features``, scoring ``scoring`` on the
    held-out fold at each size; the best mean size wins (smaller on a tie); a
    final elimination on all rows gives the ranking (1 = kept). ``full_model`` spares its first
    fit, of all features on all rows."""
    check_scoring(scoring)
    feats = list(features)
    min_features = max(1, min(min_features, len(feats)))
    folded = split.stratified_folds(df, label_col, key_col, cv, seed).persist(
        StorageLevel.MEMORY_AND_DISK)

    def path(train, test):
        cur, out, order = list(feats), [], []
        while True:
            m = _fit(train, cur, label_col, factory)
            if test is not None:
                out.append((len(cur), _score_of(_counts(m, test, label_col), scoring)))
            if len(cur) <= min_features:
                return out, order, cur
            weakest = weakest_of(m, cur, train)
            order.append(weakest)
            cur = [f for f in cur if f != weakest]

    def weakest_of(m, cur, rows):
        return min(importance_table(m, cur, rows, key_col, label_col, seed=seed), key=lambda t: (t[1], t[0]))[0]

    per_fold = _pmap(lambda i: path(folded.where(F.col("fold") != i),
                                    folded.where(F.col("fold") == i))[0], list(range(cv)))
    folded.unpersist()
    rows = [(i, n, s) for i, res in enumerate(per_fold) for n, s in res]
    spark = df.sparkSession
    scores = (spark.createDataFrame(rows, "fold int, n_features int, score double")
              .groupBy("n_features").agg(F.avg("score").alias("mean_score"),
                                         F.stddev_pop("score").alias("std_score")))
    best = scores.orderBy(F.desc("mean_score"), "n_features").first()["n_features"]
    # final elimination on all rows down to the best size
    cur, order = list(feats), []
    while len(cur) > best:
        m = full_model if full_model is not None and len(cur) == len(feats) else _fit(df, cur, label_col, factory)
        weakest = weakest_of(m, cur, df)
        order.append(weakest)
        cur = [f for f in cur if f != weakest]
    rank = {f: 1 for f in cur}
    for j, f in enumerate(reversed(order)):
        rank[f] = j + 2
    ranking = spark.createDataFrame([(f, rank[f], rank[f] == 1) for f in feats],
                                    "feature string, ranking int, selected boolean")
    return ranking, scores


# ------------------------------------------------------------ F3 permutation importance

#: Permuted copies of the table that are scored in one job.
PAIR_BLOCK = 16


#: Rounds of a seeded permutation of positions, and the prime its round function counts by.
ROUNDS, PRIME = 6, 2 ** 31 - 1


def position_keys(seed: int, feature: str, repeat: int) -> list[int]:
    """Round keys of a (feature, repeat): five hex digits each of an md5."""
    import hashlib
    h = hashlib.md5(f"{seed}:{feature}:{repeat}".encode()).hexdigest()
    return [int(h[5 * i:5 * i + 5], 16) for i in range(ROUNDS)]


def permuted_positions(pos, n: int, keys: Sequence[int], inverse: bool = False):
    """A seeded one-to-one map of 0..n-1 onto itself, without a sort: a Feistel network on the
    two digits of a position in a number system of a x b >= n places; places of n and
    more are mapped on until they fall below n. ``inverse`` maps back. Numpy arrays of 64-bit integers."""
    import numpy as np
    a = math.isqrt(max(n - 1, 0)) + 1
    b = -(-n // a)

    def mixed(x, key):
        y = (x * 1103515245 + key * 12345 + 1) % PRIME
        z = y * y % PRIME
        return (z * 69069 + y) % PRIME

    sign = -1 if inverse else 1
    rounds = list(enumerate(keys))[::sign]
    out = np.array(pos, dtype=np.int64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] // b, out[todo] % b
        for i, key in rounds:
            if i % 2:
                right = (right + sign * mixed(left, key)) % b
            else:
                left = (left + sign * mixed(right, key)) % a
        out[todo] = left * b + right
        todo = todo[out[todo] >= n]
    return out


def _takers(n: int, keys: list[list[int]]):
    """Column function: for every pair's keys the position that takes its value from a position."""
    @F.pandas_udf("array<bigint>")
    def takers(pos: pd.Series) -> pd.Series:
        import numpy as np
        return pd.Series(list(np.stack([permuted_positions(pos.to_numpy(), n, k, inverse=True) for k in keys], axis=1)))
    return takers


def permutation_importance(model, df: DataFrame, key_col: str, label_col: str,
                           features: Sequence[str], n_repeats: int = 10, seed: int = 42,
                           threshold: float = 0.001) -> DataFrame:
    """feature, importance_mean, importance_std (population), rank, selected.

    Rows are ranked by key once. A (feature, repeat) pair is a seeded random permutation of
    positions (``permuted_positions``): the row at position i gets the feature's value from the
    position i is mapped to. Each row sends its values to the positions that take them (the
    inverse map), where they meet the row. Both sides have all rows, so the join is a merge join
    whatever its sides' compressed sizes. Pairs are scored in blocks of PAIR_BLOCK.
    """
    feats = list(features)
    base = df.select(q(key_col).alias("_k"), q(label_col).cast("string").alias(label_col), *[q(f) for f in feats])
    ranked = checkpointed(row_number(base, ["_k"], out="_pos").withColumn("_pos", F.col("_pos") - 1))
    n = ranked.count()
    if not n:
        raise ValueError("no rows")
    hit = (F.col(models.PRED_LABEL) == q(label_col)).cast("double")
    base_acc = models.score(model, ranked, label_col).select(F.avg(hit)).first()[0]
    pairs = [(f, r) for f in feats for r in range(n_repeats)]
    accs = []
    for at in range(0, len(pairs), PAIR_BLOCK):
        block = [(i, f, r, position_keys(seed, f, r)) for i, (f, r) in enumerate(pairs[at:at + PAIR_BLOCK])]
        takers = _takers(n, [keys for *_, keys in block])(F.col("_pos"))
        given = F.array(*[q(f).cast("double") for _, f, _, _ in block])
        sent = ranked.select(F.posexplode(F.arrays_zip(takers.alias("to"), given.alias("new"))).alias("pair", "m")).select(
            "pair", F.col("m.to").alias("_pos"), F.col("m.new").alias("new"))
        rows = sent.join(ranked.hint("merge"), "_pos").select("pair", label_col, *[
            F.when(F.col("pair").isin([i for i, f, _, _ in block if f == g]), F.col("new")).otherwise(q(g)).alias(g) for g in feats])
        names = df.sparkSession.createDataFrame([(i, f, r) for i, f, r, _ in block], "pair int, f string, r int")
        accs.append(checkpointed(models.score(model, rows, label_col).groupBy("pair").agg(F.avg(hit).alias("acc"))
                                 .join(F.broadcast(names), "pair").select("f", "r", "acc")))
    imp = (_union(accs).groupBy(F.col("f").alias("feature"))
           .agg(F.avg(F.lit(base_acc) - F.col("acc")).alias("importance_mean"),
                F.stddev_pop(F.lit(base_acc) - F.col("acc")).alias("importance_std")))
    from pyspark.sql import Window
    return (imp.withColumn("rank", F.row_number().over(
        Window.partitionBy().orderBy(F.desc("importance_mean"), "feature")))
        .withColumn("selected", F.col("importance_mean") >= F.lit(threshold)))


# ------------------------------------------------------------ F4 comparison

def compare_selectors(df: DataFrame, key_col: str, label_col: str, features: Sequence[str],
                      factory: EstimatorFactory, cv: int = 3, seed: int = 42,
                      min_features: int = 5, n_repeats: int = 10) -> DataFrame:
    """method, n_features, cv_f1 (macro F1 over ``cv`` folds, rounded to 4) for
    the importance-median, RFECV and permutation selections, each with ``factory``'s
    learner. A method that keeps no feature has 0 features and a null score."""
    m = _fit(df, features, label_col, factory)      # one fit on all rows and features for all three
    sel_imp = [r["feature"] for r in select_by_importance(
        df, label_col, features, seed=seed, key_col=key_col, model=m).where("selected").collect()]
    ranking, _ = rfecv(df, key_col, label_col, features, factory, min_features, cv, seed, full_model=m)
    sel_rfe = [r["feature"] for r in ranking.where("selected").collect()]
    pi = permutation_importance(m, df, key_col, label_col, features, n_repeats, seed)
    sel_pi = [r["feature"] for r in pi.where("selected").collect()]
    folded = split.stratified_folds(df, label_col, key_col, cv, seed).persist(StorageLevel.MEMORY_AND_DISK)
    rows = []
    for name, sel in (("importance_median", sel_imp), ("rfecv", sel_rfe), ("permutation", sel_pi)):
        if not sel:
            rows.append((name, 0, None))
            continue
        _, summ = cross_validate(df, key_col, label_col, sel, factory, cv, seed, folded)
        f1 = summ.where(F.col("metric") == "f1_macro").first()["mean"]
        rows.append((name, len(sel), round(float(f1), 4)))
    folded.unpersist()
    return df.sparkSession.createDataFrame(rows, "method string, n_features int, cv_f1 double")


# ------------------------------------------------------------ F6/F7 random search

# The reference's search spaces for the forest and for boosting.
FOREST_SPACE = {
    "n_estimators": [50, 100, 200, 300],
    "max_depth": [5, 10, 15, 20, 30, None],
    "min_samples_split": [2, 5, 10, 20],
    "min_samples_leaf": [1, 2, 5, 10, 20],
    "max_features": ["sqrt", "log2", 0.3, 0.5],
}
BOOSTING_SPACE = {
    "n_estimators": [100, 200, 300, 500],
    "max_depth": [3, 5, 7, 10],
    "learning_rate": [0.01, 0.05, 0.1, 0.2],
    "min_samples_split": [2, 5, 10],
    "min_samples_leaf": [1, 2, 5],
    "subsample": [0.7, 0.8, 0.9, 1.0],
}


def spark_params(kind: str, setting: Mapping) -> dict:
    """Map a reference-style setting to the learner's parameters: depth None -> 30 (the
    MLlib limit). MLlib's forest has no min_samples_split, so its leaf minimum is
    raised to ceil(split / 2) (stricter, never looser); boosting has it."""
    p = {}
    leaf = int(setting.get("min_samples_leaf", 1))
    if "min_samples_split" in setting and kind == "forest":
        leaf = max(leaf, -(-int(setting["min_samples_split"]) // 2))
    elif "min_samples_split" in setting:
        p["minSamplesSplit"] = int(setting["min_samples_split"])
    p["minInstancesPerNode"] = leaf
    if "max_depth" in setting:
        p["maxDepth"] = 30 if setting["max_depth"] is None else min(int(setting["max_depth"]), 30)
    if kind == "forest":
        if "n_estimators" in setting:
            p["numTrees"] = int(setting["n_estimators"])
        if "max_features" in setting:
            p["featureSubsetStrategy"] = str(setting["max_features"])
    else:
        if "n_estimators" in setting:
            p["maxIter"] = int(setting["n_estimators"])
        if "learning_rate" in setting:
            p["stepSize"] = float(setting["learning_rate"])
        if "subsample" in setting:
            p["subsamplingRate"] = float(setting["subsample"])
    return p


def draw_settings(space: Mapping[str, Sequence], n_iter: int, seed: int = 42) -> list[dict]:
    """n_iter distinct settings of the grid, seeded (all of it if smaller)."""
    keys = list(space)
    sizes = [len(space[k]) for k in keys]
    total = 1
    for s in sizes:
        total *= s
    idx = random.Random(seed).sample(range(total), min(n_iter, total))
    out = []
    for i in idx:
        d = {}
        for k, s in zip(reversed(keys), reversed(sizes)):
            d[k] = space[k][i % s]
            i //= s
        out.append({k: d[k] for k in keys})
    return out


def _forest_counts(folded: DataFrame, fold: int, features: Sequence[str], label_col: str,
                   learners: Mapping[int, forest.Forest]) -> DataFrame:
    """Count tables (setting_id, fold, side, label, prediction, count) of a fold's forests, which have as many
    bins a feature: the rows are indexed and binned once, and rows alike in their bins are scored once a forest."""
    rows = folded.withColumn(label_col, q(label_col).cast("string"))
    train = rows.where(F.col("fold") != fold)
    head = Pipeline(stages=models.head_stages(features, label_col)).fit(train)
    prepared = next(iter(learners.values())).prepared(head.transform(train))
    both = head.stages[1].transform(rows).select(
        vector_to_array(F.col(models.FEATURES)).alias("x"), q(label_col).alias("label"),
        F.when(F.col("fold") == fold, "val").otherwise("train").alias("side"))
    cells = forest.counted(both, prepared.cuts)
    ids = list(learners)
    groups = [[ids[i] for i in own] for own in forest.drawn_alike(list(learners.values()), prepared)]
    grown = _pmap(lambda own: forest.grown_together([learners[i] for i in own], prepared), groups)
    fitted = {i: m for own, made in zip(groups, grown) for i, m in zip(own, made)}
    return forest.predicted_counts(fitted, head.stages[0].labels, cells).withColumnRenamed(
        "id", "setting_id").withColumn("fold", F.lit(fold))


def random_search(df: DataFrame, key_col: str, label_col: str, features: Sequence[str],
                  kind: str | Callable[..., object], space: Mapping[str, Sequence], n_iter: int = 20, cv: int = 3,
                  seed: int = 42, overrides: Mapping | None = None, scoring: str = "f1_macro"
                  ) -> tuple[DataFrame, object]:
    """(results, best model). Results: setting_id, params (JSON), mean and std of
    the validation score, mean train score, gap (train - validation), rank.
    The best setting (highest validation mean) is refitted on all rows.

    ``kind`` is 'forest' or 'boosting' (settings mapped by ``spark_params``) or any
    callable that makes a learner from a setting's names and values. Forests share the rows of a fold
    (``_forest_counts``); every other learner is fitted and scored by itself."""
    import json
    check_scoring(scoring)
    settings = draw_settings(space, n_iter, seed)

    def learner(setting: Mapping):
        if callable(kind):
            return kind(**{**setting, **(overrides or {})})
        return models.make_estimator(kind, **{**spark_params(kind, setting), **(overrides or {})})

    learners = [learner(s) for s in settings]
    alike: dict[int, dict[int, forest.Forest]] = {}
    for sid, e in enumerate(learners):
        if isinstance(e, forest.Forest):
            alike.setdefault(e.getOrDefault(e.maxBins), {})[sid] = e
    folded = split.stratified_folds(df, label_col, key_col, cv, seed).persist(StorageLevel.MEMORY_AND_DISK)

    def one(job):
        sid, fold = job
        tr = folded.where(F.col("fold") != fold)
        m = models.fit_pipeline(tr, features, label_col, learners[sid])
        tags = {"setting_id": sid, "fold": fold}
        return _counts(m, folded.where(F.col("fold") == fold), label_col, side="val", **tags).unionByName(
            _counts(m, tr, label_col, side="train", **tags))

    jobs = [(s, f) for s, e in enumerate(learners) if not isinstance(e, forest.Forest) for f in range(cv)]
    found = [_forest_counts(folded, f, features, label_col, forests) for f in range(cv) for forests in alike.values()]
    counts = checkpointed(_union(found + (_pmap(one, jobs) if jobs else [])))
    per = metrics.macro_metrics(None, by=["setting_id", "fold", "side"], counts=counts)
    val, trn = F.when(F.col("side") == "val", F.col(scoring)), F.when(F.col("side") == "train", F.col(scoring))
    agg = per.groupBy("setting_id").agg(F.avg(val).alias("mean_val"), F.stddev_pop(val).alias("std_val"),
                                        F.avg(trn).alias("mean_train"))
    spark = df.sparkSession
    params = spark.createDataFrame([(i, json.dumps(s, sort_keys=True, default=str))
                                    for i, s in enumerate(settings)], "setting_id int, params string")
    from pyspark.sql import Window
    res = checkpointed(agg.join(params, "setting_id")
                       .withColumn("gap", F.col("mean_train") - F.col("mean_val"))
                       .withColumn("rank", F.row_number().over(
                           Window.partitionBy().orderBy(F.desc("mean_val"), "setting_id"))))
    best_id = res.where(F.col("rank") == 1).first()["setting_id"]
    best = models.fit_pipeline(folded.drop("fold"), features, label_col, learners[best_id])
    folded.unpersist()
    return res, best
