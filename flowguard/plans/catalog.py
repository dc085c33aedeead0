"""Named queries over the given tables: each is (spark, sf_dir) -> DataFrame.

Every query reads whole tables. Float results are rounded to 6 places and
integers widened to long, so that they compare exactly with the SQL oracle
(``flowguard.plans.oracle``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowguard.operators import (clean, drift, jobs, metrics, models, profile, resample, scale,
                                 split, validate)
from flowguard.plans.standins import (FLOW_DAY, FLOW_FEATURES, FLOW_KEY, FLOW_LABEL,
                                      DOC_FEATURES, EMB_FEATURES, PERIOD, REFERENCE_DAYS,
                                      dirty_flows, doc_quality, flows_by_period,
                                      RULE_SQL, embedding_rows, flows, scored_flows,
                                      table)
from flowguard.session import checkpointed
from flowguard.sources import files

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


def finalize(df: DataFrame) -> DataFrame:
    """Round floats to 6 places, widen integers to long, keep names."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            c = F.round(c.cast("double"), 6)
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("long")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def _ref_cur(spark, sf_dir):
    fl = flows(spark, sf_dir)
    return fl.where(F.col(FLOW_DAY) < REFERENCE_DAYS), fl.where(F.col(FLOW_DAY) >= REFERENCE_DAYS)


# ---------------------------------------------------------------- drift (D1-D4)

@register
def drift_by_day(spark, sf_dir):
    """KS drift of every feature, each later day against the first seven days."""
    ref, cur = _ref_cur(spark, sf_dir)
    res = drift.ks_drift(ref, cur, FLOW_FEATURES, batch_col=FLOW_DAY)
    return finalize(res)


@register
def ks_drift(spark, sf_dir):
    """KS drift, first half of the month against the second half."""
    fl = flows(spark, sf_dir)
    res = drift.ks_drift(fl.where(F.col(FLOW_DAY) < 15), fl.where(F.col(FLOW_DAY) >= 15),
                         FLOW_FEATURES)
    return finalize(res)


@register
def drift_summary(spark, sf_dir):
    ref, cur = _ref_cur(spark, sf_dir)
    ks = drift.ks_drift(ref, cur, FLOW_FEATURES, batch_col=FLOW_DAY)
    res = drift.drift_summary(ks, FLOW_DAY).withColumn(
        "drifted_features", F.array_join("drifted_features", ","))
    return finalize(res)


@register
def class_shift_counts(spark, sf_dir):
    ref, cur = _ref_cur(spark, sf_dir)
    return finalize(drift.class_shift_counts(ref, cur, FLOW_LABEL, FLOW_DAY))


@register
def chi2_drift(spark, sf_dir):
    ref, cur = _ref_cur(spark, sf_dir)
    return finalize(drift.chi2_drift(ref, cur, FLOW_LABEL, FLOW_DAY))


# ---------------------------------------------------------- sources, cleaning (S, P)

def _mixed_csv(spark, sf_dir):
    """One folder of CSV files with three headers: the second lacks user_id and has its
    columns in another order; the third names ``value`` twice."""
    fl = flows(spark, sf_dir)
    path = files.scratch_path(spark, "csv")
    files.write_csv(fl.where(F.col(FLOW_DAY) < 15), path)
    some = ["Label", "k", "value", FLOW_DAY, FLOW_KEY]
    files.write_csv(fl.where(F.col(FLOW_DAY).between(15, 21)).select(*some), path, "append")
    # a header with a repeated name ahead of the lines of every file
    header = ",".join([*some, "value"])

    def headed(batches):
        import pyarrow as pa
        yield pa.RecordBatch.from_pydict({"value": [header]})
        yield from batches
    last = fl.where(F.col(FLOW_DAY) > 21).withColumn("more", F.col("k") * 2)
    lines = last.select(F.to_csv(F.struct(*some, "more")).alias("value")).mapInArrow(headed, "value string")
    # the unquoted, delimiter-free CSV writer passes lines on as they are
    (lines.write.mode("append").option("header", False).option("quote", "").option("delimiter", "\u0001")
     .option("escapeQuotes", False).csv(path))
    return path, fl.schema


@register
def csv_union(spark, sf_dir):
    """CSV files of one folder with different headers, united by name; types found."""
    path, _ = _mixed_csv(spark, sf_dir)
    return finalize(files.load_csv_files(spark, path, keep_source=False))


@register
def csv_union_schema(spark, sf_dir):
    """The same folder read with a schema, which is applied by name."""
    path, schema = _mixed_csv(spark, sf_dir)
    return finalize(files.load_csv_files(spark, path, schema=schema, keep_source=False))


@register
def clean_flows(spark, sf_dir):
    return finalize(clean.clean_dataframe(dirty_flows(spark, sf_dir)))


@register
def clean_drop_report(spark, sf_dir):
    return finalize(clean.clean_drop_report(dirty_flows(spark, sf_dir)))


@register
def label_repair(spark, sf_dir):
    d = dirty_flows(spark, sf_dir).select(F.col("` Label `").alias("raw_label"))
    return finalize(d.groupBy("raw_label").agg(F.count(F.lit(1)).alias("n"))
                    .withColumn("label", clean.repaired_label("raw_label")))


@register
def downcast_plan(spark, sf_dir):
    return finalize(clean.downcast_plan(table(spark, sf_dir, "lineitem")))


@register
def downcast_values(spark, sf_dir):
    """Values after narrowing, widened back to long/double: equal to the input
    for integers, float32 precision for floats. Not rounded, so the float
    round-trip shows in every digit."""
    li = table(spark, sf_dir, "lineitem")
    out = clean.downcast(li)
    widened = [F.col(f.name).cast("long").alias(f.name) if isinstance(f.dataType, clean.INT_TYPES)
               else F.col(f.name).cast("double").alias(f.name)
               if isinstance(f.dataType, clean.FLOAT_TYPES)
               else F.col(f.name).cast("string").alias(f.name) for f in out.schema.fields]
    return out.select(*widened)


@register
def drop_columns(spark, sf_dir):
    return finalize(clean.drop_columns(flows(spark, sf_dir), ["k", "no_such_column"]))


@register
def class_subset(spark, sf_dir):
    return finalize(clean.class_subset(flows(spark, sf_dir), FLOW_LABEL, ["click", "purchase"]))


# Full week map for the stand-in, whose days run Monday to Sunday.
WEEK_MAP = {"Monday": 0, "Tuesday": 1, "Wednesday": 2, "Thursday": 3, "Friday": 4,
            "Saturday": 5, "Sunday": 6}


@register
def add_day(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(
        F.col("event_id").alias(FLOW_KEY), F.date_format("ts", "EEEE").alias("DayName"))
    return finalize(clean.add_day_column(e, "DayName", WEEK_MAP))


@register
def head_rows(spark, sf_dir):
    return finalize(clean.head_rows(flows(spark, sf_dir), [FLOW_KEY], 5))


@register
def parquet_roundtrip(spark, sf_dir):
    """Cleaned flows written as Parquet partitioned by day, read back whole."""
    path = files.scratch_path(spark, "parquet")
    files.write_parquet(clean.clean_dataframe(dirty_flows(spark, sf_dir)), path, [FLOW_DAY])
    return finalize(files.read_parquet(spark, path))


# ---------------------------------------------------------------- profiles (A1-A9)
LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register
def class_distribution(spark, sf_dir):
    return finalize(profile.class_distribution(flows(spark, sf_dir), FLOW_LABEL))


@register
def describe_numeric(spark, sf_dir):
    return finalize(profile.describe_numeric(flows(spark, sf_dir), FLOW_FEATURES))


@register
def column_profile(spark, sf_dir):
    return finalize(profile.column_profile(dirty_flows(spark, sf_dir)))


@register
def log_histogram(spark, sf_dir):
    return finalize(profile.log_histogram(flows(spark, sf_dir), FLOW_FEATURES, 50))


@register
def binned_kde(spark, sf_dir):
    return finalize(profile.binned_kde(flows(spark, sf_dir), FLOW_FEATURES, grid=100))


@register
def box_stats(spark, sf_dir):
    return finalize(profile.box_stats(flows(spark, sf_dir), FLOW_LABEL, FLOW_FEATURES))


@register
def factorized_corr(spark, sf_dir):
    return finalize(profile.factorized_corr(flows(spark, sf_dir), FLOW_KEY,
                                            ["value", "user_id", "k", FLOW_LABEL]))


@register
def value_corr(spark, sf_dir):
    return finalize(profile.value_corr(table(spark, sf_dir, "lineitem"), LI_NUM))


@register
def redundant_pairs(spark, sf_dir):
    """Pairs above 0.8 among the price columns and two prices derived from them."""
    li = table(spark, sf_dir, "lineitem").select(
        *LI_NUM,
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net_price"),
        (F.col("l_extendedprice") * (1 + F.col("l_tax"))).alias("gross_price"))
    corr = profile.value_corr(li, LI_NUM + ["net_price", "gross_price"])
    return finalize(profile.redundant_pairs(corr, 0.8))


@register
def prediction_summary(spark, sf_dir):
    return finalize(profile.prediction_summary(scored_flows(spark, sf_dir), "prediction"))


# ---------------------------------------------------------------- splits (V1-V4, V8)

@register
def stratified_split(spark, sf_dir):
    return finalize(split.stratified_split(flows(spark, sf_dir), FLOW_LABEL, FLOW_KEY, 0.3, 42))


@register
def stratified_folds(spark, sf_dir):
    return finalize(split.stratified_folds(flows(spark, sf_dir), FLOW_LABEL, FLOW_KEY, 5, 42))


@register
def temporal_split(spark, sf_dir):
    return finalize(split.temporal_split(flows(spark, sf_dir), FLOW_DAY, range(0, 21),
                                         range(21, 30)))


@register
def walk_forward_folds(spark, sf_dir):
    return finalize(split.walk_forward_folds(flows(spark, sf_dir), FLOW_DAY, 2))


@register
def permuted_column(spark, sf_dir):
    return finalize(split.permute_column(flows(spark, sf_dir), FLOW_KEY, "value", 7))


# ---------------------------------------------------------------- metrics (A10-A16, F5)

@register
def confusion_matrix(spark, sf_dir):
    return finalize(metrics.confusion_matrix(scored_flows(spark, sf_dir), FLOW_LABEL, "prediction"))


@register
def confusion_matrix_norm(spark, sf_dir):
    cm = metrics.confusion_matrix(scored_flows(spark, sf_dir), FLOW_LABEL, "prediction")
    return finalize(metrics.confusion_matrix_norm(cm))


@register
def classification_report(spark, sf_dir):
    return finalize(metrics.classification_report(scored_flows(spark, sf_dir), FLOW_LABEL,
                                                  "prediction"))


@register
def evaluate(spark, sf_dir):
    """Evaluation bundle: matrix, per-class report and macro scores from one count table."""
    return finalize(metrics.evaluate(scored_flows(spark, sf_dir), FLOW_LABEL, "prediction"))


@register
def train_test_gap(spark, sf_dir):
    sp = split.stratified_split(scored_flows(spark, sf_dir), FLOW_LABEL, FLOW_KEY, 0.3, 42)
    tr, te = split.train_test(sp)
    return finalize(metrics.train_test_gap(tr, te, FLOW_LABEL, "prediction"))


def _fold_scores(spark, sf_dir):
    folds = split.stratified_folds(scored_flows(spark, sf_dir), FLOW_LABEL, FLOW_KEY, 5, 42)
    return metrics.macro_metrics(folds, FLOW_LABEL, "prediction", by=["fold"])


@register
def macro_metrics(spark, sf_dir):
    return finalize(_fold_scores(spark, sf_dir))


@register
def fold_summary(spark, sf_dir):
    return finalize(metrics.fold_summary(
        _fold_scores(spark, sf_dir),
        ["accuracy", "precision_macro", "recall_macro", "f1_macro"]))


@register
def standard_scale(spark, sf_dir):
    """Scaler fitted on the stratified train side, applied to both sides."""
    sp = split.stratified_split(flows(spark, sf_dir), FLOW_LABEL, FLOW_KEY, 0.3, 42)
    tr, te = split.train_test(sp)
    a, b, _ = scale.scale_features(tr, te, FLOW_FEATURES)
    both = a.withColumn("split", F.lit("train")).unionByName(b.withColumn("split", F.lit("test")))
    return finalize(both)


# ---------------------------------------------------------------- SMOTE (V6)

@register
def smote_class_targets(spark, sf_dir):
    return finalize(resample.class_targets(embedding_rows(spark, sf_dir), "label"))


@register
def smote_knn(spark, sf_dir):
    """Exact 5 nearest vectors of the same class for every vector."""
    knn = resample.knn_within_class(embedding_rows(spark, sf_dir), "vec_id", "label",
                                    EMB_FEATURES, k=5, seed=42)
    return finalize(knn.select(F.col("key").alias("vec_id"), "label", "nn_rank",
                               F.col("nn_key").alias("nn_vec_id"), "dist"))


@register
def smote_rows(spark, sf_dir):
    """The synthetic rows that raise every class to the majority count."""
    out = resample.synthetic_rows(embedding_rows(spark, sf_dir), "vec_id", "label", EMB_FEATURES, 5, 42)
    return finalize(out)


# ------------------------------------------------------ models, scoring (M, S4-S7)
# Seeded fits: the queries run the whole job and return what SQL can state about it
# (rows, supports, sizes, sums, ranges); tests look at the scores themselves. The
# *_rule queries run the same loops with a fixed rule as the learner, exactly.
#
# Learners are smaller than the operators' defaults (100 trees of depth 15; 100 rounds)
# where a query fits many of them, so that one ends in minutes on one machine.

def _forest(**kw):
    p = {"numTrees": 20, "maxDepth": 8, "seed": 42}
    p.update(kw)
    return lambda: models.make_estimator("forest", **p)


#: The forest at the operator's defaults.
FULL_FOREST = {"numTrees": 100, "maxDepth": 15}


def _in_unit(*cols):
    ok = F.lit(True)
    for c in cols:
        ok = ok & F.coalesce(F.col(c).between(0, 1), F.lit(True))
    return ok


def _report(model, test, label_col):
    """row, support of the classification report and whether its scores lie in [0, 1]."""
    counts = metrics.cells(models.score(model, test, label_col), label_col, models.PRED_LABEL)
    rep = metrics.classification_report(None, counts=counts)
    return rep.select("row", "support", _in_unit("precision", "recall", "f1").alias("scores_valid"))


def _split_kept(df, label_col, key_col):
    """Both sides of the split, computed once (the learner passes over train many times)."""
    sp = split.stratified_split(df, label_col, key_col)
    path = files.scratch_path(df.sparkSession, "split")
    sp.write.parquet(path)
    return split.train_test(df.sparkSession.read.parquet(path))


def _flow_split(spark, sf_dir):
    return _split_kept(flows(spark, sf_dir), FLOW_LABEL, FLOW_KEY)


def _doc_split(spark, sf_dir):
    return _split_kept(doc_quality(spark, sf_dir), "quality", "doc_id")


@register
def train_logreg(spark, sf_dir):
    tr, te = _flow_split(spark, sf_dir)
    est = models.make_estimator("logreg", n_rows=tr.count(), maxIter=1000)
    m = models.fit_pipeline(tr, FLOW_FEATURES, FLOW_LABEL, est, scale=True)
    return finalize(_report(m, te, FLOW_LABEL))


@register
def train_forest(spark, sf_dir):
    tr, te = _flow_split(spark, sf_dir)
    m = models.fit_pipeline(tr, FLOW_FEATURES, FLOW_LABEL, _forest(**FULL_FOREST)())
    return finalize(_report(m, te, FLOW_LABEL))


def _smote_train(tr):
    return resample.smote(tr, "doc_id", "quality", DOC_FEATURES, 5, 42)


@register
def train_smote_forest(spark, sf_dir):
    """SMOTE on the training side only, then the forest; scored on the untouched
    test side."""
    tr, te = _doc_split(spark, sf_dir)
    m = models.fit_pipeline(_smote_train(tr), DOC_FEATURES, "quality", _forest(**FULL_FOREST)())
    return finalize(_report(m, te, "quality"))


@register
def train_boosting(spark, sf_dir):
    """Joint boosting at the operator's defaults: 100 rounds of a tree a class."""
    tr, te = _flow_split(spark, sf_dir)
    m = models.fit_pipeline(tr, FLOW_FEATURES, FLOW_LABEL, models.make_estimator("boosting"))
    return finalize(_report(m, te, FLOW_LABEL))


def _few_rounds():
    return models.make_estimator("boosting", maxIter=10)


@register
def learners_rule(spark, sf_dir):
    """Learners on a label that is a rule of one feature (bands of ``value``), scored on the test
    side: rows, whether nearly all are right (99 % for trees, better than the
    commonest class for the linear model), and whether a second fit predicts the same. Boosting
    has 10 rounds here, the forest 20 trees of depth 8 with 256 bins: the rule needs no more."""
    ruled = flows(spark, sf_dir).withColumn("band", F.expr(RULE_SQL)).drop(FLOW_LABEL)
    tr, te = _split_kept(ruled, "band", FLOW_KEY)
    n_train = tr.count()
    makers = {"logreg": (lambda: models.make_estimator("logreg", n_rows=n_train, maxIter=100), True),
              "forest": (_forest(featureSubsetStrategy="all", maxBins=256), False), "boosting": (_few_rounds, False)}
    n = te.count()
    most = te.groupBy("band").count().agg(F.max("count")).first()[0]
    rows = []
    for name, (make, scale) in makers.items():
        fits = [checkpointed(models.score(models.fit_pipeline(tr, FLOW_FEATURES, "band", make(), scale=scale), te).select(
            FLOW_KEY, "band", models.PRED_LABEL)) for _ in range(2)]
        right = fits[0].where(F.col("band") == F.col(models.PRED_LABEL)).count()
        again = fits[0].join(fits[1].withColumnRenamed(models.PRED_LABEL, "_again"), FLOW_KEY).where(
            F.col(models.PRED_LABEL) == F.col("_again")).count()
        rows.append((name, n, right > most if name == "logreg" else right >= 0.99 * n, again == n))
    return spark.createDataFrame(rows, "model string, n long, learned boolean, same_again boolean")


@register
def compare_models(spark, sf_dir):
    """Per-class reports of the three models on the same split, tagged by model."""
    tr, te = _doc_split(spark, sf_dir)
    lr = models.fit_pipeline(tr, DOC_FEATURES, "quality", models.make_estimator(
        "logreg", n_rows=tr.count(), maxIter=1000), scale=True)
    rf = models.fit_pipeline(tr, DOC_FEATURES, "quality", _forest()())
    sm = models.fit_pipeline(_smote_train(tr), DOC_FEATURES, "quality", _forest()())
    parts = [_report(m, te, "quality").withColumn("model", F.lit(name))
             for name, m in (("logreg", lr), ("forest", rf), ("smote_forest", sm))]
    out = parts[0]
    for p_ in parts[1:]:
        out = out.unionByName(p_)
    return finalize(out)


def _saved_forest(spark, sf_dir):
    tr, te = _flow_split(spark, sf_dir)
    m = models.fit_pipeline(tr, FLOW_FEATURES, FLOW_LABEL, _forest()())
    acc = metrics.macro_metrics(models.score(m, te, FLOW_LABEL), FLOW_LABEL,
                                models.PRED_LABEL).first()["accuracy"]
    path = files.scratch_path(spark, "model")
    models.save_model(m, path, {"name": "forest", "accuracy": acc})
    return path


@register
def score_table(spark, sf_dir):
    """Scoring job: load a saved model, score flows written as CSV, write the input rows
    plus the prediction as CSV and summarise: rows scored, rows in the summary and in
    the written file, and the sum of its percentages."""
    path = _saved_forest(spark, sf_dir)
    fl = flows(spark, sf_dir).drop(FLOW_LABEL)
    csv_dir, out_dir = files.scratch_path(spark, "input"), files.scratch_path(spark, "predictions")
    files.write_csv(fl, csv_dir)
    scored, summary = jobs.score_job(spark, path, csv_dir, out_dir, schema=fl.schema, features=FLOW_FEATURES)
    written = files.load_csv_files(spark, out_dir, schema=scored.schema, keep_source=False)
    total = summary.agg(F.sum("count").alias("n_summary"), F.round(F.sum("percent"), 4).alias("percent_total")).first()
    return finalize(written.agg(F.count("prediction").alias("n_written"))
                    .withColumn("n_summary", F.lit(total["n_summary"]))
                    .withColumn("percent_total", F.lit(total["percent_total"])))


@register
def score_stream(spark, sf_dir):
    """The scoring job on a stream: flows in six files, two a micro-batch. Rows written, rows
    in the running summary, the sum of its percentages, and flows that are written once."""
    from flowguard.streaming.score_stream import running_summary, scored_rows, start_score_job
    path = _saved_forest(spark, sf_dir)
    fl = flows(spark, sf_dir).drop(FLOW_LABEL)
    src, out = files.scratch_path(spark, "score-src"), files.scratch_path(spark, "score-out")
    fl.repartition(6, FLOW_KEY).write.parquet(src)
    stream = spark.readStream.schema(fl.schema).option("maxFilesPerTrigger", 2).parquet(src)
    start_score_job(stream, path, out, files.scratch_path(spark, "score-ckpt"), FLOW_FEATURES).awaitTermination()
    rows = scored_rows(spark, out, fl.withColumn("prediction", F.lit("")).schema)
    total = running_summary(spark, out).agg(F.sum("count").alias("n"), F.round(F.sum("percent"), 4).alias("p")).first()
    return finalize(rows.agg(F.count("prediction").alias("n_written"), F.countDistinct(FLOW_KEY).alias("n_flows"))
                    .withColumn("n_summary", F.lit(total["n"])).withColumn("percent_total", F.lit(total["p"])))


@register
def clustered_write(spark, sf_dir):
    """Flows written by day with at most 150 rows a part: rows of each day, and whether its files
    are no more than its rows need."""
    fl = flows(spark, sf_dir)
    path = files.write_parquet(fl, files.scratch_path(spark, "clustered"), [FLOW_DAY], file_rows=150)
    back = spark.read.parquet(path).select(FLOW_DAY, F.col("_metadata.file_path").alias("file"))
    return finalize(back.groupBy(FLOW_DAY).agg(
        F.count(F.lit(1)).alias("n"),
        (F.countDistinct("file") <= F.ceil(F.count(F.lit(1)) / 150)).alias("files_bounded")))


@register
def split_features_target(spark, sf_dir):
    """Names of the features, and the features' sums by target."""
    fl = flows(spark, sf_dir).select(*FLOW_FEATURES, FLOW_LABEL)
    names, target = clean.split_features_target(fl, FLOW_LABEL)
    return finalize(fl.groupBy(F.col(target).alias("target")).agg(
        F.lit(",".join(names)).alias("features"), F.count(F.lit(1)).alias("n"),
        *[F.sum(f).cast("double").alias(f"sum_{f}") for f in names]))


@register
def score_probabilities(spark, sf_dir):
    """For every flow and each of three learners (saved forest, linear, boosting with 10 rounds)
    the number of class probabilities, their sum, whether each lies in [0, 1], and whether the
    predicted class is the likeliest."""
    forest, _ = models.load_model(_saved_forest(spark, sf_dir))
    fl = flows(spark, sf_dir)
    linear = models.fit_pipeline(fl, FLOW_FEATURES, FLOW_LABEL, models.make_estimator("logreg", n_rows=fl.count(), maxIter=100), scale=True)
    boosted = models.fit_pipeline(fl, FLOW_FEATURES, FLOW_LABEL, _few_rounds())
    parts = []
    for name, model in (("forest", forest), ("logreg", linear), ("boosting", boosted)):
        scored = models.score(model, fl)
        probs = models.class_probabilities(model, scored, [FLOW_KEY, models.PRED_LABEL])
        own = F.max(F.when(F.col("class") == F.col(models.PRED_LABEL), F.col("probability")))
        parts.append(probs.groupBy(FLOW_KEY).agg(
            F.count(F.lit(1)).alias("n_classes"), F.sum("probability").alias("probability_sum"),
            F.min(F.col("probability").between(0, 1)).alias("in_range"),
            (own >= F.max("probability")).alias("predicts_likeliest")).withColumn("model", F.lit(name)))
    return finalize(parts[0].unionByName(parts[1]).unionByName(parts[2]))


@register
def model_roundtrip(spark, sf_dir):
    """Save, load, score the whole table with both: n_rows, n_same, metadata."""
    tr, _ = _flow_split(spark, sf_dir)
    m = models.fit_pipeline(tr, FLOW_FEATURES, FLOW_LABEL, _forest()())
    path = files.scratch_path(spark, "roundtrip")
    models.save_model(m, path, {"name": "forest", "accuracy": 0.0})
    m2, meta = models.load_model(path)
    fl = flows(spark, sf_dir)
    a = models.score(m, fl).select(FLOW_KEY, F.col(models.PRED_LABEL).alias("a"))
    b = models.score(m2, fl).select(FLOW_KEY, F.col(models.PRED_LABEL).alias("b"))
    cmp = a.join(b, FLOW_KEY).agg(F.count(F.lit(1)).alias("n_rows"),
                                  F.sum((F.col("a") == F.col("b")).cast("long")).alias("n_same"))
    return finalize(cmp.withColumn("name", F.lit(meta.get("name")))
                    .withColumn("has_saved_at", F.lit("saved_at" in meta)))


@register
def prepared_dataset(spark, sf_dir):
    """The prepared bundle: cleaned rows, stratified split, features kept by forest
    importance, population scaling, table and fitted pipeline written and read back.
    Returns every row's key, label and side."""
    cl = clean.clean_dataframe(dirty_flows(spark, sf_dir))
    path = files.scratch_path(spark, "prepared")
    jobs.prepare_bundle(cl, FLOW_KEY, FLOW_LABEL, FLOW_FEATURES, path)
    data, _ = jobs.load_bundle(spark, path)
    return finalize(data.select(FLOW_KEY, FLOW_LABEL, "split"))


# ------------------------------------------------------ loops (V4, V5, F1-F4, F6-F7)
# The selection loops run over all rows and all features of the labelled documents.

def rule_learner():
    """The fixed stand-in classifier in the place of a learner: class index (alphabetical)
    from bands of ``value``."""
    from pyspark.ml.feature import SQLTransformer
    return SQLTransformer(statement="""SELECT *, CAST(CASE WHEN value < 5 THEN 4 WHEN value < 10 THEN 0
        WHEN value < 20 THEN 2 WHEN value < 40 THEN 3 ELSE 1 END AS DOUBLE) AS prediction FROM __THIS__""")


@register
def cross_validate(spark, sf_dir):
    """Five folds of a forest of 20 trees of depth 8: fold sizes, scores in [0, 1]."""
    per_fold, _ = validate.cross_validate(flows(spark, sf_dir), FLOW_KEY, FLOW_LABEL,
                                          FLOW_FEATURES, _forest(), k=5, seed=42)
    return finalize(per_fold.select("fold", "n", _in_unit(*validate.SCORE_COLS).alias("scores_valid")))


@register
def cross_validate_rule(spark, sf_dir):
    """The same loop with the fixed rule: exact scores of every fold."""
    per_fold, _ = validate.cross_validate(flows(spark, sf_dir), FLOW_KEY, FLOW_LABEL,
                                          FLOW_FEATURES, rule_learner, k=5, seed=42)
    return finalize(per_fold)


@register
def walk_forward_scores(spark, sf_dir):
    """Each later period scored by a forest (20 trees, depth 8) trained on those before it."""
    steps, _ = validate.walk_forward_scores(flows_by_period(spark, sf_dir), PERIOD, FLOW_LABEL,
                                            FLOW_FEATURES, _forest(), 2, "f1_macro")
    return finalize(steps.select("step", "test_day", "train_size", "test_size",
                                 _in_unit("score").alias("scores_valid")))


@register
def walk_forward_rule(spark, sf_dir):
    """The same loop with the fixed rule: exact scores of every step."""
    steps, _ = validate.walk_forward_scores(flows_by_period(spark, sf_dir), PERIOD, FLOW_LABEL,
                                            FLOW_FEATURES, rule_learner, 2, "f1_macro")
    return finalize(steps)


@register
def select_by_importance(spark, sf_dir):
    """Importances of the full forest over all document features: how many, how many are
    kept at the median or above, and their sum."""
    tr, _ = _doc_split(spark, sf_dir)
    imp = validate.select_by_importance(tr, "quality", DOC_FEATURES)
    return finalize(imp.agg(F.count(F.lit(1)).alias("n_features"),
                            (F.sum(F.col("selected").cast("int")) * 2 >= F.count(F.lit(1))).alias("half_kept"),
                            F.round(F.sum("importance"), 6).alias("importance_sum")))


@register
def rfecv(spark, sf_dir):
    """Elimination down to two features, three folds, forest of 20 trees of depth 8 (a fit
    for each fold and size): features ranked, one kept at least, ranks without gaps."""
    ranking, _ = validate.rfecv(doc_quality(spark, sf_dir), "doc_id", "quality", DOC_FEATURES,
                                _forest(), min_features=2, cv=3)
    kept = F.sum(F.col("selected").cast("int"))
    return finalize(ranking.agg(F.count(F.lit(1)).alias("n_features"), (kept >= 2).alias("kept_enough"),
                                (F.max("ranking") == F.count(F.lit(1)) - kept + 1).alias("ranks_whole")))


@register
def rfecv_linear(spark, sf_dir):
    """The same elimination with a linear learner, by its coefficients for a step of one std."""
    docs = doc_quality(spark, sf_dir)
    n = docs.count()
    ranking, _ = validate.rfecv(docs, "doc_id", "quality", DOC_FEATURES,
                                lambda: models.make_estimator("logreg", n_rows=n, maxIter=30), min_features=2, cv=3)
    kept = F.sum(F.col("selected").cast("int"))
    return finalize(ranking.agg(F.count(F.lit(1)).alias("n_features"), (kept >= 2).alias("kept_enough"),
                                (F.max("ranking") == F.count(F.lit(1)) - kept + 1).alias("ranks_whole")))


@register
def permutation_importance(spark, sf_dir):
    """Ten repeats for every document feature under a forest of 20 trees of depth 8."""
    docs = doc_quality(spark, sf_dir)
    m = models.fit_pipeline(docs, DOC_FEATURES, "quality", _forest()())
    imp = validate.permutation_importance(m, docs, "doc_id", "quality", DOC_FEATURES)
    return finalize(imp.select("feature", F.col("importance_mean").between(-1, 1).alias("valid"),
                               (F.col("selected") == (F.col("importance_mean") >= 0.001)).alias("threshold_applied")))


@register
def permutation_rule(spark, sf_dir):
    """The same operator with the fixed rule as the model, ten repeats: exact importances and ranks."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import SQLTransformer
    rule = SQLTransformer(statement=f"SELECT *, {RULE_SQL} AS {models.PRED_LABEL} FROM __THIS__")
    # the first stage stands for the label indexer, which scoring skips
    model = PipelineModel([rule, rule])
    return finalize(validate.permutation_importance(model, flows(spark, sf_dir), FLOW_KEY, FLOW_LABEL, FLOW_FEATURES))


@register
def compare_selectors(spark, sf_dir):
    """The three selections at their default repeats, forest of 10 trees of depth 5 (about
    forty fits)."""
    res = validate.compare_selectors(doc_quality(spark, sf_dir), "doc_id", "quality", DOC_FEATURES,
                                     _forest(numTrees=10, maxDepth=5), cv=3, min_features=2)
    n = len(DOC_FEATURES)
    return finalize(res.select("method", F.col("n_features").between(0, n).alias("count_valid"),
                               _in_unit("cv_f1").alias("scores_valid")))


@register
def random_search(spark, sf_dir):
    """The operator's defaults: 20 settings of the forest space, three folds, best one refitted on all
    rows (a setting is up to 300 trees of depth 30)."""
    res, _ = validate.random_search(doc_quality(spark, sf_dir), "doc_id", "quality", DOC_FEATURES,
                                    "forest", validate.FOREST_SPACE)
    return finalize(res.select("setting_id", _in_unit("mean_val", "mean_train").alias("scores_valid"),
                               F.col("rank").between(1, 20).alias("ranked")))


# ---------------------------------------------------------------- streaming (D4)

def _stream_reports(spark, sf_dir):
    """Flows dealt to files by their key, so that every file holds rows of every day, streamed a
    few files per micro-batch: a day is whole only after the last one."""
    from flowguard.streaming.drift_stream import start_drift_stream
    ref, cur = _ref_cur(spark, sf_dir)
    src = files.scratch_path(spark, "stream-src")
    cur.repartition(6, FLOW_KEY).write.mode("overwrite").parquet(src)
    stream = (spark.readStream.schema(spark.read.parquet(src).schema)
              .option("maxFilesPerTrigger", 2).parquet(src))
    reports = files.scratch_path(spark, "stream-reports")
    q_ = start_drift_stream(stream, ref, FLOW_FEATURES, FLOW_DAY, reports,
                            files.scratch_path(spark, "stream-ckpt"), label_col=FLOW_LABEL)
    q_.awaitTermination()
    return reports


@register
def drift_stream(spark, sf_dir):
    """Feature drift of the stream after its last micro-batch: the same numbers as drift_by_day."""
    from flowguard.streaming.drift_stream import read_reports
    return finalize(read_reports(spark, _stream_reports(spark, sf_dir), batch_col=FLOW_DAY))


@register
def drift_stream_batches(spark, sf_dir):
    """Batch reports of the stream: data drift, class drift and needs_retraining by day."""
    from flowguard.streaming.drift_stream import read_reports
    return finalize(read_reports(spark, _stream_reports(spark, sf_dir), "batches", FLOW_DAY))


@register
def drift_monitor(spark, sf_dir):
    """The batch monitor over three later periods of flows, with labels for the
    first two and without for the third: one report row per batch."""
    fl = flows(spark, sf_dir)
    mon = drift.DriftMonitor(fl.where(F.col(FLOW_DAY) < REFERENCE_DAYS), FLOW_FEATURES,
                             FLOW_LABEL)
    reps = [mon.check(fl.where((F.col(FLOW_DAY) >= lo) & (F.col(FLOW_DAY) < hi)), labels)
            for lo, hi, labels in ((7, 14, True), (14, 21, True), (21, 30, False))]
    out = reps[0]
    for r in reps[1:]:
        out = out.unionByName(r)
    return finalize(out)
