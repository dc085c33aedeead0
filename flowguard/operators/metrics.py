"""Classification quality from a scored table (true label + prediction columns).

Everything derives from one count table: ``cells`` counts rows by (group, label,
prediction) in a single pass over the scored rows, so a model is run once. Per-class,
macro and weighted scores, the confusion matrix and accuracy come from that small
table (classes squared per group). No collect, no per-row Python.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.evaluation import Evaluator
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowguard.functions.columns import q
from flowguard.session import checkpointed


def _safe_div(a, b):
    """a / b, 0 when b is 0 (zero_division = 0)."""
    return F.when(b == 0, F.lit(0.0)).otherwise(a / b)


def cells(df: DataFrame, label_col: str, pred_col: str, by: Sequence[str] = ()) -> DataFrame:
    """by..., label, prediction, count: the one pass over the scored rows. Written to the
    checkpoint folder, so that what is computed from it does not score again."""
    return checkpointed(df.groupBy(*[q(b).alias(b) for b in by], q(label_col).cast("string").alias("label"),
                                   q(pred_col).cast("string").alias("prediction"))
                        .agg(F.count(F.lit(1)).alias("count")))


def class_counts(df: DataFrame | None, label_col: str = "label", pred_col: str = "prediction",
                 by: Sequence[str] = (), counts: DataFrame | None = None) -> DataFrame:
    """by..., class, tp, n_true, n_pred over the union of true and predicted
    classes of each group; from ``counts`` (see ``cells``) if given."""
    by = list(by)
    c = counts if counts is not None else cells(df, label_col, pred_col, by)
    n, zero = F.col("count"), F.lit(0).cast("long")
    sides = F.array(
        F.struct(F.col("label").alias("class"), F.when(F.col("label") == F.col("prediction"), n)
                 .otherwise(zero).alias("tp"), n.alias("t"), zero.alias("p")),
        F.struct(F.col("prediction").alias("class"), zero.alias("tp"), zero.alias("t"), n.alias("p")))
    return (c.select(*by, F.inline(sides)).groupBy(*by, "class")
            .agg(F.sum("tp").alias("tp"), F.sum("t").alias("n_true"), F.sum("p").alias("n_pred")))


def per_class_scores(counts: DataFrame) -> DataFrame:
    p = _safe_div(F.col("tp"), F.col("n_pred"))
    r = _safe_div(F.col("tp"), F.col("n_true"))
    return (counts.withColumn("precision", p).withColumn("recall", r)
            .withColumn("f1", _safe_div(2 * F.col("precision") * F.col("recall"),
                                        F.col("precision") + F.col("recall"))))


def macro_metrics(df: DataFrame | None, label_col: str = "label", pred_col: str = "prediction",
                  by: Sequence[str] = (), counts: DataFrame | None = None) -> DataFrame:
    """by..., n, accuracy, precision_macro, recall_macro, f1_macro (means over the
    sorted union of classes of each group; 0 on zero division)."""
    by = list(by)
    s = per_class_scores(class_counts(df, label_col, pred_col, by, counts))
    return s.groupBy(*by).agg(
        F.sum("n_true").alias("n"),
        (F.sum("tp") / F.sum("n_true")).alias("accuracy"),
        F.avg("precision").alias("precision_macro"), F.avg("recall").alias("recall_macro"),
        F.avg("f1").alias("f1_macro"))


def classification_report(df: DataFrame | None, label_col: str = "label", pred_col: str = "prediction",
                          counts: DataFrame | None = None) -> DataFrame:
    """row, precision, recall, f1, support: one row per class, then 'accuracy'
    (f1 column holds it), 'macro avg' and 'weighted avg'."""
    s = per_class_scores(class_counts(df, label_col, pred_col, (), counts))
    per = s.select(F.col("class").alias("row"), "precision", "recall", "f1",
                   F.col("n_true").alias("support"))
    tot = s.agg(F.sum("n_true").alias("n"), F.sum("tp").alias("tp"),
                F.avg("precision").alias("mp"), F.avg("recall").alias("mr"),
                F.avg("f1").alias("mf"),
                (F.sum(F.col("precision") * F.col("n_true")) / F.sum("n_true")).alias("wp"),
                (F.sum(F.col("recall") * F.col("n_true")) / F.sum("n_true")).alias("wr"),
                (F.sum(F.col("f1") * F.col("n_true")) / F.sum("n_true")).alias("wf"))
    rows = F.array(
        F.struct(F.lit("accuracy").alias("row"), F.lit(None).cast("double").alias("precision"),
                 F.lit(None).cast("double").alias("recall"),
                 (F.col("tp") / F.col("n")).alias("f1"), F.col("n").alias("support")),
        F.struct(F.lit("macro avg").alias("row"), F.col("mp").alias("precision"),
                 F.col("mr").alias("recall"), F.col("mf").alias("f1"), F.col("n").alias("support")),
        F.struct(F.lit("weighted avg").alias("row"), F.col("wp").alias("precision"),
                 F.col("wr").alias("recall"), F.col("wf").alias("f1"), F.col("n").alias("support")))
    return per.unionByName(tot.select(F.explode(rows).alias("r")).select("r.*"))


#: Classes of one block of the class list.
CLASS_BLOCK = 1000


def confusion_matrix(df: DataFrame | None, label_col: str = "label", pred_col: str = "prediction",
                     counts: DataFrame | None = None) -> DataFrame:
    """label, prediction, count over the union of classes; zero cells kept. The class list is
    dealt to blocks of about CLASS_BLOCK; every class meets every block once, so no row or
    task holds all classes. A null label or prediction is a class of its own."""
    c = counts if counts is not None else cells(df, label_col, pred_col)
    name = lambda x: F.struct(F.col(x).isNull().alias("none"), F.col(x).alias("name"))
    classes = c.select(F.explode(F.array(name("label"), name("prediction"))).alias("c")).distinct()
    blocks = max(1, -(-classes.count() // CLASS_BLOCK))
    listed = classes.groupBy(F.pmod(F.xxhash64("c"), F.lit(blocks)).alias("_block")).agg(F.collect_list("c").alias("_known"))
    grid = (classes.select("c", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("_block"))
            .join(listed, "_block").select("c", F.explode("_known").alias("p"))
            .select(F.col("c.name").alias("label"), F.col("p.name").alias("prediction"), F.lit(0).cast("long").alias("count")))
    return (grid.unionByName(c.select("label", "prediction", "count")).groupBy("label", "prediction")
            .agg(F.sum("count").alias("count")))


def evaluate(df: DataFrame, label_col: str, pred_col: str) -> DataFrame:
    """The evaluation bundle as one table, from one count table: ``section`` 'matrix' (row =
    label, col = prediction, value = count), 'class' and 'average' (row = class or
    average, col = precision / recall / f1 / support) and 'macro' (col = n, accuracy and
    the macro means)."""
    c = cells(df, label_col, pred_col)
    cm = confusion_matrix(None, counts=c).select(
        F.lit("matrix").alias("section"), F.col("label").alias("row"), F.col("prediction").alias("col"),
        F.col("count").cast("double").alias("value"))
    rep = (classification_report(None, counts=c).withColumn("support", F.col("support").cast("double"))
           .unpivot(["row"], ["precision", "recall", "f1", "support"], "col", "value")
           .select(F.when(F.col("row").isin("accuracy", "macro avg", "weighted avg"), "average").otherwise("class")
                   .alias("section"), "row", "col", "value").where(F.col("value").isNotNull()))
    mac = (macro_metrics(None, counts=c).withColumn("n", F.col("n").cast("double"))
           .unpivot([], ["n", "accuracy", "precision_macro", "recall_macro", "f1_macro"], "col", "value")
           .select(F.lit("macro").alias("section"), F.lit("all").alias("row"), "col", "value"))
    return cm.unionByName(rep).unionByName(mac)


def confusion_matrix_norm(cm: DataFrame) -> DataFrame:
    """Add row_total, share (count / row total; null for a label never true) and
    the cell text '12.3%\\n(45)'. The window runs over the matrix (classes^2 rows)."""
    tot = F.sum("count").over(Window.partitionBy("label"))
    out = cm.withColumn("row_total", tot).withColumn(
        "share", F.try_divide(F.col("count").cast("double"), F.col("row_total").cast("double")))
    text = F.concat(F.format_string("%.1f%%", F.round(F.col("share") * 100.0, 1)),
                    F.lit("\n("), F.col("count").cast("string"), F.lit(")"))
    return out.withColumn("cell_text", text)


def train_test_gap(scored_train: DataFrame, scored_test: DataFrame, label_col: str,
                   pred_col: str, limit: float = 0.05) -> DataFrame:
    """train_score, test_score (accuracy), gap, is_overfitting (gap > limit) in one
    aggregate over the tagged union of both sides."""
    hit = (q(label_col).cast("string") == q(pred_col).cast("string")).cast("double")
    u = (scored_train.select(F.lit("train").alias("side"), hit.alias("hit"))
         .unionByName(scored_test.select(F.lit("test").alias("side"), hit.alias("hit"))))
    r = u.agg(F.avg(F.when(F.col("side") == "train", F.col("hit"))).alias("train_score"),
              F.avg(F.when(F.col("side") == "test", F.col("hit"))).alias("test_score"))
    return (r.withColumn("gap", F.col("train_score") - F.col("test_score"))
            .withColumn("is_overfitting", F.col("gap") > F.lit(limit)))


def fold_summary(scores: DataFrame, metrics: Sequence[str], by: Sequence[str] = ()
                 ) -> DataFrame:
    """by..., metric, mean, std (population), n_folds: one row per metric."""
    by = list(by)
    long = scores.select(*by, *metrics).unpivot(by, list(metrics), "metric", "score")
    return long.groupBy(*by, "metric").agg(
        F.coalesce(F.avg("score"), F.lit(0.0)).alias("mean"),
        F.coalesce(F.stddev_pop("score"), F.lit(0.0)).alias("std"),
        F.count(F.lit(1)).alias("n_folds"))


class MacroEvaluator(Evaluator):
    """Spark ML evaluator for accuracy / macro precision / recall / F1 (Spark's
    own evaluator offers weighted F1 only). Labels and predictions are compared
    as they are (index doubles or strings)."""

    def __init__(self, labelCol: str = "label", predictionCol: str = "prediction",
                 metricName: str = "f1_macro"):
        super().__init__()
        self.labelCol, self.predictionCol, self.metricName = labelCol, predictionCol, metricName

    def _evaluate(self, dataset: DataFrame) -> float:
        row = macro_metrics(dataset, self.labelCol, self.predictionCol).first()
        key = {"f1_macro": "f1_macro", "precision_macro": "precision_macro",
               "recall_macro": "recall_macro", "accuracy": "accuracy"}[self.metricName]
        return float(row[key]) if row is not None and row[key] is not None else 0.0

    def isLargerBetter(self) -> bool:
        return True
