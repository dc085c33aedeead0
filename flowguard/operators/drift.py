"""Feature drift (two-sample KS) and prediction drift (chi-square of class counts).

Batch form: one job compares a reference table with any number of batches at
once; ``batch_col`` is just another grouping key. The reference is never crossed
with the batches: its running counts are computed once over all distinct points
and each batch point looks them up by an equi-join (see ``ks_drift``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowguard.functions.columns import ks_pvalue, q
from flowguard.functions.stats import EXACT_ROWS, chi2_sf, ks_exact_sf
from flowguard.plans.joins import checked_broadcast
from flowguard.plans.prefix import running_sum
from flowguard.session import checkpointed

_BATCH = "_fg_batch"


def to_long(df: DataFrame, features: Sequence[str], id_cols: Sequence[str] = (),
            feature_col: str = "feature", value_col: str = "value") -> DataFrame:
    """Unpivot feature columns to (id_cols..., feature, value double); nulls and
    NaN are left out (the reference cleans them before any test)."""
    if not features:
        raise ValueError("no feature columns given")
    cols = [q(c) for c in id_cols] + [q(f).cast("double").alias(f) for f in features]
    long = df.select(*cols).unpivot(list(id_cols), list(features), feature_col, value_col)
    return long.where(F.col(value_col).isNotNull() & ~F.isnan(value_col))


def reference_points(reference: DataFrame, features: Sequence[str]) -> DataFrame:
    """feature, value, rc: how often each value occurs in the reference. Built once and
    kept (checkpointed or written), it stands for the reference in every later check."""
    return to_long(reference, features).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("rc"))


def batch_points(current: DataFrame, features: Sequence[str], batch_col: str) -> DataFrame:
    """batch, feature, value, cc: how often each value occurs in each batch. Counts of parts of
    a batch add up to those of the batch."""
    return to_long(current, features, id_cols=[batch_col]).groupBy(batch_col, "feature", "value").agg(
        F.count(F.lit(1)).alias("cc"))


def ks_drift(reference: DataFrame, current: DataFrame, features: Sequence[str],
             batch_col: str | None = None, threshold: float = 0.05,
             method: str = "ks", prefix_method: str = "blocks",
             ref_points: DataFrame | None = None) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov test of every feature, per batch.

    Returns [batch_col,] feature, n_ref, n_cur, statistic, p_value, is_drifted. A
    feature without values on one side of a batch has count 0 there, a null
    statistic and p-value, and no drift. ``ref_points`` (see ``reference_points``) spares
    the pass over the reference. The p-value is exact up to ``EXACT_ROWS`` rows a side and the
    limit's beyond.
    """
    if method != "ks":
        raise ValueError(f"unsupported drift method: {method}")
    b = batch_col or _BATCH
    cur = current if batch_col else current.withColumn(b, F.lit(0))
    cur = cur.where(q(b).isNotNull())   # a null batch key has no batch to report
    ref_pts = ref_points if ref_points is not None else reference_points(reference, features)
    out = ks_of_counts(ref_pts, batch_points(cur, features, b), cur.select(q(b).alias(b)).distinct(), features, b,
                       threshold, prefix_method)
    return out if batch_col else out.drop(b)


def ks_of_counts(ref_pts: DataFrame, cur_pts: DataFrame, batches: DataFrame, features: Sequence[str], b: str,
                 threshold: float = 0.05, prefix_method: str = "blocks") -> DataFrame:
    """``ks_drift`` from count tables: of the reference (feature, value, rc) and of the batches
    (batch, feature, value, cc); ``batches`` lists those to report.

    D = sup |F_ref - F_cur|. F_cur is flat between consecutive points c_j of the
    batch and F_ref never falls, so the sup is reached at some c_j, either at the
    point (F_ref(c_j) vs F_cur(c_j)) or just before it (F_ref(c_j-) vs
    F_cur(c_{j-1})). Running reference counts are therefore needed only at the
    union of points, computed once for all batches.
    """
    pts = (ref_pts.unionByName(cur_pts.select("feature", "value",
                                              F.lit(0).cast("long").alias("rc")))
           .groupBy("feature", "value").agg(F.sum("rc").alias("rc")))

    # both running counts in one distributed prefix pass: the reference points
    # form one group per feature (null batch), each batch one group per feature
    both = (pts.select(F.lit(None).cast(cur_pts.schema[b].dataType).alias(b), "feature",
                       "value", F.col("rc").alias("w"))
            .unionByName(cur_pts.select(b, "feature", "value", F.col("cc").alias("w"))))
    cdf = running_sum(both, ["value"], [b, "feature"], weight="w", out="le",
                      method=prefix_method)
    ref_cdf = cdf.where(F.col(b).isNull()).select(
        "feature", "value", F.col("le").alias("ref_le"),
        (F.col("le") - F.col("w")).alias("ref_lt"))
    cur_cdf = cdf.where(F.col(b).isNotNull()).select(
        b, "feature", "value", F.col("w").alias("cc"), F.col("le").alias("cur_le"),
        (F.col("le") - F.col("w")).alias("cur_prev"))
    # one row per feature, and per (batch, feature): the totals are joined to points by
    # broadcast where counted small (the points of a feature share one key)
    n_ref = F.broadcast(ref_pts.groupBy("feature").agg(F.sum("rc").alias("n_ref")))
    n_cur = checkpointed(cur_pts.groupBy(b, "feature").agg(F.sum("cc").alias("n_cur")))

    gap = F.greatest(
        F.abs(F.col("ref_le") / F.col("n_ref") - F.col("cur_le") / F.col("n_cur")),
        F.abs(F.col("ref_lt") / F.col("n_ref") - F.col("cur_prev") / F.col("n_cur")))
    stat = (cur_cdf.join(ref_cdf, ["feature", "value"])
            .join(n_ref, "feature").join(checked_broadcast(n_cur), [b, "feature"])
            .groupBy(b, "feature").agg(F.max(gap).alias("statistic")))
    # a row for every feature of every batch, with or without values
    every = batches.withColumn("feature", F.explode(F.array(*[F.lit(f) for f in features])))
    stat = (every.join(n_ref, "feature", "left").join(n_cur, [b, "feature"], "left")
            .join(stat, [b, "feature"], "left").na.fill(0, ["n_ref", "n_cur"]))
    few = F.greatest("n_ref", "n_cur") <= EXACT_ROWS
    exact = ks_exact_sf(F.when(few, F.col("statistic")), F.col("n_ref"), F.col("n_cur"))
    p = F.when(few, exact).otherwise(ks_pvalue("statistic", "n_ref", "n_cur"))
    return stat.select(
        F.col(b), "feature", F.col("n_ref").cast("long").alias("n_ref"),
        F.col("n_cur").cast("long").alias("n_cur"), "statistic",
        F.when(F.col("statistic").isNotNull(), p).alias("p_value")).withColumn(
            "is_drifted", F.coalesce(F.col("p_value") < F.lit(threshold), F.lit(False)))


def drift_summary(ks: DataFrame, batch_col: str | None = None) -> DataFrame:
    """Per batch: n_features, n_drifted, drift_ratio, has_drift, drifted_features
    (sorted names)."""
    keys = [batch_col] if batch_col else []
    return (ks.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_features"),
        F.sum(F.col("is_drifted").cast("long")).alias("n_drifted"),
        F.array_sort(F.collect_list(F.when(F.col("is_drifted"), F.col("feature"))))
        .alias("drifted_features"))
        .withColumn("drift_ratio", F.col("n_drifted") / F.col("n_features"))
        .withColumn("has_drift", F.col("n_drifted") > 0))


def class_count_table(reference: DataFrame, label_col: str) -> DataFrame:
    return reference.groupBy(q(label_col).alias("label")).agg(F.count(F.lit(1)).alias("ref_count"))


def batch_classes(current: DataFrame, label_col: str, batch_col: str) -> DataFrame:
    """batch, label, cur_count; counts of parts of a batch add up."""
    return current.groupBy(q(batch_col).alias(batch_col), q(label_col).alias("label")).agg(
        F.count(F.lit(1)).alias("cur_count"))


def _present(ref_counts: DataFrame, cur_counts: DataFrame, b: str) -> tuple[DataFrame, int, int]:
    """The (batch, class) cells with rows: counts of both sides, the batch's total and whether
    the class is new; and rows and classes of the reference."""
    ref_counts = checkpointed(ref_counts)
    size = ref_counts.agg(F.sum("ref_count").alias("n"), F.count(F.lit(1)).alias("k")).first()
    if not size["n"]:
        raise ValueError("reference side is empty")
    totals = cur_counts.groupBy(F.col(b).alias("_b")).agg(F.sum("cur_count").alias("cur_total"))
    ref = ref_counts.select(F.col("label").alias("_label"), "ref_count")
    cells = (cur_counts.join(ref, F.col("label").eqNullSafe(F.col("_label")), "left")
             .join(totals, F.col(b).eqNullSafe(F.col("_b"))).select(
                 b, "label", "cur_count", "cur_total", F.coalesce("ref_count", F.lit(0)).alias("ref_count"),
                 F.col("ref_count").isNull().alias("is_new")))
    return cells, int(size["n"]), int(size["k"])


#: Classes of one block of the class list.
CLASS_BLOCK = 1000


def class_shift_counts(reference: DataFrame, current: DataFrame, label_col: str,
                       batch_col: str | None = None, ref_counts: DataFrame | None = None) -> DataFrame:
    """Counts and shares of each class on both sides over the union of classes.

    With ``batch_col`` every batch is compared with the whole reference. Both sides are
    counted first; everything after works on one row per (batch, class). A class of the
    reference missing from a batch still gets a row (count 0): the class list is dealt to blocks
    of about CLASS_BLOCK and each batch meets every block. A null label is a class
    like any other, on both sides. ``ref_counts`` (label, ref_count) may be given to
    spare the pass over the reference.
    """
    b = batch_col or _BATCH
    cur = current if batch_col else current.withColumn(b, F.lit(0))
    if ref_counts is None:
        ref_counts = class_count_table(reference, label_col)
    ref_counts = checkpointed(ref_counts)
    cur_counts = checkpointed(batch_classes(cur, label_col, b))
    cells, total, classes = _present(ref_counts, cur_counts, b)
    blocks = -(-classes // CLASS_BLOCK)
    block = F.pmod(F.xxhash64(F.coalesce(F.col("label").cast("string"), F.lit(""))), F.lit(blocks)).alias("_block")
    listed = ref_counts.groupBy(block).agg(F.collect_list(F.struct("label", "ref_count")).alias("_classes"))
    batches = cur_counts.groupBy(b).agg(F.sum("cur_count").alias("cur_total"))
    zero = (batches.select(b, "cur_total", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("_block"))
            .join(listed, "_block").select(b, "cur_total", F.explode("_classes").alias("_c"))
            .select(b, F.col("_c.label").alias("label"), F.col("_c.ref_count").alias("ref_count"),
                    F.lit(0).cast("long").alias("cur_count"), "cur_total"))
    new = cells.where("is_new").select(b, "label", "ref_count", "cur_count", "cur_total")
    seen = cells.where(~F.col("is_new")).select(b, "label", F.lit(0).cast("long").alias("ref_count"), "cur_count", "cur_total")
    out = (zero.unionByName(seen).unionByName(new).groupBy(b, "label").agg(
        F.sum("ref_count").alias("ref_count"), F.sum("cur_count").alias("cur_count"), F.max("cur_total").alias("cur_total"))
        .withColumn("ref_share", F.col("ref_count") / F.lit(float(total)))
        .withColumn("cur_share", F.col("cur_count") / F.col("cur_total"))
        .select(b, "label", "ref_count", "cur_count", "ref_share", "cur_share", "cur_total"))
    return out if batch_col else out.drop(b)


def chi2_drift(reference: DataFrame, current: DataFrame, label_col: str,
               batch_col: str | None = None, threshold: float = 0.05,
               ref_counts: DataFrame | None = None) -> DataFrame:
    """Chi-square test of the batch's class counts against the reference shares.

    expected = ref_share * batch total (0 -> 1e-10, so a class new to the batch
    gives a huge statistic); dof = classes - 1. A single class has no test:
    p_value null and no drift.
    """
    b = batch_col or _BATCH
    cur = current if batch_col else current.withColumn(b, F.lit(0))
    if ref_counts is None:
        ref_counts = class_count_table(reference, label_col)
    res = chi2_of_counts(ref_counts, batch_classes(cur, label_col, b), b, threshold)
    return res if batch_col else res.drop(b)


def chi2_of_counts(ref_counts: DataFrame, cur_counts: DataFrame, b: str, threshold: float = 0.05) -> DataFrame:
    """``chi2_drift`` from count tables (label, ref_count) and (batch, label, cur_count).

    Only cells with rows are formed. A class that a batch lacks adds its expected count, and
    those of all such classes are the batch's total times the share of the reference that
    lies in classes the batch lacks.
    """
    cells, n, classes = _present(ref_counts, cur_counts, b)
    exp = F.when(F.col("is_new"), F.lit(1e-10)).otherwise(F.col("ref_count") / F.lit(float(n)) * F.col("cur_total"))
    res = cells.groupBy(b).agg(
        (F.lit(classes) + F.count_if("is_new")).alias("n_classes"),
        (F.sum(F.pow(F.col("cur_count") - exp, 2) / exp)
         + F.max("cur_total") * ((F.lit(n) - F.sum("ref_count")) / F.lit(float(n)))).alias("statistic"))
    res = res.withColumn("dof", (F.col("n_classes") - 1).cast("long"))
    return (res.withColumn("p_value", F.when(F.col("dof") > 0, chi2_sf(F.col("statistic"), F.col("dof"))))
            .withColumn("has_drift", F.coalesce(F.col("p_value") < F.lit(threshold), F.lit(False))))


class DriftMonitor:
    """Batch-by-batch drift checks against a fixed reference table.

    ``check`` returns a one-row report (batch number from 1, data drift summary,
    prediction drift when a label column is given, needs_retraining = either).
    Reports are appended to ``history_path`` (Parquet, one folder per batch
    number, so a batch repeated under its ``batch_id`` replaces itself) and kept as small
    one-row DataFrames. A monitor on an existing history goes on after its last number.
    """

    def __init__(self, reference: DataFrame, features: Sequence[str],
                 label_col: str | None = None, data_threshold: float = 0.05,
                 prediction_threshold: float = 0.05, history_path: str | None = None):
        self.features = list(features)
        self.label_col = label_col
        self.data_threshold = data_threshold
        self.prediction_threshold = prediction_threshold
        self.history_path = history_path
        self.history: list[DataFrame] = []
        self.spark = reference.sparkSession
        # the reference is read once; every check uses these two tables
        self.points = checkpointed(reference_points(reference, self.features))
        self.classes = (checkpointed(class_count_table(reference, label_col))
                        if label_col and label_col in reference.columns else None)
        self.next_number = self._last_number() + 1

    def _last_number(self) -> int:
        """The highest batch number in the history folder, 0 if there is none."""
        if not self.history_path:
            return 0
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.history_path)
        if not path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            return 0
        last = self.spark.read.parquet(self.history_path).agg(F.max("batch_number")).first()[0]
        return int(last or 0)

    def check(self, current: DataFrame, with_labels: bool = True, batch_id: int | None = None) -> DataFrame:
        n = batch_id if batch_id is not None else self.next_number
        self.next_number = max(self.next_number, n + 1)
        ks = ks_drift(None, current, self.features, threshold=self.data_threshold, ref_points=self.points)
        summ = drift_summary(ks).select(
            F.lit(n).alias("batch_number"), "n_features", "n_drifted", "drift_ratio",
            F.col("has_drift").alias("data_drift"),
            F.array_join("drifted_features", ",").alias("drifted_features"))
        use_labels = with_labels and self.classes is not None and self.label_col in current.columns
        row = summ.first().asDict()          # one row per side, assembled on the driver
        chi = (chi2_drift(None, current, self.label_col, threshold=self.prediction_threshold,
                          ref_counts=self.classes).first() if use_labels else None)
        row["chi2_statistic"] = float(chi["statistic"]) if chi else None
        row["chi2_p_value"] = (float(chi["p_value"]) if chi and chi["p_value"] is not None
                               else None)
        row["prediction_drift"] = bool(chi["has_drift"]) if chi else None
        row["needs_retraining"] = bool(row["data_drift"]) or bool(row["prediction_drift"])
        rep = current.sparkSession.createDataFrame(
            [row], "batch_number int, n_features long, n_drifted long, drift_ratio double, "
                   "data_drift boolean, drifted_features string, chi2_statistic double, "
                   "chi2_p_value double, prediction_drift boolean, needs_retraining boolean")
        if self.history_path:
            rep.drop("batch_number").write.mode("overwrite").parquet(f"{self.history_path}/batch_number={n}")
        self.history.append(rep)
        return rep
