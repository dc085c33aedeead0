"""Drift on a stream: every batch (e.g. day) is compared with the reference by the batch
operators, however its rows are dealt to micro-batches.

The state is two count tables that add up: (batch, feature, value) and (batch, class). A
micro-batch writes its own counts to ``state/.../epoch=e``, adds those of earlier epochs for the
batches it touches, and reports these batches from the sums. ``read_reports`` gives one row a
batch (and feature), that of its last epoch. Every ``compact_every`` epochs the sums are
written as one table, so a report reads one such table and the few epochs after it.

Replays are idempotent: what micro-batch ``e`` writes lives in folders of its own, which are
overwritten, and it reads only epochs up to ``e`` and compacted tables before it. The
reference is reduced once to its points and class counts. All of it lies in the given
folders on shared storage, beside the stream's checkpoint.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowguard.functions.columns import q
from flowguard.operators.drift import (batch_classes, batch_points, chi2_of_counts, class_count_table, drift_summary,
                                       ks_of_counts, reference_points)
from flowguard.plans.joins import checked_broadcast
from flowguard.session import checkpointed


def batch_report(ks: DataFrame, chi: DataFrame | None, batch_col: str) -> DataFrame:
    """One row per batch: data drift, prediction drift (null without labels) and
    needs_retraining, either of them."""
    out = drift_summary(ks, batch_col).select(
        batch_col, "n_features", "n_drifted", "drift_ratio", F.col("has_drift").alias("data_drift"))
    if chi is None:
        return out.withColumns({"chi2_statistic": F.lit(None).cast("double"), "chi2_p_value": F.lit(None).cast("double"),
                                "prediction_drift": F.lit(None).cast("boolean"), "needs_retraining": F.col("data_drift")})
    return out.join(chi.select(batch_col, F.col("statistic").alias("chi2_statistic"),
                               F.col("p_value").alias("chi2_p_value"), F.col("has_drift").alias("prediction_drift")),
                    batch_col, "left").withColumn(
        "needs_retraining", F.col("data_drift") | F.coalesce("prediction_drift", F.lit(False)))


class CountState:
    """A count table that grows by epochs: ``add`` writes an epoch's counts and returns the sums
    up to it for the batches it touches."""

    def __init__(self, spark: SparkSession, path: str, batch_col: str, keys: Sequence[str], count: str,
                 compact_every: int = 20):
        self.spark, self.path, self.batch_col = spark, path, batch_col
        self.keys, self.count, self.compact_every = [batch_col, *keys], count, compact_every

    def _folders(self, kind: str) -> list[int]:
        """Numbers of the complete folders of a kind; one row an epoch, compacted ones replace them."""
        root = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        fs = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        found = fs.globStatus(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{kind}=*/_SUCCESS"))
        return sorted(int(f.getPath().getParent().getName().split("=")[1]) for f in found or [])

    def upto(self, epoch: int) -> DataFrame | None:
        """Sums of all epochs up to ``epoch``: the last compacted table before it and the
        epochs after that."""
        base = max((n for n in self._folders("upto") if n < epoch), default=None)
        paths = [f"{self.path}/epoch={n}" for n in self._folders("epoch") if n <= epoch and (base is None or n > base)]
        if base is not None:
            paths.append(f"{self.path}/upto={base}")
        if not paths:
            return None
        return self.spark.read.parquet(*paths).groupBy(*self.keys).agg(F.sum(self.count).alias(self.count))

    def add(self, epoch: int, counts: DataFrame, touched: DataFrame) -> DataFrame:
        # sorted by batch, so that the row groups of other batches are not read
        counts.sortWithinPartitions(self.batch_col).write.mode("overwrite").parquet(f"{self.path}/epoch={epoch}")
        if (epoch + 1) % self.compact_every == 0:
            (self.upto(epoch).sortWithinPartitions(self.batch_col)
             .write.mode("overwrite").parquet(f"{self.path}/upto={epoch}"))
        return self.upto(epoch).join(checked_broadcast(touched), self.batch_col, "left_semi")


def start_drift_stream(stream: DataFrame, reference: DataFrame, features: Sequence[str],
                       batch_col: str, report_path: str, checkpoint_path: str,
                       threshold: float = 0.05, available_now: bool = True, label_col: str | None = None,
                       compact_every: int = 20):
    """Start the query; returns the StreamingQuery. Feature reports go to
    ``report_path/features``, batch reports to ``report_path/batches``, counts to
    ``report_path/state``. Rows without a batch belong to none and are left out."""
    points = checkpointed(reference_points(reference, features))
    classes = checkpointed(class_count_table(reference, label_col)) if label_col else None
    spark = stream.sparkSession
    point_state = CountState(spark, f"{report_path}/state/points", batch_col, ["feature", "value"], "cc", compact_every)
    class_state = CountState(spark, f"{report_path}/state/classes", batch_col, ["label"], "cur_count", compact_every)

    def per_batch(batch: DataFrame, epoch_id: int) -> None:
        batch = batch.where(q(batch_col).isNotNull()).persist()
        touched = checkpointed(batch.select(q(batch_col).alias(batch_col)).distinct())
        if touched.isEmpty():
            batch.unpersist()
            return
        counts = checkpointed(point_state.add(epoch_id, batch_points(batch, features, batch_col), touched))
        ks = checkpointed(ks_of_counts(points, counts, touched, features, batch_col, threshold))
        chi = None
        if label_col:
            counts = class_state.add(epoch_id, batch_classes(batch, label_col, batch_col), touched)
            chi = chi2_of_counts(classes, checkpointed(counts), batch_col, threshold)
        ks.write.mode("overwrite").parquet(f"{report_path}/features/epoch={epoch_id}")
        batch_report(ks, chi, batch_col).write.mode("overwrite").parquet(f"{report_path}/batches/epoch={epoch_id}")
        batch.unpersist()

    writer = (stream.writeStream.foreachBatch(per_batch)
              .option("checkpointLocation", checkpoint_path))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="30 seconds")
    return writer.start()


def read_reports(spark: SparkSession, report_path: str, kind: str = "features", batch_col: str | None = None) -> DataFrame:
    """Reports of a stream: with ``batch_col`` the last of every batch (and feature), which counts
    all its rows; without, those of all epochs."""
    rows = spark.read.parquet(f"{report_path}/{kind}")
    if batch_col is None:
        return rows
    keys = [batch_col, "feature"] if kind == "features" else [batch_col]
    # report rows only: one for each (batch, feature) and epoch that touched the batch
    last = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("epoch")))
    return rows.withColumn("_nr", last).where("_nr = 1").drop("_nr", "epoch")
