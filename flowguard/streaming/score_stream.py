"""Scoring a stream with a saved model: the rows of a micro-batch with their prediction, and a
summary that grows with them.

Micro-batch ``e`` writes folders of its own (``rows/epoch=e`` as CSV, ``counts/epoch=e``), which a
replay overwrites, so every row counts once; the summary adds up the counts of all epochs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowguard.operators import models, profile
from flowguard.operators.jobs import score_frame
from flowguard.sources import files


def start_score_job(stream: DataFrame, model_path: str, out_path: str, checkpoint_path: str,
                    features: Sequence[str] | None = None, available_now: bool = True):
    """Start the scoring query; returns the StreamingQuery. The arguments and errors are those of
    ``jobs.score_job``; ``stream`` is the streaming table."""
    model, _ = models.load_model(model_path)
    score_frame(model, stream, features)        # a missing column is an error before the start
    spark = stream.sparkSession

    def per_batch(batch: DataFrame, epoch_id: int) -> None:
        staged = files.scratch_path(spark, "scored")
        score_frame(model, batch, features).write.parquet(staged)       # scored once
        scored = spark.read.parquet(staged)
        files.write_csv(scored, f"{out_path}/rows/epoch={epoch_id}")
        scored.groupBy("prediction").count().write.mode("overwrite").parquet(f"{out_path}/counts/epoch={epoch_id}")

    writer = stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint_path)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()


def running_summary(spark: SparkSession, out_path: str) -> DataFrame:
    """The prediction summary of all rows scored so far: as ``profile.prediction_summary`` of
    the whole table."""
    return profile.summary_of_counts(
        spark.read.parquet(f"{out_path}/counts").groupBy("prediction").agg(F.sum("count").alias("count")), "prediction")


def scored_rows(spark: SparkSession, out_path: str, schema) -> DataFrame:
    """The rows of all epochs with their prediction."""
    return spark.read.schema(schema).option("header", True).option("recursiveFileLookup", True).csv(f"{out_path}/rows")
