"""Whole jobs made of the operators: scoring a table or a folder of CSV files, and the
prepared training bundle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowguard.functions.columns import q
from flowguard.operators import models, profile, split, validate
from flowguard.sources import files


def score_frame(model: PipelineModel, data: DataFrame, features: Sequence[str] | None = None) -> DataFrame:
    """The input's columns and ``prediction``; batch or stream. Something that is no
    DataFrame is a TypeError, a missing feature column a ValueError."""
    if not isinstance(data, DataFrame):
        raise TypeError(f"expected a DataFrame, got {type(data).__name__}")
    missing = [f for f in features or [] if f not in data.columns]
    if missing:
        raise ValueError(f"missing feature columns: {missing}")
    return models.score(model, data).select(*[q(c) for c in data.columns], F.col(models.PRED_LABEL).alias("prediction"))


def score_job(spark: SparkSession, model_path: str, source: str | DataFrame, out_path: str,
              schema: T.StructType | None = None, features: Sequence[str] | None = None
              ) -> tuple[DataFrame, DataFrame]:
    """(scored table, prediction summary): load the model, score a folder of CSV files or
    a table, write the rows with their prediction as CSV to ``out_path``. The
    rows are scored once, into Parquet beside the CSV; summary and result read that. A
    missing model or folder is a FileNotFoundError."""
    model, _ = models.load_model(model_path)
    data = files.load_csv_files(spark, source, schema=schema, keep_source=False) if isinstance(source, str) else source
    staged = files.scratch_path(spark, "scored")
    score_frame(model, data, features).write.parquet(staged)
    scored = spark.read.parquet(staged)
    files.write_csv(scored, out_path)
    return scored, profile.prediction_summary(scored, "prediction")


def prepare_bundle(df: DataFrame, key_col: str, label_col: str, features: Sequence[str], path: str,
                   test_size: float = 0.3, seed: int = 42, n_trees: int = 100, max_depth: int = 15
                   ) -> tuple[DataFrame, PipelineModel]:
    """(prepared table, fitted pipeline): stratified split, features kept by importance
    (fitted on train), population scaling (fitted on train). The table goes to
    ``path/data`` by split, the fitted assembler and scaler to ``path/pipeline``, the names of
    the kept features to ``path/features``."""
    from pyspark.storagelevel import StorageLevel
    spark = df.sparkSession
    sp = split.stratified_split(df, label_col, key_col, test_size, seed).persist(StorageLevel.MEMORY_AND_DISK)
    train = sp.where(F.col("split") == "train")
    imp = validate.select_by_importance(train, label_col, features, n_trees, max_depth, seed)
    keep = [r["feature"] for r in imp.where("selected").collect()]
    fitted = Pipeline(stages=[VectorAssembler(inputCols=keep, outputCol="raw_features", handleInvalid="keep"),
                              models.PopulationScaler(inputCol="raw_features", outputCol="features")]).fit(train)
    fitted.write().overwrite().save(f"{path}/pipeline")
    spark.createDataFrame([(f,) for f in keep], "feature string").write.mode("overwrite").parquet(f"{path}/features")
    scaled = fitted.transform(sp).withColumn("_x", vector_to_array("features"))
    files.write_parquet(scaled.select(q(key_col), *[F.col("_x")[i].alias(f) for i, f in enumerate(keep)],
                                      q(label_col), "split"), f"{path}/data", ["split"])
    sp.unpersist()
    return files.read_parquet(spark, f"{path}/data"), fitted


def load_bundle(spark: SparkSession, path: str) -> tuple[DataFrame, PipelineModel]:
    return files.read_parquet(spark, f"{path}/data"), PipelineModel.load(f"{path}/pipeline")
