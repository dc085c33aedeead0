"""Model pipelines on Spark ML: label indexing, feature assembly, population-std
scaling, the learners the reference uses, scoring, class probabilities, and
saving / loading with metadata.

Logistic regression is MLlib's, forests are ``operators/forest.py``, joint boosting is ``operators/boosting.py``;
this module is the table work around them. Labels are indexed in sorted order (as the reference's library sorts classes) and mapped
back to names after prediction.
"""

from __future__ import annotations

import datetime as _dt
import json
from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IndexToString, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param.shared import HasInputCol, HasOutputCol, Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowguard.functions.columns import q
from flowguard.operators.boosting import SoftmaxBoosting
from flowguard.operators.forest import Forest

LABEL_IDX = "label_idx"
FEATURES = "features"
PRED = "prediction"
PRED_LABEL = "predicted_label"


# ------------------------------------------------------------ population scaler

class _ScalerParams(HasInputCol, HasOutputCol):
    mean = Param(Params._dummy(), "mean", "per-feature mean", TypeConverters.toListFloat)
    scale = Param(Params._dummy(), "scale", "per-feature population std (0 -> 1)",
                  TypeConverters.toListFloat)


class PopulationScalerModel(Model, _ScalerParams, DefaultParamsReadable, DefaultParamsWritable):
    """(x - mean) / std with fitted lists; an array expression on the vector, JVM-side."""

    @keyword_only
    def __init__(self, inputCol=None, outputCol=None, mean=None, scale=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        mean = F.array(*[F.lit(float(x)) for x in self.getOrDefault(self.mean)])
        scale = F.array(*[F.lit(float(x)) for x in self.getOrDefault(self.scale)])
        arr = vector_to_array(F.col(self.getInputCol()))
        scaled = F.transform(arr, lambda x, i: (x - F.element_at(mean, i + 1))
                             / F.element_at(scale, i + 1))
        return dataset.withColumn(self.getOutputCol(), array_to_vector(scaled))


class PopulationScaler(Estimator, _ScalerParams, DefaultParamsReadable, DefaultParamsWritable):
    """Standardise with the population std (ddof 0); Spark's StandardScaler uses
    the sample std. Fitting is one aggregate of the vector's moments."""

    @keyword_only
    def __init__(self, inputCol=None, outputCol=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> PopulationScalerModel:
        from pyspark.ml.stat import Summarizer
        row = dataset.select(Summarizer.metrics("mean", "variance", "count")
                             .summary(F.col(self.getInputCol())).alias("s")).first()["s"]
        n = float(row["count"])
        mean = [float(x) for x in row["mean"]]
        var = [float(v) * (n - 1) / n if n > 1 else 0.0 for v in row["variance"]]
        scale = [v ** 0.5 if v > 0 else 1.0 for v in var]
        return PopulationScalerModel(inputCol=self.getInputCol(), outputCol=self.getOutputCol(),
                                     mean=mean, scale=scale)


# ------------------------------------------------------------ learners

def make_estimator(kind: str, n_rows: int | None = None, **p):
    """Learners of the reference (see README for the mapping)."""
    common = {"featuresCol": p.pop("featuresCol", FEATURES), "labelCol": LABEL_IDX}
    if kind == "logreg":
        c = p.pop("C", 1.0)
        reg = 1.0 / (c * n_rows) if n_rows else 0.0
        return LogisticRegression(family="multinomial", maxIter=p.pop("maxIter", 1000),
                                  regParam=reg, elasticNetParam=0.0, standardization=False,
                                  **common, **p)
    if kind == "forest":
        return Forest(**{"numTrees": 100, "maxDepth": 15, "featureSubsetStrategy": "sqrt", "seed": 42, **common, **p})
    if kind == "boosting":
        return SoftmaxBoosting(**{"maxIter": 100, "maxDepth": 3, "stepSize": 0.1, "seed": 42, **common, **p})
    raise ValueError(f"unknown model kind: {kind}")


def head_stages(features: Sequence[str], label_col: str, scale: bool = False) -> list:
    """indexer -> assembler -> [population scaler]: what comes before a learner."""
    stages = [StringIndexer(inputCol=label_col, outputCol=LABEL_IDX, stringOrderType="alphabetAsc"),
              VectorAssembler(inputCols=list(features), outputCol="raw_features" if scale else FEATURES,
                              handleInvalid="keep")]
    if scale:
        stages.append(PopulationScaler(inputCol="raw_features", outputCol=FEATURES))
    return stages


def fit_pipeline(train: DataFrame, features: Sequence[str], label_col: str, estimator,
                 scale: bool = False) -> PipelineModel:
    """indexer -> assembler -> [population scaler] -> learner -> index-to-name."""
    if label_col not in train.columns:
        raise ValueError(f"target column {label_col!r} not found; columns: {train.columns}")
    fitted = Pipeline(stages=[*head_stages(features, label_col, scale), estimator]).fit(train.withColumn(label_col, q(label_col).cast("string")))
    labels = fitted.stages[0].labels
    return PipelineModel(fitted.stages + [IndexToString(inputCol=PRED, outputCol=PRED_LABEL,
                                                        labels=labels)])


def model_classes(model: PipelineModel) -> list[str]:
    return list(model.stages[0].labels)


def score(model: PipelineModel, df: DataFrame, label_col: str | None = None) -> DataFrame:
    """Input rows plus ``predicted_label`` (and the model's feature / raw columns).
    The label indexer is needed only for fitting, so scoring skips it: a table
    without a label, or with a class never seen, scores all the same. Works on a
    batch or a streaming DataFrame."""
    if label_col and label_col in df.columns:
        df = df.withColumn(label_col, q(label_col).cast("string"))
    return PipelineModel(model.stages[1:]).transform(df)


def class_probabilities(model: PipelineModel, scored: DataFrame, key_cols: Sequence[str]
                        ) -> DataFrame:
    """key..., class, probability: one row per (row, class), from the probability
    vector and the class names of the model. A learner without probabilities is an error."""
    if "probability" not in scored.columns:
        raise ValueError(f"{type(model.stages[-2]).__name__} gives no class probabilities")
    names = F.array(*[F.lit(c) for c in model_classes(model)])
    probs = vector_to_array(F.col("probability"))
    return (scored.select(*[q(k) for k in key_cols],
                          F.explode(F.arrays_zip(names.alias("class"),
                                                 probs.alias("probability"))).alias("z"))
            .select(*key_cols, "z.class", "z.probability"))


# ------------------------------------------------------------ persistence

def save_model(model: PipelineModel, path: str, metadata: dict | None = None) -> str:
    """Write the pipeline to ``path/model`` and a one-row metadata table (with the
    save time) to ``path/metadata``; returns ``path``."""
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    model.write().overwrite().save(f"{path}/model")
    meta = dict(metadata or {})
    meta["saved_at"] = _dt.datetime.now(_dt.timezone.utc).isoformat()
    spark.createDataFrame([(json.dumps(meta, default=str),)], "meta string").coalesce(1) \
        .write.mode("overwrite").json(f"{path}/metadata")
    return path


def load_model(path: str) -> tuple[PipelineModel, dict]:
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/model")
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        raise FileNotFoundError(f"no model at {path}")
    model = PipelineModel.load(f"{path}/model")
    meta_rows = spark.read.json(f"{path}/metadata").limit(1).collect()
    meta = json.loads(meta_rows[0]["meta"]) if meta_rows else {}
    return model, meta
