"""Standardisation fitted on the training side with the population std (ddof 0;
a constant column is divided by 1), as the reference's scaler does. Spark ML's
StandardScaler uses the sample std, so it is not used here."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowguard.functions.columns import q


def fit_scaler(train: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """{column: (mean, scale)} from one aggregate over the training rows; the result
    is two numbers per column (bounded by the column list)."""
    aggs = []
    for i, c in enumerate(columns):
        aggs += [F.avg(q(c)).alias(f"m{i}"), F.stddev_pop(q(c)).alias(f"s{i}")]
    row = train.agg(*aggs).first()
    out = {}
    for i, c in enumerate(columns):
        m, s = row[f"m{i}"], row[f"s{i}"]
        out[c] = (m if m is not None else 0.0, s if s not in (None, 0.0) else 1.0)
    return out


def apply_scaler(df: DataFrame, params: dict[str, tuple[float, float]]) -> DataFrame:
    return df.select(*[((q(c) - F.lit(params[c][0])) / F.lit(params[c][1])).alias(c)
                       if c in params else q(c) for c in df.columns])


def scale_features(train: DataFrame, test: DataFrame, columns: Sequence[str]
                   ) -> tuple[DataFrame, DataFrame, dict[str, tuple[float, float]]]:
    """Fit on ``train``, apply to both; returns both tables and the fitted values."""
    params = fit_scaler(train, columns)
    return apply_scaler(train, params), apply_scaler(test, params), params
