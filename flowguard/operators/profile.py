"""Table profiles: class counts, describe, column info, log histogram and its
kernel density, box statistics per class, correlations, prediction summary."""

from __future__ import annotations

import itertools
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowguard.functions.columns import pct_text, q
from flowguard.operators.drift import to_long
from flowguard.plans.joins import HOT_ROWS, checked_broadcast, uneven_join
from flowguard.plans.prefix import row_number
from flowguard.plans.quantiles import exact_quantiles
from flowguard.session import checkpointed


def class_distribution(df: DataFrame, label_col: str) -> DataFrame:
    """label, count, share; ordered by count descending then label. The share
    window runs over the aggregated table (one row per class)."""
    counts = df.groupBy(q(label_col).alias("label")).agg(F.count(F.lit(1)).alias("count"))
    return (counts.withColumn("share", F.col("count") / F.sum("count").over(Window.partitionBy()))
            .orderBy(F.desc("count"), "label"))


def describe_numeric(df: DataFrame, columns: Sequence[str],
                     prefix_method: str = "blocks") -> DataFrame:
    """column, count, mean, std (sample), min, p25, p50, p75, max; a column without
    values has count 0 and nulls.

    Moments in one aggregate over the long form; quartiles exact (linear) by
    ``exact_quantiles``, not by buffering a column in one task.
    """
    long = to_long(df, columns, feature_col="column")
    moments = long.groupBy("column").agg(
        F.count(F.lit(1)).alias("count"), F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"), F.min("value").alias("min"),
        F.max("value").alias("max"))
    quart = exact_quantiles(long, ["column"], "value", [0.25, 0.5, 0.75],
                            ["p25", "p50", "p75"], prefix_method).drop("n")
    every = df.sparkSession.createDataFrame([(c,) for c in columns], "column string")
    return every.join(moments.join(quart, "column"), "column", "left").na.fill(0, ["count"]).select(
        "column", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def column_profile(df: DataFrame) -> DataFrame:
    """column, dtype, non_null, nulls: one aggregate of counts, then unpivot. NaN counts
    as missing."""
    fields = df.schema.fields

    def present(f):
        return F.when(~F.isnan(q(f.name)), q(f.name)) if f.dataType.typeName() in ("float", "double") else q(f.name)

    counts = df.agg(*[F.count(present(f)).alias(f"c{i}") for i, f in enumerate(fields)],
                    F.count(F.lit(1)).alias("_n"))
    rows = F.array(*[F.struct(F.lit(f.name).alias("column"),
                              F.lit(f.dataType.simpleString()).alias("dtype"),
                              F.col(f"c{i}").alias("non_null"),
                              (F.col("_n") - F.col(f"c{i}")).alias("nulls"))
                     for i, f in enumerate(fields)])
    return counts.select(F.explode(rows).alias("r")).select("r.*")


def _log_long(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    long = to_long(df, columns)
    return long.where(F.col("value") > 0).select("feature", F.log10("value").alias("lv"))


def log_histogram(df: DataFrame, columns: Sequence[str], bins: int = 50) -> DataFrame:
    """feature, bin, log_lo, log_hi, count: ``bins`` even bins of log10(value) over
    its range; values <= 0 have no log and are left out; empty bins are kept.

    The range table has one row per feature (bounded by the column list); the bin
    grid is generated from it with ``sequence``, not by a join.
    """
    ll = _log_long(df, columns)
    rng = F.broadcast(ll.groupBy("feature").agg(F.min("lv").alias("mn"), F.max("lv").alias("mx")))
    width = (F.col("mx") - F.col("mn")) / F.lit(bins)
    pos = F.when(F.col("mx") == F.col("mn"), F.lit(bins // 2)).otherwise(
        F.least(F.floor((F.col("lv") - F.col("mn")) / (F.col("mx") - F.col("mn")) * F.lit(bins)),
                F.lit(bins - 1)))
    counts = (ll.join(rng, "feature").withColumn("bin", pos.cast("int"))
              .groupBy("feature", "bin").agg(F.count(F.lit(1)).alias("count")))
    grid = rng.select("feature", "mn", "mx",
                      F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return (grid.join(counts, ["feature", "bin"], "left")
            .select("feature", "bin",
                    (F.col("mn") + F.col("bin") * width).alias("log_lo"),
                    (F.col("mn") + (F.col("bin") + 1) * width).alias("log_hi"),
                    F.coalesce("count", F.lit(0)).cast("long").alias("count")))


def binned_kde(df: DataFrame, columns: Sequence[str], nodes: int = 1024, grid: int = 100
               ) -> DataFrame:
    """Gaussian kernel density of log10(value) on ``grid`` even points of its range, with Scott's
    bandwidth std * n^(-1/5).

    Values are binned linearly: each shares its weight between the two nearest of ``nodes`` even
    places, so the error falls with the square of their distance; kernels end at 8 bandwidths. Per
    feature the weights are one row of ``nodes`` numbers (fixed by the argument) and the
    density is an array expression: no join, no pairing of rows. A feature with one value has no
    bandwidth and null densities.
    """
    ll = _log_long(df, columns)
    spread = checkpointed(ll.groupBy("feature").agg(
        F.stddev_samp("lv").alias("sd"), F.count(F.lit(1)).alias("n"), F.min("lv").alias("mn"), F.max("lv").alias("mx")))
    place = F.coalesce((F.col("lv") - F.col("mn")) / F.nullif(F.col("mx") - F.col("mn"), F.lit(0.0)), F.lit(0.0)) * F.lit(nodes - 1)
    low = F.least(F.floor(place), F.lit(nodes - 2))
    share = place - low
    weights = (ll.join(F.broadcast(spread), "feature")
               .select("feature", F.inline(F.array(F.struct(low.alias("node"), (1 - share).alias("w")),
                                                   F.struct((low + 1).alias("node"), share.alias("w")))))
               .groupBy("feature", "node").agg(F.sum("w").alias("w")))
    packed = (weights.groupBy("feature").agg(F.sort_array(F.collect_list(F.struct("node", "w"))).alias("h"))
              .join(F.broadcast(spread), "feature")
              .withColumn("bw", F.nullif(F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2)), F.lit(0.0))))
    step = (F.col("mx") - F.col("mn")) / F.lit(grid - 1)
    pts = packed.select("feature", "h", "n", "bw", "mn", step.alias("step"),
                        ((F.col("mx") - F.col("mn")) / F.lit(nodes - 1)).alias("apart"),
                        F.explode(F.sequence(F.lit(0), F.lit(grid - 1))).alias("gi"))
    x = F.col("mn") + F.col("gi") * F.col("step")

    def term(acc, b):
        z = (x - (F.col("mn") + b["node"] * F.col("apart"))) / F.col("bw")
        return F.when(F.abs(z) > 8, acc).otherwise(acc + b["w"] * F.exp(F.lit(-0.5) * z * z))

    dens = F.aggregate("h", F.lit(0.0).cast("double"), term) / (
        F.col("n") * F.col("bw") * F.lit((2.0 * 3.141592653589793) ** 0.5))
    return pts.select("feature", F.col("gi").alias("grid_index"), x.alias("x"),
                      F.when(F.col("bw").isNotNull(), dens).alias("density"))


def box_stats(df: DataFrame, label_col: str, columns: Sequence[str],
              prefix_method: str = "blocks") -> DataFrame:
    """Per (class, feature): q1, median, q3, whisker ends (furthest values inside
    1.5 IQR fences) and the number of values outside them."""
    long = to_long(df, columns, id_cols=[label_col]).withColumnRenamed(label_col, "label")
    quart = exact_quantiles(long, ["label", "feature"], "value", [0.25, 0.5, 0.75],
                            ["q1", "median", "q3"], prefix_method)
    iqr = F.col("q3") - F.col("q1")
    fences = quart.select("label", "feature", "n", "q1", "median", "q3",
                          (F.col("q1") - 1.5 * iqr).alias("fence_lo"),
                          (F.col("q3") + 1.5 * iqr).alias("fence_hi"))
    v = F.col("value")
    inside = (v >= F.col("fence_lo")) & (v <= F.col("fence_hi"))
    fences = checkpointed(fences)       # one row per class and feature
    whisk = (long.join(checked_broadcast(fences.select("label", "feature", "fence_lo", "fence_hi")),
                       ["label", "feature"])
             .groupBy("label", "feature").agg(
                 F.min(F.when(inside, v)).alias("whisker_lo"),
                 F.max(F.when(inside, v)).alias("whisker_hi"),
                 F.sum((~inside).cast("long")).alias("n_outliers")))
    return fences.join(whisk, ["label", "feature"])


#: Up to so many columns one aggregate per pair is planned; beyond, one Gram pass.
WIDE_COLUMNS = 16


def _pair_corr(wide: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Strict lower triangle: one row per pair (i > j) in the given column order,
    all pairs in one aggregate pass."""
    pairs = [(a, b) for (i, a), (j, b) in itertools.product(enumerate(cols), repeat=2) if i > j]
    if not pairs:
        return wide.sparkSession.createDataFrame([], "feature_a string, feature_b string, corr double")
    if len(cols) <= WIDE_COLUMNS:
        agg = wide.agg(*[F.corr(q(a), q(b)).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
        rows = F.array(*[F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"),
                                  F.col(f"c{i}").alias("corr")) for i, (a, b) in enumerate(pairs)])
        return agg.select(F.explode(rows).alias("r")).select("r.*")
    # many columns: one pass for all moments. Values are shifted by the mean (missing:
    # 0), and masks take part, so every pair uses the rows where both are present
    n = len(cols)
    mean = wide.agg(*[F.avg(q(c)).alias(f"m{i}") for i, c in enumerate(cols)]).first()
    import numpy as np
    shift = np.array([float(x) if x is not None else 0.0 for x in mean])

    def gram(batches):
        import pyarrow as pa
        total = np.zeros((3 * n, 3 * n))
        for batch in batches:
            x = np.column_stack([batch.column(i).to_numpy(zero_copy_only=False).astype(float) for i in range(n)])
            present = ~np.isnan(x)
            x = np.where(present, x - shift, 0.0)
            full = np.concatenate([x, x * x, present.astype(float)], axis=1)
            total += full.T @ full
        yield pa.RecordBatch.from_pydict({"i": np.arange(9 * n * n), "v": total.reshape(-1)})

    parts = (wide.select(*[q(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
             .mapInArrow(gram, "i long, v double").groupBy("i").agg(F.sum("v").alias("v")).collect())
    g = np.zeros(9 * n * n)
    for r in parts:
        g[r["i"]] = r["v"]
    g = g.reshape(3 * n, 3 * n)
    xy, xm, xxm, nn = g[:n, :n], g[:n, 2 * n:], g[n:2 * n, 2 * n:], g[2 * n:, 2 * n:]
    with np.errstate(all="ignore"):
        cov = xy - xm * xm.T / nn
        var = xxm - xm * xm / nn
        corr = cov / np.sqrt(var * var.T)
    at = {c: i for i, c in enumerate(cols)}
    rows = [(a, b, None if np.isnan(corr[at[a], at[b]]) else float(corr[at[a], at[b]])) for a, b in pairs]
    return wide.sparkSession.createDataFrame(rows, "feature_a string, feature_b string, corr double")


def value_corr(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of values, strict lower triangle."""
    return _pair_corr(df.select(*[q(c).cast("double").alias(c) for c in columns]), columns)


def factorize(df: DataFrame, key_col: str, columns: Sequence[str],
              prefix_method: str = "blocks", hot_rows: int = HOT_ROWS) -> DataFrame:
    """key, and per column the code of its value: 0, 1, 2... in order of first
    appearance by ``key_col``; null -> -1.

    Per (column, value) the first key is found by an aggregate; codes are a
    distributed row number over those firsts; rows get them back by a join on (column, value)
    that deals common values to several tasks, and one ``groupBy(key)`` pivot. A repeated or
    null key is an error: codes are given back by key.
    """
    if df.groupBy(q(key_col)).count().where((F.col("count") > 1) | q(key_col).isNull()).limit(1).collect():
        raise ValueError(f"{key_col!r} holds repeated or null keys")
    long = (df.select(q(key_col).alias("_key"),
                      *[q(c).cast("string").alias(c) for c in columns])
            .unpivot(["_key"], list(columns), "column", "v"))
    firsts = long.where(F.col("v").isNotNull()).groupBy("column", "v").agg(
        F.min("_key").alias("_first"))
    codes = row_number(firsts, ["_first"], ["column"], out="_rn", method=prefix_method)
    coded = (uneven_join(long, codes.select("column", "v", (F.col("_rn") - 1).alias("code")), ["column", "v"], "left",
                         hot_rows)
             .select("_key", "column", F.coalesce("code", F.lit(-1)).cast("long").alias("code")))
    wide = coded.groupBy("_key").pivot("column", list(columns)).agg(F.first("code"))
    return wide.withColumnRenamed("_key", key_col)


def factorized_corr(df: DataFrame, key_col: str, columns: Sequence[str],
                    prefix_method: str = "blocks") -> DataFrame:
    """Correlation of factorize codes (order of first appearance), as the
    reference's heat map computes it; strict lower triangle."""
    return _pair_corr(factorize(df, key_col, columns, prefix_method), columns)


def redundant_pairs(corr: DataFrame, threshold: float = 0.8) -> DataFrame:
    """Pairs whose absolute correlation is above ``threshold``."""
    return corr.where(F.abs(F.col("corr")) > F.lit(threshold))


def prediction_summary(scored: DataFrame, pred_col: str = "prediction") -> DataFrame:
    """prediction, count, percent (of all rows), percent_text."""
    return summary_of_counts(scored.groupBy(q(pred_col).alias("prediction")).agg(F.count(F.lit(1)).alias("count")))


def summary_of_counts(counts: DataFrame, pred_col: str = "prediction") -> DataFrame:
    """``prediction_summary`` from the rows of each prediction."""
    share = F.col("count") / F.sum("count").over(Window.partitionBy())
    return (counts.select(q(pred_col).alias("prediction"), "count").withColumn("percent", share * 100.0)
            .withColumn("percent_text", pct_text(share)))
