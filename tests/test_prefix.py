from pyspark.sql import functions as F

from flowguard.plans.prefix import row_number, running_sum
from flowguard.plans.quantiles import exact_quantiles


def _rows(df, cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_blocks_equal_window_on_skewed_groups(spark):
    # one group holds most rows (skew), others are small
    df = spark.range(0, 3000).select(
        F.col("id"), F.when(F.col("id") % 10 < 7, F.lit("big")).otherwise(
            (F.col("id") % 3).cast("string")).alias("g"),
        (F.col("id") % 5 + 1).alias("w"))
    a = running_sum(df, ["id"], ["g"], "w", "cum", method="blocks", num_blocks=7)
    b = running_sum(df, ["id"], ["g"], "w", "cum", method="window")
    assert _rows(a, ["id", "g", "cum"]) == _rows(b, ["id", "g", "cum"])


def test_global_row_number(spark):
    df = spark.range(0, 500).select((F.col("id") * 7919 % 500).alias("k"))
    r = row_number(df, ["k"], out="rn", num_blocks=5)
    got = sorted((x["k"], x["rn"]) for x in r.collect())
    assert got == [(k, k + 1) for k in range(500)]


def test_exact_quantiles_linear(spark):
    import numpy as np
    vals = [1.0, 2.0, 2.0, 3.5, 10.0, 11.0, 4.0]
    df = spark.createDataFrame([("a", v) for v in vals], "g string, v double")
    r = exact_quantiles(df, ["g"], "v", [0.25, 0.5, 0.75]).first()
    for name, p in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75)):
        assert abs(r[name] - float(np.quantile(vals, p))) < 1e-12


def test_null_group_key_is_a_group(spark):
    df = spark.range(0, 1200).select(
        F.col("id"), F.when(F.col("id") % 2 == 0, F.lit(None)).otherwise(F.lit("x")).alias("g"))
    a = running_sum(df, ["id"], ["g"], None, "cum", method="blocks", num_blocks=6)
    b = running_sum(df, ["id"], ["g"], None, "cum", method="window")
    assert _rows(a, ["id", "cum"]) == _rows(b, ["id", "cum"])
