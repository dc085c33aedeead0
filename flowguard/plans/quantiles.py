"""Exact quantiles (linear interpolation) without holding a group in one task.

Spark's ``percentile`` keeps every value of a group in one aggregation buffer.
Here values are first collapsed to distinct points with counts, a distributed
running count gives each point its rank interval, and the points holding the
needed ranks are picked by conditional aggregates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowguard.plans.joins import checked_broadcast
from flowguard.plans.prefix import running_sum
from flowguard.session import checkpointed


def exact_quantiles(long: DataFrame, group_cols: Sequence[str], value_col: str,
                    probs: Sequence[float], names: Sequence[str] | None = None,
                    prefix_method: str = "blocks") -> DataFrame:
    """Per group: n and one column per probability (same as pandas / numpy
    'linear': position h = (n-1)p, value v[floor h] + (v[ceil h] - v[floor h]) * frac).

    Nulls and NaN are left out.
    """
    names = list(names or [f"q{int(round(p * 100))}" for p in probs])
    g = list(group_cols)
    if not g:   # one group: a constant key keeps every step an equi-join / groupBy
        res = exact_quantiles(long.withColumn("_g", F.lit(0)), ["_g"], value_col, probs,
                              names, prefix_method)
        return res.drop("_g")
    v = F.col(value_col)
    pts = (long.where(v.isNotNull() & ~F.isnan(v))
           .groupBy(*g, value_col).agg(F.count(F.lit(1)).alias("_c")))
    cum = running_sum(pts, [value_col], g, weight="_c", out="_cum", method=prefix_method)
    n = pts.groupBy(*g).agg(F.sum("_c").alias("_n"))
    cum = cum.join(checked_broadcast(checkpointed(n)), g)
    aggs = [F.first("_n").alias("n")]
    for i, p in enumerate(probs):
        h = (F.col("_n") - 1) * F.lit(float(p))
        lo, hi = F.floor(h), F.ceil(h)
        start = F.col("_cum") - F.col("_c")          # 0-based first rank of the point
        aggs.append(F.max(F.when((lo >= start) & (lo < F.col("_cum")), v)).alias(f"_lo{i}"))
        aggs.append(F.max(F.when((hi >= start) & (hi < F.col("_cum")), v)).alias(f"_hi{i}"))
        aggs.append(F.first(h - lo).alias(f"_fr{i}"))
    res = cum.groupBy(*g).agg(*aggs)
    outs = [F.col(c) for c in g] + [F.col("n")]
    for i, name in enumerate(names):
        lo_v, hi_v, fr = F.col(f"_lo{i}"), F.col(f"_hi{i}"), F.col(f"_fr{i}")
        outs.append((lo_v + (hi_v - lo_v) * fr).alias(name))
    return res.select(*outs)
