"""Distributed running sums and row numbers.

A window ``partitionBy(g).orderBy(o)`` sends every row of a group to one task. The
groups here are few and large (a feature, a class, the whole table), so that
window does not scale. ``running_sum`` gives the same numbers with work spread
over range blocks:

1. ``repartitionByRange(n, g..., o...)`` and tag each row with its block id;
   a local window within (block, group) gives the sum inside the block;
2. the tagged rows are checkpointed, so the block of a row is fixed data, not a
   property of one execution (a recomputed range sample could move rows);
3. per (block, group) totals; only groups that span blocks need an offset, and
   at most ``n - 1`` (block, group) pairs can follow the start of a group in
   another block, so the offset table has at most ``n`` rows and is broadcast;
4. result = local sum + offset.

The order columns must make the order total inside a group (append a unique key);
otherwise equal keys may straddle a block boundary in any order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowguard.session import checkpointed

_BLK = "_fg_blk"
_W = "_fg_w"
_LOCAL = "_fg_local"
_TOT = "_fg_tot"
_OFF = "_fg_off"


def _as_cols(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def running_sum(df: DataFrame, order_by: Sequence[str | Column],
                partition_by: Sequence[str] = (), weight: str | Column | None = None,
                out: str = "cum", method: str = "blocks",
                num_blocks: int | None = None) -> DataFrame:
    """Add ``out`` = sum of ``weight`` (default 1) over the rows of the same
    ``partition_by`` group up to and including this row in ``order_by`` order.

    ``method="window"`` is the plain single-window form, kept for small inputs
    and as the reference in tests; ``"blocks"`` is the scalable form.
    """
    part = list(partition_by)
    order = _as_cols(order_by)
    w = F.lit(1).cast("long") if weight is None else (
        F.col(weight) if isinstance(weight, str) else weight)
    base = df.withColumn(_W, w)

    if method == "window":
        win = (Window.partitionBy(*part).orderBy(*order)
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        return base.withColumn(out, F.sum(_W).over(win)).drop(_W)
    if method != "blocks":
        raise ValueError(f"unknown method: {method}")

    spark = df.sparkSession
    n = num_blocks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    tagged = (base.repartitionByRange(n, *[F.col(c) for c in part], *order)
              .withColumn(_BLK, F.spark_partition_id()))
    local_win = (Window.partitionBy(_BLK, *part).orderBy(*order)
                 .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = checkpointed(tagged.withColumn(_LOCAL, F.sum(_W).over(local_win)))

    # (block, group) totals -> offsets of groups that continue from earlier blocks.
    tot = local.groupBy(_BLK, *part).agg(F.sum(_W).alias(_TOT))
    prev = Window.partitionBy(*part).orderBy(_BLK).rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = (tot.withColumn(_OFF, F.sum(_TOT).over(prev))
               .where(F.col(_OFF).isNotNull())
               .select(_BLK, *part, _OFF))
    # at most num_blocks rows: safe to broadcast whatever the input size. The join
    # is null-safe so that a null group key is a group like any other.
    offs = offsets.select(F.col(_BLK).alias("_o_blk"),
                          *[F.col(c).alias(f"_o_{i}") for i, c in enumerate(part)], _OFF)
    cond = F.col(_BLK) == F.col("_o_blk")
    for i, c in enumerate(part):
        cond = cond & F.col(c).eqNullSafe(F.col(f"_o_{i}"))
    joined = local.join(F.broadcast(offs), cond, how="left")
    return (joined.withColumn(out, F.col(_LOCAL) + F.coalesce(F.col(_OFF), F.lit(0)))
            .drop(_BLK, _W, _LOCAL, _OFF, "_o_blk", *[f"_o_{i}" for i in range(len(part))]))


def row_number(df: DataFrame, order_by: Sequence[str | Column],
               partition_by: Sequence[str] = (), out: str = "rn",
               method: str = "blocks", num_blocks: int | None = None) -> DataFrame:
    """1-based row number within ``partition_by`` in a total ``order_by`` order."""
    return running_sum(df, order_by, partition_by, None, out, method, num_blocks)
