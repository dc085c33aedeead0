"""Joins with small tables, and with tables that have one row a key where keys are uneven."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowguard.session import checkpointed

#: Most rows of a narrow table (a key and a few numbers) that is sent to every task.
BROADCAST_ROWS = 200_000


def checked_broadcast(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``most`` rows, by count; as it is
    otherwise, so that the join shuffles both sides."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


#: Rows of one key that a task takes in an uneven join.
HOT_ROWS = 1_000_000


def uneven_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner", hot_rows: int = HOT_ROWS) -> DataFrame:
    """``left`` joined with ``right``, which has one row a key, where a key may hold any part of
    ``left``: keys of more than ``hot_rows`` rows are counted first (there are no more than rows /
    ``hot_rows`` of them), dealt to as many parts as they need by a hash of the row, and their
    row of ``right`` is there once for each part. ``how`` is inner or left. Null keys match nothing.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unsupported join: {how}")
    on = list(on)
    hot = checkpointed(left.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows)
                       .select(*on, F.ceil(F.col("_n") / hot_rows).cast("long").alias("_parts")))
    if hot.limit(1).isEmpty():
        return left.join(right, on, how)
    hot = checked_broadcast(hot.na.drop(subset=on))
    parts = F.coalesce("_parts", F.lit(1).cast("long"))
    no_key = F.greatest(*[F.col(f"`{c}`").isNull() for c in on]) if len(on) > 1 else F.col(f"`{on[0]}`").isNull()
    # rows without a key meet nothing, so they go wherever their hash says
    row = F.xxhash64(*[F.col(f"`{c}`") for c in left.columns])
    dealt = (left.join(hot, on, "left")
             .withColumn("_part", F.when(no_key, row).otherwise(F.pmod(row, parts))).drop("_parts"))
    copies = (right.join(hot, on, "left")
              .withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))).drop("_parts"))
    return dealt.join(copies, [*on, "_part"], how).drop("_part")
