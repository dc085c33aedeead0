"""Exact, seeded, reproducible splits: stratified train/test, stratified folds,
day-based splits and walk-forward steps, column permutation.

Row order is never assumed. Rows are ranked inside their class by
md5('<seed>:' || key), a distributed row number (``plans.prefix``), so a class
holding a third of the table is still spread over many tasks. Class quotas come
from the class counts (one row per class).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowguard.functions.columns import q, seeded_hash
from flowguard.operators.clean import require_rows
from flowguard.plans.joins import checked_broadcast
from flowguard.plans.prefix import row_number
from flowguard.session import checkpointed


def class_quotas(df: DataFrame, label_col: str, test_size: float = 0.3) -> DataFrame:
    """label, n_class, n_train, n_test.

    Whole-table sizes first: n_test = ceil(n * test_size), n_train = n - n_test.
    Per class the train quota is floor(n_train * c / n); the rows left over go
    one each to the classes with the largest remainders (ties by label). A class
    with fewer than 2 rows is an error. The window runs over the class table.
    """
    counts = checkpointed(df.groupBy(q(label_col).alias("label")).agg(F.count(F.lit(1)).alias("n_class")))
    if counts.where(F.col("label").isNull()).limit(1).collect():
        raise ValueError(f"{label_col!r} holds null labels; a stratified split needs a class for every row")
    small = counts.where(F.col("n_class") < 2).limit(1).collect()
    if small:
        raise ValueError(f"class {small[0]['label']!r} has fewer than 2 rows")
    all_ = Window.partitionBy()
    n = F.sum("n_class").over(all_)
    n_train_total = n - F.ceil(n * F.lit(float(test_size)))
    prod = n_train_total * F.col("n_class")
    base = counts.select("label", "n_class", n.alias("n"), n_train_total.alias("nt"),
                         ((prod - F.pmod(prod, n)) / n).cast("long").alias("base"),
                         F.pmod(prod, n).alias("rem"))
    left = F.col("nt") - F.sum("base").over(all_)
    rk = F.row_number().over(Window.partitionBy().orderBy(F.desc("rem"), "label"))
    quotas = base.withColumn("n_train", F.col("base") + (rk <= left).cast("long"))
    return quotas.select("label", "n_class", "n_train",
                         (F.col("n_class") - F.col("n_train")).alias("n_test"))


def _ranked(df: DataFrame, label_col: str, key_col: str, seed: int,
            prefix_method: str) -> DataFrame:
    h = df.withColumn("_h", seeded_hash(seed, q(key_col)))
    return row_number(h, ["_h", key_col], [label_col], out="_rank", method=prefix_method)


def stratified_split(df: DataFrame, label_col: str, key_col: str, test_size: float = 0.3,
                     seed: int = 42, split_col: str = "split",
                     prefix_method: str = "blocks") -> DataFrame:
    """All rows with ``split_col`` = 'train' or 'test'; class shares kept exactly
    (largest-remainder quotas), rows picked by the seeded hash order."""
    quotas = class_quotas(df, label_col, test_size)
    ranked = _ranked(df, label_col, key_col, seed, prefix_method)
    # one row per class, broadcast by its count: no data row moves for it
    joined = ranked.join(checked_broadcast(quotas.select(F.col("label").alias(label_col), "n_test")), label_col)
    return (joined.withColumn(split_col, F.when(F.col("_rank") <= F.col("n_test"), "test")
                              .otherwise("train"))
            .drop("_h", "_rank", "n_test"))


def train_test(df: DataFrame, split_col: str = "split") -> tuple[DataFrame, DataFrame]:
    return (df.where(F.col(split_col) == "train").drop(split_col),
            df.where(F.col(split_col) == "test").drop(split_col))


def stratified_folds(df: DataFrame, label_col: str, key_col: str, k: int = 5, seed: int = 42,
                     fold_col: str = "fold", prefix_method: str = "blocks") -> DataFrame:
    """All rows with ``fold_col`` in 0..k-1: (rank in class - 1) mod k, so every
    fold holds the same share of each class (within one row)."""
    if k < 2:
        raise ValueError("k must be at least 2")
    ranked = _ranked(df, label_col, key_col, seed, prefix_method)
    return ranked.withColumn(fold_col, F.pmod(F.col("_rank") - 1, F.lit(k)).cast("int")).drop(
        "_h", "_rank")


def temporal_split(df: DataFrame, day_col: str = "Day",
                   train_days: Sequence[int] | None = None,
                   test_days: Sequence[int] | None = None, split_col: str = "split",
                   check_empty: bool = True) -> DataFrame:
    """Rows of the train days tagged 'train', of the test days 'test'; other days
    dropped. Each side must have rows. On a table stored by day the filters
    prune folders."""
    if day_col not in df.columns:
        raise ValueError(f"no day column {day_col!r}; add it first")
    train_days = list(train_days if train_days is not None else [0, 1, 2])
    test_days = list(test_days if test_days is not None else [3, 4])
    train = df.where(q(day_col).isin(train_days))
    test = df.where(q(day_col).isin(test_days))
    if check_empty:
        if not train.limit(1).collect():
            raise ValueError(f"no rows for train days {train_days}")
        if not test.limit(1).collect():
            raise ValueError(f"no rows for test days {test_days}")
    return (train.withColumn(split_col, F.lit("train"))
            .unionByName(test.withColumn(split_col, F.lit("test"))))


def walk_forward_folds(df: DataFrame, day_col: str = "Day", min_train_days: int = 2
                       ) -> DataFrame:
    """One row per step: step (1-based), test_day, first/last train day, number
    of train days, train_size, test_size. Step i trains on the i sorted days
    before the test day. Windows run over the per-day counts (one row per day)."""
    days = df.groupBy(q(day_col).alias("day")).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy().orderBy("day")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    steps = (days.withColumn("idx", F.row_number().over(w) - 1)
             .withColumn("train_size", F.coalesce(F.sum("n").over(before), F.lit(0)))
             .withColumn("first_train_day", F.first("day").over(w))
             .withColumn("last_train_day", F.lag("day").over(w)))
    return (steps.where(F.col("idx") >= min_train_days)
            .select((F.col("idx") - min_train_days + 1).alias("step"),
                    F.col("day").alias("test_day"), "first_train_day", "last_train_day",
                    F.col("idx").alias("n_train_days"), "train_size",
                    F.col("n").alias("test_size")))


def permute_column(df: DataFrame, key_col: str, col: str, seed: int | str = 42,
                   out: str | None = None, prefix_method: str = "blocks") -> DataFrame:
    """Add ``out`` = ``col`` shuffled over the whole table: the row at position i
    in key order receives the value of the row at position i in seeded-hash
    order. Two distributed row numbers and one equi-join on the position. A repeated
    or null key is an error: values are given back by key."""
    if df.groupBy(q(key_col)).count().where((F.col("count") > 1) | q(key_col).isNull()).limit(1).collect():
        raise ValueError(f"{key_col!r} holds repeated or null keys")
    out = out or f"{col}_perm"
    base = df.select(q(key_col).alias("_k"), q(col).alias("_v"))
    by_key = row_number(base.select("_k"), ["_k"], out="_pos", method=prefix_method)
    by_hash = row_number(base.withColumn("_h", seeded_hash(seed, "_k")), ["_h", "_k"],
                         out="_pos", method=prefix_method).select("_pos", F.col("_v").alias(out))
    perm = by_key.join(by_hash, "_pos").select(F.col("_k").alias(key_col), out)
    return df.join(perm, key_col)
