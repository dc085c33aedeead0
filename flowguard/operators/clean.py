"""Cleaning, type narrowing, projections and filters (one narrow pass each, no
shuffle)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowguard.functions.columns import finite_or_null, q, repaired_label

FLOAT_TYPES = (T.FloatType, T.DoubleType)
INT_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)

# Weekday name -> day index of the capture week.
DAY_MAP = {"Monday": 0, "Tuesday": 1, "Wednesday": 2, "Thursday": 3, "Friday": 4}


def require_rows(df: DataFrame, what: str = "input") -> None:
    """Emptiness check by ``limit(1)``: reads at most one row."""
    if not df.limit(1).collect():
        raise ValueError(f"{what} table is empty")


def strip_names(df: DataFrame) -> DataFrame:
    """Trim blanks at both ends of every column name; a clash after trimming is an
    error."""
    names = [c.strip() for c in df.columns]
    seen = set()
    for n in names:
        if n in seen:
            raise ValueError(f"duplicate column after stripping names: {n!r}")
        seen.add(n)
    return df.select(*[q(old).alias(new) for old, new in zip(df.columns, names)])


def inf_to_null(df: DataFrame) -> DataFrame:
    """+-inf -> null in every float column, in one projection."""
    return df.select(*[
        finite_or_null(q(f.name)).alias(f.name) if isinstance(f.dataType, FLOAT_TYPES)
        else q(f.name) for f in df.schema.fields])


def keep_flag(df: DataFrame) -> Column:
    """True where no column is missing: one predicate per column; for floats
    abs(c) < inf is false for null, NaN and +-inf alike (NaN compares above
    every number), so each column is referenced once."""
    out = F.lit(True)
    for f in df.schema.fields:
        c = q(f.name)
        cond = (F.abs(c) < F.lit(float("inf"))) if isinstance(f.dataType, FLOAT_TYPES) \
            else c.isNotNull()
        out = out & cond
    return out


def repair_label(df: DataFrame, label_col: str = "Label") -> DataFrame:
    if label_col not in df.columns:
        return df
    return df.withColumn(label_col, repaired_label(q(label_col)))


def clean_dataframe(df: DataFrame, label_col: str = "Label", check_empty: bool = True
                    ) -> DataFrame:
    """Strip names, map +-inf to null, drop rows with any missing value, repair the
    label text. The input is not changed; the result may be empty.

    Rows with +-inf are exactly the rows that the mapping to null would drop, so
    one filter on the raw values does both; no kept row holds an infinity."""
    if check_empty:
        require_rows(df)
    s = strip_names(df)
    return repair_label(s.where(keep_flag(s)), label_col)


def clean_drop_report(df: DataFrame) -> DataFrame:
    """rows_in, rows_out, rows_dropped of ``clean_dataframe`` in one aggregate."""
    s = strip_names(df)
    keep = F.coalesce(keep_flag(s), F.lit(False)).cast("long")
    return s.agg(F.count(F.lit(1)).alias("rows_in"), F.sum(keep).alias("rows_out")).select(
        "rows_in", F.coalesce("rows_out", F.lit(0)).alias("rows_out"),
        (F.col("rows_in") - F.coalesce("rows_out", F.lit(0))).alias("rows_dropped"))


# ------------------------------------------------------------ type narrowing

_INT_STEPS = [("tinyint", -2 ** 7, 2 ** 7 - 1), ("smallint", -2 ** 15, 2 ** 15 - 1),
              ("int", -2 ** 31, 2 ** 31 - 1), ("bigint", -2 ** 63, 2 ** 63 - 1)]
FLOAT32_MAX = 3.4028234663852886e38


def downcast_plan(df: DataFrame) -> DataFrame:
    """One row per numeric column: column, in_type, min, max, out_type. NaN counts as
    missing; the choice of integer types is made on the exact integers.

    Integers take the smallest type holding [min, max]; floats become float when
    in float range, else (also when all null) stay double. One aggregate pass.
    """
    num = [f for f in df.schema.fields if isinstance(f.dataType, INT_TYPES + FLOAT_TYPES)]
    if not num:
        return df.sparkSession.createDataFrame(
            [], "column string, in_type string, min double, max double, out_type string")
    aggs = []
    for i, f in enumerate(num):
        c = q(f.name)
        if isinstance(f.dataType, FLOAT_TYPES):
            c = F.nanvl(c.cast("double"), F.lit(None).cast("double"))
        aggs += [F.min(c).alias(f"mn{i}"), F.max(c).alias(f"mx{i}")]
    stats = df.agg(*aggs)
    rows = []
    for i, f in enumerate(num):
        mn, mx = F.col(f"mn{i}"), F.col(f"mx{i}")
        if isinstance(f.dataType, INT_TYPES):
            out = F.lit("bigint")
            for name, lo, hi in reversed(_INT_STEPS[:-1]):
                out = F.when((mn >= lo) & (mx <= hi), F.lit(name)).otherwise(out)
            out = F.when(mn.isNull(), F.lit(f.dataType.simpleString())).otherwise(out)
        else:
            out = F.when((mn >= -FLOAT32_MAX) & (mx <= FLOAT32_MAX), F.lit("float")).otherwise(
                F.lit("double"))
        rows.append(F.struct(F.lit(f.name).alias("column"),
                             F.lit(f.dataType.simpleString()).alias("in_type"),
                             mn.cast("double").alias("min"), mx.cast("double").alias("max"),
                             out.alias("out_type")))
    return stats.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def downcast(df: DataFrame, plan: DataFrame | None = None) -> DataFrame:
    """Apply ``downcast_plan``: the plan is one row per column (bounded by the
    schema), so it is read on the driver and becomes one projection of casts."""
    plan = plan if plan is not None else downcast_plan(df)
    types = {r["column"]: r["out_type"] for r in plan.collect()}
    return df.select(*[q(c).cast(types[c]).alias(c) if c in types else q(c)
                       for c in df.columns])


# ------------------------------------------------------------ projections / filters

def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop the named columns; names not in the table are ignored."""
    present = [c for c in columns if c in df.columns]
    return df.drop(*present)


def split_features_target(df: DataFrame, target: str = "Label") -> tuple[list[str], str]:
    """Feature names (all other columns) and the target name; a missing target is
    an error naming the columns. Spark keeps both in one table; no split."""
    if target not in df.columns:
        raise ValueError(f"target column {target!r} not found; columns: {df.columns}")
    return [c for c in df.columns if c != target], target


def class_subset(df: DataFrame, label_col: str, classes: Sequence) -> DataFrame:
    return df.where(q(label_col).isin(list(classes)))


def head_rows(df: DataFrame, key_cols: Sequence[str], n: int = 5) -> DataFrame:
    return df.orderBy(*[q(c) for c in key_cols]).limit(n)


def day_name_from_path(path_col: str | Column) -> Column:
    """'Monday-WorkingHours.pcap_ISCX.csv' -> 'Monday'."""
    c = F.col(path_col) if isinstance(path_col, str) else path_col
    return F.regexp_extract(F.element_at(F.split(c, "/"), -1), r"^([A-Za-z]+)-", 1)


#: Names an error lists.
UNKNOWN_LISTED = 1000


def add_day_column(df: DataFrame, source_column: str | None = None,
                   day_map: Mapping[str, int] | None = None, day_col: str = "Day"
                   ) -> DataFrame:
    """Day index from a day-name column (an existing ``day_col`` is overwritten).

    Without a usable source column an existing ``day_col`` is kept; with neither
    it is an error. Values outside the map are an error listing them (found by
    one anti-filter; at most UNKNOWN_LISTED names reach the driver, and whether there are more).
    """
    day_map = dict(day_map or DAY_MAP)
    if source_column and source_column in df.columns:
        unknown = (df.select(q(source_column).alias("v"))
                   .where(q("v").isNull() | ~q("v").isin(list(day_map))).distinct().orderBy("v")
                   .limit(UNKNOWN_LISTED + 1).collect())
        if unknown:
            more = " and more" if len(unknown) > UNKNOWN_LISTED else ""
            raise ValueError(f"unknown values in {source_column!r}: "
                             f"{[r['v'] for r in unknown[:UNKNOWN_LISTED]]}{more}; expected {list(day_map)}")
        m = F.create_map(*[x for k, v in day_map.items() for x in (F.lit(k), F.lit(v))])
        return df.withColumn(day_col, F.element_at(m, q(source_column)).cast("int"))
    if day_col in df.columns:
        return df
    raise ValueError("no day column: give source_column or add a Day column")


def day_filter(df: DataFrame, days: Sequence[int] | int, day_col: str = "Day") -> DataFrame:
    if isinstance(days, int):
        return df.where(q(day_col) == days)
    return df.where(q(day_col).isin(list(days)))
