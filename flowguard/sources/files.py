"""Readers and writers: multi-file CSV with differing headers, Parquet tables,
and scratch folders on the shared checkpoint storage."""

from __future__ import annotations

import csv
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowguard.functions.columns import NA_TOKENS
from flowguard.plans.prefix import row_number
from flowguard.session import ensure_checkpoint_dir

SOURCE_FILE = "source_file"
#: Rows that a task writes, in as many files as they make.
TASK_ROWS = 50_000


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the session's reliable checkpoint folder (shared
    storage on a cluster, never a machine-local temp folder)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/scratch-{name}-{uuid.uuid4().hex[:12]}"


def list_files_exist(spark: SparkSession, path: str, glob: str = "*.csv") -> bool:
    """Whether ``path`` holds a file that matches ``glob``; a missing path is an error."""
    try:
        listing = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path")
        return bool(listing.limit(1).collect())
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            raise FileNotFoundError(f"no such folder: {path}") from e
        raise


def distinct_names(header: Sequence[str]) -> list[str]:
    """Column names of a header in which names may repeat: the first keeps its name, later ones
    become ``name.1``, ``name.2`` and so on, past names that the header has itself."""
    out, taken = [], set(header)
    seen: set[str] = set()
    for name in header:
        if name in seen:
            k = 1
            while f"{name}.{k}" in taken:
                k += 1
            name = f"{name}.{k}"
            taken.add(name)
        seen.add(name)
        out.append(name)
    return out


def csv_headers(spark: SparkSession, path: str, glob: str = "*.csv") -> list[tuple[tuple[str, ...], str]]:
    """(header, name pattern) of the header groups of a folder, by their first file. One
    distributed job scans the first block of every file for its first line; the driver
    gets one row per distinct header with the names of its files. Repeated names are told
    apart by ``distinct_names``; a header that goes on in the next line is an error."""
    first = (spark.read.option("pathGlobFilter", glob).text(path)
             .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"),
                     F.col("value"), F.monotonically_increasing_id().alias("n"))
             .where(F.col("at") == 0).groupBy("file").agg(F.min_by("value", "n").alias("header")))
    groups = first.groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files")).collect()
    out = []
    for r in sorted(groups, key=lambda r: r["files"][0]):
        line = r["header"].lstrip("\ufeff")
        if line.count('"') % 2:
            raise ValueError(f"the header of {r['files'][0]} goes on in the next line")
        out.append((tuple(distinct_names(next(csv.reader([line])))), r["files"]))
    return out


def _numeric(kind: str) -> bool:
    return kind in ("int", "bigint", "double")


def _inferred(raw: DataFrame) -> dict[str, str]:
    """Type of every text column, missing-value tokens left out: int, bigint, double,
    boolean or string, the first that holds every value. One aggregate."""
    tests = {"int": r"^[+-]?\d{1,9}$", "bigint": r"^[+-]?\d{1,18}$",
             "double": r"^[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|[iI]nf(inity)?|Infinity|NaN)$",
             "boolean": r"^(?i:true|false)$"}
    aggs = []
    for i, c in enumerate(raw.columns):
        v = F.trim(F.col(f"`{c}`"))
        there = F.col(f"`{c}`").isNotNull() & ~v.isin(NA_TOKENS)
        aggs += [F.min(F.when(there, v.rlike(p))).alias(f"{kind}_{i}") for kind, p in tests.items()]
    row = raw.agg(*aggs).first()
    return {c: next((kind for kind in tests if row[f"{kind}_{i}"]), "string") for i, c in enumerate(raw.columns)}


def load_csv_files(spark: SparkSession, path: str, schema: T.StructType | None = None,
                   keep_source: bool = True, na_tokens: bool = True,
                   day_from_name: str | None = None) -> DataFrame:
    """All ``*.csv`` files of a folder as one table, columns united by name.

    Files are grouped by header; each group is one CSV scan and the groups are
    united with ``unionByName(allowMissingColumns=True)`` (a column missing from a
    group is null there). A given ``schema`` is applied by name: each group is read with
    the fields in the order of its header, and the result has the schema's columns in
    its order. Without one, text is read and types are found in one aggregate per group;
    a numeric column with missing-value tokens is numeric, the tokens null. Columns are read by
    position under the names of ``distinct_names``, so a header may repeat a name.
    ``day_from_name`` adds a column with the day name that leads the file name.
    """
    groups = csv_headers(spark, path) if list_files_exist(spark, path) else []
    if not groups:
        raise ValueError(f"no CSV files in: {path}")
    wanted = {f.name: f.dataType for f in schema.fields} if schema is not None else None
    parts = []
    for header, group in groups:
        text = T.StructType([T.StructField(c, T.StringType()) for c in header])
        own = text if wanted is None else T.StructType(
            [T.StructField(c, wanted.get(c, T.StringType())) for c in header])
        reader = spark.read.option("header", True).option("enforceSchema", True)
        source = F.col("_metadata.file_name").alias(SOURCE_FILE)
        if wanted is not None:
            df = reader.schema(own).csv(group).select("*", source)
            df = df.select(*[F.col(f"`{c}`") for c in header if c in wanted], SOURCE_FILE)
        else:
            df = reader.schema(text).csv(group).select("*", source)
            kinds = _inferred(df.select(*[F.col(f"`{c}`") for c in header]))

            def typed(c: str):
                v = F.col(f"`{c}`")
                if _numeric(kinds[c]):
                    return F.when(~F.trim(v).isin(NA_TOKENS), F.trim(v)).try_cast(kinds[c]).alias(c)
                return v.try_cast(kinds[c]).alias(c) if kinds[c] != "string" else v
            df = df.select(*[typed(c) for c in header], SOURCE_FILE)
        parts.append(df)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    if wanted is not None:
        out = out.select(*[F.col(f"`{c}`") if c in out.columns else F.lit(None).cast(t).alias(c)
                           for c, t in wanted.items()], SOURCE_FILE)
    if na_tokens:
        out = out.select(*[
            (F.when(F.col(f"`{f.name}`").isin(NA_TOKENS), F.lit(None))
             .otherwise(F.col(f"`{f.name}`")).alias(f.name))
            if isinstance(f.dataType, T.StringType) and f.name != SOURCE_FILE
            else F.col(f"`{f.name}`") for f in out.schema.fields])
    if day_from_name:
        from flowguard.operators.clean import day_name_from_path
        out = out.withColumn(day_from_name, day_name_from_path(SOURCE_FILE))
    return out if keep_source else out.drop(SOURCE_FILE)


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None,
                  mode: str = "overwrite", file_rows: int | None = None) -> str:
    """Overwrite one Parquet dataset, optionally partitioned (e.g. by day so that
    day filters prune folders).

    With ``file_rows`` the rows of a folder (or the whole table) are ranked by a hash of the row
    and every ``file_rows`` of them are a file: ceil(rows / file_rows) files a folder, none
    larger. A task writes the files of about TASK_ROWS rows one after the other, so that the number of tasks
    does not grow with the number of files, and no folder is in one task.
    """
    if file_rows:
        by = list(partition_by or [])
        ranked = row_number(df.withColumn("_h", F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])), ["_h"], by, out="_rn")
        a_task = max(1, TASK_ROWS // file_rows) * file_rows
        tasks = ranked.groupBy(*[F.col(f"`{c}`") for c in by]).agg(F.ceil(F.max("_rn") / a_task).alias("_t")).agg(F.sum("_t")).first()[0] or 1
        # whole files go together: only the last task of a folder has a file with fewer rows
        df = (ranked.withColumn("_chunk", F.floor((F.col("_rn") - 1) / a_task)).repartition(int(tasks), *[F.col(f"`{c}`") for c in by], "_chunk")
              .sortWithinPartitions(*[F.col(f"`{c}`") for c in by], "_rn").select(*[F.col(f"`{c}`") for c in df.columns]))
    w = df.write.mode(mode)
    if file_rows:
        w = w.option("maxRecordsPerFile", file_rows)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).option("header", True).csv(path)
    return path
