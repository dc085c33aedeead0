"""Sharding by proportional stratified interleaving."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowguard.llm.common import checked_broadcast
from flowguard.plans.prefix import row_number
from flowguard.session import checkpointed

SEED = "20240229"


def interleaved_shards(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text",
                       source_col: str = "source", seed: str = SEED) -> DataFrame:
    """``doc_id``, ``source``, ``size`` (UTF-8 bytes of the text plus 1), ``text_crc32``,
    ``law`` (``rows``: shard counts differ by one at most), ``shard`` and ``slot`` (from 0
    without gaps) of every row.

    Rows of a source are shuffled by a seeded hash and ranked; all rows are sorted by
    the fractional rank (rank - 1/2) / rows of the source, and the order is cut in
    ``shards`` equal parts. A part holds an equal stretch of every source, so its mixture
    is that of the table up to one row a source. Both ranks are distributed prefix
    passes over narrow rows, so one source may hold any part of the table.

    Null text: size 1, checksum of the empty text. A null source is a source of its own.
    Ties of the hash (repeated or null ids) are broken by checksum and size; rows equal
    in all of these are interchangeable. Only the three named columns are read. With
    fewer rows than shards some shards stay empty; an empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).alias("_dice"))
    tie = ["_dice", "doc_id", "text_crc32", "size"]
    ranked = row_number(rows, tie, ["source"], "_rank")
    counts = rows.groupBy("source").agg(F.count(F.lit(1)).alias("_rows")).withColumnRenamed("source", "_source")
    counts = checkpointed(counts)
    total = int(counts.agg(F.sum("_rows").alias("n")).first()["n"] or 0)
    placed = (ranked.join(checked_broadcast(counts), F.col("source").eqNullSafe(F.col("_source")))
              .withColumn("_share", (2 * F.col("_rank") - 1) / (2 * F.col("_rows")).cast("double")))
    ordered = row_number(placed, ["_share", "source", *tie], (), "_at")
    at = F.col("_at") - 1
    # shard s holds places ceil(s*n/shards) .. ceil((s+1)*n/shards)-1
    shard = F.expr(f"((_at - 1) * {shards}L) div {max(total, 1)}L")
    first = F.expr(f"(((_at - 1) * {shards}L) div {max(total, 1)}L * {total}L + {shards - 1}L) div {shards}L")
    return ordered.select("doc_id", "source", "size", "text_crc32", F.lit("rows").alias("law"),
                          shard.cast("int").alias("shard"), (at - first).cast("long").alias("slot"))
