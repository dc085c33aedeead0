"""Corpus pipeline: five stages in order, each over all rows its predecessor kept.

The stages take (spark, docs, sf_dir) and return the columns of ``documents`` (the last
one the encoded documents). Between stages rows are written as Parquet to the shared
folder and read again, so a lost executor costs at most the stage it was in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowguard.llm.common import fresh, table
from flowguard.llm.decontaminate import drop_contaminated
from flowguard.llm.quality_classifier import THRESHOLD, fit_classifier, held_out, score_documents
from flowguard.llm.queries import MODEL
from flowguard.llm.secret_scan import redact, scan_secrets
from flowguard.llm.sentencepiece_scan import encode
from flowguard.llm.simhash import near_dedup
from flowguard.sources.files import scratch_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the attention classifier accepts."""
    model = fit_classifier(docs, table(spark, sf_dir, "labels").where(~held_out()))
    score = fresh(docs, "_quality")
    scored = score_documents(docs, model, keep=[c for c in docs.columns if c != "doc_id"], out_col=score)
    return scored.where(F.col(score) >= THRESHOLD).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: four-word shingles, at most 4 differing bits."""
    return near_dedup(docs, shingle=4, max_bits=4).select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, secrets blanked out; ``n_chars`` follows the text."""
    spans = fresh(docs, "_spans")
    found = scan_secrets(docs, keep=[c for c in docs.columns if c not in ("doc_id", "text")],
                         out=spans)
    out = found.withColumn("text", redact(F.col("text"), F.col(spans)))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.size(spans) > 0, F.length("text").cast("long")).otherwise(
            F.col("n_chars")))
    return out.select(docs.columns)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document and whether decoding them gives the text back."""
    return encode(docs, MODEL, keep_text=False).select(
        "doc_id", F.size("ids").cast("long").alias("n_pieces"), "ids", "round_trip")


STAGES = [
    ("quality classifier", quality),
    ("simhash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("secret scan", secrets),
    ("sentencepiece", encoding),
]

#: The model fit, the segmentation and the alignment are not SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for n, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if n < len(STAGES) - 1:
            path = scratch_path(spark, f"pipeline-{n}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
