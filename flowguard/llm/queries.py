"""Queries of the text operators: thin callables (spark, sf_dir) -> DataFrame that
apply one operator to its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowguard.llm import kneser_ney
from flowguard.llm.common import table
from flowguard.llm.conversation_repair import damage, repair_conversations, summarise
from flowguard.llm.decontaminate import contaminated
from flowguard.llm.html_extract import extract_pages

from flowguard.llm.merkle import fold, leaf_digest, merkle_manifest, siblings
from flowguard.llm.oracle import CONVERSATION_REPAIR, LM_SCORING, MERKLE_MANIFEST, SECRET_SCAN, SUBSTRING_DEDUP
from flowguard.llm.quality_classifier import THRESHOLD, fit_classifier, held_out, score_documents
from flowguard.llm.quality_rules import quality_rules
from flowguard.llm.secret_scan import joined, scan_secrets
from flowguard.llm.sentencepiece_scan import encode
from flowguard.llm.sharding import interleaved_shards
from flowguard.llm.simhash import simhash_components
from flowguard.llm.substring_dedup import substring_dedup
from flowguard.llm.token_counts import count_tokens

#: Where the public tokenizers' files lie; a parameter of the operators.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document: counts of the base kinds and the spans of all."""
    found = scan_secrets(table(spark, sf_dir, "documents"))

    def number(kind: str):
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", number("assign"), number("access"), number("hex"),
        F.sha2(joined(F.filter("found", lambda s: s["base"])), 256).alias("base_sha256"),
        joined(F.col("found")).alias("spans"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage, with the place and its edits."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that lie in a 20-word window seen earlier are removed."""
    out = substring_dedup(table(spark, sf_dir, "documents"), window=20)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; one fold of the ids is never trained on."""
    docs = table(spark, sf_dir, "documents")
    model = fit_classifier(docs, table(spark, sf_dir, "labels").where(~held_out()))
    return score_documents(docs, model).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of equal row counts and equal source mixture."""
    out = interleaved_shards(table(spark, sf_dir, "documents"), shards=16)
    return out.drop("source").withColumn("grown_shard", F.lit(None).cast("int"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 4-word SimHash differs in at most 4 bits."""
    return simhash_components(table(spark, sf_dir, "documents"), shingle=4, max_bits=4)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule columns and n-gram likelihood-ratio verdict of every document."""
    return quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of the best unigram segmentation of every document."""
    return count_tokens(table(spark, sf_dir, "documents"), MODEL)


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every document and whether decoding gives the text back."""
    out = encode(table(spark, sf_dir, "documents"), MODEL, keep_text=False)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), "ids", "round_trip")


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract_pages(table(spark, sf_dir, "pages"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots and proof of every document; rows whose id's checksum 7 divides are
    verified with one more in ``n_chars``."""
    n_chars = F.col("n_chars") + F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, 1).otherwise(0)
    claim = leaf_digest(F.col("doc_id"), F.col("source"), F.col("lang"), n_chars, F.col("text"))
    out = merkle_manifest(table(spark, sf_dir, "documents"), claim=claim)
    return (out.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root",
                       F.sha2(siblings(F.col("path")).cast("binary"), 256).alias("proof_sha256"),
                       fold(F.col("claim"), F.col("path")).alias("folded_root"))
            .withColumn("verified", F.col("folded_root") == F.col("root")))


def op12_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probability of every document under a model of those outside one fold."""
    docs = table(spark, sf_dir, "documents")
    model = kneser_ney.train(docs.where(~kneser_ney.held_out()))
    return kneser_ney.score_documents(docs, model).select(
        "doc_id", kneser_ney.held_out().alias("held_out"), "n_tokens", "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cheapest repair of every conversation after seeded damage."""
    rows = table(spark, sf_dir, "conversations")
    found = summarise(repair_conversations(damage(rows))).withColumnRenamed("conv_id", "_conv")
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return (rows.select("conv_id").distinct().join(found, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").select(
        "conv_id", *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.sha2(F.coalesce("repaired", F.lit("")).cast("binary"), 256).alias("repaired_sha256")))


QUERIES = {
    "op1_secret_scan": op1_secret_scan,
    "op2_decontaminate": op2_decontaminate,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_sharding": op5_sharding,
    "op6_simhash": op6_simhash,
    "op7_quality_rules": op7_quality_rules,
    "op8_token_counts": op8_token_counts,
    "op9_sentencepiece": op9_sentencepiece,
    "op10_html_extraction": op10_html_extraction,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_lm_scoring": op12_lm_scoring,
    "op13_conversation_repair": op13_conversation_repair,
}

ORACLE: dict[str, str] = {
    "op1_secret_scan": SECRET_SCAN,
    "op3_substring_dedup": SUBSTRING_DEDUP,
    "op11_merkle_manifest": MERKLE_MANIFEST,
    "op12_lm_scoring": LM_SCORING,
    "op13_conversation_repair": CONVERSATION_REPAIR,
}
