"""Quality rules: plain text statistics and a hashed n-gram likelihood ratio, in
DataFrame functions only.

Words and word pairs of every document are hashed into ``buckets``. Two multinomials
are counted over all documents: the raw corpus, and the trusted target (documents
labelled good). A document's score is the mean over its n-grams of
log p_target - log p_raw, both with add-one smoothing; it is kept if the score
reaches a fixed threshold. No draw is involved, so every document's verdict is
determined by the two tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowguard.llm.common import WORD, checked_broadcast

BUCKETS = 10_000
THRESHOLD = -0.06
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


def _windows(words: Column) -> Column:
    """Hash of each run of three words."""
    return F.when(F.size(words) >= 3, F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))).otherwise(
            F.array().cast("array<bigint>"))


def rule_features(docs: DataFrame) -> DataFrame:
    """Adds the rule columns to ``docs`` (doc_id, text; text not null)."""
    text = F.col("text")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    base = (docs.withColumn("words", F.regexp_extract_all(text, F.lit(WORD), F.lit(0)))
            .withColumn("word_chars", F.length(F.translate(text, " \t\n\x0b\x0c\r", "")).cast("long"))
            .withColumn("n_symbols", (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).cast("long"))
            .withColumn("lines", lines)
            .withColumn("n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"))
            .drop("lines", "text"))
    h = base.withColumn("h", _windows(F.col("words")))
    # hash and place, sorted by hash; only texts with a repeated window need it
    s = h.withColumn("s", F.when(F.size(F.array_distinct("h")) < F.size("h"), F.sort_array(
        F.transform("h", lambda x, i: F.struct(x.alias("h"), i.alias("p"))))).otherwise(
            F.array().cast("array<struct<h:bigint,p:int>>"))).drop("h")
    repeated = F.filter("s", lambda x, i: x["h"].eqNullSafe(F.get("s", i - 1)["h"])
                        | x["h"].eqNullSafe(F.get("s", i + 1)["h"]))
    p = s.withColumn("p", F.sort_array(F.transform(repeated, lambda x: x["p"]))).drop("s")
    # each window adds three words, less what the one before it covers
    added = F.transform("p", lambda x, i: F.least(F.lit(3), x - F.coalesce(F.get("p", i - 1), F.lit(-3))))
    return (p.withColumn("n_repeat_words", F.aggregate(added, F.lit(0).cast("long"), lambda a, x: a + x))
            .withColumn("n_words", F.size("words").cast("long")).drop("p"))


def ngrams(words: Column, buckets: int) -> Column:
    """Buckets of the words, then of the pairs of neighbouring words."""
    one = F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(buckets)).cast("int"))
    two = F.when(F.size(words) > 1, F.transform(
        F.sequence(F.lit(0), F.size(words) - 2),
        lambda i: F.pmod(F.xxhash64(F.get(words, i), F.get(words, i + 1)), F.lit(buckets)).cast("int"))).otherwise(
            F.array().cast("array<int>"))
    return F.concat(one, two)


def likelihood_ratios(grams: DataFrame, buckets: int) -> list[float]:
    """log p_target - log p_raw of every bucket. ``grams``: grams array<int>, trusted
    boolean, over all documents. The counts are one sum per bucket; the list has
    ``buckets`` entries whatever the corpus."""
    # explode_outer: explode would filter on the array first and compute it twice
    count = (grams.select(F.explode_outer("grams").alias("b"), F.col("trusted").cast("long").alias("t"))
             .where(F.col("b").isNotNull()).groupBy("b").agg(F.count(F.lit(1)).alias("raw"), F.sum("t").alias("target")))
    every = grams.sparkSession.range(buckets).select(F.col("id").cast("int").alias("b"))
    rows = (every.join(count, "b", "left").na.fill(0).orderBy("b").select("b", "raw", "target").collect())
    import math
    raw, target = sum(r["raw"] for r in rows), sum(r["target"] for r in rows)
    return [math.log((r["target"] + 1) / (target + buckets)) - math.log((r["raw"] + 1) / (raw + buckets))
            for r in rows]


def quality_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  label_id_col: str = "doc_id", label_col: str = "quality", buckets: int = BUCKETS,
                  threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_words``, ``word_chars``, ``n_symbols``,
    ``n_dup_lines``, ``n_repeat_words``, ``base_failed``, ``score`` and ``kept``.

    Trusted are the documents whose id has a label row with ``label_col`` = 1; without
    any, both multinomials differ by smoothing alone and the rules decide. Null text
    counts as empty: no words, so it fails the base rules, and its score is 0.
    Null ids are never trusted. Repeated rows are judged and counted each. Only the
    named columns are read. An empty table gives no rows.
    """
    src = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    good = labels.where(F.col(label_col) == 1).select(F.col(label_id_col).alias("_good")).where(
        F.col("_good").isNotNull()).distinct()
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    grams = (src.join(checked_broadcast(good), F.col("doc_id") == F.col("_good"), "left")
             .select(words.alias("words"), F.col("_good").isNotNull().alias("trusted"))
             .select(ngrams(F.col("words"), buckets).alias("grams"), "trusted"))
    # a constant of `buckets` numbers, folded once
    ratio = F.split(F.lit(",".join(map(repr, likelihood_ratios(grams, buckets)))), ",").cast("array<double>")
    out = (rule_features(src).withColumn("grams", ngrams(F.col("words"), buckets)).drop("words")
           .withColumn("score", F.when(F.size("grams") > 0, F.aggregate(
               "grams", F.lit(0.0), lambda a, g: a + F.get(ratio, g)) / F.size("grams")).otherwise(F.lit(0.0))))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      failed.alias("base_failed"), "score", (~failed & (F.col("score") >= threshold)).alias("kept"))
