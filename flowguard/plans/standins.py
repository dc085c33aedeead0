"""The given tables in the roles of the reference's flow data.

The reference works on labelled network-flow rows (numeric features, a class
label, a capture day). ``events`` plays that table: one row per event with a
unique key, a day index from its timestamp, three numeric features and the event
type as class label. Other tables stand in where a shape is needed (wide numeric
rows, vectors, an imbalanced class).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FLOW_FEATURES = ["value", "user_id", "k"]
FLOW_LABEL = "Label"
FLOW_DAY = "Day"
FLOW_KEY = "flow_id"
FIRST_DAY = "2024-01-01"
REFERENCE_DAYS = 7          # days 0..6 are the reference sample of the drift checks


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """flow_id, Day (0 = first day), value, user_id, k (doubles), Label."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias(FLOW_KEY),
        F.datediff(F.to_date("ts"), F.lit(FIRST_DAY).cast("date")).cast("int").alias(FLOW_DAY),
        F.col("value").cast("double").alias("value"),
        F.col("user_id").cast("double").alias("user_id"),
        F.get_json_object("props", "$.k").cast("double").alias("k"),
        F.col("event_type").alias(FLOW_LABEL),
    )


# SQL form of ``flows`` for the DuckDB oracle (same columns, same values).
FLOWS_SQL = f"""flows AS (
  SELECT event_id AS flow_id,
         CAST(date_diff('day', DATE '{FIRST_DAY}', CAST(ts AS DATE)) AS INTEGER) AS Day,
         CAST(value AS DOUBLE) AS value,
         CAST(user_id AS DOUBLE) AS user_id,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k,
         event_type AS Label
  FROM events)"""


def _band(part: int, key: str = FLOW_KEY):
    """Hex digits 4*part+1 .. 4*part+4 of md5('dirt:' || key): a stable value in
    0000..ffff, compared as text (same order in SQL). One hash per row serves
    all bands."""
    h = F.md5(F.concat(F.lit("dirt:"), F.col(key).cast("string")))
    return F.substring(h, 4 * part + 1, 4)


def dirty_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``flows`` as a raw capture would give it: blanks around column names, +-inf,
    NaN and null in features, mis-decoded and missing labels. Every row is kept;
    which rows carry dirt is fixed by a hash of the key (about 1-6 % each)."""
    fl = flows(spark, sf_dir)
    h1, h2, h3 = _band(0), _band(1), _band(2)
    bad_label = F.concat(F.lit("Web "), F.col("Label"), F.lit(" �  x"))
    return fl.select(
        F.col(FLOW_KEY).alias(" flow_id"),
        F.col("Day").alias("Day "),
        F.when(h1 < "0290", F.lit(float("inf"))).when(h1 < "0520", F.lit(float("nan")))
        .otherwise(F.col("value")).alias("  value"),
        F.when(h2 < "0290", F.lit(float("-inf"))).when(h2 < "03d8", F.lit(None))
        .otherwise(F.col("user_id")).alias("user_id "),
        F.col("k"),
        F.when(h3 < "0ccc", bad_label).when(h3 < "0f5c", F.lit(None))
        .otherwise(F.col("Label")).alias(" Label "),
    )


def _band_sql(part: int) -> str:
    return f"substr(md5('dirt:' || CAST(flow_id AS VARCHAR)), {4 * part + 1}, 4)"


DIRTY_SQL = f"""dirty AS (
  SELECT flow_id AS " flow_id", Day AS "Day ",
         CASE WHEN {_band_sql(0)} < '0290' THEN 'inf'::DOUBLE
              WHEN {_band_sql(0)} < '0520' THEN 'nan'::DOUBLE ELSE value END AS "  value",
         CASE WHEN {_band_sql(1)} < '0290' THEN '-inf'::DOUBLE
              WHEN {_band_sql(1)} < '03d8' THEN NULL ELSE user_id END AS "user_id ",
         k,
         CASE WHEN {_band_sql(2)} < '0ccc' THEN 'Web ' || Label || ' �  x'
              WHEN {_band_sql(2)} < '0f5c' THEN NULL ELSE Label END AS " Label "
  FROM flows)"""

# SQL form of clean_dataframe over ``dirty``.
CLEAN_SQL = """clean AS (
  SELECT " flow_id" AS flow_id, "Day " AS Day, "  value" AS value, "user_id " AS user_id, k,
         trim(regexp_replace(replace(" Label ", '�', ' '), '\\s+', ' ', 'g')) AS Label
  FROM dirty
  WHERE " flow_id" IS NOT NULL AND "Day " IS NOT NULL
    AND "  value" IS NOT NULL AND NOT isnan("  value") AND NOT isinf("  value")
    AND "user_id " IS NOT NULL AND NOT isnan("user_id ") AND NOT isinf("user_id ")
    AND k IS NOT NULL AND NOT isnan(k) AND NOT isinf(k)
    AND " Label " IS NOT NULL)"""


def rule_prediction(value_col: str = "value"):
    """A fixed stand-in classifier: bands of ``value`` -> event type. Gives the
    metric queries a prediction column that SQL can compute too."""
    v = F.col(value_col)
    return (F.when(v < 5, "view").when(v < 10, "click").when(v < 20, "purchase")
            .when(v < 40, "signup").otherwise("error"))


RULE_SQL = """CASE WHEN value < 5 THEN 'view' WHEN value < 10 THEN 'click'
  WHEN value < 20 THEN 'purchase' WHEN value < 40 THEN 'signup' ELSE 'error' END"""


def scored_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flows(spark, sf_dir).withColumn("prediction", rule_prediction())


EMB_DIM = 64
EMB_FEATURES = [f"e{i}" for i in range(EMB_DIM)]


def embedding_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, label, e0..e63 (doubles): the vectors as wide numeric rows."""
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", "label",
                    *[F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(EMB_DIM)])


DOC_FEATURES = ["n_chars", "n_words", "n_lines", "n_upper", "n_digits"]


def doc_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The imbalanced stand-in: labelled documents (quality 0/1, about 85/15) with
    numeric features measured on the whole text."""
    d = table(spark, sf_dir, "documents")
    lab = table(spark, sf_dir, "labels")
    t = F.col("text")
    return d.join(lab, "doc_id").select(
        "doc_id",
        F.col("n_chars").cast("double").alias("n_chars"),
        F.size(F.split(F.trim(t), r"\s+")).cast("double").alias("n_words"),
        F.size(F.split(t, "\n")).cast("double").alias("n_lines"),
        F.length(F.regexp_replace(t, "[^A-Z]", "")).cast("double").alias("n_upper"),
        F.length(F.regexp_replace(t, "[^0-9]", "")).cast("double").alias("n_digits"),
        F.col("quality").cast("string").alias("quality"))


PERIOD = "Period"


def flows_by_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    """flows with Period = Day // 6: five capture periods, as the reference's five
    capture days."""
    return flows(spark, sf_dir).withColumn(PERIOD, F.floor(F.col(FLOW_DAY) / 6).cast("int"))
