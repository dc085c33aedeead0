import pytest
from pyspark.sql import functions as F

from flowguard.operators import split


def _labelled(spark, counts):
    rows, i = [], 0
    for label, n in counts.items():
        for _ in range(n):
            rows.append((i, float(i % 7), label))
            i += 1
    return spark.createDataFrame(rows, "id long, f1 double, label string")


def test_stratified_shares(spark):
    df = _labelled(spark, {"A": 800, "B": 200})
    out = split.stratified_split(df, "label", "id", 0.3, 42)
    c = {(r["split"], r["label"]): r["count"] for r in out.groupBy("split", "label").count().collect()}
    assert c[("test", "A")] + c[("test", "B")] == 300
    assert abs(c[("test", "B")] / 300 - 0.2) < 0.05


def test_exact_70_30(spark):
    out = split.stratified_split(_labelled(spark, {"A": 50, "B": 50}), "label", "id", 0.3, 42)
    c = {r["split"]: r["count"] for r in out.groupBy("split").count().collect()}
    assert c == {"train": 70, "test": 30}


def test_same_seed_same_split(spark):
    df = _labelled(spark, {"A": 60, "B": 40})
    a = sorted(tuple(r) for r in split.stratified_split(df, "label", "id", 0.3, 7).collect())
    b = sorted(tuple(r) for r in split.stratified_split(df, "label", "id", 0.3, 7).collect())
    assert a == b


def test_folds_balanced(spark):
    df = _labelled(spark, {"A": 300, "B": 150, "C": 50})
    out = split.stratified_folds(df, "label", "id", 5, 42)
    c = {(r["fold"], r["label"]): r["count"] for r in out.groupBy("fold", "label").count().collect()}
    for f in range(5):
        assert (c[(f, "A")], c[(f, "B")], c[(f, "C")]) == (60, 30, 10)


def _week(spark):
    rows = [(d * 50 + i, float(i) + 0.5 * d, d, "BENIGN" if i % 5 else "Attack")
            for d in range(5) for i in range(50)]
    return spark.createDataFrame(rows, "id long, f1 double, Day int, Label string")


def test_temporal_split_and_empty_error(spark):
    out = split.temporal_split(_week(spark), "Day", [0, 1, 2], [3, 4])
    c = {r["split"]: r["count"] for r in out.groupBy("split").count().collect()}
    assert c == {"train": 150, "test": 100}
    with pytest.raises(ValueError):
        split.temporal_split(_week(spark), "Day", [7], [3])


def test_walk_forward_steps(spark):
    steps = split.walk_forward_folds(_week(spark), "Day", 2).orderBy("step").collect()
    assert [(s["test_day"], s["train_size"], s["test_size"]) for s in steps] == \
        [(2, 100, 50), (3, 150, 50), (4, 200, 50)]


def test_permutation_is_a_permutation(spark):
    df = spark.range(0, 200).select(F.col("id"), (F.col("id") * 3).alias("v"))
    out = split.permute_column(df, "id", "v", 5)
    assert sorted(r["v_perm"] for r in out.collect()) == sorted(r["v"] for r in df.collect())
    assert out.where(F.col("v") != F.col("v_perm")).count() > 150
