import math

import pytest
from pyspark.sql import functions as F

from flowguard.operators import clean


@pytest.fixture
def dirty_flows(spark):
    rows = [(1, 1.0, 10.0, "BENIGN"), (2, 2.0, float("-inf"), "Web Attack �  Brute Force"),
            (3, float("inf"), 30.0, "DDoS"), (4, 4.0, 40.0, "  PortScan "),
            (5, 5.0, 50.0, "BENIGN")]
    return spark.createDataFrame(rows, "id long, ` Column A ` double, `Column B` double, Label string")


def test_clean_removes_inf_and_nan_rows(dirty_flows):
    out = clean.clean_dataframe(dirty_flows)
    assert out.columns == ["id", "Column A", "Column B", "Label"]
    rows = out.collect()
    assert len(rows) == 3
    for r in rows:
        assert math.isfinite(r["Column A"]) and math.isfinite(r["Column B"])
    labels = {r["Label"] for r in rows}
    assert "PortScan" in labels


def test_label_repair_collapses_blanks(spark):
    df = spark.createDataFrame([("Web Attack �  Brute Force",)], "Label string")
    assert clean.repair_label(df).first()["Label"] == "Web Attack Brute Force"


def test_drop_report_counts(dirty_flows):
    r = clean.clean_drop_report(dirty_flows).first()
    assert (r["rows_in"], r["rows_out"], r["rows_dropped"]) == (5, 3, 2)


def test_empty_input_is_error(spark):
    with pytest.raises(ValueError):
        clean.clean_dataframe(spark.createDataFrame([], "a double"))


def test_duplicate_after_strip_is_error(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "`a ` double, ` a` double")
    with pytest.raises(ValueError):
        clean.strip_names(df)


def test_downcast_keeps_int_values(spark):
    df = spark.range(0, 100).select(F.col("id").alias("int_col"),
                                    (F.col("id") / 100.0).alias("float_col"))
    plan = {r["column"]: r["out_type"] for r in clean.downcast_plan(df).collect()}
    assert plan == {"int_col": "tinyint", "float_col": "float"}
    out = clean.downcast(df)
    assert [r[0] for r in out.select("int_col").collect()] == list(range(100))


def test_drop_columns_ignores_unknown(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert clean.drop_columns(df, ["a", "x"]).columns == ["b", "c"]


def test_add_day_column(spark):
    df = spark.createDataFrame([("Monday", 1), ("Tuesday", 2), ("Wednesday", 3)],
                               "DayName string, f1 int")
    out = clean.add_day_column(df, "DayName")
    assert [r["Day"] for r in out.orderBy("f1").collect()] == [0, 1, 2]
    with pytest.raises(ValueError):
        clean.add_day_column(spark.createDataFrame([("Sunday", 1)], "DayName string, f1 int"),
                             "DayName")
    with pytest.raises(ValueError):
        clean.add_day_column(df.drop("DayName"))
