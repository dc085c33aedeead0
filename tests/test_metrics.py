from flowguard.operators import metrics


def _scored(spark):
    rows = [("a", "a")] * 5 + [("a", "b")] * 2 + [("b", "b")] * 3 + [("c", "a")]
    return spark.createDataFrame(rows, "label string, pred string")


def test_confusion_matrix_has_zero_cells(spark):
    cm = {(r["label"], r["prediction"]): r["count"]
          for r in metrics.confusion_matrix(_scored(spark), "label", "pred").collect()}
    assert len(cm) == 9 and cm[("a", "a")] == 5 and cm[("c", "c")] == 0


def test_macro_metrics_by_hand(spark):
    r = metrics.macro_metrics(_scored(spark), "label", "pred").first()
    # precision a=5/6, b=3/5, c=0; recall a=5/7, b=1, c=0
    p = (5 / 6 + 3 / 5 + 0) / 3
    rec = (5 / 7 + 1 + 0) / 3
    f1a = 2 * (5 / 6) * (5 / 7) / (5 / 6 + 5 / 7)
    f1b = 2 * (3 / 5) / (3 / 5 + 1)
    assert abs(r["precision_macro"] - p) < 1e-12
    assert abs(r["recall_macro"] - rec) < 1e-12
    assert abs(r["f1_macro"] - (f1a + f1b) / 3) < 1e-12
    assert abs(r["accuracy"] - 8 / 11) < 1e-12


def test_gap_zero_on_equal_sides(spark):
    s = _scored(spark)
    r = metrics.train_test_gap(s, s, "label", "pred").first()
    assert r["gap"] == 0 and not r["is_overfitting"]


def test_normalized_rows_sum_to_one(spark):
    cm = metrics.confusion_matrix(_scored(spark), "label", "pred")
    rows = metrics.confusion_matrix_norm(cm).collect()
    for lab in "abc":
        assert abs(sum(r["share"] for r in rows if r["label"] == lab) - 1.0) < 1e-12


def test_matrix_from_blocks_of_the_class_list(spark, monkeypatch):
    from flowguard.operators import metrics
    monkeypatch.setattr(metrics, "CLASS_BLOCK", 2)
    rows = [("a", "b"), ("a", "a"), ("c", None), ("d", "e"), ("a", "b")]
    got = {(r["label"], r["prediction"]): r["count"] for r in metrics.confusion_matrix(
        spark.createDataFrame(rows, "y string, p string"), "y", "p").collect()}
    names = ["a", "b", "c", "d", "e", None]
    assert got == {(x, y): rows.count((x, y)) for x in names for y in names}
    assert metrics.confusion_matrix(spark.createDataFrame([], "y string, p string"), "y", "p").collect() == []
