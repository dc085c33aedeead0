import numpy as np
from pyspark.sql import functions as F

from flowguard.operators import drift


def _gauss(spark, n, shift, seed, cols=5):
    rng = np.random.default_rng(seed)
    data = rng.normal(0, 1, size=(n, cols)) + shift
    return spark.createDataFrame([tuple(map(float, r)) for r in data],
                                 ", ".join(f"f{i} double" for i in range(cols)))


def test_no_drift_same_distribution(spark):
    a, b = _gauss(spark, 500, 0, 1), _gauss(spark, 500, 0, 2)
    res = drift.ks_drift(a, b, [f"f{i}" for i in range(5)]).collect()
    assert len(res) == 5
    assert sum(r["is_drifted"] for r in res) <= 1


def test_drift_found_on_shift(spark):
    a, b = _gauss(spark, 500, 0, 1), _gauss(spark, 500, 10, 2)
    res = drift.ks_drift(a, b, [f"f{i}" for i in range(5)]).collect()
    assert all(r["is_drifted"] and r["statistic"] == 1.0 for r in res)


def test_ks_statistic_matches_brute_force(spark):
    rng = np.random.default_rng(3)
    x, y = rng.integers(0, 20, 300).astype(float), rng.integers(3, 25, 200).astype(float)
    a = spark.createDataFrame([(float(v),) for v in x], "f double")
    b = spark.createDataFrame([(float(v),) for v in y], "f double")
    d = drift.ks_drift(a, b, ["f"]).first()["statistic"]
    grid = np.union1d(x, y)
    brute = max(abs((x <= g).mean() - (y <= g).mean()) for g in grid)
    assert abs(d - brute) < 1e-12


def test_chi_square_flip(spark):
    ref = spark.createDataFrame([("A",)] * 800 + [("B",)] * 200, "y string")
    cur = spark.createDataFrame([("A",)] * 200 + [("B",)] * 800, "y string")
    r = drift.chi2_drift(ref, cur, "y").first()
    assert abs(r["statistic"] - 2250.0) < 1e-9 and r["has_drift"]


def test_monitor_history_and_no_labels(spark):
    ref = _gauss(spark, 100, 0, 1).withColumn("y", F.lit("x"))
    mon = drift.DriftMonitor(ref, [f"f{i}" for i in range(5)], "y")
    r1 = mon.check(_gauss(spark, 50, 0, 2).withColumn("y", F.lit("x"))).first()
    r2 = mon.check(_gauss(spark, 50, 10, 3), with_labels=False).first()
    assert r1["batch_number"] == 1 and r2["batch_number"] == 2
    assert r2["prediction_drift"] is None and r2["needs_retraining"]
    assert len(mon.history) == 2


def _paths(n, m):
    """Brute force: how many lattice paths reach each largest |i*m - j*n|."""
    import itertools
    counts = {}
    for ups in itertools.combinations(range(n + m), n):
        i = j = most = 0
        for k in range(n + m):
            i, j = (i + 1, j) if k in ups else (i, j + 1)
            most = max(most, abs(i * m - j * n))
        counts[most] = counts.get(most, 0) + 1
    return counts


def test_exact_tail_equals_counting_paths():
    from flowguard.functions.stats import ks_exact
    for n in range(1, 9):
        for m in range(1, n + 1):
            counts = _paths(n, m)
            total = sum(counts.values())
            for h in range(n * m + 2):
                want = sum(c for k, c in counts.items() if k >= h) / total
                assert abs(ks_exact(h, n, m) - want) < 1e-12 and abs(ks_exact(h, m, n) - want) < 1e-12


def test_exact_tail_of_large_sides():
    from flowguard.functions.stats import ks_exact
    assert ks_exact(0, 10, 10) == 1 and ks_exact(100, 10, 10) < 1.1e-5
    # the limit 0.03664 is near, and from above
    assert 0.0355 < ks_exact(round(0.02 * 10_000 * 9_999), 10_000, 9_999) < 0.0366
    assert ks_exact(round(0.5 * 10_000 * 9_999), 10_000, 9_999) < 1e-12


def test_flag_near_the_threshold_is_the_exact_one(spark):
    """Two sides of 10 with D = 0.6: exact p 0.0524, the limit's 0.0546; D = 0.7: 0.0123."""
    ref = spark.createDataFrame([(float(i),) for i in range(10)], "f double")
    for d, flag, p in ((6, False, 0.05245), (7, True, 0.01234)):
        cur = spark.createDataFrame([(float(i + d) - 0.5,) for i in range(10)], "f double")
        r = drift.ks_drift(ref, cur, ["f"]).first()
        assert abs(r["statistic"] - d / 10) < 1e-12 and r["is_drifted"] == flag and abs(r["p_value"] - p) < 1e-4


def test_many_classes_without_a_grid(spark):
    """100,000 classes x 100 batches: only cells with rows are formed."""
    ref = spark.range(200_000).selectExpr("CAST(id % 100000 AS STRING) AS y")
    cur = spark.range(10_000).selectExpr("CAST(id % 100 AS INT) AS b", "CAST(id * 7 % 100000 AS STRING) AS y").unionByName(
        spark.createDataFrame([(0, "new"), (0, None)], "b int, y string"))
    got = {r["b"]: r for r in drift.chi2_drift(ref, cur, "y", "b").collect()}
    assert len(got) == 100
    # 100 classes with one row each, expected 1e-3; the others expected 1e-3 each
    want = 100 * (1 - 1e-3) ** 2 / 1e-3 + 99_900 * 1e-3
    assert abs(got[5]["statistic"] - want) < 1e-6 * want and (got[5]["n_classes"], got[5]["dof"]) == (100_000, 99_999)
    assert got[0]["n_classes"] == 100_002 and got[0]["statistic"] > 1e9


def test_class_table_keeps_missing_and_new_classes(spark, monkeypatch):
    monkeypatch.setattr(drift, "CLASS_BLOCK", 2)
    ref = spark.createDataFrame([("a",)] * 4 + [("b",)] * 2 + [(None,)] + [("c",)], "y string")
    cur = spark.createDataFrame([(1, "a"), (1, "z"), (2, None)], "b int, y string")
    got = {(r["b"], r["label"]): (r["ref_count"], r["cur_count"], r["cur_total"]) for r in
           drift.class_shift_counts(ref, cur, "y", "b").collect()}
    assert got == {(1, "a"): (4, 1, 2), (1, "b"): (2, 0, 2), (1, None): (1, 0, 2), (1, "c"): (1, 0, 2), (1, "z"): (0, 1, 2),
                   (2, "a"): (4, 0, 1), (2, "b"): (2, 0, 1), (2, None): (1, 1, 1), (2, "c"): (1, 0, 1)}
