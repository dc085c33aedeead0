import numpy as np
import pytest

from flowguard.operators import resample


def frame(spark, pts, labels):
    return spark.createDataFrame([(i, *map(float, p), c) for i, (p, c) in enumerate(zip(pts, labels))],
                                 "id long, " + ", ".join(f"f{j} double" for j in range(len(pts[0]))) + ", c string")


def brute(pts, labels, k):
    out = {}
    for i, p in enumerate(pts):
        same = [j for j in range(len(pts)) if j != i and labels[j] == labels[i]]
        d = {j: float(np.sqrt(((pts[i] - pts[j]) ** 2).sum())) for j in same}
        for r, j in enumerate(sorted(same, key=lambda j: (d[j], j))[:k], 1):
            out[i, r] = j
    return out


CASES = {
    "far outliers": lambda rng: (np.concatenate([rng.normal(0, 1e-3, (40, 2)), [[1e9, 0], [0, -1e9]]]), ["a"] * 42),
    "exact duplicates": lambda rng: (np.repeat(rng.integers(0, 3, (10, 2)).astype(float), 6, axis=0), ["a"] * 30 + ["b"] * 30),
    "one class 100 times the other": lambda rng: (rng.normal(0, 1, (404, 3)), ["a"] * 400 + ["b"] * 4),
    "one dimension apart": lambda rng: (np.column_stack([np.arange(90.0), np.zeros(90)]), ["a"] * 90),
}


@pytest.mark.parametrize("name", CASES)
def test_neighbours_equal_brute_force_over_blocks(spark, name):
    pts, labels = CASES[name](np.random.default_rng(3))
    feats = [f"f{j}" for j in range(pts.shape[1])]
    got = resample.knn_within_class(frame(spark, pts, labels), "id", "c", feats, 5, block=13).collect()
    assert {(r["key"], r["nn_rank"]): r["nn_key"] for r in got} == brute(pts, labels, 5)


def test_only_asked_rows_and_needy_classes(spark):
    rng = np.random.default_rng(1)
    pts, labels = rng.normal(0, 1, (60, 2)), ["a"] * 50 + ["b"] * 9 + ["c"]
    df = frame(spark, pts, labels)
    asked = spark.createDataFrame([(3,), (55,)], "key long")
    got = resample.knn_within_class(df, "id", "c", ["f0", "f1"], 5, query_keys=asked, block=8).collect()
    want = brute(pts, labels, 5)
    assert {(r["key"], r["nn_rank"]): r["nn_key"] for r in got} == {k: v for k, v in want.items() if k[0] in (3, 55)}
    synth = resample.synthetic_rows(df, "id", "c", ["f0", "f1"]).collect()
    assert {c: sum(r["label"] == c for r in synth) for c in "abc"} == {"a": 0, "b": 41, "c": 49}
    for r in synth:
        a = pts[r["base_key"]]
        b = pts[r["nn_key"]] if r["nn_key"] is not None else a      # a class of one row repeats it
        assert labels[r["base_key"]] == r["label"]
        assert np.allclose([r["f0"], r["f1"]], a + r["gap"] * (b - a))
        if r["label"] == "b":
            assert r["nn_key"] in {v for (i, _), v in want.items() if i == r["base_key"]}


def test_tree_skips_most_pairs_in_few_dimensions(spark, capsys):
    """Share of the block pairs that are compared: small in three dimensions, all in many."""
    rng = np.random.default_rng(9)
    shares = {}
    for dim in (3, 40):
        pts = rng.random((3000, dim))
        df = frame(spark, pts, ["a"] * 3000)
        seen = {}
        plain = resample._near_blocks

        def counted(blocks):
            out = plain(blocks)
            seen["n"], seen["pairs"] = blocks.count(), out.count()
            return out
        resample._near_blocks = counted
        try:
            got = resample.knn_within_class(df, "id", "c", [f"f{j}" for j in range(dim)], 5, block=60).collect()
        finally:
            resample._near_blocks = plain
        shares[dim] = seen["pairs"] / seen["n"] ** 2
        d = np.sqrt(np.maximum((pts ** 2).sum(axis=1)[:, None] + (pts ** 2).sum(axis=1) - 2 * pts @ pts.T, 0))
        np.fill_diagonal(d, np.inf)
        near = np.sort(d, axis=1)[:, :5]
        mine = np.zeros_like(near)
        for r in got:
            mine[r["key"], r["nn_rank"] - 1] = r["dist"]
        assert np.allclose(near, mine)
    with capsys.disabled():
        print(f" compared block pairs: {shares} ", end="")
    assert shares[3] < 0.5 and shares[40] <= 1
