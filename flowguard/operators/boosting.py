"""Multi-class gradient boosting with a joint softmax loss, as a Spark ML estimator.

A round fits one regression tree per class to the residuals (class indicator less
probability) of all classes at once; leaves get the Newton step (K-1)/K * sum(r) /
sum(|r| (1 - |r|)), as in Friedman's multi-class algorithm.

Rows are packed once to blocks of binned features (one byte a value) and written to the checkpoint
folder. A tree level is one job: every task routes its rows through the trees so far and adds
up histograms of residuals by (class, node, feature, bin); histograms are summed by (class,
feature), where the best cut of every node is found. The driver sees one row per (class, node,
feature), the trees, and never rows.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.ml.param.shared import (HasFeaturesCol, HasLabelCol, HasMaxIter, HasPredictionCol, HasProbabilityCol,
                                     HasRawPredictionCol, HasSeed, HasStepSize, Param, Params, TypeConverters)
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowguard.session import checkpointed

BLOCK_ROWS = 4096
#: Rows a task takes of the table, whatever the number of shuffle partitions: a round is a few jobs
#: over all of them, so that tasks of few rows would cost more to start than to run.
TASK_ROWS = 100_000
#: Rounds between two checkpoints of the scores.
CHECKPOINT_ROUNDS = 10
_LEAST_GAIN = 1e-12


class Tree:
    """A binary tree in arrays: feature (-1 in a leaf), cut (a bin or a value; smaller or equal
    goes left), children and value."""

    def __init__(self, feature=(-1,), cut=(0,), left=(0,), right=(0,), value=(0.0,)):
        self.feature, self.cut, self.left, self.right = list(feature), list(cut), list(left), list(right)
        self.value = list(value)

    def split(self, node: int, feature: int, cut) -> tuple[int, int]:
        a = len(self.feature)
        self.feature[node], self.cut[node], self.left[node], self.right[node] = feature, cut, a, a + 1
        for column, empty in ((self.feature, -1), (self.cut, 0), (self.left, 0), (self.right, 0), (self.value, 0.0)):
            column += [empty, empty]
        return a, a + 1

    def route(self, columns: np.ndarray) -> np.ndarray:
        """The leaf (or node without children so far) of each row; ``columns`` is features x rows.
        A missing value (NaN) goes left."""
        feature, cut = np.array(self.feature), np.array(self.cut)
        left, right = np.array(self.left), np.array(self.right)
        node = np.zeros(columns.shape[1], dtype=np.int64)
        rows = np.arange(columns.shape[1])
        while len(rows):
            rows = rows[feature[node[rows]] >= 0]
            at = node[rows]
            more = columns[feature[at], rows] > cut[at]
            node[rows] = np.where(more, right[at], left[at])
        return node

    def lists(self) -> list:
        return [self.feature, self.cut, self.left, self.right, self.value]


def softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


_BLOCK = "id long, n int, bins binary, y binary, scores binary"


def _pack(cuts: list[np.ndarray], start: np.ndarray):
    """Rows (x, y, part) to blocks of binned features, classes and scores to start from."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seq = 0
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                n = part.num_rows
                x = part.column("x").flatten().to_numpy(zero_copy_only=False).reshape(n, len(cuts))
                bins = np.stack([np.where(np.isnan(x[:, f]), 0, np.searchsorted(c, x[:, f])) for f, c in enumerate(cuts)])
                y = part.column("y").to_numpy(zero_copy_only=False).astype("<u2")
                yield pa.RecordBatch.from_arrays([
                    pa.array([(part.column("part")[0].as_py() << 32) + seq], pa.int64()), pa.array([n], pa.int32()),
                    pa.array([bins.astype(np.uint8).tobytes()], pa.binary()), pa.array([y.tobytes()], pa.binary()),
                    pa.array([np.tile(start, (n, 1)).tobytes()], pa.binary())], ["id", "n", "bins", "y", "scores"])
                seq += 1
    return pack


def _blocks(batches: Iterator[pa.RecordBatch], features: int, classes: int):
    for batch in batches:
        for i in range(batch.num_rows):
            row = {c: batch.column(c)[i].as_py() for c in ("id", "n", "bins", "y", "scores")}
            n = row["n"]
            yield (row, np.frombuffer(row["bins"], np.uint8).reshape(features, n), np.frombuffer(row["y"], "<u2"),
                   np.frombuffer(row["scores"]).reshape(n, classes))


def _advance(trees: list[Tree], rate: float, features: int):
    """Blocks with the scores raised by a round's trees."""
    def advance(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, bins, _, scores in _blocks(batches, features, len(trees)):
            step = np.stack([np.array(t.value)[t.route(bins)] for t in trees], axis=1)
            yield pa.RecordBatch.from_arrays([
                pa.array([row["id"]], pa.int64()), pa.array([row["n"]], pa.int32()), pa.array([row["bins"]], pa.binary()),
                pa.array([row["y"]], pa.binary()), pa.array([(scores + rate * step).tobytes()], pa.binary())],
                ["id", "n", "bins", "y", "scores"])
    return advance


_SUMS = "k int, f int, sums binary"


def _histograms(trees: list[Tree], open_nodes: list[list[int]], features: int, bins_most: int, share: float, draw: list[int]):
    """Sums of (residual, hessian, rows) by open node and bin of every (class, feature), and
    under (-1, -1) the loss and the rows."""
    def histograms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = len(trees)
        sums = [np.zeros((features, len(nodes) * bins_most, 3)) for nodes in open_nodes]
        loss = np.zeros(2)
        for row, bins, y, scores in _blocks(batches, features, classes):
            p = softmax(scores)
            loss += (-np.log(np.maximum(p[np.arange(len(y)), y], 1e-300)).sum(), len(y))
            # the rows of a round: the same in every job, whatever task has the block
            used = None if share >= 1 else np.random.default_rng([*draw, row["id"]]).random(len(y)) < share
            for k, nodes in enumerate(open_nodes):
                if not nodes:
                    continue
                place = np.full(len(trees[k].feature), -1)
                place[nodes] = np.arange(len(nodes))
                node = place[trees[k].route(bins)]
                rows = np.flatnonzero(node >= 0 if used is None else (node >= 0) & used)
                r = (y[rows] == k) - p[rows, k]
                h = p[rows, k] * (1 - p[rows, k])
                own, every = node[rows] * bins_most, len(rows) == len(y)
                size = len(nodes) * bins_most
                for f in range(features):
                    cell = own + (bins[f] if every else bins[f, rows])
                    sums[k][f, :, 0] += np.bincount(cell, r, size)
                    sums[k][f, :, 1] += np.bincount(cell, h, size)
                    sums[k][f, :, 2] += np.bincount(cell, minlength=size)
        out = [(k, f, sums[k][f].tobytes()) for k in range(classes) if open_nodes[k] for f in range(features)]
        out.append((-1, -1, loss.tobytes()))
        yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int32()), pa.array([o[1] for o in out], pa.int32()),
                                          pa.array([o[2] for o in out], pa.binary())], ["k", "f", "sums"])
    return histograms


_CUTS = "k int, f int, node int, gain double, cut int, own array<double>, left array<double>"


def _best_cuts(bins_most: int, least_rows: int):
    """The best cut of every node by one feature: the largest n_l n_r / (n_l + n_r) * (mean_l -
    mean_r)^2, the first of equals."""
    def best(rows: pa.Table) -> pa.Table:
        k, f = rows.column("k")[0].as_py(), rows.column("f")[0].as_py()
        total = np.sum([np.frombuffer(b) for b in rows.column("sums").to_pylist()], axis=0)
        if k < 0:
            return pa.table([pa.array([k], pa.int32()), pa.array([f], pa.int32()), pa.array([0], pa.int32()),
                             pa.array([0.0]), pa.array([0], pa.int32()), pa.array([total.tolist()], pa.list_(pa.float64())),
                             pa.array([[]], pa.list_(pa.float64()))], names=["k", "f", "node", "gain", "cut", "own", "left"])
        left = np.cumsum(total.reshape(-1, bins_most, 3), axis=1)
        own = left[:, -1:, :]
        right = own - left
        nl, nr = left[:, :, 2], right[:, :, 2]
        ok = (nl >= least_rows) & (nr >= least_rows) & (nl > 0) & (nr > 0)
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = np.where(ok, nl * nr / (nl + nr) * (left[:, :, 0] / nl - right[:, :, 0] / nr) ** 2, 0.0)
        cut = gain.argmax(axis=1)
        at = np.arange(len(cut))
        n = len(cut)
        return pa.table([pa.array([k] * n, pa.int32()), pa.array([f] * n, pa.int32()), pa.array(at, pa.int32()),
                         pa.array(gain[at, cut]), pa.array(cut, pa.int32()),
                         pa.array(own[:, 0].tolist(), pa.list_(pa.float64())),
                         pa.array(left[at, cut].tolist(), pa.list_(pa.float64()))],
                        names=["k", "f", "node", "gain", "cut", "own", "left"])
    return best


class _BoostingParams(HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol, HasRawPredictionCol, HasMaxIter,
                      HasStepSize, HasSeed):
    maxDepth = Param(Params._dummy(), "maxDepth", "levels of a tree", TypeConverters.toInt)
    maxBins = Param(Params._dummy(), "maxBins", "bins a feature, at most 256", TypeConverters.toInt)
    minInstancesPerNode = Param(Params._dummy(), "minInstancesPerNode", "least rows of a child", TypeConverters.toInt)
    minSamplesSplit = Param(Params._dummy(), "minSamplesSplit", "least rows of a node that is split", TypeConverters.toInt)
    subsamplingRate = Param(Params._dummy(), "subsamplingRate", "share of the rows a round fits", TypeConverters.toFloat)


class SoftmaxBoostingModel(Model, _BoostingParams, DefaultParamsReadable, DefaultParamsWritable):
    """Trees by round and class. ``rawPrediction`` holds the scores, ``probability`` their softmax."""

    ensemble = Param(Params._dummy(), "ensemble", "start scores, trees and importances (JSON)", TypeConverters.toString)

    @keyword_only
    def __init__(self, featuresCol="features", predictionCol="prediction", probabilityCol="probability",
                 rawPredictionCol="rawPrediction", ensemble=None):
        super().__init__()
        self._setDefault(featuresCol="features", predictionCol="prediction", probabilityCol="probability",
                         rawPredictionCol="rawPrediction")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _parts(self) -> dict:
        return json.loads(self.getOrDefault(self.ensemble))

    @property
    def featureImportances(self) -> DenseVector:
        """Total gain of the cuts by each feature, as shares."""
        return Vectors.dense(self._parts()["importances"])

    @property
    def lossHistory(self) -> list[float]:
        """Mean log loss of the training rows ahead of each round."""
        return self._parts()["loss"]

    @property
    def numClasses(self) -> int:
        return len(self._parts()["start"])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        parts = self._parts()
        start, rate = np.array(parts["start"]), parts["rate"]
        rounds = [[Tree(*t) for t in trees] for trees in parts["trees"]]
        width = parts["features"]

        @F.pandas_udf("array<double>")
        def scores(x: pd.Series) -> pd.Series:
            columns = np.array(x.tolist(), dtype=np.float64).reshape(len(x), width).T
            out = np.tile(start, (len(x), 1))
            for trees in rounds:
                for k, t in enumerate(trees):
                    out[:, k] += rate * np.array(t.value)[t.route(columns)]
            return pd.Series(list(out))

        raw, prob = self.getRawPredictionCol(), self.getProbabilityCol()
        tmp = next(n for n in (f"_scores{i}" for i in range(len(dataset.columns) + 1)) if n not in dataset.columns)
        s = F.col(tmp)
        top = F.array_max(s)
        e = F.transform(s, lambda v: F.exp(v - top))
        total = F.aggregate(e, F.lit(0.0), lambda a, v: a + v)
        return (dataset.withColumn(tmp, scores(vector_to_array(F.col(self.getFeaturesCol()))))
                .withColumn(raw, array_to_vector(s))
                .withColumn(prob, array_to_vector(F.transform(e, lambda v: v / total)))
                .withColumn(self.getPredictionCol(), (F.array_position(s, top) - 1).cast("double")).drop(tmp))


class SoftmaxBoosting(Estimator, _BoostingParams, DefaultParamsReadable, DefaultParamsWritable):
    """Boosted trees for labels 0..K-1. Missing features (NaN) go to the left child. A single
    class gives a model without trees. Labels must not be null."""

    @keyword_only
    def __init__(self, featuresCol="features", labelCol="label", predictionCol="prediction", probabilityCol="probability",
                 rawPredictionCol="rawPrediction", maxIter=100, stepSize=0.1, maxDepth=3, maxBins=256,
                 minInstancesPerNode=1, minSamplesSplit=2, subsamplingRate=1.0, seed=42):
        super().__init__()
        self._setDefault(featuresCol="features", labelCol="label", predictionCol="prediction", probabilityCol="probability",
                         rawPredictionCol="rawPrediction", maxIter=100, stepSize=0.1, maxDepth=3, maxBins=256,
                         minInstancesPerNode=1, minSamplesSplit=2, subsamplingRate=1.0, seed=42)
        self._set(**self._input_kwargs)

    def _cuts(self, rows: DataFrame, width: int) -> list[np.ndarray]:
        """Ascending cuts of every feature: halfway between neighbouring quantiles."""
        most = min(self.getOrDefault(self.maxBins), 256)
        split = rows.select(*[F.nanvl(F.col("x")[f], F.lit(None).cast("double")).alias(f"_{f}") for f in range(width)])
        at = [i / most for i in range(most + 1)]
        out = []
        for q in split.approxQuantile(split.columns, at, 0.1 / most):
            v = np.unique(np.array([x for x in q if x is not None and np.isfinite(x)]))
            out.append((v[1:] + v[:-1]) / 2)
        return out

    def _fit(self, dataset: DataFrame) -> SoftmaxBoostingModel:
        get = self.getOrDefault
        rows = dataset.select(vector_to_array(F.col(self.getFeaturesCol())).alias("x"), F.col(self.getLabelCol()).alias("y"))
        counts = {int(r["y"]): r["n"] for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
        if not counts:
            raise ValueError("no rows to fit")
        first = rows.select(F.size("x")).first()[0]
        classes, total = max(counts) + 1, sum(counts.values())
        start = np.log(np.maximum([counts.get(k, 0) / total for k in range(classes)], 1e-10))
        cuts = self._cuts(rows, first)
        bins_most = max((len(c) for c in cuts), default=0) + 1
        trees: list[list[Tree]] = []
        gains, loss = np.zeros(first), []
        rate = get(self.stepSize)
        if classes > 1 and bins_most > 1:
            n = max(-(-total // TASK_ROWS), min(rows.sparkSession.sparkContext.defaultParallelism, -(-total // BLOCK_ROWS)))
            state = checkpointed(rows.withColumn("part", F.spark_partition_id().cast("long"))
                                 .mapInArrow(_pack(cuts, start), _BLOCK).repartition(n, "id"))
            before = None
            for t in range(get(self.maxIter)):
                state.persist(StorageLevel.MEMORY_AND_DISK)
                round_trees = self._round(state, t, classes, first, bins_most, gains, loss)
                if before is not None:
                    before.unpersist()      # its successor has been computed by now
                trees.append([Tree(t.feature, [float(cuts[f][c]) if f >= 0 else 0.0 for f, c in zip(t.feature, t.cut)],
                                   t.left, t.right, t.value) for t in round_trees])
                before, state = state, state.mapInArrow(_advance(round_trees, rate, first), _BLOCK)
                if (t + 1) % CHECKPOINT_ROUNDS == 0:
                    state = checkpointed(state)
            if before is not None:
                before.unpersist()
        made = {"start": start.tolist(), "rate": rate, "features": first, "loss": loss,
                "importances": (gains / gains.sum() if gains.sum() else gains).tolist(),
                "trees": [[t.lists() for t in trees_] for trees_ in trees]}
        return SoftmaxBoostingModel(
            featuresCol=self.getFeaturesCol(), predictionCol=self.getPredictionCol(), probabilityCol=self.getProbabilityCol(),
            rawPredictionCol=self.getRawPredictionCol(), ensemble=json.dumps(made))

    def _round(self, state: DataFrame, t: int, classes: int, width: int, bins_most: int, gains: np.ndarray,
               loss: list[float]) -> list[Tree]:
        get = self.getOrDefault
        trees = [Tree() for _ in range(classes)]
        open_nodes = [[0] for _ in range(classes)]
        newton = (classes - 1) / classes
        for level in range(get(self.maxDepth)):
            found = (state.mapInArrow(_histograms(trees, open_nodes, width, bins_most, get(self.subsamplingRate),
                                                  [get(self.seed) % 2**32, t]), _SUMS)
                     .groupBy("k", "f").applyInArrow(_best_cuts(bins_most, get(self.minInstancesPerNode)), _CUTS).collect())
            if level == 0:
                own = next(r["own"] for r in found if r["k"] < 0)
                loss.append(own[0] / own[1])
            best: dict[tuple[int, int], object] = {}
            for r in sorted((r for r in found if r["k"] >= 0), key=lambda r: (r["k"], r["node"], -r["gain"], r["f"])):
                best.setdefault((r["k"], r["node"]), r)
            after: list[list[int]] = [[] for _ in range(classes)]
            for (k, at), r in best.items():
                node, tree = open_nodes[k][at], trees[k]
                tree.value[node] = newton * r["own"][0] / r["own"][1] if r["own"][1] > 1e-150 else 0.0
                if r["gain"] <= _LEAST_GAIN or r["own"][2] < get(self.minSamplesSplit):
                    continue
                gains[r["f"]] += r["gain"]
                a, b = tree.split(node, r["f"], r["cut"])
                for child, sums in ((a, np.array(r["left"])), (b, np.array(r["own"]) - np.array(r["left"]))):
                    tree.value[child] = newton * sums[0] / sums[1] if sums[1] > 1e-150 else 0.0
                after[k] += [a, b]
            open_nodes = after
            if not any(open_nodes):
                break
        return trees
