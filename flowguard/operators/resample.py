"""SMOTE oversampling on Spark: exact k nearest neighbours inside each class and
seeded synthetic rows x + u * (neighbour - x).

Neighbours are searched only for rows that a synthetic row starts from, in classes
that need some:

1. the rows of a class are dealt to a metric tree: a node of more than ``BLOCK`` rows is split
   by the nearest of ``FANOUT`` of its rows, drawn by a hash. A leaf is a block, one record of keys and
   a matrix, with centre and radius; a query row's k-th distance inside its own block
   bounds its k-th neighbour from above;
2. inner nodes are balls around their blocks. Pairs of nodes are followed from the root down,
   and left where the triangle inequality (centre distance less both radii) exceeds the bound
   of every query row there, so that no list of all blocks of a class meets another;
3. the blocks of one parent meet the others in slices of about ``SLICE`` blocks, a group each. A pair of
   blocks is one matrix product, whose rounding is bounded: the rows that may be among the k
   nearest are compared by differences. A slice keeps k rows per query row, and the k best over the slices are
   the neighbours.

What is stored per query row is k times the number of slices it met; a block is sent once to every
parent it meets. Where distances separate little (high dimensions),
few block pairs are skipped: that is the cost of exact neighbours.

Synthetic rows are generated as distributed id ranges (chunks), each picking its
base row, neighbour and gap from hashes of (seed, class, id), so the result does
not depend on partitioning or retries.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowguard.functions.columns import hash_unit, q
from flowguard.plans.joins import checked_broadcast
from flowguard.plans.prefix import row_number
from flowguard.session import checkpointed

CHUNK = 50_000
BLOCK = 1_000
#: Children of a tree node, and levels after which rows are split by hash (rows that are all
#: alike have no nearest pivot).
FANOUT = 8
#: Blocks that a group of query blocks meets at once.
SLICE = 32
TREE_LEVELS, HASH_LEVELS = 12, 8


def class_targets(df: DataFrame, label_col: str, target: int | None = None) -> DataFrame:
    """label, n, need, target: every class raised to the majority count (or to
    ``target``); the majority and classes already there need 0."""
    counts = df.groupBy(q(label_col).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    tgt = F.lit(target) if target is not None else F.max("n").over(Window.partitionBy())
    return (counts.withColumn("target", F.greatest(tgt, F.col("n")).cast("long"))
            .withColumn("need", (F.col("target") - F.col("n")).cast("long")))


def _squares(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared distances by one matrix product, and for each row of ``x`` how far they may be off."""
    middle = y.mean(axis=0)
    a, b = x - middle, y - middle
    na, nb = (a * a).sum(axis=1), (b * b).sum(axis=1)
    dim, eps = x.shape[1], np.finfo(float).eps
    # rounding of the product, and of the coordinates less the middle
    moved = 2 * dim ** 0.5 * eps * (max(np.abs(x).max(initial=0), np.abs(y).max(initial=0)) + np.abs(middle).max(initial=0))
    size = na ** 0.5 + nb.max(initial=0) ** 0.5
    return na[:, None] + nb - 2 * (a @ b.T), 4 * (dim + 8) * eps * size ** 2 + 4 * moved * size + moved ** 2


def _nearest(x: np.ndarray, kx: np.ndarray, y: np.ndarray, ky: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of x, row of y, distance) of the k nearest rows of ``y`` (keys ``ky``, ascending) for every
    row of ``x`` but those of its own key; ties by key. Distances by differences (no cancellation)."""
    found = []
    # a row with a missing or infinite value is nobody's neighbour and has none
    rows, cols = np.flatnonzero(np.isfinite(x).all(axis=1)), np.flatnonzero(np.isfinite(y).all(axis=1))
    x, kx, y, ky = x[rows], kx[rows], y[cols], ky[cols]
    step = max(1, 4_000_000 // max(1, len(y)))
    for at in range(0, len(x) if len(y) else 0, step):
        part, keys = x[at:at + step], kx[at:at + step]
        with np.errstate(over="ignore", invalid="ignore"):
            d2, off = _squares(part, y)
        own = np.zeros(d2.shape, dtype=bool)
        lo, hi = np.searchsorted(ky, keys, "left"), np.searchsorted(ky, keys, "right")
        for i in np.flatnonzero(hi > lo):
            own[i, lo[i]:hi[i]] = True
        near = ~own
        if len(y) > k and np.isfinite(off).all():
            d2[own] = np.inf
            near &= d2 <= (np.partition(d2, k - 1, axis=1)[:, k - 1] + 2 * off)[:, None]
        i, j = np.nonzero(near)
        d = np.empty(len(i))
        some = max(1, 4_000_000 // max(1, x.shape[1]))
        with np.errstate(over="ignore"):
            for a in range(0, len(i), some):
                e = part[i[a:a + some]] - y[j[a:a + some]]
                d[a:a + some] = np.sqrt((e * e).sum(axis=1))
        ok = np.isfinite(d)
        i, j, d = i[ok], j[ok], d[ok]
        best = _first(i, d, j, k)
        found.append((rows[i[best] + at], cols[j[best]], d[best]))
    return tuple(np.concatenate(c) for c in zip(*found)) if found else (np.zeros(0, int), np.zeros(0, int), np.zeros(0))


def _first(row: np.ndarray, dist: np.ndarray, key: np.ndarray, k: int) -> np.ndarray:
    """Places of the k least (distance, key) of every row."""
    order = np.lexsort((key, dist, row))
    r = row[order]
    start = np.flatnonzero(np.r_[True, r[1:] != r[:-1]]) if len(r) else np.zeros(0, int)
    rank = np.arange(len(r)) - np.repeat(start, np.diff(np.r_[start, len(r)]))
    return order[rank < k]


def _apart(a: Column, b: Column) -> Column:
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, v: s + v))


def _tree_leaves(rows: DataFrame, block: int, seed: int) -> DataFrame:
    """``rows`` (key, label, x, asks) with ``b``, the leaf of their class's metric tree: ids in base
    FANOUT with a leading 1. A level is a pass over the rows; levels grow with the logarithm
    of rows / block."""
    rows = rows.withColumn("b", F.lit(1).cast("long"))
    for level in range(TREE_LEVELS + HASH_LEVELS):
        big = rows.groupBy("label", "b").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > block).select(
            F.col("label").alias("_l"), F.col("b").alias("_b"))
        big = checkpointed(big)
        if big.limit(1).isEmpty():
            break
        same = F.col("label").eqNullSafe(F.col("_l")) & (F.col("b") == F.col("_b"))
        dice = F.xxhash64(F.lit(seed + level), F.col("key"))
        part = F.pmod(dice, F.lit(FANOUT)).cast("int")
        if level < TREE_LEVELS:
            drawn = (rows.join(checked_broadcast(big), same).groupBy("_l", "_b", part.alias("_i"))
                     .agg(F.min_by("x", dice).alias("_x")).groupBy("_l", "_b")
                     .agg(F.sort_array(F.collect_list(F.struct("_i", "_x"))).alias("_s")).select("_l", "_b", F.col("_s._x").alias("_pivots")))
        else:
            drawn = big.withColumn("_pivots", F.array(F.array().cast("array<double>")))
        far = F.transform("_pivots", lambda p: _apart(F.col("x"), p))
        nearest = F.array_position(far, F.array_min(far)).cast("int") - 1
        child = F.when(F.lit(level >= TREE_LEVELS), part).otherwise(nearest)
        rows = checkpointed(rows.join(checked_broadcast(checkpointed(drawn)), same, "left").withColumn(
            "b", F.when(F.col("_b").isNull(), F.col("b")).otherwise(F.col("b") * FANOUT + child)).drop("_l", "_b", "_pivots"))
    return rows


def _near_blocks(blocks: DataFrame) -> DataFrame:
    """label, b, other: the pairs of blocks (label, b, centre, radius, reach) in which a row of
    the first may have a neighbour in the second."""
    depth = F.floor(F.round(F.log(float(FANOUT), F.col("b").cast("double")), 9)).cast("int")
    leaves = checkpointed(blocks.withColumn("depth", depth))
    most = leaves.agg(F.max("depth")).first()[0] or 0
    # every ancestor of a block, itself at all levels from its own down
    up = leaves.select("*", F.explode(F.sequence(F.lit(0), F.lit(most))).alias("level")).withColumn(
        "node", F.expr(f"b div CAST(pow({FANOUT}, greatest(depth - level, 0)) AS BIGINT)"))
    heart = up.groupBy("label", "level", "node").agg(F.min_by("centre", "b").alias("heart"))
    up = up.join(heart.withColumnsRenamed({"label": "_l", "level": "_v", "node": "_o"}),
                 F.col("label").eqNullSafe(F.col("_l")) & (F.col("level") == F.col("_v")) & (F.col("node") == F.col("_o")))
    nodes = checkpointed(up.groupBy("label", "level", "node").agg(
        F.min_by("centre", "b").alias("heart"), F.max(_apart(F.col("centre"), F.col("heart")) + F.col("radius")).alias("radius"),
        F.max("reach").alias("reach"), F.max("depth").alias("deepest"))
        .withColumn("parent", F.when((F.col("deepest") < F.col("level")), F.col("node")).otherwise(
            F.expr(f"node div {FANOUT}"))))
    pairs = nodes.where("level = 0").select("label", F.col("node").alias("x"), F.col("node").alias("y")).where("x = 1")
    for level in range(most + 1):
        at = nodes.where(F.col("level") == level)
        if level:
            kids = at.select(F.col("label").alias("_l"), "parent", "node")
            pairs = (pairs.join(kids.withColumnsRenamed({"node": "x1"}), F.col("label").eqNullSafe(F.col("_l")) & (F.col("x") == F.col("parent")))
                     .select("label", F.col("x1").alias("x"), "y")
                     .join(kids.withColumnsRenamed({"node": "y1"}), F.col("label").eqNullSafe(F.col("_l")) & (F.col("y") == F.col("parent")))
                     .select("label", "x", F.col("y1").alias("y")))
        ball = lambda side: at.select(F.col("label").alias(f"_l{side}"), F.col("node").alias(f"_n{side}"),
                                      F.col("heart").alias(f"_h{side}"), F.col("radius").alias(f"_r{side}"), F.col("reach").alias(f"_q{side}"))
        pairs = (pairs.join(ball("x"), F.col("label").eqNullSafe(F.col("_lx")) & (F.col("x") == F.col("_nx")))
                 .join(ball("y"), F.col("label").eqNullSafe(F.col("_ly")) & (F.col("y") == F.col("_ny")))
                 .withColumn("_d", _apart(F.col("_hx"), F.col("_hy")))
                 # room for the rounding of far centres and wide balls
                 .where((F.col("_qx") >= 0) & (F.col("_d") - F.col("_rx") - F.col("_ry") <= F.col("_qx") * (1 + 1e-9) + 1e-9
                                               + (F.col("_d") + F.col("_rx") + F.col("_ry")) * 1e-12)).select("label", "x", "y"))
        pairs = checkpointed(pairs)
    return pairs.select("label", F.col("x").alias("b"), F.col("y").alias("other"))


def knn_within_class(df: DataFrame, key_col: str, label_col: str, features: Sequence[str],
                     k: int = 5, seed: int = 42, prefix_method: str = "blocks",
                     query_keys: DataFrame | None = None, block: int = BLOCK) -> DataFrame:
    """key, label, nn_rank (1..k_eff), nn_key, dist: exact k nearest rows of the
    same class (itself excluded; k_eff = min(k, n_class - 1); ties by key).

    ``query_keys`` (one column ``key``, distinct) limits the rows that ask, not the rows
    that may answer. Keys are unique integers; features hold no missing values.
    """
    feats = list(features)
    dim = len(feats)
    base = df.select(q(key_col).cast("long").alias("key"), q(label_col).alias("label"),
                     F.array(*[q(f).cast("double") for f in feats]).alias("x"))
    asks = F.lit(True)
    if query_keys is not None:
        base = base.join(query_keys.select("key", F.lit(True).alias("_q")), "key", "left")
        asks = F.coalesce("_q", F.lit(False))
    base = base.withColumn("asks", asks)
    if query_keys is not None:      # classes without a query row answer nobody
        some = checkpointed(base.where("asks").select(F.col("label").alias("_l")).distinct())
        base = base.join(checked_broadcast(some), F.col("label").eqNullSafe(F.col("_l")), "left_semi")
    placed = _tree_leaves(base.select("key", "label", "x", "asks"), block, seed)
    kind = df.schema[label_col].dataType.simpleString()

    def pack(rows: pa.Table) -> pa.Table:
        x = np.array(rows.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False)).reshape(-1, dim)
        key, ask = rows.column("key").to_numpy(), rows.column("asks").to_numpy()
        order = np.argsort(key)
        x, key, ask = x[order], key[order], ask[order]
        centre = x.mean(axis=0)
        radius = float(np.sqrt(((x - centre) ** 2).sum(axis=1)).max())
        reach = -1.0                          # no query row: meets no other block
        if ask.any():
            reach = float("inf")
            whole = np.isfinite(x).all(axis=1)
            if whole.sum() > k:
                reach, full = 0.0, x[whole]
                own = np.searchsorted(np.flatnonzero(whole), np.flatnonzero(whole & ask))
                step = max(1, 4_000_000 // len(full))
                for at in range(0, len(own), step):
                    with np.errstate(over="ignore", invalid="ignore"):
                        d2, off = _squares(full[own[at:at + step]], full)
                    d2[np.arange(len(d2)), own[at:at + step]] = np.inf
                    kth = np.partition(d2, k - 1, axis=1)[:, k - 1] + off
                    reach = max(reach, float("inf") if np.isnan(kth).any() else float(np.sqrt(np.maximum(kth, 0)).max()))
        return pa.table({
            "label": rows.column("label")[:1], "b": rows.column("b")[:1],
            "keys": [key.tobytes()], "asks": [np.packbits(ask).tobytes()], "mat": [x.tobytes()],
            "centre": pa.array([centre.tolist()], pa.list_(pa.float64())), "radius": [radius], "reach": [reach]})

    packed = checkpointed(placed.select("label", "b", "key", "x", "asks").groupBy("label", "b").applyInArrow(
        pack, f"label {kind}, b long, keys binary, asks binary, mat binary, centre array<double>, radius double, reach double"))
    pairs = _near_blocks(packed.select("label", "b", "centre", "radius", "reach"))
    name = F.to_json(F.struct("label"))         # a key that is never null
    met = pairs.select(name.alias("c"), "b", F.expr(f"b div {FANOUT}").alias("parent"), "other").groupBy("c", "parent", "other").agg(
        F.collect_list("b").alias("bs"))
    slices = checkpointed(met.groupBy("c", "parent").agg(F.ceil(F.count(F.lit(1)) / SLICE).cast("long").alias("slices")))
    left = (packed.where("reach >= 0").select(name.alias("c"), F.expr(f"b div {FANOUT}").alias("parent"), "label", "b", "keys", "asks", "mat")
            .join(slices, ["c", "parent"]).withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1))).drop("slices"))
    right = (met.join(slices, ["c", "parent"]).withColumn("slice", F.pmod(F.xxhash64("other"), F.col("slices"))).drop("slices")
             .join(packed.select(name.alias("c"), F.col("b").alias("other"), F.col("keys").alias("k2"), F.col("mat").alias("m2")).hint("merge"),
                   ["c", "other"]).select("c", "parent", "slice", "other", "bs", "k2", "m2"))

    def nearest(mine: pa.Table, others: pa.Table) -> pa.Table:
        out = []
        buffers = {c: [v.as_buffer() for v in others.column(c)] for c in ("k2", "m2")}
        wanted = [set(b) for b in others.column("bs").to_pylist()]
        for at in range(mine.num_rows):
            b = mine.column("b")[at].as_py()
            keys = np.frombuffer(mine.column("keys")[at].as_buffer(), np.int64)
            ask = np.unpackbits(np.frombuffer(mine.column("asks")[at].as_buffer(), np.uint8), count=len(keys)).astype(bool)
            x = np.frombuffer(mine.column("mat")[at].as_buffer()).reshape(-1, dim)[ask]
            keys = keys[ask]
            found = []
            for o, bs in enumerate(wanted):
                if b in bs:
                    ky = np.frombuffer(buffers["k2"][o], np.int64)
                    i, j, d = _nearest(x, keys, np.frombuffer(buffers["m2"][o]).reshape(-1, dim), ky, k)
                    found.append((i, d, ky[j]))
            if found:
                i, d, nn = (np.concatenate(c) for c in zip(*found))
                best = _first(i, d, nn, k)
                out.append((keys[i[best]], nn[best], d[best]))
        key, nn, d = (np.concatenate(c) for c in zip(*out)) if out else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        kind_of = mine.schema.field("label").type if mine.num_rows else pa.null()
        label = mine.column("label")[0].as_py() if mine.num_rows else None
        return pa.table({"key": key, "label": pa.array([label] * len(key), kind_of), "nn_key": nn, "dist": d})

    by = ["c", "parent", "slice"]
    found = left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(nearest, f"key long, label {kind}, nn_key long, dist double")
    rank = F.row_number().over(Window.partitionBy("key").orderBy("dist", "nn_key"))
    return (found.withColumn("nn_rank", rank).where(F.col("nn_rank") <= k)
            .select("key", "label", "nn_rank", "nn_key", "dist"))


def synthetic_rows(df: DataFrame, key_col: str, label_col: str, features: Sequence[str], k: int = 5,
                   seed: int = 42, target: int | None = None, prefix_method: str = "blocks",
                   block: int = BLOCK) -> DataFrame:
    """label, j, base_key, nn_key, gap and the features of every synthetic row.

    Synthetic row j of class c: base = the row of rank 1 + floor(h_b * n_c) in
    key order, neighbour = its (1 + floor(h_n * k_eff))-th nearest, gap u = h_u,
    with h_* = hash(seed, c, j, *) in [0, 1). A class of one row repeats it.
    """
    feats = list(features)
    plan = checkpointed(class_targets(df, label_col, target).where(F.col("need") > 0))
    # id chunks: each row of ``chunks`` expands to at most CHUNK synthetic ids
    chunks = plan.select("label", "n", "need", F.explode(F.sequence(
        F.lit(0), F.floor((F.col("need") - 1) / CHUNK).cast("int"))).alias("chunk"))
    ids = (chunks.repartition("label", "chunk")
           .select("label", "n", F.explode(F.sequence(
               F.col("chunk") * CHUNK + 1,
               F.least(F.col("need"), (F.col("chunk") + 1) * CHUNK))).alias("j")))
    lab = F.col("label").cast("string")
    ids = ids.select("label", "n", "j",
                     (F.floor(hash_unit(seed, lab, "j", F.lit("b")) * F.col("n")) + 1)
                     .cast("long").alias("base_rank"),
                     hash_unit(seed, lab, "j", F.lit("n")).alias("hn"),
                     hash_unit(seed, lab, "j", F.lit("u")).alias("gap"))

    # rows of the classes that need synthetic ones
    few = df.select(q(key_col).cast("long").alias("key"), q(label_col).alias("label"),
                    *[q(f).cast("double").alias(f) for f in feats]).join(
        checked_broadcast(plan.select("label")), "label")
    rank_of = checkpointed(row_number(few.select("label", "key"), ["key"], ["label"], out="base_rank",
                                      method=prefix_method))
    drawn = checkpointed(ids.join(rank_of.withColumnRenamed("key", "base_key"), ["label", "base_rank"]))
    knn = checkpointed(knn_within_class(few, "key", "label", feats, k, seed, prefix_method,
                                        drawn.select(F.col("base_key").alias("key")).distinct(), block))
    k_eff = plan.select(F.col("label").alias("_label"), F.least(F.lit(k), F.col("n") - 1).alias("k_eff"))
    bases = (drawn.join(checked_broadcast(k_eff), F.col("label") == F.col("_label"))
             .withColumn("nn_rank", (F.floor(F.col("hn") * F.greatest("k_eff", F.lit(1))) + 1).cast("int")))
    nn = knn.select(F.col("key").alias("base_key"), "nn_rank", "nn_key")
    own = few.select(F.col("key").alias("base_key"), *feats)
    other = few.select(F.col("key").alias("nn_key"), *[F.col(f).alias(f"_nn_{f}") for f in feats])
    return (bases.join(nn, ["base_key", "nn_rank"], "left").join(own, "base_key").join(other, "nn_key", "left")
            .select("label", "j", "base_key", "nn_key", "gap", *[
                (F.col(f) + F.col("gap") * (F.coalesce(F.col(f"_nn_{f}"), F.col(f)) - F.col(f))).alias(f)
                for f in feats]))


def smote(df: DataFrame, key_col: str, label_col: str, features: Sequence[str], k: int = 5,
          seed: int = 42, target: int | None = None, synthetic_col: str = "synthetic",
          prefix_method: str = "blocks") -> DataFrame:
    """Input rows plus the ``synthetic_rows`` that raise each class to the majority count.
    Synthetic keys are null; ``synthetic_col`` marks them."""
    feats = list(features)
    synth = synthetic_rows(df, key_col, label_col, feats, k, seed, target, prefix_method).select(
        F.lit(None).cast(df.schema[key_col].dataType).alias(key_col),
        F.col("label").alias(label_col), *feats, F.lit(True).alias(synthetic_col))
    orig = df.select(q(key_col), q(label_col), *[q(f).cast("double").alias(f) for f in feats],
                     F.lit(False).alias(synthetic_col))
    return orig.unionByName(synth)
