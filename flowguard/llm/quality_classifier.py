"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages of ``passage_words`` words. Every passage is encoded by a
small network over hashed words, hashed word shapes and text statistics; gated
attention, learned from the labels of whole documents alone, weighs the passages;
the weighted sum is the document's representation, which a logistic unit scores.

Training uses a sample of at most ``sample`` labelled documents with at most ``passages``
passages in all (parameters of the fit only: they bound what the driver holds), chosen by
a hash of the id; one row of an id that repeats. Every document is
scored on its whole text, without any shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowguard.llm.common import Words, mix64, window_hashes
from flowguard.session import checkpointed

PASSAGE_WORDS = 100
SAMPLE = 3000
PASSAGES = 100_000
WORD_BUCKETS = 256
SHAPE_BUCKETS = 64
HIDDEN = 32
THRESHOLD = 0.3

# classes of bytes: lower, upper, digit, sentence mark, other ASCII mark, beyond ASCII
_CLASS = np.zeros(256, dtype=np.int64)
_CLASS[ord("a"):ord("z") + 1] = 1
_CLASS[ord("A"):ord("Z") + 1] = 2
_CLASS[ord("0"):ord("9") + 1] = 3
_CLASS[[ord(c) for c in ".,;:?!'\"()-"]] = 4
_CLASS[[c for c in range(33, 127) if _CLASS[c] == 0]] = 5
_CLASS[128:] = 6
_STATS = 6 + 7
N_FEATURES = WORD_BUCKETS + SHAPE_BUCKETS + _STATS


def passage_features(texts: list[str | None], passage_words: int = PASSAGE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Features of every passage and the index of its text. A text without words has
    one passage of zeros."""
    words = Words([(t or "").encode("utf-8") for t in texts])
    n = len(words.start)
    per = np.maximum(1, -(-words.count // passage_words))
    first = np.concatenate(([0], np.cumsum(per)[:-1])).astype(np.int64)
    owner = np.repeat(np.arange(len(texts)), per)
    out = np.zeros((len(owner), N_FEATURES), dtype=np.float32)
    if not n:
        return out, owner
    at = first[words.doc] + words.pos // passage_words
    h = words.hashes()
    size = np.bincount(at, minlength=len(owner)).astype(np.float32)
    size[size == 0] = 1

    def spread(bucket: np.ndarray, buckets: int) -> np.ndarray:
        grid = np.bincount(at * buckets + bucket, minlength=len(owner) * buckets).reshape(-1, buckets)
        return np.sqrt(grid / size[:, None])

    out[:, :WORD_BUCKETS] = spread((h % np.uint64(WORD_BUCKETS)).astype(np.int64), WORD_BUCKETS)
    # shape: the classes of a word's first byte, its last two, and what else occurs
    kind = _CLASS[words.buf]
    solid = np.zeros(len(words.buf) + 1, dtype=np.int64)
    inside = []
    for c in range(1, 7):
        np.cumsum(kind == c, out=solid[1:])
        inside.append(solid[words.end] - solid[words.start])
    counts = np.stack(inside, axis=1)
    shape = kind[words.start] + 7 * kind[words.end - 1] + 49 * kind[np.maximum(words.end - 2, words.start)]
    shape = shape * 64 + ((counts > 0) * (1 << np.arange(6))).sum(axis=1)
    shape = (mix64(shape.astype(np.uint64)) % np.uint64(SHAPE_BUCKETS)).astype(np.int64)
    out[:, WORD_BUCKETS:WORD_BUCKETS + SHAPE_BUCKETS] = spread(shape, SHAPE_BUCKETS)

    def total(x: np.ndarray) -> np.ndarray:
        return np.bincount(at, weights=x, minlength=len(owner))

    length = (words.end - words.start).astype(float)
    letters = np.maximum(total(length), 1)
    stats = [total(counts[:, c]) / letters for c in range(6)]
    # of the words and word triples of the text, how many in the passage are repeats
    doc_of = words.doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)

    def repeats(keys: np.ndarray, where: np.ndarray) -> np.ndarray:
        _, place, count = np.unique(keys, return_inverse=True, return_counts=True)
        return np.bincount(where, weights=count[place] > 1, minlength=len(owner)) / size

    triple = window_hashes(h, 3)
    same = np.flatnonzero(words.doc[:len(triple)] == words.doc[2:2 + len(triple)]) if len(triple) else np.zeros(0, int)
    stats += [total(length) / size / 10, repeats(h + doc_of, at),
              repeats(triple[same] + doc_of[same], at[same]),
              total(np.concatenate(([0.0], (h[1:] == h[:-1]).astype(float)))) / size,
              total(length > 20) / size, total(length <= 2) / size,
              (np.log1p(words.count[owner]) / 10)]
    out[:, WORD_BUCKETS + SHAPE_BUCKETS:] = np.stack(stats, axis=1)
    return out, owner


class Model(NamedTuple):
    mean: np.ndarray
    scale: np.ndarray
    enc: np.ndarray         # features -> hidden
    enc0: np.ndarray
    gate_v: np.ndarray      # gated attention
    gate_u: np.ndarray
    gate_w: np.ndarray
    out: np.ndarray
    out0: np.ndarray


def _segments(owner: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))


def _forward(m: Model, x: np.ndarray, owner: np.ndarray):
    """x: standardised features, passages of one text side by side."""
    start = _segments(owner)
    bag = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(owner))))
    h = np.tanh(x @ m.enc + m.enc0)
    t, g = np.tanh(h @ m.gate_v), 1 / (1 + np.exp(-(h @ m.gate_u)))
    a = (t * g) @ m.gate_w
    a = np.exp(a - np.maximum.reduceat(a, start)[bag])
    a = a / np.add.reduceat(a, start)[bag]
    z = np.add.reduceat(a[:, None] * h, start)
    p = 1 / (1 + np.exp(-np.clip(z @ m.out + m.out0[0], -30, 30)))
    return start, bag, h, t, g, a, z, p


def train(x: np.ndarray, owner: np.ndarray, label: np.ndarray, epochs: int = 30, rate: float = 2e-3,
          decay: float = 1e-4, seed: int = 5) -> Model:
    """Fit by Adam on batches of 64 bags. ``owner`` ascends from 0; ``label`` by bag."""
    rng = np.random.default_rng(seed)
    f = x.shape[1]
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    w = lambda *s: (rng.normal(size=s) / np.sqrt(s[0])).astype(np.float32)
    share = np.clip(label.mean(), 0.02, 0.98)
    m = Model(mean, scale, w(f, HIDDEN), np.zeros(HIDDEN, np.float32), w(HIDDEN, HIDDEN), w(HIDDEN, HIDDEN),
              w(HIDDEN), w(HIDDEN) * 0, np.array([np.log(share / (1 - share))], np.float32))
    x = (x - mean) / scale
    first = np.append(_segments(owner), len(owner))
    fit = list(m[2:])
    low, high = [np.zeros_like(v) for v in fit], [np.zeros_like(v) for v in fit]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(label))
        for at in range(0, len(order), 64):
            bags = np.sort(order[at:at + 64])
            rows = np.concatenate([np.arange(first[b], first[b + 1]) for b in bags])
            xb, yb = x[rows], label[bags]
            m = Model(mean, scale, *fit)
            start, bag, h, t, g, a, z, p = _forward(m, xb, owner[rows])
            d = (p - yb) / len(bags)
            dz = d[:, None] * m.out
            da_ = (dz[bag] * h).sum(axis=1)
            da = a * (da_ - np.add.reduceat(a * da_, start)[bag])
            dt = da[:, None] * m.gate_w * g * (1 - t * t)
            dg = da[:, None] * m.gate_w * t * g * (1 - g)
            dh = a[:, None] * dz[bag] + dt @ m.gate_v.T + dg @ m.gate_u.T
            de = dh * (1 - h * h)
            grads = [xb.T @ de, de.sum(axis=0), h.T @ dt, h.T @ dg, (t * g).T @ da, z.T @ d, np.array([d.sum()])]
            step += 1
            for k, gr in enumerate(grads):
                gr = gr + decay * fit[k] * (k not in (1, 6))
                low[k] = 0.9 * low[k] + 0.1 * gr
                high[k] = 0.999 * high[k] + 0.001 * gr * gr
                fit[k] = (fit[k] - rate * (low[k] / (1 - 0.9 ** step)) / (
                    np.sqrt(high[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    return Model(mean, scale, *fit)


def score_texts(m: Model, texts: list[str | None], passage_words: int = PASSAGE_WORDS) -> np.ndarray:
    x, owner = passage_features(texts, passage_words)
    return _forward(m, (x - m.mean) / m.scale, owner)[-1]


def fit_classifier(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   label_id_col: str = "doc_id", label_col: str = "quality", sample: int = SAMPLE,
                   passage_words: int = PASSAGE_WORDS, passages: int = PASSAGES) -> Model | None:
    """The model, fitted on the labelled rows given; None without labelled texts.

    Of rows that share a chosen id the one with the least text hash is taken. Documents are
    taken in the order of their id's hash while their passages fit in ``passages``; one
    that does not fit is passed over (the shortest is taken if none fits).
    """
    chosen = (labels.where(F.col(label_id_col).isNotNull() & F.col(label_col).isNotNull())
              .groupBy(F.col(label_id_col).alias("_label_id")).agg(F.max(label_col).cast("int").alias("_label"))
              .orderBy(F.xxhash64("_label_id"), "_label_id").limit(sample))
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    # at most `sample` narrow rows are sent to the tasks
    rows = (src.join(F.broadcast(chosen), F.col("doc_id") == F.col("_label_id"))
            .groupBy("_label_id", "_label").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                x, owner = passage_features(part.column("text").to_pylist(), passage_words)
                cut = np.append(_segments(owner), len(owner)) if len(owner) else np.zeros(1, int)
                yield pa.RecordBatch.from_arrays(
                    [part.column("_label_id"), part.column("_label"), pa.array(np.diff(cut), pa.int64()),
                     pa.array([x[a:b].astype(np.float16).tobytes() for a, b in zip(cut[:-1], cut[1:])], pa.binary())],
                    ["doc_id", "label", "n", "x"])

    kind = docs.schema[id_col].dataType.simpleString()
    encoded = checkpointed(rows.mapInArrow(encode, f"doc_id {kind}, label int, n long, x binary"))
    sizes = encoded.select("doc_id", "n", F.xxhash64("doc_id").alias("h")).collect()     # at most `sample` rows
    if not sizes:
        return None
    taken, left = [], passages
    for r in sorted(sizes, key=lambda r: (r["h"], r["doc_id"])):
        if r["n"] <= left:
            taken.append(r["doc_id"])
            left -= r["n"]
    if len(taken) < len(sizes):
        encoded = encoded.where(F.col("doc_id").isin(taken or [min(sizes, key=lambda r: (r["n"], r["h"]))["doc_id"]]))
    got = encoded.select("doc_id", "label", "x").collect()
    got.sort(key=lambda r: (r["doc_id"], bytes(r["x"])))
    parts = [np.frombuffer(r["x"], np.float16).reshape(-1, N_FEATURES) for r in got]
    owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    return train(np.concatenate(parts).astype(np.float32), owner, np.array([r["label"] for r in got], np.float32))


def score_documents(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text",
                    passage_words: int = PASSAGE_WORDS, keep: list[str] | None = None,
                    out_col: str = "score") -> DataFrame:
    """``out_col`` (0 to 1, higher: label 1 likelier) of every row of ``docs``, with its id
    as ``doc_id`` and the columns named in ``keep``.

    Only the text enters the score. Null and empty texts are one passage of zeros;
    repeated rows score alike; ids are passed through, nulls too. Without a model
    every score is 0.5. An empty table gives no rows.
    """
    kept = keep or []
    src = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"),
                      *[F.col(c).alias(f"_k{i}") for i, c in enumerate(kept)])
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                if sent.value is None:
                    p = np.full(part.num_rows, 0.5)
                else:
                    p = score_texts(sent.value, part.column("_text").to_pylist(), passage_words)
                yield pa.RecordBatch.from_arrays(
                    [part.column("_id"), *[part.column(f"_k{i}") for i in range(len(kept))],
                     pa.array(p.astype(float), pa.float64())],
                    ["_id", *[f"_k{i}" for i in range(len(kept))], "_score"])

    kinds = src.drop("_text").schema
    out = src.mapInArrow(score, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kinds) + ", _score double")
    return out.select(F.col("_id").alias("doc_id"), *[F.col(f"_k{i}").alias(c) for i, c in enumerate(kept)],
                      F.col("_score").alias(out_col))


def held_out(id_col: str = "doc_id"):
    """Whether a row belongs to the fold that is never trained on."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))
