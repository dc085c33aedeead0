"""Interpolated modified Kneser-Ney language model over word pairs.

**Counting** (Spark): every task turns its texts to 64-bit word keys and sends its distinct
(previous word, word) pairs with their counts to buckets, sorted and packed; a bucket is a
cell of a grid over the keys of both words, so a very common word is dealt over many buckets.
A bucket adds up its pairs, and sends for each word what the lower order needs: how often it
occurs, how many words it follows and how many words follow it once, twice, more often.

**Model**: per bucket one sorted array of pair hashes with an array of counts beside it, per
word bucket the same with five numbers a word, as files in the shared folder. Their size
grows with the distinct pairs; the driver keeps a few totals and the discounts.

**Scoring**: workers map the arrays into memory and look up the distinct pairs of some
megabytes of text at a time, in sorted order, so that a file is read front to back; pages
are the operating system's to keep or drop. Texts stay where they are.
"""

from __future__ import annotations

import math
import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from flowguard.llm.common import (Words, pack_signed, pack_sorted, pair_hashes, pieces_for, text_bytes, unpack_signed,
                                  unpack_sorted)
from flowguard.sources.files import scratch_path

#: Text that a task counts, and scores, at a time.
CHUNK_BYTES = 10 << 20
SCORE_BYTES = 5 << 20
BUCKET_BYTES = 12 << 20
#: Longer texts are taken in pieces, cut behind a word.
PIECE_BYTES = 4 << 20

#: Keys of the start and the end of a text (no word hashes to them but by chance, 1 in 2^64).
BOS, END = np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344)
_GAPS = b" \t\n\x0b\x0c\r"
_WORD_FIELDS = ("c", "a", "n1", "n2", "n3")


@dataclass(frozen=True)
class Model:
    """Where the arrays lie, totals, and the discounts of both orders (for counts of 1, 2 and
    3 or more)."""
    folder: str
    grid: tuple[int, int]       # parts of the pairs' buckets along the first and the second word
    words: int                  # word buckets
    tokens: int                 # N: training tokens, ends included
    vocabulary: int             # V: distinct ones
    pairs: int                  # distinct pairs
    upper: tuple[float, float, float]
    lower: tuple[float, float, float]
    lower_types: tuple[int, int, int]       # words that follow 1, 2, 3 or more words


def _cell(first: np.ndarray, second: np.ndarray, grid: tuple[int, int]) -> np.ndarray:
    return _part(first, grid[0]) * grid[1] + _part(second, grid[1])


def _part(keys: np.ndarray, parts: int) -> np.ndarray:
    """Which of ``parts`` equal ranges a key lies in."""
    return ((keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _pieces(text: bytes) -> Iterator[tuple[bytes, bool]]:
    """A text in pieces of whole words; whether a piece is the last."""
    at = 0
    while len(text) - at > PIECE_BYTES:
        cut = min((p for p in (text.find(bytes([g]), at + PIECE_BYTES) for g in _GAPS) if p >= 0), default=-1)
        if cut < 0:
            break
        yield text[at:cut], False
        at = cut
    yield text[at:], True


def _chunks(batches: Iterator[pa.RecordBatch], size: int):
    """(row ids, row of each piece, pieces, whether a piece ends its text) of about ``size`` bytes
    of text at a time; the last row goes on in the next chunk if its last piece is no end."""
    rows, owner, pieces, ends, n = [], [], [], [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            ids = part.column("_id").to_pylist() if "_id" in part.schema.names else [None] * part.num_rows
            for own, text in zip(ids, part.column("_text").to_pylist()):
                rows.append(own)
                for piece, last in _pieces(_lower(text)):
                    owner.append(len(rows) - 1)
                    pieces.append(piece)
                    ends.append(last)
                    n += len(piece) + 1
                    if n >= size:
                        yield rows, owner, pieces, ends
                        rows, owner, pieces, ends, n = ([] if last else rows[-1:]), [], [], [], 0
    if pieces:
        yield rows, owner, pieces, ends


def _lower(text: str | None) -> bytes:
    """UTF-8 with A-Z in lower case."""
    return (text or "").encode("utf-8").lower()


class _Tokens:
    """Tokens of the pieces of a chunk: keys, the piece of each, and the distinct pairs."""

    def __init__(self, pieces: list[bytes], ends: list[bool], before: np.uint64):
        words = Words(pieces)
        last = np.flatnonzero(ends)
        stops = words.first[last] + words.count[last]
        self.cur = np.insert(words.keys(), stops, END)
        self.piece = np.insert(words.doc, stops, last)
        known, place = np.unique(np.concatenate((np.array([BOS, END, before]), self.cur)), return_inverse=True)
        self.known, bos, end = known, place[0], place[1]
        self.word = place[3:]
        prev = np.concatenate((place[2:3], self.word))[:len(self.word)]
        prev = np.where(prev == end, bos, prev)
        self.code = prev.astype(np.uint64) * np.uint64(len(known)) + self.word.astype(np.uint64)
        self.after = self.cur[-1] if len(self.cur) else before

    def split(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the first and the second word of pair codes among ``known``."""
        n = np.uint64(len(self.known))
        return (code // n).astype(np.int64), (code % n).astype(np.int64)


_BLOB = "kind int, bucket long, blob binary"


def _blobs(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([
        pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int64()),
        pa.array([r[2] for r in rows], pa.binary())], ["kind", "bucket", "blob"])


def _join(parts: list[bytes]) -> bytes:
    return np.array([len(p) for p in parts], "<i8").tobytes() + b"".join(parts)


def _cut(blob: bytes, n: int) -> list[bytes]:
    sizes = np.frombuffer(blob, "<i8", n)
    ends = 8 * n + np.cumsum(sizes)
    return [blob[e - s:e] for s, e in zip(sizes.tolist(), ends.tolist())]


def _pack_pairs(first: np.ndarray, second: np.ndarray, count: np.ndarray) -> bytes:
    """Pairs in the order of their first word."""
    start = np.flatnonzero(np.concatenate(([True], first[1:] != first[:-1])))
    each = np.diff(np.append(start, len(first)))
    return _join([pack_sorted(first[start]), pack_signed(each), pack_signed(count), second.astype("<u8").tobytes()])


def _unpack_pairs(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    first, each, count, second = _cut(blob, 4)
    return np.repeat(unpack_sorted(first), unpack_signed(each)), np.frombuffer(second, "<u8"), unpack_signed(count)


def _pack_words(keys: np.ndarray, fields: list[np.ndarray]) -> bytes:
    return _join([pack_sorted(keys), *[pack_signed(f) for f in fields]])


def _unpack_words(blob: bytes) -> tuple[np.ndarray, list[np.ndarray]]:
    keys, *fields = _cut(blob, 1 + len(_WORD_FIELDS))
    return unpack_sorted(keys), [unpack_signed(f) for f in fields]


def _save(path: str, values: np.ndarray) -> None:
    """Write an array so that a task that runs again replaces it whole."""
    os.makedirs(os.path.dirname(path), exist_ok=True)
    own = f"{path}.{uuid.uuid4().hex}.part"
    with open(own, "wb") as f:
        np.save(f, values)
    os.replace(own, path)


def _narrow(counts: np.ndarray) -> np.ndarray:
    return counts.astype("<u4" if not len(counts) or int(counts.max()) < 1 << 32 else "<u8")


@lru_cache(maxsize=512)
def _mapped(path: str) -> np.ndarray | None:
    """An array of the model, mapped into memory; None if its bucket has none."""
    return np.load(path, mmap_mode="r") if os.path.exists(path) else None


def _types(counts: np.ndarray) -> list[int]:
    """How many counts are 1, 2, 3 and 4."""
    return [int((counts == k).sum()) for k in (1, 2, 3, 4)]


def _discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts; 0.5, 1, 1.5 where a count of counts is missing."""
    if not (n1 and n2 and n3 and n4):
        return 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    found = 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3
    return tuple(min(max(d, 0.0), float(k)) for k, d in enumerate(found, 1))


def _local_folder(path: str) -> str:
    """The path under which workers open files of the shared folder."""
    url = urlparse(path)
    if url.scheme not in ("", "file"):
        raise ValueError(f"workers map the model's files: spark.checkpoint.dir must be a mounted folder, not {path}")
    return unquote(url.path)


def train(docs: DataFrame, text_col: str = "text", chunk_bytes: int = CHUNK_BYTES,
          bucket_bytes: int = BUCKET_BYTES, folder: str | None = None) -> Model:
    """Count the texts of ``docs`` and store the model under ``folder`` (default: a new folder in
    the shared checkpoint folder, which must be one that workers mount).

    Tokens are the words with A-Z in lower case, and one end a text. Null and empty texts
    are an end only. Every row counts, repeated rows again. Only ``text_col`` is read. An empty table gives a
    model that knows no word.
    """
    spark = docs.sparkSession
    src = docs.select(F.col(text_col).cast("string").alias("_text"))
    folder = folder or _local_folder(scratch_path(spark, "word-pairs"))
    buckets = pieces_for(text_bytes(src, F.col("_text")), bucket_bytes, 64)
    # a word's pairs lie in as many buckets as the grid has columns, which grow with the input
    columns = math.isqrt(buckets)
    grid = -(-buckets // columns), columns
    words = max(1, buckets // 8)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = BOS
        for _, _, pieces, ends in _chunks(batches, chunk_bytes):
            tokens = _Tokens(pieces, ends, before)
            before = tokens.after
            code, n = np.unique(tokens.code, return_counts=True)
            a, b = (tokens.known[x] for x in tokens.split(code))
            cell = _cell(a, b, grid)
            order = np.argsort(cell, kind="stable")
            cuts = np.flatnonzero(np.concatenate(([True], np.diff(cell[order]) > 0, [True]))) if len(cell) else []
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                own = order[lo:hi]
                yield _blobs([(0, int(cell[own[0]]), _pack_pairs(a[own], b[own], n[own]))])

    def add_pairs(rows: pa.Table) -> pa.Table:
        """Store a bucket's pairs; what they say of words, by word bucket."""
        bucket = rows.column("bucket")[0].as_py()
        parts = [_unpack_pairs(x) for x in rows.column("blob").to_pylist()]
        a, b, n = (np.concatenate([p[k] for p in parts]) for k in range(3))
        del parts
        key = pair_hashes(a, b)
        order = np.argsort(key)
        key = key[order]
        start = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        n = np.add.reduceat(n[order], start)
        key, a, b = key[start], a[order[start]], b[order[start]]
        _save(f"{folder}/pairs/{bucket}.key.npy", key)
        _save(f"{folder}/pairs/{bucket}.n.npy", _narrow(n))
        known, place = np.unique(np.concatenate((a, b)), return_inverse=True)
        before, after = place[:len(a)], place[len(a):]
        c, follows = np.zeros(len(known), np.int64), np.bincount(after, minlength=len(known))
        np.add.at(c, after, n)
        ones = [np.bincount(before[x], minlength=len(known)) for x in (n == 1, n == 2, n >= 3)]
        fields = [c, follows, *ones]
        part = _part(known, words)
        cuts = np.searchsorted(part, np.arange(words + 1))
        out = [(1, w, _pack_words(known[lo:hi], [f[lo:hi] for f in fields]))
               for w, (lo, hi) in enumerate(zip(cuts[:-1], cuts[1:])) if hi > lo]
        out.append((2, bucket % words, np.array([len(key), *_types(n)], "<i8").tobytes()))
        return pa.Table.from_batches([_blobs(out)])

    def add_words(rows: pa.Table) -> pa.Table:
        """Store a bucket's words; the totals of words, and of pairs, go on."""
        bucket = rows.column("bucket")[0].as_py()
        blobs = list(zip(rows.column("kind").to_pylist(), rows.column("blob").to_pylist()))
        stats = [(2, bucket, x) for k, x in blobs if k == 2]
        parts = [_unpack_words(x) for k, x in blobs if k == 1]
        if parts:
            known, place = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            fields = []
            for f in range(len(_WORD_FIELDS)):
                total = np.zeros(len(known), np.int64)
                np.add.at(total, place, np.concatenate([p[1][f] for p in parts]))
                fields.append(total)
            _save(f"{folder}/words/{bucket}.key.npy", known)
            for name, f in zip(_WORD_FIELDS, fields):
                _save(f"{folder}/words/{bucket}.{name}.npy", _narrow(f))
            c, a = fields[0], fields[1][fields[0] > 0]
            stats.append((3, bucket, np.array(
                [int(c.sum()), len(a), int(a.sum()), *_types(a), int((a >= 3).sum())], "<i8").tobytes()))
        return pa.Table.from_batches([_blobs(stats)])

    # one row a bucket comes to the driver
    stats = (src.mapInArrow(count, _BLOB).groupBy("bucket").applyInArrow(add_pairs, _BLOB)
             .groupBy("bucket").applyInArrow(add_words, _BLOB).select("kind", "blob").collect())

    def totals(kind: int, n: int) -> list[int]:
        return np.sum([np.frombuffer(r["blob"], "<i8") for r in stats if r["kind"] == kind] or [np.zeros(n, "<i8")],
                      axis=0).tolist()
    pairs, *upper = totals(2, 5)
    tokens, vocabulary, _, t1, t2, t3, t4, more = totals(3, 8)
    return Model(folder, grid, words, tokens, vocabulary, pairs, _discounts(*upper), _discounts(t1, t2, t3, t4), (t1, t2, more))


def _lookup(folder: str, kind: str, bucket: int, keys: np.ndarray, names: tuple[str, ...]) -> list[np.ndarray]:
    """The fields of each key, 0 where the model has none. One pass over the sorted keys."""
    have = _mapped(f"{folder}/{kind}/{bucket}.key.npy")
    if have is None or not len(have):
        return [np.zeros(len(keys), np.int64) for _ in names]
    order = np.argsort(keys)
    at = np.empty(len(keys), np.int64)
    at[order] = np.minimum(np.searchsorted(have, keys[order]), len(have) - 1)
    found = have[at] == keys
    return [np.where(found, _mapped(f"{folder}/{kind}/{bucket}.{n}.npy")[at].astype(np.int64), 0) for n in names]


def _look_up_all(model: Model, kind: str, keys: np.ndarray, bucket: np.ndarray, names: tuple[str, ...]) -> list[np.ndarray]:
    out = [np.zeros(len(keys), np.int64) for _ in names]
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.concatenate(([True], np.diff(bucket[order]) > 0, [True]))) if len(bucket) else []
    for lo, hi in zip(cuts[:-1], cuts[1:]):
        own = order[lo:hi]
        for o, v in zip(out, _lookup(model.folder, kind, int(bucket[own[0]]), keys[own], names)):
            o[own] = v
    return out


def _weight(counts: np.ndarray, discounts: tuple[float, float, float]) -> np.ndarray:
    """Counts less their discount."""
    return np.maximum(counts - np.array([0.0, *discounts])[np.minimum(counts, 3)], 0.0)


def pair_probabilities(model: Model, first: np.ndarray, second: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of pairs of places among the sorted keys ``known``: the model's probability of the
    second word after the first, the base probability of the second, whether it is known."""
    c, a, n1, n2, n3 = _look_up_all(model, "words", known, _part(known, model.words), _WORD_FIELDS)
    u1, u2, u3 = model.lower
    t1, t2, t3 = model.lower_types
    spare = (u1 * t1 + u2 * t2 + u3 * t3) / model.pairs if model.pairs else 1.0
    lower = _weight(a, model.lower) / max(model.pairs, 1) + spare / (model.vocabulary + 1)
    keys = pair_hashes(known[first], known[second])
    n, = _look_up_all(model, "pairs", keys, _cell(known[first], known[second], model.grid), ("n",))
    # every occurrence of a word is followed by a token; texts start as often as they end
    ends = int(_look_up_all(model, "words", np.array([END]), _part(np.array([END]), model.words), ("c",))[0][0])
    total = np.where(known == BOS, ends, c)[first].astype(np.float64)
    d1, d2, d3 = model.upper
    left = (d1 * n1 + d2 * n2 + d3 * n3)[first]
    seen = total > 0
    safe = np.where(seen, total, 1.0)
    p = np.where(seen, _weight(n, model.upper) / safe + left / safe * lower[second], lower[second])
    base = (c + 0.5) / (model.tokens + 0.5 * (model.vocabulary + 1))
    return p, base[second], (c > 0)[second]


def score_documents(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
                    chunk_bytes: int = SCORE_BYTES) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``n_known``, ``base_score``, ``score`` and ``perplexity`` of every row.

    ``score`` is the log10 probability of the tokens (words with A-Z in lower case, then one
    end) each after the one before it, the first after the start of a text; ``base_score`` that
    of single tokens with 0.5 added to every count; perplexity is per token. Tokens never seen in
    training share what the lower order leaves for them. Null and empty texts are one end.
    Repeated and null ids are rows like others; only the two named columns are read. An empty
    table gives no rows; a model of no texts gives every token the probability 1.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    id_type = to_arrow_type(docs.schema[id_col].dataType)
    src = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, carried = BOS, np.zeros((4, 1))
        for rows, owner, pieces, ends in _chunks(batches, chunk_bytes):
            tokens = _Tokens(pieces, ends, before)
            before = tokens.after
            code, place = np.unique(tokens.code, return_inverse=True)
            first, second = tokens.split(code)
            p, base, known = pair_probabilities(model, first, second, tokens.known)
            row = np.asarray(owner, np.int64)[tokens.piece]
            # per token: one, known, base, score
            sums = np.zeros((4, len(rows)))
            sums[:, :1] += carried
            for k, v in enumerate((None, known.astype(np.float64)[place], np.log10(base)[place], np.log10(p)[place])):
                sums[k] += np.bincount(row, weights=v, minlength=len(rows))
            done = len(rows) if ends[-1] else len(rows) - 1
            carried = np.zeros((4, 1)) if ends[-1] else sums[:, -1:].copy()
            if done:
                yield pa.RecordBatch.from_arrays([
                    pa.array(rows[:done], id_type), pa.array(sums[0, :done].astype(np.int64)), pa.array(sums[1, :done].astype(np.int64)),
                    pa.array(sums[2, :done]), pa.array(sums[3, :done])],
                    ["doc_id", "n_tokens", "n_known", "base_score", "score"])

    out = src.mapInArrow(score, f"doc_id {kind}, n_tokens long, n_known long, base_score double, score double")
    return out.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))


def held_out(id_col: str = "doc_id", folds: int = 5, fold: int = 1) -> Column:
    """Rows never trained on: unsigned CRC-32 of the id as text, modulo ``folds``, is ``fold``
    (a null id counts as empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds == fold
