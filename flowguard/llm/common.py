"""Helpers shared by the text operators: table readers, sizes, and word arrays.

Words are maximal runs of characters other than space and U+0009..U+000D. These
are all ASCII, so the byte-level split of UTF-8 text equals the split of the
text itself.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The word pattern, as a Java / Python regular expression.
WORD = r"[^\x20\x09-\x0D]+"
#: The complement, for splitting.
GAP = r"[\x20\x09-\x0D]+"

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_RNG = np.random.default_rng(20240229)
_BYTE_VALUE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE_BASE = np.uint64(0x9E3779B97F4A7C15)
_WORD_BASE = 0xD1342543DE82EF95
_LANE = np.uint64(0x9E3779B97F4A7C15)
_PAIR = np.uint64(0xD1342543DE82EF95)
#: Words of more bytes get their key one by one.
_LONG_WORD = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or with underscores behind it until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_bytes(df: DataFrame, col: Column) -> int:
    """UTF-8 bytes of a text column over the whole table (one aggregate row)."""
    row = df.select(F.sum(F.octet_length(col)).alias("b")).first()
    return int(row["b"] or 0)


def pieces_for(total: int, each: int, least: int = 64) -> int:
    """How many pieces of about ``each`` a total of ``total`` makes; at least
    ``least`` so that small inputs still use every core."""
    return max(least, math.ceil(total / each))


def mix64(h: np.ndarray) -> np.ndarray:
    """Finalizer of the 64-bit hashes below (bijective)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Words:
    """All words of several texts at once.

    ``buf`` holds the UTF-8 texts joined by a line feed (a space, so no word
    crosses a text); ``start``/``end`` are byte offsets of the words, ``doc`` the
    index of each word's text and ``pos`` its index inside that text.
    """

    def __init__(self, texts: list[bytes]):
        self.raw = b"\n".join(texts)
        self.buf = np.frombuffer(self.raw, dtype=np.uint8)
        lengths = np.fromiter((len(t) for t in texts), dtype=np.int64, count=len(texts))
        self.text_start = np.concatenate(([0], np.cumsum(lengths + 1)[:-1])) if texts else lengths
        solid = ~_SPACE[self.buf]
        edge = np.flatnonzero(np.diff(np.concatenate(([0], solid.view(np.int8), [0]))))
        self.start, self.end = edge[0::2], edge[1::2]
        self.doc = np.searchsorted(self.text_start, self.start, side="right") - 1
        self.first = np.searchsorted(self.doc, np.arange(len(texts)))
        self.count = np.bincount(self.doc, minlength=len(texts)) if len(texts) else lengths
        self.pos = np.arange(len(self.start)) - self.first[self.doc] if len(self.start) else self.start

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word (equal words, equal hashes), for features and filters; a
        polynomial, so words can be built that collide. ``keys`` are for comparisons."""
        if not len(self.start):
            return np.zeros(0, dtype=np.uint64)
        size = self.end - self.start
        at = np.concatenate(([0], np.cumsum(size)[:-1]))
        inside = np.arange(int(size.sum())) - np.repeat(at, size)
        power = np.ones(int(size.max()), dtype=np.uint64)
        power[1:] = _BYTE_BASE
        power = np.cumprod(power)
        solid = self.buf[np.repeat(self.start, size) + inside]
        total = np.add.reduceat(_BYTE_VALUE[solid] * power[inside], at)
        return mix64(total + size.astype(np.uint64))

    def keys(self) -> np.ndarray:
        """A 64-bit key of each word (equal words, equal keys): its length and its bytes,
        eight at a time, through a finalizer each; long words by BLAKE2b."""
        if not len(self.start):
            return np.zeros(0, dtype=np.uint64)
        size = self.end - self.start
        eight = np.ndarray((len(self.raw) + 1,), "<u8", self.raw + b"\0" * 8, strides=(1,))
        h = mix64(size.astype(np.uint64) * _LANE)
        todo, at, left = np.arange(len(size)), self.start, size
        while len(todo):
            lane = eight[at]
            part = np.flatnonzero(left < 8)
            lane[part] &= (np.uint64(1) << (left[part] * 8).astype(np.uint64)) - np.uint64(1)
            h[todo] = mix64(h[todo] ^ lane) + _LANE
            more = (left > 8) & (size[todo] <= _LONG_WORD)
            todo, at, left = todo[more], at[more] + 8, left[more] - 8
        for i in np.flatnonzero(size > _LONG_WORD).tolist():
            word = self.raw[int(self.start[i]):int(self.end[i])]
            h[i] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return h


def pair_hashes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each ordered pair of hashes."""
    return mix64(mix64(a + _PAIR) * _LANE + b)


def run_keys(words: np.ndarray, k: int) -> np.ndarray:
    """Key of every run of ``k`` consecutive entries: out[i] covers i..i+k-1. Runs of
    1, 2, 4 ... entries are paired, so no algebra of the words makes two runs alike."""
    n = len(words)
    if n < k:
        return np.zeros(0, dtype=np.uint64)
    out, done = None, 0          # hash of the run of `done` entries starting at i
    block, size, left = words, 1, k
    while left:
        if left & 1:
            if out is None:
                out, done = block, size
            else:
                m = min(len(out), len(block) - done)
                out = pair_hashes(out[:m], block[done:done + m])
                done += size
        left >>= 1
        if left:
            m = len(block) - size
            block = pair_hashes(block[:m], block[size:size + m])
            size *= 2
    return mix64(out[:n - k + 1])


def window_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` consecutive entries: out[i] covers i..i+k-1."""
    n = len(words)
    if n < k:
        return np.zeros(0, dtype=np.uint64)
    out, done = None, 0          # hash of the run of `done` entries starting at i
    block, size, left = words, 1, k
    while left:
        if left & 1:
            if out is None:
                out, done = block, size
            else:
                m = min(len(out), len(block) - done)
                out = out[:m] * np.uint64(pow(_WORD_BASE, size, 1 << 64)) + block[done:done + m]
                done += size
        left >>= 1
        if left:
            m = len(block) - size
            block = block[:m] * np.uint64(pow(_WORD_BASE, size, 1 << 64)) + block[size:size + m]
            size *= 2
    return mix64(out[:n - k + 1])


def pack_sorted(values: np.ndarray) -> bytes:
    """Sorted unsigned integers as byte planes of their differences: one byte with
    the number of planes, then the planes. Few bytes when values are dense."""
    if not len(values):
        return b"\x00"
    step = np.diff(values, prepend=np.uint64(0))
    planes = max(1, (int(step.max()).bit_length() + 7) // 8)
    body = step.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :planes].T
    return bytes([planes]) + body.tobytes()


def unpack_sorted(blob: bytes) -> np.ndarray:
    planes = blob[0]
    if planes == 0:
        return np.zeros(0, dtype=np.uint64)
    body = np.frombuffer(blob, dtype=np.uint8, offset=1).reshape(planes, -1)
    wide = np.zeros((body.shape[1], 8), dtype=np.uint8)
    wide[:, :planes] = body.T
    return np.cumsum(wide.reshape(-1).view("<u8"), dtype=np.uint64)


def pack_signed(values: np.ndarray) -> bytes:
    """Signed 64-bit integers as the used byte planes of their offset to the least."""
    if not len(values):
        return b"\x00" * 9
    low = values.min()
    off = (values.astype(np.int64) - low).view(np.uint64)
    planes = max(1, (int(off.max()).bit_length() + 7) // 8)
    body = off.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :planes].T
    return bytes([planes]) + int(low).to_bytes(8, "little", signed=True) + body.tobytes()


def unpack_signed(blob: bytes) -> np.ndarray:
    planes = blob[0]
    if planes == 0:
        return np.zeros(0, dtype=np.int64)
    low = int.from_bytes(blob[1:9], "little", signed=True)
    body = np.frombuffer(blob, dtype=np.uint8, offset=9).reshape(planes, -1)
    wide = np.zeros((body.shape[1], 8), dtype=np.uint8)
    wide[:, :planes] = body.T
    return wide.reshape(-1).view("<i8") + np.int64(low)


#: Most rows of a table of narrow rows (a key and a number) that is sent to every task.
BROADCAST_ROWS = 500_000


def checked_broadcast(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``most`` rows, by count; as it is
    otherwise, so that the join shuffles both sides."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df
