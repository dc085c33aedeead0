"""Substring dedup by fixed-block anchors.

A window of ``window`` consecutive words always contains one whole block of a
document cut into non-overlapping blocks of ``(window + 1) // 2`` words. So:

1. **index** the blocks (anchors) of every document and **probe** them with every
   rolling run of the same length. Texts are grouped in chunks by a hash of id and
   text; a chunk sends its distinct hashes, sorted and packed, to hash
   buckets; a bucket answers with one bit per hash: seen in another chunk, with an
   anchor among the places. A run repeated within one chunk is found there.
2. **extend**: windows that contain a hit run are the only ones that can repeat.
   Their full hashes go to buckets with the least place (id, rank) of the chunk; a
   bucket answers with one bit per hash: starts earlier in another chunk. Windows
   that overlap merge to maximal repeats, whose words go.

A document's place in the order is its id and, where an id repeats, the rank of its text
among the id's distinct texts (``plans/prefix.py``), so rows that share an id (or have
none) spread over chunks. Wholly equal rows are one row here; the others are repeats from
end to end and are written beside.

What moves is one shuffle of the texts (reused by the three passes; rows whose id repeats
are shuffled twice more, to be counted and ranked), a few bytes for each rolling run, and
bits. A run that occurs in many documents is sent once
per chunk, so no key gathers rows with its frequency.

Runs are compared by hash: 48 bits in step 1, where a collision only costs work,
64 bits in step 2 and inside a chunk. The hash mixes words one into another, so no form of the
words makes two runs alike; chance does once in 2^64 pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowguard.llm.common import (GAP, Words, checked_broadcast, pack_signed, pack_sorted, pieces_for, run_keys, text_bytes,
                                  unpack_signed, unpack_sorted)
from flowguard.plans.prefix import row_number

CHUNK_BYTES = 4 << 20
BUCKET_RUNS = 1 << 20
_BITS = 48
_LAST = (1 << 63) - 1
_NULLS = 1 << 62                # rank of the first row without an id, behind id _LAST
_COPIES = 1000
_RANK_BYTES = 256 << 20

_REQUEST = "chunk long, bucket long, step int, first binary, second binary"


class _Chunk:
    """The texts of one chunk in the order (id, rank) with their words' hashes."""

    def __init__(self, rows: pa.Table, window: int):
        ids = rows.column("_id").to_pylist()
        texts = rows.column("_text").to_pylist()
        ranks = rows.column("_rank").to_pylist()
        both = sorted((_LAST if i is None else i, r + _NULLS if i is None else r, t or "", i is None)
                      for i, r, t in zip(ids, ranks, texts))
        self.ids = [None if null else i for i, _, _, null in both]
        self.order = np.array([i for i, _, _, _ in both], dtype=np.int64)
        self.rank = np.array([r for _, r, _, _ in both], dtype=np.int64)
        self.words = Words([t.encode("utf-8") for _, _, t, _ in both])
        self.window, self.block = window, (window + 1) // 2
        self.hash = self.words.keys()

    def runs(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Start index and hash of every run of k words inside one text."""
        h = run_keys(self.hash, k)
        doc = self.words.doc
        inside = np.flatnonzero(doc[:len(h)] == doc[k - 1:k - 1 + len(h)]) if len(h) else np.zeros(0, np.int64)
        return inside, h[inside]

    def probes(self):
        """Of the rolling runs: start, 48-bit hash; whether it is an anchor; and the
        sorted distinct hashes with the place of each run among them."""
        start, h = self.runs(self.block)
        h = h >> np.uint64(64 - _BITS)
        anchor = self.words.pos[start] % self.block == 0
        distinct, place, count = np.unique(h, return_inverse=True, return_counts=True)
        anchored = np.zeros(len(distinct), dtype=bool)
        anchored[place[anchor]] = True
        return start, place, distinct, count, anchored

    def candidates(self, hit: np.ndarray, start: np.ndarray):
        """Windows that contain a run marked in ``hit``: start, hash."""
        at, h = self.runs(self.window)
        marked = np.zeros(len(self.hash) + 1, dtype=np.int64)
        marked[start[hit] + 1] = 1
        before = np.cumsum(marked)
        keep = before[at + self.window - self.block + 1] > before[at]
        return at[keep], h[keep]


def _cuts(distinct: np.ndarray, buckets: int, bits: int) -> np.ndarray:
    """Slice bounds of sorted hashes by bucket (equal ranges of the hash)."""
    bounds = np.array([((b << bits) + buckets - 1) // buckets for b in range(1, buckets)], dtype=np.uint64)
    return np.concatenate(([0], np.searchsorted(distinct, bounds), [len(distinct)]))


def _table(rows: list[tuple]) -> pa.Table:
    cols = list(zip(*rows)) if rows else [()] * 5
    return pa.table({
        "chunk": pa.array(cols[0], pa.int64()), "bucket": pa.array(cols[1], pa.int64()),
        "step": pa.array(cols[2], pa.int32()), "first": pa.array(cols[3], pa.binary()),
        "second": pa.array(cols[4], pa.binary())})


def _answers(right: pa.Table, step: int, cuts: np.ndarray) -> np.ndarray:
    """The answer bits of a step, in the order of the chunk's distinct hashes."""
    out = np.zeros(int(cuts[-1]), dtype=bool)
    for b, s, bits in zip(right.column("bucket").to_pylist(), right.column("step").to_pylist(),
                          right.column("first").to_pylist()):
        if s == step:
            n = cuts[b + 1] - cuts[b]
            out[cuts[b]:cuts[b + 1]] |= np.unpackbits(np.frombuffer(bits, np.uint8), count=n).astype(bool)
    return out


def _pack_places(ids: np.ndarray, ranks: np.ndarray) -> bytes:
    first = pack_signed(ids)
    return len(first).to_bytes(8, "little") + first + pack_signed(ranks)


def _unpack_places(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    cut = 8 + int.from_bytes(blob[:8], "little")
    return unpack_signed(blob[8:cut]), unpack_signed(blob[cut:])


def _groups(blobs: list[np.ndarray]):
    """Equal hashes of several sorted arrays side by side: the order that sorts
    all, and the group number of each sorted entry."""
    every = np.concatenate(blobs)
    order = np.argsort(every, kind="stable")
    ranked = every[order]
    group = np.cumsum(np.concatenate(([0], (ranked[1:] != ranked[:-1]).astype(np.int64))))
    return order, group


def _chunked(rows: DataFrame, chunks: int) -> DataFrame:
    return rows.withColumn("chunk", F.pmod(F.xxhash64("_id", "_text"), F.lit(chunks)).cast("long"))


def _ranked(src: DataFrame, total: int) -> tuple[DataFrame, DataFrame | None]:
    """Every distinct row once with its ``_rank`` among the texts of its id; and the rows that
    occur more than once with their number ``_n``, or None if every id is there once.
    ``total`` is the bytes of all texts: the ranking's range bounds are texts, sampled for each
    block, so its blocks are large."""
    repeated = src.groupBy("_id").count().where(F.col("count") > 1).select(F.col("_id").alias("_rid"), F.lit(1).alias("_rep"))
    if repeated.limit(1).isEmpty():
        return src.withColumn("_rank", F.lit(0).cast("long")), None
    marked = src.join(checked_broadcast(repeated), F.col("_id").eqNullSafe(F.col("_rid")), "left")
    single = marked.where(F.col("_rep").isNull()).select("_id", "_text", F.lit(0).cast("long").alias("_rank"))
    distinct = (marked.where(F.col("_rep").isNotNull())
                .groupBy("_id", F.coalesce("_text", F.lit("")).alias("_text")).agg(F.count(F.lit(1)).alias("_n")))
    blocks = min(int(src.sparkSession.conf.get("spark.sql.shuffle.partitions")), pieces_for(total, _RANK_BYTES))
    ranks = row_number(distinct, ["_text"], ["_id"], out="_rank", num_blocks=blocks)
    return single.unionByName(ranks.select("_id", "_text", "_rank")), ranks.where(F.col("_n") > 1).select("_id", "_text", "_n")


def _copies(equal: DataFrame, window: int) -> DataFrame:
    """The result rows of all but one of wholly equal rows: repeated from end to end."""
    words = F.filter(F.split("_text", GAP), lambda w: w != "")
    rows = (equal.select("_id", "_n", words.alias("_words"))
            .select("_id", "_n", F.size("_words").cast("long").alias("n_words"), "_words")
            .withColumn("kept_text", F.when(F.col("n_words") >= window, "").otherwise(F.array_join("_words", " ")))
            .withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 2) / _COPIES))))
            .drop("_words"))
    n = int(equal.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (rows.repartition(n, "_id", "_part", "kept_text")
            .withColumn("_copy", F.explode(F.sequence(
                F.lit(1).cast("long"), F.least(F.lit(_COPIES).cast("long"), F.col("_n") - 1 - F.col("_part") * _COPIES))))
            .select(F.col("_id").alias("doc_id"), "n_words",
                    F.when(F.col("n_words") >= window, F.col("n_words")).otherwise(F.lit(0)).cast("long").alias("n_removed"),
                    "kept_text"))


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    window: int = 20, chunk_bytes: int = CHUNK_BYTES,
                    bucket_runs: int = BUCKET_RUNS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_words``, ``n_removed`` and
    ``kept_text`` (the kept words joined by one space).

    A word goes if a window that covers it starts earlier elsewhere: at a smaller
    id, or before it in the same text. Only these two columns are read, so other
    columns and their names do not matter.

    Ids are whole numbers (cast to long; others are an error). Null or empty text: no words, empty kept text. Fewer words than a window:
    nothing is removed. A null id comes after every other id. Rows that repeat an id
    are ordered by their text; of wholly equal rows one counts as the earlier.
    An empty table gives no rows.
    """
    if window < 2:
        raise ValueError("window must be at least 2 words")
    kind = docs.schema[id_col].dataType.simpleString()
    if kind not in ("tinyint", "smallint", "int", "bigint"):
        raise ValueError(f"ids must be whole numbers, {id_col} is {kind}")
    src = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_text"))
    total = text_bytes(src, F.col("_text"))
    chunks = pieces_for(total, chunk_bytes)
    buckets = pieces_for(total // 6, bucket_runs)
    rows, equal = _ranked(src, total)
    texts = _chunked(rows, chunks)

    def ask_blocks(rows: pa.Table) -> pa.Table:
        c = rows.column("chunk")[0].as_py()
        _, _, distinct, _, anchored = _Chunk(rows, window).probes()
        cuts = _cuts(distinct, buckets, _BITS)
        return _table([(c, b, 0, pack_sorted(distinct[lo:hi]), np.packbits(anchored[lo:hi]).tobytes())
                       for b, (lo, hi) in enumerate(zip(cuts[:-1], cuts[1:])) if hi > lo])

    def answer_blocks(rows: pa.Table) -> pa.Table:
        b = rows.column("bucket")[0].as_py()
        from_chunk = rows.column("chunk").to_pylist()
        blobs = [unpack_sorted(x) for x in rows.column("first").to_pylist()]
        sizes = [len(x) for x in blobs]
        anchored = np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8), count=n)
                                   for x, n in zip(rows.column("second").to_pylist(), sizes)])
        order, group = _groups(blobs)
        places = np.bincount(group)
        anchors = np.bincount(group, weights=anchored[order])
        hit = np.zeros(len(order), dtype=bool)
        hit[order] = ((places >= 2) & (anchors >= 1))[group]
        return _split(hit, from_chunk, sizes, b, 0)

    def _split(flag, from_chunk, sizes, b, step):
        ends = np.cumsum(sizes)
        return _table([(c, b, step, np.packbits(flag[e - n:e]).tobytes(), b"")
                       for c, n, e in zip(from_chunk, sizes, ends) if flag[e - n:e].any()])

    def _windows(chunk: _Chunk, right: pa.Table):
        start, place, distinct, count, anchored = chunk.probes()
        hit = _answers(right, 0, _cuts(distinct, buckets, _BITS)) | ((count >= 2) & anchored)
        at, h = chunk.candidates(hit[place], start)
        distinct, first, place = np.unique(h, return_index=True, return_inverse=True)
        return at, distinct, first, place

    def ask_windows(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return _table([])
        c = left.column("chunk")[0].as_py()
        chunk = _Chunk(left, window)
        at, distinct, first, _ = _windows(chunk, right)
        # starts ascend in (id, rank, position), so the first one is the least
        least = chunk.words.doc[at[first]]
        ids, ranks = chunk.order[least], chunk.rank[least]
        cuts = _cuts(distinct, buckets, 64)
        return _table([(c, b, 1, pack_sorted(distinct[lo:hi]), _pack_places(ids[lo:hi], ranks[lo:hi]))
                       for b, (lo, hi) in enumerate(zip(cuts[:-1], cuts[1:])) if hi > lo])

    def answer_windows(rows: pa.Table) -> pa.Table:
        b = rows.column("bucket")[0].as_py()
        from_chunk = rows.column("chunk").to_pylist()
        blobs = [unpack_sorted(x) for x in rows.column("first").to_pylist()]
        places = [_unpack_places(x) for x in rows.column("second").to_pylist()]
        order, group = _groups(blobs)
        ids = np.concatenate([i for i, _ in places])[order]
        ranks = np.concatenate([r for _, r in places])[order]
        least = np.full(int(group[-1]) + 1, _LAST, dtype=np.int64)
        np.minimum.at(least, group, ids)
        same = ids == least[group]
        lowest = np.full(len(least), _LAST, dtype=np.int64)
        np.minimum.at(lowest, group[same], ranks[same])
        later = np.zeros(len(order), dtype=bool)
        later[order] = ~same | (ranks > lowest[group])
        return _split(later, from_chunk, [len(x) for x in blobs], b, 1)

    def remove(left: pa.Table, right: pa.Table) -> pa.Table:
        chunk = _Chunk(left, window)
        words = chunk.words
        n = len(words.start)
        gone = np.zeros(n, dtype=bool)
        if n:
            at, distinct, first, place = _windows(chunk, right)
            elsewhere = _answers(right, 1, _cuts(distinct, buckets, 64))
            repeat = elsewhere[place]
            repeat |= first[place] != np.arange(len(at))
            bound = np.zeros(n + 1, dtype=np.int64)
            bound[at[repeat]] += 1
            np.add.at(bound, at[repeat] + window, -1)
            gone = np.cumsum(bound[:n]) > 0
        removed = np.bincount(words.doc[gone], minlength=len(chunk.ids))
        starts, ends, raw = words.start.tolist(), words.end.tolist(), words.raw
        kept, flags = [], gone.tolist()
        for f, k in zip(words.first.tolist(), words.count.tolist()):
            kept.append(b" ".join([raw[starts[i]:ends[i]] for i in range(f, f + k) if not flags[i]]).decode("utf-8"))
        return pa.table({"doc_id": pa.array(chunk.ids, pa.int64()),
                         "n_words": pa.array(words.count, pa.int64()),
                         "n_removed": pa.array(removed, pa.int64()),
                         "kept_text": pa.array(kept, pa.string())})

    by_chunk = texts.groupBy("chunk")
    hits = (by_chunk.applyInArrow(ask_blocks, _REQUEST)
            .groupBy("bucket").applyInArrow(answer_blocks, _REQUEST))
    earlier = (by_chunk.cogroup(hits.groupBy("chunk")).applyInArrow(ask_windows, _REQUEST)
               .groupBy("bucket").applyInArrow(answer_windows, _REQUEST))
    out = by_chunk.cogroup(hits.unionByName(earlier).groupBy("chunk")).applyInArrow(
        remove, "doc_id long, n_words long, n_removed long, kept_text string")
    return out if equal is None else out.unionByName(_copies(equal, window))
