"""SimHash near-duplicates by pivot distance tables.

A fingerprint's table row holds its Hamming distances to many reference
fingerprints (pivots). Distances to a pivot differ by at most the distance of the
two fingerprints, so a pair whose rows differ by more than ``max_bits`` in any
coordinate is discarded; survivors are verified on their bits.

The pivots are chosen so that the table also deals the work out. Cut the 64 bits
in ``max_bits + s`` blocks and take, beside a base pivot and some random ones,
pivots that differ from the base inside one block only: distance minus base
distance is then a function of that block. Two fingerprints within ``max_bits``
agree on at least ``s`` whole blocks, so they have equal coordinates for at least
one choice of ``s`` blocks: an equality join key for each choice, without loss.

Only distinct fingerprints are compared. A bucket of equal keys reports a spanning
forest of its links, not its pairs; a bucket above ``hot_rows`` is cut in parts
that are compared two at a time, each pair of parts on its own.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowguard.llm.common import fresh, pair_hashes
from flowguard.llm.components import components
from flowguard.session import checkpointed

RANDOM_PIVOTS = 15
PIVOTS_PER_BLOCK = 8
HOT_ROWS = 4096
BIN_ROWS = 100_000


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = 4) -> DataFrame:
    """``doc_id``, ``row`` (a hash of id and text), ``fp`` (64 bits as a long) of every row. A-Z are lower-cased, words
    split at space and U+0009..U+000D; each run of ``shingle`` words (all words, if
    fewer), repeats included, is hashed by XXH64 with seed 42 over its space-joined
    UTF-8; a bit is 1 if it is set in over half the hashes. No word: 0."""
    kind = docs.schema[id_col].dataType.simpleString()
    if kind not in ("tinyint", "smallint", "int", "bigint"):
        raise ValueError(f"ids must be whole numbers, {id_col} is {kind}")
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                      _row_key(id_col, text_col).alias("row"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        digest = xxhash.xxh64_digest

        def one(text: str | None) -> int:
            # bytes.lower and bytes.split treat exactly A-Z and the six spaces
            words = (text or "").encode("utf-8").lower().split()
            if not words:
                return 0
            line = b" ".join(words)
            n = len(words) - shingle + 1
            if n <= 1:
                hashes = digest(line, 42)
            else:
                size = np.fromiter(map(len, words), np.int64, len(words))
                end = np.cumsum(size + 1) - 1
                ends, starts = end[shingle - 1:].tolist(), (end - size)[:n].tolist()
                hashes = b"".join([digest(line[a:b], 42) for a, b in zip(starts, ends)])
            ones = np.zeros(64, dtype=np.int64)
            every = np.frombuffer(hashes, np.uint8).reshape(-1, 8)
            for part in range(0, len(every), 1 << 16):
                ones += np.unpackbits(every[part:part + (1 << 16)], axis=1).sum(axis=0, dtype=np.int64)
            bits = np.packbits(ones * 2 > len(every))
            return int.from_bytes(bits.tobytes(), "big", signed=True)

        for batch in batches:
            fp = [one(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("row"), pa.array(fp, pa.int64())],
                                             ["doc_id", "row", "fp"])

    return src.mapInArrow(encode, "doc_id long, row binary, fp long")


def _row_key(id_col: str, text_col: str) -> Column:
    """128 bits of id and text."""
    text = F.col(text_col).cast("string")
    return F.unhex(F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("-")), F.when(text.isNull(), "-").otherwise(":"),
                                  F.coalesce(text, F.lit(""))).cast("binary")))


class Pivots:
    """Reference fingerprints and the blocks they isolate."""

    def __init__(self, max_bits: int, whole: int, seed: int = 17):
        rng = np.random.default_rng(seed)
        self.max_bits = max_bits
        count = max_bits + whole
        cuts = [round(64 * i / count) for i in range(count + 1)]
        self.choices = list(itertools.combinations(range(count), whole))
        base = int(rng.integers(0, 2**64, dtype=np.uint64))
        every = [base]
        self.of_block: list[list[int]] = []
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            own = []
            for _ in range(PIVOTS_PER_BLOCK):
                own.append(len(every))
                every.append(base ^ (int(rng.integers(1, 1 << (hi - lo), dtype=np.uint64)) << lo))
            self.of_block.append(own)
        every += [int(x) for x in rng.integers(0, 2**64, RANDOM_PIVOTS, dtype=np.uint64)]
        self.values = np.array(every, dtype=np.uint64)

    def keys(self, fp: np.ndarray) -> np.ndarray:
        """One key per choice of blocks (a row for each fingerprint): a hash of the coordinates
        of those blocks' pivots relative to the base pivot."""
        far = np.stack([np.bitwise_count(fp ^ p) for p in self.values]).astype(np.int64)
        block = []
        for own in self.of_block:
            place = np.zeros(len(fp), dtype=np.uint64)
            for k, i in enumerate(own):
                place += (far[i] - far[0] + 32).astype(np.uint64) << np.uint64(7 * k)
            block.append(place)
        out = []
        for n, choice in enumerate(self.choices):
            h = np.full(len(fp), n, dtype=np.uint64)
            for b in choice:
                h = pair_hashes(h, block[b])
            out.append(h)
        return np.stack(out, axis=1).view(np.int64)

    def table(self, fp: np.ndarray) -> np.ndarray:
        return np.stack([np.bitwise_count(fp ^ p) for p in self.values], axis=1).astype(np.int8)

    def linked(self, fp: np.ndarray, rows: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Which pairs (i, j) are within max_bits: discard on the pivot table, 16
        coordinates at a time, then compare the bits of what is left."""
        left = np.arange(len(i))
        for k in range(0, rows.shape[1], 16):
            gap = np.abs(rows[i[left], k:k + 16] - rows[j[left], k:k + 16]).max(axis=1)
            left = left[gap <= self.max_bits]
        ok = np.zeros(len(i), dtype=bool)
        ok[left] = np.bitwise_count(fp[i[left]] ^ fp[j[left]]) <= self.max_bits
        return ok


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least index of the component of each of n nodes."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, root):
            break
        root = new
    return root


def _forest(fp: np.ndarray, key: np.ndarray, pivots: Pivots) -> tuple[np.ndarray, np.ndarray]:
    """Links among rows of equal key, as (fingerprint, root) of a spanning forest."""
    fp, at = np.unique(fp, return_inverse=True)
    rows = pivots.table(fp)
    order = np.argsort(key, kind="stable")
    key, at = key[order], at[order]
    edge = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1], [True])))
    size = np.diff(edge)
    a_all, b_all = [], []
    small = np.flatnonzero((size > 1) & (size <= 64))
    place = np.arange(len(key))
    last = np.repeat(edge[1:], size)
    ok_small = np.zeros(len(key), dtype=bool)
    for s in small:
        ok_small[edge[s]:edge[s + 1]] = True
    for step in range(1, int(size[small].max()) if len(small) else 1):
        i = place[ok_small & (place + step < last)]
        if not len(i):
            break
        x, y = at[i], at[i + step]
        good = pivots.linked(fp, rows, x, y)
        a_all.append(x[good])
        b_all.append(y[good])
    for s in np.flatnonzero(size > 64):
        rest = np.unique(at[edge[s]:edge[s + 1]])
        front: list[int] = []
        while len(rest):            # each row is compared with the rows not reached yet
            if not front:
                front, rest = [int(rest[0])], rest[1:]
            x = front.pop()
            good = pivots.linked(fp, rows, np.full(len(rest), x), rest)
            if good.any():
                hit = rest[good]
                a_all.append(np.full(len(hit), x))
                b_all.append(hit)
                front.extend(hit.tolist())
                rest = rest[~good]
    if not a_all:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    root = _roots(len(fp), np.concatenate(a_all), np.concatenate(b_all))
    moved = np.flatnonzero(root != np.arange(len(fp)))
    return fp[moved], fp[root[moved]]


def links(prints: DataFrame, max_bits: int = 4, hot_rows: int = HOT_ROWS,
          bin_rows: int = BIN_ROWS) -> DataFrame:
    """Links ``a``, ``b`` that connect the same fingerprints as all pairs within
    ``max_bits`` do. ``prints``: distinct ``fp``."""
    n = prints.count()
    whole = 2
    while whole < 4 and n > 16 * 2 ** (64 * whole / (max_bits + whole)):
        whole += 1
    pivots = Pivots(max_bits, whole)

    def key_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                fp = batch.column("fp").slice(at, 4096).to_numpy(zero_copy_only=False)
                keys = pivots.keys(fp.view(np.uint64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(fp, keys.shape[1])), pa.array(keys.reshape(-1))], ["fp", "key"])

    keyed = prints.select("fp").mapInArrow(key_rows, "fp long, key long")
    # keys with many fingerprints: their parts are compared two at a time
    hot = (keyed.groupBy("key").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows)
           .select("key", F.ceil(F.col("_n") / hot_rows).cast("long").alias("_parts")))
    part = F.pmod(F.xxhash64("fp"), F.col("_parts"))
    dealt = (keyed.join(hot, "key", "left")
             .withColumn("_parts", F.coalesce("_parts", F.lit(1).cast("long")))
             .withColumn("_own", part)
             .withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_parts") - 1)))
             .withColumn("key", F.xxhash64("key", F.least("_own", "_other"), F.greatest("_own", "_other"))))
    bins = max(64, -(-n * len(pivots.choices) // bin_rows))

    def find(rows: pa.Table) -> pa.Table:
        a, b = _forest(rows.column("fp").to_numpy().view(np.uint64), rows.column("key").to_numpy(), pivots)
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    return (dealt.select("fp", "key", F.pmod(F.xxhash64("key", F.lit(7)), F.lit(bins)).alias("bin"))
            .groupBy("bin").applyInArrow(find, "a long, b long"))


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       shingle: int = 4, max_bits: int = 4, hot_rows: int = HOT_ROWS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``fingerprint`` (16 lowercase hex
    digits) and ``component_id``, the smallest id reachable over links of at most
    ``max_bits`` differing bits (its own included).

    Null or empty texts have fingerprint zero and link like any other. A null id
    gets the component of its fingerprint and never names one (a component of null
    ids alone has a null id). Repeated rows share everything. Ids are whole numbers (others are an
    error). Only the two named columns are read. An empty table gives no rows.
    """
    prints = checkpointed(fingerprints(docs, id_col, text_col, shingle))
    tagged = _rooted(prints, max_bits, hot_rows)
    named = tagged.groupBy("root").agg(F.min("first.id").alias("component_id"))
    of_print = tagged.select("fp", "root").join(named, "root").select("fp", "component_id")
    return (prints.join(of_print, "fp", "left")
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))


def _rooted(prints: DataFrame, max_bits: int, hot_rows: int) -> DataFrame:
    """``fp``, its component's ``root`` and the ``first`` row that has it: least id (null
    ids last), then least row hash."""
    parts = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), "row"))
    distinct = checkpointed(prints.groupBy("fp").agg(first.alias("first")).repartition(parts, "fp"))
    joined = components(links(distinct.select("fp"), max_bits, hot_rows))
    return (distinct.join(joined.withColumnRenamed("node", "fp"), "fp", "left")
            .withColumn("root", F.coalesce("root", "fp")))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
               max_bits: int = 4, hot_rows: int = HOT_ROWS) -> DataFrame:
    """The rows of ``docs``, all columns, that stay: of every component of
    ``simhash_components`` the one with the least id (null ids last, then by a hash of
    id and text); of repeated rows one."""
    tagged = _rooted(checkpointed(fingerprints(docs, id_col, text_col, shingle)), max_bits, hot_rows)
    stay = tagged.groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.row").alias("_row"))
    row = fresh(docs, "_row")
    return (docs.withColumn(row, _row_key(id_col, text_col)).join(stay.withColumnRenamed("_row", row), row, "left_semi")
            .dropDuplicates([row]).drop(row))
