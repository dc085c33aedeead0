"""Benchmark decontamination by q-gram lemma filtering.

An occurrence of an item of m characters with at most k edits keeps at least
m - q + 1 - q*k of its q-grams, all within k + 1 neighbouring diagonals (text
position minus item position). So the shared q-grams of a text and an item are
counted in overlapping bands of 2(k + 1) diagonals, a band that reaches the bound
is kept, and a banded alignment of the item against the band decides.

Items are a query set: they are sent to the tasks in blocks of bounded size, and
each block is matched against every text in one pass. Texts are never shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowguard.llm.common import checked_broadcast, fresh, text_bytes, window_hashes
from flowguard.session import checkpointed

MAX_Q = 10
MAX_ERROR = 0.08
MIN_CHARS = 20
BLOCK_BYTES = 4 << 20
SEGMENT = 1 << 19
_MAP_BITS = 22


def normalise(text: str | None) -> str:
    """Lower case, white space runs as one space, trimmed."""
    return " ".join((text or "").lower().split())


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


class Items:
    """One block of items with the q-gram index of each q in use."""

    def __init__(self, ids: list, texts: list[str], max_error: float, max_q: int):
        self.ids, self.codes = ids, [_codes(t) for t in texts]
        self.size = np.array([len(c) for c in self.codes], dtype=np.int64)
        self.edits = np.floor(self.size * max_error).astype(np.int64)
        self.width = self.edits + 1
        self.q = np.array([self._best_q(m, k, max_q) for m, k in zip(self.size.tolist(), self.edits.tolist())],
                          dtype=np.int64)
        self.need = self.size - self.q + 1 - self.q * self.edits
        self.longest = int(self.size.max()) if len(ids) else 0
        self.reach = int((self.size + 2 * self.width).max()) if len(ids) else 0
        self.grams = []
        for q in sorted(set(self.q.tolist())):
            own = np.flatnonzero(self.q == q)
            h = np.concatenate([window_hashes(self.codes[i].astype(np.uint64), q) for i in own])
            item = np.repeat(own, self.size[own] - q + 1)
            at = np.concatenate([np.arange(self.size[i] - q + 1) for i in own])
            order = np.argsort(h, kind="stable")
            values, first = np.unique(h[order], return_index=True)
            present = np.zeros(1 << _MAP_BITS, dtype=bool)
            present[values >> np.uint64(64 - _MAP_BITS)] = True
            self.grams.append((q, values, np.append(first, len(h)), item[order], at[order], present))

    @staticmethod
    def _best_q(m: int, k: int, max_q: int) -> int:
        """The longest q whose bound is a fifth of the q-grams or more (at least one);
        with q = 1 and k < m the bound is always positive."""
        for q in range(min(max_q, m), 1, -1):
            if m - q + 1 - q * k >= max(1, (m - q + 1) // 5):
                return q
        return 1

    def bands(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(item, least diagonal) of the bands that reach their item's bound."""
        found_item, found_low = [], []
        for q, values, first, item, at, present in self.grams:
            h = window_hashes(text.astype(np.uint64), q)
            place = np.flatnonzero(present[h >> np.uint64(64 - _MAP_BITS)])
            if not len(place):
                continue
            row = np.minimum(np.searchsorted(values, h[place]), len(values) - 1)
            real = values[row] == h[place]
            place, row = place[real], row[real]
            hits = first[row + 1] - first[row]
            if not hits.sum():
                continue
            start = np.concatenate(([0], np.cumsum(hits)[:-1]))
            entry = np.repeat(first[row] - start, hits) + np.arange(int(hits.sum()))
            it = item[entry]
            band = (np.repeat(place, hits) - at[entry]) // self.width[it]
            base = int(band.min()) - 1
            span = int(band.max()) - base + 1
            key = it * span + (band - base)
            key, count = np.unique(key, return_counts=True)
            key = np.concatenate((key, key - 1))       # a band and the one that starts before it
            count = np.concatenate((count, count))
            key, inverse = np.unique(key, return_inverse=True)
            total = np.bincount(inverse, weights=count).astype(np.int64)
            it = key // span
            good = total >= self.need[it]
            found_item.append(it[good])
            found_low.append((key[good] % span + base) * self.width[it[good]])
        if not found_item:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(found_item), np.concatenate(found_low)


def banded(items: list[np.ndarray], texts: list[np.ndarray], lows: np.ndarray, width: int,
           anchored: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Least edits of each item against a stretch of its text whose diagonals stay in
    low .. low + width - 1, and the end (exclusive) of the first such stretch. The start
    is free within the band, or at position 0 if ``anchored``. All pairs run side by
    side, one item character a step."""
    n, m = len(items), max(map(len, items))
    size = np.array([len(i) for i in items])
    pat = np.zeros((n, m), dtype=np.uint32)
    for r, i in enumerate(items):
        pat[r, :len(i)] = i
    pad = max(0, int(-lows.min())) + 1
    length = max(int((lows + width).max()) + m, max(map(len, texts))) + 2
    txt = np.full((n, pad + length), 0xFFFFFFFF, dtype=np.uint32)
    ends = np.array([len(t) for t in texts])
    for r, t in enumerate(texts):
        txt[r, pad:pad + len(t)] = t
    diag = lows[:, None] + np.arange(width)[None, :]
    big = np.int32(1 << 20)
    legal = (diag >= 0) & (diag <= ends[:, None])
    ramp = np.arange(width, dtype=np.int32)
    now = np.where(legal & ((diag == 0) | (not anchored)), np.int32(0), big)
    if anchored:
        now = np.minimum.accumulate(now - ramp, axis=1) + ramp
    best = np.full(n, big, dtype=np.int32)
    stop = np.zeros(n, dtype=np.int64)
    rows = np.arange(n)[:, None]
    for i in range(m):
        text_at = diag + i
        same = txt[rows, text_at + pad] == pat[:, i:i + 1]
        step = now + np.where(same, np.int32(0), np.int32(1))
        step[:, :-1] = np.minimum(step[:, :-1], now[:, 1:] + 1)
        step[(text_at + 1 < 0) | (text_at + 1 > ends[:, None])] = big
        now = np.minimum.accumulate(step - ramp, axis=1) + ramp
        done = size == i + 1
        if done.any():
            end = now[done].argmin(axis=1)
            best[done] = now[done].min(axis=1)
            stop[done] = lows[done] + end + i + 1
    return best, stop


def _origin(text: str, start: int, end: int) -> tuple[int, int]:
    """Code points of the text that a stretch of its normalised form stands for."""
    at, where = 0, []
    for n, c in enumerate(text):
        low = c.lower()
        if c.isspace():
            if where and where[-1] is not None:
                where.append(None)
            continue
        if where and where[-1] is None:
            where[-1] = n - 1
        where += [n] * len(low)
        at = len(where)
        if at >= end:
            break
    where = [w for w in where if w is not None]
    return where[min(start, len(where) - 1)], where[min(end, len(where)) - 1] + 1


def match_texts(texts: list[str | None], items: Items) -> list[tuple[int, int, int, int, int]]:
    """(text, item, start, end, edits): the best stretch (fewest edits, then first) of
    each pair of a text and an item within the item's edit budget."""
    norm = [_codes(normalise(t)) for t in texts]
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    # several short texts side by side, or one stretch of a long one, at a time
    pieces: list[list[tuple[int, int, np.ndarray]]] = [[]]
    filled = 0
    step = SEGMENT
    for t, code in enumerate(norm):
        for lo in range(0, max(1, len(code)), step):
            part = code[max(0, lo - items.reach):lo + step]
            if filled + len(part) > 2 * SEGMENT and pieces[-1]:
                pieces.append([])
                filled = 0
            pieces[-1].append((t, max(0, lo - items.reach), part))
            filled += len(part) + 1
    for piece in pieces:
        gap = np.zeros(1, dtype=np.uint32)
        every = np.concatenate([x for _, _, part in piece for x in (part, gap)])
        start = np.cumsum([0] + [len(part) + 1 for _, _, part in piece])
        found, low = items.bands(every)
        if not len(found):
            continue
        # a band belongs to the text that its middle lies in (bands reach both ways)
        pairs = []
        for it, lo in zip(found.tolist(), low.tolist()):
            w = 2 * int(items.width[it])
            first = max(0, int(np.searchsorted(start, lo, side="right")) - 1)
            last = min(len(piece) - 1, int(np.searchsorted(start, lo + w, side="right")) - 1)
            for p in range(first, last + 1):
                pairs.append((it, p, lo - int(start[p]), w))
        for at in range(0, len(pairs), 256):
            some = pairs[at:at + 256]
            width = max(w for *_, w in some)
            cut = [max(0, lo) for _, _, lo, _ in some]
            texts_cut = [piece[p][2][c:max(c, lo + w + int(items.size[it]))]
                         for (it, p, lo, w), c in zip(some, cut)]
            lows = np.array([lo - c for (_, _, lo, _), c in zip(some, cut)])
            edits, stop = banded([items.codes[it] for it, *_ in some], texts_cut, lows, width)
            for (it, p, _, _), c, txt, e, s in zip(some, cut, texts_cut, edits.tolist(), stop.tolist()):
                if e > items.edits[it]:
                    continue
                t, shift, _ = piece[p]
                k = int(items.edits[it])
                back, length = banded([items.codes[it][::-1]], [txt[:s][::-1][:int(items.size[it]) + k + 1]],
                                      np.array([-k]), 2 * k + 1, anchored=True)
                begin = s - int(length[0])
                new = (e, shift + c + begin, shift + c + s)
                if (t, it) not in best or new < best[t, it]:
                    best[t, it] = new
    out = []
    for (t, it), (e, a, b) in sorted(best.items()):
        a, b = _origin(texts[t], a, b)
        out.append((t, it, a, b, e))
    return out


def _blocks(items: DataFrame, item_col: str, item_text_col: str, min_chars: int, block_bytes: int):
    """The query set in blocks of about ``block_bytes``, whatever the number of items."""
    bench = items.select(F.col(item_col).alias("item_id"), F.col(item_text_col).cast("string").alias("text")).where(
        F.col("text").isNotNull())
    blocks = max(1, math.ceil(text_bytes(bench, F.col("text")) / block_bytes))
    for b in range(blocks):
        rows = [(r["item_id"], normalise(r["text"])) for r in
                bench.where(F.pmod(F.xxhash64("text", "item_id"), F.lit(blocks)) == b).toLocalIterator()]
        rows = [r for r in rows if len(r[1]) >= max(1, min_chars)]
        if rows:
            yield rows


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text", max_error: float = MAX_ERROR,
                 max_q: int = MAX_Q, min_chars: int = MIN_CHARS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id``, ``item_id``, ``start``, ``end`` (code points, end exclusive), ``edits``:
    one row for each row of ``docs`` and item whose text the document holds with at
    most ``max_error`` edits per item character, both lower-cased with white space
    runs as one space; the place is the stretch with the fewest edits, then the first.

    Items whose normalised text is shorter than ``min_chars``, or null, are no
    passages and match nothing. Null or empty documents match nothing. Repeated
    rows on either side give repeated rows; null ids are reported as they are. Only
    the four named columns are read. Without items or documents there are no rows.
    """
    doc_type = docs.schema[id_col].dataType.simpleString()
    item_type = items.schema[item_col].dataType.simpleString()
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = f"doc_id {doc_type}, item_id {item_type}, start long, end long, edits long"
    spark = docs.sparkSession
    parts = []
    for rows in _blocks(items, item_col, item_text_col, min_chars, block_bytes):
        sent = spark.sparkContext.broadcast((rows, max_error, max_q))

        def search(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            rows, error, q = sent.value
            index = Items([i for i, _ in rows], [t for _, t in rows], error, q)
            for batch in batches:
                for at in range(0, batch.num_rows, 256):
                    part = batch.slice(at, 256)
                    ids = part.column("doc_id").to_pylist()
                    found = match_texts(part.column("text").to_pylist(), index)
                    if found:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([ids[t] for t, *_ in found], part.column("doc_id").type),
                             pa.array([index.ids[i] for _, i, *_ in found]),
                             *[pa.array([f[c] for f in found], pa.int64()) for c in (2, 3, 4)]],
                            ["doc_id", "item_id", "start", "end", "edits"])

        parts.append(src.mapInArrow(search, schema))
    if not parts:
        return spark.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, parts)


def drop_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id",
                      item_text_col: str = "text", max_error: float = MAX_ERROR, max_q: int = MAX_Q,
                      min_chars: int = MIN_CHARS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs``, all columns, whose text holds no item (as in ``contaminated``).
    Rows are judged by their text alone, so null and repeated ids do not matter; null texts stay.

    With one block of items the rows are filtered where they lie. With more, each block is a
    pass of its own that names the texts it hits (128 bits each), and rows with one of these
    go, so that a task never holds more than one block's index.
    """
    sent = [docs.sparkSession.sparkContext.broadcast((rows, max_error, max_q))
            for rows in _blocks(items, item_col, item_text_col, min_chars, block_bytes)]
    if not sent:
        return docs

    def judged(part: pa.RecordBatch, index: Items, column: str) -> list[bool]:
        hit = {t for t, *_ in match_texts(part.column(column).to_pylist(), index)}
        return [i in hit for i in range(part.num_rows)]

    def clean(batches: Iterator[pa.RecordBatch], sent=sent[0]) -> Iterator[pa.RecordBatch]:
        rows, error, q = sent.value
        index = Items([i for i, _ in rows], [t for _, t in rows], error, q)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                yield part.filter(pa.array([not x for x in judged(part, index, text_col)]))

    if len(sent) == 1:
        return docs.mapInArrow(clean, docs.schema)
    key = fresh(docs, "_digest")
    digest = F.md5(F.col(text_col).cast("string").cast("binary"))
    src = docs.select(digest.alias(key), F.col(text_col).cast("string").alias("_text"))

    def hits(one):
        def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rows, error, q = one.value
            index = Items([i for i, _ in rows], [t for _, t in rows], error, q)
            for batch in batches:
                for at in range(0, batch.num_rows, 256):
                    part = batch.slice(at, 256)
                    yield part.select([key]).filter(pa.array(judged(part, index, "_text")))
        return find
    found = reduce(DataFrame.unionByName, [src.mapInArrow(hits(one), f"{key} string") for one in sent])
    return docs.withColumn(key, digest).join(checked_broadcast(checkpointed(found.distinct())), key, "left_anti").drop(key)
