"""SentencePiece encoding and decoding, giant documents by a max-plus parallel scan.

A text up to ``giant_chars`` is segmented by one task. A longer one is cut in chunks of
``chunk_chars`` and segmented by many:

1. every chunk yields a transfer matrix M[i][j]: the best score from entering it i
   characters in (a piece of the chunk before reached so far) to leaving it j
   characters into the next one;
2. matrices are combined with (max, +), which is associative: products of up to
   ``FAN`` neighbours, level by level, then the scores at every chunk's entry on
   the way down;
3. with its entry scores a chunk knows, for every way to leave it, where the best path
   enters it; these maps are composed from the right in the same levels, which gives
   every chunk the place where the whole text's best path leaves it;
4. every chunk traces its own path back from there; a text's ids are its chunks' ids.

The result equals the sequential one, ties included: sums are exact, and an entry
counts as an earlier start than any piece inside the chunk.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowguard.llm.unigram import SPACE, Unigram, Vocabulary, decode, prepare, read_vocabulary
from flowguard.session import checkpointed

GIANT_CHARS = 1 << 15
CHUNK_CHARS = 1 << 13
FAN = 64
_NONE = -1


class _Chunk:
    """One chunk with the characters behind it that a piece can still cover."""

    def __init__(self, model: Unigram, text: str, size: int):
        self.model, self.text, self.size, self.states = model, text, size, model.longest
        # places that no piece covers: every path has a node there
        self.cut = None
        if model.parts is not None:
            inner = text[1:size]
            first = next((k + 1 for k, c in enumerate(inner) if c == SPACE and text[k] != SPACE), None)
            if first is not None:
                last = next(k for k in range(size - 1, 0, -1) if text[k] == SPACE and text[k - 1] != SPACE)
                self.cut = (first, last)

    def _exits(self, best) -> np.ndarray:
        out = np.full(self.states, -np.inf)
        for j in range(min(self.states, len(best) - self.size)):
            out[j] = best[self.size + j]
        return out

    def _tail(self, score: float = 0.0):
        """Best path from the last cut over the chunk's end; no node may start behind it."""
        at = self.cut[1]
        return self._open(self.text[at:], self.size - at, {0: score})

    def _open(self, text: str, size: int, entry: dict[int, float]):
        """As forward(), but only pieces that start before ``size`` may be used."""
        best = [-np.inf] * (len(text) + 1)
        back: list = [None] * (len(text) + 1)
        for at, s in entry.items():
            if at <= len(text):
                best[at] = s
        for end, start, s, i in self.model.matches(text):
            if start < size and best[start] + s > best[end]:
                best[end], back[end] = best[start] + s, (start, i)
        return best, back

    def matrix(self) -> np.ndarray:
        m = np.full((self.states, self.states), -np.inf)
        if self.cut is None:
            for i in range(min(self.states, self.size + 1)):
                best, _ = self._open(self.text, self.size, {i: 0.0})
                own = [-np.inf if b == -np.inf else b for b in best]
                m[i] = np.array([own[self.size + j] if self.size + j < len(own) else -np.inf
                                 for j in range(self.states)])
            return m
        first, last = self.cut
        middle = self.model.prepared_path(self.text[first:last])[1]
        best, _ = self._tail()
        exits = np.array([best[self.size - last + j] if self.size - last + j < len(best) else -np.inf
                          for j in range(self.states)])
        for i in range(min(self.states, first + 1)):
            head, _ = self.model.forward(self.text[:first], {i: 0.0})
            m[i] = head[first] + middle + exits
        return m

    def entries(self, scores: np.ndarray) -> np.ndarray:
        """For every way to leave the chunk the place where the best path enters it."""
        entry = {i: float(s) for i, s in enumerate(scores) if s > -np.inf}
        out = np.full(self.states, _NONE, dtype=np.int64)
        if self.cut is None:
            best, back = self._open(self.text, self.size, entry)
            for j in range(self.states):
                if self.size + j < len(best) and best[self.size + j] > -np.inf:
                    out[j] = self.model.trace(self.text, back, self.size + j)[1]
            return out
        first = self.cut[0]
        _, back = self.model.forward(self.text[:first], {i: s for i, s in entry.items() if i <= first})
        out[:] = self.model.trace(self.text[:first], back, first)[1]
        return out

    def path(self, scores: np.ndarray, leave: int) -> list[int]:
        entry = {i: float(s) for i, s in enumerate(scores) if s > -np.inf}
        if self.cut is None:
            _, back = self._open(self.text, self.size, entry)
            return self.model.trace(self.text, back, self.size + leave)[0]
        first, last = self.cut
        _, back = self.model.forward(self.text[:first], {i: s for i, s in entry.items() if i <= first})
        head = self.model.trace(self.text[:first], back, first)[0]
        middle = self.model.prepared_path(self.text[first:last])[0]
        _, back = self._tail()
        return head + middle + self.model.trace(self.text[last:], back, self.size - last + leave)[0]


def times(vector: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    return (vector[:, None] + matrix).max(axis=0)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """(max, +) product."""
    return (a[:, :, None] + b[None, :, :]).max(axis=1)


def _square(flat) -> np.ndarray:
    m = np.array(flat, dtype=float)
    side = int(round(len(m) ** 0.5))
    return m.reshape(side, side)


def _rows(table: pa.Table) -> list[dict]:
    return sorted(table.to_pylist(), key=lambda r: r["n"])


def _scan(chunks: DataFrame, deepest: int, up, down, start: list, kind: str, backwards: bool) -> DataFrame:
    """``state`` of every (key, n) of ``chunks`` with ``item``: what the items before it
    (or after it, ``backwards``) make of ``start``. ``up`` combines the items of up to FAN
    neighbours to one, ``down`` carries a state through them."""
    schema = f"key string, n long, item array<{kind}>"
    listed = pa.list_({"double": pa.float64(), "bigint": pa.int64()}[kind])

    def combine(rows: pa.Table) -> pa.Table:
        own = _rows(rows)
        out = up([r["item"] for r in own])
        return pa.table({"key": [own[0]["key"]], "n": pa.array([own[0]["n"] // FAN], pa.int64()),
                         "item": pa.array([out], listed)})

    levels = [chunks.select("key", "n", "item")]
    width = deepest
    while width > 1:
        levels.append(levels[-1].withColumn("g", F.floor(F.col("n") / FAN)).groupBy("key", "g")
                      .applyInArrow(combine, schema))
        width = -(-width // FAN)
    state = levels[-1].select("key", F.col("n").alias("g"), F.array(*[F.lit(x).cast(kind) for x in start]).alias("state"))

    def spread(left: pa.Table, right: pa.Table) -> pa.Table:
        own = _rows(left)
        now = right.column("state")[0].as_py()
        out = []
        for r in reversed(own) if backwards else own:
            out.append((r["key"], r["n"], now))
            now = down(now, r["item"])
        return pa.table({"key": [o[0] for o in out], "g": pa.array([o[1] for o in out], pa.int64()),
                         "state": pa.array([o[2] for o in out], listed)})

    for level in reversed(levels[:-1]):
        state = (level.withColumn("g", F.floor(F.col("n") / FAN)).groupBy("key", "g")
                 .cogroup(state.groupBy("key", "g"))
                 .applyInArrow(spread, f"key string, g long, state array<{kind}>"))
    return state.select("key", F.col("g").alias("n"), "state")


def _giant_ids(texts: DataFrame, sent, chunk_chars: int) -> DataFrame:
    """``key``, ``ids`` of texts (key, text) by the scan."""
    vocabulary: Vocabulary = sent.value
    states = max(map(len, vocabulary.pieces))
    size = max(chunk_chars, 2 * states)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist()):
                text = prepare(text)
                starts = range(0, len(text), size)
                yield pa.RecordBatch.from_pydict({
                    "key": [key] * len(starts), "n": pa.array(range(len(starts)), pa.int64()),
                    "size": pa.array([min(size, len(text) - s) for s in starts], pa.int64()),
                    "body": [text[s:s + size + states] for s in starts]})

    pieces = checkpointed(texts.mapInArrow(cut, "key string, n long, size long, body string")
                          .repartition(F.col("key"), F.col("n")))
    deepest = (pieces.agg(F.max("n").alias("m")).first()["m"] or 0) + 1

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Unigram(sent.value)
        for b in batches:
            found = [_Chunk(model, t, s).matrix().reshape(-1)
                     for t, s in zip(b.column("body").to_pylist(), b.column("size").to_pylist())]
            yield pa.RecordBatch.from_pydict({"key": b.column("key"), "n": b.column("n"), "item": pa.array(
                found, pa.list_(pa.float64()))})

    def all_of(items: list) -> list:
        out = _square(items[0])
        for m in items[1:]:
            out = product(out, _square(m))
        return out.reshape(-1).tolist()

    begin = [0.0] + [float("-inf")] * (states - 1)
    entry = _scan(pieces.mapInArrow(matrices, "key string, n long, item array<double>"), deepest, all_of,
                  lambda v, m: times(np.array(v), _square(m)).tolist(), begin, "double", False)
    placed = checkpointed(pieces.join(entry, ["key", "n"]))

    def enters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Unigram(sent.value)
        for b in batches:
            found = [_Chunk(model, t, s).entries(np.array(v)) for t, s, v in zip(
                b.column("body").to_pylist(), b.column("size").to_pylist(), b.column("state").to_pylist())]
            yield pa.RecordBatch.from_pydict({"key": b.column("key"), "n": b.column("n"), "item": pa.array(
                found, pa.list_(pa.int64()))})

    def chain(items: list) -> list:
        out = np.arange(states)
        for m in reversed(items):
            m = np.append(np.array(m), _NONE)
            out = m[out]
        return out.tolist()

    leave = _scan(placed.mapInArrow(enters, "key string, n long, item array<bigint>"), deepest, chain,
                  lambda j, m: [m[j[0]] if j[0] != _NONE else _NONE], [0], "bigint", True)
    ready = placed.join(leave.select("key", "n", F.col("state")[0].alias("leave")), ["key", "n"])

    def paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Unigram(sent.value)
        for b in batches:
            found = [_Chunk(model, t, s).path(np.array(v), j) for t, s, v, j in zip(
                b.column("body").to_pylist(), b.column("size").to_pylist(),
                b.column("state").to_pylist(), b.column("leave").to_pylist())]
            yield pa.RecordBatch.from_pydict({"key": b.column("key"), "n": b.column("n"), "ids": pa.array(
                found, pa.list_(pa.int32()))})

    traced = ready.select("key", "n", "size", "body", "state", "leave").mapInArrow(
        paths, "key string, n long, ids array<int>")
    return traced.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("n", "ids"))).alias("all")).select(
        "key", F.flatten(F.col("all.ids")).alias("ids"))


def _same(surface: list[bytes], text: str | None, ids) -> bool:
    """Decoding the ids gives the text again (U+2581 is what the model writes for a space;
    null counts as empty)."""
    return decode(surface, ids) == (text or "").replace(SPACE, " ")


def _checked(batches: Iterator[pa.RecordBatch], surface: list[bytes]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            ok = [_same(surface, t, i.values.to_numpy().tolist()) for t, i in zip(
                part.column("text").to_pylist(), part.column("ids"))]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(ok)], [*part.schema.names, "round_trip"])


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
           giant_chars: int = GIANT_CHARS, chunk_chars: int = CHUNK_CHARS, keep_text: bool = True) -> DataFrame:
    """``doc_id``, ``text`` (if ``keep_text``), ``ids`` and ``round_trip`` of every row: the piece
    ids of the whole text, and whether decoding them gives the text again (U+2581 counts
    as a space, null as empty).

    Null or empty text: no ids. Repeated rows are encoded each, null ids kept. Only the
    two named columns are read. An empty table gives no rows. Texts above
    ``giant_chars`` characters go through the scan, with the same result.
    """
    sent = docs.sparkSession.sparkContext.broadcast(read_vocabulary(model_path))
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    giant = F.coalesce(F.length("text") > giant_chars, F.lit(False))
    kind = docs.schema[id_col].dataType.simpleString()
    names = ["doc_id", *(["text"] if keep_text else []), "ids", "round_trip"]
    schema = f"doc_id {kind}, " + "text string, " * keep_text + "ids array<int>, round_trip boolean"

    def plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Unigram(sent.value)
        surface = sent.value.surface
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                texts = part.column("text").to_pylist()
                packed = [model.encode_packed(t) for t in texts]
                ids = [np.frombuffer(p, "<i4") for p in packed]
                ends = np.cumsum([0] + [len(i) for i in ids]).astype(np.int32)
                ok = [_same(surface, t, i.tolist()) for t, i in zip(texts, ids)]
                column = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(
                    np.frombuffer(b"".join(packed), "<i4"), pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *([part.column("text")] if keep_text else []), column, pa.array(ok)], names)

    small = src.where(~giant).mapInArrow(plain, schema)
    large = src.where(giant).withColumn("key", F.sha2("text", 256))
    found = _giant_ids(large.select("key", "text").dropDuplicates(["key"]), sent, chunk_chars)
    checked = large.join(found, "key").select("doc_id", "text", "ids").mapInArrow(
        lambda b: _checked(b, sent.value.surface), f"doc_id {kind}, text string, ids array<int>, round_trip boolean")
    return small.unionByName(checked.select(names))


def decoded(ids_table: DataFrame, model_path: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """Adds the text of a column of ids (null ids: null; no ids: empty text)."""
    sent = ids_table.sparkSession.sparkContext.broadcast(read_vocabulary(model_path).surface)

    @F.pandas_udf("string")
    def back(ids):
        return ids.map(lambda x: None if x is None else decode(sent.value, x.tolist()))

    return ids_table.withColumn(out, back(F.col(ids_col)))
