"""Merkle manifest of a table: leaves, roots and inclusion proofs by bitmap-rank indexing.

Leaves are never sorted. The place of a row among the leaves of its group is a rank query:

1. **bitmaps**: every task packs the ids it reads to containers of ``1 << CONTAINER_BITS``
   consecutive ids of a group (a bitmap, or a list where ids are sparse, with a popcount
   directory and the numbers of ids that repeat); containers of one range are merged;
2. **ranks**: a running sum over the containers gives the rank of a container's first id,
   popcounts inside it the rest. Rows whose id repeats share the id's rank and are numbered by
   their leaf (``plans/prefix.py``), so one id may hold any part of the table;
3. **slot arrays**: rows go to keyed arrays of ``1 << BLOCK_LEVELS`` slots (group, rank >>
   BLOCK_LEVELS) and are put at their slot. An array gives one node that many levels up, and
   so on until a group has one node; the groups' nodes are then slots of one more tree;
4. **paths** come down the same arrays, one row an array, to the rows.

What moves is narrow: ids, digests, containers. The text is read once, for its leaf.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowguard.llm.common import checked_broadcast
from flowguard.plans.prefix import row_number, running_sum
from flowguard.session import checkpointed

CONTAINER_BITS = 12
BLOCK_LEVELS = 12
#: The range of rows without an id: before that of the least id.
_NO_ID = -(1 << 60)
#: Ids a task packs at once.
PACK_ROWS = 1 << 20
#: Containers with more ids than this are bitmaps, others lists of 2 bytes an id.
_LIST_IDS = 288
_WORDS = (1 << CONTAINER_BITS) // 64

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf_digest(*values: Column) -> Column:
    """Lower-case hex SHA-256 of the values one after another: ``-`` for null, else the
    UTF-8 byte count, a colon and the value as text."""
    def field(c: Column) -> Column:
        text = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))
    return F.sha2(F.concat(*[field(c) for c in values]).cast("binary"), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that ``path`` (steps ``L<digest>``: sibling before, ``R<digest>``: sibling
    after, ``-``: no sibling) leads to from ``leaf``."""
    return F.aggregate(path, leaf, lambda node, step: F.sha2(
        F.when(step.startswith("L"), F.concat(F.substr(step, F.lit(2)), node))
        .when(step.startswith("R"), F.concat(node, F.substr(step, F.lit(2))))
        .otherwise(node).cast("binary"), 256))


def siblings(path: Column) -> Column:
    """The siblings' digests of ``path`` one after another, leaf to root."""
    return F.array_join(F.transform(path, lambda step: F.substr(step, F.lit(2))), "")


def node_digest(children: list[bytes]) -> bytes:
    return hashlib.sha256(b"".join(children)).hexdigest().encode()


def levels_up(nodes: list[bytes], levels: int) -> list[list[bytes]]:
    """``nodes`` and the ``levels`` levels above them: every two consecutive nodes become one,
    a last single one as well."""
    out = [nodes]
    for _ in range(levels):
        below = out[-1]
        out.append([node_digest(below[i:i + 2]) for i in range(0, len(below), 2)])
    return out


def path_up(tree: list[list[bytes]], at: int) -> list[str]:
    """Steps from node ``at`` of the lowest level to the top of ``tree``."""
    steps = []
    for level in tree[:-1]:
        other = at ^ 1
        steps.append("-" if other >= len(level) else ("L" if at & 1 else "R") + level[other].decode())
        at >>= 1
    return steps


# Containers ------------------------------------------------------------------------------------

def pack_container(low: np.ndarray, count: np.ndarray) -> tuple[int, int, bytes, bytes]:
    """Number of ids, number of rows, the packed ids and the packed repeats of one container:
    ``low`` ascending ids inside it, ``count`` the rows of each."""
    if len(low) > _LIST_IDS:
        bits = np.zeros(_WORDS * 64, dtype=np.uint8)
        bits[low] = 1
        words = np.packbits(bits, bitorder="little").view("<u8")
        before = np.concatenate(([0], np.cumsum(np.bitwise_count(words).astype(np.int64))[:-1]))
        blob = before.astype("<u2").tobytes() + words.tobytes()
    else:
        blob = low.astype("<u2").tobytes()
    many = count > 1
    extra = low[many].astype("<u2").tobytes() + (count[many] - 1).astype("<i8").tobytes()
    return len(low), int(count.sum()), blob, extra


def _extras(extra: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(extra) // 10
    return np.frombuffer(extra, "<u2", n).astype(np.int64), np.frombuffer(extra, "<i8", n, 2 * n)


def unpack_container(card: int, blob: bytes, extra: bytes) -> tuple[np.ndarray, np.ndarray]:
    if card > _LIST_IDS:
        words = np.frombuffer(blob, np.uint8, _WORDS * 8, _WORDS * 2)
        low = np.flatnonzero(np.unpackbits(words, bitorder="little"))
    else:
        low = np.frombuffer(blob, "<u2", card).astype(np.int64)
    count = np.ones(card, dtype=np.int64)
    at, more = _extras(extra)
    count[np.searchsorted(low, at)] += more
    return low, count


def rank_in_container(card: int, blob: bytes, extra: bytes, low: np.ndarray) -> np.ndarray:
    """Rows of the container before each of ``low``: a directory entry, one popcount and the
    repeats of smaller ids."""
    if card > _LIST_IDS:
        before = np.frombuffer(blob, "<u2", _WORDS).astype(np.int64)
        words = np.frombuffer(blob, "<u8", _WORDS, _WORDS * 2)
        word, bit = low >> 6, (low & 63).astype(np.uint64)
        rank = before[word] + np.bitwise_count(words[word] & ((np.uint64(1) << bit) - np.uint64(1))).astype(np.int64)
    else:
        rank = np.searchsorted(np.frombuffer(blob, "<u2", card).astype(np.int64), low)
    at, more = _extras(extra)
    total = np.concatenate(([0], np.cumsum(more)))
    return rank + total[np.searchsorted(at, low)]


_CONTAINER = "g string, hi long, card long, total long, ids binary, extra binary"
_CONTAINER_SCHEMA = pa.schema([("g", pa.string()), ("hi", pa.int64()), ("card", pa.int64()), ("total", pa.int64()),
                               ("ids", pa.binary()), ("extra", pa.binary())])


def _containers_of(rows: pa.Table) -> pa.RecordBatch:
    """Containers of rows (g, hi, low), at least one."""
    names = rows.column("g").combine_chunks().dictionary_encode()
    if isinstance(names, pa.ChunkedArray):
        names = names.combine_chunks()
    code, hi, low = names.indices.to_numpy(), rows.column("hi").to_numpy(), rows.column("low").to_numpy()
    order = np.lexsort((low, hi, code))
    code, hi, low = code[order], hi[order], low[order]
    new_range = np.concatenate(([True], (code[1:] != code[:-1]) | (hi[1:] != hi[:-1])))
    first = np.flatnonzero(new_range | np.concatenate(([True], low[1:] != low[:-1])))
    count = np.diff(np.append(first, len(low)))
    starts = np.flatnonzero(new_range[first])
    texts = names.dictionary.to_pylist()
    out = []
    for a, b in zip(starts, np.append(starts[1:], len(first))):
        at = first[a]
        out.append((texts[code[at]], int(hi[at]), *pack_container(low[first[a:b]], count[a:b])))
    cols = list(zip(*out))
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _CONTAINER_SCHEMA)], schema=_CONTAINER_SCHEMA)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, n = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
        n += batch.num_rows
        if n >= PACK_ROWS:
            yield _containers_of(pa.Table.from_batches(held))
            held, n = [], 0
    if held:
        yield _containers_of(pa.Table.from_batches(held))


def _merge(rows: pa.Table) -> pa.Table:
    """All containers of one range of ids as one."""
    parts = [unpack_container(c, i, e) for c, i, e in zip(*[rows.column(x).to_pylist() for x in ("card", "ids", "extra")])]
    count = np.zeros(1 << CONTAINER_BITS, dtype=np.int64)
    for low, n in parts:
        count[low] += n
    ids = np.flatnonzero(count)
    first = rows.slice(0, 1)
    return pa.table([first.column("g").combine_chunks(), first.column("hi").combine_chunks(),
                     *[pa.array([x], f.type) for x, f in zip(pack_container(ids, count[ids]), list(_CONTAINER_SCHEMA)[2:])]],
                    schema=_CONTAINER_SCHEMA)


def _rank(left: pa.Table, right: pa.Table) -> pa.Table:
    """``left`` with ``at``, the rank of each row's id in its group."""
    if not left.num_rows:
        return left.drop_columns(["hi", "low"]).append_column("at", pa.array([], pa.int64()))
    card, blob, extra, base = (right.column(c)[0].as_py() for c in ("card", "ids", "extra", "base"))
    at = base + rank_in_container(card, blob, extra, left.column("low").to_numpy())
    return left.drop_columns(["hi", "low"]).append_column("at", pa.array(at, pa.int64()))


# Slot arrays -----------------------------------------------------------------------------------

_ARRAY = "g string, n long, block long, top string, nodes binary, key binary, claims array<string>"


def _depth(n: int) -> int:
    """Levels above ``n`` nodes until one is left."""
    return max(0, (n - 1).bit_length())


def _array_of(rows: pa.Table) -> pa.Table:
    """One slot array: the rows (g, n, block, at, digest, key, claim) at their slots."""
    slot = rows.column("at").to_numpy() & ((1 << BLOCK_LEVELS) - 1)
    order = np.empty(len(slot), dtype=np.int64)
    order[slot] = np.arange(len(slot))
    rows = rows.take(pa.array(order))
    n = rows.column("n")[0].as_py()
    nodes = [d.encode() for d in rows.column("digest").to_pylist()]
    top = levels_up(nodes, min(BLOCK_LEVELS, _depth(n)))[-1][0]
    keys = rows.column("key")
    have = np.array([k is not None for k in keys.to_pylist()], dtype=np.uint8)
    packed = have.tobytes() + keys.fill_null(0).to_numpy().astype("<i8").tobytes()
    return pa.table({"g": rows.column("g").slice(0, 1), "n": rows.column("n").slice(0, 1),
                     "block": rows.column("block").slice(0, 1), "top": pa.array([top.decode()]),
                     "nodes": pa.array([bytes.fromhex(b"".join(nodes).decode())], pa.binary()),
                     "key": pa.array([packed], pa.binary()),
                     "claims": pa.array([rows.column("claim").to_pylist()], pa.list_(pa.string()))})


def _arrays(nodes: DataFrame) -> DataFrame:
    """Slot arrays of nodes (g, n, at, digest, key, claim)."""
    return checkpointed(
        nodes.select("g", "n", F.shiftright("at", BLOCK_LEVELS).alias("block"), "at", "digest", "key", "claim")
        .groupBy("g", "block").applyInArrow(_array_of, _ARRAY))


_ROW = "g string, key long, at long, digest string, claim string, path array<string>"


def _unfold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The slots of arrays with their paths: inside the array, then on from its top."""
    for batch in batches:
        for r in range(batch.num_rows):
            row = {c: batch.column(c)[r].as_py() for c in ("g", "n", "block", "nodes", "key", "claims", "path")}
            raw = row["nodes"].hex().encode()
            nodes = [raw[i:i + 64] for i in range(0, len(raw), 64)]
            tree = levels_up(nodes, min(BLOCK_LEVELS, _depth(row["n"])))
            have = np.frombuffer(row["key"], np.uint8, len(nodes)).astype(bool)
            keys = np.frombuffer(row["key"], "<i8", len(nodes), len(nodes))
            for lo in range(0, len(nodes), 1024):
                hi = min(len(nodes), lo + 1024)
                yield pa.RecordBatch.from_arrays([
                    pa.array([row["g"]] * (hi - lo), pa.string()),
                    pa.array(keys[lo:hi], pa.int64(), mask=~have[lo:hi]),
                    pa.array(np.arange(lo, hi) + (row["block"] << BLOCK_LEVELS), pa.int64()),
                    pa.array([d.decode() for d in nodes[lo:hi]], pa.string()),
                    pa.array(row["claims"][lo:hi], pa.string()),
                    pa.array([path_up(tree, i) + row["path"] for i in range(lo, hi)], pa.list_(pa.string()))],
                    ["g", "key", "at", "digest", "claim", "path"])


def _tree(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The rounds of slot arrays above ``nodes`` (g, n, at, digest, key, claim), lowest first,
    and the top (g, digest) of every group."""
    rounds, tops = [], None
    while True:
        arrays = _arrays(nodes)
        rounds.append(arrays)
        one = arrays.where(F.col("n") <= 1 << BLOCK_LEVELS).select("g", F.col("top").alias("digest"))
        tops = one if tops is None else tops.unionByName(one)
        more = arrays.where(F.col("n") > 1 << BLOCK_LEVELS)
        if more.limit(1).isEmpty():
            return rounds, tops
        nodes = more.select("g", F.ceil(F.col("n") / (1 << BLOCK_LEVELS)).cast("long").alias("n"),
                            F.col("block").alias("at"), F.col("top").alias("digest"),
                            F.lit(None).cast("long").alias("key"), F.lit(None).cast("string").alias("claim"))


def _paths(rounds: list[DataFrame], top_paths: DataFrame) -> DataFrame:
    """Every slot of the lowest round with its whole path. ``top_paths`` (g, path) leads on
    from the top of each group's tree."""
    above = None
    for arrays in reversed(rounds):
        topped = arrays.where(F.col("n") <= 1 << BLOCK_LEVELS).join(checked_broadcast(top_paths), "g")
        if above is not None:
            way = above.select("g", F.col("at").alias("block"), "path")
            topped = topped.unionByName(arrays.where(F.col("n") > 1 << BLOCK_LEVELS).join(
                checked_broadcast(way, 20_000), ["g", "block"]).select(topped.columns))
        above = topped.mapInArrow(_unfold, _ROW)
    return above


def merkle_manifest(docs: DataFrame, id_col: str = "doc_id", group_col: str = "lang", fields: tuple = FIELDS,
                    claim: Column | None = None) -> DataFrame:
    """``group`` (the value of ``group_col``), ``id``, ``position`` (of the leaf in its
    group, from 0), ``leaf``, ``claim``, ``path`` (steps from leaf to root, see ``fold``),
    ``subroot`` and ``root`` of every row of ``docs``.

    A leaf is ``leaf_digest`` of ``fields``; leaves of a group ascend by id; every two
    consecutive nodes become one (a last single one as well) until one is left, the subroot;
    subroots in the order of their groups (null first, then by UTF-8 bytes) give the root in
    the same way. ``claim`` is the digest somebody holds for a row (default: its leaf);
    ``fold(claim, path)`` equals ``root`` if it is the leaf.

    Ids are whole numbers, of any sign and density. Rows without an id come first in their
    group; rows that share an id are ordered by their leaf, wholly equal rows are
    interchangeable. A null group is a group of its own. Null fields count as such, empty ones
    as empty text. Only the named columns are read. An empty table gives no rows.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    if kind not in ("tinyint", "smallint", "int", "bigint"):
        raise ValueError(f"ids must be whole numbers, {id_col} is {kind}")
    names = docs.schema[group_col].dataType.simpleString()
    own = F.col(group_col).cast("string")
    group = F.when(F.col(group_col).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), own)).alias("g")
    key = F.col(id_col).cast("long").alias("key")
    hi = F.coalesce(F.shiftright("key", CONTAINER_BITS), F.lit(_NO_ID)).alias("hi")
    low = F.coalesce(F.col("key").bitwiseAND((1 << CONTAINER_BITS) - 1), F.lit(0)).alias("low")
    leaf = leaf_digest(*[F.col(c) for c in fields])
    rows = checkpointed(docs.select(group, key, leaf.alias("digest"), (leaf if claim is None else claim).alias("claim"))
                        .select("g", "key", "digest", F.nullif("claim", "digest").alias("claim")))

    containers = (rows.select("g", hi, low).mapInArrow(_pack, _CONTAINER)
                  .groupBy("g", "hi").applyInArrow(_merge, _CONTAINER))
    placed = running_sum(containers, ["hi"], ["g"], "total", "upto")
    placed = checkpointed(placed.withColumn("base", F.col("upto") - F.col("total")).drop("upto"))
    sizes = checkpointed(placed.groupBy("g").agg(F.sum("total").alias("n")))

    repeated = (placed.where(F.octet_length("extra") > 0).select("g", "hi", "card", "ids", "extra")
                .mapInArrow(_repeated_ids, "g string, key long"))
    by_range = placed.groupBy("g", "hi")

    def ranks(wanted: DataFrame, kept: str) -> DataFrame:
        return (wanted.select("*", hi, low).groupBy("g", "hi").cogroup(by_range)
                .applyInArrow(_rank, f"{kept}, at long"))
    if placed.where(F.octet_length("extra") > 0).limit(1).isEmpty():
        ranked = ranks(rows, "g string, key long, digest string, claim string")
    else:
        ids = checkpointed(ranks(repeated, "g string, key long"))
        ids = checked_broadcast(ids.select(F.col("g").alias("_g"), F.col("key").alias("_key"), "at"))
        same = (F.col("g") == F.col("_g")) & F.col("key").eqNullSafe(F.col("_key"))
        once = rows.join(ids, same, "left_anti")
        # of equal rows it does not matter which comes first, so the leaf makes the order total
        ties = row_number(rows.join(ids, same), ["digest", "claim"], ["g", "key"], "_tie")
        ranked = ranks(once, "g string, key long, digest string, claim string").unionByName(
            ties.select("g", "key", "digest", "claim", (F.col("at") + F.col("_tie") - 1).alias("at")))
    rounds, tops = _tree(ranked.join(checked_broadcast(sizes), "g"))

    # the groups' subroots are the leaves of one more tree
    tops = checkpointed(tops)
    groups = tops.count()
    roots = row_number(tops, ["g"], (), "_nr").select(
        F.lit("").alias("g"), F.lit(groups).cast("long").alias("n"), (F.col("_nr") - 1).alias("at"), "digest",
        F.lit(None).cast("long").alias("key"), F.col("g").alias("claim"))
    if not groups:
        return _empty(docs, id_col, group_col)
    root_rounds, root = _tree(roots)
    root = root.first()["digest"]
    last = docs.sparkSession.createDataFrame([("", [])], "g string, path array<string>")
    top_paths = checkpointed(_paths(root_rounds, last).select(
        F.col("claim").alias("g"), "path", F.col("digest").alias("subroot")))
    out = _paths(rounds, top_paths.select("g", "path")).join(checked_broadcast(top_paths.select("g", "subroot")), "g")
    return out.select(
        F.when(F.col("g") == "", F.lit(None)).otherwise(F.substr("g", F.lit(2))).cast(names).alias("group"),
        F.col("key").cast(kind).alias("id"), F.col("at").alias("position"), F.col("digest").alias("leaf"),
        F.coalesce("claim", "digest").alias("claim"), "path", "subroot", F.lit(root).alias("root"))


def _repeated_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        g, key = [], []
        for name, hi, extra in zip(*[batch.column(c).to_pylist() for c in ("g", "hi", "extra")]):
            for low in _extras(extra)[0].tolist():
                g.append(name)
                key.append(None if hi == _NO_ID else (hi << CONTAINER_BITS) + low)
        yield pa.RecordBatch.from_arrays([pa.array(g, pa.string()), pa.array(key, pa.int64())], ["g", "key"])


def _empty(docs: DataFrame, id_col: str, group_col: str) -> DataFrame:
    none = F.lit(None).cast("string")
    return docs.limit(0).select(
        F.col(group_col).alias("group"), F.col(id_col).alias("id"), F.lit(0).cast("long").alias("position"),
        none.alias("leaf"), none.alias("claim"), F.array(none).alias("path"), none.alias("subroot"), none.alias("root"))
