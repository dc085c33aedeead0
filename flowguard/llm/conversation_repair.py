"""Repair of conversations: the cheapest edits to a legal sequence of roles.

A conversation is legal if the initials of its roles read ``(s?(ua)+)?``. Its edit lattice has
a node for every (turns consumed, state of that pattern); edges keep, rerole or delete the next
turn or insert an empty one. Two Dijkstra searches run at once, one from the start and one, with
the edges turned round, from the ends; when the least costs of both heaps together exceed the
best crossing, every crossing of that cost is finished and the one with the least
concatenated audit is taken.

The audit names an edit's kind only, but state and turn tell the rest, so an audit is one
path; and of the audits that lead to one node none begins with another. So the least audit
through a node is the least one before it and the least one after it.

Conversations of up to ``LONG`` turns are groups of one task's work. A longer one is numbered
by distributed prefix sums and cut to blocks; a block gives, for each state it may be
entered in, cost and order of its least audits to each state it may be left in (an edit that
inserts belongs to the block of the next turn). These tables are combined over the blocks,
and each block then traces its own part.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowguard.llm.common import WORD, checked_broadcast
from flowguard.plans.prefix import row_number
from flowguard.session import checkpointed

#: Turns of a conversation that one task takes whole, and of a block of a longer one.
LONG = 2000
KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 3, 4, 3, 3
FAULTS = ("blank", "duplicate", "truncated")

#: States of ``(s?(ua)+)?``: start, after s, after u, after a; the move on each initial.
_MOVES = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
#: The role that an edit which writes one writes in each state.
_WRITES = {0: "u", 1: "u", 2: "a", 3: "u"}
_ENDS = (0, 3)
_ROLES = {"u": "user", "a": "assistant"}


def damage(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id``, ``turn``, ``role``, ``text`` of the rows with seeded faults: by the CRC-32 of
    ``conv_id:turn`` modulo 20 a row is dropped (0), its text emptied (1) or left without
    ``.!?`` (2), repeated (3), or given the role user (4). Nulls read as one space."""
    def known(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))
    dice = F.crc32(F.concat(known(conv), F.lit(":"), known(turn)).cast("binary")) % 20
    out = rows.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), known(role).alias("role"),
                      known(text).alias("text"), dice.alias("_dice")).where(F.col("_dice") != 0)
    return out.select(
        "conv_id", "turn", F.when(F.col("_dice") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("_dice") == 1, "").when(F.col("_dice") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("_dice") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("_copy")).drop("_copy")


def _edits(initial: str, fault: str | None, state: int) -> list[tuple[str, int, int]]:
    """(edit, cost, next state) of the edits of one turn in one state."""
    out = [("D", DELETE, state)]
    if fault not in ("blank", "duplicate"):
        more = CUT_OFF if fault == "truncated" else 0
        to = _MOVES.get((state, initial))
        if to is not None:
            out.append(("K", KEEP + more, to))
        out.append(("R", REROLE + more, _MOVES[state, _WRITES[state]]))
    return out


def _insert(state: int) -> int:
    return _MOVES[state, _WRITES[state]]


class _Search:
    """One of the two searches: nodes (turn, state) by cost, then by turns consumed, so that
    all edges of cost 0 into a node come from nodes settled before it."""

    def __init__(self, starts: list[tuple[int, int]], step: int):
        self.best = {node: (0, "") for node in starts}
        self.done: dict[tuple[int, int], tuple[int, str]] = {}      # cost and least audit
        self.step = step
        self.heap = [(0, step * i, "", i, s) for i, s in starts]
        heapq.heapify(self.heap)

    def least(self) -> float:
        while self.heap and (self.heap[0][3], self.heap[0][4]) in self.done:
            heapq.heappop(self.heap)
        return self.heap[0][0] if self.heap else float("inf")

    def settle(self) -> tuple[tuple[int, int], int, str]:
        cost, _, audit, i, s = heapq.heappop(self.heap)
        self.done[i, s] = (cost, audit)
        return (i, s), cost, audit

    def offer(self, node: tuple[int, int], cost: int, audit: str) -> None:
        if node not in self.done and (node not in self.best or (cost, audit) < self.best[node]):
            self.best[node] = (cost, audit)
            heapq.heappush(self.heap, (cost, self.step * node[0], audit, *node))


def _into(i: int, s: int, initials, faults) -> Iterator[tuple[str, int, tuple[int, int]]]:
    """Edges into a node, turned round."""
    for r in range(4):
        if _insert(r) == s:
            yield "I", INSERT, (i, r)
        if i:
            for edit, cost, to in _edits(initials[i - 1], faults[i - 1], r):
                if to == s:
                    yield edit, cost, (i - 1, r)


def _out_of(i: int, s: int, initials, faults) -> Iterator[tuple[str, int, tuple[int, int]]]:
    """Edges out of a node."""
    if i < len(initials):
        for edit, cost, to in _edits(initials[i], faults[i], s):
            yield edit, cost, (i + 1, to)
    yield "I", INSERT, (i, _insert(s))


@lru_cache(maxsize=1 << 14)
def repair(initials: tuple[str, ...], faults: tuple[str | None, ...]) -> tuple[int, str]:
    """Least cost and, of the edits of that cost, the least audit of one conversation.

    When the heaps' least costs together exceed the best crossing, take any path of that cost
    and its last node nearer to the start than the forward heap: it is settled, and the next
    one is settled from the end. So every such path has been seen at an edge, or at a node
    settled twice.
    """
    n = len(initials)
    ahead, back = _Search([(0, 0)], 1), _Search([(n, s) for s in _ENDS], -1)
    found: tuple[int, str] | None = None

    def crossing(cost: int, audit: str) -> None:
        nonlocal found
        if found is None or (cost, audit) < found:
            found = cost, audit

    def settle(forward: bool) -> None:
        side, other = (ahead, back) if forward else (back, ahead)
        node, cost, audit = side.settle()
        if node in other.done:
            rest = other.done[node]
            crossing(cost + rest[0], audit + rest[1] if forward else rest[1] + audit)
        for edit, more, to in (_out_of if forward else _into)(*node, initials, faults):
            if to in other.done:
                rest = other.done[to]
                crossing(cost + more + rest[0], audit + edit + rest[1] if forward else rest[1] + edit + audit)
            side.offer(to, cost + more, audit + edit if forward else edit + audit)

    settle(True)
    for _ in _ENDS:
        settle(False)
    while True:
        a, b = ahead.least(), back.least()
        if found is not None and a + b > found[0]:
            return found
        settle(a <= b)


def trace(audit: str, initials: list[str], state: int = 0) -> list[tuple[str, int | None, str | None]]:
    """The edits of an audit: kind, the turn it consumes (None: inserts), the role initial
    it writes (None: keeps or deletes)."""
    out, i = [], 0
    for edit in audit:
        if edit == "I":
            out.append((edit, None, _WRITES[state]))
            state = _insert(state)
            continue
        writes = _WRITES[state] if edit == "R" else None
        out.append((edit, i, writes))
        if edit != "D":
            state = _MOVES[state, writes or initials[i]]
        i += 1
    return out


# Blocks of a long conversation ------------------------------------------------------------------

def block_paths(initials, faults, state: int) -> dict[int, tuple[int, str]]:
    """From one entry state: cost and least audit to each state a block may be left in; the
    last edit consumes the block's last turn."""
    now = {state: (0, "")}
    for initial, fault in zip(initials, faults):
        after: dict[int, tuple[int, str]] = {}
        for s, (cost, audit) in now.items():
            for k in range(4):          # up to three inserted turns lead to every state they can
                for edit, more, to in _edits(initial, fault, s):
                    offer = (cost + more, audit + edit)
                    if to not in after or offer < after[to]:
                        after[to] = offer
                s, cost, audit = _insert(s), cost + INSERT, audit + "I"
        now = after
    return now


def block_table(initials, faults) -> tuple[list[int], list[int]]:
    """Costs and ranks of the audits by (entry, exit), 16 each; -1 where there is no way."""
    costs, ranks = [-1] * 16, [-1] * 16
    for e in range(4):
        ways = block_paths(initials, faults, e)
        for rank, (audit, m) in enumerate(sorted((audit, m) for m, (_, audit) in ways.items())):
            costs[4 * e + m], ranks[4 * e + m] = ways[m][0], rank
    return costs, ranks


def _to_end(state: int) -> int:
    """Turns to insert behind the last one."""
    n = 0
    while state not in _ENDS:
        state, n = _insert(state), n + 1
    return n


def choose(tables: list[tuple[list[int], list[int]]]) -> list[tuple[int, int]]:
    """The (entry, exit) of every block on the cheapest way with the least audit: audits that
    differ do so in the first block with another exit."""
    far = float("inf")
    togo = [[INSERT * _to_end(s) for s in range(4)]]
    for costs, _ in reversed(tables):
        togo.append([min([costs[4 * e + m] + togo[-1][m] for m in range(4) if costs[4 * e + m] >= 0], default=far)
                     for e in range(4)])
    togo.reverse()
    out, e = [], 0
    for k, (costs, ranks) in enumerate(tables):
        _, m = min((ranks[4 * e + m], m) for m in range(4)
                   if costs[4 * e + m] >= 0 and costs[4 * e + m] + togo[k + 1][m] == togo[k][e])
        out.append((e, m))
        e = m
    return out


# Rows ------------------------------------------------------------------------------------------

TURNS = ("_key string, position long, edit string, cost int, fault string, illegal boolean, new_turn boolean, "
         "turn long, role string, text string")
_NAMES = [c.split()[0] for c in TURNS.split(", ")]
_TYPES = [pa.string(), pa.int64(), pa.string(), pa.int32(), pa.string(), pa.bool_(), pa.bool_(), pa.int64(), pa.string(), pa.string()]
_LEGAL = {"su", "ua", "au"}
_COSTS = {"K": KEEP, "R": REROLE, "D": DELETE, "I": INSERT}


def _turn_rows(key: str, rows: list[tuple], faults: list[str | None], audit: str, state: int = 0, start: int = 0,
               before: tuple | None = None) -> list[tuple]:
    """Rows of the result for consecutive turns (turn, role, text); ``before`` is the one ahead of them."""
    out = []
    initials = [r[1][:1] for r in rows]
    for n, (edit, i, writes) in enumerate(trace(audit, initials, state)):
        if i is None:
            out.append((key, start + n, edit, INSERT, None, False, False, None, _ROLES[writes], ""))
            continue
        turn, role, text = rows[i]
        last = rows[i - 1] if i else before
        cost = _COSTS[edit] + (CUT_OFF if faults[i] == "truncated" and edit != "D" else 0)
        out.append((key, start + n, edit, cost, faults[i], last is not None and last[1][:1] + initials[i] not in _LEGAL,
                    turn is not None and (last is None or last[0] != turn), turn, _ROLES[writes] if writes else role, text))
    return out


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [()] * len(_NAMES)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _TYPES)], _NAMES)


def _short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole conversations, one after another, in the order of their turns."""
    out: list[tuple] = []
    key, rows, plain = None, [], []

    def done() -> None:
        seen, faults = set(), []
        for (_, role, text), fault in zip(rows, plain):
            if fault != "blank" and (role, text) in seen:
                fault = "duplicate"
            seen.add((role, text))
            faults.append(fault)
        _, audit = repair(tuple(r[1][:1] for r in rows), tuple(faults))
        out.extend(_turn_rows(key, rows, faults, audit))

    for batch in batches:
        for k, *row, fault in zip(*[batch.column(c).to_pylist() for c in ("_key", "turn", "role", "text", "fault")]):
            if rows and k != key:
                done()
                rows, plain = [], []
            key = k
            rows.append(tuple(row))
            plain.append(fault)
        if len(out) > 4096:
            yield _batch(out)
            out.clear()
    if rows:
        done()
    yield _batch(out)


_TABLE = "_key string, block long, costs array<long>, ranks array<long>, turn long, role string"
_CHOICE = "_key string, block long, entry int, exit int, last boolean, turn long, role string, ahead boolean"


def _in_order(rows: pa.Table) -> tuple[list[tuple], list[str | None]]:
    rows = rows.sort_by("at")
    return (list(zip(*[rows.column(c).to_pylist() for c in ("turn", "role", "text")])), rows.column("fault").to_pylist())


def _block(rows: pa.Table) -> pa.Table:
    turns, faults = _in_order(rows)
    costs, ranks = block_table([t[1][:1] for t in turns], faults)
    return pa.table({"_key": rows.column("_key").slice(0, 1), "block": rows.column("block").slice(0, 1),
                     "costs": pa.array([costs], pa.list_(pa.int64())), "ranks": pa.array([ranks], pa.list_(pa.int64())),
                     "turn": pa.array([turns[-1][0]], pa.int64()), "role": pa.array([turns[-1][1]], pa.string())})


def _choose(rows: pa.Table) -> pa.Table:
    """One row a block of one conversation: the states on its way, and the turn ahead of it."""
    rows = rows.sort_by("block")
    ways = choose(list(zip(rows.column("costs").to_pylist(), rows.column("ranks").to_pylist())))
    n = rows.num_rows
    turn, role = rows.column("turn").to_pylist(), rows.column("role").to_pylist()
    return pa.table({"_key": rows.column("_key"), "block": rows.column("block"),
                     "entry": pa.array([e for e, _ in ways], pa.int32()), "exit": pa.array([m for _, m in ways], pa.int32()),
                     "last": pa.array([i == n - 1 for i in range(n)]), "turn": pa.array([None, *turn[:-1]], pa.int64()),
                     "role": pa.array([None, *role[:-1]], pa.string()), "ahead": pa.array([i > 0 for i in range(n)])})


def _traced(rows: pa.Table, choice: pa.Table) -> pa.Table:
    if not rows.num_rows:
        return pa.Table.from_batches([_batch([])])
    way = choice.to_pylist()[0]
    turns, faults = _in_order(rows)
    audit = block_paths([t[1][:1] for t in turns], faults, way["entry"])[way["exit"]][1]
    if way["last"]:
        audit += "I" * _to_end(way["exit"])
    before = (way["turn"], way["role"]) if way["ahead"] else None
    return pa.Table.from_batches([_batch(_turn_rows(way["_key"], turns, faults, audit, way["entry"],
                                                    way["block"] * 4 * (LONG + 1), before))])


def _fault(text: Column) -> Column:
    """Blank or truncated, by the text alone."""
    return F.when(~text.rlike(WORD), "blank").when(~text.rlike(r"[.!?][\x20\x09-\x0D]*\z"), "truncated")


def _long(rows: DataFrame, size: int) -> DataFrame:
    """Conversations that no task takes whole."""
    placed = row_number(rows, ["turn", "role", "text"], ["_key"], "at")
    placed = checkpointed(placed.withColumn("_text", F.sha2(F.col("text").cast("binary"), 256)))
    first = placed.groupBy("_key", "role", "_text").agg(F.min("at").alias("first"))
    marked = placed.join(first, ["_key", "role", "_text"]).select(
        "_key", ((F.col("at") - 1) / size).cast("long").alias("block"), "at", "turn", "role", "text",
        F.when((F.col("at") > F.col("first")) & ~F.col("fault").eqNullSafe("blank"), "duplicate")
        .otherwise(F.col("fault")).alias("fault"))
    marked = checkpointed(marked)
    blocks = marked.groupBy("_key", "block")
    ways = blocks.applyInArrow(_block, _TABLE).groupBy("_key").applyInArrow(_choose, _CHOICE)
    return blocks.cogroup(ways.groupBy("_key", "block")).applyInArrow(_traced, TURNS)


def repair_conversations(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                         text: str = "text", long: int = LONG) -> DataFrame:
    """The turns of every conversation with their edits, and the inserted ones: ``conv_id``,
    ``position`` (ascends along the edits), ``edit`` (K, R, D, I), ``cost``, ``fault``
    (blank, duplicate, truncated, null), ``illegal`` (its role cannot follow the one
    before it), ``new_turn`` (first of its turn number), ``turn``, ``role`` and ``text`` after
    the edit (those of a deleted turn as they were).

    Turns are taken by number (nulls first), then role, then text. Null roles and texts
    read as one space. A null conversation id is a conversation. Deleting is the only edit of a blank or
    duplicate turn; a truncated one that stays costs more. Only the named columns are read; an
    empty table gives no rows. Conversations of more than ``long`` turns (at most LONG) are
    split to blocks of that size; one row a block is combined by conversation.
    """
    size = min(long, LONG)
    key = F.when(F.col(conv).isNull(), "").otherwise(F.concat(F.lit("="), F.col(conv).cast("string")))
    body = F.coalesce(F.col(text).cast("string"), F.lit(" "))
    src = rows.select(key.alias("_key"), F.col(turn).cast("long").alias("turn"),
                      F.coalesce(F.col(role).cast("string"), F.lit(" ")).alias("role"), body.alias("text"))
    src = src.withColumn("fault", _fault(F.col("text")))
    many = checkpointed(src.groupBy("_key").count().where(F.col("count") > size).select("_key"))
    some = not many.limit(1).isEmpty()
    few = src.join(checked_broadcast(many), "_key", "left_anti") if some else src
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    out = few.repartition(n, "_key").sortWithinPartitions("_key", "turn", "role", "text").mapInArrow(_short, TURNS)
    if some:
        out = out.unionByName(_long(src.join(checked_broadcast(many), "_key"), size))
    kind = rows.schema[conv].dataType.simpleString()
    back = F.when(F.col("_key") == "", F.lit(None)).otherwise(F.substr("_key", F.lit(2))).cast(kind)
    return out.select(back.alias("conv_id"), *_NAMES[1:])


def summarise(turns: DataFrame) -> DataFrame:
    """One row a conversation that has turns: ``conv_id``, ``gaps`` in the turn numbers, numbers of
    faults and of illegal pairs, ``cost``, ``audit`` (edits in order) and ``repaired`` (the
    turns that are left as ``role:text`` lines).

    The last two are one value a conversation, so it has to fit in one; ``turns`` itself is not bound so.
    """
    def number(c: Column) -> Column:
        return F.coalesce(F.count_if(c), F.lit(0)).cast("long")
    line = F.when(F.col("edit") != "D", F.concat("role", F.lit(":"), "text"))
    grouped = turns.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_if("new_turn"), F.lit(0)).cast("long").alias("gaps"),
        *[number(F.col("fault") == f).alias(f) for f in FAULTS], number(F.col("illegal")).alias("illegal"),
        F.sum("cost").cast("long").alias("cost"),
        F.sort_array(F.collect_list(F.struct("position", "edit", line.alias("line")))).alias("_all"))
    return grouped.select(
        "conv_id", "gaps", *FAULTS, "illegal", "cost", F.array_join("_all.edit", "").alias("audit"),
        F.array_join("_all.line", "\n").alias("repaired"))
