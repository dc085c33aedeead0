"""Secret scan with a trigram inverted index, in DataFrame functions only.

1. From each rule's regular expression a Boolean trigram query is derived: strings
   the expression must contain give AND, alternatives give OR; an expression
   without a mandatory trigram has the query True.
2. The index holds, for every trigram that some query names, the postings of the
   texts (by text hash) that contain it, in blocks of a bounded number of texts,
   so that no list grows with the corpus. Case is folded.
3. Each query intersects and unites postings block by block. Its texts are the
   rule's candidates; rules with the query True take every text.
4. Candidates are verified with the expression itself.
"""

from __future__ import annotations

import re._constants as rc
import re._parser as rp
from functools import reduce
from itertools import product
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_TEXTS = 10_000
_MOST_STRINGS = 64


class Rule(NamedTuple):
    """``pattern`` in the syntax common to Java and Python; a match counts if its
    group ``value`` (0: all of it) has at least ``least`` characters."""
    kind: str
    pattern: str
    value: int = 0
    least: int = 0
    base: bool = False


#: Base kinds first, in the order that breaks ties; then the kinds beyond them.
RULES = [
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18, True),
    Rule("hex", r"[0-9a-f]+", 0, 16, True),
    Rule("private_key", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,255}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,255}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{16,255}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("url_login", r"[a-z]{2,10}://[A-Za-z0-9._-]{1,64}:[^\x20-\x20\x09-\x0D/@:]{3,128}@[A-Za-z0-9.-]+"),
]


# ------------------------------------------------------------- trigram queries
# A query is True, a trigram, or ("and" | "or", [queries]).

def _join(op: str, parts: list):
    flat = []
    for p in parts:
        if p is True:
            if op == "or":
                return True
        elif isinstance(p, tuple) and p[0] == op:
            flat += p[1]
        else:
            flat.append(p)
    flat = sorted(set(map(_freeze, flat)), key=repr)
    return True if not flat else flat[0] if len(flat) == 1 else (op, tuple(flat))


def _freeze(q):
    return (q[0], tuple(q[1])) if isinstance(q, tuple) else q


def _of_strings(strings: set[str]):
    return _join("or", [_join("and", [s[i:i + 3] for i in range(len(s) - 2)]) if len(s) > 2 else True
                        for s in strings])


def _class(items) -> set[str] | None:
    out: set[str] = set()
    for op, arg in items:
        if op is rc.LITERAL:
            out.add(chr(arg).lower())
        elif op is rc.RANGE and arg[1] - arg[0] < 8:
            out |= {chr(c).lower() for c in range(arg[0], arg[1] + 1)}
        else:
            return None
    return out if len(out) <= 8 else None


def _walk(seq) -> tuple[set[str] | None, object]:
    """The strings a sequence can match, folded (None: too many), and its query."""
    now, whole, parts = {""}, True, []
    for op, arg in seq:
        exact, query = None, True
        if op is rc.LITERAL:
            exact = {chr(arg).lower()}
        elif op is rc.IN:
            exact = _class(arg)
        elif op is rc.SUBPATTERN:
            exact, query = _walk(arg[3])
        elif op is rc.BRANCH:
            ways = [_walk(way) for way in arg[1]]
            if all(e is not None for e, _ in ways) and sum(len(e) for e, _ in ways) <= _MOST_STRINGS:
                exact = set().union(*[e for e, _ in ways])
            else:
                query = _join("or", [_of_strings(e) if e is not None else q for e, q in ways])
        elif op in (rc.MAX_REPEAT, rc.MIN_REPEAT):
            low, high, item = arg
            e, q = _walk(item)
            if e is not None and high is not rc.MAXREPEAT and len(e) ** high <= 8:
                exact = {"".join(x) for n in range(low, high + 1) for x in product(e, repeat=n)}
            elif low:
                query = _of_strings({"".join(x) for x in product(e, repeat=low)}) if (
                    e is not None and len(e) ** low <= 8) else q
        if exact is not None and len(now) * len(exact) <= _MOST_STRINGS:
            now = {a + b for a in now for b in exact}
        else:
            parts.append(_of_strings(now))
            if exact is not None:
                now = set(exact)
            else:
                parts.append(query)
                now = {""}
            whole = False
    if whole:
        return now, _of_strings(now)
    return None, _join("and", [*parts, _of_strings(now)])


def trigram_query(pattern: str):
    """The Boolean trigram query that every text with a match of ``pattern``
    satisfies (case folded); True if no trigram is mandatory."""
    return _freeze(_walk(rp.parse(pattern))[1])


def _grams(query) -> set[str]:
    if query is True:
        return set()
    return {query} if isinstance(query, str) else set().union(*map(_grams, query[1]))


def _postings(query, index: Column) -> Column:
    if isinstance(query, str):
        return F.coalesce(F.element_at(index, query), F.array().cast("array<bigint>"))
    return reduce(F.array_intersect if query[0] == "and" else F.array_union,
                  [_postings(q, index) for q in query[1]])


def trigram_index(texts: DataFrame, grams: list[str], blocks: int) -> DataFrame:
    """``block``, ``postings`` (trigram -> text keys) of ``texts`` (key, text)."""
    low = texts.select("key", F.lower("text").alias("low"))
    present = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(g)), F.lit(g)) for g in grams]))
    # explode_outer: explode would filter on the array first and compute it twice
    return (low.select("key", F.explode_outer(present).alias("gram")).where(F.col("gram").isNotNull())
            .groupBy("gram", F.pmod("key", F.lit(blocks)).alias("block"))
            .agg(F.collect_set("key").alias("keys"))
            .groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("gram", "keys"))).alias("postings")))


def candidates(texts: DataFrame, rules: list[Rule], block_texts: int = BLOCK_TEXTS) -> DataFrame:
    """``key``, ``rules`` (bit i: rule i's query holds) for the texts (key, text)
    that satisfy the query of some rule that has one."""
    queries = {i: q for i, r in enumerate(rules) if (q := trigram_query(r.pattern)) is not True}
    grams = sorted(set().union(*map(_grams, queries.values()))) if queries else []
    if not grams:
        return texts.select("key", F.lit(0).cast("long").alias("rules")).limit(0)
    blocks = max(64, -(-texts.count() // block_texts))
    index = trigram_index(texts, grams, blocks)
    found = F.array(*[F.struct(_postings(q, F.col("postings")).alias("keys"), F.lit(1 << i).cast("long").alias("bit"))
                      for i, q in queries.items()])
    return (index.select(F.inline(found)).select(F.explode("keys").alias("key"), "bit")
            .groupBy("key").agg(F.bit_or("bit").alias("rules")))


# ----------------------------------------------------------------- verification

def _running(lengths: Column, width: int = 256) -> Column:
    """Running totals of an array: in slices, so the work stays near linear."""
    def totals(part: Column) -> Column:
        return F.aggregate(part, F.array().cast("array<bigint>"), lambda acc, x: F.concat(
            acc, F.array(x + F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0).cast("long")))))
    slices = F.transform(F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / width).cast("int")),
                         lambda b: totals(F.slice(lengths, b * width + 1, width)))
    placed = F.aggregate(slices, F.struct(F.lit(0).cast("long").alias("at"),
                                          F.array().cast("array<array<bigint>>").alias("out")),
                         lambda acc, s: F.struct(
                             (acc["at"] + F.element_at(s, -1)).alias("at"),
                             F.concat(acc["out"], F.array(F.transform(s, lambda x: x + acc["at"]))).alias("out")))
    return F.when(F.size(lengths) > 0, F.flatten(placed["out"])).otherwise(F.array().cast("array<bigint>"))


def find_spans(text: Column, rule: Rule, order: int) -> Column:
    """Array of struct(start, order, end, kind, base) of a rule's matches, leftmost
    and non-overlapping, in code points. The text is cut into (gap, match) pairs by
    one expression that also takes the rest of the text as a last gap, so it is
    read once from left to right."""
    cut = F.lit(rf"(?s)(.*?)(?:({rule.pattern})|\z)")
    gaps = F.regexp_extract_all(text, cut, F.lit(1))
    hits = F.regexp_extract_all(text, cut, F.lit(2))
    values = F.regexp_extract_all(text, cut, F.lit(2 + rule.value)) if rule.value else hits
    sized = F.zip_with(gaps, hits, lambda g, h: (F.length(g) + F.length(h)).cast("long"))
    ends = _running(sized)
    found = F.zip_with(F.arrays_zip(hits.alias("hit"), values.alias("value")), ends, lambda m, e: F.struct(
        (e - F.length(m["hit"])).alias("start"), F.lit(order).alias("order"), e.alias("end"),
        F.lit(rule.kind).alias("kind"), F.lit(rule.base).alias("base"), F.length(m["value"]).alias("size"),
        F.length(m["hit"]).alias("n")))
    return F.filter(found, lambda s: (s["n"] > 0) & (s["size"] >= rule.least))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 rules: list[Rule] | None = None, keep: list[str] | None = None,
                 out: str = "found") -> DataFrame:
    """One row per row of ``docs``: the id as ``doc_id``, ``text``, the columns named in
    ``keep`` and, as ``out``, all spans as struct(start, order, end, kind, base, ..)
    by start, then rule order. Positions are code points, ends exclusive.

    Null text counts as empty and has no spans; rows may repeat and ids may be null,
    since texts are matched by their hash and verified on themselves. Only the named
    columns are read. An empty table gives no rows.
    """
    rules = RULES if rules is None else rules
    kept = keep or []
    body = F.coalesce("text", F.lit(""))
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                      *[F.col(c).alias(f"_k{i}") for i, c in enumerate(kept)]).withColumn("key", F.xxhash64(body))
    cand = candidates(src.select("key", body.alias("text")), rules)
    marked = src.join(cand, "key", "left")
    spans = []
    for i, rule in enumerate(rules):
        found = find_spans(body, rule, i)
        if trigram_query(rule.pattern) is not True:
            asked = F.coalesce("rules", F.lit(0).cast("long")).bitwiseAND(F.lit(1 << i)) != 0
        else:
            # a full scan; texts without any match long enough skip the cutting
            asked = body.rlike(rule.pattern)
            if rule.value == 0 and rule.pattern.endswith("+"):
                asked = body.rlike(rule.pattern[:-1] + "{%d}" % max(1, rule.least))
        spans.append(F.when(asked, found))
    some = F.array_compact(F.array(*spans))
    return marked.select("doc_id", "text", *[F.col(f"_k{i}").alias(c) for i, c in enumerate(kept)],
                         F.array_sort(F.flatten(some)).alias(out))


def redact(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """``text`` with ``mark`` in place of every stretch that its spans (by start) cover."""
    cut = F.aggregate(
        spans, F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out")),
        lambda acc, s: F.when(s["start"] >= acc["at"], F.struct(
            s["end"].alias("at"), F.concat(acc["out"], F.array(F.substring(
                text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")), F.lit(mark))).alias("out")))
        .otherwise(F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out"))))
    whole = F.transform(F.array(cut), lambda c: F.concat(
        F.array_join(c["out"], ""), F.substring(text, (c["at"] + 1).cast("int"), F.length(text))))
    return F.when(F.size(spans) > 0, F.get(whole, 0)).otherwise(text)


def joined(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
