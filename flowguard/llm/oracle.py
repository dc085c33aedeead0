"""DuckDB SQL for the text queries that SQL can express, written from their contracts:
one window function over all word windows, one list of matches per kind."""

from __future__ import annotations

from flowguard.llm.common import WORD
from flowguard.llm.secret_scan import RULES


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


SUBSTRING_DEDUP = f"""WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_quoted(WORD)}) AS ws FROM documents),
starts AS (SELECT doc_id, unnest(range(1, len(ws) - 18)) AS i,
             unnest(list_transform(range(1, len(ws) - 18), lambda i: md5(array_to_string(ws[i:i + 19], ' ')))) AS k FROM w),
ranked AS (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS r FROM starts),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS j FROM ranked WHERE r > 1),
every AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS j FROM w),
kept AS (SELECT e.doc_id, COUNT(g.j) AS n_removed, string_agg(e.word, ' ' ORDER BY e.j) FILTER (WHERE g.j IS NULL) AS body
         FROM every e LEFT JOIN gone g ON g.doc_id = e.doc_id AND g.j = e.j GROUP BY e.doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(body, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)"""


def _spans(order: int, rule) -> str:
    """Spans of one kind: the text as (gap, match) pairs, ends by summing lengths."""
    cut = _quoted(rf"(?s)(.*?)(?:({rule.pattern})|\z)")
    # only texts with a match long enough are cut
    some = rule.pattern[:-1] + "{%d}" % rule.least if not rule.value and rule.pattern.endswith("+") and rule.least \
        else rule.pattern
    value = f"regexp_extract_all(t, {cut}, {2 + rule.value})"
    return f"""SELECT doc_id, {order} AS o, '{rule.kind}' AS kind, e - length(h) AS s, e FROM (
  SELECT doc_id, unnest(hits) AS h, unnest(vals) AS v,
         unnest(list_transform(range(1, len(hits) + 1), lambda i: list_sum(list_transform(gaps[:i], lambda x: length(x)))
                + list_sum(list_transform(hits[:i], lambda x: length(x))))) AS e
  FROM (SELECT doc_id, regexp_extract_all(t, {cut}, 1) AS gaps, regexp_extract_all(t, {cut}, 2) AS hits,
               {value} AS vals FROM d WHERE regexp_matches(t, {_quoted(some)})))
WHERE length(h) > 0 AND length(v) >= {rule.least}"""


_BASE = ", ".join(f"'{r.kind}'" for r in RULES if r.base)
SECRET_SCAN = f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
spans AS ({" UNION ALL ".join(_spans(i, r) for i, r in enumerate(RULES))}),
own AS (SELECT doc_id, COUNT(*) FILTER (WHERE kind = 'assign') AS a, COUNT(*) FILTER (WHERE kind = 'access') AS c,
          COUNT(*) FILTER (WHERE kind = 'hex') AS x,
          string_agg(kind || ':' || CAST(CAST(s AS BIGINT) AS VARCHAR) || ':' || CAST(CAST(e AS BIGINT) AS VARCHAR), ',' ORDER BY s, o)
            FILTER (WHERE kind IN ({_BASE})) AS base,
          string_agg(kind || ':' || CAST(CAST(s AS BIGINT) AS VARCHAR) || ':' || CAST(CAST(e AS BIGINT) AS VARCHAR), ',' ORDER BY s, o) AS every
        FROM spans GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(a, 0) AS BIGINT) AS n_assign, CAST(coalesce(c, 0) AS BIGINT) AS n_access,
       CAST(coalesce(x, 0) AS BIGINT) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(every, '') AS spans
FROM d LEFT JOIN own USING (doc_id)"""


def _levels(name: str, leaves: str, levels: int = 40) -> str:
    """All nodes of trees as one table (g, n, lv, i, h), a level a step, from leaves (g, i, h)."""
    parts = [f"{name}0 AS MATERIALIZED (SELECT g, count(*) OVER (PARTITION BY g) AS n, 0 AS lv, i, h FROM {leaves})"]
    for k in range(1, levels + 1):
        parts.append(f"""{name}{k} AS MATERIALIZED (SELECT g, (n + 1) // 2 AS n, {k} AS lv, i // 2 AS i, sha256(string_agg(h, '' ORDER BY i)) AS h
  FROM {name}{k - 1} WHERE n > 1 GROUP BY g, n, i // 2)""")
    return ",\n".join(parts) + f",\n{name} AS ({' UNION ALL '.join(f'SELECT * FROM {name}{k}' for k in range(levels + 1))})"


def _field(c: str) -> str:
    text = f"CAST({c} AS VARCHAR)"
    return f"coalesce(CAST(strlen({text}) AS VARCHAR) || ':' || {text}, '-')"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(_field(c) for c in ("doc_id", "source", "lang", n_chars, "text")) + ")"


def _crc32(text: str) -> str:
    """Unsigned CRC-32 of ASCII text: bit by bit, which is short enough for a decimal id."""
    bit = "CASE WHEN (a & 1) = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END"
    byte = "list_reduce([x, 1, 2, 3, 4, 5, 6, 7, 8], lambda a, b: " + bit + ")"
    one = byte.replace("[x,", "[xor(c, CAST(ascii(d) AS BIGINT)),")
    fold = f"list_reduce(list_prepend('4294967295', string_split({text}, '')), lambda c0, d: CAST((" \
           + one.replace("(c,", "(CAST(c0 AS BIGINT),") + ") AS VARCHAR))"
    return f"xor(CAST({fold} AS BIGINT), 4294967295)"


MERKLE_MANIFEST = f"""WITH RECURSIVE d AS (SELECT doc_id, lang, {_leaf("n_chars")} AS leaf,
  CASE WHEN {_crc32("CAST(doc_id AS VARCHAR)")} % 7 = 0 THEN {_leaf("n_chars + 1")} ELSE {_leaf("n_chars")} END AS claim FROM documents),
placed AS MATERIALIZED (SELECT doc_id, leaf AS h, claim, CASE WHEN lang IS NULL THEN '' ELSE '=' || lang END AS g,
  row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM d),
{_levels("t", "placed")},
tops AS MATERIALIZED (SELECT '' AS g, g AS member, h, row_number() OVER (ORDER BY encode(g)) - 1 AS i FROM t WHERE n = 1),
{_levels("r", "tops", 20)},
steps AS (SELECT p.g, p.i, t.lv, CASE WHEN t.i % 2 = 1 THEN 'R' ELSE 'L' END || t.h AS s FROM placed p
            JOIN t ON t.g = p.g AND t.n > 1 AND t.i = xor(p.i >> t.lv, 1)
          UNION ALL SELECT p.g, p.i, t.lv, '-' FROM placed p
            JOIN t ON t.g = p.g AND t.n > 1 AND t.i = p.i >> t.lv AND t.i % 2 = 0 AND t.i = t.n - 1),
up AS (SELECT m.member, r.lv, CASE WHEN r.i % 2 = 1 THEN 'R' ELSE 'L' END || r.h AS s FROM tops m
            JOIN r ON r.n > 1 AND r.i = xor(m.i >> r.lv, 1)
       UNION ALL SELECT m.member, r.lv, '-' FROM tops m
            JOIN r ON r.n > 1 AND r.i = m.i >> r.lv AND r.i % 2 = 0 AND r.i = r.n - 1),
own AS (SELECT g, i, list(s ORDER BY lv) AS s FROM steps GROUP BY g, i),
upper AS (SELECT member, list(s ORDER BY lv) AS s FROM up GROUP BY member),
whole AS (SELECT p.doc_id, p.h AS leaf, p.claim, tops.h AS subroot, (SELECT h FROM r WHERE n = 1) AS root,
            list_concat(coalesce(own.s, []), coalesce(upper.s, [])) AS path
          FROM placed p JOIN tops ON tops.member = p.g LEFT JOIN own ON own.g = p.g AND own.i = p.i
          LEFT JOIN upper ON upper.member = p.g),
folded AS (SELECT *, list_reduce(list_prepend(claim, path), lambda a, s: sha256(CASE WHEN s[1] = 'L' THEN s[2:] || a
            WHEN s[1] = 'R' THEN a || s[2:] ELSE a END)) AS folded_root FROM whole)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(path, lambda s: s[2:]), '')) AS proof_sha256,
       folded_root, folded_root = root AS verified FROM folded"""


def _discounts(source: str, count: str) -> str:
    """One row d1, d2, d3 of modified Kneser-Ney discounts of the counts in a table."""
    y = "(n1 / (n1 + 2.0 * n2))"
    found = [f"least(greatest({k} - {k + 1}.0 * {y} * n{k + 1} / n{k}, 0), {k})" for k in (1, 2, 3)]
    some = "n1 > 0 AND n2 > 0 AND n3 > 0 AND n4 > 0"
    cols = ", ".join(f"CASE WHEN {some} THEN {f} ELSE {0.5 * k} END AS d{k}" for k, f in enumerate(found, 1))
    counts = ", ".join(f"COUNT(*) FILTER (WHERE {count} = {k}) AS n{k}" for k in (1, 2, 3, 4))
    return f"SELECT {cols} FROM (SELECT {counts} FROM {source})"


def _less(n: str, d: str) -> str:
    return f"({n} - CASE WHEN {n} = 0 THEN 0 WHEN {n} = 1 THEN {d}.d1 WHEN {n} = 2 THEN {d}.d2 ELSE {d}.d3 END)"


# the end of a text is the token ' ', its start '': no words
LM_SCORING = f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_crc32("CAST(doc_id AS VARCHAR)")} % 5 = 1 AS held_out,
  list_append(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                 {_quoted(WORD)}), ' ') AS ws FROM documents),
t AS MATERIALIZED (SELECT r, held_out, unnest(list_prepend('', ws[:-2])) AS v, unnest(ws) AS w FROM d),
pairs AS MATERIALIZED (SELECT v, w, COUNT(*) AS n FROM t WHERE NOT held_out GROUP BY v, w),
words AS MATERIALIZED (SELECT w, CAST(SUM(n) AS BIGINT) AS c, COUNT(*) AS a FROM pairs GROUP BY w),
ctx AS MATERIALIZED (SELECT v, SUM(n) AS total, COUNT(*) FILTER (WHERE n = 1) AS n1, COUNT(*) FILTER (WHERE n = 2) AS n2,
  COUNT(*) FILTER (WHERE n > 2) AS n3 FROM pairs GROUP BY v),
up AS ({_discounts("pairs", "n")}), low AS ({_discounts("words", "a")}),
whole AS (SELECT CAST(SUM(c) AS BIGINT) AS tokens, COUNT(*) AS vocabulary, SUM(a) AS types,
  SUM(CASE WHEN a = 1 THEN low.d1 WHEN a = 2 THEN low.d2 ELSE low.d3 END) / SUM(a) / (COUNT(*) + 1) AS spare FROM words, low),
asked AS (SELECT DISTINCT v, w FROM t),
found AS (SELECT q.v, q.w, coalesce(c, 0) AS c, coalesce(a, 0) AS a, coalesce(n, 0) AS n, total, n1, n2, n3
  FROM asked q LEFT JOIN words USING (w) LEFT JOIN pairs p ON p.v = q.v AND p.w = q.w LEFT JOIN ctx ON ctx.v = q.v),
lower AS (SELECT found.*, {_less("a", "low")} / types + spare AS p1, log10((c + 0.5) / (tokens + 0.5 * (vocabulary + 1))) AS base
  FROM found, low, whole),
p AS (SELECT v, w, c, base, log10(CASE WHEN total IS NULL THEN p1
    ELSE {_less("n", "up")} / total + (up.d1 * n1 + up.d2 * n2 + up.d3 * n3) / total * p1 END) AS logp FROM lower, up),
sums AS (SELECT r, COUNT(*) AS n_tokens, COUNT(*) FILTER (WHERE c > 0) AS n_known, SUM(base) AS base_score, SUM(logp) AS score
  FROM t JOIN p USING (v, w) GROUP BY r)
SELECT doc_id, held_out, n_tokens, n_known, tokens AS train_tokens, base_score, score FROM d JOIN sums USING (r), whole"""


# The cheapest edits turn by turn: way holds, for each state of (s?(ua)+)? behind turn i, the
# least (cost, audit) as one string and the lines it leaves. States 0 start, 1 s, 2 u, 3 a.
_INSERTS = ", ".join(f"({s}, {k}, {t}, {lines})" for s, ways in {
    0: [(0, []), (2, ["user:"]), (3, ["user:", "assistant:"]), (2, ["user:", "assistant:", "user:"])],
    1: [(1, []), (2, ["user:"]), (3, ["user:", "assistant:"]), (2, ["user:", "assistant:", "user:"])],
    2: [(2, []), (3, ["assistant:"]), (2, ["assistant:", "user:"]), (3, ["assistant:", "user:", "assistant:"])],
    3: [(3, []), (2, ["user:"]), (3, ["user:", "assistant:"]), (2, ["user:", "assistant:", "user:"])],
}.items() for k, (t, lines) in enumerate(ways))
CONVERSATION_REPAIR = f"""WITH RECURSIVE raw AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  {_crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS k FROM conversations),
damaged AS (SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN k = 1 THEN '' WHEN k = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(CASE WHEN k = 3 THEN [1, 2] ELSE [1] END) AS copy FROM raw WHERE k <> 0),
placed AS (SELECT *, coalesce(CAST(conv_id AS VARCHAR), '') AS c, row_number() OVER w AS i, row_number() OVER same AS nth,
    lag(role) OVER w AS before FROM damaged
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, encode(role), encode(text), copy),
         same AS (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy)),
r AS MATERIALIZED (SELECT *, left(role, 1) AS x, CASE WHEN NOT regexp_matches(text, {_quoted(WORD)}) THEN 'blank' WHEN nth > 1 THEN 'duplicate'
    WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') THEN 'truncated' ELSE '' END AS fault FROM placed),
ins AS MATERIALIZED (SELECT * FROM (VALUES {_INSERTS}) v(s, k, t, lines)),
edges AS MATERIALIZED (SELECT * FROM (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)) v(s, x, t)),
way(c, i, s, best, lines) AS (
  SELECT DISTINCT c, CAST(0 AS BIGINT), 0, '000000000', CAST([] AS VARCHAR[]) FROM r
  UNION ALL
  SELECT c, i, s, min(best), arg_min(lines, best) FROM (
    SELECT way.c, r.i AS i, e.t AS s,
        lpad(CAST(CAST(left(best, 9) AS INTEGER) + 3 * k + e.cost AS VARCHAR), 9, '0') || best[10:] || repeat('I', k) || e.edit AS best,
        list_concat(list_concat(way.lines, ins.lines), e.lines) AS lines
    FROM way JOIN r ON r.c = way.c AND r.i = way.i + 1 JOIN ins ON ins.s = way.s,
      LATERAL (
        SELECT 'D' AS edit, 4 AS cost, ins.t AS t, CAST([] AS VARCHAR[]) AS lines
        UNION ALL SELECT 'K', CASE WHEN r.fault = 'truncated' THEN 3 ELSE 0 END, edges.t, [r.role || ':' || r.text] FROM edges
          WHERE edges.s = ins.t AND edges.x = r.x AND r.fault IN ('', 'truncated')
        UNION ALL SELECT 'R', CASE WHEN r.fault = 'truncated' THEN 6 ELSE 3 END, CASE WHEN ins.t = 2 THEN 3 ELSE 2 END,
          [CASE WHEN ins.t = 2 THEN 'assistant:' ELSE 'user:' END || r.text] WHERE r.fault IN ('', 'truncated')) e)
  GROUP BY c, i, s),
last AS (SELECT c, MAX(i) AS i FROM r GROUP BY c),
whole AS (SELECT way.c, min(full_best) AS best, arg_min(full_lines, full_best) AS lines FROM (
    SELECT way.c, way.i, lpad(CAST(CAST(left(best, 9) AS INTEGER) + 3 * k AS VARCHAR), 9, '0') || best[10:] || repeat('I', k) AS full_best,
           list_concat(way.lines, ins.lines) AS full_lines FROM way JOIN ins ON ins.s = way.s AND ins.t IN (0, 3)) way
  JOIN last ON last.c = way.c AND last.i = way.i GROUP BY way.c),
nums AS (SELECT c, coalesce(MAX(turn) - MIN(turn) + 1 - COUNT(DISTINCT turn), 0) AS gaps, COUNT(*) FILTER (WHERE fault = 'blank') AS blank,
    COUNT(*) FILTER (WHERE fault = 'duplicate') AS duplicate, COUNT(*) FILTER (WHERE fault = 'truncated') AS truncated,
    COUNT(*) FILTER (WHERE i > 1 AND left(before, 1) || x NOT IN ('su', 'ua', 'au')) AS illegal FROM r GROUP BY c)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       coalesce(CAST(left(best, 9) AS BIGINT), 0) AS cost, coalesce(best[10:], '') AS audit,
       sha256(coalesce(array_to_string(lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN whole ON whole.c = coalesce(CAST(o.conv_id AS VARCHAR), '') LEFT JOIN nums ON nums.c = coalesce(CAST(o.conv_id AS VARCHAR), '')"""
