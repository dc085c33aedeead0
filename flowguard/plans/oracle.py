"""DuckDB SQL for the named queries: plain windows and joins on the same parquet
tables, written independently of the Spark plans; the two must agree after
rounding floats to 6 places."""

from __future__ import annotations

from flowguard.functions.stats import EXACT_ROWS
from flowguard.plans.standins import (CLEAN_SQL, DIRTY_SQL, FLOWS_SQL, REFERENCE_DAYS,
                                      RULE_SQL)

ORACLE: dict[str, str] = {}


def ks_pvalue_sql(d: str, n: str, m: str) -> str:
    lam = f"({d} * sqrt(CAST({n} AS DOUBLE) * CAST({m} AS DOUBLE) / (CAST({n} AS DOUBLE) + CAST({m} AS DOUBLE))))"
    series = (f"list_sum(list_transform(range(1, 101), lambda j: pow(-1.0, j - 1) * "
              f"exp(-2.0 * j * j * {lam} * {lam})))")
    return (f"CASE WHEN {lam} < 0.2 THEN 1.0 "
            f"ELSE least(greatest(2.0 * {series}, 0.0), 1.0) END")


FLOW_LONG = """flow_long AS (
  SELECT flow_id, Day, Label, feature, v FROM (
    SELECT flow_id, Day, Label, 'value' AS feature, value AS v FROM flows
    UNION ALL SELECT flow_id, Day, Label, 'user_id', user_id FROM flows
    UNION ALL SELECT flow_id, Day, Label, 'k', k FROM flows)
  WHERE v IS NOT NULL AND NOT isnan(v))"""


# Exact two-sample tail: the chance v that a random lattice path to (n, m) comes to i on
# diagonal k and has kept |i*m - j*n| < h so far, one diagonal a step.
KS_EXACT = f"""few AS (SELECT b, feature, row_number() OVER () AS r, n_ref AS n, n_cur AS m,
    CAST(round(statistic * n_ref * n_cur) AS BIGINT) AS h FROM st WHERE greatest(n_ref, n_cur) <= {EXACT_ROWS}),
walk(r, k, i, v) AS (
  SELECT r, CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(1 AS DOUBLE) FROM few WHERE h > 0
  UNION ALL
  SELECT r, k + 1, i, SUM(v) FROM (
    SELECT w.r, w.k, few.n, few.m, few.h, unnest([w.i, w.i + 1]) AS i,
           unnest([w.v * (1 - CAST(few.n - w.i AS DOUBLE) / (few.n + few.m - w.k)), w.v * CAST(few.n - w.i AS DOUBLE) / (few.n + few.m - w.k)]) AS v
    FROM walk w JOIN few ON few.r = w.r WHERE w.k < few.n + few.m)
  WHERE i <= n AND k + 1 - i <= m AND abs(i * (n + m) - (k + 1) * n) < h GROUP BY r, k, i),
whole AS (SELECT walk.r, SUM(v) AS inside FROM walk JOIN few ON few.r = walk.r AND walk.k = few.n + few.m GROUP BY walk.r)"""


def _ks_sql(ref_pred: str, cur_pred: str, batch: str | None) -> str:
    bsel = f"{batch} AS b" if batch else "0 AS b"
    out_b = f"CAST(b AS BIGINT) AS {batch}, " if batch else ""
    return f"""WITH RECURSIVE {FLOWS_SQL}, {FLOW_LONG},
rp AS (SELECT feature, v, COUNT(*) AS rc FROM flow_long WHERE {ref_pred} GROUP BY feature, v),
cp AS (SELECT {bsel}, feature, v, COUNT(*) AS cc FROM flow_long WHERE {cur_pred} GROUP BY ALL),
pts AS (SELECT feature, v, SUM(rc) AS rc FROM (
          SELECT feature, v, rc FROM rp UNION ALL SELECT feature, v, 0 FROM cp) GROUP BY feature, v),
rcdf AS (SELECT feature, v, rc, SUM(rc) OVER (PARTITION BY feature ORDER BY v
          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ref_le FROM pts),
ccdf AS (SELECT b, feature, v, cc, SUM(cc) OVER (PARTITION BY b, feature ORDER BY v
          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cur_le FROM cp),
nr AS (SELECT feature, SUM(rc) AS n_ref FROM rp GROUP BY feature),
nc AS (SELECT b, feature, SUM(cc) AS n_cur FROM cp GROUP BY b, feature),
st AS (SELECT c.b, c.feature, CAST(nr.n_ref AS BIGINT) AS n_ref, CAST(nc.n_cur AS BIGINT) AS n_cur,
         MAX(GREATEST(
           ABS(CAST(r.ref_le AS DOUBLE) / CAST(nr.n_ref AS DOUBLE) - CAST(c.cur_le AS DOUBLE) / CAST(nc.n_cur AS DOUBLE)),
           ABS(CAST(r.ref_le - r.rc AS DOUBLE) / CAST(nr.n_ref AS DOUBLE)
               - CAST(c.cur_le - c.cc AS DOUBLE) / CAST(nc.n_cur AS DOUBLE)))) AS statistic
       FROM ccdf c JOIN rcdf r ON c.feature = r.feature AND c.v = r.v
       JOIN nr ON nr.feature = c.feature JOIN nc ON nc.b = c.b AND nc.feature = c.feature
       GROUP BY c.b, c.feature, nr.n_ref, nc.n_cur),
{KS_EXACT},
pv AS (SELECT st.*, CASE WHEN greatest(n_ref, n_cur) > {EXACT_ROWS} THEN {ks_pvalue_sql('statistic', 'n_ref', 'n_cur')}
         WHEN h = 0 THEN 1 ELSE least(greatest(1 - coalesce(inside, 0), 0), 1) END AS p
       FROM st LEFT JOIN few ON few.b = st.b AND few.feature = st.feature LEFT JOIN whole ON whole.r = few.r)
SELECT {out_b}feature, n_ref, n_cur, ROUND(statistic, 6) AS statistic, ROUND(p, 6) AS p_value,
       p < 0.05 AS is_drifted
FROM pv"""


ORACLE["drift_by_day"] = _ks_sql(f"Day < {REFERENCE_DAYS}", f"Day >= {REFERENCE_DAYS}", "Day")
ORACLE["ks_drift"] = _ks_sql("Day < 15", "Day >= 15", None)
ORACLE["drift_summary"] = f"""WITH ks AS ({_ks_sql(f"Day < {REFERENCE_DAYS}", f"Day >= {REFERENCE_DAYS}", "Day")})
SELECT Day, CAST(COUNT(*) AS BIGINT) AS n_features,
       CAST(SUM(CAST(is_drifted AS BIGINT)) AS BIGINT) AS n_drifted,
       coalesce(array_to_string(list_sort(list(feature) FILTER (WHERE is_drifted)), ','), '')
         AS drifted_features,
       ROUND(CAST(SUM(CAST(is_drifted AS BIGINT)) AS DOUBLE) / COUNT(*), 6) AS drift_ratio,
       SUM(CAST(is_drifted AS BIGINT)) > 0 AS has_drift
FROM ks GROUP BY Day"""

_CLASS_COUNTS = f"""WITH {FLOWS_SQL},
rc AS (SELECT Label AS label, COUNT(*) AS ref_count FROM flows WHERE Day < {REFERENCE_DAYS} GROUP BY Label),
cc AS (SELECT Day, Label AS label, COUNT(*) AS cur_count FROM flows WHERE Day >= {REFERENCE_DAYS} GROUP BY Day, Label),
ct AS (SELECT Day, SUM(cur_count) AS cur_total FROM cc GROUP BY Day),
grid AS (SELECT ct.Day, rc.label FROM ct, rc UNION SELECT Day, label FROM cc),
counts AS (
  SELECT g.Day, g.label, CAST(coalesce(rc.ref_count, 0) AS BIGINT) AS ref_count,
         CAST(coalesce(cc.cur_count, 0) AS BIGINT) AS cur_count,
         CAST(coalesce(rc.ref_count, 0) AS DOUBLE) / (SELECT SUM(ref_count) FROM rc) AS ref_share,
         CAST(coalesce(cc.cur_count, 0) AS DOUBLE) / ct.cur_total AS cur_share,
         CAST(ct.cur_total AS BIGINT) AS cur_total
  FROM grid g LEFT JOIN rc ON rc.label = g.label
  LEFT JOIN cc ON cc.Day = g.Day AND cc.label = g.label JOIN ct ON ct.Day = g.Day)"""

ORACLE["class_shift_counts"] = _CLASS_COUNTS + """
SELECT CAST(Day AS BIGINT) AS Day, label, ref_count, cur_count, ROUND(ref_share, 6) AS ref_share,
       ROUND(cur_share, 6) AS cur_share, cur_total FROM counts"""

# The stand-in has 5 classes, so dof is even and the chi-square tail has the
# closed form exp(-x/2) * sum_{i < dof/2} (x/2)^i / i!; the Spark side uses the
# general incomplete-gamma tail.
ORACLE["chi2_drift"] = _CLASS_COUNTS + """,
e AS (SELECT *, CASE WHEN ref_share * cur_total = 0 THEN 1e-10 ELSE ref_share * cur_total END AS ex
      FROM counts),
s AS (SELECT Day, COUNT(*) AS n_classes, SUM(pow(cur_count - ex, 2) / ex) AS statistic FROM e GROUP BY Day),
p AS (SELECT *, n_classes - 1 AS dof,
        CASE WHEN n_classes > 1 AND (n_classes - 1) % 2 = 0 THEN
          exp(-statistic / 2) * list_sum(list_transform(range(0, CAST((n_classes - 1) / 2 AS BIGINT)),
              lambda i: pow(statistic / 2, i) / factorial(CAST(i AS INTEGER))))
        END AS p_value FROM s)
SELECT CAST(Day AS BIGINT) AS Day, CAST(n_classes AS BIGINT) AS n_classes, ROUND(statistic, 6) AS statistic,
       CAST(dof AS BIGINT) AS dof, ROUND(p_value, 6) AS p_value,
       coalesce(p_value < 0.05, false) AS has_drift FROM p"""


# ---------------------------------------------------------- sources, cleaning
FLOW_COLS_SQL = "CAST(flow_id AS BIGINT) AS flow_id, CAST(Day AS BIGINT) AS Day, value, user_id, k, Label"

ORACLE["csv_union"] = f"""WITH {FLOWS_SQL}
SELECT CAST(flow_id AS BIGINT) AS flow_id, CAST(Day AS BIGINT) AS Day, value,
       CASE WHEN Day < 15 THEN user_id END AS user_id, k, Label
FROM flows"""
ORACLE["csv_union_schema"] = ORACLE["csv_union"]
# with types found every column is kept, the second "value" of the last files under its own name
ORACLE["csv_union"] = ORACLE["csv_union"].replace(
    "k, Label", 'k, Label, CASE WHEN Day > 21 THEN k * 2 END AS "value.1"')

ORACLE["clean_flows"] = f"""WITH {FLOWS_SQL}, {DIRTY_SQL}, {CLEAN_SQL}
SELECT {FLOW_COLS_SQL} FROM clean"""

ORACLE["clean_drop_report"] = f"""WITH {FLOWS_SQL}, {DIRTY_SQL}, {CLEAN_SQL}
SELECT CAST((SELECT COUNT(*) FROM dirty) AS BIGINT) AS rows_in,
       CAST((SELECT COUNT(*) FROM clean) AS BIGINT) AS rows_out,
       CAST((SELECT COUNT(*) FROM dirty) - (SELECT COUNT(*) FROM clean) AS BIGINT) AS rows_dropped"""

ORACLE["label_repair"] = f"""WITH {FLOWS_SQL}, {DIRTY_SQL}
SELECT " Label " AS raw_label, CAST(COUNT(*) AS BIGINT) AS n,
       trim(regexp_replace(replace(" Label ", '�', ' '), '\\s+', ' ', 'g')) AS label
FROM dirty GROUP BY ALL"""

_LI_INT = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
_LI_FLOAT = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_LI_TYPES = {"l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint",
             "l_linenumber": "int"}


def _int_choice(c: str) -> str:
    return (f"CASE WHEN min({c}) >= -128 AND max({c}) <= 127 THEN 'tinyint' "
            f"WHEN min({c}) >= -32768 AND max({c}) <= 32767 THEN 'smallint' "
            f"WHEN min({c}) >= -2147483648 AND max({c}) <= 2147483647 THEN 'int' ELSE 'bigint' END")


def _float_choice(c: str) -> str:
    return (f"CASE WHEN min({c}) >= -3.4028234663852886e38 AND max({c}) <= 3.4028234663852886e38 "
            f"THEN 'float' ELSE 'double' END")


ORACLE["downcast_plan"] = "\nUNION ALL\n".join(
    [f"SELECT '{c}' AS column, '{_LI_TYPES[c]}' AS in_type, ROUND(CAST(min({c}) AS DOUBLE), 6) AS min, "
     f"ROUND(CAST(max({c}) AS DOUBLE), 6) AS max, {_int_choice(c)} AS out_type FROM lineitem"
     for c in _LI_INT]
    + [f"SELECT '{c}' AS column, 'double' AS in_type, ROUND(min({c}), 6) AS min, "
       f"ROUND(max({c}), 6) AS max, {_float_choice(c)} AS out_type FROM lineitem"
       for c in _LI_FLOAT])

_SQL_TYPE = {"tinyint": "TINYINT", "smallint": "SMALLINT", "int": "INTEGER",
             "bigint": "BIGINT", "float": "FLOAT", "double": "DOUBLE"}


def _roundtrip(c: str, kinds: tuple[str, ...], wide: str) -> str:
    whens = " ".join(f"WHEN (SELECT t_{c} FROM lim) = '{t}' THEN CAST(CAST({c} AS {_SQL_TYPE[t]}) AS {wide})"
                     for t in kinds)
    return f"CASE {whens} END AS {c}"


ORACLE["downcast_values"] = f"""WITH lim AS (SELECT
  {", ".join(f"{_int_choice(c)} AS t_{c}" for c in _LI_INT)},
  {", ".join(f"{_float_choice(c)} AS t_{c}" for c in _LI_FLOAT)} FROM lineitem)
SELECT
  {", ".join(_roundtrip(c, ("tinyint", "smallint", "int", "bigint"), "BIGINT") for c in _LI_INT)},
  {", ".join(_roundtrip(c, ("float", "double"), "DOUBLE") for c in _LI_FLOAT)},
  l_returnflag, l_linestatus, CAST(l_shipdate AS VARCHAR) AS l_shipdate
FROM lineitem"""

ORACLE["drop_columns"] = f"""WITH {FLOWS_SQL}
SELECT CAST(flow_id AS BIGINT) AS flow_id, CAST(Day AS BIGINT) AS Day, value, user_id, Label FROM flows"""

ORACLE["class_subset"] = f"""WITH {FLOWS_SQL}
SELECT {FLOW_COLS_SQL} FROM flows WHERE Label IN ('click', 'purchase')"""

ORACLE["add_day"] = """SELECT CAST(event_id AS BIGINT) AS flow_id, dayname(ts) AS DayName,
  CAST(CASE dayname(ts) WHEN 'Monday' THEN 0 WHEN 'Tuesday' THEN 1 WHEN 'Wednesday' THEN 2
       WHEN 'Thursday' THEN 3 WHEN 'Friday' THEN 4 WHEN 'Saturday' THEN 5 WHEN 'Sunday' THEN 6 END
       AS BIGINT) AS Day
FROM events"""

ORACLE["head_rows"] = f"""WITH {FLOWS_SQL}
SELECT {FLOW_COLS_SQL} FROM flows ORDER BY flow_id LIMIT 5"""

ORACLE["parquet_roundtrip"] = ORACLE["clean_flows"]


# ---------------------------------------------------------------- profiles
ORACLE["class_distribution"] = f"""WITH {FLOWS_SQL}
SELECT Label AS label, CAST(COUNT(*) AS BIGINT) AS count,
       ROUND(CAST(COUNT(*) AS DOUBLE) / SUM(COUNT(*)) OVER (), 6) AS share
FROM flows GROUP BY Label"""

ORACLE["describe_numeric"] = f"""WITH {FLOWS_SQL}, {FLOW_LONG}
SELECT feature AS column, CAST(COUNT(*) AS BIGINT) AS count, ROUND(AVG(v), 6) AS mean,
       ROUND(STDDEV_SAMP(v), 6) AS std, ROUND(MIN(v), 6) AS min,
       ROUND(quantile_cont(v, 0.25), 6) AS p25, ROUND(quantile_cont(v, 0.5), 6) AS p50,
       ROUND(quantile_cont(v, 0.75), 6) AS p75, ROUND(MAX(v), 6) AS max
FROM flow_long GROUP BY feature"""

_DIRTY_COLS = [(" flow_id", "bigint"), ("Day ", "int"), ("  value", "double"),
               ("user_id ", "double"), ("k", "double"), (" Label ", "string")]
ORACLE["column_profile"] = f"""WITH {FLOWS_SQL}, {DIRTY_SQL}
""" + "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS column, '{t}' AS dtype, CAST(COUNT({v}) AS BIGINT) AS non_null,
       CAST(COUNT(*) - COUNT({v}) AS BIGINT) AS nulls FROM dirty""" for c, t in _DIRTY_COLS
    for v in [f'CASE WHEN NOT isnan("{c}") THEN 1 END' if t == "double" else f'"{c}"'])

_LOG_HIST = f"""{FLOWS_SQL}, {FLOW_LONG},
ll AS (SELECT feature, log10(v) AS lv FROM flow_long WHERE v > 0),
rng AS (SELECT feature, MIN(lv) AS mn, MAX(lv) AS mx FROM ll GROUP BY feature),
cnt AS (SELECT ll.feature, CAST(CASE WHEN mx = mn THEN 25
          ELSE least(floor((lv - mn) / (mx - mn) * 50), 49) END AS INTEGER) AS bin,
          COUNT(*) AS c FROM ll JOIN rng ON ll.feature = rng.feature GROUP BY ALL),
grid AS (SELECT feature, mn, mx, CAST(unnest(range(0, 50)) AS INTEGER) AS bin FROM rng),
hist AS (SELECT g.feature, g.bin, g.mn + g.bin * ((g.mx - g.mn) / 50) AS log_lo,
           g.mn + (g.bin + 1) * ((g.mx - g.mn) / 50) AS log_hi, coalesce(c, 0) AS count
         FROM grid g LEFT JOIN cnt ON cnt.feature = g.feature AND cnt.bin = g.bin)"""

ORACLE["log_histogram"] = f"""WITH {_LOG_HIST}
SELECT feature, CAST(bin AS BIGINT) AS bin, ROUND(log_lo, 6) AS log_lo, ROUND(log_hi, 6) AS log_hi,
       CAST(count AS BIGINT) AS count FROM hist"""

ORACLE["binned_kde"] = f"""WITH {_LOG_HIST},
sp AS (SELECT feature, STDDEV_SAMP(lv) AS sd, COUNT(*) AS n, MIN(lv) AS mn, MAX(lv) AS mx FROM ll GROUP BY feature),
par AS (SELECT *, sd * pow(CAST(n AS DOUBLE), -0.2) AS bw, (mx - mn) / 99 AS step, (mx - mn) / 1023 AS apart FROM sp),
spot AS (SELECT ll.feature, (lv - mn) / (mx - mn) * 1023 AS place, least(floor((lv - mn) / (mx - mn) * 1023), 1022) AS low
       FROM ll JOIN par ON par.feature = ll.feature),
w AS (SELECT feature, node, SUM(w) AS w FROM (
        SELECT feature, low AS node, 1 - (place - low) AS w FROM spot UNION ALL SELECT feature, low + 1, place - low FROM spot)
      GROUP BY feature, node),
g AS (SELECT par.*, unnest(range(0, 100)) AS gi FROM par),
d AS (SELECT g.feature, g.gi, g.mn + g.gi * g.step AS x,
        SUM(CASE WHEN abs((g.mn + g.gi * g.step - (g.mn + w.node * g.apart)) / g.bw) > 8 THEN 0 ELSE
              w.w * exp(-0.5 * pow((g.mn + g.gi * g.step - (g.mn + w.node * g.apart)) / g.bw, 2)) END)
          / (g.n * g.bw * sqrt(2.0 * pi())) AS density
      FROM g JOIN w ON w.feature = g.feature GROUP BY g.feature, g.gi, g.mn, g.step, g.n, g.bw)
SELECT feature, CAST(gi AS BIGINT) AS grid_index, ROUND(x, 6) AS x, ROUND(density, 6) AS density FROM d"""

ORACLE["box_stats"] = f"""WITH {FLOWS_SQL}, {FLOW_LONG},
lv AS (SELECT Label AS label, feature, v FROM flow_long),
qs AS (SELECT label, feature, COUNT(*) AS n, quantile_cont(v, 0.25) AS q1,
         quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS q3 FROM lv GROUP BY label, feature),
fe AS (SELECT *, q1 - 1.5 * (q3 - q1) AS fence_lo, q3 + 1.5 * (q3 - q1) AS fence_hi FROM qs),
wh AS (SELECT lv.label, lv.feature,
         MIN(CASE WHEN v >= fence_lo AND v <= fence_hi THEN v END) AS whisker_lo,
         MAX(CASE WHEN v >= fence_lo AND v <= fence_hi THEN v END) AS whisker_hi,
         SUM(CASE WHEN v >= fence_lo AND v <= fence_hi THEN 0 ELSE 1 END) AS n_outliers
       FROM lv JOIN fe ON fe.label = lv.label AND fe.feature = lv.feature GROUP BY lv.label, lv.feature)
SELECT fe.label, fe.feature, CAST(n AS BIGINT) AS n, ROUND(q1, 6) AS q1, ROUND(median, 6) AS median,
       ROUND(q3, 6) AS q3, ROUND(fence_lo, 6) AS fence_lo, ROUND(fence_hi, 6) AS fence_hi,
       ROUND(whisker_lo, 6) AS whisker_lo, ROUND(whisker_hi, 6) AS whisker_hi,
       CAST(n_outliers AS BIGINT) AS n_outliers
FROM fe JOIN wh ON wh.label = fe.label AND wh.feature = fe.feature"""


def _pairs_sql(cols, src):
    sel = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            if i > j:
                sel.append(f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, "
                           f"ROUND(corr(c_{a}, c_{b}), 6) AS corr FROM {src}")
    return "\nUNION ALL\n".join(sel)


_FCOLS = ["value", "user_id", "k", "Label"]
ORACLE["factorized_corr"] = f"""WITH {FLOWS_SQL},
""" + ",\n".join(
    f"""f_{c} AS (SELECT {c} AS v, MIN(flow_id) AS fk FROM flows WHERE {c} IS NOT NULL GROUP BY {c}),
k_{c} AS (SELECT v, row_number() OVER (ORDER BY fk) - 1 AS code FROM f_{c})""" for c in _FCOLS) + """,
codes AS (SELECT flows.flow_id, """ + ", ".join(f"coalesce(k_{c}.code, -1) AS c_{c}" for c in _FCOLS) + """
  FROM flows """ + " ".join(f"LEFT JOIN k_{c} ON k_{c}.v = flows.{c}" for c in _FCOLS) + """)
""" + _pairs_sql(_FCOLS, "codes")

_LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
ORACLE["value_corr"] = "WITH li AS (SELECT " + ", ".join(f"{c} AS c_{c}" for c in _LI_NUM) + \
    " FROM lineitem)\n" + _pairs_sql(_LI_NUM, "li")
_LI_RED = _LI_NUM + ["net_price", "gross_price"]
ORACLE["redundant_pairs"] = (
    "WITH li AS (SELECT " + ", ".join(f"{c} AS c_{c}" for c in _LI_NUM)
    + ", l_extendedprice * (1 - l_discount) AS c_net_price, l_extendedprice * (1 + l_tax) AS c_gross_price"
    + " FROM lineitem)\nSELECT * FROM (" + _pairs_sql(_LI_RED, "li") + ") WHERE abs(corr) > 0.8")

ORACLE["prediction_summary"] = f"""WITH {FLOWS_SQL},
s AS (SELECT {RULE_SQL} AS prediction, COUNT(*) AS count FROM flows GROUP BY ALL),
t AS (SELECT *, CAST(count AS DOUBLE) / SUM(count) OVER () AS share FROM s)
SELECT prediction, CAST(count AS BIGINT) AS count, ROUND(share * 100.0, 6) AS percent,
       printf('%.1f%%', round(share * 100.0, 1)) AS percent_text FROM t"""


# ---------------------------------------------------------------- splits
_RANKED = """r AS (SELECT flows.*, row_number() OVER (PARTITION BY Label
          ORDER BY md5('42:' || CAST(flow_id AS VARCHAR)), flow_id) AS rk FROM flows)"""
ORACLE["stratified_split"] = f"""WITH {FLOWS_SQL},
cc AS (SELECT Label, COUNT(*) AS c FROM flows GROUP BY Label),
t AS (SELECT SUM(c) AS n, SUM(c) - CAST(ceil(SUM(c) * 0.3) AS BIGINT) AS nt FROM cc),
b AS (SELECT Label, c, (nt * c) // n AS base, (nt * c) % n AS rem, nt FROM cc, t),
qt AS (SELECT Label, c, base + CASE WHEN row_number() OVER (ORDER BY rem DESC, Label)
          <= nt - SUM(base) OVER () THEN 1 ELSE 0 END AS n_train FROM b),
{_RANKED}
SELECT {FLOW_COLS_SQL}, CASE WHEN rk <= c - n_train THEN 'test' ELSE 'train' END AS split
FROM r JOIN qt USING (Label)"""

ORACLE["stratified_folds"] = f"""WITH {FLOWS_SQL}, {_RANKED}
SELECT {FLOW_COLS_SQL}, CAST((rk - 1) % 5 AS BIGINT) AS fold FROM r"""

ORACLE["temporal_split"] = f"""WITH {FLOWS_SQL}
SELECT {FLOW_COLS_SQL}, CASE WHEN Day < 21 THEN 'train' ELSE 'test' END AS split FROM flows
WHERE Day BETWEEN 0 AND 29"""

ORACLE["walk_forward_folds"] = f"""WITH {FLOWS_SQL},
d AS (SELECT Day, COUNT(*) AS n FROM flows GROUP BY Day),
s AS (SELECT Day, n, row_number() OVER (ORDER BY Day) - 1 AS idx,
        coalesce(SUM(n) OVER (ORDER BY Day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS train_size,
        first_value(Day) OVER (ORDER BY Day) AS first_train_day,
        lag(Day) OVER (ORDER BY Day) AS last_train_day FROM d)
SELECT CAST(idx - 1 AS BIGINT) AS step, CAST(Day AS BIGINT) AS test_day,
       CAST(first_train_day AS BIGINT) AS first_train_day, CAST(last_train_day AS BIGINT) AS last_train_day,
       CAST(idx AS BIGINT) AS n_train_days, CAST(train_size AS BIGINT) AS train_size,
       CAST(n AS BIGINT) AS test_size
FROM s WHERE idx >= 2"""

ORACLE["permuted_column"] = f"""WITH {FLOWS_SQL},
a AS (SELECT flow_id, row_number() OVER (ORDER BY flow_id) AS pos FROM flows),
b AS (SELECT value AS value_perm, row_number() OVER (
        ORDER BY md5('7:' || CAST(flow_id AS VARCHAR)), flow_id) AS pos FROM flows)
SELECT {FLOW_COLS_SQL}, value_perm FROM flows JOIN a USING (flow_id) JOIN b USING (pos)"""


# ---------------------------------------------------------------- metrics
_SCORED = f"""{FLOWS_SQL}, scored AS (SELECT flows.*, {RULE_SQL} AS prediction FROM flows)"""
_CM = f"""{_SCORED},
cls AS (SELECT Label AS c FROM scored UNION SELECT prediction FROM scored),
cells AS (SELECT Label AS label, prediction, COUNT(*) AS n FROM scored GROUP BY ALL),
cm AS (SELECT a.c AS label, b.c AS prediction, coalesce(n, 0) AS count
       FROM cls a, cls b LEFT JOIN cells ON cells.label = a.c AND cells.prediction = b.c)"""

ORACLE["confusion_matrix"] = f"""WITH {_CM}
SELECT label, prediction, CAST(count AS BIGINT) AS count FROM cm"""

ORACLE["confusion_matrix_norm"] = f"""WITH {_CM},
t AS (SELECT *, SUM(count) OVER (PARTITION BY label) AS row_total FROM cm)
SELECT label, prediction, CAST(count AS BIGINT) AS count, CAST(row_total AS BIGINT) AS row_total,
       ROUND(CASE WHEN row_total = 0 THEN NULL ELSE CAST(count AS DOUBLE) / row_total END, 6) AS share,
       printf('%.1f%%', round(CAST(count AS DOUBLE) / row_total * 100.0, 1)) || chr(10) || '(' || CAST(count AS VARCHAR) || ')'
         AS cell_text
FROM t"""


def _per_class(src: str, by: str = "") -> str:
    bsel = f"{by}, " if by else ""
    return f"""cc AS (
  SELECT {bsel}c AS class, SUM(tp) AS tp, SUM(t) AS n_true, SUM(p) AS n_pred FROM (
    SELECT {bsel}Label AS c, CASE WHEN Label = prediction THEN 1 ELSE 0 END AS tp, 1 AS t, 0 AS p FROM {src}
    UNION ALL SELECT {bsel}prediction, 0, 0, 1 FROM {src}) GROUP BY ALL),
pc AS (SELECT *, CASE WHEN n_pred = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / n_pred END AS precision,
         CASE WHEN n_true = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / n_true END AS recall FROM cc),
pf AS (SELECT *, CASE WHEN precision + recall = 0 THEN 0.0
         ELSE 2 * precision * recall / (precision + recall) END AS f1 FROM pc)"""


ORACLE["classification_report"] = f"""WITH {_SCORED}, {_per_class("scored")}
SELECT class AS row, ROUND(precision, 6) AS precision, ROUND(recall, 6) AS recall, ROUND(f1, 6) AS f1,
       CAST(n_true AS BIGINT) AS support FROM pf
UNION ALL SELECT 'accuracy', NULL, NULL, ROUND(CAST(SUM(tp) AS DOUBLE) / SUM(n_true), 6),
       CAST(SUM(n_true) AS BIGINT) FROM pf
UNION ALL SELECT 'macro avg', ROUND(AVG(precision), 6), ROUND(AVG(recall), 6), ROUND(AVG(f1), 6),
       CAST(SUM(n_true) AS BIGINT) FROM pf
UNION ALL SELECT 'weighted avg', ROUND(SUM(precision * n_true) / SUM(n_true), 6),
       ROUND(SUM(recall * n_true) / SUM(n_true), 6), ROUND(SUM(f1 * n_true) / SUM(n_true), 6),
       CAST(SUM(n_true) AS BIGINT) FROM pf"""

_SPLIT_QUOTA = """cq AS (SELECT Label, COUNT(*) AS c FROM flows GROUP BY Label),
tq AS (SELECT SUM(c) AS n, SUM(c) - CAST(ceil(SUM(c) * 0.3) AS BIGINT) AS nt FROM cq),
bq AS (SELECT Label, c, (nt * c) // n AS base, (nt * c) % n AS rem, nt FROM cq, tq),
qt AS (SELECT Label, c, base + CASE WHEN row_number() OVER (ORDER BY rem DESC, Label)
          <= nt - SUM(base) OVER () THEN 1 ELSE 0 END AS n_train FROM bq)"""
_SPLIT_ROWS = f"""{_SPLIT_QUOTA}, {_RANKED},
sp AS (SELECT r.*, CASE WHEN rk <= c - n_train THEN 'test' ELSE 'train' END AS split
       FROM r JOIN qt USING (Label))"""

ORACLE["train_test_gap"] = f"""WITH {FLOWS_SQL}, {_SPLIT_ROWS},
h AS (SELECT split, CASE WHEN Label = ({RULE_SQL}) THEN 1.0 ELSE 0.0 END AS hit FROM sp),
a AS (SELECT AVG(CASE WHEN split = 'train' THEN hit END) AS tr, AVG(CASE WHEN split = 'test' THEN hit END) AS te FROM h)
SELECT ROUND(tr, 6) AS train_score, ROUND(te, 6) AS test_score, ROUND(tr - te, 6) AS gap,
       tr - te > 0.05 AS is_overfitting FROM a"""

_FOLD_SCORES = f"""{FLOWS_SQL}, {_RANKED},
fs AS (SELECT r.*, (rk - 1) % 5 AS fold, {RULE_SQL} AS prediction FROM r),
{_per_class("fs", "fold")},
ms AS (SELECT fold, SUM(n_true) AS n, CAST(SUM(tp) AS DOUBLE) / SUM(n_true) AS accuracy,
         AVG(precision) AS precision_macro, AVG(recall) AS recall_macro, AVG(f1) AS f1_macro
       FROM pf GROUP BY fold)"""

ORACLE["macro_metrics"] = f"""WITH {_FOLD_SCORES}
SELECT CAST(fold AS BIGINT) AS fold, CAST(n AS BIGINT) AS n, ROUND(accuracy, 6) AS accuracy,
       ROUND(precision_macro, 6) AS precision_macro, ROUND(recall_macro, 6) AS recall_macro,
       ROUND(f1_macro, 6) AS f1_macro FROM ms"""

ORACLE["fold_summary"] = f"""WITH {_FOLD_SCORES},
l AS (UNPIVOT ms ON accuracy, precision_macro, recall_macro, f1_macro INTO NAME metric VALUE score)
SELECT metric, ROUND(AVG(score), 6) AS mean, ROUND(STDDEV_POP(score), 6) AS std,
       CAST(COUNT(*) AS BIGINT) AS n_folds FROM l GROUP BY metric"""

ORACLE["standard_scale"] = f"""WITH {FLOWS_SQL}, {_SPLIT_ROWS},
st AS (SELECT AVG(value) AS mv, STDDEV_POP(value) AS sv, AVG(user_id) AS mu, STDDEV_POP(user_id) AS su,
         AVG(k) AS mk, STDDEV_POP(k) AS sk FROM sp WHERE split = 'train')
SELECT CAST(flow_id AS BIGINT) AS flow_id, CAST(Day AS BIGINT) AS Day,
       ROUND((value - mv) / CASE WHEN sv = 0 THEN 1 ELSE sv END, 6) AS value,
       ROUND((user_id - mu) / CASE WHEN su = 0 THEN 1 ELSE su END, 6) AS user_id,
       ROUND((k - mk) / CASE WHEN sk = 0 THEN 1 ELSE sk END, 6) AS k, Label, split
FROM sp, st"""


# ---------------------------------------------------------------- SMOTE
ORACLE["smote_class_targets"] = """WITH c AS (SELECT label, COUNT(*) AS n FROM embeddings GROUP BY label)
SELECT CAST(label AS BIGINT) AS label, CAST(n AS BIGINT) AS n, CAST(MAX(n) OVER () AS BIGINT) AS target,
       CAST(MAX(n) OVER () - n AS BIGINT) AS need FROM c"""

ORACLE["smote_knn"] = """WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
pairs AS (SELECT a.vec_id, a.label, b.vec_id AS nn_vec_id,
            sqrt(list_sum(list_transform(range(1, 65), lambda i: (a.v[i] - b.v[i]) * (a.v[i] - b.v[i])))) AS dist
          FROM e a JOIN e b ON a.label = b.label AND a.vec_id <> b.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY dist, nn_vec_id) AS nn_rank FROM pairs)
SELECT CAST(vec_id AS BIGINT) AS vec_id, CAST(label AS BIGINT) AS label, CAST(nn_rank AS BIGINT) AS nn_rank,
       CAST(nn_vec_id AS BIGINT) AS nn_vec_id, ROUND(dist, 6) AS dist FROM r WHERE nn_rank <= 5"""

def _unit(kind: str) -> str:
    return (f"CAST(CAST('0x' || substr(md5('42:' || CAST(label AS VARCHAR) || ':' || CAST(j AS VARCHAR) || ':{kind}'), 1, 13)"
            f" AS BIGINT) AS DOUBLE) / {float(16 ** 13)}")


_NN = ORACLE["smote_knn"].split("\nSELECT")[0]
ORACLE["smote_rows"] = _NN + f""",
c AS (SELECT label, COUNT(*) AS n FROM embeddings GROUP BY label),
need AS (SELECT label, n, (SELECT MAX(n) FROM c) - n AS need FROM c),
ids AS (SELECT label, n, unnest(range(1, need + 1)) AS j FROM need WHERE need > 0),
drawn AS (SELECT label, j, CAST(floor({_unit("b")} * n) AS BIGINT) + 1 AS base_rank,
            CAST(floor({_unit("n")} * greatest(least(5, n - 1), 1)) AS BIGINT) + 1 AS nn_rank, {_unit("u")} AS gap FROM ids),
ranked AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS base_rank FROM e),
joined AS (SELECT d.label, d.j, x.vec_id AS base_key, r.nn_vec_id AS nn_key, d.gap, x.v AS xv, coalesce(y.v, x.v) AS yv
  FROM drawn d JOIN ranked x ON x.label = d.label AND x.base_rank = d.base_rank
  LEFT JOIN r ON r.vec_id = x.vec_id AND r.nn_rank = d.nn_rank LEFT JOIN e y ON y.vec_id = r.nn_vec_id)
SELECT CAST(label AS BIGINT) AS label, CAST(j AS BIGINT) AS j, CAST(base_key AS BIGINT) AS base_key,
  CAST(nn_key AS BIGINT) AS nn_key, ROUND(gap, 6) AS gap,
  {", ".join(f"ROUND(xv[{i + 1}] + gap * (yv[{i + 1}] - xv[{i + 1}]), 6) AS e{i}" for i in range(64))}
FROM joined"""


# ---------------------------------------------------------------- streaming
ORACLE["drift_stream"] = ORACLE["drift_by_day"]
ORACLE["drift_stream_batches"] = f"""WITH ks AS ({_ks_sql(f"Day < {REFERENCE_DAYS}", f"Day >= {REFERENCE_DAYS}", "Day")}),
chi AS ({ORACLE["chi2_drift"]}),
d AS (SELECT Day, CAST(COUNT(*) AS BIGINT) AS n_features, CAST(SUM(CAST(is_drifted AS BIGINT)) AS BIGINT) AS n_drifted
      FROM ks GROUP BY Day)
SELECT d.Day, n_features, n_drifted, ROUND(CAST(n_drifted AS DOUBLE) / n_features, 6) AS drift_ratio,
  n_drifted > 0 AS data_drift, chi.statistic AS chi2_statistic, chi.p_value AS chi2_p_value,
  chi.has_drift AS prediction_drift, n_drifted > 0 OR chi.has_drift AS needs_retraining
FROM d JOIN chi ON chi.Day = d.Day"""


# ---------------------------------------------------------------- monitor, round trip
def _monitor_batch(n: int, lo: int, hi: int, labels: bool) -> str:
    ks = _ks_sql(f"Day < {REFERENCE_DAYS}", f"Day >= {lo} AND Day < {hi}", None)
    if labels:
        chi = f"""(WITH {FLOWS_SQL},
rc AS (SELECT Label AS label, COUNT(*) AS ref_count FROM flows WHERE Day < {REFERENCE_DAYS} GROUP BY Label),
cc AS (SELECT Label AS label, COUNT(*) AS cur_count FROM flows WHERE Day >= {lo} AND Day < {hi} GROUP BY Label),
g AS (SELECT label FROM rc UNION SELECT label FROM cc),
e AS (SELECT coalesce(cc.cur_count, 0) AS o,
        CAST(coalesce(rc.ref_count, 0) AS DOUBLE) / (SELECT SUM(ref_count) FROM rc)
          * (SELECT SUM(cur_count) FROM cc) AS ex0
      FROM g LEFT JOIN rc USING (label) LEFT JOIN cc USING (label)),
s AS (SELECT COUNT(*) AS k, SUM(pow(o - (CASE WHEN ex0 = 0 THEN 1e-10 ELSE ex0 END), 2)
        / (CASE WHEN ex0 = 0 THEN 1e-10 ELSE ex0 END)) AS x FROM e)
SELECT x AS chi2_statistic,
  CASE WHEN (k - 1) % 2 = 0 AND k > 1 THEN exp(-x / 2) * list_sum(list_transform(
    range(0, CAST((k - 1) / 2 AS BIGINT)), lambda i: pow(x / 2, i) / factorial(CAST(i AS INTEGER)))) END
    AS chi2_p_value FROM s)"""
    else:
        chi = "(SELECT CAST(NULL AS DOUBLE) AS chi2_statistic, CAST(NULL AS DOUBLE) AS chi2_p_value)"
    return f"""SELECT CAST({n} AS BIGINT) AS batch_number, CAST(COUNT(*) AS BIGINT) AS n_features,
  CAST(SUM(CAST(is_drifted AS BIGINT)) AS BIGINT) AS n_drifted,
  ROUND(CAST(SUM(CAST(is_drifted AS BIGINT)) AS DOUBLE) / COUNT(*), 6) AS drift_ratio,
  SUM(CAST(is_drifted AS BIGINT)) > 0 AS data_drift,
  coalesce(array_to_string(list_sort(list(feature) FILTER (WHERE is_drifted)), ','), '') AS drifted_features,
  ROUND(ANY_VALUE(c.chi2_statistic), 6) AS chi2_statistic, ROUND(ANY_VALUE(c.chi2_p_value), 6) AS chi2_p_value,
  {"ANY_VALUE(c.chi2_p_value) < 0.05" if labels else "CAST(NULL AS BOOLEAN)"} AS prediction_drift,
  (SUM(CAST(is_drifted AS BIGINT)) > 0) OR coalesce({"ANY_VALUE(c.chi2_p_value) < 0.05" if labels else "NULL"}, false)
    AS needs_retraining
FROM ({ks}) ks, {chi} c"""


ORACLE["drift_monitor"] = "\nUNION ALL\n".join([
    _monitor_batch(1, 7, 14, True), _monitor_batch(2, 14, 21, True),
    _monitor_batch(3, 21, 30, False)])

# Saving and loading must not change a single prediction: all rows equal.
ORACLE["model_roundtrip"] = """SELECT CAST(COUNT(*) AS BIGINT) AS n_rows, CAST(COUNT(*) AS BIGINT) AS n_same,
  'forest' AS name, true AS has_saved_at FROM events"""


# ------------------------------------------------- evaluation bundle, fits and loops
ORACLE["evaluate"] = f"""WITH {_CM}, {_per_class("scored")},
l AS (SELECT class AS row, precision, recall, f1, CAST(n_true AS DOUBLE) AS support FROM pf),
t AS (SELECT CAST(SUM(n_true) AS DOUBLE) AS n, CAST(SUM(tp) AS DOUBLE) / SUM(n_true) AS acc, AVG(precision) AS mp,
        AVG(recall) AS mr, AVG(f1) AS mf, SUM(precision * n_true) / SUM(n_true) AS wp,
        SUM(recall * n_true) / SUM(n_true) AS wr, SUM(f1 * n_true) / SUM(n_true) AS wf FROM pf)
SELECT 'matrix' AS section, label AS row, prediction AS col, ROUND(CAST(count AS DOUBLE), 6) AS value FROM cm
UNION ALL SELECT 'class', row, unnest(['precision', 'recall', 'f1', 'support']),
  ROUND(unnest([precision, recall, f1, support]), 6) FROM l
UNION ALL SELECT 'average', 'accuracy', unnest(['f1', 'support']), ROUND(unnest([acc, n]), 6) FROM t
UNION ALL SELECT 'average', 'macro avg', unnest(['precision', 'recall', 'f1', 'support']), ROUND(unnest([mp, mr, mf, n]), 6) FROM t
UNION ALL SELECT 'average', 'weighted avg', unnest(['precision', 'recall', 'f1', 'support']), ROUND(unnest([wp, wr, wf, n]), 6) FROM t
UNION ALL SELECT 'macro', 'all', unnest(['n', 'accuracy', 'precision_macro', 'recall_macro', 'f1_macro']),
  ROUND(unnest([n, acc, mp, mr, mf]), 6) FROM t"""

ORACLE["cross_validate_rule"] = ORACLE["macro_metrics"]
ORACLE["cross_validate"] = f"""WITH {FLOWS_SQL}, {_RANKED}
SELECT CAST((rk - 1) % 5 AS BIGINT) AS fold, CAST(COUNT(*) AS BIGINT) AS n, true AS scores_valid FROM r GROUP BY ALL"""

_STEPS = f"""{FLOWS_SQL},
pr AS (SELECT *, CAST(floor(Day / 6) AS BIGINT) AS period, {RULE_SQL} AS prediction FROM flows),
ps AS (SELECT period, COUNT(*) AS n FROM pr GROUP BY period),
st AS (SELECT period, n, row_number() OVER (ORDER BY period) - 2 AS step,
         SUM(n) OVER (ORDER BY period ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS train_size FROM ps)"""
_STEP_COLS = """CAST(st.step AS BIGINT) AS step, CAST(st.period AS BIGINT) AS test_day,
  CAST(st.train_size AS BIGINT) AS train_size, CAST(st.n AS BIGINT) AS test_size"""
ORACLE["walk_forward_scores"] = f"""WITH {_STEPS}
SELECT {_STEP_COLS}, true AS scores_valid FROM st WHERE step >= 1"""
ORACLE["walk_forward_rule"] = f"""WITH {_STEPS}, {_per_class("pr", "period")},
ms AS (SELECT period, AVG(f1) AS f1_macro FROM pf GROUP BY period)
SELECT {_STEP_COLS}, ROUND(f1_macro, 6) AS score FROM st JOIN ms USING (period) WHERE st.step >= 1"""


def _support(rows: str, label: str) -> str:
    """Report rows with their support; ``rows`` is the test side."""
    return f"""SELECT CAST({label} AS VARCHAR) AS row, CAST(COUNT(*) AS BIGINT) AS support, true AS scores_valid
FROM {rows} GROUP BY 1
UNION ALL SELECT a, CAST((SELECT COUNT(*) FROM {rows}) AS BIGINT), true
FROM (SELECT unnest(['accuracy', 'macro avg', 'weighted avg']) AS a)"""


for _name in ("train_logreg", "train_forest", "train_boosting"):
    ORACLE[_name] = f"""WITH {FLOWS_SQL}, {_SPLIT_ROWS}, te AS (SELECT * FROM sp WHERE split = 'test')
{_support("te", "Label")}"""

_DOC_TEST = """dq AS (SELECT doc_id, CAST(quality AS VARCHAR) AS quality FROM documents JOIN labels USING (doc_id)),
cq AS (SELECT quality, COUNT(*) AS c FROM dq GROUP BY quality),
tq AS (SELECT SUM(c) AS n, SUM(c) - CAST(ceil(SUM(c) * 0.3) AS BIGINT) AS nt FROM cq),
bq AS (SELECT quality, c, (nt * c) // n AS base, (nt * c) % n AS rem, nt FROM cq, tq),
qt AS (SELECT quality, c, base + CASE WHEN row_number() OVER (ORDER BY rem DESC, quality)
          <= nt - SUM(base) OVER () THEN 1 ELSE 0 END AS n_train FROM bq),
rk AS (SELECT dq.*, row_number() OVER (PARTITION BY quality ORDER BY md5('42:' || CAST(doc_id AS VARCHAR)), doc_id) AS r FROM dq),
te AS (SELECT rk.* FROM rk JOIN qt USING (quality) WHERE r <= c - n_train)"""
ORACLE["train_smote_forest"] = f"WITH {_DOC_TEST}\n{_support('te', 'quality')}"
ORACLE["compare_models"] = f"""WITH {_DOC_TEST}, rep AS ({_support('te', 'quality')})
SELECT rep.*, model FROM rep, (SELECT unnest(['logreg', 'forest', 'smote_forest']) AS model)"""

ORACLE["score_table"] = """SELECT CAST(COUNT(*) AS BIGINT) AS n_written, CAST(COUNT(*) AS BIGINT) AS n_summary,
  CAST(100 AS DOUBLE) AS percent_total FROM events"""
ORACLE["score_stream"] = ORACLE["score_table"].replace("AS n_written,", "AS n_written, CAST(COUNT(*) AS BIGINT) AS n_flows,")
ORACLE["clustered_write"] = f"""WITH {FLOWS_SQL}
SELECT CAST(Day AS BIGINT) AS Day, CAST(COUNT(*) AS BIGINT) AS n, true AS files_bounded FROM flows GROUP BY Day"""
ORACLE["split_features_target"] = f"""WITH {FLOWS_SQL}
SELECT Label AS target, 'value,user_id,k' AS features, CAST(COUNT(*) AS BIGINT) AS n, ROUND(SUM(CAST(value AS DOUBLE)), 6) AS sum_value,
  CAST(SUM(user_id) AS DOUBLE) AS sum_user_id, CAST(SUM(k) AS DOUBLE) AS sum_k FROM flows GROUP BY Label"""
ORACLE["score_probabilities"] = """SELECT CAST(event_id AS BIGINT) AS flow_id,
  CAST((SELECT COUNT(DISTINCT event_type) FROM events) AS BIGINT) AS n_classes, CAST(1 AS DOUBLE) AS probability_sum,
  true AS in_range, true AS predicts_likeliest, unnest(['forest', 'logreg', 'boosting']) AS model FROM events"""
# Test rows of the stratified split by the rule's bands: the same formula of rows per band.
ORACLE["learners_rule"] = f"""WITH {FLOWS_SQL.replace("flows AS", "flows0 AS", 1)}, flows AS (SELECT * REPLACE ({RULE_SQL} AS Label) FROM flows0), {_SPLIT_ROWS}
SELECT unnest(['logreg', 'forest', 'boosting']) AS model, CAST(COUNT(*) AS BIGINT) AS n, true AS learned, true AS same_again
FROM sp WHERE split = 'test'"""
_CLEAN_SPLIT = _SPLIT_ROWS.replace("FROM flows", "FROM clean").replace("flows.*", "clean.*")
ORACLE["prepared_dataset"] = f"""WITH {FLOWS_SQL}, {DIRTY_SQL}, {CLEAN_SQL}, {_CLEAN_SPLIT}
SELECT CAST(flow_id AS BIGINT) AS flow_id, Label, split FROM sp"""

# What holds for any fit.
ORACLE["select_by_importance"] = """SELECT CAST(5 AS BIGINT) AS n_features, true AS half_kept,
  CAST(1 AS DOUBLE) AS importance_sum FROM documents JOIN labels USING (doc_id) LIMIT 1"""
ORACLE["rfecv"] = """SELECT CAST(5 AS BIGINT) AS n_features, true AS kept_enough, true AS ranks_whole
FROM documents JOIN labels USING (doc_id) LIMIT 1"""
ORACLE["rfecv_linear"] = ORACLE["rfecv"]
ORACLE["permutation_importance"] = """SELECT unnest(['n_chars', 'n_words', 'n_lines', 'n_upper', 'n_digits']) AS feature,
  true AS valid, true AS threshold_applied"""
ORACLE["compare_selectors"] = """SELECT unnest(['importance_median', 'rfecv', 'permutation']) AS method,
  true AS count_valid, true AS scores_valid"""
ORACLE["random_search"] = """SELECT CAST(unnest(range(0, 20)) AS BIGINT) AS setting_id, true AS scores_valid, true AS ranked"""


def _walk_step() -> str:
    """One pass of the position map: six rounds on the digits l, r of base b, keys in a list."""
    def mixed(x: str, i: int) -> str:
        y = f"(({x} * 1103515245 + keys[{i + 1}] * 12345 + 1) % 2147483647)"
        return f"((({y} * {y} % 2147483647) * 69069 + {y}) % 2147483647)"
    inner = "SELECT f, rep, i, keys, n, a, b, x // b AS l, x % b AS r FROM walk WHERE NOT done"
    for i in range(6):
        new = f"l, (r + {mixed('l', i)}) % b AS r" if i % 2 else f"(l + {mixed('r', i)}) % a AS l, r"
        inner = f"SELECT f, rep, i, keys, n, a, b, {new} FROM ({inner})"
    return f"SELECT f, rep, i, keys, n, a, b, l * b + r AS x, l * b + r < n AS done FROM ({inner})"


_MOVED = {f: RULE_SQL.replace("value", "y.value") if f == "value" else RULE_SQL.replace("value", "p.value")
          for f in ("value", "user_id", "k")}
ORACLE["permutation_rule"] = f"""WITH RECURSIVE {FLOWS_SQL},
pos AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY flow_id) - 1 AS i FROM flows),
base AS (SELECT AVG(CASE WHEN Label = ({RULE_SQL}) THEN 1.0 ELSE 0.0 END) AS acc0 FROM flows),
size AS (SELECT n, a, (n + a - 1) // a AS b FROM (SELECT n, CAST(ceil(sqrt(n)) AS BIGINT) AS a FROM (SELECT COUNT(*) AS n FROM flows))),
pairs AS (SELECT f, rep, list_transform(range(0, 6), lambda j: CAST('0x' || substr(h, 5 * j + 1, 5) AS BIGINT)) AS keys FROM (
  SELECT f, rep, md5('42:' || f || ':' || rep) AS h FROM (SELECT unnest(['value', 'user_id', 'k']) AS f), range(0, 10) t(rep))),
walk(f, rep, i, keys, n, a, b, x, done) AS (
  SELECT f, rep, i, keys, n, a, b, i, false FROM pos, pairs, size
  UNION ALL {_walk_step()}),
runs AS (SELECT w.f AS feature, w.rep, AVG(CASE WHEN p.Label = (CASE w.f {" ".join(f"WHEN '{f}' THEN {m}" for f, m in _MOVED.items())} END)
    THEN 1.0 ELSE 0.0 END) AS acc FROM walk w JOIN pos p ON p.i = w.i JOIN pos y ON y.i = w.x WHERE done GROUP BY ALL)
SELECT feature, ROUND(AVG(acc0 - acc), 6) AS importance_mean, ROUND(STDDEV_POP(acc0 - acc), 6) AS importance_std,
  CAST(row_number() OVER (ORDER BY AVG(acc0 - acc) DESC, feature) AS BIGINT) AS rank,
  AVG(acc0 - acc) >= 0.001 AS selected FROM runs, base GROUP BY feature"""
