"""Column expressions shared by the operators (all JVM-side, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The replacement character found in mis-decoded labels, and the
# blank pattern collapsed to one space.
REPLACEMENT_CHAR = "�"
BLANK_RUN = r"\s+"

# The strings the reference's CSV reader treats as missing in text
# columns (pandas default na_values).
NA_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
             "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
             "nan", "null"]


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def q(name: str) -> Column:
    """Column by exact name, even with blanks or dots in it."""
    return F.col(f"`{name}`")


def finite_or_null(c: str | Column) -> Column:
    """+inf / -inf -> null; other values unchanged (NaN stays NaN)."""
    c = col_of(c)
    return F.when(F.abs(c) == F.lit(float("inf")), F.lit(None)).otherwise(c)


def repaired_label(c: str | Column) -> Column:
    """U+FFFD -> blank, runs of blanks -> one blank, trim both ends."""
    c = col_of(c)
    return F.trim(F.regexp_replace(F.replace(c, F.lit(REPLACEMENT_CHAR), F.lit(" ")),
                                   BLANK_RUN, " "))


def seeded_hash(seed: int | str, *keys: str | Column) -> Column:
    """Deterministic pseudo-random order key: md5('<seed>:' || key...).

    md5 of the same text gives the same order in any engine, so a seeded shuffle
    is reproducible and checkable in SQL.
    """
    parts = [F.lit(f"{seed}:")]
    for i, k in enumerate(keys):
        if i:
            parts.append(F.lit(":"))
        parts.append(col_of(k).cast("string"))
    return F.md5(F.concat(*parts))


def hash_unit(seed: int | str, *keys: str | Column) -> Column:
    """Deterministic number in [0, 1) from the first 13 hex digits of the md5."""
    h = seeded_hash(seed, *keys)
    return F.conv(F.substring(h, 1, 13), 16, 10).cast("double") / F.lit(float(16 ** 13))


def ks_pvalue(d: str | Column, n: str | Column, m: str | Column, terms: int = 100) -> Column:
    """Asymptotic two-sample KS tail: Q(l) = 2 sum_j (-1)^(j-1) exp(-2 j^2 l^2),
    l = D sqrt(nm/(n+m)); 1 for l < 0.2 where the series converges slowly and
    Q is 1 to many places."""
    d, n, m = col_of(d), col_of(n).cast("double"), col_of(m).cast("double")
    lam = d * F.sqrt(n * m / (n + m))
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)), F.lit(0.0).cast("double"),
        lambda acc, j: acc + F.pow(F.lit(-1.0), j - 1) * F.exp(
            F.lit(-2.0) * j * j * lam * lam))
    p = F.least(F.greatest(F.lit(2.0) * series, F.lit(0.0)), F.lit(1.0))
    return F.when(lam < 0.2, F.lit(1.0)).otherwise(p)


def r6(c: str | Column) -> Column:
    """Round a float result to 6 places (the oracle's comparison precision)."""
    return F.round(col_of(c).cast("double"), 6)


def pct_text(c: str | Column) -> Column:
    """0.1234 -> '12.3%' (rounded first, so no engine-specific tie rule applies)."""
    return F.format_string("%.1f%%", F.round(col_of(c) * 100.0, 1))
