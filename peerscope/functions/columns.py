"""Column builders. All are built-in expressions: they stay inside whole-stage codegen."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_divide(num: Column, den: Column) -> Column:
    """num / den, NULL when den is 0 or NULL (ANSI Spark would raise on /0)."""
    return num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))


def rounded_ratio(k: Column, n: Column, decimals: int) -> Column:
    """k / n rounded half-up to ``decimals`` places, computed exactly on integers.

    round(k/n, d) on a double differs between engines when k/n sits exactly on a half
    (n=800, k=57 gives 0.07125). Working on integers removes the ambiguity:
        q = floor((2*k*10^d + n) / (2*n)),  result = q / 10^d.
    The quotient is an integral division, so nothing is ever rounded through a double.
    """
    scale = 10 ** decimals
    num = k.cast("long") * F.lit(2 * scale) + n.cast("long")
    den = n.cast("long") * F.lit(2)
    q = F.call_function("div", num - F.pmod(num, den), den)
    return q.cast("double") / F.lit(float(scale))


def title_case(s: Column) -> Column:
    """Python ``str.title`` semantics: every run of letters is capitalised on its own.

    ``initcap`` only splits on spaces ("O'NEIL" -> "O'neil"); splitting into letter and
    non-letter runs first gives "O'Neil Smith-Jones" like Python.
    """
    runs = F.regexp_extract_all(s, F.lit(r"(\p{L}+|\P{L}+)"), 1)
    return F.array_join(F.transform(runs, lambda x: F.initcap(x)), "")


def monotone(*cols: Column) -> Column:
    """c1 <= c2 AND c2 <= c3 AND ... (the breakpoint chain)."""
    pairs = [a <= b for a, b in zip(cols, cols[1:])]
    return reduce(lambda x, y: x & y, pairs)


def null_safe_equal(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def normalised(s: Column) -> Column:
    """upper(trim(s)) — the normalised form used by agreement checks."""
    return F.upper(F.trim(s))
