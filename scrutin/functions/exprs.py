"""Column expressions.

All JVM-side built-ins, so they stay inside whole-stage code generation.
Every function takes and returns a ``Column``; none triggers a job.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from scrutin import schema as S

#: White space as Unicode has it, no-break spaces and separators included: ``[\s\x1C-\x1F\x85\p{Z}]``.
_WS = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
                        0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round2(c: str | Column) -> Column:
    """Round half to even at 2 decimals, exactly as ``numpy.round(x, 2)``.

    NumPy scales by 100, rounds to the nearest even integer and scales
    back; ``rint`` does the same on the same IEEE values (``round`` and
    ``bround`` go through decimals and differ on some ratios).
    """
    return F.rint(col(c) * 100) / 100


def guarded_pct(num: str | Column, den: str | Column) -> Column:
    """``round2(num / den * 100)`` when ``den > 0``, else 0."""
    n, d = col(num).cast("double"), col(den).cast("double")
    return F.when(d > 0, round2(n / d * 100)).otherwise(F.lit(0.0))


def safe_ratio(num: str | Column, den: str | Column) -> Column:
    """``num / den`` as double, null when ``den`` is 0 or null (no ANSI error)."""
    return F.try_divide(col(num).cast("double"), col(den).cast("double"))


def strip(c: str | Column) -> Column:
    """Remove leading and trailing white space (tabs and new lines too)."""
    return F.btrim(col(c), F.lit(_WS))


def to_double(c: str | Column) -> Column:
    """Parse to double; unparsable text and NaN become null."""
    parsed = col(c).try_cast("double")
    return F.nanvl(parsed, F.lit(None).cast("double"))


def to_int(c: str | Column) -> Column:
    """Parse to int through double (``'12.0'`` is 12); bad values are null."""
    return to_double(c).try_cast("int")


def to_count(c: str | Column, default: int = 0) -> Column:
    """Parse a vote count to long; unparsable or missing becomes ``default``."""
    return F.coalesce(to_double(c).try_cast("long"), F.lit(default).cast("long"))


def pad2(c: str | Column) -> Column:
    """Zero-pad a department code to two characters, never truncating."""
    s = col(c).cast("string")
    return F.when(F.length(s) < 2, F.lpad(s, 2, "0")).otherwise(s)


def normalise_label(c: str | Column) -> Column:
    """Strip, upper-case, and map null/blank/'NAN'/'NULL' to 'AUTRE'."""
    cleaned = F.upper(strip(col(c).cast("string")))
    return (F.when(cleaned.isNull() | cleaned.isin(*S.EMPTY_LABELS), F.lit(S.OTHER_LABEL))
            .otherwise(cleaned))


def family(c: str | Column, rules: Sequence[tuple[str, Sequence[str]]] = S.FAMILY_RULES) -> Column:
    """Political family of an upper-case label: ordered substring rules, first wins."""
    label = col(c)
    expr = F.when(label.isNull() | (label == S.OTHER_LABEL), F.lit(S.OTHER_FAMILY))
    for name, fragments in rules:
        hit = None
        for frag in fragments:
            test = label.contains(frag)
            hit = test if hit is None else (hit | test)
        expr = expr.when(hit, F.lit(name))
    return expr.otherwise(F.lit(S.OTHER_FAMILY))


def lookup(c: str | Column, mapping: Mapping, default=None) -> Column:
    """CASE lookup of a small constant mapping (no join, no shuffle)."""
    key = col(c)
    expr = None
    for k, v in mapping.items():
        expr = F.when(key == F.lit(k), F.lit(v)) if expr is None else expr.when(key == F.lit(k), F.lit(v))
    if expr is None:
        return F.lit(default)
    return expr.otherwise(F.lit(default))


def department_name(c: str | Column = S.DEPT) -> Column:
    return lookup(c, S.DEPARTMENT_NAMES, S.UNKNOWN_DEPARTMENT)


def bin_right_closed(c: str | Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Right-closed bins ``(lo, hi]``; values outside every bin are null."""
    x = col(c)
    expr = None
    for lo, hi, name in zip(edges[:-1], edges[1:], labels):
        cond = (x > F.lit(lo)) & (x <= F.lit(hi))
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr


def clip(c: str | Column, lo: float | None, hi: float | None) -> Column:
    """Bound a value to ``[lo, hi]``; null stays null."""
    x = col(c)
    out = x
    if lo is not None:
        out = F.when(out < F.lit(lo), F.lit(lo)).otherwise(out)
    if hi is not None:
        out = F.when(out > F.lit(hi), F.lit(hi)).otherwise(out)
    return out
