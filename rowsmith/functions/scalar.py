"""Column-level functions. All stay inside whole-stage code generation."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(a, b) -> Column:
    """``a / b``; a zero denominator gives NULL instead of an ANSI error."""
    return F.try_divide(_col(a), _col(b))


def safe_log(c) -> Column:
    return F.log(_col(c))


def safe_log1p(c) -> Column:
    return F.log1p(_col(c))


def truth(cond: Column) -> Column:
    """A comparison where an unknown result counts as false."""
    return F.coalesce(cond, F.lit(False))


def count_true(conds) -> Column:
    """Row-wise number of conditions that hold."""
    return reduce(add, [truth(c).cast("int") for c in conds])


def count_positive(cols) -> Column:
    return count_true([_col(c) > 0 for c in cols])


def row_mean(cols) -> Column:
    """Row-wise mean over the non-null cells."""
    cols = [_col(c) for c in cols]
    total = reduce(add, [F.coalesce(c.cast("double"), F.lit(0.0)) for c in cols])
    filled = reduce(add, [c.isNotNull().cast("int") for c in cols])
    return F.try_divide(total, filled)


def split_part(c, sep: str, index: int) -> Column:
    """Zero-based piece of a delimited string; NULL when it is absent."""
    return F.get(F.split(_col(c), sep), index)


def prefix(c, n: int) -> Column:
    return F.substring(_col(c), 1, n)


def joined(sep: str, *cols) -> Column:
    """Concatenation that is NULL as soon as one part is NULL."""
    parts: list[Column] = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit(sep))
        parts.append(_col(c).cast("string"))
    return F.concat(*parts)


def count_chars(c, chars: str) -> Column:
    """How many characters of the text belong to the given set."""
    return F.length(_col(c)) - F.length(F.translate(_col(c), chars, ""))


def decade_label(year) -> Column:
    return F.concat((F.floor(_col(year) / 10) * 10).cast("bigint").cast("string"), F.lit("s"))


def parse_date(c, fmt: str) -> Column:
    """Parse text with an explicit pattern; unreadable text gives NULL."""
    return F.try_to_timestamp(_col(c), F.lit(fmt)).cast("date")


def age_in_years(birth, as_of) -> Column:
    """Whole years completed on ``as_of``, aware of the birthday."""
    birth, as_of = _col(birth), _col(as_of)
    not_yet = (F.month(as_of) * 100 + F.dayofmonth(as_of)) < (F.month(birth) * 100 + F.dayofmonth(birth))
    return F.year(as_of) - F.year(birth) - not_yet.cast("int")


def clip(c, low=None, high=None) -> Column:
    """Bound a value on both sides and keep NULL as NULL."""
    c = _col(c)
    out = c
    if low is not None:
        out = F.greatest(out, F.lit(low))
    if high is not None:
        out = F.least(out, F.lit(high))
    return F.when(c.isNotNull(), out)


def percent_error(pred, true, bound: float = 1.0) -> Column:
    return clip(ratio(pred, true) - 1, -bound, bound)


def null_if(c, value) -> Column:
    c = _col(c)
    return F.when(c == F.lit(value), F.lit(None)).otherwise(c)


def map_values(c, mapping: dict) -> Column:
    """Replace exact values; everything else passes through."""
    c = _col(c)
    out = c
    for old, new in mapping.items():
        out = F.when(c == F.lit(old), F.lit(new)).otherwise(out)
    return out


def binary_flag(cond: Column, yes=1, no=0) -> Column:
    return F.when(cond, F.lit(yes)).otherwise(F.lit(no))


def nonzero_flag(c) -> Column:
    """'1' for a non-zero value, '0' for zero."""
    return (_col(c) != 0).cast("int").cast("string")


def interval_label(low: float, high: float, lowest: bool = False) -> str:
    return f"{'[' if lowest else '('}{low:g}, {high:g}]"


def cut(c, edges, labels=None, include_lowest: bool = False) -> Column:
    """Right-closed bins ``(a, b]``; values outside every bin give NULL."""
    c = _col(c)
    edges = list(edges)
    if labels is None:
        labels = [interval_label(a, b, include_lowest and i == 0) for i, (a, b) in enumerate(zip(edges, edges[1:]))]
    inside = c >= F.lit(edges[0]) if include_lowest else c > F.lit(edges[0])
    out = None
    for upper, label in zip(edges[1:], labels):
        hit = c <= F.lit(upper)
        out = F.when(hit, F.lit(label)) if out is None else out.when(hit, F.lit(label))
    return F.when(inside, out)


def left_closed_bin(c, edges) -> Column:
    """Bin number with ``[a, b)`` bins; values beyond the ends go to the end bins."""
    c = _col(c)
    inner = list(edges)[1:-1]
    out = F.lit(0) if not inner else reduce(add, [(c >= F.lit(e)).cast("int") for e in inner])
    return F.when(c.isNotNull(), out)


def signed_power(c, lam) -> Column:
    """Yeo-Johnson transform of ``c``; ``lam`` is a number or a column."""
    c = _col(c).cast("double")
    lam = lam if isinstance(lam, Column) else F.lit(float(lam))
    pos = F.when(F.abs(lam) < 1e-12, F.log1p(c)).otherwise((F.pow(c + 1.0, lam) - 1.0) / lam)
    neg = F.when(F.abs(lam - 2.0) < 1e-12, -F.log1p(-c)).otherwise(-(F.pow(1.0 - c, 2.0 - lam) - 1.0) / (2.0 - lam))
    return F.when(c >= 0, pos).when(c < 0, neg)
