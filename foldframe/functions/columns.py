"""Null-safe scalar column helpers.

Rules (so that Spark agrees with the pandas semantics of the listing model):
NaN never survives a helper (it becomes NULL), clipping keeps NULL, and
division by zero yields NULL instead of raising under ANSI mode.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c: str | Column) -> Column:
    return F.nanvl(col_of(c), F.lit(None).cast("double"))


def to_double(c: str | Column) -> Column:
    """Coerce anything to double; unparsable text and NaN become NULL."""
    return nan_to_null(col_of(c).try_cast("double"))


def to_integral(c: str | Column) -> Column:
    """Coerce to bigint when the value is a whole number, else NULL."""
    d = to_double(c)
    return F.when(d == F.floor(d), d.cast("bigint"))


def clip(c: str | Column, lower: float | None = None, upper: float | None = None) -> Column:
    """pandas `clip`: bounds applied, NULL kept (never least/greatest)."""
    x = col_of(c)
    out = x
    if lower is not None:
        out = F.when(x < F.lit(lower), F.lit(float(lower))).otherwise(out)
    if upper is not None:
        out = F.when(x > F.lit(upper), F.lit(float(upper))).otherwise(out)
    return out


def safe_div(num: str | Column, den: str | Column) -> Column:
    """Division that yields NULL for a zero denominator (pandas gives inf,
    which the listing features turn into missing)."""
    return F.try_divide(col_of(num).cast("double"), col_of(den).cast("double"))


def flag(cond: Column) -> Column:
    """0/1 integer flag; a NULL comparison counts as 0 (pandas astype(int8))."""
    return F.coalesce(cond, F.lit(False)).cast("int")


def nullable_flag(cond: Column) -> Column:
    """0.0/1.0 flag that stays NULL when the input was missing."""
    return cond.cast("double")


def bin_by_edges(x: str | Column, edges: Sequence[float], labels: Sequence[str],
                 missing_label: str | None, lowest_open: bool = True) -> Column:
    """Right-closed binning: label i covers (edges[i-1], edges[i]]; the last
    label covers (edges[-1], inf). Missing input gives `missing_label`."""
    if len(labels) != len(edges) + 1:
        raise ValueError("need one more label than edges")
    v = col_of(x)
    expr = None
    for edge, label in zip(edges, labels[:-1]):
        expr = (F.when(v <= F.lit(edge), F.lit(label)) if expr is None
                else expr.when(v <= F.lit(edge), F.lit(label)))
    expr = expr.otherwise(F.lit(labels[-1]))
    out = F.when(v.isNull(), F.lit(missing_label)).otherwise(expr)
    return out


def edges_below(name: str, edges: Sequence[float]) -> Column:
    """Number of the ascending `edges` that lie below a column's value, by bisection; missing
    -> 0 (NaN is above all). As SQL text: hundreds of nested column objects are slow to make."""
    def count(first: int, last: int) -> str:
        if first == last:
            return str(first)
        middle = (first + last) // 2
        return f"CASE WHEN `{name}` > double('{float(edges[middle])!r}') THEN {count(middle + 1, last)} ELSE {count(first, middle)} END"

    return F.expr(count(0, len(edges)))


def bin_code_by_edges(x: str | Column, edges: Sequence[float], lower: float) -> Column:
    """Integer code of right-closed bins (lower, e0], (e0, e1], ... as double;
    NULL outside the covered range or when missing (pandas cut labels=False)."""
    v = col_of(x)
    expr = F.when(v <= F.lit(lower), F.lit(None).cast("double"))
    for i, edge in enumerate(edges):
        expr = expr.when(v <= F.lit(edge), F.lit(float(i)))
    return expr.otherwise(F.lit(None).cast("double"))


def key_text(c: str | Column) -> Column:
    """Text form of a key as pandas `astype("string")` prints it (NULL kept)."""
    return col_of(c).cast("string")


def concat_key(*parts: str | Column) -> Column:
    """`a|b|c` that is NULL when any part is NULL (pandas string `+`)."""
    cols = []
    for i, p in enumerate(parts):
        if i:
            cols.append(F.lit("|"))
        cols.append(key_text(p))
    return F.concat(*cols)
