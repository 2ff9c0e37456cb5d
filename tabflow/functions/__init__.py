"""Column expressions. All built-in Spark functions, so they
stay inside whole-stage codegen; no Python UDF anywhere."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half(c: ColumnOrName, digits: int) -> Column:
    """Round to ``digits`` decimals as ``round(x * 10^d) / 10^d``.

    ``F.round(x, d)`` rounds the decimal text of the double and disagrees with
    the SQL engines of the reference near ties (57/800 -> 0.0713 instead of
    0.0712); scaling first matches them.
    """
    scale = float(10**digits)
    return F.round(_c(c) * F.lit(scale)) / F.lit(scale)


def ratio(num: ColumnOrName, den: ColumnOrName, digits: int | None = 4) -> Column:
    """``num / den`` as a double, rounded; null when ``den`` is 0 or null."""
    q = F.when(_c(den) != 0, _c(num).cast("double") / _c(den).cast("double"))
    return q if digits is None else round_half(q, digits)


def safe_ratio(num: ColumnOrName, den: ColumnOrName, default: float = 0.0) -> Column:
    """Overall rate: ``num / den``, or ``default`` when ``den`` is 0 or null."""
    return F.coalesce(ratio(num, den, None), F.lit(float(default)))


def nan_to_null(c: ColumnOrName) -> Column:
    """Turn NaN into null so aggregates skip it like pandas does."""
    return F.nanvl(_c(c).cast("double"), F.lit(None).cast("double"))


def clean_avg(c: ColumnOrName) -> Column:
    """Mean that skips both null and NaN (pandas ``mean``); Spark's ``avg``
    alone would propagate NaN."""
    return F.avg(nan_to_null(c))


# Fixed value: what counts as a number in text. Spark's own cast would also take Java's type suffixes and hexadecimal.
NUMBER = r"^\s*[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?|(?i:inf|infinity|nan))\s*$"


def strict_double(c: ColumnOrName) -> Column:
    """Cast to double and fail on text that is not a number ('abc', '', '5.2d',
    '0x1p3', '1_0').

    Independent of ``spark.sql.ansi.enabled``: text must match ``NUMBER``, the
    value is converted with ``try_cast``, and a non-null input that yields
    null raises.
    """
    src = _c(c)
    casted = F.when(src.cast("string").rlike(NUMBER), src.try_cast("double"))
    return F.when(
        src.isNotNull() & casted.isNull(),
        F.raise_error(F.concat(F.lit("cannot cast to double: '"), src.cast("string"), F.lit("'"))),
    ).otherwise(casted)


def as_double(df: DataFrame, column: str) -> Column:
    """``column`` of ``df`` as a double: untouched when it already is one,
    ``strict_double`` otherwise (so the plan carries no no-op guard)."""
    c = F.col(f"`{column}`")
    if isinstance(df.schema[column].dataType, T.DoubleType):
        return c
    return strict_double(c)


def bucket_label(c: ColumnOrName, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the right-closed interval ``(edges[i], edges[i+1]]`` holding the
    value; null for NaN, null, and values outside ``(edges[0], edges[-1]]``."""
    if len(edges) != len(labels) + 1:
        raise ValueError("need exactly one more edge than labels")
    x = _c(c)
    expr = None
    for lo, hi, label in zip(edges[:-1], edges[1:], labels):
        cond = (x > F.lit(float(lo))) & (x <= F.lit(float(hi)))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return F.when(~F.isnan(x.cast("double")), expr)


def ordinal(c: ColumnOrName, order: Sequence[str], default: int = 99) -> Column:
    """Position of the value in ``order``; ``default`` for anything else."""
    pairs = []
    for i, v in enumerate(order):
        pairs += [F.lit(v), F.lit(i)]
    return F.coalesce(F.create_map(*pairs)[_c(c)], F.lit(default))


def fmt_count(c: ColumnOrName) -> Column:
    """Integer with thousands separators: ``1,234,567``."""
    return F.format_number(_c(c), 0)


def fmt_decimal(c: ColumnOrName, digits: int = 2) -> Column:
    """Fixed decimals without separators, like Python's ``f"{x:.2f}"``."""
    return F.regexp_replace(F.format_number(_c(c), digits), ",", "")


def fmt_half_even(c: ColumnOrName, digits: int = 2) -> Column:
    """Fixed decimals with separators, like Python's ``f"{x:,.0f}"``:
    ``1,234``. ``format_number`` rounds the same way, half to even."""
    return F.format_number(_c(c).cast("double"), digits)


def fmt_pct(c: ColumnOrName, digits: int = 2) -> Column:
    """A ratio as percent text: 0.3807 -> ``38.07%``."""
    return F.concat(fmt_decimal(_c(c) * F.lit(100.0), digits), F.lit("%"))
