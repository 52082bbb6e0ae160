"""Numeric column functions: lenient casts, placeholder handling, guarded
ratios, composite scores and non-finite sanitising. All are ANSI-safe."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lenient_cast(c: ColumnOrName, to: str | T.DataType = "int") -> Column:
    """Malformed input becomes NULL instead of failing under ANSI. Integers
    go through decimal and truncate, so "37.0" is 37 and "12.5" is 12."""
    if to in ("int", "bigint") or isinstance(to, (T.IntegerType, T.LongType)):
        return _col(c).try_cast(T.DecimalType(38, 6)).try_cast(to)
    return _col(c).try_cast(to)


# Fixed value: the placeholder the source files use for "no value".
DEFAULT_PLACEHOLDERS = ("–",)


def placeholder_to_zero(c: ColumnOrName, placeholders: Sequence[str] = DEFAULT_PLACEHOLDERS) -> Column:
    """P10: placeholder strings become "0" on the real column, before casting."""
    col = _col(c)
    return F.when(F.trim(col).isin(list(placeholders)), F.lit("0")).otherwise(col)


def count_value(c: ColumnOrName, placeholders: Sequence[str] = DEFAULT_PLACEHOLDERS) -> Column:
    """Placeholder -> 0, lenient integer cast, NULL -> 0 (P10 + P4 + P11)."""
    return F.coalesce(lenient_cast(placeholder_to_zero(c, placeholders), "bigint"), F.lit(0))


def scale_to_int(c: ColumnOrName, factor: int = 1000) -> Column:
    """Exact unit scaling through decimal, then bigint (trap 2)."""
    d = _col(c).try_cast(T.DecimalType(18, 4))
    return (d * F.lit(factor)).try_cast("bigint")


def row_sum(cols: Iterable[ColumnOrName]) -> Column:
    """Left-to-right sum of columns (integers as bigint by their inputs)."""
    return reduce(add, [_col(c) for c in cols])


def ratio_per(numerator: ColumnOrName, denominator: ColumnOrName, per: float) -> Column:
    """``n / (d / per)`` when ``d > 0`` else NULL (double)."""
    n, d = _col(numerator), _col(denominator)
    return F.when(d > 0, n / (d / F.lit(per))).otherwise(F.lit(None).cast("double"))


def percentage(numerator: ColumnOrName, denominator: ColumnOrName) -> Column:
    """``(n / d) * 100`` when ``d > 0``."""
    n, d = _col(numerator), _col(denominator)
    return F.when(d > 0, (n / d) * F.lit(100)).otherwise(F.lit(None).cast("double"))


def weighted_score(weights: Mapping[str, float] | Sequence[tuple[ColumnOrName, float]]) -> Column:
    """P20: ``sum(col * w)`` evaluated left to right in the given order."""
    items = weights.items() if isinstance(weights, Mapping) else weights
    return reduce(add, [_col(c) * F.lit(w) for c, w in items])


def inverse(c: ColumnOrName) -> Column:
    """``1 - x``."""
    return F.lit(1.0) - _col(c)


def finite_or_null(c: ColumnOrName) -> Column:
    """NaN / +Inf / -Inf -> NULL."""
    x = _col(c)
    bad = F.isnan(x) | (x == F.lit(float("inf"))) | (x == F.lit(float("-inf")))
    return F.when(bad, F.lit(None).cast(T.DoubleType())).otherwise(x)


def sanitize(df: DataFrame) -> DataFrame:
    """P29 over a frame: every float/double column and float/double array
    element that is not finite becomes NULL. Other columns are untouched."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            out.append(finite_or_null(c).cast(f.dataType).alias(f.name))
        elif isinstance(f.dataType, T.ArrayType) and isinstance(
                f.dataType.elementType, (T.FloatType, T.DoubleType)):
            et = f.dataType.elementType
            out.append(F.transform(c, lambda x: finite_or_null(x).cast(et)).alias(f.name))
        else:
            out.append(c)
    return df.select(*out)
