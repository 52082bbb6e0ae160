"""Row filters, NULL filling and deterministic deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import normalize


def keep_non_negative(df: DataFrame, col: str) -> DataFrame:
    """P5: not NULL and >= 0."""
    return df.where(F.col(col).isNotNull() & (F.col(col) >= 0))


def keep_positive(df: DataFrame, col: str) -> DataFrame:
    """Not NULL and > 0."""
    return df.where(F.col(col).isNotNull() & (F.col(col) > 0))


def keep_in(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """Whitelist."""
    return df.where(F.col(col).isin(list(values)))


def drop_sentinels(df: DataFrame, col: str | Column, values: Sequence[str] = (),
                   prefixes: Sequence[str] = ()) -> DataFrame:
    """P7 + P8: drop rows whose normalised value is NULL, in ``values``, or
    starts with one of ``prefixes`` (total rows, blanks, footnotes)."""
    key = normalize(col)
    cond = key.isNotNull()
    if values:
        cond = cond & ~key.isin(list(values))
    for p in prefixes:
        cond = cond & ~key.startswith(p)
    return df.where(cond)


def dedupe_latest(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """A1, deterministic: one row per key, the greatest by ``order_by`` and
    then by all remaining columns.

    Written as ``max(struct(...))`` per key. The aggregate has a map-side
    partial step (sort-based, as the buffer is a struct), so a key repeated
    across a third of the input is reduced inside each task before the shuffle.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    ordered = list(order_by) + rest
    packed = F.struct(*[F.col(f"`{c}`") for c in ordered])
    agg = df.groupBy(*keys).agg(F.max(packed).alias("__row"))
    return agg.select(*keys, *[F.col("__row").getField(c).alias(c) for c in ordered]).select(*df.columns)
