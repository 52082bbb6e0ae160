"""Grouping, pivoting, global summaries and arg-max."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pivot_sum(df: DataFrame, keys: Sequence[str], pivot_col: str, values: Sequence[str],
              value: str | None = None, fill: int | float | None = 0,
              cast: str | None = "bigint") -> DataFrame:
    """A3: ``groupBy(keys).pivot(col, values).sum(value)``; absent -> ``fill``.

    Written as one conditional aggregate per listed value, so it is a single
    partial + final aggregation with one shuffle (the built-in pivot groups
    by (keys, pivot value) first and shuffles twice). Values outside the list
    are ignored, as with an explicit pivot list. ``value=None`` counts rows.
    """
    p = F.col(pivot_col)
    aggs = []
    for v in values:
        if value is None:
            a = F.count(F.when(p == F.lit(v), F.lit(1)))
        else:
            a = F.sum(F.when(p == F.lit(v), F.col(value)))
        if cast:
            a = a.cast(cast)
        if fill is not None:
            a = F.coalesce(a, F.lit(fill).cast(cast) if cast else F.lit(fill))
        aggs.append(a.alias(v))
    return df.groupBy(*keys).agg(*aggs)


def summary(df: DataFrame, mean_col: str, sum_cols: Sequence[str], flag_col: str,
            mean_digits: int = 3) -> DataFrame:
    """A5: one-row summary: rounded mean, sums, conditional count, row count."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.round(F.avg(mean_col), mean_digits).alias(f"avg_{mean_col}"),
        *[F.sum(c).cast("bigint").alias(f"sum_{c}") for c in sum_cols],
        F.count_if(F.col(flag_col)).alias(f"n_{flag_col}"),
    )


def arg_max(df: DataFrame, score: str, ties: Sequence[str], cols: Sequence[str] | None = None,
            group_by: Sequence[str] = ()) -> DataFrame:
    """The row with the greatest ``score``, optionally per group; ties
    go to the least ``ties`` columns in order. ``min_by`` aggregates partially,
    so this never collects a group into one task."""
    cols = list(cols or df.columns)
    packed = F.struct(*[F.col(f"`{c}`") for c in cols])
    agg = df.where(F.col(score).isNotNull()).groupBy(*group_by).agg(
        F.min_by(packed, F.struct((-F.col(score)).alias("__s"), *ties)).alias("__r"))
    return agg.where(F.col("__r").isNotNull()).select(*group_by, *[F.col("__r").getField(c).alias(c) for c in cols])
