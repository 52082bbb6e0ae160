"""Ranking without a single-task window.

``rank(df, score)`` returns SQL ``rank()`` (gaps on ties) or ``dense_rank()``
over the whole table ordered by ``score`` (descending by default, NULLs
last). The *distinct* scores are counted, range-partitioned and stored once;
a rank is the count of the ranges ahead plus the running count within the
range. Rows of hot scores get their rank by a broadcast join, so they are not
shuffled; the others look it up by a shuffle join on the score.
``rank_within`` does the same inside groups of any size.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import store

# A score that holds more than 1/HOT_FRACTION of the rows is hot; there are
# fewer than HOT_FRACTION of them, which bounds their broadcast.
HOT_FRACTION = 10_000


def rank(df: DataFrame, score: str, out: str = "rank", descending: bool = True,
         dense: bool = False, buckets: int | None = None) -> DataFrame:
    """Whole-table ``rank()`` / ``dense_rank()`` by ``score``, NULLs last.

    ``buckets`` (default: the session's shuffle partitions) is the number of
    ranges of distinct scores. Only one row per range reaches the driver. NULL
    is one more value after all others. The data is read three times (counts,
    rows of hot scores, other rows)."""
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    v = F.col("v")
    order = v.desc_nulls_last() if descending else v.asc_nulls_last()
    counts = df.groupBy(F.col(score).alias("v")).agg(F.count(F.lit(1)).alias("cnt"))
    values = store(counts.repartitionByRange(buckets, order).withColumn("bucket", F.spark_partition_id()),
                   "rank-values")
    offsets, rows, ahead = [], 0, 0
    sizes = sorted(map(tuple, values.groupBy("bucket").agg(F.sum("cnt"), F.count(F.lit(1))).collect()))
    for b, n, d in sizes:
        offsets.append((b, ahead))
        rows += n
        ahead += d if dense else n
    before = Window.partitionBy("bucket").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    local = F.count(F.lit(1)) if dense else F.coalesce(F.sum("cnt").over(before), F.lit(0))
    if dense:
        local = local.over(before)
    ranked = values.join(F.broadcast(spark.createDataFrame(offsets, "bucket int, ahead bigint")), "bucket").select(
        v.alias("__v"), "cnt", (F.col("ahead") + local + 1).alias(out))
    return _attach(df, ranked, F.col(score).eqNullSafe(F.col("__v")), rows, sum(d for _, _, d in sizes)).drop("__v")


def _attach(df: DataFrame, ranked: DataFrame, same: Column, rows: int, distinct: int) -> DataFrame:
    """``df`` joined to ``ranked`` (``cnt`` rows each) on ``same``: by one broadcast
    where there are no more distinct values than hot ones there may be, else
    hot values by broadcast and the others by a shuffle join."""
    if distinct <= HOT_FRACTION:
        return df.join(F.broadcast(ranked.drop("cnt")), same)
    is_hot = F.col("cnt") * HOT_FRACTION > rows
    hot = F.broadcast(ranked.where(is_hot).drop("cnt"))
    of_hot = df.join(hot, same)
    others = df.join(hot, same, "left_anti").join(ranked.where(~is_hot).drop("cnt"), same)
    return of_hot.unionByName(others)


def rank_within(df: DataFrame, group: Sequence[str], score: str, out: str = "rank", descending: bool = True,
                dense: bool = False, buckets: int | None = None) -> DataFrame:
    """``rank()`` / ``dense_rank()`` by ``score`` (NULLs last) within the values of
    the columns ``group``, where a group may hold any share of the rows.

    The distinct (group, score) pairs are counted, range-partitioned by both and
    stored: a large group spreads over several ranges. Only a group that crosses
    the border of a range needs the counts of the ranges ahead, and there are at
    most 2 x ``buckets`` such (group, range) pairs, which are broadcast. NULL is
    a group like any other; an empty table gives no rows."""
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [f"__g{i}" for i in range(len(group))]
    v = F.col("__v")
    order = v.desc_nulls_last() if descending else v.asc_nulls_last()
    counts = df.groupBy(*[F.col(f"`{g}`").alias(k) for g, k in zip(group, keys)], F.col(f"`{score}`").alias("__v")).agg(
        F.count(F.lit(1)).alias("cnt"))
    values = store(counts.repartitionByRange(buckets, *keys, order).withColumn("bucket", F.spark_partition_id()),
                   "rank-within")
    size = values.agg(F.sum("cnt"), F.count(F.lit(1))).first()
    spans = values.groupBy(*keys).agg(F.min("bucket").alias("lo"), F.max("bucket").alias("hi")).where("lo < hi")
    parts = values.join(F.broadcast(spans.drop("lo", "hi")), _same(values, spans, keys), "left_semi")
    before = Window.partitionBy(*keys).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    ahead = parts.groupBy(*keys, "bucket").agg(F.count(F.lit(1)).alias("d") if dense else F.sum("cnt").alias("d")).select(
        *[F.col(k).alias(f"{k}a") for k in keys], F.col("bucket").alias("__b"),
        F.coalesce(F.sum("d").over(before), F.lit(0)).alias("ahead"))
    held = values.join(F.broadcast(ahead), reduce(and_, [F.col(k).eqNullSafe(F.col(f"{k}a")) for k in keys])
                       & (F.col("bucket") == F.col("__b")), "left")
    inside = Window.partitionBy("bucket", *keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    local = (F.count(F.lit(1)) if dense else F.sum("cnt")).over(inside)
    ranked = held.select(*keys, "__v", "cnt",
                         (F.coalesce("ahead", F.lit(0)) + F.coalesce(local, F.lit(0)) + 1).alias(out))
    same = reduce(and_, [F.col(f"`{g}`").eqNullSafe(F.col(k)) for g, k in zip(group, keys)]) & F.col(
        f"`{score}`").eqNullSafe(v)
    return _attach(df, ranked, same, size[0] or 0, size[1]).drop(*keys, "__v")


def _same(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(and_, [a[k].eqNullSafe(b[k]) for k in keys])


def ordinal_by(df: DataFrame, key: str, value: str, out: str = "ordinal",
               cap: int | None = None) -> DataFrame:
    """0-based position of each row of a *small* frame (one row per
    group, e.g. per cluster) ordered by ``value`` then ``key``, capped at
    ``cap``. The input is an aggregate over a bounded set of groups."""
    w = Window.orderBy(F.col(value).asc_nulls_first(), F.col(key).asc())
    pos = F.row_number().over(w) - 1
    if cap is not None:
        pos = F.least(pos, F.lit(cap))
    return df.withColumn(out, pos.cast("int"))
