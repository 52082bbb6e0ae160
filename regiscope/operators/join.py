"""Joins (J1-J5 helpers): chained left joins onto a master table with a
period policy and optional key-uniqueness check, and overlap matching."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from ..session import store

#: log2 of the entries of a theta sketch: 16,384 hashes, 128 kB a column.
LG_ENTRIES = 14
#: Standard errors on either side of a sketch's estimate.
MARGIN = 8.0


class DuplicateKeyError(ValueError):
    pass


def latest_period(df: DataFrame, keys: Sequence[str], period: str) -> DataFrame:
    """Keep only the rows of the greatest ``period`` per key (policy
    ``latest``; a key with no period at all keeps its rows). Written as a partial aggregate on the key plus a join back
    on the key (no per-key window sort); a key holding a large share of the
    rows is split by AQE's skew-join handling on the row side."""
    keys = list(keys)
    last = df.groupBy(*keys).agg(F.max(period).alias("__p"))
    return (df.join(last, keys, "inner").where(F.col(period).eqNullSafe(F.col("__p"))).drop("__p"))


def assert_unique(df: DataFrame, keys: Sequence[str], name: str = "right side") -> None:
    """Fail when ``keys`` is not unique (an action; one small aggregate)."""
    dup = df.groupBy(*keys).count().where(F.col("count") > 1).limit(1).collect()
    if dup:
        raise DuplicateKeyError(f"{name}: key {list(keys)} not unique, e.g. {dup[0].asDict()}")


def left_join_all(master: DataFrame, others: Sequence[DataFrame], on: Sequence[str],
                  check_unique: bool = False) -> DataFrame:
    """``master ⟕ d1 ⟕ d2 …`` on the same key.

    Strategy is left to Spark: small sides are broadcast after a size check
    (static statistics, or AQE at runtime from the shuffled size); anything
    larger stays a shuffle join. No unchecked broadcast hint is given.
    """
    out = master
    for i, d in enumerate(others):
        if check_unique:
            assert_unique(d, on, name=f"join input {i}")
        out = out.join(d, list(on), "left")
    return out


def best_overlap(long_df: DataFrame, reference: DataFrame, field: str = "field",
                 value: str = "value", ref_value: str = "value",
                 field_order: Sequence[str] | None = None) -> DataFrame:
    """For a long frame ``(field, value)`` find the field whose
    distinct values overlap ``reference`` the most.

    distinct -> left-semi join with the reference set -> count per field ->
    best one (ties -> earliest in ``field_order``). Returns ``field, score``;
    fields without any overlap score 0.
    """
    vals = long_df.select(field, value).where(F.col(value).isNotNull()).distinct()
    ref = reference.select(F.col(ref_value).alias("__ref")).distinct()
    hits = vals.join(ref, F.col(value) == F.col("__ref"), "left_semi")
    scores = hits.groupBy(field).agg(F.count(F.lit(1)).alias("score"))
    if field_order:  # the fields are known: no second pass over the values
        fields = long_df.sparkSession.createDataFrame([(f,) for f in field_order], f"`{field}` string")
    else:
        fields = long_df.select(field).distinct()
    scored = fields.join(scores, field, "left").na.fill(0, subset=["score"])
    if field_order:
        order_map = F.create_map(*[F.lit(x) for i, f in enumerate(field_order) for x in (f, i)])
        pos = F.coalesce(order_map[F.col(field)], F.lit(len(field_order)))
    else:
        pos = F.lit(0)
    best = scored.agg(F.max_by(F.struct(F.col(field), F.col("score")),
                               F.struct(F.col("score"), -pos)).alias("__b"))
    return best.select(F.col("__b").getField(field).alias(field),
                       F.col("__b").getField("score").alias("score"))


def overlap_bounds(df: DataFrame, fields: Sequence[str], reference: DataFrame, ref_value: str = "value",
                   lg_entries: int = LG_ENTRIES) -> dict[str, tuple[float, float]]:
    """Bounds of the number of distinct values each of ``fields`` (as strings)
    shares with ``reference``, from one theta sketch per column: one pass over
    ``df``, one row of estimates to the driver.

    Below 2^lg_entries distinct values on both sides a sketch holds every hash
    and both bounds are the number itself. Beyond, hashes are a sample of share
    2^lg_entries / distinct; the bounds are ``MARGIN`` standard errors of the
    sampled count away, with room for small counts, and no side whose sketch
    holds every hash shares more than it has."""
    def sketch(name: str) -> Column:
        # a sketch ignores empty strings
        return F.theta_sketch_agg(F.concat(F.lit("="), F.col(f"`{name}`").cast("string")), lg_entries)

    ref = reference.select(sketch(ref_value).alias("__ref"))
    made = df.select(*[sketch(f).alias(f"s{i}")
                       for i, f in enumerate(fields)])
    got = made.crossJoin(F.broadcast(ref)).select(  # one row each
        F.theta_sketch_estimate("__ref").alias("n"),
        *[F.theta_sketch_estimate(f"s{i}").alias(f"n{i}") for i in range(len(fields))],
        *[F.theta_sketch_estimate(F.theta_intersection(f"s{i}", "__ref")).alias(f"b{i}") for i in range(len(fields))]).first()
    out = {}
    for i, f in enumerate(fields):
        most, both, whole = max(got["n"], got[f"n{i}"]), got[f"b{i}"], 0.9 * (1 << lg_entries)
        share = min(1.0, whole / max(most, 1))
        if most < whole:
            out[f] = (both, both)
            continue
        hits = both * share
        error = MARGIN * math.sqrt(hits)
        high = min([(hits + error + MARGIN ** 2) / share, *[n for n in (got["n"], got[f"n{i}"]) if n < whole]])
        out[f] = (min(max(0.0, (hits - error) / share), high), high)
    return out


def _exact_overlap(df: DataFrame, fields: Sequence[str], reference: DataFrame, ref_value: str) -> DataFrame:
    """``field, score`` of the field that shares most distinct values with
    ``reference``, ties to the earliest. The values of all fields are grouped
    once, with the set of fields that hold them as bits: a value that a task
    meets in several rows or fields is shuffled once, and already by the key of
    the join. Whole numbers stay numbers: they are equal as strings when they
    are equal."""
    whole = all(isinstance(t, IntegralType) for t in [reference.schema[ref_value].dataType, *[df.schema[f].dataType for f in fields]])
    kind = "bigint" if whole else "string"
    ref = reference.select(F.col(f"`{ref_value}`").cast(kind).alias("value")).where("value IS NOT NULL").distinct()
    words = [fields[i:i + 63] for i in range(0, len(fields), 63)]
    held = [F.struct(F.col(f"`{f}`").cast(kind).alias("value"), *[F.lit(1 << j if k == w else 0).cast("bigint").alias(f"m{k}")
                                                                    for k in range(len(words))])
            for w, names in enumerate(words) for j, f in enumerate(names)]
    values = df.select(F.explode(F.array(*held)).alias("h")).select("h.*").where("value IS NOT NULL").groupBy("value").agg(
        *[F.bit_or(f"m{k}").alias(f"m{k}") for k in range(len(words))])
    hits = values.join(ref, "value", "left_semi")
    scores = hits.agg(*[F.count_if(F.col(f"m{i // 63}").bitwiseAND(1 << i % 63) != 0).alias(f"s{i}") for i in range(len(fields))])
    best = F.array_max(F.array(*[F.struct(F.col(f"s{i}").alias("score"), F.lit(-i).alias("place"), F.lit(f).alias("field"))
                                 for i, f in enumerate(fields)]))
    return scores.select(best.alias("b")).select("b.field", "b.score")


def best_overlap_wide(df: DataFrame, fields: Sequence[str], reference: DataFrame, ref_value: str = "value",
                      lg_entries: int = LG_ENTRIES, sources: Sequence[DataFrame] = ()) -> DataFrame:
    """J4 / T5 for tables of many columns: ``field, score`` of the column that
    shares most distinct values (compared as strings, without NULL) with
    ``reference``; ties go to the earliest of ``fields``.

    Theta sketches rank the columns in one pass; only those whose upper bound
    reaches the best lower bound are counted exactly, and none are where a
    sketch held every value of the only one left. ``df`` is read a second time
    for the columns left over alone. An empty table scores 0.

    ``sources`` are frames that an inner join made ``df`` of: its values of a column are
    among those of the source's column of that name. They are sketched where
    they lie, without a shuffle, and ``df`` is computed once, stored, with the
    columns alone whose upper bound is at least half of the greatest; another
    column is looked at only where its upper bound reaches what they score, and
    never where its source shares nothing with ``reference``."""
    fields = list(fields)
    upper = {f: math.inf for f in fields}
    for of in sources:
        own = [f for f in fields if f in of.columns]
        found = overlap_bounds(of, own, reference, ref_value, lg_entries) if own else {}
        upper |= {f: hi if math.isinf(upper[f]) else max(upper[f], hi) for f, (_, hi) in found.items()}
    bounds = {f: (0.0, 0.0) for f in fields if upper[f] <= 0}
    most, least, frames = max(upper.values()), 0.0, {}
    for reach in (lambda f: upper[f] >= most / 2, lambda f: upper[f] >= least):
        new = [f for f in fields if f not in bounds and reach(f)]
        if new:
            frame = df.select(*[F.col(f"`{f}`") for f in new])
            frame = store(frame, "overlap") if sources else frame
            frames |= dict.fromkeys(new, frame)
            bounds |= overlap_bounds(frame, new, reference, ref_value, lg_entries)
            least = max(lo for lo, _ in bounds.values())
    left = [f for f in fields if f in bounds and bounds[f][1] >= least]
    spark = df.sparkSession
    if all(lo == hi for lo, hi in (bounds[f] for f in left)):  # equal bounds: all tie, the first one wins
        return spark.createDataFrame([(left[0], round(least))], "field string, score bigint")
    held = {id(frames[f]): frames[f] for f in left if f in frames}
    frame = next(iter(held.values())) if len(held) == 1 else df
    frame = frame.select(*[F.col(f"`{f}`") if f in frames else F.lit(None).cast(df.schema[f].dataType).alias(f) for f in left])
    return _exact_overlap(frame, left, reference, ref_value)
