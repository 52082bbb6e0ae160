"""Table-wide statistics without single-task windows.

* ``attach_stats`` (J5): one aggregate row (partial + final aggregation, so only
  per-task partials meet in one place) broadcast back onto every row. The
  broadcast side is a single row by construction.
* ``min_max_normalize`` (W1), ``zscore`` (M2/M3) are built on it.
* ``exact_quantiles`` (A8, A9, A12) selects by radix, exponent first and then
  digits of the mantissa; no rows are sorted and none reach the driver.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import store


def attach_stats(df: DataFrame, stats: DataFrame) -> DataFrame:
    """Cross join a one-row statistics frame onto every row.

    ``stats`` must be a global aggregate (exactly one row); that bound is what
    makes the broadcast safe at any data size.
    """
    return df.crossJoin(F.broadcast(stats))


#: A group with more than 1 / HOT_SHARE of the rows is hot.
HOT_SHARE = 1000


def join_group_stats(df: DataFrame, stats: DataFrame, keys: Sequence[str], count: str = "__n") -> DataFrame:
    """``df`` with the statistics of its group, for groups of any size.

    ``stats`` has one row per group with its number of rows ``count``. Groups
    that hold more than 1/1,000 of the rows, so fewer than 1,000 of them, go to
    the rows by a broadcast and their rows are not shuffled: a group with a
    third of the rows is not one task. The rows of the others meet their group
    by a shuffle join. NULL keys match NULL keys."""
    stats = store(stats, "group-stats")
    total = F.broadcast(stats.agg(F.sum(count).alias("__total")))
    marked = stats.crossJoin(total)
    hot = marked.where(F.col(count) * HOT_SHARE > F.col("__total")).drop("__total")
    cold = marked.where(F.col(count) * HOT_SHARE <= F.col("__total")).drop("__total")
    names = [c for c in stats.columns if c not in keys]

    def joined(rows: DataFrame, side: DataFrame, how: str) -> DataFrame:
        side = side.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], *names)
        on = [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)]
        got = rows.join(side, on, how)
        return got if how == "left_anti" else got.drop(*[f"__k{i}" for i in range(len(keys))])

    of_hot = joined(df, F.broadcast(hot), "inner")
    rest = joined(df, F.broadcast(hot), "left_anti")
    return of_hot.unionByName(joined(rest, cold, "inner"))


def min_max_normalize(df: DataFrame, cols: Sequence[str], out: Sequence[str] | None = None,
                      partition_by: Sequence[str] | None = None,
                      constant_value: float = 0.0, keep_stats: bool = False) -> DataFrame:
    """``(x - min) / (max - min)``, ``constant_value`` when max == min.

    NULLs are ignored by min/max and stay NULL. With ``partition_by`` the
    statistics are per group (``join_group_stats``); a NULL key is a group.
    """
    out = list(out or [f"{c}_norm" for c in cols])
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.min(c).alias(f"__mn{i}"), F.max(c).alias(f"__mx{i}")]
    if partition_by:
        j = join_group_stats(df, df.groupBy(*partition_by).agg(*aggs, F.count(F.lit(1)).alias("__n")), list(partition_by)).drop("__n")
    else:
        j = attach_stats(df, df.agg(*aggs))
    for i, (c, o) in enumerate(zip(cols, out)):
        mn, mx = F.col(f"__mn{i}"), F.col(f"__mx{i}")
        j = j.withColumn(o, F.when(mx == mn, F.lit(constant_value))
                         .otherwise((F.col(c) - mn) / (mx - mn)))
    if not keep_stats:
        j = j.drop(*[f"__mn{i}" for i in range(len(cols))], *[f"__mx{i}" for i in range(len(cols))])
    return j


def zscore(df: DataFrame, cols: Sequence[str], out: Sequence[str] | None = None,
           ddof: int = 1) -> DataFrame:
    """M2 (``ddof=1``, sample sd, like MLlib StandardScaler) and M3 (``ddof=0``,
    population sd). A zero or undefined sd yields 0.0, as both scalers do."""
    out = list(out or [f"{c}_z" for c in cols])
    sd = F.stddev_samp if ddof == 1 else F.stddev_pop
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.avg(c).alias(f"__mu{i}"), sd(c).alias(f"__sd{i}")]
    j = attach_stats(df, df.agg(*aggs))
    for i, (c, o) in enumerate(zip(cols, out)):
        mu, s = F.col(f"__mu{i}"), F.col(f"__sd{i}")
        j = j.withColumn(o, F.when(s.isNull() | (s == 0), F.lit(0.0))
                         .otherwise((F.col(c) - mu) / s))
    return j.drop(*[f"__mu{i}" for i in range(len(cols))], *[f"__sd{i}" for i in range(len(cols))])


def _positions(n: int, p: float, method: str) -> tuple[int, int, float]:
    if method == "cont":
        pos = p * (n - 1)
        lo = math.floor(pos)
        return lo, math.ceil(pos), pos - lo
    if method == "disc":
        k = max(math.ceil(p * n) - 1, 0)
        return k, k, 0.0
    raise ValueError(method)


#: Bits of the mantissa that one pass of ``exact_quantiles`` tells apart.
DIGIT_BITS = 12


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                    method: str = "cont", bits: int = DIGIT_BITS) -> DataFrame:
    """Exact quantiles of several columns without sorting the data.

    ``method="cont"``: linear interpolation between order statistics
    (``percentile`` / ``median`` / numpy default). ``method="disc"``: the
    smallest value whose cumulative share is >= p (``percentile_disc``; for
    p = 0.5 the lower middle value). NULL and NaN are no values.

    Radix selection: the first pass counts the values by sign and exponent, so
    that a wanted rank lies in one power of two whatever the values' spread.
    Every further pass divides the span of the values left, least to greatest,
    into 2**bits parts and counts their rows: with 52 bits of mantissa that
    ends after five passes more. Rows of a part that are all equal, or of which
    there are at most 2**bits, end it earlier; the latter are told apart by
    whole values. Passes after the second read the rows of the open parts from
    a stored table. A pass is one aggregate of which at most 2**bits rows per
    open part (the first: 4,200 per column) reach the driver.

    Returns one row per (column, p): ``name, p, value`` (value NULL when the
    column has no value).
    """
    got = quantile_values(df, cols, probs, method, bits)
    return df.sparkSession.createDataFrame([(c, float(p), got[(c, p)]) for c in cols for p in probs],
                                           "name string, p double, value double")


def _counted(rows: DataFrame, part: Column) -> list:
    """Rows, least and greatest value of every part of an open part."""
    return rows.groupBy("c", "lo", part.alias("d")).agg(
        F.count(F.lit(1)).alias("n"), F.min("x").alias("a"), F.max("x").alias("b")).collect()


def quantile_values(df: DataFrame, cols: Sequence[str], probs: Sequence[float], method: str = "cont",
                    bits: int = DIGIT_BITS, nulls: dict | None = None) -> dict[tuple[str, float], float | None]:
    """``exact_quantiles`` as {(column, p): value}. With ``nulls``, a dict that
    receives the number of rows without a value per column, columns that have
    none of them are left out."""
    spark = df.sparkSession
    values = [F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double")) for c in cols]
    if len(cols) == 1:
        rows = df.select(F.lit(0).alias("c"), values[0].alias("x"))
    else:
        rows = df.select(F.posexplode(F.array(*values)).alias("c", "x"))
    x, a = F.col("x"), F.abs("x")
    exponent = F.when(a > 0, F.signum("x") * (F.least(F.floor(F.log2(a)), F.lit(1024)) + 1100)).otherwise(x * 0)
    first = _counted(rows.withColumn("lo", F.lit(0.0)), exponent)
    none = {cols[r["c"]]: r["n"] for r in first if r["a"] is None}
    if nulls is not None:
        nulls.update(none)
    counted: dict[tuple, list] = {}  # (column number, least value) -> [(least, greatest value, rows)] of its parts
    for r in first:
        if r["a"] is not None:
            counted.setdefault((r["c"], 0.0), []).append((r["a"], r["b"], r["n"]))
    total = {c: sum(n for _, _, n in held) for (c, _), held in counted.items()}
    wanted = [i for i, c in enumerate(cols) if i in total and (nulls is None or c in none)]
    found: dict[tuple, float] = {}
    #: (column number, least value) -> [(rank among its rows, rank in the column)]
    open_ = {(c, 0.0): [(k, k) for k in {k for p in probs for k in _positions(total[c], float(p), method)[:2]}]
             for c in wanted}
    passes = 1
    while open_:
        todo, open_, most = open_, {}, 0
        ends: dict[tuple, float] = {}
        for key, ranks in todo.items():
            below, held = 0, iter(sorted(counted[key]))
            lo, hi, n = next(held)
            for inside, k in sorted(ranks):
                while inside >= below + n:
                    below += n
                    lo, hi, n = next(held)
                if lo == hi:
                    found[(key[0], k)] = lo
                else:
                    open_.setdefault((key[0], lo), []).append((inside - below, k))
                    ends[(key[0], lo)] = hi
                    most = max(most, n)
        if not open_:
            break
        # columns x probabilities x 2 rows at most: a bounded broadcast
        parts = F.broadcast(spark.createDataFrame([(c, lo, hi) for (c, lo), hi in ends.items()], "pc int, lo double, hi double"))
        inside = rows.join(parts, (F.col("c") == F.col("pc")) & (x >= F.col("lo")) & (x <= F.col("hi"))).select("c", "x", "lo", "hi")
        passes += 1
        # few rows are told apart by whole values, of which there are no more than rows
        few = most <= 1 << bits
        if passes == 3 and not few:
            inside = store(inside, "quantile-rows")
            rows = inside.select("c", "x")
        span = F.col("hi") / 2 - F.col("lo") / 2  # halves, as the whole may be infinite
        share = F.least(F.floor((x / 2 - F.col("lo") / 2) / span * (1 << bits)), F.lit((1 << bits) - 1))
        counted = {}
        for r in _counted(inside, x if few else share):
            counted.setdefault((r["c"], r["lo"]), []).append((r["a"], r["b"], r["n"]))
    out = {}
    for i, c in enumerate(cols):
        for p in probs:
            out[(c, p)] = None
            if i in wanted:
                lo, hi, frac = _positions(total[i], float(p), method)
                a, b = found[(i, lo)], found[(i, hi)]
                out[(c, p)] = a if a == b or not frac else a + (b - a) * frac
    return out


def impute_quantile(df: DataFrame, cols: Sequence[str], method: str,
                    default: float = 0.0) -> DataFrame:
    """A8 (``method="disc"``: lower median) / A9 (``"cont"``: midpoint median).

    NULLs and NaNs of each column are filled with that column's median; a column with
    no value at all falls back to ``default`` (lower median) or stays NULL
    (midpoint, as pandas does)."""
    df = df.withColumns({c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in cols})
    nulls: dict[str, int] = {}  # counted by the first pass; columns without any take no further ones
    med = quantile_values(df, cols, [0.5], method, nulls=nulls)
    fills = {c: default if med[(c, 0.5)] is None and method == "disc" else med[(c, 0.5)] for c in nulls}
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v).cast("double")) for c, v in fills.items()})


def flag_below_quantile(df: DataFrame, score: str, contamination: float,
                        out: str = "is_anomaly", cut_col: str | None = None) -> DataFrame:
    """``score < percentile(score, contamination)`` (linear interpolation)."""
    cut = quantile_values(df, [score], [contamination])[(score, contamination)]
    j = df.withColumn(out, F.coalesce(F.col(score) < F.lit(cut).cast("double"), F.lit(False)))
    return j.withColumn(cut_col, F.lit(cut).cast("double")) if cut_col else j
