"""Silver -> Gold: region master table, ratios, normalisation, composite
scores and priority rank (J1, P15-P22, W1/J5, W2, P19).

The functions take Silver-shaped frames keyed by region, so the same plan
serves the health-domain Silver tables and the analogues derived from the
driver's test tables (``plans.testtables``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import percentage, ratio_per, row_sum, weighted_score
from ..operators.join import DuplicateKeyError, assert_unique, latest_period, left_join_all
from ..operators.rank import rank
from ..session import materialize

KEY = "kabupaten_kota"

# Gold contract.
BURDEN_COLS = ["total_stunting", "total_gizi_buruk", "total_gizi_kurang", "total_underweight"]
FACILITY_COLS = ["jumlah_rs_umum", "jumlah_rs_khusus", "jumlah_posyandu"]
WORKER_COL = "total_nakes"
RISK_WEIGHTS = (("norm_stunting", 0.5), ("norm_faskes_inv", 0.3), ("norm_nakes_inv", 0.2))
def _one_period(df: DataFrame, period: str | None) -> DataFrame:
    if period and period in df.columns:
        return latest_period(df, [KEY], period)
    return df


def master_table(population: DataFrame, burden: DataFrame, facilities: DataFrame,
                 workers: DataFrame | None, burden_map: dict[str, str] | None = None,
                 period: str | None = "periode_data", check_unique: bool = True) -> DataFrame:
    """J1 + P15 + P11 + P16: one row per region of ``population``.

    ``burden_map`` maps Gold burden names to the pivoted Silver columns. The
    right sides are reduced to one period per region (policy ``latest``)
    before joining, so they cannot fan out the master rows. Without ``workers``
    the facilities hold their column too.

    A repeated key of any input repeats a region of the result. With
    ``check_unique`` the joined rows (one per region) are stored and checked
    once, so no input is computed a second time for the check; without it the
    result stays lazy and callers store it before reading it twice.
    """
    bm = burden_map or dict(zip(BURDEN_COLS, ["STUNTING", "GIZI BURUK", "GIZI KURANG", "UNDERWEIGHT"]))
    b = _one_period(burden, period).select(
        KEY, *[F.coalesce(F.col(f"`{src}`"), F.lit(0)).cast("bigint").alias(dst) for dst, src in bm.items()])
    f = _one_period(facilities, period).select(KEY, *FACILITY_COLS, *([] if workers is not None else [WORKER_COL]))
    w = [] if workers is None else [_one_period(workers, period).select(KEY, WORKER_COL)]
    m = left_join_all(population.select(KEY, "populasi"), [b, f, *w], [KEY])
    m = m.na.fill(0, subset=[*BURDEN_COLS, *FACILITY_COLS, WORKER_COL])
    m = m.withColumn("total_balita_gizi_buruk", row_sum(BURDEN_COLS))
    if check_unique:
        m = materialize(m)
        assert_unique(m, [KEY], name="Gold master")
    return m


def indicators(master: DataFrame) -> DataFrame:
    """P17 + P18: guarded ratios."""
    return (master
            .withColumn("rasio_faskes_per_10k_balita",
                        ratio_per(F.col("jumlah_rs_umum") + F.col("jumlah_rs_khusus"),
                                  "total_balita_gizi_buruk", 10000))
            .withColumn("rasio_posyandu_per_10k_populasi", ratio_per("jumlah_posyandu", "populasi", 10000))
            .withColumn("rasio_nakes_per_10k_populasi", ratio_per(WORKER_COL, "populasi", 10000))
            .withColumn("prevalensi_stunting_pct", percentage("total_stunting", "populasi")))


NORM_INPUTS = ["prevalensi_stunting_pct", "rasio_faskes_per_10k_balita",
               "rasio_posyandu_per_10k_populasi", "rasio_nakes_per_10k_populasi"]


def scores(ind: DataFrame, check_unique: bool = False) -> DataFrame:
    """W1 via J5 + P20-P22: every min/max from one aggregate row, then NRS
    (weighted) and NCI (mean of three norms). The row's eight numbers enter the
    plan as constants. ``check_unique``: the same row tells a repeated region,
    which raises."""
    aggs = [f(c).alias(f"{k}{i}") for i, c in enumerate(NORM_INPUTS) for k, f in (("mn", F.min), ("mx", F.max))]
    if check_unique:
        aggs += [F.count(F.lit(1)).alias("n"), F.count_distinct(KEY).alias("keys"), F.count_if(F.col(KEY).isNull()).alias("none")]
    row = ind.agg(*aggs).first()
    if check_unique and row["n"] > row["keys"] + min(row["none"], 1):
        raise DuplicateKeyError(f"Gold master: key [{KEY!r}] not unique")

    def norm(i: int) -> Column:
        lo, hi = row[f"mn{i}"], row[f"mx{i}"]
        if lo is None or lo == hi:
            return F.lit(None if lo is None else 0.0).cast("double")
        return (F.col(NORM_INPUTS[i]) - lo) / F.lit(hi - lo)

    n_stunt, n_fask, n_posy, n_nakes = (norm(i) for i in range(len(NORM_INPUTS)))
    return (ind.withColumn("norm_stunting", n_stunt)
            .withColumn("norm_faskes_inv", F.lit(1.0) - n_fask)
            .withColumn("norm_nakes_inv", F.lit(1.0) - n_nakes)
            .withColumn("nutrition_risk_score", weighted_score(list(RISK_WEIGHTS)))
            .withColumn("nutrition_coverage_index", (n_fask + n_posy + n_nakes) / F.lit(3.0)))


def finalize(scored: DataFrame, as_of: Column | None = None) -> DataFrame:
    """W2 on the unrounded NRS, then P19 rounding and the Gold projection.

    The scores are a projection of the stored master, which the rank reads more
    than once."""
    ranked = rank(scored, "nutrition_risk_score", out="priority_rank", descending=True)
    cols = [
        KEY, "populasi", "total_balita_gizi_buruk", *BURDEN_COLS, *FACILITY_COLS, WORKER_COL,
        F.round("rasio_faskes_per_10k_balita", 4).alias("rasio_faskes_per_10k_balita"),
        F.round("rasio_posyandu_per_10k_populasi", 4).alias("rasio_posyandu_per_10k_populasi"),
        F.round("rasio_nakes_per_10k_populasi", 4).alias("rasio_nakes_per_10k_populasi"),
        F.round("prevalensi_stunting_pct", 2).alias("prevalensi_stunting_pct"),
        F.round("nutrition_coverage_index", 4).alias("nutrition_coverage_index"),
        F.round("nutrition_risk_score", 4).alias("nutrition_risk_score"),
        "priority_rank",
    ]
    if as_of is not None:
        cols.append(as_of.alias("last_updated"))
    return ranked.select(*cols)


def gold(population: DataFrame, burden: DataFrame, facilities: DataFrame, workers: DataFrame,
         burden_map: dict[str, str] | None = None, period: str | None = "periode_data",
         as_of: Column | None = None, check_unique: bool = True) -> DataFrame:
    """The whole Silver -> Gold plan (q18)."""
    m = master_table(population, burden, facilities, workers, burden_map, period, check_unique)
    # one row per region: stored so the statistics row and the rows it is
    # joined back to do not each recompute the fact-table aggregates
    return finalize(scores(indicators(m if check_unique else materialize(m))), as_of)


def top(df: DataFrame, n: int = 10, by: Sequence[str] = ("priority_rank", KEY)) -> DataFrame:
    """Ordered preview (TakeOrderedAndProject)."""
    return df.orderBy(*by).limit(n)
