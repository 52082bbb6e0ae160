"""K-Means segmentation and its quality measures (M1, M4-M8).

Two fits: MLlib's (``assemble_scale_fit``), and one that depends on the rows
alone (``fit_deterministic``, ``k_sweep``: farthest-first start, a fixed number
of Lloyd steps as aggregates), which SQL can repeat. The closed forms below
(assignment to given centres, WSSE, silhouette) are plain aggregates too, so
they run at any size.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.format import lookup
from .rank import ordinal_by
from .stats import attach_stats, quantile_values

# Cluster labels in ascending order of mean risk.
CLUSTER_LABELS = ["Risiko Rendah", "Risiko Sedang", "Risiko Tinggi"]


def assemble_scale_fit(df: DataFrame, features: Sequence[str], k: int = 3, seed: int = 42,
                       max_iter: int = 20, tol: float = 1e-4,
                       prediction: str = "cluster_id") -> PipelineModel:
    """M1 + M2 + M4: assemble, standardise (sample sd, centred) and fit.

    The scaler is saved with the model as one pipeline (the original job drops
    it), so reloaded models score new rows in the same space."""
    pipe = Pipeline(stages=[
        VectorAssembler(inputCols=list(features), outputCol="features_raw"),
        StandardScaler(inputCol="features_raw", outputCol="features", withMean=True, withStd=True),
        KMeans(k=k, seed=seed, featuresCol="features", predictionCol=prediction,
               maxIter=max_iter, tol=tol),
    ])
    return pipe.fit(df)


def silhouette(pred: DataFrame, prediction: str = "cluster_id", features: str = "features") -> float:
    """M7 via MLlib's evaluator (squared Euclidean)."""
    return ClusteringEvaluator(featuresCol=features, predictionCol=prediction,
                               metricName="silhouette", distanceMeasure="squaredEuclidean").evaluate(pred)


#: Lloyd steps of the deterministic fit.
LLOYD_STEPS = 10


def farthest_first(df: DataFrame, features: Sequence[str], key: str, k: int) -> list[tuple[float, ...]]:
    """k start centres that depend on the rows alone, for scaled features (of
    mean 0): the row farthest from the origin, then again and again the row farthest from its nearest centre;
    ties go to the least key. Every centre is one aggregate of one row. The
    first j of them are the start for j clusters. Fewer distinct rows than k
    give repeated centres, whose clusters stay empty."""
    cols = [F.col(f"`{c}`").cast("double") for c in features]
    from_ = [(0.0,) * len(cols)]
    centres: list[tuple[float, ...]] = []
    while len(centres) < k:
        near = F.least(*[_sqdist(cols, c) for c in from_]) if len(from_) > 1 else _sqdist(cols, from_[0])
        far = df.agg(F.min(F.struct((-near).alias("d"), F.col(f"`{key}`").alias("key"),
                                    *[c.alias(f"x{i}") for i, c in enumerate(cols)])).alias("far")).first()["far"]
        if far is None:
            return []
        centres.append(tuple(far[2:]))
        from_ = centres
    return centres


def _nearest(cols: Sequence[Column], centres: Sequence[Sequence[float]]) -> Column:
    """(d, i): squared distance to and number of the nearest centre, ties to the least number."""
    return F.array_min(F.array(*[F.struct(_sqdist(cols, c).alias("d"), F.lit(i).alias("i"))
                                 for i, c in enumerate(centres)]))


def fit_centres(df: DataFrame, features: Sequence[str], key: str, ks: Sequence[int],
                steps: int = LLOYD_STEPS) -> dict[int, list[tuple[float, ...]]]:
    """M4 / M5: centres for every k by farthest-first starts and ``steps``
    Lloyd steps. A step is one aggregate for all k; what reaches the driver is
    one row per (k, cluster). An empty cluster keeps its centre."""
    ks = sorted(set(ks))
    cols = [F.col(f"`{c}`").cast("double") for c in features]
    start = farthest_first(df, features, key, max(ks))
    if not start:
        return {k: [] for k in ks}
    centres = {k: start[:k] for k in ks}
    for _ in range(steps):
        at = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), _nearest(cols, centres[k])["i"].alias("i")) for k in ks]))
        sums = df.select(at.alias("c"), *[c.alias(f"x{i}") for i, c in enumerate(cols)]).groupBy("c.k", "c.i").agg(
            F.count(F.lit(1)).alias("n"), *[F.sum(f"x{i}").alias(f"s{i}") for i in range(len(cols))]).collect()
        moved = {k: list(c) for k, c in centres.items()}
        for r in sums:
            moved[r["k"]][r["i"]] = tuple(r[f"s{i}"] / r["n"] for i in range(len(cols)))
        if moved == centres:
            break
        centres = moved
    return centres


@dataclass
class CentreModel:
    """Scaler and centres of one fit, as saved and reloaded."""

    features: list[str]
    fills: list[float | None]
    means: list[float]
    deviations: list[float]
    centres: list[list[float]]

    def assign(self, df: DataFrame, out: str = "cluster_id") -> DataFrame:
        """Nearest centre of every row in the fitted scale; NULLs filled."""
        cols = [(F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(f).cast("double"), F.lit(0.0)) - m) / s if s else F.lit(0.0)
                for c, f, m, s in zip(self.features, self.fills, self.means, self.deviations)]
        return df.withColumn(out, _nearest(cols, self.centres)["i"])

    def save(self, spark: SparkSession, path: str) -> None:
        row = (self.features, self.fills, self.means, self.deviations, [[float(x) for x in c] for c in self.centres])
        spark.createDataFrame([row], _CENTRES).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> CentreModel:
        return cls(*spark.read.schema(_CENTRES).parquet(path).first())


_CENTRES = ("features array<string>, fills array<double>, means array<double>, deviations array<double>, "
            "centres array<array<double>>")


def fit_deterministic(df: DataFrame, features: Sequence[str], key: str, k: int = 3,
                      steps: int = LLOYD_STEPS) -> CentreModel:
    """A8 + M2 + M4: lower-median fill, sample-sd scaling and centres that
    depend on the rows alone, so that SQL can repeat them. ``df`` is read many
    times: store it first."""
    feats = list(features)
    nulls: dict[str, int] = {}
    med = quantile_values(df, feats, [0.5], "disc", nulls=nulls)
    fills = {c: (0.0 if med[(c, 0.5)] is None else med[(c, 0.5)]) for c in nulls}
    filled = df.select(key, *[F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(fills.get(c)).cast("double")).alias(c) for c in feats])
    got = filled.agg(*[f(c).alias(f"{n}{i}") for i, c in enumerate(feats)
                       for n, f in (("mu", F.avg), ("sd", F.stddev_samp))]).first()
    means = [got[f"mu{i}"] or 0.0 for i in range(len(feats))]
    sds = [got[f"sd{i}"] or 0.0 for i in range(len(feats))]
    z = filled.select(key, *[((F.col(c) - m) / s if s else F.lit(0.0)).alias(c) for c, m, s in zip(feats, means, sds)])
    centres = fit_centres(z, feats, key, [k], steps)[k]
    return CentreModel(feats, [fills.get(c) for c in feats], means, sds, [list(c) for c in centres])


def k_sweep(df: DataFrame, features: Sequence[str], ks: Sequence[int], key: str,
            steps: int = LLOYD_STEPS) -> DataFrame:
    """M5: ``k, wsse, silhouette`` per k over scaled features: one fit for all k,
    one aggregate for the clusters' sums and one for both measures. An empty
    table gives NULL measures."""
    spark = df.sparkSession
    ks = sorted(set(ks))
    cols = [F.col(f"`{c}`").cast("double") for c in features]
    centres = fit_centres(df, features, key, ks, steps)
    schema = "k int, wsse double, silhouette double"
    if not all(centres.values()):
        return spark.createDataFrame([(k, None, None) for k in ks], schema)
    rows = df.select(*[c.alias(f"x{i}") for i, c in enumerate(cols)], *[_nearest(cols, centres[k]).alias(f"c{k}") for k in ks])
    xs = [F.col(f"x{i}") for i in range(len(cols))]
    sq = reduce(add, [x * x for x in xs])
    at = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"c{k}.i").alias("i")) for k in ks]))
    sums = {(r["k"], r["i"]): r for r in rows.select(at.alias("c"), sq.alias("sq"), *xs).groupBy("c.k", "c.i").agg(
        F.count(F.lit(1)).alias("n"), F.sum("sq").alias("p"), *[F.sum(x).alias(f"y{i}") for i, x in enumerate(xs)]).collect()}
    aggs = []
    for k in ks:
        own, others = F.lit(None).cast("double"), []
        for i in range(k):
            r = sums.get((k, i))
            if r is None:
                continue
            total = r["n"] * sq + r["p"] - F.lit(2.0) * reduce(add, [x * r[f"y{j}"] for j, x in enumerate(xs)])
            here = F.col(f"c{k}.i") == i
            others.append(F.when(~here, total / r["n"]))
            own = F.when(here & F.lit(r["n"] > 1), total / max(r["n"] - 1, 1)).otherwise(own)
        b = F.least(*others) if len(others) > 1 else F.lit(None).cast("double")
        s = F.when(own.isNull() | b.isNull(), F.lit(0.0)).otherwise((b - own) / F.greatest(own, b))
        aggs += [F.sum(f"c{k}.d").alias(f"w{k}"), F.avg(s).alias(f"s{k}")]
    got = rows.agg(*aggs).first()
    return spark.createDataFrame([(k, got[f"w{k}"], got[f"s{k}"]) for k in ks], schema)


def k_sweep_mllib(df: DataFrame, features: Sequence[str], ks: Sequence[int], seed: int = 42) -> DataFrame:
    """M5 with MLlib: (k, wsse, silhouette) per k, fitted on one cached scaled
    frame. Each fit is a distributed job; only the k scalars come back."""
    spark = df.sparkSession
    prep = Pipeline(stages=[
        VectorAssembler(inputCols=list(features), outputCol="features_raw"),
        StandardScaler(inputCol="features_raw", outputCol="features", withMean=True, withStd=True),
    ]).fit(df)
    scaled = prep.transform(df).select("features").cache()
    rows = []
    try:
        for k in ks:
            model = KMeans(k=k, seed=seed, featuresCol="features", predictionCol="cluster_id",
                           maxIter=20, tol=1e-4).fit(scaled)
            pred = model.transform(scaled)
            rows.append((int(k), float(model.summary.trainingCost), float(silhouette(pred))))
    finally:
        scaled.unpersist()
    return spark.createDataFrame(rows, "k int, wsse double, silhouette double")


def _sqdist(cols: Sequence[Column], centre: Sequence[float]) -> Column:
    return reduce(add, [(c - F.lit(float(v))) * (c - F.lit(float(v))) for c, v in zip(cols, centre)])


def assign_nearest(df: DataFrame, features: Sequence[str], centres: Sequence[Sequence[float]],
                   out: str = "cluster_id", dist_out: str | None = None) -> DataFrame:
    """M4 assignment step against given centres: argmin squared distance,
    ties -> lowest centre id. A projection: no shuffle."""
    cols = [F.col(c) for c in features]
    d = [_sqdist(cols, c) for c in centres]
    best = F.array_min(F.array(*[F.struct(di.alias("d"), F.lit(i).alias("i")) for i, di in enumerate(d)]))
    res = df.withColumn("__best", best).withColumn(out, F.col("__best.i"))
    if dist_out:
        res = res.withColumn(dist_out, F.col("__best.d"))
    return res.drop("__best")


def wsse(df: DataFrame, features: Sequence[str], centres: Sequence[Sequence[float]],
         cluster: str = "cluster_id") -> DataFrame:
    """M6: within-set sum of squared distances to the assigned centre."""
    cols = [F.col(c) for c in features]
    per = F.element_at(F.array(*[_sqdist(cols, c) for c in centres]), F.col(cluster) + 1)
    return df.agg(F.sum(per).alias("wsse"))


def silhouette_closed_form(df: DataFrame, features: Sequence[str], cluster: str = "cluster_id") -> DataFrame:
    """M7 in closed form (squared Euclidean), one aggregate pass + one
    broadcast of per-cluster sums (k rows):

    for x in cluster A with size N_A, vector sum Y_A, squared-norm sum P_A,
    the mean squared distance to cluster C is (N_C |x|^2 + P_C - 2 x.Y_C)/N_C,
    divided by N_A - 1 instead of N_A for the own cluster; s = (b - a) /
    max(a, b), 0 for singletons; the result is the mean of s.
    """
    sq = reduce(add, [F.col(c) * F.col(c) for c in features])
    stats = df.groupBy(F.col(cluster).alias("__c")).agg(
        F.count(F.lit(1)).alias("__n"), F.sum(sq).alias("__p"),
        *[F.sum(c).alias(f"__y{i}") for i, c in enumerate(features)])
    packed = stats.agg(F.collect_list(F.struct(
        "__c", "__n", "__p", *[f"__y{i}" for i in range(len(features))])).alias("__cs"))
    j = attach_stats(df.withColumn("__sq", sq), packed)
    xs = [F.col(c) for c in features]

    def mean_d(s, own: bool):
        dot = reduce(add, [x * s[f"__y{i}"] for i, x in enumerate(xs)])
        total = s["__n"] * F.col("__sq") + s["__p"] - F.lit(2.0) * dot
        return total / (s["__n"] - 1) if own else total / s["__n"]

    own = F.filter("__cs", lambda s: s["__c"] == F.col(cluster))[0]
    others = F.transform(F.filter("__cs", lambda s: s["__c"] != F.col(cluster)), lambda s: mean_d(s, False))
    a = mean_d(own, True)
    b = F.array_min(others)
    s_val = F.when(own["__n"] <= 1, F.lit(0.0)).when(b.isNull(), F.lit(0.0)).otherwise(
        (b - a) / F.greatest(a, b))
    return j.select(s_val.alias("__s")).agg(F.avg("__s").alias("silhouette"))


def label_by_mean(df: DataFrame, cluster: str, score: str, labels: Sequence[str] = CLUSTER_LABELS,
                  out: str = "cluster_label") -> DataFrame:
    """M8: order clusters by mean ``score`` (A7 + W3), label them (P25) and
    join the label back. The cluster table has one row per cluster; Spark sizes
    the join. No driver collect."""
    means = df.groupBy(cluster).agg(F.avg(score).alias("__mean"))
    ordered = ordinal_by(means, cluster, "__mean", out="__ord", cap=len(labels) - 1)
    lab = ordered.select(cluster, lookup("__ord", dict(enumerate(labels))).alias(out))
    return df.join(lab, cluster, "left")
