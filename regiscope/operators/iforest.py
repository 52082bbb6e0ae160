"""Distributed Isolation Forest.

Algorithm: Liu, Ting and Zhou, "Isolation Forest", ICDM 2008.

Plan
1. ``n`` rows; subsample size ``psi = min(max_samples, n)``; height limit
   ``ceil(log2(psi))``.
2. Every row is named by its keys and goes to ``r`` of the trees, one where the
   table has rows enough: the MD5 of its name gives the first tree and, per
   tree, a draw. A row whose draw is not among about ``CANDIDATE * psi +
   MARGIN`` least ones expected of a tree leaves inside its task, so what is
   shuffled is in proportion to trees x psi, whatever the table's size.
3. Tree ``t`` takes the ``psi`` least draws. Rows of equal name are counted, so
   one repeated without bound is one candidate with copies.
4. A tree grows in one task from its ``psi`` rows: the least and greatest value
   of every feature in a node, a feature among those that vary and a threshold
   between its ends, both from the MD5 of (seed, tree, node). No step depends on
   partitioning, and SQL can repeat all of it, level by level (nine levels of
   windows in one Spark plan took longer to analyse than all trees to grow).
5. The node table has at most ``T * (2 psi - 1)`` rows; ``save`` keeps it with
   all a reloaded model needs (S16). ``mapInPandas`` scores every row
   vectorised over Arrow batches:
   ``score = -2 ** (-mean_path / c(psi))`` (lower = more anomalous), with
   path = depth + c(leaf size).
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .stats import attach_stats, exact_quantiles, flag_below_quantile, quantile_values

EULER_GAMMA = 0.5772156649015329
# Candidates per tree: CANDIDATE * psi + MARGIN expected, of SPREAD * psi rows that
# the tree could choose from, so that fewer than psi practically never occur (it raises).
CANDIDATE, MARGIN, SPREAD = 3, 64, 4
#: Rows that descend the trees together.
SCORE_ROWS = 256

NODE_SCHEMA = T.StructType([
    T.StructField("tree", T.IntegerType()),
    T.StructField("node", T.IntegerType()),
    T.StructField("feature", T.IntegerType()),
    T.StructField("threshold", T.DoubleType()),
    T.StructField("left", T.IntegerType()),
    T.StructField("right", T.IntegerType()),
    T.StructField("size", T.IntegerType()),
    T.StructField("depth", T.IntegerType()),
])


def c_factor(n: float) -> float:
    """Average path length of an unsuccessful BST search over n points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + EULER_GAMMA) - 2.0 * (n - 1.0) / n


def _c_vec(n: np.ndarray) -> np.ndarray:
    n = n.astype(float)
    out = np.zeros_like(n)
    two = n == 2
    big = n > 2
    out[two] = 1.0
    nb = n[big]
    out[big] = 2.0 * (np.log(nb - 1.0) + EULER_GAMMA) - 2.0 * (nb - 1.0) / nb
    return out


def _hex(h: Column, start: int, digits: int) -> Column:
    """A number of some hexadecimal digits of an MD5."""
    return F.conv(F.substring(h, start, digits), 16, 10).cast("bigint")


def trees_per_row(n: int, n_trees: int, psi: int) -> int:
    """Trees that a row may go to: so many that a tree has SPREAD * psi rows to
    choose from."""
    return min(n_trees, -(-SPREAD * n_trees * psi // n))


def sample(df: DataFrame, features: Sequence[str], keys: Sequence[str] | None, n: int, n_trees: int,
           psi: int, seed: int) -> DataFrame:
    """``tree, x0.., w``: the psi least draws of every tree; w copies each."""
    xs = [f"x{i}" for i in range(len(features))]
    r = trees_per_row(n, n_trees, psi)
    limit = min(1.0, (CANDIDATE * psi + MARGIN) * n_trees / (n * r)) if r < n_trees else 1.0
    name = [F.col(f"`{k}`").cast("string") for k in keys] if keys else [F.monotonically_increasing_id().cast("string")]

    def md5(j):
        return F.md5(F.concat_ws("|", F.lit(str(seed)), j.cast("string"), F.col("__name")))

    rows = df.select(F.concat_ws("|", *name).alias("__name"),
                     *[F.col(f"`{c}`").cast("double").alias(x) for c, x in zip(features, xs)])
    rows = rows.withColumn("__h", md5(F.lit(0)))
    if r == 1:
        rows = rows.withColumn("j", F.lit(0))
    else:
        rows = rows.select("*", F.explode(F.sequence(F.lit(0), F.lit(r - 1))).alias("j"))
    draw = _hex(F.when(F.col("j") == 0, F.col("__h")).otherwise(md5(F.col("j"))), 9, 13)
    rows = rows.withColumn("u", draw).where(F.col("u") < F.lit(math.ceil(limit * 2 ** 52))).select(
        ((_hex(F.col("__h"), 1, 8) + F.col("j")) % n_trees).cast("int").alias("tree"), "u", *xs)
    rows = rows.groupBy("tree", "u", *xs).agg(F.count(F.lit(1)).alias("copies"))
    before = F.sum("copies").over(Window.partitionBy("tree").orderBy("u", *xs)) - F.col("copies")
    return rows.withColumn("before", before).where(F.col("before") < psi).select(
        "tree", *xs, F.least("copies", F.lit(psi) - F.col("before")).alias("w"))


def grow_tree(x: np.ndarray, w: np.ndarray, tree: int, height: int, seed: int) -> list[tuple]:
    """Nodes of one tree over the rows of ``x``, each standing for ``w`` rows.

    A node splits a feature among those that vary in it at a threshold between
    its least and greatest value, both from the MD5 of (seed, tree, node): no
    generator is carried, so any order of nodes or rows, and SQL, give the same."""
    nodes = []
    todo = [(1, np.arange(len(x)), 0)]
    while todo:
        node, rows, depth = todo.pop()
        sub = x[rows]
        lo, hi = sub.min(axis=0), sub.max(axis=0)
        varying = np.flatnonzero(hi > lo)
        size = int(w[rows].sum())
        if depth >= height or not len(varying):
            nodes.append((tree, node, -1, 0.0, -1, -1, size, depth))
            continue
        h = hashlib.md5(f"{seed}|{tree}|{node}".encode()).hexdigest()
        f = int(varying[int(h[:8], 16) % len(varying)])
        low, high = float(lo[f]), float(hi[f])
        cut = low + int(h[8:21], 16) / 2.0 ** 52 * (high - low)
        cut = high if cut <= low else cut  # never the least value itself, so that both children have rows
        nodes.append((tree, node, f, cut, 2 * node, 2 * node + 1, size, depth))
        left = sub[:, f] < cut
        todo += [(2 * node, rows[left], depth + 1), (2 * node + 1, rows[~left], depth + 1)]
    return nodes


def grow(rows: DataFrame, n_features: int, psi: int, seed: int) -> DataFrame:
    """The node table of the trees over ``sample``'s rows, of which a tree has
    at most ``psi``. The children of node i are 2 i and 2 i + 1, the root is 1."""
    xs = [f"x{i}" for i in range(n_features)]
    height = int(math.ceil(math.log2(psi))) if psi > 1 else 0

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        tree, w = int(pdf["tree"].iloc[0]), pdf["w"].to_numpy()
        if w.sum() < psi:
            raise ValueError(f"tree {tree}: {w.sum()} draws, {psi} wanted")
        return pd.DataFrame(grow_tree(pdf[xs].to_numpy(dtype=float), w, tree, height, seed), columns=NODE_SCHEMA.names)

    return rows.groupBy("tree").applyInPandas(one, NODE_SCHEMA)


def fit(df: DataFrame, features: Sequence[str], n_trees: int = 100, max_samples: int = 256,
        seed: int = 42, keys: Sequence[str] | None = None, n: int | None = None) -> tuple[DataFrame, int]:
    """Fit the forest; returns (node table, psi). ``features`` must be
    non-NULL doubles (impute and scale first).

    ``keys`` name a row: equal names share their draws. Without keys a row is
    named by its place in ``df``, which then should be a stored table. ``n``:
    the number of rows, if known. A tree with fewer than psi draws raises."""
    spark = df.sparkSession
    n = df.count() if n is None else n
    if n == 0:
        return spark.createDataFrame([], NODE_SCHEMA), 0
    psi = min(max_samples, n)
    return grow(sample(df, features, keys, n, n_trees, psi, seed), len(features), psi, seed), psi


def score(df: DataFrame, nodes: DataFrame, features: Sequence[str], psi: int,
          out: str = "anomaly_score") -> DataFrame:
    """Score every row (vectorised ``mapInPandas``); the node table is
    collected once (bounded by trees x (2 psi - 1) rows) and broadcast. A scan
    of small splits (``session.store(split_bytes=)``) keeps all cores busy."""
    spark = df.sparkSession
    nd = nodes.toPandas().sort_values(["tree", "node"]).reset_index(drop=True)
    # one node array: the children of i are child[2 i] and child[2 i + 1], a leaf is its own
    place = {k: i for i, k in enumerate(zip(nd["tree"], nd["node"]))}
    leaf = nd["feature"].to_numpy() < 0
    own = np.arange(len(nd))
    child = np.empty(2 * len(nd), np.int64)
    for side, name in enumerate(("left", "right")):
        at = np.array([place.get(k, 0) for k in zip(nd["tree"], nd[name])], dtype=np.int64)
        child[side::2] = np.where(leaf, own, at)
    first = nd.groupby("tree")["node"].min()
    glob = {
        "feature": np.where(leaf, 0, nd["feature"].to_numpy()),
        "threshold": nd["threshold"].to_numpy(),
        "child": child,
        "path": nd["depth"].to_numpy() + _c_vec(nd["size"].to_numpy()),
        "roots": np.array([place[k] for k in first.items()], dtype=np.int64),
        "max_depth": int(nd["depth"].max()) if len(nd) else 0,
    }
    bc = spark.sparkContext.broadcast(glob)
    c_psi = c_factor(psi) or 1.0
    feats = list(features)
    schema = T.StructType(df.schema.fields + [T.StructField(out, T.DoubleType())])

    def run(batches):
        g = bc.value
        feat, thr, child, path, roots = g["feature"], g["threshold"], g["child"], g["path"], g["roots"]
        n_trees, n_feats = len(roots), len(feats)
        for pdf in batches:
            x = np.ascontiguousarray(pdf[feats].to_numpy(dtype=float))
            mean_path = np.zeros(len(pdf))
            # all trees of a few hundred rows descend together, one level per step: that many nodes fit the cache
            for at in range(0, len(pdf) if n_trees else 0, SCORE_ROWS):
                some = x[at:at + SCORE_ROWS]
                m = len(some)
                flat = some.ravel()
                base = np.repeat(np.arange(m) * n_feats, n_trees)
                node = np.tile(roots, m)
                for _ in range(g["max_depth"]):
                    node = child[2 * node + (flat[base + feat[node]] >= thr[node])]
                mean_path[at:at + m] = path[node].reshape(m, n_trees).mean(axis=1)
            pdf[out] = -np.power(2.0, -mean_path / c_psi)
            yield pdf

    return df.mapInPandas(run, schema=schema)


def flag(df: DataFrame, score_col: str, contamination: float, out: str = "is_anomaly") -> DataFrame:
    """anomaly = score below the exact ``contamination`` quantile."""
    return flag_below_quantile(df, score_col, contamination, out)


def _cuts(df: DataFrame, score_col: str, levels: Sequence[float]) -> DataFrame:
    """``contamination, cut`` per level from one quantile job."""
    return exact_quantiles(df, [score_col], list(levels), "cont").select(
        F.col("p").alias("contamination"), F.col("value").alias("cut"))


def _flagged(df: DataFrame, score_col: str, cuts: DataFrame, keys: Sequence[str]) -> DataFrame:
    packed = cuts.agg(F.sort_array(F.collect_list(F.struct("contamination", "cut"))).alias("__cuts"))
    low = F.filter("__cuts", lambda c: F.col(score_col) < c["cut"])
    # the levels travel as one array on one row, so only flagged rows multiply
    return (attach_stats(df.select(*keys, score_col), packed)
            .select(*keys, F.explode(low).alias("__c")).select("__c.contamination", *keys))


def contamination_flags(df: DataFrame, score_col: str, levels: Sequence[float],
                        keys: Sequence[str]) -> DataFrame:
    """The keys flagged at every level, as ``contamination, keys...`` rows.

    One quantile job and one pass over the scores serve all levels; the
    forest is fitted once (the original job refits it per level). A NULL score
    is never flagged."""
    return _flagged(df, score_col, _cuts(df, score_col, levels), keys)


def contamination_sweep(df: DataFrame, score_col: str, levels: Sequence[float]) -> DataFrame:
    """M10 summarised: ``contamination, cut, n_flagged`` per level."""
    cuts = _cuts(df, score_col, levels)
    counts = _flagged(df, score_col, cuts, []).groupBy("contamination").agg(F.count(F.lit(1)).alias("n"))
    return cuts.join(counts, "contamination", "left").select(
        "contamination", "cut", F.coalesce("n", F.lit(0)).alias("n_flagged"))


@dataclass
class Model:
    """All that scoring unseen rows needs."""

    nodes: DataFrame
    psi: int
    features: list[str]
    fills: list[float | None]
    means: list[float]
    deviations: list[float]
    contamination: float | None = None
    cut: float | None = None

    def score(self, df: DataFrame, out: str = "anomaly_score", flag_out: str = "is_anomaly") -> DataFrame:
        """``df`` with its scores: NULLs filled, features scaled and trees
        walked as when fitted, flagged by the stored cut if there is one."""
        xs = [f"__x{i}" for i in range(len(self.features))]
        scaled = {}
        for x, c, fill, mu, sd in zip(xs, self.features, self.fills, self.means, self.deviations):
            v = F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double"))
            scaled[x] = (F.coalesce(v, F.lit(fill).cast("double"), F.lit(0.0)) - mu) / sd if sd else F.lit(0.0)
        got = score(df.withColumns(scaled), self.nodes, xs, self.psi, out).drop(*xs)
        if self.cut is None:
            return got
        return got.withColumn(flag_out, F.coalesce(F.col(out) < F.lit(self.cut), F.lit(False)))

    def save(self, path: str) -> None:
        """Two tables below ``path``: nodes, and one row with everything else."""
        self.nodes.write.mode("overwrite").parquet(f"{path}/nodes")
        row = (self.psi, self.features, self.fills, self.means, self.deviations, self.contamination, self.cut)
        self.nodes.sparkSession.createDataFrame([row], _MODEL).write.mode("overwrite").parquet(f"{path}/model")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Model:
        row = spark.read.schema(_MODEL).parquet(f"{path}/model").first()
        return cls(spark.read.schema(NODE_SCHEMA).parquet(f"{path}/nodes"), *row)


_MODEL = ("psi int, features array<string>, fills array<double>, means array<double>, deviations array<double>, "
          "contamination double, cut double")


def fit_model(df: DataFrame, features: Sequence[str], n_trees: int = 100, max_samples: int = 256, seed: int = 42,
              keys: Sequence[str] | None = None, all_fills: bool = True) -> Model:
    """Midpoint-median fill, population-sd scaling and forest as one model.

    Without ``all_fills`` the median is found only for columns that have a NULL
    in ``df``; unseen rows then get 0 for a NULL in another one, as they do for
    a column without any value."""
    feats = list(features)
    values = {c: F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double")) for c in feats}

    def moments(fills: dict):
        return df.agg(F.count(F.lit(1)).alias("n"), *[f(F.coalesce(v, F.lit(fills.get(c)).cast("double"))).alias(f"{k}{i}")
                                                      for i, (c, v) in enumerate(values.items())
                                                      for k, f in (("c", F.count), ("mu", F.avg), ("sd", F.stddev_pop))]).first()

    got = moments({})
    gaps = [c for i, c in enumerate(feats) if got[f"c{i}"] < got["n"]]
    fills = {c: v for (c, _), v in quantile_values(df, feats if all_fills else gaps, [0.5]).items()} if gaps or all_fills else {}
    if gaps:
        got = moments({c: 0.0 if fills[c] is None else fills[c] for c in gaps})
    means = [got[f"mu{i}"] or 0.0 for i in range(len(feats))]
    sds = [got[f"sd{i}"] or 0.0 for i in range(len(feats))]
    xs = [f"__x{i}" for i in range(len(feats))]
    scaled = {x: (F.coalesce(v, F.lit(fills.get(c)).cast("double"), F.lit(0.0)) - mu) / sd if sd else F.lit(0.0)
              for x, (c, v), mu, sd in zip(xs, values.items(), means, sds)}
    nodes, psi = fit(df.withColumns(scaled), xs, n_trees, max_samples, seed, keys, got["n"])
    return Model(nodes, psi, feats, [fills.get(c) for c in feats], means, sds)
