import numpy as np
import pytest
from pyspark.sql import functions as F

from regiscope.operators import cluster as CL
from regiscope.operators import iforest as IF
from regiscope.session import scratch_path


@pytest.fixture(scope="module")
def blobs(spark):
    rnd = np.random.default_rng(5)
    pts = np.vstack([rnd.normal(c, 0.3, size=(60, 2)) for c in (0.0, 4.0, 8.0)])
    return spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(pts)],
                                 "id long, x double, y double")


def test_kmeans_fit_save_reload(spark, blobs):
    from pyspark.ml import PipelineModel
    model = CL.assemble_scale_fit(blobs, ["x", "y"], k=3, seed=42)
    path = scratch_path(spark, "test-kmeans")
    model.write().overwrite().save(path)
    again = PipelineModel.load(path).transform(blobs)
    first = model.transform(blobs)
    a = {r.id: r.cluster_id for r in first.collect()}
    b = {r.id: r.cluster_id for r in again.collect()}
    assert a == b and len(set(a.values())) == 3


def test_wsse_non_increasing_in_k(spark, blobs):
    sweep = sorted(CL.k_sweep(blobs, ["x", "y"], [2, 3, 4], "id").collect())
    w = [r.wsse for r in sweep]
    assert w[0] >= w[1] >= w[2]
    assert max(sweep, key=lambda r: r.silhouette).k == 3


def test_deterministic_fit_equals_plain_lloyd(spark, blobs):
    """Farthest-first start and Lloyd steps against numpy; the saved model
    assigns as the fitted one, whatever the partitioning."""
    pts = np.array([(r.x, r.y) for r in blobs.orderBy("id").collect()])
    z = (pts - pts.mean(0)) / pts.std(0, ddof=1)
    d = (z ** 2).sum(1)
    centres = []
    for _ in range(3):
        centres.append(z[np.argmax(d)])
        d = np.min([((z - c) ** 2).sum(1) for c in centres], axis=0)
    c = np.array(centres)
    for _ in range(CL.LLOYD_STEPS):
        near = ((z[:, None] - c[None]) ** 2).sum(2).argmin(1)
        c = np.array([z[near == i].mean(0) if (near == i).any() else c[i] for i in range(3)])
    model = CL.fit_deterministic(blobs.repartition(5), ["x", "y"], "id", k=3)
    assert np.allclose(model.centres, c)
    path = scratch_path(spark, "test-centres")
    model.save(spark, path)
    got = {r.id: r.cluster_id for r in CL.CentreModel.load(spark, path).assign(blobs).collect()}
    assert got == dict(enumerate(near.tolist()))
    same = spark.createDataFrame([(i, 1.0, None) for i in range(4)], "id long, x double, y double")
    flat = CL.fit_deterministic(same, ["x", "y"], "id", k=3)
    assert {r.cluster_id for r in flat.assign(same).collect()} == {0}
    none = spark.createDataFrame([], "id long, x double, y double")
    assert [tuple(r) for r in CL.k_sweep(none, ["x", "y"], [2], "id").collect()] == [(2, None, None)]


def test_c_factor():
    assert IF.c_factor(1) == 0.0 and IF.c_factor(2) == 1.0
    assert IF.c_factor(256) == pytest.approx(10.2448, abs=1e-3)


def test_isolation_forest_planted_outlier(spark):
    rnd = np.random.default_rng(0)
    pts = rnd.normal(0, 1, size=(3000, 3))
    pts[17] = [9.0, -9.0, 9.0]
    df = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(pts)], "id long, a double, b double, c double")
    nodes, psi = IF.fit(df, ["a", "b", "c"], n_trees=50, max_samples=128, seed=42)
    nodes = nodes.cache()
    assert psi == 128
    assert nodes.groupBy("tree").count().count() == 50
    assert nodes.agg(F.max("depth")).first()[0] <= 7
    scored = IF.score(df, nodes, ["a", "b", "c"], psi)
    rows = scored.orderBy("anomaly_score").limit(3).collect()
    assert rows[0].id == 17
    assert all(-1.0 <= r.anomaly_score < 0 for r in scored.collect())
    flagged = IF.flag(scored, "anomaly_score", 0.15).where("is_anomaly").count()
    assert flagged == pytest.approx(450, abs=2)


def test_forest_is_independent_of_partitioning(spark):
    df = spark.range(2000).select("id", (F.col("id") % 97).cast("double").alias("a"),
                                  (F.col("id") % 13).cast("double").alias("b"))
    n1, _ = IF.fit(df.repartition(3), ["a", "b"], n_trees=10, max_samples=64, keys=["id"])
    n2, _ = IF.fit(df.repartition(7), ["a", "b"], n_trees=10, max_samples=64, keys=["id"])
    key = ["tree", "node"]
    assert sorted(map(tuple, n1.orderBy(key).collect())) == sorted(map(tuple, n2.orderBy(key).collect()))


def test_contamination_sweep_counts(spark):
    df = spark.range(1000).select((F.col("id") * 1.0).alias("s"))
    got = {round(r.contamination, 2): r.n_flagged for r in IF.contamination_sweep(df, "s", [0.1, 0.15, 0.2]).collect()}
    assert got == {0.1: 100, 0.15: 150, 0.2: 200}


def test_forest_samples_copies_as_rows(spark):
    """A key or a row repeated without bound: the group of a tree stays small
    and its sample holds the copies in their share of the table."""
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, F.lit(0.0)).otherwise(F.rand(3) + 1).alias("a"))
    nodes, psi = IF.fit(df, ["a"], n_trees=30, max_samples=256)
    nodes = nodes.cache()
    assert psi == 256
    roots = nodes.where("node = 1").agg(F.min("size").alias("lo"), F.max("size").alias("hi"), F.count("*").alias("n")).first()
    assert (roots.lo, roots.hi, roots.n) == (256, 256, 30)
    same = spark.range(5_000).select(F.lit(1.0).alias("a"))
    flat, psi = IF.fit(same, ["a"], n_trees=5, max_samples=64)
    assert psi == 64 and [(r.node, r.size) for r in flat.collect()] == [(1, 64)] * 5


def test_forest_sample_is_uniform_and_counts_copies(spark):
    """Every row has the same chance; rows of one name count as copies."""
    n, trees = 3000, 40
    df = spark.range(n).select("id", F.col("id").cast("double").alias("a"))
    got = IF.sample(df, ["a"], ["id"], n, trees, 64, 7).collect()
    per = {}
    for r in got:
        per.setdefault(r.tree, []).append(r.x0)
    assert len(per) == trees and all(len(set(v)) == 64 for v in per.values())
    x = np.concatenate(list(per.values()))
    assert abs(x.mean() / n - 0.5) < 4 * np.sqrt(1 / 12 / len(x))
    one = spark.range(5000).select(F.lit(1).alias("id"), F.lit(2.0).alias("a")).unionByName(
        spark.range(2, 5002).select("id", F.col("id").cast("double").alias("a")))
    got = IF.sample(one, ["a"], ["id"], 10_000, trees, 64, 7).groupBy("tree").agg(F.sum("w").alias("w"), F.count("*").alias("c")).collect()
    assert len(got) == trees and {r.w for r in got} == {64} and min(r.c for r in got) < 64


def test_forest_shuffles_samples_not_rows(spark):
    """What reaches the trees' shuffle does not grow with the table."""
    for n in (40_000, 160_000):
        df = spark.range(n).select("id", F.rand(1).alias("a"))
        r = IF.trees_per_row(n, 10, 128)
        limit = (IF.CANDIDATE * 128 + IF.MARGIN) * 10 / (n * r)
        assert r == 1 and limit * n < 4_500
        nodes, psi = IF.fit(df, ["a"], n_trees=10, max_samples=128, keys=["id"])
        assert nodes.where("node = 1").agg(F.min("size")).first()[0] == psi == 128


def test_saved_forest_scores_unseen_rows(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") % 11 == 0, None).otherwise(F.sin("id")).alias("a"),
                                  (F.col("id") % 17).cast("double").alias("b"))
    seen, new = df.where("id % 2 = 0"), df.where("id % 2 = 1")
    model = IF.fit_model(seen, ["a", "b"], n_trees=20, max_samples=64, keys=["id"])
    model.cut, model.contamination = -0.5, 0.1
    path = scratch_path(spark, "test-forest")
    model.save(path)
    again = IF.Model.load(spark, path)
    assert (again.psi, again.features, again.fills, again.cut) == (64, ["a", "b"], model.fills, -0.5)
    a = {r.id: (r.anomaly_score, r.is_anomaly) for r in model.score(new).collect()}
    assert a == {r.id: (r.anomaly_score, r.is_anomaly) for r in again.score(new).collect()} and len(a) == 1500
    # scaled by the fitted rows, not by the new ones
    one = again.score(new.where("id = 1")).first()
    assert one.anomaly_score == a[1][0]


def test_saved_kmeans_assignment_matches_sql(spark, blobs):
    """The centres read back from the saved pipeline give, in SQL, the clusters
    that the pipeline assigns."""
    import duckdb
    from pyspark.ml import PipelineModel
    path = scratch_path(spark, "test-kmeans-sql")
    CL.assemble_scale_fit(blobs, ["x", "y"], k=3, seed=42).write().overwrite().save(path)
    saved = PipelineModel.load(path)
    centres = [tuple(map(float, c)) for c in saved.stages[-1].clusterCenters()]
    pts, cen = blobs.toPandas(), ", ".join(f"({i}, {a!r}, {b!r})" for i, (a, b) in enumerate(centres))
    con = duckdb.connect()
    con.register("pts", pts)
    want = con.execute(f"""WITH m AS (SELECT avg(x) mx, avg(y) my, stddev_samp(x) sx, stddev_samp(y) sy FROM pts)
        SELECT id, arg_min(c, power((x - mx) / sx - a, 2) + power((y - my) / sy - b, 2))
        FROM pts, m, (VALUES {cen}) t(c, a, b) GROUP BY id""").fetchall()
    assert {r.id: r.cluster_id for r in saved.transform(blobs).collect()} == dict(want)
