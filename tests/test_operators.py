import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from regiscope.operators import aggregate as AGG
from regiscope.operators import clean as CLN
from regiscope.operators import cluster as CL
from regiscope.operators import join as J
from regiscope.operators import rank as RK
from regiscope.operators import stats as ST


def test_dedupe_keeps_latest_and_is_idempotent(spark):
    df = spark.createDataFrame([
        ("k1", "2024-01-01T00:00:00", 5), ("k1", "2024-02-01T00:00:00", 7), ("k2", "2024-01-01T00:00:00", 1),
    ], "k string, ingested_at string, v int")
    once = CLN.dedupe_latest(df, ["k"], ["ingested_at"])
    got = sorted((r.k, r.v) for r in once.collect())
    assert got == [("k1", 7), ("k2", 1)]
    twice = CLN.dedupe_latest(once, ["k"], ["ingested_at"])
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, once.collect()))


def test_dedupe_plan_is_a_partial_aggregate(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    plan = CLN.dedupe_latest(df, ["k"], ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "partial" in plan.lower()


def test_drop_sentinels(spark):
    df = spark.createDataFrame([(x,) for x in [None, "", "Catatan", "Hasil proyeksi", "Laju x", "DKI Jakarta",
                                                "Kepulauan Seribu"]], "x string")
    kept = CLN.drop_sentinels(df, "x", ["DKI JAKARTA", "", "CATATAN"], ["HASIL", "LAJU"])
    assert [r.x for r in kept.collect()] == ["Kepulauan Seribu"]


def test_filters(spark):
    df = spark.createDataFrame([(-1,), (None,), (0,), (4,)], "v int")
    assert [r.v for r in CLN.keep_non_negative(df, "v").collect()] == [0, 4]
    assert [r.v for r in CLN.keep_positive(df, "v").collect()] == [4]


def test_min_max_constant_null_and_range(spark):
    df = spark.createDataFrame([(1, 2.0, 5.0), (2, 4.0, 5.0), (3, None, 5.0), (4, 6.0, 5.0)],
                               "id int, a double, b double")
    out = {r.id: (r.a_norm, r.b_norm) for r in ST.min_max_normalize(df, ["a", "b"]).collect()}
    assert out[1] == (0.0, 0.0) and out[2] == (0.5, 0.0) and out[3] == (None, 0.0) and out[4] == (1.0, 0.0)


def test_min_max_has_no_single_partition_window(spark):
    df = spark.range(1000).select(F.col("id").cast("double").alias("x"))
    plan = ST.min_max_normalize(df, ["x"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Broadcast" in plan


def test_min_max_per_group(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 5.0)], "g string, x double")
    out = {(r.g, r.x): r.x_norm for r in ST.min_max_normalize(df, ["x"], partition_by=["g"]).collect()}
    assert out == {("a", 1.0): 0.0, ("a", 3.0): 1.0, ("b", 5.0): 0.0}


@pytest.mark.parametrize("dense", [False, True])
def test_distributed_rank_equals_window_rank(spark, dense):
    rnd = random.Random(7)
    rows = [(i, None if rnd.random() < 0.05 else float(rnd.randint(0, 60))) for i in range(3000)]
    rows += [(10_000 + i, 30.0) for i in range(1500)]  # one hot value: a quarter of all rows
    df = spark.createDataFrame(rows, "id long, s double")
    got = {r.id: r.rk for r in RK.rank(df, "s", out="rk", dense=dense, buckets=7).collect()}
    fn = F.dense_rank() if dense else F.rank()
    ref = {r.id: r.rk for r in df.withColumn("rk", fn.over(Window.orderBy(F.col("s").desc_nulls_last()))).collect()}
    assert got == ref


def test_rank_ascending_ties(spark):
    df = spark.createDataFrame([(1, 0.5), (2, 0.9), (3, 0.5), (4, None)], "id int, s double")
    got = {r.id: r.rk for r in RK.rank(df, "s", out="rk", descending=False).collect()}
    assert got == {1: 1, 3: 1, 2: 3, 4: 4}


@pytest.mark.parametrize("bits", [2, 7, 12])
def test_exact_quantiles_match_numpy(spark, bits):
    rnd = np.random.default_rng(3)
    a = rnd.normal(size=2001).round(3)
    b = rnd.integers(0, 5, size=2001).astype(float)
    df = spark.createDataFrame([(float(x), float(y)) for x, y in zip(a, b)], "a double, b double")
    probs = [0.0, 0.1, 0.15, 0.5, 0.9, 1.0]
    q = {(r.name, r.p): r.value for r in ST.exact_quantiles(df, ["a", "b"], probs, "cont", bits=bits).collect()}
    for p in probs:
        assert q[("a", p)] == pytest.approx(float(np.quantile(a, p)), abs=1e-9)
        assert q[("b", p)] == pytest.approx(float(np.quantile(b, p)), abs=1e-9)


def test_exact_quantiles_nan_infinity_and_hot_value(spark):
    vals = [5.0, float("nan"), 1.0, 4.0, 2.0, 3.0, None]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    assert ST.exact_quantiles(df, ["x"], [0.5], "disc").first().value == 3.0
    wide = [float("-inf"), -1.7e308, 5e-324, 0.0, 1.7e308, float("inf"), float("inf")]
    df = spark.createDataFrame([(v,) for v in wide], "x double")
    got = [r.value for r in ST.exact_quantiles(df, ["x"], [0.0, 0.2, 0.5, 0.7, 1.0], "disc", bits=3).collect()]
    assert got == [float("-inf"), -1.7e308, 5e-324, 1.7e308, float("inf")]
    # a quarter of a million rows, a third of them equal
    df = spark.range(250_000).select(F.when(F.col("id") % 3 == 0, F.lit(0.5)).otherwise(F.col("id") / 250_000).alias("x"))
    want = np.quantile(df.toPandas()["x"], [0.15, 0.5, 0.99])
    got = [r.value for r in ST.exact_quantiles(df, ["x"], [0.15, 0.5, 0.99], "cont").collect()]
    assert got == pytest.approx(list(want), abs=1e-12)


def test_quantile_passes_do_not_depend_on_the_spread(spark, monkeypatch):
    """Normal and log-uniform values take the same passes, never more than six."""
    seen = []
    count = ST._counted
    monkeypatch.setattr(ST, "_counted", lambda *a: seen.append(1) or count(*a))
    rnd = np.random.default_rng(2)
    passes = []
    wide = rnd.integers(-(1 << 63), (1 << 63) - 1, 20_000).view(np.float64)  # any bits
    for v in (rnd.normal(size=20_000), np.exp(rnd.uniform(-650, 650, 20_000)), 1 + np.arange(20_000) * 2.0 ** -50,
              wide[np.isfinite(wide)], np.concatenate([np.arange(9000) * 5e-324, [0.0, -0.0] * 500, [-np.inf, np.inf] * 9])):
        df = spark.createDataFrame([(float(x),) for x in v], "x double")
        seen.clear()
        got = ST.quantile_values(df, ["x"], [0.3], "disc")
        assert got[("x", 0.3)] == sorted(v)[int(np.ceil(0.3 * len(v))) - 1]
        passes.append(len(seen))
    assert passes[0] == passes[1] and max(passes) <= 6


def test_rank_with_infinities(spark):
    df = spark.createDataFrame([(1, float("inf")), (2, float("-inf")), (3, 0.5), (4, float("inf"))], "id int, s double")
    assert {r.id: r.rk for r in RK.rank(df, "s", out="rk").collect()} == {1: 1, 4: 1, 3: 3, 2: 4}


def test_median_fill_low_and_mid(spark):
    df = spark.createDataFrame([(1, 1.0, None), (2, 3.0, None), (3, None, None)], "id int, x double, y double")
    low = {r.id: (r.x, r.y) for r in ST.impute_quantile(df, ["x", "y"], "disc").collect()}
    mid = {r.id: (r.x, r.y) for r in ST.impute_quantile(df, ["x", "y"], "cont").collect()}
    assert low[3] == (1.0, 0.0)
    assert mid[3] == (2.0, None)


def test_zscore_sample_and_population(spark):
    vals = [1.0, 2.0, 4.0, 7.0]
    df = spark.createDataFrame([(v, 3.0) for v in vals], "x double, c double")
    s = [r.x_z for r in ST.zscore(df, ["x", "c"], ddof=1).collect()]
    p = [r.x_z for r in ST.zscore(df, ["x", "c"], ddof=0).collect()]
    arr = np.array(vals)
    assert s == pytest.approx(list((arr - arr.mean()) / arr.std(ddof=1)))
    assert p == pytest.approx(list((arr - arr.mean()) / arr.std(ddof=0)))
    assert {r.c_z for r in ST.zscore(df, ["c"]).collect()} == {0.0}


def test_quantile_flag_share(spark):
    df = spark.range(2000).select(F.col("id"), (F.col("id") * 0.5).alias("s"))
    flagged = ST.flag_below_quantile(df, "s", 0.15).where("is_anomaly").count()
    assert flagged == 300


def test_pivot_sum_fills_absent(spark):
    df = spark.createDataFrame([("r1", "A", 2), ("r1", "A", 3), ("r2", "B", 1)], "k string, c string, v int")
    out = {r.k: (r.A, r.B, r.C) for r in AGG.pivot_sum(df, ["k"], "c", ["A", "B", "C"], "v").collect()}
    assert out == {"r1": (5, 0, 0), "r2": (0, 1, 0)}


def test_arg_max_ties(spark):
    df = spark.createDataFrame([("x", 0.5, 2), ("y", 0.9, 1), ("z", 0.9, 3)], "k string, s double, t int")
    assert AGG.arg_max(df, "s", ["t"], ["k", "s"]).first().k == "y"
    assert AGG.arg_max(df, "s", ["k"], ["k", "s"]).first().k == "y"


def test_left_join_missing_region_gives_zero_after_fill(spark):
    m = spark.createDataFrame([("A", 10), ("B", 20)], "k string, pop int")
    f = spark.createDataFrame([("A", 3)], "k string, fac int")
    out = {r.k: r.fac for r in J.left_join_all(m, [f], ["k"]).na.fill(0, ["fac"]).collect()}
    assert out == {"A": 3, "B": 0}


def test_assert_unique_and_latest_period(spark):
    d = spark.createDataFrame([("A", 2019, 1), ("A", 2020, 2)], "k string, p int, v int")
    with pytest.raises(J.DuplicateKeyError):
        J.assert_unique(d, ["k"])
    assert [r.v for r in J.latest_period(d, ["k"], "p").collect()] == [2]


def test_best_overlap(spark):
    long = spark.createDataFrame([("ID", "1"), ("ID", "2"), ("NAMOBJ", "JAKARTA BARAT"),
                                  ("NAMOBJ", "KEPULAUAN SERIBU"), ("OTHER", "JAKARTA BARAT")],
                                 "field string, value string")
    ref = spark.createDataFrame([("JAKARTA BARAT",), ("KEPULAUAN SERIBU",)], "value string")
    best = J.best_overlap(long, ref, field_order=["ID", "NAMOBJ", "OTHER"]).first()
    assert (best.field, best.score) == ("NAMOBJ", 2)


def test_silhouette_closed_form_matches_mllib(spark):
    from pyspark.ml.feature import VectorAssembler
    rnd = np.random.default_rng(1)
    pts = np.vstack([rnd.normal(c, 0.4, size=(40, 2)) for c in (0, 3, 6)])
    df = spark.createDataFrame([(float(x), float(y)) for x, y in pts], "x double, y double")
    centres = [(0.0, 0.0), (3.0, 3.0), (6.0, 6.0)]
    a = CL.assign_nearest(df, ["x", "y"], centres)
    closed = CL.silhouette_closed_form(a, ["x", "y"]).first().silhouette
    vec = VectorAssembler(inputCols=["x", "y"], outputCol="features").transform(a)
    assert closed == pytest.approx(CL.silhouette(vec), abs=1e-9)
    w = CL.wsse(a, ["x", "y"], centres).first().wsse
    expect = sum(min((x - cx) ** 2 + (y - cy) ** 2 for cx, cy in centres) for x, y in pts)
    assert w == pytest.approx(expect)


def test_label_by_mean_is_monotone(spark):
    df = spark.createDataFrame([(0, 0.9), (0, 0.8), (1, 0.1), (2, 0.5), (3, 0.99)], "cluster_id int, s double")
    lab = {r.cluster_id: r.cluster_label for r in CL.label_by_mean(df, "cluster_id", "s").collect()}
    assert lab == {1: "Risiko Rendah", 2: "Risiko Sedang", 0: "Risiko Tinggi", 3: "Risiko Tinggi"}


def test_hot_score_rows_spread_over_tasks(spark):
    """Half the rows share one score; after the salted lookup they sit in
    many partitions (a plain hash join on the score would put them in one)."""
    prev = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = spark.range(20000).select(F.col("id"), F.when(F.col("id") % 2 == 0, F.lit(7.0))
                                       .otherwise(F.col("id").cast("double")).alias("s"))
        ranked = RK.rank(df, "s", out="rk", buckets=4)
        parts = (ranked.where(F.col("s") == 7.0).select(F.spark_partition_id().alias("p"))
                 .distinct().count())
        assert parts >= 4
        hot = ranked.where(F.col("s") == 7.0).select("rk").distinct().collect()
        assert [r.rk for r in hot] == [9997]  # 1 + number of odd ids above 7
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", prev)


def test_rank_all_null_and_empty(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "id int, s double")
    assert {r.rk for r in RK.rank(df, "s", out="rk").collect()} == {1}
    empty = spark.createDataFrame([], "id int, s double")
    assert RK.rank(empty, "s", out="rk").count() == 0


@pytest.mark.parametrize("dense", [False, True])
@pytest.mark.parametrize("hot", [10, 10_000])
def test_rank_within_equals_window_rank(spark, monkeypatch, dense, hot):
    monkeypatch.setattr(RK, "HOT_FRACTION", hot)
    rnd = random.Random(8)
    rows = [(i, rnd.choice(["a", "a", "a", "b", None]), rnd.randrange(3), None if rnd.random() < 0.05 else float(rnd.randint(0, 90)))
            for i in range(3000)]
    rows += [(10_000 + i, "a", 1, 30.0) for i in range(1500)]  # one hot score of one hot group
    rows += [(20_000 + i, f"s{i}", 0, float("inf")) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, g string, `h.x` int, s double")
    for group in (["g"], ["g", "h.x"]):
        for desc in (True, False):
            got = {r.id: r.rk for r in RK.rank_within(df, group, "s", out="rk", dense=dense, descending=desc, buckets=7).collect()}
            order = F.col("s").desc_nulls_last() if desc else F.col("s").asc_nulls_last()
            fn = F.dense_rank() if dense else F.rank()
            w = Window.partitionBy(*[F.col(f"`{c}`") for c in group]).orderBy(order)
            assert got == {r.id: r.rk for r in df.withColumn("rk", fn.over(w)).collect()}
    assert RK.rank_within(df.limit(0), ["g"], "s").count() == 0


@pytest.mark.parametrize("lg", [5, 14])
def test_best_overlap_wide_is_exact(spark, lg):
    """Sampled sketches leave columns over that are counted; whole ones tell."""
    df = spark.range(6000).select(
        F.col("id").alias("a"), (F.col("id") % 900).alias("b.c"), (F.col("id") + 3001).alias("d"), F.lit("").alias("e"),
        (F.col("id") + 3000).alias("f"), F.lit(None).cast("string").alias("g"))
    ref = spark.range(3000, 9000).select(F.col("id").cast("string").alias("value")).unionByName(
        spark.createDataFrame([("",)], "value string"))
    bounds = J.overlap_bounds(df, df.columns, ref, lg_entries=lg)
    want = {"a": 3000, "b.c": 0, "d": 5999, "e": 1, "f": 6000, "g": 0}
    assert all(bounds[f][0] <= n <= bounds[f][1] for f, n in want.items())
    assert tuple(J.best_overlap_wide(df, df.columns, ref, lg_entries=lg).first()) == ("f", 6000)
    assert tuple(J.best_overlap_wide(df, ["b.c", "e", "g"], ref, lg_entries=lg).first()) == ("e", 1)
    assert tuple(J.best_overlap_wide(df.limit(0), ["a", "d"], ref, lg_entries=lg).first()) == ("a", 0)


@pytest.mark.parametrize("lg", [5, 14])
def test_best_overlap_wide_with_sources_is_exact(spark, lg):
    """The join loses what the sources promise: the columns left behind are
    looked at when they may win, and ties go to the earliest."""
    a = spark.range(4000).select(F.col("id").alias("a"), (F.col("id") % 7).alias("a.k"), F.lit("none").alias("z"))
    b = spark.range(3000).select(F.when(F.col("id") > 5, 20000).otherwise(F.col("id") % 7).alias("k"), (F.col("id") % 900).alias("b"))
    ref = spark.range(3900).select(F.col("id").cast("int").alias("value")).unionByName(spark.createDataFrame([(None,)], "value int"))
    for left, keep in ((a, F.col("a") > 3800), (a, F.col("a") < 0), (a, F.col("a") > 3898), (
            a.union(a).union(spark.createDataFrame([(None, 1, None)], "a long, k long, z string")), F.lit(True))):
        df = left.join(b, F.col("`a.k`") == F.col("k")).where(keep)
        rows = df.collect()
        for fields in (["z", "a", "b", "k", "a.k"], ["k", "a.k", "z"]):
            n = {f: len({str(r[f]) for r in rows if r[f] is not None} & {str(i) for i in range(3900)}) for f in fields}
            want = max(fields, key=lambda f: n[f])  # the first of the greatest
            got = J.best_overlap_wide(df, fields, ref, lg_entries=lg, sources=[left, b]).collect()
            assert [tuple(r) for r in got] == [(want, n[want])], (fields, n)


def test_q64_joins_only_columns_that_may_match(spark, tmp_path, monkeypatch):
    """What is shuffled is the keys, not whole rows of five tables; repeated and NULL keys stay exact."""
    import duckdb
    from regiscope.plans.catalog import QUERIES
    from regiscope.plans.oracle_sql import SQL
    sql = {
        "nation": "SELECT range::INT AS n_nationkey, 'N' || range AS n_name FROM range(5)",
        "customer": "SELECT nullif(range, 3) AS c_custkey, (range % 6)::INT AS c_nationkey, 'Customer ' || range AS c_name FROM range(60)",
        "part": "SELECT nullif(range % 390, 7) AS p_partkey, 'part ' || range AS p_name, 9.5 AS p_retailprice FROM range(400)",
        "orders": "SELECT range AS o_orderkey, nullif(range % 70, 5) AS o_custkey, 1.5 * range AS o_totalprice, 'O' AS o_orderstatus FROM range(900)",
        "lineitem": """SELECT nullif(range % 880, 9) AS l_orderkey, range * 7 % 500 AS l_partkey, range % 10 AS l_suppkey, (range % 4)::INT AS l_linenumber,
                       'R' AS l_returnflag, 0.25 * range AS l_extendedprice FROM range(3000)"""}
    con = duckdb.connect()
    for t, q in sql.items():
        con.sql(f"COPY ({q}) TO '{tmp_path}/{t}.parquet' (FORMAT parquet)")
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet'")
    own = [set(con.sql(f"SELECT * FROM {t}").columns) for t in sql]
    seen, plain = [], J.overlap_bounds

    def bounds(df, fields, *args, **kwargs):
        if not any(set(df.columns) <= o for o in own):
            seen.append(list(fields))
        return plain(df, fields, *args, **kwargs)

    monkeypatch.setattr(J, "overlap_bounds", bounds)
    got = QUERIES["q64_field_detect_wide"](spark, str(tmp_path)).collect()
    assert [tuple(r) for r in got] == con.sql(SQL["q64_field_detect_wide"]).fetchall()
    assert seen and all(f.endswith("key") for fields in seen for f in fields)
