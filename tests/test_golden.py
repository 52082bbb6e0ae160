"""End-to-end: raw CSV fixtures -> Bronze -> Silver -> Gold, compared with the
published golden rows (exact ints, 4 dp ratios / scores, 2 dp prevalence)."""

import os

import pytest
from pyspark.sql import functions as F

from regiscope.plans import layers as L
from regiscope.sources.csv import read_csv
from regiscope.sources.tables import with_ingest_metadata

from .conftest import FIXTURES

GOLDEN = {
    # region: (populasi, stunting, gizi_buruk, gizi_kurang, underweight, burden, rs_umum, rs_khusus,
    #          posyandu, nakes, r_faskes, r_posyandu, r_nakes, prevalence, nci, nrs, rank)
    "KEPULAUAN SERIBU": (28800, 101, 10, 356, 240, 707, 1, 0, 37, 172,
                         14.1443, 12.8472, 59.7222, 0.35, 0.4715, 0.9171, 1),
    "JAKARTA BARAT": (2479600, 5016, 821, 4979, 3142, 13958, 21, 5, 855, 1258,
                      18.6273, 3.4481, 5.0734, 0.20, 0.0196, 0.6368, 2),
    "JAKARTA UTARA": (1815600, 4080, 329, 2339, 1226, 7974, 23, 2, 649, 8615,
                      31.3519, 3.5746, 47.4499, 0.22, 0.1869, 0.5747, 3),
    "JAKARTA TIMUR": (3086000, 5485, 1026, 3615, 1480, 11606, 32, 9, 1179, 8702,
                      35.3266, 3.8205, 28.1983, 0.18, 0.1643, 0.4788, 4),
    "JAKARTA PUSAT": (1044300, 1876, 81, 1469, 1401, 4827, 27, 8, 489, 14303,
                      72.5088, 4.6826, 136.9626, 0.18, 0.6324, 0.1719, 5),
    "JAKARTA SELATAN": (2230700, 3033, 191, 1193, 564, 4981, 37, 8, 1263, 11301,
                        90.3433, 5.6619, 50.6612, 0.14, 0.5271, 0.1309, 6),
}

RAW = {
    "gizi": ("balita_stunting.csv", ["periode_data", "wilayah", "kecamatan", "kategori_masalah_gizi", "jumlah"]),
    "nakes": ("jumlah_nakes.csv", ["periode_data", "wilayah", "kecamatan", "tenaga_kesehatan", "jumlah"]),
    "faskes": ("sebaran_rumahSakit.csv", ["Kabupaten/Kota", "Jumlah Rumah Sakit Umum",
                                          "Jumlah Rumah Sakit Khusus", "Jumlah Posyandu"]),
    "populasi": ("lajupertumbuhan.csv", ["Kabupaten/Kota", "Population (Thousand)", "Population Growth Rate",
                                         "Percentage of Total Population", "Population Density per sq.km (Km2)",
                                         "Population Sex Ratio"]),
}


@pytest.fixture(scope="module")
def bronze(spark):
    out = {}
    for name, (f, cols) in RAW.items():
        df = read_csv(spark, os.path.join(FIXTURES, f), cols)
        out[name] = with_ingest_metadata(df, "20250101_000000", "2025-01-01T00:00:00")
    return out


def test_raw_rename_and_bom(bronze):
    assert bronze["faskes"].columns[:4] == ["kabupaten_kota", "jumlah_rumah_sakit_umum",
                                            "jumlah_rumah_sakit_khusus", "jumlah_posyandu"]
    assert "population_density_per_sq_km_km2" in bronze["populasi"].columns


def test_missing_csv_gives_empty_frame(spark):
    df = read_csv(spark, "/nonexistent/path/x.csv", ["a", "b"])
    assert df.columns == ["a", "b"] and df.count() == 0


def test_silver_cleaning(bronze):
    s = L.silver(bronze)
    fas = {r.kabupaten_kota: (r.jumlah_rs_umum, r.jumlah_rs_khusus) for r in s["faskes_clean"].collect()}
    assert "DKI JAKARTA" not in fas and fas["KEPULAUAN SERIBU"] == (1, 0)
    pop = {r.kabupaten_kota: r.populasi for r in s["populasi_clean"].collect()}
    assert pop == {k: v[0] for k, v in GOLDEN.items()}
    agg = {r.kabupaten_kota: r for r in s["gizi_agregat"].collect()}
    assert agg["JAKARTA BARAT"]["GIZI BURUK"] == 821  # duplicate and negative rows dropped
    assert agg["JAKARTA BARAT"]["WASTING"] == 4 and agg["JAKARTA PUSAT"]["OVERWEIGHT"] == 0
    cats = {r.kategori_masalah_gizi for r in s["gizi_kecamatan_clean"].collect()}
    assert "OBESITAS" not in cats and "STUNTING" in cats


def test_gold_matches_golden_rows(spark, bronze):
    gold = L.gold_from_silver(L.silver(bronze), as_of=F.lit("2025-01-01T00:00:00"))
    rows = {r.kabupaten_kota: r for r in gold.collect()}
    assert set(rows) == set(GOLDEN)
    for k, g in GOLDEN.items():
        r = rows[k]
        ints = (r.populasi, r.total_stunting, r.total_gizi_buruk, r.total_gizi_kurang, r.total_underweight,
                r.total_balita_gizi_buruk, r.jumlah_rs_umum, r.jumlah_rs_khusus, r.jumlah_posyandu, r.total_nakes)
        assert ints == g[:10], k
        assert r.rasio_faskes_per_10k_balita == pytest.approx(g[10], abs=1e-4)
        assert r.rasio_posyandu_per_10k_populasi == pytest.approx(g[11], abs=1e-4)
        assert r.rasio_nakes_per_10k_populasi == pytest.approx(g[12], abs=1e-4)
        assert r.prevalensi_stunting_pct == pytest.approx(g[13], abs=1e-2)
        assert r.nutrition_coverage_index == pytest.approx(g[14], abs=1e-4)
        assert r.nutrition_risk_score == pytest.approx(g[15], abs=1e-4)
        assert r.priority_rank == g[16]
    assert dict(gold.dtypes)["priority_rank"] == "bigint" and dict(gold.dtypes)["total_nakes"] == "bigint"


def test_two_periods_do_not_fan_out(spark, bronze):
    s = L.silver(bronze)
    older = s["nakes_agregat"].withColumn("periode_data", F.col("periode_data") - 1) \
        .withColumn("total_nakes", F.lit(1).cast("bigint"))
    s["nakes_agregat"] = s["nakes_agregat"].unionByName(older)
    gold = L.gold_from_silver(s)
    assert gold.count() == 6
    assert {r.total_nakes for r in gold.collect()} == {g[9] for g in GOLDEN.values()}


def test_zero_burden_ranks_last_and_ties_share_rank(spark):
    from regiscope.plans import gold as G
    pop = spark.createDataFrame([("A", 100), ("B", 100), ("C", 100), ("D", 100)], "kabupaten_kota string, populasi int")
    bur = spark.createDataFrame([("A", 5, 1, 1, 1), ("B", 5, 1, 1, 1), ("C", 9, 0, 0, 0), ("D", 0, 0, 0, 0)],
                                "kabupaten_kota string, STUNTING long, `GIZI BURUK` long, `GIZI KURANG` long, UNDERWEIGHT long")
    fac = spark.createDataFrame([("A", 1, 1, 1), ("B", 1, 1, 1), ("C", 2, 0, 1)],
                                "kabupaten_kota string, jumlah_rs_umum int, jumlah_rs_khusus int, jumlah_posyandu int")
    wrk = spark.createDataFrame([("A", 10), ("B", 10), ("C", 10), ("D", 10)], "kabupaten_kota string, total_nakes long")
    g = {r.kabupaten_kota: r for r in G.gold(pop, bur, fac, wrk, period=None).collect()}
    assert g["D"].rasio_faskes_per_10k_balita is None and g["D"].nutrition_risk_score is None
    assert g["D"].priority_rank == 4
    assert g["A"].priority_rank == g["B"].priority_rank
    assert sorted(r.priority_rank for r in g.values()) in ([1, 1, 3, 4], [1, 2, 2, 4])
    # all regions have the same worker ratio -> norm 0, inverse 1
    assert all(r.jumlah_posyandu is not None for r in g.values())


def test_whole_job_from_csv_files(spark):
    from regiscope.session import scratch_path
    base = scratch_path(spark, "job")
    res = L.run(spark, FIXTURES, base, "20250101_000000", "2025-01-01T00:00:00",
                as_of=F.lit("2025-01-01 00:00:00").cast("timestamp"))
    assert res["messages"] == {"gizi-raw": 53, "faskes-raw": 7, "nakes-raw": 30, "populasi-raw": 11}
    # 48 + WASTING; duplicate, negative, non-numeric and unknown category dropped
    assert res["silver_rows"] == {"gizi_kecamatan_clean": 49, "gizi_agregat": 6, "faskes_clean": 6,
                                  "nakes_kecamatan_clean": 30, "nakes_agregat": 6, "populasi_clean": 6}
    fin = {r.kabupaten_kota: r for r in res["final"].collect()}
    assert len(fin) == 6 and len(res["final"].columns) == 23
    for k, g in GOLDEN.items():
        assert fin[k].priority_rank == g[16]
        assert fin[k].nutrition_risk_score == pytest.approx(g[15], abs=1e-4)
    assert fin["KEPULAUAN SERIBU"].last_updated == "2025-01-01T00:00:00"
    # the planted-outlier behaviour of the golden run: Kepulauan Seribu is the
    # most isolated region and the only one flagged at contamination 0.15
    worst = min(fin.values(), key=lambda r: r.anomaly_score)
    assert worst.kabupaten_kota == "KEPULAUAN SERIBU" and worst.is_anomaly
    assert sum(r.is_anomaly for r in fin.values()) == 1
    assert fin["KEPULAUAN SERIBU"].cluster_label == "Risiko Tinggi"
    assert {fin[k].cluster_label for k in ("JAKARTA PUSAT", "JAKARTA SELATAN")} == {"Risiko Rendah"}
    sweep = {r.k: r.wsse for r in res["k_sweep"].collect()}
    assert sorted(sweep) == [2, 3, 4, 5] and sweep[3] == pytest.approx(3.353, abs=5e-3)
    assert res["silhouette"] == pytest.approx(0.633, abs=5e-4)
    flagged = {(round(r.contamination, 2), r.kabupaten_kota) for r in res["flagged"].collect()}
    assert {c for c, k in flagged if k == "KEPULAUAN SERIBU"} == {0.1, 0.15, 0.2}
    # tables and models as a later process reads them
    from regiscope.operators.iforest import Model
    from regiscope.sources.versions import VersionedTable
    assert VersionedTable(spark, f"{base}/gold/wilayah_final").read().count() == 6
    assert VersionedTable(spark, f"{base}/serving/display").read().count() == 6
    saved = Model.load(spark, f"{base}/models/iforest")
    gold = VersionedTable(spark, f"{base}/gold/wilayah_risk_score").read()
    scores = {r.kabupaten_kota: r for r in saved.score(gold).collect()}
    assert all(scores[k].anomaly_score == pytest.approx(r.anomaly_score, abs=1e-6) and scores[k].is_anomaly == r.is_anomaly
               for k, r in fin.items())
    # serving tables over the golden final: the dashboard figures of the source
    from regiscope.plans import serve as SV
    summ = SV.dashboard_summary(res["final"]).first()
    assert summ.n_rows == 6 and summ.avg_nutrition_risk_score == pytest.approx(0.485, abs=5e-4)
    assert (summ.sum_jumlah_posyandu, summ.sum_total_nakes, summ.n_is_anomaly) == (4472, 44351, 1)
    hl = {r.metric: (r.kabupaten_kota, r.value) for r in SV.highlights(res["final"]).collect()}
    assert hl == {"highest_risk": ("KEPULAUAN SERIBU", 0.9171), "best_coverage": ("JAKARTA PUSAT", 0.6324)}
    ins = [r.body for r in SV.insights(res["final"]).collect()]
    assert ins[0] == "KEPULAUAN SERIBU memiliki Nutrition Risk Score tertinggi (0.9171)" and ins[1] == "JAKARTA PUSAT"
    listing = SV.anomaly_listing(res["final"]).collect()
    assert listing[0].kabupaten_kota == "KEPULAUAN SERIBU"
    assert [r.anomaly_score for r in listing] == sorted(r.anomaly_score for r in listing)
    disp = {r.kabupaten_kota: r for r in SV.display(res["final"]).collect()}
    assert disp["KEPULAUAN SERIBU"].rank_tier == "1" and disp["JAKARTA UTARA"].rank_tier == "top"
    assert disp["JAKARTA PUSAT"].coverage_pct == 63 and disp["KEPULAUAN SERIBU"].anomaly_label == "Ya"


def test_k_sweep_reproduces_measured_figures(spark, bronze):
    """WSSE / silhouette per k on the golden features, rows in rank order in
    """
    from regiscope.operators import cluster as CL
    from regiscope.operators import stats as ST
    g = L.gold_from_silver(L.silver(bronze))
    feats = ST.impute_quantile(g, L.FEATURE_COLS, "disc").orderBy("priority_rank").coalesce(1).cache()
    got = {r.k: (r.wsse, r.silhouette) for r in CL.k_sweep_mllib(feats, L.FEATURE_COLS, [2, 3, 4]).collect()}
    assert got[2] == (pytest.approx(14.42, abs=5e-3), pytest.approx(0.454, abs=5e-4))
    assert got[3] == (pytest.approx(3.353, abs=5e-3), pytest.approx(0.633, abs=5e-4))
    assert got[4] == (pytest.approx(1.046, abs=5e-3), pytest.approx(0.437, abs=5e-4))


def test_final_guards_empty_and_single_region(spark, bronze):
    g = L.gold_from_silver(L.silver(bronze), as_of=F.lit("2025-01-01 00:00:00").cast("timestamp"))
    empty = L.final(g.where(F.lit(False)))
    assert empty.count() == 0 and len(empty.columns) == 23
    assert dict(empty.dtypes)["cluster_id"] == "int" and dict(empty.dtypes)["is_anomaly"] == "boolean"
    one = L.final(g.where(F.col("kabupaten_kota") == "JAKARTA BARAT")).collect()
    assert len(one) == 1 and one[0].cluster_label == "Risiko Rendah" and one[0].cluster_id == 0
    assert one[0].is_anomaly is False


def test_map_layer_colours(spark):
    from regiscope.plans import serve as SV
    df = spark.createDataFrame([("A", "Risiko Tinggi", 0.91714, None, 0.351, 1, True),
                                ("B", None, None, 0.2, None, 2, False)],
                               "kabupaten_kota string, cluster_label string, nutrition_risk_score double, "
                               "nutrition_coverage_index double, prevalensi_stunting_pct double, "
                               "priority_rank int, is_anomaly boolean")
    rows = {r.kabupaten_kota: r for r in SV.map_layer(df).collect()}
    assert rows["A"].fill_color == "#e74c3c" and rows["A"].tooltip_nrs == 0.9171 and rows["A"].tooltip_nci is None
    assert rows["B"].fill_color == "lightgrey" and rows["B"].tooltip_nrs is None and rows["B"].tooltip_anomaly == "Tidak"


def test_a_second_run_replaces_the_first(spark, tmp_path):
    base = str(tmp_path / "job")
    first = L.run(spark, FIXTURES, base, "20240131_000000", "2024-01-31T00:00:00")
    rows = {r.kabupaten_kota for r in first["final"].collect()}
    again = L.run(spark, FIXTURES, base, "20240201_000000", "2024-02-01T00:00:00")
    assert again["silver_rows"] == first["silver_rows"]
    for name, n in first["silver_rows"].items():
        assert L.read_silver(spark, f"{base}/silver")[name].count() == n
    fin = again["final"].collect()
    assert len(fin) == len(rows) == 6 and {r.kabupaten_kota for r in fin} == rows
    text = spark.read.text(f"{base}/export/wilayah_final_json").collect()
    assert len(text) == 6 and all('"anomaly_score":' in r.value for r in text)


def test_a_key_without_period_keeps_its_rows(spark):
    from regiscope.operators.join import latest_period
    df = spark.createDataFrame([("a", None, 1), ("b", 2023, 2), ("b", 2024, 3)], "k string, p int, v int")
    assert sorted(r.v for r in latest_period(df, ["k"], "p").collect()) == [1, 3]


def test_csv_columns_by_name(spark, tmp_path):
    from regiscope.sources.csv import read_csv
    p = tmp_path / "x.csv"
    p.write_text("﻿wilayah,periode_data\nJAKARTA,2023\n", encoding="utf-8")
    got = read_csv(spark, str(p), ["periode_data", "wilayah", "jumlah"]).first()
    assert (got.periode_data, got.wilayah, got.jumlah) == ("2023", "JAKARTA", None)
    assert read_csv(spark, str(tmp_path / "none.csv"), ["a"]).count() == 0
