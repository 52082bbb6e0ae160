import json

import pytest

from regiscope.operators import geo as GEO
from regiscope.session import scratch_path


def _write_geojson(spark, path):
    fc = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"ID": "1", "NAMOBJ": "KOTA ADMINISTRASI JAKARTA BARAT"},
         "geometry": {"type": "Polygon", "coordinates": [[[106.7, -6.2], [106.8, -6.1], [106.75, -6.25], [106.7, -6.2]]]}},
        {"type": "Feature", "properties": {"ID": "2", "NAMOBJ": "Kep. Seribu"},
         "geometry": {"type": "MultiPolygon", "coordinates": [[[[106.5, -5.6], [106.6, -5.5], [106.55, -5.7], [106.5, -5.6]]],
                                                             [[[106.4, -5.9], [106.45, -5.8], [106.42, -5.95], [106.4, -5.9]]]]}},
        {"type": "Feature", "properties": {"ID": "3", "NAMOBJ": "Bogor"},
         "geometry": {"type": "Polygon", "coordinates": [[[106.8, -6.6], [106.9, -6.5], [106.85, -6.7], [106.8, -6.6]]]}},
    ]}
    spark.sparkContext.parallelize([json.dumps(fc)], 1).saveAsTextFile(path)


def test_geojson_detect_join_bounds(spark):
    from pyspark.sql import types as T
    path = scratch_path(spark, "geo")
    _write_geojson(spark, path)
    props = T.StructType([T.StructField("ID", T.StringType()), T.StructField("NAMOBJ", T.StringType())])
    feats = GEO.read_geojson(spark, path, props)
    assert feats.count() == 3
    ref = spark.createDataFrame([("JAKARTA BARAT",), ("KEPULAUAN SERIBU",), ("JAKARTA PUSAT",)], "value string")
    best = GEO.detect_name_field(feats, ["ID", "NAMOBJ"], ref).first()
    assert (best.field, best.score) == ("NAMOBJ", 2)
    scores = spark.createDataFrame([("JAKARTA BARAT", 0.6), ("KEPULAUAN SERIBU", 0.9)],
                                   "kabupaten_kota string, nutrition_risk_score double")
    joined = {r.ID: (r.wilayah_key, r.nutrition_risk_score) for r in GEO.join_boundaries(feats, "NAMOBJ", scores).collect()}
    assert joined == {"1": ("JAKARTA BARAT", 0.6), "2": ("KEPULAUAN SERIBU", 0.9), "3": ("BOGOR", None)}
    b = GEO.total_bounds(GEO.feature_bounds(feats)).first()
    assert (b.minx, b.miny, b.maxx, b.maxy) == (106.4, -6.7, 106.9, -5.5)


def test_boundary_layer_in_one_step(spark):
    from pyspark.sql import types as T
    from regiscope.plans import serve as SV
    path = scratch_path(spark, "geo")
    _write_geojson(spark, path)
    props = T.StructType([T.StructField("ID", T.StringType()), T.StructField("NAMOBJ", T.StringType())])
    feats = GEO.read_geojson(spark, path, props)
    final = spark.createDataFrame(
        [("JAKARTA BARAT", 0.61238, 0.5, 3.456, 2, "Risiko Sedang", False), ("KEPULAUAN SERIBU", None, 0.1, None, 1, None, True)],
        "kabupaten_kota string, nutrition_risk_score double, nutrition_coverage_index double, "
        "prevalensi_stunting_pct double, priority_rank long, cluster_label string, is_anomaly boolean")
    with pytest.warns(UserWarning, match="matches only 2 regions"):
        layer = SV.boundary_layer(feats, ["ID", "NAMOBJ"], final)
    got = {r.label: r for r in layer.collect()}
    assert set(got) == {"Kota Administrasi Jakarta Barat", "Kep. Seribu", "Bogor"}
    r = got["Kota Administrasi Jakarta Barat"]
    assert (r.name_field, r.fill_color, r.tooltip_nrs, r.tooltip_prevalence, r.tooltip_anomaly) == (
        "NAMOBJ", "#f39c12", 0.6124, 3.46, "Tidak")
    assert (got["Bogor"].fill_color, got["Bogor"].tooltip_anomaly, got["Bogor"].maxy) == ("lightgrey", None, -6.5)
    assert (got["Kep. Seribu"].minx, got["Kep. Seribu"].fill_color, got["Kep. Seribu"].tooltip_anomaly) == (106.4, "lightgrey", "Ya")
    assert {(r.map_minx, r.map_miny, r.map_maxx, r.map_maxy) for r in got.values()} == {(106.4, -6.7, 106.9, -5.5)}
