"""GeoJSON read in splits, ordered tables, statistics of hot groups."""

import json
import random
import warnings

import pytest
from pyspark.sql import functions as F

from regiscope.operators import geo as GEO
from regiscope.operators import stats as ST
from regiscope.session import scratch_path
from regiscope.sources.ordered import OrderedTable


def feature(i, **more):
    x = float(i)
    return {"type": "Feature", "properties": {"name": f"R{i}", **more},
            "geometry": {"type": "Polygon", "coordinates": [[[x, 0.0], [x + 1, 0.0], [x + 1, 2.0], [x, 0.0]]]}}


def read(spark, path):
    return sorted((r.properties["name"], r.geometry_type, r.rings[0][0][0]) for r in GEO.read_geojson(spark, path).collect())


@pytest.mark.parametrize("indent", [None, 1])
def test_one_geojson_file_is_read_by_many_tasks(spark, tmp_path, indent):
    n = 400
    whole = {"type": "FeatureCollection", "name": "x", "crs": {"type": "name", "properties": {"name": "c"}},
             "features": [feature(i, note='a "quoted" } ] text') for i in range(n)]}
    p = tmp_path / "x.json"
    p.write_text(json.dumps(whole, indent=indent))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        got = GEO.read_geojson(spark, str(p))
        assert GEO._split_features(spark, str(p)) is not None and got.rdd.getNumPartitions() > 4
        assert read(spark, str(p)) == sorted((f"R{i}", "Polygon", float(i)) for i in range(n))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old[0])
        spark.conf.set("spark.sql.files.openCostInBytes", old[1])


def test_geojson_that_cannot_be_split_is_read_whole(spark, tmp_path):
    a, b = feature(1), feature(2)
    cases = [[{"id": 1, **a}, b], [feature(1, kind="Feature"), b], [], [a]]
    for k, feats in enumerate(cases):
        p = tmp_path / f"{k}.json"
        p.write_text(json.dumps({"type": "FeatureCollection", "features": feats, "bbox": [1, 2]} if k == 1 else
                                {"type": "FeatureCollection", "features": feats}))
        assert (GEO._split_features(spark, str(p)) is None) == (k < 3)
        assert [x[0] for x in read(spark, str(p))] == [f["properties"]["name"] for f in feats]
    with warnings.catch_warnings(record=True) as seen:
        warnings.simplefilter("always")
        assert GEO.read_geojson_properties(spark, str(tmp_path / "none.json")) is None
    assert any("no boundary file" in str(w.message) for w in seen)


def test_geojson_round_trip_with_null_geometry(spark):
    df = spark.range(50).select(F.col("id").cast("string").alias("name"), F.when(
        F.col("id") % 7 > 0, F.array(F.array(F.array(F.lit(1.0), F.col("id").cast("double"))))).alias("rings")).repartition(3)
    path = scratch_path(spark, "geojson")
    GEO.write_geojson(df, path, ["name"])
    back = {r.properties["name"]: r.rings for r in GEO.read_geojson(spark, path).collect()}
    assert back == {r.name: r.rings for r in df.collect()}
    got, names = GEO.read_geojson_properties(spark, path)
    assert names == ["name"] and got.count() == 50


def test_ordered_table_reads_only_the_parts_it_needs(spark):
    rnd = random.Random(1)
    rows = [(i, rnd.choice([None, *range(40)]) if i % 3 else 7) for i in range(900)]
    df = spark.createDataFrame(rows, "id long, v int")
    t = OrderedTable(spark, scratch_path(spark, "ordered"), df.schema, [F.desc("v"), "id"])
    t.write(df.repartition(4), parts=12)
    want = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
    assert sum(n for _, _, n in t.parts()) == 900 and len(t.parts()) > 6
    for first, last in ((1, 10), (300, 420), (895, 2000), (901, 950)):
        got = [(r.place, r.id, r.v) for r in t.places(first, last).orderBy("place").collect()]
        assert got == [(first + i, *r) for i, r in enumerate(want[first - 1:last])]
    files = t.top(10).inputFiles()
    assert len(files) < len(t._rows().inputFiles())
    whole = [tuple(r)[:2] for r in t._rows().orderBy("__part", F.desc("v"), "id").collect()]
    assert whole == want  # the parts one after the other are the table in order


def test_group_statistics_of_hot_and_null_groups(spark):
    df = spark.range(30_000).select("id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 1000 == 1, None).otherwise(
        F.concat(F.lit("g"), F.col("id") % 4000)).alias("g"), (F.col("id") % 977).cast("double").alias("x"))
    got = ST.min_max_normalize(df, ["x"], ["n"], partition_by=["g"])
    assert got.columns == ["id", "g", "x", "n"]
    got = {r.id: r.n for r in got.collect()}
    lo, hi = {}, {}
    rows = df.collect()
    for r in rows:
        lo[r.g], hi[r.g] = min(lo.get(r.g, r.x), r.x), max(hi.get(r.g, r.x), r.x)
    assert got == {r.id: 0.0 if hi[r.g] == lo[r.g] else (r.x - lo[r.g]) / (hi[r.g] - lo[r.g]) for r in rows}
    plan = ST.join_group_stats(df, df.groupBy("g").agg(F.count(F.lit(1)).alias("__n")), ["g"])._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in plan.lower()
    assert ST.min_max_normalize(df.limit(0), ["x"], partition_by=["g"]).count() == 0
