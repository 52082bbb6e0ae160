"""Boundary data as tables.

GeoJSON is read by Spark's JSON reader and exploded into one row per
feature; geometry stays a nested column. Only the tables behind the map
are built; rendering is out of scope.
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import canonical_name
from ..session import path_exists
from .join import best_overlap

POLYGON = T.ArrayType(T.ArrayType(T.ArrayType(T.DoubleType())))
MULTIPOLYGON = T.ArrayType(POLYGON)


def read_geojson(spark: SparkSession, path: str, properties: T.StructType | None = None) -> DataFrame:
    """FeatureCollection file(s) -> one row per feature with its
    properties flattened and ``geometry`` kept as a struct. Coordinates are
    read as a string and parsed per type, so Polygon and MultiPolygon mix."""
    prop_t = properties or T.MapType(T.StringType(), T.StringType())
    schema = T.StructType([T.StructField("features", T.ArrayType(T.StructType([
        T.StructField("properties", prop_t),
        T.StructField("geometry", T.StructType([
            T.StructField("type", T.StringType()),
            T.StructField("coordinates", T.StringType()),
        ])),
    ])))])
    feature = schema["features"].dataType.elementType
    raw = _split_features(spark, path)
    if raw is not None:
        feats = raw.select(F.from_json("value", feature).alias("f"))
    else:
        feats = spark.read.schema(schema).option("multiLine", True).json(path).select(F.explode("features").alias("f"))
    if isinstance(prop_t, T.StructType):
        props = [F.col(f"f.properties.`{f.name}`").alias(f.name) for f in prop_t.fields]
    else:
        props = [F.col("f.properties").alias("properties")]
    g = F.col("f.geometry")
    rings = F.when(g["type"] == "MultiPolygon", F.flatten(F.from_json(g["coordinates"], MULTIPOLYGON))) \
        .otherwise(F.from_json(g["coordinates"], POLYGON))
    return feats.select(*props, g["type"].alias("geometry_type"), rings.alias("rings"))


#: What separates the features of a collection whose features begin with their type.
_MARK = '"Feature"'
_NEXT = r',\s*\{\s*"type"\s*:\s*$'
_HEAD = r'"features"\s*:\s*\[\s*\{\s*"type"\s*:\s*$'
_END = r'\}\s*\][^\]}]*\}?\s*$'


def _split_features(spark: SparkSession, path: str) -> DataFrame | None:
    """The features of ``path`` as JSON text, one row each, read in as many
    splits as Spark makes of the files: the type of a feature is the record
    separator. None where a file is not written so that every separator stands
    between two features (another key in front of the type, or a value
    "Feature"), which one pass over the pieces' ends tells; such a file is read
    whole by one task."""
    pieces = spark.read.option("lineSep", _MARK).text(path)
    v = F.col("value")
    head, more, last = v.rlike(_HEAD), v.rlike(r"\}\s*" + _NEXT), v.rlike(_END)
    ends = pieces.agg(F.count(F.lit(1)).alias("n"), F.count_if(~head & ~more & ~last).alias("odd"),
                      F.count_if(head & ~more).alias("heads"), F.count_if(last & ~head & ~more).alias("ends")).first()
    if not ends["n"] or ends["odd"] or ends["heads"] != ends["ends"]:
        return None
    body = F.regexp_replace(v, _NEXT, "")
    body = F.when(last & ~more, F.regexp_replace(v, r"\s*\][^\]}]*\}?\s*$", "")).otherwise(body)
    return pieces.where(~head | more).select(F.concat(F.lit('{"type":"Feature"'), body).alias("value"))


def write_geojson(df: DataFrame, path: str, properties: Sequence[str], rings: str = "rings") -> None:
    """Polygons as FeatureCollections, one file per task; a NULL ring list has
    a NULL geometry."""
    geometry = F.when(F.col(rings).isNotNull(), F.struct(F.lit("Polygon").alias("type"), F.col(rings).alias("coordinates")))
    feature = F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct(*[F.col(f"`{c}`") for c in properties]).alias("properties"),
                                 geometry.alias("geometry")), {"ignoreNullFields": "false"})

    def collect(batches):
        first = True
        for pdf in batches:
            if len(pdf):
                lines = pdf["value"].tolist()
                lines = [("" if first and not i else ",") + x for i, x in enumerate(lines)]
                yield pdf.assign(value=['{"type":"FeatureCollection","features":[\n' + lines[0], *lines[1:]] if first else lines)
                first = False
        if not first:
            import pandas as pd
            yield pd.DataFrame({"value": ["]}"]})

    df.select(feature.alias("value")).mapInPandas(collect, "value string").write.mode("overwrite").text(path)


def read_geojson_properties(spark: SparkSession, path: str) -> tuple[DataFrame, list[str]] | None:
    """The features of ``path`` with every property as a string column,
    and the names of these; None with a warning where there is no file. The
    names come from one distinct over the features' keys (a schema, so a
    bounded list)."""
    if not path_exists(spark, path):
        warnings.warn(f"no boundary file {path}", stacklevel=2)
        return None
    feats = read_geojson(spark, path)
    names = sorted(r[0] for r in feats.select(F.explode(F.map_keys("properties"))).distinct().collect())
    return feats.select(*[F.col("properties")[n].alias(n) for n in names], "rings"), names


def feature_bounds(df: DataFrame, rings: str = "rings") -> DataFrame:
    """Per-feature bounding box from its rings (no shuffle)."""
    pts = F.flatten(F.col(rings))
    xs = F.transform(pts, lambda p: p[0])
    ys = F.transform(pts, lambda p: p[1])
    return df.withColumn("minx", F.array_min(xs)).withColumn("miny", F.array_min(ys)) \
             .withColumn("maxx", F.array_max(xs)).withColumn("maxy", F.array_max(ys))


def total_bounds(df: DataFrame, x: str = "minx", y: str = "miny",
                 x2: str | None = "maxx", y2: str | None = "maxy") -> DataFrame:
    """A10: one-row bounding box over all features / points (partial agg)."""
    return df.agg(F.min(x).alias("minx"), F.min(y).alias("miny"),
                  F.max(x2 or x).alias("maxx"), F.max(y2 or y).alias("maxy"))


def long_values(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """``(field, value)`` long form of string columns, canonicalised."""
    return df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("field"), F.col(f"`{c}`").cast("string").alias("value"))
        for c in fields])).alias("__fv")).select("__fv.field", canonical_name("__fv.value").alias("value"))


def detect_name_field(df: DataFrame, fields: Sequence[str], reference: DataFrame,
                      ref_col: str = "value") -> DataFrame:
    """Which column's canonical values overlap the reference names most."""
    ref = reference.select(F.col(ref_col).alias("value"))
    return best_overlap(long_values(df, fields), ref, field_order=list(fields))


def join_boundaries(boundaries: DataFrame, name_field: str, scores: DataFrame,
                    score_key: str = "kabupaten_kota") -> DataFrame:
    """Every boundary kept; scores attached on the canonical key."""
    b = boundaries.withColumn("wilayah_key", canonical_name(F.col(name_field)))
    s = scores.withColumn("wilayah_key", canonical_name(F.col(score_key))).drop(score_key)
    return b.join(s, "wilayah_key", "left")
