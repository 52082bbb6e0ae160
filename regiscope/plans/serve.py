"""Tables behind the dashboard and the map.

All inputs are Gold-final frames (one row per region). Nothing is collected:
each function returns a DataFrame.
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.format import capped_percent, plain_number, rank_tier, rounded_percent, yes_no
from ..functions.text import canonical_name, title_case
from ..operators.aggregate import arg_max, summary
from ..operators.geo import detect_name_field, feature_bounds, join_boundaries, total_bounds
from ..operators.stats import attach_stats

KEY = "kabupaten_kota"
BOX = ["minx", "miny", "maxx", "maxy"]
NRS = "nutrition_risk_score"
NCI = "nutrition_coverage_index"

# Dashboard insight titles and sentence templates.
TITLE_PRIORITY = "Prioritas Intervensi"
TITLE_COVERAGE = "Coverage Tertinggi"
TITLE_AUDIT = "Audit Distribusi"
BODY_PRIORITY = "%s memiliki Nutrition Risk Score tertinggi (%s)"
BODY_AUDIT = "Perbedaan rasio fasilitas dan tenaga kesehatan menunjukkan ketimpangan."


def dashboard_summary(final: DataFrame) -> DataFrame:
    """A5: one row."""
    return summary(final, NRS, ["jumlah_posyandu", "total_nakes"], "is_anomaly")


def highlights(final: DataFrame) -> DataFrame:
    """The highest-risk and the best-covered region: ``metric, value`` and
    the full record (two rows)."""
    hi = arg_max(final, NRS, ["priority_rank", KEY]).select(
        F.lit("highest_risk").alias("metric"), F.col(NRS).alias("value"), *final.columns)
    cov = arg_max(final, NCI, ["priority_rank", KEY]).select(
        F.lit("best_coverage").alias("metric"), F.col(NCI).alias("value"), *final.columns)
    return hi.unionByName(cov)


def insights(final: DataFrame) -> DataFrame:
    """Three sentences."""
    h = highlights(final)
    top = h.where(F.col("metric") == "highest_risk").select(
        F.lit(TITLE_PRIORITY).alias("title"),
        F.format_string(BODY_PRIORITY, F.col(KEY), plain_number("value")).alias("body"))
    cov = h.where(F.col("metric") == "best_coverage").select(
        F.lit(TITLE_COVERAGE).alias("title"), F.col(KEY).alias("body"))
    audit = final.sparkSession.range(1).select(F.lit(TITLE_AUDIT).alias("title"), F.lit(BODY_AUDIT).alias("body"))
    return top.unionByName(cov).unionByName(audit)


def display(final: DataFrame) -> DataFrame:
    """P30 + P25 + P26: per-region display fields of the priority list."""
    return final.select(
        KEY, "priority_rank",
        rank_tier("priority_rank").alias("rank_tier"),
        capped_percent(NRS).alias("risk_bar_pct"),
        rounded_percent(NCI).alias("coverage_pct"),
        yes_no("is_anomaly").alias("anomaly_label"),
        "jumlah_posyandu", "cluster_label")


# Cluster colours of the map and the colour for unlabelled regions.
CLUSTER_COLORS = {"Risiko Rendah": "#2ecc71", "Risiko Sedang": "#f39c12", "Risiko Tinggi": "#e74c3c"}
NO_LABEL_COLOR = "lightgrey"


def map_layer(final: DataFrame) -> DataFrame:
    """P25 + P26: per-region fill colour (lookup with default) and the
    tooltip fields, rounded for display (NULL stays NULL)."""
    from ..functions.format import lookup, round_or_null
    return final.select(
        KEY,
        lookup("cluster_label", CLUSTER_COLORS, NO_LABEL_COLOR).alias("fill_color"),
        round_or_null(NRS, 4).alias("tooltip_nrs"),
        round_or_null(NCI, 4).alias("tooltip_nci"),
        round_or_null("prevalensi_stunting_pct", 2).alias("tooltip_prevalence"),
        "priority_rank", "cluster_label",
        yes_no("is_anomaly").alias("tooltip_anomaly"))


def anomaly_listing(final: DataFrame) -> DataFrame:
    """Regions from most to least anomalous (ascending score), ordered at
    the reading edge."""
    return final.select(KEY, "anomaly_score", "is_anomaly").orderBy(
        F.col("anomaly_score").asc_nulls_last(), KEY)


# Fixed value: fewer matching names than this mean a wrong name field or file.
MIN_MATCHES = 3


def boundary_layer(boundaries: DataFrame, fields: Sequence[str], final: DataFrame,
                   min_matches: int = MIN_MATCHES) -> DataFrame:
    """J4 + J3 + P25-P28 + A10 in one step: the map's table from a boundary
    table (its attribute columns ``fields`` and ``rings``).

    The attribute whose canonical values match the most regions of ``final``
    names the boundaries (one row is read back for that choice); fewer than
    ``min_matches`` matching names give a warning. Every boundary is kept, with
    its label from the name as delivered, fill colour and tooltip (no data:
    default colour, NULLs), its box, and the box of all boundaries
    (``map_minx`` ...). An empty boundary table gives no rows."""
    ref = final.select(canonical_name(KEY).alias("value"))
    found = detect_name_field(boundaries, fields, ref).first()
    if found["score"] < min_matches:
        warnings.warn(f"name field {found['field']!r} matches only {found['score']} regions", stacklevel=2)
    name = f"`{found['field']}`"
    b = feature_bounds(boundaries.select(F.col(name).cast("string").alias("name"), "rings"))
    layer = join_boundaries(b, "name", map_layer(final), KEY)
    box = total_bounds(b).select(*[F.col(c).alias(f"map_{c}") for c in BOX])
    return attach_stats(layer, box).select(
        "wilayah_key", F.lit(found["field"]).alias("name_field"), title_case("name").alias("label"),
        F.coalesce("fill_color", F.lit(NO_LABEL_COLOR)).alias("fill_color"),
        "tooltip_nrs", "cluster_label", "tooltip_anomaly", "tooltip_prevalence", "priority_rank",
        *BOX, *[f"map_{c}" for c in BOX])
