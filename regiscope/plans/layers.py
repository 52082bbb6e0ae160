"""Bronze -> Silver -> Gold for the four health datasets (nutrition cases,
facilities, health workers, population).

Raw columns arrive as strings (declared schema, snake_case names from
``sources.csv``); every numeric field goes through ``try_cast`` so a
malformed value becomes NULL under ANSI mode instead of failing the job.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import count_value, lenient_cast, scale_to_int
from ..functions.text import recode, standardize
from ..operators.aggregate import pivot_sum
from ..operators.clean import dedupe_latest, drop_sentinels, keep_in, keep_non_negative, keep_positive
from . import gold as G

# Region-name variants and their standard form, as listed by
# the source (KEPULAUAN SERIBU appears twice; the dictionary collapses it).
REGION_DICTIONARY = [
    ("KOTA ADM. JAKARTA PUSAT", "JAKARTA PUSAT"),
    ("KOTA ADM. JAKARTA SELATAN", "JAKARTA SELATAN"),
    ("KOTA ADM. JAKARTA TIMUR", "JAKARTA TIMUR"),
    ("KOTA ADM. JAKARTA UTARA", "JAKARTA UTARA"),
    ("KOTA ADM. JAKARTA BARAT", "JAKARTA BARAT"),
    ("KAB. ADM. KEP. SERIBU", "KEPULAUAN SERIBU"),
    ("JAKARTA PUSAT", "JAKARTA PUSAT"),
    ("JAKARTA SELATAN", "JAKARTA SELATAN"),
    ("JAKARTA TIMUR", "JAKARTA TIMUR"),
    ("JAKARTA UTARA", "JAKARTA UTARA"),
    ("JAKARTA BARAT", "JAKARTA BARAT"),
    ("KEPULAUAN SERIBU", "KEPULAUAN SERIBU"),
    ("KEPULAUAN SERIBU", "KEPULAUAN SERIBU"),
    ("KOTA JAKARTA SELATAN", "JAKARTA SELATAN"),
    ("KOTA JAKARTA TIMUR", "JAKARTA TIMUR"),
    ("KOTA JAKARTA PUSAT", "JAKARTA PUSAT"),
    ("KOTA JAKARTA BARAT", "JAKARTA BARAT"),
    ("KOTA JAKARTA UTARA", "JAKARTA UTARA"),
]

# Nutrition categories (pivot order), the one recoded label,
# and the rows that are totals / blanks / footnotes rather than regions.
NUTRITION_CATEGORIES = ["STUNTING", "GIZI BURUK", "GIZI KURANG", "UNDERWEIGHT", "WASTING", "OVERWEIGHT"]
STUNTING_RAW = "BALITA STUNTING"
FACILITY_REJECT = ["DKI JAKARTA", ""]
POPULATION_REJECT = ["DKI JAKARTA", "", "CATATAN"]
POPULATION_REJECT_PREFIXES = ["HASIL", "LAJU"]

META = ["ingested_at", "source", "ingested_batch"]
KEY = G.KEY


def region(c: str) -> F.Column:
    return standardize(c, REGION_DICTIONARY)


def clean_nutrition(bronze: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Detail rows and the per-region pivot (region x period)."""
    df = (bronze.withColumn("wilayah_std", region("wilayah"))
          .withColumn("kategori_std", recode("kategori_masalah_gizi", STUNTING_RAW, "STUNTING"))
          .withColumn("jumlah", lenient_cast("jumlah", "bigint"))
          .withColumn("periode_data", lenient_cast("periode_data", "int")))
    df = keep_non_negative(df, "jumlah")
    df = dedupe_latest(df, ["periode_data", "wilayah_std", "kecamatan", "kategori_std"], ["ingested_at"])
    df = keep_in(df, "kategori_std", NUTRITION_CATEGORIES)
    detail = df.select("periode_data", "kecamatan", F.col("kategori_std").alias("kategori_masalah_gizi"),
                       "jumlah", *META, F.col("wilayah_std").alias(KEY))
    agg = pivot_sum(df.withColumnRenamed("wilayah_std", KEY), [KEY, "periode_data"], "kategori_std",
                    NUTRITION_CATEGORIES, value="jumlah", fill=0, cast="bigint")
    return detail, agg


def clean_facilities(bronze: DataFrame) -> DataFrame:
    df = drop_sentinels(bronze, "kabupaten_kota", FACILITY_REJECT)
    return dedupe_latest(df.select(
        region("kabupaten_kota").alias(KEY),
        count_value("jumlah_rumah_sakit_umum").alias("jumlah_rs_umum"),
        count_value("jumlah_rumah_sakit_khusus").alias("jumlah_rs_khusus"),
        count_value("jumlah_posyandu").alias("jumlah_posyandu"),
        *META), [KEY], ["ingested_at"])


def clean_workers(bronze: DataFrame) -> tuple[DataFrame, DataFrame]:
    df = (bronze.withColumn("wilayah_std", region("wilayah"))
          .withColumn("jumlah", lenient_cast("jumlah", "bigint"))
          .withColumn("periode_data", lenient_cast("periode_data", "int")))
    df = keep_non_negative(df, "jumlah")
    df = dedupe_latest(df, ["periode_data", "wilayah_std", "kecamatan", "tenaga_kesehatan"], ["ingested_at"])
    detail = df.select("periode_data", "kecamatan", "tenaga_kesehatan", "jumlah", *META,
                       F.col("wilayah_std").alias(KEY))
    agg = df.groupBy(F.col("wilayah_std").alias(KEY), "periode_data").agg(
        F.sum("jumlah").cast("bigint").alias("total_nakes"))
    return detail, agg


def clean_population(bronze: DataFrame) -> DataFrame:
    df = drop_sentinels(bronze, "kabupaten_kota", POPULATION_REJECT, POPULATION_REJECT_PREFIXES)
    df = df.withColumn("__thousand", lenient_cast("population_thousand", "decimal(18,4)"))
    df = keep_positive(df, "__thousand")
    return dedupe_latest(df.select(
        region("kabupaten_kota").alias(KEY),
        scale_to_int("population_thousand", 1000).alias("populasi"),
        lenient_cast("population_growth_rate", "double").alias("population_growth_rate"),
        lenient_cast("percentage_of_total_population", "double").alias("percentage_of_total"),
        lenient_cast("population_density_per_sq_km_km2", "double").alias("density_per_sqkm"),
        lenient_cast("population_sex_ratio", "double").alias("sex_ratio"),
        *META), [KEY], ["ingested_at"])


def silver(bronze: dict[str, DataFrame]) -> dict[str, DataFrame]:
    gd, ga = clean_nutrition(bronze["gizi"])
    nd, na = clean_workers(bronze["nakes"])
    return {"gizi_kecamatan_clean": gd, "gizi_agregat": ga,
            "faskes_clean": clean_facilities(bronze["faskes"]),
            "nakes_kecamatan_clean": nd, "nakes_agregat": na,
            "populasi_clean": clean_population(bronze["populasi"])}


def gold_from_silver(s: dict[str, DataFrame], as_of: F.Column | None = None) -> DataFrame:
    """Joins use the latest period per region, so two periods never fan out."""
    burden = s["gizi_agregat"]
    return G.gold(s["populasi_clean"], burden, s["faskes_clean"], s["nakes_agregat"],
                  period="periode_data", as_of=as_of)


# --- dataset registry and the whole job (S2, S9-S13, A4, M1-M10, J2) ----------

class DatasetSpec:
    """One raw dataset: name, topic, CSV header (file order) and file name."""

    def __init__(self, name: str, topic: str, header: list[str], file: str):
        self.name, self.topic, self.header, self.file = name, topic, header, file

    @property
    def columns(self) -> list[str]:
        from ..sources.csv import snake
        return [snake(c) for c in self.header]

    def schema(self):
        from ..sources.csv import string_schema
        return string_schema(self.columns + META)


# Dataset names, topics, raw headers and file names.
DATASETS = [
    DatasetSpec("gizi", "gizi-raw", ["periode_data", "wilayah", "kecamatan", "kategori_masalah_gizi", "jumlah"],
                "balita_stunting.csv"),
    DatasetSpec("faskes", "faskes-raw", ["Kabupaten/Kota", "Jumlah Rumah Sakit Umum", "Jumlah Rumah Sakit Khusus",
                                         "Jumlah Posyandu"], "sebaran_rumahSakit.csv"),
    DatasetSpec("nakes", "nakes-raw", ["periode_data", "wilayah", "kecamatan", "tenaga_kesehatan", "jumlah"],
                "jumlah_nakes.csv"),
    DatasetSpec("populasi", "populasi-raw", ["Kabupaten/Kota", "Population (Thousand)", "Population Growth Rate",
                                             "Percentage of Total Population", "Population Density per sq.km (Km2)",
                                             "Population Sex Ratio"], "lajupertumbuhan.csv"),
]

# Model features.
FEATURE_COLS = ["prevalensi_stunting_pct", "rasio_faskes_per_10k_balita", "rasio_posyandu_per_10k_populasi",
                "rasio_nakes_per_10k_populasi", "nutrition_coverage_index"]
IFOREST_FEATURES = ["prevalensi_stunting_pct", "rasio_faskes_per_10k_balita", "rasio_posyandu_per_10k_populasi",
                    "rasio_nakes_per_10k_populasi", "nutrition_risk_score"]


def publish(spark, csv_dir: str, topic_path: str, ingested_at: str) -> dict[str, int]:
    """CSV files -> keyed JSON messages per topic (S1 + S3 + S4). Returns
    messages written per topic, counted while writing (A4)."""
    import os

    from ..operators.audit import observed, rows_of
    from ..sources.csv import read_csv
    from ..sources.messages import to_messages, write_messages
    counts = {}
    for spec in DATASETS:
        raw = read_csv(spark, os.path.join(csv_dir, spec.file), spec.header)
        key = F.monotonically_increasing_id().cast("string")
        msgs, obs = observed(to_messages(raw, spec.topic, key=key, ingested_at=ingested_at), spec.topic)
        write_messages(msgs, topic_path)
        counts[spec.topic] = rows_of(obs)
    return counts


def bronze_tables(spark, bronze_path: str) -> dict[str, DataFrame]:
    """Bronze read back per dataset with its declared schema (S11); typed
    empty frames when nothing has been ingested yet (S19)."""
    from ..session import path_exists
    if not path_exists(spark, bronze_path):
        return {spec.name: spark.createDataFrame([], spec.schema()) for spec in DATASETS}
    b = spark.read.schema(bronze_schema()).parquet(bronze_path)
    # a later delivery of a topic replaces the earlier ones; batch ids sort by time
    last = b.groupBy("topic").agg(F.max("ingested_batch").alias("__last"))
    b = b.join(last, "topic").where(F.col("ingested_batch") == F.col("__last")).drop("__last")
    return {spec.name: b.where(F.col("topic") == spec.topic).select(*spec.columns, *META) for spec in DATASETS}


def message_schema():
    """The union of the declared datasets' columns, all strings."""
    from pyspark.sql import types as T
    names = list(dict.fromkeys(c for spec in DATASETS for c in spec.columns))
    return T.StructType([T.StructField(c, T.StringType()) for c in names + ["source", "ingested_at"]])


def bronze_schema():
    from pyspark.sql import types as T
    return T.StructType([*message_schema().fields, T.StructField("topic", T.StringType()),
                         T.StructField("ingested_batch", T.StringType()), T.StructField("epoch", T.IntegerType())])


def ingest_all(spark, topic_path: str, bronze_path: str, checkpoint: str, batch_id: str,
               ledger_path: str | None = None, dead_path: str | None = None) -> dict[str, DataFrame]:
    """All topics in one bounded stream (S5-S10): the union schema of the
    declared datasets, each topic keeping its own columns. With ``ledger_path``
    every topic is committed for itself, with ``dead_path`` messages that
    cannot be decoded go there."""
    from ..streaming.ingest import ingest
    ingest(spark, topic_path, bronze_path, checkpoint, message_schema(), batch_id,
           topics=[spec.topic for spec in DATASETS], ledger_path=ledger_path, dead_path=dead_path)
    return bronze_tables(spark, bronze_path)


def write_silver(s: dict[str, DataFrame], base: str) -> dict[str, int]:
    """S12 + A4: Silver tables partitioned by region, each replaced atomically;
    returns the rows written per table, observed during the write (no second
    scan)."""
    from ..operators.audit import observed, rows_of
    from ..sources.versions import VersionedTable
    counts = {}
    for name, df in s.items():
        obs_df, obs = observed(df, f"silver_{name}")
        VersionedTable(df.sparkSession, f"{base}/{name}", df.schema).replace(obs_df, partition_by=[KEY])
        counts[name] = rows_of(obs)
    return counts


def read_silver(spark, base: str) -> dict[str, DataFrame]:
    """The Silver tables as committed last."""
    from ..sources.versions import VersionedTable
    return {name: VersionedTable(spark, f"{base}/{name}").read() for name in SILVER}


# The Silver tables.
SILVER = ["gizi_kecamatan_clean", "gizi_agregat", "faskes_clean", "nakes_kecamatan_clean", "nakes_agregat", "populasi_clean"]
#: Numbers of clusters that the sweep tries, and contamination levels.
SWEEP_MAX = 5
CONTAMINATION_LEVELS = [0.10, 0.15, 0.20]


@dataclass
class Analysis:
    """What the model step yields: the final table, (k, WSSE, silhouette) per
    k, the silhouette of the chosen k, and the flagged regions per level."""

    final: DataFrame
    sweep: DataFrame
    silhouette: float | None
    flagged: DataFrame


def analyse(gold: DataFrame, k: int = 3, seed: int = 42, n_trees: int = 100,
            contamination: float = 0.15, models_path: str | None = None) -> Analysis:
    """Gold -> models -> Gold final (J2), with the checks of both models.

    * K-Means on FEATURE_COLS: exact lower-median fill (A8), sample-sd scaling
      (M2), k = min(k, n) from a deterministic start (M4), labels by ascending
      mean NRS (M8); the sweep over k = 2 .. min(5, n - 1) (M5-M7).
    * Isolation Forest on IFOREST_FEATURES: midpoint-median fill (A9),
      population-sd scaling (M3), score, flag below the contamination
      quantile (A12) and the regions flagged at three levels (M10).

    With ``models_path`` both models are saved there, each with all that
    scoring new rows needs (S15, S16). An empty Gold gives typed empty tables."""
    from pyspark.sql import types as T

    from ..functions.format import iso_timestamp
    from ..operators import cluster as CL
    from ..operators import iforest as IF
    from ..operators import stats as ST
    from ..session import materialize, store

    spark = gold.sparkSession
    g = materialize(gold)
    n = g.count()
    iso = [iso_timestamp("last_updated").alias(c) if c == "last_updated" else F.col(f"`{c}`") for c in g.columns]
    if n == 0:  # S19: nothing to fit
        schema = T.StructType(g.select(*iso).schema.fields + [
            T.StructField("cluster_id", T.IntegerType()), T.StructField("cluster_label", T.StringType()),
            T.StructField("is_anomaly", T.BooleanType()), T.StructField("anomaly_score", T.DoubleType())])
        return Analysis(spark.createDataFrame([], schema), spark.createDataFrame([], "k int, wsse double, silhouette double"),
                        None, spark.createDataFrame([], f"contamination double, {KEY} string"))
    model = CL.fit_deterministic(g, FEATURE_COLS, KEY, k=min(k, n))
    pred = model.assign(g)
    clusters = CL.label_by_mean(pred.select(KEY, "cluster_id", "nutrition_risk_score"),
                                "cluster_id", "nutrition_risk_score").select(KEY, "cluster_id", "cluster_label")
    z = ST.zscore(ST.impute_quantile(g.select(KEY, *FEATURE_COLS), FEATURE_COLS, "disc"), FEATURE_COLS,
                  [f"z{i}" for i in range(len(FEATURE_COLS))])
    z = materialize(z.select(KEY, *[f"z{i}" for i in range(len(FEATURE_COLS))]))
    ks = list(range(2, min(SWEEP_MAX, n - 1) + 1))
    sweep = CL.k_sweep(z, z.columns[1:], ks, KEY) if ks else spark.createDataFrame([], "k int, wsse double, silhouette double")
    held = [r["silhouette"] for r in sweep.where(F.col("k") == min(k, n)).collect()]
    forest = IF.fit_model(g, IFOREST_FEATURES, n_trees=n_trees, seed=seed, keys=[KEY])
    forest.nodes = store(forest.nodes, "iforest-nodes")
    scored = materialize(forest.score(g.select(KEY, *IFOREST_FEATURES)).select(KEY, F.round("anomaly_score", 6).alias("anomaly_score")))
    forest.contamination = contamination
    forest.cut = ST.quantile_values(scored, ["anomaly_score"], [contamination])[("anomaly_score", contamination)]
    flags = scored.withColumn("is_anomaly", F.coalesce(F.col("anomaly_score") < F.lit(forest.cut), F.lit(False)))
    if models_path:
        model.save(spark, f"{models_path}/kmeans")
        forest.save(f"{models_path}/iforest")
    out = g.select(*iso).join(clusters, KEY, "left").join(flags.select(KEY, "is_anomaly", "anomaly_score"), KEY, "left")
    flagged = IF.contamination_flags(scored, "anomaly_score", CONTAMINATION_LEVELS, [KEY])
    return Analysis(out, sweep, held[0] if held else None, flagged)


def final(gold: DataFrame, k: int = 3, seed: int = 42, n_trees: int = 100,
          contamination: float = 0.15, models_path: str | None = None) -> DataFrame:
    """``analyse``'s final table."""
    return analyse(gold, k, seed, n_trees, contamination, models_path).final


def serving_tables(fin: DataFrame) -> dict[str, DataFrame]:
    """The dashboard's and the map's tables."""
    from . import serve as SV
    return {"summary": SV.dashboard_summary(fin), "highlights": SV.highlights(fin), "insights": SV.insights(fin),
            "display": SV.display(fin), "map_layer": SV.map_layer(fin), "anomalies": SV.anomaly_listing(fin)}


def run(spark, csv_dir: str, out_base: str, batch_id: str, ingested_at: str,
        as_of: F.Column | None = None, boundaries: str | None = None) -> dict[str, object]:
    """The whole job: publish -> ingest -> Silver -> Gold -> models -> serving
    tables, below ``out_base`` (a shared folder). Silver, Gold, the analysis
    and the serving tables are ``VersionedTable``s: a run that is lost half-way
    leaves the rows of the one before. Gold is made from Silver as stored.

    ``boundaries``: GeoJSON of the regions for the map's boundary layer; a file
    that is not there leaves the layer out."""
    from ..operators.geo import read_geojson_properties
    from ..sources.tables import export_json
    from ..sources.versions import VersionedTable
    from . import serve as SV
    counts = publish(spark, csv_dir, f"{out_base}/topics", ingested_at)
    bronze = ingest_all(spark, f"{out_base}/topics", f"{out_base}/bronze", f"{out_base}/_ingest_ckpt", batch_id,
                        f"{out_base}/_ledger/{batch_id}", f"{out_base}/dead_letters")
    silver_rows = write_silver(silver(bronze), f"{out_base}/silver")

    def keep(name: str, df: DataFrame) -> DataFrame:
        table = VersionedTable(spark, f"{out_base}/{name}", df.schema)
        table.replace(df)
        return table.read()

    g = keep("gold/wilayah_risk_score", gold_from_silver(
        read_silver(spark, f"{out_base}/silver"), as_of=as_of if as_of is not None else F.current_timestamp()))
    got = analyse(g, models_path=f"{out_base}/models")
    fin = keep("gold/wilayah_final", got.final)
    sweep, flagged = keep("analysis/k_sweep", got.sweep), keep("analysis/contamination", got.flagged)
    export_json(fin, f"{out_base}/export/wilayah_final_json")
    for name, df in serving_tables(fin).items():
        keep(f"serving/{name}", df)
    if boundaries:
        found = read_geojson_properties(spark, boundaries)
        if found is not None:
            keep("serving/boundary_layer", SV.boundary_layer(*found, fin))
    return {"messages": counts, "silver_rows": silver_rows, "final": fin, "k_sweep": sweep,
            "silhouette": got.silhouette, "flagged": flagged}
