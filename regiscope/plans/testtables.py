"""Silver-shaped analogues derived from the driver's TPC-H-like test tables.

Region = nation. Every right side is pre-aggregated on its own foreign key
before it meets a dimension, so the large fact tables (orders, lineitem)
shuffle only partial aggregates and never join row-by-row against a
dimension whose size is unknown.

| Gold input | derived as |
|---|---|
| populasi | customers per nation |
| burden pivot | orders per nation pivoted on ``o_orderpriority`` |
| rs_umum / rs_khusus | suppliers with ``s_acctbal >= 5000`` / ``< 5000`` |
| posyandu | distinct parts shipped by the nation's suppliers |
| total_nakes | lineitems shipped by the nation's suppliers |
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.aggregate import pivot_sum
from .gold import KEY

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

# Order priorities used as the four summed burden categories,
# plus one pivoted but not summed (like WASTING / OVERWEIGHT).
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
BURDEN_MAP = {
    "total_stunting": "1-URGENT",
    "total_gizi_buruk": "2-HIGH",
    "total_gizi_kurang": "3-MEDIUM",
    "total_underweight": "5-LOW",
}
ACCTBAL_SPLIT = 5000.0


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def named(spark: SparkSession, sf_dir: str, df: DataFrame) -> DataFrame:
    """``df`` keyed by the nation's name in place of its key. The fact side of
    every input is keyed by the nation key; the name is looked up once, at the
    end."""
    nation = load(spark, sf_dir, "nation").select(F.col("n_nationkey").alias(KEY), F.col("n_name").alias("__name"))
    return df.join(nation, KEY, "inner").select(F.col("__name").alias(KEY), *[c for c in df.columns if c != KEY])


def population(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = load(spark, sf_dir, "customer")
    return c.groupBy(F.col("c_nationkey").alias(KEY)).agg(F.count(F.lit(1)).cast("bigint").alias("populasi"))


def burden(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders")
    c = load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("ck"), F.col("c_nationkey").alias(KEY))
    # Partial aggregate on the fact table first: one row per (customer, priority).
    per_cust = o.groupBy(F.col("o_custkey").alias("ck"), "o_orderpriority").agg(
        F.count(F.lit(1)).alias("n"))
    joined = per_cust.join(c, "ck", "inner")
    return pivot_sum(joined, [KEY], "o_orderpriority", PRIORITIES, value="n", cast="bigint")


def supply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facilities and workers per supplier nation: suppliers by balance, and
    distinct parts and lineitems from one pass over lineitem, (supplier, part)
    partial aggregate -> supplier nation -> (nation, part) -> nation."""
    s = load(spark, sf_dir, "supplier")
    li = load(spark, sf_dir, "lineitem")
    pairs = li.groupBy(F.col("l_suppkey").alias("sk"), "l_partkey").agg(F.count(F.lit(1)).alias("n"))
    nation = s.select(F.col("s_suppkey").alias("sk"), F.col("s_nationkey").alias(KEY))
    shipped = pairs.join(nation, "sk", "inner").groupBy(KEY, "l_partkey").agg(F.sum("n").alias("n")).groupBy(KEY).agg(
        F.count("l_partkey").cast("bigint").alias("jumlah_posyandu"), F.sum("n").cast("bigint").alias("total_nakes"))
    sup = s.groupBy(F.col("s_nationkey").alias(KEY)).agg(
        F.count_if(F.col("s_acctbal") >= ACCTBAL_SPLIT).cast("bigint").alias("jumlah_rs_umum"),
        F.count_if(F.col("s_acctbal") < ACCTBAL_SPLIT).cast("bigint").alias("jumlah_rs_khusus"))
    return sup.join(shipped, KEY, "left").na.fill(0, subset=["jumlah_posyandu", "total_nakes"])


def silver_inputs(spark: SparkSession, sf_dir: str):
    """Population, burden and supply, keyed by the nation key."""
    return population(spark, sf_dir), burden(spark, sf_dir), supply(spark, sf_dir)
