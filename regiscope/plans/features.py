"""Feature frames derived from the test tables for the statistics and ML
operators. Both grow with the data (one row per customer / per lineitem)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .testtables import load

CUSTOMER_FEATURES = ["f_avg_price", "f_max_price", "f_n_orders", "f_acctbal"]
LINEITEM_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "net_price"]


def customer_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer; order features are NULL for customers without
    orders (left join), which is what the median imputers fill.

    The order side is aggregated on ``o_custkey`` before the join. The money
    sum is exact (decimal) so the mean is the same whatever the summation
    order. The frame is checkpointed: imputation, scaling and fitting read it
    several times, and one write is cheaper than re-aggregating the orders
    for every pass."""
    o = load(spark, sf_dir, "orders")
    per = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("__s"),
        F.max("o_totalprice").alias("f_max_price"),
        F.count(F.lit(1)).alias("__n"))
    c = load(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    j = c.join(per, "c_custkey", "left")
    return materialize(j.select(
        "c_custkey",
        (F.col("__s").cast("double") / F.col("__n")).alias("f_avg_price"),
        "f_max_price",
        F.col("__n").cast("double").alias("f_n_orders"),
        F.col("c_acctbal").alias("f_acctbal")))


def lineitem_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load(spark, sf_dir, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        (F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))).alias("net_price"))


#: What names a lineitem (no two rows of the table agree in all of them).
LINEITEM_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "price_cents"]


def named_lineitems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem_features`` with the price in cents, so that the keys are integers."""
    return lineitem_features(spark, sf_dir).withColumn(
        "price_cents", F.round(F.col("l_extendedprice") * 100).cast("bigint"))
