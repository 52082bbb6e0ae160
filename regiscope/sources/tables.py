"""Parquet / JSON table sinks and scans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_SOURCE = "csv_fallback"


def with_ingest_metadata(df: DataFrame, batch_id: str, ingested_at: str | Column | None = None,
                         source: str = DEFAULT_SOURCE) -> DataFrame:
    """``source`` / ``ingested_at`` only when absent on the record,
    ``ingested_batch`` always."""
    stamp = F.lit(ingested_at) if isinstance(ingested_at, str) else ingested_at
    if stamp is None:
        stamp = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss")
    out = df
    out = out.withColumn("source", F.coalesce(F.col("source"), F.lit(source))) if "source" in df.columns \
        else out.withColumn("source", F.lit(source))
    out = out.withColumn("ingested_at", F.coalesce(F.col("ingested_at").cast("string"), stamp)) \
        if "ingested_at" in df.columns else out.withColumn("ingested_at", stamp.cast("string"))
    return out.withColumn("ingested_batch", F.lit(batch_id))


def write_bronze(df: DataFrame, path: str, partition_by: Sequence[str] = ("ingested_batch",),
                 skip_empty: bool = True) -> bool:
    """S9 + S12: Snappy Parquet, dynamic partition overwrite, so replaying a
    batch replaces exactly its own partition. Empty input writes nothing and
    still counts as success."""
    if skip_empty and df.isEmpty():
        return True
    w = (df.write.mode("overwrite").option("compression", "snappy")
         .option("partitionOverwriteMode", "dynamic"))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return True


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Overwrite the whole table (partitions of an earlier run go as
    well), without ``coalesce(1)``.

    Partitioned output goes through the ``REBALANCE`` hint on the partition
    columns: rows of one partition value are clustered so each task writes
    few files, and AQE splits a value that holds a large share of the rows
    into several tasks instead of sending it all to one (a plain
    ``repartition(col)`` would)."""
    if partition_by:
        w = df.hint("rebalance", *partition_by)
        (w.write.mode("overwrite").option("partitionOverwriteMode", "static")
         .partitionBy(*partition_by).parquet(path))
    else:
        df.write.mode("overwrite").parquet(path)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet scan; a declared schema keeps partition columns typed."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(path)


def export_json(df: DataFrame, path: str) -> None:
    """Records as JSON lines (one file per task, no driver hop), NULL fields included."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType, multiline: bool = False) -> DataFrame:
    """JSON records with a declared schema (``multiline`` for array files)."""
    return spark.read.schema(schema).option("multiLine", multiline).json(path)
