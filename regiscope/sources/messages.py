"""Keyed JSON messages.

A message frame is ``(topic string, key string, value string)`` where value
is a JSON object: the shape of a Kafka record. The same frame goes to the
``kafka`` sink when its connector is on the classpath, or to JSON files
partitioned by topic (the file layout Structured Streaming can replay).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Timestamps travel with full microsecond precision (the JSON defaults keep
# milliseconds only).
JSON_TIME_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}

MESSAGE_SCHEMA = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("topic", T.StringType()),
])


def to_messages(df: DataFrame, topic: str | Column, key: str | Column | None = None,
                ingested_at: str | Column | None = None, keep_nulls: bool = True) -> DataFrame:
    """S3 + S4: every row becomes one JSON message. ``ingested_at`` (one
    value per batch) is stamped into the payload. NULL fields are written as
    ``null`` unless ``keep_nulls`` is False."""
    body = df
    if ingested_at is not None:
        stamp = F.lit(ingested_at) if isinstance(ingested_at, str) else ingested_at
        body = body.withColumn("ingested_at", stamp.cast("string"))
    k = F.lit(None).cast("string") if key is None else (F.col(key) if isinstance(key, str) else key)
    opts = dict(JSON_TIME_OPTIONS)
    if keep_nulls:
        opts["ignoreNullFields"] = "false"
    t = F.lit(topic) if isinstance(topic, str) else topic
    return body.select(k.cast("string").alias("key"),
                       F.to_json(F.struct(*[F.col(f"`{c}`") for c in body.columns]), opts).alias("value"),
                       t.alias("topic"))


def decode(messages: DataFrame, schema: T.StructType, corrupt_col: str | None = "_corrupt") -> DataFrame:
    """Parse ``value`` with a declared schema. A message that is not a
    JSON object keeps its raw text in ``corrupt_col`` instead of failing."""
    opts = {"mode": "PERMISSIVE", **JSON_TIME_OPTIONS}
    parse_schema = schema
    if corrupt_col:
        parse_schema = T.StructType(schema.fields + [T.StructField(corrupt_col, T.StringType())])
        opts["columnNameOfCorruptRecord"] = corrupt_col
    parsed = F.from_json(F.col("value").cast("string"), parse_schema, opts)
    out = messages.select(F.col("topic"), F.col("key").cast("string").alias("key"), parsed.alias("__v"))
    return out.select("topic", "key", *[F.col(f"__v.`{f.name}`").alias(f.name) for f in parse_schema.fields])


def write_messages(messages: DataFrame, path: str, mode: str = "append") -> None:
    """S3 sink without a broker: JSON lines partitioned by topic."""
    messages.write.mode(mode).partitionBy("topic").json(path)


def write_kafka(messages: DataFrame, bootstrap: str) -> None:  # pragma: no cover - no broker here
    """S3 sink to Kafka (needs the spark-sql-kafka connector)."""
    (messages.select("key", "value", "topic").write.format("kafka")
     .option("kafka.bootstrap.servers", bootstrap).save())


def route_counts(messages: DataFrame) -> DataFrame:
    """Messages per topic (demultiplexing is ``partitionBy(topic)``)."""
    return messages.groupBy("topic").agg(F.count(F.lit(1)).alias("n_messages"))
