"""S5 + S8 + S9 + S10: bounded ingest as one Structured Streaming query.

``readStream`` over the topic files (or ``kafka`` with ``subscribe``) ->
``from_json`` -> metadata -> non-finite sanitising -> ``foreachBatch`` into
Bronze Parquet, run with ``trigger(availableNow=True)``: every message
available at start is consumed, then the query stops (the original job's
"drain until idle"). Progress lives in the checkpoint, committed only after
the batch's write succeeded; a replayed batch overwrites only its own
``ingested_batch`` partition, so a retry after executor loss never
duplicates rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numeric import sanitize
from ..operators.audit import observed, rows_of
from ..sources.messages import JSON_TIME_OPTIONS, MESSAGE_SCHEMA, decode
from ..sources.tables import with_ingest_metadata
from ..sources.versions import Ledger


def message_stream(spark: SparkSession, path: str, topics: list[str] | None = None,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming message source over topic folders written by
    ``sources.messages.write_messages``."""
    r = spark.readStream.schema(MESSAGE_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    df = r.json(path)
    if topics:
        df = df.where(F.col("topic").isin(topics))
    return df


def kafka_stream(spark: SparkSession, bootstrap: str, topics: list[str]) -> DataFrame:  # pragma: no cover
    """S5 against a broker (needs the spark-sql-kafka connector)."""
    return (spark.readStream.format("kafka").option("kafka.bootstrap.servers", bootstrap)
            .option("subscribe", ",".join(topics)).option("startingOffsets", "earliest").load()
            .select(F.col("key").cast("string"), F.col("value").cast("string"), "topic"))


CORRUPT_COL = "_corrupt_record"
#: Epoch of replayed dead letters; micro-batches count from 0.
REPLAY_EPOCH = -1
DEAD_SCHEMA = "key string, value string, reason string, topic string, ingested_batch string, epoch int"


def bronze_frame(messages: DataFrame, schema: T.StructType, batch_id: str,
                 ingested_at: str | None = None, source: str = "csv_fallback") -> DataFrame:
    """Decode + metadata + sanitise; works on batch and streaming frames.
    A message that is not valid JSON is kept, its raw text in
    ``_corrupt_record`` (NULL for good messages), instead of failing the
    stream."""
    rows = decode(messages, schema, corrupt_col=CORRUPT_COL)
    rows = with_ingest_metadata(rows, batch_id, ingested_at, source)
    return sanitize(rows)


def dead_letters(messages: DataFrame, schema: T.StructType) -> DataFrame:
    """The messages that are no JSON object of the schema, as they came:
    ``topic, key, value, reason``. Reasons: ``empty`` (NULL or blank), ``no
    object`` (does not start with a brace), ``malformed``."""
    bad = _marked(messages, schema).where(_BAD)
    text = F.trim("value")
    reason = (F.when(F.coalesce(text, F.lit("")) == "", "empty").when(~text.startswith("{"), "no object")
              .otherwise("malformed"))
    return bad.select("topic", "key", "value", reason.alias("reason"))


_BAD = "__bad"


def _marked(messages: DataFrame, schema: T.StructType) -> DataFrame:
    """``messages`` with a flag on those that cannot be decoded."""
    probe = T.StructType(schema.fields + [T.StructField(CORRUPT_COL, T.StringType())])
    parsed = F.from_json(F.col("value").cast("string"), probe,
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COL, **JSON_TIME_OPTIONS})
    return messages.withColumn(_BAD, F.coalesce(parsed[CORRUPT_COL].isNotNull(), F.lit(True)) | (
        F.trim(F.coalesce(F.col("value").cast("string"), F.lit(""))) == ""))


def ingest(spark: SparkSession, topic_path: str, bronze_path: str, checkpoint: str,
           schema: T.StructType, batch_id: str, ingested_at: str | None = None,
           topics: list[str] | None = None, timeout_s: int | None = None,
           max_files_per_trigger: int | None = None, after_write=None,
           kafka: str | None = None, ledger_path: str | None = None,
           dead_path: str | None = None) -> dict:
    """Run the bounded stream to completion; returns rows written per micro-batch,
    counted while each is written. ``kafka`` names bootstrap servers to read
    ``topics`` from in place of the folder. Without ``timeout_s`` it waits as
    long as the stream takes.
    A topic folder that does not exist yet (nothing published) is an empty
    run, not an error.

    With ``ledger_path`` the topics of a micro-batch are written one after the
    other and each is committed to a ledger when its rows are there; the first
    failure ends the run, the topics before it stay, and a replay of the epoch
    skips them. With ``dead_path`` messages that cannot be decoded go there
    (``topic, key, value, reason``) and Bronze holds the others only."""
    from ..session import path_exists
    if kafka:
        messages = kafka_stream(spark, kafka, topics or [])
    elif path_exists(spark, topic_path):
        messages = message_stream(spark, topic_path, topics, max_files_per_trigger)
    else:
        return {}
    ledger = Ledger(spark, ledger_path) if ledger_path else None
    written: dict[str, int] = {}

    def put(batch: DataFrame, epoch_id: int, name: str) -> int:
        # dynamic partition overwrite keyed by (topic, ingested_batch, epoch):
        # replaying an epoch rewrites exactly its own partitions.
        def out(df: DataFrame, path: str) -> None:
            (df.withColumn("epoch", F.lit(int(epoch_id)))
             .write.mode("overwrite").option("compression", "snappy")
             .option("partitionOverwriteMode", "dynamic")
             .partitionBy("topic", "ingested_batch", "epoch").parquet(path))

        if dead_path:
            out(dead_letters(batch, schema).withColumn("ingested_batch", F.lit(batch_id)), dead_path)
            batch = _marked(batch, schema).where(f"NOT {_BAD}").drop(_BAD)
        rows = bronze_frame(batch, schema, batch_id, ingested_at)
        if dead_path:
            rows = rows.drop(CORRUPT_COL)
        rows, counted = observed(rows, name)
        out(rows, bronze_path)
        return rows_of(counted)

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        if ledger is None:
            written[str(epoch_id)] = put(batch, epoch_id, f"epoch_{epoch_id}")
            if after_write is not None:  # hook (e.g. to inject a failure after the write)
                after_write(epoch_id)
            return
        # one row per topic reaches the driver; a topic is a named stream, not a key of the data
        names = topics or [r["topic"] for r in batch.select("topic").distinct().collect()]
        written[str(epoch_id)] = 0
        for i, topic in enumerate(sorted(names)):
            if ledger.done(topic, epoch_id):
                continue
            n = put(batch.where(F.col("topic") == topic), epoch_id, f"epoch_{epoch_id}_{i}")
            if after_write is not None:
                after_write(epoch_id, topic)
            ledger.commit(topic, epoch_id, n)
            written[str(epoch_id)] += n

    q = (messages.writeStream.foreachBatch(write_batch)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination(timeout_s) if timeout_s else q.awaitTermination()
    if q.isActive:  # pragma: no cover - only on timeout
        q.stop()
        raise TimeoutError("ingest stream did not finish")
    if q.exception():  # pragma: no cover
        raise q.exception()
    return written


def replay(spark: SparkSession, dead_path: str, bronze_path: str, schema: T.StructType, batch_id: str,
           repair: Column, ingested_at: str | None = None, epoch: int = REPLAY_EPOCH) -> DataFrame:
    """Dead letters once more with ``repair`` as their value. Those that
    decode now are written to Bronze under ``batch_id`` and ``epoch``, which a
    second replay of the batch overwrites; returns those that still do not
    (``topic, key, value, reason``). The dead-letter table is not changed."""
    letters = spark.read.schema(DEAD_SCHEMA).parquet(dead_path).select("topic", "key", repair.alias("value"))
    good = _marked(letters, schema).where(f"NOT {_BAD}").drop(_BAD)
    rows = bronze_frame(good, schema, batch_id, ingested_at).drop(CORRUPT_COL)
    (rows.withColumn("epoch", F.lit(int(epoch))).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("topic", "ingested_batch", "epoch").parquet(bronze_path))
    return dead_letters(letters, schema)
