import json
import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from regiscope.sources import messages as MSG
from regiscope.sources import tables as TBL
from regiscope.session import scratch_path
from regiscope.streaming import ingest as ING

SCHEMA = T.StructType([
    T.StructField("wilayah", T.StringType()),
    T.StructField("jumlah", T.StringType()),
    T.StructField("extra", T.StringType()),
    T.StructField("ratio", T.DoubleType()),
])


def test_roundtrip_keeps_declared_late_field_and_flags_bad_json(spark):
    msgs = spark.createDataFrame([
        ("0", json.dumps({"wilayah": "A", "jumlah": "1"}), "gizi-raw"),
        ("1", json.dumps({"wilayah": "B", "jumlah": "2", "extra": "late"}), "gizi-raw"),
        ("2", "not json", "gizi-raw"),
    ], "key string, value string, topic string")
    out = {r.key: r for r in MSG.decode(msgs, SCHEMA).collect()}
    assert out["0"].extra is None and out["1"].extra == "late"
    assert out["2"]._corrupt == "not json" and out["0"]._corrupt is None


def test_to_messages_stamps_and_keeps_nulls(spark):
    df = spark.createDataFrame([("A", None)], "wilayah string, jumlah string")
    m = MSG.to_messages(df, "gizi-raw", key=F.lit("0"), ingested_at="2025-01-01T00:00:00").first()
    body = json.loads(m.value)
    assert body == {"wilayah": "A", "jumlah": None, "ingested_at": "2025-01-01T00:00:00"}
    assert m.topic == "gizi-raw" and m.key == "0"


def test_metadata_defaults_only_when_absent(spark):
    df = spark.createDataFrame([("api", "2024-01-01T00:00:00"), (None, None)], "source string, ingested_at string")
    rows = TBL.with_ingest_metadata(df, "B1", "2025-01-01T00:00:00").collect()
    assert (rows[0].source, rows[0].ingested_at) == ("api", "2024-01-01T00:00:00")
    assert (rows[1].source, rows[1].ingested_at, rows[1].ingested_batch) == \
        ("csv_fallback", "2025-01-01T00:00:00", "B1")


def test_empty_topic_writes_nothing(spark):
    path = scratch_path(spark, "empty-bronze")
    empty = spark.createDataFrame([], "a string, ingested_batch string")
    assert TBL.write_bronze(empty, path) is True
    assert not os.path.exists(path.replace("file:", ""))


def test_stream_ingest_is_bounded_and_replay_safe(spark):
    rows = [(str(i), json.dumps({"wilayah": f"R{i % 3}", "jumlah": str(i), "ratio": 1.5}), "gizi-raw")
            for i in range(40)]
    rows.append(("40", '{"wilayah": "R0", "jumlah": "1", "ratio": NaN}', "gizi-raw"))
    rows.append(("41", '{"wilayah": "R1", "jumlah": ', "gizi-raw"))  # truncated message
    msgs = spark.createDataFrame(rows, "key string, value string, topic string")
    topics = scratch_path(spark, "t-topics")
    MSG.write_messages(msgs, topics)
    bronze = scratch_path(spark, "t-bronze")
    ckpt = scratch_path(spark, "t-ckpt")
    ING.ingest(spark, topics, bronze, ckpt, SCHEMA, "20250101_000000", "2025-01-01T00:00:00")
    first = spark.read.parquet(bronze)
    assert first.count() == 42
    bad = first.where(F.col("_corrupt_record").isNotNull()).collect()
    assert len(bad) == 1 and bad[0]._corrupt_record.startswith('{"wilayah": "R1"')
    assert first.where(F.col("ratio").isNull() & F.col("_corrupt_record").isNull()).count() == 1  # NaN sanitised
    assert {r.ingested_batch for r in first.select("ingested_batch").distinct().collect()} == {"20250101_000000"}
    # same checkpoint: nothing new to read, nothing duplicated
    ING.ingest(spark, topics, bronze, ckpt, SCHEMA, "20250101_000000", "2025-01-01T00:00:00")
    assert spark.read.parquet(bronze).count() == 42


def test_missing_topic_folder_is_an_empty_run(spark):
    from regiscope.plans import layers as L
    bronze = scratch_path(spark, "none-bronze")
    assert ING.ingest(spark, scratch_path(spark, "never-published"), bronze, scratch_path(spark, "none-ckpt"),
                      SCHEMA, "B1", "T") == {}
    tables = L.bronze_tables(spark, bronze)
    assert set(tables) == {"gizi", "faskes", "nakes", "populasi"}
    assert all(t.count() == 0 for t in tables.values())
    assert "ingested_batch" in tables["gizi"].columns


def test_stream_ingest_over_several_micro_batches(spark):
    """availableNow with one file per trigger: several epochs in one run;
    each epoch owns its Bronze partition, so none overwrites another."""
    rows = [(str(i), json.dumps({"wilayah": f"R{i % 5}", "jumlah": str(i)}), "gizi-raw") for i in range(100)]
    msgs = spark.createDataFrame(rows, "key string, value string, topic string").repartition(4)
    topics = scratch_path(spark, "mb-topics")
    MSG.write_messages(msgs, topics)
    bronze = scratch_path(spark, "mb-bronze")
    progress = ING.ingest(spark, topics, bronze, scratch_path(spark, "mb-ckpt"), SCHEMA, "B1", "T",
                          max_files_per_trigger=1)
    assert len(progress) >= 2 and sum(progress.values()) == 100
    b = spark.read.parquet(bronze)
    assert b.count() == 100 and b.select("epoch").distinct().count() == len(progress)
    assert sorted(int(r.jumlah) for r in b.collect()) == list(range(100))


def test_crash_after_write_is_replayed_without_duplicates(spark):
    """The batch is written, then the driver dies before the commit: the
    restarted query replays the same epoch, which overwrites its own
    partition, so Bronze holds every message exactly once."""
    import pytest
    rows = [(str(i), json.dumps({"wilayah": "R", "jumlah": str(i)}), "gizi-raw") for i in range(30)]
    topics = scratch_path(spark, "cr-topics")
    MSG.write_messages(spark.createDataFrame(rows, "key string, value string, topic string"), topics)
    bronze, ckpt = scratch_path(spark, "cr-bronze"), scratch_path(spark, "cr-ckpt")

    def crash(epoch_id):
        raise RuntimeError("simulated failure after the write")

    with pytest.raises(Exception):
        ING.ingest(spark, topics, bronze, ckpt, SCHEMA, "B1", "T", after_write=crash)
    assert spark.read.parquet(bronze).count() == 30  # written, not committed
    replay = ING.ingest(spark, topics, bronze, ckpt, SCHEMA, "B1", "T")
    assert sum(replay.values()) == 30  # the uncommitted epoch really ran again
    b = spark.read.parquet(bronze)
    assert b.count() == 30 and b.select("key").distinct().count() == 30


def test_json_export_writes_null_fields(spark):
    path = scratch_path(spark, "json-nulls")
    df = spark.createDataFrame([("A", None), ("B", 1.5)], "k string, v double")
    TBL.export_json(df, path)
    lines = sorted(r.value for r in spark.read.text(path).collect())
    assert [json.loads(x) for x in lines] == [{"k": "A", "v": None}, {"k": "B", "v": 1.5}]
    assert '"v":null' in lines[0]


def test_sums_beyond_32_bits(spark):
    from regiscope.operators.aggregate import pivot_sum
    from regiscope.plans.gold import master_table
    big = 3_000_000_000
    pop = spark.createDataFrame([("A", big)], "kabupaten_kota string, populasi long")
    bur = spark.createDataFrame([("A", big, big, 1, None)], "kabupaten_kota string, a long, b long, c long, d long")
    fac = spark.createDataFrame([("A", big, big, big)], "kabupaten_kota string, jumlah_rs_umum long, jumlah_rs_khusus long, jumlah_posyandu long")
    wrk = spark.createDataFrame([("A", big)], "kabupaten_kota string, total_nakes long")
    row = master_table(pop, bur, fac, wrk, {"total_stunting": "a", "total_gizi_buruk": "b", "total_gizi_kurang": "c",
                                           "total_underweight": "d"}, period=None).first()
    assert (row.total_balita_gizi_buruk, row.jumlah_posyandu, row.total_nakes) == (2 * big + 1, big, big)
    cells = spark.createDataFrame([("A", "x", big), ("A", "x", big)], "k string, c string, v long")
    assert pivot_sum(cells, ["k"], "c", ["x"], value="v", cast="bigint").first().x == 2 * big
