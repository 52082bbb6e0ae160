"""Exact deduplication against a persistent digest index.

The index is a table of SHA-256 digests, bucketed and sorted by digest. New
data is reduced to one row per digest, deduplicated against the index by a
sort-merge anti-join (the index side is read by bucket, without a shuffle) and
appended. A digest shared by a third of the rows is one partial row per task.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import store


def digest(text_col: str = "text"):
    """Lowercase hex SHA-256 of the text's UTF-8 bytes, NULL as empty."""
    return F.sha2(F.coalesce(F.col(text_col), F.lit("")).cast("binary"), 256)


class DigestIndex:
    """``text_sha256 -> keep_id`` for every distinct text seen so far.

    ``path`` defaults to a fresh folder below the shared checkpoint folder;
    give the path of an earlier index and its ``buckets`` to go on with it. A
    new one has as many buckets as the session has shuffle partitions.
    """

    def __init__(self, spark: SparkSession, id_type: str = "bigint", path: str | None = None,
                 buckets: int | None = None):
        self.spark, self.id_type = spark, id_type
        self.buckets = buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.path = path or scratch_path(spark, "digest-index")
        self.table = f"digest_index_{uuid.uuid4().hex[:12]}"
        spark.sql(f"CREATE TABLE {self.table} (text_sha256 STRING, keep_id {id_type}) USING parquet "
                  f"CLUSTERED BY (text_sha256) SORTED BY (text_sha256) INTO {buckets} BUCKETS "
                  f"LOCATION '{self.path}'")

    def read(self) -> DataFrame:
        """The bucketed table."""
        self.spark.catalog.refreshTable(self.table)
        return self.spark.table(self.table)

    def add(self, digests: DataFrame, id_col: str = "doc_id") -> None:
        """Append the digests of a batch that the index lacks; of equal texts
        in the batch the row with the greatest id stays."""
        # stored: else the anti-join is planned below this aggregate, on every row
        new = store(digests.groupBy("text_sha256").agg(F.max(id_col).alias("keep_id")), "digest-batch")
        fresh = new.join(self.read().select("text_sha256").hint("merge"), "text_sha256", "left_anti")
        # the stored rows are read back: the table is not written while it is read
        fresh = store(fresh, "digest-new")
        (fresh.repartition(self.buckets, "text_sha256").sortWithinPartitions("text_sha256")
         .select("text_sha256", "keep_id").write.insertInto(self.table))

    def close(self) -> None:
        """Take the table out of the catalogue; its files stay, for
        ``DigestIndex(path=...)``."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")

    def entries(self) -> DataFrame:
        """The index as plain files: joins on it shuffle both sides, so AQE may
        split a digest that many rows share."""
        self.spark.catalog.refreshTable(self.table)
        return self.spark.read.schema(f"text_sha256 string, keep_id {self.id_type}").parquet(self.path)


def dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", batches: int = 2,
          index: DigestIndex | None = None) -> DataFrame:
    """``id_col, keep_id, group_size, kept, text_sha256, n_rows`` per document.

    Texts are equal when identical, NULL counts as empty; the greatest id of a
    group stays. Documents enter the index in ``batches`` ranges of the id,
    greatest ids first, the way a corpus grows by deliveries. Rows that share
    both id and text are one document: they give one row, ``n_rows`` says
    how many they are, and ``group_size`` counts them all. A NULL id is the least id. Against an index from earlier
    data its ``keep_id`` wins. Other columns are not read; an empty table gives
    no rows."""
    spark = df.sparkSession
    d = df.select(F.col(id_col).alias("__id"), digest(text_col).alias("text_sha256"))
    d = store(d.groupBy("text_sha256", "__id").agg(F.count(F.lit(1)).alias("__n")), "digests")
    kind = dict(d.dtypes)["__id"]
    if index is None:
        index = DigestIndex(spark, kind)
        try:
            return _dedup_counted(d, index, id_col, batches)
        finally:
            index.close()
    return _dedup_counted(d, index, id_col, batches)


def _dedup_counted(d: DataFrame, index: DigestIndex, id_col: str, batches: int) -> DataFrame:
    """``dedup`` of the counted rows ``d`` (text_sha256, __id, __n)."""
    ends = d.agg(F.min("__id"), F.max("__id")).first()
    if batches > 1 and isinstance(ends[0], int) and ends[0] < ends[1]:
        width = ends[1] - ends[0] + 1
        cuts = sorted({ends[0] + width * i // batches for i in range(1, batches)} - {ends[0]})
        high = None
        for low in reversed(cuts):
            part = d.where(F.col("__id") >= low)
            index.add(part if high is None else part.where(F.col("__id") < high), "__id")
            high = low
        index.add(d.where(F.col("__id").isNull() | (F.col("__id") < high)), "__id")
    else:
        index.add(d, "__id")
    sizes = d.groupBy("text_sha256").agg(F.sum("__n").alias("group_size"))
    info = store(sizes.join(index.entries(), "text_sha256"), "digest-groups")
    return d.join(info, "text_sha256").select(
        F.col("__id").alias(id_col), "keep_id", "group_size",
        F.col("__id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256",
        F.col("__n").alias("n_rows"))
