"""Globally ordered tables with an index of their parts.

Rows are range-partitioned and sorted, so the parts in their order are the
whole table in order, and an index holds each part's number of rows. The first
n rows, or those of a range of places, are then read from the parts that hold
them only. No task sees more than its part; the index has one row per part."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PART = "__part"


class OrderedTable:
    """The table below ``path`` in the order of ``by``, columns or expressions
    with their direction; a tie-break makes the order total."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, by: Sequence[str | Column]):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.by = [F.col(c) if isinstance(c, str) else c for c in by]

    def write(self, df: DataFrame, parts: int | None = None) -> None:
        """Write ``df``; ``parts`` is the number of ranges (default: as many as
        shuffle partitions). Rows that are equal in ``by`` lie in one part."""
        n = parts or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        rows = df.select(*[f"`{f.name}`" for f in self.schema.fields]).repartitionByRange(n, *self.by)
        rows = rows.withColumn(PART, F.spark_partition_id()).sortWithinPartitions(PART, *self.by)
        rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(PART).parquet(f"{self.path}/rows")
        self._rows().groupBy(PART).agg(F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{self.path}/index")

    def _rows(self, parts: Sequence[int] | None = None) -> DataFrame:
        schema = T.StructType([*self.schema.fields, T.StructField(PART, T.IntegerType())])
        base = f"{self.path}/rows"
        folders = [base] if parts is None else [f"{base}/{PART}={p}" for p in parts]
        return self.spark.read.schema(schema).option("basePath", base).parquet(*folders)

    def parts(self) -> list[tuple[int, int, int]]:
        """(part, rows in front of it, its rows)."""
        out, before = [], 0
        index = self.spark.read.schema(f"{PART} int, n bigint").parquet(f"{self.path}/index")
        for r in sorted(map(tuple, index.collect())):
            out.append((r[0], before, r[1]))
            before += r[1]
        return out

    def places(self, first: int, last: int, out: str = "place") -> DataFrame:
        """The rows of the places first .. last (from 1), numbered in ``out``.
        Reads the parts of those places; the numbers come from a window over
        each of these parts."""
        from pyspark.sql import Window
        need = [(p, b) for p, b, n in self.parts() if b < last and b + n >= first]
        if not need:
            return self.spark.createDataFrame([], T.StructType([*self.schema.fields, T.StructField(out, T.LongType())]))
        rows = self._rows([p for p, _ in need])
        before = F.element_at(F.create_map(*[F.lit(x) for pair in need for x in pair]), F.col(PART))
        place = F.row_number().over(Window.partitionBy(PART).orderBy(*self.by)) + before
        rows = rows.withColumn(out, place.cast("bigint")).where(F.col(out).between(first, last))
        return rows.select(*[f"`{f.name}`" for f in self.schema.fields], out)

    def top(self, n: int, out: str = "place") -> DataFrame:
        return self.places(1, n, out)
