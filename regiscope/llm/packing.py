"""Packing by power-of-two decomposition: every document is cut into pieces of
binary lengths, equal lengths share a bucket, so no sequence crosses documents
and none needs padding."""

from __future__ import annotations

import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import lists, out_batch
from .tokens import default_vocabulary, word_ids

END_ID = 1


def binary_lengths(n: int, longest: int) -> list[int]:
    """Lengths of the pieces of ``n`` tokens: as many of ``longest`` (a power
    of two) as fit, then the binary digits of the rest, greatest first."""
    out = [longest] * (n // longest)
    rest = n % longest
    while rest:
        bit = 1 << (rest.bit_length() - 1)
        out.append(bit)
        rest -= bit
    return out


def pack(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None,
         longest: int = 2048, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """One row per piece: ``id_col, start, length, ids_crc32, doc_tokens,
    sequence_id, offset, bucket`` and, with ``with_ids``, ``ids``.

    A document is its token ids and ``end_id`` (so a NULL or empty text is one
    token). Each piece is a sequence of its own: ``offset`` is 0, its length is
    its ``bucket``, a power of two, and it is never padded. A bucket is what a
    trainer batches together; ``write_buckets`` stores them apart. Repeated
    rows are packed each; other columns are not read; an empty table gives no
    rows. ``sequence_id`` is unique within the result, not gapless: it is the
    partition number and the row in it, so no shuffle is needed and a task that
    runs again on the same input gives the same ids."""
    if longest < 1 or longest & (longest - 1):
        raise ValueError("longest must be a power of two")
    path = vocabulary or default_vocabulary()
    fields = [(id_col, None), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
              ("doc_tokens", pa.int64())] + [("ids", pa.list_(pa.int64()))] * with_ids
    schema = T.StructType([T.StructField(id_col, df.schema[id_col].dataType)]
                          + [T.StructField(n, T.LongType()) for n, _ in fields[1:5]]
                          + [T.StructField("ids", T.ArrayType(T.LongType()))] * with_ids)
    end = end_id.to_bytes(4, "little")

    def run(batches):
        import numpy as np
        encoder = word_ids(path)
        for b in batches:
            cols = [(id_col, b.schema.field(0).type)] + fields[1:]
            for part in lists(b, "__text"):
                rows: list[tuple] = []
                for key, ids in zip(part["__id"], encoder.ids(part["__text"])):
                    ids += end
                    n = len(ids) // 4
                    at = 0
                    for length in binary_lengths(n, longest):
                        piece = ids[4 * at:4 * (at + length)]
                        rows.append((key, at, length, zlib.crc32(piece), n)
                                    + ((np.frombuffer(piece, "<u4").tolist(),) if with_ids else ()))
                        at += length
                if rows:
                    yield out_batch(cols, list(zip(*rows)))

    got = df.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")).mapInArrow(run, schema)
    extra = ["ids"] * with_ids
    return got.select(id_col, "start", "length", "ids_crc32", "doc_tokens",
                      F.monotonically_increasing_id().alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
                      F.col("length").alias("bucket"), *extra)


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Store the pieces with one folder per length."""
    pieces.write.mode("overwrite").partitionBy("bucket").parquet(path)
