"""CSV scan with a declared all-string schema.

Columns are renamed to snake_case once at this boundary (P14), the UTF-8
byte-order mark is dropped from the first header, and a missing path gives
an empty frame of the declared schema instead of an exception.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

BOM = "﻿"


def snake(name: str) -> str:
    s = name.replace(BOM, "").strip()
    s = re.sub(r"[^0-9A-Za-z]+", "_", s).strip("_").lower()
    return s or "col"


def string_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def read_csv(spark: SparkSession, path: str, columns: Sequence[str],
             rename: bool = True) -> DataFrame:
    """Read ``path`` (file, folder or glob) with header; every column a
    string. ``columns`` are found in the header by name, in any order; one the
    file lacks is NULL. Files of a folder must agree on their header."""
    try:
        df = (spark.read.option("header", True).option("inferSchema", False).option("encoding", "UTF-8")
              .option("enforceSchema", False).option("mode", "PERMISSIVE").csv(path))
    except AnalysisException:
        df = spark.createDataFrame([], string_schema(columns))
    df = df.toDF(*[c.replace(BOM, "").strip() for c in df.columns])
    have = set(df.columns)
    df = df.select(*[(F.col(f"`{c}`") if c in have else F.lit(None).cast("string")).alias(c) for c in columns])
    return df.toDF(*[snake(c) for c in columns]) if rename else df
