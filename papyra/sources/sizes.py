"""Decisions that depend on the size of a table, which is checked first."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A side found to hold no more rows, and no more bytes of text in them, is broadcast.
BROADCAST_ROWS = 500_000
BROADCAST_TEXT_BYTES = 64 << 20
# Text that one task works on.
TEXT_PARTITION_BYTES = 16 << 20


def can_broadcast(df: DataFrame) -> bool:
    """Whether ``df``, of numbers and short texts, has been measured to be fit for broadcast."""
    texts = [F.octet_length(c) for c, kind in df.dtypes if kind == "string"]
    size = sum(texts, F.lit(0)) if texts else F.lit(0)
    rows, text_bytes = df.limit(BROADCAST_ROWS + 1).agg(
        F.count("*"), F.coalesce(F.sum(size), F.lit(0))
    ).first()
    return rows <= BROADCAST_ROWS and text_bytes <= BROADCAST_TEXT_BYTES


def partitions_for(spark: SparkSession, text_bytes: int) -> int:
    """How many partitions work on so much text takes: one per task slot and per so many bytes."""
    return max(spark.sparkContext.defaultParallelism, -(-text_bytes // TEXT_PARTITION_BYTES))


def text_partitions(df: DataFrame, text_column: str) -> int:
    """``partitions_for`` the measured size of a column."""
    size = df.agg(F.coalesce(F.sum(F.octet_length(text_column)), F.lit(0))).first()[0]
    return partitions_for(df.sparkSession, size)
