"""Broadcast only what has been measured."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_BROADCAST_BYTES = 64 << 20
_FIXED_BYTES = 8  # what a number or a time takes


def estimated_bytes(df: DataFrame) -> int:
    """Size Spark's own statistics give for the frame."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def auto_broadcast_bytes(df: DataFrame) -> int:
    conf = df.sparkSession._jsparkSession.sessionState().conf()
    return int(conf.autoBroadcastJoinThreshold())


def measured_bytes(df: DataFrame) -> int:
    """Bytes of the frame's values, in one job: texts by their length, all else by its width."""
    texts = [f.name for f in df.schema if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    fixed = _FIXED_BYTES * (len(df.columns) - len(texts))
    size = F.lit(fixed)
    for name in texts:
        size = size + F.coalesce(F.octet_length(F.col(name)), F.lit(0)) + _FIXED_BYTES
    return df.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]


def broadcast_if_small(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast for a frame of at most ``max_bytes``; else leave the join to Spark.

    A frame Spark would broadcast by itself is returned as it is. Any other is measured.
    """
    if estimated_bytes(df) <= auto_broadcast_bytes(df):
        return df
    return F.broadcast(df) if measured_bytes(df) <= max_bytes else df
