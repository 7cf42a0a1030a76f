"""Holes in a numbered notification stream."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ledgerloom import storage
from ledgerloom.operators.sequences import BAND_WIDTH, lag_by_number
from ledgerloom.streaming.state import state_store

STREAM_BAND = 1 << 16
_BAND = "batch"      # the partition column of the result: a portion is the gaps of one band


def sequence_gaps(notifications: DataFrame, last_seen: int | None = None,
                  width: int = BAND_WIDTH) -> DataFrame:
    """(expected, seq, missed) wherever a number does not follow its predecessor.

    The first message reports nothing unless ``last_seen`` continues an earlier run.
    """
    previous = lag_by_number(notifications.select("seq"), "seq", "seq", "_prev", width=width)
    before = F.coalesce(F.col("_prev"), F.lit(last_seen).cast("bigint"))
    return (previous.select((before + 1).alias("expected"), "seq")
            .where(F.col("expected") != F.col("seq"))
            .select("expected", "seq", (F.col("seq") - F.col("expected")).alias("missed")))


def merge_intervals(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Closed intervals of whole numbers, in order, joined where they touch or overlap."""
    order = np.argsort(lo, kind="stable")
    lo, hi = lo[order], np.maximum.accumulate(hi[order])
    first = np.r_[True, lo[1:] > hi[:-1] + 1] if len(lo) else np.zeros(0, bool)
    last = np.r_[first[1:], True] if len(lo) else first
    return lo[first], hi[last]


class _Seen(StatefulProcessor):
    """The numbers a band has seen, as intervals; every batch gives those of the bands it touches."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "packed binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        known = self.seen.get()
        packed = np.frombuffer(bytes(known[0]) if known is not None else b"", "<i8").reshape(2, -1)
        lo, hi = packed[0], packed[1]
        for part in rows:
            new = np.unique(part["seq"].to_numpy(np.int64))
            lo, hi = merge_intervals(np.r_[lo, new], np.r_[hi, new])
        self.seen.update((np.stack([lo, hi]).astype("<i8").tobytes(),))
        yield pd.DataFrame({"band": np.int64(key[0]), "lo": lo, "hi": hi})

    def close(self) -> None:
        pass


class _Gaps:
    """The result table: the gaps of each band, from the intervals its numbers form."""

    def __init__(self, spark: SparkSession, out: str):
        self.spark, self.out = spark, out.rstrip("/")
        self.intervals, self.edges = f"{self.out}/_intervals", f"{self.out}/_edges"

    def take(self, intervals: DataFrame) -> None:
        """Replace what is known of the bands in ``intervals`` and of those that follow them."""
        intervals.persist()
        try:
            self._overwrite(intervals, self.intervals, "band")
            self._overwrite(intervals.groupBy("band").agg(
                F.min("lo").alias("first"), F.max("hi").alias("last")), self.edges, "band")
            changed = [r[0] for r in intervals.select("band").distinct().collect()]
        finally:
            intervals.unpersist()
        if not changed:
            return
        # one row a band: what ends the band before it
        edges = self.spark.read.schema("first BIGINT, last BIGINT, band BIGINT").parquet(self.edges)
        in_order = Window.orderBy("band")
        heads = edges.select("band", F.lag("last").over(in_order).alias("carry"),
                             F.lag("band").over(in_order).alias("before"))
        due = heads.where(F.col("band").isin(changed) | F.col("before").isin(changed))
        bands = sorted(r.band for r in due.collect())
        rows = (self.spark.read.schema("lo BIGINT, hi BIGINT, band BIGINT").parquet(self.intervals)
                .where(F.col("band").isin(bands)))
        before = F.lag("hi").over(Window.partitionBy("band").orderBy("lo"))
        gaps = (rows.withColumn("_before", before).join(F.broadcast(due), "band")
                .select((F.coalesce("_before", "carry") + 1).alias("expected"),
                        F.col("lo").alias("seq"), F.col("band").alias(_BAND))
                .where(F.col("expected") != F.col("seq"))
                .withColumn("missed", F.col("seq") - F.col("expected")))
        gaps = gaps.select("expected", "seq", "missed", _BAND)
        self._overwrite(gaps, self.out, _BAND)
        with_gaps = {r[0] for r in gaps.select(_BAND).distinct().collect()}
        for band in set(bands) - with_gaps:   # late numbers have closed all of them
            storage.delete(self.spark, f"{self.out}/{_BAND}={band}")

    def _overwrite(self, rows: DataFrame, path: str, by: str) -> None:
        (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(by).parquet(path))


def start_sequence_gaps(spark: SparkSession, source: DataFrame, out: str, checkpoint: str,
                        available_now: bool = False, width: int = STREAM_BAND) -> StreamingQuery:
    """The streaming form; after each batch ``out`` has the gaps of all numbers seen so far.

    Numbers are kept per band of ``width`` as intervals in Spark's state store, so they may
    come late, repeated and in any order: a number that fills a gap closes or splits
    it. A batch rewrites the gaps of the bands it touches and of the next band, whose first
    gap begins in them; a batch repeated after a crash writes the same again.
    """
    table = _Gaps(spark, out)
    seen = (source.select("seq", F.floor(F.col("seq") / width).alias("band"))
            .where(F.col("seq").isNotNull()).groupBy("band")
            .transformWithStateInPandas(statefulProcessor=_Seen(),
                                        outputStructType="band bigint, lo bigint, hi bigint",
                                        outputMode="Update", timeMode="None"))
    writer = (seen.writeStream.outputMode("update")
              .foreachBatch(lambda batch, _: table.take(batch))
              .option("checkpointLocation", f"{checkpoint}/query"))
    with state_store(spark):
        return (writer.trigger(availableNow=True) if available_now else writer).start()
