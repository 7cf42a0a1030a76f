"""Alerts with a cooldown over a stream of service checks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ledgerloom import storage
from ledgerloom.operators.health import CHECK_SECONDS, COOLDOWN_SECONDS
from ledgerloom.streaming.state import state_store

LATENESS = "1 hour"
_OUT = "service bigint, run bigint, open boolean"
_PORTION = "batch"


def fold_alerts(runs: np.ndarray, failed: np.ndarray, last_alert: int | None,
                gap: int) -> tuple[list[int], int | None]:
    """Alerts of runs in order, and the alert that a later failure has to mind."""
    alerts = []
    for run, bad in zip(runs.tolist(), failed.tolist()):
        if not bad:
            last_alert = None
        elif last_alert is None or run - last_alert >= gap:
            alerts.append(run)
            last_alert = run
    return alerts, last_alert


class _Cooldown(StatefulProcessor):
    """Per service: the runs that may still change, and the last alert before them.

    A run is settled once the watermark has passed its end. Until then its alert is
    given as open with every batch that brings checks of the service, and may change.
    A timer settles what is left when no more checks come.
    """

    def __init__(self, every: int, gap: int):
        self.every, self.gap = every, gap

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pending = handle.getValueState("pending", "runs binary, failed binary")
        self.last = handle.getValueState("last", "run bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        runs, failed = self._known()
        for part in rows:
            seconds = part["ts"].to_numpy("datetime64[s]").astype(np.int64)
            run = np.r_[runs, seconds // self.every]
            bad = np.r_[failed, (part["status"] != "ok").to_numpy(bool)]
            runs, place = np.unique(run, return_inverse=True)
            failed = np.zeros(len(runs), bool)
            np.logical_or.at(failed, place, bad)
        yield self._settle(key, runs, failed, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield self._settle(key, *self._known(), timerValues.getCurrentWatermarkInMs())

    def _known(self) -> tuple[np.ndarray, np.ndarray]:
        held = self.pending.get()
        if held is None:
            return np.zeros(0, np.int64), np.zeros(0, bool)
        return np.frombuffer(bytes(held[0]), "<i8"), np.frombuffer(bytes(held[1]), "?")

    def _settle(self, key, runs: np.ndarray, failed: np.ndarray, watermark: int) -> pd.DataFrame:
        held = self.last.get()
        last = held[0] if held is not None else None
        done = (runs + 1) * self.every * 1000 <= watermark
        settled, last = fold_alerts(runs[done], failed[done], last, self.gap)
        runs, failed = runs[~done], failed[~done]
        still_open, _ = fold_alerts(runs, failed, last, self.gap)
        if last is None:
            self.last.clear()
        else:
            self.last.update((last,))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if len(runs):
            self.pending.update((runs.astype("<i8").tobytes(), failed.tobytes()))
            self.handle.registerTimer(int((runs[0] + 1) * self.every * 1000))
        else:
            self.pending.clear()
        # the row without a run says that the service was looked at
        found = [*settled, *still_open, None]
        return pd.DataFrame({
            "service": np.int64(key[0]), "run": pd.array(found, "Int64"),
            "open": [False] * len(settled) + [True] * (len(still_open) + 1)})

    def close(self) -> None:
        pass


class _Alerts:
    """The result table: settled alerts by batch, open ones by service."""

    def __init__(self, spark: SparkSession, out: str):
        self.spark, self.out = spark, out.rstrip("/")

    def take(self, rows: DataFrame, batch_id: int) -> None:
        rows = rows.withColumn("service", F.col("service").cast("int")).persist()
        try:
            looked_at = {r[0] for r in rows.select("service").distinct().collect()}
            portion = F.when(F.col("open"), F.concat(F.lit("open-"), F.col("service"))).otherwise(
                F.lit(str(batch_id)))
            alerts = rows.where(F.col("run").isNotNull()).select(
                "service", "run", portion.alias(_PORTION))
            (alerts.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy(_PORTION).parquet(self.out))
            still_open = {r[0] for r in rows.where("open and run is not null")
                          .select("service").distinct().collect()}
        finally:
            rows.unpersist()
        for service in looked_at - still_open:
            storage.delete(self.spark, f"{self.out}/{_PORTION}=open-{service}")


def start_alerts(spark: SparkSession, checks: DataFrame, out: str, checkpoint: str,
                 every: int = CHECK_SECONDS, cooldown: int = COOLDOWN_SECONDS,
                 available_now: bool = False, lateness: str = LATENESS) -> StreamingQuery:
    """Alerts (service, run) of all checks so far, in ``out`` after each batch.

    Checks may come in any order and split over batches: a run stays open until the
    watermark, ``lateness`` behind the newest check, has passed its end. Its alert is in
    ``out`` from the start and follows late checks; then an event-time timer settles it and
    the run leaves the state. Checks that come later still are ignored. State and timers
    are Spark's; a batch repeated after a crash writes its own portions again.
    """
    table = _Alerts(spark, out)
    timed = (checks.select(F.col("service").cast("bigint").alias("service"), "status",
                           F.col("ts").cast("timestamp").alias("ts"))
             .withWatermark("ts", lateness))
    sent = timed.groupBy("service").transformWithStateInPandas(
        statefulProcessor=_Cooldown(every, -(-cooldown // every)), outputStructType=_OUT,
        outputMode="Update", timeMode="EventTime")
    writer = (sent.writeStream.outputMode("update").foreachBatch(table.take)
              .option("checkpointLocation", f"{checkpoint}/query"))
    with state_store(spark):
        return (writer.trigger(availableNow=True) if available_now else writer).start()
