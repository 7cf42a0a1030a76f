"""Counts and totals over the raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.normalize import LedgerFrames
from ledgerloom.schemas import KINDS


def _stack(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def table_counts(frames: LedgerFrames) -> DataFrame:
    return _stack([f.agg(F.count("*").alias("row_count"))
                   .select(F.lit(t).alias("table_name"), "row_count") for t, f in frames.items()])


def block_record_counts(frames: LedgerFrames) -> DataFrame:
    """Transactions, inputs, outputs and all records of every block."""
    def per_height(table: str, name: str) -> DataFrame:
        height = F.col(KINDS[table].height_col).alias("height")
        return getattr(frames, table).groupBy(height).agg(F.count("*").alias(name))

    joined = frames.blocks.select("height")
    for table, name in (("transactions", "txs"), ("tx_in", "inputs"), ("tx_out", "outputs")):
        joined = joined.join(per_height(table, name), "height", "left")
    txs, ins, outs = (F.coalesce(F.col(c), F.lit(0)) for c in ("txs", "inputs", "outputs"))
    return joined.select("height", txs.alias("txs"), ins.alias("inputs"), outs.alias("outputs"),
                         (txs + ins + outs + 1).alias("records"))


def run_averages(per_block: DataFrame) -> DataFrame:
    names = ("txs", "inputs", "outputs", "records")
    return per_block.agg(
        F.count("*").alias("blocks"),
        *[F.sum(c).alias(f"total_{c}") for c in names],
        *[F.round(F.avg(c), 4).alias(f"avg_{c}") for c in names])


def throughput(records: int, elapsed_ms: float) -> float:
    """Records per second."""
    return records / (elapsed_ms / 1000.0)


def run_rates(per_block: DataFrame, records: str, elapsed_ms: str,
              interval_ms: int = 600_000) -> DataFrame:
    """Adds records per second, and how many times the elapsed time fits into the interval."""
    return (per_block.withColumn("per_second", F.round(F.col(records) * 1000 / F.col(elapsed_ms), 4))
            .withColumn("headroom", F.round(F.lit(interval_ms) / F.col(elapsed_ms), 4)))


def headroom(interval_ms: float, latency_ms: float) -> float:
    """How many times the latency fits into the block interval."""
    return interval_ms / latency_ms


def value_checksum(frames: LedgerFrames) -> DataFrame:
    """Rows and exact satoshi total per table; tables without money total zero."""
    none = F.lit(0).cast("decimal(38,0)")
    parts = []
    for table, frame in frames.items():
        total = F.coalesce(F.sum(F.col("value").cast("decimal(20,0)")), none) \
            if table == "tx_out" else F.first(none)
        parts.append(frame.agg(F.count("*").alias("row_count"), total.alias("satoshis"))
                     .select(F.lit(table).alias("table_name"), "row_count",
                             F.coalesce(F.col("satoshis"), none).cast("decimal(38,0)")
                             .alias("satoshis")))
    return _stack(parts)


def compare_sources(left: DataFrame, right: DataFrame) -> DataFrame:
    """Two checksum tables side by side, with a verdict per table."""
    a = left.select("table_name", F.col("row_count").alias("left_rows"),
                    F.col("satoshis").alias("left_satoshis"))
    b = right.select("table_name", F.col("row_count").alias("right_rows"),
                     F.col("satoshis").alias("right_satoshis"))
    same = (F.col("left_rows").eqNullSafe(F.col("right_rows"))
            & F.col("left_satoshis").eqNullSafe(F.col("right_satoshis")))
    return a.join(b, "table_name", "full").withColumn("equal", same)
