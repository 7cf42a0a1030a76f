"""Checks over the ledger tables. Each returns the offending rows or one verdict row per item."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom import functions as L
from ledgerloom.operators.sequences import BAND_WIDTH, lag_by_number, running_sum
from ledgerloom.schemas import ZERO_HASH

MAX_TIP_AGE_SECONDS = 30 * 60
MAX_LAG = 10


def chain_breaks(blocks: DataFrame) -> DataFrame:
    """Blocks whose ``hashPrev`` is not the hash of a block one height below.

    An equi-join on (height, hash), so competing blocks at one height are fine.
    """
    b = blocks.select("height", "block_hash", F.col("hashPrev").alias("hash_prev"))
    parents = blocks.select((F.col("height") + 1).alias("height"),
                            F.col("block_hash").alias("hash_prev"))
    genesis_ok = (F.col("height") == 0) & (F.col("hash_prev") == ZERO_HASH)
    broken = b.where(~genesis_ok).join(parents, ["height", "hash_prev"], "left_anti")
    below = parents.select("height").distinct().withColumn("_below", F.lit(True))
    reason = (F.when(F.col("height") == 0, "genesis has a parent")
              .when(F.col("_below").isNull(), "parent missing").otherwise("hash mismatch"))
    return (broken.join(below, "height", "left")
            .select("height", "block_hash", "hash_prev", reason.alias("reason")))


def height_gaps(blocks: DataFrame, width: int = BAND_WIDTH) -> DataFrame:
    """(gap_start, gap_length) of heights missing below the tip."""
    heights = blocks.select("height").distinct()
    prev = lag_by_number(heights, "height", "height", "_prev", width=width)
    before = F.coalesce(F.col("_prev"), F.lit(-1))
    return (prev.where(F.col("height") - before > 1)
            .select((before + 1).cast("int").alias("gap_start"),
                    (F.col("height") - before - 1).cast("int").alias("gap_length")))


def build_progress(per_block: DataFrame, start: int, tip: Column | int) -> DataFrame:
    """Running transaction total and percentage done, height by height."""
    total = running_sum(per_block.select("height", "txs"), "height", "txs", "total_txs")
    end = tip if isinstance(tip, Column) else F.lit(tip)
    done = (F.col("height") - start) / (end - start + 1) * 100
    return total.select("height", "txs", "total_txs", F.round(done, 1).alias("percent"))


def order_violations(stream: DataFrame, width: int = BAND_WIDTH) -> DataFrame:
    """Per topic: records whose height lies below that of the preceding offset."""
    prev = lag_by_number(stream, "offset", "height", "_prev", ["topic_name"], width)
    return prev.groupBy("topic_name").agg(
        F.count("*").alias("records"), F.count_if(F.col("_prev") > F.col("height")).alias("violations"))


def resolve_prevouts(tx_in: DataFrame, tx_out: DataFrame) -> DataFrame:
    """Spending inputs with the value and address of the output they spend.

    Unresolved inputs stay, with NULLs. ``tx_out`` may hold several rows per
    identity; deduplicate it first if one match per input is wanted.
    """
    spent = tx_in.where(F.col("hashPrevOut") != ZERO_HASH)
    outs = tx_out.select(F.col("txid").alias("hashPrevOut"),
                         F.col("indexOut").cast("bigint").alias("indexPrevOut"),
                         F.col("value").alias("prev_value"), F.col("address").alias("prev_address"))
    return spent.join(outs, ["hashPrevOut", "indexPrevOut"], "left")


def raw_flat_parity(blocks: DataFrame, transactions: DataFrame, flat: DataFrame) -> DataFrame:
    """Per height: transactions of living blocks against flat rows, where they differ or not."""
    alive = blocks.where(F.col("finality_status") != "REORGED").select("block_hash", "height")
    raw = (transactions.join(alive, F.col("hashBlock") == F.col("block_hash"))
           .groupBy("height").agg(F.count("*").alias("raw_rows")))
    made = flat.groupBy(F.col("block_height").alias("height")).agg(F.count("*").alias("flat_rows"))
    zero = F.lit(0)
    return (raw.join(made, "height", "full")
            .select("height", F.coalesce("raw_rows", zero).alias("raw_rows"),
                    F.coalesce("flat_rows", zero).alias("flat_rows"))
            .withColumn("equal", F.col("raw_rows") == F.col("flat_rows")))


def tip_freshness(blocks: DataFrame, as_of: Column) -> DataFrame:
    """Age of the newest block; fresh below 30 minutes."""
    newest = blocks.agg(F.max("height").alias("tip_height"),
                        F.max("block_timestamp").alias("_at"))
    age = F.timestamp_diff("SECOND", F.col("_at"), as_of)
    return newest.select(
        "tip_height", L.wire_timestamp("_at").alias("tip_time"),
        age.alias("age_seconds"), (age < MAX_TIP_AGE_SECONDS).alias("fresh"))


def topic_lag(stream: DataFrame, committed: DataFrame) -> DataFrame:
    """Per topic: last offset minus the committed one; healthy below 10."""
    ends = stream.groupBy("topic_name").agg(F.max("offset").alias("end_offset"))
    lag = F.col("end_offset") - F.coalesce(F.col("committed_offset"), F.lit(-1))
    return (ends.join(committed, "topic_name", "left")
            .select("topic_name", "end_offset",
                    F.coalesce("committed_offset", F.lit(-1)).alias("committed_offset"),
                    lag.alias("lag"), (lag < MAX_LAG).alias("healthy")))


def missing_ids(expected: DataFrame, actual: DataFrame, key: str) -> DataFrame:
    """Expected keys that are not there."""
    return (expected.select(key).distinct()
            .join(actual.select(key).distinct(), key, "left_anti"))
