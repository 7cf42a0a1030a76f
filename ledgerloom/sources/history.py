"""Historical CSV dumps to the raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom import functions as L
from ledgerloom.operators.broadcasting import broadcast_if_small
from ledgerloom.operators.conform import conform
from ledgerloom.operators.normalize import LedgerFrames
from ledgerloom.schemas import CONFIRMED, KINDS
from ledgerloom.sources.lake import Lake

# The columns of the four historical files.
HISTORY = {
    "blocks": "block_hash STRING, height BIGINT, version BIGINT, blocksize BIGINT, "
              "hashPrev STRING, hashMerkleRoot STRING, nTime BIGINT, nBits BIGINT, nNonce BIGINT",
    "transactions": "txid STRING, hashBlock STRING, version BIGINT, lockTime BIGINT",
    "tx_in": "txid STRING, hashPrevOut STRING, indexPrevOut BIGINT, scriptSig STRING, "
             "sequence BIGINT",
    "tx_out": "txid STRING, indexOut BIGINT, height BIGINT, value BIGINT, scriptPubKey STRING, "
              "address STRING",
}
_MAY_BE_EMPTY = {"tx_in": ("scriptSig",), "tx_out": ("scriptPubKey", "address")}


def history_columns(table: str) -> list[str]:
    return [part.split()[0] for part in HISTORY[table].split(",")]


def write_history(frames: LedgerFrames, root: str, sep: str = ";") -> None:
    """Dump the historical columns of the four frames as CSV."""
    for table, frame in frames.items():
        (frame.select(*history_columns(table)).write.mode("overwrite")
         .option("sep", sep).option("emptyValue", "").option("compression", "gzip")
         .csv(f"{root}/{table}"))


def read_history(spark: SparkSession, root: str, table: str, sep: str = ";") -> DataFrame:
    df = spark.read.schema(HISTORY[table]).option("sep", sep).csv(f"{root}/{table}")
    for name in _MAY_BE_EMPTY.get(table, ()):  # CSV cannot tell empty text from none
        df = df.withColumn(name, L.default_if_missing(name, ""))
    return df


def from_history(spark: SparkSession, root: str, loaded_at: str, sep: str = ";",
                 status: str = CONFIRMED) -> LedgerFrames:
    """Historical files mapped to the raw schemas.

    Transactions find their block by its hash, inputs and outputs by their
    transaction: by the first one of a txid that came twice, and outputs by the one
    at their own height. Rows without a block are in ``unplaced_history``.
    """
    raw = {table: read_history(spark, root, table, sep) for table in HISTORY}
    stamps = [F.lit(loaded_at).alias("observed_at"), F.lit(loaded_at).alias("ingested_at")]
    when = L.utc_wall_clock("nTime").alias("block_timestamp")
    blocks = raw["blocks"].select(
        "*", when, *stamps, F.lit(status).alias("finality_status"))
    placed = raw["blocks"].select(F.col("block_hash").alias("hashBlock"),
                                  F.col("height").alias("block_height"), when)
    transactions = raw["transactions"].join(
        broadcast_if_small(placed), "hashBlock").select(
        *history_columns("transactions"), "block_height", "block_timestamp", *stamps)
    owner = transactions.select("txid", F.col("hashBlock").alias("block_hash"), "block_height",
                                "block_timestamp")
    first = _one_per(owner, "txid")
    tx_in = raw["tx_in"].join(first, "txid").select(
        *history_columns("tx_in"), "block_hash", "block_height", *stamps)
    placed_at = _one_per(owner.withColumnRenamed("block_height", "height"), "txid", "height")
    tx_out = raw["tx_out"].join(placed_at, ["txid", "height"]).select(
        *history_columns("tx_out"), "block_hash", "block_timestamp", *stamps)
    frames = {"blocks": blocks, "transactions": transactions, "tx_in": tx_in, "tx_out": tx_out}
    return LedgerFrames(**{t: conform(df, KINDS[t]) for t, df in frames.items()})


def _one_per(owner: DataFrame, *key: str) -> DataFrame:
    """The earliest block of each key."""
    rest = [c for c in ("block_height", "block_hash", "block_timestamp") if c in owner.columns]
    least = F.min(F.struct(*rest)).alias("_least")
    return owner.groupBy(*key).agg(least).select(*key, *[f"_least.{c}" for c in rest])


def unplaced_history(spark: SparkSession, root: str, sep: str = ";") -> DataFrame:
    """(table_name, value, reason) of the rows that have no block: what ``from_history`` leaves out."""
    raw = {table: read_history(spark, root, table, sep) for table in HISTORY}
    txs = raw["transactions"]
    blocks = raw["blocks"].select(F.col("block_hash").alias("hashBlock"), "height")
    known = txs.join(blocks, "hashBlock").select("txid", "height")
    lost = {"transactions": txs.join(blocks, "hashBlock", "left_anti"),
            "tx_in": raw["tx_in"].join(known, "txid", "left_anti"),
            "tx_out": raw["tx_out"].join(known, ["txid", "height"], "left_anti")}
    out = None
    for table, df in lost.items():
        part = df.select(F.lit(table).alias("table_name"), F.to_json(F.struct(
            *history_columns(table))).alias("value"), F.lit("no block").alias("reason"))
        out = part if out is None else out.unionByName(part)
    return out


def backfill(spark: SparkSession, root: str, lake: Lake, loaded_at: str, sep: str = ";") -> None:
    """Load the dumps as one batch per table, and set aside rows without a block.

    The batch is named by the heights and hashes of the block file: the same dump
    again replaces itself, another one is a batch of its own.
    """
    span = read_history(spark, root, "blocks", sep).agg(
        F.min("height").alias("lo"), F.max("height").alias("hi"),
        F.bit_xor(F.xxhash64("block_hash")).alias("mark")).first()
    batch = f"backfill-{span.lo}-{span.hi}-{(span.mark or 0) & (1 << 64) - 1:016x}"
    lake.append_all(from_history(spark, root, loaded_at, sep), batch)
    (unplaced_history(spark, root, sep).withColumn("batch", F.lit(batch))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("table_name", "batch").parquet(f"{lake.root}/_quarantine"))
