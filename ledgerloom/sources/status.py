"""Finality statuses as an append-only log beside the blocks, merged when blocks are read.

An entry says which status a block has from now on, and which event said so. The
newest entry of a block counts, whatever a raw folder holds: a batch that is appended
again, or a compaction, cannot take a status back. Entries are written by named
portions; the same portion again replaces itself. Folding keeps one entry a block, and
as the newest entry counts either way, a fold that stops half-way does no harm.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom import storage

SCHEMA = "block_hash STRING, finality_status STRING, offset BIGINT, version BIGINT"
_PORTION = "portion"


class StatusLog:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def is_empty(self) -> bool:
        return not self._portions()

    def _portions(self) -> list[str]:
        return [n for n in storage.child_names(self.spark, self.path)
                if n.startswith(f"{_PORTION}=")]

    def entries(self, but: str | None = None) -> DataFrame:
        """All entries, or those of every portion except ``but``."""
        storage.make_dirs(self.spark, self.path)
        rows = self.spark.read.schema(f"{SCHEMA}, {_PORTION} STRING").parquet(self.path)
        return rows if but is None else rows.where(F.col(_PORTION) != but)

    def append(self, changes: DataFrame, portion: str) -> None:
        """(block_hash, finality_status, offset) with one row a block; they count from now on."""
        newest = self.entries(but=portion).agg(F.coalesce(F.max("version"), F.lit(0))).first()[0]
        (changes.select("block_hash", "finality_status", F.col("offset").cast("bigint"),
                        F.lit(newest + 1).cast("bigint").alias("version"))
         .write.mode("overwrite").parquet(f"{self.path}/{_PORTION}={portion}"))

    def latest(self) -> DataFrame:
        """(block_hash, finality_status, offset, version): the entry that counts."""
        return self._reduced(self.entries())

    @staticmethod
    def _reduced(entries: DataFrame) -> DataFrame:
        last = F.max(F.struct("version", "finality_status")).alias("last")
        return (entries.groupBy("block_hash").agg(last, F.max("offset").alias("offset"))
                .select("block_hash", "last.finality_status", "offset", "last.version"))

    def offsets(self, but: str | None = None) -> DataFrame:
        """(block_hash, offset): the newest event a block's status has taken over."""
        return (self.entries(but).where(F.col("offset").isNotNull())
                .groupBy("block_hash").agg(F.max("offset").alias("offset")))

    def over(self, blocks: DataFrame) -> DataFrame:
        """``blocks`` with the status that counts; columns and their order stay."""
        if self.is_empty():
            return blocks
        now = self.latest().select("block_hash", F.col("finality_status").alias("_now"))
        status = F.coalesce(F.col("_now"), F.col("finality_status")).alias("finality_status")
        return blocks.join(now, "block_hash", "left").select(
            *[status if c == "finality_status" else F.col(c) for c in blocks.columns])

    def fold(self, name: str) -> None:
        """One entry a block: the folded portion is written first, then what it holds goes."""
        portions = self._portions()
        if len(portions) < 2:
            return
        self._reduced(self.entries()).write.mode("overwrite").parquet(
            f"{self.path}/{_PORTION}=folded-{name}")
        for portion in portions:
            if portion != f"{_PORTION}=folded-{name}":
                storage.delete(self.spark, f"{self.path}/{portion}")
