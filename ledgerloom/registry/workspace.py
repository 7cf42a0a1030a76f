"""Data sets several queries share: documents, topics and a loaded lake.

Each is derived by Spark from the given tables, written once per session below
the shared folder, and read from there afterwards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom import functions as L
from ledgerloom import storage
from ledgerloom.operators.normalize import LedgerFrames, to_messages
from ledgerloom.schemas import KINDS
from ledgerloom.sources import documents, topics
from ledgerloom.sources.lake import Lake
from ledgerloom.sources.views import LedgerViews

_written: dict[tuple[str, str, str], str] = {}

# Columns that make up the fingerprint of a record; stamps and status are left out.
PRINTED = {
    "blocks": ("block_hash", "height", "version", "blocksize", "hashPrev", "hashMerkleRoot",
               "nTime", "nBits", "nNonce", "block_timestamp"),
    "transactions": ("txid", "hashBlock", "version", "lockTime", "block_height",
                     "block_timestamp"),
    "tx_in": ("txid", "hashPrevOut", "indexPrevOut", "scriptSig", "sequence", "block_hash",
              "block_height"),
    "tx_out": ("txid", "indexOut", "height", "value", "scriptPubKey", "address", "block_hash",
               "block_timestamp"),
}


class Workspace:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.views = LedgerViews(spark, sf_dir)
        storage.drop_shuffles(spark)

    def _once(self, label: str, write) -> str:
        key = (self.spark.sparkContext.applicationId, self.sf_dir, label)
        if key not in _written:
            path = storage.new_dir(self.spark, label)
            write(path)
            _written[key] = path
        return _written[key]

    def new_dir(self, label: str) -> str:
        return storage.new_dir(self.spark, label)

    def documents_dir(self) -> str:
        return self._once("documents", lambda p: documents.write_documents(
            self.views.documents(), p))

    def documents(self) -> DataFrame:
        return documents.read_documents(self.spark, self.documents_dir())

    def topics_dir(self) -> str:
        return self._once("topics", lambda p: topics.publish(
            to_messages(wire_frames(LedgerViews(self.spark, self.sf_dir, ordered=True).frames())), p))

    def topic_offsets(self) -> DataFrame:
        return self.spark.read.parquet(self._once(
            "offsets", lambda p: self.views.topic_offsets().write.parquet(p)))

    def tip(self) -> int:
        """The greatest height of the derived ledger, without a lake of it."""
        return self.views.heights().agg(F.coalesce(F.max("height"), F.lit(-1))).first()[0]

    def lake(self) -> Lake:
        """All four tables, loaded as one batch. Queries must not change it."""
        def load(path: str) -> None:
            lake = Lake(self.spark, path)
            rows = LedgerViews(self.spark, self.sf_dir, spread=lake.bucket_of, ordered=True).frames()
            lake.append_all(rows, "load", spread=True)  # narrow rows were rebalanced
        return Lake(self.spark, self._once("lake", load))

    def new_lake(self, label: str) -> Lake:
        return Lake(self.spark, self.new_dir(label))

    def stored(self) -> LedgerFrames:
        lake = self.lake()
        return LedgerFrames(**{t: lake.read(t) for t in KINDS})


def wire_frames(frames: LedgerFrames) -> LedgerFrames:
    """Table records as wire records: version added, integers widened, times as text."""
    def convert(table: str, df: DataFrame) -> DataFrame:
        out = [F.lit(1).cast("bigint").alias("schema_version")]
        for field in KINDS[table].wire_schema.fields[1:]:
            c = F.col(field.name)
            if field.name == "block_timestamp":
                c = L.wire_timestamp(c)
            out.append(c.cast(field.dataType).alias(field.name))
        return df.select(*out)

    return LedgerFrames(**{t: convert(t, f) for t, f in frames.items()})


def text_of(column: str):
    c = F.col(column)
    return L.wire_timestamp(c) if column == "block_timestamp" else c.cast("string")


def fingerprint(columns):
    """Order-free checksum of all rows: the sum of a 32-bit hash of each."""
    row = F.md5(F.concat_ws("|", *[text_of(c) for c in columns]).cast("binary"))
    part = F.conv(F.substring(row, 1, 8), 16, 10).cast("decimal(20,0)")
    return F.coalesce(F.sum(part), F.lit(0).cast("decimal(30,0)")).cast("decimal(38,0)").cast(
        "string")


def summary(frames: LedgerFrames) -> DataFrame:
    """(table_name, row_count, fingerprint) of the four tables."""
    out = None
    for table, frame in frames.items():
        part = frame.agg(F.count("*").alias("row_count"),
                         fingerprint(PRINTED[table]).alias("fingerprint")).select(
            F.lit(table).alias("table_name"), "row_count", "fingerprint")
        out = part if out is None else out.unionByName(part)
    return out

