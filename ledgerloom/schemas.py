"""Record schemas, identity keys and routing of the ledger data model."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --- Fixed values -----------------------------------------------------------
# They are part of the stored data and of the wire format.
TOPIC_BLOCKS = "btc.blocks.v1"
TOPIC_TRANSACTIONS = "btc.transactions.v1"
TOPIC_TX_INPUTS = "btc.tx_inputs.v1"
TOPIC_TX_OUTPUTS = "btc.tx_outputs.v1"
WIRE_SCHEMA_VERSION = 1
ZERO_HASH = "0" * 64
COINBASE_INDEX = 4294967295
SATOSHIS_PER_COIN = "100000000"
OBSERVED = "OBSERVED"
CONFIRMED = "CONFIRMED"
REORGED = "REORGED"
EVENT_TYPES = ("finality", "reorg")
EVENT_STATUSES = (CONFIRMED, REORGED)
RAW_BUCKETS = 10
FLAT_RANGE_WIDTH = 100_000
CONFIRMATIONS = 6
# ----------------------------------------------------------------------------

# The figures of a block travel beside its records; this topic is the engine's own.
TOPIC_FIGURES = "ledgerloom.block_figures.v1"

# Layout columns added by the lake; they are not part of any record.
BUCKET_COL = "height_bucket"
BATCH_COL = "ingest_batch"


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields])


_STR, _INT, _LONG, _NTZ = T.StringType(), T.IntegerType(), T.LongType(), T.TimestampNTZType()

BLOCKS = _struct(
    ("block_hash", _STR), ("height", _INT), ("version", _INT), ("blocksize", _INT),
    ("hashPrev", _STR), ("hashMerkleRoot", _STR), ("nTime", _INT), ("nBits", _LONG),
    ("nNonce", _LONG), ("block_timestamp", _NTZ), ("observed_at", _STR),
    ("ingested_at", _STR), ("finality_status", _STR), ("source_seq", _INT),
)
TRANSACTIONS = _struct(
    ("txid", _STR), ("hashBlock", _STR), ("version", _INT), ("lockTime", _LONG),
    ("block_height", _INT), ("block_timestamp", _NTZ), ("observed_at", _STR),
    ("ingested_at", _STR),
)
TX_IN = _struct(
    ("txid", _STR), ("hashPrevOut", _STR), ("indexPrevOut", _LONG), ("scriptSig", _STR),
    ("sequence", _LONG), ("block_hash", _STR), ("block_height", _INT),
    ("observed_at", _STR), ("ingested_at", _STR),
)
TX_OUT = _struct(
    ("txid", _STR), ("indexOut", _INT), ("height", _INT), ("value", _LONG),
    ("scriptPubKey", _STR), ("address", _STR), ("block_hash", _STR),
    ("block_timestamp", _NTZ), ("observed_at", _STR), ("ingested_at", _STR),
)
FLAT = _struct(
    ("txid", _STR), ("block_height", _INT), ("block_hash", _STR), ("block_timestamp", _NTZ),
    ("nTime", _INT), ("tx_version", _INT), ("lockTime", _LONG), ("input_count", _INT),
    ("inputs", T.ArrayType(_struct(
        ("hashPrevOut", _STR), ("indexPrevOut", _LONG), ("scriptSig", _STR), ("sequence", _LONG)))),
    ("output_count", _INT), ("total_output_value", _LONG),
    ("outputs", T.ArrayType(_struct(
        ("indexOut", _INT), ("value", _LONG), ("scriptPubKey", _STR), ("address", _STR)))),
    ("finality_status", _STR),
)
FLAT_KEY = ("txid", "block_height")

# Money is parsed as an exact decimal; no double is ever involved. A block may come in
# several documents, and a transaction in several pieces: those numbered 0, or not numbered,
# stand for the block's header and for the transaction itself.
BLOCK_DOCUMENT = _struct(
    ("hash", _STR), ("height", _LONG), ("version", _LONG), ("size", _LONG),
    ("previousblockhash", _STR), ("merkleroot", _STR), ("time", _LONG), ("bits", _STR),
    ("nonce", _LONG), ("slice", _INT),
    ("tx", T.ArrayType(_struct(
        ("txid", _STR), ("version", _LONG), ("locktime", _LONG), ("piece", _INT),
        ("vin", T.ArrayType(_struct(
            ("coinbase", _STR), ("txid", _STR), ("vout", _LONG),
            ("scriptSig", _struct(("hex", _STR))), ("sequence", _LONG)))),
        ("vout", T.ArrayType(_struct(
            ("value", T.DecimalType(28, 18)), ("n", _LONG),
            ("scriptPubKey", _struct(("hex", _STR), ("address", _STR))))))))),
)

CONTROL_EVENT = _struct(
    ("type", _STR), ("block_hash", _STR), ("height", _LONG), ("finality_status", _STR),
    ("timestamp", _STR),
)


_HASHES = {"block_hash", "hashPrev", "hashMerkleRoot", "txid", "hashBlock", "hashPrevOut",
           "scriptSig", "scriptPubKey"}


@dataclass(frozen=True)
class RecordKind:
    """One record stream: where it travels, where it is stored, what names a row."""

    table: str
    topic: str
    schema: T.StructType
    key: tuple[str, ...]
    height_col: str
    required: tuple[str, ...]

    @property
    def wire_schema(self) -> T.StructType:
        """Payload as sent: integers widened to BIGINT, times as text."""
        def widen(dtype: T.DataType) -> T.DataType:
            if isinstance(dtype, T.IntegerType):
                return _LONG
            return _STR if isinstance(dtype, T.TimestampNTZType) else dtype

        fields = [T.StructField("schema_version", _LONG)]
        fields += [T.StructField(f.name, widen(f.dataType)) for f in self.schema]
        return T.StructType(fields)

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def hashes(self) -> list[str]:
        """Columns of hashes and scripts, which are hex as a rule."""
        return [c for c in self.columns if c in _HASHES]

    @property
    def block_col(self) -> str:
        """The column that names the record's block."""
        return "hashBlock" if "hashBlock" in self.columns else "block_hash"


KINDS: dict[str, RecordKind] = {
    k.table: k
    for k in (
        RecordKind("blocks", TOPIC_BLOCKS, BLOCKS, ("block_hash",), "height",
                   ("block_hash", "height")),
        RecordKind("transactions", TOPIC_TRANSACTIONS, TRANSACTIONS, ("txid",), "block_height",
                   ("txid",)),
        RecordKind("tx_in", TOPIC_TX_INPUTS, TX_IN, ("txid", "hashPrevOut", "indexPrevOut"),
                   "block_height", ("txid", "hashPrevOut", "indexPrevOut")),
        RecordKind("tx_out", TOPIC_TX_OUTPUTS, TX_OUT, ("txid", "indexOut"), "height",
                   ("txid", "indexOut")),
    )
}
TABLE_OF_TOPIC = {k.topic: k.table for k in KINDS.values()}
