"""Nested block documents to the four flat record streams.

Each ``*_record`` function describes one record as columns over a block, a
transaction and a child. They serve both forms below: four DataFrames for table
writes, and one single-pass topic stream for publishing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom import functions as L
from ledgerloom.schemas import (
    COINBASE_INDEX,
    KINDS,
    OBSERVED,
    TOPIC_FIGURES,
    WIRE_SCHEMA_VERSION,
    ZERO_HASH,
)
from ledgerloom.sources import completeness


@dataclass(frozen=True)
class LedgerFrames:
    blocks: DataFrame
    transactions: DataFrame
    tx_in: DataFrame
    tx_out: DataFrame

    def items(self) -> list[tuple[str, DataFrame]]:
        return [(name, getattr(self, name)) for name in KINDS]


@dataclass(frozen=True)
class _Stamp:
    observed_at: Column
    source_seq: Column

    def columns(self) -> list[Column]:
        return [self.observed_at.alias("observed_at"), self.observed_at.alias("ingested_at")]


def _version() -> Column:
    return F.lit(WIRE_SCHEMA_VERSION).cast("bigint").alias("schema_version")


def _block_time(b: Column) -> Column:
    return L.wire_timestamp(L.utc_wall_clock(b["time"])).alias("block_timestamp")


def block_record(b: Column, stamp: _Stamp) -> list[Column]:
    return [
        _version(),
        b["hash"].alias("block_hash"),
        b["height"].alias("height"),
        b["version"].alias("version"),
        b["size"].alias("blocksize"),
        L.default_if_missing(b["previousblockhash"], ZERO_HASH).alias("hashPrev"),
        b["merkleroot"].alias("hashMerkleRoot"),
        b["time"].alias("nTime"),
        L.compact_target(b["bits"]).alias("nBits"),
        b["nonce"].alias("nNonce"),
        _block_time(b),
        *stamp.columns(),
        F.lit(OBSERVED).alias("finality_status"),
        stamp.source_seq.alias("source_seq"),
    ]


def transaction_record(b: Column, tx: Column, stamp: _Stamp) -> list[Column]:
    return [
        _version(),
        tx["txid"].alias("txid"),
        b["hash"].alias("hashBlock"),
        tx["version"].alias("version"),
        tx["locktime"].alias("lockTime"),
        b["height"].alias("block_height"),
        _block_time(b),
        *stamp.columns(),
    ]


def input_record(b: Column, tx: Column, vin: Column, stamp: _Stamp) -> list[Column]:
    minted = vin["coinbase"].isNotNull()
    script = L.default_if_missing(vin["scriptSig"]["hex"], "")
    return [
        _version(),
        tx["txid"].alias("txid"),
        F.when(minted, F.lit(ZERO_HASH)).otherwise(vin["txid"]).alias("hashPrevOut"),
        F.when(minted, F.lit(COINBASE_INDEX)).otherwise(vin["vout"]).alias("indexPrevOut"),
        F.when(minted, vin["coinbase"]).otherwise(script).alias("scriptSig"),
        vin["sequence"].alias("sequence"),
        b["hash"].alias("block_hash"),
        b["height"].alias("block_height"),
        *stamp.columns(),
    ]


def output_record(b: Column, tx: Column, vout: Column, stamp: _Stamp) -> list[Column]:
    return [
        _version(),
        tx["txid"].alias("txid"),
        vout["n"].alias("indexOut"),
        b["height"].alias("height"),
        L.coin_to_satoshis(vout["value"]).alias("value"),
        L.default_if_missing(vout["scriptPubKey"]["hex"], "").alias("scriptPubKey"),
        L.default_if_missing(vout["scriptPubKey"]["address"], "").alias("address"),
        b["hash"].alias("block_hash"),
        _block_time(b),
        *stamp.columns(),
    ]


_HEADER = ("hash", "height", "version", "size", "previousblockhash", "merkleroot", "time",
           "bits", "nonce")


def _stamp(observed_at: str | None, source_seq: Column | int | None) -> _Stamp:
    seen = F.lit(observed_at) if observed_at is not None else L.ingest_stamp()
    seq = source_seq if isinstance(source_seq, Column) else F.lit(source_seq)
    return _Stamp(seen, seq.cast("bigint"))


def _header(present: list[str]) -> Column:
    return F.struct(*[F.col(c) for c in _HEADER if c in present]).alias("b")


def _is_first(number: Column) -> Column:
    return F.coalesce(number, F.lit(0)) == 0


def _numbered(documents: DataFrame) -> DataFrame:
    """The documents with a slice, and with pieces of their transactions."""
    if "slice" not in documents.columns:
        documents = documents.withColumn("slice", F.lit(0))
    if "piece" not in documents.schema["tx"].dataType.elementType.fieldNames():
        documents = documents.withColumn(
            "tx", F.transform("tx", lambda t: t.withField("piece", F.lit(0))))
    return documents


def normalize(documents: DataFrame, observed_at: str | None = None,
              source_seq: Column | int | None = None) -> LedgerFrames:
    """The four record frames of a frame of block documents (``BLOCK_DOCUMENT`` columns).

    A header comes from slice 0 of its block alone, a transaction from its piece 0.
    """
    documents, stamp = _numbered(documents), _stamp(observed_at, source_seq)
    header = documents.where(_is_first(F.col("slice"))).select(
        _header(documents.columns), stamp.source_seq.alias("_seq"))
    return _records(header, documents.select(_header(documents.columns), F.explode("tx").alias("tx")),
                    stamp)


def cut_documents(documents: DataFrame) -> DataFrame:
    """(b, slice, figures, at, tx): documents cut into their transactions, to be stored.

    ``at`` is the place of the transaction, null in a document without any. The first row of
    a document has its figures. No row is longer than a transaction's piece.
    """
    documents = _numbered(documents)
    slice_ = F.coalesce("slice", F.lit(0)).cast("int").alias("slice")
    whole = documents.select(_header(documents.columns), slice_, "tx", _figures().alias("figures"))
    rows = whole.select("b", "slice", "figures", F.posexplode_outer("tx").alias("at", "tx"))
    return rows.withColumn("figures", F.when(_is_first(F.col("at")), F.col("figures")))


def normalize_cut(cut: DataFrame, observed_at: str | None = None,
                  source_seq: Column | int | None = None) -> LedgerFrames:
    """``normalize`` of documents that ``cut_documents`` has cut."""
    stamp = _stamp(observed_at, source_seq)
    header = cut.where(_is_first(F.col("at")) & (F.col("slice") == 0)).select(
        "b", stamp.source_seq.alias("_seq"))
    return _records(header, cut.where(F.col("at").isNotNull()).select("b", "tx"), stamp)


def cut_figures(cut: DataFrame) -> DataFrame:
    """``document_figures`` of documents that ``cut_documents`` has cut."""
    return (cut.where(F.col("figures").isNotNull())
            .select(F.col("b.hash").alias("block_hash"), "slice",
                    F.col("b.height").cast("int").alias("height"), F.explode("figures").alias("f"))
            .select("block_hash", "slice", "height", "f.*"))


def _records(header: DataFrame, per_tx: DataFrame, stamp: _Stamp) -> LedgerFrames:
    b, tx = F.col("b"), F.col("tx")
    per_vin = per_tx.select("b", F.struct("tx.txid").alias("tx"), F.explode("tx.vin").alias("vin"))
    per_vout = per_tx.select(
        "b", F.struct("tx.txid").alias("tx"), F.explode("tx.vout").alias("vout"))
    block_stamp = _Stamp(stamp.observed_at, F.col("_seq"))
    return LedgerFrames(
        blocks=header.select(*block_record(b, block_stamp)),
        transactions=per_tx.where(_is_first(tx["piece"])).select(*transaction_record(b, tx, stamp)),
        tx_in=per_vin.select(*input_record(b, tx, F.col("vin"), stamp)),
        tx_out=per_vout.select(*output_record(b, tx, F.col("vout"), stamp)),
    )


def _message(topic: str, key: Column, fields: list[Column]) -> Column:
    return F.struct(F.lit(topic).alias("topic"), key.alias("key"),
                    F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("value"))


def to_messages(frames: LedgerFrames) -> DataFrame:
    """Record frames to keyed messages (topic, key, value): one union, no shuffle."""
    parts = []
    for name, frame in frames.items():
        kind = KINDS[name]
        parts.append(frame.select(_message(
            kind.topic, L.composite_key(*kind.key), [F.col(c) for c in frame.columns]
        ).alias("m")).select("m.*"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def document_figures(documents: DataFrame) -> DataFrame:
    """(block_hash, slice, height, table_name, rows, digest): what each document holds."""
    documents = _numbered(documents)
    return (documents.select(F.col("hash").alias("block_hash"), F.coalesce("slice", F.lit(0)).cast(
                "int").alias("slice"), F.col("height").cast("int").alias("height"),
            F.explode(_figures()).alias("f"))
            .select("block_hash", "slice", "height", "f.*"))


def _figures() -> Column:
    return completeness.document_figures(F.col("hash"), F.col("tx"), _is_first(F.col("slice")),
                                         lambda t: _is_first(t["piece"]))


def _figures_message() -> Column:
    fields = [F.col("hash").alias("block_hash"), F.coalesce("slice", F.lit(0)).alias("slice"),
              F.col("height").alias("height"), _figures().alias("figures")]
    return _message(TOPIC_FIGURES, F.col("hash"), fields)


def document_messages(documents: DataFrame, observed_at: str | None = None,
                      source_seq: Column | int | None = None, figures: bool = False) -> DataFrame:
    """All four topics of a frame of documents in one pass over the documents.

    The records of a block are built in place and exploded once, so the
    documents are read and parsed a single time instead of once per topic. With
    ``figures`` each document is followed by a message of its own topic that says how
    many records it holds.
    """
    documents, stamp = _numbered(documents), _stamp(observed_at, source_seq)
    told = [_figures_message().alias("told")] if figures else []
    row = documents.select(_header(documents.columns), "slice", "tx",
                           stamp.source_seq.alias("_seq"), *told)
    b = F.col("b")
    block_stamp = _Stamp(stamp.observed_at, F.col("_seq"))

    def key(kind: str, fields: list[Column], values: dict[str, Column]) -> Column:
        spec = KINDS[kind]
        return _message(spec.topic, L.composite_key(*[values[k] for k in spec.key]), fields)

    def tx_message(tx: Column) -> Column:
        return key("transactions", transaction_record(b, tx, stamp), {"txid": tx["txid"]})

    def vin_messages(tx: Column) -> Column:
        def one(vin: Column) -> Column:
            fields = input_record(b, tx, vin, stamp)
            minted = vin["coinbase"].isNotNull()
            return key("tx_in", fields, {
                "txid": tx["txid"],
                "hashPrevOut": F.when(minted, F.lit(ZERO_HASH)).otherwise(vin["txid"]),
                "indexPrevOut": F.when(minted, F.lit(COINBASE_INDEX)).otherwise(vin["vout"]),
            })
        return F.transform(tx["vin"], one)

    def vout_messages(tx: Column) -> Column:
        def one(vout: Column) -> Column:
            fields = output_record(b, tx, vout, stamp)
            return key("tx_out", fields, {"txid": tx["txid"], "indexOut": vout["n"]})
        return F.transform(tx["vout"], one)

    block_message = key("blocks", block_record(b, block_stamp), {"block_hash": b["hash"]})
    messages = F.concat(
        F.filter(F.array(block_message), lambda _: _is_first(F.col("slice"))),
        F.transform(F.filter("tx", lambda t: _is_first(t["piece"])), tx_message),
        F.flatten(F.transform("tx", vin_messages)),
        F.flatten(F.transform("tx", vout_messages)),
        *([F.array("told")] if figures else []),
    )
    return row.select(F.explode(messages).alias("m")).select("m.*")
