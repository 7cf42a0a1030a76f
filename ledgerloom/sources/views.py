"""Ledger views over the order, line-item and event tables.

The ledger here is derived, row by row, from ordinary business tables: a block
per order day, a transaction per order, an output per line item. All frames are
lazy plans over the whole Parquet tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom import functions as L
from ledgerloom.operators.broadcasting import broadcast_if_small
from ledgerloom.operators.normalize import LedgerFrames
from ledgerloom.operators.sequences import lag_in_key
from ledgerloom.operators.skew import HOT_ROWS, hot_keys, join_many_to_one
from ledgerloom.schemas import (
    COINBASE_INDEX,
    CONFIRMATIONS,
    CONFIRMED,
    OBSERVED,
    REORGED,
    ZERO_HASH,
)

# Fixed values of the derived ledger.
FIRST_DAY = "1995-01-01"
FIRST_EPOCH = 788918400
SEEN_AT = "2001-09-01T00:00:00+00:00"
NBITS = 486604799
NBITS_HEX = "1d00ffff"
NONCE_STEP = 2654435761
CONTROL_HEIGHTS = 2405
TXS_PER_DOCUMENT = 4096


class LedgerViews:
    """Derived ``blocks``, ``transactions``, ``tx_in``, ``tx_out`` and event streams."""

    def __init__(self, spark: SparkSession, sf_dir: str, hot_rows: int | None = None,
                 spread: Callable[[Column], Column] | None = None, ordered: bool = False):
        """``spread`` of a height: the records come rebalanced by it, before they are made.

        ``ordered``: those of a block, and of a transaction in it, lie together in each
        partition, so that files take up less.
        """
        self.spark, self.dir, self.hot_rows, self._by = spark, sf_dir, hot_rows, spread
        self._ordered = ordered

    def _placed(self, df: DataFrame, key: str) -> DataFrame:
        if self._by is not None:
            df = df.withColumn("_by", self._by(F.col("h"))).hint("rebalance", F.col("_by"))
        return df.sortWithinPartitions("h", key) if self._ordered else df

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    # -- building blocks ---------------------------------------------------
    @staticmethod
    def _height() -> Column:
        return F.datediff(F.col("o_orderdate"), F.lit(FIRST_DAY).cast("date"))

    @staticmethod
    def block_hash(height: Column) -> Column:
        return F.md5(F.concat(F.lit("block:"), height.cast("string")).cast("binary"))

    @staticmethod
    def txid(orderkey: Column) -> Column:
        return F.md5(F.concat(F.lit("tx:"), orderkey.cast("string")).cast("binary"))

    @staticmethod
    def _time(height: Column) -> Column:
        return height.cast("bigint") * 86400 + FIRST_EPOCH

    def heights(self) -> DataFrame:
        return self.table("orders").select(self._height().alias("height"))

    def tip(self) -> Column:
        """Highest height as a scalar subquery."""
        return self.heights().agg(F.max("height")).scalar()

    # -- raw tables --------------------------------------------------------
    @property
    def blocks(self) -> DataFrame:
        h = F.col("height")
        status = (F.when(h % 97 == 0, REORGED)
                  .when(h <= self.tip() - CONFIRMATIONS, CONFIRMED).otherwise(OBSERVED))
        prev = F.when(h == 0, F.lit(ZERO_HASH)).otherwise(self.block_hash(h - 1))
        return self.heights().distinct().select(
            self.block_hash(h).alias("block_hash"),
            h,
            F.lit(1).alias("version"),
            (h % 1000 + 285).alias("blocksize"),
            prev.alias("hashPrev"),
            F.md5(F.concat(F.lit("merkle:"), h.cast("string")).cast("binary"))
            .alias("hashMerkleRoot"),
            self._time(h).cast("int").alias("nTime"),
            F.lit(NBITS).cast("bigint").alias("nBits"),
            (h.cast("bigint") * F.lit(NONCE_STEP) % F.lit(4294967296)).alias("nNonce"),
            L.utc_wall_clock(self._time(h)).alias("block_timestamp"),
            F.lit(SEEN_AT).alias("observed_at"),
            F.lit(SEEN_AT).alias("ingested_at"),
            status.alias("finality_status"),
            F.lit(None).cast("int").alias("source_seq"),
        )

    def _orders(self) -> DataFrame:
        return self.table("orders").select(
            "o_orderkey", "o_custkey", self._height().alias("h"))

    @property
    def transactions(self) -> DataFrame:
        h = F.col("h")
        return self._placed(self._orders().drop("o_custkey"), "o_orderkey").select(
            self.txid(F.col("o_orderkey")).alias("txid"),
            self.block_hash(h).alias("hashBlock"),
            (F.col("o_orderkey") % 2 + 1).cast("int").alias("version"),
            F.col("o_orderkey").alias("lockTime"),
            h.alias("block_height"),
            L.utc_wall_clock(self._time(h)).alias("block_timestamp"),
            F.lit(SEEN_AT).alias("observed_at"),
            F.lit(SEEN_AT).alias("ingested_at"),
        )

    def _linked(self) -> DataFrame:
        return lag_in_key(self._orders(), "o_custkey", ["h", "o_orderkey"], "o_orderkey",
                          "prev_key", self.hot_rows)

    @staticmethod
    def _script(orderkey: Column) -> Column:
        return F.md5(F.concat(F.lit("sig:"), orderkey.cast("string")).cast("binary"))

    @property
    def tx_in(self) -> DataFrame:
        """An order spends output 0 of the same customer's previous order."""
        first, h = F.col("prev_key").isNull(), F.col("h")
        return self._placed(self._linked().drop("o_custkey"), "o_orderkey").select(
            self.txid(F.col("o_orderkey")).alias("txid"),
            F.when(first, F.lit(ZERO_HASH)).otherwise(self.txid(F.col("prev_key")))
            .alias("hashPrevOut"),
            F.when(first, F.lit(COINBASE_INDEX)).otherwise(F.lit(0).cast("bigint"))
            .alias("indexPrevOut"),
            self._script(F.col("o_orderkey")).alias("scriptSig"),
            F.lit(4294967295).alias("sequence"),
            self.block_hash(h).alias("block_hash"),
            h.alias("block_height"),
            F.lit(SEEN_AT).alias("observed_at"),
            F.lit(SEEN_AT).alias("ingested_at"),
        )

    def _lines(self) -> DataFrame:
        return self.table("lineitem").select(
            "l_orderkey", "l_linenumber", "l_extendedprice", "l_partkey", "l_suppkey")

    def _output(self, line: Callable[[str], Column]) -> dict[str, Column]:
        """The columns of an output from the line item that it is."""
        supp = line("l_suppkey")
        return {
            "indexOut": line("l_linenumber") - 1,
            "value": F.round(line("l_extendedprice") * 100).cast("bigint"),
            "scriptPubKey": F.md5(F.concat(F.lit("pk:"), line("l_partkey").cast("string"))
                                  .cast("binary")),
            "address": F.when(supp % 13 == 0, F.lit("")).otherwise(
                F.concat(F.lit("s"), supp.cast("string"))),
        }

    @property
    def tx_out(self) -> DataFrame:
        """Joined on the order's number: hashes are made behind the shuffle, not sent through it."""
        h = F.col("h")
        owner = self._orders().select(F.col("o_orderkey").alias("l_orderkey"), "h")
        placed = join_many_to_one(self._lines(), owner, "l_orderkey", hot_rows=self.hot_rows)
        out = self._output(F.col)
        return self._placed(placed, "l_orderkey").select(
            self.txid(F.col("l_orderkey")).alias("txid"),
            out["indexOut"].alias("indexOut"), h.alias("height"),
            *[out[c].alias(c) for c in ("value", "scriptPubKey", "address")],
            self.block_hash(h).alias("block_hash"),
            L.utc_wall_clock(self._time(h)).alias("block_timestamp"),
            F.lit(SEEN_AT).alias("observed_at"),
            F.lit(SEEN_AT).alias("ingested_at"),
        )

    def frames(self) -> LedgerFrames:
        return LedgerFrames(self.blocks, self.transactions, self.tx_in, self.tx_out)

    # -- nested documents --------------------------------------------------
    def documents(self) -> DataFrame:
        """Block documents as typed rows, a block's transactions nested below its header.

        A day's slice 0 stands for its header and holds no transactions; slices 1,
        2, ... hold a bounded share of them each. Piece 0 of an order stands for
        the transaction and has its inputs; an order with very many lines has them
        in pieces 1, 2, ..., any other in piece 0, too.
        """
        day_sizes = (self._orders().groupBy("h").agg(F.count("*").alias("n"))
                     .select("h", F.ceil(F.col("n") / TXS_PER_DOCUMENT).alias("parts")))
        part = F.pmod(F.xxhash64(self.txid(F.col("tx.key")), F.size("tx.lines"),
                                 F.size("tx.spent")), F.col("parts"))
        # Orders travel with the numbers of their lines; what is made of them is made at the end.
        nested = (self._nested_orders().join(broadcast_if_small(day_sizes), "h")
                  .withColumn("part", part)
                  .groupBy("h", "part").agg(F.collect_list("tx").alias("tx"))
                  .select("h", (F.col("part") + 1).cast("int").alias("slice"),
                          F.transform("tx", self._transaction).alias("tx")))
        heads = day_sizes.select("h", F.lit(0).alias("slice"),
                                 F.array().cast(nested.schema["tx"].dataType).alias("tx"))
        nested, h = nested.unionByName(heads), F.col("h")
        return nested.select(
            self.block_hash(h).alias("hash"),
            h.cast("bigint").alias("height"),
            F.lit(1).cast("bigint").alias("version"),
            (h % 1000 + 285).cast("bigint").alias("size"),
            F.when(h > 0, self.block_hash(h - 1)).alias("previousblockhash"),
            F.md5(F.concat(F.lit("merkle:"), h.cast("string")).cast("binary")).alias("merkleroot"),
            self._time(h).alias("time"),
            F.lit(NBITS_HEX).alias("bits"),
            (h.cast("bigint") * F.lit(NONCE_STEP) % F.lit(4294967296)).alias("nonce"),
            "slice",
            "tx",
        )

    def _transaction(self, order: Column) -> Column:
        """A transaction as it stands in a document, from an order and its lines."""
        def vin(spent: Column) -> Column:
            prev, script = spent["prev_key"], self._script(order["key"])
            minted = prev.isNull()
            return F.struct(
                F.when(minted, script).alias("coinbase"),
                F.when(~minted, self.txid(prev)).alias("txid"),
                F.when(~minted, F.lit(0).cast("bigint")).alias("vout"),
                F.when(~minted, F.struct(script.alias("hex"))).alias("scriptSig"),
                F.lit(4294967295).alias("sequence"))

        def vout(line: Column) -> Column:
            out = self._output(lambda name: line[name])
            coins = out["value"].cast("decimal(20,0)") / F.lit(100000000).cast("decimal(9,0)")
            return F.struct(
                coins.cast("decimal(28,18)").alias("value"),
                out["indexOut"].cast("bigint").alias("n"),
                F.struct(out["scriptPubKey"].alias("hex"),
                         F.when(out["address"] != "", out["address"]).alias("address"))
                .alias("scriptPubKey"))

        return F.struct(
            self.txid(order["key"]).alias("txid"),
            (order["key"] % 2 + 1).cast("int").cast("bigint").alias("version"),
            order["key"].alias("locktime"), order["piece"].alias("piece"),
            F.transform(order["spent"], vin).alias("vin"),
            F.transform(order["lines"], vout).alias("vout"))

    def _nested_orders(self) -> DataFrame:
        """(h, tx): an order's key, piece, the orders its inputs spend, and its line items."""
        outputs = self._in_pieces(self._lines())
        inputs = self._linked().groupBy("o_orderkey").agg(
            F.collect_list(F.struct("prev_key")).alias("spent"))
        heads = self._orders().select("o_orderkey", "h")
        joined = heads.join(inputs, "o_orderkey", "left").join(
            outputs.withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey", "left")
        piece = F.coalesce("piece", F.lit(0))
        lines = F.coalesce(F.col("lines"), F.array().cast(outputs.schema["lines"].dataType))
        spent = F.when(piece == 0, F.col("spent")).otherwise(
            F.array().cast(inputs.schema["spent"].dataType))
        return joined.select("h", F.struct(
            F.col("o_orderkey").alias("key"), piece.alias("piece"), spent.alias("spent"),
            lines.alias("lines")).alias("tx"))

    def _in_pieces(self, lines: DataFrame) -> DataFrame:
        """(l_orderkey, piece, lines): one piece 0 per ordinary order.

        The lines of a hot order are dealt out evenly over pieces 1, 2, ...; its
        piece 0 stays empty and is the one the inputs go with.
        """
        hot, limit = hot_keys(lines, "l_orderkey", self.hot_rows), self.hot_rows or HOT_ROWS
        line = F.struct("l_linenumber", "l_extendedprice", "l_partkey", "l_suppkey")
        if not hot:
            return lines.groupBy("l_orderkey").agg(F.collect_list(line).alias("lines")).select(
                "l_orderkey", F.lit(0).alias("piece"), "lines")
        key = lines.schema["l_orderkey"].dataType
        pieces = F.create_map(*[x for order, rows in hot.items() for x in (
            F.lit(order).cast(key), F.lit(max(2, 8 * rows // limit)))])
        mine = F.try_element_at(pieces, F.col("l_orderkey"))
        dealt_to = F.pmod(F.xxhash64(self.txid(F.col("l_orderkey")), *self._output(F.col).values()),
                          mine).cast("int") + 1
        piece = F.coalesce(dealt_to, F.lit(0))
        dealt = lines.withColumn("piece", piece).groupBy("l_orderkey", "piece").agg(
            F.collect_list(line).alias("lines"))
        heads = self.spark.createDataFrame([(order, 0) for order in hot],
                                           f"l_orderkey {key.simpleString()}, piece int")
        return dealt.unionByName(heads.withColumn(
            "lines", F.array().cast(dealt.schema["lines"].dataType)))

    # -- event streams -----------------------------------------------------
    @property
    def control(self) -> DataFrame:
        """Finality and reorganisation events, ordered by ``offset``."""
        kind, height = F.col("event_type"), F.col("user_id") * 10 % CONTROL_HEIGHTS
        missing = F.md5(F.concat(F.lit("missing:"), F.col("event_id").cast("string")).cast("binary"))
        return self.table("events").select(
            F.col("event_id").alias("offset"),
            F.when(kind == "error", "reorg").when(kind == "click", "unknown")
            .otherwise("finality").alias("type"),
            F.when(kind == "purchase", missing).otherwise(self.block_hash(height))
            .alias("block_hash"),
            height.alias("height"),
            F.when(kind == "error", REORGED).when(kind == "view", "INVALID")
            .otherwise(CONFIRMED).alias("finality_status"),
            F.concat(F.replace(L.wire_timestamp("ts"), F.lit(" "), F.lit("T")), F.lit("Z"))
            .alias("timestamp"),
        )

    @property
    def notifications(self) -> DataFrame:
        """Numbered block notifications with holes in the numbering."""
        seen = self.table("events").where(F.col("event_type") == "view")
        height = F.col("user_id") * 10 % CONTROL_HEIGHTS
        return seen.select(F.col("event_id").alias("seq"),
                           self.block_hash(height).alias("block_hash"))

    @property
    def health(self) -> DataFrame:
        """Service checks: (service, status, ts)."""
        return self.table("events").select(
            (F.col("user_id") % 11).cast("int").alias("service"),
            F.when(F.col("event_type") == "error", "FAIL").otherwise("ok").alias("status"),
            F.col("ts"))

    def topic_offsets(self) -> DataFrame:
        """(topic_name, offset, height) of the four streams; an offset names one record."""
        tx = self._orders().select(F.col("o_orderkey").alias("offset"), F.col("h").alias("height"))
        lines = (self.table("lineitem")
                 .select("l_orderkey", (F.col("l_orderkey") * 8 + F.col("l_linenumber"))
                         .alias("offset")).distinct()
                 .join(self._orders().select(F.col("o_orderkey").alias("l_orderkey"),
                                             F.col("h").alias("height")), "l_orderkey"))
        blocks = self.heights().distinct().select(
            F.col("height").cast("bigint").alias("offset"), "height")
        out = None
        for name, frame in (("blocks", blocks), ("transactions", tx), ("tx_in", tx),
                            ("tx_out", lines.select("offset", "height"))):
            part = frame.select(F.lit(name).alias("topic_name"), "offset", "height")
            out = part if out is None else out.unionByName(part)
        return out
