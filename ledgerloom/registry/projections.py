"""Normalisation, scalar functions and filters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom import functions as L
from ledgerloom.operators import counts
from ledgerloom.operators.dedupe import dedupe_identity
from ledgerloom.operators.normalize import normalize
from ledgerloom.plans import finality, flat
from ledgerloom.registry.sql import ledger, print_of
from ledgerloom.registry.workspace import Workspace, fingerprint
from ledgerloom.schemas import KINDS, ZERO_HASH
from ledgerloom.sources import topics
from ledgerloom.sources.views import SEEN_AT

_STAMPS = ("observed_at", "ingested_at")


def _wide(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f.name).cast("bigint").alias(f.name)
                       if f.dataType.simpleString() == "int" else F.col(f.name)
                       for f in df.schema])


def _normalized(spark: SparkSession, sf: str):
    return normalize(Workspace(spark, sf).documents(), SEEN_AT)


def norm_blocks(spark: SparkSession, sf: str) -> DataFrame:
    return _normalized(spark, sf).blocks.drop(*_STAMPS, "source_seq")


def norm_transactions(spark: SparkSession, sf: str) -> DataFrame:
    return _normalized(spark, sf).transactions.drop(*_STAMPS)


def norm_tx_in(spark: SparkSession, sf: str) -> DataFrame:
    return _normalized(spark, sf).tx_in.drop(*_STAMPS)


def norm_tx_out(spark: SparkSession, sf: str) -> DataFrame:
    return _normalized(spark, sf).tx_out.drop(*_STAMPS)


def satoshi_exact(spark: SparkSession, sf: str) -> DataFrame:
    """Coin amounts as text with ten decimals; the last two are cut off, never rounded."""
    orders = Workspace(spark, sf).views.table("orders")
    whole = F.col("o_orderkey") % 21000000
    parts = F.col("o_orderkey") % 1000003 * 9876 % 10000000000
    coins = F.concat(whole.cast("string"), F.lit("."), F.lpad(parts.cast("string"), 10, "0"))
    return orders.select("o_orderkey", coins.alias("coins")).withColumn(
        "satoshis", L.text_to_satoshis("coins"))


def hex_to_int(spark: SparkSession, sf: str) -> DataFrame:
    orders = Workspace(spark, sf).views.table("orders")
    bits = orders.select("o_orderkey", F.lower(F.hex("o_orderkey")).alias("bits"))
    return bits.withColumn("target", L.compact_target("bits"))


def epoch_to_ts(spark: SparkSession, sf: str) -> DataFrame:
    blocks = Workspace(spark, sf).views.blocks
    return blocks.select(F.col("nTime").cast("bigint").alias("epoch"),
                         L.wire_timestamp(L.utc_wall_clock("nTime")).alias("block_time"))


def default_missing(spark: SparkSession, sf: str) -> DataFrame:
    """How often a default stood in for an absent field."""
    frames = _normalized(spark, sf)
    blocks = dedupe_identity(frames.blocks, "blocks")
    parts = [(blocks, "hashPrev", ZERO_HASH), (frames.tx_out, "address", ""),
             (frames.tx_out, "scriptPubKey", "")]
    out = None
    for df, field, default in parts:
        part = df.agg(F.count("*").alias("records"),
                      F.count_if(F.col(field) == default).alias("defaulted")).select(
            F.lit(field).alias("field"), "records", "defaulted")
        out = part if out is None else out.unionByName(part)
    return out


def ingest_stamp(spark: SparkSession, sf: str) -> DataFrame:
    """Records of one run, its distinct stamps, and those of the ISO form."""
    frames = normalize(Workspace(spark, sf).documents())
    iso = r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{6}\+00:00$"
    return frames.tx_in.agg(
        F.count("*").alias("records"), F.count_distinct("observed_at").alias("stamps"),
        F.count_if(F.col("observed_at").rlike(iso)).alias("well_formed"),
        F.count_if(F.col("observed_at") == F.col("ingested_at")).alias("same"))


def route_topics(spark: SparkSession, sf: str) -> DataFrame:
    """Messages of all topics, control events included, routed to their tables."""
    ws = Workspace(spark, sf)
    records = topics.read_topics(spark, ws.topics_dir()).select("topic", "value")
    control = ws.views.control.select(F.lit("control").alias("topic"),
                                      F.to_json(F.struct("*")).alias("value"))
    routed = topics.with_table(records.unionByName(control))
    return routed.groupBy("table_name").agg(F.count("*").alias("messages"))


def parse_iso_ts(spark: SparkSession, sf: str) -> DataFrame:
    """Event times written in five ways, one of them unreadable."""
    events = Workspace(spark, sf).views.table("events")
    form, base = F.col("event_id") % 5, F.replace(
        L.wire_timestamp("ts"), F.lit(" "), F.lit("T"))
    text = (F.when(form == 0, F.concat(base, F.lit("Z")))
            .when(form == 1, F.concat(base, F.lit("+00:00")))
            .when(form == 2, base)
            .when(form == 3, F.concat(base, F.lit("+02:00")))
            .otherwise(F.concat(F.lit("at "), base)))
    parsed = L.wire_timestamp(L.parse_iso_timestamp("text"))
    return events.select("event_id", text.alias("text")).select(
        "event_id", "text", F.coalesce(parsed, F.lit("none")).alias("parsed"))


def uint32_wrap(spark: SparkSession, sf: str) -> DataFrame:
    blocks = Workspace(spark, sf).views.blocks
    return blocks.select(F.col("height").cast("bigint").alias("height"), "nNonce",
                         L.wrap_uint32("nNonce").cast("bigint").alias("wrapped"))


def json_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    outs = Workspace(spark, sf).views.tx_out.select(
        "txid", "indexOut", "value", "scriptPubKey", "address")
    back = outs.select(F.struct("*").alias("before"), F.from_json(
        F.to_json(F.struct("*")), outs.schema).alias("after"))
    columns = [F.col(f"after.{c}").alias(c) for c in outs.columns]
    return back.select((F.col("before") == F.col("after")).alias("same"), *columns).agg(
        F.count("*").alias("records"), F.count_if("same").alias("same"),
        fingerprint(outs.columns).alias("fingerprint"))


def short_hash(spark: SparkSession, sf: str) -> DataFrame:
    return Workspace(spark, sf).views.blocks.select(
        "block_hash", L.short_hash("block_hash").alias("short"))


def decode_notify(spark: SparkSession, sf: str) -> DataFrame:
    """Binary notifications: hash bytes and a little-endian counter."""
    sent = Workspace(spark, sf).views.notifications.select(
        F.unhex("block_hash").alias("body"),
        F.unhex(L.little_endian(F.lpad(F.hex(F.col("seq") % F.lit(4294967296)), 8, "0")))
        .alias("counter"))
    block_hash, seq = L.decode_notify("body", "counter")
    return sent.select(block_hash.alias("block_hash"), seq.alias("seq"))


def not_reorged(spark: SparkSession, sf: str) -> DataFrame:
    """Living blocks; a block without a status counts as neither."""
    blocks = Workspace(spark, sf).views.blocks.withColumn(
        "finality_status", F.when(F.col("height") % 89 != 0, F.col("finality_status")))
    return flat.not_reorged(blocks).select(
        F.col("height").cast("bigint").alias("height"), "block_hash", "finality_status")


def count_by_heights(spark: SparkSession, sf: str) -> DataFrame:
    """Rows per table at the five newest heights; buckets are pruned by the reader."""
    lake = Workspace(spark, sf).lake()
    newest = [r[0] for r in lake.read("blocks").select("height").orderBy(F.desc("height"))
              .limit(5).collect()]
    return lake.counts_at_heights(newest)


def height_between(spark: SparkSession, sf: str) -> DataFrame:
    """Transactions from the first height to the last one six deep."""
    lake = Workspace(spark, sf).lake()
    rows = lake.read("transactions", between=(0, lake.high_water() - 6))
    return rows.groupBy(F.col("block_height").cast("bigint").alias("block_height")).agg(
        F.count("*").alias("txs"), F.max("lockTime").alias("last_lock"))


def coinbase_split(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.when(F.col("hashPrevOut") == ZERO_HASH, "coinbase").otherwise("regular")
    return Workspace(spark, sf).views.tx_in.groupBy(kind.alias("kind")).agg(
        F.count("*").alias("inputs"), F.max("indexPrevOut").alias("max_index"))


def addressed_outputs(spark: SparkSession, sf: str) -> DataFrame:
    outs = Workspace(spark, sf).views.tx_out.where(F.col("address") != "")
    return outs.groupBy("address").agg(F.count("*").alias("outputs"),
                                       F.sum("value").alias("satoshis"))


def control_validate(spark: SparkSession, sf: str) -> DataFrame:
    return finality.validate_events(Workspace(spark, sf).views.control).select(
        "offset", "type", "finality_status", "reason")


_TX_IN = """CAST(1 AS BIGINT) AS schema_version, txid, hashPrevOut, indexPrevOut, scriptSig,
    sequence, block_hash, CAST(block_height AS BIGINT) AS block_height"""
QUERIES = {
    f.__name__: f for f in (
        norm_blocks, norm_transactions, norm_tx_in, norm_tx_out, satoshi_exact, hex_to_int,
        epoch_to_ts, default_missing, ingest_stamp, route_topics, parse_iso_ts, uint32_wrap,
        json_roundtrip, short_hash, decode_notify, not_reorged, count_by_heights, height_between,
        coinbase_split, addressed_outputs, control_validate)
}
ORACLES = {
    "norm_blocks": ledger("""SELECT CAST(1 AS BIGINT) AS schema_version, block_hash,
        CAST(height AS BIGINT) AS height, CAST(version AS BIGINT) AS version,
        CAST(blocksize AS BIGINT) AS blocksize, hashPrev, hashMerkleRoot, nTime,
        CAST(nBits AS BIGINT) AS nBits, nNonce, block_timestamp, 'OBSERVED' AS finality_status
        FROM blocks""", "blocks"),
    "norm_transactions": ledger("""SELECT CAST(1 AS BIGINT) AS schema_version, txid, hashBlock,
        version, lockTime, CAST(block_height AS BIGINT) AS block_height, block_timestamp
        FROM transactions""", "transactions"),
    "norm_tx_in": ledger(f"SELECT {_TX_IN} FROM tx_in", "tx_in"),
    "norm_tx_out": ledger("""SELECT CAST(1 AS BIGINT) AS schema_version, txid,
        CAST(indexOut AS BIGINT) AS indexOut, CAST(height AS BIGINT) AS height, value,
        scriptPubKey, address, block_hash, block_timestamp FROM tx_out""", "tx_out"),
    "satoshi_exact": """SELECT o_orderkey,
        (o_orderkey % 21000000) || '.' || p AS coins,
        CAST((o_orderkey % 21000000) * 100000000 + CAST(substr(p, 1, 8) AS BIGINT) AS BIGINT)
            AS satoshis
        FROM (SELECT o_orderkey, lpad(CAST(o_orderkey % 1000003 * 9876 % 10000000000 AS VARCHAR),
                                      10, '0') AS p FROM orders) x""",
    "hex_to_int": "SELECT o_orderkey, lower(to_hex(o_orderkey)) AS bits, o_orderkey AS target "
                  "FROM orders",
    "epoch_to_ts": ledger("SELECT nTime AS epoch, block_timestamp AS block_time FROM blocks",
                          "blocks"),
    "default_missing": ledger("""
        SELECT 'hashPrev' AS field, count(*) AS records,
            count(*) FILTER (WHERE height = 0) AS defaulted FROM blocks
        UNION ALL SELECT 'address', count(*), count(*) FILTER (WHERE address = '') FROM tx_out
        UNION ALL SELECT 'scriptPubKey', count(*), 0 FROM tx_out""", "blocks", "tx_out"),
    "ingest_stamp": """SELECT count(*) AS records, CAST(1 AS BIGINT) AS stamps,
        count(*) AS well_formed, count(*) AS same FROM orders""",
    "route_topics": ledger(" UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS messages FROM {t}" for t in KINDS), *KINDS),
    "parse_iso_ts": """SELECT event_id,
        CASE event_id % 5 WHEN 0 THEN base || 'Z' WHEN 1 THEN base || '+00:00' WHEN 2 THEN base
            WHEN 3 THEN base || '+02:00' ELSE 'at ' || base END AS text,
        CASE event_id % 5 WHEN 4 THEN 'none'
            WHEN 3 THEN strftime(ts - INTERVAL 2 HOUR, '%Y-%m-%d %H:%M:%S')
            ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS parsed
        FROM (SELECT event_id, ts, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS base FROM events) e""",
    "uint32_wrap": ledger("""SELECT CAST(height AS BIGINT) AS height, nNonce,
        CASE WHEN nNonce > 2147483647 THEN nNonce - 4294967296 ELSE nNonce END AS wrapped
        FROM blocks""", "blocks"),
    "json_roundtrip": ledger(f"""SELECT count(*) AS records, count(*) AS same,
        {print_of('txid, indexOut, value, scriptPubKey, address')} AS fingerprint
        FROM tx_out""", "tx_out"),
    "short_hash": ledger("SELECT block_hash, substr(block_hash, 1, 16) || '...' AS short "
                         "FROM blocks", "blocks"),
    "decode_notify": ledger("SELECT block_hash, seq % 4294967296 AS seq FROM notify", "notify"),
    "not_reorged": ledger("""SELECT CAST(height AS BIGINT) AS height, block_hash, finality_status
        FROM alive WHERE height % 89 <> 0""", "alive"),
    "count_by_heights": ledger(" UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t} "
        f"WHERE {k.height_col} IN (SELECT height FROM newest)" for t, k in KINDS.items()), *KINDS,
        newest="SELECT height FROM blocks ORDER BY height DESC LIMIT 5"),
    "height_between": ledger("""SELECT CAST(block_height AS BIGINT) AS block_height,
        count(*) AS txs, max(lockTime) AS last_lock FROM transactions, tip
        WHERE block_height BETWEEN 0 AND tip - 6 GROUP BY block_height""", "transactions", "tip"),
    "coinbase_split": ledger("""SELECT CASE WHEN hashPrevOut = repeat('0', 64) THEN 'coinbase'
        ELSE 'regular' END AS kind, count(*) AS inputs, CAST(max(indexPrevOut) AS BIGINT)
        AS max_index FROM tx_in GROUP BY 1""", "tx_in"),
    "addressed_outputs": ledger("""SELECT address, count(*) AS outputs,
        CAST(sum(value) AS BIGINT) AS satoshis FROM tx_out WHERE address <> ''
        GROUP BY address""", "tx_out"),
    "control_validate": ledger("""SELECT "offset", type, finality_status,
        CASE WHEN type NOT IN ('finality', 'reorg') THEN 'unknown type'
             WHEN finality_status NOT IN ('CONFIRMED', 'REORGED') THEN 'invalid status'
             ELSE '' END AS reason FROM control""", "control"),
}
