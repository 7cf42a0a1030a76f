"""Joins, aggregates, sequences, ordering and set operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom import functions as L
from ledgerloom.operators import counts, health, validate
from ledgerloom.operators.dedupe import dedupe_identity, keep_latest, latest_per_key
from ledgerloom.operators.normalize import LedgerFrames
from ledgerloom.plans import finality, flat
from ledgerloom.registry.scans import FLAT_LIGHT
from ledgerloom.registry.sql import ledger
from ledgerloom.registry.workspace import Workspace
from ledgerloom.schemas import KINDS
from ledgerloom.sources import history
from ledgerloom.sources.views import SEEN_AT, LedgerViews
from ledgerloom.streaming.gaps import sequence_gaps

LATER = "2001-10-01T00:00:00+00:00"


def _views(spark: SparkSession, sf: str) -> LedgerViews:
    return Workspace(spark, sf).views


def _wide(name: str) -> Column:
    return F.col(name).cast("bigint").alias(name)


def _joined(items: str, fields: tuple[str, ...]) -> Column:
    text = F.transform(items, lambda s: F.concat_ws(":", *[s[f].cast("string") for f in fields]))
    return F.coalesce(F.array_join(text, ","), F.lit("")).alias(items)


_IN = ("hashPrevOut", "indexPrevOut", "scriptSig", "sequence")
_OUT = ("indexOut", "value", "scriptPubKey", "address")


def flat_text(df: DataFrame) -> DataFrame:
    """Flat rows with arrays and times as text."""
    return df.select(
        "txid", _wide("block_height"), "block_hash",
        L.wire_timestamp("block_timestamp").alias("block_timestamp"),
        _wide("nTime"), _wide("tx_version"), "lockTime", _wide("input_count"),
        _joined("inputs", _IN), _wide("output_count"), "total_output_value",
        _joined("outputs", _OUT), "finality_status")


def block_tx_join(spark: SparkSession, sf: str) -> DataFrame:
    v = _views(spark, sf)
    b = v.blocks.select("block_hash", "height", "nTime", "finality_status")
    return v.transactions.join(b, F.col("hashBlock") == F.col("block_hash")).select(
        "txid", "block_hash", _wide("height"), _wide("nTime"), "lockTime", "finality_status")


def flat_block(spark: SparkSession, sf: str) -> DataFrame:
    """The flat rows of the newest living block, read through pruned buckets."""
    ws = Workspace(spark, sf)
    lake = ws.lake()
    newest = flat.not_reorged(lake.read("blocks")).agg(F.max("height")).first()[0]
    frames = LedgerFrames(**{t: lake.read(t, heights=[newest]) for t in KINDS})
    return flat_text(flat.build_flat(frames, newest, newest))


def flat_range(spark: SparkSession, sf: str) -> DataFrame:
    """Flat rows of the whole chain."""
    return flat_text(flat.build_flat(_views(spark, sf).frames()))


def flat_fanout_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Inputs replayed once: distinct counts stay right, sums double."""
    v = _views(spark, sf)
    frames = LedgerFrames(v.blocks, v.transactions, v.tx_in.unionByName(v.tx_in), v.tx_out)
    return flat.fanout_counts(frames).select(
        "txid", _wide("height"), "joined_rows", "input_count", "output_count", "inflated_value")


def control_unmatched(spark: SparkSession, sf: str) -> DataFrame:
    v = _views(spark, sf)
    return finality.unmatched_events(v.control, v.blocks).select(
        "offset", "block_hash", "finality_status")


def prevout_join(spark: SparkSession, sf: str) -> DataFrame:
    v = _views(spark, sf)
    once = keep_latest(v.tx_out, KINDS["tx_out"].key, [])
    spent = validate.resolve_prevouts(v.tx_in, once)
    return spent.select("txid", "hashPrevOut", "indexPrevOut",
                        F.coalesce("prev_value", F.lit(-1)).alias("prev_value"),
                        F.coalesce("prev_address", F.lit("unresolved")).alias("prev_address"))


def raw_flat_parity(spark: SparkSession, sf: str) -> DataFrame:
    """A flat table built to three heights below the tip against the raw tables."""
    ws = Workspace(spark, sf)
    frames = ws.stored()
    made = flat.FlatTable(spark, ws.new_dir("flat"))
    made.append(flat.build_flat(frames, hi=ws.lake().high_water() - 3))
    out = validate.raw_flat_parity(frames.blocks, frames.transactions, made.read())
    return out.select(_wide("height"), "raw_rows", "flat_rows", "equal")


def source_parity(spark: SparkSession, sf: str) -> DataFrame:
    """The historical dump against the lake: rows and satoshis per table."""
    ws = Workspace(spark, sf)
    dump = ws.new_dir("dump")
    history.write_history(ws.views.frames(), dump)
    dumped = LedgerFrames(**{t: history.read_history(spark, dump, t) for t in KINDS})
    both = counts.compare_sources(counts.value_checksum(dumped), counts.value_checksum(ws.stored()))
    return both.select("table_name", "left_rows", "right_rows",
                       *[F.col(c).cast("string").alias(c)
                         for c in ("left_satoshis", "right_satoshis")], "equal")


def tx_child_counts(spark: SparkSession, sf: str) -> DataFrame:
    v, out = _views(spark, sf), None
    for kind, df in (("tx_in", v.tx_in.select("txid")), ("tx_out", v.tx_out.select("txid"))):
        part = df.groupBy("txid").agg(F.count("*").alias("children")).withColumn(
            "kind", F.lit(kind))
        out = part if out is None else out.unionByName(part)
    return out


def tx_output_value(spark: SparkSession, sf: str) -> DataFrame:
    return _views(spark, sf).tx_out.groupBy("txid").agg(
        F.sum("value").alias("total_output_value"))


def tx_nested(spark: SparkSession, sf: str) -> DataFrame:
    v = _views(spark, sf)
    ins, outs = flat.nested_inputs(v.tx_in), flat.nested_outputs(v.tx_out)
    return ins.join(outs, "txid", "full").select("txid", _joined("inputs", _IN),
                                                 _joined("outputs", _OUT))


def high_water(spark: SparkSession, sf: str) -> DataFrame:
    """Highest height of all, of living, and of no blocks."""
    blocks = _views(spark, sf).blocks
    top = lambda c: F.coalesce(F.max(c), F.lit(-1)).cast("bigint")
    alive = F.when(F.col("finality_status") != "REORGED", F.col("height"))
    none = F.when(F.col("finality_status") == "", F.col("height"))
    return blocks.agg(top("height").alias("max_all"), top(alive).alias("max_living"),
                      top(none).alias("max_none"))


def distinct_children(spark: SparkSession, sf: str) -> DataFrame:
    """Children of each transaction, and how many of them differ by key, of both kinds."""
    v, out = _views(spark, sf), None
    for kind in ("tx_in", "tx_out"):
        part = getattr(v, kind).groupBy("txid").agg(
            F.count("*").alias("children"),
            F.count_distinct(F.struct(*KINDS[kind].key)).alias("distinct_children")).withColumn(
            "kind", F.lit(kind))
        out = part if out is None else out.unionByName(part)
    return out


def table_counts(spark: SparkSession, sf: str) -> DataFrame:
    return counts.table_counts(_views(spark, sf).frames())


def block_record_counts(spark: SparkSession, sf: str) -> DataFrame:
    per_block = counts.block_record_counts(_views(spark, sf).frames())
    return per_block.withColumn("height", F.col("height").cast("bigint"))


def run_averages(spark: SparkSession, sf: str) -> DataFrame:
    return counts.run_averages(counts.block_record_counts(_views(spark, sf).frames()))


def run_rates(spark: SparkSession, sf: str) -> DataFrame:
    """Records per second and headroom of every block, its size standing for milliseconds."""
    v = _views(spark, sf)
    sizes = v.blocks.select("height", "blocksize")
    rated = counts.run_rates(counts.block_record_counts(v.frames()).join(sizes, "height"),
                             "records", "blocksize")
    return rated.select(F.col("height").cast("bigint").alias("height"), "per_second", "headroom")


def value_checksum(spark: SparkSession, sf: str) -> DataFrame:
    sums = counts.value_checksum(_views(spark, sf).frames())
    return sums.withColumn("satoshis", F.col("satoshis").cast("string"))


def health_rollup(spark: SparkSession, sf: str) -> DataFrame:
    out = health.status_counts(_views(spark, sf).health)
    return out.withColumn("service", F.col("service").cast("bigint"))


def health_run_status(spark: SparkSession, sf: str) -> DataFrame:
    """Runs of one hour each, by how many services failed."""
    return health.run_status(_views(spark, sf).health, every=3600)


def alert_cooldown(spark: SparkSession, sf: str) -> DataFrame:
    sent = health.alerts(_views(spark, sf).health, every=60)
    return sent.withColumn("service", F.col("service").cast("bigint"))


def chain_breaks(spark: SparkSession, sf: str) -> DataFrame:
    out = validate.chain_breaks(_views(spark, sf).blocks)
    return out.withColumn("height", F.col("height").cast("bigint"))


def height_gaps(spark: SparkSession, sf: str) -> DataFrame:
    out = validate.height_gaps(_views(spark, sf).blocks)
    return out.select(_wide("gap_start"), _wide("gap_length"))


def build_progress(spark: SparkSession, sf: str) -> DataFrame:
    v = _views(spark, sf)
    per_block = v.transactions.groupBy(F.col("block_height").alias("height")).agg(
        F.count("*").alias("txs"))
    out = validate.build_progress(per_block, 0, v.tip())
    return out.withColumn("height", F.col("height").cast("bigint"))


def seq_gaps(spark: SparkSession, sf: str) -> DataFrame:
    return sequence_gaps(_views(spark, sf).notifications)


def compact_latest(spark: SparkSession, sf: str) -> DataFrame:
    last = latest_per_key(_views(spark, sf).control.drop("timestamp"), "block_hash", "offset")
    return last.select("block_hash", "offset", "type", "finality_status")


def latest_blocks(spark: SparkSession, sf: str) -> DataFrame:
    return _views(spark, sf).blocks.orderBy(F.desc("height")).limit(5).select(
        _wide("height"), "block_hash", "finality_status")


def order_violations(spark: SparkSession, sf: str) -> DataFrame:
    """The offsets are written once and read for every step of the check."""
    return validate.order_violations(Workspace(spark, sf).topic_offsets())


def dual_path_union(spark: SparkSession, sf: str) -> DataFrame:
    """History up to ten heights below the tip and live data from twenty below, one table."""
    v = _views(spark, sf)
    tip = Workspace(spark, sf).lake().high_water()
    old = v.transactions.where(F.col("block_height") <= tip - 10)
    live = v.transactions.where(F.col("block_height") > tip - 20).withColumn(
        "ingested_at", F.lit(LATER))
    both = dedupe_identity(old.unionByName(live), "transactions")
    return both.select("txid", _wide("block_height"), "ingested_at")


def dedup_identity(spark: SparkSession, sf: str) -> DataFrame:
    """Outputs, one row per identity key."""
    once = keep_latest(_views(spark, sf).tx_out, KINDS["tx_out"].key, [])
    return once.select("txid", _wide("indexOut"), _wide("height"), "value", "scriptPubKey",
                       "address")


def missing_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Transactions without any output."""
    v = _views(spark, sf)
    return validate.missing_ids(v.transactions, v.tx_out, "txid")


def retention(spark: SparkSession, sf: str) -> DataFrame:
    """Events of the last seven days before the newest one."""
    from ledgerloom.streaming.ingest import retained
    events = _views(spark, sf).table("events")
    kept = retained(events, "ts", events.agg(F.max("ts")).scalar())
    return kept.select("event_id", "event_type")


def tip_freshness(spark: SparkSession, sf: str) -> DataFrame:
    as_of = F.expr("TIMESTAMP_NTZ'2001-08-01 00:20:00'")
    out = validate.tip_freshness(_views(spark, sf).blocks, as_of)
    return out.withColumn("tip_height", F.col("tip_height").cast("bigint"))


def topic_lag(spark: SparkSession, sf: str) -> DataFrame:
    """Records of the last six heights are not committed yet."""
    v = _views(spark, sf)
    stream = v.topic_offsets()
    committed = stream.where(F.col("height") <= v.tip() - 6).groupBy("topic_name").agg(
        F.max("offset").alias("committed_offset"))
    return validate.topic_lag(stream, committed)


_ALL = tuple(KINDS)
_PER_BLOCK = """
    SELECT CAST(b.height AS BIGINT) AS height, coalesce(t.n, 0) AS txs, coalesce(i.n, 0) AS inputs,
           coalesce(p.n, 0) AS outputs, 1 + coalesce(t.n, 0) + coalesce(i.n, 0) + coalesce(p.n, 0)
               AS records
    FROM blocks b
    LEFT JOIN (SELECT block_height h, count(*) n FROM transactions GROUP BY 1) t ON t.h = b.height
    LEFT JOIN (SELECT block_height h, count(*) n FROM tx_in GROUP BY 1) i ON i.h = b.height
    LEFT JOIN (SELECT height h, count(*) n FROM tx_out GROUP BY 1) p ON p.h = b.height"""
_CHECKSUM = ("SELECT '{t}' AS table_name, count(*) AS row_count, "
             "CAST(coalesce(sum({v}), 0) AS VARCHAR) AS satoshis FROM {t}")
_FLAT = """txid, block_height, block_hash, block_timestamp, nTime, tx_version, lockTime,
    input_count, inputs, output_count, total_output_value, outputs, finality_status"""
_RUNS = """SELECT service, CAST(floor(epoch(ts) / 60) AS BIGINT) AS run,
    bool_or(status <> 'ok') AS failed FROM health GROUP BY 1, 2"""
_STREAKS = """SELECT service, streak, run FROM (
    SELECT *, count(*) FILTER (WHERE NOT failed) OVER (PARTITION BY service ORDER BY run
        ROWS UNBOUNDED PRECEDING) AS streak FROM runs) r WHERE failed"""

QUERIES = {
    f.__name__: f for f in (
        block_tx_join, flat_block, flat_range, flat_fanout_counts, control_unmatched, prevout_join,
        raw_flat_parity, source_parity, tx_child_counts, tx_output_value, tx_nested, high_water,
        distinct_children, table_counts, block_record_counts, run_averages, run_rates, value_checksum,
        health_rollup, health_run_status, alert_cooldown, chain_breaks, height_gaps,
        build_progress, seq_gaps, compact_latest, latest_blocks, order_violations,
        dual_path_union, dedup_identity, missing_ids, retention, tip_freshness, topic_lag)
}
SEQ_GAPS = ledger("""SELECT prev + 1 AS expected, seq, seq - prev - 1 AS missed FROM (
    SELECT seq, lag(seq) OVER (ORDER BY seq) AS prev FROM notify) l
    WHERE seq <> prev + 1""", "notify")
ALERTS = ledger("""SELECT CAST(service AS BIGINT) AS service, run FROM sent""", "health",
                runs=_RUNS, fails=_STREAKS, sent="""
        SELECT service, streak, min(run) AS run FROM fails GROUP BY 1, 2
        UNION ALL
        SELECT s.service, s.streak, min(f.run) FROM sent s
        JOIN fails f ON f.service = s.service AND f.streak = s.streak AND f.run >= s.run + 1440
        GROUP BY 1, 2""").replace("WITH ", "WITH RECURSIVE ", 1)
ORACLES = {
    "block_tx_join": ledger("""SELECT txid, block_hash, CAST(height AS BIGINT) AS height, nTime,
        lockTime, finality_status FROM transactions JOIN blocks ON hashBlock = block_hash""",
                            "transactions", "blocks"),
    "flat_block": ledger(f"""SELECT {_FLAT} FROM flat
        WHERE block_height = (SELECT max(height) FROM alive)""", "flat"),
    "flat_range": ledger(f"SELECT {_FLAT} FROM flat", "flat"),
    "flat_fanout_counts": ledger("""
        SELECT t.txid, CAST(a.height AS BIGINT) AS height, count(*) AS joined_rows,
            count(DISTINCT i.hashPrevOut || ':' || i.indexPrevOut) AS input_count,
            count(DISTINCT p.indexOut) AS output_count,
            CAST(coalesce(sum(p.value), 0) AS BIGINT) AS inflated_value
        FROM alive a JOIN transactions t ON t.hashBlock = a.block_hash
        LEFT JOIN twice i ON i.txid = t.txid LEFT JOIN tx_out p ON p.txid = t.txid
        GROUP BY a.block_hash, a.height, a.block_timestamp, a.nTime, t.txid, t.version,
            t.lockTime, a.finality_status""", "alive", "transactions", "tx_in", "tx_out",
                                 twice="SELECT * FROM tx_in UNION ALL SELECT * FROM tx_in"),
    "control_unmatched": ledger("""SELECT "offset", block_hash, finality_status FROM control
        WHERE type IN ('finality', 'reorg') AND finality_status IN ('CONFIRMED', 'REORGED')
        AND block_hash NOT IN (SELECT block_hash FROM blocks)""", "control", "blocks"),
    "prevout_join": ledger("""SELECT i.txid, i.hashPrevOut, CAST(i.indexPrevOut AS BIGINT)
        AS indexPrevOut, coalesce(p.value, -1) AS prev_value,
        coalesce(p.address, 'unresolved') AS prev_address
        FROM tx_in i LEFT JOIN tx_out_unique p
            ON p.txid = i.hashPrevOut AND p.indexOut = i.indexPrevOut
        WHERE i.hashPrevOut <> repeat('0', 64)""", "tx_in", "tx_out_unique"),
    "raw_flat_parity": ledger("""SELECT CAST(height AS BIGINT) AS height, count(*) AS raw_rows,
        count(*) FILTER (WHERE height <= tip - 3) AS flat_rows, height <= tip - 3 AS equal
        FROM transactions JOIN alive ON hashBlock = block_hash, tip GROUP BY height, tip""",
                              "transactions", "alive"),
    "source_parity": ledger("""SELECT table_name, row_count AS left_rows, row_count AS right_rows,
        satoshis AS left_satoshis, satoshis AS right_satoshis, true AS equal FROM sums""", *_ALL,
                            sums=" UNION ALL ".join(_CHECKSUM.format(
                                t=t, v="value" if t == "tx_out" else "0") for t in _ALL)),
    "tx_child_counts": ledger("""SELECT txid, count(*) AS children, 'tx_in' AS kind FROM tx_in
        GROUP BY txid UNION ALL SELECT txid, count(*), 'tx_out' FROM tx_out GROUP BY txid""",
                              "tx_in", "tx_out"),
    "tx_output_value": ledger("""SELECT txid, CAST(sum(value) AS BIGINT) AS total_output_value
        FROM tx_out GROUP BY txid""", "tx_out"),
    "tx_nested": ledger("""SELECT coalesce(ic.txid, oc.txid) AS txid, coalesce(inputs, '')
        AS inputs, coalesce(outputs, '') AS outputs
        FROM ic FULL JOIN oc ON ic.txid = oc.txid""", "ic", "oc"),
    "high_water": ledger("""SELECT CAST(max(height) AS BIGINT) AS max_all,
        CAST(max(height) FILTER (WHERE finality_status <> 'REORGED') AS BIGINT) AS max_living,
        CAST(-1 AS BIGINT) AS max_none FROM blocks""", "blocks"),
    "distinct_children": ledger("""SELECT txid, count(*) AS children,
        count(DISTINCT hashPrevOut || ':' || indexPrevOut) AS distinct_children, 'tx_in' AS kind
        FROM tx_in GROUP BY txid
        UNION ALL SELECT txid, count(*), count(DISTINCT indexOut), 'tx_out'
        FROM tx_out GROUP BY txid""", "tx_in", "tx_out"),
    "table_counts": ledger(" UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in _ALL), *_ALL),
    "block_record_counts": ledger(_PER_BLOCK, *_ALL),
    "run_rates": ledger("""SELECT CAST(p.height AS BIGINT) AS height,
        round(records * 1000 / blocksize, 4) AS per_second,
        round(600000 / blocksize, 4) AS headroom
        FROM per_block p JOIN blocks b ON b.height = p.height""", *_ALL, per_block=_PER_BLOCK),
    "run_averages": ledger("SELECT count(*) AS blocks, " + ", ".join(
        f"CAST(sum({c}) AS BIGINT) AS total_{c}, round(avg({c}), 4) AS avg_{c}"
        for c in ("txs", "inputs", "outputs", "records")) + " FROM per_block", *_ALL,
        per_block=_PER_BLOCK),
    "value_checksum": ledger(" UNION ALL ".join(_CHECKSUM.format(
        t=t, v="value" if t == "tx_out" else "0") for t in _ALL), *_ALL),
    "health_rollup": ledger("""SELECT CAST(service AS BIGINT) AS service, status,
        count(*) AS checks FROM health GROUP BY 1, 2""", "health"),
    "health_run_status": ledger("""SELECT CASE WHEN n = 0 THEN 'OK' ELSE 'FAIL(' || n || ')' END
        AS run_status, count(*) AS runs FROM (
            SELECT floor(epoch(ts) / 3600) AS run,
                   count(DISTINCT service) FILTER (WHERE status <> 'ok') AS n
            FROM health GROUP BY 1) r GROUP BY 1""", "health"),
    "alert_cooldown": ALERTS,
    "chain_breaks": ledger("""SELECT CAST(b.height AS BIGINT) AS height, b.block_hash,
        b.hashPrev AS hash_prev,
        CASE WHEN p.height IS NULL THEN 'parent missing' ELSE 'hash mismatch' END AS reason
        FROM blocks b LEFT JOIN blocks p ON p.height = b.height - 1
        WHERE b.height > 0 AND (p.block_hash IS NULL OR p.block_hash <> b.hashPrev)""", "blocks"),
    "height_gaps": ledger("""SELECT CAST(prev + 1 AS BIGINT) AS gap_start,
        CAST(height - prev - 1 AS BIGINT) AS gap_length FROM (
            SELECT height, lag(height, 1, -1) OVER (ORDER BY height) AS prev FROM blocks) l
        WHERE height - prev > 1""", "blocks"),
    "build_progress": ledger("""SELECT CAST(h AS BIGINT) AS height, n AS txs,
        CAST(sum(n) OVER (ORDER BY h) AS BIGINT) AS total_txs,
        round(CAST(h AS DOUBLE) / (tip + 1) * 100, 1) AS percent
        FROM (SELECT h, count(*) AS n FROM o GROUP BY h) c, tip""", "tip"),
    "seq_gaps": SEQ_GAPS,
    "compact_latest": ledger("""SELECT block_hash, "offset", type, finality_status FROM (
        SELECT *, row_number() OVER (PARTITION BY block_hash ORDER BY "offset" DESC) AS rn
        FROM control) r WHERE rn = 1""", "control"),
    "latest_blocks": ledger("""SELECT CAST(height AS BIGINT) AS height, block_hash, finality_status
        FROM blocks ORDER BY height DESC LIMIT 5""", "blocks"),
    "order_violations": ledger("""SELECT topic_name, count(*) AS records,
        count(*) FILTER (WHERE prev > height) AS violations FROM (
            SELECT *, lag(height) OVER (PARTITION BY topic_name ORDER BY "offset") AS prev
            FROM streams) l GROUP BY 1""", "streams"),
    "dual_path_union": ledger(f"""SELECT txid, CAST(block_height AS BIGINT) AS block_height,
        CASE WHEN block_height > tip - 20 THEN '{LATER}' ELSE '{SEEN_AT}' END AS ingested_at
        FROM transactions, tip""", "transactions", "tip"),
    "dedup_identity": ledger("""SELECT txid, CAST(indexOut AS BIGINT) AS indexOut,
        CAST(height AS BIGINT) AS height, value, scriptPubKey, address FROM tx_out_unique""",
                             "tx_out_unique"),
    "missing_ids": ledger("""SELECT txid FROM transactions
        WHERE lockTime NOT IN (SELECT l_orderkey FROM lineitem)""", "transactions"),
    "retention": """SELECT event_id, event_type FROM events
        WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 7 DAY""",
    "tip_freshness": ledger("""SELECT CAST(height AS BIGINT) AS tip_height,
        block_timestamp AS tip_time, date_diff('second', CAST(block_timestamp AS TIMESTAMP),
            TIMESTAMP '2001-08-01 00:20:00') AS age_seconds,
        date_diff('second', CAST(block_timestamp AS TIMESTAMP),
            TIMESTAMP '2001-08-01 00:20:00') < 1800 AS fresh
        FROM blocks, tip WHERE height = tip""", "blocks"),
    "topic_lag": ledger("""SELECT topic_name, max("offset") AS end_offset,
        max("offset") FILTER (WHERE height <= tip - 6) AS committed_offset,
        max("offset") - max("offset") FILTER (WHERE height <= tip - 6) AS lag,
        max("offset") - max("offset") FILTER (WHERE height <= tip - 6) < 10 AS healthy
        FROM streams, tip GROUP BY topic_name""", "streams", "tip"),
}
