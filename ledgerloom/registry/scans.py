"""Sources, sinks and scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators import counts
from ledgerloom.operators.conform import conform, decode
from ledgerloom.operators.normalize import LedgerFrames, normalize
from ledgerloom.plans.flat import FlatTable, build_flat
from ledgerloom.registry.sql import ledger, print_of, summary_of
from ledgerloom.registry.workspace import PRINTED, Workspace, fingerprint, summary, text_of
from ledgerloom.schemas import CONFIRMED, KINDS
from ledgerloom.sources import catalog, history, topics
from ledgerloom.sources.lake import Lake, overwrite_by
from ledgerloom.sources.views import SEEN_AT


def block_source(spark: SparkSession, sf: str) -> DataFrame:
    docs = Workspace(spark, sf).documents()
    whole = F.filter("tx", lambda t: t["piece"] == 0)
    return docs.groupBy("height", F.col("hash").alias("block_hash")).agg(
        F.sum(F.size(whole)).alias("txs"))


def publish_keyed(spark: SparkSession, sf: str) -> DataFrame:
    messages = topics.read_topics(spark, Workspace(spark, sf).topics_dir())
    return messages.groupBy("topic").agg(
        F.count("*").alias("messages"), F.count_distinct("key").alias("distinct_keys"),
        fingerprint(["key"]).alias("fingerprint"))


def topic_decode(spark: SparkSession, sf: str) -> DataFrame:
    root = Workspace(spark, sf).topics_dir()
    frames = {t: conform(decode(topics.read_topic(spark, root, k.topic), k), k)
              for t, k in KINDS.items()}
    return summary(LedgerFrames(**frames))


def scan_full(spark: SparkSession, sf: str) -> DataFrame:
    return summary(Workspace(spark, sf).stored())


def _blocks_out(df: DataFrame) -> DataFrame:
    return df.select("block_hash", F.col("height").cast("bigint").alias("height"),
                     F.col("nTime").cast("bigint").alias("nTime"), "nNonce", "finality_status")


def scan_point(spark: SparkSession, sf: str) -> DataFrame:
    """The newest stored block, looked up by its hash."""
    ws = Workspace(spark, sf)
    tip_hash = ws.views.block_hash(F.lit(ws.lake().high_water()))
    return _blocks_out(ws.lake().read("blocks").where(F.col("block_hash") == tip_hash))


def _schema_name(ws: Workspace, label: str) -> str:
    return f"{label}_{ws.new_dir('x').rsplit('-', 1)[1]}"


def catalog_scan(spark: SparkSession, sf: str) -> DataFrame:
    ws = Workspace(spark, sf)
    name = _schema_name(ws, "scan")
    catalog.create_tables(spark, ws.lake(), name)
    return summary(LedgerFrames(**{t: catalog.read_table(spark, name, t) for t in KINDS}))


def flat_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """A stored flat table whose youngest 100 heights are confirmed by an upsert."""
    ws = Workspace(spark, sf)
    frames = ws.stored()
    tip = ws.lake().high_water()
    flat = FlatTable(spark, ws.new_dir("flat"), band_width=200)
    flat.append(build_flat(frames), span=(0, tip))
    newer = build_flat(frames, lo=tip - 99, hi=tip)
    flat.upsert(newer.withColumn("finality_status", F.lit(CONFIRMED)), span=(tip - 99, tip))
    return flat_light(flat.read())


def flat_light(df: DataFrame) -> DataFrame:
    return df.select(
        "txid", F.col("block_height").cast("bigint").alias("block_height"),
        F.col("input_count").cast("bigint").alias("input_count"),
        F.col("output_count").cast("bigint").alias("output_count"),
        "total_output_value", "finality_status")


FLAT_LIGHT = "txid, block_height, input_count, output_count, total_output_value"


def csv_backfill(spark: SparkSession, sf: str) -> DataFrame:
    ws = Workspace(spark, sf)
    dump, lake = ws.new_dir("dump"), ws.new_lake("backfill")
    history.write_history(ws.views.frames(), dump)
    history.backfill(spark, dump, lake, SEEN_AT)
    return summary(LedgerFrames(**{t: lake.read(t) for t in KINDS}))


def partition_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    """Ranges of 100 heights from 1,200 on replaced; the ranges below stay."""
    ws = Workspace(spark, sf)
    blocks = ws.views.blocks.select("height", "blocksize").withColumn(
        "height_range", (F.floor(F.col("height") / 100) * 100).cast("int"))
    path = ws.new_dir("ranges")
    overwrite_by(blocks, path, ["height_range"])
    overwrite_by(blocks.where(F.col("height_range") >= 1200)
                 .withColumn("blocksize", F.col("blocksize") * 2), path, ["height_range"])
    stored = spark.read.parquet(path)
    return stored.select(*[F.col(c).cast("bigint").alias(c)
                           for c in ("height", "height_range", "blocksize")])


def refresh_read(spark: SparkSession, sf: str) -> DataFrame:
    """Rows a catalog table shows before and after files arrive behind it."""
    ws = Workspace(spark, sf)
    lake, blocks, name = ws.new_lake("refresh"), ws.stored().blocks, _schema_name(ws, "refresh")
    tip = ws.lake().high_water()
    lake.append("blocks", blocks.where(F.col("height") <= tip - 100), "first")
    catalog.create_tables(spark, lake, name)
    before = catalog.read_table(spark, name, "blocks").count()
    lake.append("blocks", blocks.where(F.col("height") > tip - 100), "second")
    catalog.refresh(spark, f"{name}.blocks")
    after = catalog.read_table(spark, name, "blocks")
    return after.agg(F.count("*").alias("after_rows")).select(
        F.lit(before).cast("bigint").alias("before_rows"), "after_rows")


def compact(spark: SparkSession, sf: str) -> DataFrame:
    """Outputs appended in four batches, folded into one; rows stay as they were."""
    ws = Workspace(spark, sf)
    lake, outs, tip = ws.new_lake("compact"), ws.stored().tx_out, ws.lake().high_water()
    step = tip // 4 + 1
    for i in range(4):
        lake.append("tx_out", outs.where(F.floor(F.col("height") / step) == i), f"batch-{i}")
    files = lake.compact("tx_out", "1")
    fewer = files["files_after"] < files["files_before"]
    return lake.read("tx_out").agg(
        F.count("*").alias("row_count"),
        fingerprint(["txid", "indexOut", "value", "address"]).alias("fingerprint")).select(
        "row_count", "fingerprint", F.lit(fewer).alias("fewer_files"))


def inspect_block(spark: SparkSession, sf: str) -> DataFrame:
    """Record counts and the first record of each kind, by its key, in the newest block."""
    lake: Lake = Workspace(spark, sf).lake()
    tip, out = lake.high_water(), None
    for table, kind in KINDS.items():
        key = F.concat_ws(":", *[F.col(c).cast("string") for c in kind.key])
        part = lake.read(table, heights=[tip]).agg(
            F.count("*").alias("records"), F.min_by(F.concat_ws(
                "|", *[text_of(c) for c in PRINTED[table]]), key).alias("first_record")).select(
            F.lit(table).alias("kind"), "records", "first_record")
        out = part if out is None else out.unionByName(part)
    return out


def dry_run_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Normalised without any sink; only counts come back."""
    frames = normalize(Workspace(spark, sf).documents(), SEEN_AT)
    return counts.table_counts(frames)


_KEYS = """
    SELECT 'btc.blocks.v1' AS topic, block_hash AS key FROM blocks
    UNION ALL SELECT 'btc.transactions.v1', txid FROM transactions
    UNION ALL SELECT 'btc.tx_inputs.v1', txid || ':' || hashPrevOut || ':' || indexPrevOut FROM tx_in
    UNION ALL SELECT 'btc.tx_outputs.v1', txid || ':' || indexOut FROM tx_out"""
_ALL = ("blocks", "transactions", "tx_in", "tx_out")
_SUMMARY = ledger(summary_of(), *_ALL)
_COUNTS = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in _ALL)

QUERIES = {
    "block_source": block_source, "publish_keyed": publish_keyed, "topic_decode": topic_decode,
    "scan_full": scan_full, "scan_point": scan_point, "catalog_scan": catalog_scan,
    "flat_upsert": flat_upsert, "csv_backfill": csv_backfill,
    "partition_overwrite": partition_overwrite, "refresh_read": refresh_read, "compact": compact,
    "inspect_block": inspect_block, "dry_run_counts": dry_run_counts,
}
ORACLES = {
    "block_source": ledger("""SELECT CAST(h AS BIGINT) AS height, md5('block:' || h) AS block_hash,
        count(*) AS txs FROM o GROUP BY h""", "o"),
    "publish_keyed": ledger(f"""SELECT topic, count(*) AS messages,
        count(DISTINCT key) AS distinct_keys, {print_of('key')} AS fingerprint
        FROM keys GROUP BY topic""", *_ALL, keys=_KEYS),
    "topic_decode": _SUMMARY,
    "scan_full": _SUMMARY,
    "scan_point": ledger("""SELECT block_hash, CAST(height AS BIGINT) AS height, nTime, nNonce,
        finality_status FROM blocks, tip WHERE height = tip""", "blocks"),
    "catalog_scan": _SUMMARY,
    "flat_upsert": ledger(f"""SELECT {FLAT_LIGHT},
        CASE WHEN block_height > tip - 100 THEN 'CONFIRMED' ELSE finality_status END
            AS finality_status FROM flat, tip""", "flat", "tip"),
    "csv_backfill": _SUMMARY,
    "partition_overwrite": ledger("""SELECT CAST(height AS BIGINT) AS height,
        CAST(height // 100 * 100 AS BIGINT) AS height_range,
        CAST(CASE WHEN height >= 1200 THEN 2 * blocksize ELSE blocksize END AS BIGINT) AS blocksize
        FROM blocks""", "blocks"),
    "refresh_read": ledger("""SELECT count(*) FILTER (WHERE height <= tip - 100) AS before_rows,
        count(*) AS after_rows FROM blocks, tip""", "blocks"),
    "compact": ledger(f"""SELECT count(*) AS row_count,
        {print_of('txid, indexOut, value, address')} AS fingerprint, true AS fewer_files
        FROM tx_out""", "tx_out"),
    "inspect_block": ledger(" UNION ALL ".join(
        f"SELECT '{t}' AS kind, count(*) AS records, arg_min(concat_ws('|', "
        f"{', '.join(PRINTED[t])}), concat_ws(':', {', '.join(k.key)})) AS first_record "
        f"FROM {t}, tip WHERE {k.height_col} = tip" for t, k in KINDS.items()), *_ALL),
    "dry_run_counts": ledger(_COUNTS, *_ALL),
}
