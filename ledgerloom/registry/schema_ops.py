"""DDL and schema operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators import conform as C
from ledgerloom.plans.flat import RANGE_COL, FlatTable, build_flat
from ledgerloom.registry.scans import _schema_name
from ledgerloom.registry.sql import ledger, print_of
from ledgerloom.registry.workspace import Workspace, fingerprint
from ledgerloom.schemas import BUCKET_COL, KINDS, TABLE_OF_TOPIC
from ledgerloom.sources import catalog, topics

REQUIRED = {
    KINDS["blocks"].topic: [c for c in KINDS["blocks"].columns if c != "source_seq"]
    + ["schema_version"],
    KINDS["transactions"].topic: KINDS["transactions"].columns + ["schema_version"],
    KINDS["tx_in"].topic: KINDS["tx_in"].columns + ["schema_version"],
    KINDS["tx_out"].topic: KINDS["tx_out"].columns + ["schema_version"],
}
FORBIDDEN = {
    KINDS["blocks"].topic: ["txid", "hashPrevOut"],
    KINDS["transactions"].topic: ["finality_status", "hashPrevOut", "indexOut"],
    KINDS["tx_in"].topic: ["indexOut", "scriptPubKey"],
    KINDS["tx_out"].topic: ["hashPrevOut", "scriptSig"],
}


def ddl_create(spark: SparkSession, sf: str) -> DataFrame:
    """Tables created twice, dropped and created again, then filled and counted by name."""
    ws = Workspace(spark, sf)
    lake, name = ws.new_lake("ddl"), _schema_name(ws, "ddl")
    catalog.create_tables(spark, lake, name)
    catalog.create_tables(spark, lake, name)
    catalog.create_tables(spark, lake, name, drop=True)
    out = None
    for table, frame in ws.stored().items():
        lake.append(table, frame, "load")
        catalog.refresh(spark, f"{name}.{table}")
        key = ",".join(catalog.identity_key(spark, name, table))
        part = catalog.read_table(spark, name, table).agg(F.count("*").alias("row_count")).select(
            F.lit(table).alias("table_name"), F.lit(key).alias("identity_key"), "row_count")
        out = part if out is None else out.unionByName(part)
    return out


def bucket_layout(spark: SparkSession, sf: str) -> DataFrame:
    """Rows and heights per table, and the heights whose rows share a single bucket."""
    lake, out = Workspace(spark, sf).lake(), None
    for table, kind in KINDS.items():
        per_height = lake.scan(table).groupBy(kind.height_col).agg(
            F.count("*").alias("n"), F.min(BUCKET_COL).alias("lo"), F.max(BUCKET_COL).alias("hi"))
        part = per_height.agg(
            F.sum("n").alias("row_count"), F.count("*").alias("heights"),
            F.count_if((F.col("lo") == F.col("hi")) & F.col("lo").between(0, lake.buckets - 1))
            .alias("heights_in_one_bucket")).select(
            F.lit(table).alias("table_name"), "row_count", "heights", "heights_in_one_bucket")
        out = part if out is None else out.unionByName(part)
    return out


def range_layout(spark: SparkSession, sf: str) -> DataFrame:
    """Flat rows per range folder, here with ranges of 1,000 heights."""
    ws = Workspace(spark, sf)
    flat = FlatTable(spark, ws.new_dir("flat"), range_width=1000, band_width=1000)
    flat.append(build_flat(ws.stored()), span=(0, ws.lake().high_water()))
    folders = spark.read.parquet(flat.path)
    return folders.groupBy(F.col(RANGE_COL).cast("bigint").alias("height_range")).agg(
        F.count("*").alias("row_count"),
        F.min("block_height").cast("bigint").alias("lowest"),
        F.max("block_height").cast("bigint").alias("highest"))


def describe_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Columns of each catalog table, and its rows."""
    ws = Workspace(spark, sf)
    name = _schema_name(ws, "describe")
    catalog.create_tables(spark, ws.lake(), name)
    described = catalog.describe(spark, name).groupBy("table_name").agg(
        F.count("*").alias("columns"), F.count_if(F.col("data_type") == "bigint").alias("bigints"))
    rows = None
    for table in KINDS:
        part = catalog.read_table(spark, name, table).agg(F.count("*").alias("row_count")).select(
            F.lit(table).alias("table_name"), "row_count")
        rows = part if rows is None else rows.unionByName(part)
    return described.join(rows, "table_name")


def widen_read(spark: SparkSession, sf: str) -> DataFrame:
    """Old files hold lockTime as INT, newer ones as BIGINT; one BIGINT schema reads both."""
    ws = Workspace(spark, sf)
    txs, root = ws.views.transactions.select("txid", "version", "block_height", "lockTime"), \
        ws.new_dir("widen")
    old = (F.col("block_height") < 1000) & (F.col("lockTime") <= 2147483647)
    (txs.where(old).withColumn("lockTime", F.col("lockTime").cast("int"))
     .write.parquet(f"{root}/part=old"))
    txs.where(~old).write.parquet(f"{root}/part=new")
    both = spark.read.schema(
        "txid STRING, version INT, block_height INT, lockTime BIGINT, part STRING").parquet(root)
    return both.groupBy(F.col("version").cast("bigint").alias("version")).agg(
        F.count("*").alias("row_count"),
        F.sum(F.col("lockTime").cast("decimal(20,0)")).cast("string").alias("lock_sum"),
        F.max("lockTime").alias("lock_max"))


def conform_schema(spark: SparkSession, sf: str) -> DataFrame:
    """Records with a foreign column, without an optional one and out of order."""
    ws, kind = Workspace(spark, sf), KINDS["transactions"]
    wire = C.decode(topics.read_topic(spark, ws.topics_dir(), kind.topic), kind)
    odd = wire.drop("observed_at").withColumn("fee", F.lit(1)).select(
        "fee", *[c for c in reversed(wire.columns) if c not in ("observed_at", "_corrupt")])
    fitted = C.conform(odd, kind)
    return fitted.agg(
        F.count("*").alias("row_count"), F.count_if(F.col("observed_at").isNull())
        .alias("null_observed"),
        fingerprint(["txid", "hashBlock", "version", "lockTime", "block_height",
                     "block_timestamp"]).alias("fingerprint")).select(
        "*", F.lit(",".join(fitted.columns)).alias("columns"))


def schema_drift(spark: SparkSession, sf: str) -> DataFrame:
    """Fields met in the messages of each topic against the declared tables."""
    messages = topics.with_table(topics.read_topics(spark, Workspace(spark, sf).topics_dir()))
    made = messages.select("table_name", F.explode(F.json_object_keys("value")).alias("field")
                           ).distinct()
    declared = spark.createDataFrame(
        [(t, c) for t, k in KINDS.items() for c in k.columns], "table_name string, field string")
    return C.schema_drift(made, declared)


def _damaged(spark: SparkSession, sf: str, change) -> DataFrame:
    messages = topics.read_topics(spark, Workspace(spark, sf).topics_dir())
    hit = ((F.col("topic") == KINDS["blocks"].topic)
           & (F.get_json_object("value", "$.height").cast("int") % 40 == 3))
    body = F.to_json(change(F.from_json("value", "map<string,string>")))
    return messages.withColumn("value", F.when(hit, body).otherwise(F.col("value")))


def required_fields(spark: SparkSession, sf: str) -> DataFrame:
    """Every 40th block message has lost a field."""
    messages = _damaged(spark, sf, lambda m: F.map_filter(m, lambda k, _: k != "nBits"))
    return topics.missing_fields(messages, REQUIRED)


def topic_isolation(spark: SparkSession, sf: str) -> DataFrame:
    """Every 40th block message carries a field of another topic."""
    messages = _damaged(spark, sf, lambda m: F.map_concat(
        m, F.create_map(F.lit("txid"), F.lit("x"))))
    return topics.leaked_fields(messages, FORBIDDEN)


_ALL = ("blocks", "transactions", "tx_in", "tx_out")


def _per_field(fields: dict[str, list[str]], name: str, hits: set[tuple[str, str]]) -> str:
    rows = []
    for topic, names in fields.items():
        table = TABLE_OF_TOPIC[topic]
        for f in names:
            count = "count(*) FILTER (WHERE height % 40 = 3)" if (table, f) in hits else "0"
            rows.append(f"SELECT '{topic}' AS topic, '{f}' AS field, count(*) AS messages, "
                        f"CAST({count} AS BIGINT) AS {name} FROM {table}")
    return " UNION ALL ".join(rows)


QUERIES = {
    "ddl_create": ddl_create, "bucket_layout": bucket_layout, "range_layout": range_layout,
    "describe_tables": describe_tables, "widen_read": widen_read,
    "conform_schema": conform_schema, "schema_drift": schema_drift,
    "required_fields": required_fields, "topic_isolation": topic_isolation,
}
ORACLES = {
    "ddl_create": ledger("""
        SELECT 'blocks' AS table_name, 'block_hash' AS identity_key, count(*) AS row_count FROM blocks
        UNION ALL SELECT 'transactions', 'txid', count(*) FROM transactions
        UNION ALL SELECT 'tx_in', 'txid,hashPrevOut,indexPrevOut', count(*) FROM tx_in
        UNION ALL SELECT 'tx_out', 'txid,indexOut', count(*) FROM tx_out""", *_ALL),
    "bucket_layout": ledger(" UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count, count(DISTINCT {h}) AS heights, "
        f"count(DISTINCT {h}) AS heights_in_one_bucket FROM {t}"
        for t, h in (("blocks", "height"), ("transactions", "block_height"),
                     ("tx_in", "block_height"), ("tx_out", "height"))), *_ALL),
    "range_layout": ledger("""SELECT block_height // 1000 * 1000 AS height_range,
        count(*) AS row_count, min(block_height) AS lowest, max(block_height) AS highest
        FROM flat GROUP BY 1""", "flat"),
    "describe_tables": ledger("""
        SELECT 'blocks' AS table_name, 16 AS columns, 2 AS bigints, count(*) AS row_count FROM blocks
        UNION ALL SELECT 'transactions', 10, 1, count(*) FROM transactions
        UNION ALL SELECT 'tx_in', 11, 2, count(*) FROM tx_in
        UNION ALL SELECT 'tx_out', 12, 1, count(*) FROM tx_out""", *_ALL),
    "widen_read": ledger("""SELECT version, count(*) AS row_count,
        CAST(sum(lockTime) AS VARCHAR) AS lock_sum, max(lockTime) AS lock_max
        FROM transactions GROUP BY version""", "transactions"),
    "conform_schema": ledger(f"""SELECT count(*) AS row_count, count(*) AS null_observed,
        {print_of('txid, hashBlock, version, lockTime, block_height, block_timestamp')}
            AS fingerprint,
        'txid,hashBlock,version,lockTime,block_height,block_timestamp,observed_at,ingested_at'
            AS columns FROM transactions""", "transactions"),
    "schema_drift": ledger(" UNION ALL ".join(
        f"SELECT DISTINCT '{t}' AS table_name, 'schema_version' AS field, 'not declared' AS drift "
        f"FROM {t}" for t in _ALL), *_ALL),
    "required_fields": ledger(_per_field(REQUIRED, "missing", {("blocks", "nBits")}),
                              *_ALL),
    "topic_isolation": ledger(_per_field(FORBIDDEN, "leaked", {("blocks", "txid")}), *_ALL),
}
