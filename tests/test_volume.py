"""What is written and sent through shuffles on the way from the tables to topics and lake."""

from __future__ import annotations

import glob
import gzip
import json
import re

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.conform import conform
from ledgerloom.registry.workspace import Workspace
from ledgerloom.schemas import BUCKET_COL, KINDS
from ledgerloom.sources import lake as lake_module
from ledgerloom.sources import topics
from ledgerloom.sources.lake import Lake
from ledgerloom.sources.views import LedgerViews
from tests.conftest import rows

OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"


@pytest.fixture
def tables(spark, folder):
    """Nine orders of three customers on three days, 24 line items."""
    root = folder("tables")
    orders = spark.range(9).select(
        F.col("id").alias("o_orderkey"), (F.col("id") % 3).alias("o_custkey"),
        F.date_add(F.lit("1995-01-01").cast("date"), (F.col("id") % 3).cast("int"))
        .cast("timestamp").alias("o_orderdate"))
    lines = spark.range(24).select(
        (F.col("id") % 8).alias("l_orderkey"), (F.col("id") * 7 + 1).alias("l_partkey"),
        (F.col("id") * 5 + 1).alias("l_suppkey"),
        (F.floor(F.col("id") / 8) + 1).cast("int").alias("l_linenumber"),
        (F.col("id") * 1.25 + 1).cast("double").alias("l_extendedprice"))
    orders.write.parquet(f"{root}/orders.parquet")
    lines.write.parquet(f"{root}/lineitem.parquet")
    return root


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_topics_are_compressed_in_files_of_bounded_length(spark, folder, monkeypatch):
    monkeypatch.setattr(topics, "MESSAGES_PER_FILE", 4)
    root, before = folder("topics"), spark.conf.get(OPEN_FILES)
    sent = spark.range(0, 20, 1, 2).select(
        F.concat(F.lit("t"), F.col("id") % 2).alias("topic"), F.col("id").cast("string").alias("key"),
        F.lit("v").alias("value"))
    topics.publish(sent, root)
    files = [r.f for r in spark.read.text(root).select(F.input_file_name().alias("f"))
             .distinct().collect()]
    assert files and all(f.endswith(".json.gz") for f in files)
    for f in files:
        with gzip.open(f.removeprefix("file://")) as lines:
            assert len(lines.readlines()) <= 4
    assert rows(topics.read_topics(spark, root), "topic", "key", "value") == rows(sent)
    assert spark.conf.get(OPEN_FILES) == before


def test_outputs_and_documents_send_no_hashes(spark, tables):
    views, name = LedgerViews(spark, tables), "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        plans = [plan_of(views.tx_out), plan_of(views.documents())]
    finally:
        spark.conf.set(name, before)
    for plan in plans:
        keys = re.findall(r"hashpartitioning\(([^)]*)", plan)
        assert keys and not any("txid" in k for k in keys)


def test_the_lake_is_loaded_from_rows_spread_before_they_are_made(spark, tables):
    ws, before = Workspace(spark, tables), spark.conf.get(OPEN_FILES)
    lake = ws.lake()
    for table, frame in ws.views.frames().items():
        assert rows(lake.read(table)) == rows(frame)
        kept = lake.scan(table).select(
            lake.bucket_of(F.col(KINDS[table].height_col)).alias("want"), BUCKET_COL)
        assert kept.where(f"want != {BUCKET_COL}").isEmpty()
    assert spark.conf.get(OPEN_FILES) == before
    spread = LedgerViews(spark, tables, spread=lake.bucket_of).tx_out
    above = plan_of(spread).split("REBALANCE")[0]
    assert "AS scriptPubKey" in above  # made behind the rebalance


def test_records_of_a_block_lie_together(spark, tables):
    ws, heights = Workspace(spark, tables), {}
    for table, kind in KINDS.items():
        if table == "blocks":
            continue
        for name in glob.glob(f"{topics.topic_dir(ws.topics_dir(), kind.topic)}/*.gz"):
            with gzip.open(name, "rt") as lines:
                told = [json.loads(json.loads(line)["value"]) for line in lines]
            # a transaction's records stand side by side in its block
            order = [(r[kind.height_col], r["txid"]) for r in told]
            runs = [at for k, at in enumerate(order) if not k or order[k - 1] != at]
            assert len(runs) == len(set(runs))
            assert [h for h, _ in order] == sorted(h for h, _ in order)
            heights.setdefault(table, set()).update(h for h, _ in order)
        for name in glob.glob(f"{ws.lake().path(table)}/**/*.parquet", recursive=True):
            found = pq.ParquetFile(name).read([kind.height_col])[kind.height_col].to_pylist()
            assert found == sorted(found)
    assert heights == {t: {0, 1, 2} for t in ("transactions", "tx_in", "tx_out")}
    # narrow rows are sorted, and records made of them behind it
    plan = plan_of(LedgerViews(spark, tables, ordered=True).tx_out)
    assert "AS scriptPubKey" in plan.split("Sort [h#")[0]
    assert rows(LedgerViews(spark, tables, ordered=True).tx_out) == rows(ws.views.tx_out)


def test_large_appends_send_no_records_through_a_shuffle(spark, folder, monkeypatch):
    asked, before = [], spark.conf.get(OPEN_FILES)
    whole = Lake._write

    def write(self, laid_out, path, as_it_lies=False):
        asked.append((as_it_lies, laid_out.sparkSession.conf.get(OPEN_FILES)))
        whole(self, laid_out, path, as_it_lies)

    monkeypatch.setattr(Lake, "_write", write)
    made = spark.range(0, 400, 1, 4).select(F.col("id").alias("n"))
    records = conform(made.select(
        F.md5(F.col("n").cast("string").cast("binary")).alias("txid"), F.lit("b").alias("hashBlock"),
        F.lit(1).alias("version"), F.col("n").alias("lockTime"),
        (F.col("n") % 40).cast("int").alias("block_height")), KINDS["transactions"])
    few, many = Lake(spark, folder("lake")), Lake(spark, folder("lake"))
    few.append("transactions", records, "one")
    monkeypatch.setattr(lake_module, "FILE_BYTES", 1)
    many.append("transactions", records, "one")
    many.append("transactions", records, "one")
    assert asked == [(False, "10"), (True, "10"), (True, "10")]
    assert rows(few.read("transactions")) == rows(many.read("transactions")) == rows(records)
    kept = many.scan("transactions").select(
        many.bucket_of(F.col("block_height")).alias("want"), BUCKET_COL)
    assert kept.where(f"want != {BUCKET_COL}").isEmpty()
    assert spark.conf.get(OPEN_FILES) == before
