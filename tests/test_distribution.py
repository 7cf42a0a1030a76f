"""Joins, aggregates and lookups by txid on distributed tables."""

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.dedupe import drop_copies, keep_latest
from ledgerloom.plans import distribution
from tests.conftest import rows


@pytest.fixture
def tables(spark, folder):
    name = f"dist_{abs(hash(folder()))}"
    spark.sql(f"CREATE SCHEMA {name} LOCATION '{folder('schema')}'")
    txs = spark.range(400).select(F.md5(F.col("id").cast("string")).alias("txid"), "id")
    outs = spark.range(1200).select(F.md5((F.col("id") % 500).cast("string")).alias("txid"),
                                    F.col("id").alias("value"))
    yield [distribution.save_distributed(df, f"{name}.{t}", folder(t), buckets=8)
           for t, df in (("txs", txs), ("outs", outs))], name
    spark.sql(f"DROP SCHEMA {name} CASCADE")


def test_join_and_aggregate_need_no_exchange(spark, tables):
    (txs, outs), _ = tables
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sums = outs.groupBy("txid").agg(F.sum("value").alias("total"))
        both = txs.join(sums, "txid", "left").groupBy("txid").agg(F.max("total").alias("total"))
        plan = both._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "SortMergeJoin" in plan
        assert both.count() == 400
        assert both.where(F.col("txid") == F.md5(F.lit("7"))).first().total == 7 + 507 + 1007
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_point_read_opens_one_bucket(spark, tables):
    _, name = tables
    txid = spark.range(1).select(F.md5(F.lit("9"))).first()[0]
    assert rows(distribution.rows_of(spark, f"{name}.txs", txid), "id") == [(9,)]
    auto = "spark.sql.sources.bucketing.autoBucketedScan.enabled"
    spark.conf.set(auto, "false")   # a scan that is shown as bucketed also shows its buckets
    try:
        found = distribution.rows_of(spark, f"{name}.txs", txid)
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset(auto)
    assert "SelectedBucketsCount: 1 out of 8" in plan


def test_saving_again_replaces_the_table(spark, tables, folder):
    _, name = tables
    again = distribution.save_distributed(spark.range(3).select(
        F.col("id").cast("string").alias("txid")), f"{name}.txs", folder("again"), buckets=2)
    assert rows(again) == [("0",), ("1",), ("2",)]


@pytest.mark.parametrize("limit", [64 << 20, 0])
def test_copies_go_as_with_whole_rows(spark, monkeypatch, limit):
    monkeypatch.setattr("ledgerloom.operators.dedupe.MAX_BROADCAST_BYTES", limit)
    df = spark.sql("SELECT CAST(id % 70 AS STRING) AS k, if(id % 3 = 0, null, id % 5) AS o, "
                   "CAST(id AS STRING) AS v FROM range(100)")
    assert rows(drop_copies(df, ["k"], ["o"])) == rows(keep_latest(df, ["k"], ["o"]))
    single = df.where("v < '2'").dropDuplicates(["k"])
    assert drop_copies(single, ["k"], ["o"]) is single
    nulls = spark.createDataFrame([(None, 1, "a"), (None, 2, "b")], "k string, o int, v string")
    assert rows(drop_copies(nulls, ["k"], ["o"])) == [(None, 2, "b")]
