"""How much lies on disk, or goes through a shuffle, while the serving table is built and kept."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ledgerloom import storage
from ledgerloom.operators.conform import conform
from ledgerloom.operators.normalize import (
    cut_documents,
    cut_figures,
    document_figures,
    normalize,
    normalize_cut,
)
from ledgerloom.plans import distribution, finality, flat
from ledgerloom.registry.workspace import Workspace
from ledgerloom.schemas import FLAT, KINDS, RAW_BUCKETS
from ledgerloom.sources.lake import Lake
from ledgerloom.streaming import ingest
from tests.conftest import STAMP, block, chain, mint, pay, rows, tx
from tests.test_lake import events


@pytest.fixture
def lake_of(spark, folder, documents):
    def make(docs):
        lake = Lake(spark, folder("lake"))
        for table, frame in normalize(documents(docs), STAMP).items():
            lake.append(table, conform(frame, KINDS[table]), "first")
        return lake
    return make


def flat_rows(spark, *keys):
    """Flat rows of (txid, height, block)."""
    given = spark.createDataFrame(keys, "txid string, block_height int, block_hash string")
    have = {"txid", "block_height", "block_hash"}
    return given.select(*[F.col(f.name) if f.name in have else F.lit("OBSERVED").alias(f.name)
                          if f.name == "finality_status" else F.lit(None).cast(f.dataType)
                          .alias(f.name) for f in FLAT])


def spied(monkeypatch):
    """Plans of what a flat table writes."""
    plans, write = [], flat.FlatTable._write

    def spy(self, laid_out, path, as_it_lies):
        plans.append(laid_out._jdf.queryExecution().optimizedPlan().toString()
                     + (" as it lies" if as_it_lies else " gathered"))
        write(self, laid_out, path, as_it_lies)

    monkeypatch.setattr(flat.FlatTable, "_write", spy)
    return plans


def test_a_workspace_drops_shuffles_when_a_query_is_over(spark, folder):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, "false")
        Workspace(spark, folder("tables"))
        assert spark.conf.get(name) == "true"
    finally:
        spark.conf.set(name, before)
    again = spark.range(100).groupBy((F.col("id") % 7).alias("k")).count()
    assert rows(again) == rows(again)   # a frame may be run again


def test_appended_rows_are_not_shuffled_to_find_copies(spark, folder, monkeypatch):
    plans, made = spied(monkeypatch), flat.FlatTable(spark, folder("flat"))
    made.append(flat_rows(spark, ("a", 0, "x"), ("b", 0, "x"), ("a", 1, "y")), span=(0, 1))
    assert len(plans) == 1 and "Aggregate" not in plans[0] and plans[0].endswith("as it lies")
    made.append(flat_rows(spark, ("c", 2, "z"), ("c", 2, "z"), ("c", 2, "w"), ("d", 2, "z")),
                span=(2, 2))
    assert rows(made.read(), "txid", "block_height", "block_hash") == [
        ("a", 0, "x"), ("a", 1, "y"), ("b", 0, "x"), ("c", 2, "z"), ("d", 2, "z")]
    assert not [n for n in storage.child_names(spark, made.path) if n.startswith("part-")]


def test_an_upsert_merges_bands_by_turns_and_leaves_stored_rows_where_they_are(
        spark, folder, monkeypatch):
    made = flat.FlatTable(spark, folder("flat"), range_width=4, band_width=2)
    made.append(flat_rows(spark, *[(f"t{h}", h, f"b{h}") for h in range(8)]), span=(0, 7))
    monkeypatch.setattr(flat, "MERGE_BYTES", 1)
    monkeypatch.setattr(flat, "FILE_BYTES", 1)
    plans = spied(monkeypatch)
    now = spark.createDataFrame([("b0", "CONFIRMED"), ("b5", "CONFIRMED"), ("b6", "OBSERVED")],
                                "block_hash string, finality_status string")
    gone = spark.createDataFrame([("b2",), ("b3",)], "block_hash string")
    made.upsert(flat_rows(spark, ("t1", 1, "c1"), ("n", 9, "b9")), drop=gone, statuses=now)
    # new rows, then bands 0, 2, 4 and 8, each by itself; 6 has no change
    assert len(plans) == 5 and all("Aggregate" not in p for p in (plans[2], plans[3]))
    assert rows(made.read(), "txid", "block_height", "block_hash", "finality_status") == [
        ("n", 9, "b9", "OBSERVED"), ("t0", 0, "b0", "CONFIRMED"), ("t1", 1, "c1", "OBSERVED"),
        ("t4", 4, "b4", "OBSERVED"), ("t5", 5, "b5", "CONFIRMED"), ("t6", 6, "b6", "OBSERVED"),
        ("t7", 7, "b7", "OBSERVED")]
    assert not [n for n in storage.child_names(spark, made.path) if n.startswith("_swapped")]


@pytest.mark.parametrize("build", ["range", "incremental"])
def test_many_records_are_built_bucket_by_bucket(spark, folder, lake_of, monkeypatch, build):
    shared = tx("s", [mint()], [pay(0, "1")])
    docs = [*chain(14), block(14, [shared], name="left"), block(14, [shared], name="right"),
            block(15, [shared])]
    made = []
    for portion in (flat.PORTION_BYTES, 1):
        monkeypatch.setattr(flat, "PORTION_BYTES", portion)
        lake, table = lake_of(docs), flat.FlatTable(spark, folder("flat"))
        taken, whole = [], flat.build_flat
        monkeypatch.setattr(flat, "build_flat", lambda *a, **k: taken.append(0) or whole(*a, **k))
        if build == "range":
            flat.build_range(lake, table, 0, 15)
        else:
            flat.build_incremental(lake, table)
        monkeypatch.setattr(flat, "build_flat", whole)
        assert len(taken) == (1 if portion > 1 else RAW_BUCKETS)
        made.append(rows(table.read()))
    assert len(made[0]) == 16 and made[0] == made[1]


def test_refreshed_statuses_and_revived_rows(spark, folder, lake_of, monkeypatch):
    monkeypatch.setattr(flat, "MERGE_BYTES", 1)
    lake, made = lake_of(chain(6)), flat.FlatTable(spark, folder("flat"), band_width=2)
    finality.apply_finality(lake, events(spark, ("reorg", "b0", "REORGED")))
    flat.build_incremental(lake, made)
    finality.apply_finality(lake, events(
        spark, ("finality", "b0", "CONFIRMED"), ("reorg", "b4", "REORGED"),
        ("reorg", "b5", "REORGED"), ("finality", "b3", "CONFIRMED")))
    flat.build_incremental(lake, made, refresh_status=True)
    assert rows(made.read(), "block_height", "finality_status") == [
        (0, "CONFIRMED"), (1, "OBSERVED"), (2, "OBSERVED"), (3, "CONFIRMED")]


def test_documents_that_are_cut_give_the_same_records(spark, folder, documents):
    docs = documents([block(0, [tx("a", [mint()], [pay(0, "50", "x")])]), block(1, []),
                      block(2, [tx("b", [mint("01")], [pay(1, "2"), pay(0, "1")]), tx("c", [], [])])])
    docs = docs.withColumn("slice", F.when(F.col("height") == 2, 1))
    path = folder("cut")
    cut_documents(docs).write.parquet(path)
    cut = spark.read.parquet(path)
    for (_, want), (_, got) in zip(normalize(docs, STAMP, -1).items(),
                                   normalize_cut(cut, STAMP, -1).items()):
        assert rows(got) == rows(want)
    assert rows(cut_figures(cut)) == rows(document_figures(docs))


def test_a_catchup_caches_no_documents(spark, folder, documents, monkeypatch):
    def refuse(*args):
        raise AssertionError("persisted")

    docs, lake = documents(chain(6)), Lake(spark, folder("lake"))
    monkeypatch.setattr(type(docs), "persist", refuse)
    assert ingest.catchup(docs, lake, observed_at=STAMP) == (0, 5)
    assert rows(lake.read("blocks"), "height") == [(h,) for h in range(6)]
    assert not [n for n in storage.child_names(spark, storage.shared_dir(spark))
                if n.startswith("catchup-staged")]


def test_rows_by_txid_and_streams_send_hashes_as_bytes(spark, folder):
    one = spark.createDataFrame(
        [("00ff", [("ab", 1), None], "Text"), ("x", None, None)],
        "txid string, inputs array<struct<h: string, n: int>>, address string")
    dealt = distribution._dealt(one, "txid", 3)
    exchange = [line for line in dealt._jdf.queryExecution().optimizedPlan().toString().split("\n")
                if "Repartition" in line]
    assert len(exchange) == 1 and "unhex" not in exchange[0]
    below = dealt._jdf.queryExecution().optimizedPlan().toString().split("Repartition")[1]
    assert "unhex" in below
    assert rows(dealt) == rows(one)
    want = one.select("txid", (F.expr("pmod(hash(txid), 3)")).alias("at"))
    assert rows(dealt.select("txid", F.spark_partition_id().alias("at"))) == rows(want)
    topic = folder("topic")
    storage.make_dirs(spark, topic)
    messages = spark.readStream.schema("value STRING").json(topic)
    plan = ingest.deduplicated(messages, KINDS["tx_out"])._jdf.queryExecution().analyzed().toString()
    assert "unhex" in plan.split("DeduplicateWithinWatermark")[1]
