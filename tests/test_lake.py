from pyspark.sql import functions as F

from ledgerloom import storage
from ledgerloom.operators.conform import conform
from ledgerloom.operators.normalize import LedgerFrames, normalize
from ledgerloom.plans import finality
from ledgerloom.schemas import BATCH_COL, KINDS
from ledgerloom.sources import catalog, history
from ledgerloom.sources.lake import Lake, overwrite_by
from tests.conftest import STAMP, chain, rows


def load(spark, folder, documents, n=30, batches=3):
    lake = Lake(spark, folder("lake"))
    frames = normalize(documents(chain(n)), STAMP)
    for table, frame in frames.items():
        height = F.col(KINDS[table].height_col)
        for i in range(batches):
            lake.append(table, conform(frame.where(height % batches == i), KINDS[table]), f"b{i}")
    return lake


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_append_is_idempotent_per_batch(spark, folder, documents):
    lake = Lake(spark, folder("lake"))
    blocks = conform(normalize(documents(chain(8)), STAMP).blocks, KINDS["blocks"])
    assert lake.high_water() == -1
    lake.append("blocks", blocks, "one")
    lake.append("blocks", blocks, "one")
    assert lake.read("blocks").count() == 8 and lake.high_water() == 7
    lake.append("blocks", blocks, "two")
    assert lake.read("blocks").count() == 16


def test_height_reads_prune_folders_and_push_filters(spark, folder, documents):
    lake = load(spark, folder, documents)
    point = lake.read("transactions", heights=[3, 4])
    assert rows(point, "txid") == [("c3",), ("c4",)]
    text = plan(point)
    assert "PartitionFilters: [isnotnull(height_bucket" in text or "height_bucket#" in \
        text.split("PartitionFilters: [")[1].split("]")[0]
    assert "PushedFilters: [In(block_height, [3,4])]" in text
    span = lake.read("transactions", between=(3, 5))
    assert span.count() == 3 and "GreaterThanOrEqual(block_height,3)" in plan(span)
    by_hash = lake.read("blocks").where("block_hash = 'b3'")
    assert "EqualTo(block_hash,b3)" in plan(by_hash) and by_hash.count() == 1


def test_compaction_keeps_rows_and_reduces_files(spark, folder, documents):
    lake = load(spark, folder, documents)
    before = rows(lake.read("tx_out"))
    files = lake.compact("tx_out", "g1")
    assert rows(lake.read("tx_out")) == before
    assert files["files_after"] < files["files_before"]
    assert {r[0] for r in lake.scan("tx_out").select(BATCH_COL).distinct().collect()} == {
        "compacted-g1"}


def test_compaction_leaves_older_generations_alone(spark, folder, documents):
    lake = load(spark, folder, documents)
    lake.compact("blocks", "g1")
    old = {r.f for r in lake.scan("blocks").select(F.input_file_name().alias("f")).collect()}
    more = conform(normalize(documents(chain(40)[30:]), STAMP).blocks, KINDS["blocks"])
    lake.append("blocks", more, "late")
    lake.compact("blocks", "g2")
    new = {r.f for r in lake.scan("blocks").select(F.input_file_name().alias("f")).collect()}
    assert old < new and lake.read("blocks").count() == 40
    lake.compact("blocks", "g3", everything=True)
    assert {r[0] for r in lake.scan("blocks").select(BATCH_COL).distinct().collect()} == {
        "compacted-g3"}
    assert lake.read("blocks").count() == 40


def test_compaction_stopped_after_a_swap_is_finished(spark, folder, documents):
    lake = load(spark, folder, documents)
    before, path = rows(lake.read("blocks")), lake.path("blocks")
    lake.compact("blocks", "g1")
    bucket = next(n for n in storage.child_names(spark, path) if n.startswith("height_bucket="))
    spark.range(3).write.parquet(f"{path}/_replaced-g1/{bucket}/ingest_batch=b0")
    lake.compact("blocks", "g2")
    assert rows(lake.read("blocks")) == before


def test_interrupted_compaction_is_put_right(spark, folder, documents):
    lake = load(spark, folder, documents)
    before, path = rows(lake.read("blocks")), lake.path("blocks")
    name = storage.child_names(spark, path)[0]
    storage.rename(spark, f"{path}/{name}", f"{path}/_replaced-g0/{name}")
    assert lake.read("blocks").count() < len(before)
    lake.compact("blocks", "g1")
    assert rows(lake.read("blocks")) == before
    assert not any(n.startswith("_replaced") for n in storage.child_names(spark, path))


def events(spark, *items):
    data = [(i, t, h, 0, s, "2024-01-01T00:00:00Z") for i, (t, h, s) in enumerate(items)]
    return spark.createDataFrame(
        data, "offset bigint, type string, block_hash string, height bigint, "
              "finality_status string, timestamp string")


def test_event_validation(spark):
    e = events(spark, ("finality", "b1", "CONFIRMED"), ("reorg", "b1", "REORGED"),
               ("unknown", "b1", "CONFIRMED"), ("finality", "b1", "INVALID"), (None, "b1", None))
    assert [r.reason for r in finality.validate_events(e).orderBy("offset").collect()] == [
        "", "", "unknown type", "invalid status", "unknown type"]


def test_finality_touches_only_changed_folders(spark, folder, documents):
    lake = load(spark, folder, documents)
    e = events(spark, ("reorg", "b2", "REORGED"), ("finality", "b2", "CONFIRMED"),
               ("finality", "b2", "INVALID"), ("reorg", "b5", "REORGED"),
               ("finality", "nowhere", "CONFIRMED"))
    old = {r.f for r in lake.scan("blocks").select(F.input_file_name().alias("f")).collect()}
    before = rows(lake.read("blocks").drop("finality_status"))
    finality.apply_finality(lake, e)
    new = {r.f for r in lake.scan("blocks").select(F.input_file_name().alias("f")).collect()}
    assert 1 <= len(new - old) <= 2
    status = {r.block_hash: r.finality_status for r in lake.read("blocks").collect()}
    assert (status["b2"], status["b5"], status["b1"]) == ("CONFIRMED", "REORGED", "OBSERVED")
    assert rows(lake.read("blocks").drop("finality_status")) == before
    finality.apply_finality(lake, e)
    again = {r.f for r in lake.scan("blocks").select(F.input_file_name().alias("f")).collect()}
    assert again == new
    assert rows(finality.unmatched_events(e, lake.read("blocks")), "block_hash") == [("nowhere",)]


def test_transitions_may_be_enforced(spark, folder, documents):
    lake = load(spark, folder, documents)
    finality.apply_finality(lake, events(spark, ("reorg", "b2", "REORGED")))
    back = events(spark, ("finality", "b2", "CONFIRMED"))
    finality.apply_finality(lake, back, enforce_transitions=True)
    status = lambda: lake.read("blocks").where("block_hash = 'b2'").first().finality_status
    assert status() == "REORGED"
    finality.apply_finality(lake, back)
    assert status() == "CONFIRMED"


def test_catalog_round_trip(spark, folder, documents):
    lake = load(spark, folder, documents, n=5)
    name = "ledger_test"
    catalog.create_tables(spark, lake, name)
    catalog.create_tables(spark, lake, name)
    assert catalog.read_table(spark, name, "blocks").count() == 5
    assert catalog.identity_key(spark, name, "tx_in") == ["txid", "hashPrevOut", "indexPrevOut"]
    described = {(r.table_name, r.column_name): r.data_type
                 for r in catalog.describe(spark, name).collect()}
    assert described[("tx_in", "indexPrevOut")] == "bigint"
    assert described[("blocks", "block_timestamp")] == "timestamp_ntz"
    catalog.create_tables(spark, lake, name, drop=True)
    assert catalog.read_table(spark, name, "tx_out").count() == 5
    catalog.drop_schema(spark, name)


def test_history_round_trip(spark, folder, documents):
    frames = normalize(documents(chain(6)), STAMP)
    dump, lake = folder("dump"), Lake(spark, folder("lake"))
    history.write_history(frames, dump)
    history.backfill(spark, dump, lake, STAMP)
    history.backfill(spark, dump, lake, STAMP)
    for table, frame in frames.items():
        want = conform(frame, KINDS[table])
        got = lake.read(table)
        if table == "blocks":
            want = want.withColumn("finality_status", F.lit("CONFIRMED"))
        assert rows(got) == rows(want), table


def test_overwrite_leaves_other_partitions(spark, folder):
    path = folder("parts")
    overwrite_by(spark.range(10).withColumn("p", F.col("id") % 2), path, ["p"])
    overwrite_by(spark.range(100, 102).withColumn("p", F.lit(1)), path, ["p"])
    assert rows(spark.read.parquet(path), "id") == sorted(
        [(i,) for i in (0, 2, 4, 6, 8, 100, 101)], key=lambda r: str(r[0]))


def test_shared_folder_is_required_off_local(spark):
    assert storage.shared_dir(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")


def test_frames_keep_table_order(documents):
    assert [n for n, _ in normalize(documents(chain(1)), STAMP).items()] == list(KINDS)
    assert LedgerFrames.__dataclass_fields__.keys() == KINDS.keys()
