"""The status log: replays, compactions and restarts cannot take a status back."""

import pytest

from ledgerloom import storage
from ledgerloom.operators.conform import conform
from ledgerloom.operators.normalize import normalize
from ledgerloom.plans import finality
from ledgerloom.schemas import KINDS
from ledgerloom.sources.lake import Lake
from tests.conftest import STAMP, chain, rows
from tests.test_lake import events


@pytest.fixture
def lake(spark, folder, documents):
    made = Lake(spark, folder("lake"))
    blocks = conform(normalize(documents(chain(8)), STAMP).blocks, KINDS["blocks"])
    made.append("blocks", blocks.where("height < 4"), "s-000000000")
    made.append("blocks", blocks.where("height >= 4"), "s-000000001")
    made.blocks = blocks
    return made


def status(lake):
    found = {r.block_hash: r.finality_status for r in lake.read("blocks").collect()}
    assert lake.read("blocks").count() == 8
    return "".join(found[f"b{h}"][0] for h in range(8))


def reorg(spark, *names):
    return events(spark, *[("reorg", n, "REORGED") for n in names])


def test_a_batch_appended_again_keeps_its_statuses(spark, lake):
    finality.apply_finality(lake, reorg(spark, "b1", "b5"))
    lake.append("blocks", lake.blocks.where("height < 4"), "s-000000000")
    lake.append("blocks", lake.blocks.where("height >= 4"), "s-000000001")
    assert status(lake) == "OROOOROO"


def test_the_newest_batch_of_a_stream_is_left_to_the_log(spark, lake):
    finality.apply_finality(lake, reorg(spark, "b1", "b5"))
    stored = {r.block_hash: r.finality_status for r in lake.scan("blocks").collect()}
    assert (stored["b1"], stored["b5"]) == ("REORGED", "OBSERVED")


def test_compaction_during_an_update(spark, lake):
    swap_in = lake._swap_in

    def compact_first(*args):
        lake.compact("blocks", "g1")
        swap_in(*args)

    lake._swap_in = compact_first
    finality.apply_finality(lake, reorg(spark, "b1", "b5"))
    assert status(lake) == "OROOOROO"


def test_an_update_during_a_compaction(spark, lake):
    foldable, calls = lake._foldable, []

    def update_after_listing(path, everything):
        found = foldable(path, everything)
        if not calls:
            calls.append(1)
            finality.apply_finality(lake, reorg(spark, "b1", "b5"))
        return found

    lake._foldable = update_after_listing
    lake.compact("blocks", "g1")
    assert status(lake) == "OROOOROO"


def test_compaction_folds_statuses_and_log(spark, lake):
    for names in (("b1",), ("b2", "b5")):
        finality.apply_finality(lake, reorg(spark, *names))
    lake.status.append(spark.createDataFrame([("b3", "CONFIRMED", 9)], "block_hash string, "
                                             "finality_status string, offset bigint"), "late")
    assert status(lake) == "ORRCOROO"
    lake.compact("blocks", "g1", everything=True)
    stored = {r.block_hash: r.finality_status for r in lake.scan("blocks").collect()}
    assert [stored[f"b{h}"] for h in range(4)] == ["OBSERVED", "REORGED", "REORGED", "CONFIRMED"]
    assert len(lake.status._portions()) == 1 and status(lake) == "ORRCOROO"
    assert rows(lake.status.offsets()) == [("b3", 9)]


def test_a_fold_stopped_half_way_does_no_harm(spark, lake, monkeypatch):
    for names in (("b1",), ("b5",)):
        finality.apply_finality(lake, reorg(spark, *names))
    monkeypatch.setattr("ledgerloom.sources.status.storage.delete", lambda *a: None)
    lake.status.fold("x")
    assert len(lake.status._portions()) == 3 and status(lake) == "OROOOROO"


def test_an_interrupted_swap_is_put_right(spark, lake):
    before, path = status(lake), lake.path("blocks")
    bucket = lake._buckets(path)[0]
    storage.rename(spark, f"{path}/{bucket}", f"{path}/_status-x/{bucket}")
    assert lake.read("blocks").count() < 8
    lake.compact("blocks", "g1")
    assert status(lake) == before


def stream(spark, lake, folder, control, checkpoint):
    source = folder("control")
    control.write.parquet(source)
    finality.start_finality(spark.readStream.schema(control.schema).parquet(source), lake,
                            checkpoint, available_now=True).awaitTermination()


def test_offsets_outlive_a_checkpoint(spark, folder, lake):
    both = events(spark, ("reorg", "x", "REORGED"), ("finality", "b3", "CONFIRMED"),
                  ("reorg", "b3", "REORGED"), ("unknown", "b4", "REORGED"))
    stream(spark, lake, folder, both.where("offset >= 2"), folder("cp"))
    stream(spark, lake, folder, both.where("offset < 2"), folder("cp"))
    assert status(lake) == "OOOROOOO"
    assert rows(finality.rejected_events(lake), "offset", "reason") == [
        (0, "no such block"), (3, "unknown type")]
    assert rows(finality.applied_offsets(lake)) == [("b3", 2)]


def test_no_raw_folder_changes_for_a_stream(spark, folder, lake):
    names = lambda: sorted(r[0] for r in lake.scan("blocks").selectExpr(
        "_metadata.file_path").distinct().collect())
    before = names()
    stream(spark, lake, folder, reorg(spark, "b1", "b6"), folder("cp"))
    assert names() == before and status(lake) == "OROOOORO"
