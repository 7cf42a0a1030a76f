import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.conform import conform
from ledgerloom.operators.normalize import LedgerFrames, normalize
from ledgerloom.plans import finality, flat
from ledgerloom.schemas import FLAT, KINDS
from ledgerloom.sources.lake import Lake
from tests.conftest import STAMP, block, chain, mint, pay, rows, spend, tx
from tests.test_lake import events


@pytest.fixture
def lake_of(spark, folder, documents):
    def make(docs):
        lake = Lake(spark, folder("lake"))
        add(lake, docs, "first")
        return lake

    def add(lake, docs, batch):
        for table, frame in normalize(documents(docs), STAMP).items():
            lake.append(table, conform(frame, KINDS[table]), batch)
    make.add = add
    return make


def frames(lake):
    return LedgerFrames(**{t: lake.read(t) for t in KINDS})


DOCS = [block(0, [tx("a", [mint()], [pay(0, "50", "x")])]),
        block(1, [tx("b", [mint("01")], [pay(1, "2", "y"), pay(0, "1")]),
                  tx("c", [spend("b", 1), spend("a", 0)],
                     [pay(2, "0.3"), pay(0, "0.1", "p"), pay(1, "0.2")]),
                  tx("d", [], [])], prev="b0")]


def test_rows_arrays_and_totals(lake_of):
    out = flat.build_flat(frames(lake_of(DOCS)))
    assert out.schema.simpleString() == FLAT.simpleString()
    got = {r.txid: r for r in out.collect()}
    c = got["c"]
    assert (c.input_count, c.output_count, c.total_output_value) == (2, 3, 60000000)
    assert [i.hashPrevOut for i in c.inputs] == ["a", "b"]
    assert [o.indexOut for o in c.outputs] == [0, 1, 2]
    assert [o.value for o in c.outputs] == [10000000, 20000000, 30000000]
    d = got["d"]
    assert (d.input_count, d.inputs, d.output_count, d.outputs, d.total_output_value) == (
        0, None, 0, None, 0)


def test_coinbase_sentinel_fits(lake_of):
    r = flat.build_flat(frames(lake_of(DOCS))).where("txid = 'a'").first()
    assert r.inputs[0].indexPrevOut == 4294967295


def test_fanout_form_inflates_the_sum(lake_of):
    out = {r.txid: r for r in flat.fanout_counts(frames(lake_of(DOCS))).collect()}
    c = out["c"]
    assert (c.joined_rows, c.input_count, c.output_count, c.inflated_value) == (6, 2, 3, 120000000)
    assert (out["d"].joined_rows, out["d"].inflated_value) == (1, 0)


def test_reorged_and_unknown_status_stay_out(spark, lake_of):
    f = frames(lake_of(chain(4)))
    status = F.when(F.col("height") == 1, "REORGED").when(F.col("height") != 2, "CONFIRMED")
    out = flat.build_flat(LedgerFrames(f.blocks.withColumn("finality_status", status),
                                       f.transactions, f.tx_in, f.tx_out))
    assert rows(out, "block_height") == [(0,), (3,)]


def test_height_bounds_reach_all_four_scans(lake_of):
    lake = lake_of(chain(9))
    out = flat.build_flat(frames(lake), 2, 4)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    executed = out._jdf.queryExecution().executedPlan().toString()
    assert executed.count("PushedFilters: [IsNotNull(") >= 4 and plan.count(" >= 2)") == 4
    assert "Cartesian" not in executed and "NestedLoop" not in executed
    assert rows(out, "block_height") == [(2,), (3,), (4,)]


def test_replays_count_double_unless_deduplicated(lake_of):
    lake = lake_of(DOCS)
    lake_of.add(lake, DOCS, "again")
    twice = flat.build_flat(frames(lake)).where("txid = 'c'")
    assert {r.input_count for r in twice.collect()} == {4}
    once = {r.txid: r for r in flat.build_flat(frames(lake), dedup=True).collect()}
    assert len(once) == 4 and once["c"].total_output_value == 60000000


def test_competing_blocks_keep_their_own_children(lake_of):
    shared = tx("s", [spend("a")], [pay(0, "1")])
    lake = lake_of([block(1, [shared], name="left"), block(1, [shared], name="right")])
    assert {r.output_count for r in flat.build_flat(frames(lake)).collect()} == {2}
    apart = flat.build_flat(frames(lake), dedup=True)
    assert rows(apart, "block_hash", "output_count") == [("left", 1), ("right", 1)]


def test_incremental_adds_only_new_heights(spark, folder, lake_of):
    lake, made = lake_of(chain(5)), flat.FlatTable(spark, folder("flat"))
    assert flat.build_incremental(lake, made) == (0, 4)
    lake_of.add(lake, chain(8)[5:], "second")
    assert flat.build_incremental(lake, made) == (5, 7)
    lo, hi = flat.build_incremental(lake, made)
    assert lo > hi and made.read().count() == 8 and made.max_height() == 7
    assert rows(made.read(3, 4), "block_height") == [(3,), (4,)]


def test_range_folders_are_pruned(spark, folder, lake_of):
    made = flat.FlatTable(spark, folder("flat"), range_width=4, band_width=2)
    flat.build_incremental(lake_of(chain(12)), made)
    part = made.read(4, 7)
    scan = part._jdf.queryExecution().executedPlan().toString()
    assert "(height_range#" in scan.split("PartitionFilters: [")[1].split("]")[0]
    assert part.count() == 4


def test_single_block_build_replaces_its_rows(spark, folder, lake_of):
    lake, made = lake_of(chain(3)), flat.FlatTable(spark, folder("flat"))
    flat.build_incremental(lake, made)
    finality.apply_finality(lake, events(spark, ("finality", "b1", "CONFIRMED")))
    flat.build_block(lake, made, 1)
    assert rows(made.read(), "block_height", "finality_status") == [
        (0, "OBSERVED"), (1, "CONFIRMED"), (2, "OBSERVED")]


def test_stale_rows_remain_by_default_and_follow_on_request(spark, folder, lake_of):
    lake = lake_of(chain(6))
    made = flat.FlatTable(spark, folder("flat"), range_width=4, band_width=2)
    finality.apply_finality(lake, events(spark, ("reorg", "b0", "REORGED")))
    flat.build_incremental(lake, made)
    assert rows(made.read(), "block_height") == [(h,) for h in range(1, 6)]
    finality.apply_finality(lake, events(
        spark, ("finality", "b0", "CONFIRMED"), ("reorg", "b2", "REORGED"),
        ("reorg", "b3", "REORGED"), ("finality", "b4", "CONFIRMED")))
    flat.build_incremental(lake, made)
    assert rows(made.read(), "block_height") == [(h,) for h in range(1, 6)]
    flat.build_incremental(lake, made, refresh_status=True)
    assert rows(made.read(), "block_height", "finality_status") == [
        (0, "CONFIRMED"), (1, "OBSERVED"), (4, "CONFIRMED"), (5, "OBSERVED")]
