"""Whole blocks, whatever the order, number and size of the portions they arrive in."""

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.conform import conform
from ledgerloom.operators.normalize import document_figures, document_messages, normalize
from ledgerloom.plans import flat
from ledgerloom.schemas import KINDS, TOPIC_FIGURES
from ledgerloom.sources import topics
from ledgerloom.sources.completeness import block_states, whole_blocks
from ledgerloom.sources.lake import Lake
from ledgerloom.streaming import ingest
from tests.conftest import STAMP, block, mint, pay, rows, spend, tx


def busy_chain(n):
    """Blocks of three transactions with several inputs and outputs."""
    out = []
    for h in range(n):
        txs = [tx(f"c{h}", [mint()], [pay(0, "50.0", f"a{h}")]),
               tx(f"d{h}", [spend(f"c{h}"), spend(f"x{h}", 3)], [pay(k, "1.5") for k in range(4)]),
               tx(f"e{h}", [], [])]
        out.append(block(h, txs, prev=f"b{h - 1}" if h else None))
    return out


@pytest.fixture
def lake(spark, folder):
    return Lake(spark, folder("lake"))


def store(lake, documents, docs, batch, where=None, figures=True):
    frames = normalize(documents(docs), STAMP)
    if figures:
        lake.expect(document_figures(documents(docs)), batch)
    for table, frame in frames.items():
        frame = frame if where is None else frame.where(where.get(table, "true"))
        lake.append(table, conform(frame, KINDS[table]), batch)


def states(lake):
    return {r.block_hash: r.state for r in block_states(lake).collect()}


def test_figures_of_documents_are_those_of_stored_rows(lake, documents):
    docs = busy_chain(3)
    store(lake, documents, docs, "one")
    told = {(r.block_hash, r.table_name): (r.rows, r.digest)
            for r in document_figures(documents(docs)).collect()}
    for table in KINDS:
        for r in lake.arrivals(table).collect():
            assert told[r.block_hash, table] == (r.rows, r.digest)
    assert set(states(lake).values()) == {"whole"}


def test_messages_carry_the_same_figures(spark, folder, documents):
    docs, root = documents(busy_chain(3)), folder("topics")
    topics.publish(document_messages(docs, STAMP, figures=True), root)
    sent = topics.read_topic(spark, root, TOPIC_FIGURES)
    assert rows(topics.decode_figures(sent)) == rows(document_figures(docs))
    assert topics.read_topics(spark, root).where(F.col("topic") == TOPIC_FIGURES).isEmpty()


def test_a_missing_output_keeps_its_block_short(lake, documents):
    store(lake, documents, busy_chain(4), "one", {"tx_out": "not (txid = 'd2' and indexOut = 3)"})
    assert states(lake) == {"b0": "whole", "b1": "whole", "b2": "short", "b3": "whole"}
    assert rows(whole_blocks(lake), "block_hash") == [("b0",), ("b1",), ("b3",)]


def test_copies_do_not_stand_in_for_missing_records(lake, documents):
    half = {"tx_out": "indexOut < 2"}
    store(lake, documents, busy_chain(2), "one", half)
    store(lake, documents, busy_chain(2), "two", half)
    assert set(states(lake).values()) == {"copies"} and whole_blocks(lake).isEmpty()
    store(lake, documents, busy_chain(1), "three", {"tx_out": "indexOut >= 2"})
    assert rows(whole_blocks(lake)) == [("b0", 0, False)]
    assert whole_blocks(lake, but=whole_blocks(lake)).isEmpty()


def test_a_batch_written_again_is_counted_again(lake, documents):
    docs = busy_chain(2)
    store(lake, documents, docs, "one", {"transactions": "txid != 'e1'"})
    assert states(lake) == {"b0": "whole", "b1": "short"}
    store(lake, documents, docs, "one")
    assert set(states(lake).values()) == {"whole"}
    store(lake, documents, docs, "two")
    lake.compact("tx_out", "g1")
    assert lake.counts_at_heights([1]).where("table_name = 'tx_out'").first().row_count == 10
    assert rows(whole_blocks(lake), "block_hash") == [("b0",), ("b1",)]


def test_blocks_nobody_counted_pass_when_every_table_has_some(lake, documents):
    store(lake, documents, busy_chain(3), "one", {"tx_in": "block_height != 1"}, figures=False)
    assert states(lake) == {"b0": "whole", "b1": "short", "b2": "whole"}


def test_blocks_are_built_when_they_are_whole_in_any_order(spark, folder, lake, documents):
    docs, made = busy_chain(6), flat.FlatTable(spark, folder("flat"), range_width=4, band_width=2)
    store(lake, documents, docs[3:], "upper", {"tx_out": "height != 4"})
    assert flat.build_incremental(lake, made) == (3, 5)
    assert rows(made.read().select("block_height").distinct()) == [(3,), (5,)]
    store(lake, documents, docs[:3], "lower")
    assert flat.build_incremental(lake, made) == (0, 2)
    store(lake, documents, [docs[4]], "rest", dict.fromkeys(
        ("blocks", "transactions", "tx_in"), "false"))
    assert flat.build_incremental(lake, made) == (4, 4)
    lo, hi = flat.build_incremental(lake, made)
    assert lo > hi and made.read().count() == 18
    assert {r.output_count for r in made.read().where("txid like 'd%'").collect()} == {4}


def test_a_build_that_was_not_noted_is_done_again_without_copies(spark, folder, lake, documents):
    made = flat.FlatTable(spark, folder("flat"))
    store(lake, documents, busy_chain(3), "one")
    made.note_built = lambda blocks: None
    flat.build_incremental(lake, made)
    assert flat.build_incremental(lake, made) == (0, 2) and made.read().count() == 9


def test_a_compaction_during_a_build(spark, folder, lake, documents, monkeypatch):
    made = flat.FlatTable(spark, folder("flat"))
    store(lake, documents, busy_chain(3), "one")
    store(lake, documents, busy_chain(6)[3:], "two")
    only, calls = flat._only, []

    def compact_first(*args):
        if not calls:
            calls.append(lake.compact("tx_out", "g1"))
        frames = only(args[0], flat._stored(lake, between=(0, 5), at={
            t: ["one", "two"] for t in KINDS}), *args[2:]) if len(calls) == 1 else only(*args)
        calls.append(None)
        return frames

    monkeypatch.setattr(flat, "_only", compact_first)
    assert flat.build_incremental(lake, made) == (0, 5)
    assert {r.output_count for r in made.read().where("txid like 'd%'").collect()} == {4}


def test_a_stream_tells_its_lake_what_is_whole(spark, folder, lake, documents):
    root, checkpoint, docs = folder("topics"), folder("cp"), documents(busy_chain(4))
    messages = document_messages(docs, STAMP, figures=True)
    late = (F.col("topic") == KINDS["tx_in"].topic) & F.col("key").startswith("d1")
    for part, want in ((~late, ["b0", "b2", "b3"]), (late, ["b0", "b1", "b2", "b3"])):
        topics.publish(messages.where(part), root)
        ingest.drain(ingest.start_raw_ingest(spark, root, lake, checkpoint, available_now=True))
        assert rows(whole_blocks(lake), "block_hash") == [(b,) for b in want]


def test_catchup_starts_below_the_first_unfinished_block(lake, documents):
    docs = busy_chain(9)
    store(lake, documents, docs[:7], "one", {"tx_out": "height != 3"})
    assert ingest.catchup(documents(docs), lake, overlap=2, observed_at=STAMP) == (1, 8)
    assert rows(whole_blocks(lake), "height") == [(h,) for h in range(9)]
    assert ingest.catchup(documents(docs), lake, overlap=2, observed_at=STAMP) == (7, 8)


def test_height_ranges_name_the_batches_that_hold_them(lake, documents):
    docs = busy_chain(20)
    for k in range(4):
        store(lake, documents, docs[5 * k:5 * k + 5], f"b{k}")
    part = lake.read("tx_out", between=(6, 12))
    files = {r.f for r in part.select(F.input_file_name().alias("f")).collect()}
    assert rows(part.select("height").distinct()) == sorted(
        [(h,) for h in range(6, 13)], key=lambda r: str(r[0]))
    assert {f.split("ingest_batch=")[1].split("/")[0] for f in files} == {"b1", "b2"}
    assert "ingest_batch#" in part._jdf.queryExecution().executedPlan().toString().split(
        "PartitionFilters: [")[1].split("]")[0]
    assert lake.read("tx_out", between=(50, 60)).isEmpty()


def test_counts_at_heights_read_no_records(lake, documents):
    store(lake, documents, busy_chain(5), "one")
    found = lake.counts_at_heights([1, 3, 77])
    assert rows(found) == [("blocks", 2), ("transactions", 6), ("tx_in", 6), ("tx_out", 10)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "_figures" in plan and "scriptSig" not in plan and "height_bucket=" not in plan
