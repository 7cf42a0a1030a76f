"""Headline queries at one scale; prints a single JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Each query runs to completion into a sink that discards rows. Stage rates are
records per second over the ledger derived from the given tables.
"""

from __future__ import annotations

import json
import os
import shutil
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerloom.operators import counts  # noqa: E402
from ledgerloom.operators.normalize import document_messages  # noqa: E402
from ledgerloom.plans import finality, flat  # noqa: E402
from ledgerloom.registry import QUERIES  # noqa: E402
from ledgerloom.registry.workspace import Workspace  # noqa: E402
from ledgerloom.schemas import KINDS  # noqa: E402
from ledgerloom.session import build_session  # noqa: E402
from ledgerloom.sources import topics  # noqa: E402
from ledgerloom.streaming import ingest  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = (
    "flat_range", "flat_block", "tx_nested", "tx_output_value", "prevout_join", "dedup_identity",
    "block_record_counts", "chain_breaks", "height_gaps", "count_by_heights", "seq_gaps",
    "alert_cooldown", "norm_transactions", "norm_tx_in", "norm_tx_out", "topic_decode",
    "stream_raw_append", "flat_incremental", "finality_apply", "compact")


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


LATENCY_BLOCKS = 5  # the newest ones, one after the other, as they arrive live


def latencies(spark, ws) -> dict[str, float]:
    """Mean milliseconds for one block at a time: publish, ingest and flat build."""
    docs, tip = ws.documents(), ws.lake().high_water()
    root, checkpoint = ws.new_dir("live-topics"), ws.new_dir("live-checkpoint")
    lake, made = ws.new_lake("live"), flat.FlatTable(spark, ws.new_dir("live-flat"))
    for table, frame in ws.stored().items():
        kept = frame.where(f"{KINDS[table].height_col} <= {tip - LATENCY_BLOCKS - 1}")
        lake.append(table, kept, "load")
    flat.build_incremental(lake, made)
    spent: dict[str, list[float]] = {"publish": [], "ingest": [], "flat": []}
    for height in range(tip - LATENCY_BLOCKS, tip + 1):
        one = docs.where(f"height = {height}")
        spent["publish"].append(timed(lambda: ingest.publish_documents(one, root, "bench")))
        spent["ingest"].append(timed(lambda: ingest.drain(ingest.start_raw_ingest(
            spark, root, lake, checkpoint, available_now=True))))
        spent["flat"].append(timed(lambda: flat.build_incremental(lake, made)))
    # the first round compiles code and is left out
    out = {f"one_block_{k}_ms": round(1000 * sum(v[1:]) / LATENCY_BLOCKS) for k, v in spent.items()}
    return out | {"one_block_ms": out["one_block_publish_ms"] + out["one_block_ingest_ms"]}


def stages(spark) -> dict[str, float]:
    """The pipeline stage by stage: normalise, publish, raw write, counts, flat build, finality."""
    ws = Workspace(spark, SF_DIR)
    docs = ws.documents()
    records = {t: ws.lake().read(t).count() for t in KINDS}
    total, secs = sum(records.values()), {}
    secs["normalise"] = timed(lambda: run(document_messages(docs, "bench")))
    root = ws.new_dir("bench-topics")
    secs["publish"] = timed(lambda: ingest.publish_documents(docs, root, "bench"))
    lake, checkpoint = ws.new_lake("bench"), ws.new_dir("bench-checkpoint")
    secs["raw_write"] = timed(lambda: ingest.drain(ingest.start_raw_ingest(
        spark, root, lake, checkpoint, available_now=True)))
    tip = lake.high_water()
    newest = list(range(tip - 4, tip + 1))
    for label in ("filtered_count_cold", "filtered_count_warm"):
        secs[label] = timed(lambda: lake.counts_at_heights(newest).collect())
    made = flat.FlatTable(spark, ws.new_dir("bench-flat"))
    secs["flat_build"] = timed(lambda: flat.build_incremental(lake, made))
    events = ws.views.control
    applicable = finality.validate_events(events).where("reason = ''").count()
    secs["finality"] = timed(lambda: finality.apply_finality(lake, events))
    blocks = records["blocks"]
    e2e = secs["publish"] + secs["raw_write"]
    out = {f"{k}_sec": round(v, 3) for k, v in secs.items()}
    out.update({
        "records": total, "blocks": blocks,
        "normalise_rec_per_sec": round(counts.throughput(total, secs["normalise"] * 1000)),
        "publish_rec_per_sec": round(counts.throughput(total, secs["publish"] * 1000)),
        "raw_write_rec_per_sec": round(counts.throughput(total, secs["raw_write"] * 1000)),
        "end_to_end_rec_per_sec": round(counts.throughput(total, e2e * 1000)),
        "bulk_end_to_end_ms_per_block": round(e2e * 1000 / blocks, 3),
        "flat_tx_per_sec": round(records["transactions"] / secs["flat_build"]),
        "finality_events_per_sec": round(applicable / secs["finality"]),
    })
    out.update(latencies(spark, ws))
    out["headroom_vs_600s_blocks"] = round(counts.headroom(600_000, out["one_block_ms"]))
    return out


def main() -> None:
    shared = tempfile.mkdtemp(prefix="ledgerloom-bench-")
    spark = build_session("bench", f"local[{CPUS}]", {
        "spark.checkpoint.dir": shared,
        "spark.sql.shuffle.partitions": CPUS, "spark.driver.memory": "16g",
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    ws = Workspace(spark, SF_DIR)
    setup = {"documents": timed(ws.documents_dir), "topics": timed(ws.topics_dir),
             "lake": timed(ws.lake)}
    secs = {}
    for name in HEADLINE:
        secs[name] = round(timed(lambda: run(QUERIES[name](spark, SF_DIR))), 3)
        print(f"{name} {secs[name]}", file=sys.stderr, flush=True)
    pipeline = stages(spark)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(secs.values()), 3), "unit": "sec",
        "queries": secs, "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1], "pipeline": pipeline,
        "setup_sec": {k: round(v, 3) for k, v in setup.items()}}))
    spark.stop()
    shutil.rmtree(shared, ignore_errors=True)


if __name__ == "__main__":
    main()
