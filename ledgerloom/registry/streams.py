"""Streaming ingest, replay, incremental builds and stored updates."""

from __future__ import annotations

import contextlib
import uuid

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.conform import conform
from ledgerloom.operators.dedupe import dedupe_identity
from ledgerloom.operators.normalize import (
    LedgerFrames,
    document_figures,
    document_messages,
    to_messages,
)
from ledgerloom.plans import distribution, finality, flat
from ledgerloom.registry.relations import ALERTS, SEQ_GAPS
from ledgerloom.registry.scans import FLAT_LIGHT, flat_light
from ledgerloom.registry.sql import ledger, print_of, summary_of
from ledgerloom.registry.workspace import (
    Workspace,
    fingerprint,
    summary,
    wire_frames,
)
from ledgerloom.schemas import BATCH_COL, KINDS
from ledgerloom.sources import history, topics
from ledgerloom.sources.documents import parse_documents, stream_documents
from ledgerloom.sources.lake import Lake
from ledgerloom.sources.views import SEEN_AT
from ledgerloom.streaming import ingest
from ledgerloom.streaming.cooldown import start_alerts
from ledgerloom.streaming.gaps import start_sequence_gaps


def _frames(lake: Lake) -> LedgerFrames:
    return LedgerFrames(**{t: lake.read(t) for t in KINDS})


def _drain(ws: Workspace, root: str, lake: Lake, checkpoint: str) -> None:
    ingest.drain(ingest.start_raw_ingest(ws.spark, root, lake, checkpoint, available_now=True,
                                         files_per_batch=ingest.FILES_PER_BATCH))


def publish_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Documents read as a stream and published; every record key arrives."""
    ws = Workspace(spark, sf)
    root = ws.new_dir("topics")
    ingest.start_publish(stream_documents(spark, ws.documents_dir()), root,
                         ws.new_dir("checkpoint"), available_now=True).awaitTermination()
    return topics.read_topics(spark, root).groupBy("topic").agg(
        F.count_distinct("key").alias("distinct_keys"))


def stream_raw_append(spark: SparkSession, sf: str) -> DataFrame:
    ws = Workspace(spark, sf)
    lake = ws.new_lake("stream")
    _drain(ws, ws.topics_dir(), lake, ws.new_dir("checkpoint"))
    return summary(_frames(lake))


def _crash(table: str, batch_id: int) -> None:
    raise RuntimeError(f"{table}: stopped after batch {batch_id} was appended")


def _drain_and_crash(ws: Workspace, root: str, lake: Lake, checkpoint: str) -> None:
    """Every query stops between the append and the commit of its first batch."""
    started = ingest.start_raw_ingest(ws.spark, root, lake, checkpoint, available_now=True,
                                      after_append=_crash)
    for query in started.values():
        with contextlib.suppress(StreamingQueryException):
            query.awaitTermination()


def stream_replay_safe(spark: SparkSession, sf: str) -> DataFrame:
    """A batch of every topic is appended a second time after a crash."""
    ws = Workspace(spark, sf)
    lake, checkpoint = ws.new_lake("replay"), ws.new_dir("checkpoint")
    _drain_and_crash(ws, ws.topics_dir(), lake, checkpoint)
    _drain(ws, ws.topics_dir(), lake, checkpoint)
    return summary(_frames(lake))


def compact_then_replay(spark: SparkSession, sf: str) -> DataFrame:
    """The tables are compacted between a crash and the repeated batch."""
    ws = Workspace(spark, sf)
    lake, checkpoint = ws.new_lake("replay"), ws.new_dir("checkpoint")
    _drain_and_crash(ws, ws.topics_dir(), lake, checkpoint)
    for table in KINDS:
        lake.compact(table, "1")
    _drain(ws, ws.topics_dir(), lake, checkpoint)
    return summary(_frames(lake))


def compact_while_ingesting(spark: SparkSession, sf: str) -> DataFrame:
    """A batch arrives between the listing of a compaction and its swap."""
    ws = Workspace(spark, sf)
    lake, outs, tip = ws.new_lake("meanwhile"), ws.stored().tx_out, ws.lake().high_water()
    lake.append("tx_out", outs.where(F.col("height") <= tip // 2), "first")
    listed = lake._foldable(lake.path("tx_out"), False)
    lake.append("tx_out", outs.where(F.col("height") > tip // 2), "second")
    lake._foldable = lambda path, everything: listed
    lake.compact("tx_out", "1")
    return lake.read("tx_out").agg(
        F.count("*").alias("row_count"),
        fingerprint(["txid", "indexOut", "value", "address"]).alias("fingerprint"))


def stream_second_checkpoint(spark: SparkSession, sf: str) -> DataFrame:
    """Two ingests into one lake, each with a checkpoint of its own."""
    ws = Workspace(spark, sf)
    lake, tip = ws.new_lake("second"), ws.lake().high_water()
    for lo, hi in ((0, tip // 2), (tip // 2 + 1, tip)):
        root = ws.new_dir("topics")
        _publish_heights(ws, root, lo, hi)
        _drain(ws, root, lake, ws.new_dir("checkpoint"))
    return summary(_frames(lake))


def dedup_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Heights published twice around a seam; the stream drops the copies."""
    ws = Workspace(spark, sf)
    root, tip = ws.new_dir("topics"), ws.lake().high_water()
    _publish_heights(ws, root, 0, tip // 2 + 10)
    _publish_heights(ws, root, tip // 2 - 10, tip)
    out = {}
    for table, kind in KINDS.items():
        path = ws.new_dir(f"once-{table}")
        source = topics.stream_topic(spark, root, kind.topic, ingest.FILES_PER_BATCH)
        (ingest.deduplicated(source, kind).writeStream.format("parquet")
         .option("compression", "zstd")
         .option("checkpointLocation", ws.new_dir("checkpoint")).option("path", path)
         .trigger(availableNow=True).start().awaitTermination())
        out[table] = conform(spark.read.parquet(path), kind)
    return _keys(LedgerFrames(**out))


def _publish_heights(ws: Workspace, root: str, lo: int, hi: int) -> None:
    topics.publish(to_messages(wire_frames(_between(ws.stored(), lo, hi))), root)


def stream_resume(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs over one checkpoint; the second sees only what was published in between."""
    ws = Workspace(spark, sf)
    root, lake, checkpoint = ws.new_dir("topics"), ws.new_lake("resume"), ws.new_dir("checkpoint")
    tip = ws.lake().high_water()
    _publish_heights(ws, root, 0, tip // 2)
    _drain(ws, root, lake, checkpoint)
    _publish_heights(ws, root, tip // 2 + 1, tip)
    _drain(ws, root, lake, checkpoint)
    return summary(_frames(lake))


def catchup_range(spark: SparkSession, sf: str) -> DataFrame:
    """A lake that stopped twenty heights below the tip catches up with an overlap of ten."""
    ws = Workspace(spark, sf)
    lake, docs = ws.new_lake("catchup"), ws.documents()
    tip = ws.tip()
    ingest.catchup(docs.where(F.col("height") <= tip - 20), lake, last=-1,
                   observed_at=SEEN_AT, batch_id="first")
    ingest.catchup(docs, lake, overlap=10, observed_at=SEEN_AT, batch_id="second")
    out = None
    for table, kind in KINDS.items():
        twice = (lake.scan(table).groupBy(kind.height_col)
                 .agg(F.count_distinct(BATCH_COL).alias("batches")))
        seam = twice.agg(F.count_if(F.col("batches") > 1).alias("replayed_heights"),
                         F.max(kind.height_col).cast("bigint").alias("top_height"))
        once = (dedupe_identity(lake.read(table), table)
                .agg(F.count("*").alias("distinct_rows")).scalar())
        part = seam.select(F.lit(table).alias("table_name"), "replayed_heights",
                           once.alias("distinct_rows"), "top_height")
        out = part if out is None else out.unionByName(part)
    return out


def _keys(frames: LedgerFrames) -> DataFrame:
    """(table_name, row_count, fingerprint) of the four tables' identity keys."""
    out = None
    for table, frame in frames.items():
        part = frame.agg(F.count("*").alias("row_count"),
                         fingerprint(KINDS[table].key).alias("fingerprint")).select(
            F.lit(table).alias("table_name"), "row_count", "fingerprint")
        out = part if out is None else out.unionByName(part)
    return out


def _once(lake: Lake) -> DataFrame:
    return _keys(LedgerFrames(**{t: dedupe_identity(lake.read(t), t) for t in KINDS}))


def catchup_repeated(spark: SparkSession, sf: str) -> DataFrame:
    """Two catch-ups with their defaults; the second leaves what the first stored."""
    ws = Workspace(spark, sf)
    lake, docs = ws.new_lake("repeated"), ws.documents()
    tip = ws.tip()
    ingest.catchup(docs.where(F.col("height") <= tip // 2), lake, observed_at=SEEN_AT)
    ingest.catchup(docs, lake, observed_at=SEEN_AT)
    return _once(lake)


def catchup_after_failure(spark: SparkSession, sf: str) -> DataFrame:
    """A catch-up that stored all blocks and half the outputs is done again."""
    ws = Workspace(spark, sf)
    lake, tip = ws.new_lake("failed"), ws.lake().high_water()
    for table, frame in ws.stored().items():
        upto = tip if table == "blocks" else tip // 2
        lake.append(table, frame.where(F.col(KINDS[table].height_col) <= upto), "broken-off")
    ingest.catchup(ws.documents(), lake, observed_at=SEEN_AT)
    return _once(lake)


def backfill_two_dumps(spark: SparkSession, sf: str) -> DataFrame:
    """Two dumps one after the other, and the first of them once more."""
    ws = Workspace(spark, sf)
    lake, tip = ws.new_lake("dumps"), ws.lake().high_water()
    roots = []
    for lo, hi in ((0, tip // 2), (tip // 2 + 1, tip)):
        root = ws.new_dir("dump")
        history.write_history(_between(ws.stored(), lo, hi), root)
        history.backfill(spark, root, lake, SEEN_AT)
        roots.append(root)
    history.backfill(spark, roots[0], lake, SEEN_AT)
    return summary(_frames(lake))


def _between(frames: LedgerFrames, lo: int, hi: int) -> LedgerFrames:
    return LedgerFrames(**{t: f.where(F.col(KINDS[t].height_col).between(lo, hi))
                           for t, f in frames.items()})


def flat_incremental_overlap(spark: SparkSession, sf: str) -> DataFrame:
    """Records of ten heights are stored twice before the second build."""
    ws = Workspace(spark, sf)
    lake, made = ws.new_lake("overlap"), flat.FlatTable(spark, ws.new_dir("flat"))
    tip = ws.lake().high_water()
    lake.expect(document_figures(ws.documents()), "publisher")
    lake.append_all(_between(ws.stored(), 0, tip - 50), "first")
    flat.build_incremental(lake, made)
    lake.append_all(_between(ws.stored(), tip - 59, tip), "second")
    lake.append_all(_between(ws.stored(), tip - 9, tip), "third")
    flat.build_incremental(lake, made)
    return flat_light(made.read())


def flat_with_late_outputs(spark: SparkSession, sf: str) -> DataFrame:
    """Outputs that lag behind the other tables hold the build back."""
    ws = Workspace(spark, sf)
    lake, made = ws.new_lake("late"), flat.FlatTable(spark, ws.new_dir("flat"))
    tip = ws.lake().high_water()
    lake.expect(document_figures(ws.documents()), "publisher")
    for table, frame in ws.stored().items():
        upto = tip - 30 if table == "tx_out" else tip
        lake.append(table, frame.where(F.col(KINDS[table].height_col) <= upto), "first")
    flat.build_incremental(lake, made)
    lake.append("tx_out", ws.stored().tx_out.where(F.col("height") > tip - 30), "second")
    flat.build_incremental(lake, made)
    return flat_light(made.read())


def flat_out_of_order(spark: SparkSession, sf: str) -> DataFrame:
    """The upper half of the chain arrives first, and a fifth of all outputs last.

    Each portion is drained and built; nothing is built short, and all of it in the end.
    """
    ws = Workspace(spark, sf)
    root, lake, checkpoint = ws.new_dir("topics"), ws.new_lake("disorder"), ws.new_dir("checkpoint")
    made, tip = flat.FlatTable(spark, ws.new_dir("flat")), ws.tip()
    docs, upper = ws.documents(), F.col("height") > tip // 2
    late = (F.col("topic") == KINDS["tx_out"].topic) & (F.crc32("key") % 5 == 0)
    # a message has the height of its document
    for part, portion in ((docs.where(upper), ~late), (docs.where(~upper), ~late), (docs, late)):
        messages = document_messages(part, SEEN_AT, figures=True)
        topics.publish(messages.where(portion), root)
        _drain(ws, root, lake, checkpoint)
        lake.set_status(ws.views.blocks)
        flat.build_incremental(lake, made)
    return flat_light(made.read())


def flat_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """Built to fifty heights below the tip, brought up to date, and once more with no effect."""
    ws = Workspace(spark, sf)
    made = flat.FlatTable(spark, ws.new_dir("flat"))
    flat.build_range(ws.lake(), made, 0, ws.lake().high_water() - 50)
    flat.build_incremental(ws.lake(), made)
    flat.build_incremental(ws.lake(), made)
    return flat_light(made.read())


def flat_by_txid(spark: SparkSession, sf: str) -> DataFrame:
    """Flat rows and raw outputs, both distributed by txid, meet without a shuffle."""
    ws, name = Workspace(spark, sf), f"by_txid_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE SCHEMA {name} LOCATION '{ws.new_dir('schema')}'")
    frames = ws.stored()
    rows = distribution.save_distributed(flat.build_flat(frames, dedup=True), f"{name}.flat",
                                         ws.new_dir("flat-by-txid"))
    outs = distribution.save_distributed(frames.tx_out, f"{name}.tx_out", ws.new_dir("out-by-txid"))
    stored = outs.groupBy("txid").agg(F.count("*").alias("stored_outputs"),
                                      F.sum("value").alias("stored_value"))
    return rows.join(stored, "txid", "left").select(
        "txid", F.col("block_height").cast("bigint").alias("block_height"),
        F.col("output_count").cast("bigint").alias("output_count"), "total_output_value",
        F.coalesce("stored_outputs", F.lit(0)).alias("stored_outputs"),
        F.coalesce("stored_value", F.lit(0)).alias("stored_value"))


def flat_refresh_status(spark: SparkSession, sf: str) -> DataFrame:
    """Control events change stored blocks; the flat table follows when asked to."""
    ws = Workspace(spark, sf)
    lake, made = ws.new_lake("refresh"), flat.FlatTable(spark, ws.new_dir("flat"), band_width=200)
    lake.expect(document_figures(ws.documents()), "publisher")
    lake.append_all(ws.stored(), "load")
    flat.build_incremental(lake, made)
    finality.apply_finality(lake, ws.views.control)
    flat.build_incremental(lake, made, refresh_status=True)
    return flat_light(made.read())


def finality_apply(spark: SparkSession, sf: str) -> DataFrame:
    """Events applied twice; the second time changes nothing."""
    ws = Workspace(spark, sf)
    lake = ws.new_lake("finality")
    lake.append("blocks", ws.stored().blocks, "load")
    finality.apply_finality(lake, ws.views.control)
    finality.apply_finality(lake, ws.views.control)
    return lake.read("blocks").select(
        F.col("height").cast("bigint").alias("height"), "block_hash", "nNonce", "finality_status")


def _finality_streamed(ws: Workspace) -> Lake:
    """Control events arriving in three portions, each drained by a restarted query."""
    spark, lake = ws.spark, ws.new_lake("finality")
    lake.append("blocks", ws.stored().blocks, "load")
    arrived, checkpoint, control = ws.new_dir("control"), ws.new_dir("checkpoint"), ws.views.control
    top = control.agg(F.max("offset")).first()[0]
    for i in range(3):
        lo, hi = (top * i // 3 if i else -1), top * (i + 1) // 3
        control.where((F.col("offset") > lo) & (F.col("offset") <= hi)).write.mode(
            "append").parquet(arrived)
        source = spark.readStream.schema(control.schema).parquet(arrived)
        finality.start_finality(source, lake, checkpoint, available_now=True).awaitTermination()
    return lake


def finality_stream(spark: SparkSession, sf: str) -> DataFrame:
    lake = _finality_streamed(Workspace(spark, sf))
    return lake.read("blocks").select(
        F.col("height").cast("bigint").alias("height"), "block_hash", "nNonce", "finality_status")


def _statuses(lake: Lake) -> DataFrame:
    return lake.read("blocks").select(
        F.col("height").cast("bigint").alias("height"), "block_hash", "nNonce", "finality_status")


def _apply_control(ws: Workspace, lake: Lake, control: DataFrame, checkpoint: str) -> None:
    arrived = ws.new_dir("control")
    control.write.parquet(arrived)
    source = ws.spark.readStream.schema(control.schema).parquet(arrived)
    finality.start_finality(source, lake, checkpoint, available_now=True).awaitTermination()


def finality_two_checkpoints(spark: SparkSession, sf: str) -> DataFrame:
    """The newer half of the events comes first; the older half under a checkpoint of its own."""
    ws = Workspace(spark, sf)
    lake, control = ws.new_lake("finality"), ws.views.control
    lake.append("blocks", ws.stored().blocks, "load")
    middle = control.agg(F.max("offset")).first()[0] // 2
    for part in (control.where(F.col("offset") > middle), control.where(F.col("offset") <= middle)):
        _apply_control(ws, lake, part, ws.new_dir("checkpoint"))
    return _statuses(lake)


def replay_after_finality(spark: SparkSession, sf: str) -> DataFrame:
    """Blocks are appended, changed by events, and appended again as after a crash.

    Statuses are applied both ways, as a stream and by copy-on-write.
    """
    ws = Workspace(spark, sf)
    lake, checkpoint, control = ws.new_lake("replay"), ws.new_dir("checkpoint"), ws.views.control
    _drain_and_crash(ws, ws.topics_dir(), lake, checkpoint)
    middle = control.agg(F.max("offset")).first()[0] // 2
    _apply_control(ws, lake, control.where(F.col("offset") <= middle), ws.new_dir("checkpoint"))
    finality.apply_finality(lake, control.where(F.col("offset") > middle))
    _drain(ws, ws.topics_dir(), lake, checkpoint)
    return _statuses(lake)


def compact_during_update(spark: SparkSession, sf: str) -> DataFrame:
    """A compaction runs between the staging of a status update and its swap."""
    ws = Workspace(spark, sf)
    lake, blocks, tip = ws.new_lake("during"), ws.stored().blocks, ws.lake().high_water()
    lake.append("blocks", blocks.where(F.col("height") <= tip // 2), "first")
    lake.append("blocks", blocks.where(F.col("height") > tip // 2), "second")
    swap_in = lake._swap_in

    def compact_first(*args: str) -> None:
        lake.compact("blocks", "1")
        swap_in(*args)

    lake._swap_in = compact_first
    finality.apply_finality(lake, ws.views.control)
    return _statuses(lake)


def finality_rejects(spark: SparkSession, sf: str) -> DataFrame:
    lake = _finality_streamed(Workspace(spark, sf))
    return finality.rejected_events(lake).groupBy("reason").agg(F.count("*").alias("events"))


def quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Every 50th block is damaged, as a document and as a message; the rest goes through."""
    ws = Workspace(spark, sf)
    cut = lambda c: F.substring(c, 1, 60)
    lines = ws.documents().select("height", F.to_json(F.struct("*")).alias("line")).select(
        F.when(F.col("height") % 50 == 7, cut("line")).otherwise(F.col("line")).alias("value"))
    parsed = parse_documents(lines)
    good_docs = parsed.where(F.col("_corrupt").isNull() & (F.col("slice") == 0)).select("hash")
    bad_docs = parsed.where(F.col("_corrupt").isNotNull()).select("_corrupt").distinct()

    root, lake = ws.new_dir("topics"), ws.new_lake("quarantine")
    frames = wire_frames(ws.stored())
    messages = to_messages(frames).where(F.col("topic") == KINDS["blocks"].topic)
    height = F.get_json_object("value", "$.height").cast("int")
    damaged = messages.withColumn(
        "value", F.when(height % 50 == 7, cut("value")).otherwise(F.col("value")))
    topics.publish(damaged, root)
    query = ingest.start_raw_ingest(spark, root, lake, ws.new_dir("checkpoint"),
                                    available_now=True, tables=("blocks",))
    ingest.drain(query)
    stored = lake.read("blocks").agg(F.count("*").alias("n"), fingerprint(["block_hash"]).alias("f"))
    aside = spark.read.parquet(ingest.quarantine_dir(lake)).agg(
        F.count("*").alias("n"), fingerprint(["table_name"]).alias("f"))

    def row(label: str, df: DataFrame) -> DataFrame:
        return df.select(F.lit(label).alias("outcome"), F.col("n").alias("row_count"),
                         F.col("f").alias("fingerprint"))

    def of(df: DataFrame, column: str) -> DataFrame:
        return df.agg(F.count("*").alias("n"), fingerprint([column]).alias("f"))

    return (row("documents read", of(good_docs, "hash"))
            .unionByName(row("documents unreadable", of(
                bad_docs.select(F.lit("blocks").alias("t")), "t")))
            .unionByName(row("messages stored", stored))
            .unionByName(row("messages set aside", aside)))


def quarantine_topics(spark: SparkSession, sf: str) -> DataFrame:
    """Every message of every 50th height is cut short, in all four topics."""
    ws = Workspace(spark, sf)
    root, lake = ws.new_dir("topics"), ws.new_lake("quarantine")
    messages = to_messages(wire_frames(ws.stored()))
    height = F.coalesce(F.get_json_object("value", "$.height"),
                        F.get_json_object("value", "$.block_height")).cast("int")
    topics.publish(messages.withColumn("value", F.when(
        height % 50 == 7, F.substring("value", 1, 30)).otherwise(F.col("value"))), root)
    _drain(ws, root, lake, ws.new_dir("checkpoint"))
    aside = spark.read.parquet(ingest.quarantine_dir(lake)).groupBy("table_name").agg(
        F.count("*").alias("set_aside"))
    return _keys(_frames(lake)).join(aside, "table_name", "left").select(
        "table_name", "row_count", "fingerprint",
        F.coalesce("set_aside", F.lit(0)).alias("set_aside"))


def seq_gaps_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Notifications arriving in four portions, each drained by a restarted query."""
    ws = Workspace(spark, sf)
    arrived, out = ws.new_dir("notify"), ws.new_dir("gaps")
    notes = ws.views.notifications
    top = notes.agg(F.max("seq")).first()[0]
    checkpoint = ws.new_dir("checkpoint")
    for i in range(4):
        lo, hi = (top * i // 4 if i else -1), top * (i + 1) // 4
        notes.where((F.col("seq") > lo) & (F.col("seq") <= hi)).write.mode("append").parquet(arrived)
        source = spark.readStream.schema(notes.schema).parquet(arrived)
        start_sequence_gaps(spark, source, out, checkpoint, available_now=True).awaitTermination()
    return spark.read.parquet(out).select("expected", "seq", "missed")


def seq_gaps_late(spark: SparkSession, sf: str) -> DataFrame:
    """Numbers arrive in no order, some of them twice; late ones close their gaps."""
    ws = Workspace(spark, sf)
    arrived, out, checkpoint = ws.new_dir("notify"), ws.new_dir("gaps"), ws.new_dir("checkpoint")
    notes = ws.views.notifications
    lot = F.crc32(F.col("seq").cast("string"))
    for part in (lot % 3 == 2, lot % 3 == 0, (lot % 3 == 1) | (lot % 6 == 0)):
        notes.where(part).write.mode("append").parquet(arrived)
        source = spark.readStream.schema(notes.schema).parquet(arrived)
        start_sequence_gaps(spark, source, out, checkpoint, available_now=True).awaitTermination()
    return spark.read.parquet(out).select("expected", "seq", "missed")


def alert_cooldown_late(spark: SparkSession, sf: str) -> DataFrame:
    """Runs are split over two arrivals: every tenth check of the first half comes late."""
    ws = Workspace(spark, sf)
    arrived, out, checkpoint = ws.new_dir("health"), ws.new_dir("alerts"), ws.new_dir("checkpoint")
    checks = ws.views.health
    edges = checks.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).first()
    middle = edges.lo + (edges.hi - edges.lo) / 2
    days = (edges.hi - edges.lo).days + 1
    early = F.col("ts") < F.lit(middle).cast("timestamp_ntz")
    tenth = F.crc32(F.col("ts").cast("string")) % 10 == 0
    for part in (early & ~tenth, ~early | tenth):
        checks.where(part).write.mode("append").parquet(arrived)
        source = spark.readStream.schema(checks.schema).parquet(arrived)
        start_alerts(spark, source, out, checkpoint, every=60, available_now=True,
                     lateness=f"{days} days").awaitTermination()
    sent = spark.read.schema("service INT, run BIGINT").parquet(out)
    return sent.select(F.col("service").cast("bigint").alias("service"), "run")


def alert_cooldown_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Check runs arriving by time; the state per service is its last alert."""
    ws = Workspace(spark, sf)
    arrived, out, checkpoint = ws.new_dir("health"), ws.new_dir("alerts"), ws.new_dir("checkpoint")
    checks = ws.views.health
    edges = checks.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).first()
    middle = edges.lo + (edges.hi - edges.lo) / 2
    middle = middle.replace(hour=0, minute=0, second=0, microsecond=0)
    for part in (checks.where(F.col("ts") < F.lit(middle).cast("timestamp_ntz")),
                 checks.where(F.col("ts") >= F.lit(middle).cast("timestamp_ntz"))):
        part.write.mode("append").parquet(arrived)
        source = spark.readStream.schema(checks.schema).parquet(arrived)
        start_alerts(spark, source, out, checkpoint, every=60, available_now=True).awaitTermination()
    sent = spark.read.schema("service INT, run BIGINT").parquet(out)
    return sent.select(F.col("service").cast("bigint").alias("service"), "run")


_ALL = tuple(KINDS)
_SUMMARY = ledger(summary_of(), *_ALL)
_CHANGES = """SELECT block_hash, finality_status AS new_status FROM (
    SELECT *, row_number() OVER (PARTITION BY block_hash ORDER BY "offset" DESC) AS rn FROM control
    WHERE type IN ('finality', 'reorg') AND finality_status IN ('CONFIRMED', 'REORGED')) r
    WHERE rn = 1"""
_AFTER = """SELECT b.height, b.block_hash, b.nNonce,
    coalesce(new_status, finality_status) AS finality_status
    FROM blocks b LEFT JOIN changes c ON c.block_hash = b.block_hash"""
# A line number given twice in one order is one output; of its copies the greatest is kept.
_OUTPUTS_ONCE = """SELECT txid, count(*) AS output_count, CAST(sum(v) AS BIGINT) AS total_output_value
    FROM (SELECT txid, indexOut, max(value) AS v FROM tx_out GROUP BY txid, indexOut) d
    GROUP BY txid"""
_FLAT_ONCE = ledger("""SELECT t.txid, CAST(b.height AS BIGINT) AS block_height,
    coalesce(input_count, 0) AS input_count, coalesce(output_count, 0) AS output_count,
    coalesce(total_output_value, 0) AS total_output_value, b.finality_status
    FROM transactions t JOIN blocks b ON t.hashBlock = b.block_hash
    LEFT JOIN ic ON ic.txid = t.txid LEFT JOIN once ON once.txid = t.txid
    WHERE b.finality_status <> 'REORGED'""", "transactions", "blocks", "ic", "tx_out",
                    once=_OUTPUTS_ONCE)
_KEYS_ONCE = ledger(" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count, {print_of(', '.join(k.key))} AS fingerprint "
    f"FROM (SELECT DISTINCT {', '.join(k.key)} FROM {t}) d{t}" for t, k in KINDS.items()), *_ALL)
QUERIES = {
    f.__name__: f for f in (
        publish_stream, stream_raw_append, stream_replay_safe, stream_resume,
        stream_second_checkpoint, compact_then_replay, compact_while_ingesting, dedup_stream,
        catchup_range, catchup_repeated, catchup_after_failure, backfill_two_dumps,
        flat_incremental, flat_incremental_overlap, flat_with_late_outputs, finality_stream,
        finality_rejects, flat_refresh_status, finality_apply, quarantine, seq_gaps_stream,
        alert_cooldown_stream, flat_out_of_order, finality_two_checkpoints, replay_after_finality,
        compact_during_update, seq_gaps_late, alert_cooldown_late, flat_by_txid,
        quarantine_topics)
}
_STATUSES = ledger("""SELECT CAST(height AS BIGINT) AS height, block_hash, nNonce,
    finality_status FROM after""", "blocks", "control", changes=_CHANGES, after=_AFTER)
ORACLES = {
    "publish_stream": ledger(" UNION ALL ".join(
        f"SELECT '{k.topic}' AS topic, count(*) AS distinct_keys FROM "
        f"(SELECT DISTINCT {', '.join(k.key)} FROM {t}) u" for t, k in KINDS.items()), *_ALL),
    "stream_raw_append": _SUMMARY,
    "stream_replay_safe": _SUMMARY,
    "stream_resume": _SUMMARY,
    "catchup_range": ledger(" UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(DISTINCT {k.height_col}) FILTER "
        f"(WHERE {k.height_col} BETWEEN last - 9 AND last) AS replayed_heights, (SELECT count(*) FROM (SELECT DISTINCT "
        f"{', '.join(k.key)} FROM {t}) u) AS distinct_rows, "
        f"CAST(max({k.height_col}) AS BIGINT) AS top_height FROM {t}, stopped"
        for t, k in KINDS.items()), *_ALL,
        stopped="SELECT max(height) AS last FROM blocks, tip WHERE height <= tip - 20"),
    "stream_second_checkpoint": _SUMMARY,
    "compact_then_replay": _SUMMARY,
    "compact_while_ingesting": ledger(f"""SELECT count(*) AS row_count,
        {print_of('txid, indexOut, value, address')} AS fingerprint FROM tx_out""", "tx_out"),
    "dedup_stream": _KEYS_ONCE,
    "catchup_repeated": _KEYS_ONCE,
    "catchup_after_failure": _KEYS_ONCE,
    "backfill_two_dumps": _SUMMARY,
    "flat_incremental_overlap": _FLAT_ONCE,
    "flat_with_late_outputs": _FLAT_ONCE,
    "finality_stream": ledger("""SELECT CAST(height AS BIGINT) AS height, block_hash, nNonce,
        finality_status FROM after""", "blocks", "control", changes=_CHANGES, after=_AFTER),
    "finality_rejects": ledger("""SELECT reason, count(*) AS events FROM (
        SELECT CASE WHEN type NOT IN ('finality', 'reorg') THEN 'unknown type'
                    WHEN c.finality_status NOT IN ('CONFIRMED', 'REORGED') THEN 'invalid status'
                    WHEN b.block_hash IS NULL THEN 'no such block' END AS reason
        FROM control c LEFT JOIN blocks b ON b.block_hash = c.block_hash) r
        WHERE reason IS NOT NULL GROUP BY reason""", "blocks", "control"),
    "flat_incremental": _FLAT_ONCE,
    "flat_refresh_status": ledger(f"""SELECT t.txid, CAST(a.height AS BIGINT) AS block_height,
        coalesce(input_count, 0) AS input_count, coalesce(output_count, 0) AS output_count,
        coalesce(total_output_value, 0) AS total_output_value, a.finality_status
        FROM transactions t JOIN after a ON t.hashBlock = a.block_hash
        LEFT JOIN ic ON ic.txid = t.txid LEFT JOIN once ON once.txid = t.txid
        WHERE a.finality_status <> 'REORGED'""", "transactions", "blocks", "ic", "tx_out", "control",
        changes=_CHANGES, after=_AFTER, once=_OUTPUTS_ONCE),
    "finality_apply": ledger("""SELECT CAST(height AS BIGINT) AS height, block_hash, nNonce,
        finality_status FROM after""", "blocks", "control", changes=_CHANGES, after=_AFTER),
    "quarantine": ledger(f"""
        SELECT 'documents read' AS outcome, count(*) AS row_count, {print_of('block_hash')}
            AS fingerprint FROM blocks WHERE height % 50 <> 7
        UNION ALL SELECT 'documents unreadable', count(*), {print_of("'blocks'")}
            FROM blocks WHERE height % 50 = 7
        UNION ALL SELECT 'messages stored', count(*), {print_of('block_hash')}
            FROM blocks WHERE height % 50 <> 7
        UNION ALL SELECT 'messages set aside', count(*), {print_of("'blocks'")}
            FROM blocks WHERE height % 50 = 7""", "blocks"),
    "quarantine_topics": ledger(" UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count, {print_of(', '.join(k.key))} "
        f"AS fingerprint, (SELECT count(*) FROM {t} WHERE {k.height_col} % 50 = 7) AS set_aside "
        f"FROM {t} WHERE {k.height_col} % 50 <> 7" for t, k in KINDS.items()), *_ALL),
    "flat_out_of_order": _FLAT_ONCE,
    "flat_by_txid": ledger("""SELECT t.txid, CAST(b.height AS BIGINT) AS block_height,
        coalesce(once.output_count, 0) AS output_count,
        coalesce(once.total_output_value, 0) AS total_output_value,
        coalesce(oc.output_count, 0) AS stored_outputs,
        coalesce(oc.total_output_value, 0) AS stored_value
        FROM transactions t JOIN alive b ON t.hashBlock = b.block_hash
        LEFT JOIN once ON once.txid = t.txid LEFT JOIN oc ON oc.txid = t.txid""",
                           "transactions", "alive", "oc", "tx_out", once=_OUTPUTS_ONCE),
    "finality_two_checkpoints": _STATUSES,
    "replay_after_finality": _STATUSES,
    "compact_during_update": _STATUSES,
    "seq_gaps_late": SEQ_GAPS,
    "alert_cooldown_late": ALERTS,
    "seq_gaps_stream": SEQ_GAPS,
    "alert_cooldown_stream": ALERTS,
}
