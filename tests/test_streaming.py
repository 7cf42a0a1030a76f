import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from ledgerloom.operators.dedupe import dedupe_identity
from ledgerloom.operators.normalize import document_messages
from ledgerloom.schemas import KINDS
from ledgerloom.sources import topics
from ledgerloom.sources.documents import stream_documents, write_documents
from ledgerloom.sources.lake import Lake
from ledgerloom.streaming import ingest
from ledgerloom.streaming.cooldown import start_alerts
from ledgerloom.streaming.gaps import start_sequence_gaps
from tests.conftest import STAMP, chain, rows
from tests.test_operators import checks_frame, random_checks, simulate_alerts


@pytest.fixture
def env(spark, folder):
    class Env:
        root, checkpoint, lake = folder("topics"), folder("checkpoint"), Lake(spark, folder("lake"))

        def publish(self, docs):
            topics.publish(document_messages(docs, STAMP), self.root)

        def drain(self, **kw):
            ingest.drain(ingest.start_raw_ingest(spark, self.root, self.lake, self.checkpoint,
                                                 available_now=True, **kw))

        def counts(self):
            return {t: self.lake.read(t).count() for t in KINDS}
    return Env()


def test_ingest_resumes_where_it_stopped(env, documents):
    docs = chain(6)
    env.publish(documents(docs[:4]))
    env.drain()
    assert env.counts() == dict.fromkeys(KINDS, 4)
    env.publish(documents(docs[4:]))
    env.drain()
    env.drain()
    assert env.counts() == dict.fromkeys(KINDS, 6)


def test_batches_obey_the_file_budget(spark, env, documents):
    for d in chain(3):
        env.publish(documents([d]))
    env.drain(files_per_batch=1)
    batches = env.lake.scan("blocks").select("ingest_batch").distinct().count()
    assert batches == 3 and env.counts()["blocks"] == 3


def test_repeated_batch_leaves_no_copies(spark, env, documents):
    def crash(table, batch):
        raise RuntimeError("stopped before the commit")

    env.publish(documents(chain(5)))
    with pytest.raises(StreamingQueryException):
        env.drain(after_append=crash)
    env.drain()
    assert env.counts() == dict.fromkeys(KINDS, 5)
    assert env.lake.scan("blocks").select("ingest_batch").distinct().count() == 1


def test_numbers_that_do_not_fit_are_set_aside(spark, env, documents):
    docs = chain(3)
    docs[1]["version"] = 4294967295
    env.publish(documents(docs))
    env.drain()
    assert env.counts()["blocks"] == 2 and env.counts()["transactions"] == 3
    kept = spark.read.parquet(ingest.quarantine_dir(env.lake))
    assert rows(kept.select("table_name", "reason")) == [("blocks", "number too large")]


def test_damaged_messages_are_set_aside(spark, env, documents):
    env.publish(documents(chain(3)))
    bad = spark.createDataFrame(
        [("btc.blocks.v1", "k", "{nope"), ("btc.blocks.v1", "k", '{"height": 1}'),
         ("btc.tx_inputs.v1", "k", '{"txid": 5, "sequence": "x"}')],
        "topic string, key string, value string")
    topics.publish(bad, env.root)
    env.drain()
    assert env.counts() == dict.fromkeys(KINDS, 3)
    kept = spark.read.parquet(ingest.quarantine_dir(env.lake))
    assert rows(kept.select("table_name", "value")) == sorted([
        ("blocks", "{nope"), ("blocks", '{"height": 1}'),
        ("tx_in", '{"txid": 5, "sequence": "x"}')])


def test_documents_stream_into_topics(spark, folder, documents):
    docs, root = folder("docs"), folder("topics")
    write_documents(documents(chain(4)), docs)
    ingest.start_publish(stream_documents(spark, docs), root, folder("cp"),
                         available_now=True).awaitTermination()
    assert rows(topics.read_topics(spark, root).groupBy("topic").count(), "count") == [(4,)] * 4


@pytest.mark.parametrize("last, overlap, published", [(-1, 0, 6), (3, 2, 4), (5, 0, 0), (2, 100, 6)])
def test_catchup_ranges(spark, folder, documents, last, overlap, published):
    lake = Lake(spark, folder("lake"))
    span = ingest.catchup(documents(chain(6)), lake, last=last, overlap=overlap, observed_at=STAMP)
    assert lake.read("blocks").count() == published
    assert span == ((max(0, last - overlap + 1), 5) if published else None)
    if published:
        assert {r.source_seq for r in lake.read("blocks").collect()} == {-1}


def test_overlap_is_removed_by_the_identity_dedupe(spark, folder, documents):
    lake, docs = Lake(spark, folder("lake")), documents(chain(9))
    ingest.catchup(docs.where("height <= 5"), lake, observed_at=STAMP, batch_id="one")
    assert ingest.catchup(docs, lake, overlap=3, observed_at=STAMP, batch_id="two") == (3, 8)
    for table in KINDS:
        stored = lake.read(table)
        assert (stored.count(), dedupe_identity(stored, table).count()) == (12, 9)


def test_retention(spark):
    df = spark.sql("SELECT id, timestampadd(HOUR, -12 * id, TIMESTAMP_NTZ'2024-02-01') AS ts "
                   "FROM range(40)")
    kept = ingest.retained(df, "ts", F.expr("TIMESTAMP_NTZ'2024-02-01'"))
    assert kept.count() == 15


def test_field_checks(spark, env, documents):
    env.publish(documents(chain(2)))
    leak = spark.createDataFrame([("btc.tx_outputs.v1", "k", '{"hashPrevOut": "x"}')],
                                 "topic string, key string, value string")
    topics.publish(leak, env.root)
    messages = topics.read_topics(spark, env.root)
    leaked = topics.leaked_fields(messages, {"btc.tx_outputs.v1": ["hashPrevOut"]})
    assert rows(leaked) == [("btc.tx_outputs.v1", 3, "hashPrevOut", 1)]
    lacking = topics.missing_fields(messages, {"btc.tx_outputs.v1": ["txid"],
                                               "btc.blocks.v1": ["txid"]})
    assert rows(lacking, "topic", "missing") == [("btc.blocks.v1", 2), ("btc.tx_outputs.v1", 1)]


def test_unknown_topics_are_not_routed(spark):
    m = spark.createDataFrame([("btc.blocks.v1", "v"), ("other", "v")], "topic string, value string")
    assert rows(topics.with_table(m), "table_name") == [("blocks",)]


def test_gaps_across_batches(spark, folder):
    src, out, cp = folder("src"), folder("out"), folder("cp")
    for numbers in ([0, 1, 5], [6, 9], [20]):
        spark.createDataFrame([(n,) for n in numbers], "seq bigint").coalesce(1).write.mode(
            "append").parquet(src)
        stream = spark.readStream.schema("seq bigint").parquet(src)
        start_sequence_gaps(spark, stream, out, cp, available_now=True).awaitTermination()
    assert rows(spark.read.parquet(out).drop("batch")) == sorted(
        [(2, 5, 3), (7, 9, 2), (10, 20, 10)], key=lambda r: tuple(map(str, r)))


def test_streamed_alerts_remember_the_last_one(spark, folder):
    checks = random_checks(9, 250)
    src, out, cp = folder("src"), folder("out"), folder("cp")
    for lo, hi in ((0, 1500), (1500, 2200), (2200, 6000)):
        part = [c for c in checks if lo <= c[1] < hi]
        checks_frame(spark, part).write.mode("append").parquet(src)
        stream = spark.readStream.schema("service int, status string, ts timestamp_ntz").parquet(src)
        start_alerts(spark, stream, out, cp, available_now=True).awaitTermination()
    got = spark.read.schema("service int, run bigint").parquet(out)
    assert sorted(rows(got, "service", "run")) == simulate_alerts(checks)
