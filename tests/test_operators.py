import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerloom.operators import counts, health, sequences, validate
from ledgerloom.operators.broadcasting import broadcast_if_small
from ledgerloom.operators.dedupe import dedupe_identity, keep_latest
from ledgerloom.operators.normalize import document_messages, normalize
from ledgerloom.operators.skew import hot_keys, join_many_to_one
from ledgerloom.schemas import KINDS
from ledgerloom.sources.views import LedgerViews
from ledgerloom.streaming.gaps import sequence_gaps
from tests.conftest import STAMP, block, chain, mint, pay, rows, tx


@pytest.fixture(scope="module")
def skewed(spark):
    """2,000 rows of which one key holds a third and every order value is unique."""
    rng = random.Random(3)
    data = [((1 if i % 3 == 0 else rng.randrange(2, 60)), rng.randrange(40), i, f"v{i}")
            for i in range(2000)]
    return spark.createDataFrame(data, "k bigint, h int, o bigint, v string").cache()


def test_lag_in_key_with_hot_keys(skewed):
    plain = skewed.withColumn("p", F.lag("v").over(Window.partitionBy("k").orderBy("h", "o")))
    split = sequences.lag_in_key(skewed, "k", ["h", "o"], "v", "p", hot_rows=50)
    assert hot_keys(skewed, "k", 50)
    assert rows(plain) == rows(split)


def test_lag_by_number_over_many_bands(spark, skewed):
    plain = skewed.withColumn("p", F.lag("h").over(Window.partitionBy("k").orderBy("o")))
    assert rows(plain) == rows(sequences.lag_by_number(skewed, "o", "h", "p", ["k"], width=7))
    whole = skewed.withColumn("p", F.lag("h").over(Window.orderBy("o")))
    assert rows(whole) == rows(sequences.lag_by_number(skewed, "o", "h", "p", width=64))


def test_running_sum_over_many_bands(skewed):
    w = Window.orderBy("o").rowsBetween(Window.unboundedPreceding, 0)
    plain = skewed.withColumn("s", F.sum("h").over(w))
    assert rows(plain) == rows(sequences.running_sum(skewed, "o", "h", "s", width=33))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_join_around_hot_keys(spark, skewed, how):
    one = spark.createDataFrame([(i, f"n{i}") for i in range(0, 50)], "k bigint, name string")
    many = skewed.union(spark.createDataFrame([(None, 1, -1, "x")], skewed.schema))
    plain = many.join(one, "k", how)
    assert rows(plain) == rows(join_many_to_one(many, one, "k", how, hot_rows=50))


def test_broadcast_needs_a_small_frame(spark):
    def hinted(df):
        return "broadcast" in df._jdf.queryExecution().logical().toString().lower()

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert hinted(broadcast_if_small(spark.range(10), 100))
        assert not hinted(broadcast_if_small(spark.range(101), 100))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_keep_latest_collapses_copies_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, 1), ("a", 2, 3), ("b", 0, 9)],
                               "k string, at int, v int")
    best = keep_latest(df, ["k"], ["at"])
    assert rows(best) == [("a", 2, 3), ("b", 0, 9)]
    assert "partial_max" in best._jdf.queryExecution().executedPlan().toString()


def test_views_with_hot_customers_and_orders(spark):
    sf = "/root/testdata/sf0.001"
    plain, split = LedgerViews(spark, sf), LedgerViews(spark, sf, hot_rows=5)
    for name in ("tx_in", "tx_out"):
        assert rows(getattr(plain, name)) == rows(getattr(split, name))


def test_sequence_gaps(spark):
    def seqs(*xs):
        return spark.createDataFrame([(x,) for x in xs], "seq bigint")

    assert rows(sequence_gaps(seqs(0, 5))) == [(1, 5, 4)]
    assert rows(sequence_gaps(seqs(0, 1))) == []
    assert rows(sequence_gaps(seqs(3))) == []
    assert rows(sequence_gaps(seqs(3), last_seen=0)) == [(1, 3, 2)]
    assert rows(sequence_gaps(seqs(0, 5, 6, 20), width=4)) == [(1, 5, 4), (7, 20, 13)]


def test_chain_breaks_and_gaps(documents):
    docs = chain(6)
    docs[3]["previousblockhash"] = "other"
    del docs[4]
    docs.append(block(2, [], prev="b1", name="b2-rival"))
    blocks = normalize(documents(docs), STAMP).blocks
    assert rows(validate.chain_breaks(blocks), "height", "reason") == [
        (3, "hash mismatch"), (5, "parent missing")]
    assert rows(validate.height_gaps(blocks)) == [(4, 1)]
    assert rows(validate.height_gaps(blocks.where("height > 1"), width=2)) == [(0, 2), (4, 1)]


def test_genesis_must_have_no_parent(documents):
    blocks = normalize(documents([block(0, [], prev="x")]), STAMP).blocks
    assert rows(validate.chain_breaks(blocks), "height", "reason") == [(0, "genesis has a parent")]


def test_block_record_counts_and_averages(documents):
    docs = chain(3) + [block(9, [])]
    per_block = counts.block_record_counts(normalize(documents(docs), STAMP))
    assert rows(per_block) == [(0, 1, 1, 1, 4), (1, 1, 1, 1, 4), (2, 1, 1, 1, 4), (9, 0, 0, 0, 1)]
    r = counts.run_averages(per_block).first()
    assert (r.blocks, r.total_records, r.avg_records) == (4, 13, 3.25)
    assert counts.throughput(500, 250) == 2000 and counts.headroom(600_000, 909) > 660


def test_resolve_prevouts(documents):
    docs = [block(0, [tx("a", [mint()], [pay(0, "1", "x"), pay(1, "2", "y")])]),
            block(1, [tx("b", [{"txid": "a", "vout": 1, "sequence": 1}], [pay(0, "2", "z")]),
                      tx("c", [{"txid": "gone", "vout": 0, "sequence": 1}], [])])]
    f = normalize(documents(docs), STAMP)
    assert rows(validate.resolve_prevouts(f.tx_in, f.tx_out), "txid", "prev_value",
                "prev_address") == [("b", 200000000, "y"), ("c", None, None)]


def test_dedupe_identity_prefers_the_last_ingested(documents):
    f = normalize(documents(chain(2)), STAMP).transactions
    later = f.withColumn("ingested_at", F.lit("2024-02-01T00:00:00+00:00"))
    once = dedupe_identity(f.unionByName(later).unionByName(f), "transactions")
    assert [r[0] for r in rows(once, "ingested_at")] == ["2024-02-01T00:00:00+00:00"] * 2


def test_lag_and_freshness(spark, documents):
    stream = spark.createDataFrame([("a", 1, 5), ("a", 20, 7), ("b", 3, 1)],
                                   "topic_name string, offset bigint, height int")
    committed = spark.createDataFrame([("a", 5)], "topic_name string, committed_offset bigint")
    assert rows(validate.topic_lag(stream, committed)) == [("a", 20, 5, 15, False),
                                                           ("b", 3, -1, 4, True)]
    blocks = normalize(documents(chain(2)), STAMP).blocks.withColumn(
        "block_timestamp", F.col("block_timestamp").cast("timestamp_ntz"))
    at = lambda t: F.expr(f"TIMESTAMP_NTZ'{t}'")
    assert validate.tip_freshness(blocks, at("2009-01-03 18:30:00")).first().fresh
    assert not validate.tip_freshness(blocks, at("2009-01-03 18:55:05")).first().fresh


def test_order_violations(spark):
    stream = spark.createDataFrame([("a", i, h) for i, h in enumerate([1, 2, 2, 1, 5, 4])],
                                   "topic_name string, offset bigint, height int")
    assert rows(validate.order_violations(stream, width=2)) == [("a", 6, 2)]


def simulate_alerts(checks, cooldown=86400):
    """The plain sequential rule, per service in time order."""
    last, out = {}, []
    for service, minute, ok in sorted(checks, key=lambda c: (c[0], c[1])):
        if ok:
            last.pop(service, None)
        elif service not in last or (minute - last[service]) * 60 >= cooldown:
            last[service] = minute
            out.append((service, minute))
    return sorted(out)


def random_checks(seed: int, n: int = 400):
    rng = random.Random(seed)
    cells = {(rng.randrange(3), rng.randrange(6000)) for _ in range(n)}
    return [(s, m, rng.random() < (0.02 if s else 0.5)) for s, m in cells]


def checks_frame(spark, checks):
    df = spark.createDataFrame(checks, "service int, minute bigint, ok boolean")
    at = F.timestamp_add("MINUTE", F.col("minute"), F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"))
    return df.select("service", F.when(F.col("ok"), "ok").otherwise("FAIL").alias("status"),
                     at.alias("ts"))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_alerts_follow_the_sequential_rule(spark, seed):
    checks = random_checks(seed)
    got = rows(health.alerts(checks_frame(spark, checks)))
    assert sorted(got) == simulate_alerts(checks)


def test_run_status(spark):
    checks = [(0, 0, True), (1, 0, True), (0, 1, False), (1, 1, True), (0, 2, False), (1, 2, False)]
    assert rows(health.run_status(checks_frame(spark, checks))) == [
        ("FAIL(1)", 1), ("FAIL(2)", 1), ("OK", 1)]


def test_documents_of_hot_days_and_orders(spark, monkeypatch):
    """Split documents normalise to the same records as whole ones."""
    from ledgerloom.sources import views
    sf = "/root/testdata/sf0.001"
    whole = normalize(LedgerViews(spark, sf).documents(), STAMP)
    monkeypatch.setattr(views, "TXS_PER_DOCUMENT", 1)
    docs = LedgerViews(spark, sf, hot_rows=5).documents().cache()
    assert docs.count() > docs.select("hash").distinct().count()
    assert docs.select(F.explode("tx.piece").alias("piece")).where("piece > 0").count() > 0
    split = normalize(docs, STAMP)
    messages = document_messages(docs, STAMP).groupBy("topic").count()
    sent = {r["topic"]: r["count"] for r in messages.collect()}
    for table, frame in whole.items():
        assert rows(getattr(split, table)) == rows(frame), table
        assert sent[KINDS[table].topic] == frame.count()
