import json

import pytest
from pyspark.sql import functions as F

from ledgerloom import functions as L
from ledgerloom.operators.conform import conform, decode, schema_drift
from ledgerloom.operators.normalize import document_messages, normalize, to_messages
from ledgerloom.schemas import KINDS, TABLE_OF_TOPIC
from ledgerloom.sources.documents import parse_documents
from tests.conftest import STAMP, block, chain, mint, pay, rows, spend, to_line, tx

ZEROS = "0" * 64


def first_real_payment():
    """A block with a coinbase and one payment of 10 and 40 coins."""
    return block(170, [
        tx("mint170", [mint("04ffff001d0102")], [pay(0, "50.00000000")]),
        tx("pay170", [spend("0437cd7f")], [pay(0, "10.00000000", "alice"),
                                           pay(1, "40.00000000", "bob")]),
    ], prev="b169", time=1231731025)


def test_genesis(documents):
    doc = block(0, [tx("t0", [mint("04ffff")], [pay(0, "50.00000000")])], nonce=2083236893)
    f = normalize(documents([doc]), STAMP)
    assert [x.count() for _, x in f.items()] == [1, 1, 1, 1]
    b = f.blocks.first()
    assert (b.hashPrev, b.nBits, b.nNonce) == (ZEROS, 486604799, 2083236893)
    assert (b.block_timestamp, b.finality_status) == ("2009-01-03 18:15:05", "OBSERVED")
    assert (b.schema_version, b.source_seq, b.observed_at) == (1, None, STAMP)
    assert b.observed_at == b.ingested_at
    i = f.tx_in.first()
    assert (i.hashPrevOut, i.indexPrevOut, i.scriptSig) == (ZEROS, 4294967295, "04ffff")
    o = f.tx_out.first()
    assert (o.value, o.address) == (5000000000, "")


def test_first_payment(documents):
    f = normalize(documents([first_real_payment()]), STAMP, source_seq=5)
    assert [x.count() for _, x in f.items()] == [1, 2, 2, 3]
    assert sorted(r.value for r in f.tx_out.collect()) == [1000000000, 4000000000, 5000000000]
    assert f.blocks.first().source_seq == 5
    assert f.blocks.first().hashPrev == "b169"
    assert rows(f.tx_in.where("hashPrevOut <> repeat('0', 64)"), "txid", "hashPrevOut",
                "indexPrevOut", "scriptSig") == [("pay170", "0437cd7f", 0, "ab")]
    assert rows(f.tx_out.where("address <> ''"), "address") == [("alice",), ("bob",)]


def test_many_transactions(documents):
    txs = [tx("cb", [mint()], [pay(0, "6.25", "miner")])]
    txs += [tx(f"t{i}", [spend(f"p{i}"), spend(f"q{i}", 1)],
               [pay(0, "0.5", "x"), pay(1, "0.3", "y"), pay(2, "0.1")]) for i in range(1, 50)]
    f = normalize(documents([block(200000, txs, prev="p", bits="17034219")]), STAMP)
    assert [x.count() for _, x in f.items()] == [1, 50, 99, 148]
    assert f.blocks.first().nBits == int("17034219", 16)


def test_absent_and_null_fields_take_defaults(documents):
    doc = block(5, [tx("t", [spend("p", 3, script=None)], [pay(0, "0", script=None)])])
    doc["previousblockhash"] = None
    f = normalize(documents([doc]), STAMP)
    assert f.blocks.first().hashPrev == ZEROS
    assert f.tx_in.first().scriptSig == ""
    assert tuple(f.tx_out.select("value", "scriptPubKey", "address").first()) == (0, "", "")


@pytest.mark.parametrize("coins, satoshis", [
    ("50.0", 5000000000), ("0.001", 100000), ("1e-08", 1), ("0", 0),
    ("21000000", 2100000000000000), ("0.1", 10000000), ("0.2", 20000000), ("0.3", 30000000),
    ("1.23456789", 123456789), ("25", 2500000000), ("12.5", 1250000000), ("6.25", 625000000),
    ("3.125", 312500000), ("0.123456789", 12345678)])
def test_coins_are_exact(spark, documents, coins, satoshis):
    assert spark.range(1).select(L.text_to_satoshis(F.lit(coins))).first()[0] == satoshis
    f = normalize(documents([block(1, [tx("t", [mint()], [pay(0, coins)])])]), STAMP)
    assert f.tx_out.first().value == satoshis


def test_one_pass_messages_equal_frames(documents):
    docs = documents([first_real_payment(), *chain(3)])
    one_pass, by_frame = document_messages(docs, STAMP), to_messages(normalize(docs, STAMP))
    assert rows(one_pass) == rows(by_frame)
    keys = {r.topic: r.key for r in one_pass.where("value like '%pay170%'").orderBy("key").collect()}
    assert keys["btc.tx_inputs.v1"] == "pay170:0437cd7f:0"
    assert keys["btc.tx_outputs.v1"] == "pay170:1"
    block_value = json.loads(one_pass.where("key = 'b170'").first().value)
    assert "source_seq" in block_value and block_value["schema_version"] == 1


def test_messages_round_trip_to_tables(documents):
    docs = documents([first_real_payment()])
    frames, messages = normalize(docs, STAMP), document_messages(docs, STAMP)
    for topic, table in TABLE_OF_TOPIC.items():
        kind = KINDS[table]
        back = conform(decode(messages.where(F.col("topic") == topic), kind), kind)
        assert back.schema.fieldNames() == kind.columns
        assert rows(back) == rows(conform(getattr(frames, table), kind))


def test_unreadable_documents_are_kept_apart(spark):
    good = to_line(chain(1)[0])
    lines = spark.createDataFrame([(good,), (good[:40],), ("[]",), ('{"height": 3}',)], "value string")
    parsed = parse_documents(lines)
    assert parsed.where("_corrupt is null").count() == 1
    assert sorted(r[0] for r in parsed.where("_corrupt is not null").select("_corrupt").collect()) \
        == sorted([good[:40], "[]", '{"height": 3}'])


def test_conform_orders_fills_drops(spark):
    kind = KINDS["transactions"]
    df = spark.createDataFrame([(7, "x", 4294967295, "2024-01-01T00:00:00Z")],
                               "fee int, txid string, lockTime bigint, block_timestamp string")
    r = conform(df, kind).first()
    assert list(r.asDict()) == kind.columns
    assert (r.txid, r.lockTime, r.version, str(r.block_timestamp)) == (
        "x", 4294967295, None, "2024-01-01 00:00:00")


def test_conform_refuses_overflow_and_missing_keys(spark):
    kind = KINDS["blocks"]
    big = spark.createDataFrame([("h", 4294967295)], "block_hash string, height bigint")
    with pytest.raises(Exception, match="does not fit"):
        conform(big, kind).collect()
    assert conform(big, kind, wrap_unsigned=True).first().height == -1
    with pytest.raises(Exception, match="required"):
        conform(spark.createDataFrame([(None, 1)], "block_hash string, height bigint"), kind).collect()


def test_schema_drift(spark):
    made = spark.createDataFrame([("t", "a"), ("t", "x")], "table_name string, field string")
    want = spark.createDataFrame([("t", "a"), ("t", "b")], "table_name string, field string")
    assert rows(schema_drift(made, want)) == [("t", "b", "not produced"), ("t", "x", "not declared")]


@pytest.mark.parametrize("text, parsed", [
    ("2024-05-01T10:00:00Z", "2024-05-01 10:00:00"),
    ("2024-05-01T10:00:00+00:00", "2024-05-01 10:00:00"),
    ("2024-05-01 10:00:00", "2024-05-01 10:00:00"),
    ("2024-05-01T10:00:00+02:00", "2024-05-01 08:00:00"),
    ("2024-05-01T10:00:00-05:30", "2024-05-01 15:30:00"),
    ("2024-05-01", "2024-05-01 00:00:00"), ("soon", None), (None, None)])
def test_iso_times(spark, text, parsed):
    df = spark.createDataFrame([(text,)], "t string")
    got = df.select(L.parse_iso_timestamp("t")).first()[0]
    assert (str(got) if got else None) == parsed


def test_scalars_do_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        r = spark.sql("SELECT 1710054000 AS e").select(
            L.wire_timestamp(L.utc_wall_clock("e")).alias("t"), L.ingest_stamp().alias("s")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert r.t == "2024-03-10 07:00:00"
    assert len(r.s) == len("2024-01-01T00:00:00.000000+00:00")


def test_notification_decoding(spark):
    df = spark.createDataFrame([(bytes.fromhex("00ffe0"), (4076863488).to_bytes(4, "little"))],
                               "body binary, seq binary")
    h, n = L.decode_notify("body", "seq")
    assert tuple(df.select(h, n).first()) == ("00ffe0", 4076863488)


def test_small_scalars(spark):
    r = spark.range(1).select(
        L.short_hash(F.lit("a" * 64)), L.wrap_uint32(F.lit(2147483648)),
        L.wrap_uint32(F.lit(5)), L.composite_key(F.lit("t"), F.lit(4294967295)),
        L.compact_target(F.lit("ffffffff")),
        L.progress_percent(F.lit(1000), F.lit(0), F.lit(1999))).first()
    assert tuple(r) == ("a" * 16 + "...", -2147483648, 5, "t:4294967295", 4294967295, 50.0)
