"""Laws of the slot map and places without gaps."""

import random
import zlib
from collections import defaultdict

from ledgerloom import storage
from ledgerloom.llm import sharding
from ledgerloom.llm.common import read


def loads(shard_of, load):
    total = defaultdict(int)
    for s, b in zip(shard_of, load):
        total[s] += b
    return [total[s] for s in range(max(shard_of) + 1)]


def test_rebalancing_evens_out_and_growing_moves_into_the_new_shard_only():
    rng = random.Random(1)
    load = [int(rng.paretovariate(1.3) * 100) for _ in range(2000)]
    even = [k % 7 for k in range(2000)]
    out = loads(sharding.balanced(even, load), load)
    assert max(out) - min(out) <= max(0.002 * sum(load) / 7, max(load) - sum(load) / 7)
    more = sharding.grown(even, load)
    assert all(a == b or b == 7 for a, b in zip(even, more))
    assert abs(loads(more, load)[7] - sum(load) / 8) < 0.1 * sum(load) / 8
    assert sharding.balanced(even, [0] * 2000) == even


def test_versions_are_kept(spark):
    m = sharding.SlotMap.create(spark, storage.new_dir(spark, "map"), 3, 64)
    assert m.rebalance([1] * 63 + [40]) == 1 and m.grow() == 2
    assert m.versions() == [0, 1, 2]
    assert m.shard_of(0) == [k % 3 for k in range(64)]
    assert max(m.shard_of()) == 3 and max(m.shard_of(1)) == 2


def places(spark, docs, shards=5):
    rows = sharding.sized(docs)
    m = sharding.SlotMap.create(spark, storage.new_dir(spark, "map"), shards)
    m.rebalance(sharding.bytes_per_slot(rows))
    return sharding.placed(rows, m.read()).collect(), m


def gapless(rows):
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())


def test_given_table(spark):
    docs = read(spark, "/root/testdata/sf0.01", "documents")
    rows, m = places(spark, docs)
    texts = {r.doc_id: (r.text or "").encode() for r in docs.collect()}
    gapless(rows)
    assert {(r.doc_id, r.size, r.text_crc32) for r in rows} == {
        (i, len(t) + 8, zlib.crc32(t)) for i, t in texts.items()}
    size = defaultdict(int)
    for r in rows:
        size[r.shard] += r.size
    assert max(size.values()) - min(size.values()) < 0.01 * sum(size.values()) / 5
    assigned = sharding.assign(docs, m.read()).select("doc_id", "shard").collect()
    assert {tuple(r) for r in assigned} == {(r.doc_id, r.shard) for r in rows}


def test_awkward_rows(spark, hard, nothing, monkeypatch):
    rows, _ = places(spark, hard, 2)
    assert len(rows) == 12
    gapless(rows)
    assert {(r.size, r.text_crc32) for r in rows if r.doc_id in (2, 3)} == {(8, 0)}
    assert places(spark, nothing)[0] == []
    monkeypatch.setattr(sharding, "RUN", 7)
    many = spark.createDataFrame([(1, "same")] * 50 + [(2, "x")], "doc_id long, text string")
    rows, _ = places(spark, many, 2)
    assert len(rows) == 51
    gapless(rows)
