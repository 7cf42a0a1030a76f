"""Best fit against a plain search, and the packed table's invariants."""

import random

from ledgerloom.llm import packing
from ledgerloom.llm.common import read


def plain(pieces, capacity, per_source):
    bins, out = [], [None] * len(pieces)
    for i in sorted(range(len(pieces)), key=lambda k: -pieces[k][0]):
        size, source, cluster = pieces[i]
        fits = [(capacity - sum(pieces[j][0] for j in b), k) for k, b in enumerate(bins)
                if capacity - sum(pieces[j][0] for j in b) >= size
                and all(pieces[j][2] != cluster for j in b)
                and sum(pieces[j][1] == source for j in b) < per_source]
        if fits:
            k = min(fits)[1]
        else:
            bins.append([])
            k = len(bins) - 1
        out[i] = (k, sum(pieces[j][0] for j in bins[k]))
        bins[k].append(i)
    return out


def test_tightest_bin_without_conflict():
    rng = random.Random(4)
    for _ in range(60):
        pieces = [(rng.randrange(1, 51), rng.choice("aaab") if rng.random() < .9 else None,
                   rng.randrange(12)) for _ in range(80)]
        for per_source in (1, 3):
            assert packing.best_fit(pieces, 50, per_source) == plain(pieces, 50, per_source)


def check(rows, docs, capacity, per_source):
    words = {}
    for r in rows:
        if r.bin_id is not None:
            words.setdefault(r.bin_id, []).append(r)
    for b in words.values():
        b.sort(key=lambda r: r.bin_start)
        at = 0
        for r in b:
            assert r.bin_start == at
            at += r.n_words
        assert at <= capacity
        sources = [docs[r.doc_id][1] for r in b]
        assert max(map(sources.count, sources)) <= per_source
    for i, (n, _) in docs.items():
        pieces = sorted((r.first_word, r.n_words) for r in rows if r.doc_id == i)
        assert sum(p[1] for p in pieces) == n
        assert [p[0] for p in pieces] == [k * capacity for k in range(len(pieces))]


def test_given_table_with_small_bins(spark):
    docs = read(spark, "/root/testdata/sf0.001", "documents")
    known = {r.doc_id: (len((r.text or "").split()), r.source) for r in docs.collect()}
    check(packing.pack(docs, capacity=300, per_source=2).collect(), known, 300, 2)


def test_copies_never_share_a_bin(spark):
    docs = spark.createDataFrame([(k, "same words here", "s") for k in range(500)],
                                 "doc_id long, text string, source string")
    rows = packing.pack(docs).collect()
    assert len({r.bin_id for r in rows}) == 500


def test_awkward_rows(hard, nothing):
    rows = packing.pack(hard, capacity=1000).collect()
    assert sum(r.n_words for r in rows if r.doc_id == 5) == 60_000
    assert [r.bin_id for r in rows if r.doc_id in (2, 3, 4)] == [None] * 3
    assert len([r for r in rows if r.doc_id == 6]) == 2
    assert len([r for r in rows if r.doc_id is None]) == 2
    assert packing.pack(nothing).count() == 0
