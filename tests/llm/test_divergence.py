"""The audit against loops over Python's whole numbers, and against SQL."""

import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from ledgerloom.llm import divergence
from ledgerloom.llm.common import read
from tests.compare import canonical

TERM = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
COLUMNS = ["lang", "source", "part", "item", "value", "rank"]


def plain(rows, top=200):
    count, found, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for r in rows:
        lang, source = r.lang or "", r.source or ""
        groups[lang].add(source)
        words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in TERM.findall(r.text or "")]
        count[lang, source].update(words)
        found[lang].update(set(words))
    out = []
    for lang, sources in groups.items():
        kept = sorted(t for t, n in found[lang].items() if n >= 3)

        def shares(names):
            c = Counter({t: sum(count[lang, s][t] for s in names) for t in kept})
            total = sum(c.values()) + len(kept)
            return c, {t: 1 + 10 ** 9 * (c[t] + 1) // total for t in kept}
        whole = shares(sources)[1]
        own = {s: shares([s]) for s in sources}
        for s in sources:
            c, p = own[s]
            pairs = [(-sum((p[t] - q[t]) ** 2 // q[t] for t in kept), o.encode(), o)
                     for o, (_, q) in own.items() if o != s]
            terms = [(-((p[t] - whole[t]) ** 2 // whole[t]), t.encode(), t)
                     for t in kept if c[t] and p[t] > whole[t]]
            for part, items in (("pair", pairs), ("term", sorted(terms)[:top])):
                out += [(lang, s, part, item, -v, k + 1)
                        for k, (v, _, item) in enumerate(sorted(items))]
    return sorted(out)


def mine(docs, **kw):
    return sorted(tuple(r) for r in divergence.audit(docs, **kw).select(*COLUMNS).collect())


@pytest.mark.parametrize("tile, levels, terms", [(2048, 1 << 14, (64, 4096)), (3, 4, (2, 5))])
def test_given_table(spark, monkeypatch, tile, levels, terms):
    monkeypatch.setattr(divergence, "TILE", tile)
    monkeypatch.setattr(divergence, "BLOCK_LEVELS", levels)
    monkeypatch.setattr(divergence, "BLOCK_TERMS", terms)
    docs = read(spark, "/root/testdata/sf0.001", "documents").where("doc_id % 3 = 0")
    assert mine(docs) == plain(docs.collect())


def test_sql_gives_the_same(spark, hard):
    con = duckdb.connect()
    rows = hard.select("doc_id", "text", "lang", "source").toArrow()
    con.register("documents", rows)
    want = con.execute(divergence.SQL)
    names = [d[0] for d in want.description]
    got = divergence.audit(hard)
    assert canonical(got.collect(), got.columns) == canonical(want.fetchall(), names)


def test_awkward_rows(spark, hard, nothing):
    assert mine(hard) == plain(hard.collect())
    assert mine(nothing) == []
    lone = spark.createDataFrame([("A\x00b é\x7fB", "xx", "s")] * 3, "text string, lang string, "
                                 "source string")
    assert mine(lone) == []   # one source only, and it is its language
    two = lone.unionByName(spark.createDataFrame([(None, "xx", None), ("zz", "xx", "t")],
                                                 lone.schema))
    assert mine(two) == plain(two.collect())


def test_ranks_end_at_the_top_terms(spark):
    rows = [(" ".join(f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(400)), "x", "a"),
            *[("other", "x", "b")] * 3] * 3
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    got = mine(docs)
    assert got == plain(docs.collect())
    assert sum(r[1:3] == ("a", "term") for r in got) == 200


def test_partitions_send_terms_on(spark, monkeypatch):
    monkeypatch.setattr(divergence, "HELD", 10)
    docs = read(spark, "/root/testdata/sf0.001", "documents").where("doc_id < 30")
    assert mine(docs) == plain(docs.collect())


def test_joint_prices_by_tiles(monkeypatch):
    rng = np.random.default_rng(1)
    counts = rng.integers(0, 9, (50, 7)) * rng.integers(0, 2, (50, 7))
    totals, kept = [int(counts[:, s].sum()) + s for s in range(7)], 60
    p = [[1 + 10 ** 9 * (int(c) + 1) // (totals[s] + kept) for c in counts[:, s]] for s in range(7)]
    want = [[sum((a - b) ** 2 // b for a, b in zip(p[g], p[h])) for h in range(7)] for g in range(7)]
    for tile in (1, 4, 11, 4096):
        monkeypatch.setattr(divergence, "TILE", tile)
        assert divergence.joint_prices(counts, totals, kept).tolist() == want
