"""Span hashes, extensions and the order of rows against plain string work."""

import hashlib
import random

import numpy as np
from pyspark.sql import functions as F

from ledgerloom.llm import fingerprints as fp
from ledgerloom.llm.common import read


def test_spans_and_extensions():
    rng = random.Random(3)
    for _ in range(60):
        a = "".join(rng.choice("ab\U0001f600") for _ in range(rng.randrange(1, 60)))
        b = "".join(rng.choice("ab\U0001f600") for _ in range(rng.randrange(1, 60)))
        p, q = fp.Prefix(a), fp.Prefix(b)
        for _ in range(20):
            i, j = rng.randrange(len(a) + 1), rng.randrange(len(b) + 1)
            n = rng.randrange(min(len(a) - i, len(b) - j) + 1)
            assert fp.equal_spans(p, i, q, j, n) == (a[i:i + n] == b[j:j + n])
            same = 0
            while i + same < len(a) and j + same < len(b) and a[i + same] == b[j + same]:
                same += 1
            assert fp.common_extension(p, i, q, j) == same
        w = p.windows(1)
        assert len(w) == len(a) and len(np.unique(w)) == len(set(a))


def test_likeness_follows_what_texts_share():
    rng = random.Random(9)
    text = "".join(rng.choice("abcdefgh ") for _ in range(4000))
    other = "".join(rng.choice("abcdefgh ") for _ in range(4000))
    mark = [fp.fingerprint(fp.Prefix(t)) for t in (text, text, text[:2000] + other[:2000], other, "")]
    assert mark[0] == mark[1] and fp.likeness(mark[0], mark[1]) == 1
    assert 0.15 < fp.likeness(mark[0], mark[2]) < 0.6
    assert fp.likeness(mark[0], mark[3]) < 0.1 and fp.likeness(mark[0], mark[4]) == 0
    assert fp.likeness(mark[4], mark[4]) == 1


def expected(rows):
    order = sorted(rows, key=lambda r: -r[0])
    out = {}
    for k, (i, t) in enumerate(order):
        t, n = t or "", order[(k + 1) % len(order)][1] or ""
        m = len(t) // 3
        out[i] = (len(t), hashlib.sha256((t[:len(t) - m] + n[:m]).encode()).hexdigest())
    return out


def test_given_table(spark):
    docs = read(spark, "/root/testdata/sf0.01", "documents").repartition(7)
    got = fp.fingerprints(docs).collect()
    want = expected([(r.doc_id, r.text) for r in docs.collect()])
    assert {r.doc_id: (r.n_chars, r.edited_sha256) for r in got} == want
    assert np.mean([r.near_edited for r in got]) > 0.4 > 0.05 > np.mean([r.near_next for r in got])
    assert all(r.lce_edited >= r.n_chars - r.n_chars // 3 for r in got)


def test_awkward_rows(spark, hard, nothing):
    got = fp.fingerprints(hard).collect()
    assert len(got) == 12
    assert {r.n_chars for r in got if r.doc_id in (2, 3)} == {0}
    assert len({r.fingerprint for r in got if r.doc_id in (1, 6)}) == 1
    assert fp.fingerprints(nothing).count() == 0
    one = fp.fingerprints(hard.where("doc_id = 1")).collect()
    assert len(one) == 1 and one[0].near_next == 1
    assert fp.fingerprints(hard.where(F.col("doc_id") == 6)).count() == 2
