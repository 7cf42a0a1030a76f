"""Exact sets, links and components against a comparison of all pairs."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from ledgerloom.llm import jaccard
from ledgerloom.llm.common import read
from tests.llm.conftest import SCHEMA, full

SF = "/root/testdata/sf0.001"


def brute(rows):
    sets = {}
    for i, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[i] = ({tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5
                   else {tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {(i, len(s), find(i)) for i, s in sets.items()}


def test_given_table(spark):
    docs = read(spark, SF, "documents")
    want = brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert {tuple(r) for r in jaccard.jaccard_groups(docs).collect()} == want


@pytest.mark.parametrize("levels", [(16, 128, 1024), (1, 2, 3)])
def test_chains_copies_and_a_common_passage(spark, monkeypatch, levels):
    monkeypatch.setattr(jaccard, "LEVELS", levels)
    rng = random.Random(5)
    words = [f"w{k}" for k in range(400)]
    shared = [rng.choice(words) for _ in range(60)]
    rows = []
    for g in range(6):
        text = [rng.choice(words) for _ in range(100)]
        for _ in range(12):  # each a little different from the last: links make a chain
            rows.append(" ".join(text))
            text[rng.randrange(100)] = rng.choice(words)
            text[rng.randrange(100)] = rng.choice(words)
        rows += [rows[-1]] * 3
    for _ in range(25):
        own = [rng.choice(words) for _ in range(rng.randrange(8, 40))]
        rows.append(" ".join(shared + own))
    rows = [(k, t) for k, t in enumerate(rows)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert {tuple(r) for r in jaccard.jaccard_groups(docs).collect()} == brute(rows)


def test_awkward_rows(hard, nothing):
    got = sorted(tuple(r) for r in jaccard.jaccard_groups(hard).collect())
    assert got[:4] == [(1, 6, 1), (2, 0, 2), (3, 0, 3), (4, 0, 4)]
    assert [r for r in got if r[0] == 6] == [(6, 6, 1), (6, 6, 1)]
    assert all(r[0] is not None for r in got) and len(got) == 10
    assert jaccard.jaccard_groups(nothing).count() == 0


def test_word_rules(spark):
    texts = ["A b\x0bC\x0cd e", "a\x1cb c d e f", "É b c d e", "a", "a b", "a  b\n"]
    sets = list(jaccard.shingle_sets(pa.array(texts), 5))
    assert [len(s) for s in sets] == [1] * 6
    assert sets[4] == sets[5] and sets[3] != sets[4]
    lower = next(jaccard.shingle_sets(pa.array(["a b c d e"]), 5))
    assert np.array_equal(sets[0], lower)
    assert not np.array_equal(sets[2], next(jaccard.shingle_sets(pa.array(["é b c d e"]), 5)))


def test_documents_without_columns_to_spare(spark):
    docs = spark.createDataFrame([full(1, "x y"), full(2, "x y")], SCHEMA)
    assert {r.component_id for r in jaccard.jaccard_groups(docs).collect()} == {1}


def test_rows_that_repeat_an_id_count_with_their_own_texts(spark):
    rng = random.Random(8)
    a, b = ([rng.choice("abcdefghijklmnop") + str(rng.randrange(99)) for _ in range(30)]
            for _ in range(2))
    near = [*a[:-1], "changed"]
    rows = [(1, a), (1, b), (2, near), (3, [*b, "tail"]), (3, [*b, "tail"]), (4, ["else"])]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in rows],
                                 "doc_id long, text string").repartition(3)
    got = sorted(tuple(r) for r in jaccard.jaccard_groups(docs).collect())
    assert got == [(1, 26, 1), (1, 26, 1), (2, 26, 1), (3, 27, 1), (3, 27, 1), (4, 1, 4)]


def group_of(count, seed=3):
    """Near copies of an absent text, each with 14 words in a row replaced."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(5000)}" for _ in range(200)]
    rows = []
    for k in range(count):
        text, at = list(base), rng.randrange(187)
        text[at:at + 14] = [f"n{rng.randrange(10 ** 6)}" for _ in range(14)]
        rows.append((k, " ".join(text)))
    return rows


@pytest.mark.parametrize("count", [100, 400])
def test_near_copies_without_their_original(spark, monkeypatch, count):
    rows, looked_at = group_of(count), []
    verified = jaccard.JaccardJoin._verified
    monkeypatch.setattr(jaccard.JaccardJoin, "_verified", lambda self, pairs: (
        looked_at.append(pairs.count()), verified(self, pairs))[1])
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert {tuple(r) for r in jaccard.jaccard_groups(docs).collect()} == brute(rows)
    assert sum(looked_at) < 20 * count, looked_at
