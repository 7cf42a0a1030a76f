"""Links, counts and components against a comparison of all pairs."""

import numpy as np

from ledgerloom.llm import vectors
from ledgerloom.llm.common import read

FIELDS = "vec_id long, embedding array<double>, label int, node long, copies int, part string"


def brute(rows, cosine=0.98):
    def ok(v):
        return v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) \
            and any(v)
    use = [(i, np.array(v, float) / np.linalg.norm(v), la) for i, v, la in rows
           if i is not None and la is not None and ok(v)]
    root = {i: i for i, _, _ in use}
    links = dict.fromkeys(root, 0)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, (i, v, la) in enumerate(use):
        for j, w, lb in use[a + 1:]:
            if la == lb and len(v) == len(w) and v @ w >= cosine:
                links[i] += 1
                links[j] += 1
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {(i, links.get(i, 0), find(i) if i in root else i) for i, _, _ in rows}


def made(n=600, dim=16, seed=3):
    rng = np.random.default_rng(seed)
    rows = []
    for k in range(n):
        if rows and rng.random() < 0.5:
            v = np.array(rows[rng.integers(len(rows))][1]) + rng.normal(0, 0.04, dim)
        else:
            v = rng.normal(0, 1, dim)
            v /= np.linalg.norm(v)
        rows.append((k, v.tolist(), int(rng.integers(3))))
    return rows + [(n + k, rows[5][1], rows[5][2]) for k in range(30)]


def result(table):
    out = vectors.near_vectors(table).collect()
    assert all(r.kept == (r.vec_id == r.component_id) for r in out if r.vec_id is not None)
    return {(r.vec_id, r.n_links, r.component_id) for r in out}


def test_recall_and_counts(spark, monkeypatch):
    monkeypatch.setattr(vectors, "PER_CELL", 8)
    monkeypatch.setattr(vectors, "BLOCK", 16)
    rows = made()
    table = spark.createDataFrame([(*r, None, None, None) for r in rows], FIELDS)
    want, got = brute(rows), result(table)
    assert sum(n for _, n, _ in got) >= 0.99 * sum(n for _, n, _ in want)
    assert all(dict((i, n) for i, n, _ in want)[i] >= n for i, n, _ in got)


def test_given_table(spark):
    table = read(spark, "/root/testdata/sf0.001", "embeddings")
    rows = [tuple(r) for r in table.select("vec_id", "embedding", "label").collect()]
    assert result(table) == brute(rows)


def test_awkward_rows(spark):
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None),
            (5, None, 1), (6, [], 1), (7, [0.0, 0.0], 1), (8, [float("nan"), 1.0], 1),
            (9, [None, 1.0], 1), (10, [float("inf"), 1.0], 1), (11, [1.0], 1), (12, [5.0], 1),
            (13, [1e300, 1e300], 1), (14, [1.0, 1.0], 1), (15, [1.0, 0.0, 0.0], 1)]
    table = spark.createDataFrame([(*r, 1, 2, "p") for r in [*rows, (None, [1.0, 0.0], 1)]], FIELDS)
    want = {(i, 0, i) for i, _, _ in rows if i not in (1, 2, 11, 12, 13, 14)}
    want |= {(1, 1, 1), (2, 1, 1), (11, 1, 11), (12, 1, 11), (13, 1, 13), (14, 1, 13),
             (None, 0, None)}
    assert result(table) == want
    assert vectors.near_vectors(table.limit(0)).count() == 0
