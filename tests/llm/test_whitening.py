"""Whitening against plain arithmetic on whole integers."""

import math
import random

import numpy as np
import pytest

from ledgerloom.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, index string, row int, x int, n string"


def table(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    return spark.createDataFrame([(i, v, 1, "i", 2, 3, "n") for i, v in zip(ids, vectors)],
                                 SCHEMA).repartition(3)


def plain(vectors, keep=32):
    """{position: (deviation, whitened)}, explained and n, by loops and one eigh."""
    good = {k: v for k, v in enumerate(vectors)
            if v is not None and all(c is not None and math.isfinite(c) for c in v)}
    dim = max(map(len, good.values()))
    x = {k: [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]
         + [1_000_000] * (dim - len(v)) for k, v in good.items()}
    n, sums = len(x), [sum(col) for col in zip(*x.values())]
    centred = {k: np.array([(n * c - s) / n for c, s in zip(r, sums)]) for k, r in x.items()}
    every = np.array(list(centred.values()))
    values, vecs = np.linalg.eigh(every.T @ every / n)
    order = np.argsort(-values)[:keep]
    values, vecs, trace = values[order], vecs[:, order], values.sum()
    return ({k: (sum((n * c - s) ** 2 for c, s in zip(x[k], sums)),
                 centred[k] @ vecs / np.sqrt(values)) for k in x}, values / trace, n)


def check(spark, vectors, keep=32):
    want, share, n = plain(vectors, keep)
    done, fit = whitening.whiten(table(spark, vectors), components=keep)
    rows = done.collect()
    assert sorted(r.vec_id for r in rows) == sorted(want)
    signs = None
    for r in sorted(rows, key=lambda r: r.vec_id):
        deviation, white = want[r.vec_id]
        assert int(r.deviation) == deviation and r.n == n and r.identity_error < 1e-9
        assert np.allclose(r.explained, share, rtol=1e-9)
        if signs is None:
            signs = np.sign(np.array(r.whitened) * white)
        assert np.allclose(r.whitened, white * signs, atol=1e-7)
    return fit


def vectors_of(rng, count, dim):
    return [[rng.gauss(0, 1 + k) for k in range(dim)] for _ in range(count)]


def test_plain_arithmetic(spark):
    rng = random.Random(1)
    odd = [None, [1.0, None, 2.0, 0.0, 1.0], [float("nan")] * 5, [float("inf"), 0.0, 1.0, 2.0, 3.0]]
    check(spark, vectors_of(rng, 300, 5) + odd)


def test_slabs_add_up(spark, monkeypatch):
    monkeypatch.setattr(whitening, "SLAB_BYTES", 8 * 6 * 40)
    monkeypatch.setattr(whitening, "FILE_BLOCKS", 3)
    monkeypatch.setattr(whitening, "BLOCK_ROWS", 8)
    fit = check(spark, vectors_of(random.Random(2), 200, 6), keep=4)
    assert fit.n == 200 and len(fit.eigenvalues) == 4


def test_short_vectors_count_as_continued_with_zeros(spark):
    check(spark, vectors_of(random.Random(3), 60, 4) + [[1.0], [], [2.0, 3.0]])


def test_given_table(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").orderBy("vec_id")
    check(spark, [list(r.embedding) for r in vectors.collect()])


def test_no_variance(spark):
    done, fit = whitening.whiten(table(spark, [[1.0, 2.0]] * 5))
    rows = whitening.by_component(done).collect()
    assert len(rows) == 10 and not fit.varied.any()
    assert {(r.deviation, r.whitened, r.explained, r.identity_error) for r in rows} == {
        (0, None, 0.0, 0.0)}
    half = whitening.by_component(whitening.whiten(table(
        spark, [[1.0, 2.0], [2.0, 2.0], [4.0, 2.0]]))[0])
    first, second = (half.where(f"component = {k}").collect() for k in (1, 2))
    assert all(r.whitened is None and abs(r.explained) < 1e-9 for r in second)
    assert np.isclose(np.mean([r.whitened ** 2 for r in first]), 1)


def test_awkward_rows(spark):
    vectors = [[3e38, -3e38], [0.0, 1.0], [1.0, 0.0], [1.0, 0.0], None]
    done, _ = whitening.whiten(table(spark, vectors, [1, None, 2, 2, 3]))
    rows = whitening.by_component(done).collect()
    assert len(rows) == 8 and sorted((r.vec_id or 0) for r in rows) == [0, 0, 1, 1, 2, 2, 2, 2]
    assert all(r.deviation is None for r in rows)   # beyond a long
    assert done.where("deviation is null").isEmpty()
    for empty in ([], [None], [[None]], [[]]):
        left = [v for v in empty if v == []]
        out, fit = whitening.whiten(table(spark, empty) if empty else
                                    spark.createDataFrame([], SCHEMA))
        assert out.count() == len(left) and (fit is None) == (not left)
        assert whitening.by_component(out).count() == 0


@pytest.mark.parametrize("n, largest", [(3, 10), (1 << 40, 1 << 50)])
def test_deviations_are_exact_at_any_size(n, largest):
    x = np.array([[largest, 5], [-largest, 7], [0, 9]])
    sums = np.array([n * 3 + 1, n * 7 - 2], object)
    want = [sum((n * int(c) - int(s)) ** 2 for c, s in zip(row, sums)) for row in x]
    assert whitening._squares(x, n, sums) == want
