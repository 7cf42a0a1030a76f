"""Embedding near-dedup over an inverted multi-index.

Each half of the unit vectors has a codebook of its own; the pairs of codewords
are the cells of a product grid, and every vector lies in one cell. A vector's
distance past the border of each codeword's region, in both halves, orders the
cells; a multi-sequence traversal of the two sorted lists visits the nearest
cells up to a radius. The radius is set so that the share ``recall`` of vectors
at just the wanted similarity lie in visited cells, and a pair is found if either
of its vectors visits the other's cell. All vectors met in a visited cell are
verified by their cosine in double precision.

The codebooks are fitted to at most ``SAMPLE`` vectors picked by hash; all
vectors are indexed and all search. Equal vectors are one node with a count. The
vectors of a cell, and those that visit it, are dealt into blocks, and pairs of
blocks are compared; only counts and the links of a spanning forest leave a task.

Only vectors of one label and one length are compared. Vectors that are null,
empty, zero or have null or non-finite components, and rows without a label or an
id, link with nothing. Repeated rows are vectors like others. Other columns of
the input are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import common

SAMPLE = 8192
PER_CELL = 64        # vectors of one label a cell should hold
BLOCK = 1024
RECALL = 0.9995
ROUNDS = 12          # of k-means


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.maximum(np.abs(x).max(1, keepdims=True), 1e-300)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of a list column, filled up with zeros to ``dim`` values."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    size = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.zeros((len(column), dim))
    out[np.arange(dim) < size[:, None]] = flat
    return out


class MultiIndex:
    """Codebooks of both halves, and the radius of a traversal."""

    def __init__(self, books: list[np.ndarray], radius: float):
        self.books, self.radius = books, radius

    @property
    def words(self) -> int:
        return len(self.books[0])

    @classmethod
    def fit(cls, sample: np.ndarray, words: int, cosine: float, recall: float) -> MultiIndex:
        rng = np.random.default_rng(11)
        half = (sample.shape[1] + 1) // 2
        index = cls([_kmeans(sample[:, :half], words, rng), _kmeans(sample[:, half:], words, rng)],
                    0.0)
        noise = rng.normal(size=sample.shape)
        noise -= (noise * sample).sum(1, keepdims=True) * sample
        noise /= np.maximum(np.linalg.norm(noise, axis=1, keepdims=True), 1e-12)
        near = cosine * sample + np.sqrt(1 - cosine ** 2) * noise
        past, other = index.past(sample), index.home(near)
        cost = past[0][np.arange(len(sample)), other[0]] + past[1][np.arange(len(sample)), other[1]]
        index.radius = float(np.quantile(cost, recall)) + 1e-9
        return index

    def _halves(self, x: np.ndarray) -> list[np.ndarray]:
        half = (x.shape[1] + 1) // 2
        return [x[:, :half], x[:, half:]]

    def _distances(self, x: np.ndarray) -> list[np.ndarray]:
        return [(b * b).sum(1) - 2 * h @ b.T for h, b in zip(self._halves(x), self.books)]

    def home(self, x: np.ndarray) -> list[np.ndarray]:
        return [d.argmin(1) for d in self._distances(x)]

    def past(self, x: np.ndarray) -> list[np.ndarray]:
        """Squared distance of each vector's half past the border of each codeword's region."""
        out = []
        for d, b in zip(self._distances(x), self.books):
            near = d.argmin(1)
            apart = np.sqrt(np.maximum(((b[near][:, None, :] - b[None]) ** 2).sum(2), 1e-18))
            border = np.maximum(d - d[np.arange(len(d)), near][:, None], 0) / (2 * apart)
            border[np.arange(len(d)), near] = 0
            out.append(border ** 2)
        return out

    def visited(self, x: np.ndarray) -> Iterator[np.ndarray]:
        """Cells of each vector's traversal: both lists in order, sums up to the radius."""
        first, second = self.past(x)
        order, ranked = second.argsort(1), np.sort(second, axis=1)
        for i in range(len(x)):
            cells = []
            for j in first[i].argsort():
                if first[i, j] > self.radius:
                    break
                upto = np.searchsorted(ranked[i], self.radius - first[i, j], "right")
                cells.append(j * self.words + order[i, :upto])
            yield np.concatenate(cells)


def _kmeans(x: np.ndarray, words: int, rng) -> np.ndarray:
    books = x[rng.choice(len(x), words, replace=len(x) < words)].copy()
    for _ in range(ROUNDS):
        near = ((books * books).sum(1) - 2 * x @ books.T).argmin(1)
        total = np.zeros_like(books)
        np.add.at(total, near, x)
        count = np.bincount(near, minlength=words)
        books = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], books)
    return books


def _cells(sent, dim: int):
    """(node, cell, home): the cell each vector lies in, and those it visits."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = sent.value
        for b in batches:
            x = _unit(_matrix(b.column(2), dim)) if len(b) else np.zeros((0, dim))
            a, c = index.home(x)
            seen = list(index.visited(x))
            size = [len(s) for s in seen]
            row = np.repeat(np.arange(len(x)), size)
            cells = np.concatenate([np.zeros(0, np.int64), *seen, a * index.words + c])
            row = np.r_[row, np.arange(len(x))]
            home = np.r_[np.zeros(sum(size), bool), np.ones(len(x), bool)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(row)), b.column(1).take(pa.array(row)),
                 pa.array(cells.astype(np.int64)), pa.array(home)],
                names=["node", "part", "cell", "home"])
    return run


def _forest(hit: np.ndarray) -> np.ndarray:
    """Pairs (row, column) of a spanning forest of the bipartite links ``hit``."""
    rows, columns = np.nonzero(hit)
    if len(rows) <= 2 * sum(hit.shape):
        return np.stack([rows, columns], 1)
    out, row_free, col_free = [], hit.any(1), np.ones(hit.shape[1], bool)
    while row_free.any():
        frontier = np.array([row_free.argmax()])
        row_free[frontier] = False
        while len(frontier):
            found = hit[frontier] & col_free
            new = np.flatnonzero(found.any(0))
            col_free[new] = False
            out.append(np.stack([frontier[found[:, new].argmax(0)], new], 1))
            back = hit[:, new] & row_free[:, None]
            frontier = np.flatnonzero(back.any(1))
            row_free[frontier] = False
            if len(frontier):
                out.append(np.stack([frontier, new[back[frontier].argmax(1)]], 1))
    return np.concatenate(out)


def _compared(sent, dim: int, cosine: float):
    """Counts of links (b null) and forest links of one pair of blocks."""
    def run(table: pa.Table) -> pa.Table:
        index = sent.value
        node, weight = table["node"].to_numpy(), table["copies"].to_numpy()
        home = table["home"].to_numpy(zero_copy_only=False).astype(bool)
        x = _unit(_matrix(table["vec"], dim))
        q, m = np.flatnonzero(~home), np.flatnonzero(home)
        hit = (x[q] @ x[m].T >= cosine) & (node[q][:, None] != node[m][None])
        a, b = np.nonzero(hit)
        # a link whose other end visits this end's cell is counted for that end over there
        own = index.home(x[q])
        past = index.past(x[m])
        missed = past[0][b, own[0][a]] + past[1][b, own[1][a]] > index.radius
        count = np.zeros(len(node), np.int64)
        np.add.at(count, q[a], weight[m[b]])
        np.add.at(count, m[b[missed]], weight[q[a[missed]]])
        some = np.flatnonzero(count)
        pairs = _forest(hit)
        return pa.table({
            "a": np.r_[node[some], node[q[pairs[:, 0]]]],
            "b": pa.array(np.r_[np.zeros(len(some), np.int64), node[m[pairs[:, 1]]]],
                          mask=np.r_[np.ones(len(some), bool), np.zeros(len(pairs), bool)]),
            "n": np.r_[count[some], np.zeros(len(pairs), np.int64)]})
    return run


def near_vectors(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                 label_col: str = "label", cosine: float = 0.98,
                 recall: float = RECALL) -> DataFrame:
    """One row per row: vec_id, n_links, component_id, kept."""
    spark = table.sparkSession
    v = F.col("vec")
    usable = (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & v.isNotNull()
              & F.forall(v, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
              & F.exists(v, lambda e: e != 0))
    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("vec"),
                        F.col(label_col).alias("label"))
    part = F.xxhash64("label", F.size("vec"))
    rows = rows.select("vec_id", "vec", F.when(F.coalesce(usable, F.lit(False)), F.xxhash64(
        part, "vec")).alias("node"), part.alias("part"))
    nodes = common.written(
        rows.where("node is not null").groupBy("node", "part", "vec")
        .agg(F.count("*").alias("copies"), F.min("vec_id").alias("first")), "vectors")
    facts = nodes.agg(F.count("*").alias("n"), F.max(F.size("vec")).alias("dim"),
                      F.approx_count_distinct("part").alias("parts")).first()
    if not facts["n"]:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"),
                           F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    dim = max(facts["dim"], 2)
    sample = nodes.orderBy(F.xxhash64("node")).limit(SAMPLE).select("vec").toArrow()
    words = int(np.clip(round((facts["n"] / max(facts["parts"], 1) / PER_CELL) ** 0.5), 2, 256))
    index = MultiIndex.fit(_unit(_matrix(sample["vec"], dim)), words, cosine, recall)
    sent = spark.sparkContext.broadcast(index)
    cells = common.written(nodes.select("node", "part", "vec").mapInArrow(
        _cells(sent, dim), "node long, part long, cell long, home boolean"), "cells")
    counts = (cells.groupBy("part", "cell")
              .agg(F.count_if("home").alias("held"), F.count_if(~F.col("home")).alias("visits"))
              .where("held > 0")
              .select("part", "cell", F.ceil(F.col("held") / BLOCK).alias("hb"),
                      F.ceil(F.col("visits") / BLOCK).alias("vb")))
    mine = F.pmod(F.xxhash64("node"), F.when(F.col("home"), F.col("hb")).otherwise(F.col("vb")))
    others = F.when(F.col("home"), F.col("vb")).otherwise(F.col("hb"))
    dealt = (cells.join(counts, ["part", "cell"]).withColumn("mine", mine)
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), others - 1)))
             .select("node", "part", "cell", "home",
                     F.when(F.col("home"), F.col("mine")).otherwise(F.col("other")).alias("hb"),
                     F.when(F.col("home"), F.col("other")).otherwise(F.col("mine")).alias("vb")))
    found = common.written(
        dealt.join(nodes.select("node", "vec", "copies"), "node")
        .groupBy("part", "cell", "hb", "vb")
        .applyInArrow(_compared(sent, dim, cosine), "a long, b long, n long"), "found")
    linked = found.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    roots = common.components(found.where("b is not null"), "a", "b")
    named = (nodes.join(roots, "node", "left")
             .select("node", "copies", "first", F.coalesce("root", "node").alias("root")))
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    per_node = (named.join(least, "root").join(linked, "node", "left")
                .select("node", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                        "component_id"))
    return (rows.select("vec_id", "node").join(per_node, "node", "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component_id", "vec_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))))
