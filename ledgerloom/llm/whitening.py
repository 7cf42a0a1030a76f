"""Whitening of vectors with MLlib's distributed block matrices.

Every entry c becomes the integer ``floor(scale * c) + shift``, so that sums and
deviations are exact. The centred rows are laid into numbered blocks, a table of matrices
in the shared folder. Their transpose times themselves is the scatter, whose
eigenvectors are found locally (its size is that of one vector squared); multiplying
the blocks by the whitening matrix projects the rows. The covariance of the result is
measured in the same way.

MLlib's product collects the numbers of all blocks on the driver and holds what one
task of its grid receives in memory. Blocks are therefore taken in slabs of whole files of
at most ``SLAB_BYTES`` (one file at least, and files have a limit of blocks): scatters of
slabs add up, projections of slabs stand side by side. No task or driver sees more than
a slab.

Vectors that are null or hold null or non-finite entries go. A vector shorter than the
longest counts as continued with zeros, an empty one is all zeros. Rows without an id,
repeated rows and ties stay, each as a row of its own; an empty table gives an empty
result. Integers beyond 2^50 in size stand at that value. A component without variance
(to rounding) has no whitened value (null) and is left out of the identity error; where
nothing varies, ``explained`` is 0. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix, MatrixUDT
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom import storage
from ledgerloom.llm import common

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
SLAB_BYTES = 128 << 20   # of centred rows that one product takes
BLOCK_ROWS = 1024
FILE_BLOCKS = 16
AT_ONCE = 4              # slabs whose jobs run side by side
_LARGEST = 1 << 50


@dataclass(frozen=True)
class Whitening:
    """Exact counts and sums of a fit, and its components by falling eigenvalue."""

    n: int
    sums: tuple[int, ...]
    eigenvalues: np.ndarray
    vectors: np.ndarray      # one column each
    trace: float

    @property
    def varied(self) -> np.ndarray:
        """Which components have variance beyond rounding."""
        top = self.eigenvalues.max(initial=0.0)
        return self.eigenvalues > max(top, 0.0) * 1e-13 * max(1, len(self.sums))

    def matrix(self) -> np.ndarray:
        """Eigenvectors over the root of their eigenvalues; zero where nothing varies."""
        root = np.sqrt(np.where(self.varied, self.eigenvalues, 1.0))
        return np.where(self.varied, self.vectors / root, 0.0)


def _integers(vector: str) -> F.Column:
    edge = float(_LARGEST)
    return F.transform(vector, lambda c: F.floor(F.greatest(F.lit(-edge), F.least(
        F.lit(edge), F.lit(float(SCALE)) * c))).cast("long") + SHIFT)


def _flat(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of a list column of integers, continued with the integer that stands for zero."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    size = np.diff(column.offsets.to_numpy())
    out = np.full((len(column), dim), SHIFT, np.int64)
    out[np.arange(dim) < size[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def _partial_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(at, total, rows): sums of each entry and of how many vectors; at -1 all vectors count."""
    total: list[int] = []
    covered: list[int] = []
    count = 0
    for b in batches:
        count += b.num_rows
        size = np.diff(b.column(0).offsets.to_numpy())
        dim = int(size.max(initial=0))
        total += [0] * (dim - len(total))
        covered += [0] * (dim - len(covered))
        x = _flat(b.column(0), dim) * (np.arange(dim) < size[:, None])
        for s in range(0, len(x), 4096):   # 4,096 times 2^50 stays below 2^63
            for k, v in enumerate(x[s:s + 4096].sum(0).tolist()):
                total[k] += v
        for k in range(dim):
            covered[k] += int((size > k).sum())
    yield pa.RecordBatch.from_arrays(
        [pa.array([-1, *range(len(total))], pa.int32()),
         pa.array(["0", *map(str, total)], pa.string()), pa.array([count, *covered], pa.int64())],
        names=["at", "total", "rows"])


def _fit_sums(kept: DataFrame) -> tuple[int, tuple[int, ...]]:
    """How many vectors there are, and the exact sum of each entry; shorter ones count on."""
    partial = kept.select("x").mapInArrow(_partial_sums, "at int, total string, rows long")
    rows = partial.groupBy("at").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("s"),
                                     F.sum("rows").alias("rows")).orderBy("at").collect()
    n = sum(r["rows"] for r in rows if r["at"] < 0)
    return n, tuple(int(r["s"]) + SHIFT * (n - r["rows"]) for r in rows if r["at"] >= 0)


def _squares(x: np.ndarray, n: int, sums: np.ndarray) -> list[int]:
    """The sum of (n x - S)^2 of each row, exact at any size."""
    largest = max((abs(int(v)) for v in (x.min(initial=0), x.max(initial=0))), default=0)
    if n * largest < 1 << 62 and all(abs(int(s)) < 1 << 62 for s in sums):
        apart = x * np.int64(n) - sums.astype(np.int64)
        if int(np.abs(apart).max(initial=0)) ** 2 * max(1, x.shape[1]) < 1 << 62:
            return (apart * apart).sum(1).tolist()
    whole = x.astype(object) * n - sums
    return [int(v) for v in (whole * whole).sum(1)]


def _centred(n: int, sums: tuple[int, ...]) -> Callable[[pa.RecordBatch], tuple]:
    """x - S/n of the rows, and beside it their ids and exact deviations."""
    exact = np.array(sums, object)
    whole = np.array([s // n for s in sums], np.int64)
    part = np.array([(s % n) / n for s in sums])

    def run(b: pa.RecordBatch) -> tuple[np.ndarray, list, list]:
        x = _flat(b.column(1), len(sums))
        return ((x - whole) - part, b.column(0).to_pylist(),
                list(map(str, _squares(x, n, exact))))
    return run


_MATRIX = ("struct<type: tinyint, numRows: int, numCols: int, colPtrs: array<int>, "
           "rowIndices: array<int>, values: array<double>, isTransposed: boolean>")
_BLOCK = f"block {_MATRIX}, ids array<long>, deviations array<string>"
_ARROW = pa.struct([("type", pa.int8()), ("numRows", pa.int32()), ("numCols", pa.int32()),
                    ("colPtrs", pa.list_(pa.int32())), ("rowIndices", pa.list_(pa.int32())),
                    ("values", pa.list_(pa.float64())), ("isTransposed", pa.bool_())])


def _laid(make: Callable[[pa.RecordBatch], tuple]):
    """Rows to dense blocks of BLOCK_ROWS rows (a partition's last one has fewer)."""
    def one(rows: np.ndarray, ids: list, deviations: list) -> pa.RecordBatch:
        block = pa.StructArray.from_arrays(
            [pa.array([1], pa.int8()), pa.array([len(rows)], pa.int32()),
             pa.array([rows.shape[1]], pa.int32()), pa.array([None], pa.list_(pa.int32())),
             pa.array([None], pa.list_(pa.int32())),
             pa.ListArray.from_arrays(pa.array([0, rows.size], pa.int32()),
                                      pa.array(np.ascontiguousarray(rows).ravel())),
             pa.array([True])], fields=list(_ARROW))
        return pa.RecordBatch.from_arrays(
            [block, pa.array([ids], pa.list_(pa.int64())),
             pa.array([deviations], pa.list_(pa.string()))], names=["block", "ids", "deviations"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, ids, deviations = None, [], []
        for b in batches:
            new, new_ids, new_deviations = make(b)
            rows = new if rows is None else np.concatenate([rows, new])
            ids, deviations = ids + new_ids, deviations + new_deviations
            while len(rows) >= BLOCK_ROWS:
                yield one(rows[:BLOCK_ROWS], ids[:BLOCK_ROWS], deviations[:BLOCK_ROWS])
                rows, ids = rows[BLOCK_ROWS:], ids[BLOCK_ROWS:]
                deviations = deviations[BLOCK_ROWS:]
        if rows is not None and len(rows):
            yield one(rows, ids, deviations)
    return run


class _Blocks:
    """A written table of blocks, cut into slabs of whole files; blocks are numbered in each."""

    def __init__(self, rows: DataFrame, make: Callable[[pa.RecordBatch], tuple], label: str,
                 width: int):
        self.spark, self.width = rows.sparkSession, width
        self.path = storage.new_dir(self.spark, label)
        (rows.mapInArrow(_laid(make), _BLOCK).write.option("maxRecordsPerFile", FILE_BLOCKS)
         .parquet(self.path))
        files = sorted((r["f"], r["count"]) for r in self.spark.read.schema(_BLOCK).parquet(
            self.path).groupBy(F.col("_metadata.file_path").alias("f")).count().collect())
        most = max(1, SLAB_BYTES // (8 * max(1, width) * BLOCK_ROWS))
        self.slabs: list[list[tuple[str, int]]] = []
        held = most
        for name, count in files:
            if held + count > most:
                self.slabs.append([])
                held = 0
            self.slabs[-1].append((name, count))
            held += count

    def rows(self, slab: int, matrix: T.DataType | str) -> tuple[DataFrame, int]:
        """(number, block, ids, deviations) of a slab, and how many blocks it has."""
        starts, at = [], 0
        for name, count in self.slabs[slab]:
            starts += [F.lit(name), F.lit(at).cast("long")]
            at += count
        start = F.element_at(F.create_map(*starts), F.col("_metadata.file_path"))
        schema = T.StructType([T.StructField("block", matrix)]
                              + [T.StructField(n, T.ArrayType(t)) for n, t in
                                 (("ids", T.LongType()), ("deviations", T.StringType()))])
        df = self.spark.read.schema(schema).parquet(*[name for name, _ in self.slabs[slab]])
        number = (start + F.col("_metadata.row_index")).alias("number")
        return df.select(number, "block", "ids", "deviations"), at

    def matrix(self, slab: int) -> tuple[BlockMatrix, int]:
        """The slab as MLlib's block matrix; the blocks never leave the JVM."""
        rows, count = self.rows(slab, MatrixUDT())
        placed = rows.select(F.struct("number", F.lit(0).cast("long")).alias("at"), "block")
        held = callMLlibFunc("createBlockMatrix", placed, BLOCK_ROWS, self.width,
                             count * BLOCK_ROWS, self.width)
        return BlockMatrix(held, BLOCK_ROWS, self.width), count

    def scatter(self, slab: int) -> np.ndarray:
        """The slab's transpose times itself, summed block by block."""
        blocks, count = self.matrix(slab)
        # the middle dimension is cut, so that block pairs are multiplied in many tasks
        product = blocks.transpose()._java_matrix_wrapper.call(
            "multiply", blocks._java_matrix_wrapper._java_model, max(1, -(-count // 8)))
        return BlockMatrix(product, self.width, self.width).toLocalMatrix().toArray()

    def total_scatter(self) -> np.ndarray:
        """Over all slabs; the jobs of a few run side by side."""
        with ThreadPoolExecutor(AT_ONCE) as pool:
            parts = pool.map(self.scatter, range(len(self.slabs)))
            return sum(parts, np.zeros((self.width, self.width)))

    def project(self, slab: int, by: np.ndarray, path: str) -> None:
        """Writes (vec_id, deviation, projected) of the slab's rows: its blocks times ``by``."""
        blocks, _ = self.matrix(slab)
        local = self.spark.sparkContext.parallelize(
            [((0, 0), DenseMatrix(self.width, by.shape[1], by.ravel(order="F")))], 1)
        product = blocks.multiply(BlockMatrix(local, self.width, by.shape[1]))
        found = callMLlibFunc("getMatrixBlocks", product._java_matrix_wrapper._java_model)
        placed = found.toDF("at", "projected").select(F.col("at._1").alias("number"), "projected")
        names, _ = self.rows(slab, MatrixUDT())
        (names.drop("block").join(placed, "number").select("ids", "deviations", "projected")
         .mapInArrow(_unlaid, _ROWS).write.parquet(f"{path}/slab={slab}"))

    def delete(self) -> None:
        storage.delete(self.spark, self.path)


_ROWS = "vec_id long, deviation string, projected array<double>"


def _unlaid(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks back to rows with their ids."""
    for b in batches:
        for k in range(b.num_rows):
            block = b.column(2)[k]
            width = block["numCols"].as_py()
            values = np.asarray(block["values"].values)
            if not block["isTransposed"].as_py():
                values = values.reshape(width, -1).T.ravel()
            ends = np.arange(0, len(values) + 1, width)
            yield pa.RecordBatch.from_arrays(
                [pa.array(b.column(0)[k].values), pa.array(b.column(1)[k].values),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))],
                names=["vec_id", "deviation", "projected"])


def _components(scatter: np.ndarray, n: int, sums: tuple[int, ...], keep: int) -> Whitening:
    covariance = (scatter + scatter.T) / (2.0 * n)
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")[:keep]
    return Whitening(n, sums, np.maximum(values[order], 0.0), vectors[:, order],
                     float(np.trace(covariance)))


_RESULT = ("vec_id long, n long, deviation decimal(38,0), whitened array<double>, "
           "explained array<double>, identity_error double")


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
           components: int = COMPONENTS) -> tuple[DataFrame, Whitening | None]:
    """Every usable vector projected on the first components, and the fit.

    Rows: vec_id, n, deviation (exact; null beyond 38 digits), whitened and explained
    (one value a component), identity_error. The fit is None where no vector is usable.
    """
    spark = vectors.sparkSession
    common.small_batches(spark, BLOCK_ROWS)
    usable = F.forall("c", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    kept = (vectors.select(F.col(id_col).cast("long").alias("vec_id"),
                           F.col(vector_col).cast("array<double>").alias("c"))
            .where(F.col("c").isNotNull() & usable).select("vec_id", _integers("c").alias("x")))
    n, sums = _fit_sums(kept)
    if not n:
        return spark.createDataFrame([], _RESULT), None
    if not sums:
        return kept.select("vec_id", F.lit(n).cast("long").alias("n"), F.lit(0).cast(
            "decimal(38,0)").alias("deviation"), F.array().cast("array<double>").alias("whitened"),
            F.array().cast("array<double>").alias("explained"), F.lit(0.0).alias("identity_error")
            ), Whitening(n, (), np.zeros(0), np.zeros((0, 0)), 0.0)
    blocks = _Blocks(kept, _centred(n, sums), "centred", len(sums))
    fit = _components(blocks.total_scatter(), n, sums, components)
    folder = storage.new_dir(spark, "whitened")
    with ThreadPoolExecutor(AT_ONCE) as pool:
        list(pool.map(lambda slab: blocks.project(slab, fit.matrix(), folder),
                      range(len(blocks.slabs))))
    blocks.delete()
    done = spark.read.schema(_ROWS).parquet(
        *[f"{folder}/slab={k}" for k in range(len(blocks.slabs))])
    error = _identity_error(done, fit, len(fit.eigenvalues))
    varied = [F.when(F.lit(bool(v)), F.col("projected")[k]).otherwise(F.lit(None).cast("double"))
              for k, v in enumerate(fit.varied)]
    share = [float(e / fit.trace) if fit.trace > 0 else 0.0 for e in fit.eigenvalues]
    return done.select(
        "vec_id", F.lit(n).cast("long").alias("n"),
        F.expr("try_cast(deviation as decimal(38,0))").alias("deviation"),
        F.array(*varied).alias("whitened"), F.array(*map(F.lit, share)).alias("explained"),
        F.lit(error).alias("identity_error")), fit


def _identity_error(done: DataFrame, fit: Whitening, width: int) -> float:
    """Largest absolute entry of the measured covariance of the result minus the identity."""
    mean = np.array(done.agg(*[F.avg(F.col("projected")[k]) for k in range(width)]).first(), float)

    def centre(b: pa.RecordBatch) -> tuple[np.ndarray, list, list]:
        rows = b.column(0).flatten().to_numpy().reshape(-1, width) - mean
        return rows, [None] * len(rows), [None] * len(rows)

    blocks = _Blocks(done.select("projected"), centre, "projected", width)
    covariance = blocks.total_scatter() / fit.n
    blocks.delete()
    apart = np.abs(covariance - np.eye(width))[np.ix_(fit.varied, fit.varied)]
    return float(apart.max(initial=0.0))


def by_component(whitened: DataFrame) -> DataFrame:
    """A row for each vector and component, numbered from 1; deviations beyond a long are null."""
    (at,) = common.unused(whitened, "_at")
    return (whitened.select("*", F.posexplode("explained").alias(at, "_share"))
            .select("vec_id", (F.col(at) + 1).alias("component"), "n",
                    F.expr("try_cast(deviation as bigint)").alias("deviation"),
                    F.col("whitened")[F.col(at)].alias("whitened"),
                    F.col("_share").alias("explained"), "identity_error"))
