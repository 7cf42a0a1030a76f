"""The raw tables: partitioned Parquet, appended and compacted in place.

Layout of a table: ``height_bucket=<b>/ingest_batch=<id>/*.parquet``. A batch id
names one append. Writing the same batch again replaces its own folders and
nothing else, which makes a retried or replayed append harmless. Statuses that
change later stand in a log beside the blocks (``StatusLog``). Beside each table lie
the figures of its batches, made when they are first asked for: rows and key digest per
block. They tell which blocks are whole, count heights and say which batches a
height range needs.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom import storage
from ledgerloom.operators.broadcasting import estimated_bytes
from ledgerloom.operators.normalize import LedgerFrames
from ledgerloom.schemas import BATCH_COL, BUCKET_COL, KINDS, RAW_BUCKETS
from ledgerloom.sources.completeness import DIGEST, EXPECTED, key_digest
from ledgerloom.sources.status import StatusLog

_LAYOUT = [T.StructField(BUCKET_COL, T.IntegerType()), T.StructField(BATCH_COL, T.StringType())]
COMPACTED = "compacted"
FILE_BYTES = 64 << 20  # what one file should hold
ROW_GROUP_BYTES = 16 << 20  # what a task holds in memory of each file it keeps open
_STREAM_BATCH = re.compile(r"(.+)-\d{9}")
_ASIDE, _FOLDED = "_replaced-", "_status-"
_FIGURES = f"{BUCKET_COL} INT, height INT, block_hash STRING, rows BIGINT, digest {DIGEST}"


class Lake:
    def __init__(self, spark: SparkSession, root: str, buckets: int = RAW_BUCKETS):
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets
        self.status = StatusLog(spark, f"{self.root}/_status")
        for table in KINDS:
            storage.make_dirs(spark, self.path(table))

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def bucket_of(self, height: Column) -> Column:
        return F.pmod(F.hash(height.cast("int")), F.lit(self.buckets))

    # -- writing -----------------------------------------------------------
    def append(self, table: str, records: DataFrame, batch_id: str, spread: bool = False) -> None:
        """Append conformed records as one batch; the same id again replaces it.

        ``spread``: the records come rebalanced by bucket and are written as they lie. A batch
        that may fill a file or more is written so, too, each task keeping a file open for
        every bucket: no record goes through a shuffle, and compaction folds the files. A
        smaller one is gathered by bucket first.
        """
        kind = KINDS[table]
        storage.delete(self.spark, f"{self._figures(table)}/{BATCH_COL}={batch_id}")
        laid_out = (records.select(*kind.columns)
                    .withColumn(BUCKET_COL, self.bucket_of(F.col(kind.height_col)))
                    .withColumn(BATCH_COL, F.lit(batch_id)))
        as_it_lies = spread or estimated_bytes(records) >= FILE_BYTES
        # a streaming batch has a session of its own
        with storage.open_files(records.sparkSession, self.buckets):
            self._write(laid_out, self.path(table), as_it_lies)

    def append_all(self, frames: LedgerFrames, batch_id: str, spread: bool = False) -> None:
        """Append to all four tables as one batch id; the four jobs run side by side."""
        # set around the threads too, so that none of them takes it away from another
        with storage.open_files(frames.blocks.sparkSession, self.buckets), \
                ThreadPoolExecutor(max_workers=len(KINDS)) as pool:
            jobs = [pool.submit(self.append, table, frame, batch_id, spread)
                    for table, frame in frames.items()]
        for job in jobs:
            job.result()

    def _write(self, laid_out: DataFrame, path: str, as_it_lies: bool = False) -> None:
        # The rebalance splits large buckets over many tasks and joins small
        # ones, so files come out near the advisory size at any volume.
        laid_out = laid_out if as_it_lies else laid_out.hint("rebalance", F.col(BUCKET_COL))
        (laid_out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .option("compression", "zstd").option("parquet.block.size", ROW_GROUP_BYTES)
         .partitionBy(BUCKET_COL, BATCH_COL).parquet(path))

    def overwrite_partitions(self, table: str, laid_out: DataFrame) -> None:
        """Replace exactly the (bucket, batch) folders present in ``laid_out``."""
        columns = [*KINDS[table].columns, BUCKET_COL, BATCH_COL]
        storage.delete(self.spark, self._figures(table))
        self._write(laid_out.select(*columns), self.path(table))

    def expect(self, figures: DataFrame, batch_id: str) -> None:
        """Keep what a publisher says its documents hold; the same id again replaces it."""
        (figures.select(*[F.col(c.split()[0]).cast(c.split()[1]) for c in EXPECTED.split(", ")])
         .write.mode("overwrite").parquet(f"{self.root}/_expected/{BATCH_COL}={batch_id}"))

    def expected(self) -> DataFrame:
        storage.make_dirs(self.spark, f"{self.root}/_expected")
        return self.spark.read.schema(EXPECTED).parquet(f"{self.root}/_expected")

    # -- reading -----------------------------------------------------------
    def scan(self, table: str) -> DataFrame:
        """Whole table as it lies there, with its layout columns."""
        schema = T.StructType(list(KINDS[table].schema.fields) + _LAYOUT)
        return self.spark.read.schema(schema).parquet(self.path(table))

    def folders(self) -> dict[str, set[tuple[str, str]]]:
        """(bucket, batch) of every folder of each table, as they are now."""
        return {table: {(bucket, batch) for bucket in self._buckets(self.path(table))
                        for batch in self._in_bucket(self.path(table), bucket)} for table in KINDS}

    def read(self, table: str, heights: Sequence[int] | None = None,
             between: tuple[int, int] | None = None,
             at: dict[str, list[str]] | None = None,
             buckets: Sequence[int] | None = None) -> DataFrame:
        """Record columns only, optionally for given heights or a height range.

        Equality and IN also name the buckets, which prunes folders. A range names the
        batches that hold some of it, and uses the Parquet statistics inside them.
        ``at`` leaves out batches that are not in the snapshot, ``buckets`` all other buckets.
        Blocks come with the status that counts.
        """
        kind = KINDS[table]
        df, height = self.scan(table), F.col(kind.height_col)
        if at is not None:
            df = df.where(F.col(BATCH_COL).isin(at[table]))
        if buckets is not None:
            df = df.where(F.col(BUCKET_COL).isin(list(buckets)))
        if heights is not None:
            wanted = [int(h) for h in heights]
            own = [self.bucket_of(F.lit(h)) for h in wanted]
            df = df.where(height.isin(wanted) & F.col(BUCKET_COL).isin(own))
        if between is not None:
            batches = self._batches_within(table, *between)
            if batches is not None:
                df = df.where(F.col(BATCH_COL).isin(batches))
            df = df.where(height.between(*between))
        df = df.select(*kind.columns)
        return self.status.over(df) if table == "blocks" else df

    # -- figures of the stored batches ---------------------------------------
    def _figures(self, table: str) -> str:
        return f"{self.root}/_figures/{table}"

    def arrivals(self, table: str) -> DataFrame:
        """(height_bucket, ingest_batch, height, block_hash, rows, digest) of every batch.

        Figures are made once a batch, from its key columns. An append forgets those of
        its batch, a compaction makes those of its generation anew.
        """
        path, kind = self._figures(table), KINDS[table]
        stored = self._batches(self.path(table))
        known = {n.split("=", 1)[1] for n in storage.child_names(self.spark, path)
                 if n.startswith(f"{BATCH_COL}=")}
        for batch in known - stored:
            storage.delete(self.spark, f"{path}/{BATCH_COL}={batch}")
        new = sorted(stored - known)
        if new:
            part = self.scan(table)
            if known & stored:
                part = part.where(F.col(BATCH_COL).isin(new))
            (part.groupBy(BUCKET_COL, BATCH_COL, F.col(kind.height_col).alias("height"),
                          F.col(kind.block_col).alias("block_hash"))
             .agg(F.count("*").alias("rows"),
                  F.sum(key_digest(*kind.key)).cast(DIGEST).alias("digest"))
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy(BATCH_COL).parquet(path))
        storage.make_dirs(self.spark, path)
        return self.spark.read.schema(f"{_FIGURES}, {BATCH_COL} STRING").parquet(path)

    def _batches(self, path: str) -> set[str]:
        return {n.split("=", 1)[1] for bucket in self._buckets(path)
                for n in storage.child_names(self.spark, f"{path}/{bucket}")
                if n.startswith(f"{BATCH_COL}=")}

    def _batches_within(self, table: str, lo: int, hi: int) -> list[str] | None:
        """Batches that hold a height of the range; None where there is nothing to leave out."""
        if len(self._batches(self.path(table))) < 2:
            return None
        return sorted(r[0] for r in self.arrivals(table).where(F.col("height").between(lo, hi))
                      .select(BATCH_COL).distinct().collect())

    def counts_at_heights(self, heights: Sequence[int]) -> DataFrame:
        """Rows of each table at the given heights, in one job over the figures of the batches."""
        wanted = [int(h) for h in heights]
        out = None
        for table in KINDS:
            rows = self.arrivals(table).where(F.col("height").isin(wanted))
            part = rows.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("row_count")).select(
                F.lit(table).alias("table_name"), "row_count")
            out = part if out is None else out.unionByName(part)
        return out

    def high_water(self, table: str = "blocks", column: str = "height") -> int:
        return self.read(table).agg(F.coalesce(F.max(column), F.lit(-1))).first()[0]

    # -- statuses ----------------------------------------------------------
    def set_status(self, changes: DataFrame, portion: str | None = None) -> None:
        """New statuses (block_hash, finality_status) of stored blocks, one row a block.

        The log is written first; from then on every read has them. Then the folders that
        hold a changed row take them over by copy-on-write, so that plain scans see them,
        too. A folder that a compaction has taken away meanwhile, or that its stream may
        still write again, is left to the log.
        """
        portion = portion or uuid.uuid4().hex
        staging = storage.new_dir(self.spark, "status")
        new = changes.select("block_hash", F.col("finality_status").alias("_new"))
        current = self.status.over(self.scan("blocks"))
        differing = current.join(new, "block_hash").where(
            ~F.col("finality_status").eqNullSafe(F.col("_new")))
        differing.select("block_hash", F.col("_new").alias("finality_status"), BUCKET_COL,
                         BATCH_COL).write.parquet(f"{staging}/changes")
        changed = self.spark.read.parquet(f"{staging}/changes")
        if changed.isEmpty():
            storage.delete(self.spark, staging)
            return
        self.status.append(changed.select("block_hash", "finality_status", F.lit(None).cast(
            "bigint").alias("offset")).distinct(), portion)
        self._fold_status(changed.select(BUCKET_COL, BATCH_COL).distinct(), staging, portion)
        storage.delete(self.spark, staging)

    def _fold_status(self, folders: DataFrame, staging: str, portion: str) -> None:
        path = self.path("blocks")
        settled = self._foldable(path, True)
        folders = folders.where(F.col(BATCH_COL).isin(settled))
        part = self.scan("blocks").join(folders, [BUCKET_COL, BATCH_COL], "left_semi")
        columns = self.scan("blocks").columns
        self._write(self.status.over(part).select(*columns), f"{staging}/folders")
        self._swap_in(path, f"{staging}/folders", f"{_FOLDED}{portion}")

    def _swap_in(self, path: str, staged: str, aside: str) -> None:
        """Puts staged folders in the place of those of the same name that are still there."""
        for bucket in self._buckets(staged):
            for batch in storage.child_names(self.spark, f"{staged}/{bucket}"):
                own = f"{bucket}/{batch}"
                try:
                    storage.rename(self.spark, f"{path}/{own}", f"{path}/{aside}/{own}")
                except OSError:
                    continue
                storage.rename(self.spark, f"{staged}/{own}", f"{path}/{own}")
        storage.delete(self.spark, f"{path}/{aside}")
        self.spark.catalog.refreshByPath(path)

    # -- maintenance -------------------------------------------------------
    def compact(self, table: str, generation: str, everything: bool = False) -> dict[str, int]:
        """Fold the batches of every bucket into one, in as few files as the size allows.

        Batches compacted earlier are left alone unless ``everything`` is set,
        so a regular run costs as much as what arrived since the last one. The
        compacted copy is staged and counted; then the folders that were read are
        swapped by rename, bucket by bucket; batches that arrive meanwhile stay. The
        newest batch of each stream may still be repeated and is left alone, too. Replaced folders stay aside under a hidden
        name until all swaps are done; the next run puts an interrupted one right.
        """
        path, new_batch = self.path(table), f"{COMPACTED}-{generation}"
        self._put_right(path)
        files_before = storage.data_file_count(self.spark, path)
        batches = self._foldable(path, everything)
        if not batches:
            return {"files_before": files_before, "files_after": files_before}
        listed = {bucket: set(batches) & self._in_bucket(path, bucket)
                  for bucket in self._buckets(path)}
        source = self.scan(table).where(F.col(BATCH_COL).isin(batches))
        staging = storage.new_dir(self.spark, f"compact-{table}")
        folded = self.status.over(source) if table == "blocks" else source
        (folded.withColumn(BATCH_COL, F.lit(new_batch)).hint("rebalance", F.col(BUCKET_COL))
         .sortWithinPartitions(BUCKET_COL, KINDS[table].height_col)
         .write.option("compression", "zstd").partitionBy(BUCKET_COL, BATCH_COL).parquet(staging))
        rows = source.count()
        staged = self.spark.read.schema(source.schema).parquet(staging).count()
        if rows != staged:
            raise RuntimeError(f"{table}: staged {staged} rows for {rows}; table left as it was")
        aside = f"{path}/{_ASIDE}{generation}"
        for bucket in self._buckets(staging):
            if not listed[bucket] <= self._in_bucket(path, bucket):
                continue  # another rewrite has one of its folders; the next run takes it
            for batch in sorted(listed[bucket]):
                storage.rename(self.spark, f"{path}/{bucket}/{BATCH_COL}={batch}",
                               f"{aside}/{bucket}/{BATCH_COL}={batch}")
            storage.rename(self.spark, f"{staging}/{bucket}/{BATCH_COL}={new_batch}",
                           f"{path}/{bucket}/{BATCH_COL}={new_batch}")
        storage.delete(self.spark, aside)
        storage.delete(self.spark, staging)
        storage.delete(self.spark, f"{self._figures(table)}/{BATCH_COL}={new_batch}")
        self.spark.catalog.refreshByPath(path)
        if table == "blocks":
            self.status.fold(generation)
        return {"files_before": files_before,
                "files_after": storage.data_file_count(self.spark, path)}

    def _foldable(self, path: str, everything: bool) -> list[str]:
        """Batches a compaction takes in, as they are when it starts."""
        found = self._batches(path)
        newest: dict[str, str] = {}
        for name in found:
            stream = _STREAM_BATCH.fullmatch(name)
            if stream:
                newest[stream[1]] = max(newest.get(stream[1], ""), name)
        return sorted(n for n in found - set(newest.values())
                      if everything or not n.startswith(f"{COMPACTED}-"))

    def _buckets(self, path: str) -> list[str]:
        return [n for n in storage.child_names(self.spark, path) if n.startswith(f"{BUCKET_COL}=")]

    def _in_bucket(self, path: str, bucket: str) -> set[str]:
        return {n.split("=", 1)[1] for n in storage.child_names(self.spark, f"{path}/{bucket}")
                if n.startswith(f"{BATCH_COL}=")}

    def _put_right(self, path: str) -> None:
        """Finish or undo the swaps of an interrupted compaction or status fold.

        A bucket that got its compacted folder is done; any other takes its
        replaced folders back. A folder whose folded form is missing comes back, too.
        """
        for aside in storage.child_names(self.spark, path):
            if aside.startswith(_FOLDED):
                self._take_back(path, aside)
            if not aside.startswith(_ASIDE):
                continue
            done = f"{BATCH_COL}={COMPACTED}-{aside[len(_ASIDE):]}"
            for bucket in self._buckets(f"{path}/{aside}"):
                if storage.exists(self.spark, f"{path}/{bucket}/{done}"):
                    continue
                for batch in storage.child_names(self.spark, f"{path}/{aside}/{bucket}"):
                    storage.rename(self.spark, f"{path}/{aside}/{bucket}/{batch}",
                                   f"{path}/{bucket}/{batch}")
            storage.delete(self.spark, f"{path}/{aside}")

    def _take_back(self, path: str, aside: str) -> None:
        for bucket in self._buckets(f"{path}/{aside}"):
            for batch in storage.child_names(self.spark, f"{path}/{aside}/{bucket}"):
                if not storage.exists(self.spark, f"{path}/{bucket}/{batch}"):
                    storage.rename(self.spark, f"{path}/{aside}/{bucket}/{batch}",
                                   f"{path}/{bucket}/{batch}")
        storage.delete(self.spark, f"{path}/{aside}")


def overwrite_by(df: DataFrame, path: str, partition_cols: Sequence[str]) -> None:
    """Replace the partitions present in ``df`` and leave all others alone."""
    (df.hint("rebalance", *[F.col(c) for c in partition_cols])
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .option("compression", "zstd").partitionBy(*partition_cols).parquet(path))
