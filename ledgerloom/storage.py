"""Working folders and the few file-system calls the lake needs.

Every path goes through Hadoop's FileSystem, so the same code serves a local
disk, HDFS or an object store.
"""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
_OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session.

    Only a local master may do without the setting; it then gets one fresh
    temporary folder per application.
    """
    configured = (spark.conf.get(CHECKPOINT_CONF, None)
                  or spark.sparkContext.getConf().get(CHECKPOINT_CONF))
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="ledgerloom-")
    return _local_dirs[app]


def new_dir(spark: SparkSession, label: str) -> str:
    """A fresh, not yet existing folder below the shared one."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex[:10]}"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


@contextlib.contextmanager
def open_files(spark: SparkSession, count: int) -> Iterator[None]:
    """Writes planned inside keep up to ``count`` folders' files open at once, unsorted."""
    before = spark.conf.get(_OPEN_FILES)
    spark.conf.set(_OPEN_FILES, count)
    try:
        yield
    finally:
        spark.conf.set(_OPEN_FILES, before)


def drop_shuffles(spark: SparkSession) -> None:
    """From now on the session deletes what a query has shuffled when that query is over.

    Else those files stay until the driver happens to collect its garbage, so that a chain of
    writes keeps all of them on disk. A frame that is run once more shuffles once more.
    """
    spark.conf.set(_DROP_SHUFFLES, "true")


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def make_dirs(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.mkdirs(p)


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def rename(spark: SparkSession, source: str, target: str) -> None:
    """Fails with ``OSError`` where the source is gone or the target cannot be made."""
    fs, src = _fs(spark, source)
    _, dst = _fs(spark, target)
    if not fs.exists(src):
        raise OSError(f"{source} is gone")
    fs.mkdirs(dst.getParent())
    if not fs.rename(src, dst):
        raise OSError(f"could not rename {source} to {target}")


def move_files(spark: SparkSession, source: str, target: str) -> None:
    """Every visible file below ``source`` to its place below ``target``; names are unique."""
    for name in child_names(spark, source):
        if name.startswith(("_", ".")):
            continue
        fs, child = _fs(spark, f"{source}/{name}")
        if fs.getFileStatus(child).isDirectory() and exists(spark, f"{target}/{name}"):
            move_files(spark, f"{source}/{name}", f"{target}/{name}")
        else:
            rename(spark, f"{source}/{name}", f"{target}/{name}")


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes of the files below ``path``."""
    fs, p = _fs(spark, path)
    return fs.getContentSummary(p).getLength() if fs.exists(p) else 0


def child_names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p))


def data_file_count(spark: SparkSession, path: str) -> int:
    """Visible data files below ``path`` (names starting with _ or . are hidden)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return 0
    count, listing = 0, fs.listFiles(p, True)
    root = p.toUri().getPath()
    while listing.hasNext():
        below = listing.next().getPath().toUri().getPath()[len(root):]
        if not any(part.startswith(("_", ".")) for part in below.split("/") if part):
            count += 1
    return count
