"""Helpers the operators share: tables, folders, fixed-size bit sets, connected components."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom import storage

MAX_BITS = 1 << 27  # a bit set sent to every executor never takes more than 16 MB
BATCH_ROWS = 500

MIX = [np.uint64(x) for x in (0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xFF51AFD7ED558CCD)]
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
SPACES = np.zeros(256, bool)
SPACES[[32, *range(9, 14)]] = True


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Bounds what a Python worker holds of long texts at once."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(32 << 20))


def written_at(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Writes ``df`` below the shared folder; what is read from there, and the folder."""
    spark = df.sparkSession
    path = storage.new_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def written(df: DataFrame, label: str) -> DataFrame:
    """Cuts the lineage: ``df`` as written below the shared folder and read from there."""
    return written_at(df, label)[0]


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, lengthened until no column of ``df`` has them."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def in_fold(doc_id: str = "doc_id", fold: int = 2):
    """Is crc32 of the id as text congruent to ``fold`` modulo 4? Rows without an id are not."""
    crc = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    return F.coalesce(crc % 4 == fold, F.lit(False))


def bits_for(count: int, per_item: int = 64) -> int:
    """A power of two with ``per_item`` bits for each of ``count`` items, at most MAX_BITS."""
    return min(MAX_BITS, max(1 << 15, 1 << int(count * per_item).bit_length()))


def bit_set(positions: DataFrame, column: str, bits: int) -> np.ndarray:
    """The set of the column's values (0 to bits - 1) as packed bits, at most 16 MB.

    Spark builds it in pieces of 4 KB; only those pieces come to the driver.
    """
    at = F.col(column) + 1
    rows = (positions.groupBy(F.bitmap_bucket_number(at).alias("piece"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits")).collect())
    out = np.zeros(bits // 8, np.uint8)
    for r in rows:
        start = (r["piece"] - 1) * 4096
        out[start:start + 4096] = np.frombuffer(bytes(r["bits"]), np.uint8)[:len(out) - start]
    return out


def has_bit(packed: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (packed[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root): the smallest node each node of an edge can reach.

    Large-star and small-star rounds; each round is checkpointed in the shared
    folder and no step gathers a neighbourhood in one place.
    """
    context = edges.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(storage.shared_dir(edges.sparkSession))
    u, v = F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    links = edges.where(F.col(a) != F.col(b)).select(u, v).distinct().checkpoint()
    state = None
    while True:
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (both.join(low, "u").where("v > u")
                 .select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
                 .where("u != v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = (joined.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low.select("u", F.col("m").alias("v")))
                 .distinct().checkpoint())
        now = small.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        links = small
        if tuple(now) == state:
            break
        state = tuple(now)
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads close values."""
    x = (x ^ (x >> np.uint64(31))) * MIX[0]
    x = (x ^ (x >> np.uint64(29))) * MIX[1]
    return x ^ (x >> np.uint64(32))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _bounds(buf: np.ndarray, offsets: np.ndarray,
            separator: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    word = ~separator[buf]
    first = np.zeros(len(buf) + 1, bool)
    first[offsets] = True
    start = np.flatnonzero(word & (first[:-1] | np.r_[True, ~word[:-1]]))
    return start, np.flatnonzero(word & (first[1:] | np.r_[~word[1:], True])) + 1


def word_hashes(buf: np.ndarray, offsets: np.ndarray, separator: np.ndarray,
                prefixes: tuple[int, ...] = ()) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of several texts, and where each text's words begin.

    ``buf`` holds the texts' UTF-8 bytes end to end, ``separator`` marks the bytes
    between words, and A-Z count as a-z. A word's hash is the difference of two
    prefix sums, so it does not depend on where the word stands. With ``prefixes``
    the hashes have a row more for each: of the words' first so many bytes.
    """
    start, end = _bounds(buf, offsets, separator)
    h = np.zeros((1 + len(prefixes), len(start)), np.uint64)
    block = 1 << 20  # words of so many bytes at a time share one table of powers
    at = 0
    while at < len(start):
        upto = max(at + 1, int(np.searchsorted(end, start[at] + block, "right")))
        lo, hi = start[at], end[upto - 1]
        power = _powers(_BASE, hi - lo)
        sums = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum((_LOWER[buf[lo:hi]].astype(np.uint64) + np.uint64(1)) * power, out=sums[1:])
        s, e = start[at:upto] - lo, end[at:upto] - lo
        back = _powers(_INVERSE, hi - lo)
        for k, n in enumerate((hi - lo, *prefixes)):
            h[k, at:upto] = (sums[np.minimum(e, s + n)] - sums[s]) * back[s]
        at = upto
    return mixed(h if prefixes else h[0]), np.searchsorted(start, offsets)


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)
    offsets = offsets[texts.offset:texts.offset + len(texts) + 1]
    if not len(offsets):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    data = texts.buffers()[2]
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[offsets[0]:offsets[-1]], offsets - offsets[0]


def words_of(texts: pa.Array, separator: np.ndarray, marks: np.ndarray | None = None,
             prefixes: tuple[int, ...] = ()):
    """Hashes of all words of the texts, and where each text's words begin (one more at the end).

    With ``marks``, also which words hold one of the marked bytes.
    """
    buf, offsets = _bytes_of(texts)
    hashes, begin = word_hashes(buf, offsets, separator, prefixes)
    return (hashes, begin) if marks is None else (hashes, begin, _hold(
        buf, offsets, separator, marks[buf]))


def words_with(texts: pa.Array, separator: np.ndarray, part: str) -> np.ndarray:
    """Which words hold ``part``, ASCII without separators."""
    buf, offsets = _bytes_of(texts)
    raw = part.encode()
    at = np.ones(max(0, len(buf) - len(raw) + 1), bool)
    for k, c in enumerate(raw):
        at &= buf[k:len(buf) - len(raw) + 1 + k] == c
    return _hold(buf, offsets, separator, np.r_[at, np.zeros(len(buf) - len(at), bool)])


def _hold(buf, offsets, separator, here: np.ndarray) -> np.ndarray:
    start, end = _bounds(buf, offsets, separator)
    sums = np.r_[0, np.cumsum(here)]
    return sums[end] > sums[start]
