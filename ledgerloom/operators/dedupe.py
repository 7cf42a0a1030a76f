"""One row per identity key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom import storage
from ledgerloom.operators.broadcasting import MAX_BROADCAST_BYTES
from ledgerloom.schemas import KINDS


def keep_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order`` per key; ties fall to the remaining columns.

    An aggregate, not a window: copies of one key already collapse on the map
    side, so a key with very many copies costs nothing in the shuffle.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    best = F.max(F.struct(*order, *rest)).alias("_best")
    return (df.groupBy(*keys).agg(best)
            .select(*[F.col(c) if c in keys else F.col(f"_best.{c}").alias(c)
                      for c in df.columns]))


def drop_copies(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """As ``keep_latest`` for a stored frame in which copies are few.

    Keys are counted by their 64-bit hash first, which shuffles 16 bytes a row and sorts
    nothing. Rows whose hash is alone pass as they are; only the others, copies and
    the rare collision, are compared as whole rows. Where very many keys have copies, all
    rows are.
    """
    (mark,) = [n for n in ("_key_hash", "_key_hash_") if n not in df.columns][:1]
    hashed = df.withColumn(mark, F.xxhash64(*keys))
    twice, path = hashed.groupBy(mark).count().where("count > 1").select(mark), storage.new_dir(
        df.sparkSession, "copies")
    twice.write.parquet(path)   # counted once, for what is asked of it here and by the result
    twice = df.sparkSession.read.schema(twice.schema).parquet(path)
    found = twice.count()
    if not found or found * 16 > MAX_BROADCAST_BYTES:
        storage.delete(df.sparkSession, path)
        return keep_latest(df, keys, order) if found else df
    twice = F.broadcast(twice)
    alone = hashed.join(twice, mark, "left_anti").drop(mark)
    copies = hashed.join(twice, mark, "left_semi").drop(mark)
    return alone.unionByName(keep_latest(copies, keys, order))


def dedupe_identity(df: DataFrame, table: str) -> DataFrame:
    """Copies left by overlapping replays removed; the last ingested one wins."""
    return drop_copies(df, KINDS[table].key, ["ingested_at"])


def latest_per_key(df: DataFrame, key: str, offset: str) -> DataFrame:
    """A changelog reduced to the last row of each key, as a compacted topic keeps it."""
    return keep_latest(df, [key], [offset])
