"""Finding keys that hold too many rows for one task, and joining around them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.broadcasting import MAX_BROADCAST_BYTES, measured_bytes

HOT_ROWS = 2_000_000
SAMPLE_ROWS = 2_000_000
MAX_HOT_KEYS = 10_000
SALTS = 64


def hot_keys(df: DataFrame, key: str, hot_rows: int | None = None) -> dict:
    """Keys estimated to hold more than ``hot_rows`` rows, with the estimate.

    A frame of at most ``hot_rows`` rows is only counted, which Parquet answers
    from its footers. A larger one is estimated from a sample of the key column.
    The estimate steers how work is spread and never what comes out. A threshold
    below 1/10,000 of all rows is raised to that, so the answer stays small.
    """
    total = df.count()
    limit = max(hot_rows or HOT_ROWS, total // MAX_HOT_KEYS)
    if total <= limit:
        return {}
    fraction = min(1.0, SAMPLE_ROWS / total)
    found = (df.select(key).sample(fraction, seed=11).groupBy(key)
             .agg(F.count("*").alias("n")).where(F.col("n") > limit * fraction)
             .where(F.col(key).isNotNull()).collect())
    return {r[key]: int(r["n"] / fraction) for r in found}


def join_many_to_one(many: DataFrame, one: DataFrame, key: str, how: str = "inner",
                     hot_rows: int | None = None) -> DataFrame:
    """``many.join(one, key, how)`` for ``inner`` or ``left`` where some keys may be hot.

    Rows of hot keys stay where they are and meet their few partners by
    broadcast; all other rows take the ordinary join. Without hot keys the plan
    is the ordinary join alone.
    """
    hot = list(hot_keys(many, key, hot_rows))
    if not hot:
        return many.join(one, key, how)
    is_hot = F.coalesce(F.col(key).isin(hot), F.lit(False))
    cold = many.where(~is_hot).join(one.where(~is_hot), key, how)
    heavy, partners = many.where(is_hot), one.where(is_hot)
    if measured_bytes(partners) <= MAX_BROADCAST_BYTES:
        return cold.unionByName(heavy.join(F.broadcast(partners), key, how))
    # too many partners to send everywhere: each meets its rows in SALTS portions
    heavy = heavy.withColumn("_salt", F.pmod(F.xxhash64(*many.columns), F.lit(SALTS)).cast("int"))
    partners = partners.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return cold.unionByName(heavy.join(partners, [key, "_salt"], how).drop("_salt"))
