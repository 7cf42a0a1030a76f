"""Previous-row and running-total operators that never put a whole key in one task.

A plain ``lag`` or running ``sum`` sorts every row of its window partition in a
single task. Here an ordered sequence is cut into bands, each band is handled on
its own, and a small table with one row per band carries the value across the
border. The answer is the same as with one large window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.operators.skew import HOT_ROWS, hot_keys

BAND_WIDTH = 1 << 20
MAX_PIECES = 20_000


def _lag_over_bands(df: DataFrame, keys: list[str], order: list[str], value: str, band: str,
                    out: str) -> DataFrame:
    in_band = Window.partitionBy(*keys, band).orderBy(*order)
    local = (df.withColumn("_rn", F.row_number().over(in_band))
             .withColumn("_local", F.lag(value).over(in_band)))
    tails = (df.groupBy(*keys, band)
             .agg(F.max_by(F.col(value), F.struct(*order)).alias("_tail")))
    across = Window.partitionBy(*keys).orderBy(band) if keys else Window.orderBy(band)
    heads = tails.select(*keys, band, F.lag("_tail").over(across).alias("_carry"))
    joined = local.join(heads, [*keys, band], "left")
    result = F.when(F.col("_rn") == 1, F.col("_carry")).otherwise(F.col("_local"))
    return joined.select(*[c for c in df.columns if c != band], result.alias(out))


def lag_by_number(df: DataFrame, number: str, value: str, out: str,
                  keys: list[str] | None = None, width: int = BAND_WIDTH) -> DataFrame:
    """``value`` of the row with the next lower ``number`` (unique per key).

    The number itself gives the bands, so a band holds at most ``width`` rows
    and the border table one row per ``width`` numbers.
    """
    banded = df.withColumn("_band", F.floor(F.col(number) / width))
    return _lag_over_bands(banded, keys or [], [number], value, "_band", out)


def running_sum(df: DataFrame, number: str, value: str, out: str,
                width: int = BAND_WIDTH) -> DataFrame:
    """Running total of ``value`` in order of the unique ``number``."""
    banded = df.withColumn("_band", F.floor(F.col(number) / width))
    in_band = (Window.partitionBy("_band").orderBy(number)
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = banded.withColumn("_local", F.sum(value).over(in_band))
    before = Window.orderBy("_band").rowsBetween(Window.unboundedPreceding, -1)
    totals = (banded.groupBy("_band").agg(F.sum(value).alias("_total"))
              .select("_band", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_base")))
    joined = local.join(totals, "_band", "left")
    return joined.select(*df.columns, (F.col("_local") + F.col("_base")).alias(out))


def lag_in_key(df: DataFrame, key: str, order: list[str], value: str, out: str,
               hot_rows: int | None = None) -> DataFrame:
    """``value`` of the previous row of the same ``key``; ``order`` must be unique per key.

    Keys of ordinary size take one window. A hot key is cut along split points
    drawn from its own order values, as a range partitioning does; the split
    points only balance the work and cannot change the result.
    """
    plain = Window.partitionBy(key).orderBy(*order)
    hot = hot_keys(df, key, hot_rows)
    if not hot:
        return df.withColumn(out, F.lag(value).over(plain))
    is_hot = F.coalesce(F.col(key).isin(list(hot)), F.lit(False))
    cold = df.where(~is_hot).withColumn(out, F.lag(value).over(plain))
    splits = _split_points(df.where(is_hot), key, order, hot, hot_rows or HOT_ROWS)
    here = F.struct(*order)
    heavy = (df.where(is_hot).join(F.broadcast(splits), key)
             .withColumn("_band", F.size(F.filter("_splits", lambda s: s <= here)))
             .drop("_splits"))
    return cold.unionByName(_lag_over_bands(heavy, [key], order, value, "_band", out))


def _split_points(df: DataFrame, key: str, order: list[str], hot: dict, limit: int) -> DataFrame:
    """One row per hot key with its sorted split points.

    All keys together get at most ``MAX_PIECES`` pieces and 20 sampled rows per
    piece, which bounds what is collected and what is broadcast.
    """
    scale = min(1.0, MAX_PIECES / sum(2.0 * n / limit for n in hot.values()))
    pieces = {k: max(2, int(2.0 * n / limit * scale)) for k, n in hot.items()}
    fractions = {k: min(1.0, 20.0 * pieces[k] / hot[k]) for k in hot}
    drawn: dict = {k: [] for k in hot}
    for row in df.select(key, *order).sampleBy(key, fractions, seed=7).collect():
        drawn[row[key]].append(tuple(row[c] for c in order))
    rows = []
    for k, points in drawn.items():
        points.sort()
        step = max(1, len(points) // pieces[k])
        rows.append((k, points[step::step]))
    types = df.select(key, *order).schema
    fields = ", ".join(f"{c}: {types[c].dataType.simpleString()}" for c in order)
    schema = f"{key} {types[key].dataType.simpleString()}, _splits array<struct<{fields}>>"
    return df.sparkSession.createDataFrame(rows, schema)
