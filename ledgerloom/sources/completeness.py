"""Which blocks have arrived as a whole.

A publisher says of every document how many records of each kind it holds, and a digest
of their keys: the sum of a 64-bit hash of each. A lake keeps the same figures of every
stored batch (``Lake.arrivals``). A block is whole when both agree in all four tables;
where copies are stored, their keys are compared once each. Neither the order in which
files, batches or heights arrive nor how often they do matters.

Blocks nobody counted (a dump, frames appended by hand) pass as whole when every table
holds some of them; that cannot see a part of a table that is still to come, and a block
without any record of a kind waits until somebody counts it.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom import functions as L
from ledgerloom.operators.broadcasting import broadcast_if_small
from ledgerloom.schemas import BATCH_COL, COINBASE_INDEX, KINDS, ZERO_HASH

if TYPE_CHECKING:
    from ledgerloom.sources.lake import Lake

DIGEST = "decimal(38,0)"
EXPECTED = f"block_hash STRING, slice INT, height INT, table_name STRING, rows BIGINT, digest {DIGEST}"


def _key_hash(*key: Column | str) -> Column:
    return F.xxhash64(L.composite_key(*key))


def key_digest(*key: Column | str) -> Column:
    """One record's share of the digest."""
    return _key_hash(*key).cast(DIGEST)


def _of_keys(keys: Column) -> tuple[Column, Column]:
    once = F.array_distinct(keys)
    total = F.aggregate(once, F.lit(0).cast(DIGEST),
                        lambda s, k: (s + F.xxhash64(k).cast(DIGEST)).cast(DIGEST))
    return F.size(once).cast("bigint"), total


def document_figures(block_hash: Column, tx: Column, is_first: Column,
                     is_first_piece) -> Column:
    """An array of (table_name, rows, digest) for one document, each key counted once."""
    def inputs(t: Column) -> Column:
        return F.transform(t["vin"], lambda v: L.composite_key(
            t["txid"],
            F.when(v["coinbase"].isNotNull(), F.lit(ZERO_HASH)).otherwise(v["txid"]),
            F.when(v["coinbase"].isNotNull(), F.lit(COINBASE_INDEX)).otherwise(v["vout"])))

    def outputs(t: Column) -> Column:
        return F.transform(t["vout"], lambda v: L.composite_key(t["txid"], v["n"]))

    none = F.array().cast("array<string>")
    keys = {
        "blocks": F.when(is_first, F.array(block_hash)).otherwise(none),
        "transactions": F.transform(F.filter(tx, is_first_piece), lambda t: t["txid"]),
        "tx_in": F.flatten(F.transform(tx, lambda t: F.coalesce(inputs(t), none))),
        "tx_out": F.flatten(F.transform(tx, lambda t: F.coalesce(outputs(t), none))),
    }
    figures = []
    for table in KINDS:
        rows, digest = _of_keys(F.coalesce(keys[table], none))
        figures.append(F.struct(F.lit(table).alias("table_name"), rows.alias("rows"),
                                digest.alias("digest")))
    return F.array(*figures)


def _expected(lake: Lake) -> DataFrame:
    """(block_hash, table_name, height, rows, digest) that publishers have announced."""
    once = lake.expected().groupBy("block_hash", "slice", "table_name").agg(
        F.max("height").alias("height"), F.max("rows").alias("rows"),
        F.max("digest").alias("digest"))
    return once.groupBy("block_hash", "table_name").agg(
        F.max("height").alias("height"), F.sum("rows").alias("want_rows"),
        F.sum("digest").cast(DIGEST).alias("want_digest"), F.max("slice").alias("slices"))


Snapshot = dict[str, list[str]]


def _arrived(lake: Lake, at: Snapshot | None) -> DataFrame:
    out = None
    with ThreadPoolExecutor(len(KINDS)) as pool:   # figures that are still to be made
        figures = list(pool.map(lake.arrivals, KINDS))
    for table, rows in zip(KINDS, figures):
        if at is not None:
            rows = rows.where(F.col(BATCH_COL).isin(at[table]))
        part = rows.select(F.lit(table).alias("table_name"), "block_hash", "height", "rows", "digest")
        out = part if out is None else out.unionByName(part)
    return out.groupBy("block_hash", "table_name").agg(
        F.max("height").alias("height"), F.sum("rows").alias("rows"),
        F.sum("digest").cast(DIGEST).alias("digest"))


def block_states(lake: Lake, at: Snapshot | None = None) -> DataFrame:
    """(block_hash, height, state, once) of every block anybody has announced or sent.

    ``whole``; ``copies``: at least as much as announced, to be looked at key by key;
    ``short``: records are missing. ``once``: each key of the block is stored once for sure.
    With ``at`` only the batches of a snapshot count.
    """
    both = _arrived(lake, at).withColumnRenamed("height", "at").join(
        _expected(lake), ["block_hash", "table_name"], "full")
    none = F.lit(0).cast(DIGEST)
    rows, want = F.coalesce("rows", F.lit(0)), F.coalesce("want_rows", F.lit(0))
    same = (rows == want) & (F.coalesce("digest", none) == F.coalesce("want_digest", none))
    judged = both.groupBy("block_hash").agg(
        F.max(F.coalesce("height", "at")).alias("height"),
        F.bool_or(F.col("want_rows").isNotNull()).alias("counted"),
        F.bool_and(same).alias("same"), F.bool_and(rows >= want).alias("enough"),
        F.max("slices").alias("slices"),
        F.count_if(rows > 0).alias("tables"))
    state = (F.when(F.col("counted") & F.col("same"), "whole")
             .when(F.col("counted") & F.col("enough"), "copies")
             .when(~F.col("counted") & (F.col("tables") == len(KINDS)), "whole")
             .otherwise("short"))
    once = F.col("counted") & F.col("same") & (F.col("slices") == 0)
    return judged.select("block_hash", "height", state.alias("state"), once.alias("once"))


def whole_blocks(lake: Lake, but: DataFrame | None = None,
                 at: Snapshot | None = None) -> DataFrame:
    """(block_hash, height, once) of the whole blocks, without those of ``but`` (block_hash)."""
    states = block_states(lake, at)
    if but is not None:
        states = states.join(but.select("block_hash"), "block_hash", "left_anti")
    span = states.where("state = 'copies'").agg(F.min("height").alias("lo"),
                                                F.max("height").alias("hi")).first()
    whole = states.where("state = 'whole'").select("block_hash", "height", "once")
    if span.lo is None:
        return whole
    copies = states.where("state = 'copies'").select("block_hash", "height")
    found = _whole_by_key(lake, copies, (span.lo, span.hi), at)
    return whole.unionByName(found.withColumn("once", F.lit(False)))


def _whole_by_key(lake: Lake, blocks: DataFrame, span: tuple[int, int],
                  at: Snapshot | None) -> DataFrame:
    """Those of ``blocks`` whose stored keys, each once, are the announced ones."""
    hashes, out = broadcast_if_small(blocks.select("block_hash")), None
    for table, kind in KINDS.items():
        # keys go by the hash that the digest adds up
        stored = (lake.read(table, between=span, at=at)
                  .select(F.col(kind.block_col).alias("_block"), _key_hash(*kind.key).alias("_key"))
                  .join(hashes, F.col("_block") == hashes["block_hash"], "left_semi")
                  .select(L.packed("_block").alias("_block"), "_key").distinct())
        part = stored.groupBy(L.unpacked("_block").alias("block_hash")).agg(
            F.count("*").alias("rows"), F.sum(F.col("_key").cast(DIGEST)).cast(DIGEST).alias("digest")
        ).select(F.lit(table).alias("table_name"), "block_hash", "rows", "digest")
        out = part if out is None else out.unionByName(part)
    wanted = _expected(lake).drop("height").join(blocks, "block_hash", "left_semi")
    same = (F.coalesce("rows", F.lit(0)) == F.col("want_rows")) & (
        F.coalesce("digest", F.lit(0).cast(DIGEST)) == F.col("want_digest"))
    good = (wanted.join(out, ["block_hash", "table_name"], "left").groupBy("block_hash")
            .agg(F.bool_and(same).alias("good")).where("good"))
    return blocks.join(good, "block_hash", "left_semi").select("block_hash", "height")
