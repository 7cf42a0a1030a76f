"""Best-fit packing with conflicts.

Texts are packed into sequences (bins) of ``capacity`` words. Open bins stand in
order of what room they have left. Each carries bitmaps of the sources and the
duplicate clusters in it: a cluster comes once into a bin, a source at most
``per_source`` times (one bitmap per time). The search for a place starts at the
tightest bin with room enough and goes on to the next until one has no conflict;
if none has, a new bin opens. Larger pieces are placed before smaller ones.

A text longer than a bin is cut into full bins, which need no search, and a rest.
Rests and short texts are dealt by hash into groups of about ``GROUP`` pieces;
groups are packed side by side, their number grows with the input, and a source
or cluster with a third of all rows is spread over all of them like any other.

Null and empty texts need no room: they get one row without a bin. Rows without a
source share one source; rows without an id are packed like others; repeated rows
are copies of each other. Other columns of the input are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import common

CAPACITY = 4096
PER_SOURCE = 4
GROUP = 4096
WORD = r"[^\x20\x09-\x0D]+"


def best_fit(pieces: list[tuple[int, str | None, int]], capacity: int,
             per_source: int) -> list[tuple[int, int]]:
    """(bin, start in it) of each (size, source, cluster), sizes 1 to ``capacity``."""
    many = Counter(p[2] for p in pieces)
    clusters = {c: 1 << k for k, c in enumerate(sorted(c for c, n in many.items() if n > 1))}
    sources = {s: 1 << k for k, s in enumerate(dict.fromkeys(p[1] for p in pieces))}
    order: list[tuple[int, int]] = []      # (room left, bin), ascending
    held: list[int] = []                   # clusters of each bin
    planes: list[list[int]] = []           # sources that are in a bin k + 1 times or more
    out: list[tuple[int, int]] = [(0, 0)] * len(pieces)
    for i in sorted(range(len(pieces)), key=lambda k: -pieces[k][0]):
        size, source, cluster = pieces[i]
        s, c = sources[source], clusters.get(cluster, 0)
        at = bisect_left(order, (size, -1))
        while at < len(order) and (held[order[at][1]] & c or planes[order[at][1]][-1] & s):
            at += 1
        if at < len(order):
            room, b = order.pop(at)
        else:
            room, b = capacity, len(held)
            held.append(0)
            planes.append([0] * per_source)
        out[i] = (b, capacity - room)
        held[b] |= c
        for k in range(per_source):
            if not planes[b][k] & s:
                planes[b][k] |= s
                break
        if room > size:
            insort(order, (room - size, b))
    return out


def _packed(capacity: int, per_source: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("n_words", "descending"), ("doc_id", "ascending"),
                               ("row", "ascending")])
        places = best_fit(list(zip(table["n_words"].to_pylist(), table["source"].to_pylist(),
                                   table["cluster"].to_pylist())), capacity, per_source)
        group = table["grp"][0].as_py()
        return table.select(["doc_id", "piece", "first_word", "n_words"]).append_column(
            "bin_id", pa.array([f"{group}.{b}" for b, _ in places])).append_column(
            "bin_start", pa.array([s for _, s in places], pa.int64()))
    return run


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         source_col: str | None = "source", cluster_col: str | None = None,
         capacity: int = CAPACITY, per_source: int = PER_SOURCE) -> DataFrame:
    """One row per piece: doc_id, piece, first_word, n_words, bin_id, bin_start.

    Without ``cluster_col`` equal texts, up to case and outer spaces, are a cluster.
    """
    text = F.col(text_col)
    cluster = F.col(cluster_col) if cluster_col else F.lower(F.trim(text))
    source = F.col(source_col).cast("string") if source_col else F.lit(None).cast("string")
    sized = common.written(docs.select(
        F.col(id_col).cast("long").alias("doc_id"), source.alias("source"),
        F.xxhash64(cluster).alias("cluster"),
        F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("n_words")),
        "sized").withColumn("row", F.monotonically_increasing_id())
    full = F.floor(F.col("n_words") / capacity)
    rest = F.col("n_words") % capacity
    whole = (sized.where(F.col("n_words") >= capacity)
             .withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), full - 1)))
             .select("doc_id", "piece", (F.col("piece") * capacity).alias("first_word"),
                     F.lit(capacity).cast("long").alias("n_words"),
                     F.concat_ws(".", F.lit("full"), "row", "piece").alias("bin_id"),
                     F.lit(0).cast("long").alias("bin_start")))
    empty = sized.where("n_words = 0").select(
        "doc_id", F.lit(0).cast("long").alias("piece"), F.lit(0).cast("long").alias("first_word"),
        "n_words", F.lit(None).cast("string").alias("bin_id"),
        F.lit(None).cast("long").alias("bin_start"))
    parts = sized.where(rest > 0)
    groups = max(1, -(-parts.count() // GROUP))
    dealt = parts.select(
        "doc_id", "source", "cluster", "row", full.alias("piece"),
        (full * capacity).alias("first_word"), rest.alias("n_words"),
        F.pmod(F.xxhash64("doc_id", "cluster", "row"), F.lit(groups)).alias("grp"))
    packed = dealt.groupBy("grp").applyInArrow(
        _packed(capacity, per_source),
        "doc_id long, piece long, first_word long, n_words long, bin_id string, bin_start long")
    return packed.unionByName(whole).unionByName(empty)
