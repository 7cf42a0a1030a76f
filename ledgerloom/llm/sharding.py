"""Sharding by fixed virtual slots.

A record hashes into one of ``SLOTS`` virtual slots and never leaves it. Which
shard a slot belongs to is looked up in a stored map with versions: a new map
spreads the slots evenly, rebalancing edits it by the bytes measured per slot,
and a further shard takes slots from the others only into itself. Every edit is
written as the next version beside the older ones.

The rows are handled by DataFrame functions alone. Rows that agree in id, size
and checksum are one counted row until they are given their places, so no
number of repeated rows meets in one task. Only the bytes per slot, at most
``SLOTS`` numbers however large the input is, come to the driver, where the map
is edited.

A null text has size 8 and checksum 0, as an empty one has. A null id is a
value like others. Other columns are ignored by ``placed`` and pass through
``assign``. An empty table gives an empty result and an even map.
"""

from __future__ import annotations

import heapq
import json
from bisect import bisect_left, insort

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom import storage
from ledgerloom.llm import common

SLOTS = 8192
RECORD_BYTES = 8       # what a record takes besides its text
RUN = 4096             # places given out by one row at a time


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          slots: int = SLOTS) -> DataFrame:
    """(doc_id, size, text_crc32, vslot) of every record."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"),
                       (F.octet_length(text) + F.lit(RECORD_BYTES)).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"))
    return rows.withColumn("vslot", F.pmod(F.xxhash64("doc_id", "size", "text_crc32"),
                                           F.lit(slots)).cast("int"))


def bytes_per_slot(rows: DataFrame, slots: int = SLOTS) -> list[int]:
    out = [0] * slots
    for r in rows.groupBy("vslot").agg(F.sum("size").alias("b")).collect():
        out[r["vslot"]] = r["b"]
    return out


class SlotMap:
    """The versions of a slot-to-shard map in a folder all executors share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    @classmethod
    def create(cls, spark: SparkSession, path: str, shards: int, slots: int = SLOTS) -> SlotMap:
        made = cls(spark, path)
        made._write(0, [s % shards for s in range(slots)])
        return made

    def versions(self) -> list[int]:
        names = storage.child_names(self.spark, self.path)
        return sorted(int(n.split("=")[1]) for n in names if n.startswith("version="))

    def read(self, version: int | None = None) -> DataFrame:
        v = self.versions()[-1] if version is None else version
        return self.spark.read.schema("vslot int, shard int").parquet(f"{self.path}/version={v}")

    def shard_of(self, version: int | None = None) -> list[int]:
        return [r["shard"] for r in self.read(version).orderBy("vslot").collect()]

    def rebalance(self, load: list[int]) -> int:
        """Edits the newest version until the shards' bytes are near equal; returns the new one."""
        return self._next(balanced(self.shard_of(), load))

    def grow(self, load: list[int] | None = None) -> int:
        """One more shard, filled with slots of the fullest shards and changing no other slot."""
        now = self.shard_of()
        return self._next(grown(now, load or [1] * len(now)))

    def _next(self, shard_of: list[int]) -> int:
        version = self.versions()[-1] + 1
        self._write(version, shard_of)
        return version

    def _write(self, version: int, shard_of: list[int]) -> None:
        listed = F.from_json(F.lit(json.dumps(shard_of)), "array<int>")
        (self.spark.range(1).select(F.posexplode(listed).alias("vslot", "shard"))
         .write.parquet(f"{self.path}/version={version}"))


def balanced(shard_of: list[int], load: list[int], close: float = 0.001) -> list[int]:
    """The map after moves that even out the shards' bytes.

    Shards over the mean give up slots, largest first, which go to the shards
    with the least; then single slots move, or are swapped, between the fullest
    and the emptiest shard for as long as that brings the two closer.
    """
    out, shards = list(shard_of), max(shard_of) + 1
    held: list[list[tuple[int, int]]] = [[] for _ in range(shards)]
    for slot, s in enumerate(out):
        held[s].append((load[slot], slot))
    total = [sum(b for b, _ in h) for h in held]
    mean = sum(total) / shards
    free = []
    for s in range(shards):
        held[s].sort()
        for entry in reversed(list(held[s])):
            if total[s] > mean and entry[0] > 0:
                held[s].remove(entry)
                total[s] -= entry[0]
                free.append(entry)
    heap = [(t, s) for s, t in enumerate(total)]
    heapq.heapify(heap)
    for b, slot in sorted(free, key=lambda e: (-e[0], e[1])):
        t, s = heapq.heappop(heap)
        insort(held[s], (b, slot))
        heapq.heappush(heap, (t + b, s))
    total = [t for t, _ in sorted(heap, key=lambda e: e[1])]
    for _ in range(len(load)):
        hi, lo = total.index(max(total)), total.index(min(total))
        gap = total[hi] - total[lo]
        if gap <= close * mean:
            break
        move = _best_move(held[hi], held[lo], gap)
        if move is None:
            break
        for give, a, b in ((move[0], hi, lo), (move[1], lo, hi)):
            if give is not None:
                held[a].remove(give)
                insort(held[b], give)
                total[a] -= give[0]
                total[b] += give[0]
    for s, h in enumerate(held):
        for _, slot in h:
            out[slot] = s
    return out


def _best_move(full: list, empty: list, gap: int):
    """What to give and what to take in return so that the gap shrinks most."""
    best, choice = gap, None
    for take in [None, *empty]:
        back = take[0] if take else 0
        k = bisect_left(full, (back + gap / 2, -1))
        for give in full[max(0, k - 1):k + 1]:
            left = abs(gap - 2 * (give[0] - back))
            if left < best:
                best, choice = left, (give, take)
    return choice


def grown(shard_of: list[int], load: list[int]) -> list[int]:
    out, new = list(shard_of), max(shard_of) + 1
    held: dict[int, list] = {s: [] for s in range(new)}
    for slot, s in enumerate(out):
        held[s].append((load[slot], slot))
    total = {s: sum(b for b, _ in h) for s, h in held.items()}
    share, filled = sum(total.values()) / (new + 1), 0
    for h in held.values():
        h.sort()
    while filled < share:
        s = max(total, key=lambda k: (total[k], -k))
        k = bisect_left(held[s], (share - filled, len(out))) - 1
        if k < 0 or held[s][k][0] == 0:
            break
        b, slot = held[s].pop(k)
        out[slot] = new
        total[s] -= b
        filled += b
    return out


def assign(docs: DataFrame, shard_map: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           slots: int = SLOTS, vslot: str = "vslot", shard: str = "shard") -> DataFrame:
    """``docs`` with the virtual slot and the shard of each row; nothing is shuffled."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    key = F.xxhash64(F.col(id_col), (F.octet_length(text) + F.lit(RECORD_BYTES)).cast("long"),
                     F.crc32(text.cast("binary")))
    kept = [c for c in docs.columns if c not in (vslot, shard)]
    v, s = common.unused(docs, "_vslot", "_shard")
    keyed = docs.select(*kept, F.pmod(key, F.lit(slots)).cast("int").alias(v))
    looked = shard_map.select(F.col("vslot").alias(v), F.col("shard").alias(s))
    return (keyed.join(F.broadcast(looked), v)  # at most SLOTS rows
            .select(*kept, F.col(v).alias(vslot), F.col(s).alias(shard)))


def placed(rows: DataFrame, shard_map: DataFrame) -> DataFrame:
    """The rows of ``sized`` with their shard and a place in it, counted from 0 without a gap.

    Places run slot by slot and in the order of id, checksum and size within a slot.
    """
    counted = (rows.groupBy("vslot", "doc_id", "text_crc32", "size")
               .agg(F.count("*").alias("n")))
    mapped = F.broadcast(shard_map)  # at most SLOTS rows, and so is what is summed below
    before = (Window.partitionBy("shard").orderBy("vslot")
              .rowsBetween(Window.unboundedPreceding, -1))
    base = (rows.groupBy("vslot").agg(F.count("*").alias("rows")).join(mapped, "vslot")
            .select("vslot", "shard", F.coalesce(F.sum("rows").over(before),
                                                 F.lit(0)).alias("base")))
    here = (Window.partitionBy("vslot").orderBy("doc_id", "text_crc32", "size")
            .rowsBetween(Window.unboundedPreceding, -1))
    start = F.coalesce(F.sum("n").over(here), F.lit(0))
    runs = (counted.withColumn("start", start).join(F.broadcast(base), "vslot")
            .withColumn("first", F.explode(F.sequence(F.lit(0), F.col("n") - 1, F.lit(RUN)))))
    last = F.least(F.col("n"), F.col("first") + RUN) - 1
    return (runs.withColumn("k", F.explode(F.sequence(F.col("first"), last)))
            .select("doc_id", "size", "text_crc32", "vslot", "shard",
                    (F.col("base") + F.col("start") + F.col("k")).cast("long").alias("slot")))
