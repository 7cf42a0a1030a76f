"""Document fingerprints from prefix polynomial hashes.

A text's code points are summed up as ``H[i] = sum(c[j] * B**j for j < i)`` modulo
two values of ``B`` and the prime 2**31 - 1. Any span's hash follows from two
entries, so spans of one text or of two are compared in one step, and the longest
common extension of two positions is found by binary search.

A fingerprint is the text's length, the hash of the whole, and the ``SKETCH``
smallest hashes of its windows of ``WINDOW`` code points (texts under four windows
long add windows of a quarter). The likeness of two fingerprints is 1 for equal
texts and else the share of common ones among the smallest hashes of both, an
estimate of the share of common windows. Empty texts are alike only each other.

Null texts count as empty. Rows are taken in descending order of id, then by a
hash of the text; rows without an id come last. Each row is compared with the
next one, the last with the first; a single row is its own next one. Other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm import common

PRIME = (1 << 31) - 1
BASES = (1_000_003 * 613 % PRIME, 48_271 * 7919 % PRIME)
WINDOW = 16
SKETCH = 40
DIGITS = 10            # hexadecimal digits kept of a window's hash

_power: list[np.ndarray] = [np.ones(1, np.uint64)] * 4  # of both bases and their inverses


def _powers(k: int, n: int) -> np.ndarray:
    """Powers 0 to n - 1 of a base (k = 0, 1) or of its inverse (k = 2, 3); grown by doubling."""
    base = BASES[k] if k < 2 else pow(BASES[k - 2], -1, PRIME)
    have = _power[k]
    while len(have) < n:
        step = np.uint64(pow(base, len(have), PRIME))
        have = np.concatenate([have, have * step % np.uint64(PRIME)])
    _power[k] = have if len(have) <= 1 << 22 else _power[k]
    return have[:n]


class Prefix:
    """The modular prefix arrays of one text."""

    def __init__(self, text: str):
        c = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
        self.n = len(c)
        self.h = []
        c += np.uint64(1)
        for k in (0, 1):
            h = np.zeros(self.n + 1, np.uint64)
            np.cumsum(c * _powers(k, self.n) % np.uint64(PRIME), out=h[1:])
            self.h.append(h % np.uint64(PRIME))

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of many spans; equal spans have equal hashes wherever they stand."""
        p, out = np.uint64(PRIME), []
        for k, h in enumerate(self.h):
            back = _powers(k + 2, self.n + 1)[start]
            out.append((h[end] + p - h[start]) % p * back % p)
        return out[0] << np.uint64(31) | out[1]

    def span(self, start: int, end: int) -> int:
        return int(self.spans(np.array([start]), np.array([end]))[0])

    def windows(self, size: int) -> np.ndarray:
        """Hashes of all windows of one size, in order."""
        p, out, m = np.uint64(PRIME), [], self.n - size + 1
        for k, h in enumerate(self.h):
            out.append((h[size:] + p - h[:m]) % p * _powers(k + 2, m) % p)
        return out[0] << np.uint64(31) | out[1]


def equal_spans(a: Prefix, i: int, b: Prefix, j: int, size: int) -> bool:
    return a.span(i, i + size) == b.span(j, j + size)


def common_extension(a: Prefix, i: int, b: Prefix, j: int) -> int:
    """Length of the longest equal spans from ``i`` in ``a`` and ``j`` in ``b``."""
    lo, hi = 0, min(a.n - i, b.n - j)
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if equal_spans(a, i, b, j, mid):
            lo = mid
        else:
            hi = mid - 1
    return lo


def fingerprint(p: Prefix) -> str:
    sizes = [WINDOW] if p.n >= 4 * WINDOW else [WINDOW, WINDOW // 4]
    marks = [common.mixed(p.windows(s) + np.uint64(s << 62 >> 62)) for s in sizes if p.n >= s]
    v = np.concatenate(marks) if marks else np.zeros(0, np.uint64)
    v >>= np.uint64(64 - 4 * DIGITS)
    if len(v) > 8 * SKETCH:
        few = np.unique(np.partition(v, 4 * SKETCH)[:4 * SKETCH])
        v = few if len(few) >= SKETCH else v
    v = np.unique(v)[:SKETCH]
    whole = p.span(0, p.n) if p.n else 0
    return f"{p.n:x}-{whole:016x}-" + "".join(f"{x:0{DIGITS}x}" for x in v.tolist())


def likeness(a: str, b: str) -> float:
    """Of two fingerprints, from 0 to 1."""
    if a == b:
        return 1.0
    x, y = ({part[i:i + DIGITS] for i in range(0, len(part), DIGITS)}
            for part in (f.rsplit("-", 1)[1] for f in (a, b)))
    both = sorted(x | y)[:SKETCH]
    return sum(v in x and v in y for v in both) / len(both) if both else 0.0


def edited(text: str, following: str) -> str:
    """The last third of the code points gives way to as many of the next text's first."""
    m = len(text) // 3
    return text[:len(text) - m] + following[:m]


FIELDS = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
          "edited_fingerprint string, near_edited double, near_next double, lce_edited long")


def _row(doc_id, text: str, p: Prefix, fp: str, following: str, next_fp: str) -> tuple:
    other = edited(text, following)
    q = Prefix(other)
    other_fp = fp if other == text else fingerprint(q)
    return (doc_id, p.n, hashlib.sha256(other.encode()).hexdigest(), fp, other_fp,
            likeness(fp, other_fp), likeness(fp, next_fp), common_extension(p, 0, q, 0))


def _batch(rows: list[tuple], kind: int, pid: int, texts: list) -> pa.RecordBatch:
    names = [f.split()[0] for f in FIELDS.split(", ")]
    types = [pa.int64() if f.endswith("long") else pa.float64() if f.endswith("double")
             else pa.string() for f in FIELDS.split(", ")]
    columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]
    return pa.RecordBatch.from_arrays(
        columns + [pa.array([kind] * len(rows), pa.int32()), pa.array([pid] * len(rows), pa.int32()),
                   pa.array(texts, pa.string())], names=[*names, "kind", "pid", "whole"])


@F.arrow_udf(T.BinaryType())
def _compressed(texts: pa.Array) -> pa.Array:
    pack = zstandard.ZstdCompressor(level=3).compress
    return pa.array([pack(x.encode()) for x in texts.to_pylist()], pa.binary())


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one ordered partition: finished ones (kind 0), its last (1) and its first (2)."""
    held, pid = None, None
    unpack = zstandard.ZstdDecompressor().decompress
    for b in batches:
        out = []
        for doc_id, packed, part in zip(*(c.to_pylist() for c in b.columns)):
            text = unpack(packed).decode()
            p = Prefix(text)
            now = (doc_id, text, p, fingerprint(p))
            if held is None:
                pid = part
                yield _batch([(doc_id, p.n, None, now[3], None, None, None, None)], 2, pid, [text])
            else:
                out.append(_row(*held, text, now[3]))
            held = now
        if out:
            yield _batch(out, 0, pid, [None] * len(out))
    if held is not None:
        doc_id, text, p, fp = held
        yield _batch([(doc_id, p.n, None, fp, None, None, None, None)], 1, pid, [text])


def _at_borders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = []
        for doc_id, text, following in zip(*(c.to_pylist() for c in b.columns)):
            p, q = Prefix(text), Prefix(following)
            rows.append(_row(doc_id, text, p, fingerprint(p), following, fingerprint(q)))
        yield _batch(rows, 0, 0, [None] * len(rows)).select(range(8))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row's fingerprint, that of its edited text, and the likenesses, as in the module's text.

    Texts are shuffled once, compressed, into ranges of the id; only the first and last row of
    each range meet again, through a table in the shared folder.
    """
    common.small_batches(docs.sparkSession, 200)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("h", F.xxhash64("text")).withColumn("u", F.monotonically_increasing_id())
    rows = rows.select("doc_id", "h", "u", _compressed("text").alias("packed"))
    order = [F.desc_nulls_last("doc_id"), F.asc("h"), F.asc("u")]
    ranged = (rows.repartitionByRange(*order).sortWithinPartitions(*order)
              .select("doc_id", "packed", F.spark_partition_id().alias("pid")))
    found = common.written(ranged.mapInArrow(
        _in_order, f"{FIELDS}, kind int, pid int, whole string"), "fingerprints")
    heads = found.where("kind = 2").select("pid", F.col("whole").alias("following"))
    # one narrow row per range: the ranges' number, not the documents', bounds this window
    every = Window.orderBy("pid")
    all_rows = every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = heads.select(F.col("pid").alias("here"), F.coalesce(
        F.lead("pid").over(every), F.first("pid").over(all_rows)).alias("pid"))
    tails = found.where("kind = 1").select("doc_id", "whole", F.col("pid").alias("here"))
    border = (tails.join(after, "here").join(heads, "pid").select("doc_id", "whole", "following")
              .mapInArrow(_at_borders, FIELDS))
    names = [f.split()[0] for f in FIELDS.split(", ")]
    return found.where("kind = 0").select(*names).union(border)
