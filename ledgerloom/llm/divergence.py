"""Audit of how far the sources of a language differ in their words.

The terms of a language are counted per source. For every two sources a joint
table says how many terms occur c times in the one and d times in the other. All
of these tables together are one product: an indicator matrix has a row for each term
and a one-hot column for each (source, count level), level 0 included, and its
transpose times itself holds every table. The product is taken in blocks of terms,
with 0/1 entries and sums far below 2^24, so 32-bit floats are exact. A cell is priced
once, with the exact integer divergence of its two levels, however many terms
stand in it; the prices of all blocks add up to the divergence of each pair.

Blocks hold terms of about one total count, so that levels are few: many rare terms
or few frequent ones. No block, and no tile of a product, exceeds a fixed number of
cells; which block a term is in does not change any result.

Null text, language or source counts as ''. Terms are runs of letters A-Z, a-z
and characters beyond ASCII, with A-Z made small. A language keeps the terms found
in at least ``LEAST_DOCS`` of its rows; repeated rows and rows without an id
count like others, nothing is cut from long texts. A group without terms is a
group still. An empty table gives an empty result; a source alone in its language has
no pairs. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ledgerloom.llm import common
from ledgerloom.operators.broadcasting import broadcast_if_small

LEAST_DOCS = 3
SCALE = 1_000_000_000
TOP_TERMS = 200
HELD = 200_000          # terms a partition counts before it sends them on
BLOCK_LEVELS = 1 << 14  # about the terms of a block times their levels
BLOCK_TERMS = (64, 4096)
TILE = 2048             # columns of one product

_SMALL = bytes((c + 32 if 65 <= c <= 90 else c) if 65 <= c <= 90 or 97 <= c <= 122 or c >= 128
               else 32 for c in range(256))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, n, docs), summed over what the partition holds at a time."""
    held: dict[tuple, dict[bytes, list[int]]] = {}
    size = 0

    def sent() -> Iterator[pa.RecordBatch]:
        for (lang, source), terms in held.items():
            n = len(terms)
            yield pa.RecordBatch.from_arrays(
                [pa.repeat(pa.scalar(lang, pa.string()), n),
                 pa.repeat(pa.scalar(source, pa.string()), n),
                 pa.array(list(terms), pa.binary()).cast(pa.string()),
                 pa.array([v[0] for v in terms.values()], pa.int64()),
                 pa.array([v[1] for v in terms.values()], pa.int64())],
                names=["lang", "source", "term", "n", "docs"])
        held.clear()

    for b in batches:
        for lang, source, text in zip(*(b.column(k).to_pylist() for k in range(3))):
            terms = held.setdefault((lang, source), {})
            before, here = len(terms), {}
            for t in text.encode().translate(_SMALL).split():
                here[t] = here.get(t, 0) + 1
            for t, n in here.items():
                known = terms.get(t)
                if known is None:
                    terms[t] = [n, 1]
                else:
                    known[0] += n
                    known[1] += 1
            size += len(terms) - before
            if size > HELD:
                yield from sent()
                size = 0
    yield from sent()


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
                source_col: str = "source") -> DataFrame:
    """(lang, source, term, n, docs): occurrences, and rows that hold the term."""
    common.small_batches(docs.sparkSession)
    named = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name) for c, name
                          in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])
    return (named.mapInArrow(_counted, "lang string, source string, term string, n long, docs long")
            .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))


def _share(count: str, total: str, kept: str) -> Column:
    """1 + floor(SCALE (count + 1) / (total + kept)), in exact whole numbers."""
    return F.expr(f"1 + (cast({SCALE} as decimal(10,0)) * cast({count} + 1 as decimal(20,0))) "
                  f"div cast({total} + {kept} as decimal(20,0))")


def _prices(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


class _Levels:
    """The one-hot columns of a block: for each source its distinct counts, and their shares."""

    def __init__(self, counts: np.ndarray, totals: list[int], kept: int):
        self.of_source: list[np.ndarray] = []
        sources, shares, hits = [], [], []
        at = 0
        for s in range(counts.shape[1]):
            levels, place = np.unique(counts[:, s], return_inverse=True)
            self.of_source.append(np.arange(at, at + len(levels)))
            sources.append(np.full(len(levels), s))
            shares.append(np.array([1 + SCALE * (int(c) + 1) // (totals[s] + kept)
                                    for c in levels], np.int64))
            hits.append(place + at)
            at += len(levels)
        self.source, self.share = np.concatenate(sources), np.concatenate(shares)
        self.hits, self.n = hits, at

    def tiles(self) -> list[tuple[int, int]]:
        """Ranges of sources whose columns fill a tile (one source at least)."""
        out, first, held = [], 0, 0
        for s, columns in enumerate(self.of_source):
            if held and held + len(columns) > TILE:
                out.append((first, s))
                first, held = s, 0
            held += len(columns)
        return [*out, (first, len(self.of_source))]

    def indicator(self, tile: tuple[int, int]) -> tuple[np.ndarray, int, int]:
        """0/1 matrix of a tile's columns, and the range of those columns."""
        lo, hi = self.of_source[tile[0]][0], self.of_source[tile[1] - 1][-1] + 1
        terms = len(self.hits[0])
        one_hot = np.zeros((terms, hi - lo), np.float32)
        for s in range(*tile):
            one_hot[np.arange(terms), self.hits[s] - lo] = 1
        return one_hot, lo, hi


def joint_prices(counts: np.ndarray, totals: list[int], kept: int) -> np.ndarray:
    """For a block of terms (rows) and sources (columns): the divergence of every two sources.

    Entry (g, h) sums floor((p - q)^2 / q) over the terms, p of source g and q of h.
    """
    levels = _Levels(counts, totals, kept)
    out = np.zeros((counts.shape[1],) * 2, np.int64)
    tiles = levels.tiles()
    for k, left in enumerate(tiles):
        a, a_lo, _ = levels.indicator(left)
        for right in tiles[k:]:
            b, b_lo, _ = (a, a_lo, 0) if right == left else levels.indicator(right)
            table = a.T @ b
            i, j = np.nonzero(table)
            terms = table[i, j].astype(np.int64)
            i, j = i + a_lo, j + b_lo
            g, h, p, q = levels.source[i], levels.source[j], levels.share[i], levels.share[j]
            np.add.at(out, (g, h), terms * _prices(p, q))
            if right != left:
                np.add.at(out, (h, g), terms * _prices(q, p))
    return out


def _block_prices(key: tuple, rows: pa.Table) -> pa.Table:
    """Every pair of sources of one block; the rows without a term name the sources."""
    is_head = np.asarray(rows.column("term").is_null())
    head = rows.filter(pa.array(is_head))
    head = head.sort_by("sid")
    sid = head.column("sid").to_numpy()
    totals, kept = head.column("total").to_pylist(), head.column("kept")[0].as_py()
    body = rows.filter(pa.array(~is_head))
    terms = body.column("term").combine_chunks().dictionary_encode()
    counts = np.zeros((len(terms.dictionary), len(sid)), np.int64)
    counts[terms.indices.to_numpy(), np.searchsorted(sid, body.column("sid").to_numpy())] = (
        body.column("n").to_numpy())
    value = joint_prices(counts, totals, kept)
    g, h = np.nonzero(~np.eye(len(sid), dtype=bool))
    return pa.table({"lang": pa.repeat(pa.scalar(key[0].as_py(), pa.string()), len(g)),
                     "sid": pa.array(sid[g], pa.int32()), "other": pa.array(sid[h], pa.int32()),
                     "value": pa.array(value[g, h], pa.int64())})


def _in_blocks(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """Counts laid into blocks, with a row for every source of the language in each block."""
    total = kept.groupBy("lang", "term").agg(F.sum("n").alias("m"))
    stratum = F.floor(F.log2(F.col("m"))).cast("int")
    total = total.withColumn("stratum", stratum)
    low, high = BLOCK_TERMS
    room = F.greatest(F.lit(low), F.least(F.lit(high), F.floor(
        F.lit(BLOCK_LEVELS) / F.pow(F.lit(2.0), F.col("stratum")))))
    sizes = (total.groupBy("lang", "stratum").agg(F.count("*").alias("c"))
             .withColumn("parts", F.ceil(F.col("c") / room)).drop("c"))
    # a row for each language and power of two
    placed = (total.join(broadcast_if_small(sizes), ["lang", "stratum"])
              .select("lang", "term", "stratum",
                      F.pmod(F.xxhash64("term"), F.col("parts")).alias("part")))
    body = kept.join(placed, ["lang", "term"]).join(groups, ["lang", "source"]).select(
        "lang", "stratum", "part", "term", "sid", "n", F.lit(None).cast("long").alias("total"),
        F.lit(None).cast("long").alias("kept"))
    heads = (placed.select("lang", "stratum", "part").distinct().join(groups, "lang")
             .select("lang", "stratum", "part", F.lit(None).cast("string").alias("term"), "sid",
                     F.lit(0).cast("long").alias("n"), "total", "kept"))
    return body.unionByName(heads)


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
          source_col: str = "source", top: int = TOP_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank.

    ``pair``: the divergence of a source from every other source of its language.
    ``term``: the ``top`` terms a source has more of than its language as a whole.
    """
    counts = common.written(term_counts(docs, text_col, lang_col, source_col), "terms")
    by_term = Window.partitionBy("lang", "term")
    kept = common.written(
        counts.withColumn("in_docs", F.sum("docs").over(by_term))
        .withColumn("everywhere", F.sum("n").over(by_term))
        .where(F.col("in_docs") >= LEAST_DOCS)
        .select("lang", "source", "term", "n", "everywhere"), "kept")
    all_groups = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("lang"),
                             F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source")
                             ).distinct()
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    vocabulary = (kept.groupBy("lang", "term").agg(F.max("everywhere").alias("n"))
                  .groupBy("lang").agg(F.count("*").alias("kept"), F.sum("n").alias("lang_total")))
    zero = F.lit(0).cast("long")
    groups = common.written(
        all_groups.join(totals, ["lang", "source"], "left").join(vocabulary, "lang", "left")
        .select("lang", "source", *[F.coalesce(c, zero).alias(c)
                                    for c in ("total", "kept", "lang_total")])
        .withColumn("sid", F.row_number().over(Window.partitionBy("lang").orderBy("source"))),
        "groups")
    return _pairs(kept, groups).unionByName(_terms(kept, groups, top))


def _ranked(rows: DataFrame) -> DataFrame:
    place = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.withColumn("rank", F.row_number().over(place))


def _pairs(kept: DataFrame, groups: DataFrame) -> DataFrame:
    blocks = _in_blocks(kept.drop("everywhere"), groups.select("lang", "source", "sid", "total",
                                                               "kept"))
    priced = (blocks.groupBy("lang", "stratum", "part")
              .applyInArrow(_block_prices, "lang string, sid int, other int, value long")
              .groupBy("lang", "sid", "other").agg(F.sum("value").alias("value")))
    mine = groups.select("lang", "source", "sid", "kept")
    theirs = groups.select("lang", F.col("source").alias("item"), F.col("sid").alias("other"))
    # every two sources of a language are rows of the result
    both = mine.join(theirs, "lang").where(F.col("sid") != F.col("other"))
    valued = (both.join(priced, ["lang", "sid", "other"], "left")
              .select("lang", "source", F.lit("pair").alias("part"), "item",
                      F.coalesce("value", F.lit(0)).alias("value")))
    return _ranked(valued)


def _terms(kept: DataFrame, groups: DataFrame, top: int) -> DataFrame:
    shares = (kept.join(groups, ["lang", "source"])
              .withColumn("p", _share("n", "total", "kept"))
              .withColumn("q", _share("everywhere", "lang_total", "kept"))
              .where((F.col("n") > 0) & (F.col("p") > F.col("q"))))
    valued = shares.select("lang", "source", F.lit("term").alias("part"),
                           F.col("term").alias("item"),
                           F.expr("((p - q) * (p - q)) div q").alias("value"))
    return _ranked(valued).where(F.col("rank") <= top)


SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
           AS text
  FROM documents),
words AS (
  SELECT row_id, lang, source,
         unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
vocab AS (
  SELECT lang, term, count(*)::HUGEINT AS everywhere FROM words
  GROUP BY lang, term HAVING count(DISTINCT row_id) >= 3),
counts AS (
  SELECT w.lang, w.source, w.term, count(*)::HUGEINT AS n
  FROM words w JOIN vocab v ON v.lang = w.lang AND v.term = w.term GROUP BY ALL),
langs AS (SELECT lang, count(*)::HUGEINT AS kept, sum(everywhere)::HUGEINT AS lang_total
          FROM vocab GROUP BY lang),
groups AS (
  SELECT d.lang, d.source, coalesce(t.total, 0)::HUGEINT AS total,
         coalesce(l.kept, 0)::HUGEINT AS kept, coalesce(l.lang_total, 0)::HUGEINT AS lang_total
  FROM (SELECT DISTINCT lang, source FROM docs) d
  LEFT JOIN (SELECT lang, source, sum(n) AS total FROM counts GROUP BY ALL) t
    ON t.lang = d.lang AND t.source = d.source
  LEFT JOIN langs l ON l.lang = d.lang),
shares AS (
  SELECT g.lang, g.source, v.term, coalesce(c.n, 0) AS n,
         1 + (1000000000 * (coalesce(c.n, 0) + 1)) // (g.total + g.kept) AS p,
         1 + (1000000000 * (v.everywhere + 1)) // (g.lang_total + g.kept) AS q
  FROM groups g JOIN vocab v ON v.lang = g.lang
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = v.term),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY ALL),
valued AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q)) // q FROM shares WHERE n > 0 AND p > q),
ranked AS (
  SELECT lang, source, part, item, value::BIGINT AS value,
         (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT
           AS rank
  FROM valued)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 200
"""
