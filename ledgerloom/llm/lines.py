"""Line dedup with a log-template tree of fixed depth.

A line goes down the tree by its number of words and its first ``DEPTH`` words;
words with a digit, an ``@`` or ``://`` are variable fields and count as one
wildcard. Lines of a leaf that agree in every word make one template, which recurs
from ``DOCS`` documents on, whatever its length. So do lines of a leaf of ``SPLIT``
words or more whose other words agree in all but one of four parts: the words that
differ there are variable fields too, but only from ``FIELD_DOCS`` documents on, as
two lines do not tell a field from a text of its own. A template that recurs is
dropped from all documents but the first, the one with the smallest id. Lines under
``LEAST`` words stay.

A document is judged as a whole before its lines are. Equal texts are one document
here. So is a document with the first one of at least ``COPY_LINES`` of its lines,
where what would be left of both reaches ``COPY`` of their union in words: it is a
near copy. A copy keeps and loses the lines its original does, so that it can still
be found to be one, and does not make a line recur.

A line's word count, leaf and parts are numbers, so the tree is a grouping: every
document sends each of its templates once, equal ones are summed before they are
shuffled, and only templates that recur go back to their documents.

Null texts stay null, and empty ones empty. Rows without an id are never the first. Columns of the result's names
are replaced; all others pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm import common

DEPTH = 3
LEAST = 5
SPLIT = 12
PARTS = 4
DOCS = 2
FIELD_DOCS = 3
COPY = 0.8
COPY_LINES = 2

_VARIABLE = np.zeros(256, bool)
_VARIABLE[[*range(48, 58), 64]] = True  # digits and @
_WILDCARD = np.uint64(0x5DEECE66D)


def _line_texts(texts: list[str | None]) -> tuple[list[list[str]], pa.Array]:
    lines = [t.split("\n") if t else [] for t in texts]
    return lines, pa.array([x for ls in lines for x in ls], pa.large_string())


def line_keys(lines: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(line, key, words) of every template a line belongs to, its own first."""
    words, begin, marked = common.words_of(lines, common.SPACES, _VARIABLE)
    marked |= common.words_with(lines, common.SPACES, "://")
    with np.errstate(over="ignore"):
        token = np.where(marked, _WILDCARD, words)
        n = np.diff(begin)
        line = np.repeat(np.arange(len(n)), n)
        place = (np.arange(len(token)) - begin[line]).astype(np.uint64)
        value = np.r_[np.zeros(1, np.uint64),
                      np.cumsum(common.mixed(token + (place + np.uint64(1)) * common.MIX[2]),
                                dtype=np.uint64)]
        some = np.flatnonzero(n >= LEAST)
        a, size = begin[some], n[some]
        leaf = common.mixed((value[a + DEPTH] - value[a]) ^ size.astype(np.uint64) * common.MIX[0])
        cuts = [a + DEPTH + (size - DEPTH) * k // PARTS for k in range(PARTS + 1)]
        part = [value[e] - value[s] for s, e in zip(cuts, cuts[1:])]
        whole = leaf
        for p in part:
            whole = common.mixed((whole ^ p) * common.MIX[1])
        keys, lines_of = [whole], [some]
        wide = size >= SPLIT
        for j in range(PARTS):
            k = leaf[wide] + np.uint64(j + 1)
            for i, p in enumerate(part):
                if i != j:
                    k = common.mixed((k ^ p[wide]) * common.MIX[1])
            keys.append(k)
            lines_of.append(some[wide])
    line = np.concatenate(lines_of)
    return line, np.concatenate(keys).view(np.int64), n[line]


def _templates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each template of a document, and one of line -1 with the words of its lines."""
    for b in batches:
        lines, flat = _line_texts(b.column(2).to_pylist())
        owner = np.repeat(np.arange(len(lines)), [len(x) for x in lines])
        start = np.cumsum([0, *map(len, lines)])
        line, key, words = line_keys(flat)
        size = np.array([len(x.split()) for x in flat.to_pylist()], np.int64)
        own = np.r_[True, line[1:] > line[:-1]].cumprod().astype(bool)[:len(line)]
        # of equal lines of a document only the first counts
        _, at = np.unique(np.stack([owner[line[own]], key[own]], 1), axis=0, return_index=True)
        once = np.ones(len(flat), bool)
        once[line[own]] = False
        once[line[own][at]] = True
        total = np.bincount(owner[once], size[once], len(lines)).astype(np.int64)
        some = once[line]
        line, key, words, own = line[some], key[some], words[some], own[some]
        row = pa.array(np.r_[owner[line], np.arange(len(lines))])
        none = np.full(len(lines), -1)
        yield pa.RecordBatch.from_arrays(
            [b.column(0).take(row), b.column(1).take(row), pa.array(np.r_[line - start[owner[line]], none]),
             pa.array(np.r_[own, none > 0]), pa.array(np.r_[key, none]),
             pa.array(np.r_[words, total])],
            names=["content", "doc_id", "line", "own", "key", "words"])


@F.arrow_udf(T.StructType().add("text", T.StringType()).add("lines", T.LongType())
             .add("dropped", T.LongType()))
def _without(texts: pa.Array, keys: pa.Array) -> pa.Array:
    values, drop = texts.to_pylist(), keys.to_pylist()
    lines, flat = _line_texts([t if d else None for t, d in zip(values, drop)])
    start = np.cumsum([0, *map(len, lines)])
    line, key, _ = line_keys(flat)
    order = np.argsort(line, kind="stable")
    line, key = line[order], key[order]
    out, counts, gone = [], [], []
    for i, (text, d) in enumerate(zip(values, drop)):
        a, b = np.searchsorted(line, start[i:i + 2])
        bad = set((line[a:b][np.isin(key[a:b], d)] - start[i]).tolist()) if d else set()
        out.append("\n".join(x for k, x in enumerate(lines[i]) if k not in bad) if bad else text)
        counts.append(text.count("\n") + 1 if text else 0)
        gone.append(len(bad))
    return pa.StructArray.from_arrays(
        [pa.array(out, pa.string()), pa.array(counts, pa.int64()), pa.array(gone, pa.int64())],
        names=["text", "lines", "dropped"])


def _dropped(found: DataFrame) -> DataFrame:
    """(content, key): the templates each text loses."""
    first = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "content")))
    recurring = (found.where("line >= 0").groupBy("key")
                 .agg(F.min("content").alias("a"), F.max("content").alias("b"),
                      first.alias("first"))
                 .where("a != b and first is not null"))  # DOCS is two
    hits = common.written(
        found.where("line >= 0").drop("doc_id").join(recurring, "key"), "recurring")
    # FIELD_DOCS is three: one more than the smallest and the largest
    fields = hits.where("not own and content != a and content != b").select("key").distinct()
    hits = (hits.where("own").unionByName(hits.where("not own").join(fields, "key", "left_semi"))
            .where("first.content != content"))
    # equal texts number their lines alike; a line's first document is its templates' smallest
    by_line = (hits.groupBy("content", "line")
               .agg(F.min("first")["content"].alias("first"), F.max("words").alias("words")))
    shared = (by_line.groupBy("content", "first")
              .agg(F.sum("words").alias("shared"), F.count("*").alias("n")))
    elsewhere = shared.groupBy("content").agg(F.sum("shared").alias("gone"))
    left = (found.where("line < 0").groupBy("content").agg(F.first("words").alias("words"))
            .join(elsewhere, "content", "left")
            .select("content", (F.col("words") - F.coalesce("gone", F.lit(0))).alias("left")))
    copies = (shared.where(F.col("n") >= COPY_LINES).join(left, "content")
              .join(left.select(F.col("content").alias("first"), F.col("left").alias("whole")),
                    "first")
              .where(F.col("shared") >= COPY * (F.col("left") + F.col("whole")))
              .groupBy("content").agg(F.max_by("first", F.struct("shared", "first")).alias("of")))
    return (hits.select("content", "key", F.col("first.content").alias("first"))
            .join(copies, "content", "left")
            .where("of is null or first != of").select("content", "key"))


def dedupe_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 n_lines: str = "n_lines", n_dropped: str = "n_dropped") -> DataFrame:
    """``docs`` with recurring lines dropped from their texts, and two counts."""
    common.small_batches(docs.sparkSession)
    content = F.coalesce(F.when(F.col(text_col).isNotNull(), F.xxhash64(F.col(text_col))),
                         F.xxhash64(F.col(id_col), F.lit("")))
    at, keys, out = common.unused(docs, "_content", "_keys", "_done")
    found = common.written(
        docs.where(F.col(text_col).isNotNull())
        .select(content.alias("content"), F.col(id_col).cast("long").alias("doc_id"),
                F.col(text_col).alias("text"))
        .mapInArrow(_templates, "content long, doc_id long, line long, own boolean, key long, "
                                "words long"), "templates")
    drops = (_dropped(found).groupBy(F.col("content").alias(at))
             .agg(F.collect_set("key").alias(keys)))
    kept = [c for c in docs.columns if c not in (n_lines, n_dropped)]
    marked = docs.select(*kept, content.alias(at)).join(drops, at, "left")
    done = marked.select(*kept, _without(F.col(text_col), F.coalesce(
        keys, F.array().cast("array<long>"))).alias(out))
    text = F.col(out)["text"].alias(text_col)
    return done.select(*[text if c == text_col else F.col(c) for c in kept],
                       F.col(out)["lines"].alias(n_lines), F.col(out)["dropped"].alias(n_dropped))
