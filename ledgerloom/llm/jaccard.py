"""N-gram Jaccard join: near copies among whole texts by exact set similarity.

A document's set holds its distinct word n-grams. Two sets can only reach the
similarity t if the first ``n - ceil(t n) + 1`` members of both, in one global
order, have a member in common (prefix filter). The order puts rare n-grams
first: those counted more than ``LEVELS`` times come after all others, level by
level. The counts take the prefixes of all documents, and then all members of
the documents whose prefixes consist of frequent n-grams to a quarter or more.
Length, positional and suffix filters thin out the candidates, and each
remaining pair is verified once, on the full sets.

Copies of one set are one node, however many there are. In each n-gram's list
the node that has it earliest, with the fewest rare n-grams of its own, is
compared with all others first: the text that near copies were made of is the
nearest to each of them. Where a list still holds several components, a further
round compares a few other nodes of it with the rest. Only then are the nodes of
different components paired, each pair in the first list it meets in and only if
the parities of its sets allow it. So a large group of near copies costs its size and
not its square, and no link between components is missed.

Empty or null texts have an empty set and link with nothing. Rows without an
id take part in nothing. Every row counts with its own text, also where rows repeat
an id; equal rows get equal results. Other columns of the input are ignored, whatever
their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom import storage
from ledgerloom.llm import common
from ledgerloom.llm.common import MIX as _MIX
from ledgerloom.llm.common import mixed as _mix
from ledgerloom.operators.broadcasting import MAX_BROADCAST_BYTES

ROUNDS = 1                # of comparing a few nodes of each list with all others, after the first
LEADERS = 4               # so many of each list
EARLIER = 4               # n-grams before its own that a list's entry remembers
LEVELS = (16, 128, 1024)  # an n-gram counted more often comes later in the order
PARITY_LONGS = 16         # 1,024 parities of a set: their difference bounds the symmetric difference


def shingle_sets(texts: pa.Array, ngram: int) -> Iterator[np.ndarray]:
    """Each text's set of n-gram hashes, sorted; a text of fewer words is one n-gram."""
    words, begin = common.words_of(texts, common.SPACES)
    grams = np.zeros(max(0, len(words) - ngram + 1), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(ngram):
            grams = _mix((grams ^ words[k:k + len(grams)]) + _MIX[2] * np.uint64(k + 1))
        for i, valid in enumerate(texts.is_valid().to_pylist()):
            a, b = begin[i], begin[i + 1]
            if b - a >= ngram:
                yield np.unique(grams[a:b - ngram + 1])
            elif valid and b > a:
                one = np.array([b - a], np.uint64)
                for w in words[a:b]:
                    one = _mix((one ^ w) + _MIX[2])
                yield one
            else:
                yield np.zeros(0, np.uint64)


def _least_overlap(n, percent: int):
    return -(-percent * n // 100)


def _prefix_sizes(n: int, percent: int) -> int:
    return n - _least_overlap(n, percent) + 1 if n else 0


def _parities(grams: np.ndarray) -> np.ndarray:
    counts = np.bincount((grams & np.uint64(PARITY_LONGS * 64 - 1)).astype(np.int64),
                         minlength=PARITY_LONGS * 64)
    return np.packbits((counts & 1).astype(np.uint8)).view(np.int64)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    sizes = np.cumsum([0, *map(len, arrays)])
    flat = np.concatenate(arrays) if arrays else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(flat.view(np.int64)))


def _node(grams: np.ndarray) -> int:
    """The number of a set; equal sets have equal numbers."""
    with np.errstate(over="ignore"):
        key = _mix(np.array([np.add.reduce(_mix(grams ^ _MIX[0]), dtype=np.uint64)
                             + np.uint64(len(grams))]))
    return int(key.view(np.int64)[0])


def _signatures(ngram: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes, nodes, parity, prefix = [], [], [], []
            for g in shingle_sets(b.column(1), ngram):
                sizes.append(len(g))
                nodes.append(_node(g))
                parity.append(_parities(g))
                prefix.append(g[:_prefix_sizes(len(g), percent)])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()),
                 _lists(parity), _lists(prefix)],
                names=["doc_id", "n", "node", "parity", "prefix"])
    return run


def _level(grams: np.ndarray, late: list, mask: np.uint64) -> np.ndarray:
    at = (grams & mask).astype(np.int64)
    return sum(common.has_bit(bits, at).astype(np.int8) for bits in late)


def _crowded(ngram: int, percent: int, late, bits: int):
    """All members of the texts whose prefix is frequent to a quarter or more."""
    mask = np.uint64(bits - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [np.zeros(0, np.uint64)]
            for g in shingle_sets(b.column(0), ngram):
                size = _prefix_sizes(len(g), percent)
                if size and 4 * (_level(g[:size], late.value, mask) > 0).sum() >= size:
                    out.append(g)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out).view(np.int64))],
                                             names=["gram"])
    return run


def _prefixes(ngram: int, percent: int, late, bits: int):
    mask = np.uint64(bits - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, nodes, prefix = [], [], []
            for i, g in enumerate(shingle_sets(b.column(1), ngram)):
                if not len(g):
                    continue
                order = np.argsort(_level(g, late.value, mask), kind="stable")
                rows.append(i)
                nodes.append(_node(g))
                prefix.append(g[order[:_prefix_sizes(len(g), percent)]])
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(rows, pa.int64())), pa.array(nodes, pa.int64()),
                 _lists(prefix)], names=["doc_id", "node", "prefix"])
    return run


def _sets(ngram: int, wanted):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if wanted is not None:
                b = b.filter(pa.array(common.has_bit(wanted.value, b.column(2).to_numpy())))
            sets = list(shingle_sets(b.column(1), ngram))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(map(_node, sets), pa.int64()), _lists(sets)],
                names=["doc_id", "node", "grams"])
    return run


class JaccardJoin:
    """Near-copy groups of ``docs``; ``percent`` is the least similarity in hundredths."""

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 ngram: int = 5, percent: int = 80):
        self.spark = docs.sparkSession
        common.small_batches(self.spark)
        self.ngram, self.percent = ngram, percent
        self.frequent: DataFrame | None = None
        self.posted: DataFrame | None = None
        self.docs = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                                F.col(text_col).alias("text")).where("doc_id is not null")
        self.whole, self.path = common.written_at(self.docs.mapInArrow(
            _signatures(ngram, percent),
            "doc_id long, n long, node long, parity array<long>, prefix array<long>"), "signed")
        self.signed = common.written(self.whole.drop("prefix"), "sizes")
        self.nodes = common.written(
            self.signed.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("first"))
            .join(self.signed.select(F.col("doc_id").alias("first"), "node", "n", "parity"),
                  ["first", "node"]).dropDuplicates(["node"]), "nodes")

    def _late(self, grams: DataFrame):
        """Bit sets of the n-grams known to be beyond each level, and how many bits each has."""
        counts = grams.groupBy("gram").count().where(F.col("count") > LEVELS[0])
        if self.frequent is not None:
            counts = counts.union(self.frequent)
        self.frequent = common.written(counts.groupBy("gram").agg(
            F.max("count").alias("count")), "frequent")
        bits = common.bits_for(self.frequent.count())
        at = F.col("gram").bitwiseAND(bits - 1).alias("at")
        sets = [common.bit_set(self.frequent.where(F.col("count") > n).select(at), "at", bits)
                for n in LEVELS]
        return self.spark.sparkContext.broadcast(sets), bits

    def _postings(self) -> DataFrame:
        """(gram, node, n, pos, least) for every n-gram in the prefixes of two nodes or more."""
        if self.posted is not None:
            return self.posted
        late, bits = self._late(self.whole.select(F.explode("prefix").alias("gram")))
        storage.delete(self.spark, self.path)  # the prefixes of the first order are done with
        members = self.docs.select("text").mapInArrow(
            _crowded(self.ngram, self.percent, late, bits), "gram long")
        late, bits = self._late(members)
        prefixes = self.docs.mapInArrow(_prefixes(self.ngram, self.percent, late, bits),
                                        "doc_id long, node long, prefix array<long>")
        keys = self.nodes.select(F.col("first").alias("doc_id"), "node")
        index = (prefixes.join(keys, ["doc_id", "node"]).dropDuplicates(["doc_id", "node"])
                 .select("node", F.posexplode("prefix").alias("pos", "gram")))
        shared = (index.groupBy("gram").agg(F.min("pos").alias("least"), F.count("*").alias("c"))
                  .where("c > 1").drop("c"))
        sizes = self.nodes.select("node", "n")
        self.posted = common.written(index.join(shared, "gram").join(sizes, "node"), "postings")
        return self.posted

    def _filtered(self, pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) that the length and suffix filters cannot rule out."""
        side = self.nodes.select("node", "n", "parity", "first")
        a, b = (side.select(*[F.col(c).alias(f"{s}_{c}") for c in side.columns]) for s in "ab")
        both = (pairs.join(a, F.col("a") == F.col("a_node")).join(b, F.col("b") == F.col("b_node")))
        odd = F.aggregate(F.zip_with("a_parity", "b_parity", lambda x, y: F.bit_count(
            x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
        t, total = self.percent, F.col("a_n") + F.col("b_n")
        least = F.ceil(F.lit(t) * total / (100 + t))
        return both.where((100 * F.least("a_n", "b_n") >= t * F.greatest("a_n", "b_n"))
                          & (odd <= total - 2 * least)).select("a", "b", "a_n", "b_n",
                                                               "a_first", "b_first")

    def _verified(self, pairs: DataFrame) -> DataFrame:
        """Those of the pairs whose sets are similar enough, each looked at once."""
        pairs, pairs_at = common.written_at(self._filtered(pairs), "pairs")
        ids = pairs.select(F.explode(F.array(
            F.struct(F.col("a_first").alias("doc_id"), F.col("a").alias("node")),
            F.struct(F.col("b_first").alias("doc_id"), F.col("b").alias("node")))).alias("i"))
        ids, ids_at = common.written_at(ids.select("i.*").distinct(), "ids")
        schema = "doc_id long, node long, grams array<long>"
        count = ids.count()
        if count * 16 <= MAX_BROADCAST_BYTES:   # the other texts need not reach Python at all
            named = self.docs.join(F.broadcast(ids.select("doc_id").distinct()), "doc_id")
            sets = named.select("doc_id", "text").mapInArrow(_sets(self.ngram, None), schema)
        else:
            bits = common.bits_for(count, 16)
            at = F.pmod(F.xxhash64("doc_id"), F.lit(bits)).alias("at")
            wanted = self.spark.sparkContext.broadcast(common.bit_set(ids.select(at), "at", bits))
            sets = self.docs.select("doc_id", "text", at).mapInArrow(
                _sets(self.ngram, wanted), schema)
        sets, sets_at = common.written_at(
            sets.join(ids, ["doc_id", "node"]).dropDuplicates(["node"]), "sets")
        a = sets.select(F.col("node").alias("a"), F.col("grams").alias("a_grams"))
        b = sets.select(F.col("node").alias("b"), F.col("grams").alias("b_grams"))
        both = F.size(F.array_intersect("a_grams", "b_grams"))
        links = common.written(
            pairs.join(b, "b").join(a, "a")
            .where(100 * both >= self.percent * (F.col("a_n") + F.col("b_n") - both))
            .select("a", "b"), "links")
        for path in (pairs_at, ids_at, sets_at):
            storage.delete(self.spark, path)
        return links

    def _mixed(self, postings: DataFrame, roots: DataFrame) -> tuple[DataFrame, str]:
        """The entries of lists that hold several components so far.

        Besides its own place each entry knows its node's component, its parities folded to
        256, and the last lists before this one that its node stands in.
        """
        rows = postings.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        kinds = rows.groupBy("gram").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
        rows = rows.join(kinds.where("lo < hi").select("gram"), "gram")
        before = Window.partitionBy("node").orderBy("pos").rowsBetween(-EARLIER, -1)
        folded = [F.expr(" ^ ".join(f"parity[{k + 4 * j}]" for j in range(PARITY_LONGS // 4)))
                  .alias(f"q{k}") for k in range(4)]
        rows = rows.select("gram", "node", "root", "n", "pos",
                           F.collect_list("gram").over(before).alias("early"))
        return common.written_at(rows.join(self.nodes.select("node", *folded), "node"), "mixed")

    def _near(self):
        """Can entries a and b of one list be near, and is this the first list they share?

        The first n-gram two sets share has nothing in common before it, so what is left
        of either set from there on must be as large as the overlap they need.
        """
        t, a, b = self.percent, "a.{}".format, "b.{}".format
        total = F.col(a("n")) + F.col(b("n"))
        least = F.ceil(F.lit(t) * total / (100 + t))
        odd = sum((F.bit_count(F.col(a(f"q{k}")).bitwiseXOR(F.col(b(f"q{k}")))) for k in range(4)),
                  F.lit(0))
        return ((100 * F.least(a("n"), b("n")) >= t * F.greatest(a("n"), b("n")))
                & (F.least(F.col(a("n")) - F.col(a("pos")), F.col(b("n")) - F.col(b("pos"))) >= least)
                & (odd <= total - 2 * least) & ~F.arrays_overlap(a("early"), b("early")))

    @staticmethod
    def _pair(rows: DataFrame) -> DataFrame:
        return rows.select(F.least("a.node", "b.node").alias("a"),
                           F.greatest("a.node", "b.node").alias("b")).distinct()

    def _led(self, mixed: DataFrame, round_number: int) -> DataFrame:
        """A few nodes of each list, with all of its nodes of other components."""
        entry = F.struct(*mixed.columns)
        picked = [F.min_by(entry, F.xxhash64("node", F.lit(LEADERS * round_number + k)))
                  for k in range(LEADERS)]
        leaders = (mixed.groupBy("gram").agg(F.array_distinct(F.array(*picked)).alias("l"))
                   .select(F.explode("l").alias("l")).select("l.*"))
        return self._pair(leaders.alias("a").join(
            mixed.alias("b"), (F.col("a.gram") == F.col("b.gram"))
            & (F.col("a.root") != F.col("b.root")) & self._near()))

    def _across(self, mixed: DataFrame) -> DataFrame:
        """Pairs of nodes that share a list and are in different components so far.

        Each component of a list is matched with the list's other components first and
        only then with their nodes.
        """
        t = self.percent
        groups = (mixed.groupBy("gram", F.col("root").alias("other"))
                  .agg(F.min("n").alias("n0"), F.max("n").alias("n1"), F.min("pos").alias("p0")))
        least = F.ceil(F.lit(t) * (F.col("n") + F.col("n0")) / (100 + t))
        near = ((100 * F.col("n") >= t * F.col("n0")) & (100 * F.col("n1") >= t * F.col("n"))
                & (F.least(F.col("n") - F.col("pos"), F.col("n1") - F.col("p0")) >= least))
        left = (mixed.join(groups, "gram").where((F.col("root") < F.col("other")) & near)
                .select(*mixed.columns, "other"))
        return self._pair(left.alias("a").join(
            mixed.alias("b"), (F.col("a.gram") == F.col("b.gram"))
            & (F.col("a.other") == F.col("b.root")) & self._near()))

    def _joined(self, found: DataFrame) -> DataFrame:
        return common.written(common.components(found, "a", "b"), "roots")

    def links(self) -> tuple[DataFrame, DataFrame]:
        """Verified links that hold every component together, and (node, root)."""
        postings = self._postings()
        leaders = postings.where("pos = least").groupBy("gram").agg(F.min("node").alias("leader"))
        star = (postings.join(leaders, "gram").where("node != leader")
                .select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct())
        star = common.written(star, "star")
        found = self._verified(star)
        roots = self._joined(found)
        mixed, path = self._mixed(postings, roots)
        for k in range(ROUNDS):
            more = self._verified(self._led(mixed, k).join(star, ["a", "b"], "left_anti"))
            if more.isEmpty():
                break
            found = found.union(more)
            roots = self._joined(found)
            storage.delete(self.spark, path)
            mixed, path = self._mixed(postings, roots)
        found = found.union(self._verified(self._across(mixed).join(star, ["a", "b"], "left_anti")))
        storage.delete(self.spark, path)
        return found, self._joined(found)

    def groups(self) -> DataFrame:
        """One row per row with an id: doc_id, n_shingles, component_id."""
        _, roots = self.links()
        first = self.nodes.select("node", "first").join(roots, "node", "left")
        least = (first.groupBy(F.coalesce("root", "node").alias("root"))
                 .agg(F.min("first").alias("component_id")))
        named = (first.select("node", F.coalesce("root", "node").alias("root"))
                 .join(least, "root").select("node", "component_id"))
        return (self.signed.select("doc_id", "n", "node").join(named, "node", "left")
                .select("doc_id", F.col("n").alias("n_shingles"),
                        F.when(F.col("n") > 0, F.col("component_id"))
                        .otherwise(F.col("doc_id")).alias("component_id")))


def jaccard_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   ngram: int = 5, percent: int = 80) -> DataFrame:
    return JaccardJoin(docs, id_col, text_col, ngram, percent).groups()
