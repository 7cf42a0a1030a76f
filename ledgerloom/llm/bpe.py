"""BPE encoding and decoding with a minimal acyclic transducer as lexicon.

The words the corpus uses most are encoded once and compiled into an automaton
whose equal suffixes are shared. Following a word through it adds up to the
word's rank among all of them, and the rank gives its ids. Workers map the
compiled file into memory. Words outside the lexicon are merged exactly, many at
a time, by the rule of the tokenizer: the pair of least rank first, from the left.
The lexicon only saves time; the ids do not depend on what it holds.

The rules are those of a word-end BPE file: special strings are cut out first,
the rest is composed (NFC), white space separates, letters are lowered one by
one, and words are contractions, runs of letters, single digits and runs of
anything else. Decoding joins the tokens' strings with spaces.

Null texts count as empty, empty texts have no ids. Columns of the result's
names are replaced; all others pass through.
"""

from __future__ import annotations

import json
import re
import tempfile
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import common

LEXICON_WORDS = 50_000
COUNTED = 300_000      # different words a partition counts at a time
SENT = 60_000          # words a partition reports, the most frequent ones
REMEMBERED = 100_000   # merged words a worker remembers
_SPACE = "\t-\r \x85\xa0  -     　"
_SPACES = re.compile(f"[{_SPACE}]+")
_ODD = re.compile("[\x1c-\x1f]")  # str.split() takes these as white space, the rules do not
_WORD = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{_SPACE}\p{{L}}\p{{N}}]+")
_END = "</w>"


def _byte_letters() -> list[str]:
    """The printable stand-in of each byte: itself where printable, else the next from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


def chunks_of(text: str) -> list[str]:
    """Pieces between white space, composed and in small letters."""
    if not text.isascii():
        if not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        text = text.replace("Σ", "σ")  # no letter depends on its neighbours
    low = text.lower()
    return [x for x in _SPACES.split(low) if x] if _ODD.search(low) else low.split()


def words_in(chunk: str) -> list[str]:
    return [chunk] if chunk.isalpha() else _WORD.findall(chunk)


class _Lists:
    """Many lists of ids in one array, end to end unless ``start`` says otherwise."""

    def __init__(self, flat: np.ndarray, size: np.ndarray, start: np.ndarray | None = None):
        self.flat, self.size = flat, size
        self.start = np.cumsum(size) - size if start is None else start

    def and_one_each(self, ids: list[int]) -> _Lists:
        extra = np.array(ids, np.uint32)
        return _Lists(np.concatenate([self.flat, extra]), np.r_[self.size, np.ones(len(ids), int)],
                      np.r_[self.start, len(self.flat) + np.arange(len(ids))])

    def joined(self, members: np.ndarray, counts: np.ndarray) -> _Lists:
        """New lists, each the concatenation of the next ``counts`` members."""
        size = self.size[members]
        ends = np.cumsum(size)
        at = np.arange(int(size.sum())) + np.repeat(self.start[members] - (ends - size), size)
        upto = np.r_[0, np.r_[0, ends][np.cumsum(counts)]]
        return _Lists(self.flat[at], np.diff(upto))

    def split(self) -> list[np.ndarray]:
        return [self.flat[a:a + n] for a, n in zip(self.start.tolist(), self.size.tolist())]


def _numbered(order: dict, members: list[str]) -> np.ndarray:
    number = dict(zip(order, range(len(order))))
    return np.fromiter(map(number.__getitem__, members), np.int64, len(members))


def merge_array(state: tuple, words: list[str]) -> _Lists:
    """Ids of many words, all merged side by side; ``state`` holds the merge tables."""
    first, last, keys, ranks, made = state
    raw = [w.encode() for w in words]
    size = np.array([len(r) for r in raw], np.int64)
    buf = np.frombuffer(b"".join(raw), np.uint8)
    ends = np.cumsum(size)
    sym = first[buf]
    sym[ends - 1] = last[buf[ends - 1]]
    owner = np.repeat(np.arange(len(words)), size)
    done_sym, done_owner = [], []
    none = np.int64(1) << 40
    while len(sym):
        key = (sym[:-1] << 17) | sym[1:]
        at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        rank = np.where((keys[at] == key) & (owner[:-1] == owner[1:]), ranks[at], none)
        rank = np.append(rank, none)
        begin = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        least = np.minimum.reduceat(rank, begin)
        count = np.diff(np.r_[begin, len(sym)])
        least = np.repeat(least, count)
        live = least < none
        hit = live & (rank == least)
        if not live.all():
            done_sym.append(sym[~live])
            done_owner.append(owner[~live])
        # of pairs that overlap (a run of one letter) every second one is merged, from the left
        place = np.arange(len(sym))
        run = np.maximum.accumulate(np.where(hit & ~np.r_[False, hit[:-1]], place, 0))
        hit &= (place - run) % 2 == 0
        sym = sym.copy()
        at = np.append(at, 0)
        sym[hit] = made[at[hit]]
        keep = live & ~np.r_[False, hit[:-1]]
        sym, owner = sym[keep], owner[keep]
    if not done_sym:
        return _Lists(np.zeros(0, np.uint32), np.zeros(len(words), np.int64))
    sym, owner = np.concatenate(done_sym), np.concatenate(done_owner)
    order = np.argsort(owner, kind="stable")
    return _Lists(sym[order].astype(np.uint32), np.bincount(owner, minlength=len(words)))


class Automaton:
    """A minimal acyclic automaton over byte strings that numbers its words in sorted order."""

    def __init__(self, keys: np.ndarray, target: np.ndarray, skip: np.ndarray, final: np.ndarray):
        self.keys, self.target, self.skip, self.final = keys, target, skip, final

    @classmethod
    def build(cls, words: list[bytes]) -> Automaton:
        """Adds sorted words one by one and shares each finished suffix at once."""
        known: dict = {}
        root: list = [False, {}]
        path, before = [root], b""

        def close(depth: int) -> None:
            while len(path) > depth + 1:
                node = path.pop()
                parent, byte = path[-1], before[len(path) - 1]
                mark = (node[0], tuple((b, id(n)) for b, n in node[1].items()))
                parent[1][byte] = known.setdefault(mark, node)

        for w in words:
            same = 0
            while same < min(len(w), len(before)) and w[same] == before[same]:
                same += 1
            close(same)
            for b in w[same:]:
                node: list = [False, {}]
                path[-1][1][b] = node
                path.append(node)
            path[-1][0] = True
            before = w
        close(0)
        number, order, below, stack = {id(root): 0}, [root], {}, [root]
        while stack:
            for n in stack.pop()[1].values():
                if id(n) not in number:
                    number[id(n)] = len(order)
                    order.append(n)
                    stack.append(n)

        work = [(root, False)]
        while work:
            node, ready = work.pop()
            if id(node) in below:
                continue
            if ready:
                below[id(node)] = node[0] + sum(below[id(n)] for n in node[1].values())
            else:
                work.append((node, True))
                work.extend((n, False) for n in node[1].values())
        arcs = []
        for node in order:
            ahead = int(node[0])
            for b, n in sorted(node[1].items()):
                arcs.append((number[id(node)] << 8 | b, number[id(n)], ahead))
                ahead += below[id(n)]
        arcs.sort()
        table = np.array(arcs, np.int64).reshape(-1, 3)
        return cls(table[:, 0].copy(), table[:, 1].astype(np.int32), table[:, 2].astype(np.int32),
                   np.array([n[0] for n in order], bool))

    def rank(self, words: list[bytes]) -> np.ndarray:
        """Each word's number, or -1; all words take one step at a time."""
        size = np.array([len(w) for w in words], np.int64)
        buf = np.frombuffer(b"".join(words) or b"\0", np.uint8)
        start = np.cumsum(size) - size
        state, total = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        if not len(self.keys):
            return np.full(len(words), -1)
        at, depth = np.flatnonzero(size > 0), 0
        state[size == 0] = 0
        while len(at):
            key = state[at] << 8 | buf[start[at] + depth]
            k = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            ok = self.keys[k] == key
            state[at] = np.where(ok, self.target[k], -1)
            total[at] += np.where(ok, self.skip[k], 0)
            depth += 1
            at = at[ok & (size[at] > depth)]
        return np.where((state >= 0) & self.final[state], total, -1)


class Lexicon:
    """The automaton and the ids of its words, as one file that is mapped into memory."""

    def __init__(self, automaton: Automaton, offsets: np.ndarray, ids: np.ndarray):
        self.automaton, self.offsets, self.ids = automaton, offsets, ids

    @classmethod
    def compile(cls, words: list[str], encode) -> Lexicon:
        keyed = sorted({w.encode(): w for w in words}.items())
        ids = encode([w for _, w in keyed])
        return cls(Automaton.build([b for b, _ in keyed]), np.r_[0, np.cumsum(ids.size)], ids.flat)

    def to_bytes(self) -> bytes:
        a = self.automaton
        parts = [a.keys.astype("<i8"), self.offsets.astype("<i8"), a.target.astype("<i4"),
                 a.skip.astype("<i4"), self.ids.astype("<u4"), a.final.astype("u1")]
        head = np.array([len(p) for p in parts], "<i8")
        return head.tobytes() + b"".join(p.tobytes() for p in parts)

    @classmethod
    def mapped(cls, data: bytes) -> Lexicon:
        """Maps the compiled file; its name goes at once, the mapping keeps it alive."""
        with tempfile.NamedTemporaryFile() as f:
            f.write(data)
            f.flush()
            whole = np.asarray(np.memmap(f.name, np.uint8, "r"))
        sizes, at, out = whole[:48].view("<i8"), 48, []
        for n, kind in zip(sizes, ("<i8", "<i8", "<i4", "<i4", "<u4", "?")):
            end = at + int(n) * np.dtype(kind).itemsize
            out.append(whole[at:end].view(kind))
            at = end
        return cls(Automaton(out[0], out[2], out[3], out[5]), out[1], out[4])


class Codec:
    """Encoder and decoder of one word-end BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, special = spec["model"]["vocab"], spec["added_tokens"]
        self.special = {t["content"]: t["id"] for t in special}
        self.tokens = [""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for name, i in [*vocab.items(), *self.special.items()]:
            self.tokens[i] = name
        letters = _byte_letters()
        first = np.array([vocab[c] for c in letters], np.int64)
        last = np.array([vocab[c + _END] for c in letters], np.int64)
        rows = sorted((vocab[a] << 17 | vocab[b], k, vocab[a + b])
                      for k, (a, b) in enumerate(spec["model"]["merges"]))
        table = np.array(rows, np.int64)
        self.merges = (first, last, table[:, 0].copy(), table[:, 1].copy(), table[:, 2].copy())
        self.compiled = b""

    def with_lexicon(self, words: list[str]) -> Codec:
        self.compiled = Lexicon.compile(
            words, lambda w: merge_array(self.merges, w)).to_bytes()
        return self


class Encoder:
    """A worker's codec: the mapped lexicon, and what it has merged lately."""

    def __init__(self, codec: Codec):
        self.codec = codec
        self.lexicon = Lexicon.mapped(codec.compiled) if codec.compiled else None
        self.cut = (re.compile("(" + "|".join(map(re.escape, codec.special)) + ")")
                    if codec.special else None)
        self._forget()

    def _forget(self) -> None:
        self.merged: dict[str, int] = {}
        self.kept = _Lists(np.zeros(0, np.uint32), np.zeros(0, np.int64))

    def _words(self, words: list[str]) -> _Lists:
        rank = (self.lexicon.automaton.rank([w.encode() for w in words])
                if self.lexicon is not None else np.full(len(words), -1))
        known = rank >= 0
        rest = [words[i] for i in np.flatnonzero(~known).tolist()]
        new = [w for w in rest if w not in self.merged]
        if len(self.merged) + len(new) > REMEMBERED:
            self._forget()
            new = rest
        for s in range(0, len(new), 20_000):
            part = new[s:s + 20_000]
            self.merged.update(zip(part, range(len(self.merged), len(self.merged) + len(part))))
            more = merge_array(self.codec.merges, part)
            self.kept = _Lists(np.concatenate([self.kept.flat, more.flat]),
                               np.concatenate([self.kept.size, more.size]))
        start, size = np.empty(len(words), np.int64), np.empty(len(words), np.int64)
        at = np.fromiter(map(self.merged.__getitem__, rest), np.int64, len(rest))
        start[~known], size[~known] = self.kept.start[at], self.kept.size[at]
        if not known.any():
            return _Lists(self.kept.flat, size, start)
        begin = self.lexicon.offsets[rank[known]]
        start[known] = begin + len(self.kept.flat)
        size[known] = self.lexicon.offsets[rank[known] + 1] - begin
        return _Lists(np.concatenate([self.kept.flat, self.lexicon.ids]), size, start)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, as unsigned 32-bit numbers."""
        flat: list[str] = []
        counts = []
        for text in texts:
            before = len(flat)
            if self.cut is not None and "<|" in text:
                for k, part in enumerate(self.cut.split(text)):
                    # a special string is kept under a name that no chunk can have
                    flat.extend([" " + part] if k % 2 else chunks_of(part))
            else:
                flat.extend(chunks_of(text))
            counts.append(len(flat) - before)
        seen = dict.fromkeys(flat)
        parts = [[c] if c[0] == " " else words_in(c) for c in seen]
        members = [w for ws in parts for w in ws]
        number = dict.fromkeys(members)
        words = self._words([w for w in number if w[0] != " "])
        if len(words.size) < len(number):
            special = [w for w in number if w[0] == " "]
            words = words.and_one_each([self.codec.special[w[1:]] for w in special])
            number = dict.fromkeys([w for w in number if w[0] != " "] + special)
        chunks = words.joined(_numbered(number, members), np.array([len(ws) for ws in parts], int))
        return chunks.joined(_numbered(seen, flat), np.array(counts, int)).split()

    def decode(self, ids: np.ndarray) -> str:
        return " ".join(map(self.codec.tokens.__getitem__, ids.tolist()))


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A partition's most frequent words; rare ones are let go where too many are held."""
    held: Counter = Counter()
    for b in batches:
        for text in b.column(0).to_pylist():
            held.update(chunks_of(text or ""))
        if len(held) > COUNTED:
            held = Counter(dict(held.most_common(COUNTED // 2)))
    words: Counter = Counter()
    for chunk, n in held.most_common(SENT):
        for w in words_in(chunk):
            words[w] += n
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(words), pa.string()), pa.array(list(words.values()), pa.int64())],
        names=["word", "n"])


def frequent_words(docs: DataFrame, text_col: str = "text", words: int = LEXICON_WORDS) -> list[str]:
    """The ``words`` most frequent words over all texts, counted partition by partition."""
    common.small_batches(docs.sparkSession)
    counted = docs.select(text_col).mapInArrow(_counts, "word string, n long")
    top = (counted.groupBy("word").agg(F.sum("n").alias("n"))
           .orderBy(F.desc("n"), "word").limit(words).collect())
    return [r["word"] for r in top]


def encode_decode(docs: DataFrame, codec: Codec, text_col: str = "text", ids: str = "ids",
                  decoded: str = "decoded") -> DataFrame:
    """``docs`` with each whole text's ids (little-endian unsigned 32-bit numbers) and their text."""
    common.small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(codec)
    ready: list[Encoder] = []

    @F.arrow_udf("struct<ids: binary, decoded: string>")
    def run(texts: pa.Array) -> pa.Array:
        if not ready:
            ready.append(Encoder(sent.value))
        coded = ready[0].encode([x or "" for x in texts.to_pylist()])
        return pa.StructArray.from_arrays(
            [pa.array([x.astype("<u4").tobytes() for x in coded], pa.binary()),
             pa.array([ready[0].decode(x) for x in coded], pa.string())],
            names=["ids", "decoded"])

    kept = [c for c in docs.columns if c not in (ids, decoded)]
    (coded,) = common.unused(docs, "_coded")
    done = docs.select(*kept, run(F.col(text_col)).alias(coded))
    return done.select(*kept, F.col(coded)["ids"].alias(ids),
                       F.col(coded)["decoded"].alias(decoded))
