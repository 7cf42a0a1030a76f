"""SentencePiece encoding and decoding for merge-type vocabularies.

A text is a row of characters, white space written as the space mark. All pairs of
neighbours that form a piece stand in an agenda ordered by score, then from the
left; the best pair is merged, its two new neighbours enter the agenda, and pairs
that a merge has broken leave it. Characters without a piece become bytes.

Where no piece has the space mark behind another character, no merge crosses the
border of a word, and the agenda of each word is its own: with such vocabularies this
gives what a single agenda for the whole text gives. The agendas of the new words of
an Arrow batch lie side by side as rows of a matrix of costs, and each step takes the
first of the least costs of every row; a long word has a heap. Words met lately are
remembered with their ids.

With ``check`` every word that an Arrow batch brings anew is also given to the
sentencepiece library, and the column says for every text whether the ids of all its words
are the library's. The tests hold whole texts, ids and decoded texts against it.

Null texts count as empty; an empty text has the end id alone. Nothing is cut
from long texts. Columns of the result's names are replaced, all others pass
through, rows that repeat or have no id are encoded like any other.
"""

from __future__ import annotations

import codecs
import re
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import common

MARK = "▁"          # stands for a space in pieces
REMEMBERED = 200_000     # words a worker remembers, at most twice as many
LONG_WORD = 200          # characters; longer words are not remembered
WIDTHS = (6, 8, 10, 12, 16, 24, 48)   # characters; longer words have a heap
_NEVER = np.int32(1 << 30)
_REPLACED = "�"


def _byte_by_byte(error: UnicodeError):
    """Every byte that belongs to no character is replaced by itself."""
    return _REPLACED, error.start + 1


codecs.register_error("byte-by-byte", _byte_by_byte)


class Vocabulary:
    """Pieces, scores and kinds of a model, read through the library's processor."""

    def __init__(self, path: str):
        self.path = path
        with open(path, "rb") as f:
            self.model = f.read()
        model = sentencepiece.SentencePieceProcessor(model_proto=self.model)
        every = range(model.vocab_size())
        self.names = [model.id_to_piece(i) for i in every]
        self.unknown, self.end = model.unk_id(), model.eos_id()
        self.control = {i for i in every if model.is_control(i)}
        self.of_byte = {int(self.names[i][3:5], 16): i for i in every if model.is_byte(i)}
        special = self.control | set(self.of_byte.values()) | {self.unknown}
        self.ids = {self.names[i]: i for i in every if i not in special}
        self.costs = {p: -model.get_score(i) for p, i in self.ids.items()}
        self.prefix = model.normalize("a").startswith(MARK)
        probe = "A  ﬁＡ \t́​"
        if model.normalize(probe) != (MARK if self.prefix else "") + probe.replace(" ", MARK):
            raise ValueError("only models that leave texts as they are (identity) are built here")
        if any(model.is_unused(i) for i in every):
            raise ValueError("models with unused pieces are not built here")
        self.by_word = not any(MARK in p.lstrip(MARK) for p in self.ids)

    def marked(self, text: str) -> str:
        return (MARK if self.prefix and text else "") + text.replace(" ", MARK)


def merged(text: str, costs: dict[str, float]) -> list[str]:
    """The symbols that merging by a score-ordered agenda, a heap, leaves of ``text``.

    ``costs`` has the negated score of each piece.
    """
    symbols: list[str | None] = list(text)
    n = len(symbols)
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))
    agenda = [(costs[symbols[i] + symbols[i + 1]], i, i + 1, 2) for i in range(n - 1)
              if symbols[i] + symbols[i + 1] in costs]
    heapify(agenda)

    def enter(i: int, j: int) -> None:
        both = symbols[i] + symbols[j]
        if both in costs:
            heappush(agenda, (costs[both], i, j, len(both)))

    while agenda:
        _, i, j, size = heappop(agenda)
        left, right = symbols[i], symbols[j]
        if left is None or right is None or len(left) + len(right) != size:
            continue  # a merge has broken this pair
        symbols[i], symbols[j] = left + right, None
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            enter(i, k)
        if before[i] >= 0:
            enter(before[i], i)
    return [s for s in symbols if s is not None]


class Agendas:
    """The agendas of many words, side by side.

    Characters and pieces are numbered; a sorted table says what two neighbours make, and
    at what cost. Costs are ranks of scores, equal for equal scores.
    """

    def __init__(self, vocabulary: Vocabulary):
        ids, costs = vocabulary.ids, vocabulary.costs
        size = len(vocabulary.names)
        letters = sorted({c for p in ids for c in p})
        number = dict(ids)
        for c in letters:   # letters that are no pieces have numbers beyond those of pieces
            number.setdefault(c, size + len(number))
        self.pieces, self.nothing = size, size + len(number) + 1
        self.of_letter = np.full(0x110000, self.nothing, np.int32)
        self.of_letter[[ord(c) for c in letters]] = [number[c] for c in letters]
        rank = {cost: k for k, cost in enumerate(sorted(set(costs.values())))}
        rows = sorted((number[p[:k]] << 20 | number[p[k:]], rank[costs[p]], number[p])
                      for p in ids for k in range(1, len(p))
                      if p[:k] in number and p[k:] in number)
        table = np.array(rows, np.int64).reshape(-1, 3)
        self.keys = np.append(table[:, 0], np.int64(1) << 60)
        self.cost = np.append(table[:, 1], _NEVER).astype(np.int32)
        self.made = np.append(table[:, 2], self.nothing).astype(np.int32)

    def _costs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = left.astype(np.int64) << 20 | right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.cost[at], _NEVER), at.astype(np.int32)

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of the words end to end, and where each word's end; no word is over long."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        codes = self.of_letter[np.frombuffer("".join(words).encode("utf-32-le"), "<u4")]
        start = np.cumsum(size) - size
        symbols, counts = np.full((len(words), WIDTHS[-1]), self.nothing, np.int32), size.copy()
        low = 0
        for width in WIDTHS:
            rows = np.flatnonzero((size > low) & (size <= width))
            low = width
            if not len(rows):
                continue
            at = np.minimum(start[rows, None] + np.arange(width), len(codes) - 1)
            part = np.where(np.arange(width) < size[rows, None], codes[at], self.nothing)
            symbols[rows, :width], counts[rows] = self._side_by_side(part, size[rows])
        kept = np.arange(WIDTHS[-1]) < counts[:, None]
        return symbols[kept], np.cumsum(counts)

    def _side_by_side(self, symbols: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        done, counts = symbols.copy(), size.copy()
        rows = np.arange(len(symbols))
        if symbols.shape[1] < 2:
            return done, counts
        cost, pair = self._costs(symbols[:, :-1], symbols[:, 1:])
        while True:
            best = cost.argmin(1)
            here = np.arange(len(rows))
            live = cost[here, best] < _NEVER
            if not live.all():
                done[rows[~live], :symbols.shape[1]] = symbols[~live]
                rows, best = rows[live], best[live]
                symbols, cost, pair = symbols[live], cost[live], pair[live]
                here = here[:len(rows)]
            if not len(rows):
                return done, counts
            new = self.made[pair[here, best]]
            # what stands right of the merged pair moves up by one place
            place = np.arange(symbols.shape[1])
            moved = place + (place > best[:, None])
            moved[:, -1] = np.minimum(moved[:, -1], symbols.shape[1] - 1)
            symbols = np.take_along_axis(symbols, moved, 1)
            symbols[:, -1] = self.nothing
            symbols[here, best] = new
            moved = np.minimum(moved[:, :-1], cost.shape[1] - 1)
            cost, pair = np.take_along_axis(cost, moved, 1), np.take_along_axis(pair, moved, 1)
            cost[:, -1] = _NEVER
            right = np.minimum(best + 1, symbols.shape[1] - 1)
            after, after_at = self._costs(new, symbols[here, right])
            inside = best < cost.shape[1]
            cost[here[inside], best[inside]] = after[inside]
            pair[here[inside], best[inside]] = after_at[inside]
            first = best > 0
            before, before_at = self._costs(symbols[here[first], best[first] - 1], new[first])
            cost[here[first], best[first] - 1] = before
            pair[here[first], best[first] - 1] = before_at
            counts[rows] -= 1


class Codec:
    """A worker's encoder and decoder, with the words it has met lately."""

    def __init__(self, vocabulary: Vocabulary, checks: bool = False):
        self.v = v = vocabulary
        self.checks = checks
        self.agendas = Agendas(v)
        self.words = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+") if v.by_word else None
        self.end = np.array([v.end], "<i4").tobytes()
        self.packed = {p: np.array([i], "<i4").tobytes() for p, i in v.ids.items()}
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self._library: sentencepiece.SentencePieceProcessor | None = None
        self.unchecked: dict[str, bytes] = {}
        self.wrong: set[str] = set()   # words of which the library thinks otherwise
        shown = [p.replace(MARK, " ").encode() for p in v.names]
        for i in v.control:
            shown[i] = b""
        for byte, i in v.of_byte.items():
            shown[i] = bytes([byte])
        shown[v.unknown] = " ⁇ ".encode()
        self.size = np.array([len(s) for s in shown], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(shown), np.uint8)
        self.spaced = np.array([p.startswith(MARK) for p in v.names])
        self.is_control = np.zeros(len(v.names), bool)
        self.is_control[list(v.control)] = True

    def _parts(self, word: str) -> list[str]:
        """``word`` cut between characters that no piece has side by side."""
        near = self.v.side_by_side
        cuts = [k for k in range(1, len(word)) if word[k - 1:k + 1] not in near]
        return [word[a:b] for a, b in zip([0, *cuts], [*cuts, len(word)])]

    def _learn(self, words: list[str]) -> None:
        """Finds the ids of words that are not among those met lately."""
        known, older = self.known, self.older
        new = []
        for w in words:
            ids = older.get(w)
            if ids is None:
                new.append(w)
            else:
                known[w] = ids
        if not new:
            return
        short = [w for w in new if len(w) <= WIDTHS[-1]]
        flat, ends = self.agendas.merge(short)
        bytes_of, odd = flat.astype("<i4").tobytes(), np.flatnonzero(flat >= self.agendas.pieces)
        known.update(zip(short, map(bytes_of.__getitem__, map(
            slice, (np.r_[0, 4 * ends[:-1]]).tolist(), (4 * ends).tolist()))))
        by_heap = [short[i] for i in np.unique(np.searchsorted(ends, odd, "right")).tolist()]
        for w in by_heap + [w for w in new if len(w) > WIDTHS[-1]]:
            known[w] = self._by_heap(w)
        if self.checks:
            self.unchecked.update((w, known[w]) for w in new)

    def _by_heap(self, word: str) -> bytes:
        get = self.packed.get
        return b"".join([get(s) or self._fallback(s) for s in merged(word, self.v.costs)])

    def _fallback(self, symbol: str) -> bytes:
        v = self.v
        ids = [v.of_byte[b] for b in symbol.encode()] if v.of_byte else [v.unknown]
        return np.array(ids, "<i4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text and the end id, as little-endian 32-bit numbers."""
        if len(self.known) > REMEMBERED:
            self.older, self.known = self.known, {}
        get, split = self.known.get, self.words
        listed = [split.findall(m) if split else [m] if m else [] for m in map(self.v.marked, texts)]
        found = [[get(w) for w in words] for words in listed]
        new = dict.fromkeys([w for words, ids in zip(listed, found) if None in ids
                             for w, i in zip(words, ids) if i is None])
        self._learn(list(new))
        known = self.known
        out = [b"".join([i or known[w] for w, i in zip(words, ids)]) + self.end
               for words, ids in zip(listed, found)]
        for w in new:
            if len(w) > LONG_WORD:
                del known[w]
        return out

    def check(self) -> None:
        """Asks the library for the ids of the words that are new since the last time."""
        if self._library is None:
            self._library = sentencepiece.SentencePieceProcessor(model_proto=self.v.model)
        cut = len(MARK) if self.v.prefix else 0
        # a lone mark, which the library would add itself, cannot be asked for
        words = [w for w in self.unchecked if len(w) > cut]
        want = self._library.encode([w[cut:].replace(MARK, " ") for w in words], num_threads=1)
        self.wrong.update(w for w, ids in zip(words, want)
                          if np.frombuffer(self.unchecked[w], "<i4").tolist() != ids)
        self.unchecked.clear()

    def agrees(self, text: str) -> bool:
        marked = self.v.marked(text)
        return not self.wrong or self.wrong.isdisjoint(
            self.words.findall(marked) if self.words else [marked])

    def decode(self, ids: np.ndarray) -> str:
        """The text of the ids: bytes join to characters, the added space goes."""
        ids = ids[~self.is_control[ids]]
        if not len(ids):
            return ""
        size = self.size[ids]
        ends = np.cumsum(size)
        at = np.arange(ends[-1]) + np.repeat(self.start[ids] - (ends - size), size)
        raw = self.flat[at].tobytes()
        if self.v.prefix and self.spaced[ids[0]]:
            raw = raw[1:]
        return raw.decode("utf-8", "byte-by-byte")


def encode_decode(docs: DataFrame, vocabulary: Vocabulary, text_col: str = "text",
                  ids: str = "ids", decoded: str = "decoded", check: str | None = None) -> DataFrame:
    """``docs`` with each whole text's ids (array of int, end id last) and the text they give.

    ``check`` names a further column: does the library give the same for the text's words?
    """
    common.small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    @F.arrow_udf("struct<ids: array<int>, decoded: string, agrees: boolean>")
    def run(texts: pa.Array) -> pa.Array:
        codec = _codec(sent.value, check is not None)
        whole = [x or "" for x in texts.to_pylist()]
        coded = codec.encode(whole)
        flat = np.frombuffer(b"".join(coded), "<i4")
        ends = np.cumsum([0, *(len(c) // 4 for c in coded)])
        shown = [codec.decode(flat[a:b]) for a, b in zip(ends[:-1], ends[1:])]
        if check:
            codec.check()
        agrees = [codec.agrees(x) if check else None for x in whole]
        return pa.StructArray.from_arrays(
            [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32())),
             pa.array(shown, pa.string()), pa.array(agrees, pa.bool_())],
            names=["ids", "decoded", "agrees"])

    made = [ids, decoded, *([check] if check else [])]
    kept = [c for c in docs.columns if c not in made]
    (coded,) = common.unused(docs, "_coded")
    done = docs.select(*kept, run(F.col(text_col)).alias(coded))
    return done.select(*kept, *[F.col(coded)[f].alias(name)
                                for f, name in zip(("ids", "decoded", "agrees"), made)])


_ready: dict[tuple[str, bool], Codec] = {}   # of a worker, which serves many tasks


def _codec(vocabulary: Vocabulary, checks: bool) -> Codec:
    name = vocabulary.path, checks
    if name not in _ready:
        _ready.clear()
        _ready[name] = Codec(vocabulary, checks)
    return _ready[name]
