"""Language ID: a bidirectional gated recurrent network over bytes.

One state runs over a text's bytes from the left, another from the right; both
together label every byte with a language, and the mean of the labels'
probabilities over all bytes is the document's distribution. The network is
trained in numpy by backpropagation through time on windows cut out of a bounded
sample of texts. Texts are read whole, in windows of ``WINDOW`` bytes that start
with empty states, as in training, so the cost is linear in a text's length and
memory does not grow with it.

Predictions depend on the text alone. A null text and one without a letter are
``und`` with score 0. With no text to learn from, everything is ``und``. Rows
without an id are predicted like others. Columns of the result's names in the
input are replaced; all others pass through.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import common

UNKNOWN = "und"
WINDOW = 96            # bytes that one run of the states covers
HIDDEN = 8             # of each direction
SAMPLE_TEXTS = 700     # texts learned from per language, about
CUTS = 3               # windows cut out of each
AT_ONCE = 1024         # windows run side by side, fewer with very many languages
EACH = 48              # windows of each language in a training step, as far as memory goes
STEPS = 260            # training steps; more where a step has few windows of a language
SEEN = 3000            # windows of a language in all steps, at least
CELLS = 1 << 25        # labels' probabilities of a training step, at most

_CODES = np.zeros(256, np.int64)  # 0: anything but a letter
_CODES[65:91] = _CODES[97:123] = np.arange(1, 27)
_CODES[128:256] = np.arange(27, 155)
SYMBOLS = 155


@dataclass
class Model:
    languages: list[str]
    w_in: np.ndarray    # (2, SYMBOLS, 3 H): update, reset and candidate of each direction
    w_state: np.ndarray  # (2, H, 3 H)
    w_out: np.ndarray   # (2 H, L)
    b_out: np.ndarray   # (L,)


def codes_of(text: bytes) -> np.ndarray:
    """Symbols of a text's bytes; A-Z are a-z, and a run of other characters is one 0."""
    c = _CODES[np.frombuffer(text, np.uint8)]
    keep = c > 0
    keep[1:] |= c[:-1] > 0
    if len(keep):
        keep[0] = True
    return c[keep]


def _sigmoid(x):
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _run(codes, w_in, w_state, keep):
    """One direction over (N, T) codes; ``keep`` collects what backpropagation needs."""
    n, t = codes.shape
    h = np.zeros((n, HIDDEN), np.float32)
    out = np.empty((t, n, HIDDEN), np.float32)
    for k in range(t):
        x, s = w_in[codes[:, k]], h @ w_state
        zr = _sigmoid(x[:, :2 * HIDDEN] + s[:, :2 * HIDDEN])
        z, r, u = zr[:, :HIDDEN], zr[:, HIDDEN:], s[:, 2 * HIDDEN:]
        c = np.tanh(x[:, 2 * HIDDEN:] + r * u)
        keep.append((h, z, r, u, c))
        h = c + z * (h - c)
        out[k] = h
    return out


def _back(codes, w_state, kept, grad_out):
    """Gradients of one direction, from the last step to the first."""
    g_in = np.zeros((SYMBOLS, 3 * HIDDEN), np.float32)
    g_state = np.zeros_like(w_state)
    gh = np.zeros_like(grad_out[0])
    for k in range(len(kept) - 1, -1, -1):
        h, z, r, u, c = kept[k]
        gh = gh + grad_out[k]
        gc = gh * (1 - z) * (1 - c * c)
        gz = gh * (h - c) * z * (1 - z)
        gr = gc * u * r * (1 - r)
        gx = np.hstack([gz, gr, gc])
        gs = np.hstack([gz, gr, gc * r])
        np.add.at(g_in, codes[:, k], gx)
        g_state += h.T @ gs
        gh = gh * z + gs @ w_state.T
    return g_in, g_state


def train(codes: np.ndarray, label: np.ndarray, languages: list[str], steps: int | None = None,
          batch: int | None = None, rate: float = 0.02, seed: int = 3) -> Model:
    """Adam on the mean cross-entropy of all positions' labels.

    The batch grows with the languages, and where it may not, the steps do; a step
    of fewer windows than languages takes some of them in turn.
    """
    rng = np.random.default_rng(seed)
    names, h = len(languages), HIDDEN
    if batch is None:
        batch = max(1, min(max(192, EACH * names), CELLS // (WINDOW * names)))
    if steps is None:
        steps = max(STEPS, -(-SEEN * names // batch))
    p = [rng.normal(0, 0.3, (2, SYMBOLS, 3 * h)).astype(np.float32),
         rng.normal(0, 0.3, (2, h, 3 * h)).astype(np.float32),
         rng.normal(0, 0.3, (2 * h, names)).astype(np.float32), np.zeros(names, np.float32)]
    first, second = [np.zeros_like(x) for x in p], [np.zeros_like(x) for x in p]
    by_label = [np.flatnonzero(label == k) for k in range(names)]
    turn = rng.permutation(names) if batch < names else np.arange(names)
    for step in range(1, steps + 1):
        now_learned = turn[:batch]
        turn = np.roll(turn, -batch) if batch < names else turn
        take = np.concatenate([rng.choice(by_label[k], max(1, batch // names))
                               for k in now_learned])
        x, y = codes[take], label[take]
        kept = [[], []]
        out = np.concatenate([_run(x, p[0][0], p[1][0], kept[0]),
                              _run(x[:, ::-1], p[0][1], p[1][1], kept[1])[::-1]], axis=2)
        logits = out @ p[2] + p[3]
        logits -= logits.max(2, keepdims=True)
        prob = np.exp(logits)
        prob /= prob.sum(2, keepdims=True)
        prob[:, np.arange(len(y)), y] -= 1
        prob /= len(y) * WINDOW
        g_out = prob @ p[2].T
        ahead = _back(x, p[1][0], kept[0], g_out[:, :, :h])
        behind = _back(x[:, ::-1], p[1][1], kept[1], g_out[::-1, :, h:])
        grads = [np.stack([ahead[0], behind[0]]), np.stack([ahead[1], behind[1]]),
                 out.reshape(-1, 2 * h).T @ prob.reshape(-1, names), prob.sum((0, 1))]
        size = np.sqrt(sum(float((g * g).sum()) for g in grads))
        for q, g, a, b in zip(p, grads, first, second):
            g = g * min(1.0, 1.0 / max(size, 1e-9))
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            now = rate * min(1.0, 2 * (1 - step / (steps + 1)))
            q -= now * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.99 ** step)) + 1e-8)
    return Model(languages, *p)


class Runner:
    """A model laid out for prediction: both directions are steps of one joint state."""

    def __init__(self, m: Model):
        h = HIDDEN
        gate = [0.5, 0.5, 1.0]  # sigmoids are taken as tanh of the half
        self.m = m
        self.x = np.zeros((2, SYMBOLS, 6 * h), np.float32)
        self.s = np.zeros((2 * h, 6 * h), np.float32)
        for d in (0, 1):
            for g in range(3):
                to = slice((2 * g + d) * h, (2 * g + d + 1) * h)
                self.x[d, :, to] = m.w_in[d][:, g * h:(g + 1) * h] * gate[g]
                self.s[d * h:(d + 1) * h, to] = m.w_state[d][:, g * h:(g + 1) * h] * gate[g]

    def label_probabilities(self, codes: np.ndarray) -> np.ndarray:
        """(T, N, L) probabilities of every position of (N, T) windows."""
        n, t = codes.shape
        h = 2 * HIDDEN
        state = np.zeros((n, h), np.float32)
        ahead = np.empty((t, n, h), np.float32)
        for k in range(t):
            x = self.x[0][codes[:, k]]
            x += self.x[1][codes[:, t - 1 - k]]
            s = state @ self.s
            zr = np.tanh(x[:, :2 * h] + s[:, :2 * h])
            zr *= 0.5
            zr += 0.5
            c = zr[:, h:]
            c *= s[:, 2 * h:]
            c += x[:, 2 * h:]
            c = np.tanh(c)
            state -= c
            state *= zr[:, :h]
            state += c
            ahead[k] = state
        both = np.concatenate([ahead[:, :, :HIDDEN], ahead[::-1, :, HIDDEN:]], axis=2)
        p = both.reshape(-1, h) @ self.m.w_out + self.m.b_out
        p -= p.max(1, keepdims=True)
        np.exp(p, out=p)
        p /= p.sum(1, keepdims=True)
        return p.reshape(t, n, -1)

    def documents(self, texts: list[bytes], positions: bool = False):
        """Mean distribution of each text, and on request the label of every symbol."""
        total = np.zeros((len(texts), len(self.m.languages)))
        length = np.zeros(len(texts))
        labels: list[list[np.ndarray]] = [[] for _ in texts]
        owner, rows = [], []
        at_once = max(1, min(AT_ONCE, (CELLS >> 2) // (WINDOW * len(self.m.languages))))

        def flush():
            codes = np.zeros((len(rows), WINDOW), np.int64)
            size = np.array([len(r) for r in rows])
            for i, r in enumerate(rows):
                codes[i, :len(r)] = r
            p = self.label_probabilities(codes)
            real = np.arange(WINDOW)[:, None] < size
            p *= real[:, :, None]
            np.add.at(total, owner, p.sum(0))
            np.add.at(length, owner, size)
            if positions:
                for i, (d, n) in enumerate(zip(owner, size)):
                    labels[d].append(p[:n, i].argmax(1))
            owner.clear(), rows.clear()

        for d, text in enumerate(texts):
            c = codes_of(text)
            for at in range(0, len(c), WINDOW):
                owner.append(d), rows.append(c[at:at + WINDOW])
                if len(rows) == at_once:
                    flush()
        if rows:
            flush()
        mean = total / np.maximum(length, 1)[:, None]
        return (mean, [np.concatenate(x) if x else np.zeros(0, int) for x in labels]) \
            if positions else mean


def fit(docs: DataFrame, learn_from=None, per_language: int = SAMPLE_TEXTS) -> Model | None:
    """Learns every value of ``lang`` from about ``per_language`` texts of each.

    Texts are picked by a hash of the id, and windows at places given by the same
    hash, anywhere in the text; nothing but these windows comes to the driver.
    """
    known = docs.where("lang is not null and text is not null and length(text) > 0")
    known = known.where(learn_from) if learn_from is not None else known
    known = known.where(F.col("text").rlike(r"\p{L}"))
    found = sorted((r["lang"], r["count"]) for r in known.groupBy("lang").count().collect())
    if not found:
        return None
    m = 1 << 30
    limits = F.create_map(*[F.lit(x) for lang, n in found
                            for x in (lang, min(m, m * per_language // n + 1))])
    picked = known.where(F.pmod(F.xxhash64("doc_id", F.crc32(F.col("text").cast("binary"))),
                                F.lit(m)) < F.coalesce(limits[F.col("lang")], F.lit(0)))
    places = [F.substring("text", (F.pmod(F.xxhash64("doc_id", F.lit(k)), F.greatest(
        F.length("text") - WINDOW, F.lit(0)) + 1) + 1).cast("int"), F.lit(WINDOW))
        for k in range(CUTS)]
    cuts = (picked.select("lang", F.explode(F.array_distinct(F.array(*places))).alias("cut"))
            .orderBy("lang", "cut").collect())
    names = [lang for lang, _ in found]
    number = {lang: k for k, lang in enumerate(names)}
    rows, label = [], []
    for r in cuts:
        c = codes_of(r["cut"].encode())[:WINDOW]
        if (c > 0).any():
            rows.append(np.pad(c, (0, WINDOW - len(c)), mode="wrap"))
            label.append(number[r["lang"]])
    present = sorted(set(label))
    names = [names[k] for k in present]
    label = np.searchsorted(present, label)
    return train(np.array(rows), np.asarray(label), names) if names else None


def predict(docs: DataFrame, m: Model | None, text_col: str = "text", lang: str = "lang_pred",
            score: str = "score") -> DataFrame:
    """``docs`` with the most probable language of each whole text and its probability."""
    common.small_batches(docs.sparkSession)
    if m is None:
        return docs.withColumn(lang, F.lit(UNKNOWN)).withColumn(score, F.lit(0.0))
    sent = docs.sparkSession.sparkContext.broadcast(m)
    ready: list[Runner] = []

    @F.arrow_udf("struct<lang: string, score: double>")
    def run(texts: pa.Array) -> pa.Array:
        if not ready:
            ready.append(Runner(sent.value))
        p = ready[0].documents([(x or "").encode() for x in texts.to_pylist()])
        best = p.argmax(1) if len(p) else np.zeros(0, int)
        names = np.array(sent.value.languages, object)[best]
        return pa.StructArray.from_arrays(
            [pa.array(list(names), pa.string()),
             pa.array(np.clip(p[np.arange(len(p)), best], 0, 1).astype(np.float64))],
            names=["lang", "score"])

    kept = [c for c in docs.columns if c not in (lang, score)]
    letter, best = common.unused(docs, "_letter", "_best")
    known = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)).alias(letter)
    done = docs.select(*kept, known, run(F.col(text_col)).alias(best))
    return done.select(
        *kept, F.when(F.col(letter), F.col(best)["lang"]).otherwise(UNKNOWN).alias(lang),
        F.when(F.col(letter), F.col(best)["score"]).otherwise(0.0).alias(score))


def spans(text: str, m: Model) -> list[tuple[str, int]]:
    """Runs of equally labelled symbols of one text: (language, symbols)."""
    labels = Runner(m).documents([text.encode()], positions=True)[1][0]
    cuts = np.flatnonzero(np.r_[True, labels[1:] != labels[:-1]]) if len(labels) else []
    ends = np.r_[cuts[1:], len(labels)] if len(labels) else []
    return [(m.languages[labels[a]], int(b - a)) for a, b in zip(cuts, ends)]
