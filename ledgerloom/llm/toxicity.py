"""Toxicity: a convolutional text classifier over hashed word embeddings.

A word has three hashes, of its whole and of its first bytes; its vector is the
three hashed rows side by side, so two words only look alike if all hashes collide,
and the forms of one stem look somewhat alike. Filters one, two and three words
wide slide over the text, each filter's maximum over the whole text is pooled,
and a logistic unit reads the pooled values. All labelled texts that may be learned
from are read. They are dealt to workers of about ``GROUP`` texts; in each round every
worker takes one pass over its texts from the same model, and what the workers moved
is averaged by Spark. A validation part, taken by hash, calibrates the score (Platt)
and gives each language its own threshold, by counts of all its rounded logits.

Scores depend on the text alone. Null and empty texts score as a text without
words does. Rows without an id are scored and never learned from; an id
labelled twice counts once. Columns ``score`` and the like in the input are
replaced; all others pass through. With no labels of both classes every score
is the share of the class that is there, or 0.5 without labels.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import common
from ledgerloom.operators.broadcasting import broadcast_if_small

BUCKETS = 1 << 15
PREFIXES = (4, 5)      # bytes of a word that the further hashes take
HASHES = 1 + len(PREFIXES)
DIM = 8
WIDTHS = (1, 2, 3)
FILTERS = 6
PAD = max(WIDTHS) - 1
GROUP = 4096           # labelled texts a worker learns from
ROUNDS = 4             # passes over all of them
STEP = 0.01            # logits that calibrate are rounded to this
BLOCK = 1 << 15        # words scored at a time
_TAPS = [(w, o) for w in WIDTHS for o in range(w)]

# A word is a run of letters and digits; bytes above 127 count as letters.
SEPARATOR = np.ones(256, bool)
SEPARATOR[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


@dataclass
class Model:
    tables: list[np.ndarray]                     # of each hash, BUCKETS x DIM
    filters: dict = field(default_factory=dict)  # width -> (width, HASHES * DIM, FILTERS)
    bias: np.ndarray | None = None            # of all filters
    out: np.ndarray | None = None
    out_bias: float = 0.0
    scale: float = 1.0
    shift: float = 0.0
    thresholds: dict = field(default_factory=dict)
    threshold: float = 0.5


def _padded(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All hashes of every word, PAD empty places after each text, and where texts begin."""
    texts = texts.cast(pa.large_string()).fill_null("")
    words, begin = common.words_of(texts, SEPARATOR, prefixes=PREFIXES)
    shift = np.repeat(np.arange(len(texts)) * PAD, np.diff(begin))
    at = np.arange(words.shape[1]) + shift
    ids = np.full((HASHES, words.shape[1] + PAD * len(texts) + PAD), BUCKETS, np.int32)
    ids[:, at] = (words & np.uint64(BUCKETS - 1)).astype(np.int32)
    return ids, begin[:-1] + np.arange(len(texts)) * PAD


def _projections(m: Model) -> tuple[np.ndarray, ...]:
    """Each hashed row times each filter tap; the last row is the empty place."""
    taps = np.concatenate([m.filters[w][o] for w, o in _TAPS], axis=1)
    return tuple(np.vstack([t @ taps[i * DIM:(i + 1) * DIM],
                            np.zeros((1, taps.shape[1]), np.float32)]).astype(np.float32)
                 for i, t in enumerate(m.tables))


def _responses(rows: np.ndarray, m: int) -> np.ndarray:
    """Filter responses at the first ``m`` places from the taps' projections."""
    out, k = [], 0
    for w in WIDTHS:
        acc = rows[:m, k * FILTERS:(k + 1) * FILTERS].copy()
        for o in range(1, w):
            acc += rows[o:m + o, (k + o) * FILTERS:(k + o + 1) * FILTERS]
        out.append(acc)
        k += w
    return np.hstack(out)


def _pooled(ids, begin, tables) -> np.ndarray:
    """Maximum of each filter over each whole text, a block of words at a time."""
    n = len(begin)
    best = np.full((n, FILTERS * len(WIDTHS)), -np.inf, np.float32)
    end = ids.shape[1] - PAD
    for s in range(0, end, BLOCK):
        e = min(end, s + BLOCK)
        rows = tables[0][ids[0, s:e + PAD]]
        for k in range(1, HASHES):
            rows += tables[k][ids[k, s:e + PAD]]
        z = _responses(rows, e - s)
        lo = int(np.searchsorted(begin, s, "right")) - 1
        hi = int(np.searchsorted(begin, e, "left"))
        cuts = np.maximum(begin[lo:hi] - s, 0)
        best[lo:hi] = np.maximum(best[lo:hi], np.maximum.reduceat(z, cuts, axis=0))
    return best


def _logits(m: Model, texts: pa.Array, tables) -> np.ndarray:
    pooled = np.maximum(_pooled(*_padded(texts), tables) + m.bias, 0)
    return pooled @ m.out + m.out_bias


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _seen(all_ids, begin, label) -> np.ndarray:
    """Texts of each class that hold a hashed row, by hash, class and row."""
    ends = np.r_[begin[1:], all_ids.shape[1] - PAD]
    seen = np.zeros((HASHES, 2, BUCKETS))
    for k, ids in enumerate(all_ids):
        for a, b, y in zip(begin, ends, label):
            u = np.unique(ids[a:b])
            seen[k, int(y), u[u < BUCKETS]] += 1
    return seen


def _log_odds(seen: np.ndarray, share: float) -> list[np.ndarray]:
    """Smoothed log odds of the label given a hashed row, the start of the first dimension."""
    share = np.clip(share, 1e-3, 1 - 1e-3)
    out = []
    for clean, toxic in seen:
        odds = np.log((toxic + 2 * share) / (clean + 2 * (1 - share)))
        out.append((odds - np.log(share / (1 - share))).astype(np.float32) / 3)
    return out


def _start(rng: np.random.Generator, seen: np.ndarray, share: float) -> tuple[Model, dict]:
    """The model before its first step, and the squares its step sizes begin with."""
    tables = [rng.normal(0, 0.02, (BUCKETS, DIM)).astype(np.float32) for _ in range(HASHES)]
    for t, odds in zip(tables, _log_odds(seen, share)):
        t[:, 0] = odds
    m = Model(tables)
    leading = [k * DIM for k in range(HASHES)]
    for w in WIDTHS:
        f = rng.normal(0, 0.2, (w, HASHES * DIM, FILTERS)).astype(np.float32)
        f[:, leading] = np.abs(f[:, leading]) + 0.5 / w
        m.filters[w] = f
    m.bias = np.full(FILTERS * len(WIDTHS), -0.5, np.float32)
    m.out = np.full(FILTERS * len(WIDTHS), 0.3, np.float32)
    m.out_bias = -1.0
    past = {**{f"t{k}": np.full_like(t, 1e-2) for k, t in enumerate(tables)},
            **{w: np.full_like(f, 1e-2) for w, f in m.filters.items()},
            "b": np.full_like(m.bias, 1e-2), "o": np.full_like(m.out, 1e-2), "c": 1e-2}
    return m, past


def _pass(m: Model, past: dict, ids, begin, label, share: float, rng, rate: float,
          batch: int) -> None:
    """One pass over the texts in an order of ``rng``; ``share`` is that of all toxic texts."""
    ends = np.r_[begin[1:], ids.shape[1] - PAD]
    weight = np.where(label > 0, 0.5 / max(share, 1e-6), 0.5 / max(1 - share, 1e-6))
    order = rng.permutation(len(label))
    for s in range(0, len(order), batch):
        _step(m, [ids[:, begin[i]:ends[i]] for i in order[s:s + batch]],
              label[order[s:s + batch]], weight[order[s:s + batch]], past, rate)


def train(texts: pa.Array, label: np.ndarray, epochs: int = ROUNDS, rate: float = 0.05,
          batch: int = 64, seed: int = 7) -> Model:
    """Backpropagation through the pooled maxima, with per-weight step sizes (Adagrad)."""
    rng, share = np.random.default_rng(seed), float(label.mean())
    ids, begin = _padded(texts)
    m, past = _start(rng, _seen(ids, begin, label), share)
    for _ in range(epochs):
        _pass(m, past, ids, begin, label, share, rng, rate, batch)
    return m


# -- the same by many workers: weights and squares as rows of DIM numbers ----------
_VALUES = [f"{kind}{k}" for kind in "vp" for k in range(DIM)]
_MOVED = "row int, " + ", ".join(f"{name} float" for name in _VALUES)


def _rows_of(tables: list, filters: dict, bias, out, out_bias) -> np.ndarray:
    """All numbers of a model (or of its squares) as rows: tables first, then the rest."""
    rest = np.concatenate([*(filters[w].ravel() for w in WIDTHS), bias, out, [out_bias]])
    rest = np.pad(rest, (0, -len(rest) % DIM)).reshape(-1, DIM)
    return np.vstack([*tables, rest]).astype(np.float32)


def _as_rows(m: Model, past: dict) -> tuple[np.ndarray, np.ndarray]:
    return (_rows_of(m.tables, m.filters, m.bias, m.out, m.out_bias),
            _rows_of([past[f"t{k}"] for k in range(HASHES)], past, past["b"], past["o"], past["c"]))


def _from_rows(value: np.ndarray, square: np.ndarray) -> tuple[Model, dict]:
    def cut(rows: np.ndarray):
        tables = [rows[k * BUCKETS:(k + 1) * BUCKETS].copy() for k in range(HASHES)]
        rest, at, parts = rows[HASHES * BUCKETS:].ravel(), 0, []
        shapes = [(w, HASHES * DIM, FILTERS) for w in WIDTHS] + [(FILTERS * len(WIDTHS),)] * 2
        for shape in shapes:
            n = int(np.prod(shape))
            parts.append(rest[at:at + n].reshape(shape).copy())
            at += n
        return tables, dict(zip(WIDTHS, parts)), parts[-2], parts[-1], float(rest[at])

    tables, filters, bias, out, out_bias = cut(value)
    m = Model(tables, filters, bias, out, out_bias)
    tables, filters, bias, out, c = cut(square)
    return m, {**{f"t{k}": t for k, t in enumerate(tables)}, **filters, "b": bias, "o": out, "c": c}


def _count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen = np.zeros((HASHES, 2, BUCKETS))
    for b in batches:
        if b.num_rows:
            seen += _seen(*_padded(b.column(0)), b.column(1).to_numpy())
    at = np.flatnonzero(seen)
    yield pa.RecordBatch.from_arrays(
        [pa.array(at.astype(np.int32)), pa.array(seen.ravel()[at].astype(np.int64))],
        names=["at", "n"])


def train_on(rows: DataFrame, workers: int, share: float, rounds: int = ROUNDS,
             rate: float = 0.05, batch: int = 64, seed: int = 7) -> Model:
    """``train`` on all ``rows`` (h, text, toxic), dealt to ``workers`` by hash.

    A weight's new value is the mean of those workers that moved it.
    """
    spark = rows.sparkSession
    counted = (rows.select("text", "toxic").mapInArrow(_count_rows, "at int, n long")
               .groupBy("at").agg(F.sum("n").alias("n")).toArrow())
    seen = np.zeros(HASHES * 2 * BUCKETS)
    seen[counted.column("at").to_numpy()] = counted.column("n").to_numpy()
    m, past = _start(np.random.default_rng(seed), seen.reshape(HASHES, 2, BUCKETS), share)
    value, square = _as_rows(m, past)
    dealt = (rows.withColumn("worker", F.pmod("h", F.lit(workers)).cast("int"))
             .repartition(workers, "worker"))
    for turn in range(rounds):
        sent = spark.sparkContext.broadcast((value, square))

        def run(key: tuple, mine: pa.Table) -> pa.Table:
            mine = mine.sort_by([("h", "ascending"), ("text", "ascending")]).combine_chunks()
            old, squares = sent.value
            model, state = _from_rows(old, squares)
            texts = pa.concat_arrays(mine.column("text").chunks)
            rng = np.random.default_rng([seed, turn, key[0].as_py()])
            _pass(model, state, *_padded(texts), mine.column("toxic").to_numpy().astype(float),
                  share, rng, rate, batch)
            new, squared = _as_rows(model, state)
            at = np.flatnonzero((squared != squares).any(axis=1))
            return pa.table([pa.array(at.astype(np.int32)), *(pa.array(x[at, k].copy())
                             for x in (new, squared) for k in range(DIM))], ["row", *_VALUES])

        moved = (dealt.groupBy("worker").applyInArrow(run, _MOVED).groupBy("row")
                 .agg(*[F.avg(c).cast("float").alias(c) for c in _VALUES]).toArrow())
        at = moved.column("row").to_numpy()
        for k in range(DIM):
            value[at, k] = moved.column(f"v{k}").to_numpy()
            square[at, k] = moved.column(f"p{k}").to_numpy()
        sent.destroy()
    return _from_rows(value, square)[0]


def _step(m: Model, docs, label, weight, past, rate) -> None:
    tables = _projections_of(m, docs)
    grad = {w: np.zeros_like(f) for w, f in m.filters.items()}
    pooled, where = [], []
    for ids, rows in zip(docs, tables):
        z = _responses(rows, ids.shape[1])
        top = z.argmax(0)
        pooled.append(z[top, np.arange(z.shape[1])])
        where.append(top)
    pooled = np.array(pooled) + m.bias
    hidden = np.maximum(pooled, 0)
    err = ((_sigmoid(hidden @ m.out + m.out_bias) - label) * weight / len(docs)).astype(np.float32)
    back = err[:, None] * m.out * (pooled > 0)
    hit: list = []
    vec: list = []
    for ids, top, g in zip(docs, where, back):
        for j in np.flatnonzero(g):
            w, f = WIDTHS[j // FILTERS], j % FILTERS
            for o in range(w):
                at = top[j] + o
                if at >= ids.shape[1] or ids[0, at] == BUCKETS:
                    continue
                x = np.concatenate([t[r] for t, r in zip(m.tables, ids[:, at])])
                grad[w][o, :, f] += g[j] * x
                hit.append(ids[:, at])
                vec.append(g[j] * m.filters[w][o, :, f])

    def move(key, value, g, at=...):
        past[key][at] += g * g
        value[at] -= rate * g / np.sqrt(past[key][at])

    move("o", m.out, hidden.T @ err)
    move("b", m.bias, back.sum(0))
    past["c"] += float(err.sum()) ** 2
    m.out_bias -= rate * float(err.sum()) / past["c"] ** 0.5
    for w, g in grad.items():
        move(w, m.filters[w], g)
    for k in range(HASHES if hit else 0):
        rows, inverse = np.unique(np.array(hit)[:, k], return_inverse=True)
        total = np.zeros((len(rows), DIM), np.float32)
        np.add.at(total, inverse, np.array(vec, np.float32)[:, k * DIM:(k + 1) * DIM])
        move(f"t{k}", m.tables[k], total, rows)


def _projections_of(m: Model, docs) -> list[np.ndarray]:
    """The taps' projections for the words of some texts only."""
    taps = np.concatenate([m.filters[w][o] for w, o in _TAPS], axis=1)
    out = []
    for ids in docs:
        x = np.zeros((ids.shape[1] + PAD, HASHES * DIM), np.float32)
        real = np.flatnonzero(ids[0] < BUCKETS)
        x[real] = np.hstack([t[row[real]] for t, row in zip(m.tables, ids)])
        out.append(x @ taps)
    return out


def calibrate(m: Model, logits: np.ndarray, label: np.ndarray, lang: list, share: float,
              times: np.ndarray | None = None) -> None:
    """Platt scale and shift at the corpus' share of toxic texts, and a threshold by language.

    ``times``: how many texts each entry stands for, else one.

    A language's threshold gives the best F1 on its validation texts; languages
    with under 30 of them, or under 5 toxic ones, take that of all languages.
    """
    times = np.ones(len(label)) if times is None else times
    mean, total = np.average(label, weights=times), times.sum()
    weight = times * np.where(label > 0, share / max(mean, 1e-6),
                              (1 - share) / max(1 - mean, 1e-6))
    a, b = 1.0, float(np.log(share / (1 - share)))
    for _ in range(300):
        err = weight * (_sigmoid(a * logits + b) - label)
        a -= 0.05 * float((err * logits).sum() / total + 0.01 * (a - 1))
        b -= 0.2 * float(err.sum() / total)
    m.scale, m.shift = max(a, 0.05), b
    score = _sigmoid(m.scale * logits + m.shift)

    def best(take: np.ndarray) -> float:
        s, y, w = score[take], label[take], weight[take]
        cuts = np.unique(np.r_[np.linspace(0.05, 0.95, 19), s])
        f1 = [2 * (w * y)[s >= c].sum() / max(w[s >= c].sum() + (w * y).sum(), 1e-9) for c in cuts]
        good = cuts[np.array(f1) >= max(f1) - 1e-9]
        return float(good[len(good) // 2])

    names = np.array([x if x is not None else "" for x in lang], object)
    m.threshold = best(np.ones(len(label), bool)) if label.any() else 0.5
    for x in set(names):
        take = names == x
        if times[take].sum() >= 30 and (times * label)[take].sum() >= 5:
            m.thresholds[x] = best(take)


def fit(docs: DataFrame, labels: DataFrame, learn_from=None) -> Model:
    """Learns from all labelled texts.

    ``learn_from`` is a condition on ``doc_id`` for rows that may be learned from.
    """
    common.small_batches(docs.sparkSession)
    known = labels.where("doc_id is not null and toxic in (0, 1)")
    known = known.where(learn_from) if learn_from is not None else known
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    lang = F.col("lang") if "lang" in docs.columns else F.lit(None).cast("string")
    h = F.xxhash64("doc_id")
    rows = common.written(
        docs.select("doc_id", "text", lang.alias("lang"))
        .join(broadcast_if_small(known), "doc_id")
        .select(h.alias("h"), F.coalesce("text", F.lit("")).alias("text"), "toxic",
                F.coalesce("lang", F.lit("")).alias("lang"),
                (F.pmod(F.shiftright(h, 7), F.lit(5)) == 0).alias("held")), "labelled")
    n = {(held, y): 0 for held in (False, True) for y in (0, 1)}
    n.update({(r["held"], r["toxic"]): r["count"]
              for r in rows.groupBy("held", "toxic").count().collect()})
    clean, toxic = (n[False, y] + n[True, y] for y in (0, 1))
    m = Model([np.zeros((BUCKETS, DIM), np.float32)] * HASHES,
              {w: np.zeros((w, HASHES * DIM, FILTERS), np.float32) for w in WIDTHS},
              np.zeros(FILTERS * len(WIDTHS), np.float32),
              np.zeros(FILTERS * len(WIDTHS), np.float32))
    if not clean or not toxic:
        m.out_bias = 30.0 * (2 * toxic / (clean + toxic) - 1) if clean + toxic else 0.0
        return m
    apart = min(n[True, 0], n[True, 1]) >= 5 and min(n[False, 0], n[False, 1]) > 0
    learned, check = (rows.where("not held"), rows.where("held")) if apart else (rows, rows)
    trained = n[False, 0] + n[False, 1] if apart else clean + toxic
    share = n[False, 1] / trained if apart else toxic / trained
    m = train_on(learned, -(-trained // GROUP), share)
    logits = F.round(_logit(docs.sparkSession, m)(F.col("text")) / STEP).cast("int").alias("z")
    found = check.select("lang", "toxic", logits).groupBy("lang", "toxic", "z").count().toArrow()
    found = found.sort_by([(c, "ascending") for c in ("lang", "z", "toxic")])
    calibrate(m, found.column("z").to_numpy() * STEP, found.column("toxic").to_numpy().astype(float),
              found.column("lang").to_pylist(), toxic / (clean + toxic),
              found.column("count").to_numpy().astype(float))
    return m


def _logit(spark: SparkSession, m: Model):
    sent = spark.sparkContext.broadcast(m)
    ready: list = []

    @F.arrow_udf("double")
    def run(texts: pa.Array) -> pa.Array:
        model = sent.value
        if not ready:
            ready.append(_projections(model))
        if not len(texts):
            return pa.array([], pa.float64())
        return pa.array(_logits(model, texts, ready[0]).astype(np.float64))

    return run


def score(docs: DataFrame, m: Model, text_col: str = "text", lang_col: str | None = None,
          out: str = "score", rejected: str = "rejected") -> DataFrame:
    """``docs`` with the score, and whether it reaches the threshold of the row's language."""
    common.small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(m)
    ready: list = []

    @F.arrow_udf("double")
    def run(texts: pa.Array) -> pa.Array:
        model = sent.value
        if not ready:
            ready.append(_projections(model))
        if not len(texts):
            return pa.array([], pa.float64())
        z = _logits(model, texts, ready[0])
        return pa.array(_sigmoid(model.scale * z + model.shift).astype(np.float64))

    scored = docs.withColumn(out, run(F.col(text_col)))
    limit = F.lit(m.threshold)
    if lang_col is not None:
        for name, t in m.thresholds.items():
            limit = F.when(F.col(lang_col) == name, F.lit(t)).otherwise(limit)
    return scored.withColumn(rejected, F.col(out) >= limit)
