"""Held-out accuracy of the trained classifiers, their gradients and their awkward rows."""

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerloom.llm import language, queries, toxicity
from ledgerloom.llm.common import in_fold, read

SF = "/root/testdata/sf0.01"


def area(score, label):
    order = np.argsort(np.argsort(score))
    hot = label == 1
    n = hot.sum()
    return (order[hot].sum() - n * (n - 1) / 2) / (n * (len(label) - n))


def test_toxicity_holds_on_texts_not_learned_from(spark):
    sf = "/root/testdata/sf0.1"
    got = queries.op1_toxicity(spark, sf)
    rows = got.join(read(spark, sf, "labels"), "doc_id").where("held_out").toPandas()
    assert area(rows.score.to_numpy(), rows.toxic.to_numpy()) > 0.93
    assert ((rows.predicted == 1) == (rows.score >= 0.3)).all()
    assert got.count() == read(spark, sf, "documents").count()


def test_toxicity_pools_whole_texts():
    rng = np.random.default_rng(0)
    clean = [" ".join(f"w{k}" for k in rng.integers(0, 300, 80)) for _ in range(200)]
    texts = clean[:100] + [t + " vile person" for t in clean[100:]]
    label = np.r_[np.zeros(100), np.ones(100)]
    m = toxicity.train(pa.array(texts), label)
    tables = toxicity._projections(m)
    far = " ".join(["w1"] * 40_000) + " vile person " + " ".join(["w2"] * 40_000)
    z = toxicity._logits(m, pa.array([far, far.replace("vile person", "w3"), "", "vile person"]),
                         tables)
    assert z[0] > z[1] and z[3] > z[2]
    again = toxicity._logits(m, pa.array([far]), tables)
    assert abs(again[0] - z[0]) < 1e-4


def test_toxicity_learns_from_all_labelled_texts(spark):
    """Past the first thousands of ids by hash another word marks the toxic texts."""
    place = F.row_number().over(Window.orderBy("toxic", F.xxhash64("doc_id")))
    labels = spark.range(5000).select(F.col("id").alias("doc_id"), F.when(
        F.col("id") % 2 == 0, 1).otherwise(0).alias("toxic"))
    docs = labels.withColumn("place", place).select(
        "doc_id", F.concat(F.lit("some words "), F.col("doc_id") % 90, F.lit(" "), F.when(
            F.col("toxic") == 0, "fine").when(F.col("place") <= 4500, "vile").otherwise("nasty"))
        .alias("text"))
    m = toxicity.fit(docs, labels)
    texts = ["some words 3 nasty", "some words 3 vile", "some words 3 fine"]
    z = toxicity._logits(m, pa.array(texts), toxicity._projections(m))
    assert min(z[0], z[1]) > z[2] + 1


def test_workers_learn_as_one_and_counts_calibrate_as_rows(spark):
    rng = np.random.default_rng(3)
    made = [(int(h), " ".join(f"w{k}" for k in rng.integers(0, 50, 9)) + " vile" * int(h % 2),
             int(h % 2)) for h in rng.integers(-10**15, 10**15, 300)]
    rows = spark.createDataFrame(made, "h long, text string, toxic int")
    for workers in (1, 3):
        m = toxicity.train_on(rows, workers, 0.5)
        z = toxicity._logits(m, pa.array(["w1 w2 vile", "w1 w2"]), toxicity._projections(m))
        assert z[0] > z[1] + 1
    value, square = toxicity._as_rows(*toxicity._start(rng, np.zeros(
        (toxicity.HASHES, 2, toxicity.BUCKETS)), 0.5))
    again = toxicity._as_rows(*toxicity._from_rows(value, square))
    assert (again[0] == value).all() and (again[1] == square).all()
    label, logits = np.array([0.0, 0, 1, 1, 1]), np.array([-1.0, 2, 1, 1, 3])
    few, many = (toxicity.Model([]) for _ in range(2))
    times = np.array([10.0, 10, 10, 10, 10])
    toxicity.calibrate(few, logits, label, ["x"] * 5, 0.4, times)
    toxicity.calibrate(many, np.repeat(logits, 10), np.repeat(label, 10), ["x"] * 50, 0.4)
    assert np.isclose([few.scale, few.shift], [many.scale, many.shift]).all()
    assert few.thresholds == many.thresholds and few.threshold == many.threshold


def test_language_holds_on_texts_not_learned_from(spark):
    rows = (queries.op2_language(spark, SF).join(
        read(spark, SF, "documents").select("doc_id", "lang"), "doc_id").where("held_out").toPandas())
    assert (rows.lang == rows.lang_pred).mean() > 0.97
    assert rows.score.between(0, 1).all()


def test_every_language_is_learned(spark, monkeypatch):
    names = [f"l{k:03d}" for k in range(70)]
    docs = spark.createDataFrame([(k, f"text of number {chr(97 + k % 26)} " * 9, names[k % 70])
                                  for k in range(140)], "doc_id long, text string, lang string")
    whole, seen = language.train, []

    def short(codes, label, languages):
        seen.extend(label)
        return whole(codes, label, languages, steps=2)
    monkeypatch.setattr(language, "train", short)
    m = language.fit(docs)
    assert m.languages == names and set(seen) == set(range(70)) and m.b_out.shape == (70,)
    # a step with fewer windows than languages reaches all of them in turn
    rng = np.random.default_rng(0)
    few = whole(rng.integers(0, 20, (70, language.WINDOW)), np.arange(70), names, steps=7, batch=10)
    assert np.isfinite(few.w_out).all()
    assert language.Runner(few).documents([b"some text"])[0].shape == (70,)


def test_gradients_through_time(monkeypatch):
    monkeypatch.setattr(language, "WINDOW", 6)
    rng = np.random.default_rng(1)
    codes = rng.integers(0, 20, (4, 6))
    w_in = rng.normal(0, 0.5, (language.SYMBOLS, 3 * language.HIDDEN))
    w_state = rng.normal(0, 0.5, (language.HIDDEN, 3 * language.HIDDEN))
    pull = rng.normal(size=(6, 4, language.HIDDEN))
    monkeypatch.setattr(np, "float32", np.float64)

    def loss():
        return float((language._run(codes, w_in, w_state, []) * pull).sum())
    kept = []
    language._run(codes, w_in, w_state, kept)
    g_in, g_state = language._back(codes, w_state, kept, pull)
    for value, grad, at in ((w_state, g_state, (2, 5)), (w_state, g_state, (1, 20)),
                            (w_in, g_in, (codes[0, 0], 3)), (w_in, g_in, (codes[2, 5], 18))):
        before = value[at]
        value[at] = before + 1e-5
        up = loss()
        value[at] = before - 1e-5
        down = loss()
        value[at] = before
        assert abs((up - down) / 2e-5 - grad[at]) < 1e-4


def test_positions_are_labelled_and_windows_agree(spark):
    m = language.fit(read(spark, SF, "documents"), ~in_fold(), 60)
    text = "der die das und nicht " * 40
    runs = language.spans(text, m)
    assert sum(n for _, n in runs) == len(language.codes_of(text.encode()))
    p = language.Runner(m).documents([text.encode(), b"", b"x"])
    assert abs(p[0].sum() - 1) < 1e-5 and p[1].sum() == 0


def test_awkward_rows(spark, hard, nothing):
    labels = spark.createDataFrame([(1, 0, 1), (6, 1, 0), (6, 1, 0), (None, 1, 1), (9, None, None)],
                                   "doc_id long, quality int, toxic int")
    m = toxicity.fit(hard, labels)
    rows = toxicity.score(hard, m, lang_col="lang").collect()
    assert len(rows) == 12 and all(0 <= r.score <= 1 for r in rows)
    none = toxicity.fit(nothing, labels.limit(0))
    assert [r.score for r in toxicity.score(hard.limit(2), none).collect()] == [0.5, 0.5]
    assert toxicity.score(nothing, m).count() == 0
    lm = language.fit(hard)
    rows = {(r.doc_id, r.text): r for r in language.predict(hard, lm).collect()}
    for key in ((2, None), (3, ""), (4, " \t\n"), (7, "%%% 123 !!!")):
        assert rows[key].lang_pred == "und" and rows[key].score == 0
    assert rows[(9, "one")].lang_pred in ("de", "en", "fr")
    assert language.fit(nothing) is None
    assert {r.lang_pred for r in language.predict(hard, None).collect()} == {"und"}
    assert language.predict(nothing, lm).count() == 0
