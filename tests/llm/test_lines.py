"""Templates of the line tree, and what is dropped where."""

import random

import pyarrow as pa
from pyspark.sql import functions as F

from ledgerloom.llm import jaccard, lines

WIDE = "one two three four five six seven eight nine ten eleven twelve"


def keys(text):
    line, key, _ = lines.line_keys(pa.array([text]))
    return set(key.tolist())


def test_variable_fields_share_a_template():
    assert keys("user 17 came from 10.0.0.1 today") == keys("user 9x came from 8.8.8.8 today")
    assert keys("mail a@b.c to them now") == keys("mail x@y.z to them now")
    assert keys("see http://a.b/c now and then") == keys("see ftp://q/zz now and then")
    assert not keys("user came from there today") & keys("user went from there today")
    assert not keys("a b c d")
    assert keys(WIDE) & keys(WIDE.replace("twelve", "dozen"))
    assert not keys(WIDE) & keys(WIDE.replace("three", "3rd"))       # a leading word
    assert not keys(WIDE) & keys(WIDE.replace("four", "x").replace("twelve", "y"))
    assert not keys(WIDE) & keys(WIDE + " more")


def dropped(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return {(r.doc_id, r.text, r.n_lines, r.n_dropped) for r in lines.dedupe_lines(docs).collect()}


def test_recurring_lines_stay_in_the_first_document_only(spark):
    short = "all of these rights are reserved here"
    passage = " ".join(f"p{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(60))
    got = dropped(spark, [(1, f"a\n{short}\nb"), (2, f"{short}\nc"), (3, f"{short}\n{short}\nd"),
                          (4, f"x\n{passage}"), (5, f"{passage}\ny"), (6, "twice only here ok so"),
                          (7, "twice only here ok so")])
    assert got == {(1, f"a\n{short}\nb", 3, 0), (2, "c", 2, 1), (3, "d", 3, 2),
                   (4, f"x\n{passage}", 2, 0), (5, "y", 2, 1), (6, "twice only here ok so", 1, 0),
                   (7, "twice only here ok so", 1, 0)}


def prose(rng, sizes):
    return "\n".join(" ".join(f"{rng.choice('bcdfg')}{rng.choice('aeiou')}{rng.randrange(16**5):x}"
                              .translate(DIGITS) for _ in range(n)) for n in sizes)


DIGITS = str.maketrans("0123456789", "ghijklmnop")
SIZES = [3, 8, 60, 20, 6, 55, 14, 30]


def test_copies_of_mixed_line_lengths_stay_whole_and_leave_one(spark):
    rng = random.Random(5)
    pair, three, near, own = (prose(rng, SIZES) for _ in range(4))
    edited = near.replace(near.split("\n")[4], "some other six words stand here")
    notice = "a notice of eight words stands right here"
    rows = [(1, pair), (2, three), (3, near), (4, own + "\n" + notice), (11, pair), (12, three),
            (13, edited), (22, three), (24, notice + "\n" + prose(rng, SIZES))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    done = lines.dedupe_lines(docs)
    got = {r.doc_id: r.text for r in done.collect()}
    assert {k: t for k, t in rows if got[k] != t}.keys() == {24}
    assert got[24] == rows[-1][1].split("\n", 1)[1]
    groups = {r.doc_id: r.component_id for r in jaccard.jaccard_groups(done).collect()}
    assert {k: groups.get(k, k) for k, _ in rows} == {1: 1, 11: 1, 2: 2, 12: 2, 22: 2, 3: 3, 13: 3,
                                                      4: 4, 24: 24}


def test_two_wide_lines_do_not_make_a_field(spark):
    rng = random.Random(6)
    wide = prose(rng, [60])
    other = wide.rsplit(" ", 10)[0] + " " + prose(rng, [10])
    assert dropped(spark, [(1, wide), (2, other)]) == {(1, wide, 1, 0), (2, other, 1, 0)}


def test_a_line_repeated_in_one_document_stays(spark):
    text = "\n".join(["the same old line again and again"] * 5)
    assert dropped(spark, [(1, text), (2, "other")]) == {(1, text, 5, 0), (2, "other", 1, 0)}


def test_awkward_rows(hard, nothing):
    rows = lines.dedupe_lines(hard).collect()
    assert len(rows) == 12 and rows[0].asDict().keys() >= {"key", "pos", "doc", "node"}
    assert {(r.text, r.n_lines) for r in rows if r.doc_id in (2, 3)} == {(None, 0), ("", 0)}
    assert lines.dedupe_lines(nothing).count() == 0


def test_all_columns_keep_their_order(hard):
    out = lines.dedupe_lines(hard.withColumn("n_lines", F.lit("old")))
    assert out.columns == [*hard.columns, "n_lines", "n_dropped"]
