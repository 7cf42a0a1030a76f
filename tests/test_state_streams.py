"""The gap and cooldown streams against plain loops, on arrivals in any order."""

import random

import numpy as np
import pytest

from ledgerloom.streaming.cooldown import fold_alerts, start_alerts
from ledgerloom.streaming.gaps import merge_intervals, start_sequence_gaps
from tests.conftest import rows
from tests.test_operators import checks_frame, random_checks, simulate_alerts


def plain_gaps(numbers):
    numbers = sorted(set(numbers))
    return sorted([(a + 1, b, b - a - 1) for a, b in zip(numbers, numbers[1:]) if b > a + 1],
                  key=lambda r: tuple(map(str, r)))


def feed(spark, folder, portions, width):
    src, out, cp = folder("src"), folder("out"), folder("cp")
    seen = []
    for numbers in portions:
        spark.createDataFrame([(n,) for n in numbers], "seq bigint").coalesce(1).write.mode(
            "append").parquet(src)
        stream = spark.readStream.schema("seq bigint").parquet(src)
        start_sequence_gaps(spark, stream, out, cp, available_now=True, width=width
                            ).awaitTermination()
        seen += numbers
        if plain_gaps(seen):
            got = spark.read.schema("expected bigint, seq bigint, missed bigint, batch bigint"
                                    ).parquet(out).drop("batch")
            assert rows(got) == plain_gaps(seen)


def test_late_numbers_close_their_gaps(spark, folder):
    feed(spark, folder, [[1, 2, 3, 4, 10], [5, 6], [11, 12]], 1 << 16)


def test_numbers_in_any_order_over_many_bands(spark, folder):
    rng = random.Random(1)
    numbers = [n for n in range(60) if rng.random() < 0.7]
    rng.shuffle(numbers)
    feed(spark, folder, [numbers[:12], numbers[12:25] + numbers[3:6], numbers[25:]], 8)


def test_a_gap_over_empty_bands_closes(spark, folder):
    feed(spark, folder, [[3, 45], list(range(4, 45)), [44, 60]], 8)


@pytest.mark.parametrize("lo, hi, want", [
    ([], [], []), ([5], [5], [(5, 5)]), ([1, 2, 4], [1, 2, 4], [(1, 2), (4, 4)]),
    ([1, 3, 2], [10, 4, 2], [(1, 10)]), ([7, 1, 4], [9, 3, 6], [(1, 9)]),
])
def test_intervals(lo, hi, want):
    found = merge_intervals(np.array(lo, np.int64), np.array(hi, np.int64))
    assert list(zip(*(x.tolist() for x in found))) == want


def test_runs_split_over_batches_and_late_checks(spark, folder):
    checks = random_checks(4, 250)
    order = list(checks)
    random.Random(2).shuffle(order)
    src, out, cp = folder("src"), folder("out"), folder("cp")
    for k in range(3):
        checks_frame(spark, order[k::3]).write.mode("append").parquet(src)
        stream = spark.readStream.schema("service int, status string, ts timestamp_ntz").parquet(src)
        start_alerts(spark, stream, out, cp, available_now=True, lateness="10 days"
                     ).awaitTermination()
        so_far = [c for j in range(k + 1) for c in order[j::3]]
        got = spark.read.schema("service int, run bigint").parquet(out)
        assert sorted(rows(got, "service", "run")) == simulate_alerts(so_far)


def test_settled_runs_leave_the_state_and_stay_in_the_result(spark, folder):
    checks = random_checks(7, 250)
    src, out, cp = folder("src"), folder("out"), folder("cp")
    edges = (0, 1000, 1530, 2200, 4000, 10 ** 9)
    for lo, hi in zip(edges, edges[1:]):
        part = [c for c in checks if lo <= c[1] < hi]
        if not part:
            continue
        checks_frame(spark, part).write.mode("append").parquet(src)
        stream = spark.readStream.schema("service int, status string, ts timestamp_ntz").parquet(src)
        start_alerts(spark, stream, out, cp, available_now=True, lateness="5 minutes"
                     ).awaitTermination()
    got = spark.read.schema("service int, run bigint").parquet(out)
    assert sorted(rows(got, "service", "run")) == simulate_alerts(checks)


def test_alerts_of_runs():
    runs, failed = np.array([1, 2, 3, 9, 10, 20]), np.array([1, 1, 1, 0, 1, 1], bool)
    assert fold_alerts(runs, failed, None, 2) == ([1, 3, 10, 20], 20)
    assert fold_alerts(runs[:3], failed[:3], 0, 2) == ([2], 2)
    assert fold_alerts(runs[:0], failed[:0], 5, 2) == ([], 5)
