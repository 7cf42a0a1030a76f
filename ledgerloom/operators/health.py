"""Service health checks: roll-ups and alerts with a cooldown."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

COOLDOWN_SECONDS = 86_400
CHECK_SECONDS = 60


def status_counts(checks: DataFrame) -> DataFrame:
    return checks.groupBy("service", "status").agg(F.count("*").alias("checks"))


def check_runs(checks: DataFrame, every: int = CHECK_SECONDS) -> DataFrame:
    """One status per service and check run; a run failed if any of its checks did.

    Runs are numbered by wall clock, one per ``every`` seconds, so a service has
    at most that many rows however many checks arrive.
    """
    second = F.timestamp_diff("SECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), F.col("ts"))
    run = F.floor(second / every)
    return checks.groupBy("service", run.alias("run")).agg(
        F.bool_or(F.col("status") != "ok").alias("failed"))


def run_status(checks: DataFrame, every: int = CHECK_SECONDS) -> DataFrame:
    """How often a run came out OK or FAIL(n), n being the failing services."""
    per_run = check_runs(checks, every).groupBy("run").agg(
        F.count_if(F.col("failed")).alias("n"))
    label = F.when(F.col("n") == 0, "OK").otherwise(F.concat(F.lit("FAIL("), F.col("n"), F.lit(")")))
    return per_run.groupBy(label.alias("run_status")).agg(F.count("*").alias("runs"))


def failure_streaks(runs: DataFrame) -> DataFrame:
    """Failing runs with the number of the streak they belong to; an ok run ends a streak."""
    upto = (Window.partitionBy("service").orderBy("run")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    streak = F.count_if(~F.col("failed")).over(upto)
    return (runs.withColumn("streak", streak).where(F.col("failed"))
            .select("service", "streak", "run"))


def alerts(checks: DataFrame, every: int = CHECK_SECONDS,
           cooldown: int = COOLDOWN_SECONDS) -> DataFrame:
    """(service, run): the first failure of a streak, then one per cooldown while it lasts."""
    none = checks.select("service", F.lit(None).cast("bigint").alias("last_alert")).limit(0)
    return alerts_from_runs(check_runs(checks, every), none, every, cooldown)


def alerts_from_runs(runs: DataFrame, last_alerts: DataFrame, every: int = CHECK_SECONDS,
                     cooldown: int = COOLDOWN_SECONDS) -> DataFrame:
    """As ``alerts``, continuing from the last unforgotten alert of each service.

    A success forgets the last alert, so streaks are independent of each other
    and each is folded on its own; only a service's first streak, the one no
    success precedes, goes on from before.
    """
    gap = F.lit(-(-cooldown // every)).cast("bigint")
    streaks = failure_streaks(runs).groupBy("service", "streak").agg(
        F.array_sort(F.collect_list("run")).alias("runs"))
    seeded = streaks.join(last_alerts, "service", "left").withColumn(
        "seed", F.when((F.col("streak") == 0) & F.col("last_alert").isNotNull(),
                       F.array("last_alert")).otherwise(F.array().cast("array<bigint>")))

    def fold(out: Column, run: Column) -> Column:
        due = (F.size(out) == 0) | (run - F.try_element_at(out, F.lit(-1)) >= gap)
        return F.when(due, F.concat(out, F.array(run))).otherwise(out)

    sent = F.aggregate("runs", F.col("seed"), fold)
    fresh = F.slice(sent, F.size("seed") + 1, F.greatest(F.size(sent), F.lit(1)))
    return seeded.select("service", F.explode(fresh).alias("run"))
