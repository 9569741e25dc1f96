"""Operational reports: runs, cost shares, access logs, layer health, partner extracts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from spindrift.functions.numeric import dec, exact_sum
from spindrift.operators.aggregates import share_of_total


def run_metrics(runs: DataFrame, task: str, failed: Column, duration: str, alert_rate: float) -> DataFrame:
    """Runs, success rate and duration per task, with an alert above a failure rate."""
    bad = F.count(F.when(failed, 1))
    n = F.count(F.lit(1))
    return runs.groupBy(task).agg(
        n.alias("runs"), bad.alias("failures"),
        ((n - bad) * 100.0 / n).cast("double").alias("success_pct"),
        (exact_sum(duration) / n).alias("avg_duration"), F.max(duration).alias("max_duration"),
        (bad.cast("double") / n > alert_rate).alias("alert"),
    )


def cost_share(usage: DataFrame, by: Sequence[str], amount: str, within: Sequence[str] = ()) -> DataFrame:
    """Cost per group and its share of the total (of ``within``)."""
    cost = usage.groupBy(*by).agg(F.sum(dec(amount)).alias("_cost"))
    shared = share_of_total(cost, "_cost", list(within), "share")
    return shared.select(*by, F.col("_cost").cast("double").alias("cost"), (F.col("share") * 100.0).alias("share_pct"))


def access_summary(log: DataFrame, who: str, action: str, ts: str, denied: str, off_hours: tuple[int, int] = (8, 18)) -> DataFrame:
    """Per principal: accesses, denied ones, off-hours ones, last access."""
    hour = F.hour(ts)
    return log.groupBy(who).agg(
        F.count(F.lit(1)).alias("accesses"),
        F.count(F.when(F.col(action) == denied, 1)).alias("denied"),
        F.count(F.when((hour < off_hours[0]) | (hour >= off_hours[1]), 1)).alias("off_hours"),
        F.max(ts).cast("string").alias("last_access"),
        F.count_distinct(action).alias("actions"),
    )


def stale_objects(log: DataFrame, obj: str, ts: str, now: str, days: int) -> DataFrame:
    """Objects not accessed for ``days`` before a given now."""
    last = log.groupBy(obj).agg(F.max(ts).alias("_last"))
    return last.filter(F.col("_last") < F.lit(now).cast("timestamp_ntz") - F.expr(f"INTERVAL {days} DAYS")).select(
        obj, F.col("_last").cast("string").alias("last_access"))


def share_extract(df: DataFrame, where: str, keys: Sequence[str], amount: str) -> DataFrame:
    """Filtered, aggregated and formatted copy for a partner."""
    return df.filter(where).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("row_count"), F.sum(dec(amount)).alias("_sum"),
    ).select(
        *keys, "row_count", F.format_number(F.col("_sum").cast("decimal(28,2)"), 2).alias("amount_text"))
