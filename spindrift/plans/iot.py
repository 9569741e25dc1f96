"""Sensor jobs: range-based anomaly marks, correlated anomalies, rolling summaries, shifts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from spindrift.functions.numeric import exact_avg
from spindrift.operators.joins import latest_before
from spindrift.session import broadcast_few_rows


def ranges_by_type(readings: DataFrame, type_col: str, value: str) -> DataFrame:
    """Reference range per sensor type: 0 to twice the mean."""
    return readings.groupBy(type_col).agg(exact_avg(value).alias("_mean")).select(
        type_col, F.lit(0.0).alias("normal_min"), (F.col("_mean") * 2.0).alias("normal_max"))


def with_ranges(readings: DataFrame, history: DataFrame, type_col: str, value: str) -> DataFrame:
    """Readings (batch or stream) beside the normal range of their type, taken from ``history``."""
    return readings.join(broadcast_few_rows(ranges_by_type(history, type_col, value)), type_col)


def mark_anomalies(readings: DataFrame, value: str, sensor: str, kind: str) -> DataFrame:
    """Distance from the middle of the normal range in sixths of the range, with severity and message.

    Columns normal_min and normal_max must be present. Works on streams.
    """
    span = F.col("normal_max") - F.col("normal_min")
    marked = readings.withColumns({
        "baseline_mean": (F.col("normal_min") + F.col("normal_max")) / 2.0,
        "baseline_std": F.when(span > 0, span / 6.0).otherwise(F.lit(1.0)),
    }).withColumn("deviation", F.col(value) - F.col("baseline_mean")).withColumn(
        "deviation_sigma", F.round(F.abs("deviation") / F.col("baseline_std"), 2)
    ).withColumn("is_anomaly", F.abs("deviation") > F.col("baseline_std") * 3.0)
    severity = F.when(F.col("deviation_sigma") > 5, "CRITICAL").when(F.col("deviation_sigma") > 4, "HIGH").when(
        F.col("deviation_sigma") > 3, "MEDIUM").otherwise("LOW")
    message = F.concat(F.lit("["), F.col("severity"), F.lit("] "), F.col(kind), F.lit(" anomaly on "),
                       F.col(sensor).cast("string"))
    return marked.withColumn("severity", severity).withColumn("alert_message", message)


def correlated(readings: DataFrame, site: str, ts: str, row_id: str, first: str, second: str, seconds: int = 180) -> DataFrame:
    """Each anomaly of the second kind with the latest of the first kind at its site within ``seconds`` before."""
    cols = [site, ts, row_id]
    a = readings.filter(first).select(*cols)
    b = readings.filter(second).select(*cols)
    return latest_before(a, b, site, ts, ts, seconds, [ts, row_id], row_id)


def recent_summary(readings: DataFrame, ts: str, kind: str, value: str, now: str, minutes: int) -> DataFrame:
    """Readings per type in the last ``minutes`` before a given now."""
    end = F.lit(now).cast("timestamp_ntz")
    return readings.filter((F.col(ts) >= end - F.expr(f"INTERVAL {minutes} MINUTES")) & (F.col(ts) <= end)).groupBy(kind).agg(
        F.count(F.lit(1)).alias("readings"), exact_avg(value).alias("avg_value"),
        F.min(value).alias("min_value"), F.max(value).alias("max_value"))


def severity_summary(alerts: DataFrame, sensor: str) -> DataFrame:
    return alerts.groupBy("severity").agg(
        F.count(F.lit(1)).alias("alert_count"),
        (F.sum(F.col("deviation_sigma").cast("decimal(18,2)")).cast("double") / F.count(F.lit(1))).alias("avg_sigma"),
        F.count_distinct(sensor).alias("affected_sensors"))


def shifts(windows: DataFrame, keys: list[str], start: str, mean: str, sd: str, k: float = 1.5) -> DataFrame:
    """Windows whose mean moved by more than ``k`` deviations from the window before.

    ``windows`` holds one row per key and time window, so a key has as many rows as the
    calendar has windows.
    """
    w = Window.partitionBy(*keys).orderBy(start)
    moved = windows.withColumn("previous_mean", F.lag(mean).over(w))
    return moved.withColumn("delta", F.col(mean) - F.col("previous_mean")).filter(F.abs("delta") > F.col(sd) * k)
