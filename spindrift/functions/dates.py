"""Date predicates and dimensions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def date_range_predicate(col: str | Column, grain: str, value: str) -> Column:
    """``col`` within one year ("1996"), month ("1996-03") or day ("1996-03-05") as a half-open range.

    Unlike ``year(col) = 1996`` the range reaches the scan and skips row groups.
    """
    c = F.col(col) if isinstance(col, str) else col
    parts = [int(p) for p in value.split("-")]
    if grain == "year" and len(parts) == 1:
        lo, hi = dt.date(parts[0], 1, 1), dt.date(parts[0] + 1, 1, 1)
    elif grain == "month" and len(parts) == 2:
        y, m = parts
        lo, hi = dt.date(y, m, 1), dt.date(y + m // 12, m % 12 + 1, 1)
    elif grain == "day" and len(parts) == 3:
        lo = dt.date(*parts)
        hi = lo + dt.timedelta(days=1)
    else:
        raise ValueError(f"{grain} {value}")
    as_ts = [F.lit(d.isoformat()).cast("timestamp_ntz") for d in (lo, hi)]
    return (c >= as_ts[0]) & (c < as_ts[1])


def date_columns(day: Column) -> list[Column]:
    return [
        day.cast("string").alias("date"),
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day_of_month"),
        F.trunc(day, "month").cast("string").alias("month_start"),
        (F.dayofweek(day).isin(1, 7)).alias("is_weekend"),
    ]


def date_dim(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row per day of a fixed calendar span."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("d"))
    return days.select(*date_columns(F.col("d")))


def date_dim_of(df: DataFrame, ts: str) -> DataFrame:
    """One row per day from the first to the last day found in a column."""
    span = df.agg(F.min(F.to_date(ts)).alias("lo"), F.max(F.to_date(ts)).alias("hi"))
    days = span.select(F.explode(F.sequence("lo", "hi")).alias("d"))
    return days.select(*date_columns(F.col("d")))
