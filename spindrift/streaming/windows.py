"""Event-time windows, stream joins and streaming anomaly marks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from spindrift.functions.numeric import exact_sum
from spindrift.session import new_dir


def windowed(df: DataFrame, ts: str, keys: Sequence[str], value: str, duration: str, slide: str | None = None) -> DataFrame:
    """Count, sum, mean and bounds per key and tumbling (or, with ``slide``, sliding) window.

    Partial sums are built before the shuffle, so a hot key sends one row per task and window.
    """
    win = F.window(ts, duration, slide) if slide else F.window(ts, duration)
    return df.groupBy(win.alias("w"), *keys).agg(
        F.count(F.lit(1)).alias("n"),
        exact_sum(value).alias("total"),
        F.min(value).alias("min_value"),
        F.max(value).alias("max_value"),
    ).select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys,
             "n", "total", (F.col("total") / F.col("n")).alias("mean_value"), "min_value", "max_value")


def time_bounded_join(left: DataFrame, right: DataFrame, on: Column, left_ts: str, right_ts: str, within: str,
                      how: str = "inner") -> DataFrame:
    """Stream-stream join with left_ts <= right_ts <= left_ts + within.

    Both sides need a watermark; together with the bound it lets Spark drop old state.
    """
    bound = (F.col(right_ts) >= F.col(left_ts)) & (F.col(right_ts) <= F.col(left_ts) + F.expr(f"INTERVAL {within}"))
    return left.join(right, on & bound, how)


def time_slices(sides: Sequence[tuple[DataFrame, str]], n: int, label: str) -> list[list[DataFrame]]:
    """The rows of several frames as ``n`` slices of time, cut at the same times for all: slice by slice, a frame for each side.

    Fed to a stream join one after another, the watermark passes along and old state is dropped, so the state holds a slice and the join's bound, not
    the whole input; a later slice holds no row older than the watermark. Rows without time are in the first slice. Each side is written once.
    """
    at = [F.col(ts).cast("timestamp").cast("double") for _, ts in sides]
    times = sides[0][0].select(at[0].alias("at"))
    for (df, _), t in zip(sides[1:], at[1:]):
        times = times.unionByName(df.select(t.alias("at")))
    cuts = times.approxQuantile("at", [i / n for i in range(1, n)], 0.2 / n) if n > 1 else []
    staged = []
    for (df, ts), t in zip(sides, at):
        path = new_dir(df.sparkSession, label)
        number = sum((F.coalesce((t >= F.lit(c)).cast("int"), F.lit(0)) for c in cuts), F.lit(0))
        df.withColumn("_slice", number).write.partitionBy("_slice").parquet(path)
        staged.append(df.sparkSession.read.schema(StructType([*df.schema, StructField("_slice", IntegerType())])).parquet(path))
    return [[s.filter(F.col("_slice") == i).drop("_slice") for s in staged] for i in range(n)]
