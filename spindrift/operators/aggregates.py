"""Mergeable statistics, exact quantiles, nesting and Arrow aggregation."""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from spindrift.functions.numeric import dec
from spindrift.operators.joins import row_salt
from spindrift.operators.windows import chunked_window


def running_stats(df: DataFrame, keys: Sequence[str], value: str, ts: str, tie: str, scale: int = 2) -> DataFrame:
    """Statistics per key that can be combined exactly: count, sum, sum of squares, bounds, first, last."""
    v = dec(value, scale)
    return df.groupBy(*keys).agg(
        F.count(value).alias("n"),
        F.sum(v).cast("decimal(38,2)").alias("total"),
        F.sum(v * v).cast("decimal(38,4)").alias("total_sq"),
        F.min(value).alias("min_value"),
        F.max(value).alias("max_value"),
        F.min(ts).alias("first_seen"),
        F.max(F.struct(F.col(ts).alias("ts"), F.col(tie).alias("tie"), F.col(value).alias("value"))).alias("last"),
    )


def merge_stats(state: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Combine two sets of running statistics: the union is aggregated again, so order does not matter."""
    return state.unionByName(batch).groupBy(*keys).agg(
        F.sum("n").alias("n"),
        F.sum("total").cast("decimal(38,2)").alias("total"),
        F.sum("total_sq").cast("decimal(38,4)").alias("total_sq"),
        F.min("min_value").alias("min_value"),
        F.max("max_value").alias("max_value"),
        F.min("first_seen").alias("first_seen"),
        F.max("last").alias("last"),
    )


def read_stats(stats: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Mean and sample deviation of running statistics, with the plain columns beside them."""
    n, s = F.col("n").cast("double"), F.col("total").cast("double")
    spread = (F.col("n").cast("decimal(16,0)") * F.col("total_sq").cast("decimal(38,4)")).cast("double") - s * s
    return stats.select(
        *keys,
        "n",
        F.when(F.col("n") > 0, s / n).alias("mean_value"),
        F.when(F.col("n") > 1, F.sqrt(F.greatest(spread, F.lit(0.0)) / (n * (n - 1)))).alias("stddev_value"),
        "min_value",
        "max_value",
        "first_seen",
        F.col("last.ts").alias("last_seen"),
        F.col("last.value").alias("last_value"),
    )


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, probabilities: dict[str, float],
                    hot_rows: int | None = None) -> DataFrame:
    """Discrete quantiles without holding a group: count equal values, sum upwards (in ranges beyond ``hot_rows`` values of a key), pick.

    Each quantile is the smallest value whose cumulative share reaches the probability.
    """
    keys = list(keys)
    counted = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_copies"))
    sums = chunked_window(counted, keys, [value], hot_rows=hot_rows, sizes=df, running={"_upto": "_copies"})
    totals = counted.groupBy(*keys).agg(F.sum("_copies").alias("_all"))
    joined = sums.join(totals, keys)
    return joined.groupBy(*keys).agg(*[
        F.min(F.when(F.col("_upto") >= F.ceil(F.col("_all") * F.lit(p)), F.col(value))).alias(name)
        for name, p in probabilities.items()
    ])


def nest(df: DataFrame, keys: Sequence[str], fields: Sequence[str], order: str, span: int, name: str = "items") -> DataFrame:
    """Rows to sorted arrays of structs per key and ``part``.

    Parts are equal stretches of the whole number ``order``, ``span`` wide, whatever the size of the key. Where it is unique,
    no array holds more than ``span`` items. Rows without it make a part of their own, NULL.
    """
    part = F.floor(F.col(order) / F.lit(span)).cast("long")
    return df.withColumn("part", part).groupBy(*keys, "part").agg(
        F.sort_array(F.collect_list(F.struct(*fields))).alias(name)
    ).select(*keys, "part", name)


def pandas_aggregate(
    df: DataFrame,
    keys: Sequence[str],
    partial: Callable[[pd.DataFrame], pd.DataFrame],
    partial_schema: str,
    combine: Sequence[Column],
) -> DataFrame:
    """Aggregate with pandas code per Arrow batch, then combine the partial rows natively.

    ``partial`` maps the rows of one batch to rows holding the keys and partial
    values. No group is ever held whole in Python, whatever its size.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield partial(batch)

    return df.mapInPandas(run, partial_schema).groupBy(*keys).agg(*combine)


def share_of_total(df: DataFrame, value: str, keys: Sequence[str], name: str = "share") -> DataFrame:
    """Each row's part of the sum over its key. The sums are joined back, not windowed."""
    if not keys:
        whole = df.agg(F.sum(value)).scalar()
        return df.withColumn(name, F.col(value).cast("double") / F.nullif(whole.cast("double"), F.lit(0.0)))
    joined = df.join(df.groupBy(*keys).agg(F.sum(value).alias("_all")), list(keys))
    return joined.withColumn(name, F.col(value).cast("double") / F.nullif(F.col("_all").cast("double"), F.lit(0.0))).drop("_all")
