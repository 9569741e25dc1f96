"""Dedup, aligned unions and order-free comparison of row sets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def dedup_latest(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per key: the greatest by ``order_by``, remaining ties by the whole row.

    An aggregate, not a window: each map task keeps one candidate per key, so the
    copies of a hot key never travel.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    tie = [c for c in rest if c not in order_by]
    position = F.struct(*[F.col(c) for c in (*order_by, *tie)])
    best = df.groupBy(*keys).agg(F.max(position).alias("_best"))
    return best.select(*[F.col(c) if c in keys else F.col(f"_best.{c}").alias(c) for c in df.columns])


def latest_per_key(df: DataFrame, keys: Sequence[str], ts: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Value columns of the latest row per key."""
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*values), F.struct(*ts)).alias("_v"))
    return picked.select(*keys, *[F.col(f"_v.{v}").alias(v) for v in values])


def align_union(frames: Sequence[DataFrame], columns: Mapping[str, str]) -> DataFrame:
    """Union of frames brought to one schema: missing columns become NULL, all are cast, others dropped."""
    shaped = []
    for df in frames:
        have = set(df.columns)
        shaped.append(df.select(*[
            (F.col(c) if c in have else F.lit(None)).cast(t).alias(c) for c, t in columns.items()
        ]))
    out = shaped[0]
    for df in shaped[1:]:
        out = out.unionByName(df)
    return out


def diff_rows(a: DataFrame, b: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows whose number of copies differs, with both numbers. One shuffle, map-side combined."""
    tagged = a.select(*columns, F.lit(1).alias("_a"), F.lit(0).alias("_b")).unionByName(
        b.select(*columns, F.lit(0).alias("_a"), F.lit(1).alias("_b"))
    )
    counts = tagged.groupBy(*columns).agg(F.sum("_a").alias("in_a"), F.sum("_b").alias("in_b"))
    return counts.filter(F.col("in_a") != F.col("in_b"))


def same_rows(a: DataFrame, b: DataFrame) -> Column | bool:
    """True when both frames hold the same rows the same number of times."""
    return diff_rows(a, b, a.columns).isEmpty()
