"""Reproducible derived columns: categories, hash picks and skewed keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def category(id_col: str | Column, values: Sequence[str]) -> Column:
    """Value number ``id % n``."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.pmod(c, F.lit(len(values))) + 1).cast("int"))


def hash_pick(id_col: str | Column, values: Sequence[str], seed: int = 0) -> Column:
    """A value picked by a hash of the id: scattered, and the same in every run."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return category(F.xxhash64(c, F.lit(seed)), values)


def synthetic(spark: SparkSession, n: int, columns: Mapping[str, Column]) -> DataFrame:
    """``n`` rows with an ``id`` and the given columns over it."""
    return spark.range(n).select("id", *[c.alias(name) for name, c in columns.items()])


def skewed_key(position: Column, shares: Sequence[tuple[str, int]], tail: Column) -> Column:
    """A key of which ``shares`` (key, percent) take fixed parts of the rows; ``position`` is uniform in 0..99."""
    out, upto = tail, 0
    bounds = []
    for key, percent in shares:
        bounds.append((upto, upto + percent, key))
        upto += percent
    for lo, hi, key in reversed(bounds):
        out = F.when((position >= lo) & (position < hi), F.lit(key)).otherwise(out)
    return out
