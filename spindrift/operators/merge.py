"""MERGE, UPDATE and DELETE as DataFrame x DataFrame -> DataFrame."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F


class AmbiguousMerge(ValueError):
    """More than one source row matches one target row."""


@dataclass(frozen=True)
class WhenMatched:
    """UPDATE (``set`` maps columns to expressions, "*" takes every source column) or DELETE (``set`` is None).

    Expressions may name ``target.x`` and ``source.x``.
    """

    set: Mapping[str, str] | str | None
    when: str | None = None


@dataclass(frozen=True)
class WhenNotMatched:
    """INSERT: ``values`` maps columns to expressions, "*" takes the source columns; others become NULL."""

    values: Mapping[str, str] | str = "*"
    when: str | None = None


def update_all(*, when: str | None = None) -> WhenMatched:
    return WhenMatched("*", when)


def delete(*, when: str | None = None) -> WhenMatched:
    return WhenMatched(None, when)


def insert_all(*, when: str | None = None) -> WhenNotMatched:
    return WhenNotMatched("*", when)


def _holds(condition: str | None) -> Column:
    return F.coalesce(F.expr(condition), F.lit(False)) if condition else F.lit(True)


def merge(
    target: DataFrame,
    source: DataFrame,
    on: Sequence[str],
    clauses: Sequence[WhenMatched | WhenNotMatched],
    target_pred: str | None = None,
    check_source: bool = True,
) -> DataFrame:
    """The target after the merge. Clauses apply in order and the first that holds wins.

    Two joins rather than one full outer join: a left join can be split on a hot
    target key and an anti join moves only keys. ``target_pred`` limits the merge to
    matching target rows; the others pass through without a shuffle. The source check
    runs one aggregate job and raises ``AmbiguousMerge``.
    """
    on = list(on)
    matched = [c for c in clauses if isinstance(c, WhenMatched)]
    unmatched = [c for c in clauses if isinstance(c, WhenNotMatched)]
    untouched = None
    if target_pred:
        scope = _holds(target_pred)
        untouched, target = target.filter(~scope), target.filter(scope)
    if check_source and matched:
        doubled = source.groupBy(*on).agg(F.count(F.lit(1)).alias("_copies")).filter("_copies > 1")
        if not doubled.join(target.select(*on), on, "left_semi").isEmpty():
            raise AmbiguousMerge(f"several source rows for one target row, keys {on}")

    t = target.alias("target")
    s = source.withColumn("_hit", F.lit(True)).alias("source")
    match = _match(on)
    columns = target.columns
    parts = []
    if matched:
        joined = t.join(s, match, "left")
        hit = F.coalesce(F.col("source._hit"), F.lit(False))
        action = F.lit(-1)
        for i, c in reversed(list(enumerate(matched))):
            action = F.when(hit & _holds(c.when), F.lit(i)).otherwise(action)
        joined = joined.withColumn("_action", action)
        deletes = [i for i, c in enumerate(matched) if c.set is None]
        if deletes:
            joined = joined.filter(~F.col("_action").isin(deletes))
        out = []
        for name in columns:
            value = F.col(f"target.{name}")
            for i, c in reversed(list(enumerate(matched))):
                if c.set == "*" and name in source.columns:
                    value = F.when(F.col("_action") == i, F.col(f"source.{name}")).otherwise(value)
                elif isinstance(c.set, Mapping) and name in c.set:
                    value = F.when(F.col("_action") == i, F.expr(c.set[name])).otherwise(value)
            out.append(value.cast(target.schema[name].dataType).alias(name))
        parts.append(joined.select(*out))
    else:
        parts.append(target)

    if unmatched:
        fresh = s.join(target.select(*on).alias("target"), match, "left_anti")
        taken = F.lit(-1)
        for i, c in reversed(list(enumerate(unmatched))):
            taken = F.when(_holds(c.when), F.lit(i)).otherwise(taken)
        fresh = fresh.withColumn("_action", taken).filter(F.col("_action") >= 0)
        out = []
        for name in columns:
            value = F.lit(None)
            for i, c in reversed(list(enumerate(unmatched))):
                if c.values == "*":
                    given = F.col(f"source.{name}") if name in source.columns else F.lit(None)
                else:
                    given = F.expr(c.values[name]) if name in c.values else F.lit(None)
                value = F.when(F.col("_action") == i, given).otherwise(value)
            out.append(value.cast(target.schema[name].dataType).alias(name))
        parts.append(fresh.select(*out))
    if untouched is not None:
        parts.append(untouched)
    result = parts[0]
    for p in parts[1:]:
        result = result.unionByName(p)
    return result


def _match(on: Sequence[str]) -> Column:
    cond = F.lit(True)
    for i, k in enumerate(on):
        one = F.col(f"target.{k}") == F.col(f"source.{k}")
        cond = one if i == 0 else cond & one
    return cond


def insert_missing(target: DataFrame, source: DataFrame, on: Sequence[str]) -> DataFrame:
    """Insert-only merge: loading the same source again changes nothing."""
    first = source.dropDuplicates(list(on))
    return target.unionByName(first.join(target.select(*on), list(on), "left_anti").select(*target.columns))


def upsert(target: DataFrame, source: DataFrame, on: Sequence[str]) -> DataFrame:
    return merge(target, source, on, [update_all(), insert_all()])


def upsert_if_newer(target: DataFrame, source: DataFrame, on: Sequence[str], event_time: str) -> DataFrame:
    """Upsert that ignores source rows older than the stored row."""
    newer = f"source.{event_time} >= target.{event_time} OR target.{event_time} IS NULL"
    return merge(target, source, on, [update_all(when=newer), insert_all()])


def update_where(df: DataFrame, predicate: str, assignments: Mapping[str, str]) -> DataFrame:
    """UPDATE ... SET ... WHERE: rows whose predicate is false or NULL stay as they are."""
    hit = _holds(predicate)
    return df.select(*[
        F.when(hit, F.expr(assignments[c])).otherwise(F.col(c)).cast(df.schema[c].dataType).alias(c)
        if c in assignments else F.col(c)
        for c in df.columns
    ])


def delete_where(df: DataFrame, predicate: str) -> DataFrame:
    """DELETE ... WHERE: keeps rows whose predicate is false or NULL."""
    return df.filter(~_holds(predicate))


def delete_keys(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Erase every row whose key is listed."""
    return df.join(keys.select(*on), list(on), "left_anti")


def replace_where(target: DataFrame, new: DataFrame, predicate: str) -> DataFrame:
    """Replace the rows that match a predicate, after checking that every new row matches it."""
    if not new.filter(~_holds(predicate)).isEmpty():
        raise ValueError(f"new rows outside {predicate!r}")
    return delete_where(target, predicate).unionByName(new.select(*target.columns))
