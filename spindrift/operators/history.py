"""Slowly changing dimensions, change data capture and change feeds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from spindrift.operators.merge import AmbiguousMerge, insert_all, merge, update_all
from spindrift.operators.windows import chunked_window

INSERT, PRE, POST, DELETE = "insert", "update_preimage", "update_postimage", "delete"
FEED_COLUMNS = ("_change_type", "_commit_version", "_commit_timestamp")


def differs(a: str, b: str, columns: Sequence[str]) -> Column:
    """NULL-safe: true when any of the columns differs between two aliased frames."""
    out = F.lit(False)
    for c in columns:
        out = out | ~F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}"))
    return out


def scd1(dim: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Type 1: overwrite in place, insert new keys."""
    return merge(dim, changes, keys, [update_all(), insert_all()])


def open_history(snapshot: DataFrame, effective: str, start: str = "eff_start", end: str = "eff_end",
                 flag: str = "is_current") -> DataFrame:
    """First load of a type 2 table."""
    return snapshot.select(
        "*", F.lit(effective).cast("date").alias(start), F.lit(None).cast("date").alias(end), F.lit(True).alias(flag)
    )


def scd2(dim: DataFrame, snapshot: DataFrame, keys: Sequence[str], tracked: Sequence[str], effective: str,
         start: str = "eff_start", end: str = "eff_end", flag: str = "is_current") -> DataFrame:
    """Type 2 from a snapshot: close changed current rows, open their new versions, insert new keys.

    Closed rows pass through without a shuffle. The outcome depends on its arguments
    only, so a second run with the same snapshot and date changes nothing. A key that the snapshot holds more than once, which
    would have two current versions, is an error, found in a job of its own; rows without a whole key match nothing and are new versions.
    """
    keys = list(keys)
    doubled = snapshot.dropna(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")
    if not doubled.isEmpty():
        raise AmbiguousMerge(f"several snapshot rows for one key, keys {keys}")
    closed = dim.filter(~F.col(flag))
    live = dim.filter(F.col(flag)).withColumn("_live", F.lit(True)).alias("d")
    snap = snapshot.select(*[c for c in dim.columns if c in snapshot.columns])
    s = snap.withColumn("_seen", F.lit(True)).alias("s")
    joined = live.join(s, [F.col(f"d.{k}") == F.col(f"s.{k}") for k in keys], "full_outer")
    changed = F.col("d._live").isNotNull() & F.col("s._seen").isNotNull() & differs("d", "s", tracked)
    fresh = F.col("d._live").isNull()
    day = F.lit(effective).cast("date")
    # changed rows give two versions, others one
    versions = joined.withColumn("_changed", changed).withColumn("_fresh", fresh).withColumn(
        "_new", F.explode(F.when(F.col("_changed"), F.array(F.lit(False), F.lit(True)))
                          .when(F.col("_fresh"), F.array(F.lit(True)))
                          .otherwise(F.array(F.lit(False))))
    )
    out = []
    for c in dim.columns:
        if c == start:
            v = F.when(F.col("_new"), day).otherwise(F.col(f"d.{c}"))
        elif c == end:
            v = F.when(F.col("_new"), F.lit(None)).when(F.col("_changed"), day).otherwise(F.col(f"d.{c}"))
        elif c == flag:
            v = F.when(F.col("_new"), F.lit(True)).when(F.col("_changed"), F.lit(False)).otherwise(F.col(f"d.{c}"))
        elif c in snap.columns:
            v = F.when(F.col("_new"), F.col(f"s.{c}")).otherwise(F.col(f"d.{c}"))
        else:
            v = F.when(~F.col("_new"), F.col(f"d.{c}"))
        out.append(v.cast(dim.schema[c].dataType).alias(c))
    return versions.select(*out).unionByName(closed)


def current(dim: DataFrame, end: str = "eff_end") -> DataFrame:
    return dim.filter(F.col(end).isNull())


def as_of(dim: DataFrame, moment: Column | str, start: str = "eff_start", end: str = "eff_end") -> DataFrame:
    """The versions valid at one moment: start <= moment < end."""
    at = F.lit(moment) if isinstance(moment, str) else moment
    return dim.filter((F.col(start) <= at) & (F.col(end).isNull() | (F.col(end) > at)))


def apply_cdc(
    log: DataFrame, keys: Sequence[str], sequence: str, op: str, scd_type: int = 1,
    target: DataFrame | None = None, hot_rows: int | None = None,
) -> DataFrame:
    """Rows after a log of INSERT / UPDATE / DELETE events, in whatever order they arrive.

    Type 1 returns the latest row per key and keeps deletes as tombstones (``_deleted``)
    so that a late event cannot bring a row back; ``live_rows`` drops them. Type 2
    returns one interval [sequence, next sequence) per event, deletes closing the row
    before them. Pass an earlier type 1 result as ``target`` to continue from it. Of
    events with equal key and sequence the greatest row by all columns is kept.
    The log of a key of more than ``hot_rows`` events is split over tasks.
    """
    keys = list(keys)
    cols = [c for c in log.columns if c not in (op,)]
    if scd_type == 1:
        events = log.select(*cols, (F.col(op) == "DELETE").alias("_deleted"))
        if target is not None:
            events = target.select(*events.columns).unionByName(events)
        rest = [c for c in events.columns if c not in (*keys, sequence)]
        best = events.groupBy(*keys).agg(F.max(F.struct(sequence, *rest)).alias("_b"))
        return best.select(*keys, *[F.col(f"_b.{c}").alias(c) for c in events.columns if c not in keys])
    rest = [c for c in log.columns if c not in (*keys, sequence)]
    unique = log.groupBy(*keys, sequence).agg(F.max(F.struct(*rest)).alias("_r")).select(
        *keys, sequence, *[F.col(f"_r.{c}").alias(c) for c in rest]
    )
    timed = chunked_window(unique, keys, [sequence], hot_rows=hot_rows, sizes=log, lead={"valid_to": sequence})
    return timed.filter(F.col(op) != "DELETE").select(
        *[c for c in log.columns if c not in (op, sequence)],
        F.col(sequence).alias("valid_from"), "valid_to", F.col("valid_to").isNull().alias("is_current"),
    )


def live_rows(type1: DataFrame) -> DataFrame:
    return type1.filter(~F.col("_deleted")).drop("_deleted")


def change_feed(old: DataFrame, new: DataFrame, keys: Sequence[str], version: int, ts: str) -> DataFrame:
    """What changed between two snapshots of one table: one row per insert or delete, two per update."""
    keys = list(keys)
    values = [c for c in old.columns if c not in keys]
    o = old.withColumn("_in", F.lit(True)).alias("o")
    n = new.withColumn("_in", F.lit(True)).alias("n")
    joined = o.join(n, [F.col(f"o.{k}") == F.col(f"n.{k}") for k in keys], "full_outer")
    before = F.struct(*[F.col(f"o.{c}").alias(c) for c in old.columns])
    after = F.struct(*[F.col(f"n.{c}").alias(c) for c in old.columns])

    def entry(kind: str, row: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), row.alias("row"))

    entries = (
        F.when(F.col("o._in").isNull(), F.array(entry(INSERT, after)))
        .when(F.col("n._in").isNull(), F.array(entry(DELETE, before)))
        .when(differs("o", "n", values), F.array(entry(PRE, before), entry(POST, after)))
    )
    return joined.select(F.explode(entries).alias("e")).select(
        "e.row.*",
        F.col("e.kind").alias("_change_type"),
        F.lit(version).cast("bigint").alias("_commit_version"),
        F.lit(ts).cast("timestamp_ntz").alias("_commit_timestamp"),
    )


def initial_feed(rows: DataFrame, version: int, ts: str) -> DataFrame:
    """A table's first version as inserts."""
    return rows.select(
        "*", F.lit(INSERT).alias("_change_type"), F.lit(version).cast("bigint").alias("_commit_version"),
        F.lit(ts).cast("timestamp_ntz").alias("_commit_timestamp"),
    )


def state_as_of(feed: DataFrame, keys: Sequence[str], version: int | None = None, ts: str | None = None) -> DataFrame:
    """The table as of a version or time: the last image per key, deleted keys dropped.

    A restore is the state as of the version to go back to.
    """
    keys = list(keys)
    events = feed.filter(F.col("_change_type") != PRE)
    if version is not None:
        events = events.filter(F.col("_commit_version") <= version)
    if ts is not None:
        events = events.filter(F.col("_commit_timestamp") <= F.lit(ts).cast("timestamp_ntz"))
    values = [c for c in feed.columns if c not in (*keys, *FEED_COLUMNS)]
    last = events.groupBy(*keys).agg(
        F.max(F.struct("_commit_version", "_change_type", *values)).alias("_l")
    )
    return last.filter(F.col("_l._change_type") != DELETE).select(
        *[F.col(c) if c in keys else F.col(f"_l.{c}").alias(c) for c in feed.columns if c not in FEED_COLUMNS]
    )


def apply_feed(target: DataFrame, feed: DataFrame, keys: Sequence[str], after_version: int) -> DataFrame:
    """Bring a downstream table up to date with the part of a feed newer than ``after_version``."""
    keys = list(keys)
    news = feed.filter((F.col("_commit_version") > after_version) & (F.col("_change_type") != PRE))
    values = [c for c in feed.columns if c not in (*keys, *FEED_COLUMNS)]
    last = news.groupBy(*keys).agg(F.max(F.struct("_commit_version", "_change_type", *values)).alias("_l"))
    last = last.select(*keys, F.col("_l._change_type").alias("_change_type"),
                       *[F.col(f"_l.{c}").alias(c) for c in values])
    kept = target.join(last.select(*keys), keys, "left_anti")
    arrived = last.filter(F.col("_change_type") != DELETE).select(*target.columns)
    return kept.unionByName(arrived)


def first_bad_version(feed: DataFrame, rule: str) -> DataFrame:
    """First version at which some row breaks a rule, with the number of bad rows then.

    Bad rows enter by inserts and post-images and leave by deletes and pre-images, so
    the number at each version is a running signed count over versions.
    """
    bad = ~F.coalesce(F.expr(rule), F.lit(False))
    sign = F.when(F.col("_change_type").isin(INSERT, POST), 1).otherwise(-1)
    per_version = feed.filter(bad).groupBy("_commit_version").agg(F.sum(sign).alias("delta"))
    # one row per version: commits, not rows
    upto = Window.orderBy("_commit_version").rowsBetween(Window.unboundedPreceding, 0)
    counted = per_version.withColumn("bad_rows", F.sum("delta").over(upto)).filter("bad_rows > 0")
    return counted.agg(F.min_by("bad_rows", "_commit_version").alias("bad_rows"),
                       F.min("_commit_version").alias("version")).filter("version IS NOT NULL")
