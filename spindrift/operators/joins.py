"""Joins beyond the built-in ones: skew, ranges, intervals, references."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from spindrift.operators.windows import HOT_ROWS, by_parts
from spindrift.session import broadcast_few_rows, broadcast_if_small


def row_salt(df: DataFrame, buckets: int) -> Column:
    """A salt per row that a retried task computes again unchanged.

    Equal rows share a content hash, so the number of the partition is added: copies
    that fill many input partitions are spread too.
    """
    cols = [F.col(f"`{c}`") for c in df.columns]
    return F.pmod(F.xxhash64(*cols) + F.spark_partition_id(), F.lit(buckets)).cast("int")


def salted_join(fact: DataFrame, dim: DataFrame, on: str | Sequence[str], buckets: int = 16,
                how: str = "inner") -> DataFrame:
    """Equi join whose hot keys are spread over ``buckets`` tasks each.

    Every row of ``fact`` takes one salt; ``dim`` is repeated once per salt.
    The optimiser's size of ``dim`` does not know of the repeats, so Spark is told to
    shuffle and sort: it would broadcast all of them through the driver.
    ``how`` is inner, left, left_semi or left_anti.
    """
    on = [on] if isinstance(on, str) else list(on)
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"salting keeps only the left side whole: {how}")
    left = fact.withColumn("_salt", row_salt(fact, buckets))
    right = dim.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
    return left.join(right.hint("merge"), [*on, "_salt"], how).drop("_salt")


def heavy_keys(df: DataFrame, key: str, share: float) -> DataFrame:
    """Keys holding at least ``share`` of the rows: never more than 1/share of them."""
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    total = df.agg(F.count(F.lit(1))).scalar()
    return counts.filter(F.col("_rows") >= total * F.lit(share)).select(key)


def hot_key_join(fact: DataFrame, dim: DataFrame, key: str, share: float = 0.01, buckets: int = 32) -> DataFrame:
    """Inner join that salts only the rows of heavy keys and joins the rest plainly."""
    hot = broadcast_few_rows(heavy_keys(fact, key, share))  # at most 1/share rows, counted once
    spread = salted_join(fact.join(hot, key, "left_semi"), dim.join(hot, key, "left_semi"), key, buckets)
    plain = fact.join(hot, key, "left_anti").join(dim, key)
    return plain.unionByName(spread)


def preagg_join(fact: DataFrame, dim: DataFrame, key: str, *aggregates: Column, how: str = "inner") -> DataFrame:
    """Aggregate the fact side to one row per key, then join: the shuffle carries keys, not rows."""
    return fact.groupBy(key).agg(*aggregates).join(dim, key, how)


def dim_join(fact: DataFrame, dim: DataFrame, on, how: str = "inner") -> DataFrame:
    """Join a dimension, broadcast while its planned size is within the limit."""
    return fact.join(broadcast_if_small(dim), on, how)


def interval_join(fact: DataFrame, versions: DataFrame, key: str, ts: str, start: str, end: str,
                  how: str = "inner", hot_rows: int = HOT_ROWS) -> DataFrame:
    """Each fact row beside the version valid at its time: start <= ts < end, open end = NULL.

    Versions of one key do not overlap (or one is empty), so the one valid at a time is the last to start by then, if it has not ended. Facts and versions are put in one order of
    time and the last version is carried to the facts, over the ranges of a large key too: the work follows facts plus versions, not their product.
    ``how`` is inner or left; facts without key or time meet no version, versions without key or start meet no fact.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"an interval join is inner or left: {how}")
    added = [c for c in versions.columns if c != key]
    both = versions.filter(F.col(key).isNotNull() & F.col(start).isNotNull()).select(
        F.col(key).alias("_key"), F.col(start).alias("_at"), F.lit(0).alias("_side"), F.col(end).isNull().alias("_open"),
        F.coalesce(F.col(end), F.col(start)).alias("_until"), F.lit(0).cast("long").alias("_salt"), F.struct(*added).alias("_version"),
    )
    known = F.col(key).isNotNull() & F.col(ts).isNotNull()
    # facts of one moment are told apart by their content, so that a moment with very many of them can be cut
    facts = fact.filter(known).select(
        F.col(key).alias("_key"), F.col(ts).alias("_at"), F.lit(1).alias("_side"), F.lit(False).alias("_open"),
        F.col(ts).alias("_until"), row_salt(fact, 1 << 20).cast("long").alias("_salt"), F.struct(*fact.columns).alias("_fact"),
    )
    order = ["_at", "_side", "_open", "_until", "_salt"]
    met = by_parts(both.unionByName(facts, allowMissingColumns=True), ["_key"], order,
                   lambda part, window: window(part, latest={"_met": "_version"}), hot_rows=hot_rows).filter("_side = 1")
    valid = F.col(f"_met.{end}").isNull() | (F.col("_at") < F.col(f"_met.{end}"))
    valid = F.col("_met").isNotNull() & valid
    out = met.filter(valid) if how == "inner" else met.withColumn("_met", F.when(valid, F.col("_met")))
    out = out.select(*[F.col(f"_fact.{c}").alias(c) for c in fact.columns], *[F.col(f"_met.{c}").alias(c) for c in added])
    return out if how == "inner" else out.unionByName(fact.filter(~known), allowMissingColumns=True)


def orphans(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str) -> DataFrame:
    """Fact rows whose key is absent from the dimension (referential check)."""
    keys = dim.select(F.col(dim_key).alias("_dkey"))
    return fact.join(keys, F.col(fact_key) == F.col("_dkey"), "left_anti")


def replicate(df: DataFrame, name: str, values: Sequence) -> DataFrame:
    """Every row once per literal: a cross product with a list fixed in the code."""
    return df.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))


def nearest_other_place(
    df: DataFrame, key: str, place: str, ts: str, row_id: str, max_seconds: int, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """For each row the closest earlier row of its key at another place, at most ``max_seconds`` before.

    One result per arrival and no pairs: sort the moments of a key, and look back
    past the run of moments spent at the same place. What a moment must know (the moment before, and the one before
    that one's run) is carried over the ranges of a large key, so no task holds a span of it.
    """
    seconds = F.unix_seconds(F.col("_ts").cast("timestamp"))
    visits = df.select(key, F.col(place).alias("_place"), F.col(ts).alias("_ts"), F.col(row_id).alias("_id"))
    # one moment per (key, time): the smallest and largest place tell if it is mixed
    moments = visits.filter(F.col("_place").isNotNull()).groupBy(key, "_ts").agg(
        F.min(F.struct("_place", "_id")).alias("_lo"), F.max(F.struct("_place", (-F.col("_id")).alias("_neg"))).alias("_hi"),
    ).withColumn("_hi", F.struct(F.col("_hi._place").alias("_place"), (-F.col("_hi._neg")).alias("_id")))
    pure = F.when(F.col("_lo._place") == F.col("_hi._place"), F.col("_lo._place"))
    moments = moments.withColumns({"_pure": pure, "_moment": F.struct("_ts", "_lo", "_hi")})
    starts_run = F.col("_pure").isNull() | F.col("_prev_pure").isNull() | (F.col("_pure") != F.col("_prev_pure"))

    def looked_back(part: DataFrame, window) -> DataFrame:
        seen = window(part, lag={"_prev": "_moment", "_prev_pure": "_pure"})
        # the moment before the run that the previous moment belongs to
        seen = seen.withColumn("_run", F.when(starts_run, F.struct(F.col("_prev").alias("m"))))
        return window(seen, before={"_before_run": "_run"})

    seq = by_parts(moments, [key], ["_ts"], looked_back, hot_rows=hot_rows, sizes=visits).select(
        F.col(key).alias("_mkey"), F.col("_ts").alias("_mts"), "_prev", "_prev_pure", F.col("_before_run.m").alias("_back")
    )
    arrivals = visits.join(seq, (F.col(key) == F.col("_mkey")) & (F.col("_ts") == F.col("_mts")))
    origin = F.when(F.col("_prev_pure") == F.col("_place"), F.col("_back")).otherwise(F.col("_prev"))
    arrivals = arrivals.withColumn("_from", origin).withColumn(
        "_src", F.when(F.col("_from._lo._place") != F.col("_place"), F.col("_from._lo")).otherwise(F.col("_from._hi"))
    )
    gap = seconds - F.unix_seconds(F.col("_from._ts").cast("timestamp"))
    return arrivals.select(
        key,
        F.col("_src._id").alias("from_id"),
        F.col("_id").alias("to_id"),
        F.col("_src._place").alias("place_from"),
        F.col("_place").alias("place_to"),
        F.col("_from._ts").alias("departure_time"),
        F.col("_ts").alias("arrival_time"),
        gap.alias("travel_seconds"),
    ).filter(F.col("travel_seconds") <= max_seconds)


def latest_before(
    left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str, max_seconds: int,
    right_cols: Sequence[str], tie: str, count_col: str = "matches", hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """For each right row the latest left row of its key with left_ts <= right_ts <= left_ts + max_seconds.

    Also counts the left rows in that span, on whole seconds. Both sides and the moments at which left rows expire are put in one order of time: the
    last left row and a count that rises and falls are carried along it, so the work follows the rows, not the pairs.
    """
    kind = left.schema[left_ts].dataType.simpleString()
    second = F.unix_seconds(F.col(left_ts).cast("timestamp"))
    one = lambda n: F.lit(n).cast("long").alias("_one")
    l = left.filter(F.col(left_ts).isNotNull()).select(
        F.col(key).alias("_key"), F.col(left_ts).alias("_at"), F.lit(1).alias("_side"), F.col(tie).alias("_tie"), one(1),
        F.lit(0).cast("long").alias("_salt"), F.struct(*left.columns).alias("_left"))
    gone = left.filter(F.col(left_ts).isNotNull()).select(
        F.col(key).alias("_key"), F.timestamp_seconds(second + F.lit(max_seconds + 1)).cast(kind).alias("_at"), F.lit(0).alias("_side"),
        F.col(tie).alias("_tie"), one(-1), F.lit(0).cast("long").alias("_salt"))
    r = right.filter(F.col(right_ts).isNotNull()).select(
        F.col(key).alias("_key"), F.col(right_ts).cast(kind).alias("_at"), F.lit(2).alias("_side"), one(0),
        row_salt(right, 1 << 20).cast("long").alias("_salt"), F.struct(*right_cols).alias("_right"))
    both = l.unionByName(gone, allowMissingColumns=True).unionByName(r, allowMissingColumns=True)
    out = by_parts(both, ["_key"], ["_at", "_side", "_tie", "_salt"],
                   lambda part, window: window(part, running={count_col: "_one"}, latest={"_hit": "_left"}), hot_rows=hot_rows)
    out = out.filter((F.col("_side") == 2) & (F.col(count_col) > 0))
    return out.select(
        F.col("_key").alias(key),
        *[F.col(f"_hit.{c}").alias(f"left_{c}") for c in left.columns if c != key],
        *[F.col(f"_right.{c}").alias(f"right_{c}") for c in right_cols],
        count_col,
    )
