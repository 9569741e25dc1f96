"""Chunked windows against Spark's own, on ties, gaps and hot keys."""

import random

import pytest
from pyspark.sql import Window, functions as F

from spindrift.functions.numeric import exact_sum
from spindrift.operators import windows
from spindrift.operators.aggregates import exact_quantiles, merge_stats, nest, read_stats, running_stats
from spindrift.operators.windows import (
    carry, chunked_window, split_hot, time_chunk, top_per_group, trailing_stats, value_ranks, with_group_values,
)

T0 = 1_700_000_000


@pytest.fixture(scope="module")
def rows(spark):
    rnd = random.Random(5)
    data = [("hot", T0 + rnd.randrange(0, 40_000), i, float(rnd.randrange(0, 9999)) / 100) for i in range(600)]
    data += [(None if i % 3 == 0 else "cold", T0 + rnd.randrange(0, 40_000), 1000 + i, 1.5) for i in range(40)]
    # gaps of exactly 3600 and 3601 seconds, and ties
    data += [("edge", T0, 2000, 1.0), ("edge", T0 + 3600, 2001, 2.0), ("edge", T0 + 7201, 2002, 3.0), ("edge", T0 + 7201, 2003, 4.0)]
    df = spark.createDataFrame(data, "k string, s long, id long, v double")
    return df.withColumn("ts", F.timestamp_seconds("s")).cache()


def same(a, b):
    assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))


@pytest.mark.parametrize("hot_rows", [None, 50, 10_000])
def test_chunked_window_equals_plain(rows, hot_rows):
    w = Window.partitionBy("k").orderBy("s", "id")
    cents = rows.withColumn("c", (F.col("v") * 100).cast("long"))
    plain = cents.select("id", F.lag("id").over(w).alias("p"), F.lead("id").over(w).alias("n"), F.row_number().over(w).cast("long").alias("rn"),
                         F.sum("c").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("run"))
    mine = chunked_window(cents, ["k"], ["s", "id"], time_chunk("ts", 500), lag={"p": "id"}, lead={"n": "id"}, running={"run": "c"},
                          row_number="rn", hot_rows=hot_rows).select("id", "p", "n", "rn", "run")
    same(plain, mine)


def test_chunked_ranks_with_ties(rows):
    w = Window.partitionBy("k").orderBy("s")
    plain = rows.select("id", F.rank().over(w).cast("long").alias("r"), F.dense_rank().over(w).cast("long").alias("d"),
                        F.percent_rank().over(w).alias("p"))
    by_value = value_ranks(rows, ["k"], ["s"], F.floor(F.col("s") / 900), rank="r", dense_rank="d", percent_rank="p").select("id", "r", "d", "p")
    by_row = chunked_window(rows, ["k"], ["s"], time_chunk("ts", 900), rank="r", dense_rank="d", percent_rank="p").select(
        "id", F.col("r").cast("long").alias("r"), F.col("d").cast("long").alias("d"), "p")
    same(plain, by_value)
    same(plain, by_row)


@pytest.mark.parametrize("chunk", [None, 1200])
@pytest.mark.parametrize("include", [True, False])
def test_trailing_stats_equals_range_frame(rows, chunk, include):
    w = Window.partitionBy("k").orderBy("s").rangeBetween(-3600, 0 if include else -1)
    plain = rows.select("id", F.count("id").over(w), F.avg("v").over(w), F.stddev("v").over(w)).collect()
    mine = trailing_stats(rows, ["k"], "ts", "v", 3600, chunk_seconds=chunk, include_current=include, prefix="t")
    got = {r["id"]: (r["t_n"], r["t_avg"], r["t_stddev"]) for r in mine.collect()}
    assert len(got) == len(plain)
    for key, *want in plain:  # the plain frame adds doubles, so means agree to the last digits only
        for g, x in zip(got[key], want):
            assert g == x if x is None else g == pytest.approx(x, abs=1e-6)


def test_trailing_edges(rows):
    got = {r["id"]: r["t_n"] for r in trailing_stats(rows.filter("k = 'edge'"), ["k"], "ts", None, 3600, prefix="t").collect()}
    assert got == {2000: 1, 2001: 2, 2002: 2, 2003: 2}


def test_no_history_is_null(rows):
    one = trailing_stats(rows.filter("id = 2000"), ["k"], "ts", "v", 3600, include_current=False, prefix="t").first()
    assert (one["t_n"], one["t_avg"], one["t_stddev"]) == (0, None, None)


def test_chunk_must_divide(rows):
    with pytest.raises(ValueError):
        trailing_stats(rows, ["k"], "ts", None, 3600, chunk_seconds=7)


def test_exact_quantiles(rows):
    got = exact_quantiles(rows, ["k"], "v", {"m": 0.5}, hot_rows=50).filter("k = 'hot'").first()["m"]
    values = sorted(r["v"] for r in rows.filter("k = 'hot'").collect())
    assert got == values[len(values) // 2 - 1]


def test_merged_stats_equal_one_pass(rows):
    def final(s):
        return read_stats(s, ["k"])

    whole = running_stats(rows, ["k"], "v", "ts", "id")
    parts = [running_stats(rows.filter(F.pmod("id", F.lit(3)) == i), ["k"], "v", "ts", "id") for i in range(3)]
    same(final(whole), final(merge_stats(merge_stats(parts[2], parts[0], ["k"]), parts[1], ["k"])))


def test_nest_parts_follow_the_order_alone(rows, spark):
    arrays = nest(rows.select("k", "id"), ["k"], ["id"], "id", 100).withColumn("n", F.size("items"))
    assert {r["k"]: r["n"] for r in arrays.groupBy("k").agg(F.sum("n").alias("n")).collect()}["hot"] == 600
    assert arrays.agg(F.max("n")).first()[0] <= 100
    # one item over a stretch, and a single row far up: the same numbering at every size
    many = spark.range(10_001).selectExpr("'a' AS k", "id").union(spark.sql("SELECT 'b', 25000L"))
    parts = nest(many, ["k"], ["id"], "id", 10_000).select("k", "part", F.size("items")).collect()
    assert sorted(map(tuple, parts)) == [("a", 0, 10_000), ("a", 1, 1), ("b", 2, 1)]


def test_large_amounts_have_moments(spark):
    rows = spark.range(2000).select(F.lit("a").alias("k"), F.lit(5e7).alias("v"), F.timestamp_seconds("id").alias("ts"), "id")
    last = trailing_stats(rows, ["k"], "ts", "v", 3600, prefix="p").orderBy(F.desc("id")).first()
    assert (last["p_n"], last["p_avg"], last["p_stddev"]) == (2000, 5e7, 0.0)
    final = read_stats(running_stats(rows, ["k"], "v", "ts", "id"), ["k"]).first()
    assert (final["mean_value"], final["stddev_value"]) == (5e7, 0.0)
    assert spark.sql("SELECT 2e10 AS v").agg(exact_sum("v")).first()[0] == 2e10


def test_group_values_and_top_k(rows):
    plain = rows.select("id", F.max("v").over(Window.partitionBy("k")).alias("m"))
    same(plain, with_group_values(rows, ["k"], m=F.max("v")).select("id", "m"))
    assert top_per_group(rows, ["k"], [F.desc("v"), F.asc("id")], 2).count() == 8


@pytest.mark.parametrize("chunk", [None, "s"])
def test_ranges_equal_plain_windows(rows, chunk):
    """Every window column, over sampled ranges and over given chunks, of large keys only."""
    w = Window.partitionBy("k").orderBy("s", "id")
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    gaps = rows.withColumn("some", F.when(F.col("id") % 7 == 0, F.col("id")))
    plain = gaps.select(
        "id", F.lag("v").over(w).alias("p"), F.lead("v").over(w).alias("n"), F.sum("id").over(so_far).alias("run"), F.last("some", True).over(so_far).alias("l"),
        F.last("some", True).over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("b"), F.row_number().over(w).cast("long").alias("rn"),
        F.percent_rank().over(w).alias("pr"), F.count("*").over(Window.partitionBy("k")).alias("all"))
    mine = chunked_window(gaps, ["k"], ["s", "id"], chunk and F.floor(F.col(chunk) / 500), hot_rows=30, rows_per_range=40, lag={"p": "v"}, lead={"n": "v"},
                          running={"run": "id"}, latest={"l": "some"}, before={"b": "some"}, row_number="rn", percent_rank="pr", total="all")
    same(plain, mine.select(plain.columns))


def test_ranges_without_keys(rows):
    w = Window.orderBy("s", "id")
    plain = rows.select("id", F.row_number().over(w).cast("long").alias("rn"), F.sum("id").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("run"))
    same(plain, chunked_window(rows, [], ["s", "id"], hot_rows=100, row_number="rn", running={"run": "id"}).select("id", "rn", "run"))
    assert chunked_window(rows.filter("false"), [], ["s", "id"], row_number="rn").count() == 0
    with pytest.raises(TypeError):
        chunked_window(rows, ["k"], ["s"], no_such="x")


@pytest.mark.parametrize("fan_out", [2, 5, 1000])
def test_carry_tree(spark, monkeypatch, fan_out):
    monkeypatch.setattr(windows, "FAN_OUT", fan_out)
    rnd = random.Random(fan_out)
    data = {(k, c): (rnd.randrange(9), rnd.choice([None, c]), rnd.choice([None, c])) for k in ("a", None) for c in rnd.sample(range(200), 60)}
    summary = spark.createDataFrame([(k, c, *v) for (k, c), v in data.items()], "k string, _chunk long, n long, last long, first long")
    for r in carry(summary, ["k"], ["n"], ["last"], ["first"]).collect():
        earlier, later = ([v for (k, c), v in sorted(data.items(), key=repr) if k == r.k and (c < r._chunk if up else c > r._chunk)] for up in (True, False))
        assert r.n == sum(v[0] for v in earlier)
        assert r["last"] == max((v[1] for v in earlier if v[1] is not None), default=None)
        assert r["first"] == min((v[2] for v in later if v[2] is not None), default=None)


def test_one_value_is_spread(spark):
    """Nine tenths of the rows on one day of one key: the ranges are cut within the day."""
    rows = spark.range(40_000).select(F.lit("k").alias("k"), F.when(F.col("id") % 10 < 9, 5).otherwise(F.col("id") % 97).alias("day"), "id")
    small, large = split_hot(rows, ["k"], ["day", "id"], 1000, 4000)
    sizes = sorted(r["count"] for r in large.groupBy("_chunk").count().collect())
    assert small.isEmpty() and sum(sizes) == 40_000 and len(sizes) >= 9 and sizes[-1] <= 2 * sizes[len(sizes) // 2]
    w = Window.partitionBy("k").orderBy("day", "id")
    same(rows.select("id", F.row_number().over(w).cast("long").alias("rn")).filter("id % 50 = 0"),
         chunked_window(rows, ["k"], ["day", "id"], hot_rows=1000, rows_per_range=4000, row_number="rn").select("id", "rn").filter("id % 50 = 0"))
