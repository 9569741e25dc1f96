"""Window functions (W)."""

from pyspark.sql import Window, functions as F

from spindrift.functions.numeric import dec
from spindrift.operators.windows import (
    chunked_window, time_chunk, top_per_group, trailing_stats, value_ranks, with_group_values,
)
from spindrift.plans import iot
from spindrift.queries import query
from spindrift.queries.snippets import SEC, TRAILING_30D, VELOCITY, davg, dsum

DAY = 86_400


@query("w01_rank_family", """
SELECT o_orderkey, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice, o_orderkey) AS rn,
       rank() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate) AS rnk,
       dense_rank() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate) AS dense
FROM orders""")
def w01(spark, t):
    o = t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice", "o_orderdate")
    by_price = chunked_window(o, ["o_orderpriority"], ["o_totalprice", "o_orderkey"], row_number="rn")
    by_date = value_ranks(by_price, ["o_orderpriority"], ["o_orderdate"], rank="rnk", dense_rank="dense")
    return by_date.select("o_orderkey", "rn", "rnk", "dense")


@query("w02_percent_rank", """
SELECT o_orderkey, percent_rank() OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice) AS pr FROM orders""")
def w02(spark, t):
    o = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    return value_ranks(o, ["o_orderstatus"], ["o_totalprice"], percent_rank="pr").select("o_orderkey", "pr")


@query("w03_lag_lead", """
SELECT event_id, coalesce(lag(event_id) OVER w, -1) AS prev_id, coalesce(lead(event_id) OVER w, -1) AS next_id,
       (value - lag(value) OVER w) * 100 / nullif(lag(value) OVER w, 0) AS change_pct
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def w03(spark, t):
    w = chunked_window(t.events, ["user_id"], ["ts", "event_id"], lag={"p": "event_id", "pv": "value"}, lead={"n": "event_id"})
    return w.select("event_id", F.coalesce("p", F.lit(-1)).alias("prev_id"), F.coalesce("n", F.lit(-1)).alias("next_id"),
                    ((F.col("value") - F.col("pv")) * 100 / F.nullif(F.col("pv"), F.lit(0.0))).alias("change_pct"))


@query("w03_period_over_period", f"""
WITH d AS (SELECT event_type, strftime(ts, '%Y-%m-%d') AS day, {dsum('value')} AS total FROM events GROUP BY 1, 2)
SELECT event_type, day, total, (total - lag(total) OVER w) * 100 / nullif(lag(total) OVER w, 0) AS change_pct
FROM d WINDOW w AS (PARTITION BY event_type ORDER BY day)""")
def w03_period(spark, t):
    daily = t.events.groupBy("event_type", F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(
        F.sum(dec("value")).cast("double").alias("total"))
    before = F.lag("total").over(Window.partitionBy("event_type").orderBy("day"))  # one row per type and day
    return daily.withColumn("change_pct", (F.col("total") - before) * 100 / F.nullif(before, F.lit(0.0)))


@query("w04_running_total", """
SELECT event_id, CAST(SUM(CAST(value AS DECIMAL(12,2))) OVER (PARTITION BY user_id ORDER BY ts, event_id
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS running
FROM events""")
def w04(spark, t):
    rows = t.events.withColumn("v", dec("value"))
    return chunked_window(rows, ["user_id"], ["ts", "event_id"], running={"r": "v"}).select(
        "event_id", F.col("r").cast("double").alias("running"))


@query("w04_running_total_global", """
SELECT o_orderkey, CAST(SUM(CAST(o_totalprice AS DECIMAL(12,2))) OVER (ORDER BY o_orderdate, o_orderkey
       ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running
FROM orders""")
def w04_global(spark, t):
    rows = t.orders.select("o_orderkey", "o_orderdate", dec("o_totalprice").alias("v"))
    return chunked_window(rows, [], ["o_orderdate", "o_orderkey"], running={"r": "v"}).select(
        "o_orderkey", F.col("r").cast("double").alias("running"))


@query("w05_whole_partition", """
SELECT o_orderkey, CAST(SUM(CAST(o_totalprice AS DECIMAL(12,2))) OVER w AS DOUBLE) AS customer_total,
       o_totalprice / nullif(MAX(o_totalprice) OVER w, 0) AS share_of_largest
FROM orders WINDOW w AS (PARTITION BY o_custkey)""")
def w05(spark, t):
    o = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    both = with_group_values(o, ["o_custkey"], customer_total=F.sum(dec("o_totalprice")).cast("double"),
                             largest=F.max("o_totalprice"))
    return both.select("o_orderkey", "customer_total", (F.col("o_totalprice") / F.nullif(F.col("largest"), F.lit(0.0))).alias("share_of_largest"))


@query("w06_trailing_hour_count", f"""
SELECT event_id, COUNT(*) OVER (PARTITION BY user_id ORDER BY {SEC} RANGE BETWEEN 3600 PRECEDING AND CURRENT ROW) AS recent_n
FROM events""")
def w06(spark, t):
    return trailing_stats(t.events, ["user_id"], "ts", None, 3600, prefix="recent").select("event_id", "recent_n")


@query("w06_trailing_day_count", f"WITH {VELOCITY} SELECT event_id, recent_n FROM vel")
def w06_day(spark, t):
    return trailing_stats(t.events, ["user_id"], "ts", None, DAY, chunk_seconds=6 * 3600, prefix="recent").select(
        "event_id", "recent_n")


@query("w07_trailing_month_stats", f"""
WITH {TRAILING_30D}
SELECT event_id, n AS past_n, past_avg, round(past_stddev, 4) AS past_stddev FROM amounts""")
def w07(spark, t):
    return trailing_stats(t.events, ["user_id"], "ts", "value", 30 * DAY, chunk_seconds=DAY, include_current=False,
                          prefix="past").select("event_id", "past_n", "past_avg", F.round("past_stddev", 4).alias("past_stddev"))


@query("w08_window_over_aggregate", """
WITH s AS (
  SELECT r_name, n_name, SUM(CAST(o_totalprice AS DECIMAL(12,2))) AS rev
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  GROUP BY 1, 2
)
SELECT r_name, n_name, CAST(rev AS DOUBLE) AS rev, CAST(rank() OVER (PARTITION BY r_name ORDER BY rev DESC) AS INTEGER) AS rnk FROM s""")
def w08(spark, t):
    t.views("orders", "customer", "nation", "region")
    return spark.sql("""
        SELECT r_name, n_name, CAST(SUM(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS rev,
               RANK() OVER (PARTITION BY r_name ORDER BY SUM(CAST(o_totalprice AS DECIMAL(12,2))) DESC) AS rnk
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey
        GROUP BY r_name, n_name""")


@query("w09_first_last_value", """
SELECT DISTINCT user_id, first_value(event_type) OVER w AS first_type, last_value(event_type) OVER w AS last_type
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""")
def w09(spark, t):
    position = F.struct("ts", "event_id")
    return t.events.groupBy("user_id").agg(F.min_by("event_type", position).alias("first_type"),
                                           F.max_by("event_type", position).alias("last_type"))


@query("w10_top_k_per_group", """
SELECT * FROM (SELECT o_custkey, o_orderkey, o_totalprice,
  CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS INTEGER) AS rn FROM orders) WHERE rn <= 3""")
def w10(spark, t):
    return top_per_group(t.orders.select("o_custkey", "o_orderkey", "o_totalprice"), ["o_custkey"],
                         [F.desc("o_totalprice"), F.asc("o_orderkey")], 3)


@query("w11_shift_detection", f"""
WITH b AS (
  SELECT event_type, CAST(floor(epoch(ts) / 21600) AS BIGINT) AS slot, {davg('value')} AS mean_value, stddev_samp(value) AS sd
  FROM events GROUP BY 1, 2
),
p AS (SELECT *, lag(mean_value) OVER (PARTITION BY event_type ORDER BY slot) AS previous_mean FROM b)
SELECT event_type, slot, mean_value, previous_mean, mean_value - previous_mean AS delta
FROM p WHERE abs(mean_value - previous_mean) > sd * 0.1""")
def w11(spark, t):
    slots = t.events.groupBy("event_type", time_chunk("ts", 21_600).alias("slot")).agg(
        (F.sum(dec("value")).cast("double") / F.count("value")).alias("mean_value"), F.stddev_samp("value").alias("sd"))
    return iot.shifts(slots, ["event_type"], "slot", "mean_value", "sd", 0.1).select(
        "event_type", "slot", "mean_value", "previous_mean", "delta")
