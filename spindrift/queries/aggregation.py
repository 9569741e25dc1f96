"""Aggregation (A)."""

import pandas as pd
from pyspark.sql import functions as F

from spindrift.functions.numeric import dec, exact_avg, exact_sum, ratio
from spindrift.operators import aggregates
from spindrift.operators.sets import latest_per_key
from spindrift.plans import retail
from spindrift.queries import query
from spindrift.queries.snippets import LINE_TOTAL, davg, dsum
from spindrift.session import new_dir
from spindrift.streaming.buckets import fold, read_state


@query("a01_group_having", f"""
SELECT l_returnflag, l_linestatus, {dsum('l_quantity')} AS sum_qty, {dsum('l_extendedprice')} AS sum_price,
       CAST(SUM({LINE_TOTAL}) AS DOUBLE) AS sum_net, {davg('l_quantity')} AS avg_qty, MIN(l_extendedprice) AS min_price,
       MAX(l_extendedprice) AS max_price, COUNT(*) AS n
FROM lineitem WHERE l_shipdate <= TIMESTAMP '2001-09-02' GROUP BY 1, 2 HAVING COUNT(*) > 100""")
def a01(spark, t):
    rows = t.lineitem.filter(F.col("l_shipdate") <= F.lit("2001-09-02").cast("timestamp_ntz"))
    return rows.groupBy("l_returnflag", "l_linestatus").agg(
        exact_sum("l_quantity").alias("sum_qty"), exact_sum("l_extendedprice").alias("sum_price"),
        F.sum(retail.line_total()).cast("double").alias("sum_net"), exact_avg("l_quantity").alias("avg_qty"),
        F.min("l_extendedprice").alias("min_price"), F.max("l_extendedprice").alias("max_price"),
        F.count(F.lit(1)).alias("n"),
    ).filter("n > 100")


@query("a02_global", f"""
SELECT COUNT(*) AS n, {dsum('o_totalprice')} AS total, MIN(o_totalprice) AS lo, MAX(o_totalprice) AS hi, {davg('o_totalprice')} AS mean FROM orders""")
def a02(spark, t):
    return t.orders.agg(F.count(F.lit(1)).alias("n"), exact_sum("o_totalprice").alias("total"), F.min("o_totalprice").alias("lo"),
                        F.max("o_totalprice").alias("hi"), exact_avg("o_totalprice").alias("mean"))


@query("a03_count_distinct", """
SELECT l_suppkey, COUNT(DISTINCT l_partkey) AS parts, COUNT(DISTINCT l_orderkey) AS orders FROM lineitem GROUP BY 1""")
def a03(spark, t):
    return t.lineitem.groupBy("l_suppkey").agg(F.count_distinct("l_partkey").alias("parts"),
                                               F.count_distinct("l_orderkey").alias("orders"))


@query("a04_approx_distinct")
def a04(spark, t):
    return t.lineitem.groupBy("l_returnflag").agg(F.approx_count_distinct("l_orderkey", 0.02).alias("approx_orders"))


@query("a04_sketch_error", """
SELECT l_returnflag, COUNT(DISTINCT l_orderkey) AS orders, true AS within_error FROM lineitem GROUP BY 1""")
def a04_error(spark, t):
    """The sketch beside the exact count: within four times its relative standard deviation."""
    exact = t.lineitem.groupBy("l_returnflag").agg(F.count_distinct("l_orderkey").alias("orders"))
    # apart: beside a distinct count Spark keeps a sketch for each flag and order, not for each flag
    sketch = t.lineitem.groupBy(F.col("l_returnflag").alias("flag")).agg(F.approx_count_distinct("l_orderkey", 0.02).alias("approx"))
    return exact.join(sketch, F.col("l_returnflag").eqNullSafe(F.col("flag"))).select(
        "l_returnflag", "orders", (F.abs(F.col("approx") - F.col("orders")) <= F.col("orders") * 0.08).alias("within_error"))


@query("a05_sketch_rank_error", """
SELECT event_type, COUNT(value) AS n, true AS within_error FROM events GROUP BY 1""")
def a05_error(spark, t):
    """Each sketched quantile splits the values within its rank error of 1/10,000 (and one row)."""
    points = (0.5, 0.9, 0.99)
    p = F.percentile_approx("value", F.array(*[F.lit(x) for x in points]), 10_000)
    found = t.events.groupBy("event_type").agg(p.alias("p"), F.count("value").alias("n"))
    sides = t.events.join(F.broadcast(found), "event_type")  # one row per event type
    ok = []
    for i, x in enumerate(points):
        below = F.count_if(F.col("value") < F.col("p")[i])
        upto = F.count_if(F.col("value") <= F.col("p")[i])
        slack = F.max("n") / 10_000 + 1
        ok.append((below <= F.max("n") * x + slack) & (upto >= F.max("n") * x - slack))
    return sides.groupBy("event_type").agg(F.max("n").alias("n"), (ok[0] & ok[1] & ok[2]).alias("within_error"))


@query("a05_exact_quantiles", """
SELECT event_type, quantile_disc(value, 0.5) AS p50, quantile_disc(value, 0.9) AS p90, quantile_disc(value, 0.99) AS p99 FROM events GROUP BY 1""")
def a05(spark, t):
    return aggregates.exact_quantiles(t.events, ["event_type"], "value", {"p50": 0.5, "p90": 0.9, "p99": 0.99})


@query("a05_approx_quantiles")
def a05_approx(spark, t):
    p = F.percentile_approx("value", F.array(F.lit(0.5), F.lit(0.9), F.lit(0.99)), 10_000)
    return t.events.groupBy("event_type").agg(p.alias("p")).select(
        "event_type", F.col("p")[0].alias("p50"), F.col("p")[1].alias("p90"), F.col("p")[2].alias("p99"))


@query("a06_deviation", """
SELECT event_type, round(stddev_samp(value), 6) AS sd, round(var_samp(value), 6) AS var, round(stddev_pop(value), 6) AS sd_pop FROM events GROUP BY 1""")
def a06(spark, t):
    return t.events.groupBy("event_type").agg(F.round(F.stddev_samp("value"), 6).alias("sd"), F.round(F.var_samp("value"), 6).alias("var"),
                                              F.round(F.stddev_pop("value"), 6).alias("sd_pop"))


@query("a07_conditional", """
SELECT user_id, COUNT(*) FILTER (event_type = 'purchase') AS purchases, COUNT(*) FILTER (event_type = 'error') AS errors,
       CAST(SUM(CASE WHEN event_type = 'purchase' THEN CAST(value AS DECIMAL(12,2)) ELSE 0 END) AS DOUBLE) AS spent,
       CAST(COUNT(*) FILTER (event_type = 'error') AS DOUBLE) / COUNT(*) AS error_rate
FROM events GROUP BY 1""")
def a07(spark, t):
    bought = F.col("event_type") == "purchase"
    errors = F.count_if(F.col("event_type") == "error")
    return t.events.groupBy("user_id").agg(
        F.count_if(bought).alias("purchases"), errors.alias("errors"),
        F.sum(F.when(bought, dec("value")).otherwise(F.lit(0).cast("decimal(12,2)"))).cast("double").alias("spent"),
        (errors.cast("double") / F.count(F.lit(1))).alias("error_rate"))


@query("a08_collect_sets", """
SELECT l_suppkey, array_to_string(list_sort(list(DISTINCT l_returnflag || l_linestatus)), ',') AS flags FROM lineitem GROUP BY 1""")
def a08(spark, t):
    # the set is bounded by the domain of the two flags
    codes = F.concat("l_returnflag", "l_linestatus")
    return t.lineitem.groupBy("l_suppkey").agg(F.array_join(F.sort_array(F.collect_set(codes)), ",").alias("flags"))


@query("a09_first_last", """
SELECT o_custkey, CAST(min(o_orderdate) AS VARCHAR) AS first_order, CAST(max(o_orderdate) AS VARCHAR) AS last_order,
       arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS first_key, arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS last_price
FROM orders GROUP BY 1""")
def a09(spark, t):
    position = F.struct("o_orderdate", "o_orderkey")
    return t.orders.groupBy("o_custkey").agg(
        F.min("o_orderdate").cast("string").alias("first_order"), F.max("o_orderdate").cast("string").alias("last_order"),
        F.min_by("o_orderkey", position).alias("first_key"), F.max_by("o_totalprice", position).alias("last_price"))


@query("a10_guarded_ratio", """
SELECT p_brand, CAST(SUM(CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS DECIMAL(12,2)) ELSE 0 END) AS DOUBLE)
       / nullif(CAST(SUM(CASE WHEN p_size > 5 THEN CAST(l_quantity AS DECIMAL(12,2)) ELSE 0 END) AS DOUBLE), 0) AS r
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1""")
def a10(spark, t):
    zero = F.lit(0).cast("decimal(12,2)")
    j = t.lineitem.join(t.part.select("p_partkey", "p_brand", "p_size"), F.col("l_partkey") == F.col("p_partkey"))
    return j.groupBy("p_brand").agg(ratio(
        F.sum(F.when(F.col("l_returnflag") == "R", dec("l_quantity")).otherwise(zero)),
        F.sum(F.when(F.col("p_size") > 5, dec("l_quantity")).otherwise(zero))).alias("r"))


PIVOT_SQL = """
SELECT o_orderpriority, CAST(SUM(CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(12,2)) ELSE 0 END) AS DOUBLE) AS f_total,
       CAST(SUM(CASE WHEN o_orderstatus = 'O' THEN CAST(o_totalprice AS DECIMAL(12,2)) ELSE 0 END) AS DOUBLE) AS o_total,
       CAST(SUM(CASE WHEN o_orderstatus = 'P' THEN CAST(o_totalprice AS DECIMAL(12,2)) ELSE 0 END) AS DOUBLE) AS p_total
FROM orders GROUP BY 1"""


@query("a11_pivot_api", PIVOT_SQL)
def a11(spark, t):
    # the values are given, so Spark needs no extra pass to find them
    p = t.orders.groupBy("o_orderpriority").pivot("o_orderstatus", ["F", "O", "P"]).agg(F.sum(dec("o_totalprice")))
    return p.select("o_orderpriority", *[F.coalesce(F.col(s).cast("double"), F.lit(0.0)).alias(f"{s.lower()}_total") for s in "FOP"])


@query("a11_pivot_discovered", PIVOT_SQL)
def a11_discovered(spark, t):
    p = t.orders.groupBy("o_orderpriority").pivot("o_orderstatus").agg(F.sum(dec("o_totalprice"))).fillna(0)
    return p.select("o_orderpriority", *[F.col(s).cast("double").alias(f"{s.lower()}_total") for s in "FOP"])


@query("a11_pivot_sql", PIVOT_SQL)
def a11_sql(spark, t):
    t.views("orders")
    return spark.sql("""
        SELECT o_orderpriority, CAST(coalesce(f, 0) AS DOUBLE) AS f_total, CAST(coalesce(o, 0) AS DOUBLE) AS o_total,
               CAST(coalesce(p, 0) AS DOUBLE) AS p_total
        FROM (SELECT o_orderpriority, o_orderstatus, CAST(o_totalprice AS DECIMAL(12,2)) AS v FROM orders)
        PIVOT (SUM(v) FOR o_orderstatus IN ('F' AS f, 'O' AS o, 'P' AS p))""")


UNPIVOT_SQL = """
SELECT l_returnflag, measure, CAST(SUM(CAST(v AS DECIMAL(12,2))) AS DOUBLE) AS total
FROM (SELECT l_returnflag, 'quantity' AS measure, l_quantity AS v FROM lineitem UNION ALL SELECT l_returnflag, 'price', l_extendedprice FROM lineitem)
GROUP BY 1, 2"""


@query("a12_unpivot_api", UNPIVOT_SQL)
def a12(spark, t):
    wide = t.lineitem.select("l_returnflag", F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("price"))
    return wide.unpivot(["l_returnflag"], ["quantity", "price"], "measure", "v").groupBy("l_returnflag", "measure").agg(
        exact_sum("v").alias("total"))


@query("a12_unpivot_sql", UNPIVOT_SQL)
def a12_sql(spark, t):
    t.views("lineitem")
    return spark.sql("""
        SELECT l_returnflag, measure, CAST(SUM(CAST(v AS DECIMAL(12,2))) AS DOUBLE) AS total
        FROM (SELECT l_returnflag, l_quantity AS quantity, l_extendedprice AS price FROM lineitem)
        UNPIVOT (v FOR measure IN (quantity, price)) GROUP BY 1, 2""")


@query("a12_stack", UNPIVOT_SQL)
def a12_stack(spark, t):
    tall = t.lineitem.selectExpr("l_returnflag", "stack(2, 'quantity', l_quantity, 'price', l_extendedprice) AS (measure, v)")
    return tall.groupBy("l_returnflag", "measure").agg(exact_sum("v").alias("total"))


STATS_SQL = f"""
SELECT user_id, COUNT(value) AS n, {davg('value')} AS mean_value, round(stddev_samp(value), 4) AS stddev_value,
       MIN(value) AS min_value, MAX(value) AS max_value, CAST(min(ts) AS VARCHAR) AS first_seen, CAST(max(ts) AS VARCHAR) AS last_seen,
       arg_max(value, (ts, event_id)) AS last_value
FROM events GROUP BY 1"""


@query("a13_mergeable_stats", STATS_SQL)
def a13(spark, t):
    """Statistics of two halves, merged; equal to one pass over everything."""
    def half(pred):
        return aggregates.running_stats(t.events.filter(pred), ["user_id"], "value", "ts", "event_id")

    cut = "ts < TIMESTAMP_NTZ '2024-01-15 00:00:00'"
    merged = aggregates.merge_stats(half(cut), half(f"NOT ({cut})"), ["user_id"])
    return aggregates.read_stats(merged, ["user_id"]).withColumns({
        "stddev_value": F.round("stddev_value", 4), "first_seen": F.col("first_seen").cast("string"),
        "last_seen": F.col("last_seen").cast("string")})


@query("a14_aggregate_of_aggregate", """
WITH c AS (SELECT o_custkey, COUNT(*) AS n, SUM(CAST(o_totalprice AS DECIMAL(12,2))) AS spend FROM orders GROUP BY 1)
SELECT n AS orders, COUNT(*) AS customers, CAST(SUM(spend) AS DOUBLE) / COUNT(*) AS mean_spend FROM c GROUP BY 1""")
def a14(spark, t):
    per = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.sum(dec("o_totalprice")).alias("spend"))
    return per.groupBy(F.col("n").alias("orders")).agg(F.count(F.lit(1)).alias("customers"),
                                                       (F.sum("spend").cast("double") / F.count(F.lit(1))).alias("mean_spend"))


@query("a15_latest_per_key", """
SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type, arg_max(value, (ts, event_id)) AS value FROM events GROUP BY 1""")
def a15(spark, t):
    return latest_per_key(t.events, ["user_id"], ["ts", "event_id"], ["event_type", "value"])


@query("a16_time_buckets", f"""
SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H') AS hour, COUNT(*) AS n, {dsum('value')} AS total FROM events GROUP BY 1""")
def a16(spark, t):
    hour = F.date_format(F.date_trunc("hour", "ts"), "yyyy-MM-dd HH")
    return t.events.groupBy(hour.alias("hour")).agg(F.count(F.lit(1)).alias("n"), exact_sum("value").alias("total"))


@query("a16_month_and_window", f"""
SELECT strftime(o_orderdate, '%Y-%m') AS month, COUNT(*) AS n, {dsum('o_totalprice')} AS total FROM orders GROUP BY 1""")
def a16_month(spark, t):
    return t.orders.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(
        F.count(F.lit(1)).alias("n"), exact_sum("o_totalprice").alias("total"))


@query("a17_view_refresh", f"""
SELECT event_type, COUNT(value) AS n, {davg('value')} AS mean_value, MAX(value) AS max_value FROM events GROUP BY 1""")
def a17(spark, t):
    """A stored summary brought up to date by the summary of the new rows only."""
    path = new_dir(spark, "a17")
    keys = ["event_type"]
    early = t.events.filter("ts < TIMESTAMP_NTZ '2024-01-20 00:00:00'")
    late = t.events.filter("ts >= TIMESTAMP_NTZ '2024-01-20 00:00:00'")
    for load, rows in enumerate((early, late)):
        news = aggregates.running_stats(rows, keys, "value", "ts", "event_id")
        fold(news, path, keys, load, lambda old, new: aggregates.merge_stats(old, new, keys))
    return aggregates.read_stats(read_state(spark, path), keys).select("event_type", "n", "mean_value", "max_value")


@query("a17_view_recompute", f"""
SELECT event_type, COUNT(value) AS n, {davg('value')} AS mean_value, MAX(value) AS max_value FROM events GROUP BY 1""")
def a17_recompute(spark, t):
    path = new_dir(spark, "a17full")
    full = aggregates.running_stats(t.events, ["event_type"], "value", "ts", "event_id")
    full.write.mode("overwrite").parquet(path)
    return aggregates.read_stats(spark.read.parquet(path), ["event_type"]).select("event_type", "n", "mean_value", "max_value")


def _cents_by_type(batch: pd.DataFrame) -> pd.DataFrame:
    cents = (batch["value"] * 100).round().astype("int64")
    g = cents.groupby(batch["event_type"]).agg(["size", "sum", "max"]).reset_index()
    return g.set_axis(["event_type", "n", "cents", "top"], axis=1)


@query("a18_grouped_pandas", """
SELECT event_type, COUNT(*) AS n, CAST(SUM(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents, MAX(CAST(round(value * 100) AS BIGINT)) AS top
FROM events GROUP BY 1""")
def a18(spark, t):
    return aggregates.pandas_aggregate(
        t.events.select("event_type", "value"), ["event_type"], _cents_by_type, "event_type string, n long, cents long, top long",
        [F.sum("n").alias("n"), F.sum("cents").alias("cents"), F.max("top").alias("top")])
