"""Joins (JN)."""

from pyspark.sql import functions as F

from spindrift.functions.numeric import dec
from spindrift.operators import graph, joins
from spindrift.operators.windows import chunked_window
from spindrift.plans.report import operators_of, plan_text
from spindrift.queries import query
from spindrift.queries.jobs import accounts
from spindrift.queries.snippets import DEVICE, LINKS, NETWORK, TRAVEL, dsum
from spindrift.sources.synthetic import skewed_key
from spindrift.streaming.runner import result_of, table_stream


@query("jn01_inner", """
SELECT o_orderpriority, COUNT(*) AS lines, COUNT(DISTINCT l_orderkey) AS orders FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""")
def jn01(spark, t):
    joined = t.lineitem.select("l_orderkey").join(t.orders.select("o_orderkey", "o_orderpriority"),
                                                  F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("lines"), F.count_distinct("l_orderkey").alias("orders"))


def _outer(how):
    def run(spark, t):
        orders = t.orders.select("o_orderkey", "o_custkey")
        return t.customer.select("c_custkey", "c_mktsegment").join(orders, F.col("c_custkey") == F.col("o_custkey"), how).select(
            F.coalesce(F.col("c_custkey").cast("string"), F.lit("none")).alias("customer"),
            F.coalesce("c_mktsegment", F.lit("none")).alias("segment"),
            F.coalesce(F.col("o_orderkey").cast("string"), F.lit("none")).alias("order_no"))
    return run


for _how, _sql in (("left", "LEFT"), ("right", "RIGHT"), ("full", "FULL")):
    query(f"jn02_{_how}_outer", f"""
SELECT coalesce(CAST(c_custkey AS VARCHAR), 'none') AS customer, coalesce(c_mktsegment, 'none') AS segment,
       coalesce(CAST(o_orderkey AS VARCHAR), 'none') AS order_no
FROM customer {_sql} JOIN orders ON c_custkey = o_custkey""")(_outer(_how))


@query("jn03_semi", """
SELECT c_mktsegment, COUNT(*) AS customers FROM customer
WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey) GROUP BY 1""")
def jn03(spark, t):
    return t.customer.join(t.orders.select("o_custkey"), F.col("c_custkey") == F.col("o_custkey"), "left_semi").groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("customers"))


@query("jn04_anti", """
SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)""")
def jn04(spark, t):
    return t.customer.join(t.orders.select("o_custkey"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey", "c_name")


@query("jn05_replicate", """
SELECT c_mktsegment, role, COUNT(*) AS n, CAST(SUM(CASE WHEN role = 'auditor' THEN 0 ELSE CAST(c_acctbal AS DECIMAL(12,2)) END) AS DOUBLE) AS visible
FROM customer CROSS JOIN (VALUES ('admin'), ('analyst'), ('auditor')) AS r(role) GROUP BY 1, 2""")
def jn05(spark, t):
    rows = joins.replicate(t.customer.select("c_mktsegment", "c_acctbal"), "role", ["admin", "analyst", "auditor"])
    value = F.when(F.col("role") == "auditor", F.lit(0).cast("decimal(12,2)")).otherwise(dec("c_acctbal"))
    return rows.groupBy("c_mktsegment", "role").agg(F.count(F.lit(1)).alias("n"), F.sum(value).cast("double").alias("visible"))


@query("jn06_natural_and_expression", """
WITH a AS (SELECT n_nationkey AS k, n_name, n_regionkey FROM nation), b AS (SELECT c_nationkey AS k, c_custkey FROM customer)
SELECT n_name, COUNT(*) AS customers FROM a NATURAL JOIN b JOIN region ON n_regionkey = r_regionkey AND r_name <> 'ASIA' GROUP BY 1""")
def jn06(spark, t):
    t.views("nation", "customer", "region")
    return spark.sql("""
        WITH a AS (SELECT n_nationkey AS k, n_name, n_regionkey FROM nation),
             b AS (SELECT c_nationkey AS k, c_custkey FROM customer)
        SELECT n_name, COUNT(*) AS customers
        FROM a NATURAL JOIN b JOIN region ON n_regionkey = r_regionkey AND r_name <> 'ASIA'
        GROUP BY n_name""")


@query("jn07_star_join", """
SELECT r_name, p_brand, strftime(o_orderdate, '%Y') AS year, COUNT(*) AS lines,
       CAST(SUM(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) AS revenue
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
GROUP BY 1, 2, 3""")
def jn07(spark, t):
    fact = t.lineitem.select("l_orderkey", "l_partkey", "l_extendedprice")
    orders = t.orders.select("o_orderkey", "o_custkey", F.date_format("o_orderdate", "yyyy").alias("year"))
    j = fact.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    j = joins.dim_join(j, t.part.select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    j = joins.dim_join(j, t.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    j = joins.dim_join(j, t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    j = joins.dim_join(j, t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return j.groupBy("r_name", "p_brand", "year").agg(
        F.count(F.lit(1)).alias("lines"), F.sum(dec("l_extendedprice")).cast("double").alias("revenue"))


@query("jn08_denormalise", """
SELECT o_orderkey, o_orderstatus, c_name, c_mktsegment, n_name, r_name
FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""")
def jn08(spark, t):
    j = joins.dim_join(t.orders, t.customer, F.col("o_custkey") == F.col("c_custkey"), "left")
    j = joins.dim_join(j, t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    j = joins.dim_join(j, t.region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return j.select("o_orderkey", "o_orderstatus", "c_name", "c_mktsegment", "n_name", "r_name")


@query("jn09_self_range_join", f"""
WITH {TRAVEL} SELECT user_id, COUNT(*) AS arrivals, min(travel_seconds) AS fastest, COUNT(DISTINCT place_to) AS places FROM travel GROUP BY 1""")
def jn09(spark, t):
    near = joins.nearest_other_place(t.events, "user_id", "event_type", "ts", "event_id", 1800)
    return near.groupBy("user_id").agg(F.count(F.lit(1)).alias("arrivals"), F.min("travel_seconds").alias("fastest"),
                                       F.count_distinct("place_to").alias("places"))


@query("jn10_shared_attribute", f"WITH {LINKS} SELECT * FROM links")
def jn10(spark, t):
    return graph.link_counts(accounts(t), "c_custkey", ["device", "network"])


@query("jn10_shared_attribute_edges", f"""
WITH acc AS (SELECT c_custkey, {DEVICE} AS device, {NETWORK} AS network FROM customer),
val AS (SELECT c_custkey, 'device' AS link_type, CAST(device AS VARCHAR) AS shared_value FROM acc WHERE device IS NOT NULL
        UNION ALL SELECT c_custkey, 'network', CAST(network AS VARCHAR) FROM acc WHERE network IS NOT NULL),
hub AS (SELECT link_type, shared_value, min(c_custkey) AS src FROM val GROUP BY ALL HAVING COUNT(*) > 1)
SELECT src, c_custkey AS dst, link_type, shared_value FROM val JOIN hub USING (link_type, shared_value) WHERE src <> c_custkey""")
def jn10_edges(spark, t):
    return graph.shared_attribute_edges(accounts(t), "c_custkey", ["device", "network"])


@query("jn11_interval_join", """
WITH v AS (
  SELECT user_id, ts AS start_ts, event_type AS state, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS end_ts
  FROM events WHERE event_type IN ('signup', 'error')
)
SELECT e.event_id, state, CAST(start_ts AS VARCHAR) AS since
FROM events e JOIN v ON e.user_id = v.user_id AND e.ts >= start_ts AND (end_ts IS NULL OR e.ts < end_ts)
WHERE e.event_type = 'purchase'""")
def jn11(spark, t):
    marks = t.events.filter(F.col("event_type").isin("signup", "error")).select("user_id", "ts", "event_id", "event_type")
    versions = chunked_window(marks, ["user_id"], ["ts", "event_id"], lead={"end_ts": "ts"}).select(
        "user_id", F.col("ts").alias("start_ts"), "end_ts", F.col("event_type").alias("state"))
    facts = t.events.filter("event_type = 'purchase'").select("event_id", "user_id", "ts")
    return joins.interval_join(facts, versions, "user_id", "ts", "start_ts", "end_ts").select(
        "event_id", "state", F.col("start_ts").cast("string").alias("since"))


@query("jn12_broadcast_hint", """
SELECT n_name, COUNT(*) AS suppliers, CAST(SUM(CAST(s_acctbal AS DECIMAL(12,2))) AS DOUBLE) AS balance
FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 1""")
def jn12(spark, t):
    return joins.dim_join(t.supplier, t.nation, F.col("s_nationkey") == F.col("n_nationkey")).groupBy("n_name").agg(
        F.count(F.lit(1)).alias("suppliers"), F.sum(dec("s_acctbal")).cast("double").alias("balance"))


# fixed values: hint names and the operators they lead to
STRATEGIES = {"broadcast": "BroadcastHashJoin", "merge": "SortMergeJoin", "shuffle_hash": "ShuffledHashJoin"}


@query("jn13_strategy_matrix", """
WITH r AS (SELECT COUNT(*) AS n, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS sales
           FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey)
SELECT strategy, operator, n, sales FROM r,
 (VALUES ('broadcast', 'BroadcastHashJoin'), ('merge', 'SortMergeJoin'), ('shuffle_hash', 'ShuffledHashJoin')) AS s(strategy, operator)""")
def jn13(spark, t):
    """All order lines with the nation of their supplier, joined by each hash or merge strategy, with the operator found in the plan; the side that
    is broadcast has a fixed list of keys."""
    nations = t.nation.select("n_nationkey")
    lines = t.lineitem.select("l_suppkey", "l_extendedprice").join(t.supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
    out = None
    for name in STRATEGIES:
        j = lines.join(nations.hint(name), F.col("s_nationkey") == F.col("n_nationkey"))
        used = operators_of(plan_text(j))
        top = next((o for o in used if o in STRATEGIES.values()), "other")  # the plan lists the last join first
        one = j.agg(F.count(F.lit(1)).alias("n"), F.sum(dec("l_extendedprice")).cast("double").alias("sales")).select(
            F.lit(name).alias("strategy"), F.lit(top).alias("operator"), "n", "sales")
        out = one if out is None else out.unionByName(one)
    return out


@query("jn14_preaggregated_join", """
SELECT s_suppkey, s_name, COUNT(*) AS lines, CAST(SUM(CAST(l_quantity AS DECIMAL(12,2))) AS DOUBLE) AS units
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2""")
def jn14(spark, t):
    fact = t.lineitem.withColumnRenamed("l_suppkey", "s_suppkey")
    return joins.preagg_join(fact, t.supplier.select("s_suppkey", "s_name"), "s_suppkey", F.count(F.lit(1)).alias("lines"),
                             F.sum(dec("l_quantity")).cast("double").alias("units"))


SKEW = "CASE WHEN l_orderkey % 100 < 80 THEN 1 WHEN l_orderkey % 100 < 90 THEN 2 ELSE l_partkey END"
SKEW_SQL = f"""
SELECT p_brand, COUNT(*) AS lines, {dsum('l_quantity')} AS units
FROM (SELECT {SKEW} AS k, l_quantity FROM lineitem) JOIN part ON k = p_partkey GROUP BY 1"""


def skewed_lines(t):
    """Order lines of which 80 % carry one part key and 10 % another."""
    key = skewed_key(F.col("l_orderkey") % 100, [(1, 80), (2, 10)], F.col("l_partkey"))
    return t.lineitem.select(key.cast("bigint").alias("p_partkey"), "l_orderkey", "l_linenumber", "l_quantity")


def _by_brand(j):
    return j.groupBy("p_brand").agg(F.count(F.lit(1)).alias("lines"), F.sum(dec("l_quantity")).cast("double").alias("units"))


@query("jn15_salted_join", SKEW_SQL)
def jn15(spark, t):
    return _by_brand(joins.salted_join(skewed_lines(t), t.part.select("p_partkey", "p_brand"), "p_partkey", 16))


@query("jn16_hot_key_join", SKEW_SQL)
def jn16(spark, t):
    return _by_brand(joins.hot_key_join(skewed_lines(t), t.part.select("p_partkey", "p_brand"), "p_partkey", 0.05, 16))


@query("jn17_dedup_before_join", """
WITH d AS (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem)
SELECT s_name, COUNT(*) AS parts FROM d JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1""")
def jn17(spark, t):
    pairs = t.lineitem.select("l_partkey", "l_suppkey").dropDuplicates(["l_partkey", "l_suppkey"])
    return pairs.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).groupBy("s_name").agg(F.count(F.lit(1)).alias("parts"))


@query("jn18_stream_static", """
SELECT event_id, user_id, coalesce(c_mktsegment, 'unknown') AS segment FROM events LEFT JOIN customer ON user_id = c_custkey""")
def jn18(spark, t):
    stream = table_stream(t, "events")
    j = joins.dim_join(stream, t.customer.select("c_custkey", "c_mktsegment"), F.col("user_id") == F.col("c_custkey"), "left")
    return result_of(j.select("event_id", "user_id", F.coalesce("c_mktsegment", F.lit("unknown")).alias("segment")), "jn18")


@query("jn19_stream_stream", """
SELECT o_orderkey, CAST(o_orderdate AS VARCHAR) AS ordered, l_partkey, l_linenumber, CAST(l_shipdate AS VARCHAR) AS shipped
FROM orders JOIN lineitem ON l_orderkey = o_orderkey AND l_shipdate >= o_orderdate AND l_shipdate <= o_orderdate + INTERVAL 30 DAY""")
def jn19(spark, t):
    from spindrift.streaming.runner import event_time
    from spindrift.streaming.windows import time_bounded_join

    o = event_time(table_stream(t, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate", "30 days")
    l = event_time(table_stream(t, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_shipdate"), "l_shipdate", "30 days")
    j = time_bounded_join(o, l, F.col("o_orderkey") == F.col("l_orderkey"), "o_orderdate", "l_shipdate", "30 DAYS")
    return result_of(j.select("o_orderkey", F.col("o_orderdate").cast("string").alias("ordered"), "l_partkey", "l_linenumber",
                              F.col("l_shipdate").cast("string").alias("shipped")), "jn19")


@query("jn20_referential_check", """
SELECT l_returnflag, COUNT(*) AS orphans FROM lineitem
WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 10) GROUP BY 1""")
def jn20(spark, t):
    lost = joins.orphans(t.lineitem.select("l_partkey", "l_returnflag"), t.part.filter("p_size > 10"), "l_partkey", "p_partkey")
    return lost.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("orphans"))
