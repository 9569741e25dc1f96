"""Analytic jobs (O)."""

from pyspark.sql import functions as F

from spindrift.operators import graph, text, vector
from spindrift.plans import customer360, fraud, iot, ops, report, retail
from spindrift.queries import query
from spindrift.queries.snippets import (
    DEVICE, LINE_TOTAL, LINKS, NETWORK, SALES, TRAILING_30D, TRAVEL, VELOCITY, WORDS, davg, dsum,
)
from spindrift.session import written

DAY = fraud.DAY


def accounts(t):
    """Customers with two attributes that several of them share."""
    return t.customer.select(
        "c_custkey",
        F.floor("c_acctbal").cast("bigint").alias("device"),
        (F.col("c_nationkey").cast("bigint") * 1000 + F.floor(F.col("c_acctbal") / 200).cast("bigint")).alias("network"),
    )


EVENT = dict(key="user_id", ts="ts", amount="value", place="event_type", row_id="event_id")
ACCOUNT = dict(account="c_custkey", attributes=["device", "network"])


def readings(t):
    """Events as sensor readings beside the normal range of their type."""
    return iot.with_ranges(t.events, t.events, "event_type", "value")


RANGES = f"""
ranges AS (SELECT event_type, 0.0 AS normal_min, ({davg('value')}) * 2 AS normal_max FROM events GROUP BY event_type),
marked AS (
  SELECT e.event_id, e.user_id, e.event_type, e.ts, e.value, normal_max / 2.0 AS baseline_mean, normal_max / 6.0 AS baseline_std,
         e.value - normal_max / 2.0 AS deviation,
         round(abs(e.value - normal_max / 2.0) / (normal_max / 6.0), 2) AS deviation_sigma
  FROM events e JOIN ranges USING (event_type)
),
alerts AS (
  SELECT *, CASE WHEN deviation_sigma > 5 THEN 'CRITICAL' WHEN deviation_sigma > 4 THEN 'HIGH'
                 WHEN deviation_sigma > 3 THEN 'MEDIUM' ELSE 'LOW' END AS severity
  FROM marked WHERE abs(deviation) > baseline_std * 3
)"""


@query("o01_sensor_anomaly", f"""
WITH {RANGES}
SELECT event_id, user_id, event_type, value, baseline_mean, baseline_std, deviation_sigma, severity,
       '[' || severity || '] ' || event_type || ' anomaly on ' || user_id AS alert_message
FROM alerts""")
def o01(spark, t):
    return iot.mark_anomalies(readings(t), "value", "user_id", "event_type").filter("is_anomaly").select(
        "event_id", "user_id", "event_type", "value", "baseline_mean", "baseline_std", "deviation_sigma", "severity",
        "alert_message")


@query("o02_velocity_alerts", f"""
WITH {VELOCITY}
SELECT event_id, user_id, recent_n FROM vel WHERE recent_n > 5""")
def o02(spark, t):
    return fraud.velocity_alerts(t.events, "user_id", "ts", DAY, 5, 6 * 3600).select("event_id", "user_id", "recent_n")


@query("o03_amount_anomaly", f"""
WITH {TRAILING_30D}
SELECT event_id, user_id, value, past_avg, round(past_stddev, 4) AS past_stddev, amount_ratio, round(z_score, 4) AS z_score
FROM flagged WHERE amount_alert AND past_avg IS NOT NULL""")
def o03(spark, t):
    return fraud.amount_scores(t.events, "user_id", "ts", "value").filter("amount_alert AND past_avg IS NOT NULL").select(
        "event_id", "user_id", "value", "past_avg", F.round("past_stddev", 4).alias("past_stddev"), "amount_ratio",
        F.round("z_score", 4).alias("z_score"))


@query("o04_amount_jump", f"""
WITH p AS (
  SELECT event_id, user_id, value, ts, lag(value) OVER w AS prev_amount, lag(ts) OVER w AS prev_ts
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
)
SELECT event_id, user_id, value, prev_amount, value / nullif(prev_amount, 0) AS amount_jump,
       (CAST(floor(epoch(ts)) AS BIGINT) - CAST(floor(epoch(prev_ts)) AS BIGINT)) / 60.0 AS minutes_gap
FROM p
WHERE value / nullif(prev_amount, 0) > 5
  AND (CAST(floor(epoch(ts)) AS BIGINT) - CAST(floor(epoch(prev_ts)) AS BIGINT)) / 60.0 < 60""")
def o04(spark, t):
    return fraud.jumps(t.events, "user_id", "ts", "event_id", "value").select(
        "event_id", "user_id", "value", "prev_amount", "amount_jump", "minutes_gap")


@query("o05_impossible_travel", f"""
WITH {TRAVEL}
SELECT user_id, from_id, to_id, place_from, place_to, CAST(departure_time AS VARCHAR) AS departure_time,
       CAST(arrival_time AS VARCHAR) AS arrival_time, travel_seconds FROM travel""")
def o05(spark, t):
    return fraud.travel(t.events, "user_id", "event_type", "ts", "event_id").withColumns({
        "departure_time": F.col("departure_time").cast("string"), "arrival_time": F.col("arrival_time").cast("string")})


@query("o06_linkage_rings", f"""
WITH {LINKS}
SELECT *, CASE WHEN link_count >= 5 THEN 'HIGH_RISK_RING' WHEN link_count >= 3 THEN 'MEDIUM_RISK_RING'
               ELSE 'LOW_RISK_RING' END AS risk_category
FROM links WHERE link_count >= 2""")
def o06(spark, t):
    return fraud.linkage(accounts(t), "c_custkey", ["device", "network"])


@query("o07_components", f"""
WITH RECURSIVE acc AS (SELECT c_custkey, {DEVICE} AS device, {NETWORK} AS network FROM customer),
star AS (
  SELECT m.hub AS a, acc.c_custkey AS b
  FROM acc JOIN (SELECT device, min(c_custkey) AS hub FROM acc GROUP BY device) m USING (device) WHERE hub <> c_custkey
  UNION
  SELECT m.hub, acc.c_custkey
  FROM acc JOIN (SELECT network, min(c_custkey) AS hub FROM acc GROUP BY network) m USING (network) WHERE hub <> c_custkey
),
edges AS (SELECT a, b FROM star UNION SELECT b, a FROM star),
reach AS (
  SELECT DISTINCT a AS node, a AS other FROM edges
  UNION SELECT r.node, e.b FROM reach r JOIN edges e ON e.a = r.other
)
SELECT node, min(other) AS component FROM reach GROUP BY node""")
def o07(spark, t):
    return graph.components(graph.shared_attribute_edges(accounts(t), "c_custkey", ["device", "network"]))


@query("o08_composite_risk", f"""
WITH {VELOCITY}, {TRAILING_30D}, {TRAVEL}, {LINKS},
s AS (
  SELECT v.user_id, least(max_velocity * 8.0, 100) AS velocity_score,
         least((coalesce(max_ratio, 0) - 1) * 15.0, 100) AS amount_score,
         CASE WHEN min_travel IS NULL THEN 0.0 ELSE least(CAST(1800 AS DOUBLE) / greatest(min_travel, 1) * 50.0, 100) END AS geo_score,
         least(coalesce(link_count, 0) * 15.0, 100) AS linkage_score
  FROM (SELECT user_id, max(recent_n) AS max_velocity FROM vel GROUP BY user_id) v
  LEFT JOIN (SELECT user_id, max(coalesce(amount_ratio, 1)) AS max_ratio FROM flagged WHERE amount_alert GROUP BY user_id) a USING (user_id)
  LEFT JOIN (SELECT user_id, min(travel_seconds) AS min_travel FROM travel GROUP BY user_id) g USING (user_id)
  LEFT JOIN links ON c_custkey = v.user_id
)
SELECT user_id, CAST(velocity_score AS DOUBLE) AS velocity_score, CAST(amount_score AS DOUBLE) AS amount_score,
       CAST(geo_score AS DOUBLE) AS geo_score, CAST(linkage_score AS DOUBLE) AS linkage_score,
       round(velocity_score * 0.35::DOUBLE + amount_score * 0.30::DOUBLE + geo_score * 0.20::DOUBLE + linkage_score * 0.15::DOUBLE, 6) AS composite_risk,
       CASE WHEN velocity_score * 0.35::DOUBLE + amount_score * 0.30::DOUBLE + geo_score * 0.20::DOUBLE + linkage_score * 0.15::DOUBLE >= 75 THEN 'CRITICAL'
            WHEN velocity_score * 0.35::DOUBLE + amount_score * 0.30::DOUBLE + geo_score * 0.20::DOUBLE + linkage_score * 0.15::DOUBLE >= 50 THEN 'HIGH'
            WHEN velocity_score * 0.35::DOUBLE + amount_score * 0.30::DOUBLE + geo_score * 0.20::DOUBLE + linkage_score * 0.15::DOUBLE >= 25 THEN 'MEDIUM'
            ELSE 'LOW' END AS risk_tier
FROM s""")
def o08(spark, t):
    return fraud.composite_risk(t.events, accounts(t), **EVENT, **ACCOUNT, velocity_seconds=DAY).withColumn(
        "composite_risk", F.round("composite_risk", 6))


CASES = f"""{VELOCITY}, {TRAILING_30D}, {TRAVEL}, {LINKS},
cases AS (
  SELECT 'CASE_VEL_' || user_id AS case_id, user_id AS account_id, 'VELOCITY' AS detection_type,
         CAST(least(max(recent_n) * 15.0, 100) AS DOUBLE) AS risk_score, 'OPEN' AS status,
         COUNT(*) AS evidence_rows, min(event_id) AS first_evidence, max(event_id) AS last_evidence
  FROM vel WHERE recent_n > 5 GROUP BY user_id
  UNION ALL
  SELECT 'CASE_AMT_' || user_id, user_id, 'AMOUNT', least((max(amount_ratio) - 1) * 20, 100), 'OPEN',
         COUNT(*), min(event_id), max(event_id) FROM flagged WHERE amount_alert AND past_avg IS NOT NULL GROUP BY user_id
  UNION ALL
  SELECT 'CASE_GEO_' || user_id, user_id, 'GEO', CAST(least(COUNT(*) * 25.0, 100) AS DOUBLE), 'OPEN',
         COUNT(*), min(to_id), max(to_id) FROM travel GROUP BY user_id
  UNION ALL
  SELECT 'CASE_LNK_' || c_custkey, c_custkey, 'LINKAGE', CAST(least(link_count * 20.0, 100) AS DOUBLE), 'OPEN',
         1, c_custkey, c_custkey FROM links WHERE link_count >= 2
)"""
OPENED, LATER = "2024-02-01 00:00:00", "2024-02-02 00:00:00"
NOTE = "detection_type || ': ' || evidence_rows || ' evidence rows'"


@query("o09_fraud_cases", f"WITH {CASES} SELECT *, {NOTE} AS notes, '{OPENED}' AS created_at, '{OPENED}' AS updated_at FROM cases")
def o09(spark, t):
    found = fraud.cases(t.events, accounts(t), **EVENT, **ACCOUNT, velocity_seconds=DAY, opened=OPENED)
    return found.withColumns({c: F.col(c).cast("string") for c in ("created_at", "updated_at")})


@query("o09_case_escalation", f"""
WITH {CASES},
fresh AS (SELECT DISTINCT user_id FROM vel WHERE recent_n > 4 AND user_id NOT IN (SELECT account_id FROM cases WHERE detection_type = 'VELOCITY'))
SELECT case_id, account_id, detection_type,
       CASE WHEN risk_score > 50 THEN least(risk_score * 1.1::DOUBLE, 100) ELSE risk_score END AS risk_score,
       CASE WHEN risk_score > 50 THEN 'INVESTIGATING' ELSE status END AS status,
       {NOTE} || CASE WHEN risk_score > 50 THEN '; escalated' ELSE '' END AS notes, '{OPENED}' AS created_at,
       CASE WHEN risk_score > 50 THEN '{LATER}' ELSE '{OPENED}' END AS updated_at
FROM cases
UNION ALL
SELECT 'CASE_VEL_NEW_' || user_id, user_id, 'VELOCITY', 75.0, 'OPEN', 'opened by a later alert', '{LATER}', '{LATER}' FROM fresh""")
def o09_escalate(spark, t):
    table = written(fraud.cases(t.events, accounts(t), **EVENT, **ACCOUNT, velocity_seconds=DAY, opened=OPENED), "cases")
    again = fraud.velocity_alerts(t.events, "user_id", "ts", DAY, 4)
    return fraud.escalate(table, again, "user_id", LATER).select(
        "case_id", "account_id", "detection_type", "risk_score", "status", "notes", *[F.col(c).cast("string").alias(c) for c in ("created_at", "updated_at")])


@query("o09_case_evidence", f"""
WITH {VELOCITY}, {TRAILING_30D}, {TRAVEL}
SELECT 'CASE_VEL_' || user_id AS case_id, event_id AS event FROM vel WHERE recent_n > 5
UNION SELECT 'CASE_AMT_' || user_id, event_id FROM flagged WHERE amount_alert
UNION SELECT 'CASE_GEO_' || user_id, from_id FROM travel
UNION SELECT 'CASE_GEO_' || user_id, to_id FROM travel""")
def o09_evidence(spark, t):
    return fraud.case_evidence(t.events, **EVENT, velocity_seconds=DAY)


@query("o10_correlated_anomalies", f"""
WITH a AS (SELECT user_id, ts, event_id FROM events WHERE event_type = 'error' AND value > 40),
b AS (SELECT user_id, ts, event_id FROM events WHERE event_type = 'purchase' AND value > 40),
j AS (
  SELECT b.user_id, b.event_id AS right_event_id, b.ts AS right_ts, a.event_id AS left_event_id, a.ts AS left_ts,
         row_number() OVER (PARTITION BY b.event_id ORDER BY a.ts DESC, a.event_id DESC) AS rn,
         COUNT(*) OVER (PARTITION BY b.event_id) AS matches
  FROM b JOIN a ON a.user_id = b.user_id AND a.ts <= b.ts
   AND CAST(floor(epoch(b.ts)) AS BIGINT) - CAST(floor(epoch(a.ts)) AS BIGINT) <= 7200
)
SELECT user_id, left_event_id, right_event_id, CAST(left_ts AS VARCHAR) AS left_ts, CAST(right_ts AS VARCHAR) AS right_ts, matches
FROM j WHERE rn = 1""")
def o10(spark, t):
    return iot.correlated(t.events, "user_id", "ts", "event_id", "event_type = 'error' AND value > 40",
                          "event_type = 'purchase' AND value > 40", 7200).withColumns({
        "left_ts": F.col("left_ts").cast("string"), "right_ts": F.col("right_ts").cast("string")})


@query("o11_daily_sales", f"""
SELECT strftime(o_orderdate, '%Y-%m-%d') AS order_date, COUNT(DISTINCT l_orderkey) AS total_orders, {dsum('l_quantity')} AS total_units,
       CAST(SUM({LINE_TOTAL}) AS DOUBLE) AS total_revenue, CAST(SUM({LINE_TOTAL}) AS DOUBLE) / COUNT(*) AS avg_line_value,
       COUNT(DISTINCT o_custkey) AS unique_customers
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""")
def o11(spark, t):
    return retail.daily_sales(t)


@query("o11_top_products", f"""
SELECT p_partkey, p_name, p_brand, COUNT(DISTINCT l_orderkey) AS order_count, {dsum('l_quantity')} AS total_units,
       CAST(SUM({LINE_TOTAL}) AS DOUBLE) AS total_revenue,
       CAST(SUM({LINE_TOTAL} - CAST(l_quantity AS DECIMAL(12,2)) * CAST(p_retailprice AS DECIMAL(12,2))) AS DOUBLE) AS total_profit
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3""")
def o11_products(spark, t):
    return retail.top_products(t)


@query("o11_category_margin", f"""
WITH {SALES}
SELECT p_type, r_name, COUNT(DISTINCT l_orderkey) AS total_orders, {dsum('l_quantity')} AS total_units,
       CAST(SUM(line_total) AS DOUBLE) AS total_revenue, CAST(SUM(line_profit) AS DOUBLE) AS total_profit,
       CAST(SUM(line_profit) AS DOUBLE) / nullif(CAST(SUM(line_total) AS DOUBLE), 0) * 100 AS margin_pct
FROM sales GROUP BY 1, 2""")
def o11_margin(spark, t):
    return retail.category_margin(t)


@query("o11_return_rate", f"""
WITH {SALES}
SELECT r_name, COUNT(*) AS lines, COUNT(*) FILTER (l_returnflag = 'R') AS returned,
       CAST(COUNT(*) FILTER (l_returnflag = 'R') * 100 AS DOUBLE) / COUNT(*) AS return_pct
FROM sales GROUP BY 1""")
def o11_returns(spark, t):
    return retail.return_rate(t)


@query("o11_spending_bands", """
WITH c AS (SELECT o_custkey, SUM(CAST(o_totalprice AS DECIMAL(12,2))) AS spend FROM orders GROUP BY 1)
SELECT CASE WHEN spend >= 5000000 THEN 'PREMIUM' WHEN spend >= 2000000 THEN 'HIGH' WHEN spend >= 500000 THEN 'MEDIUM' ELSE 'LOW' END AS band,
       COUNT(*) AS customers, CAST(SUM(spend) AS DOUBLE) AS total_spend
FROM c GROUP BY 1""")
def o11_bands(spark, t):
    return retail.spending_bands(t)


@query("o12_lifetime_value", f"""
WITH {SALES}
SELECT o_custkey, c_mktsegment, n_name, COUNT(DISTINCT l_orderkey) AS lifetime_orders,
       CAST(SUM(line_total) AS DOUBLE) AS lifetime_revenue, CAST(SUM(line_profit) AS DOUBLE) AS lifetime_profit,
       CAST(SUM(line_total) AS DOUBLE) / COUNT(*) AS avg_line_value,
       CAST(min(order_date) AS VARCHAR) AS first_order_date, CAST(max(order_date) AS VARCHAR) AS last_order_date,
       COUNT(DISTINCT l_partkey) AS unique_products
FROM sales GROUP BY 1, 2, 3""")
def o12(spark, t):
    return retail.lifetime_value(t)


@query("o13_inventory_alert", """
WITH newest AS (SELECT max(CAST(o_orderdate AS DATE)) AS d FROM orders),
sold AS (
  SELECT l_partkey, CAST(SUM(CAST(l_quantity AS DECIMAL(12,2))) AS DOUBLE) AS units
  FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders, newest WHERE CAST(o_orderdate AS DATE) >= d - 30) GROUP BY 1
),
b AS (
  SELECT p_partkey, p_name, (p_partkey * 7) % 60 AS on_hand, p_size % 20 AS threshold, p_size * 2 AS reorder_qty,
         coalesce(units, 0) AS units_sold
  FROM part LEFT JOIN sold ON p_partkey = l_partkey
),
s AS (SELECT *, CASE WHEN on_hand = 0 THEN 'OUT_OF_STOCK' WHEN on_hand <= threshold THEN 'LOW_STOCK' ELSE 'IN_STOCK' END AS stock_status FROM b)
SELECT p_partkey, p_name, on_hand, units_sold, units_sold / 30.0::DOUBLE AS daily_rate, stock_status,
       CASE WHEN units_sold > 0 THEN on_hand / (units_sold / 30.0::DOUBLE) END AS days_until_stockout,
       CAST(CASE WHEN stock_status <> 'IN_STOCK' THEN reorder_qty ELSE 0 END AS BIGINT) AS suggested_reorder
FROM s""")
def o13(spark, t):
    return retail.inventory(t)


LOYALTY = """
loyal AS (
  SELECT c_custkey, COUNT(o_orderkey) AS order_count, coalesce(SUM(CAST(o_totalprice AS DECIMAL(12,2))), 0) AS spend
  FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1
),
tiers AS (
  SELECT c_custkey, order_count, CAST(spend AS DOUBLE) AS total_spend,
         CASE WHEN spend >= 3000000 THEN 'PLATINUM' WHEN spend >= 2000000 THEN 'GOLD' WHEN spend >= 1000000 THEN 'SILVER' ELSE 'BRONZE' END AS tier
  FROM loyal
)"""


@query("o14_loyalty_tier", f"WITH {LOYALTY} SELECT * FROM tiers")
def o14(spark, t):
    return retail.loyalty(t)


@query("o15_features_churn", """
WITH k AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01'),
g AS (
  SELECT o_custkey, COUNT(*) AS lifetime_orders, CAST(SUM(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS lifetime_value,
         date_diff('day', CAST(min(o_orderdate) AS DATE), DATE '2000-01-01') AS days_since_first,
         COUNT(DISTINCT o_orderpriority) AS priorities_used,
         date_diff('day', CAST(max(o_orderdate) AS DATE), DATE '2000-01-01') AS days_idle
  FROM k GROUP BY 1
)
SELECT *, lifetime_value / lifetime_orders AS avg_order_value,
       CASE WHEN days_idle > 90 THEN 'HIGH' WHEN days_idle > 60 THEN 'MEDIUM' ELSE 'LOW' END AS churn_risk
FROM g""")
def o15(spark, t):
    return retail.features(t, "2000-01-01")


NET = """
net AS (
  SELECT o_custkey, CAST(o_orderdate AS DATE) AS order_date, l_quantity,
         CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)) AS discount_amount,
         CAST(l_extendedprice AS DECIMAL(12,2)) - CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)) AS net_revenue
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)"""


@query("o16_net_revenue_daily", f"""
WITH {NET}
SELECT CAST(order_date AS VARCHAR) AS order_date, CAST(SUM(net_revenue) AS DOUBLE) AS net_revenue,
       CAST(SUM(discount_amount) AS DOUBLE) AS discounts, COUNT(*) AS lines, {dsum('l_quantity')} AS units
FROM net GROUP BY 1""")
def o16(spark, t):
    return retail.net_daily(t)


@query("o16_net_revenue_by_tier", f"""
WITH {NET}, {LOYALTY}
SELECT tier, CAST(SUM(net_revenue) AS DOUBLE) AS net_revenue, COUNT(DISTINCT o_custkey) AS customers,
       CAST(SUM(net_revenue) AS DOUBLE) / COUNT(*) AS avg_net_per_line
FROM net JOIN tiers ON o_custkey = c_custkey GROUP BY 1""")
def o16_tier(spark, t):
    return retail.net_by_tier(t)


@query("o17_medallion", f"""
WITH bronze AS (
  SELECT o_orderkey, o_custkey, nullif(o_orderstatus, 'P') AS status, o_totalprice, o_orderdate, 'first' AS src, 1 AS load_no FROM orders
  UNION ALL
  SELECT o_orderkey, o_custkey, o_orderstatus, -o_totalprice, o_orderdate, 'again', 2 FROM orders WHERE o_orderpriority = '1-URGENT'
),
silver AS (
  SELECT o_orderkey, o_custkey, coalesce(status, 'unknown') AS status, o_totalprice, o_orderdate,
         o_totalprice < 0 AS dq_negative, status IS NULL AS dq_no_status
  FROM (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY load_no DESC) AS rn FROM bronze) WHERE rn = 1
)
SELECT strftime(o_orderdate, '%Y-%m') AS month, c_mktsegment, COUNT(*) AS orders,
       COUNT(*) FILTER (dq_negative) AS negative, COUNT(*) FILTER (dq_no_status) AS no_status,
       CAST(SUM(CASE WHEN NOT dq_negative THEN CAST(o_totalprice AS DECIMAL(12,2)) ELSE 0 END) AS DOUBLE) AS revenue
FROM silver LEFT JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2""")
def o17(spark, t):
    return customer360.medallion(spark, t)


@query("o18_clean_transform", """
WITH s AS (
  SELECT CASE WHEN c_acctbal > 0 THEN CAST(c_acctbal AS DECIMAL(12,2)) ELSE 0 END AS amount,
         coalesce(nullif(c_name, 'Customer#000000007'), 'UNKNOWN') AS customer_id, c_mktsegment AS segment
  FROM customer
)
SELECT segment, CASE WHEN amount > 500 THEN 'high_value' WHEN amount > 100 THEN 'medium' ELSE 'low' END AS value_band,
       COUNT(*) AS transaction_count, CAST(SUM(amount) AS DOUBLE) AS total_revenue, CAST(MAX(amount) AS DOUBLE) AS max_transaction,
       COUNT(*) FILTER (customer_id = 'UNKNOWN') AS unknown_customers
FROM s GROUP BY 1, 2""")
def o18(spark, t):
    raw = t.customer.select(
        F.col("c_acctbal").alias("amount"), F.nullif("c_name", F.lit("Customer#000000007")).alias("customer_id"),
        F.lit(None).cast("string").alias("product_id"), F.col("c_mktsegment").alias("segment"))
    clean = retail.clean_sales(raw, "amount", "customer_id", "product_id")
    return clean.groupBy("segment", "value_band").agg(
        F.count(F.lit(1)).alias("transaction_count"), F.sum("amount").cast("double").alias("total_revenue"),
        F.max("amount").cast("double").alias("max_transaction"),
        F.count(F.when(F.col("customer_id") == "UNKNOWN", 1)).alias("unknown_customers"))


@query("o19_monthly_trend", f"""
WITH {SALES}, m AS (SELECT r_name, strftime(o_orderdate, '%Y-%m') AS month, SUM(line_total) AS rev FROM sales GROUP BY 1, 2)
SELECT r_name, month, CAST(rev AS DOUBLE) AS revenue,
       (CAST(rev AS DOUBLE) - CAST(lag(rev) OVER w AS DOUBLE)) * 100 / nullif(CAST(lag(rev) OVER w AS DOUBLE), 0) AS change_pct,
       CAST(SUM(rev) OVER (PARTITION BY r_name ORDER BY month ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running_revenue,
       CAST(rank() OVER (PARTITION BY month ORDER BY rev DESC) AS INTEGER) AS rank_in_month
FROM m WINDOW w AS (PARTITION BY r_name ORDER BY month)""")
def o19(spark, t):
    return retail.monthly_trend(t)


@query("o19_product_rank", f"""
WITH {SALES}, p AS (SELECT r_name, p_partkey, SUM(line_total) AS rev FROM sales GROUP BY 1, 2),
k AS (SELECT *, row_number() OVER (PARTITION BY r_name ORDER BY rev DESC, p_partkey) AS rn FROM p)
SELECT r_name, p_partkey, CAST(rev AS DOUBLE) AS revenue, CAST(rn AS INTEGER) AS rn FROM k WHERE rn <= 3""")
def o19_rank(spark, t):
    return retail.product_rank(t, 3)


@query("o20_run_metrics", f"""
SELECT event_type, COUNT(*) AS runs, COUNT(*) FILTER (value > 100) AS failures,
       CAST((COUNT(*) - COUNT(*) FILTER (value > 100)) * 100 AS DOUBLE) / COUNT(*) AS success_pct,
       {davg('value')} AS avg_duration, MAX(value) AS max_duration,
       CAST(COUNT(*) FILTER (value > 100) AS DOUBLE) / COUNT(*) > 0.13 AS alert
FROM events GROUP BY 1""")
def o20(spark, t):
    return ops.run_metrics(t.events, "event_type", F.col("value") > 100, "value", 0.13)


@query("o21_cost_share", """
WITH c AS (SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, SUM(CAST(value AS DECIMAL(12,2))) AS cost FROM events GROUP BY 1, 2)
SELECT day, event_type, CAST(cost AS DOUBLE) AS cost, CAST(cost AS DOUBLE) / CAST(SUM(cost) OVER (PARTITION BY day) AS DOUBLE) * 100 AS share_pct
FROM c""")
def o21(spark, t):
    usage = t.events.select(F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_type", "value")
    return ops.cost_share(usage, ["day", "event_type"], "value", ["day"])


@query("o21_cost_total_share", """
WITH c AS (SELECT event_type, SUM(CAST(value AS DECIMAL(12,2))) AS cost FROM events GROUP BY 1)
SELECT event_type, CAST(cost AS DOUBLE) AS cost, CAST(cost AS DOUBLE) / CAST(SUM(cost) OVER () AS DOUBLE) * 100 AS share_pct FROM c""")
def o21_total(spark, t):
    return ops.cost_share(t.events, ["event_type"], "value")


@query("o22_document_chunks", f"""
WITH w AS (SELECT doc_id, {WORDS} AS ws FROM documents WHERE regexp_matches(text, '\\S')),
n AS (SELECT *, greatest(CAST(ceil((len(ws) - 20) / 180.0) AS INTEGER) - 1, 0) AS last FROM w),
c AS (SELECT doc_id, ws, unnest(range(last + 1)) AS chunk_no FROM n)
SELECT doc_id, CAST(chunk_no AS INTEGER) AS chunk_no, CAST(len(list_slice(ws, chunk_no * 180 + 1, chunk_no * 180 + 200)) AS INTEGER) AS n_words,
       array_to_string(list_slice(ws, chunk_no * 180 + 1, chunk_no * 180 + 200), ' ') AS chunk
FROM c""")
def o22(spark, t):
    return text.chunk_text(t.documents, "doc_id", "text", 200, 20)


@query("o23_vector_top_k", """
WITH d AS (SELECT vec_id, label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
q AS (SELECT label, i, SUM(CAST(x AS DECIMAL(18,9))) AS x FROM d GROUP BY 1, 2),
p AS (
  SELECT q.label AS query_id, d.vec_id,
         SUM(CAST(q.x AS DOUBLE) * d.x) / (sqrt(SUM(CAST(q.x AS DOUBLE) * CAST(q.x AS DOUBLE))) * sqrt(SUM(CAST(d.x AS DOUBLE) * d.x))) AS cosine
  FROM q JOIN d ON q.i = d.i GROUP BY 1, 2
),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY cosine DESC, vec_id) AS rank FROM p)
SELECT query_id, vec_id, round(cosine, 6) AS cosine, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 10""")
def o23(spark, t):
    # the queries are the class sums, one vector per label
    parts = t.embeddings.select("label", F.posexplode("embedding").alias("i", "x"))
    sums = parts.groupBy("label", "i").agg(F.sum(F.col("x").cast("decimal(18,9)")).cast("double").alias("x"))
    # as many elements per label as a vector has dimensions
    queries = sums.groupBy(F.col("label").alias("query_id")).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("i", "x"))), lambda s: s["x"]).alias("embedding"))
    return vector.top_k(queries, t.embeddings, 10).withColumn("cosine", F.round("cosine", 6))


@query("o23_vector_index")
def o23_index(spark, t):
    """Ten neighbours of every vector whose id is divisible by 100 among all vectors, by centroid lists."""
    index = vector.fit_lists(t.embeddings, 10)
    built = vector.build_index(t.embeddings, index)
    asked = t.embeddings.filter("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    return vector.search(asked, built, index, 10).withColumn("cosine", F.round("cosine", 6))


@query("o24_feature_label_join", f"""
WITH lab AS (SELECT o_orderkey, o_custkey, o_orderdate FROM orders WHERE o_orderstatus = 'F'),
chg AS (
  SELECT o_custkey, o_orderdate AS feature_time, CAST(SUM(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS day_spend, COUNT(*) AS day_orders
  FROM orders GROUP BY 1, 2
),
v AS (SELECT *, lead(feature_time) OVER (PARTITION BY o_custkey ORDER BY feature_time) AS until FROM chg)
SELECT lab.o_orderkey, lab.o_custkey, CAST(feature_time AS VARCHAR) AS feature_time, day_spend, day_orders
FROM lab JOIN v ON lab.o_custkey = v.o_custkey AND lab.o_orderdate >= feature_time AND (until IS NULL OR lab.o_orderdate < until)""")
def o24(spark, t):
    return customer360.training_rows(t)


@query("o25_plan_report")
def o25(spark, t):
    return report.plan_report(retail.category_margin(t))
