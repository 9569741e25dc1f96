"""SQL fragments shared by oracle texts."""

LINE_TOTAL = "CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))"


def dsum(col: str, scale: int = 2) -> str:
    return f"CAST(SUM(CAST({col} AS DECIMAL(12,{scale}))) AS DOUBLE)"


def davg(col: str, scale: int = 2) -> str:
    return f"{dsum(col, scale)} / COUNT({col})"


SALES = f"""
sales AS (
  SELECT l.*, o.*, p.p_partkey, p.p_name, p.p_brand, p.p_type, p.p_retailprice, c.c_mktsegment, n.n_name, r.r_name,
         CAST(o_orderdate AS DATE) AS order_date,
         {LINE_TOTAL} AS line_total,
         {LINE_TOTAL} - CAST(l_quantity AS DECIMAL(12,2)) * CAST(p_retailprice AS DECIMAL(12,2)) AS line_profit
  FROM lineitem l JOIN orders o ON l_orderkey = o_orderkey
  LEFT JOIN part p ON l_partkey = p_partkey LEFT JOIN customer c ON o_custkey = c_custkey
  LEFT JOIN nation n ON c_nationkey = n_nationkey LEFT JOIN region r ON n_regionkey = r_regionkey
)"""

# epoch seconds of an event, rounded down
SEC = "CAST(floor(epoch(ts)) AS BIGINT)"

DEVICE = "CAST(floor(c_acctbal) AS BIGINT)"
NETWORK = "c_nationkey * 1000 + CAST(floor(c_acctbal / 200) AS BIGINT)"

TRAILING_30D = f"""
base AS (SELECT event_id, user_id, ts, event_type, CAST(value AS DECIMAL(12,2)) AS v, {SEC} AS s FROM events),
past AS (
  SELECT *, COUNT(*) OVER w AS n, CAST(SUM(v) OVER w AS DOUBLE) AS sm,
         CAST(SUM(CAST(v AS DECIMAL(12,2)) * CAST(v AS DECIMAL(12,2))) OVER w AS DOUBLE) AS sq
  FROM base WINDOW w AS (PARTITION BY user_id ORDER BY s RANGE BETWEEN 2592000 PRECEDING AND 1 PRECEDING)
),
amounts AS (
  SELECT event_id, user_id, ts, n, CAST(v AS DOUBLE) AS value,
         CASE WHEN n > 0 THEN sm / n END AS past_avg,
         CASE WHEN n > 1 THEN sqrt(greatest(n * sq - sm * sm, 0) / (CAST(n AS DOUBLE) * (n - 1))) END AS past_stddev
  FROM past
),
scored AS (
  SELECT *, CASE WHEN past_avg > 0 THEN value / past_avg END AS amount_ratio,
         CASE WHEN past_stddev > 0 THEN (value - past_avg) / past_stddev END AS z_score
  FROM amounts
),
flagged AS (SELECT *, coalesce(amount_ratio > 3 OR z_score > 3, false) AS amount_alert FROM scored)"""

VELOCITY = f"""
vel AS (
  SELECT event_id, user_id, ts,
         COUNT(*) OVER (PARTITION BY user_id ORDER BY {SEC} RANGE BETWEEN 86400 PRECEDING AND CURRENT ROW) AS recent_n
  FROM events
)"""

TRAVEL = f"""
hits AS (
  SELECT b.user_id, a.event_id AS from_id, b.event_id AS to_id, a.event_type AS place_from, b.event_type AS place_to,
         a.ts AS departure_time, b.ts AS arrival_time,
         CAST(floor(epoch(b.ts)) AS BIGINT) - CAST(floor(epoch(a.ts)) AS BIGINT) AS travel_seconds,
         row_number() OVER (PARTITION BY b.event_id ORDER BY a.ts DESC, a.event_type, a.event_id) AS rn
  FROM events a JOIN events b ON a.user_id = b.user_id AND a.event_type <> b.event_type AND a.ts < b.ts
   AND CAST(floor(epoch(b.ts)) AS BIGINT) - CAST(floor(epoch(a.ts)) AS BIGINT) <= 1800
),
travel AS (SELECT * FROM hits WHERE rn = 1)"""

LINKS = f"""
acc AS (SELECT c_custkey, {DEVICE} AS device, {NETWORK} AS network FROM customer),
pairs AS (
  SELECT a.c_custkey AS x, b.c_custkey AS y, 'device' AS kind FROM acc a JOIN acc b ON a.device = b.device AND a.c_custkey <> b.c_custkey
  UNION ALL
  SELECT a.c_custkey, b.c_custkey, 'network' FROM acc a JOIN acc b ON a.network = b.network AND a.c_custkey <> b.c_custkey
),
links AS (
  SELECT c_custkey, COUNT(*) FILTER (kind = 'device') AS links_device, COUNT(*) FILTER (kind = 'network') AS links_network,
         COUNT(kind) AS link_count, COUNT(DISTINCT y) AS distinct_links
  FROM acc LEFT JOIN pairs ON c_custkey = x GROUP BY c_custkey
)"""

# words split at runs of whitespace
WORDS = r"string_split(trim(regexp_replace(text, '\s+', ' ', 'g')), ' ')"
