"""Governance as data operations (G)."""

from pyspark.sql import functions as F

from spindrift.functions import masks
from spindrift.operators import graph, secure
from spindrift.operators.secure import RolePolicy
from spindrift.plans import ops
from spindrift.queries import query
from spindrift.queries.subqueries import EDGES, edges

PEOPLE = """
people AS (
  SELECT c_custkey AS emp_id, c_name AS name, nullif(c_mktsegment, 'FURNITURE') AS dept, c_acctbal AS salary, lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS ssn,
         lower(c_name) || '@example.com' AS email, c_nationkey FROM customer
)"""


def people(t):
    """Customers as staff: department (some missing), salary, number and mail address."""
    return t.customer.select(
        F.col("c_custkey").alias("emp_id"), F.col("c_name").alias("name"), F.nullif("c_mktsegment", F.lit("FURNITURE")).alias("dept"),
        F.col("c_acctbal").alias("salary"), F.lpad(F.col("c_custkey").cast("string"), 9, "0").alias("ssn"),
        F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email"), "c_nationkey")


def _band(c):
    return masks.mask_band(c, 1000)


def _text(c):
    return c.cast("string")


POLICY = {
    "admin": RolePolicy(masks={"salary": _text}),
    "hr": RolePolicy("dept IS NOT NULL", {"ssn": masks.mask_ssn, "salary": _text}),
    "manager": RolePolicy("dept = 'BUILDING'", {"ssn": masks.redact, "salary": _band}),
    "analyst": RolePolicy("salary > 0", {"ssn": masks.redact, "email": masks.mask_email, "salary": _band}),
    "auditor": RolePolicy("dept IN ('MACHINERY', 'BUILDING')", {"ssn": masks.mask_ssn, "email": masks.redact, "salary": masks.redact}),
}
ROLES = [*POLICY, "stranger"]
BAND = "CAST(CAST(floor(salary / 1000) * 1000 AS BIGINT) AS VARCHAR) || '-' || CAST(CAST(floor(salary / 1000) * 1000 AS BIGINT) + 999 AS VARCHAR)"


@query("g01_column_projection", f"""
WITH {PEOPLE} SELECT emp_id, coalesce(dept, 'none') AS dept, left(email, 2) || '***@' || split_part(email, '@', 2) AS email FROM people""")
def g01(spark, t):
    policy = {"marketing": RolePolicy(masks={"email": masks.mask_email}, columns=["emp_id", "dept", "email"])}
    return secure.apply_masks(people(t), policy, "marketing").withColumn("dept", F.coalesce("dept", F.lit("none")))


@query("g02_masks_by_role", f"""
WITH {PEOPLE} SELECT emp_id, 'REDACTED' AS ssn, left(email, 2) || '***@' || split_part(email, '@', 2) AS email, {BAND} AS salary FROM people""")
def g02(spark, t):
    return secure.apply_masks(people(t), POLICY, "analyst").select("emp_id", "ssn", "email", "salary")


@query("g03_row_filter", f"""
WITH {PEOPLE} SELECT 'admin' AS role, COUNT(*) AS visible FROM people UNION ALL SELECT 'hr', COUNT(*) FROM people WHERE dept IS NOT NULL
UNION ALL SELECT 'manager', COUNT(*) FROM people WHERE dept = 'BUILDING' UNION ALL SELECT 'analyst', COUNT(*) FROM people WHERE salary > 0
UNION ALL SELECT 'auditor', COUNT(*) FROM people WHERE dept IN ('MACHINERY', 'BUILDING') UNION ALL SELECT 'stranger', CAST(0 AS BIGINT)""")
def g03(spark, t):
    out = None
    for role in ROLES:
        one = secure.row_filter(people(t), POLICY, role).agg(F.count(F.lit(1)).alias("visible")).select(F.lit(role).alias("role"), "visible")
        out = one if out is None else out.unionByName(one)
    return out


@query("g03_mapped_row_filter", """
SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA'""")
def g03_mapped(spark, t):
    """The mapping grants each region's steward the nations of the region."""
    mapping = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.concat(F.lit("steward:"), F.col("r_name")).alias("principal"), F.col("n_name").alias("value"))
    rows = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_name")
    return secure.mapped_row_filter(rows, mapping, "n_name", "steward:ASIA")


@query("g04_secure_view", f"""
WITH {PEOPLE}
SELECT 'admin' AS role, emp_id, coalesce(dept, 'none') AS dept, ssn, email FROM people
UNION ALL SELECT 'hr', emp_id, dept, '***-**-' || right(ssn, 4), email FROM people WHERE dept IS NOT NULL
UNION ALL SELECT 'manager', emp_id, dept, 'REDACTED', email FROM people WHERE dept = 'BUILDING'
UNION ALL SELECT 'analyst', emp_id, coalesce(dept, 'none'), 'REDACTED', left(email, 2) || '***@' || split_part(email, '@', 2) FROM people WHERE salary > 0
UNION ALL SELECT 'auditor', emp_id, dept, '***-**-' || right(ssn, 4), 'REDACTED' FROM people WHERE dept IN ('MACHINERY', 'BUILDING')""")
def g04(spark, t):
    out = None
    for role in ROLES:
        one = secure.secure_view(people(t), POLICY, role).select(
            F.lit(role).alias("role"), "emp_id", F.coalesce("dept", F.lit("none")).alias("dept"), "ssn", "email")
        out = one if out is None else out.unionByName(one)
    return out


@query("g05_lineage_downstream", f"""
WITH RECURSIVE e AS ({EDGES}), r AS (SELECT 'region:ASIA' AS node, 0 AS depth UNION SELECT e.dst, r.depth + 1 FROM r JOIN e ON e.src = r.node)
SELECT node, CAST(min(depth) AS INTEGER) AS depth FROM r GROUP BY 1""")
def g05(spark, t):
    return graph.impact(edges(spark, t), spark.sql("SELECT 'region:ASIA' AS node"))


@query("g05_lineage_upstream", f"""
WITH RECURSIVE e AS ({EDGES}), r AS (SELECT 'market:BUILDING' AS node, 0 AS depth UNION SELECT e.src, r.depth + 1 FROM r JOIN e ON e.dst = r.node)
SELECT node, CAST(min(depth) AS INTEGER) AS depth FROM r GROUP BY 1""")
def g05_upstream(spark, t):
    return graph.upstream(edges(spark, t), spark.sql("SELECT 'market:BUILDING' AS node"))


COLUMN_EDGES = """
SELECT DISTINCT 'region:' || r_name AS src, 'nation:' || n_name AS dst, 'r_regionkey' AS src_column, 'n_regionkey' AS dst_column, 'copy' AS transformation
FROM region JOIN nation ON n_regionkey = r_regionkey
UNION SELECT DISTINCT 'nation:' || n_name, 'segment:' || n_name || '/' || c_mktsegment, 'n_nationkey', 'c_nationkey', 'join customer' FROM nation JOIN customer ON c_nationkey = n_nationkey
UNION SELECT DISTINCT 'segment:' || n_name || '/' || c_mktsegment, 'market:' || c_mktsegment, 'c_acctbal', 'balance', 'sum by c_mktsegment' FROM nation JOIN customer ON c_nationkey = n_nationkey
UNION SELECT DISTINCT 'segment:' || n_name || '/' || c_mktsegment, 'market:' || c_mktsegment, 'c_custkey', 'customers', 'count by c_mktsegment' FROM nation JOIN customer ON c_nationkey = n_nationkey"""


@query("g05_column_lineage", f"""
WITH RECURSIVE e AS ({COLUMN_EDGES}), r AS (SELECT 'region:ASIA' AS node, 0 AS depth UNION SELECT e.dst, r.depth + 1 FROM r JOIN e ON e.src = r.node),
d AS (SELECT node, CAST(min(depth) AS INTEGER) AS depth FROM r GROUP BY 1)
SELECT e.*, depth FROM e JOIN d ON e.src = d.node""")
def g05_columns(spark, t):
    """Every edge below a source, with the columns it joins and what is done to them."""
    t.views("region", "nation", "customer")
    return graph.lineage_edges(spark.sql(COLUMN_EDGES), spark.sql("SELECT 'region:ASIA' AS node"))


@query("g06_access_log", """
SELECT user_id, COUNT(*) AS accesses, COUNT(*) FILTER (event_type = 'error') AS denied, COUNT(*) FILTER (hour(ts) < 8 OR hour(ts) >= 18) AS off_hours,
 CAST(MAX(ts) AS VARCHAR) AS last_access, COUNT(DISTINCT event_type) AS actions FROM events GROUP BY 1""")
def g06(spark, t):
    return ops.access_summary(t.events, "user_id", "event_type", "ts", "error")


@query("g06_stale_objects", """
SELECT user_id, CAST(MAX(ts) AS VARCHAR) AS last_access FROM events GROUP BY 1 HAVING MAX(ts) < TIMESTAMP '2024-01-31' - INTERVAL 1 DAY""")
def g06_stale(spark, t):
    return ops.stale_objects(t.events, "user_id", "ts", "2024-01-31 00:00:00", 1)


# fixed values: what to look for in values and in column names
PII_VALUES = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", "ssn": r"^[0-9]{9}$", "number": r"[0-9]{4}"}
PII_NAMES = {"email": "(?i)mail", "ssn": "(?i)ssn|social", "number": "(?i)phone|card"}


def _pii_sql():
    lines = []
    for c in ("name", "dept", "ssn", "email"):
        for p, pattern in PII_VALUES.items():
            hit = str((p, c) in {("email", "email"), ("ssn", "ssn")}).lower()
            m = f"COUNT(*) FILTER (regexp_matches({c}, '{pattern}'))"
            lines.append(f"SELECT '{c}' AS column_name, '{p}' AS pattern, {m} AS matches, COUNT({c}) AS non_null, {hit} AS name_hit, "
                         f"CAST({m} AS DOUBLE) / COUNT({c}) AS match_rate, {hit} OR CAST({m} AS DOUBLE) / COUNT({c}) > 0.5 AS is_pii FROM people")
    return f"WITH {PEOPLE} " + " UNION ALL ".join(lines)


@query("g07_pii_discovery", _pii_sql())
def g07(spark, t):
    return secure.pii_scan(people(t), PII_VALUES, PII_NAMES, 0.5)


def _documents_sql():
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{p}' AS pattern, COUNT(*) FILTER (regexp_matches({c}, '{pattern}')) AS matches, COUNT({c}) AS non_null FROM documents"
        for c in ("text", "lang", "source") for p, pattern in PII_VALUES.items())


@query("g07_pii_in_documents", _documents_sql())
def g07_documents(spark, t):
    return secure.pii_scan(t.documents, PII_VALUES, PII_NAMES).select("column_name", "pattern", "matches", "non_null")


@query("g08_share_extract", """
SELECT o_orderpriority, CAST(year(o_orderdate) AS INTEGER) AS year, COUNT(*) AS row_count, format('{:,.2f}', CAST(SUM(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE)) AS amount_text
FROM orders WHERE o_orderstatus = 'F' GROUP BY 1, 2""")
def g08(spark, t):
    rows = t.orders.withColumn("year", F.year("o_orderdate"))
    return ops.share_extract(rows, "o_orderstatus = 'F'", ["o_orderpriority", "year"], "o_totalprice")
