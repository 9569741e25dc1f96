"""Contracts, data quality, profiling (C)."""

from pyspark.sql import functions as F

from spindrift.operators import layout, quality
from spindrift.operators.aggregates import exact_quantiles
from spindrift.operators.quality import Contract, Rule
from spindrift.plans import retail
from spindrift.queries import query
from spindrift.session import new_dir
from spindrift.sources.files import check_schema

DIRTY = """
dirty AS (
  SELECT o_orderkey, nullif(o_custkey, 7) AS o_custkey, nullif(o_orderstatus, 'P') AS status,
         CASE WHEN o_orderpriority = '5-LOW' AND o_totalprice < 50000 THEN -o_totalprice ELSE o_totalprice END AS price, o_orderdate
  FROM orders
)"""


def dirty(t):
    """Orders with missing customers and statuses and some negative prices."""
    bad = (F.col("o_orderpriority") == "5-LOW") & (F.col("o_totalprice") < 50000)
    return t.orders.select(
        "o_orderkey", F.nullif("o_custkey", F.lit(7)).alias("o_custkey"), F.nullif("o_orderstatus", F.lit("P")).alias("status"),
        F.when(bad, -F.col("o_totalprice")).otherwise(F.col("o_totalprice")).alias("price"), "o_orderdate")


RULES = [
    Rule("customer_present", "o_custkey IS NOT NULL", "drop", "ERROR", "missing customer"),
    Rule("price_positive", "price > 0", "drop", "ERROR", "price not positive"),
    Rule("status_known", "status IN ('F', 'O')", "warn", "WARN", "unknown status"),
    Rule("date_in_range", "o_orderdate < TIMESTAMP_NTZ '2001-01-01 00:00:00'", "warn", "WARN", "date too late"),
]
# fixed values: the same rules as SQL, name, severity, action, condition
_SQL_RULES = [(r.name, r.severity, r.action, r.expr.replace("TIMESTAMP_NTZ", "TIMESTAMP")) for r in RULES]
REPORT_SQL = f"WITH {DIRTY}, n AS (SELECT COUNT(*) AS total FROM dirty)" + " UNION ALL ".join(
    f""" SELECT '{n}' AS check_name, '{s}' AS severity, '{a}' AS action, COUNT(*) FILTER (NOT coalesce({e}, false)) AS failing_rows, COUNT(*) AS total_rows,
 COUNT(*) FILTER (NOT coalesce({e}, false)) = 0 AS passed, CAST((COUNT(*) - COUNT(*) FILTER (NOT coalesce({e}, false))) * 100 AS DOUBLE) / COUNT(*) AS pass_pct FROM dirty"""
    for n, s, a, e in _SQL_RULES)


@query("c01_expectations_metrics", REPORT_SQL)
def c01(spark, t):
    return quality.expect(dirty(t), RULES)[1]


@query("c01_expectations_rows", f"""
WITH {DIRTY} SELECT o_orderkey, o_custkey, coalesce(status, 'none') AS status, price FROM dirty WHERE o_custkey IS NOT NULL AND price > 0""")
def c01_rows(spark, t):
    kept, _ = quality.expect(dirty(t), RULES)
    return kept.select("o_orderkey", "o_custkey", F.coalesce("status", F.lit("none")).alias("status"), "price")


@query("c01_fail_action", f"""
WITH {DIRTY}, b AS (SELECT COUNT(*) AS rows_given, COUNT(*) FILTER (NOT coalesce(price > 0 AND o_custkey IS NOT NULL, false)) AS failing_rows FROM dirty)
SELECT 'dirty' AS load, rows_given, failing_rows, failing_rows > 0 AS refused, CASE WHEN failing_rows > 0 THEN 0 ELSE rows_given END AS rows_loaded FROM b
UNION ALL SELECT 'clean', rows_given - failing_rows, 0, false, rows_given - failing_rows FROM b""")
def c01_fail(spark, t):
    """A load whose rows break a rule with action fail is refused as a whole, with its metrics; the same rows without the bad ones are loaded."""
    strict = [Rule("price_positive", "price > 0", "fail"), Rule("customer_present", "o_custkey IS NOT NULL", "fail")]
    both = F.coalesce(F.expr("price > 0 AND o_custkey IS NOT NULL"), F.lit(False))
    out = None
    for load, rows in (("dirty", dirty(t)), ("clean", dirty(t).filter(both))):
        path, refused = new_dir(spark, f"c01-{load}"), False
        try:
            quality.expect(rows, strict)[0].write.parquet(path)
        except quality.RuleViolation:
            refused = True
        loaded = F.lit(0).cast("long") if refused else spark.read.parquet(path).agg(F.count(F.lit(1))).scalar()
        one = rows.agg(F.lit(load).alias("load"), F.count(F.lit(1)).alias("rows_given"), F.count(F.when(~both, 1)).alias("failing_rows")).select(
            "*", F.lit(refused).alias("refused"), loaded.alias("rows_loaded"))
        out = one if out is None else out.unionByName(one)
    return out


@query("c01_unique_expectation", """
SELECT l_orderkey, l_linenumber, COUNT(*) AS copies FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1""")
def c01_unique(spark, t):
    return quality.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("c02_rule_suite", """
WITH s AS (SELECT l.*, p_partkey, s_suppkey FROM lineitem l LEFT JOIN (SELECT p_partkey FROM part WHERE p_size > 2) ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey),
r AS (SELECT COUNT(*) AS total_rows, COUNT(*) FILTER (l_quantity IS NULL) AS f1, COUNT(*) FILTER (NOT coalesce(l_discount BETWEEN 0 AND 0.09, false)) AS f2,
  COUNT(*) FILTER (p_partkey IS NULL) AS f3, COUNT(*) FILTER (s_suppkey IS NULL) AS f4, COUNT(*) FILTER (NOT coalesce(l_extendedprice > l_quantity * 10, false)) AS f5 FROM s)
SELECT check_name, severity, failing_rows, total_rows, CAST((total_rows - failing_rows) * 100 AS DOUBLE) / total_rows AS pass_pct FROM (
 SELECT 'quantity_present' AS check_name, 'ERROR' AS severity, f1 AS failing_rows, total_rows FROM r UNION ALL SELECT 'discount_valid', 'WARN', f2, total_rows FROM r
 UNION ALL SELECT 'part_exists', 'ERROR', f3, total_rows FROM r UNION ALL SELECT 'supplier_exists', 'ERROR', f4, total_rows FROM r
 UNION ALL SELECT 'price_reasonable', 'WARN', f5, total_rows FROM r)""")
def c02(spark, t):
    """Completeness, validity, referential and business rules of order lines in one pass after the joins."""
    parts = t.part.filter("p_size > 2").select("p_partkey")
    checked = t.lineitem.join(parts, F.col("l_partkey") == F.col("p_partkey"), "left").join(
        t.supplier.select("s_suppkey"), F.col("l_suppkey") == F.col("s_suppkey"), "left")
    rules = [Rule("quantity_present", "l_quantity IS NOT NULL"), Rule("discount_valid", "l_discount BETWEEN 0 AND 0.09D", severity="WARN"),
             Rule("part_exists", "p_partkey IS NOT NULL"), Rule("supplier_exists", "s_suppkey IS NOT NULL"),
             Rule("price_reasonable", "l_extendedprice > l_quantity * 10", severity="WARN")]
    return quality.rule_report(checked, rules).select("check_name", "severity", "failing_rows", "total_rows", "pass_pct")


_MESSAGES = [(r.message, r.expr.replace("TIMESTAMP_NTZ", "TIMESTAMP")) for r in RULES]
MARKED = DIRTY + ", marked AS (SELECT *, concat_ws('; ', " + ", ".join(
    f"CASE WHEN NOT coalesce({e}, false) THEN '{m}' END" for m, e in _MESSAGES) + ") AS error_messages FROM dirty)"


@query("c03_dead_letters", f"WITH {MARKED} SELECT o_orderkey, price, error_messages FROM marked WHERE error_messages <> ''")
def c03(spark, t):
    return quality.quarantine(dirty(t), RULES)[1].select("o_orderkey", "price", "error_messages")


@query("c03_valid_rows", f"WITH {MARKED} SELECT o_orderkey, o_custkey, status, price FROM marked WHERE error_messages = ''")
def c03_valid(spark, t):
    return quality.quarantine(dirty(t), RULES)[0].select("o_orderkey", "o_custkey", "status", "price")


@query("c03_error_breakdown", f"""
WITH {MARKED} SELECT error, COUNT(*) AS rows FROM (SELECT unnest(string_split(error_messages, '; ')) AS error FROM marked WHERE error_messages <> '') GROUP BY 1""")
def c03_breakdown(spark, t):
    return quality.error_breakdown(quality.quarantine(dirty(t), RULES)[1])


@query("c04_flags", f"""
WITH {DIRTY} SELECT o_orderkey, NOT coalesce(o_custkey IS NOT NULL, false) AS dq_customer_present, NOT coalesce(price > 0, false) AS dq_price_positive,
 NOT coalesce(status IN ('F', 'O'), false) AS dq_status_known, NOT coalesce(o_orderdate < TIMESTAMP '2001-01-01 00:00:00', false) AS dq_date_in_range FROM dirty""")
def c04(spark, t):
    return quality.flag(dirty(t), RULES).drop("o_custkey", "status", "price", "o_orderdate")


@query("c05_schema_check")
def c05(spark, t):
    drifted = t.customer.withColumn("c_acctbal", F.col("c_acctbal").cast("string")).drop("c_mktsegment").withColumn("c_phone", F.lit(""))
    return check_schema(drifted, "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string")


def _batch(t):
    return t.supplier.select(F.col("s_suppkey").cast("int").alias("id"), F.col("s_name").alias("name"),
                             F.col("s_acctbal").alias("balance"), F.lit("web").alias("channel"))


def _base(t):
    return t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))


@query("c06_evolve_add_columns", """
SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, 'none' AS channel FROM customer UNION ALL SELECT s_suppkey, s_name, s_acctbal, 'web' FROM supplier""")
def c06(spark, t):
    return quality.evolve(_base(t), _batch(t)).withColumn("channel", F.coalesce("channel", F.lit("none")))


@query("c06_evolve_rescue", """
SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, 'none' AS rescued FROM customer UNION ALL SELECT s_suppkey, s_name, s_acctbal, '{"channel":"web"}' FROM supplier""")
def c06_rescue(spark, t):
    return quality.evolve(_base(t), _batch(t), "rescue").select("id", "name", "balance", F.coalesce("_rescued_data", F.lit("none")).alias("rescued"))


@query("c06_evolve_drop_new", """
SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance FROM customer UNION ALL SELECT s_suppkey, s_name, s_acctbal FROM supplier""")
def c06_none(spark, t):
    return quality.evolve(_base(t), _batch(t), "none")


@query("c06_evolve_widen", """
SELECT 'bigint' AS id_type, 'double' AS balance_type, COUNT(*) AS n, CAST(SUM(id) AS BIGINT) AS ids, CAST(SUM(CAST(floor(balance) AS BIGINT)) AS BIGINT) AS balances FROM (
  SELECT c_custkey AS id, CAST(CAST(floor(c_acctbal) AS INTEGER) AS DOUBLE) AS balance FROM customer
  UNION ALL SELECT s_suppkey + 5000000000, s_acctbal FROM supplier)""")
def c06_widen(spark, t):
    """Ids beyond four bytes and balances with cents widen the columns they arrive in."""
    old = t.customer.select(F.col("c_custkey").cast("int").alias("id"), F.floor("c_acctbal").cast("int").alias("balance"))
    new = t.supplier.select((F.col("s_suppkey") + F.lit(5_000_000_000)).alias("id"), F.col("s_acctbal").alias("balance"))
    return quality.evolve(old, new).agg(
        F.max(F.typeof("id")).alias("id_type"), F.max(F.typeof("balance")).alias("balance_type"), F.count(F.lit(1)).alias("n"),
        F.sum("id").alias("ids"), F.sum(F.floor("balance")).alias("balances"))


@query("c06_evolve_refuse", """
SELECT 'new column' AS batch, true AS refused, COUNT(*) AS n FROM customer
UNION ALL SELECT 'other type', true, COUNT(*) FROM customer
UNION ALL SELECT 'same columns', false, COUNT(*) FROM (SELECT c_custkey FROM customer UNION ALL SELECT s_suppkey FROM supplier)""")
def c06_refuse(spark, t):
    """A batch with a new column, or with a type that the column cannot take, is refused and leaves the table as it was."""
    batches = {"new column": _batch(t), "other type": _batch(t).drop("channel").withColumn("balance", F.col("name")), "same columns": _batch(t).drop("channel")}
    out = None
    for name, batch in batches.items():
        refused = False
        try:
            table = quality.evolve(_base(t), batch, "failOnNewColumns")
        except quality.RuleViolation:
            table, refused = _base(t), True
        one = table.agg(F.lit(name).alias("batch"), F.lit(refused).alias("refused"), F.count(F.lit(1)).alias("n"))
        out = one if out is None else out.unionByName(one)
    return out


PART_CONTRACT = Contract(
    schema="p_partkey bigint, p_name string, p_type string, base_price decimal(10,2), discount_pct decimal(5,2), final_price decimal(10,2), size int",
    not_null=["p_partkey", "p_name"],
    checks={"price_positive": "base_price > 0", "discount_range": "discount_pct BETWEEN 0 AND 100", "size_range": "size BETWEEN 1 AND 50"},
    defaults={"discount_pct": "10"},
    generated={"final_price": "base_price * (1 - discount_pct / 100)"},
    primary_key=["p_partkey"],
)


@query("c07_contract_write", """
SELECT p_partkey, p_name, p_type, CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS DOUBLE) AS base_price, 10.0::DOUBLE AS discount_pct,
 CAST(CAST(CAST(p_retailprice AS DECIMAL(10,2)) * 0.9 AS DECIMAL(10,2)) AS DOUBLE) AS final_price, p_size AS size FROM part""")
def c07(spark, t):
    rows = t.part.select("p_partkey", "p_name", "p_type", F.col("p_retailprice").alias("base_price"), F.col("p_size").alias("size"))
    good = quality.enforce(rows, PART_CONTRACT)
    return good.withColumns({c: F.col(c).cast("double") for c in ("base_price", "discount_pct", "final_price")})


@query("c07_contract_violations", """
SELECT check_name, failing_rows FROM (
 SELECT 'not_null_p_partkey' AS check_name, COUNT(*) FILTER (p_partkey IS NULL) AS failing_rows FROM part UNION ALL
 SELECT 'not_null_p_name', COUNT(*) FILTER (p_type = 'SMALL') FROM part UNION ALL
 SELECT 'price_positive', COUNT(*) FILTER (p_retailprice - 1000 <= 0) FROM part UNION ALL
 SELECT 'discount_range', CAST(0 AS BIGINT) UNION ALL
 SELECT 'size_range', COUNT(*) FILTER (p_size + 5 > 50) FROM part)""")
def c07_violations(spark, t):
    """Failing rows per contract rule of a batch that would be rejected."""
    rows = t.part.select("p_partkey", F.nullif(F.when(F.col("p_type") == "SMALL", "x").otherwise(F.col("p_name")), F.lit("x")).alias("p_name"),
                         "p_type", (F.col("p_retailprice") - 1000).alias("base_price"), (F.col("p_size") + 5).alias("size"))
    shaped = quality.conform(rows, PART_CONTRACT)
    return quality.rule_report(shaped, quality.contract_rules(PART_CONTRACT)).select("check_name", "failing_rows")


@query("c08_rescued_data", """
WITH raw AS (SELECT event_id, CASE WHEN event_type = 'error' THEN 'BAD' || user_id ELSE CAST(user_id AS VARCHAR) END AS user_text,
  CASE WHEN value > 100 THEN 'n/a' ELSE CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR) END AS value_text FROM events)
SELECT event_id, coalesce(TRY_CAST(user_text AS BIGINT), -1) AS user_text, coalesce(CAST(TRY_CAST(value_text AS DECIMAL(12,2)) AS DOUBLE), -1) AS value_text,
 CASE WHEN user_text LIKE 'BAD%' AND value_text = 'n/a' THEN '{"user_text":"' || user_text || '","value_text":"n/a"}'
      WHEN user_text LIKE 'BAD%' THEN '{"user_text":"' || user_text || '"}' WHEN value_text = 'n/a' THEN '{"value_text":"n/a"}' ELSE 'none' END AS rescued
FROM raw""")
def c08(spark, t):
    raw = t.events.select(
        "event_id", F.when(F.col("event_type") == "error", F.concat(F.lit("BAD"), F.col("user_id").cast("string"))).otherwise(
            F.col("user_id").cast("string")).alias("user_text"),
        F.when(F.col("value") > 100, "n/a").otherwise(F.col("value").cast("decimal(12,2)").cast("string")).alias("value_text"))
    out = quality.rescue(raw, {"user_text": "bigint", "value_text": "decimal(12,2)"})
    return out.select("event_id", F.coalesce("user_text", F.lit(-1)).alias("user_text"),
                      F.coalesce(F.col("value_text").cast("double"), F.lit(-1.0)).alias("value_text"),
                      F.coalesce("_rescued_data", F.lit("none")).alias("rescued"))


@query("c09_reconcile", """
WITH a AS (SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem), b AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN l_partkey + 1 ELSE l_partkey END AS l_partkey FROM lineitem WHERE l_quantity < 50),
ga AS (SELECT l_orderkey, l_linenumber, COUNT(*) AS n, list_sort(list(l_partkey)) AS c FROM a GROUP BY 1, 2), gb AS (SELECT l_orderkey, l_linenumber, COUNT(*) AS n, list_sort(list(l_partkey)) AS c FROM b GROUP BY 1, 2),
j AS (SELECT ga.n AS na, gb.n AS nb, ga.c AS ca, gb.c AS cb FROM ga FULL JOIN gb USING (l_orderkey, l_linenumber))
SELECT CAST(SUM(coalesce(na, 0)) AS BIGINT) AS rows_a, CAST(SUM(coalesce(nb, 0)) AS BIGINT) AS rows_b, COUNT(*) FILTER (nb IS NULL) AS only_a, COUNT(*) FILTER (na IS NULL) AS only_b,
 COUNT(*) FILTER (na > 1) AS duplicate_keys_a, COUNT(*) FILTER (nb > 1) AS duplicate_keys_b, COUNT(*) FILTER (na IS NOT NULL AND nb IS NOT NULL AND ca <> cb) AS changed FROM j""")
def c09(spark, t):
    a = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    touched = (F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 1)
    b = t.lineitem.filter("l_quantity < 50").select(
        "l_orderkey", "l_linenumber", F.when(touched, F.col("l_partkey") + 1).otherwise(F.col("l_partkey")).alias("l_partkey"))
    return quality.reconcile(a, b, ["l_orderkey", "l_linenumber"])


@query("c10_null_rates", f"""
WITH {DIRTY}, n AS (SELECT COUNT(*) AS t, COUNT(*) FILTER (o_custkey IS NULL) AS a, COUNT(*) FILTER (status IS NULL) AS b, COUNT(*) FILTER (price IS NULL) AS c FROM dirty)
SELECT column_name, nulls, total_rows, CAST(nulls AS DOUBLE) / total_rows AS null_rate, CAST(nulls AS DOUBLE) / total_rows > 0.1 AS above_threshold FROM (
 SELECT 'o_custkey' AS column_name, a AS nulls, t AS total_rows FROM n UNION ALL SELECT 'status', b, t FROM n UNION ALL SELECT 'price', c, t FROM n)""")
def c10(spark, t):
    return quality.null_rates(dirty(t), ["o_custkey", "status", "price"], 0.1)


@query("c11_volume", """
SELECT COUNT(*) AS row_count, CASE WHEN COUNT(*) < 100 THEN 'TOO_FEW' WHEN COUNT(*) > 1000000000000 THEN 'TOO_MANY' ELSE 'OK' END AS status FROM orders""")
def c11(spark, t):
    return quality.volume(t.orders, 100, 10**12)


@query("c12_freshness", """
SELECT event_type, CAST(epoch(TIMESTAMP '2024-01-31 00:00:00') - floor(epoch(max(ts))) AS DOUBLE) / 3600.0 AS hours_since,
 CASE WHEN (epoch(TIMESTAMP '2024-01-31 00:00:00') - floor(epoch(max(ts)))) / 3600.0 <= 0.5 THEN 'FRESH' ELSE 'STALE' END AS status FROM events GROUP BY 1""")
def c12(spark, t):
    return quality.freshness(t.events, "ts", "2024-01-31 00:00:00", 0.5, ["event_type"])


@query("c13_profile", """
SELECT column_name, total_rows, nulls, distinct_values, min_value, max_value, mean_value FROM (
 SELECT 'p_size' AS column_name, COUNT(*) AS total_rows, COUNT(*) - COUNT(p_size) AS nulls, COUNT(DISTINCT p_size) AS distinct_values, CAST(MIN(p_size) AS VARCHAR) AS min_value, CAST(MAX(p_size) AS VARCHAR) AS max_value, CAST(SUM(p_size) AS DOUBLE) / COUNT(p_size) AS mean_value FROM part
 UNION ALL SELECT 'p_type', COUNT(*), COUNT(*) - COUNT(p_type), COUNT(DISTINCT p_type), MIN(p_type), MAX(p_type), NULL FROM part
 UNION ALL SELECT 'p_brand', COUNT(*), COUNT(*) - COUNT(p_brand), COUNT(DISTINCT p_brand), MIN(p_brand), MAX(p_brand), NULL FROM part)""")
def c13(spark, t):
    return quality.profile(t.part, ["p_size", "p_type", "p_brand"], exact_distinct=True)


@query("c13_profile_sketch")
def c13_sketch(spark, t):
    return quality.profile(t.lineitem)


@query("c13_sketch_error", """
SELECT 'l_orderkey' AS column_name, COUNT(DISTINCT l_orderkey) AS distinct_values, true AS within_error FROM lineitem
UNION ALL SELECT 'l_partkey', COUNT(DISTINCT l_partkey), true FROM lineitem UNION ALL SELECT 'l_shipdate', COUNT(DISTINCT l_shipdate), true FROM lineitem""")
def c13_error(spark, t):
    """The sketched profile beside the exact one, within four relative standard deviations of 5 %."""
    columns = ["l_orderkey", "l_partkey", "l_shipdate"]
    exact = quality.profile(t.lineitem, columns, exact_distinct=True).select("column_name", "distinct_values")
    sketch = quality.profile(t.lineitem, columns).select("column_name", F.col("distinct_values").alias("about"))
    return exact.join(sketch, "column_name").select(
        "column_name", "distinct_values", (F.abs(F.col("about") - F.col("distinct_values")) <= F.col("distinct_values") * 0.2).alias("within_error"))


@query("c14_drift", """
WITH old AS (SELECT value FROM events WHERE ts < TIMESTAMP '2024-01-16'), new AS (SELECT value * 1.2 AS value FROM events WHERE ts >= TIMESTAMP '2024-01-16'),
b AS (SELECT min(value) AS lo, max(value) AS hi FROM old),
o AS (SELECT CAST(least(greatest(floor((value - lo) / ((hi - lo) / 10.0::DOUBLE)), 0), 9) AS INTEGER) AS bin, COUNT(*) AS n FROM old, b GROUP BY 1),
w AS (SELECT CAST(least(greatest(floor((value - lo) / ((hi - lo) / 10.0::DOUBLE)), 0), 9) AS INTEGER) AS bin, COUNT(*) AS n FROM new, b GROUP BY 1),
j AS (SELECT bin, coalesce(o.n, 0) AS old_rows, coalesce(w.n, 0) AS new_rows FROM o FULL JOIN w USING (bin)),
s AS (SELECT *, greatest(CAST(old_rows AS DOUBLE) / SUM(old_rows) OVER (), 0.0001) AS p, greatest(CAST(new_rows AS DOUBLE) / SUM(new_rows) OVER (), 0.0001) AS q FROM j)
SELECT bin, old_rows, new_rows, round((q - p) * ln(q / p), 8) AS psi_term FROM s""")
def c14(spark, t):
    old = t.events.filter("ts < TIMESTAMP_NTZ '2024-01-16 00:00:00'").select("value")
    new = t.events.filter("ts >= TIMESTAMP_NTZ '2024-01-16 00:00:00'").select((F.col("value") * 1.2).alias("value"))
    return quality.drift(old, new, "value", 10).withColumn("psi_term", F.round("psi_term", 8))


_DRIFTED = """
j AS (SELECT coalesce(o.k, w.k) AS k, coalesce(o.n, 0) AS old_rows, coalesce(w.n, 0) AS new_rows FROM o FULL JOIN w ON o.k IS NOT DISTINCT FROM w.k),
s AS (SELECT *, CAST(old_rows AS DOUBLE) / SUM(old_rows) OVER () AS p, CAST(new_rows AS DOUBLE) / SUM(new_rows) OVER () AS q FROM j),
g AS (SELECT *, greatest(p, 0.0001) AS pp, greatest(q, 0.0001) AS qq FROM s)"""


@query("c14_quantile_drift", f"""
WITH old AS (SELECT value FROM events WHERE ts < TIMESTAMP '2024-01-16'), new AS (SELECT value * 1.2 AS value FROM events WHERE ts >= TIMESTAMP '2024-01-16'),
b AS (SELECT list_distinct(quantile_disc(value, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])) AS e FROM old),
o AS (SELECT CAST(len(list_filter(e, lambda x: x < value)) AS INTEGER) AS k, COUNT(*) AS n FROM old, b GROUP BY 1),
w AS (SELECT CAST(len(list_filter(e, lambda x: x < value)) AS INTEGER) AS k, COUNT(*) AS n FROM new, b GROUP BY 1), {_DRIFTED}
SELECT k AS bin, old_rows, new_rows, round((qq - pp) * ln(qq / pp), 8) AS psi_term, round(abs(q - p) / 2, 8) AS distance FROM g""")
def c14_quantiles(spark, t):
    old = t.events.filter("ts < TIMESTAMP_NTZ '2024-01-16 00:00:00'").select("value")
    new = t.events.filter("ts >= TIMESTAMP_NTZ '2024-01-16 00:00:00'").select((F.col("value") * 1.2).alias("value"))
    return quality.quantile_drift(old, new, "value", 10).withColumns({c: F.round(c, 8) for c in ("psi_term", "distance")})


@query("c14_category_drift", f"""
WITH o AS (SELECT o_orderpriority AS k, COUNT(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1),
w AS (SELECT o_orderpriority AS k, COUNT(*) AS n FROM orders WHERE o_orderstatus <> 'F' GROUP BY 1), {_DRIFTED}
SELECT k AS category, old_rows, new_rows, round((qq - pp) * ln(qq / pp), 8) AS psi_term, round(abs(q - p) / 2, 8) AS distance FROM g""")
def c14_categories(spark, t):
    done = t.orders.filter("o_orderstatus = 'F'")
    return quality.category_drift(done, t.orders.filter("o_orderstatus <> 'F'"), "o_orderpriority").withColumns(
        {c: F.round(c, 8) for c in ("psi_term", "distance")})


def _clustered(spark, t, label):
    path = new_dir(spark, label)
    t.lineitem.repartitionByRange(layout.pieces(t.lineitem, 16), "l_shipdate").sortWithinPartitions("l_shipdate").write.parquet(path)
    return path


@query("c15_file_ranges")
def c15(spark, t):
    path = _clustered(spark, t, "c15")
    ranges = layout.file_ranges(spark.read.parquet(path), ["l_shipdate", "l_partkey"])
    return ranges.withColumn("file", F.regexp_extract("file", "([^/]+)$", 1))


@query("c15_skipping")
def c15_skip(spark, t):
    path = _clustered(spark, t, "c15skip")
    ranges = layout.file_ranges(spark.read.parquet(path), ["l_shipdate", "l_partkey"])
    lo, hi = (F.lit(d).cast("timestamp_ntz") for d in ("1997-01-01", "1997-03-31"))
    return layout.skippable(ranges, "l_shipdate", lo, hi)


@query("c16_skew_report", """
WITH c AS (SELECT o_custkey, COUNT(*) AS n FROM orders GROUP BY 1)
SELECT COUNT(*) AS keys, CAST(SUM(n) AS BIGINT) AS total_rows, MIN(n) AS min_rows, CAST(SUM(n) AS DOUBLE) / COUNT(*) AS avg_rows, MAX(n) AS max_rows,
 quantile_disc(n, 0.5) AS p50, quantile_disc(n, 0.9) AS p90, quantile_disc(n, 0.99) AS p99,
 CAST((SELECT SUM(n) FROM (SELECT n FROM c ORDER BY n DESC LIMIT 10)) AS DOUBLE) / SUM(n) AS top10_share FROM c""")
def c16(spark, t):
    """Rows per key: bounds, quantiles and the share of the ten largest keys."""
    counts = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    points = {"p50": 0.5, "p90": 0.9, "p99": 0.99}
    q = exact_quantiles(counts.withColumn("all", F.lit(0)), ["all"], "n", points)
    top = counts.orderBy(F.desc("n")).limit(10).agg(F.sum("n")).scalar()
    basic = counts.agg(F.count(F.lit(1)).alias("keys"), F.sum("n").alias("total_rows"), F.min("n").alias("min_rows"),
                       (F.sum("n").cast("double") / F.count(F.lit(1))).alias("avg_rows"), F.max("n").alias("max_rows"))
    return basic.withColumn("q", q.select(F.struct(*points)).scalar()).select(
        "*", *[F.col(f"q.{p}").alias(p) for p in points]).withColumn(
        "top10_share", top.cast("double") / F.col("total_rows")).drop("q")


@query("c17_health_report")
def c17(spark, t):
    path = new_dir(spark, "c17")
    t.orders.withColumn("year", F.year("o_orderdate")).write.partitionBy("year").parquet(path)
    return layout.health(spark, path)


@query("c17_health_invariants", """
SELECT COUNT(DISTINCT year(o_orderdate)) AS partitions, true AS a_file_each, true AS mean_of_bytes FROM orders""")
def c17_invariants(spark, t):
    report = c17(spark, t)
    return report.select("partitions", (F.col("files") >= F.col("partitions")).alias("a_file_each"),
                         (F.abs(F.col("mean_bytes") * F.col("files") - F.col("bytes")) < 1).alias("mean_of_bytes"))


@query("c18_layer_health", """
SELECT strftime(ts, '%Y-%m-%d %H') AS hour, COUNT(*) AS n, CAST(COUNT(*) FILTER (event_type = 'error') AS DOUBLE) / COUNT(*) AS rescued_ratio,
 CAST(COUNT(*) FILTER (event_type = 'error') AS DOUBLE) / COUNT(*) > 0.3 AS bad, CAST(COUNT(*) FILTER (value < 100) AS DOUBLE) / COUNT(*) AS pass_rate,
 CAST(SUM(CAST(epoch(TIMESTAMP '2024-02-01') - floor(epoch(ts)) AS BIGINT)) AS DOUBLE) / COUNT(*) AS avg_latency FROM events GROUP BY 1""")
def c18(spark, t):
    """Rows, rescued share, rule pass rate and event-to-load delay per hour."""
    rescued = F.count_if(F.col("event_type") == "error").cast("double") / F.count(F.lit(1))
    delay = F.unix_seconds(F.lit("2024-02-01 00:00:00").cast("timestamp")) - F.unix_seconds(F.col("ts").cast("timestamp"))
    return t.events.groupBy(F.date_format("ts", "yyyy-MM-dd HH").alias("hour")).agg(
        F.count(F.lit(1)).alias("n"), rescued.alias("rescued_ratio"), (rescued > 0.3).alias("bad"),
        quality.pass_rate(F.col("value") < 100).alias("pass_rate"),
        (F.sum(delay).cast("double") / F.count(F.lit(1))).alias("avg_latency"))


@query("c19_fingerprint")
def c19(spark, t):
    return quality.fingerprint(t.lineitem, "l_returnflag = 'R'")


@query("c19_fingerprint_rerun", "SELECT COUNT(*) AS row_count, true AS unchanged FROM orders")
def c19_rerun(spark, t):
    """The fingerprint of the table and of a shuffled copy agree."""
    a = quality.fingerprint(t.orders).withColumnRenamed("content_sum", "before")
    b = quality.fingerprint(t.orders.repartition(7))
    return a.join(b, "row_count").select("row_count", (F.col("before") == F.col("content_sum")).alias("unchanged"))


@query("c02_sales_rules", """
WITH s AS (SELECT CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS net FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT 'net_positive' AS check_name, COUNT(*) FILTER (NOT net > 2000) AS failing_rows, COUNT(*) AS total_rows FROM s""")
def c02_sales(spark, t):
    lines = retail.net_lines(t).withColumnRenamed("net_revenue", "net")
    return quality.rule_report(lines, [Rule("net_positive", "net > 2000")]).select("check_name", "failing_rows", "total_rows")
