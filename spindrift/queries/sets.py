"""Set operations and dedup (U)."""

from pyspark.sql import functions as F

from spindrift.operators.sets import align_union, dedup_latest, diff_rows
from spindrift.queries import query


@query("u01_union_all", """
SELECT kind, COUNT(*) AS n FROM (SELECT 'customer' AS kind, c_custkey AS k FROM customer UNION ALL SELECT 'supplier', s_suppkey FROM supplier) GROUP BY 1""")
def u01(spark, t):
    a = t.customer.select(F.lit("customer").alias("kind"), F.col("c_custkey").alias("k"))
    return a.union(t.supplier.select(F.lit("supplier"), "s_suppkey")).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


@query("u02_union_by_name", """
SELECT id, coalesce(segment, 'none') AS segment, nation, balance FROM (
  SELECT c_custkey AS id, c_mktsegment AS segment, c_nationkey AS nation, c_acctbal AS balance FROM customer
  UNION ALL SELECT s_suppkey, NULL, s_nationkey, s_acctbal FROM supplier)""")
def u02(spark, t):
    a = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment"),
                          F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance"))
    b = t.supplier.select(F.col("s_acctbal").alias("balance"), F.col("s_nationkey").alias("nation"), F.col("s_suppkey").alias("id"))
    return a.unionByName(b, allowMissingColumns=True).withColumn("segment", F.coalesce("segment", F.lit("none")))


@query("u03_drop_duplicates", "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def u03(spark, t):
    return t.lineitem.select("l_orderkey", "l_linenumber").dropDuplicates(["l_orderkey", "l_linenumber"])


@query("u04_keep_latest", """
SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS VARCHAR) AS shipped, l_extendedprice, l_partkey FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_extendedprice DESC, l_partkey DESC) AS rn FROM lineitem)
WHERE rn = 1""")
def u04(spark, t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_shipdate", "l_extendedprice", "l_partkey")
    return dedup_latest(rows, ["l_orderkey", "l_linenumber"], ["l_shipdate"]).select(
        "l_orderkey", "l_linenumber", F.col("l_shipdate").cast("string").alias("shipped"), "l_extendedprice", "l_partkey")


@query("u05_align_union", """
SELECT source, CAST(id AS VARCHAR) AS id, CAST(score AS DOUBLE) AS score, coalesce(note, '-') AS note FROM (
  SELECT 'orders' AS source, o_orderkey AS id, o_totalprice AS score, o_orderstatus AS note FROM orders
  UNION ALL SELECT 'events', event_id, value, NULL FROM events)""")
def u05(spark, t):
    a = t.orders.select(F.lit("orders").alias("source"), F.col("o_orderkey").alias("id"),
                                                        F.col("o_totalprice").alias("score"), F.col("o_orderstatus").alias("note"))
    b = t.events.select(F.lit("events").alias("source"), F.col("event_id").alias("id"),
                                              F.col("value").alias("score"), "props")
    out = align_union([a, b], {"source": "string", "id": "string", "score": "double", "note": "string"})
    return out.withColumn("note", F.coalesce("note", F.lit("-")))


@query("u06_intersect", """
SELECT c_nationkey AS nation, CAST(floor(c_acctbal / 100) AS BIGINT) AS band FROM customer
INTERSECT SELECT s_nationkey, CAST(floor(s_acctbal / 100) AS BIGINT) FROM supplier""")
def u06(spark, t):
    a = t.customer.select(F.col("c_nationkey").alias("nation"), F.floor(F.col("c_acctbal") / 100).alias("band"))
    return a.intersect(t.supplier.select("s_nationkey", F.floor(F.col("s_acctbal") / 100)))


@query("u06_except_all", """
SELECT c_nationkey AS nation FROM customer EXCEPT ALL SELECT s_nationkey FROM supplier""")
def u06_except(spark, t):
    return t.customer.select(F.col("c_nationkey").alias("nation")).exceptAll(t.supplier.select("s_nationkey"))


@query("u06_row_difference", """
WITH a AS (SELECT c_nationkey AS nation, COUNT(*) AS n FROM customer GROUP BY 1), b AS (SELECT s_nationkey AS nation, COUNT(*) AS n FROM supplier GROUP BY 1)
SELECT nation, coalesce(a.n, 0) AS in_a, coalesce(b.n, 0) AS in_b FROM a FULL JOIN b USING (nation) WHERE coalesce(a.n, 0) <> coalesce(b.n, 0)""")
def u06_diff(spark, t):
    return diff_rows(t.customer.select(F.col("c_nationkey").alias("nation")),
                     t.supplier.select(F.col("s_nationkey").alias("nation")), ["nation"])
