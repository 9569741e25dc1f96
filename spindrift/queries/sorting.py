"""Sort, limit, partitioning (S)."""

from pyspark.sql import functions as F

from spindrift.operators.layout import pieces
from spindrift.queries import query


@query("s01_global_sort", """
SELECT o_orderkey, o_totalprice, coalesce(nullif(o_orderstatus, 'P'), 'none') AS status FROM orders
ORDER BY nullif(o_orderstatus, 'P') DESC NULLS LAST, o_totalprice DESC, o_orderkey""")
def s01(spark, t):
    rows = t.orders.select("o_orderkey", "o_totalprice", F.nullif("o_orderstatus", F.lit("P")).alias("status"))
    return rows.orderBy(F.col("status").desc_nulls_last(), F.desc("o_totalprice"), "o_orderkey").withColumn(
        "status", F.coalesce("status", F.lit("none")))


@query("s02_sort_by_case", """
SELECT event_type, COUNT(*) AS n FROM events GROUP BY 1
ORDER BY CASE event_type WHEN 'error' THEN 1 WHEN 'purchase' THEN 2 WHEN 'signup' THEN 3 ELSE 4 END, event_type""")
def s02(spark, t):
    kind = F.col("event_type")
    rank = F.when(kind == "error", 1).when(kind == "purchase", 2).when(kind == "signup", 3).otherwise(4)
    return t.events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n")).orderBy(rank, "event_type")


@query("s03_top_n", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def s03(spark, t):
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20)


@query("s04_sort_within_partitions", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem")
def s04(spark, t):
    t.views("lineitem")
    return spark.sql("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
                        DISTRIBUTE BY l_suppkey SORT BY l_suppkey, l_orderkey, l_linenumber""")


@query("s04_range_repartition", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, COUNT(*) AS n FROM orders GROUP BY 1""")
def s04_range(spark, t):
    ranged = t.orders.select("o_orderdate").repartitionByRange("o_orderdate").sortWithinPartitions("o_orderdate")
    return ranged.groupBy(F.year("o_orderdate").alias("year")).agg(F.count(F.lit(1)).alias("n"))


@query("s05_partition_counts", "SELECT 16 AS partitions, COUNT(*) AS total_rows FROM lineitem")
def s05(spark, t):
    """Rows per partition after a round-robin repartition, summed up."""
    per = t.lineitem.select("l_orderkey").repartition(pieces(t.lineitem, 16)).groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n"))
    return per.agg(F.count(F.lit(1)).cast("int").alias("partitions"), F.sum("n").alias("total_rows"))
