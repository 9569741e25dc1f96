"""Projection, filter, predicate (PRJ)."""

from pyspark.sql import functions as F

from spindrift.functions.dates import date_range_predicate
from spindrift.functions.numeric import dec, exact_sum
from spindrift.queries import query
from spindrift.queries.snippets import LINE_TOTAL, dsum


@query("prj01_select_expr", """
SELECT o_orderkey AS id, upper(o_orderstatus) AS status, o_totalprice * 2 AS doubled, CAST(year(o_orderdate) AS INTEGER) AS y FROM orders""")
def prj01(spark, t):
    packed = t.orders.select(F.struct(F.col("o_orderkey").alias("id"), F.expr("upper(o_orderstatus)").alias("status")).alias("attr"),
                             "o_totalprice", "o_orderdate")
    return packed.select("attr.*", "o_totalprice", "o_orderdate").selectExpr(
        "id", "status", "o_totalprice * 2 AS doubled", "year(o_orderdate) AS y")


@query("prj02_derived_columns", f"""
SELECT l_orderkey, l_linenumber AS line_no, l_partkey, CAST({LINE_TOTAL} AS DOUBLE) AS net,
       CAST(CAST(l_quantity AS DECIMAL(12,2)) * 2 AS DOUBLE) AS twice FROM lineitem""")
def prj02(spark, t):
    net = dec("l_extendedprice") * (F.lit(1).cast("decimal(3,2)") - dec("l_discount", 2, 4))
    return t.lineitem.withColumns({"net": net.cast("double"), "twice": (dec("l_quantity") * 2).cast("double")}).withColumnRenamed(
        "l_linenumber", "line_no").drop(
        "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")


@query("prj03_filters", """
SELECT p_partkey, p_name, p_type, p_size FROM part
WHERE p_size BETWEEN 10 AND 30 AND p_type IN ('SMALL', 'ECONOMY') AND (p_name LIKE '%ring%' OR regexp_matches(p_name, '^b.*t$')) AND NOT p_brand = 'Brand#1'""")
def prj03(spark, t):
    c = F.col
    return t.part.filter(c("p_size").between(10, 30) & c("p_type").isin("SMALL", "ECONOMY")
                         & (c("p_name").like("%ring%") | c("p_name").rlike("^b.*t$")) & ~(c("p_brand") == "Brand#1")).select(
        "p_partkey", "p_name", "p_type", "p_size")


@query("prj04_null_handling", """
WITH n AS (SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status, nullif(o_orderpriority, '5-LOW') AS priority, o_totalprice FROM orders)
SELECT coalesce(status, 'unknown') AS status, coalesce(priority, status, 'none') AS best, COUNT(*) AS n, COUNT(status) AS known
FROM n WHERE priority IS NOT NULL OR status IS NOT NULL GROUP BY 1, 2""")
def prj04(spark, t):
    n = t.orders.select("o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("raw"),
                        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority"))
    kept = n.na.drop(how="all", subset=["raw", "priority"])
    filled = kept.withColumns({"status": F.col("raw"), "best": F.coalesce("priority", "raw", F.lit("none"))}).fillna({"status": "unknown"})
    return filled.groupBy("status", "best").agg(F.count(F.lit(1)).alias("n"), F.count("raw").alias("known"))


@query("prj05_case_bands", """
SELECT CASE WHEN c_acctbal < 0 THEN 'NEGATIVE' WHEN c_acctbal < 2500 THEN 'LOW' WHEN c_acctbal < 7500 THEN 'MID' ELSE 'TOP' END AS band, COUNT(*) AS n
FROM customer GROUP BY 1""")
def prj05(spark, t):
    b = F.col("c_acctbal")
    band = F.when(b < 0, "NEGATIVE").when(b < 2500, "LOW").when(b < 7500, "MID").otherwise("TOP")
    return t.customer.groupBy(band.alias("band")).agg(F.count(F.lit(1)).alias("n"))


@query("prj06_clean_then_cast", """
WITH r AS (SELECT p_partkey, '$' || CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR) || CASE WHEN p_size > 45 THEN ' n/a x' ELSE '' END AS price_text, p_brand FROM part)
SELECT p_partkey, CAST(TRY_CAST(regexp_replace(price_text, '[$,]', '', 'g') AS DECIMAL(12,2)) AS DOUBLE) AS price,
       CAST(regexp_replace(p_brand, '[^0-9]', '', 'g') AS INTEGER) AS brand_no FROM r""")
def prj06(spark, t):
    text = F.concat(F.lit("$"), dec("p_retailprice").cast("string"), F.when(F.col("p_size") > 45, " n/a x").otherwise(""))
    return t.part.select(
        "p_partkey", F.regexp_replace(text, "[$,]", "").try_cast("decimal(12,2)").cast("double").alias("price"),
        F.regexp_replace("p_brand", "[^0-9]", "").cast("int").alias("brand_no"))


@query("prj07_distinct", "SELECT DISTINCT p_brand, p_type FROM part")
def prj07(spark, t):
    return t.part.select("p_brand", "p_type").distinct()


@query("prj08_parameters", """
SELECT n_name, COUNT(*) AS orders FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'EUROPE' AND o_orderdate >= TIMESTAMP '1997-01-01' GROUP BY 1""")
def prj08(spark, t):
    import datetime as dt

    t.views("orders", "customer", "nation", "region")
    return spark.sql("""
        SELECT n_name, COUNT(*) AS orders FROM orders JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
        WHERE r_name = :region AND o_orderdate >= :start GROUP BY n_name""",
        args={"region": "EUROPE", "start": dt.date(1997, 1, 1)})


@query("prj09_bernoulli_sample")
def prj09(spark, t):
    return t.orders.select("o_orderkey", "o_totalprice").sample(fraction=0.1, seed=42)


@query("prj09_sample_invariants", "SELECT COUNT(*) AS total, true AS share_as_asked, true AS rows_of_the_table, true AS repeatable FROM orders")
def prj09_invariants(spark, t):
    """A tenth of the rows within five standard deviations, each a row of the table and at most once, the same ones again with the same seed."""
    rows = t.orders.select("o_orderkey", "o_totalprice")
    first, second = (rows.sample(fraction=0.1, seed=42) for _ in range(2))
    content = lambda df: df.agg(F.sum(F.xxhash64("o_orderkey", "o_totalprice").cast("decimal(38,0)"))).scalar()
    count = F.count(F.lit(1))
    drawn, keys = first.agg(count).scalar(), first.agg(F.count_distinct("o_orderkey")).scalar()
    strangers = first.join(rows, rows.columns, "left_anti").agg(count).scalar()
    return rows.agg(count.alias("total")).select(
        "total", (F.abs(drawn - F.col("total") * 0.1) <= 5 * F.sqrt(F.col("total") * 0.09)).alias("share_as_asked"),
        ((strangers == 0) & (drawn == keys)).alias("rows_of_the_table"), (content(first) == content(second)).alias("repeatable"))


@query("prj10_temp_views", """
SELECT 'local' AS scope, true AS listed, true AS gone, COUNT(*) AS n FROM customer WHERE c_acctbal > 0
UNION ALL SELECT 'global', true, true, COUNT(*) FROM supplier WHERE s_acctbal > 0""")
def prj10(spark, t):
    t.customer.filter("c_acctbal > 0").createOrReplaceTempView("solvent_customers")
    t.supplier.filter("s_acctbal > 0").createOrReplaceGlobalTempView("solvent_suppliers")
    out = spark.sql("""SELECT 'local' AS scope, COUNT(*) AS n FROM solvent_customers
                       UNION ALL SELECT 'global', COUNT(*) FROM global_temp.solvent_suppliers""")
    names = {"local": (None, "solvent_customers"), "global": ("global_temp", "solvent_suppliers")}
    here = lambda scope: names[scope][1] in {v.name for v in spark.catalog.listTables(names[scope][0])}
    listed = {scope: here(scope) for scope in names}
    spark.catalog.dropTempView("solvent_customers")
    spark.catalog.dropGlobalTempView("solvent_suppliers")
    gone = {scope: not here(scope) for scope in names}
    by_scope = lambda found: F.when(F.col("scope") == "local", F.lit(found["local"])).otherwise(F.lit(found["global"]))
    return out.select("scope", by_scope(listed).alias("listed"), by_scope(gone).alias("gone"), "n")


@query("prj11_sargable_dates", f"""
SELECT 'year' AS grain, COUNT(*) AS n, {dsum('o_totalprice')} AS total FROM orders WHERE year(o_orderdate) = 1997
UNION ALL SELECT 'month', COUNT(*), {dsum('o_totalprice')} FROM orders WHERE year(o_orderdate) = 1998 AND month(o_orderdate) = 12
UNION ALL SELECT 'day', COUNT(*), {dsum('o_totalprice')} FROM orders WHERE CAST(o_orderdate AS DATE) = DATE '1999-05-17'""")
def prj11(spark, t):
    out = None
    for grain, value in (("year", "1997"), ("month", "1998-12"), ("day", "1999-05-17")):
        one = t.orders.filter(date_range_predicate("o_orderdate", grain, value)).agg(
            F.lit(grain).alias("grain"), F.count(F.lit(1)).alias("n"), exact_sum("o_totalprice").alias("total"))
        out = one if out is None else out.unionByName(one)
    return out
