"""Sales jobs: enriched lines, daily and product totals, lifetime value, stock alerts, trends."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from spindrift.functions.numeric import dec, exact_sum, ratio
from spindrift.operators.joins import dim_join
from spindrift.sources.tables import Tables


def line_total() -> Column:
    """Price after discount, exact to four digits; 17 digits, so each value is a plain long."""
    return dec("l_extendedprice", 2, 11) * (F.lit(1).cast("decimal(3,2)") - dec("l_discount", 2, 4))


def sales_lines(t: Tables) -> DataFrame:
    """One row per order line with its order, product, customer and region.

    Lines and orders meet in one shuffle join; the dimensions are broadcast while small.
    """
    lines = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag", "l_shipdate",
                              "l_extendedprice", line_total().alias("line_total"))
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate")
    parts = t.part.select("p_partkey", "p_name", "p_brand", "p_type", "p_retailprice")
    customers = t.customer.select("c_custkey", "c_nationkey", "c_mktsegment")
    sold = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    sold = dim_join(sold, parts, F.col("l_partkey") == F.col("p_partkey"), "left")
    sold = dim_join(sold, customers, F.col("o_custkey") == F.col("c_custkey"), "left")
    sold = dim_join(sold, t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    sold = dim_join(sold, t.region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    cost = dec("l_quantity", 2, 6) * dec("p_retailprice", 2, 10)
    return sold.withColumns({
        "order_date": F.to_date("o_orderdate"),
        "line_profit": F.col("line_total") - cost,
    })


def order_totals(t: Tables, profit: bool = False) -> DataFrame:
    """Lines added up to one row per order, beside the order's customer and day.

    The sums use the shuffle by order key that the join needs anyway, and orders can then
    be counted instead of counted distinct.
    """
    lines = t.lineitem.select("l_orderkey", "l_partkey", dec("l_quantity", 2, 6).alias("q"), line_total().alias("line_total"))
    sums = [F.sum("q").alias("units"), F.sum("line_total").alias("revenue"), F.count(F.lit(1)).alias("lines")]
    if profit:
        price = t.part.select("p_partkey", dec("p_retailprice", 2, 10).alias("price"))
        lines = dim_join(lines, price, F.col("l_partkey") == F.col("p_partkey"), "left")
        sums.append(F.sum(F.col("line_total") - F.col("q") * F.col("price")).alias("profit"))
    orders = t.orders.select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("order_date"))
    return lines.groupBy("l_orderkey").agg(*sums).join(orders, F.col("l_orderkey") == F.col("o_orderkey"))


def daily_sales(t: Tables) -> DataFrame:
    """Orders, units, revenue and customers per day."""
    return order_totals(t).groupBy(F.col("order_date").cast("string").alias("order_date")).agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.sum("units").cast("double").alias("total_units"),
        F.sum("revenue").cast("double").alias("total_revenue"),
        (F.sum("revenue").cast("double") / F.sum("lines")).alias("avg_line_value"),
        F.count_distinct("o_custkey").alias("unique_customers"),
    )


def top_products(t: Tables) -> DataFrame:
    """Orders, units, revenue and profit per product: lines are aggregated before the product is joined."""
    lines = t.lineitem.select("l_partkey", "l_orderkey", dec("l_quantity").alias("q"), line_total().alias("line_total"))
    per_part = lines.groupBy("l_partkey").agg(
        F.count_distinct("l_orderkey").alias("order_count"),
        F.sum("q").alias("units"), F.sum("line_total").alias("revenue"),
    )
    return per_part.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        "p_partkey", "p_name", "p_brand", "order_count",
        F.col("units").cast("double").alias("total_units"),
        F.col("revenue").cast("double").alias("total_revenue"),
        (F.col("revenue") - F.col("units") * dec("p_retailprice")).cast("double").alias("total_profit"),
    )


def category_margin(t: Tables) -> DataFrame:
    """Revenue, profit and margin per product type and region.

    Lines are first added up per order and type, on the shuffle by order key that the join needs anyway. An order has one region, so that distinct orders are
    rows from there on, and the dimensions of customers meet one row per order and type.
    """
    lines = t.lineitem.select("l_orderkey", "l_partkey", dec("l_quantity").alias("q"), line_total().alias("line_total"))
    parts = t.part.select("p_partkey", "p_type", dec("p_retailprice", 2, 10).alias("price"))
    priced = dim_join(lines, parts, F.col("l_partkey") == F.col("p_partkey"), "left")
    sold = priced.join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    per_order = sold.groupBy("l_orderkey", "o_custkey", "p_type").agg(
        F.sum("q").alias("units"), F.sum("line_total").alias("revenue"),
        F.sum(F.col("line_total") - F.col("q").cast("decimal(6,2)") * F.col("price")).alias("profit"))
    placed = dim_join(per_order, t.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"), "left")
    placed = dim_join(placed, t.nation.select("n_nationkey", "n_regionkey"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    placed = dim_join(placed, t.region.select("r_regionkey", "r_name"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return placed.groupBy("p_type", "r_name").agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.sum("units").cast("double").alias("total_units"),
        F.sum("revenue").cast("double").alias("total_revenue"),
        F.sum("profit").cast("double").alias("total_profit"),
        (ratio(F.sum("profit"), F.sum("revenue")) * 100.0).alias("margin_pct"),
    )


def return_rate(t: Tables) -> DataFrame:
    """Share of returned lines per customer region."""
    return sales_lines(t).groupBy("r_name").agg(
        F.count(F.lit(1)).alias("lines"),
        F.count(F.when(F.col("l_returnflag") == "R", 1)).alias("returned"),
        (F.count(F.when(F.col("l_returnflag") == "R", 1)) * 100.0 / F.count(F.lit(1))).cast("double").alias("return_pct"),
    )


def customer_totals(t: Tables) -> DataFrame:
    """Orders and spend per customer."""
    return t.orders.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("order_count"), F.sum(dec("o_totalprice")).alias("spend"),
    )


# fixed values: spending bands and loyalty tiers
SPEND_BANDS = ((5_000_000, "PREMIUM"), (2_000_000, "HIGH"), (500_000, "MEDIUM"))
LOYALTY_TIERS = ((3_000_000, "PLATINUM"), (2_000_000, "GOLD"), (1_000_000, "SILVER"))


def banded(value: Column, bands, otherwise: str) -> Column:
    label = F.lit(otherwise)
    for least, name in sorted(bands):
        label = F.when(value >= least, name).otherwise(label)
    return label


def spending_bands(t: Tables) -> DataFrame:
    """Customers and spend per band of total spend."""
    return customer_totals(t).groupBy(banded(F.col("spend"), SPEND_BANDS, "LOW").alias("band")).agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum("spend").cast("double").alias("total_spend"),
    )


def lifetime_value(t: Tables) -> DataFrame:
    """Orders, revenue, profit, first and last order and distinct products per customer."""
    per_customer = order_totals(t, profit=True).groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("lifetime_orders"),
        F.sum("revenue").cast("double").alias("lifetime_revenue"),
        F.sum("profit").cast("double").alias("lifetime_profit"),
        (F.sum("revenue").cast("double") / F.sum("lines")).alias("avg_line_value"),
        F.min("order_date").cast("string").alias("first_order_date"),
        F.max("order_date").cast("string").alias("last_order_date"),
    )
    bought = t.lineitem.select("l_orderkey", "l_partkey").join(
        t.orders.select("o_orderkey", F.col("o_custkey").alias("buyer")), F.col("l_orderkey") == F.col("o_orderkey"))
    products = bought.groupBy("buyer").agg(F.count_distinct("l_partkey").alias("unique_products"))
    whole = per_customer.join(products, F.col("o_custkey") == F.col("buyer")).drop("buyer")
    who = dim_join(t.customer.select("c_custkey", "c_nationkey", "c_mktsegment"), t.nation.select("n_nationkey", "n_name"),
                   F.col("c_nationkey") == F.col("n_nationkey"), "left").select("c_custkey", "c_mktsegment", "n_name")
    return whole.join(who, F.col("o_custkey") == F.col("c_custkey"), "left").drop("c_custkey")


def loyalty(t: Tables) -> DataFrame:
    """Tier by total spend; customers without orders are BRONZE."""
    spent = t.customer.select("c_custkey").join(customer_totals(t), F.col("c_custkey") == F.col("o_custkey"), "left")
    spend = F.coalesce(F.col("spend"), F.lit(0).cast("decimal(22,2)"))
    return spent.select(
        "c_custkey", F.coalesce("order_count", F.lit(0)).alias("order_count"),
        spend.cast("double").alias("total_spend"), banded(spend, LOYALTY_TIERS, "BRONZE").alias("tier"),
    )


def inventory(t: Tables, days: int = 30) -> DataFrame:
    """Stock status, days to stock-out and reorder quantity from the sales of the last ``days`` days.

    The day to look back from is the newest order in the data. Stock on hand, threshold
    and reorder quantity are attributes derived from the part.
    """
    newest = t.orders.agg(F.max(F.to_date("o_orderdate"))).scalar()
    recent = t.orders.filter(F.to_date("o_orderdate") >= F.date_sub(newest, days)).select("o_orderkey")
    sold = t.lineitem.join(recent, F.col("l_orderkey") == F.col("o_orderkey"), "left_semi").groupBy("l_partkey").agg(
        F.sum(dec("l_quantity")).alias("units"))
    stock = t.part.select(
        "p_partkey", "p_name",
        ((F.col("p_partkey") * 7) % 60).alias("on_hand"),
        (F.col("p_size") % 20).cast("bigint").alias("threshold"),
        (F.col("p_size") * 2).cast("bigint").alias("reorder_qty"),
    )
    both = stock.join(sold, F.col("p_partkey") == F.col("l_partkey"), "left")
    units = F.coalesce(F.col("units").cast("double"), F.lit(0.0))
    rate = units / F.lit(float(days))
    status = F.when(F.col("on_hand") == 0, "OUT_OF_STOCK").when(
        F.col("on_hand") <= F.col("threshold"), "LOW_STOCK").otherwise("IN_STOCK")
    return both.select(
        "p_partkey", "p_name", "on_hand", units.alias("units_sold"), rate.alias("daily_rate"),
        status.alias("stock_status"),
        F.when(rate > 0, F.col("on_hand") / rate).alias("days_until_stockout"),
        F.when(status != "IN_STOCK", F.col("reorder_qty")).otherwise(F.lit(0).cast("bigint")).alias("suggested_reorder"),
    )


def features(t: Tables, as_of: str) -> DataFrame:
    """Customer features known at ``as_of`` and churn risk by recency; later orders are not seen."""
    known = t.orders.filter(F.col("o_orderdate") < F.lit(as_of).cast("timestamp_ntz"))
    idle = F.datediff(F.lit(as_of).cast("date"), F.to_date(F.max("o_orderdate")))
    return known.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("lifetime_orders"),
        F.sum(dec("o_totalprice")).cast("double").alias("lifetime_value"),
        (F.sum(dec("o_totalprice")).cast("double") / F.count(F.lit(1))).alias("avg_order_value"),
        F.datediff(F.lit(as_of).cast("date"), F.to_date(F.min("o_orderdate"))).cast("bigint").alias("days_since_first"),
        F.count_distinct("o_orderpriority").alias("priorities_used"),
        idle.cast("bigint").alias("days_idle"),
        F.when(idle > 90, "HIGH").when(idle > 60, "MEDIUM").otherwise("LOW").alias("churn_risk"),
    )


def net_lines(t: Tables) -> DataFrame:
    """Gross, discount and net value per line."""
    gross = dec("l_extendedprice")
    off = gross * dec("l_discount", 2, 4)
    lines = t.lineitem.select("l_orderkey", "l_quantity", gross.alias("gross"), off.alias("discount_amount"),
                              (gross - off).alias("net_revenue"))
    orders = t.orders.select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("order_date"))
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))


def net_daily(t: Tables) -> DataFrame:
    return net_lines(t).groupBy(F.col("order_date").cast("string").alias("order_date")).agg(
        F.sum("net_revenue").cast("double").alias("net_revenue"),
        F.sum("discount_amount").cast("double").alias("discounts"),
        F.count(F.lit(1)).alias("lines"),
        exact_sum("l_quantity").alias("units"),
    )


def net_by_tier(t: Tables) -> DataFrame:
    """Net revenue and customers per loyalty tier."""
    per_customer = net_lines(t).groupBy("o_custkey").agg(F.sum("net_revenue").alias("net"), F.count(F.lit(1)).alias("lines"))
    tiers = loyalty(t).select("c_custkey", "tier")
    return per_customer.join(tiers, F.col("o_custkey") == F.col("c_custkey"), "left").groupBy("tier").agg(
        F.sum("net").cast("double").alias("net_revenue"),
        F.count(F.lit(1)).alias("customers"),
        (F.sum("net").cast("double") / F.sum("lines")).alias("avg_net_per_line"),
    )


def monthly_trend(t: Tables) -> DataFrame:
    """Revenue per month and region, change on the month before, running total and rank.

    The windows run over the monthly totals, whose number the calendar bounds.
    """
    monthly = sales_lines(t).groupBy("r_name", F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(
        F.sum("line_total").alias("rev"))
    w = Window.partitionBy("r_name").orderBy("month")
    before = F.lag("rev").over(w).cast("double")
    return monthly.select(
        "r_name", "month", F.col("rev").cast("double").alias("revenue"),
        ((F.col("rev").cast("double") - before) * 100.0 / F.nullif(before, F.lit(0.0))).alias("change_pct"),
        F.sum("rev").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("double").alias("running_revenue"),
        F.rank().over(Window.partitionBy("month").orderBy(F.desc("rev"))).alias("rank_in_month"),
    )


def product_rank(t: Tables, k: int = 3) -> DataFrame:
    """Best ``k`` products per region by revenue."""
    totals = sales_lines(t).groupBy("r_name", "p_partkey").agg(F.sum("line_total").alias("rev"))
    w = Window.partitionBy("r_name").orderBy(F.desc("rev"), "p_partkey")
    return totals.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= k).select(
        "r_name", "p_partkey", F.col("rev").cast("double").alias("revenue"), "rn")


def clean_sales(df: DataFrame, amount: str, customer: str, product: str) -> DataFrame:
    """NULL and negative amounts become 0, missing ids UNKNOWN; adds a value band."""
    value = F.when(F.col(amount) > 0, dec(amount)).otherwise(F.lit(0).cast("decimal(12,2)"))
    return df.withColumns({
        amount: value,
        customer: F.coalesce(F.col(customer), F.lit("UNKNOWN")),
        product: F.coalesce(F.col(product), F.lit("UNKNOWN")),
    }).withColumn("value_band", F.when(F.col(amount) > 500, "high_value")
                  .when(F.col(amount) > 100, "medium").otherwise("low"))
