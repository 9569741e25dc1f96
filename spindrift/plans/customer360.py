"""Golden customer record, layered load and point-in-time training rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from spindrift.functions.nested import with_ingest_metadata
from spindrift.functions.numeric import dec
from spindrift.operators.joins import interval_join
from spindrift.operators.merge import upsert
from spindrift.operators.quality import Rule, flag
from spindrift.operators.sets import dedup_latest
from spindrift.operators.windows import chunked_window
from spindrift.session import new_dir
from spindrift.sources.tables import Tables


def golden_record(t: Tables, master: DataFrame | None = None) -> DataFrame:
    """One row per customer from five sources, each aggregated to the key before it is joined.

    Missing sources give 0. With ``master`` the record is upserted into it.
    """
    orders = t.orders.groupBy(F.col("o_custkey").alias("k1")).agg(
        F.count(F.lit(1)).alias("total_orders"), F.sum(dec("o_totalprice")).alias("order_value"),
        F.max(dec("o_totalprice")).alias("max_order"), F.max("o_orderdate").alias("last_order"),
        F.count(F.when(F.col("o_orderstatus") == "F", 1)).alias("finished_orders"))
    lines = t.lineitem.select("l_orderkey", "l_quantity", "l_returnflag").join(
        t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")
    ).groupBy(F.col("o_custkey").alias("k2")).agg(
        F.sum(dec("l_quantity")).alias("units"), F.count(F.when(F.col("l_returnflag") == "R", 1)).alias("returned_lines"))
    visits = t.events.groupBy(F.col("user_id").alias("k3")).agg(
        F.count(F.lit(1)).alias("events"), F.count(F.when(F.col("event_type") == "purchase", 1)).alias("conversions"),
        F.max("ts").alias("last_event"), F.count_distinct("event_type").alias("event_types"))
    tickets = t.conversations.groupBy(F.col("conv_id").alias("k4")).agg(
        F.count(F.lit(1)).alias("messages"), F.count(F.when(F.col("role") == "user", 1)).alias("user_messages"))
    labels = t.labels.groupBy(F.col("doc_id").alias("k5")).agg(
        F.sum("quality").alias("good_documents"), F.sum("toxic").alias("toxic_documents"))
    out = t.customer.select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    for side, key in ((orders, "k1"), (lines, "k2"), (visits, "k3"), (tickets, "k4"), (labels, "k5")):
        out = out.join(side, F.col("c_custkey") == F.col(key), "left").drop(key)
    zero = ["total_orders", "finished_orders", "returned_lines", "events", "conversations", "conversions", "event_types",
            "messages", "user_messages", "good_documents", "toxic_documents"]
    out = out.fillna(0, [c for c in zero if c in out.columns])
    out = out.select(
        "c_custkey", "c_name", "c_mktsegment", "c_acctbal", "total_orders",
        F.coalesce(F.col("order_value").cast("double"), F.lit(0.0)).alias("order_value"),
        F.coalesce(F.col("max_order").cast("double"), F.lit(0.0)).alias("max_order"),
        F.coalesce(F.col("last_order").cast("string"), F.lit("never")).alias("last_order"),
        "finished_orders", F.coalesce(F.col("units").cast("double"), F.lit(0.0)).alias("units"), "returned_lines",
        "events", "conversions", F.coalesce(F.col("last_event").cast("string"), F.lit("never")).alias("last_event"),
        "event_types", "messages", "user_messages", "good_documents", "toxic_documents",
    )
    return out if master is None else upsert(master, out, ["c_custkey"])


def medallion(spark: SparkSession, t: Tables) -> DataFrame:
    """Two raw loads to bronze, one row per order to silver, monthly totals to gold; each layer is written."""
    base = t.orders.select("o_orderkey", "o_custkey", F.nullif("o_orderstatus", F.lit("P")).alias("status"),
                           "o_totalprice", "o_orderdate")
    again = t.orders.filter("o_orderpriority = '1-URGENT'").select(
        "o_orderkey", "o_custkey", F.col("o_orderstatus").alias("status"), (-F.col("o_totalprice")).alias("o_totalprice"),
        "o_orderdate")
    bronze = new_dir(spark, "bronze")
    with_ingest_metadata(base, "first", "b1", "2024-01-01 00:00:00").write.parquet(bronze)
    with_ingest_metadata(again, "again", "b2", "2024-01-02 00:00:00").write.mode("append").parquet(bronze)
    rules = [Rule("negative", "o_totalprice >= 0"), Rule("no_status", "status IS NOT NULL")]
    silver = new_dir(spark, "silver")
    latest = dedup_latest(spark.read.parquet(bronze), ["o_orderkey"], ["_ingested_at"])
    flag(latest, rules).fillna({"status": "unknown"}).write.parquet(silver)
    rows = spark.read.parquet(silver)
    customers = t.customer.select("c_custkey", "c_mktsegment")
    value = F.when(~F.col("dq_negative"), dec("o_totalprice")).otherwise(F.lit(0).cast("decimal(12,2)"))
    return rows.join(customers, F.col("o_custkey") == F.col("c_custkey"), "left").groupBy(
        F.date_format("o_orderdate", "yyyy-MM").alias("month"), "c_mktsegment"
    ).agg(
        F.count(F.lit(1)).alias("orders"),
        F.count(F.when(F.col("dq_negative"), 1)).alias("negative"),
        F.count(F.when(F.col("dq_no_status"), 1)).alias("no_status"),
        F.sum(value).cast("double").alias("revenue"),
    )


def training_rows(t: Tables) -> DataFrame:
    """Each labelled order with the customer's features valid at its time."""
    labels = t.orders.filter("o_orderstatus = 'F'").select("o_orderkey", "o_custkey", "o_orderdate")
    daily = t.orders.groupBy("o_custkey", F.col("o_orderdate").alias("feature_time")).agg(
        F.sum(dec("o_totalprice")).cast("double").alias("day_spend"), F.count(F.lit(1)).alias("day_orders"))
    versions = chunked_window(daily, ["o_custkey"], ["feature_time"], sizes=t.orders, lead={"until": "feature_time"})
    return interval_join(labels, versions, "o_custkey", "o_orderdate", "feature_time", "until").select(
        "o_orderkey", "o_custkey", F.col("feature_time").cast("string").alias("feature_time"), "day_spend", "day_orders")
