"""Merge, history, change capture and incremental loads (M)."""

from pyspark.sql import functions as F

from spindrift.operators import history, layout, merge
from spindrift.plans import customer360
from spindrift.queries import query
from spindrift.session import new_dir
from spindrift.sources import ingest
from spindrift.sources.versions import last_version, read_version, write_version

KEYS = ["c_custkey"]
TRACKED = ["c_acctbal", "c_mktsegment"]

V1 = """
v1 AS (
  SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_acctbal < 0 THEN 0.0::DOUBLE ELSE c_acctbal END AS c_acctbal,
         CASE WHEN c_acctbal < 0 THEN 'COLLECTIONS' WHEN c_acctbal BETWEEN 5000 AND 5200 THEN NULL ELSE c_mktsegment END AS c_mktsegment
  FROM customer WHERE c_acctbal <= 9500
  UNION ALL SELECT s_suppkey + 10000000, s_name, s_nationkey, s_acctbal, 'SUPPLIER' FROM supplier
)"""
V2 = V1 + """,
v2 AS (
  SELECT c_custkey, c_name, c_nationkey, c_acctbal, CASE WHEN c_mktsegment = 'BUILDING' THEN 'CONSTRUCTION' ELSE c_mktsegment END AS c_mktsegment
  FROM v1 WHERE NOT (c_mktsegment IS NOT DISTINCT FROM 'SUPPLIER' AND c_acctbal < 2000)
)"""
COLS = "c_custkey, c_name, c_nationkey, c_acctbal, coalesce(c_mktsegment, 'none') AS c_mktsegment"


def later(t):
    """The customers one load later: some closed, changed, emptied or new."""
    balance, segment = F.col("c_acctbal"), F.col("c_mktsegment")
    kept = t.customer.filter("c_acctbal <= 9500").select(
        "c_custkey", "c_name", "c_nationkey", F.when(balance < 0, 0.0).otherwise(balance).alias("c_acctbal"),
        F.when(balance < 0, "COLLECTIONS").when(balance.between(5000, 5200), F.lit(None)).otherwise(segment).alias("c_mktsegment"))
    new = t.supplier.select((F.col("s_suppkey") + 10_000_000).alias("c_custkey"), F.col("s_name").alias("c_name"),
                            F.col("s_nationkey").alias("c_nationkey"), F.col("s_acctbal").alias("c_acctbal"),
                            F.lit("SUPPLIER").alias("c_mktsegment"))
    return kept.unionByName(new)


def latest(t):
    """Two loads later."""
    v1 = later(t)
    gone = F.col("c_mktsegment").eqNullSafe("SUPPLIER") & (F.col("c_acctbal") < 2000)
    segment = F.when(F.col("c_mktsegment") == "BUILDING", "CONSTRUCTION").otherwise(F.col("c_mktsegment"))
    return v1.filter(~gone).withColumn("c_mktsegment", segment)


def shown(df):
    return df.select("c_custkey", "c_name", "c_nationkey", "c_acctbal", F.coalesce("c_mktsegment", F.lit("none")).alias("c_mktsegment"))


@query("m01_merge", f"""
WITH {V1}
SELECT {COLS} FROM (
  SELECT t.c_custkey, CASE WHEN s.c_acctbal <> t.c_acctbal THEN upper(s.c_name) ELSE t.c_name END AS c_name, t.c_nationkey,
         CASE WHEN s.c_custkey IS NULL THEN t.c_acctbal WHEN s.c_acctbal <> t.c_acctbal THEN s.c_acctbal ELSE t.c_acctbal END AS c_acctbal,
         CASE WHEN s.c_custkey IS NULL THEN t.c_mktsegment WHEN s.c_acctbal <> t.c_acctbal THEN s.c_mktsegment ELSE t.c_mktsegment END AS c_mktsegment
  FROM customer t LEFT JOIN v1 s ON t.c_custkey = s.c_custkey WHERE NOT (s.c_custkey IS NOT NULL AND s.c_mktsegment IS NULL)
  UNION ALL
  SELECT c_custkey, c_name, CASE WHEN c_acctbal > 5000 THEN c_nationkey ELSE -1 END, c_acctbal, c_mktsegment FROM v1 s
  WHERE c_acctbal > 0 AND NOT EXISTS (SELECT 1 FROM customer t WHERE t.c_custkey = s.c_custkey))""")
def m01(spark, t):
    out = merge.merge(t.customer, later(t), KEYS, [
        merge.delete(when="source.c_mktsegment IS NULL"),
        merge.WhenMatched({"c_name": "upper(source.c_name)", "c_acctbal": "source.c_acctbal", "c_mktsegment": "source.c_mktsegment"},
                          when="source.c_acctbal <> target.c_acctbal"),
        merge.insert_all(when="source.c_acctbal > 5000"),
        merge.WhenNotMatched({"c_custkey": "source.c_custkey", "c_name": "source.c_name", "c_nationkey": "-1",
                              "c_acctbal": "source.c_acctbal", "c_mktsegment": "source.c_mktsegment"}, when="source.c_acctbal > 0"),
    ])
    return shown(out)


@query("m01_merge_scoped", f"""
WITH {V1}
SELECT {COLS} FROM (
  SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer WHERE c_nationkey >= 10
  UNION ALL
  SELECT t.c_custkey, coalesce(s.c_name, t.c_name), t.c_nationkey, coalesce(s.c_acctbal, t.c_acctbal),
         CASE WHEN s.c_custkey IS NULL THEN t.c_mktsegment ELSE s.c_mktsegment END
  FROM (SELECT * FROM customer WHERE c_nationkey < 10) t LEFT JOIN v1 s ON t.c_custkey = s.c_custkey
  UNION ALL SELECT * FROM v1 s WHERE c_nationkey < 10 AND c_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey < 10))""")
def m01_scoped(spark, t):
    """Only target rows of some nations take part; the rest is not shuffled."""
    return shown(merge.merge(t.customer, later(t).filter("c_nationkey < 10"), KEYS, [merge.update_all(), merge.insert_all()],
                             target_pred="c_nationkey < 10"))


@query("m02_insert_only", f"""
WITH {V1} SELECT {COLS} FROM (SELECT * FROM customer UNION ALL SELECT * FROM v1 WHERE c_custkey NOT IN (SELECT c_custkey FROM customer))""")
def m02(spark, t):
    once = merge.insert_missing(t.customer, later(t), KEYS)
    return shown(merge.insert_missing(once, later(t), KEYS))


@query("m03_update_delete", """
WITH u AS (
  SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_mktsegment = 'FURNITURE' THEN c_acctbal + 100 ELSE c_acctbal END AS c_acctbal,
         CASE WHEN c_mktsegment = 'FURNITURE' THEN 'HOME' ELSE c_mktsegment END AS c_mktsegment FROM customer
)
SELECT * FROM u WHERE NOT c_acctbal < -500 AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 490000)""")
def m03(spark, t):
    updated = merge.update_where(t.customer, "c_mktsegment = 'FURNITURE'", {"c_acctbal": "c_acctbal + 100", "c_mktsegment": "'HOME'"})
    kept = merge.delete_where(updated, "c_acctbal < -500")
    erase = t.orders.filter("o_totalprice > 490000").select(F.col("o_custkey").alias("c_custkey")).distinct()
    return merge.delete_keys(kept, erase, KEYS)


@query("m03_delete_insert", f"WITH {V1} SELECT {COLS} FROM (SELECT * FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM v1) UNION ALL SELECT * FROM v1)")
def m03_delete_insert(spark, t):
    v1 = later(t)
    return shown(merge.delete_keys(t.customer, v1, KEYS).unionByName(v1))


@query("m04_scd_type1", f"WITH {V1} SELECT {COLS} FROM (SELECT * FROM v1 UNION ALL SELECT * FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM v1))")
def m04(spark, t):
    path = new_dir(spark, "scd1")
    write_version(t.customer, path)
    write_version(history.scd1(read_version(spark, path), later(t), KEYS), path)
    return shown(read_version(spark, path))


SCD2 = V2 + """,
snaps AS (SELECT *, DATE '2024-01-01' AS d FROM customer UNION ALL SELECT *, DATE '2024-02-01' FROM v1 UNION ALL SELECT *, DATE '2024-03-01' FROM v2),
seen AS (
  SELECT *, row_number() OVER w AS rn, lag(c_acctbal) OVER w AS pb, lag(c_mktsegment) OVER w AS ps FROM snaps
  WINDOW w AS (PARTITION BY c_custkey ORDER BY d)
),
vers AS (
  SELECT c_custkey, c_acctbal, c_mktsegment, d AS eff_start, lead(d) OVER (PARTITION BY c_custkey ORDER BY d) AS eff_end
  FROM seen WHERE rn = 1 OR c_acctbal IS DISTINCT FROM pb OR c_mktsegment IS DISTINCT FROM ps
)"""
SCD2_COLS = """c_custkey, c_acctbal, coalesce(c_mktsegment, 'none') AS c_mktsegment, CAST(eff_start AS VARCHAR) AS eff_start,
 coalesce(CAST(eff_end AS VARCHAR), 'open') AS eff_end, eff_end IS NULL AS is_current"""


def versions(t):
    dim = history.open_history(t.customer, "2024-01-01")
    dim = history.scd2(dim, later(t), KEYS, TRACKED, "2024-02-01")
    return history.scd2(dim, latest(t), KEYS, TRACKED, "2024-03-01")


def shown2(dim):
    return dim.select("c_custkey", "c_acctbal", F.coalesce("c_mktsegment", F.lit("none")).alias("c_mktsegment"),
                      F.col("eff_start").cast("string").alias("eff_start"),
                      F.coalesce(F.col("eff_end").cast("string"), F.lit("open")).alias("eff_end"),
                      F.col("eff_end").isNull().alias("is_current"))


@query("m05_scd_type2", f"WITH {SCD2} SELECT {SCD2_COLS} FROM vers")
def m05(spark, t):
    return shown2(versions(t))


@query("m05_scd_type2_rerun", f"WITH {SCD2} SELECT {SCD2_COLS} FROM vers")
def m05_rerun(spark, t):
    """A second run of the last load on the same day changes nothing."""
    return shown2(history.scd2(versions(t), latest(t), KEYS, TRACKED, "2024-03-01"))


OPS = "CASE event_type WHEN 'signup' THEN 'INSERT' WHEN 'error' THEN 'DELETE' ELSE 'UPDATE' END"


def change_log(t):
    """Events as a log of changes to users: signups insert, errors delete, others update."""
    op = F.when(F.col("event_type") == "signup", "INSERT").when(F.col("event_type") == "error", "DELETE").otherwise("UPDATE")
    return t.events.select("user_id", "value", "props", F.col("event_id").alias("seq"), op.alias("op"))


@query("m06_cdc_type1", f"""
SELECT user_id, value, props, event_id AS seq FROM (SELECT *, {OPS} AS op, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events)
WHERE rn = 1 AND op <> 'DELETE'""")
def m06(spark, t):
    log = change_log(t)
    # the later half arrives first: tombstones keep the outcome the same
    first = history.apply_cdc(log.filter("value > 40"), ["user_id"], "seq", "op")
    return history.live_rows(history.apply_cdc(log.filter("value <= 40"), ["user_id"], "seq", "op", target=first)).select(
        "user_id", "value", "props", "seq")


@query("m06_cdc_type2", f"""
SELECT user_id, value, event_id AS valid_from, coalesce(nxt, -1) AS valid_to, nxt IS NULL AS is_current FROM (
  SELECT *, {OPS} AS op, lead(event_id) OVER (PARTITION BY user_id ORDER BY event_id) AS nxt FROM events) WHERE op <> 'DELETE'""")
def m06_type2(spark, t):
    hist = history.apply_cdc(change_log(t), ["user_id"], "seq", "op", scd_type=2)
    return hist.select("user_id", "value", "valid_from", F.coalesce("valid_to", F.lit(-1)).alias("valid_to"), "is_current")


@query("m07_history_views", f"""
WITH {SCD2}
SELECT 'current' AS kind, c_mktsegment AS seg, n, total FROM (SELECT coalesce(c_mktsegment, 'none') AS c_mktsegment, COUNT(*) AS n, CAST(SUM(CAST(c_acctbal AS DECIMAL(12,2))) AS DOUBLE) AS total FROM vers WHERE eff_end IS NULL GROUP BY 1)
UNION ALL
SELECT 'february', c_mktsegment, n, total FROM (SELECT coalesce(c_mktsegment, 'none') AS c_mktsegment, COUNT(*) AS n, CAST(SUM(CAST(c_acctbal AS DECIMAL(12,2))) AS DOUBLE) AS total
 FROM vers WHERE eff_start <= DATE '2024-02-15' AND (eff_end IS NULL OR eff_end > DATE '2024-02-15') GROUP BY 1)""")
def m07(spark, t):
    path = new_dir(spark, "scd2")
    write_version(versions(t), path)
    dim = read_version(spark, path)

    def summary(rows, kind):
        return rows.groupBy(F.coalesce("c_mktsegment", F.lit("none")).alias("seg")).agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.col("c_acctbal").cast("decimal(12,2)")).cast("double").alias("total")
        ).withColumn("kind", F.lit(kind))

    return summary(history.current(dim), "current").unionByName(
        summary(history.as_of(dim, F.lit("2024-02-15").cast("date")), "february"))


def feed_sql(old, new, version, ts):
    diff = "(n.c_acctbal IS DISTINCT FROM o.c_acctbal OR n.c_mktsegment IS DISTINCT FROM o.c_mktsegment OR n.c_name IS DISTINCT FROM o.c_name OR n.c_nationkey IS DISTINCT FROM o.c_nationkey)"
    tail = f"{version} AS v, '{ts}' AS committed"
    return f"""
  SELECT n.*, 'insert' AS kind, {tail} FROM {new} n WHERE n.c_custkey NOT IN (SELECT c_custkey FROM {old})
  UNION ALL SELECT o.*, 'delete', {tail} FROM {old} o WHERE o.c_custkey NOT IN (SELECT c_custkey FROM {new})
  UNION ALL SELECT o.*, 'update_preimage', {tail} FROM {old} o JOIN {new} n ON o.c_custkey = n.c_custkey WHERE {diff}
  UNION ALL SELECT n.*, 'update_postimage', {tail} FROM {old} o JOIN {new} n ON o.c_custkey = n.c_custkey WHERE {diff}"""


@query("m08_change_feed", f"""
WITH {V2}, f AS ({feed_sql('customer', 'v1', 1, '2024-02-01 00:00:00')} UNION ALL {feed_sql('v1', 'v2', 2, '2024-03-01 00:00:00')})
SELECT {COLS}, kind AS _change_type, CAST(v AS BIGINT) AS _commit_version, committed AS _commit_timestamp FROM f""")
def m08(spark, t):
    return shown_feed(feed(t, initial=False))


def feed(t, initial=True):
    v1, v2 = later(t), latest(t)
    out = history.change_feed(t.customer, v1, KEYS, 1, "2024-02-01 00:00:00").unionByName(
        history.change_feed(v1, v2, KEYS, 2, "2024-03-01 00:00:00"))
    return history.initial_feed(t.customer, 0, "2024-01-01 00:00:00").unionByName(out) if initial else out


def shown_feed(f):
    return f.select("c_custkey", "c_name", "c_nationkey", "c_acctbal", F.coalesce("c_mktsegment", F.lit("none")).alias("c_mktsegment"),
                    "_change_type", "_commit_version", F.col("_commit_timestamp").cast("string").alias("_commit_timestamp"))


@query("m09_state_as_of_version", f"WITH {V1} SELECT {COLS} FROM v1")
def m09(spark, t):
    return shown(history.state_as_of(feed(t), KEYS, version=1))


@query("src25_time_travel", f"WITH {V2} SELECT {COLS} FROM v2")
def src25(spark, t):
    return shown(history.state_as_of(feed(t), KEYS, ts="2024-03-15 00:00:00"))


@query("m10_apply_feed", f"WITH {V2} SELECT {COLS} FROM v2")
def m10(spark, t):
    """A downstream copy that stopped at version 0 catches up."""
    return shown(history.apply_feed(t.customer, feed(t), KEYS, after_version=0))


@query("m11_event_time_guard", """
WITH s AS (SELECT user_id, arg_max(value, (ts, event_id)) AS value, max(ts) AS ts FROM events WHERE event_type = 'click' GROUP BY 1),
tg AS (SELECT user_id, arg_max(value, (ts, event_id)) AS value, max(ts) AS ts FROM events WHERE event_type = 'view' GROUP BY 1)
SELECT coalesce(tg.user_id, s.user_id) AS user_id, CASE WHEN tg.user_id IS NULL OR s.ts >= tg.ts THEN s.value ELSE tg.value END AS value,
       CAST(CASE WHEN tg.user_id IS NULL OR s.ts >= tg.ts THEN s.ts ELSE tg.ts END AS VARCHAR) AS ts
FROM tg FULL JOIN s ON tg.user_id = s.user_id""")
def m11(spark, t):
    def last(kind):
        return t.events.filter(F.col("event_type") == kind).groupBy("user_id").agg(
            F.max_by("value", F.struct("ts", "event_id")).alias("value"), F.max("ts").alias("ts"))

    return merge.upsert_if_newer(last("view"), last("click"), ["user_id"], "ts").withColumn("ts", F.col("ts").cast("string"))


@query("m12_new_batches", """
SELECT strftime(ts, '%Y-%m-%d') AS batch, COUNT(*) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-15' GROUP BY 1""")
def m12(spark, t):
    """Load the batches of the first days, record them, then load what is not recorded."""
    rows = t.events.withColumn("batch", F.date_format("ts", "yyyy-MM-dd"))
    done = new_dir(spark, "m12-done")
    rows.filter("ts < TIMESTAMP_NTZ '2024-01-15 00:00:00'").select("batch").distinct().write.parquet(done)
    return ingest.new_batches(rows, spark.read.parquet(done), "batch").groupBy("batch").agg(F.count(F.lit(1)).alias("n"))


@query("m13_high_watermark", """
SELECT COUNT(*) AS n, min(event_id) AS first_id, max(event_id) AS last_id FROM events WHERE ts > (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '2024-01-20')""")
def m13(spark, t):
    state = new_dir(spark, "m13-state")
    first = ingest.above_watermark(t.events.filter("ts < TIMESTAMP_NTZ '2024-01-20 00:00:00'"), "ts", None)
    ingest.watermark_of(first, "ts").write.parquet(state)
    second = ingest.above_watermark(t.events, "ts", spark.read.parquet(state))
    return second.agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id"))


@query("m14_idempotent_ingest", f"WITH {V1} SELECT {COLS} FROM (SELECT * FROM v1 UNION ALL SELECT * FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM v1))")
def m14(spark, t):
    path = new_dir(spark, "m14")
    write_version(t.customer, path)
    for _ in range(2):
        write_version(ingest.idempotent_ingest(read_version(spark, path), later(t), KEYS), path)
    return shown(read_version(spark, path, last_version(spark, path)))


@query("m15_write_amplification")
def m15(spark, t):
    """Share of files a keyed update would rewrite, in load order and after clustering."""
    plain, clustered = new_dir(spark, "m15-plain"), new_dir(spark, "m15-clustered")
    t.orders.repartition(layout.pieces(t.orders, 16)).write.parquet(plain)
    layout.zorder_write(t.orders, ["o_custkey"], clustered)
    keys = t.customer.filter("c_custkey BETWEEN 100 AND 140").select(F.col("c_custkey").alias("o_custkey"))
    out = None
    for name, path in (("plain", plain), ("clustered", clustered)):
        one = layout.write_amplification(spark.read.parquet(path), keys, "o_custkey").withColumn("layout", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return out


@query("m16_golden_record", """
WITH o AS (SELECT o_custkey, COUNT(*) AS total_orders, CAST(SUM(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS order_value, MAX(o_totalprice) AS max_order,
  CAST(MAX(o_orderdate) AS VARCHAR) AS last_order, COUNT(*) FILTER (o_orderstatus = 'F') AS finished_orders FROM orders GROUP BY 1),
l AS (SELECT o_custkey, CAST(SUM(CAST(l_quantity AS DECIMAL(12,2))) AS DOUBLE) AS units, COUNT(*) FILTER (l_returnflag = 'R') AS returned_lines
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1),
e AS (SELECT user_id, COUNT(*) AS events, COUNT(*) FILTER (event_type = 'purchase') AS conversions, CAST(MAX(ts) AS VARCHAR) AS last_event, COUNT(DISTINCT event_type) AS event_types FROM events GROUP BY 1),
v AS (SELECT conv_id, COUNT(*) AS messages, COUNT(*) FILTER (role = 'user') AS user_messages FROM conversations GROUP BY 1),
q AS (SELECT doc_id, CAST(SUM(quality) AS BIGINT) AS good_documents, CAST(SUM(toxic) AS BIGINT) AS toxic_documents FROM labels GROUP BY 1)
SELECT c_custkey, c_name, c_mktsegment, c_acctbal, coalesce(total_orders, 0) AS total_orders, coalesce(order_value, 0) AS order_value,
 coalesce(max_order, 0) AS max_order, coalesce(last_order, 'never') AS last_order, coalesce(finished_orders, 0) AS finished_orders, coalesce(units, 0) AS units,
 coalesce(returned_lines, 0) AS returned_lines, coalesce(events, 0) AS events, coalesce(conversions, 0) AS conversions, coalesce(last_event, 'never') AS last_event,
 coalesce(event_types, 0) AS event_types, coalesce(messages, 0) AS messages, coalesce(user_messages, 0) AS user_messages,
 coalesce(good_documents, 0) AS good_documents, coalesce(toxic_documents, 0) AS toxic_documents
FROM customer LEFT JOIN o ON c_custkey = o.o_custkey LEFT JOIN l ON c_custkey = l.o_custkey LEFT JOIN e ON c_custkey = user_id
LEFT JOIN v ON c_custkey = conv_id LEFT JOIN q ON c_custkey = doc_id""")
def m16(spark, t):
    return customer360.golden_record(t)


@query("m16_master_upsert", """
WITH o AS (SELECT o_custkey, COUNT(*) AS total_orders, CAST(SUM(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS order_value FROM orders GROUP BY 1)
SELECT c_custkey, c_name, c_acctbal, coalesce(total_orders, 0) AS total_orders, coalesce(order_value, 0) AS order_value
FROM customer LEFT JOIN o ON c_custkey = o_custkey
UNION ALL SELECT -1 - s_suppkey, s_name, s_acctbal, -1, 0.0 FROM supplier""")
def m16_upsert(spark, t):
    """The record goes into a master that holds stale rows of half the customers and rows of another system, which stay."""
    record = customer360.golden_record(t)
    stale = record.filter("c_custkey % 2 = 0").withColumns({"c_acctbal": F.lit(0.0), "total_orders": F.lit(-1).cast("long"), "order_value": F.lit(-1.0)})
    others = t.supplier.select((-1 - F.col("s_suppkey")).alias("c_custkey"), F.col("s_name").alias("c_name"), F.col("s_acctbal").alias("c_acctbal"),
                               F.lit(-1).cast("long").alias("total_orders"), F.lit(0.0).alias("order_value"))
    path = new_dir(spark, "m16")
    write_version(stale.unionByName(others, allowMissingColumns=True), path)
    write_version(customer360.golden_record(t, read_version(spark, path)), path)
    return read_version(spark, path).select("c_custkey", "c_name", "c_acctbal", "total_orders", "order_value")


@query("m17_first_bad_version", f"""
WITH {V2}, b AS (SELECT 0 AS version, COUNT(*) AS n FROM customer WHERE NOT coalesce(c_mktsegment IN ('BUILDING','AUTOMOBILE','MACHINERY','HOUSEHOLD','FURNITURE','SUPPLIER','CONSTRUCTION','COLLECTIONS'), false)
 UNION ALL SELECT 1, COUNT(*) FROM v1 WHERE NOT coalesce(c_mktsegment IN ('BUILDING','AUTOMOBILE','MACHINERY','HOUSEHOLD','FURNITURE','SUPPLIER','CONSTRUCTION','COLLECTIONS'), false)
 UNION ALL SELECT 2, COUNT(*) FROM v2 WHERE NOT coalesce(c_mktsegment IN ('BUILDING','AUTOMOBILE','MACHINERY','HOUSEHOLD','FURNITURE','SUPPLIER','CONSTRUCTION','COLLECTIONS'), false))
SELECT CAST(min(version) AS BIGINT) AS version, arg_min(n, version) AS bad_rows FROM b WHERE n > 0""")
def m17(spark, t):
    rule = "c_mktsegment IN ('BUILDING','AUTOMOBILE','MACHINERY','HOUSEHOLD','FURNITURE','SUPPLIER','CONSTRUCTION','COLLECTIONS')"
    return history.first_bad_version(feed(t), rule)


@query("m17_restore", f"SELECT {COLS} FROM customer")
def m17_restore(spark, t):
    """The state before the first bad version."""
    f = feed(t)
    bad = history.first_bad_version(f, "c_mktsegment IS NOT NULL").first()
    return shown(history.state_as_of(f, KEYS, version=bad["version"] - 1))
