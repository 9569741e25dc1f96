"""Streaming (ST)."""

from pyspark.sql import functions as F

from spindrift.functions.numeric import exact_avg, exact_sum
from spindrift.operators import aggregates, joins
from spindrift.operators.layout import pieces
from spindrift.plans import iot
from spindrift.queries import query
from spindrift.queries.jobs import RANGES, readings
from spindrift.queries.snippets import davg, dsum
from spindrift.session import broadcast_few_rows, new_dir
from spindrift.streaming import sinks, state
from spindrift.streaming.buckets import read_state
from spindrift.streaming.runner import event_time, file_stream, progress, result_of, run_available, start, table_stream
from spindrift.streaming.windows import time_bounded_join, time_slices, windowed

BY_TYPE = f"SELECT event_type, COUNT(*) AS n, {dsum('value')} AS total FROM events GROUP BY 1"


def split_files(spark, t, label, n=3):
    """The events as files in time order, and how many of them make a batch so that there are ``n`` batches.

    Large tables have more files, not more batches: a batch touches nearly every key, so that their number times the keys would grow with the square of the input.
    """
    path, each = new_dir(spark, label), -(-pieces(t.events, n, 16 << 20) // n)
    t.events.repartitionByRange(n * each, "ts").write.parquet(path)
    return path, each


def by_type(df):
    return df.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), exact_sum("value").alias("total"))


TRIGGERS = {"available_now": {"availableNow": True}, "once": {"once": True}, "processing_time": {"processingTime": "0 seconds"}}


@query("st01_triggers", "SELECT kind, COUNT(*) AS n FROM events, (VALUES ('available_now'), ('once'), ('processing_time')) AS v(kind) GROUP BY 1")
def st01(spark, t):
    out = None
    for kind, trigger in TRIGGERS.items():
        path = new_dir(spark, f"st01-{kind}")
        q = start(table_stream(t, "events").select("event_id"), path, new_dir(spark, f"st01-{kind}-checkpoint"), trigger=trigger)
        if kind == "processing_time":
            q.processAllAvailable()
            q.stop()
        else:
            q.awaitTermination()
        one = spark.read.parquet(path).agg(F.lit(kind).alias("kind"), F.count(F.lit(1)).alias("n"))
        out = one if out is None else out.unionByName(one)
    return out


@query("st02_append_mode", "SELECT event_id, event_type FROM events WHERE event_type = 'purchase'")
def st02(spark, t):
    return result_of(table_stream(t, "events").filter("event_type = 'purchase'").select("event_id", "event_type"), "st02a")


@query("st02_complete_mode", BY_TYPE)
def st02_complete(spark, t):
    src, each = split_files(spark, t, "st02c-in")
    return result_of(by_type(file_stream(spark, src, t.events, each)), "st02c", "complete")


@query("st02_update_mode", BY_TYPE)
def st02_update(spark, t):
    """Each batch emits the changed groups; the sink keeps the last of each."""
    (src, each), path = split_files(spark, t, "st02u-in"), new_dir(spark, "st02u")
    body = sinks.upsert_batches(path, ["event_type"], ["n"])
    run_available(by_type(file_stream(spark, src, t.events, each)), "st02u", mode="update", on_batch=body)
    return read_state(spark, path)


def window_sql(minutes, delay_minutes=None, slide=None):
    step = slide or minutes
    starts = f"unnest(range({minutes // step})) * {step * 60}"
    closed = ""
    if delay_minutes is not None:
        closed = f"HAVING win + {minutes * 60} <= (SELECT floor(epoch(max(ts)) * 1000) / 1000 FROM events) - {delay_minutes * 60}"
    return f"""
WITH w AS (SELECT event_type, value, CAST(floor(epoch(ts) / {step * 60}) AS BIGINT) * {step * 60} - {starts} AS win FROM events)
SELECT CAST(make_timestamp(win * 1000000) AS VARCHAR) AS window_start, event_type, COUNT(*) AS n, {dsum('value')} AS total, {davg('value')} AS mean_value,
 MIN(value) AS min_value, MAX(value) AS max_value FROM w GROUP BY win, event_type {closed}"""


def shown(df):
    return df.select(F.col("window_start").cast("timestamp_ntz").cast("string").alias("window_start"), "event_type", "n", "total",
                     "mean_value", "min_value", "max_value")


@query("st03_tumbling_windows", window_sql(60, 10))
def st03(spark, t):
    """Append mode: a window is emitted once the watermark has passed its end."""
    events = event_time(table_stream(t, "events"), "ts", "10 minutes")
    return shown(result_of(windowed(events, "ts", ["event_type"], "value", "60 minutes"), "st03"))


@query("st04_sliding_windows", window_sql(120, None, 30))
def st04(spark, t):
    events = event_time(table_stream(t, "events"), "ts", "10 minutes")
    return shown(result_of(windowed(events, "ts", ["event_type"], "value", "120 minutes", "30 minutes"), "st04", "complete"))


@query("st05_watermark_late_data", """
WITH f AS (SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-20'),
w AS (SELECT event_type, CAST(floor(epoch(ts) / 3600) AS BIGINT) * 3600 AS win FROM f)
SELECT CAST(make_timestamp(win * 1000000) AS VARCHAR) AS window_start, event_type, COUNT(*) AS n FROM w GROUP BY win, event_type
HAVING win + 3600 <= (SELECT epoch(max(ts)) FROM f) - 600""")
def st05(spark, t):
    """The newer events arrive first; the older ones come too late for any window."""
    out, _ = _late(spark, t)
    return out.select(F.col("window_start").cast("timestamp_ntz").cast("string").alias("window_start"), "event_type", "n")


@query("st05_dropped_rows")
def st05_dropped(spark, t):
    _, log = _late(spark, t)
    return progress(spark, log).select("batch_id", "input_rows", "dropped_rows")


def _late(spark, t):
    src, out, mark, log = (new_dir(spark, f"st05-{x}") for x in ("in", "out", "checkpoint", "log"))
    for part in ("ts >= TIMESTAMP_NTZ '2024-01-20 00:00:00'", "ts < TIMESTAMP_NTZ '2024-01-20 00:00:00'"):
        t.events.filter(part).write.mode("append").parquet(src)
        events = event_time(file_stream(spark, src, t.events), "ts", "10 minutes")
        agg = windowed(events, "ts", ["event_type"], "value", "60 minutes").select("window_start", "event_type", "n")
        run_available(agg, "st05", out=out, checkpoint=mark, log=log)
    return spark.read.parquet(out), log


@query("st06_stream_static_enrichment", f"""
SELECT c_mktsegment, event_type, COUNT(*) AS n, {dsum('value')} AS total FROM events JOIN customer ON user_id = c_custkey GROUP BY 1, 2""")
def st06(spark, t):
    side = t.customer.select("c_custkey", "c_mktsegment")
    j = joins.dim_join(table_stream(t, "events"), side, F.col("user_id") == F.col("c_custkey"))
    agg = j.groupBy("c_mktsegment", "event_type").agg(F.count(F.lit(1)).alias("n"), exact_sum("value").alias("total"))
    return result_of(agg, "st06", "complete")


def _stream_join(spark, t, how):
    """Orders and lines shipped within 30 days, as streams that arrive in slices of time, more for larger tables. A last row of the far future on
    both sides moves the watermark past everything, so unmatched rows come out too."""
    dirs = {x: new_dir(spark, f"st07-{how}-{x}") for x in ("orders", "lines", "out", "checkpoint")}
    orders = t.orders.select("o_orderkey", "o_orderdate")
    lines = t.lineitem.select("l_orderkey", "l_partkey", "l_shipdate")
    end = F.lit("2100-01-01 00:00:00").cast("timestamp_ntz")
    last = [orders.agg(F.lit(-1).cast("bigint").alias("o_orderkey"), end.alias("o_orderdate")),
            lines.agg(F.lit(-2).cast("bigint").alias("l_orderkey"), F.lit(-2).cast("bigint").alias("l_partkey"), end.alias("l_shipdate"))]
    slices = time_slices([(orders, "o_orderdate"), (lines, "l_shipdate")], pieces(lines, 2, 32 << 20), f"st07-{how}-slices")
    for o, l in [*slices, last]:
        o.write.mode("append").parquet(dirs["orders"])
        l.write.mode("append").parquet(dirs["lines"])
        left = event_time(file_stream(spark, dirs["orders"], orders), "o_orderdate", "1 day")
        right = event_time(file_stream(spark, dirs["lines"], lines), "l_shipdate", "1 day")
        j = time_bounded_join(left, right, F.col("o_orderkey") == F.col("l_orderkey"), "o_orderdate", "l_shipdate", "30 DAYS", how)
        run_available(j, f"st07-{how}", out=dirs["out"], checkpoint=dirs["checkpoint"])
    found = spark.read.parquet(dirs["out"]).filter(F.coalesce("o_orderkey", F.lit(0)) >= 0).filter(F.coalesce("l_orderkey", F.lit(0)) >= 0)
    kind = F.when(F.col("l_orderkey").isNull(), "order only").when(F.col("o_orderkey").isNull(), "line only").otherwise("both")
    return found.groupBy(F.coalesce("o_orderkey", "l_orderkey").alias("order_key"), kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"))


for _how, _word in (("inner", "JOIN"), ("left_outer", "LEFT JOIN"), ("full_outer", "FULL JOIN")):
    query(f"st07_stream_join_{_how}", f"""
SELECT coalesce(o_orderkey, l_orderkey) AS order_key, CASE WHEN l_orderkey IS NULL THEN 'order only' WHEN o_orderkey IS NULL THEN 'line only' ELSE 'both' END AS kind, COUNT(*) AS n
FROM orders {_word} lineitem ON o_orderkey = l_orderkey AND l_shipdate >= o_orderdate AND l_shipdate <= o_orderdate + INTERVAL 30 DAY GROUP BY 1, 2""")(
        lambda spark, t, how=_how: _stream_join(spark, t, how))


@query("st08_multi_sink", f"""
SELECT 'raw' AS sink, event_type, COUNT(*) AS n, {dsum('value')} AS total FROM events GROUP BY 2
UNION ALL SELECT 'summary', event_type, COUNT(*), {dsum('value')} FROM events GROUP BY 2""")
def st08(spark, t):
    src, each = split_files(spark, t, "st08-in")
    raw, summary = new_dir(spark, "st08-raw"), new_dir(spark, "st08-summary")
    body = sinks.multi_sink({raw: lambda b: b, summary: lambda b: b.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("value").cast("decimal(12,2)")).alias("total"))})
    run_available(file_stream(spark, src, t.events, each), "st08", on_batch=body)
    a = by_type(spark.read.parquet(raw))
    b = spark.read.parquet(summary).groupBy("event_type").agg(F.sum("n").alias("n"), F.sum("total").cast("double").alias("total"))
    return a.withColumn("sink", F.lit("raw")).unionByName(b.withColumn("sink", F.lit("summary")))


@query("st09_idempotent_upsert", f"""
SELECT user_id, COUNT(value) AS n, {davg('value')} AS mean_value, round(stddev_samp(value), 4) AS stddev_value, MIN(value) AS min_value, MAX(value) AS max_value,
 arg_max(value, (ts, event_id)) AS last_value FROM events GROUP BY 1""")
def st09(spark, t):
    """Running statistics per user over micro-batches; the last batch is delivered twice."""
    (src, each), path = split_files(spark, t, "st09-in"), new_dir(spark, "st09")
    fold = sinks.fold_batches(
        path, ["user_id"], lambda b: aggregates.running_stats(b, ["user_id"], "value", "ts", "event_id"),
        lambda old, new: aggregates.merge_stats(old, new, ["user_id"]))

    def twice(batch, batch_id):
        fold(batch, batch_id)
        fold(batch, batch_id)

    run_available(file_stream(spark, src, t.events, each), "st09", on_batch=twice)
    return aggregates.read_stats(read_state(spark, path), ["user_id"]).select(
        "user_id", "n", "mean_value", F.round("stddev_value", 4).alias("stddev_value"), "min_value", "max_value", "last_value")


@query("st09_latest_upsert", """
SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type, arg_max(value, (ts, event_id)) AS value, max(event_id) AS event_id FROM events GROUP BY 1""")
def st09_latest(spark, t):
    (src, each), path = split_files(spark, t, "st09l-in"), new_dir(spark, "st09l")
    rows = file_stream(spark, src, t.events, each).select("user_id", "ts", "event_id", "event_type", "value")
    run_available(rows, "st09l", on_batch=sinks.upsert_batches(path, ["user_id"], ["ts", "event_id"]))
    return read_state(spark, path).select("user_id", "event_type", "value", "event_id")


@query("st10_restart", "SELECT event_id, user_id FROM events")
def st10(spark, t):
    """Stop after the first files, add more, start again from the checkpoint: every row once."""
    src, out, mark = (new_dir(spark, f"st10-{x}") for x in ("in", "out", "checkpoint"))
    for part in ("value < 30", "value >= 30"):
        t.events.filter(part).write.mode("append").parquet(src)
        run_available(file_stream(spark, src, t.events).select("event_id", "user_id"), "st10", out=out, checkpoint=mark)
    return spark.read.parquet(out)


@query("st11_stream_anomalies", f"""
WITH {RANGES} SELECT event_id, user_id, event_type, value, deviation_sigma, severity FROM alerts""")
def st11(spark, t):
    rows = iot.with_ranges(table_stream(t, "events"), t.events, "event_type", "value")
    alerts = iot.mark_anomalies(rows, "value", "user_id", "event_type").filter("is_anomaly")
    return result_of(alerts.select("event_id", "user_id", "event_type", "value", "deviation_sigma", "severity"), "st11")


@query("st12_multi_hop", f"SELECT event_type, COUNT(*) AS n, {dsum('value')} AS total FROM events WHERE value > 1 GROUP BY 1")
def st12(spark, t):
    """Bronze, silver and gold as three queries with a checkpoint each."""
    bronze, _ = run_available(table_stream(t, "events").withColumn("_source", F.lit("events")), "st12-bronze")
    like = spark.read.parquet(bronze)
    silver, _ = run_available(file_stream(spark, bronze, like).filter("value > 1").select("event_id", "event_type", "value"), "st12-silver")
    return result_of(by_type(file_stream(spark, silver, spark.read.parquet(silver))), "st12-gold", "complete")


@query("st13_fan_out", """
SELECT 'errors' AS branch, COUNT(*) AS n FROM events WHERE event_type = 'error' UNION ALL SELECT 'large', COUNT(*) FROM events WHERE value > 100""")
def st13(spark, t):
    """Two queries run side by side over one source."""
    stream = table_stream(t, "events")
    branches = {"errors": "event_type = 'error'", "large": "value > 100"}
    paths = {k: new_dir(spark, f"st13-{k}") for k in branches}
    running = [start(stream.filter(p).select("event_id"), paths[k], new_dir(spark, f"st13-{k}-checkpoint")) for k, p in branches.items()]
    for q in running:
        q.awaitTermination()
    out = None
    for k, path in paths.items():
        one = spark.read.schema("event_id BIGINT").parquet(path).agg(F.lit(k).alias("branch"), F.count(F.lit(1)).alias("n"))
        out = one if out is None else out.unionByName(one)
    return out


@query("st14_keyed_state", """
SELECT user_id AS key, COUNT(*) AS n, CAST(SUM(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS total_cents, epoch_us(max(ts)) AS last_us FROM events GROUP BY 1""")
def st14(spark, t):
    """Own state per user (salted by event for users with a hundredth of the rows or more); the last emission per part, added up."""
    (src, each), path = split_files(spark, t, "st14-in"), new_dir(spark, "st14")
    hot = broadcast_few_rows(joins.heavy_keys(t.events, "user_id", 0.01).withColumn("hot", F.lit(True)))
    # the files of one write come in any order, so the delay covers the span of the data
    rows = event_time(file_stream(spark, src, t.events, each), "ts", "90 days").join(hot, "user_id", "left").select(
        "user_id", "ts", F.when(F.col("hot"), F.pmod(F.xxhash64("event_id"), F.lit(16))).otherwise(F.lit(0)).cast("int").alias("salt"),
        F.round(F.col("value") * 100).cast("bigint").alias("cents"), F.unix_micros("ts").alias("us"))
    totals = state.keyed_totals(rows, "user_id", "salt", "cents", "us", timeout_ms=90 * 86_400_000)
    body = sinks.upsert_batches(path, ["key", "salt"], ["n"])
    with state.keyed_state_store(spark):
        run_available(totals, "st14", mode="update", on_batch=body)
    return read_state(spark, path).groupBy("key").agg(
        F.sum("n").alias("n"), F.sum("total_cents").alias("total_cents"), F.max("last_us").alias("last_us"))


@query("st15_progress")
def st15(spark, t):
    (src, each), log = split_files(spark, t, "st15-in"), new_dir(spark, "st15-log")
    run_available(by_type(file_stream(spark, src, t.events, each)), "st15", mode="complete", log=log)
    return progress(spark, log)


@query("st15_progress_totals", "SELECT COUNT(*) AS input_rows, 0 AS dropped_rows, true AS batches_in_order FROM events")
def st15_totals(spark, t):
    """The log holds every batch once, from 0 on, and their rows add up to the input."""
    rows = st15(spark, t).agg(F.sum("input_rows").alias("input_rows"), F.sum("dropped_rows").alias("dropped_rows"),
                              F.count(F.lit(1)).alias("n"), F.max("batch_id").alias("last"), F.count_distinct("batch_id").alias("ids"))
    return rows.select("input_rows", "dropped_rows", ((F.col("n") == F.col("last") + 1) & (F.col("ids") == F.col("n"))).alias("batches_in_order"))


@query("st16_trigger_equality", f"SELECT event_type, COUNT(*) AS n, {dsum('value')} AS total, true AS same FROM events GROUP BY 1")
def st16(spark, t):
    """One run over everything and a run file by file give the same table."""
    src, each = split_files(spark, t, "st16-in")
    whole = result_of(by_type(file_stream(spark, src, t.events)), "st16-whole", "complete")
    steps = result_of(by_type(file_stream(spark, src, t.events, each)), "st16-steps", "complete")
    other = steps.select(F.col("event_type").alias("k"), F.col("n").alias("n2"), F.col("total").alias("total2"))
    return whole.join(other, F.col("event_type") == F.col("k")).select(
        "event_type", "n", "total", ((F.col("n") == F.col("n2")) & (F.col("total") == F.col("total2"))).alias("same"))


NOW = "2024-01-29 12:00:00"


@query("st17_recent_summary", f"""
SELECT minutes, event_type, COUNT(*) AS readings, {davg('value')} AS avg_value, MIN(value) AS min_value, MAX(value) AS max_value
FROM events, (VALUES (60), (720), (1440)) AS m(minutes) WHERE ts >= TIMESTAMP '{NOW}' - minutes * INTERVAL 1 MINUTE AND ts <= TIMESTAMP '{NOW}' GROUP BY 1, 2""")
def st17(spark, t):
    """Readings of the last hour, half day and day before a given now, from the stream's output."""
    out, _ = run_available(table_stream(t, "events"), "st17")
    rows = spark.read.parquet(out)
    parts = [iot.recent_summary(rows, "ts", "event_type", "value", NOW, m).select(F.lit(m).alias("minutes"), "*") for m in (60, 720, 1440)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("st17_severity_summary", f"""
WITH {RANGES} SELECT severity, COUNT(*) AS alert_count, CAST(SUM(CAST(deviation_sigma AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*) AS avg_sigma,
 COUNT(DISTINCT user_id) AS affected_sensors FROM alerts GROUP BY 1""")
def st17_severity(spark, t):
    alerts = iot.mark_anomalies(readings(t), "value", "user_id", "event_type")
    return iot.severity_summary(alerts.filter("is_anomaly"), "user_id")


@query("st17_trend_detection", f"""
WITH w AS (SELECT event_type, value, CAST(floor(epoch(ts) / 21600) AS BIGINT) * 21600 - unnest(range(2)) * 21600 AS win FROM events),
a AS (SELECT event_type, win, {davg('value')} AS mean_value, stddev_samp(value) AS sd FROM w GROUP BY 1, 2),
p AS (SELECT *, lag(mean_value) OVER (PARTITION BY event_type ORDER BY win) AS previous_mean FROM a)
SELECT event_type, CAST(make_timestamp(win * 1000000) AS VARCHAR) AS window_start, mean_value, previous_mean, mean_value - previous_mean AS delta
FROM p WHERE abs(mean_value - previous_mean) > sd * 0.25""")
def st17_trend(spark, t):
    """Sliding half-day windows every six hours whose mean moved."""
    rows = t.events.withColumn("ts", F.col("ts").cast("timestamp"))
    slides = rows.groupBy(F.window("ts", "12 hours", "6 hours").alias("w"), "event_type").agg(
        exact_avg("value").alias("mean_value"), F.stddev_samp("value").alias("sd")).select(
        F.col("w.start").cast("timestamp_ntz").cast("string").alias("window_start"), "event_type", "mean_value", "sd")
    return iot.shifts(slides, ["event_type"], "window_start", "mean_value", "sd", 0.25).select(
        "event_type", "window_start", "mean_value", "previous_mean", "delta")
