"""Replays, restarts and state, driven by files and availableNow."""

from pyspark.sql import functions as F

from spindrift.operators.aggregates import merge_stats, read_stats, running_stats
from spindrift.queries import streams
from spindrift.session import new_dir
from spindrift.streaming import buckets, sinks, state
from spindrift.streaming.runner import event_time, file_stream, progress, run_available
from spindrift.streaming.windows import time_slices, windowed
from tests.conftest import SF
from tests.oracle import compare, connect


def test_fold_survives_replay_and_ignores_old_batches(spark, tables):
    path = new_dir(spark, "fold")
    body = sinks.fold_batches(path, ["user_id"], lambda b: running_stats(b, ["user_id"], "value", "ts", "event_id"),
                              lambda old, new: merge_stats(old, new, ["user_id"]))
    early, late = tables.events.filter("event_id < 500"), tables.events.filter("event_id >= 500")
    for batch, number in ((early, 0), (late, 3), (late, 3), (early, 0)):  # batch 3 twice, then batch 0 again
        body(batch, number)
    assert buckets.last_batch(spark, path) == 3
    whole = running_stats(tables.events, ["user_id"], "value", "ts", "event_id")
    got, want = (read_stats(x, ["user_id"]) for x in (buckets.read_state(spark, path), whole))
    assert got.exceptAll(want).isEmpty() and got.count() == want.count()


def test_multi_sink_replay(spark, tables):
    path = new_dir(spark, "sink")
    body = sinks.multi_sink({path: lambda b: b.select("event_id")})
    for _ in range(2):
        body(tables.events, 0)
    assert spark.read.parquet(path).count() == tables.events.count()


def test_late_rows_are_dropped_and_counted(spark):
    src, out, mark, log = (new_dir(spark, x) for x in ("late-in", "late-out", "late-mark", "late-log"))
    ddl = "ts timestamp_ntz, k string, v double"
    first = spark.sql(f"SELECT * FROM VALUES (timestamp_ntz'2024-01-01 10:00:00', 'a', 1D), (timestamp_ntz'2024-01-01 12:00:00', 'a', 1D) AS t(ts, k, v)")
    late = spark.sql(f"SELECT * FROM VALUES (timestamp_ntz'2024-01-01 10:05:00', 'a', 100D) AS t(ts, k, v)")
    for part in (first, late):
        part.write.mode("append").parquet(src)
        stream = event_time(file_stream(spark, src, first), "ts", "10 minutes")
        run_available(windowed(stream, "ts", ["k"], "v", "30 minutes"), "late", out=out, checkpoint=mark, log=log)
    rows = spark.read.parquet(out).collect()
    assert [(r["n"], r["total"]) for r in rows] == [(1, 1.0)]
    assert progress(spark, log).agg(F.sum("dropped_rows")).first()[0] == 1


def test_restart_reads_only_new_files(spark):
    src, out, mark = (new_dir(spark, x) for x in ("re-in", "re-out", "re-mark"))
    for lo, hi in ((0, 5), (5, 9)):
        spark.range(lo, hi).write.mode("append").parquet(src)
        run_available(file_stream(spark, src, spark.range(0)), "re", out=out, checkpoint=mark)
    run_available(file_stream(spark, src, spark.range(0)), "re", out=out, checkpoint=mark)
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == list(range(9))


def files_of(spark, path):
    return {r[0] for r in spark.read.option("recursiveFileLookup", "true").format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/data").select("path").collect()}


def test_a_batch_writes_only_the_buckets_it_touches(spark):
    path = new_dir(spark, "buckets")
    body = sinks.upsert_batches(path, ["k"], ["at"], buckets=16)
    make = lambda lo, hi, at: spark.range(lo, hi).select(F.col("id").alias("k"), F.lit(at).alias("at"))
    body(make(0, 400, 0), 0)
    first = files_of(spark, path)
    body(make(7, 8, 1), 1)  # one key
    second = files_of(spark, path)
    assert len(second - first) == 1 and first <= second  # the old bucket stays, as a replay of batch 1 needs it
    body(make(7, 8, 1), 1)
    body(make(7, 9, 2), 2)
    third = files_of(spark, path)
    assert len(first & third) == 15 and len(third) <= 18  # the bucket of batch 0 that no manifest names is gone, the untouched ones are the same files
    assert {(r.k, r.at) for r in buckets.read_state(spark, path).select("k", "at").collect()} == {(i, 2 if i in (7, 8) else 0) for i in range(400)}
    body(make(0, 0, 3), 3)  # an empty batch
    assert buckets.read_state(spark, path).count() == 400 and buckets.read_state(spark, new_dir(spark, "none")) is None


def test_progress_of_more_batches_than_spark_keeps(spark):
    src, log = new_dir(spark, "many-in"), new_dir(spark, "many-log")
    spark.range(150).repartition(150).write.parquet(src)
    files = spark.read.parquet(src).select(F.input_file_name().alias("f")).distinct().count()
    run_available(file_stream(spark, src, spark.range(0), 1), "many", log=log)
    batches = progress(spark, log).collect()
    assert sorted(r.batch_id for r in batches) == list(range(len(batches))) and len(batches) >= files > 100
    assert sum(r.input_rows for r in batches) == 150


def test_large_tables_have_more_files_not_more_batches(spark, tables, monkeypatch):
    monkeypatch.setattr(streams, "pieces", lambda df, least, *_: 4 * least)  # as for a table of many files
    src, each = streams.split_files(spark, tables, "split")
    log = new_dir(spark, "split-log")
    run_available(file_stream(spark, src, tables.events, each), "split", log=log)
    batches = [r.input_rows for r in progress(spark, log).collect() if r.input_rows]
    assert spark.read.parquet(src).select(F.input_file_name()).distinct().count() > 6 and len(batches) <= 3 and sum(batches) == tables.events.count()


def test_keyed_state_of_rows_without_amount(spark):
    src, path = new_dir(spark, "gaps-in"), new_dir(spark, "gaps")
    rows = [(1, 5, None), (1, 6, 10), (1, 7, None), (1, 8, 20), (None, 9, 3), (2, 1, None)]
    spark.createDataFrame(rows, "k long, us long, cents long").withColumn("ts", F.timestamp_micros("us")).withColumn("salt", F.lit(0)).coalesce(1).write.parquet(src)
    stream = event_time(file_stream(spark, src, spark.read.parquet(src)), "ts", "1 minute")
    with state.keyed_state_store(spark):
        run_available(state.keyed_totals(stream, "k", "salt", "cents", "us", timeout_ms=60_000), "gaps", mode="update", out=path,
                      on_batch=sinks.upsert_batches(path, ["key"], ["n"]))
    got = {(r.key, r.n, r.total_cents, r.last_us) for r in buckets.read_state(spark, path).collect()}
    assert got == {(1, 4, 30, 8), (None, 1, 3, 9), (2, 1, 0, 1)}


def test_time_slices_hold_every_row_once_and_in_order(spark):
    a = spark.range(500).selectExpr("id", "IF(id % 50 = 0, NULL, timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, 0, 0, id * 7 % 500)) AS at")
    b = spark.range(90).selectExpr("id AS k", "timestamp_ntz'2024-01-05' + make_interval(0, 0, 0, 0, 0, id * 11 % 90) AS day")
    slices = time_slices([(a, "at"), (b, "day")], 4, "slices")
    for side, whole in enumerate((a, b)):
        parts = [s[side].collect() for s in slices]
        assert sorted(map(repr, sum(parts, []))) == sorted(map(repr, whole.collect()))
    spans = [[r[1] for side in s for r in side.collect() if r[1] is not None] for s in slices]
    assert all(max(x) < min(y) for x, y in zip(spans, spans[1:])) and max(map(len, spans)) < 250


def test_stream_join_of_a_large_table_arrives_in_many_slices(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(streams, "pieces", lambda df, *_: 5)
    monkeypatch.setattr(streams, "run_available", lambda *a, **b: asked.append(1) or run_available(*a, **b))
    matches, note = compare(spark, connect(SF), SF, "st07_stream_join_full_outer")
    assert matches, note
    assert len(asked) == 6  # and the row of the far future


def test_timers_close_keys_and_survive_a_restart(spark):
    src, path, mark = (new_dir(spark, x) for x in ("timer-in", "timer", "timer-mark"))
    minute, emitted = 60_000_000, []

    def load(*rows):
        spark.createDataFrame([(k, (1000 + at) * minute, c) for k, at, c in rows], "k long, us long, cents long").withColumn(
            "ts", F.timestamp_micros("us")).withColumn("salt", F.lit(0)).coalesce(1).write.mode("append").parquet(src)
        stream = event_time(file_stream(spark, src, spark.read.parquet(src)), "ts", "1 minute")
        totals = state.keyed_totals(stream, "k", "salt", "cents", "us", timeout_ms=10 * 60_000)
        with state.keyed_state_store(spark):  # each load is a new run from the checkpoint
            run_available(totals, "timer", mode="update", checkpoint=mark, out=path,
                          on_batch=lambda b, _: emitted.extend((r.key, r.n, r.total_cents, r.last_us // minute - 1000, r.closed) for r in b.collect()))

    load((1, 0, 100), (1, 2, 50), (2, 1, 7))
    assert (1, 2, 150, 2, False) in emitted and (2, 1, 7, 1, False) in emitted
    load((1, 9, 1))  # moves the timer of key 1 to minute 19
    assert (1, 3, 151, 9, False) in emitted
    load((3, 15, 5))  # watermark at minute 14: key 2 (due at 11) is over, key 1 is not
    closed = [e for e in emitted if e[-1]]
    assert closed == [(2, 1, 7, 1, True)]
    load((2, 16, 4))  # begins anew
    assert (2, 1, 4, 16, False) in emitted
    load((9, 100, 1))
    assert {e[:4] for e in emitted if e[-1]} == {(2, 1, 7, 1), (1, 3, 151, 9), (3, 1, 5, 15), (2, 1, 4, 16)}
