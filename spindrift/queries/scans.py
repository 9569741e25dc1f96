"""Scans, sources, sinks, layout (SRC)."""

import uuid

from pyspark.sql import functions as F

from spindrift.functions.dates import date_dim_of, date_range_predicate
from spindrift.functions.numeric import dec, exact_sum
from spindrift.operators import layout
from spindrift.operators.merge import replace_where
from spindrift.queries import query
from spindrift.queries.joins import SKEW, skewed_lines
from spindrift.queries.snippets import dsum
from spindrift.session import new_dir
from spindrift.sources import connectors, files, ingest, synthetic
from spindrift.sources.versions import last_version, read_version, write_version
from spindrift.streaming.runner import file_stream, result_of, run_available, table_stream

CUSTOMER = "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"
EVENT = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"


@query("src01_parquet_scan", f"""
SELECT l_returnflag, COUNT(*) AS n, {dsum('l_quantity')} AS units FROM lineitem WHERE l_shipdate >= TIMESTAMP '1997-01-01' AND l_shipdate < TIMESTAMP '1998-01-01' GROUP BY 1""")
def src01(spark, t):
    return t.lineitem.filter(date_range_predicate("l_shipdate", "year", "1997")).groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), exact_sum("l_quantity").alias("units"))


@query("src02_csv_scan", "SELECT * FROM customer")
def src02(spark, t):
    path = new_dir(spark, "csv")
    t.customer.write.option("header", "true").csv(path)
    return files.read_csv(spark, path, CUSTOMER)


@query("src02_csv_dates", """
SELECT o_orderkey, CAST(o_orderdate AS VARCHAR) AS ordered, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day FROM orders""")
def src02_dates(spark, t):
    path = new_dir(spark, "csv-dates")
    t.orders.select("o_orderkey", "o_orderdate", F.to_date("o_orderdate").alias("day")).write.options(
        header="true", sep="|", dateFormat="dd.MM.yyyy", timestampNTZFormat="dd.MM.yyyy HH:mm:ss").csv(path)
    back = files.read_csv(spark, path, "o_orderkey BIGINT, o_orderdate TIMESTAMP_NTZ, day DATE", sep="|", dateFormat="dd.MM.yyyy",
                          timestampNTZFormat="dd.MM.yyyy HH:mm:ss", encoding="UTF-8")
    return back.select("o_orderkey", F.col("o_orderdate").cast("string").alias("ordered"), F.col("day").cast("string").alias("day"))


@query("src02_csv_multiline", "SELECT doc_id, text, lang FROM documents")
def src02_multiline(spark, t):
    path = new_dir(spark, "csv-multiline")
    t.documents.select("doc_id", "text", "lang").write.options(header="true", escape='"', quoteAll="true").csv(path)
    return files.read_csv(spark, path, "doc_id BIGINT, text STRING, lang STRING", multiLine="true", escape='"')


@query("src02_csv_inferred", "SELECT c_mktsegment, COUNT(*) AS n, CAST(SUM(c_custkey) AS BIGINT) AS keys FROM customer GROUP BY 1")
def src02_inferred(spark, t):
    path = new_dir(spark, "csv-inferred")
    t.customer.write.option("header", "true").csv(path)
    back = files.read_csv(spark, path)
    return back.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"), F.sum("c_custkey").cast("bigint").alias("keys"))


@query("src03_json_scan", "SELECT event_id, CAST(ts AS VARCHAR) AS ts, user_id, event_type, value, props FROM events")
def src03(spark, t):
    path = new_dir(spark, "json")
    # the default time format keeps milliseconds only
    t.events.write.option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(path)
    return files.read_json(spark, path, EVENT).withColumn("ts", F.col("ts").cast("string"))


@query("src04_orc_scan", "SELECT * REPLACE (CAST(o_orderdate AS VARCHAR) AS o_orderdate) FROM orders WHERE o_totalprice > 100000")
def src04(spark, t):
    path = new_dir(spark, "orc")
    t.orders.write.orc(path)
    return files.read_orc(spark, path).filter("o_totalprice > 100000").withColumn("o_orderdate", F.col("o_orderdate").cast("string"))


@query("src04_text_scan", r"""
SELECT CAST(len(line) AS INTEGER) AS chars, COUNT(*) AS n FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM conversations) GROUP BY 1""")
def src04_text(spark, t):
    path = new_dir(spark, "text")
    t.conversations.select(F.explode(F.split("text", "\n")).alias("value")).write.text(path)
    return files.read_text(spark, path).groupBy(F.length("value").alias("chars")).agg(F.count(F.lit(1)).alias("n"))


@query("src05_binary_scan")
def src05(spark, t):
    path = new_dir(spark, "binary")
    t.pages.repartition(layout.pieces(t.pages, 8)).write.parquet(path)
    return files.read_binary(spark, path, "*.parquet").select(
        F.regexp_extract("path", "([^/]+)$", 1).alias("file"), "length", F.length("content").alias("content_bytes"),
        F.hex(F.substring("content", 1, 4)).alias("magic"))


@query("src07_literal_rows", """
SELECT rank, label, COUNT(*) AS n FROM orders JOIN (VALUES ('1-URGENT', 1, 'now'), ('2-HIGH', 2, 'soon'), ('3-MEDIUM', 3, 'later'), ('5-LOW', 4, 'whenever')) AS v(p, rank, label)
ON o_orderpriority = p GROUP BY 1, 2""")
def src07(spark, t):
    t.views("orders")
    return spark.sql("""
        SELECT rank, label, COUNT(*) AS n FROM orders
        JOIN (VALUES ('1-URGENT', 1, 'now'), ('2-HIGH', 2, 'soon'), ('3-MEDIUM', 3, 'later'), ('5-LOW', 4, 'whenever')) AS v(p, rank, label)
        ON o_orderpriority = p GROUP BY rank, label""")


@query("src08_synthetic_columns", """
SELECT CASE o_orderkey % 4 WHEN 0 THEN 'web' WHEN 1 THEN 'store' WHEN 2 THEN 'phone' ELSE 'app' END AS channel, COUNT(*) AS n, COUNT(*) AS covered FROM orders GROUP BY 1""")
def src08(spark, t):
    made = t.orders.select(synthetic.category("o_orderkey", ["web", "store", "phone", "app"]).alias("channel"),
                           synthetic.hash_pick("o_orderkey", ["a", "b", "c"], 3).alias("bucket"))
    return made.groupBy("channel").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("bucket").isin("a", "b", "c")).alias("covered"))


@query("src08_seeded_columns")
def src08_seeded(spark, t):
    return t.orders.select("o_orderkey", F.rand(11).alias("u"), synthetic.hash_pick("o_orderkey", ["a", "b", "c"], 3).alias("bucket"))


@query("src08_seeded_invariants", """
SELECT bucket, n AS total, true AS fair_share, true AS follows_the_key FROM (SELECT COUNT(*) AS n FROM orders), (VALUES ('a'), ('b'), ('c')) AS v(bucket)""")
def src08_invariants(spark, t):
    """Hashed picks give each value its share within five standard deviations, and one key always the same value."""
    keyed = t.lineitem.select("l_orderkey", synthetic.hash_pick("l_orderkey", ["a", "b", "c"], 3).alias("bucket"))
    steady = keyed.groupBy("l_orderkey").agg((F.min("bucket") == F.max("bucket")).alias("one")).agg(F.bool_and("one")).scalar()
    made, total = src08_seeded(spark, t), t.orders.agg(F.count(F.lit(1))).scalar()
    return made.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).select(
        "bucket", total.alias("total"), (F.abs(F.col("n") - total / 3) <= 5 * F.sqrt(total * 2 / 9)).alias("fair_share"), steady.alias("follows_the_key"))


@query("src09_skewed_rows", f"SELECT p_partkey, COUNT(*) AS n FROM (SELECT CAST({SKEW} AS BIGINT) AS p_partkey FROM lineitem) GROUP BY 1")
def src09(spark, t):
    return skewed_lines(t).groupBy("p_partkey").agg(F.count(F.lit(1)).alias("n"))


@query("src11_file_stream", "SELECT event_id, user_id, value FROM events")
def src11(spark, t):
    """A folder of files read as a stream, two files per micro-batch."""
    path = new_dir(spark, "stream-in")
    t.events.repartition(layout.pieces(t.events, 6)).write.parquet(path)
    return result_of(file_stream(spark, path, t.events, max_files=2).select("event_id", "user_id", "value"), "src11")


@query("src12_table_stream", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'O'")
def src12(spark, t):
    return result_of(table_stream(t, "orders").filter("o_orderstatus = 'O'").select("o_orderkey", "o_custkey"), "src12")


def _two_loads(t):
    early = t.events.filter("ts < TIMESTAMP_NTZ '2024-01-16 00:00:00'")
    return early, t.events.filter("ts >= TIMESTAMP_NTZ '2024-01-16 00:00:00'")


@query("src14_ingest_new_files", f"SELECT batch, COUNT(*) AS n, {dsum('value')} AS total FROM (SELECT CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 0 ELSE 1 END AS batch, value FROM events) GROUP BY 1")
def src14(spark, t):
    """Load, load again, add files, load: each file once, in two batches."""
    src, target, ledger = (new_dir(spark, f"src14-{x}") for x in ("in", "target", "ledger"))
    for part in _two_loads(t):
        part.write.mode("append").parquet(src)
        for _ in range(2):
            ingest.ingest_new_files(spark, src, "parquet", EVENT, target, ledger)
    return spark.read.parquet(target).groupBy("batch").agg(F.count(F.lit(1)).alias("n"), exact_sum("value").alias("total"))


@query("src14_ingest_stream", f"SELECT event_type, COUNT(*) AS n, {dsum('value')} AS total FROM events GROUP BY 1")
def src14_stream(spark, t):
    """The same by a file stream and its checkpoint."""
    src, out, mark = (new_dir(spark, f"src14s-{x}") for x in ("in", "out", "checkpoint"))
    for part in _two_loads(t):
        part.write.mode("append").parquet(src)
        run_available(file_stream(spark, src, t.events), "src14s", out=out, checkpoint=mark)
    return spark.read.parquet(out).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), exact_sum("value").alias("total"))


@query("src15_validate_load", """
SELECT COUNT(*) AS rows_read, COUNT(*) FILTER (event_type = 'error') AS bad_rows FROM events""")
def src15(spark, t):
    path = new_dir(spark, "src15")
    user = F.when(F.col("event_type") == "error", F.concat(F.lit("BAD"), F.col("user_id").cast("string"))).otherwise(F.col("user_id").cast("string"))
    t.events.select("event_id", user.alias("user_id"), "value").write.option("header", "true").csv(path)
    return files.validate_load(spark, path, "csv", "event_id BIGINT, user_id BIGINT, value DOUBLE", header="true").select("rows_read", "bad_rows")


@query("src16_write_modes", """
SELECT o_orderstatus, COUNT(*) AS n FROM orders GROUP BY 1""")
def src16(spark, t):
    path = new_dir(spark, "src16")
    files.save(t.orders.filter("o_orderstatus = 'P'"), path)
    files.save(t.orders.filter("o_orderstatus = 'F'"), path, "overwrite")
    files.save(t.orders.filter("o_orderstatus <> 'F'"), path, "append")
    files.save(t.orders, path, "ignore")
    return spark.read.parquet(path).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query("src17_partitioned_write", """
SELECT o_orderstatus, COUNT(*) AS n, CAST(SUM(CASE WHEN o_orderstatus = 'F' THEN 0 ELSE CAST(o_totalprice AS DECIMAL(12,2)) END) AS DOUBLE) AS total FROM orders GROUP BY 1""")
def src17(spark, t):
    """A partitioned table of which one partition is overwritten."""
    path = new_dir(spark, "src17")
    files.save(files.by_partition_value(t.orders, ["o_orderstatus"]), path, partition_by=["o_orderstatus"])
    zeroed = t.orders.filter("o_orderstatus = 'F'").withColumn("o_totalprice", F.lit(0.0))
    files.save(files.by_partition_value(zeroed, ["o_orderstatus"]), path, "overwrite", partition_by=["o_orderstatus"], dynamic_overwrite=True)
    return spark.read.parquet(path).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), exact_sum("o_totalprice").alias("total"))


@query("src18_replace_where", """
SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'P' THEN round(o_totalprice * 2, 2) ELSE o_totalprice END AS o_totalprice FROM orders WHERE NOT (o_orderstatus = 'P' AND o_totalprice < 1000)""")
def src18(spark, t):
    path = new_dir(spark, "src18")
    base = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    write_version(base, path)
    new = base.filter("o_orderstatus = 'P' AND o_totalprice >= 1000").withColumn("o_totalprice", F.round(F.col("o_totalprice") * 2, 2))
    write_version(replace_where(read_version(spark, path), new, "o_orderstatus = 'P'"), path)
    return read_version(spark, path, last_version(spark, path))


@query("src19_sql_writes", """
SELECT c_mktsegment, COUNT(*) AS n, CAST(SUM(CAST(c_acctbal AS DECIMAL(12,2))) AS DOUBLE) AS total FROM customer WHERE c_acctbal > 0 GROUP BY 1""")
def src19(spark, t):
    """CTAS, then INSERT INTO and INSERT OVERWRITE of the same table."""
    t.views("customer")
    name = f"src19_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{new_dir(spark, 'src19')}' AS SELECT * FROM customer WHERE c_acctbal < 0")
    spark.sql(f"INSERT INTO {name} SELECT * FROM customer WHERE c_acctbal < 100")
    spark.sql(f"INSERT OVERWRITE {name} SELECT * FROM customer WHERE c_acctbal > 0")
    return spark.sql(f"""SELECT c_mktsegment, COUNT(*) AS n, CAST(SUM(CAST(c_acctbal AS DECIMAL(12,2))) AS DOUBLE) AS total
                         FROM {name} GROUP BY c_mktsegment""")


@query("src19_bucketed_join", """
SELECT o_orderpriority, COUNT(*) AS lines, CAST(SUM(CAST(l_quantity AS DECIMAL(12,2))) AS DOUBLE) AS units FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""")
def src19_bucketed(spark, t):
    """Both tables bucketed by the order key: the join needs no shuffle."""
    names = [f"src19b_{uuid.uuid4().hex[:8]}" for _ in range(2)]
    for df, key, name in ((t.lineitem.select("l_orderkey", "l_quantity"), "l_orderkey", names[0]),
                          (t.orders.select("o_orderkey", "o_orderpriority"), "o_orderkey", names[1])):
        # the rows of a bucket meet before the write, so there is one file per bucket
        buckets = layout.pieces(t.lineitem, 16)  # of the larger side, for both
        df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).option("path", new_dir(spark, "src19b")).saveAsTable(name)
    j = spark.table(names[0]).join(spark.table(names[1]).hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
    return j.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("lines"), exact_sum("l_quantity").alias("units"))


@query("src20_file_sizes", "SELECT COUNT(*) AS total_rows, true AS within_limit FROM orders")
def src20(spark, t):
    """No file holds more rows than asked for."""
    path = new_dir(spark, "src20")
    files.save(t.orders.repartition(layout.pieces(t.orders, 4)), path, max_records_per_file=1000)
    per = spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("f")).agg(F.count(F.lit(1)).alias("n"))
    return per.agg(F.sum("n").alias("total_rows"), (F.max("n") <= 1000).alias("within_limit"))


@query("src20_coalesce", "SELECT COUNT(*) AS total_rows, true AS fewer_files FROM events")
def src20_coalesce(spark, t):
    many, few = new_dir(spark, "src20-many"), new_dir(spark, "src20-few")
    parts = layout.pieces(t.events, 16)
    t.events.repartition(parts).write.parquet(many)
    spark.read.parquet(many).coalesce(parts // 4).write.parquet(few)
    counts = [spark.read.parquet(p).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("_metadata.file_path").alias("f")) for p in (many, few)]
    return counts[1].select(F.col("n").alias("total_rows"), (F.col("f") < counts[0].select("f").scalar()).alias("fewer_files"))


@query("src21_compaction", f"SELECT COUNT(*) AS total_rows, {dsum('value')} AS total, true AS fewer_files FROM events")
def src21(spark, t):
    src, out = new_dir(spark, "src21-small"), new_dir(spark, "src21-compact")
    t.events.repartition(layout.pieces(t.events, 24, 16 << 20)).write.parquet(src)
    report = layout.compact(spark, src, out)
    files_of = {s: report.filter(F.col("stage") == s).select("files").scalar() for s in ("before", "after")}
    return spark.read.parquet(out).agg(F.count(F.lit(1)).alias("total_rows"), exact_sum("value").alias("total")).withColumn(
        "fewer_files", files_of["after"] < files_of["before"])


@query("src21_compaction_by_folder", f"""
SELECT event_type, COUNT(*) AS n, {dsum('value')} AS total, true AS fewer_files FROM events GROUP BY 1""")
def src21_folders(spark, t):
    """A partitioned folder keeps its folders; each holds fewer files than before."""
    src, out = new_dir(spark, "src21p-small"), new_dir(spark, "src21p-compact")
    t.events.repartition(layout.pieces(t.events, 24, 16 << 20)).write.partitionBy("event_type").parquet(src)
    layout.compact(spark, src, out)
    files_in = lambda path, name: spark.read.parquet(path).groupBy("event_type").agg(F.count_distinct("_metadata.file_path").alias(name))
    rows = spark.read.parquet(out).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), exact_sum("value").alias("total"))
    both = files_in(src, "before").join(files_in(out, "after"), "event_type")
    return rows.join(both, "event_type").select("event_type", "n", "total", (F.col("after") < F.col("before")).alias("fewer_files"))


@query("src21_compaction_report")
def src21_report(spark, t):
    src = new_dir(spark, "src21r")
    t.events.repartition(layout.pieces(t.events, 24, 16 << 20)).write.parquet(src)
    return layout.compact(spark, src, new_dir(spark, "src21r-out"))


@query("src22_clustered_write", f"SELECT COUNT(*) AS total_rows, {dsum('l_quantity')} AS units, true AS skips_by_part, true AS skips_by_date FROM lineitem")
def src22(spark, t):
    """Rows unchanged, and ranges of either column skip files."""
    path = new_dir(spark, "src22")
    days = t.lineitem.withColumn("ship_day", F.unix_date(F.to_date("l_shipdate")))
    layout.zorder_write(days, ["l_partkey", "ship_day"], path)
    out = spark.read.parquet(path)
    ranges = layout.file_ranges(out, ["l_partkey", "ship_day"])
    lowest = t.part.agg((F.min("p_partkey") + (F.max("p_partkey") - F.min("p_partkey")) / 20).cast("bigint")).scalar()
    skipped = {c: layout.skippable(ranges, c, F.lit(0), hi).select("files_skipped").scalar()
               for c, hi in (("l_partkey", lowest), ("ship_day", F.unix_date(F.lit("1995-03-31").cast("date"))))}
    return out.agg(F.count(F.lit(1)).alias("total_rows"), exact_sum("l_quantity").alias("units")).select(
        "*", (skipped["l_partkey"] > 0).alias("skips_by_part"), (skipped["ship_day"] > 0).alias("skips_by_date"))


@query("src23_memory_sink", "SELECT event_type, COUNT(*) AS n FROM events GROUP BY 1")
def src23(spark, t):
    """Complete-mode counts in the memory sink: one row per event type on the driver."""
    name = f"src23_{uuid.uuid4().hex[:8]}"
    q = (table_stream(t, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
         .writeStream.format("memory").queryName(name).outputMode("complete").trigger(availableNow=True)
         .option("checkpointLocation", new_dir(spark, "src23")).start())
    q.awaitTermination()
    return spark.table(name)


@query("src23_table_sink", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderpriority = '1-URGENT'")
def src23_table(spark, t):
    name = f"src23t_{uuid.uuid4().hex[:8]}"
    q = (table_stream(t, "orders").filter("o_orderpriority = '1-URGENT'").select("o_orderkey", "o_totalprice").writeStream
         .option("checkpointLocation", new_dir(spark, "src23t-checkpoint")).option("path", new_dir(spark, "src23t"))
         .trigger(availableNow=True).toTable(name))
    q.awaitTermination()
    return spark.table(name)


@query("src23_key_value_encoding", """
SELECT CAST(user_id AS VARCHAR) AS key, '{"event_id":' || event_id || ',"user_id":' || user_id || ',"event_type":"' || event_type || '"}' AS value FROM events""")
def src23_encode(spark, t):
    """Key and JSON value as a message sink takes them, here into files."""
    rows = table_stream(t, "events").select("event_id", "user_id", "event_type")
    return result_of(connectors.encode_kafka(rows, "user_id"), "src23k")


@query("src24_format_comparison", f"""
SELECT format, n, total FROM (SELECT COUNT(*) AS n, {dsum('value')} AS total FROM events WHERE event_type = 'purchase'), (VALUES ('csv'), ('json'), ('orc'), ('parquet')) AS f(format)""")
def src24(spark, t):
    return _formats(spark, t).select("format", "n", "total")


@query("src24_format_sizes")
def src24_sizes(spark, t):
    return _formats(spark, t)


def _formats(spark, t):
    """The same rows and the same answer from four formats, with the bytes each takes."""
    out = None
    for fmt in ("csv", "json", "orc", "parquet"):
        path = new_dir(spark, f"src24-{fmt}")
        t.events.write.format(fmt).save(path)
        back = spark.read.schema(t.events.schema).format(fmt).load(path)
        size = layout.file_sizes(spark, path, fmt).agg(F.sum("length")).scalar()
        one = back.filter("event_type = 'purchase'").agg(F.count(F.lit(1)).alias("n"), exact_sum("value").alias("total")).select(
            F.lit(fmt).alias("format"), "n", "total", size.alias("bytes"))
        out = one if out is None else out.unionByName(one)
    return out


@query("src26_date_dimension", """
SELECT CAST(d AS VARCHAR) AS date, CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day_of_month,
 CAST(CAST(date_trunc('month', d) AS DATE) AS VARCHAR) AS month_start, dayofweek(d) IN (0, 6) AS is_weekend
FROM (SELECT CAST(unnest(range(lo, hi + INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS d
      FROM (SELECT min(CAST(o_orderdate AS DATE)) AS lo, max(CAST(o_orderdate AS DATE)) AS hi FROM orders))""")
def src26(spark, t):
    return date_dim_of(t.orders, "o_orderdate")
