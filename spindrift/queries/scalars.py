"""Scalar functions (F)."""

from pyspark.sql import functions as F

from spindrift.functions import masks, nested
from spindrift.operators.aggregates import nest
from spindrift.queries import query


@query("f01_strings", r"""
SELECT c_custkey, c_name || '/' || c_mktsegment AS joined, concat_ws('-', c_name, c_mktsegment) AS dashed,
       split_part(c_name, '#', 2) AS number, substring(c_name, 1, 8) AS head, left(c_mktsegment, 3) AS l3, right(c_name, 4) AS r4,
       lower(c_mktsegment) AS low, upper(c_name) AS up, trim('  ' || c_name || ' ') AS trimmed, CAST(length(c_name) AS INTEGER) AS len,
       lpad(CAST(c_nationkey AS VARCHAR), 4, '0') AS padded, regexp_replace(c_name, '#0+', '#', 'g') AS short,
       regexp_extract(c_name, '([0-9]+)$', 1) AS digits, contains(c_mktsegment, 'MACH') AS has,
       format('{:,.2f}', CAST(c_acctbal AS DOUBLE)) AS money
FROM customer""")
def f01(spark, t):
    n, s = F.col("c_name"), F.col("c_mktsegment")
    return t.customer.select(
        "c_custkey", F.concat(n, F.lit("/"), s).alias("joined"), F.concat_ws("-", n, s).alias("dashed"),
        F.split(n, "#")[1].alias("number"), F.substring(n, 1, 8).alias("head"), F.left(s, F.lit(3)).alias("l3"),
        F.right(n, F.lit(4)).alias("r4"), F.lower(s).alias("low"), F.upper(n).alias("up"),
        F.trim(F.concat(F.lit("  "), n, F.lit(" "))).alias("trimmed"), F.length(n).alias("len"),
        F.lpad(F.col("c_nationkey").cast("string"), 4, "0").alias("padded"), F.regexp_replace(n, "#0+", "#").alias("short"),
        F.regexp_extract(n, "([0-9]+)$", 1).alias("digits"), F.contains(s, F.lit("MACH")).alias("has"),
        F.format_number("c_acctbal", 2).alias("money"))


@query("f02_dates", """
SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS d, strftime(o_orderdate, '%Y/%m/%d') AS slashed,
       CAST(CAST(o_orderdate AS DATE) + 10 AS VARCHAR) AS plus10, CAST(CAST(o_orderdate AS DATE) - 10 AS VARCHAR) AS minus10,
       CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-12-31') AS INTEGER) AS days_left,
       CAST(CAST(date_trunc('month', o_orderdate) AS DATE) AS VARCHAR) AS month_start, CAST(epoch(o_orderdate) AS BIGINT) AS unix,
       CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS m, CAST(day(o_orderdate) AS INTEGER) AS dom,
       CAST(hour(o_orderdate + INTERVAL 90 MINUTE) AS INTEGER) AS h, CAST(minute(o_orderdate + INTERVAL 90 MINUTE) AS INTEGER) AS mi,
       CAST(second(o_orderdate - INTERVAL 1 SECOND) AS INTEGER) AS sec, CAST(o_orderdate - INTERVAL 1 HOUR AS VARCHAR) AS hour_before
FROM orders""")
def f02(spark, t):
    o, d = F.col("o_orderdate"), F.to_date("o_orderdate")
    later = o + F.expr("INTERVAL 90 MINUTES")
    return t.orders.select(
        "o_orderkey", d.cast("string").alias("d"), F.date_format(o, "yyyy/MM/dd").alias("slashed"),
        F.date_add(d, 10).cast("string").alias("plus10"), F.date_sub(d, 10).cast("string").alias("minus10"),
        F.datediff(F.lit("2001-12-31").cast("date"), d).alias("days_left"),
        F.to_date(F.date_trunc("month", o)).cast("string").alias("month_start"),
        F.unix_timestamp(o.cast("timestamp")).alias("unix"), F.year(o).alias("y"), F.month(o).alias("m"), F.dayofmonth(o).alias("dom"),
        F.hour(later).alias("h"), F.minute(later).alias("mi"), F.second(o - F.expr("INTERVAL 1 SECOND")).alias("sec"),
        (o - F.expr("INTERVAL 1 HOUR")).cast("string").alias("hour_before"))


@query("f02_parse_and_epoch", """
SELECT event_id, CAST(epoch(strptime(strftime(ts, '%d.%m.%Y %H:%M'), '%d.%m.%Y %H:%M')) AS BIGINT) AS minute_epoch, strftime(ts, '%Y-%m-%d %H:%M:%S') AS back
FROM events""")
def f02_parse(spark, t):
    text = F.date_format("ts", "dd.MM.yyyy HH:mm")
    return t.events.select(
        "event_id", F.unix_seconds(F.to_timestamp(text, "dd.MM.yyyy HH:mm")).alias("minute_epoch"),
        F.from_unixtime(F.unix_seconds(F.col("ts").cast("timestamp")), "yyyy-MM-dd HH:mm:ss").alias("back"))


@query("f03_math", """
SELECT c_custkey, round(c_acctbal, 1) AS r1, abs(c_acctbal) AS a, least(c_acctbal, 1000.0::DOUBLE, 5000.0::DOUBLE) AS lo, greatest(c_acctbal, 0.0::DOUBLE) AS hi,
       c_custkey % 7 AS m, CAST(trunc(c_acctbal) AS INTEGER) AS whole FROM customer""")
def f03(spark, t):
    b = F.col("c_acctbal")
    return t.customer.select("c_custkey", F.round(b, 1).alias("r1"), F.abs(b).alias("a"), F.least(b, F.lit(1000.0), F.lit(5000.0)).alias("lo"),
                             F.greatest(b, F.lit(0.0)).alias("hi"), (F.col("c_custkey") % 7).alias("m"), b.cast("int").alias("whole"))


@query("f03_seeded_random")
def f03_random(spark, t):
    return t.customer.select("c_custkey", F.rand(7).alias("u"), F.randn(7).alias("z"))


@query("f03_random_invariants", "SELECT COUNT(*) AS n, true AS in_range, true AS mean_uniform, true AS mean_normal, true AS spread_normal FROM customer")
def f03_invariants(spark, t):
    """Seeded uniform and normal numbers keep their ranges and, within five standard errors, their moments."""
    u, z, n = F.col("u"), F.col("z"), F.count(F.lit(1))
    return f03_random(spark, t).agg(
        n.alias("n"), F.bool_and((u >= 0) & (u < 1)).alias("in_range"), (F.abs(F.avg(u) - 0.5) <= 5 / F.sqrt(12 * n)).alias("mean_uniform"),
        (F.abs(F.avg(z)) <= 5 / F.sqrt(n)).alias("mean_normal"), (F.abs(F.var_samp(z) - 1) <= 5 * F.sqrt(2 / n)).alias("spread_normal"))


@query("f04_digests", """
SELECT c_custkey, md5(c_name) AS m, sha256(c_name || '|' || c_mktsegment) AS s FROM customer""")
def f04(spark, t):
    return t.customer.select("c_custkey", F.md5("c_name").alias("m"), F.sha2(F.concat_ws("|", "c_name", "c_mktsegment"), 256).alias("s"))


@query("f04_row_hash", """
SELECT c_custkey, sha256('{"c_name":"' || c_name || '","c_mktsegment":"' || c_mktsegment || '","c_nationkey":' || c_nationkey || '}') AS row_hash FROM customer""")
def f04_row(spark, t):
    return t.customer.select("c_custkey", nested.row_hash(["c_name", "c_mktsegment", "c_nationkey"]).alias("row_hash"))


@query("f04_engine_hash")
def f04_engine(spark, t):
    return t.customer.select("c_custkey", F.hash("c_name").alias("h"), F.xxhash64("c_name").alias("x"))


@query("f05_arrays", """
WITH a AS (SELECT p_partkey, string_split(p_name, ' ') || [p_type, p_type] AS xs FROM part)
SELECT p_partkey, CAST(len(xs) AS INTEGER) AS n, list_contains(xs, 'ring') AS has_ring, xs[1] AS first, array_to_string(list_sort(list_distinct(xs)), ',') AS dist,
       array_to_string(xs[1:2], '+') AS two, array_to_string(list_sort(xs), ',') AS sorted FROM a""")
def f05(spark, t):
    xs = F.concat(F.split("p_name", " "), F.array("p_type", "p_type"))
    a = t.part.select("p_partkey", xs.alias("xs"))
    return a.select(
        "p_partkey", F.size("xs").alias("n"), F.array_contains("xs", "ring").alias("has_ring"), F.element_at("xs", 1).alias("first"),
        F.array_join(F.sort_array(F.array_distinct("xs")), ",").alias("dist"), F.array_join(F.slice("xs", 1, 2), "+").alias("two"),
        F.array_join(F.sort_array(F.flatten(F.array(F.col("xs")))), ",").alias("sorted"))


@query("f05_explode_family", """
WITH w AS (SELECT p_partkey, string_split(p_name, ' ') AS ws FROM part),
e AS (SELECT p_partkey, unnest(ws) AS word, generate_subscripts(ws, 1) - 1 AS pos FROM w)
SELECT word, CAST(pos AS INTEGER) AS pos, COUNT(*) AS n FROM e GROUP BY 1, 2
UNION ALL SELECT 'no tags', -1, COUNT(*) FROM part WHERE p_size > 25""")
def f05_explode(spark, t):
    words = t.part.select(F.posexplode(F.split("p_name", " ")).alias("pos", "word")).groupBy("word", "pos").agg(F.count(F.lit(1)).alias("n"))
    tags = F.when(F.col("p_size") <= 25, F.array(F.lit("small")))
    outer = t.part.select(F.explode_outer(tags).alias("tag")).filter("tag IS NULL").agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("no tags").alias("word"), F.lit(-1).alias("pos"), "n")
    return words.unionByName(outer)


@query("f05_inline", """
SELECT l_returnflag, kind, CAST(SUM(CAST(v AS DECIMAL(12,2))) AS DOUBLE) AS total FROM (
 SELECT l_returnflag, 'q' AS kind, l_quantity AS v FROM lineitem UNION ALL SELECT l_returnflag, 'd', l_discount FROM lineitem) GROUP BY 1, 2""")
def f05_inline(spark, t):
    return t.lineitem.selectExpr(
        "l_returnflag", "inline(array(struct('q' AS kind, l_quantity AS v), struct('d' AS kind, l_discount AS v)))"
    ).groupBy("l_returnflag", "kind").agg(F.sum(F.col("v").cast("decimal(12,2)")).cast("double").alias("total"))


@query("f06_higher_order", """
SELECT vec_id, CAST(len(list_filter(embedding, lambda x: x > 0)) AS INTEGER) AS positives,
       round(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * x)), 6) AS sum_sq,
       len(list_filter(embedding, lambda x: x > 0.3)) > 0 AS any_large
FROM embeddings""")
def f06(spark, t):
    e = F.transform("embedding", lambda x: x.cast("double"))
    return t.embeddings.select(
        "vec_id", F.size(F.filter(e, lambda x: x > 0)).alias("positives"),
        F.round(F.aggregate(F.transform(e, lambda x: x * x), F.lit(0.0), lambda a, x: a + x), 6).alias("sum_sq"),
        F.exists("embedding", lambda x: x > 0.3).alias("any_large"))


@query("f06_filter_transform_finish", """
SELECT vec_id, round(list_avg(list_transform(list_filter(embedding, lambda x: x > 0), lambda x: CAST(x AS DOUBLE) * 100)), 4) AS mean_positive FROM embeddings""")
def f06_finish(spark, t):
    kept = F.transform(F.filter("embedding", lambda x: x > 0), lambda x: x.cast("double") * 100)
    mean = F.aggregate(kept, F.struct(F.lit(0.0).alias("s"), F.lit(0).alias("n")),
                       lambda a, x: F.struct((a["s"] + x).alias("s"), (a["n"] + 1).alias("n")),
                       lambda a: a["s"] / F.nullif(a["n"], F.lit(0)))
    return t.embeddings.select("vec_id", F.round(mean, 4).alias("mean_positive"))


@query("f07_array_zscore", """
WITH d AS (SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
m AS (SELECT vec_id, avg(CAST(x AS DOUBLE)) AS mu, stddev_pop(CAST(x AS DOUBLE)) AS sd FROM d GROUP BY 1)
SELECT vec_id, CAST(i - 1 AS INTEGER) AS pos, round((x - mu) / nullif(sd, 0), 4) + 0.0::DOUBLE AS z FROM d JOIN m USING (vec_id)""")
def f07(spark, t):
    z = nested.array_zscore(F.transform("embedding", lambda x: x.cast("double")))
    return t.embeddings.select("vec_id", F.posexplode(z).alias("pos", "z")).withColumn("z", F.round("z", 4) + F.lit(0.0))


@query("f08_maps", """
SELECT c_custkey, c_mktsegment AS segment, CAST(c_nationkey AS VARCHAR) AS nation, 'gold' AS tier, 'nation,segment,tier' AS keys, CAST(3 AS INTEGER) AS n FROM customer""")
def f08(spark, t):
    base = F.map_from_arrays(F.array(F.lit("segment"), F.lit("nation")), F.array(F.col("c_mktsegment"), F.col("c_nationkey").cast("string")))
    extra = F.map_from_entries(F.array(F.struct(F.lit("tier"), F.lit("gold"))))
    m = F.map_concat(base, extra)
    return t.customer.select(
        "c_custkey", m["segment"].alias("segment"), m["nation"].alias("nation"), F.element_at(m, "tier").alias("tier"),
        F.array_join(F.sort_array(F.map_keys(m)), ",").alias("keys"), F.size(F.map_values(m)).alias("n"))


@query("f08_map_explode", """
SELECT key, value, COUNT(*) AS n FROM (SELECT 'segment' AS key, c_mktsegment AS value FROM customer UNION ALL SELECT 'nation', CAST(c_nationkey AS VARCHAR) FROM customer) GROUP BY 1, 2""")
def f08_explode(spark, t):
    m = F.create_map(F.lit("segment"), F.col("c_mktsegment"), F.lit("nation"), F.col("c_nationkey").cast("string"))
    return t.customer.select(F.explode(m).alias("key", "value")).groupBy("key", "value").agg(F.count(F.lit(1)).alias("n"))


@query("f09_structs", """
SELECT o_orderkey AS order_key, o_orderstatus AS state_status, o_orderpriority AS state_detail_priority, o_totalprice AS state_detail_price,
       o_orderpriority AS by_bracket FROM orders""")
def f09(spark, t):
    deep = t.orders.select(
        F.struct(F.col("o_orderkey").alias("key")).alias("order"),
        F.struct(F.col("o_orderstatus").alias("status"),
                 F.struct(F.col("o_orderpriority").alias("priority"), F.col("o_totalprice").alias("price")).alias("detail")).alias("state"))
    deep = deep.withColumn("by_bracket", F.col("state")["detail"].getField("priority"))
    return nested.flatten_struct(deep)


@query("f10_nest", """
SELECT o_custkey, o_orderkey // 10000 AS part, CAST(COUNT(*) AS INTEGER) AS n, string_agg(o_orderkey || ':' || o_orderstatus, ',' ORDER BY o_orderkey) AS items
FROM orders GROUP BY 1, 2""")
def f10(spark, t):
    arrays = nest(t.orders.select("o_custkey", "o_orderkey", "o_orderstatus"), ["o_custkey"], ["o_orderkey", "o_orderstatus"], "o_orderkey", 10_000)
    text = F.transform("items", lambda s: F.concat(s["o_orderkey"].cast("string"), F.lit(":"), s["o_orderstatus"]))
    return arrays.select("o_custkey", "part", F.size("items").alias("n"), F.array_join(text, ",").alias("items"))


@query("f11_json", """
SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k, json_extract_string(props, '$.k') AS k_text,
       '{"id":' || event_id || ',"type":"' || event_type || '"}' AS doc FROM events""")
def f11(spark, t):
    parsed = F.from_json("props", "k INT")
    rows = t.events.select("event_id", "event_type", "props", parsed.alias("p"))
    return rows.select("event_id", F.col("p.k").alias("k"), F.get_json_object("props", "$.k").alias("k_text"),
                       F.to_json(F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("type"))).alias("doc"))


@query("f11_json_tuple_schema", """
SELECT json_extract_string(props, '$.k') AS k, 'STRUCT<k: BIGINT>' AS found, COUNT(*) AS n FROM events GROUP BY 1""")
def f11_tuple(spark, t):
    keys = t.events.select(F.json_tuple("props", "k").alias("k"))
    return keys.groupBy("k").agg(F.count(F.lit(1)).alias("n")).withColumn("found", F.schema_of_json(F.lit('{"k": 1}')))


@query("f12_variant", """
SELECT event_type, CAST(json_extract(props, '$.k') AS INTEGER) % 10 AS digit, COUNT(*) AS n, CAST(SUM(CAST(json_extract(props, '$.k') AS INTEGER)) AS BIGINT) AS total
FROM events GROUP BY 1, 2""")
def f12(spark, t):
    v = t.events.select("event_type", F.parse_json("props").alias("v")).select(
        "event_type", F.variant_get("v", "$.k", "int").alias("k"), F.try_variant_get("v", "$.missing", "int").alias("none"))
    return v.groupBy("event_type", (F.col("k") % 10).alias("digit")).agg(F.count(F.lit(1)).alias("n"), F.sum("k").alias("total"))


@query("f12_variant_sql", """
SELECT o_orderpriority, COUNT(*) AS n, CAST(SUM(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS total, MAX(o_orderkey) AS top FROM orders GROUP BY 1""")
def f12_sql(spark, t):
    t.views("orders")
    return spark.sql("""
        WITH v AS (SELECT parse_json(to_json(struct(o_orderkey AS id, o_orderpriority AS p, array(o_totalprice, 0) AS xs))) AS doc FROM orders)
        SELECT doc:p::string AS o_orderpriority, COUNT(*) AS n,
               CAST(SUM(CAST(doc:xs[0]::double AS DECIMAL(12,2))) AS DOUBLE) AS total, MAX(doc:id::bigint) AS top
        FROM v GROUP BY 1""")


@query("f12_variant_schema", "SELECT 'OBJECT<k: BIGINT>' AS shape, COUNT(*) AS n FROM events")
def f12_schema(spark, t):
    return t.events.select(F.parse_json("props").alias("v")).agg(F.schema_of_variant_agg("v").alias("shape"), F.count(F.lit(1)).alias("n"))


@query("f13_dense_ids", """
SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS id FROM orders""")
def f13(spark, t):
    return nested.dense_ids(t.orders.select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"]).select("o_orderkey", "id")


@query("f13_engine_ids")
def f13_engine(spark, t):
    return t.customer.select("c_custkey", F.monotonically_increasing_id().alias("id"), F.current_user().alias("who"))


@query("f13_engine_ids_unique", "SELECT COUNT(*) AS n, COUNT(*) AS ids, true AS rising_in_partitions FROM customer")
def f13_unique(spark, t):
    """The engine's ids are unique; within a partition they are consecutive."""
    ids = t.customer.select(F.monotonically_increasing_id().alias("id"), F.spark_partition_id().alias("part"))
    per = ids.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("id").alias("d"), (F.max("id") - F.min("id") + 1).alias("span"))
    return per.agg(F.sum("n").alias("n"), F.sum("d").alias("ids"), F.bool_and(F.col("span") == F.col("n")).alias("rising_in_partitions"))


@query("f14_provenance", """
SELECT c_custkey, 'crm' AS _source, 'batch-7' AS _batch_id, '2024-02-01 00:00:00' AS _ingested_at, true AS from_file FROM customer""")
def f14(spark, t):
    tagged = t.customer.select("c_custkey", F.col("_metadata.file_path").endswith(".parquet").alias("from_file"))
    return nested.with_ingest_metadata(tagged, "crm", "batch-7", "2024-02-01 00:00:00").withColumn(
        "_ingested_at", F.col("_ingested_at").cast("string"))


@query("f15_masks", """
SELECT c_custkey, '***-**-' || right(lpad(CAST(c_custkey AS VARCHAR), 9, '0'), 4) AS ssn,
       left(lower(c_name), 2) || '***@' || 'example.com' AS email, '***-***-' || right(c_name, 4) AS phone,
       CAST(CAST(floor(c_acctbal / 1000) * 1000 AS BIGINT) AS VARCHAR) || '-' || CAST(CAST(floor(c_acctbal / 1000) * 1000 AS BIGINT) + 999 AS VARCHAR) AS band
FROM customer""")
def f15(spark, t):
    ssn = F.lpad(F.col("c_custkey").cast("string"), 9, "0")
    email = F.concat(F.lower("c_name"), F.lit("@example.com"))
    return t.customer.select("c_custkey", masks.mask_ssn(ssn).alias("ssn"), masks.mask_email(email).alias("email"),
                             masks.mask_phone("c_name").alias("phone"), masks.mask_band("c_acctbal", 1000).alias("band"))
