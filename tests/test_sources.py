"""Scans, option builders, incremental loads, layout."""

import json
import pathlib
import re

import pytest
from pyspark.sql import functions as F

from spindrift.operators import layout
from spindrift.plans.report import plan_text
from spindrift.session import broadcast_if_small, cut_lineage, new_dir, scratch_root
from spindrift.sources import connectors, files, ingest, synthetic
from spindrift.sources.versions import last_version, read_version, write_version


def test_scratch_follows_the_session(spark, monkeypatch):
    root = scratch_root(spark)
    assert spark.conf.get("spark.checkpoint.dir") == root and new_dir(spark, "x").startswith(root)
    assert cut_lineage(spark.range(3)).count() == 3


def test_broadcast_needs_a_small_side(spark, tables):
    assert "ResolvedHint" in broadcast_if_small(tables.nation)._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in broadcast_if_small(tables.nation, 10)._jdf.queryExecution().analyzed().toString()


def test_multi_line_json(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"id": 1, "s": "x\ny"}, {"id": 2, "s": None}], indent=2))
    rows = files.read_json(spark, str(tmp_path), "id int, s string", multi_line=True).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [(1, "x\ny"), (2, None)]


def test_binary(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"abc")
    assert files.read_binary(spark, str(tmp_path)).select("length").first()[0] == 3


def test_validate_load(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,v\n1,2\nBAD,3\n4,x\n")
    row = files.validate_load(spark, str(tmp_path), "csv", "id int, v int", header="true").first()
    assert (row["rows_read"], row["bad_rows"], row["example"]) == (3, 2, "4,x")


def test_jdbc_options():
    o = connectors.jdbc_options("jdbc:x", "t", partition_column="id", lower=0, upper=100, partitions=4, query="SELECT * FROM t WHERE a = 1")
    assert (o["dbtable"], o["partitionColumn"], o["numPartitions"]) == ("(SELECT * FROM t WHERE a = 1) AS q", "id", "4")
    with pytest.raises(ValueError):
        connectors.jdbc_options("jdbc:x", "t", partition_column="id", lower=5, upper=5)


def test_kafka_round_trip(spark, tables):
    o = connectors.kafka_options("h:1", "t", starting="earliest", max_per_trigger=10)
    assert o["subscribe"] == "t" and o["maxOffsetsPerTrigger"] == "10"
    sent = connectors.encode_kafka(tables.nation, "n_nationkey")
    got = connectors.decode_kafka(
        sent.select(F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"), F.lit("t").alias("topic"),
                    F.lit(0).alias("partition"), F.lit(1).alias("offset"), F.current_timestamp().alias("timestamp")),
        "n_nationkey int, n_name string, n_regionkey int")
    assert got.select(*tables.nation.columns).exceptAll(tables.nation).isEmpty() and got.count() == 25


def test_rate_source(spark):
    assert connectors.read_rate(spark, 5, 1).isStreaming


def test_synthetic_is_repeatable(spark):
    cols = {"c": synthetic.category("id", ["a", "b"]), "h": synthetic.hash_pick("id", ["x", "y", "z"], 1)}
    assert synthetic.synthetic(spark, 50, cols).collect() == synthetic.synthetic(spark, 50, cols).collect()
    skew = spark.range(1000).select(synthetic.skewed_key(F.col("id") % 100, [(1, 80), (2, 10)], F.col("id") + 10).alias("k"))
    assert skew.filter("k = 1").count() == 800 and skew.filter("k = 2").count() == 100


def test_ingest_each_file_once(spark):
    src, target, ledger = (new_dir(spark, x) for x in ("in", "target", "ledger"))
    counts = []
    for lo, hi in ((0, 10), (10, 10), (10, 25)):
        spark.range(lo, hi).write.mode("append").parquet(src)
        batch = ingest.ingest_new_files(spark, src, "parquet", "id bigint", target, ledger)
        counts.append((batch, spark.read.parquet(target).count()))
    assert counts == [(0, 10), (-1, 10), (1, 25)]


def test_a_load_reads_new_files_only(spark):
    src, target, ledger = (new_dir(spark, x) for x in ("in", "target", "ledger"))
    seen = set()
    for lo, hi in ((0, 10), (10, 10), (10, 25), (25, 30)):
        spark.range(lo, hi).repartition(2).write.mode("append").parquet(src)
        fresh = {r._file for r in ingest.new_files(spark, src, ledger).collect()}
        assert fresh and not fresh & seen
        seen |= fresh
        ingest.ingest_new_files(spark, src, "parquet", "id bigint", target, ledger)
        assert ingest.new_files(spark, src, ledger).isEmpty()
    recorded = spark.read.parquet(ledger).collect()
    assert {r._file for r in recorded} == seen and len(recorded) == len(seen)  # the one without rows as well
    assert sorted(r.id for r in spark.read.parquet(target).collect()) == list(range(30))
    spark.range(30, 36).repartition(3).write.mode("append").parquet(src)
    counts = [ingest.ingest_new_files(spark, src, "parquet", "id bigint", target, ledger, batch_files=2) for _ in range(3)]
    assert counts[0] >= 0 and counts[-1] == -1 and spark.read.parquet(target).count() == 36


def test_failed_load_is_repeated(spark):
    src, target, ledger = (new_dir(spark, x) for x in ("in", "target", "ledger"))
    spark.range(5).write.parquet(src)
    # rows written, ledger not yet: the next run overwrites the same batch
    spark.range(3).withColumn("_file", F.lit("half")).write.parquet(f"{target}/batch=0")
    assert ingest.ingest_new_files(spark, src, "parquet", "id bigint", target, ledger) == 0
    assert spark.read.parquet(target).count() == 5


def test_high_watermark(spark):
    rows = spark.range(10)
    state = ingest.watermark_of(ingest.above_watermark(rows.filter("id < 6"), "id", None), "id")
    assert ingest.above_watermark(rows, "id", state).count() == 4
    assert ingest.above_watermark(rows.filter("id < 6"), "id", state).count() == 0


def test_versions_ignore_unfinished(spark):
    path = new_dir(spark, "versions")
    assert last_version(spark, path) == -1 and read_version(spark, path) is None
    write_version(spark.range(1), path)
    write_version(spark.range(2), path)
    pathlib.Path(f"{path}/v=2").mkdir()
    assert last_version(spark, path) == 1 and read_version(spark, path).count() == 2


def test_dynamic_overwrite(spark):
    path = new_dir(spark, "dyn")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "x int, p string")
    files.save(df, path, partition_by=["p"])
    files.save(spark.createDataFrame([(9, "a")], "x int, p string"), path, "overwrite", partition_by=["p"], dynamic_overwrite=True)
    assert sorted(r["x"] for r in spark.read.parquet(path).collect()) == [2, 9]


def test_compaction_and_clustering(spark, tables):
    small, big, z = (new_dir(spark, x) for x in ("small", "big", "z"))
    tables.lineitem.repartition(12).write.parquet(small)
    report = {r["stage"]: r["files"] for r in layout.compact(spark, small, big).collect()}
    assert report == {"before": 12, "after": 1} and spark.read.parquet(big).count() == tables.lineitem.count()
    layout.zorder_write(tables.lineitem, ["l_partkey", "l_suppkey"], z, least_files=8)
    ranges = layout.file_ranges(spark.read.parquet(z), ["l_partkey", "l_suppkey"])
    assert layout.skippable(ranges, "l_suppkey", 0, 1).first()["files_skipped"] > 0
    assert layout.skippable(ranges, "l_partkey", 0, 10).first()["files_skipped"] > 0
    assert "small files" in layout.health(spark, small).first()["warnings"]


def test_compaction_keeps_partition_folders(spark):
    src, out = new_dir(spark, "parts"), new_dir(spark, "parts-out")
    rows = spark.range(30_000).selectExpr("id", "CASE WHEN id % 10 < 8 THEN 'a b' WHEN id % 10 = 8 THEN NULL ELSE '01' END AS p", "uuid() AS u")
    rows.repartition(20).write.partitionBy("p").parquet(src)
    sizes = lambda path: layout.file_sizes(spark, path).selectExpr("regexp_replace(path, '/[^/]*$', '') AS folder", "length").collect()
    before = sizes(src)
    target = sum(r.length for r in before if "a%20b" in r.folder or "a b" in r.folder) // 4
    layout.compact(spark, src, out, target)
    after = sizes(out)
    names = lambda rows: {r.folder.rsplit("/", 1)[-1] for r in rows}
    assert names(before) == names(after) and len(names(after)) == 3 and len(after) <= 8 < len(before)
    assert max(r.length for r in after) <= 2 * target
    same = lambda path: sorted(map(repr, spark.read.parquet(path).select("id", "p", "u").collect()))
    assert same(src) == same(out)
    # a file above the target is split by rows
    layout.compact(spark, out, new_dir(spark, "parts-split"), target // 3)


def test_zorder_key_meets_few_bounds_a_row(spark):
    rows = spark.range(2000).selectExpr("IF(id % 7 = 0, NULL, id * 37 % 1000) AS k", "IF(id % 5 = 0, double('NaN'), id % 3) AS few", "CAST(NULL AS BIGINT) AS none")
    columns = ["k", "few", "none"]
    edges = [sorted(set(e)) for e in rows.approxQuantile(columns, [i / 64 for i in range(1, 64)], 0.01)]
    keyed = layout.with_zorder_key(rows, columns, "_z")
    assert len(re.findall("<=|>=", plan_text(keyed))) <= 2 * 6 * len(columns)  # each comparison may be named twice, of 63 bounds a column

    def number(x, bounds):
        return sum(x is not None and (x != x or x >= b) for b in bounds) * 64 // (len(bounds) + 1)

    for r in keyed.collect():
        numbers = [number(r[c], b) for c, b in zip(columns, edges)]
        assert r["_z"] == sum((n >> b & 1) << (b * 3 + i) for i, n in enumerate(numbers) for b in range(6))


def test_clustering_splits_a_hot_value(spark):
    out = new_dir(spark, "hot-z")
    rows = spark.range(40_000).selectExpr("IF(id % 10 < 9, 7, id % 1000) AS k", "id AS v")
    layout.zorder_write(rows, ["k"], out)
    sizes = sorted(r["rows"] for r in layout.file_ranges(spark.read.parquet(out), ["k"]).collect())
    assert sum(sizes) == 40_000 and len(sizes) >= 14 and sizes[-1] <= 2 * sizes[len(sizes) // 2]
