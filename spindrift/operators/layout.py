"""File layout: compaction, clustering, file statistics and health."""

from __future__ import annotations

import contextlib
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from spindrift.session import cut_lineage, planned_bytes


def file_sizes(spark: SparkSession, path: str, suffix: str = "parquet") -> DataFrame:
    """(path, length) of the files below a folder. The content column is pruned, so no file is read."""
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true")
        .option("pathGlobFilter", f"*.{suffix}").load(path).select("path", "length")
    )


def compact(spark: SparkSession, path: str, out: str, target_bytes: int = 128 << 20) -> DataFrame:
    """Rewrite a folder of small Parquet files into files near ``target_bytes``; reports both sides.

    Partition folders stay: the files of each are packed by bytes, and a write task takes one pack of one folder (larger files are split by rows).
    ``out`` is a new folder: readers of ``path`` are not disturbed and a failed run leaves it whole.
    """
    def sizes(folder: str) -> DataFrame:
        return file_sizes(spark, folder).agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))

    folders = partition_columns(spark, path)
    if folders:
        packs, count = _packs(spark, path, target_bytes)
        with _settings(spark, {"spark.sql.sources.partitionColumnTypeInference.enabled": "false"}):  # folder names stay as they are
            rows = spark.read.parquet(path)
        tagged = rows.select("*", F.col("_metadata.file_path").alias("_file"))
        # one row per file: Spark broadcasts it while it is small, else both sides are shuffled
        packed = tagged.join(packs, "_file").withColumn("_pack", F.col("_first") + F.pmod(F.xxhash64(*rows.columns), F.col("_parts")).cast("int"))
        packed.repartitionById(count, F.col("_pack")).select(rows.columns).write.mode("error").partitionBy(*folders).parquet(out)
    else:
        with _settings(spark, {
            "spark.sql.files.maxPartitionBytes": str(target_bytes),
            "spark.sql.files.openCostInBytes": "0",
            "spark.sql.files.minPartitionNum": "1",
        }):
            # the scan packs small files into tasks of the target size: nothing is shuffled
            spark.read.parquet(path).write.mode("error").parquet(out)
    return sizes(path).select(F.lit("before").alias("stage"), "*").unionByName(sizes(out).select(F.lit("after").alias("stage"), "*"))


def pieces(df: DataFrame, least: int, target_bytes: int = 128 << 20) -> int:
    """How many parts to write a table in: one for each ``target_bytes`` of its planned size, ``least`` for a small one."""
    return max(least, -(-planned_bytes(df) // target_bytes))


def partition_columns(spark: SparkSession, path: str) -> list[str]:
    """Names of the partition folders (``name=value``) below a folder, outermost first."""
    one = file_sizes(spark, path).select("path").first()
    if one is None:
        return []
    below = one["path"].split(path.rstrip("/").rsplit("/", 1)[-1] + "/", 1)[-1]
    return [unquote(step.split("=", 1)[0]) for step in below.split("/")[:-1] if "=" in step]


def _packs(spark: SparkSession, path: str, target_bytes: int) -> tuple[DataFrame, int]:
    """(_file, _first, _parts) and the number of packs: the files of a folder in order of their running size go to packs ``_first`` to
    ``_first + _parts - 1``, more than one only for a file above the target."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)
    files = listed.select(F.col("_metadata.file_path").alias("_file"), "length").withColumn("_folder", F.regexp_replace("_file", r"/[^/]*$", ""))
    upto = Window.partitionBy("_folder").orderBy("length", "_file").rowsBetween(Window.unboundedPreceding, -1)
    large = F.col("length") > target_bytes
    placed = files.withColumn("_before", F.coalesce(F.sum(F.when(~large, F.col("length"))).over(upto), F.lit(0))).select(
        "_file", "_folder", large.alias("_large"), F.when(large, F.ceil(F.col("length") / target_bytes)).otherwise(F.lit(1)).cast("int").alias("_parts"),
        F.when(~large, F.floor(F.col("_before") / target_bytes)).cast("int").alias("_no"))
    # a pack is (folder, number), or a large file by itself; they are numbered from 0
    pack = placed.withColumn("_own", F.when(F.col("_large"), F.col("_file")))
    numbered = pack.groupBy("_folder", "_no", "_own").agg(F.max("_parts").alias("_size"))
    before = F.sum("_size").over(Window.orderBy("_folder", "_no", "_own").rowsBetween(Window.unboundedPreceding, -1))  # one row per pack
    numbered = cut_lineage(numbered.withColumn("_first", F.coalesce(before, F.lit(0)).cast("int")))
    count = numbered.agg(F.sum("_size")).first()[0]
    side = numbered.select(F.col("_folder").alias("f"), F.col("_no").alias("n"), F.col("_own").alias("o"), "_first")
    on = F.col("_folder").eqNullSafe(F.col("f")) & F.col("_no").eqNullSafe(F.col("n")) & F.col("_own").eqNullSafe(F.col("o"))
    return pack.join(side, on).select("_file", "_first", "_parts"), count


@contextlib.contextmanager
def _settings(spark: SparkSession, values: dict[str, str]):
    given = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in given.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def with_zorder_key(df: DataFrame, cols: Sequence[str], name: str, bits: int = 6, error: float = 0.01) -> DataFrame:
    """Interleaved bits of each column's quantile number: rows near in every column get near keys."""
    edges = df.approxQuantile(list(cols), [i / (1 << bits) for i in range(1, 1 << bits)], error)

    numbers, marked = [f"_{name}_{i}" for i in range(len(cols))], df.withColumns({f"_{name}_{i}": F.lit(0) for i in range(len(cols))})
    bounds = [sorted(set(e)) for e in edges]
    for step in [1 << b for b in reversed(range(bits))]:  # binary search, a step a projection: a row meets ``bits`` bounds, not all
        marked = marked.withColumns({n: F.col(n) + F.when(
            F.get(F.array(*[F.lit(float(x)) for x in found]), F.col(n) + F.lit(step - 1)) <= F.col(c).cast("double"), F.lit(step)).otherwise(F.lit(0))
            for n, c, found in zip(numbers, cols, bounds) if found})
    # a column of few values has few bounds: spread them, so that its high bits count too
    marked = marked.withColumns({n: F.floor(F.col(n) * F.lit(1 << bits) / F.lit(len(found) + 1)).cast("int") for n, found in zip(numbers, bounds)})
    key = F.lit(0).cast("long")
    for b in range(bits):
        for i, n in enumerate(numbers):
            bit = F.shiftright(F.col(n), b).bitwiseAND(F.lit(1)).cast("long")
            key = key + F.shiftleft(bit, b * len(numbers) + i)
    return marked.withColumn(name, key).drop(*numbers)


def zorder_write(df: DataFrame, cols: Sequence[str], out: str, target_bytes: int = 128 << 20, least_files: int = 16) -> None:
    """Write a folder whose files each cover a small range of every clustering column.

    As many files as the planned size has targets, ``least_files`` at least. Rows of one key are cut further by the columns themselves and the rest of the
    row, so a key that most rows share fills many files.
    """
    files = pieces(df, least_files, target_bytes)
    keyed = with_zorder_key(df, cols, "_z").withColumn("_rest", F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
    (keyed.repartitionByRange(files, "_z", *cols, "_rest")
     .sortWithinPartitions("_z", *cols).drop("_z", "_rest").write.mode("error").parquet(out))


def file_ranges(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows and per-column bounds of each file behind a frame."""
    return df.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.min(c).alias(f"min_{c}") for c in cols], *[F.max(c).alias(f"max_{c}") for c in cols],
    )


def skippable(ranges: DataFrame, column: str, low, high) -> DataFrame:
    """How many files a range predicate must read."""
    touched = (F.col(f"max_{column}") >= F.lit(low)) & (F.col(f"min_{column}") <= F.lit(high))
    return ranges.agg(
        F.count(F.lit(1)).alias("files"),
        F.count(F.when(touched, 1)).alias("files_read"),
        F.count(F.when(~touched, 1)).alias("files_skipped"),
    )


def write_amplification(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Share of files that hold at least one of the keys: what a keyed update would rewrite."""
    tagged = df.select(key, F.col("_metadata.file_path").alias("file"))
    hit = tagged.join(keys.select(key).distinct(), key, "left_semi").select("file").distinct()
    files = tagged.select("file").distinct().agg(F.count(F.lit(1)).alias("files"))
    touched = hit.agg(F.count(F.lit(1))).scalar()
    return files.withColumn("files_touched", touched).withColumn(
        "share_touched", F.col("files_touched").cast("double") / F.col("files")
    )


# fixed values: thresholds of the health rules
SMALL_FILE_BYTES = 16 << 20
MANY_FILES = 10_000
MANY_PARTITIONS = 5_000


def health(spark: SparkSession, path: str) -> DataFrame:
    """File count, mean size, partitions and warnings for a folder of Parquet files."""
    files = file_sizes(spark, path).withColumn("partition", F.regexp_replace("path", r"/[^/]*$", ""))
    one = files.agg(
        F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"),
        F.coalesce(F.avg("length"), F.lit(0.0)).alias("mean_bytes"), F.count_distinct("partition").alias("partitions"),
    )
    warnings = F.array_compact(F.array(
        F.when(F.col("mean_bytes") < SMALL_FILE_BYTES, F.lit("small files")),
        F.when(F.col("files") > MANY_FILES, F.lit("many files")),
        F.when(F.col("partitions") > MANY_PARTITIONS, F.lit("many partitions")),
    ))
    return one.withColumn("warnings", F.concat_ws(", ", warnings))
