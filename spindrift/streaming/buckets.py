"""A running state per key in hash buckets, of which a batch rewrites only those it touches.

``path/data/v=N/_bucket=K`` holds bucket K as batch N left it, ``path/manifest/v=N`` names for every bucket the batch that wrote it last. A manifest is written after
its data, so a failed batch leaves nothing behind that counts, and a replay of batch N starts from the manifest before N. Buckets that neither of the two last manifests
names are removed.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from spindrift.sources.versions import last_version

BUCKETS = 64
_MANIFEST = "bucket int, version long"


def _manifest(spark: SparkSession, path: str, version: int) -> dict[int, int]:
    """Bucket -> version of its data: at most one entry for each bucket."""
    if version < 0:
        return {}
    return {r.bucket: r.version for r in spark.read.schema(_MANIFEST).parquet(f"{path}/manifest/v={version}").collect()}


def _folders(path: str, manifest: dict[int, int], buckets: Sequence[int]) -> list[str]:
    return [f"{path}/data/v={manifest[b]}/_bucket={b}" for b in sorted(buckets) if b in manifest]


def last_batch(spark: SparkSession, path: str) -> int:
    """The newest batch that was folded in whole, -1 if there is none."""
    return last_version(spark, f"{path}/manifest")


def read_state(spark: SparkSession, path: str) -> DataFrame | None:
    """The state after the last batch; None before the first."""
    manifest = _manifest(spark, path, last_batch(spark, path))
    return spark.read.parquet(*_folders(path, manifest, list(manifest))) if manifest else None


def fold(news: DataFrame, path: str, keys: Sequence[str], batch: int, combine: Callable[[DataFrame, DataFrame], DataFrame], buckets: int = BUCKETS) -> None:
    """Combine the summary of a batch, one row per key, with the state; batches older than the last are skipped.

    ``combine(old, new)`` gets the touched buckets only. A state keeps the number of buckets it began with.
    """
    spark = news.sparkSession
    last = last_batch(spark, path)
    if batch < last:
        return
    base = last_version(spark, f"{path}/manifest", below=batch)
    manifest = _manifest(spark, path, base)
    bucket = F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int")
    news = news.persist()
    try:
        touched = [r[0] for r in news.select(bucket).distinct().collect()]  # at most ``buckets`` numbers
        old = _folders(path, manifest, touched)
        rows = combine(spark.read.parquet(*old), news) if old else news
        rows.withColumn("_bucket", bucket).repartition("_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(f"{path}/data/v={batch}")
    finally:
        news.unpersist()
    now = manifest | dict.fromkeys(touched, batch)
    spark.createDataFrame(sorted(now.items()), _MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest/v={batch}")
    _remove_old(spark, path, base, batch)


def _remove_old(spark: SparkSession, path: str, base: int, batch: int) -> None:
    """Deletes the manifest before ``base`` and the buckets that only it names."""
    gone = last_version(spark, f"{path}/manifest", below=base) if base >= 0 else -1
    if gone < 0:
        return
    kept = {*_manifest(spark, path, base).items(), *_manifest(spark, path, batch).items()}
    old = [f"{path}/data/v={v}/_bucket={b}" for b, v in _manifest(spark, path, gone).items() if (b, v) not in kept]
    for folder in [*old, f"{path}/manifest/v={gone}"]:
        where = spark._jvm.org.apache.hadoop.fs.Path(folder)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
