"""A table kept as numbered, complete versions: ``path/v=0``, ``path/v=1`` and so on.

A new version is written beside the old ones, so a job may read the table it replaces,
and a failed write leaves no version behind: only committed folders count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def last_version(spark: SparkSession, path: str, below: int | None = None) -> int:
    """Highest committed version (under ``below``), -1 if there is none."""
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/v=*/_SUCCESS")
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [int(f.getPath().getParent().getName()[2:]) for f in (fs.globStatus(where) or [])]
    return max([v for v in found if below is None or v < below], default=-1)


def read_version(spark: SparkSession, path: str, version: int | None = None) -> DataFrame | None:
    """One version, the newest by default; None if there is none."""
    v = last_version(spark, path) if version is None else version
    return None if v < 0 else spark.read.parquet(f"{path}/v={v}")


def write_version(df: DataFrame, path: str, version: int | None = None) -> int:
    """Write the next (or a given) version; returns its number."""
    v = last_version(df.sparkSession, path) + 1 if version is None else version
    df.write.mode("overwrite").parquet(f"{path}/v={v}")
    return v
