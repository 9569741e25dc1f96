"""Incremental loads that may be repeated: new files, new batches, a high watermark."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from spindrift.operators.merge import merge, WhenMatched, WhenNotMatched
from spindrift.session import cut_lineage


def _existing(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        return None


def new_files(spark: SparkSession, source: str, ledger: str, batch_files: int = 100_000) -> DataFrame:
    """(_file, bytes) of the files below ``source`` that the ledger does not list, by name; at most ``batch_files`` of them, the rest is for the next load.

    Only the folder is listed, no file is opened.
    """
    listed = spark.read.format("binaryFile").load(source).select(F.col("path").alias("_file"), F.col("length").alias("bytes"))
    done = _existing(spark, ledger)
    if done is not None:
        listed = listed.join(done.select("_file"), "_file", "left_anti")
    return listed.orderBy("_file").limit(batch_files)


def ingest_new_files(spark: SparkSession, source: str, fmt: str, schema: str, target: str, ledger: str,
                     batch_files: int = 100_000, **options) -> int:
    """Append the rows of files not loaded before; returns the batch number (-1: no new rows).

    The folder is listed, the files of the ledger are taken off, and the scan gets the paths of new files alone, so a load costs what is
    new. The rows go to ``target/batch=N`` before the ledger learns of the files: a failed run repeats the same N and overwrites its own leftovers,
    so each file is loaded once. Files without rows are recorded too, without a batch if the whole load has none.
    """
    fresh = cut_lineage(new_files(spark, source, ledger, batch_files))
    paths = [_literal(r[0]) for r in fresh.select("_file").collect()]  # new files only, at most ``batch_files``: what a scan keeps anyway
    if not paths:
        return -1
    done = _existing(spark, ledger)
    last = None if done is None else done.agg(F.max("batch")).first()[0]
    batch = 0 if last is None else last + 1
    base = {} if _literal(source) != source else {"basePath": source}  # columns of partition folders
    rows = spark.read.schema(schema).format(fmt).options(**{**base, **options}).load(paths)
    rows.select("*", F.col("_metadata.file_path").alias("_file")).write.mode("overwrite").parquet(f"{target}/batch={batch}")
    empty = spark.read.parquet(f"{target}/batch={batch}").isEmpty()
    number = F.lit(None if empty else batch).cast("int")
    fresh.select("_file", number.alias("batch"), "bytes").write.mode("append").parquet(ledger)
    return -1 if empty else batch


def _literal(path: str) -> str:
    """A path as a pattern that matches it alone."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


def new_batches(source: DataFrame, done: DataFrame, col: str) -> DataFrame:
    """Rows of batches not recorded as done."""
    return source.join(done.select(col).distinct(), col, "left_anti")


def above_watermark(source: DataFrame, col: str, state: DataFrame | None) -> DataFrame:
    """Rows beyond the stored high watermark (a frame with one ``high`` value, or nothing yet)."""
    if state is None:
        return source
    return source.filter(F.col(col) > state.agg(F.max("high")).scalar())


def watermark_of(batch: DataFrame, col: str) -> DataFrame:
    return batch.agg(F.max(col).alias("high")).filter("high IS NOT NULL")


def idempotent_ingest(target: DataFrame, source: DataFrame, on: Sequence[str]) -> DataFrame:
    """Upsert by natural key that touches only rows whose content differs: run twice = run once."""
    values = [c for c in source.columns if c not in on]
    changed = " OR ".join(f"NOT (target.`{c}` <=> source.`{c}`)" for c in values) or "false"
    return merge(target, source, on, [WhenMatched("*", when=changed), WhenNotMatched("*")])
