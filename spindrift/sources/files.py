"""Scans of text formats, load validation and write modes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from spindrift.operators.quality import schema_diff


def read_csv(spark: SparkSession, path: str, schema: str | None = None, **options) -> DataFrame:
    """CSV with header; the schema is inferred (one extra pass) only when none is given."""
    reader = spark.read.option("header", "true").options(**options)
    return (reader.schema(schema) if schema else reader.option("inferSchema", "true")).csv(path)


def read_json(spark: SparkSession, path: str, schema: str | None = None, multi_line: bool = False) -> DataFrame:
    reader = spark.read.option("multiLine", str(multi_line).lower())
    return (reader.schema(schema) if schema else reader).json(path)


def read_orc(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.orc(path)


def read_avro(spark: SparkSession, path: str) -> DataFrame:
    """Needs the spark-avro package on the class path."""
    return spark.read.format("avro").load(path)


def read_text(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def read_binary(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob)
            .option("recursiveFileLookup", "true").load(path))


def validate_load(spark: SparkSession, path: str, fmt: str, schema: str, **options) -> DataFrame:
    """What a load would do, without writing: rows, rows that do not parse, an example of one."""
    declared = T._parse_datatype_string(schema)
    with_bad = T.StructType([*declared.fields, T.StructField("_corrupt_record", T.StringType())])
    rows = (spark.read.schema(with_bad).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "_corrupt_record").options(**options).format(fmt).load(path))
    filled = F.lit(0)
    for name in declared.names:  # every column takes part: a pruned scan would not parse the others
        filled = filled + F.col(name).isNotNull().cast("int")
    bad = F.col("_corrupt_record").isNotNull() & (filled >= 0)
    return rows.agg(
        F.count(F.lit(1)).alias("rows_read"),
        F.count(F.when(bad, 1)).alias("bad_rows"),
        F.min(F.when(bad, F.col("_corrupt_record"))).alias("example"),
    )


def check_schema(df: DataFrame, schema: str) -> DataFrame:
    """Missing, extra and retyped columns as rows."""
    found = schema_diff(df.schema, T._parse_datatype_string(schema))
    return df.sparkSession.createDataFrame(found, "column_name string, problem string, expected string, actual string")


def save(df: DataFrame, path: str, mode: str = "error", fmt: str = "parquet", partition_by: Sequence[str] = (),
         max_records_per_file: int = 0, dynamic_overwrite: bool = False) -> None:
    """Batch write. ``dynamic_overwrite`` replaces only the partitions present in ``df``.

    A partitioned write first brings the rows of one partition value together, split
    further by a hash where a value has many rows, so tasks do not each open a file
    per partition and a hot value does not end in one task.
    """
    writer = df.write.mode(mode).format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if dynamic_overwrite:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.save(path)


def by_partition_value(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows of one partition value together; adaptive execution splits the large values."""
    return df.hint("rebalance", *[F.col(c) for c in cols])
