"""Option sets for sources that need a server; the readers themselves are Spark's."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def jdbc_options(url: str, table: str, *, partition_column: str | None = None, lower: int | None = None,
                 upper: int | None = None, partitions: int = 8, query: str | None = None,
                 fetch_size: int = 10_000, **extra: str) -> dict[str, str]:
    """Options of a JDBC scan split by ranges of a numeric column; ``query`` pushes a sub-query down."""
    out = {"url": url, "dbtable": f"({query}) AS q" if query else table, "fetchsize": str(fetch_size), **extra}
    if partition_column:
        if lower is None or upper is None or lower >= upper:
            raise ValueError("a partitioned scan needs lower < upper")
        out |= {"partitionColumn": partition_column, "lowerBound": str(lower), "upperBound": str(upper),
                "numPartitions": str(partitions)}
    return out


def read_jdbc(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return spark.read.format("jdbc").options(**options).load()


def kafka_options(servers: str, topics: str, *, starting: str = "latest", max_per_trigger: int | None = None,
                  fail_on_data_loss: bool = True) -> dict[str, str]:
    out = {"kafka.bootstrap.servers": servers, "subscribe": topics, "startingOffsets": starting,
           "failOnDataLoss": str(fail_on_data_loss).lower()}
    if max_per_trigger:
        out["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return out


def read_kafka(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return spark.readStream.format("kafka").options(**options).load()


def decode_kafka(df: DataFrame, schema: str) -> DataFrame:
    """Key as text, value parsed as JSON, offsets beside them. Works on any frame with the source's columns."""
    return df.select(
        F.col("key").cast("string").alias("key"),
        F.from_json(F.col("value").cast("string"), schema).alias("v"),
        "topic", "partition", "offset", "timestamp",
    ).select("key", "v.*", "topic", "partition", "offset", "timestamp")


def encode_kafka(df: DataFrame, key: str | Column) -> DataFrame:
    """Key and JSON value columns as the sink expects them."""
    k = F.col(key) if isinstance(key, str) else key
    return df.select(k.cast("string").alias("key"), F.to_json(F.struct(*df.columns)).alias("value"))


def read_socket(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Lines of a socket, for development only."""
    return spark.readStream.format("socket").option("host", host).option("port", str(port)).load()


def read_rate(spark: SparkSession, rows_per_second: int = 10, partitions: int | None = None) -> DataFrame:
    reader = spark.readStream.format("rate").option("rowsPerSecond", str(rows_per_second))
    return (reader.option("numPartitions", str(partitions)) if partitions else reader).load()
