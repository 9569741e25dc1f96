"""Named Parquet tables below one root folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLE_NAMES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Parquet scan; filters and column selection reach it through Catalyst."""
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")


class Tables:
    """Attribute access to the tables of a folder: ``Tables(spark, d).orders``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._frames: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLE_NAMES:
            raise AttributeError(name)
        if name not in self._frames:
            self._frames[name] = read_table(self.spark, self.root, name)
        return self._frames[name]

    def views(self, *names: str) -> None:
        """Register the named tables as temporary views for SQL text."""
        for name in names:
            getattr(self, name).createOrReplaceTempView(name)

    def stream_path(self, name: str) -> str:
        """A glob matching the table, be it one file or a folder of files."""
        return f"{self.root}/{name}.parque[t]"
