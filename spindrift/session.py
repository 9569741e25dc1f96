"""Session defaults, the shared scratch folder and size-checked broadcast."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

# The optimiser knows the size of a scan as its compressed files, which decode to several times that in memory: four times is allowed for.
BROADCAST_LIMIT_BYTES = 16 * 1024 * 1024


def local_session(cores: str | int = "*", app: str = "spindrift", **conf) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.adaptive.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def prepare(spark: SparkSession) -> SparkSession:
    """Runtime settings that results depend on. Sizing is left to the cluster."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Folder every executor can reach: the one named by spark.checkpoint.dir.

    Where the setting is absent it is a folder below the warehouse, which every
    executor can reach by definition.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_spindrift"
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def new_dir(spark: SparkSession, label: str) -> str:
    """A fresh path below the scratch folder; never reused between runs."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def qualified(spark: SparkSession, path: str) -> str:
    """The path with the scheme and host of its store: one without a scheme lies in the cluster's default store, not on the local disk."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(where).toString()


def remove_dir(spark: SparkSession, path: str) -> None:
    """Deletes a folder made by ``new_dir``; anything outside the scratch folder is refused."""
    if not path.startswith(scratch_root(spark) + "/"):
        raise ValueError(f"{path} is not below the scratch folder")
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives the loss of executors."""
    scratch_root(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet to a fresh scratch folder and read again: smaller than a checkpoint, and read by columns."""
    path = new_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def planned_bytes(df: DataFrame) -> int:
    """Upper estimate of the size of ``df`` from the optimiser's statistics."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_if_small(df: DataFrame, limit_bytes: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Broadcast hint only when the planned size is within the limit.

    Beyond it the frame is returned as is and Spark plans a shuffle join, with
    adaptive skew splitting.
    """
    return F.broadcast(df) if planned_bytes(df) <= limit_bytes else df


def broadcast_few_rows(df: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """Broadcast hint for a small result of large input, after counting its rows.

    The optimiser's estimate is no help for an aggregate, so the result is computed once,
    checkpointed and counted. Beyond ``max_rows`` it is returned without the hint.
    """
    done = cut_lineage(df)
    return F.broadcast(done) if done.count() <= max_rows else done
