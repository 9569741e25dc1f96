"""From raw documents to a mixed, encoded corpus; every stage is written as Parquet and read by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from spindrift.llm import bpe, exact_dedup, jaccard_join, mixing, quality_classifier
from spindrift.llm.rows import unused, written
from spindrift.session import prepare
from spindrift.sources.tables import Tables

#: What counts as a near copy here; the registered join has limits of its own.
NEAR_WORDS, NEAR_PERCENT = 5, 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts, fitted on the labels of these documents; without labels all stay."""
    weights = quality_classifier.train(docs, Tables(spark, sf_dir).labels)
    if not weights.any():
        return docs
    return quality_classifier.score(docs, weights).filter("predicted = 1").select(docs.columns)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the one with the largest id."""
    return exact_dedup.exact_duplicates(docs).filter("kept").select(docs.columns)


def numbered(docs: DataFrame, column: str) -> DataFrame:
    """``docs`` with a number per row in ``column`` that is the same whenever it is read: its file's rank, times 2^40, plus its place in the file.

    A stage gets a table of files; any other DataFrame is written first.
    """
    if docs._jdf.queryExecution().analyzed().nodeName() != "LogicalRelation":
        docs, _ = written(docs, "numbered")
    file, rank = unused(docs, "_file", "_rank")
    path, place = F.col("_metadata.file_path"), F.col("_metadata.row_index")
    files = docs.select(path.alias(file)).distinct()
    # one row per file
    ranked, _ = written(files.withColumn(rank, F.row_number().over(Window.orderBy(file)).cast("long")), "files")
    own = docs.select("*", path.alias(file), place.alias(column))
    return own.join(ranked, file).withColumn(column, F.shiftleft(F.col(rank), 40) + F.col(column)).select(*docs.columns, column)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of texts linked by runs of five words at 0.8 or more: the one with the least id.

    Rows are told apart by a number of their own, so a row whose text is found nowhere else stays, whatever rows share its id. Rows without words are linked with
    nothing and stay; of linked rows with one id, or without any, the first by number stays.
    """
    row, = unused(docs, "_row")
    rows = numbered(docs, row)
    ids = rows.select(F.col(row).alias("row"), "doc_id", "text")
    groups = jaccard_join.jaccard_groups(ids, id_column="row", words=NEAR_WORDS, percent=NEAR_PERCENT)
    shared = groups.groupBy("component_id").count().filter("count > 1").select("component_id")
    linked, _ = written(groups.join(shared.hint("merge"), "component_id", "left_semi").join(ids.select("row", "doc_id").hint("merge"), "row"), "linked")
    kept = linked.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "row")).alias("least"))
    dropped = linked.join(kept.select(F.col("least.row").alias("row")), "row", "left_anti").select(F.col("row").alias(row))
    return rows.join(dropped, row, "left_anti").select(docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents the mix takes, each as often as it takes them."""
    return mixing.repeated(mixing.mix(docs)).select(docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, each decoded again for comparison."""
    return bpe.encode(docs.select("doc_id", "lang", "source", "text")).select("doc_id", "lang", "source", "n_tokens", "ids", "exact")


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact_copies),
    ("n-gram Jaccard join", near_copies),
    ("source mixing", mixed),
    ("BPE encoding", encoded),
]

#: The classifier and the encoder are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = Tables(prepare(spark), sf_dir).documents
    for i, (label, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs, _ = written(docs, "stage")
    return docs
