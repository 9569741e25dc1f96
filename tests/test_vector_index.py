"""The list index beside the exact scan."""

import numpy as np
from pyspark.sql import functions as F

from spindrift.operators import vector
from spindrift.sources.tables import Tables


def pairs(df):
    return {(r.query_id, r.vec_id) for r in df.collect()}


def test_recall_over_the_whole_table(spark):
    rows = Tables(spark, "/root/testdata/sf0.1").embeddings
    asked = rows.filter("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    index = vector.fit_lists(rows, 10)
    built = vector.build_index(rows, index, block=20)
    assert built.count() == rows.count() and built.agg(F.max("parts")).first()[0] > 1
    found, true = pairs(vector.search(asked, built, index, 10)), pairs(vector.top_k(asked, rows, 10))
    assert len(found) == len(true) and len(found & true) >= 0.9 * len(true)
    every = vector.Lists(index.centroids, len(index.centroids))  # all lists probed: exact
    assert pairs(vector.search(asked, built, every, 10)) == true


def test_clustered_vectors_need_few_probes(spark):
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((30, 16)) * 5
    data = [(i, (centres[i % 30] + rng.standard_normal(16) * 0.3).tolist()) for i in range(1500)]
    rows = spark.createDataFrame([*data, (None, [1.0] * 16), (5000, None)], "vec_id long, embedding array<double>")
    index = vector.fit_lists(rows, 5, lists=30)
    assert index.probes <= 6 and len(index.centroids) == 30
    asked = rows.filter("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    found, true = pairs(vector.search(asked, vector.build_index(rows, index), index, 5)), pairs(vector.top_k(asked, rows, 5))
    assert len(found & true) >= 0.9 * len(true)


def test_empty_tables(spark):
    rows = spark.createDataFrame([], "vec_id long, embedding array<double>")
    assert vector.fit_lists(rows, 3).probes == 0
