"""Cosine top-k: exact by scanning, and by an index of centroid lists."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from spindrift.session import written

QUERY_BLOCK = 1024


def top_k(queries: DataFrame, corpus: DataFrame, k: int, *, query_id: str = "query_id", corpus_id: str = "vec_id",
          vector: str = "embedding", max_queries: int = QUERY_BLOCK, level: int = 0) -> DataFrame:
    """The ``k`` corpus vectors of largest cosine per query, ties to the smaller id.

    The queries are the small side: at most ``max_queries`` are shipped to the tasks at a
    time, checked before, and more are worked off in blocks by their hash. Each task
    scores Arrow batches by one matrix product and keeps ``k`` per query and batch, so
    k x batches rows are shuffled, not queries x corpus. Rows without an id or a vector are left out; of several
    vectors of one query id the least counts. ``level`` is how often the queries were split into blocks.
    """
    if not level:
        queries = queries.filter(F.col(query_id).isNotNull() & F.col(vector).isNotNull()).groupBy(query_id).agg(F.min(vector).alias(vector))
        corpus = corpus.filter(F.col(corpus_id).isNotNull() & F.col(vector).isNotNull())
    rows = queries.select(query_id, vector).limit(max_queries + 1).collect()  # never more than one block and a row
    if len(rows) <= max_queries:
        return _rank(_scores(rows, queries, corpus, k, query_id, corpus_id, vector), k, query_id, corpus_id)
    blocks = -(-queries.count() * 2 // max_queries)
    out = None
    for b in range(blocks):
        part = queries.filter(F.pmod(F.xxhash64(F.lit(level), query_id), F.lit(blocks)) == b)
        one = top_k(part, corpus, k, query_id=query_id, corpus_id=corpus_id, vector=vector, max_queries=max_queries, level=level + 1)
        out = one if out is None else out.unionByName(one)
    return out


def _rank(scored: DataFrame, k: int, query_id: str, corpus_id: str) -> DataFrame:
    w = Window.partitionBy(query_id).orderBy(F.desc("cosine"), F.asc(corpus_id))
    return scored.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def _scores(rows: list, queries: DataFrame, corpus: DataFrame, k: int, query_id: str, corpus_id: str, vector: str) -> DataFrame:
    if not rows:
        return corpus.limit(0).select(F.lit(None).cast(queries.schema[query_id].dataType).alias(query_id), corpus_id,
                                      F.lit(None).cast("double").alias("cosine"))
    ids = np.array([r[0] for r in rows])
    q = np.array([r[1] for r in rows], dtype="float64")
    q /= np.maximum(np.linalg.norm(q, axis=1, keepdims=True), 1e-300)
    shared = corpus.sparkSession.sparkContext.broadcast((ids, q))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, unit = shared.value
        for batch in batches:
            if not len(batch):
                continue
            x = np.array(batch[vector].tolist(), dtype="float64")
            x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
            cid = batch[corpus_id].to_numpy()
            scores = unit @ x.T
            for i, name in enumerate(names):
                best = np.lexsort((cid, -scores[i]))[:k]
                yield pd.DataFrame({query_id: name, corpus_id: cid[best], "cosine": scores[i][best]})

    qt, ct = queries.schema[query_id].dataType.simpleString(), corpus.schema[corpus_id].dataType.simpleString()
    return corpus.select(corpus_id, vector).mapInPandas(run, f"{query_id} {qt}, {corpus_id} {ct}, cosine double")


# The index is fitted on a sample of at most so many vectors; it has at most so many lists, and a task scores at most so many vectors of a list.
SAMPLE, MOST_LISTS, LIST_BLOCK = 20_000, 4096, 50_000


@dataclass(frozen=True)
class Lists:
    """Unit centroids, one row each, and how many of the nearest a query looks into."""

    centroids: np.ndarray
    probes: int


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)


def fit_lists(corpus: DataFrame, k: int = 10, *, corpus_id: str = "vec_id", vector: str = "embedding", lists: int | None = None,
              recall: float = 0.95, sample: int = SAMPLE, rounds: int = 12) -> Lists:
    """Centroid lists by spherical k-means on at most ``sample`` vectors (those of least hash of their ids), and the number of probes with which a
    hundred of the sample's vectors find ``recall`` of their true ``k`` neighbours among the sample.

    Only the centroids and the number of probes come from the sample; every row is put into a list afterwards. ``lists`` is the square root of the rows unless given.
    """
    valid = corpus.filter(F.col(corpus_id).isNotNull() & F.col(vector).isNotNull()).select(corpus_id, vector)
    count = valid.count()
    rows = valid.orderBy(F.xxhash64(F.lit(29), corpus_id), corpus_id).limit(sample).collect()  # the documented bound of the fit
    if not rows:
        return Lists(np.empty((0, 0)), 0)
    x = _unit(np.array([r[1] for r in rows], dtype="float64"))
    size = max(1, min(MOST_LISTS, len(x), lists or round(count ** 0.5)))
    centroids = x[:size].copy()  # in order of a hash, so spread over the data
    for _ in range(rounds):
        nearest = (x @ centroids.T).argmax(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, x)
        filled = np.linalg.norm(sums, axis=1) > 0
        centroids[filled] = _unit(sums[filled])
    home = (x @ centroids.T).argmax(axis=1)
    asked = x[:: max(1, len(x) // 100)]
    true = np.argsort(-(asked @ x.T), axis=1, kind="stable")[:, :k]
    order = np.argsort(-(asked @ centroids.T), axis=1, kind="stable")
    place = np.argsort(order, axis=1)  # of each list, in the order of the query
    needed = np.sort(np.take_along_axis(place, home[true], axis=1).ravel())
    return Lists(centroids, int(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))) - 1)]) + 1)


def _assigned(df: DataFrame, index: Lists, id_column: str, vector: str, probes: int) -> DataFrame:
    """(id, vector, list) with the ``probes`` nearest lists of each row; the centroids are at most MOST_LISTS."""
    shared = df.sparkSession.sparkContext.broadcast(index.centroids)
    kind = df.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                scores = np.array(batch["vector"].tolist(), dtype="float64") @ shared.value.T
                batch["lists"] = list(np.argsort(-scores, axis=1, kind="stable")[:, :probes].astype("int32"))
                yield batch

    valid = df.filter(F.col(id_column).isNotNull() & F.col(vector).isNotNull())
    found = valid.select(F.col(id_column).alias("id"), F.col(vector).cast("array<double>").alias("vector")).mapInPandas(run, f"id {kind}, vector array<double>, lists array<int>")
    return found.select("id", "vector", F.explode("lists").alias("list"))


def build_index(corpus: DataFrame, index: Lists, *, corpus_id: str = "vec_id", vector: str = "embedding", block: int = LIST_BLOCK) -> DataFrame:
    """Every corpus row in its list, lists cut into parts of about ``block`` rows: (id, vector, list, part, parts), written once for many searches."""
    placed = _assigned(corpus, index, corpus_id, vector, 1)
    sizes = written(placed.groupBy("list").count().select("list", F.ceil(F.col("count") / block).cast("int").alias("parts")), "sizes")
    part = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")
    return written(placed.join(F.broadcast(sizes), "list").select("id", "vector", "list", part.alias("part"), "parts"), "lists")


def search(queries: DataFrame, built: DataFrame, index: Lists, k: int, *, query_id: str = "query_id", corpus_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query, corpus id, cosine, rank): the ``k`` best of the lists each query probes, exact scores, ties to the smaller id.

    Queries go to the parts of their lists by a shuffle, so their number is not bounded; a task scores one part of a list against the queries that probe it.
    """
    qt, ct = queries.schema[query_id].dataType.simpleString(), built.schema["id"].dataType.simpleString()
    parts = built.groupBy("list").agg(F.max("parts").alias("parts"))  # one row per list: at most MOST_LISTS
    asked = _assigned(queries, index, query_id, vector, index.probes).join(F.broadcast(parts), "list")
    asked = asked.select("id", "vector", "list", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))

    def score(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(c):
            return pd.DataFrame({query_id: q["id"][:0], corpus_id: c["id"][:0], "cosine": np.empty(0)})
        cid, x = c["id"].to_numpy(), _unit(np.array(c["vector"].tolist(), dtype="float64"))
        made = []
        for at in range(0, len(q), QUERY_BLOCK):
            some = q.iloc[at:at + QUERY_BLOCK]
            scores = _unit(np.array(some["vector"].tolist(), dtype="float64")) @ x.T
            for name, row in zip(some["id"], scores):
                best = np.lexsort((cid, -row))[:k]
                made.append(pd.DataFrame({query_id: name, corpus_id: cid[best], "cosine": row[best]}))
        return pd.concat(made)

    scored = asked.groupBy("list", "part").cogroup(built.groupBy("list", "part")).applyInPandas(score, f"{query_id} {qt}, {corpus_id} {ct}, cosine double")
    return _rank(scored, k, query_id, corpus_id)
