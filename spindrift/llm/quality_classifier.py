"""Hashed word n-gram logistic regression, trained by follow-the-regularised-leader updates, scored as sparse dot products."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from spindrift.llm.rows import WordHash, add_columns, name, slices, words_of, written

#: The most labelled rows that a model is fitted on; of more, those with the least hash of their id are taken.
TRAIN_ROWS = 20_000
THRESHOLD = 0.7
HELD_OUT_FOLD, FOLDS = 2, 4


@dataclass(frozen=True)
class Settings:
    """bits: size of the hashed feature space; calm: word count at which a text has moved a good way from the prior; the
    others are those of FTRL-proximal."""

    bits: int = 20
    calm: float = 200.0
    alpha: float = 8.0
    beta: float = 0.1
    l1: float = 0.02
    l2: float = 0.01


class Features:
    """Hashed single words and pairs of neighbours: sorted indices and values.

    A feature found c times in a text of n features has the value sqrt(c / (n + calm)), so that short texts stay near the prior. All pairs of
    a word with itself are one feature.
    """

    def __init__(self, settings: Settings):
        self.shift, self.calm = np.uint64(64 - settings.bits), settings.calm
        self.hashes = WordHash()

    def __call__(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        words = words_of(text)
        codes = np.fromiter(map(self.hashes.__getitem__, words), np.uint64, len(words))
        left, right = codes[:-1], codes[1:]
        pairs = left * np.uint64(0x9E3779B97F4A7C15) + right
        pairs[left == right] = 1
        mixed = np.concatenate((codes, pairs))
        mixed ^= mixed >> np.uint64(29)
        at, times = np.unique((mixed * np.uint64(0xBF58476D1CE4E5B9)) >> self.shift, return_counts=True)
        return at.astype(np.int64), np.sqrt(times / (len(mixed) + self.calm))


class Leader:
    """FTRL-proximal with a learning rate per feature, on top of fixed prior log odds."""

    def __init__(self, settings: Settings, prior: float):
        self.own, self.prior = settings, prior
        self.z = np.zeros(1 << settings.bits)
        self.n = np.zeros(1 << settings.bits)

    def weights(self, at) -> np.ndarray:
        z, n, own = self.z[at], self.n[at], self.own
        return np.where(np.abs(z) <= own.l1, 0.0, (np.sign(z) * own.l1 - z) / ((own.beta + np.sqrt(n)) / own.alpha + own.l2))

    def update(self, at: np.ndarray, values: np.ndarray, label: int) -> None:
        weights = self.weights(at)
        gradient = (sigmoid(weights @ values + self.prior) - label) * values
        grown = self.n[at] + gradient * gradient
        self.z[at] += gradient - (np.sqrt(grown) - np.sqrt(self.n[at])) / self.own.alpha * weights
        self.n[at] = grown


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


def _train(settings: Settings, prior: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    features, leader = Features(settings), Leader(settings, prior)
    for batch in batches:
        for part in slices(batch):
            for text, label in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                leader.update(*features(text or ""), label)
    weights = np.append(leader.weights(slice(None)), prior).astype(np.float32)
    yield pa.RecordBatch.from_arrays([pa.array([weights.tobytes()], pa.binary())], names=["weights"])


def held_out(key: Column) -> Column:
    """Whether a row is kept from training: crc32 of the id as text, modulo 4, is 2. A null id is not."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % FOLDS == HELD_OUT_FOLD, F.lit(False))


def train(
    df: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", label: str = "quality",
    rows: int = TRAIN_ROWS, settings: Settings = Settings(),
) -> np.ndarray:
    """Weights of 2^bits features and the prior log odds, from labelled rows that are not held out.

    At most ``rows`` of them are used, so that the model is fitted in one pass of one task whose memory is the model. The order is
    that of a hash of the id, so reruns agree. Of several labels of an id the most frequent counts (a tie is 0), null ids and labels are left
    out, and of rows that repeat an id each is used. Without labels all weights are 0.
    """
    known = labels.select(name(id_column).alias("_id"), name(label).alias("_label")).filter(
        "_id IS NOT NULL AND _label IS NOT NULL"
    ).filter(~held_out(F.col("_id")))
    voted = known.groupBy("_id").agg((F.avg("_label") > 0.5).cast("int").alias("_label"))
    order = F.xxhash64(F.col("_id").cast("string"))
    chosen = voted.withColumn("_order", order).orderBy("_order", "_id").limit(rows)
    texts = df.select(name(id_column).alias("_id"), name(text).alias("_text"))
    joined, _ = written(texts.join(F.broadcast(chosen), "_id"), "labelled")  # at most ``rows`` ids
    n, good = joined.agg(F.count("*"), F.coalesce(F.sum("_label"), F.lit(0))).first()
    if not n:
        return np.zeros((1 << settings.bits) + 1, dtype=np.float32)
    prior = float(np.log((good + 1) / (n - good + 1)))
    ordered = joined.repartition(1).sortWithinPartitions("_order", "_id", "_text").select("_text", "_label")
    fitted = ordered.mapInArrow(partial(_train, settings, prior), "weights binary").first()
    return np.frombuffer(fitted[0], dtype=np.float32)


def _score(shared, settings: Settings, threshold: float):
    features, weights = Features(settings), shared.value

    def work(texts: list[str | None]) -> list[pa.Array]:
        sums = np.empty(len(texts))
        for i, text in enumerate(texts):
            at, values = features(text or "")
            sums[i] = weights[at] @ values + weights[-1]
        scores = sigmoid(sums)
        return [pa.array(scores, pa.float64()), pa.array((scores >= threshold).astype(np.int32), pa.int32())]

    return work


def score(
    df: DataFrame, weights: np.ndarray, text: str = "text", threshold: float = THRESHOLD, with_text: bool = True,
    settings: Settings = Settings(),
) -> DataFrame:
    """``df`` with score and predicted, from nothing but the text.

    A null text counts as empty and gets the prior as its score; with weights of 0 all scores are 0.5. Whole texts are scored, repeated rows
    agree, an empty table gives an empty one, columns named like a new one are replaced. The weights are broadcast; their size is fixed by the settings.
    """
    shared = df.sparkSession.sparkContext.broadcast(weights)
    return add_columns(df, text, "score double, predicted int", partial(_score, shared, settings, threshold), drop=() if with_text else (text,))
