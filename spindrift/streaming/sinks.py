"""foreachBatch bodies: several sinks, and upserts that survive replays."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame

from spindrift.operators.sets import dedup_latest
from spindrift.streaming.buckets import BUCKETS, fold

Body = Callable[[DataFrame, int], None]


def multi_sink(sinks: Mapping[str, Callable[[DataFrame], DataFrame]]) -> Body:
    """Write several results of each batch, each to ``path/batch=N``.

    A replayed batch overwrites its own folder, so every sink holds it once. The batch is
    persisted, since each result would read the source again.
    """

    def body(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for path, shape in sinks.items():
                shape(batch).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        finally:
            batch.unpersist()

    return body


def fold_batches(path: str, keys: Sequence[str], summarise: Callable[[DataFrame], DataFrame],
                 combine: Callable[[DataFrame, DataFrame], DataFrame], buckets: int = BUCKETS) -> Body:
    """Keep a running state per key across micro-batches, in hash buckets of which each batch writes those it touches.

    A replay of batch N starts again from the state before N, so nothing is counted twice; batches older than
    the newest one are skipped. Read it with ``buckets.read_state``.
    """

    def body(batch: DataFrame, batch_id: int) -> None:
        fold(summarise(batch), path, keys, batch_id, combine, buckets)

    return body


def upsert_batches(path: str, keys: Sequence[str], order_by: Sequence[str], buckets: int = BUCKETS) -> Body:
    """Keep the latest row per key across micro-batches; safe to replay."""
    return fold_batches(
        path, keys,
        lambda batch: dedup_latest(batch, keys, order_by),
        lambda old, new: dedup_latest(old.unionByName(new), keys, order_by), buckets,
    )
