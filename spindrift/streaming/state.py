"""Keyed state with timers."""

from __future__ import annotations

import contextlib
import heapq
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

OUTPUT = "key long, salt int, n long, total_cents long, last_us long, closed boolean"
_TOTALS = "n long, total_cents long, last_us long"
_LATEST = "us long, cents long"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextlib.contextmanager
def keyed_state_store(spark: SparkSession):
    """Queries started inside keep their state in RocksDB, which keyed state with timers needs."""
    key = "spark.sql.streaming.stateStore.providerClass"
    given = spark.conf.get(key, None)
    spark.conf.set(key, _ROCKS)
    try:
        yield
    finally:
        spark.conf.unset(key) if given is None else spark.conf.set(key, given)


class RunningTotals(StatefulProcessor):
    """Per key a value state (count, total and last time), a list state (the latest amounts) and a timer.

    Every call of the state store is a message to the executor, so a batch makes four for a key it knows: it reads and writes the two states. The timer
    stands ``timeout_ms`` past the last event as it was when the timer was set, and is not moved by later batches: when the watermark passes it, it is set
    anew if the last event has moved beyond the watermark less ``timeout_ms``, else the key's state is given out once more as closed and cleared.
    """

    def __init__(self, cents: str, micros: str, timeout_ms: int, keep: int):
        self.cents, self.micros, self.timeout_ms, self.keep = cents, micros, timeout_ms, keep

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.totals = handle.getValueState("totals", _TOTALS)
        self.latest = handle.getListState("latest", _LATEST)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        known = self.totals.get()
        n, total, last = known or (0, 0, 0)
        recent = [tuple(x) for x in self.latest.get()] if known else []
        heapq.heapify(recent)
        for row in rows:
            us, cents = row[self.micros], row[self.cents]
            n += 1
            total += cents or 0
            last = max(last, us or 0)
            if us is not None and cents is not None:
                if len(recent) < self.keep:
                    heapq.heappush(recent, (us, cents))
                else:
                    heapq.heappushpop(recent, (us, cents))
        self.totals.update((n, total, last))
        if recent:
            self.latest.put(sorted(recent))
        if not known:
            self.handle.registerTimer(last // 1000 + self.timeout_ms)
        yield self._row(key, n, total, last, False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        known = self.totals.get()
        if known:
            n, total, last = known
            due = last // 1000 + self.timeout_ms
            if due > timerValues.getCurrentWatermarkInMs():
                self.handle.registerTimer(due)
            else:
                self.totals.clear()
                self.latest.clear()
                yield self._row(key, n, total, last, True)

    def close(self) -> None:
        pass

    @staticmethod
    def _row(key, n: int, total: int, last: int, closed: bool) -> Row:
        return Row(key=key[0], salt=key[1], n=n, total_cents=total, last_us=last, closed=closed)


def keyed_totals(df: DataFrame, key: str, salt: str, cents: str, micros: str, timeout_ms: int, keep: int = 3) -> DataFrame:
    """Running count, total and last time per (key, salt), emitted on every batch that touches it and once more, ``closed``, when it times out.

    ``df`` needs a watermark, which drives the timers. The state of a key is three numbers and its ``keep`` latest amounts, and the rows of a batch
    are read one by one, so no group is held whole; ``salt`` splits a hot key, and readers add its parts up. Start the query within ``keyed_state_store``.
    """
    return df.groupBy(key, salt).transformWithState(
        RunningTotals(cents, micros, timeout_ms, keep), outputStructType=OUTPUT, outputMode="update", timeMode="EventTime"
    )
