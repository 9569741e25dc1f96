"""Maximal repetitions of words in whole texts, by the dictionary of basic factors.

Level k of the dictionary names every stretch of 2^k words, so that two stretches are equal if and only if their names are; a name of the next
level is a pair of names. Stretches that occur once are left out, as no longer one through them occurs twice, so on ordinary prose a level
is nearly empty.

A run of period q, at least two periods long, repeats a stretch of m = 2^k words, m <= q < 2m, at distance q. Occurrences of one
name whose gaps are at most m/2 form an arithmetic progression, whose gap is the stretch's own period; further progressions within 2m are at most three.
The differences between the members of two such progressions are the periods that a level proposes, one proposal for
each difference, so there are O(n) of them a level. Equal stretches are then extended to both sides by the dictionary, from its longest level down,
and runs found more than once are one.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from spindrift.llm.rows import name, slices

#: The shortest run, and the first level that proposes: periods below twice its length are found by it.
SHORTEST, FIRST = 12, 4
RUN_TYPE = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _named(keys: np.ndarray, places: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Names of ``size`` places by their keys (-1 where a key occurs once), and the repeated places by name, then place, with their names."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    new = np.concatenate(([True], ordered[1:] != ordered[:-1]))
    group = np.cumsum(new) - 1
    several = np.bincount(group)[group] > 1
    names = np.full(size, -1, dtype=np.int32)
    found, group = places[order[several]], group[several]
    names[found] = group
    return names, found, group


def _proposed(found: np.ndarray, group: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and periods that a level of length ``m`` proposes."""
    gap, same = found[1:] - found[:-1], group[1:] == group[:-1]
    if not (same & (gap < 2 * m)).any():
        return np.empty(0, np.int64), np.empty(0, np.int64)
    starts = np.flatnonzero(np.concatenate(([True], ~(same & (gap <= m // 2)))))
    ends = np.concatenate((starts[1:], [len(found)])) - 1
    first, last, of, count = found[starts], found[ends], group[starts], ends - starts + 1
    step = np.where(count > 1, gap[np.minimum(starts, len(gap) - 1)], 0)
    places, periods = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    if m == FIRST:  # shorter periods have no level of their own
        places.append(first[count > 1])
        periods.append(step[count > 1])
    least = 1 if m == FIRST else m
    for ahead in range(1, len(first)):
        a = np.arange(len(first) - ahead)
        a = a[(of[a] == of[a + ahead]) & (first[a + ahead] - last[a] < 2 * m)]
        if not len(a):
            break
        b = a + ahead
        by, base = np.maximum(np.maximum(step[a], step[b]), 1), first[b] - last[a]
        low = np.maximum(0, -((base - least) // by))
        high = np.minimum(count[a] + count[b] - 2, (2 * m - 1 - base) // by)
        each = np.maximum(high - low + 1, 0)
        turn = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each) + np.repeat(low, each)
        a, by, base = np.repeat(a, each), np.repeat(by, each), np.repeat(base, each)
        places.append(last[a] - np.minimum(turn, count[a] - 1) * step[a])
        periods.append(base + by * turn)
    return np.concatenate(places), np.concatenate(periods)


def runs_of(words: np.ndarray, shortest: int = SHORTEST) -> np.ndarray:
    """Rows (start, length, period) of the runs of a sequence of numbers, by start, then period.

    A run is a stretch with smallest period q and at least max(shortest, 2 q) long that no neighbour extends with that period; ``shortest`` is 11 at least.
    """
    n, none = len(words), np.empty((0, 3), dtype=np.int64)
    if shortest < 11:
        raise ValueError("runs below 11 words need levels below 4")
    if n < shortest:
        return none
    names, found, group = _named(words, np.arange(n), n)
    levels, places, periods = [], [], []
    m = 1
    while len(found):
        levels.append(names)
        if m >= FIRST:
            at, by = _proposed(found, group, m)
            places.append(at)
            periods.append(by)
        size = n - 2 * m + 1
        if size <= 0:
            break
        left, right = names[:size], names[m:m + size]
        both = np.flatnonzero((left >= 0) & (right >= 0))
        if not len(both):
            break
        names, found, group = _named(left[both].astype(np.int64) * n + right[both], both, size)
        m *= 2
    if not places:
        return none
    start, period = np.concatenate(places), np.concatenate(periods)
    key = np.unique(period * (n + 1) + start)
    if not len(key):
        return none
    key = key[np.concatenate(([True], key[1:] != key[:-1] + 1))]  # the next place with the same period is the same stretch
    start, period = key % (n + 1), key // (n + 1)
    end = start.copy()  # words from start to end equal those a period later
    for k in range(len(levels) - 1, -1, -1):
        names, size = levels[k], 1 << k
        at = np.minimum(end, len(names) - 1)
        other = np.minimum(end + period, len(names) - 1)
        equal = (end + period < len(names)) & (names[at] >= 0) & (names[at] == names[other])
        end = np.where(equal, end + size, end)
        at, other = np.maximum(start - size, 0), np.minimum(np.maximum(start - size + period, 0), len(names) - 1)
        equal = (start >= size) & (start - size + period < len(names)) & (names[np.minimum(at, len(names) - 1)] >= 0) & (names[np.minimum(at, len(names) - 1)] == names[other])
        start = np.where(equal, start - size, start)
    length = end + period - start
    long = length >= np.maximum(shortest, 2 * period)
    rows = np.stack((start[long], length[long], period[long]), axis=1)
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    smallest = np.concatenate(([True], (rows[1:, :2] != rows[:-1, :2]).any(axis=1)))[: len(rows)]
    rows = rows[smallest]  # of one stretch the least period; the others are its multiples
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def kept_words(n: int, runs: np.ndarray) -> np.ndarray:
    """Which of ``n`` words no run contains beyond its first period."""
    change = np.zeros(n + 1, dtype=np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(change)[:n] == 0


def _found(rewrite: Callable | None, names: list[str], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch):
            counts, offsets, found, texts = [], [0], [none := np.empty((0, 3), dtype=np.int64)], []
            for key, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                words = (text or "").encode().split()
                if rewrite is not None:
                    words = rewrite(key, words)
                counts.append(len(words))
                numbers: dict[bytes, int] = {}
                runs = none
                if len(words) >= SHORTEST:
                    runs = runs_of(np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), dtype=np.int64, count=len(words)))
                if len(runs):
                    words = [w for w, kept in zip(words, kept_words(len(words), runs).tolist()) if kept]
                offsets.append(offsets[-1] + len(runs))
                found.append(runs)
                texts.append(b" ".join(words))
            rows = np.concatenate(found)
            lists = pa.ListArray.from_arrays(
                pa.array(offsets, pa.int32()), pa.StructArray.from_arrays([pa.array(rows[:, i]) for i in range(3)], fields=list(RUN_TYPE))
            )
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(counts, pa.int64()), lists, pa.array(texts, pa.binary()).cast(pa.string())], names=names)


def repeat_tail(key: int | None, words: list[bytes]) -> list[bytes]:
    """The words of a text as the registered query reads them: for ids chosen by checksum, a part of the text repeats to its end.

    With h the CRC-32 of the decimal id and g = floor(h / 10), a text whose h ends in 0 has each word i from a = g mod n on replaced by word
    a + (i - a) mod p, p = 1 + floor((n - a) / (3 + g mod 8)). A text without an id stays as it is.
    """
    if key is None or not words:
        return words
    h = zlib.crc32(str(key).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit = words[a:a + p]
    return words[:a] + (unit * (-(-(n - a) // p)))[: n - a]


def periodic_runs(df: DataFrame, id_column: str = "doc_id", text: str = "text", rewrite: Callable | None = None) -> DataFrame:
    """(id, n_words, runs, collapsed) for every row of ``df``.

    Words are what U+0020 and U+0009 to U+000D separate. ``runs`` holds (start, length, period) of every run of the whole text, numbered in words
    from 0, by start, then period. ``collapsed`` is the text without the words that a run contains beyond its first period, joined by
    one space. ``rewrite`` may change the words of a text before (a function of id and words). Null and empty texts have no words, no
    runs and an empty ``collapsed``; rows that repeat an id, or have none, are rows of their own; an empty table gives an
    empty one. Other columns of ``df`` are not read. Texts are read one at a time and whole; memory follows the longest one.
    """
    kind = df.schema[id_column].dataType.simpleString()
    own = f"`{id_column.replace('`', '``')}`"
    schema = f"{own} {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    names = [id_column, "n_words", "runs", "collapsed"]
    return df.select(name(id_column), name(text)).mapInArrow(partial(_found, rewrite, names), schema)


def run_digests(runs: DataFrame) -> DataFrame:
    """``periodic_runs`` as figures: the number of runs, the longest one (then the first, then that of the least period) and two digests."""
    best = F.expr(
        "array_max(transform(runs, r -> named_struct('length', r.length, 'before', -r.start, 'short', -r.period)))"
    )
    lines = F.expr("concat_ws('', transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')))")
    found = runs.withColumn("best", best)
    length, period = F.col("best.length"), -F.col("best.short")
    return found.select(
        runs.columns[0], F.size("runs").cast("long").alias("n_runs"), (-F.col("best.before")).alias("start"), length.alias("length"),
        period.alias("period"), F.floor(F.expr("1000 * best.length div -best.short")).cast("long").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"),
    )
