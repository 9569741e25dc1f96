"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from spindrift.session import new_dir, remove_dir

#: The white space that separates words: space and U+0009 to U+000D.
SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"
WORD = r"[^\x20\x09-\x0D]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def name(column: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col("`" + column.replace("`", "``") + "`")


def unused(df: DataFrame, *names: str) -> list[str]:
    """Names for helper columns that no column of ``df`` has, upper or lower case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for wanted in names:
        while wanted.lower() in taken:
            wanted = f"_{wanted}"
        out.append(wanted)
    return out


def lower_ascii(value: Column) -> Column:
    """Lower-cases A-Z and nothing else."""
    return F.translate(value, _UPPER, _LOWER)


def words_of(text: str) -> list[bytes]:
    """The maximal runs of other characters than ``SPACE``: bytes.split() splits at exactly these."""
    return text.encode().split()


def add_columns(df: DataFrame, column: str, ddl: str, make: Callable[[], Callable], drop: tuple[str, ...] = ()) -> DataFrame:
    """``df`` with the columns of ``ddl``, computed per Arrow batch from the values of ``column``.

    ``make()`` is called once per task and returns a function from a list of values to a list of Arrow
    arrays. A column of ``df`` that has the name of a new one is replaced, those in ``drop`` are left out,
    all others pass through unchanged.
    """
    new = StructType.fromDDL(ddl)
    kept = [c for c in df.columns if c not in new.names and c not in drop]
    schema = StructType([df.schema[c] for c in kept] + new.fields)
    source = df.select(name(column).alias(unused(df, "_value")[0]), *[name(c) for c in kept if c != column])
    order = [0 if c == column else 1 + [k for k in kept if k != column].index(c) for c in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for part in slices(batch):
                made = work(part.column(0).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(i) for i in order] + made, names=schema.names)

    return source.mapInArrow(run, schema)


def slices(batch: pa.RecordBatch, limit: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """A batch in pieces of about ``limit`` bytes, so that long texts do not pile up in a worker.

    What Arrow has freed goes back to the system after each batch: workers live on between tasks, and executors share their memory.
    """
    step = max(1, int(batch.num_rows * limit / max(limit, batch.nbytes)))
    for start in range(0, batch.num_rows, step):
        yield batch.slice(start, step)
    pa.default_memory_pool().release_unused()


class WordCodes:
    """64-bit codes of the words of a byte string, all words of a stretch at once.

    A word's code is the polynomial of its bytes in a fixed odd base, modulo 2^64: a difference of prefix sums, divided by the power at its
    start. The text is taken in stretches of about ``stretch`` bytes that end at white space, so memory does not grow with it.
    """

    BASE = 0x9E3779B97F4A7C15

    def __init__(self, stretch: int = 1 << 20):
        self.stretch = stretch
        self.space = np.zeros(256, dtype=bool)
        self.space[list(SPACE)] = True
        self.powers = self.inverse = np.ones(1, dtype=np.uint64)

    def _grow(self, size: int) -> None:
        if len(self.powers) < size:
            for at, base in enumerate((self.BASE, pow(self.BASE, -1, 1 << 64))):
                steps = np.full(size, base, dtype=np.uint64)
                steps[0] = 1
                setattr(self, ("powers", "inverse")[at], np.cumprod(steps, dtype=np.uint64))

    def __call__(self, raw: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the words, and the places of their first bytes."""
        data = np.frombuffer(raw, dtype=np.uint8)
        codes, places, at = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], 0
        while at < len(data):
            end = min(len(data), at + self.stretch)
            while end < len(data) and not self.space[data[end]]:
                end += 1
            part = data[at:end]
            blank = np.concatenate(([True], self.space[part], [True]))
            starts = np.flatnonzero(blank[:-1] & ~blank[1:])
            ends = np.flatnonzero(~blank[:-1] & blank[1:])
            self._grow(len(part))
            sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((part + np.uint64(1)) * self.powers[: len(part)], dtype=np.uint64)))
            if len(starts):
                code = (sums[ends] - sums[starts]) * self.inverse[starts]
                codes.append((code ^ (code >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93))
                places.append(starts + at)
            at = end
        return np.concatenate(codes), np.concatenate(places)


class WordHash(dict):
    """64-bit hashes of words, remembered; emptied when it holds ``limit`` words."""

    def __init__(self, limit: int = 200_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def written(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Writes ``df`` as Parquet to the shared scratch folder and reads it again; cuts the lineage, survives executors."""
    path = new_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, *paths: str) -> None:
    """Removes intermediate folders that no result reads any more."""
    for path in paths:
        remove_dir(spark, path)


def public_file(file: str) -> str:
    """Path of a file of the installed public tokenizers; a path with a folder is returned as it is."""
    if os.path.dirname(file):
        return file
    import public_tokenizers

    return public_tokenizers.path(file)
