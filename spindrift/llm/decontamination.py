"""Documents that hold passages of benchmark items, by a prefix-filtered join of word shingles.

Every run of ``words`` words of an item is a window (a shorter item is one), and a window is the list of its shingles of up to three words. Shingles are
ordered by how often all documents hold them, rare ones first. A document can hold ``percent`` of a window's shingles only if it holds one of its
first n - ceil(percent n / 100) + 1: these necessary prefix shingles alone are joined with the documents. A shingle that stands
at place p of the window and at place q of the document sets the only stretch that can be meant, from q - p on; it must lie within the document
(positional bound) and be as long as the window (length bound). What is left is verified word by word over that stretch.

Documents are read twice, once to count and once to look up. A fixed-size bit filter of the shingles wanted goes to the readers, so only their
occurrences are shuffled, however many items there are; the filter may let others through, which the join drops.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window, functions as F

from spindrift.llm.rows import discard, name, slices, written

WORDS, SHINGLE, PERCENT = 10, 3, 100
#: Bits of the filter that names wanted shingles: 4 MB, whatever the data.
FILTER_BITS = 25
_BASE = 0x9E3779B97F4A7C15
#: What separates words: all ASCII characters but digits and letters. A-Z count as a-z.
_KEPT = frozenset(b"0123456789abcdefghijklmnopqrstuvwxyz") | frozenset(range(128, 256))
_CLEAN = bytes(c if c in _KEPT else 32 for c in bytes(range(256)).lower())


def clean(text: str | None) -> bytes:
    """The text's words as lower-case UTF-8, with spaces in place of all that separates them; as many bytes as the text."""
    return (text or "").encode().translate(_CLEAN)


class WordCodes:
    """64-bit codes of the words of a cleaned text, and where they start and end; memory beyond them is that of a stretch."""

    def __init__(self, stretch: int = 1 << 20):
        self.stretch = stretch
        self.powers = self.inverse = np.ones(1, dtype=np.uint64)

    def _grow(self, size: int) -> None:
        if len(self.powers) < size:
            for at, base in (("powers", _BASE), ("inverse", pow(_BASE, -1, 1 << 64))):
                steps = np.full(size, base, dtype=np.uint64)
                steps[0] = 1
                setattr(self, at, np.cumprod(steps, dtype=np.uint64))

    def __call__(self, raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        codes, starts, ends, at = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)], 0
        while at < len(raw):
            end = raw.find(b" ", at + self.stretch)
            end = len(raw) if end < 0 else end
            part = np.frombuffer(raw, dtype=np.uint8, count=end - at, offset=at)
            blank = np.concatenate(([True], part == 32, [True]))
            edges = np.flatnonzero(blank[1:] != blank[:-1])
            first, last = edges[::2], edges[1::2]
            self._grow(len(part) + 1)
            sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(part * self.powers[: len(part)], dtype=np.uint64)))
            code = (sums[last] - sums[first]) * self.inverse[first]
            codes.append((code ^ (code >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93))
            starts.append(first + at)
            ends.append(last + at)
            at = end
        return np.concatenate(codes), np.concatenate(starts), np.concatenate(ends)


def shingle_codes(codes: np.ndarray, size: int) -> np.ndarray:
    """Codes of the runs of ``size`` words."""
    many = max(0, len(codes) - size + 1)
    mixed = np.full(many, size, dtype=np.uint64)
    for i in range(size):
        mixed = (mixed ^ codes[i:i + many]) * np.uint64(_BASE)
        mixed ^= mixed >> np.uint64(29)
    return mixed * np.uint64(0xBF58476D1CE4E5B9)


def _windows(words: int, shingle: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The windows of items, each as its words and the codes of its shingles."""
    coded = WordCodes()
    for batch in batches:
        for part in slices(batch):
            ids, texts, lists = [], [], []
            for at, text in enumerate(part.column(1).to_pylist()):
                raw = clean(text)
                own, codes = [w.decode() for w in raw.split()], coded(raw)[0]
                size = min(words, len(own))
                for i in range(len(own) - size + 1 if size else 0):
                    ids.append(at)
                    texts.append(own[i:i + size])
                    lists.append(shingle_codes(codes[i:i + size], min(shingle, size)).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(ids, pa.int64())), pa.array(texts, pa.list_(pa.string())), pa.array(lists, pa.list_(pa.int64()))], names=["item", "words", "shingles"]
            )


def _marked(bits: np.ndarray, codes: np.ndarray) -> np.ndarray:
    at = (codes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
    return (bits[at >> 3] >> (at & 7)) & 1 == 1


def _counted(sizes: tuple[int, ...], shared: Broadcast, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often the wanted shingles occur, added up per piece of a batch."""
    coded, bits = WordCodes(), shared.value
    for batch in batches:
        for part in slices(batch):
            found = [np.empty(0, np.uint64)]
            for text in part.column(0).to_pylist():
                codes = coded(clean(text))[0]
                for size in sizes:
                    grams = shingle_codes(codes, size)
                    found.append(grams[_marked(bits, grams)])
            grams, counts = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(grams.view(np.int64)), pa.array(counts, pa.int64())], names=["shingle", "n"])


def _looked_up(words: int, sizes: tuple[int, ...], shared: Broadcast, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document its number of words and the occurrences of wanted shingles: place, and the words around it that a window can cover."""
    coded, bits = WordCodes(), shared.value
    kind = pa.struct([("shingle", pa.int64()), ("place", pa.int64()), ("low", pa.int64()), ("near", pa.list_(pa.string()))])
    for batch in batches:
        for part in slices(batch):
            counts, hits = [], []
            for text in part.column(1).to_pylist():
                raw = clean(text)
                codes, starts, ends = coded(raw)
                own = []
                for size in sizes:
                    grams = shingle_codes(codes, size)
                    for at in np.flatnonzero(_marked(bits, grams)).tolist():
                        low, high = max(0, at + size - words), min(len(codes), at + words)
                        near = raw[starts[low]:ends[high - 1]].decode().split()
                        own.append({"shingle": int(grams[at].view(np.int64)), "place": at, "low": low, "near": near})
                counts.append(len(codes))
                hits.append(own)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(counts, pa.int64()), pa.array(hits, pa.list_(kind))], names=["row", "n_words", "hits"]
            )


def _filter(codes: DataFrame, column: str) -> Broadcast:
    """A bit for each code, read by the first bits of codes; a table of fixed size."""
    bit = F.shiftrightunsigned(column, 64 - FILTER_BITS).cast("long")
    filled = codes.select(F.shiftright(bit, 15).alias("block"), bit.bitwiseAND(32767).alias("bit")).groupBy("block").agg(
        F.bitmap_construct_agg("bit").alias("bits")
    )
    bits = np.zeros((1 << (FILTER_BITS - 15), 4096), dtype=np.uint8)
    for block, found in filled.collect():  # at most 2^10 blocks of 4 KB
        bits[block] = np.frombuffer(found, dtype=np.uint8)
    return codes.sparkSession.sparkContext.broadcast(bits.ravel())


def _prefix(windows: DataFrame, counts: DataFrame, percent: int) -> DataFrame:
    """(window, shingle, at): the necessary prefix of each window, rare shingles first, ties by code and place."""
    spread = windows.select("window", F.posexplode("shingles").alias("at", "shingle"))
    known = spread.join(counts, "shingle", "left").select("window", "at", "shingle", F.coalesce("n", F.lit(0)).alias("n"))
    order = F.sort_array(F.collect_list(F.struct("n", "shingle", "at")))  # of one window: ten at most
    needed = F.ceil(F.size("ordered") * F.lit(percent) / 100).cast("int")
    first = known.groupBy("window").agg(order.alias("ordered"))
    return first.select("window", F.explode(F.slice("ordered", F.lit(1), F.size("ordered") - needed + 1)).alias("s")).select("window", "s.shingle", "s.at")


def contaminated_spans(
    docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text: str = "text", item_column: str = "item_id", item_text: str = "text",
    words: int = WORDS, shingle: int = SHINGLE, percent: int = PERCENT,
) -> tuple[DataFrame, DataFrame]:
    """The documents (row, id, n_words) and the stretches of them that hold windows (row, start, length, item).

    ``row`` numbers the rows of ``docs``, so rows that repeat an id, or have none, stay apart. Texts are lower-cased (A-Z) and cut into words at all
    ASCII characters but letters and digits. A stretch holds a window if at least ``percent`` of the window's shingles stand at their places; at
    100 it is the window word for word. Null and empty texts have no words, and items without words no windows; items that
    repeat are found together, items without an id are left out. Texts are read whole and one at a time. Empty tables give empty ones; other columns are not read.
    """
    if not 0 < percent <= 100:
        raise ValueError("percent lies between 1 and 100")
    item_kind = items.schema[item_column].dataType.simpleString()
    cut = items.filter(name(item_column).isNotNull()).select(name(item_column), name(item_text)).mapInArrow(
        partial(_windows, words, shingle), f"item {item_kind}, words array<string>, shingles array<long>"
    )
    held, held_in = written(cut.withColumn("window", F.sha2(F.concat_ws(" ", "words"), 256)), "windows")
    windows, windows_in = written(held.groupBy("window").agg(F.first("words").alias("words"), F.first("shingles").alias("shingles")), "distinct")
    sizes = tuple(sorted(r[0] for r in windows.select(F.least(F.size("words"), F.lit(shingle))).distinct().collect()))  # numbers up to ``shingle``
    texts = docs.select(name(text).alias("text"))
    wanted = windows.select(F.explode("shingles").alias("shingle"))
    counted = texts.mapInArrow(partial(_counted, sizes, _filter(wanted, "shingle")), "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    prefix, prefix_in = written(_prefix(windows, counted, percent), "prefix")
    kind = docs.schema[id_column].dataType.simpleString()
    numbered = docs.select(F.struct(name(id_column).alias("id"), F.monotonically_increasing_id().alias("at")).alias("row"), name(text))
    occurrence = "struct<shingle: long, place: long, low: long, near: array<string>>"
    looked = numbered.mapInArrow(
        partial(_looked_up, words, sizes, _filter(prefix, "shingle")), f"row struct<id: {kind}, at: long>, n_words long, hits array<{occurrence}>"
    )
    # Row numbers hold from here on: they are read from this table.
    marked, marked_in = written(looked.select(F.col("row.at").alias("row"), F.col("row.id").alias("id"), "n_words", "hits"), "occurrences")
    hits = marked.select("row", "n_words", F.explode("hits").alias("h")).select("row", "n_words", "h.*")
    start, size = F.col("place") - F.col("at"), F.size("words")
    within = (start >= 0) & (start + size <= F.col("n_words"))
    keyed, keyed_in = written(prefix.join(windows, "window"), "keyed")
    meant = hits.join(keyed.hint("merge"), "shingle").filter(within)
    stretch = F.slice("near", (start - F.col("low") + 1).cast("int"), size)
    held_at = _aligned(stretch, F.col("words"), shingle) * 100 >= F.size("shingles") * F.lit(percent) if percent < 100 else stretch == F.col("words")
    verified = meant.filter(held_at).select("row", start.alias("start"), size.cast("long").alias("length"), "window").distinct()
    found, _ = written(verified.join(held.select("window", "item").distinct().hint("merge"), "window").select("row", "start", "length", "item"), "spans")
    discard(docs.sparkSession, windows_in, held_in, prefix_in, keyed_in)
    return marked.select("row", "id", "n_words"), found


def _aligned(stretch: Column, words: Column, shingle: int) -> Column:
    """How many shingles of the window stand at their places in the stretch."""
    size = F.least(F.lit(shingle), F.size(words))
    places = F.sequence(F.lit(1), F.size(words) - size + 1)
    return F.size(F.filter(places, lambda i: F.slice(stretch, i, size) == F.slice(words, i, size)))


def contamination(docs: DataFrame, items: DataFrame, id_column: str = "doc_id", **options) -> DataFrame:
    """(id, n_words, n_hit, n_items, items, contaminated) for every row of ``docs``: how many words lie in stretches that hold windows, and the
    ids of the items found, as text in order. Options and unusual rows: see ``contaminated_spans``."""
    rows, spans = contaminated_spans(docs, items, id_column, **options)
    # A row has as many starts as words at most; of one start the longest stretch covers the others.
    longest = spans.groupBy("row", "start").agg(F.max("length").alias("length"))
    before = F.max(F.col("start") + F.col("length")).over(Window.partitionBy("row").orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
    end = F.col("start") + F.col("length")
    added = longest.select("row", F.greatest(F.lit(0), end - F.greatest("start", F.coalesce(before, "start"))).alias("added"))
    covered = added.groupBy("row").agg(F.sum("added").alias("n_hit"))
    named = spans.select("row", "item").distinct().groupBy("row").agg(F.sort_array(F.collect_list(F.col("item").cast("string"))).alias("items"))
    joined = rows.join(covered, "row", "left").join(named, "row", "left")
    none = F.array().cast("array<string>")
    return joined.select(
        F.col("id").alias(id_column), "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.size(F.coalesce("items", none)).cast("long").alias("n_items"),
        F.coalesce("items", none).alias("items"), (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


_SQL_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_SQL_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

CONTAMINATION_SQL = f"""
WITH item AS (
  SELECT item_id, regexp_extract_all({_SQL_LOWER}, '{_SQL_WORD}') AS w FROM benchmark),
cut AS (
  SELECT item_id, w, least({WORDS}, len(w)) AS size, unnest(generate_series(1, len(w) - least({WORDS}, len(w)) + 1)) AS i FROM item WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, size, array_to_string(w[i:i + size - 1], ' ') AS win FROM cut),
doc AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({_SQL_LOWER}, '{_SQL_WORD}') AS w FROM documents),
occ AS (
  SELECT rid, size, i, array_to_string(w[i:i + size - 1], ' ') AS win
  FROM (SELECT rid, w, size, unnest(generate_series(1, len(w) - size + 1)) AS i FROM doc, (SELECT DISTINCT size FROM win) WHERE len(w) >= size)),
hit AS (SELECT DISTINCT rid, i, size, item_id FROM occ JOIN win USING (size, win)),
covered AS (
  SELECT rid, count(DISTINCT k) AS n_hit FROM (SELECT rid, unnest(generate_series(i, i + size - 1)) AS k FROM hit) GROUP BY rid),
items AS (
  SELECT rid, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
  FROM (SELECT DISTINCT rid, item_id FROM hit) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN covered USING (rid) LEFT JOIN items USING (rid)
"""
