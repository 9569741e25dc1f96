"""Exact Jaccard join of documents on word n-grams, by pivots in a metric space, down to groups of linked documents.

Jaccard distance is a metric, but two documents without a common n-gram are at distance 1 of each other and of any pivot, so no triangle
inequality tells them apart. The space is therefore first cut by the simplest pivots there are, single n-grams: a document lies in the regions
of its *first* n-grams, as many that two documents within the distance must meet in one (n - ceil(t n) + 1 of n). N-grams
are ordered by how often their hash slot occurs in all documents, rare ones first, so that passages shared by many
documents open no regions unless a document holds little else.

Each region is then joined by rounds. Some of its documents become pivots, and the distance of every other one to each pivot is
computed exactly. Documents within the threshold are linked, and live in the Voronoi cell of their nearest pivot. A document can only be
linked to one of that cell if it is within twice the threshold of the pivot (triangle inequality): such boundary documents are
replicated into the cell. What has no near pivot forms the outer region. Pivots leave, as they were compared with all, and cells and
outer regions are joined by further rounds until each holds documents of one group only. Pivots per round grow eightfold, so the
number of rounds is logarithmic, and documents already in one group never meet again. Only the first round cuts cells: with many
pivots close to each other, boundary documents would be copied into most of their cells.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from spindrift.llm.rows import WordCodes, discard, name, slices, written
from spindrift.operators.graph import components

WORDS = 4
PERCENT = 85
#: Slots of the frequency table: its size is fixed, whatever the data.
SLOT_BITS, PART_BITS = 18, 12
#: Bits of the filter that names documents whose whole sets are wanted: fixed as well.
FILTER_BITS = 25
#: Bits of a document's parity sketch: whether an odd number of its n-grams falls on the bit.
PARITY_BITS = 512
FIRST_PIVOTS, GROWTH, SMALL_FIRST = 1, 8, 3


class Shingles:
    """Hashed word n-grams of many texts at once."""

    def __init__(self, words: int):
        self.words, self.codes = words, WordCodes()

    def all(self, texts: list[str | None]) -> list[np.ndarray]:
        """Every n-gram of each text in its order, repeated ones too."""
        raw = [(t or "").encode().lower() for t in texts]
        ends = np.cumsum([len(r) + 1 for r in raw])
        codes, places = self.codes(b"\n".join(raw))
        owner = np.searchsorted(ends, places, side="right")
        counts = np.bincount(owner, minlength=len(raw))
        whole = self._mixed(codes, self.words)
        whole = whole[owner[: len(whole)] == owner[len(owner) - len(whole):]]
        grams = np.maximum(counts - self.words + 1, 0)
        out = np.split(whole, np.cumsum(grams)[:-1])
        first = np.cumsum(counts) - counts
        for i in np.flatnonzero((counts > 0) & (counts < self.words)):
            out[i] = self._mixed(codes[first[i]:first[i] + counts[i]], int(counts[i]))
        return out

    def sets(self, texts: list[str | None]) -> list[np.ndarray]:
        """The set of each text, as sorted 64-bit numbers."""
        return [np.unique(grams) for grams in self.all(texts)]

    @staticmethod
    def _mixed(codes: np.ndarray, size: int) -> np.ndarray:
        grams = max(0, len(codes) - size + 1)
        mixed = np.full(grams, size, dtype=np.uint64)
        for i in range(size):
            mixed = (mixed ^ codes[i:i + grams]) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(32)
        return mixed * np.uint64(0xBF58476D1CE4E5B9)


def needed(size: int, percent: int) -> int:
    """The least size of a set linked to, or of the common part with, one of ``size``."""
    return -(-size * percent // 100)


def _slots(words: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each hash slot occurs in the sets of a task, in parts."""
    sets, counts = Shingles(words), np.zeros(1 << SLOT_BITS, dtype=np.int64)
    for batch in batches:
        for part in slices(batch):
            found = np.concatenate(sets.all(part.column(0).to_pylist()))
            counts += np.bincount((found >> np.uint64(64 - SLOT_BITS)).astype(np.int64), minlength=len(counts))
    pieces = counts.reshape(-1, 1 << PART_BITS)
    yield pa.RecordBatch.from_arrays(
        [pa.array(range(len(pieces)), pa.int32()), pa.array([p.tobytes() for p in pieces], pa.binary())], names=["part", "counts"]
    )


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            sums[part] = sums.get(part, 0) + np.frombuffer(counts, dtype=np.int64)
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(sums), pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())], names=["part", "counts"]
    )


def slot_order(texts: DataFrame, words: int) -> np.ndarray:
    """Rank class of each hash slot: rare slots first. Counted over all texts; the table has 2^18 numbers of 16 bits."""
    kind = "part int, counts binary"
    parts = 1 << (SLOT_BITS - PART_BITS)
    summed = texts.mapInArrow(partial(_slots, words), kind).repartition(parts, "part").mapInArrow(_added, kind)
    table = np.zeros((parts, 1 << PART_BITS), dtype=np.int64)
    for part, counts in summed.collect():  # parts of a table of fixed size
        table[part] = np.frombuffer(counts, dtype=np.int64)
    return (np.log2(table.ravel() + 1) * 64).astype(np.uint16)


def stored(size: int, percent: int) -> int:
    """How many first n-grams of a set are kept: enough that two sets without common ones among them are known to be further
    apart than twice the distance e, which takes a share of e / (1 - e)."""
    return min(size, -(-size * (100 - percent) * 115 // (percent * 100)) + 1)


def _prefixes(words: int, percent: int, shared, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document the size and digest of its set, its first n-grams in the common order as ascending keys, and how many of
    them open regions."""
    sets, order = Shingles(words), shared.value
    low = np.uint64((1 << 48) - 1)
    for batch in batches:
        for part in slices(batch):
            sizes, digests, kept, firsts, parities = [], [], [], [], []
            for own in sets.sets(part.column(1).to_pylist()):
                keys = (order[(own >> np.uint64(64 - SLOT_BITS)).astype(np.int64)].astype(np.uint64) << np.uint64(48)) | (own & low)
                keys.sort()
                sizes.append(len(own))
                digests.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest())
                firsts.append(len(own) - needed(len(own), percent) + 1 if len(own) else 0)
                kept.append(keys[:stored(len(own), percent)].view(np.int64))
                odd = np.bincount((own & np.uint64(PARITY_BITS - 1)).astype(np.int64), minlength=PARITY_BITS) & 1
                parities.append(np.packbits(odd.astype(np.uint8)).view(np.int64))
            offsets = np.concatenate(([0], np.cumsum([len(k) for k in kept]))).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*kept, np.empty(0, np.int64)])))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(firsts, pa.int32()), lists, pa.array(parities, pa.list_(pa.int64()))],
                names=["id", "n", "digest", "first", "keys", "parity"],
            )


def _sets(words: int, shared, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole sets of the documents whose bit is set."""
    sets, bits = Shingles(words), shared.value
    for batch in batches:
        marks = batch.column(2).to_numpy()
        wanted = (bits[marks >> 3] >> (marks & 7)) & 1 == 1
        for part in slices(batch.filter(pa.array(wanted))):
            own = [s.view(np.int64) for s in sets.sets(part.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(own, pa.list_(pa.int64()))], names=["node", "grams"])


def _mark(node: Column) -> Column:
    return F.pmod(F.xxhash64(node.cast("string")), F.lit(1 << FILTER_BITS))


def whole_sets(source: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """(node, grams) for at least the given nodes, from the rows (id, text).

    The nodes go to the readers as a bit filter of fixed size (4 MB), so that texts need not be shuffled to be picked. Nodes that share a bit
    are read needlessly, never left out; with very many nodes the filter only saves less.
    """
    spark = source.sparkSession
    bit = _mark(F.col("node"))
    filled = nodes.select(F.shiftright(bit, 15).alias("block"), bit.bitwiseAND(32767).alias("bit")).groupBy("block").agg(
        F.bitmap_construct_agg("bit").alias("bits")
    )
    bits = np.zeros((1 << (FILTER_BITS - 15), 4096), dtype=np.uint8)
    for block, found in filled.collect():  # at most 2^10 blocks of 4 KB
        bits[block] = np.frombuffer(found, dtype=np.uint8)
    shared = spark.sparkContext.broadcast(bits.ravel())
    kind = source.schema["id"].dataType.simpleString()
    marked = source.select("id", "text", _mark(F.col("id")).alias("mark")).filter("id IS NOT NULL")
    return marked.mapInArrow(partial(_sets, words, shared), f"node {kind}, grams array<long>")


def _reach(least: int) -> Column:
    """Whether two sets can have a similarity of ``least`` percent, by their sizes and by their first n-grams.

    Only the set whose first n-grams end earlier is sure to find all that it shares of them among the first of the other, so the
    larger of the two counts is the bound.
    """
    return F.least("n", "m", F.greatest("most", "p_most")) * (100 + least) >= (F.col("n") + F.col("m")) * least


def _alike(least: int) -> Column:
    """Whether two sets can have a similarity of ``least`` percent, by their parity sketches: sketches differ in at most as many bits as
    the sets in n-grams."""
    differing = sum((F.bit_count(F.col("parity")[i].bitwiseXOR(F.col("p_parity")[i])) for i in range(PARITY_BITS // 64)), F.lit(0))
    return differing * (100 + least) <= (F.col("n") + F.col("m")) * (100 - least)


def _possible(pairs: DataFrame, keys: DataFrame, least: int, keep) -> DataFrame:
    """The pairs (x, p) that may have a similarity of ``least`` percent, by their first n-grams.

    Up to the smaller of the two last keys both sides are known in full; beyond, at most the smaller rest can be common. The first n-grams of the documents in
    question are picked once for both sides.
    """
    wanted = pairs.select(F.col("x").alias("node")).unionByName(pairs.select(F.col("p").alias("node"))).distinct()
    held = keep(keys.select("node", "keys").join(wanted.hint("merge"), "node", "left_semi"), "held")
    of = lambda side: held.select(F.col("node").alias(side), F.col("keys").alias(f"of_{side}"))
    both = pairs.join(of("x").hint("merge"), "x").join(of("p").hint("merge"), "p")
    last = lambda side, n: F.when(F.size(side) < F.col(n), F.element_at(side, -1))  # noqa: E731  null: the whole set is known
    both = both.withColumn("until", F.least(last("of_x", "n"), last("of_p", "m")))  # least() passes over nulls
    known = lambda side: F.size(F.filter(side, lambda k: F.coalesce(k <= F.col("until"), F.lit(True))))
    most = F.size(F.array_intersect("of_x", "of_p")) + F.least(F.col("n") - known("of_x"), F.col("m") - known("of_p"))
    return both.filter(most * 100 >= (F.col("n") + F.col("m") - most) * least).select(*pairs.columns)


def _measured(pairs: DataFrame, grams: DataFrame) -> DataFrame:
    """Adds the size of the common part of the sets of x and p."""
    of = lambda side: grams.select(F.col("node").alias(side), F.col("grams").alias(f"of_{side}"))
    both = pairs.join(of("x").hint("merge"), "x").join(of("p").hint("merge"), "p")
    return both.select(*pairs.columns, F.size(F.array_intersect("of_x", "of_p")).cast("long").alias("common"))


def _grouped(members: DataFrame, groups: DataFrame | None) -> DataFrame:
    """Adds the group of each node: the least node it is linked to so far."""
    if groups is None:
        return members.withColumn("group", F.col("node"))
    named = groups.select(F.col("node").alias("same"), F.col("component").alias("to"))
    return members.join(named, F.col("node") == F.col("same"), "left").withColumn("group", F.coalesce("to", "node")).drop("same", "to")


def _regrouped(groups: DataFrame | None, moved: DataFrame) -> DataFrame:
    """The groups of all nodes linked so far, after some groups became one: ``moved`` names the new group of each old one."""
    if groups is None:
        return moved
    to = moved.select(F.col("node").alias("same"), F.col("component").alias("to")).hint("merge")
    old = groups.join(to, F.col("component") == F.col("same"), "left").select("node", F.coalesce("to", "component").alias("component"))
    return old.unionByName(moved.join(groups.select("node").hint("merge"), "node", "left_anti"))


def _several(members: DataFrame, of: str) -> DataFrame:
    """Regions whose members differ in ``of``."""
    return members.groupBy("region").agg(F.min(of).alias("a"), F.max(of).alias("b")).filter("a <> b").select("region")


def _pivots(members: DataFrame, count: int, turn: int) -> DataFrame:
    """``count`` members of each region, by a hash that is the same in all regions, so that pairs repeat and are measured once.

    The first rounds draw from all members: what is left of a region is mostly one large group and single documents, which link to one
    of many. Later rounds take small groups first (``size`` is how many members of the region are in the member's group).
    """
    draw = F.xxhash64(F.lit(turn), F.col("node"))
    row = F.struct("node", "n", "most", "group", *([] if turn == 0 else ["parity"]))
    if count == 1:
        first = members.groupBy("region").agg(F.min_by(row, draw).alias("s"))
    else:
        order = ["size", draw, "node"] if turn >= SMALL_FIRST else [draw, "node"]
        place = F.row_number().over(Window.partitionBy("region").orderBy(*order))
        # limited per task before the shuffle
        first = members.withColumn("place", place).filter(F.col("place") <= count).select("region", row.alias("s"))
    return first.select("region", F.col("s.node").alias("p"), F.col("s.n").alias("m"), F.col("s.most").alias("p_most"), F.col("s.group").alias("of"), *([] if turn == 0 else [F.col("s.parity").alias("p_parity")]))


def linked_groups(regions: DataFrame, keys: DataFrame, sets_of, percent: int) -> tuple[DataFrame | None, list[str]]:
    """(node, component) of linked nodes, for the members (region, node, n, most) of first regions; ``most`` is how many n-grams
    of the node can be common with one whose first n-grams end no earlier.

    ``keys`` holds the first n-grams and sketches (node, keys, parity), ``sets_of`` gives the whole sets of nodes.
    """
    # What is joined is written first: Spark splits a hot key only where both sides come straight from a shuffle.
    folders: list[str] = []
    groups: DataFrame | None = None
    passing: list[str] = []  # folders of a round that the next one does not read

    def keep(df: DataFrame, label: str) -> DataFrame:
        done, folder = written(df, label)
        (folders if label in ("measured", "grams", "groups", "regions") else passing).append(folder)
        return done

    members = keep(regions, "regions")
    if members.isEmpty():
        return None, folders
    grams: DataFrame | None = None
    members = members.select("*", F.col("node").alias("group"), F.lit(1).cast("long").alias("size"))
    count, turn = FIRST_PIVOTS, 0
    while True:
        pivots = keep(_pivots(members, count, turn), "pivots")
        # Only the first round needs distances beyond the threshold, for its cells.
        least = 2 * percent - 100 if turn == 0 else percent
        met = members.join(pivots, "region").filter((F.col("group") != F.col("of")) & _reach(least) & (F.lit(True) if turn == 0 else _alike(least)))
        near = met.select("region", F.col("node").alias("x"), "p", "n", "m", "most", "group", "of")
        near = keep(near, "met") if turn == 0 else near
        pairs = keep(_possible(keep(near.select("x", "p", "n", "m", "group", "of").distinct(), "distinct"), keys, least, keep), "pairs")
        wanted = pairs.select(F.col("x").alias("node")).unionByName(pairs.select(F.col("p").alias("node"))).distinct()
        if grams is not None:
            wanted = wanted.join(grams.select("node"), "node", "left_anti")
        wanted = keep(wanted, "wanted")
        if grams is None or not wanted.isEmpty():
            found = keep(sets_of(wanted).join(wanted.hint("merge"), "node", "left_semi"), "grams")
            grams = found if grams is None else grams.unionByName(found)
        union = F.col("n") + F.col("m") - F.col("common")
        within = keep(
            _measured(pairs, grams).filter(F.col("common") * 100 >= union * least).select(
                "x", "p", "group", "of", ((union - F.col("common")) / union).alias("apart"), (F.col("common") * 100 >= union * percent).alias("linked")
            ), "measured",
        )
        # Links of this round join groups of the last one: only those enter, however many documents they hold.
        new = within.filter("linked").select(F.col("group").alias("src"), F.col("of").alias("dst"))
        if not new.isEmpty():
            groups = keep(_regrouped(groups, keep(components(new), "moved")), "groups")
        left = pivots.select("region", F.col("p").alias("node"))
        if turn == 0:
            after = _cells(members, pivots, near, within, keep)
        else:
            after = members.join(left, ["region", "node"], "left_anti")
        after = keep(_grouped(after.select("region", "node", "n", "most", "p" if turn == 0 else "parity"), groups), "after")
        open_regions = keep(_several(after, "group"), "several")
        if turn == 0:
            # Outer regions of one pivot that still hold several groups become one: copies share many first n-grams.
            left_over = after.join(open_regions, "region", "left_semi").select(F.col("p").alias("region"), "node", "n", "most", "group").distinct()
            after = keep(left_over.join(keys.select("node", "parity").hint("merge"), "node"), "merged")
            open_regions = keep(_several(after, "group"), "several")
        live = after.join(open_regions, "region", "left_semi").select("region", "node", "n", "most", "group", "parity")
        sizes = keep(live.groupBy("region", "group").agg(F.count("*").alias("size")), "sizes")
        members = keep(live.join(sizes.hint("merge"), ["region", "group"]), "regions")
        discard(members.sparkSession, *passing)
        passing.clear()
        if members.isEmpty():
            return groups, folders
        count, turn = count * GROWTH, turn + 1


def _cells(members: DataFrame, pivots: DataFrame, near: DataFrame, within: DataFrame, keep) -> DataFrame:
    """The cells of the pivots, with the boundary documents that their documents may be linked to, and the outer regions; p names the region
    into which those with several groups are merged.

    A pivot was compared with all members and leaves; so does a document linked to it, as its cell holds all that it can be linked to.
    """
    placed = near.select("region", "x", "p", "n", "most").join(within, ["x", "p"])
    cells = placed.groupBy("p", "x").agg(*[F.first(c).alias(c) for c in ("n", "most", "linked")])
    cells = keep(cells, "cells")
    homes = keep(cells.filter("linked").select("p").distinct(), "homes")
    inner = cells.join(homes, "p", "left_semi").select(F.xxhash64("p", F.lit("cell")).alias("region"), F.col("x").alias("node"), "n", "most")
    gone = placed.filter("linked").select("region", F.col("x").alias("node")).unionByName(pivots.select("region", F.col("p").alias("node")))
    outer = members.join(keep(gone, "gone"), ["region", "node"], "left_anti").join(
        pivots.select("region", F.xxhash64("p", F.lit("outer")).alias("p")), "region"
    )
    return inner.withColumn("p", F.col("region")).unionByName(outer.select("region", "node", "n", "most", "p"))


def jaccard_groups(
    df: DataFrame, id_column: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT,
) -> DataFrame:
    """(id, n_shingles, component_id) for every row of ``df``.

    Texts are lower-cased (A-Z) and cut into words at U+0020 and U+0009 to U+000D; a set holds the distinct runs of ``words`` words,
    with fewer words the whole sequence as one. Sets link if 100 * common >= percent * union, and component_id is the least id
    reachable by links. Null and empty texts, or texts without words, have no n-grams, are linked with nothing and get their own id.
    Rows with equal sets are one node, whose id is their least; rows that repeat an id are one document. Rows with a null id
    get the component of an equal text with an id, else null. Texts of any length are read whole; an empty table gives an
    empty one; other columns of ``df`` are not read.
    """
    spark: SparkSession = df.sparkSession
    kind = df.schema[id_column].dataType.simpleString()
    source = df.select(name(id_column).alias("id"), name(text).alias("text"))
    order = spark.sparkContext.broadcast(slot_order(source.select("text"), words))
    sketch, sketch_in = written(
        source.mapInArrow(partial(_prefixes, words, percent, order), f"id {kind}, n long, digest binary, first int, keys array<long>, parity array<long>"), "sketch"
    )
    classes, classes_in = written(sketch.filter("n > 0").groupBy("digest").agg(F.min("id").alias("node")), "classes")
    nodes = sketch.filter("n > 0").join(
        classes.filter("node IS NOT NULL").select(F.col("digest").alias("d"), "node").hint("merge"),
        (F.col("digest") == F.col("d")) & (F.col("id") == F.col("node")),
    )
    firsts, firsts_in = written(nodes.select("node", "n", "first", "keys", "parity"), "firsts")
    spread = firsts.select("node", "n", "first", F.explode(F.slice("keys", 1, F.col("first"))).alias("region"))
    shared, shared_in = written(spread.groupBy("region").count().filter("count > 1").select("region"), "shared")
    # First n-grams without a region are in no document whose first n-grams end later; another may hold them beyond its first ones.
    # The window holds one document's rows.
    own = F.count("*").over(Window.partitionBy("node"))
    regions = spread.join(shared.hint("merge"), "region", "left_semi").select(
        "region", "node", "n", (F.col("n") - F.col("first") + own).alias("most")
    )
    groups, folders = linked_groups(regions, firsts.select("node", "keys", "parity"), lambda w: whole_sets(source, w, words), percent)
    classed = sketch.select("id", "n", "digest").join(classes, "digest", "left")
    if groups is None:
        found = classed.withColumn("component", F.col("node"))
    else:
        links = groups.select(F.col("node").alias("of"), "component")
        found = classed.join(links, F.col("node") == F.col("of"), "left")
    result, _ = written(
        found.select(
            F.col("id").alias(id_column), F.col("n").alias("n_shingles"),
            F.when(F.col("n") > 0, F.coalesce("component", "node")).otherwise(F.col("id")).alias("component_id"),
        ), "jaccard",
    )
    discard(spark, sketch_in, classes_in, firsts_in, shared_in, *folders)
    return result
