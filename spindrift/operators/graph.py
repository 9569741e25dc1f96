"""Lineage reach, linkage by shared attributes and connected components."""

from __future__ import annotations

import itertools
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from spindrift.session import cut_lineage


def reach(edges: DataFrame, starts: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Nodes reachable from ``starts`` (a column ``node``) with their least depth.

    Breadth-first by joins; each node is expanded once, so cycles end. Every round is
    checkpointed, which keeps the plan short and survives lost executors.
    """
    hop = cut_lineage(edges.select(F.col(src).alias("node"), F.col(dst).alias("_next")).distinct())
    seen = cut_lineage(starts.select("node").distinct().withColumn("depth", F.lit(0)))
    frontier, depth = seen, 0
    while not frontier.isEmpty():
        depth += 1
        found = frontier.select("node").join(hop, "node").select(F.col("_next").alias("node")).distinct()
        frontier = cut_lineage(found.join(seen.select("node"), "node", "left_anti").withColumn("depth", F.lit(depth)))
        seen = cut_lineage(seen.unionByName(frontier))
    return seen


def impact(edges: DataFrame, starts: DataFrame, **kw) -> DataFrame:
    """Everything downstream of the starts."""
    return reach(edges, starts, **kw)


def lineage_edges(edges: DataFrame, starts: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """The edges behind an impact, whatever they bear (columns, transformations), with ``depth``: how far from the starts each begins.

    ``starts`` holds a column ``node``. An edge belongs to the impact if its source is reached, which every edge out of a reached node is.
    """
    at = reach(edges, starts, src, dst).withColumnRenamed("node", "_node")
    return edges.join(at, F.col(src) == F.col("_node")).drop("_node")


def upstream(edges: DataFrame, ends: DataFrame, src: str = "src", dst: str = "dst", **kw) -> DataFrame:
    """Everything the ends depend on."""
    return reach(edges, ends, src=dst, dst=src, **kw)


def shared_attribute_edges(df: DataFrame, node: str, attributes: Sequence[str]) -> DataFrame:
    """Links members of each shared attribute value to the group's least member.

    A star has one edge per member where all pairs would have the square of that, and
    it connects the same nodes.
    """
    stars = None
    for a in attributes:
        members = df.filter(F.col(a).isNotNull()).select(node, F.col(a).alias("_value"))
        hubs = members.groupBy("_value").agg(F.min(node).alias("src"), F.count(F.lit(1)).alias("_size"))
        star = members.join(hubs.filter(F.col("_size") > 1), "_value").filter(F.col(node) != F.col("src")).select(
            "src", F.col(node).alias("dst"), F.lit(a).alias("link_type"), F.col("_value").cast("string").alias("shared_value")
        )
        stars = star if stars is None else stars.unionByName(star)
    return stars


def link_counts(df: DataFrame, node: str, attributes: Sequence[str]) -> DataFrame:
    """Per node: links by each attribute, their sum, and the number of distinct linked nodes.

    ``df`` holds one row per node. The neighbours sharing a set of attributes are as many
    as the group of that combination less one, so the union over attributes follows by
    inclusion and exclusion from group sizes; no pair is formed.
    """
    base = df.select(node, *attributes)
    counted = base
    terms = []
    for r in range(1, len(attributes) + 1):
        for combo in itertools.combinations(attributes, r):
            name = "_g_" + "_".join(combo)
            sizes = base.dropna(subset=list(combo)).groupBy(*combo).agg((F.count(F.lit(1)) - 1).alias(name))
            counted = counted.join(sizes, list(combo), "left").fillna(0, [name])
            terms.append((1 if r % 2 else -1, name))
    total = sum((F.col(f"_g_{a}") for a in attributes[1:]), F.col(f"_g_{attributes[0]}"))
    distinct = sum((F.lit(s) * F.col(n) for s, n in terms[1:]), F.lit(terms[0][0]) * F.col(terms[0][1]))
    return counted.select(
        node, *[F.col(f"_g_{a}").alias(f"links_{a}") for a in attributes],
        total.alias("link_count"), distinct.cast("bigint").alias("distinct_links"),
    )


def ring_tier(links: DataFrame, tiers: Mapping[int, str], column: str = "link_count") -> DataFrame:
    """Keep nodes that reach the lowest tier and name the highest one they reach."""
    ordered = sorted(tiers, reverse=True)
    label = F.lit(None).cast("string")
    for least in reversed(ordered):
        label = F.when(F.col(column) >= least, F.lit(tiers[least])).otherwise(label)
    return links.withColumn("risk_category", label).filter(F.col("risk_category").isNotNull())


#: Edges that a task of ``components`` takes at least, and the tasks that even a small graph gets.
EDGES_PER_TASK, LEAST_TASKS = 200_000, 4


def components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Connected components as (node, component), the component being its least node.

    Alternates large-star and small-star rounds (Kiveris et al., 2014): every round links
    nodes to the least neighbour known, which needs few rounds even on long chains. The
    least neighbour is an aggregate joined back, so the edges of a hub may be split over
    tasks. Each round is checkpointed; the rounds end when every node hangs on a root. The steps of a small graph run in few tasks,
    as many as its edges need, whatever the number of shuffle partitions.
    """
    linked = cut_lineage(edges.select(F.greatest(src, dst).alias("u"), F.least(src, dst).alias("v")).distinct())
    tasks = max(LEAST_TASKS, -(-linked.count() // EDGES_PER_TASK))

    def packed(df: DataFrame) -> DataFrame:
        return df.coalesce(tasks)

    nodes = packed(linked.select(F.col("u").alias("node")).union(linked.select("v"))).distinct()
    e = packed(linked.filter("u <> v"))
    while True:
        # large star: every larger neighbour moves to the least of the node and its neighbours
        both = packed(e.select(F.col("u").alias("n"), F.col("v").alias("m")).union(e.select(F.col("v"), F.col("u"))))
        least = both.groupBy("n").agg(F.min("m").alias("_m")).select("n", F.least("n", "_m").alias("least"))
        large = packed(both.filter("m > n").join(least, "n").select(F.col("m").alias("u"), F.col("least").alias("v")).filter("u <> v")).distinct()
        # small star: smaller neighbours and the node itself move to the least smaller neighbour
        large = packed(large)
        low = large.groupBy("u").agg(F.min("v").alias("least"))
        moved = large.join(low, "u").select(F.col("v").alias("u"), F.col("least").alias("v"))
        after = packed(moved.filter("u <> v").union(low.select("u", F.col("least"))))
        e = packed(cut_lineage(packed(after.distinct())))
        # done when each u has one v and no v is a u
        ends = e.select(F.col("u").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(e.select("v", F.lit(0), F.lit(1)))
        open_ends = packed(ends).groupBy("n").agg(F.sum("up").alias("up"), F.max("down").alias("down")).filter("up > 1 OR up = 1 AND down = 1")
        if open_ends.isEmpty():
            break
    labels = e.select("u", F.col("v").alias("component"))
    return nodes.join(labels, F.col("node") == F.col("u"), "left").select(
        "node", F.coalesce("component", "node").alias("component")
    )
