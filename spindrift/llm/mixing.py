"""Mixing sources to target weights: capped water-filling and seeded repetitions, DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from spindrift.llm.rows import WORD, name, unused
from spindrift.session import cut_lineage

MAX_EPOCHS = 3
SEED = 17
#: Seeded order values of a source fall into so many bins; only the one bin in which the fraction ends is ordered by row.
BINS = 4096
_DRAW = 1 << 32


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def cyclic_weights(sources: DataFrame, cycle: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """Adds ``weight``: the cycle's values in the order of the sources by code point, null last.

    The window holds one row per source, not per document.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    values = F.array(*[F.lit(w).cast("long") for w in cycle])
    return sources.withColumn("weight", F.get(values, (rank % len(cycle)).cast("int")))


def water_fill(sources: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Adds ``target`` to rows (source, source_size, weight): shares of the whole size by weight, none above
    ``max_epochs`` times its own size.

    Rounds: sources whose share is above their cap are clamped to it, and what is left is shared among the others by
    weight, until no share is above its cap. Each round is one aggregate over the sources; sums are whole numbers, so the
    order in which they are added does not matter. A source of size 0, or of weight 0, gets 0.
    """
    cap = F.col("source_size") * max_epochs
    state = cut_lineage(sources.withColumn("_clamped", F.col("source_size") == 0))
    total = state.agg(F.coalesce(F.sum("source_size"), F.lit(0).cast("long"))).first()[0]
    while True:
        left, weights = state.agg(
            F.lit(total) - F.coalesce(F.sum(F.when(F.col("_clamped"), cap)), F.lit(0)),
            F.coalesce(F.sum(F.when(~F.col("_clamped"), F.col("weight"))), F.lit(0)),
        ).first()
        share = F.lit(float(left)) * F.col("weight") / F.lit(float(weights)) if weights else F.lit(0.0)
        above = ~F.col("_clamped") & (share > cap)
        if not state.filter(above).limit(1).count():
            return state.withColumn("target", F.when(F.col("_clamped"), cap.cast("double")).otherwise(share)).drop("_clamped")
        state = cut_lineage(state.withColumn("_clamped", F.col("_clamped") | above))


def draw_number(key: Column, seed: int) -> Column:
    """A number below 2^32 from seed and key: the first 32 bits of an MD5 digest, so that other engines give the same."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long")


def mix(
    df: DataFrame, id_column: str = "doc_id", text: str = "text", source: str = "source",
    cycle: tuple[int, ...] = (1, 2, 3), max_epochs: int = MAX_EPOCHS, seed: int = SEED,
) -> DataFrame:
    """``df`` with size, source_size, target, repeats and taken = size * repeats.

    Size counts the words of the text. Every document of a source is taken floor(target / source_size) times; the fraction
    left is met by documents in the order of a seeded number (ties by id, nulls first): those are taken once more whose middle, in
    words summed in that order, lies within the fraction. So the words taken differ from the target by at most half a document, no
    document is taken over ``max_epochs`` times, and reruns agree.

    A null text has size 0 and is taken whole numbers of times at no words; a null source is a source of its own, ranked last; rows that
    repeat an id are drawn one by one next to each other; a source without words is taken 0 times; an empty table gives
    an empty one. Columns named like a new one are replaced.
    """
    new = {"size", "source_size", "target", "repeats", "taken"}
    # The columns of the input travel as one, so that none clashes with a helper's name.
    own = F.struct(*[name(c) for c in df.columns if c not in new], F.lit(None).cast("int").alias(unused(df, "_none")[0]))
    hidden = df.select(
        own.alias("_own"), name(source).alias("_source"),
        word_count(name(text)).alias("size"), draw_number(name(id_column), seed).alias("_draw"), name(id_column).alias("_id"),
    )
    bins = (F.col("_draw") * BINS / _DRAW).cast("int")
    per_bin = cut_lineage(
        hidden.groupBy(F.col("_source").alias("source"), bins.alias("bin")).agg(F.sum("size").alias("words"))
    )
    sources = per_bin.groupBy("source").agg(F.sum("words").alias("source_size"))
    filled = water_fill(cyclic_weights(sources, cycle), max_epochs)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    plan = filled.withColumn("whole", F.floor(ratio)).withColumn(
        "extra", F.col("target") - F.col("whole") * F.col("source_size").cast("double")
    )
    # The bin of each source in which its running sum of words passes the fraction; at most BINS rows a source.
    before = F.coalesce(
        F.sum("words").over(Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    spans = per_bin.withColumn("before", before).join(
        plan.select(F.col("source").alias("s"), "extra"), F.col("source").eqNullSafe(F.col("s"))
    )
    ends = spans.filter(F.col("before") + F.col("words") > F.col("extra")).groupBy("source").agg(
        F.min(F.struct("bin", "before")).alias("e")
    )
    plan = cut_lineage(
        plan.join(ends.select(F.col("source").alias("s"), "e"), F.col("source").eqNullSafe(F.col("s")), "left").select(
            F.col("source").alias("_of"), "source_size", "target", F.col("whole").alias("_whole"), F.col("extra").alias("_extra"),
            F.col("e.bin").alias("_end"), F.col("e.before").alias("_before"),
        )
    )
    # One row per source: Spark broadcasts it below its threshold; beyond that the join shuffles and hot sources are split.
    rows = hidden.join(plan, F.col("_source").eqNullSafe(F.col("_of"))).withColumn("_bin", bins)
    inside = (F.col("_bin") == F.col("_end")) & (F.col("_extra") > 0)
    certain = rows.filter(~F.coalesce(inside, F.lit(False))).withColumn(
        "_more", (F.col("_extra") > 0) & F.coalesce(F.col("_bin") < F.col("_end"), F.lit(True))
    )
    in_order = Window.partitionBy("_of").orderBy("_draw", F.col("_id").asc_nulls_first(), "size").rowsBetween(Window.unboundedPreceding, 0)
    middle = F.col("_before") + F.sum("size").over(in_order) - F.col("size") / 2
    border = rows.filter(inside).withColumn("_more", middle <= F.col("_extra"))
    result = certain.unionByName(border).withColumn(
        "repeats", F.col("_whole") + F.when(F.col("_more"), 1).otherwise(0)
    ).withColumn("repeats", F.when(F.col("source_size") > 0, F.col("repeats")).otherwise(F.lit(0)).cast("long"))
    kept = [F.col("_own").getField(c).alias(c) for c in df.columns if c not in new]
    return result.select(*kept, "size", "source_size", "target", "repeats", (F.col("size") * F.col("repeats")).alias("taken"))


def repeated(mixed: DataFrame) -> DataFrame:
    """One row per repetition of a document; those taken 0 times go."""
    turns = F.explode(F.array_repeat(F.lit(1), F.col("repeats").cast("int")))
    turn, = unused(mixed, "_turn")
    return mixed.filter(F.col("repeats") > 0).withColumn(turn, turns).drop(turn)


#: DuckDB text of the registered query; the water level is found on prefix sums of the sources ordered by cap over weight.
MIX_SQL = f"""
WITH d AS (
  SELECT doc_id, source, CAST(COALESCE(len(regexp_extract_all(text, '{WORD}')), 0) AS BIGINT) AS size,
    CAST('0x' || substr(md5('{SEED}:' || COALESCE(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS draw
  FROM documents),
s AS (
  SELECT source, CAST(SUM(size) AS BIGINT) AS source_size,
    CAST((ROW_NUMBER() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1 AS BIGINT) AS weight
  FROM d GROUP BY source),
o AS (
  SELECT *, {MAX_EPOCHS} * source_size AS cap,
    COALESCE(SUM({MAX_EPOCHS} * source_size) OVER w, 0) AS caps_before,
    COALESCE(SUM(weight) OVER w, 0) AS weights_before,
    SUM(source_size) OVER () AS total, SUM(CASE WHEN source_size > 0 THEN weight ELSE 0 END) OVER () AS weights
  FROM s WHERE source_size > 0
  WINDOW w AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (
  SELECT CAST(total - caps_before AS DOUBLE) AS remaining, CAST(weights - weights_before AS DOUBLE) AS sharing,
    source_size / weight AS ratio
  FROM o WHERE CAST(total - caps_before AS DOUBLE) * weight / CAST(weights - weights_before AS DOUBLE) <= cap
  ORDER BY source_size / weight, source NULLS LAST LIMIT 1),
t AS (
  SELECT s.source, s.source_size, CASE WHEN s.source_size = 0 THEN 0.0
    ELSE LEAST(CAST({MAX_EPOCHS} * s.source_size AS DOUBLE), level.remaining * s.weight / level.sharing) END AS target
  FROM s LEFT JOIN level ON TRUE),
p AS (
  SELECT source, source_size, target, CASE WHEN source_size > 0 THEN FLOOR(target / source_size) ELSE 0 END AS whole FROM t),
r AS (
  SELECT d.doc_id, d.size, p.source_size, p.target, p.whole, p.target - p.whole * CAST(p.source_size AS DOUBLE) AS extra,
    SUM(d.size) OVER (PARTITION BY d.source ORDER BY d.draw, d.doc_id NULLS FIRST, d.size ROWS UNBOUNDED PRECEDING) - d.size / 2 AS middle
  FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target,
  CAST(CASE WHEN source_size > 0 THEN size * (whole + CASE WHEN extra > 0 AND middle <= extra THEN 1 ELSE 0 END) ELSE 0 END AS BIGINT) AS taken
FROM r
"""
