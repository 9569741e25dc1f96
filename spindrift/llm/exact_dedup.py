"""Exact duplicates by distributed most-significant-byte-first radix partitioning.

All texts start in one group. Each round reads the next run of bytes of every text that is still in a group with others, and a group splits by
the values of that run; runs grow eightfold, so texts of n bytes take about log8(n / 64) rounds. A text alone in its group is done, as is
a group whose texts end in the run: they agreed in all bytes. Bytes are compared as grouping keys of Spark, no digest decides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from spindrift.llm.rows import discard, lower_ascii, name, written

FIRST_RUN = 64
GROWTH = 8


def exact_groups(active: DataFrame, start: int, size: int, growth: int = GROWTH) -> tuple[DataFrame, list[str]]:
    """(row, group) for the rows (row, group, bytes) that equal another row of their group from byte ``start`` on, and
    the scratch folders they lie in.

    Rows must be numbered uniquely; a new group bears the least number of its rows. Groups are counted with partial
    aggregation, and rows get their group by a shuffle join whose hot keys Spark splits, so a group of any size is spread over tasks.
    """
    found: DataFrame | None = None
    folders: list[str] = []
    while True:
        keyed = active.withColumn("run", F.substring("bytes", start, size))
        # Written first: Spark splits a hot key of a join only where both sides come straight from a shuffle.
        shared, counted = written(
            keyed.groupBy("group", "run").agg(F.count("*").alias("n"), F.min("row").alias("next")).filter("n > 1"), "counted"
        )
        split = keyed.join(shared.hint("merge"), ["group", "run"]).select(
            "row", F.col("next").alias("group"), (F.octet_length("run") < size).alias("ended"),
            F.when(F.octet_length("run") == size, F.col("bytes")).alias("bytes"),
        )
        kept, folder = written(split, "radix")
        folders += [counted, folder]
        ended = kept.filter("ended").select("row", "group")
        found = ended if found is None else found.unionByName(ended)
        active = kept.filter("NOT ended").select("row", "group", "bytes")
        if active.isEmpty():
            return found, folders
        start, size = start + size, size * growth


def exact_duplicates(df: DataFrame, id_column: str = "doc_id", text: str = "text", with_rows: bool = True) -> DataFrame:
    """``df`` with keep_id, group_size, kept and text_sha256 (of the normalised text).

    Texts are equal if identical after lower-casing A-Z; a null text counts as empty, and empty texts are equal to each other. Of equal texts the row
    with the largest id stays (a null id is less than any other; of rows that share the largest id one stays), keep_id is its id.
    Texts of any length are compared whole. An empty table gives an empty one; columns named like a new one are replaced.
    With ``with_rows`` false only the id and the new columns are returned.
    """
    new = ("keep_id", "group_size", "kept", "text_sha256")
    columns = [c for c in df.columns if c not in new] if with_rows else [id_column]
    body = F.coalesce(name(text), F.lit(""))
    # The first run is read by itself, so that texts are only carried on where it is shared. Shared runs grow with the
    # data, so they are joined by a shuffle at every size.
    first = F.substring(lower_ascii(F.substring(body, 1, FIRST_RUN)).cast("binary"), 1, FIRST_RUN)
    shared, shared_in = written(
        df.select(first.alias("_run")).groupBy("_run").count().filter("count > 1").select(
            "_run", F.monotonically_increasing_id().alias("_group")
        ), "runs",
    )
    # The columns of the input travel as one, so that none clashes with a helper's name.
    own = F.struct(*[name(c) for c in columns]).alias("_own")
    numbered = df.select(own, name(id_column).alias("_id"), body.alias("_body"), first.alias("_run"))
    bytes_of = lower_ascii(F.col("_body")).cast("binary")
    base, _ = written(
        numbered.join(shared.hint("merge"), "_run", "left").withColumn("_bytes", bytes_of).select(
            "_own", "_id", "_group", F.when(F.col("_group").isNotNull(), F.col("_bytes")).alias("_bytes"),
            F.sha2("_bytes", 256).alias("text_sha256"), F.monotonically_increasing_id().alias("_row"),
        ), "normal",
    )
    candidates = base.filter("_group IS NOT NULL").select(F.col("_row").alias("row"), F.col("_group").alias("group"), F.col("_bytes").alias("bytes"))
    # Groups of the first run are whole, also where texts end in it: comparing from byte 1 again would only repeat it.
    groups, folders = exact_groups(candidates, FIRST_RUN + 1, FIRST_RUN * GROWTH)
    named = base.select("_row", "_id").join(groups.withColumnRenamed("row", "_row"), "_row")
    best = F.max(F.struct(F.col("_id").isNotNull().alias("known"), F.col("_id").alias("id"), (-F.col("_row")).alias("row")))
    heads, heads_in = written(named.groupBy("group").agg(best.alias("best"), F.count("*").alias("group_size")), "heads")
    members, _ = written(
        named.join(heads.hint("merge"), "group").select(
            "_row", F.col("best.id").alias("keep_id"), "group_size", (F.col("_row") == -F.col("best.row")).alias("kept")
        ), "members",
    )
    discard(df.sparkSession, shared_in, heads_in, *folders)
    alone = F.col("kept").isNull()
    return base.drop("_bytes").join(members, "_row", "left").select(
        "_own.*",
        F.when(alone, F.col("_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce("kept", F.lit(True)).alias("kept"),
        "text_sha256",
    )


DEDUP_SQL = """
WITH t AS (
  SELECT doc_id, translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body FROM documents)
SELECT doc_id, MAX(doc_id) OVER (PARTITION BY body) AS keep_id, COUNT(*) OVER (PARTITION BY body) AS group_size,
  ROW_NUMBER() OVER (PARTITION BY body ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(body) AS text_sha256
FROM t
"""
