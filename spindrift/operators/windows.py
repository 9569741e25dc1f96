"""Window functions that split a hot key over many tasks.

A plain window sends every row of a key to one task. Here the rows of small keys
stay with it, and each larger key is cut into chunks that rise with the order of the window:
ranges whose bounds are sampled from the rows, or a given value (a day).
A small summary per (key, chunk) is combined up and down a tree, and what each chunk
must know of the others travels as one carry row placed in front of (or behind)
its rows.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from spindrift.functions.numeric import dec
from spindrift.session import cut_lineage, written

_ROW, _BEFORE, _AFTER = 1, 0, 2
_MAPS, _NAMES = ("lag", "lead", "running", "latest", "before"), ("row_number", "rank", "dense_rank", "percent_rank", "total")
HOT_ROWS = 1_000_000  # rows of one key that a task may sort
MAX_RANGES = 20_000  # ranges that one sampling serves; with more rows they grow
FAN_OUT = 512  # chunks of a key combined in one task


def time_chunk(ts: str | Column, seconds: int) -> Column:
    """Number of the interval of ``seconds`` that holds a time (epoch seconds or timestamp)."""
    return F.floor(_seconds(ts) / F.lit(seconds)).cast("long")


def _seconds(ts: str | Column) -> Column:
    return F.unix_seconds((F.col(ts) if isinstance(ts, str) else ts).cast("timestamp"))


def key_match(left: Sequence[str], right: Sequence[str]) -> Column:
    """Equality of key columns that also matches NULL with NULL; true without keys."""
    match = F.lit(True)
    for i, (a, b) in enumerate(zip(left, right)):
        one = F.col(a).eqNullSafe(F.col(b))
        match = one if i == 0 else match & one
    return match


def split_hot(df: DataFrame, keys: Sequence[str], order: Sequence[str], hot_rows: int = HOT_ROWS, rows_per_range: int | None = None,
              chunk: Column | None = None, sizes: DataFrame | None = None) -> tuple[DataFrame, DataFrame | None]:
    """The rows of keys that fit a task, and those of larger ones with ``_chunk``, the number of their range.

    Ranges are contiguous in the compound order of ``keys`` and ``order``. Spark samples their bounds from the rows themselves, so
    they hold about ``rows_per_range`` each however the values are spread; only rows equal in all of these columns stay together. There are
    at most ``MAX_RANGES``, beyond which ranges grow. The rows are written by range to the shared scratch folder, so that a range's number never
    changes. With ``chunk`` the larger keys are cut by that column instead. Keys are counted first, in a job of its own; without large keys there is no second part.
    ``sizes`` are rows to count instead, where ``df`` is dear to compute: what it was made from, with at least as many rows of each key.
    """
    keys = list(keys)
    counts = (df if sizes is None else sizes).groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > hot_rows)
    hot = cut_lineage(counts)
    found = hot.agg(F.count(F.lit(1)).alias("keys"), F.sum("_rows").alias("rows")).first()
    if not found["keys"]:
        return df, None
    side = hot.select(*[F.col(k).alias(f"_h_{k}") for k in keys])
    if found["keys"] <= MAX_RANGES:
        side = F.broadcast(side)
    names = [f"_h_{k}" for k in keys]
    large = df.join(side, key_match(keys, names), "left_semi") if keys else df
    small = df.join(side, key_match(keys, names), "left_anti") if keys else df.filter("false")
    if chunk is not None:
        return small, large.withColumn("_chunk", chunk)
    ranges = min(MAX_RANGES, max(2, -(-found["rows"] // (rows_per_range or hot_rows))))
    numbered = large.repartitionByRange(ranges, *keys, *order).withColumn("_chunk", F.spark_partition_id().cast("long"))
    return small, written(numbered, "ranges")


def _plain(df: DataFrame, keys: Sequence[str], order: Sequence[str], spec: Mapping) -> DataFrame:
    """The window columns by Spark's own windows: a key per task."""
    whole = Window.partitionBy(*keys).orderBy(*order)
    so_far = whole.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out: dict[str, Column] = {o: F.lag(c).over(whole) for o, c in spec["lag"].items()}
    out |= {o: F.lead(c).over(whole) for o, c in spec["lead"].items()}
    out |= {o: F.sum(c).over(so_far) for o, c in spec["running"].items()}
    out |= {o: F.last(c, ignorenulls=True).over(so_far) for o, c in spec["latest"].items()}
    out |= {o: F.last(c, ignorenulls=True).over(whole.rowsBetween(Window.unboundedPreceding, -1)) for o, c in spec["before"].items()}
    ranks = {"row_number": F.row_number, "rank": F.rank, "dense_rank": F.dense_rank}
    out |= {spec[k]: fn().over(whole).cast("long") for k, fn in ranks.items() if spec[k]}
    if spec["percent_rank"]:
        out[spec["percent_rank"]] = F.percent_rank().over(whole)
    if spec["total"]:
        out[spec["total"]] = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    return df.select("*", *[c.alias(o) for o, c in out.items()])


def carry(summary: DataFrame, keys: Sequence[str], sums: Sequence[str] = (), lasts: Sequence[str] = (), firsts: Sequence[str] = (),
          levels: int = 2) -> DataFrame:
    """What each chunk of a key must know of its other chunks, as (keys, ``_chunk``, the same columns).

    ``sums`` become sums over the chunks before, ``lasts`` the nearest value before that is not NULL, ``firsts`` the nearest one after. These combine
    associatively, so chunks are first combined in blocks of ``FAN_OUT``, the blocks are carried the same way, and each
    chunk adds what its block knows to what it finds within it. A task thus sees ``FAN_OUT`` rows of a key below the top, and at the top one for each
    FAN_OUT ^ levels chunk numbers.
    """
    keys = list(keys)
    up = Window.partitionBy(*keys, *(["_block"] if levels else [])).orderBy("_chunk")
    down = Window.partitionBy(*keys, *(["_block"] if levels else [])).orderBy(F.desc("_chunk"))
    earlier, later = (w.rowsBetween(Window.unboundedPreceding, -1) for w in (up, down))
    inner = [F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(c) for c in sums]
    inner += [F.last(c, ignorenulls=True).over(earlier).alias(c) for c in lasts] + [F.last(c, ignorenulls=True).over(later).alias(c) for c in firsts]
    if not levels:
        return summary.select(*keys, "_chunk", *inner)
    blocked = summary.withColumn("_block", F.floor(F.col("_chunk") / F.lit(FAN_OUT)).cast("long"))
    at = lambda c: F.when(F.col(c).isNotNull(), F.col("_chunk"))
    blocks = blocked.groupBy(*keys, "_block").agg(
        F.count(F.lit(1)).alias("_chunks"), *[F.sum(c).alias(c) for c in sums], *[F.max_by(c, at(c)).alias(c) for c in lasts],
        *[F.min_by(c, at(c)).alias(c) for c in firsts],
    )
    above = carry(blocks.withColumnRenamed("_block", "_chunk"), keys, sums, lasts, firsts, levels - 1)
    above = above.select(*[F.col(k).alias(f"_a_{k}") for k in keys], F.col("_chunk").alias("_a_block"), *[F.col(c).alias(f"_a{c}") for c in (*sums, *lasts, *firsts)])
    within = blocked.select(*keys, "_chunk", "_block", *inner)
    joined = within.join(above, key_match([*keys, "_block"], [*[f"_a_{k}" for k in keys], "_a_block"]), "left")
    return joined.select(
        *keys, "_chunk", *[(F.col(c) + F.col(f"_a{c}")).alias(c) for c in sums],
        *[F.coalesce(F.col(c), F.col(f"_a{c}")).alias(c) for c in (*lasts, *firsts)],
    )


def _carried(rows: DataFrame, keys: Sequence[str], order: Sequence[str], spec: Mapping) -> DataFrame:
    """The window columns of rows cut by ``_chunk``; the column stays."""
    lag, lead, running, latest, before = (spec[k] for k in ("lag", "lead", "running", "latest", "before"))
    position = F.struct(*order)
    parts = [F.count(F.lit(1)).alias("_n")]
    if lag:
        parts.append(F.max_by(F.struct(*[F.col(c).alias(o) for o, c in lag.items()]), position).alias("_last"))
    if lead:
        parts.append(F.min_by(F.struct(*[F.col(c).alias(o) for o, c in lead.items()]), position).alias("_first"))
    if spec["dense_rank"]:
        parts.append(F.count_distinct(position).alias("_distinct"))
    parts += [F.sum(c).alias(f"_sum_{o}") for o, c in running.items()]
    held = {**latest, **before}
    parts += [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), position)).alias(f"_held_{o}") for o, c in held.items()]
    summary = rows.groupBy(*keys, "_chunk").agg(*parts)
    sums = ["_n", *(["_distinct"] if spec["dense_rank"] else []), *[f"_sum_{o}" for o in running]]
    known = carry(summary, keys, sums, [*(["_last"] if lag else []), *[f"_held_{o}" for o in held]], ["_first"] if lead else [])
    if spec["percent_rank"] or spec["total"]:
        known = _join_null_safe(known, summary.groupBy(*keys).agg(F.sum("_n").alias("_n_all")), keys, ["_n_all"])
    else:
        known = known.withColumn("_n_all", F.lit(None).cast("long"))

    marked = rows.select(
        "*",
        F.lit(_ROW).alias("_kind"),
        *[F.col(c).alias(f"_in_{o}") for o, c in {**lag, **lead, **running, **held}.items()],
    )
    front = known.select(
        *keys, "_chunk", F.col("_n").alias("_n_before"), "_n_all",
        *([F.col("_distinct").alias("_d_before")] if spec["dense_rank"] else []),
        F.lit(_BEFORE).alias("_kind"),
        *[F.col(f"_last.{o}").alias(f"_in_{o}") for o in lag],
        *[F.col(f"_sum_{o}").alias(f"_in_{o}") for o in running],
        *[F.col(f"_held_{o}").alias(f"_in_{o}") for o in held],
    )
    stacked = marked.unionByName(front, allowMissingColumns=True)
    if lead:
        behind = known.select(
            *keys, "_chunk", F.lit(_AFTER).alias("_kind"),
            *[F.col(f"_first.{o}").alias(f"_in_{o}") for o in lead],
        )
        stacked = stacked.unionByName(behind, allowMissingColumns=True)

    whole = Window.partitionBy(*keys, "_chunk").orderBy("_kind", *order)
    so_far = whole.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    n_before = F.max("_n_before").over(so_far)
    # the carry row is row 1 of its chunk, so positions within a chunk start at 2
    rank_value = n_before + F.rank().over(whole) - F.lit(1)
    out: dict[str, Column] = {o: F.lag(f"_in_{o}").over(whole) for o in lag}
    out |= {o: F.lead(f"_in_{o}").over(whole) for o in lead}
    out |= {o: F.sum(f"_in_{o}").over(so_far) for o in running}
    out |= {o: F.last(f"_in_{o}", ignorenulls=True).over(so_far) for o in latest}
    out |= {o: F.last(f"_in_{o}", ignorenulls=True).over(whole.rowsBetween(Window.unboundedPreceding, -1)) for o in before}
    if spec["row_number"]:
        out[spec["row_number"]] = n_before + F.row_number().over(whole) - F.lit(1)
    if spec["rank"]:
        out[spec["rank"]] = rank_value
    if spec["dense_rank"]:
        out[spec["dense_rank"]] = F.max("_d_before").over(so_far) + F.dense_rank().over(whole) - F.lit(1)
    n_all = F.max("_n_all").over(so_far)
    if spec["percent_rank"]:
        out[spec["percent_rank"]] = F.when(
            n_all > 1, (rank_value - F.lit(1)).cast("double") / (n_all - F.lit(1)).cast("double")
        ).otherwise(F.lit(0.0))
    if spec["total"]:
        out[spec["total"]] = n_all
    windowed = stacked.select("*", *[c.alias(o) for o, c in out.items()])
    return windowed.filter(F.col("_kind") == _ROW).select(*rows.columns, *out)


def by_parts(df: DataFrame, keys: Sequence[str], order: Sequence[str], work: Callable[[DataFrame, Callable], DataFrame], *, chunk: Column | None = None,
             hot_rows: int | None = HOT_ROWS, rows_per_range: int | None = None, sizes: DataFrame | None = None) -> DataFrame:
    """``work(part, window)`` over the rows of small keys and of large ones, put together.

    ``window(part, lag=..., ...)`` adds window columns over ``keys`` in ``order`` (see ``chunked_window``) and may be called several times: rows are cut once, and
    the plain windows of small keys share one shuffle.
    """
    keys, order = list(keys), list(order)

    def windows(how: Callable) -> Callable:
        def window(part: DataFrame, **options) -> DataFrame:
            unknown = set(options) - {*_MAPS, *_NAMES}
            if unknown:
                raise TypeError(f"no window columns {sorted(unknown)}")
            return how(part, keys, order, {k: dict(options.get(k) or {}) for k in _MAPS} | {k: options.get(k) for k in _NAMES})
        return window

    if hot_rows is None:
        return work(df.withColumn("_chunk", chunk), windows(_carried)).drop("_chunk")
    small, large = split_hot(df, keys, order, hot_rows, rows_per_range, chunk, sizes)
    done = work(small, windows(_plain))
    return done if large is None else done.unionByName(work(large, windows(_carried)).drop("_chunk"))


def chunked_window(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    chunk: Column | None = None,
    *,
    hot_rows: int | None = None,
    rows_per_range: int | None = None,
    sizes: DataFrame | None = None,
    **columns,
) -> DataFrame:
    """Add window columns over ``keys`` ordered by ``order`` (ascending, not NULL).

    ``lag``, ``lead``, ``running``, ``latest`` and ``before`` map an output name to its input column. ``running`` sums from the first row, so give
    it decimals or integers; ``latest`` is the nearest value that is not NULL up to the row, ``before`` the one strictly before
    it. ``row_number``, ``rank``, ``dense_rank``, ``percent_rank`` and ``total`` name an output column.

    ``chunk``, a whole number or a date that never falls when ``order`` rises, cuts every key, or with ``hot_rows`` only keys above that many rows. Without it
    keys above ``hot_rows`` (``HOT_ROWS`` unless given) are cut into sampled ranges of ``rows_per_range`` rows, see ``split_hot``, also for ``sizes``.
    """
    if chunk is None:
        hot_rows = HOT_ROWS if hot_rows is None else hot_rows
    else:
        chunk = F.when(chunk.isNotNull(), F.datediff(chunk, F.lit("1970-01-01").cast("date"))).cast("long") if _is_date(df, chunk) else chunk.cast("long")
    return by_parts(df, keys, order, lambda part, window: window(part, **columns), chunk=chunk, hot_rows=hot_rows, rows_per_range=rows_per_range, sizes=sizes)


def _is_date(df: DataFrame, column: Column) -> bool:
    return df.select(column.alias("c")).schema["c"].dataType.typeName() == "date"


def value_ranks(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    chunk: Column | None = None,
    *,
    hot_rows: int | None = None,
    rank: str | None = None,
    dense_rank: str | None = None,
    percent_rank: str | None = None,
) -> DataFrame:
    """Ranks by value: equal values share a rank, so distinct values are ranked and joined back.

    A value held by many rows is one row in the window, however large its group is. Keys with many distinct values are cut as in
    ``chunked_window``; ``chunk`` is taken over the columns of ``order``.
    """
    keys, order = list(keys), list(order)
    on = [*keys, *order]
    counted = df.groupBy(*on).agg(F.count(F.lit(1)).alias("_copies"))
    summed = chunked_window(counted, keys, order, chunk, hot_rows=hot_rows, sizes=df, running={"_upto": "_copies"}, row_number="_position")
    sizes = counted.groupBy(*keys).agg(F.sum("_copies").alias("_rows"))
    first = F.col("_upto") - F.col("_copies")
    out = {}
    if rank:
        out[rank] = first + F.lit(1)
    if dense_rank:
        out[dense_rank] = F.col("_position")
    if percent_rank:
        share = first.cast("double") / F.nullif((F.col("_rows") - F.lit(1)).cast("double"), F.lit(0.0))
        out[percent_rank] = F.coalesce(share, F.lit(0.0))
        summed = _join_null_safe(summed, sizes, keys, ["_rows"])
    ranked = summed.select(*on, *[c.alias(o) for o, c in out.items()])
    return _join_null_safe(df, ranked, on, list(out))


def _join_null_safe(left: DataFrame, right: DataFrame, on: Sequence[str], take: Sequence[str]) -> DataFrame:
    """Left rows with columns of the matching right row; NULL keys match each other."""
    side = right.select(*[F.col(k).alias(f"_r_{k}") for k in on], *take)
    return left.join(side, key_match(on, [f"_r_{k}" for k in on])).select(*left.columns, *take)


def trailing_stats(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    value: str | None,
    seconds: int,
    *,
    chunk_seconds: int | None = None,
    include_current: bool = True,
    prefix: str = "trail",
    scale: int = 2,
) -> DataFrame:
    """Count, sum, mean and sample deviation of ``value`` over the trailing ``seconds``.

    The frame is [t - seconds, t] with the current second, or [t - seconds, t - 1]
    without it, both ends included, on whole seconds. Adds ``<prefix>_n`` and, when a
    value is given, ``<prefix>_sum``, ``_avg`` and ``_stddev``.

    Rows of one key and second share their frame, so they are added up before anything
    else: the window then sees at most one row per key and second, whatever the number
    of events. Those rows are cut into chunks of ``chunk_seconds`` (which divides
    ``seconds``); a shifted copy of each meets the far end of the frame and a summary
    gives the whole chunks in between. Prefix sums in decimals replace a sliding frame,
    whose cost would grow with its length.
    """
    width = chunk_seconds or seconds
    if seconds % width:
        raise ValueError("chunk_seconds must divide seconds")
    spans = seconds // width
    keys = list(keys)
    own, far, between = 0, 1, 2
    rows = df.withColumn("_t", _seconds(ts))
    measures = {"n": F.count(F.lit(1))}
    if value:
        v = dec(value, scale)
        measures |= {"c": F.count(value), "s": F.sum(v), "q": F.sum(v * v)}
    per_second = rows.groupBy(*keys, "_t").agg(*[c.alias(f"_{m}") for m, c in measures.items()])

    copies = per_second.withColumn("_kind", F.explode(F.array(F.lit(own), F.lit(far)))).withColumn(
        "_t", F.col("_t") + F.when(F.col("_kind") == far, F.lit(seconds)).otherwise(F.lit(0))
    ).withColumn("_chunk", F.floor(F.col("_t") / F.lit(width)).cast("long"))
    if spans > 1:
        summary = per_second.groupBy(*keys, F.floor(F.col("_t") / F.lit(width)).cast("long").alias("_chunk")).agg(
            *[F.sum(f"_{m}").alias(f"_b{m}") for m in measures])
        # one row per key and chunk: bounded by the calendar
        inner = Window.partitionBy(*keys).orderBy("_chunk").rangeBetween(-(spans - 1), -1)
        middle = summary.select(
            *keys, "_chunk", (F.col("_chunk") * F.lit(width)).alias("_t"), F.lit(between).alias("_kind"),
            *[F.sum(f"_b{m}").over(inner).alias(f"_m{m}") for m in measures],
        )
        copies = copies.unionByName(middle, allowMissingColumns=True)

    by_time = Window.partitionBy(*keys, "_chunk").orderBy("_t")
    upto = by_time.rangeBetween(Window.unboundedPreceding, 0 if include_current else -1)
    strictly = by_time.rangeBetween(Window.unboundedPreceding, -1)
    everything = by_time.rangeBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    def frame_total(m: str) -> Column:
        mine = F.sum(F.when(F.col("_kind") == own, F.col(f"_{m}"))).over(upto)
        tail = F.when(F.col("_kind") == far, F.col(f"_{m}"))
        pieces = [F.sum(tail).over(everything), -F.sum(tail).over(strictly)]
        if spans > 1:
            pieces.append(F.max(f"_m{m}").over(everything))
        acc = F.coalesce(mine, F.lit(0))
        for p in pieces:
            acc = acc + F.coalesce(p, F.lit(0))
        return acc

    framed = copies.select(*keys, "_t", "_kind", *[frame_total(m).alias(f"_f{m}") for m in measures]).filter(
        F.col("_kind") == own)
    out = {f"{prefix}_n": F.col("_fn")}
    if value:
        n, s = F.col("_fc").cast("double"), F.col("_fs").cast("double")
        # n*q - s*s from exact sums
        spread = (F.col("_fc").cast("decimal(16,0)") * F.col("_fq").cast("decimal(38,4)")).cast("double") - s * s
        some = F.col("_fc") > 0
        out[f"{prefix}_sum"] = F.when(some, s)
        out[f"{prefix}_avg"] = F.when(some, s / n)
        out[f"{prefix}_stddev"] = F.when(
            F.col("_fc") > 1, F.sqrt(F.greatest(spread, F.lit(0.0)) / (n * (n - 1))))
    frames = framed.select(*keys, "_t", *[c.alias(o) for o, c in out.items()])
    return _join_null_safe(rows, frames, [*keys, "_t"], list(out)).drop("_t")


def with_group_values(df: DataFrame, keys: Sequence[str], **aggregates: Column) -> DataFrame:
    """Whole-partition window values by aggregation and join.

    The aggregate is combined map-side, and the join may be split on a hot key,
    neither of which a window over the key allows.
    """
    keys = list(keys)
    values = df.groupBy(*keys).agg(*[c.alias(n) for n, c in aggregates.items()])
    renamed = values.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *aggregates)
    match = None
    for k in keys:
        one = F.col(k).eqNullSafe(F.col(f"_k_{k}"))
        match = one if match is None else match & one
    return df.join(renamed, match, "left").select(*df.columns, *aggregates)


def top_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank_col: str = "rn") -> DataFrame:
    """First ``k`` rows per key. Spark limits each map task to ``k`` rows per key before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)
