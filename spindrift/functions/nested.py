"""Arrays, structs, hashes and provenance columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T


def array_mean(values: Column) -> Column:
    total = F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)
    return total / F.nullif(F.size(values).cast("double"), F.lit(0.0))


def array_zscore(values: Column) -> Column:
    """Population z-score of each element; NULL elements where the deviation is zero. No explode."""
    mean = array_mean(values)
    squares = F.aggregate(values, F.lit(0.0), lambda acc, x: acc + (x - mean) * (x - mean))
    sd = F.sqrt(squares / F.nullif(F.size(values).cast("double"), F.lit(0.0)))
    return F.transform(values, lambda x: (x - mean) / F.nullif(sd, F.lit(0.0)))


def flatten_struct(df: DataFrame, sep: str = "_") -> DataFrame:
    """Every leaf of every struct as a column named by its path."""

    def leaves(schema: T.StructType, path: tuple[str, ...]) -> list[Column]:
        out = []
        for f in schema.fields:
            here = (*path, f.name)
            if isinstance(f.dataType, T.StructType):
                out += leaves(f.dataType, here)
            else:
                out.append(F.col(".".join(f"`{p}`" for p in here)).alias(sep.join(here)))
        return out

    return df.select(*leaves(df.schema, ()))


def row_hash(cols: Sequence[str]) -> Column:
    """SHA-256 of the columns as JSON text; NULL and empty text differ."""
    return F.sha2(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}), 256)


def with_ingest_metadata(df: DataFrame, source: str, batch_id: str, ts: str) -> DataFrame:
    """Source, batch and ingest time columns; the time is given, not read from the clock. Works on streams."""
    return df.withColumns({
        "_source": F.lit(source),
        "_batch_id": F.lit(batch_id),
        "_ingested_at": F.lit(ts).cast("timestamp_ntz"),
    })


def dense_ids(df: DataFrame, order: Sequence[str], name: str = "id", hot_rows: int | None = None) -> DataFrame:
    """Consecutive ids 1..n in the given total order. More than ``hot_rows`` rows are cut into ranges, so that no task sorts everything."""
    from spindrift.operators.windows import chunked_window

    return chunked_window(df, [], order, hot_rows=hot_rows, row_number=name)
