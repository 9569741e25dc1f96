"""Row filters, column masks and PII discovery."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F, types as T


@dataclass(frozen=True)
class RolePolicy:
    """What one role sees: rows (a predicate, "true" for all) and, per column, a mask."""

    rows: str = "true"
    masks: Mapping[str, Callable[[Column], Column]] = field(default_factory=dict)
    columns: Sequence[str] | None = None


Policy = Mapping[str, RolePolicy]


def row_filter(df: DataFrame, policy: Policy, role: str) -> DataFrame:
    """Rows the role may see. An unknown role sees none; a NULL predicate hides the row."""
    rows = policy[role].rows if role in policy else "false"
    return df.filter(F.coalesce(F.expr(rows), F.lit(False)))


def apply_masks(df: DataFrame, policy: Policy, role: str) -> DataFrame:
    """Columns as the role sees them. For an unknown role every column is NULL."""
    if role not in policy:
        return df.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema.fields])
    masks = policy[role].masks
    shown = policy[role].columns or df.columns
    return df.select(*[masks[c](F.col(c)).alias(c) if c in masks else F.col(c) for c in shown])


def secure_view(df: DataFrame, policy: Policy, role: str) -> DataFrame:
    """Filter on the true values, then mask: masks cannot change which rows are seen."""
    return apply_masks(row_filter(df, policy, role), policy, role)


def mapped_row_filter(df: DataFrame, mapping: DataFrame, on: str, principal: str) -> DataFrame:
    """Rows whose ``on`` value a mapping table (principal, value) grants to a principal."""
    granted = mapping.filter(F.col("principal") == principal).select(F.col("value").alias("_granted")).distinct()
    return df.join(granted, F.col(on) == F.col("_granted"), "left_semi")


def pii_scan(df: DataFrame, patterns: Mapping[str, str], names: Mapping[str, str], threshold: float = 0.0) -> DataFrame:
    """Per text column and pattern the share of matching values, in one pass; also hits by column name."""
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    pairs = [(c, p) for c in text for p in patterns]
    one = df.agg(
        *[F.count(c).alias(f"_n_{c}") for c in text],
        *[F.count(F.when(F.col(c).rlike(patterns[p]), 1)).alias(f"_m_{c}_{p}") for c, p in pairs],
    )
    lines = F.array(*[
        F.struct(
            F.lit(c).alias("column_name"), F.lit(p).alias("pattern"),
            F.col(f"_m_{c}_{p}").alias("matches"), F.col(f"_n_{c}").alias("non_null"),
            F.lit(c).rlike(names.get(p, "$^")).alias("name_hit"),
        )
        for c, p in pairs
    ])
    rate = F.col("matches").cast("double") / F.nullif(F.col("non_null"), F.lit(0)).cast("double")
    return one.select(F.explode(lines).alias("l")).select("l.*").withColumn(
        "match_rate", F.coalesce(rate, F.lit(0.0))
    ).withColumn("is_pii", F.col("name_hit") | (F.col("match_rate") > threshold))
