"""Column masks."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def mask_ssn(c: str | Column) -> Column:
    """Last four characters behind ***-**-."""
    return F.concat(F.lit("***-**-"), F.right(_col(c), F.lit(4)))


def mask_phone(c: str | Column) -> Column:
    return F.concat(F.lit("***-***-"), F.right(_col(c), F.lit(4)))


def mask_email(c: str | Column) -> Column:
    """First two characters and the domain."""
    return F.concat(F.left(_col(c), F.lit(2)), F.lit("***@"), F.split_part(_col(c), F.lit("@"), F.lit(2)))


def mask_band(c: str | Column, width: int) -> Column:
    """A number as the band of ``width`` that holds it: "5000-5999"."""
    low = (F.floor(_col(c) / F.lit(width)) * F.lit(width)).cast("bigint")
    return F.concat(low.cast("string"), F.lit("-"), (low + F.lit(width - 1)).cast("string"))


def redact(_: str | Column = "") -> Column:
    return F.lit("REDACTED")
