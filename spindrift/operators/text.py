"""Keyword classification, entity extraction, redaction, chunking and batch inference."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

# fixed values: the ordered keyword rules and the patterns
TICKET_RULES = (
    ("Billing", ("billing", "charge", "refund", "invoice", "payment")),
    ("Account Access", ("login", "password", "account", "cannot log")),
    ("Technical Issue", ("error", "bug", "fail", "down", "503", "500", "broken")),
    ("Security", ("security", "vulnerability", "patch", "breach")),
    ("Feature Request", ("feature", "request", "add", "enhancement")),
    ("Positive Feedback", ("thank", "great", "amazing", "love")),
)
DEFAULT_LABEL = "General Inquiry"

EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
AMOUNT = r"\$[0-9]+(?:,[0-9]{3})*(?:\.[0-9]{2})?"
ISO_DATE = r"[0-9]{4}-[0-9]{2}-[0-9]{2}"
VERSION = r"v[0-9]+\.[0-9]+(?:\.[0-9]+)?"
PHONE = r"\+?[0-9]{1,3}[ -]?\(?[0-9]{3}\)?[ -][0-9]{3}[ -][0-9]{4}"
SSN = r"[0-9]{3}-[0-9]{2}-[0-9]{4}"


def classify(text: str | Column, rules: Sequence[tuple[str, Sequence[str]]] = TICKET_RULES,
             default: str = DEFAULT_LABEL) -> Column:
    """First label one of whose keywords occurs in the lower-cased text."""
    t = F.lower(F.col(text) if isinstance(text, str) else text)
    label = F.lit(default)
    for name, words in reversed(list(rules)):
        hit = F.lit(False)
        for w in words:
            hit = hit | t.contains(w)
        label = F.when(hit, F.lit(name)).otherwise(label)
    return F.when(t.isNotNull(), label)


def entities(text: str | Column, pattern: str) -> Column:
    """All matches of a pattern, in order."""
    return F.regexp_extract_all(F.col(text) if isinstance(text, str) else text, F.lit(pattern), F.lit(0))


def extract_entities(df: DataFrame, col: str) -> DataFrame:
    """Adds arrays of e-mails, amounts, dates and versions."""
    return df.withColumns({
        "emails": entities(col, EMAIL), "amounts": entities(col, AMOUNT),
        "dates": entities(col, ISO_DATE), "versions": entities(col, VERSION),
    })


def redact_text(text: str | Column) -> Column:
    """Replaces e-mails, social security and phone numbers by tags."""
    t = F.col(text) if isinstance(text, str) else text
    t = F.regexp_replace(t, EMAIL, "[EMAIL]")
    t = F.regexp_replace(t, SSN, "[SSN]")
    return F.regexp_replace(t, PHONE, "[PHONE]")


def words(text: str | Column) -> Column:
    """Words of a text, split at runs of whitespace."""
    t = F.col(text) if isinstance(text, str) else text
    return F.array_remove(F.split(t, r"\s+"), "")


def chunk_text(df: DataFrame, id_col: str, col: str, size: int, overlap: int) -> DataFrame:
    """Pieces of ``size`` words, each starting ``size - overlap`` words after the last; whole texts."""
    if not 0 <= overlap < size:
        raise ValueError("overlap must be smaller than size")
    step = size - overlap
    split = df.select(id_col, words(col).alias("_w")).withColumn("_n", F.size("_w"))
    # the last piece starts before the words not yet covered run out
    last = F.greatest(F.ceil((F.col("_n") - F.lit(overlap)) / F.lit(step)) - 1, F.lit(0)).cast("int")
    # cut inside the row: exploding first would copy the whole word list once per piece
    pieces = F.transform(F.sequence(F.lit(0), last), lambda i: F.slice("_w", i * F.lit(step) + F.lit(1), F.lit(size)))
    out = split.filter("_n > 0").select(id_col, F.posexplode(pieces).alias("chunk_no", "_piece"))
    return out.select(id_col, "chunk_no", F.size("_piece").alias("n_words"), F.array_join("_piece", " ").alias("chunk"))


def infer(df: DataFrame, cols: Sequence[str], load_model: Callable[[], Callable[[pd.DataFrame], pd.DataFrame]],
          schema: str) -> DataFrame:
    """Run a model over Arrow batches. ``load_model`` is called once per task and returns the batch function."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = None
        for batch in batches:
            model = model or load_model()
            yield model(batch)

    return df.select(*cols).mapInPandas(run, schema)
