"""Registered queries of this subpackage: thin, each over its whole table, with DuckDB text where SQL can express the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from spindrift.llm import (
    bpe, decontamination, exact_dedup, html_extract, jaccard_join, mixing, periodic_runs, quality_classifier, quality_rules, url_filter, warc, whitening,
    word_pieces,
)
from spindrift.session import prepare
from spindrift.sources.tables import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Tables(prepare(spark), sf_dir))

        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return fn

    return register


@_query("op1_jaccard_join")
def op1(t: Tables) -> DataFrame:
    return jaccard_join.jaccard_groups(t.documents)


@_query("op2_quality_classifier")
def op2(t: Tables) -> DataFrame:
    weights = quality_classifier.train(t.documents, t.labels)
    scored = quality_classifier.score(t.documents.select("doc_id", "text"), weights, with_text=False)
    return scored.select("doc_id", quality_classifier.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@_query("op3_url_filter", url_filter.URL_SQL)
def op3(t: Tables) -> DataFrame:
    return url_filter.judge_urls(t.pages.select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict")


@_query("op4_bpe")
def op4(t: Tables) -> DataFrame:
    return bpe.encoding_digests(t.documents.select("doc_id", "text"))


@_query("op5_exact_dedup", exact_dedup.DEDUP_SQL)
def op5(t: Tables) -> DataFrame:
    return exact_dedup.exact_duplicates(t.documents, with_rows=False)


@_query("op6_token_counts")
def op6(t: Tables) -> DataFrame:
    return word_pieces.token_counts(t.documents.select("doc_id", "text"))


@_query("op7_warc", warc.WARC_SQL)
def op7(t: Tables) -> DataFrame:
    return warc.round_trip(t.pages)


@_query("op8_html_extraction")
def op8(t: Tables) -> DataFrame:
    return html_extract.main_text(t.pages).select("page_id", "url", "text", "n_chars")


@_query("op9_source_mixing", mixing.MIX_SQL)
def op9(t: Tables) -> DataFrame:
    mixed = mixing.mix(t.documents.select("doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@_query("op10_quality_rules")
def op10(t: Tables) -> DataFrame:
    judged = quality_rules.judge_lines(t.documents.select("doc_id", "text"), with_text=False)
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "reason", "lost_words"
    )


@_query("op11_whitening")
def op11(t: Tables) -> DataFrame:
    return whitening.whitened(t.embeddings)


@_query("op12_decontamination", decontamination.CONTAMINATION_SQL)
def op12(t: Tables) -> DataFrame:
    found = decontamination.contamination(t.documents, t.benchmark)
    digest = F.sha2(F.concat_ws(",", "items"), 256)
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), "contaminated")


@_query("op13_periodic_runs")
def op13(t: Tables) -> DataFrame:
    return periodic_runs.run_digests(periodic_runs.periodic_runs(t.documents, rewrite=periodic_runs.repeat_tail))
