"""Fraud jobs over account events: velocity, amounts, jumps, travel, linkage, risk and cases."""

from __future__ import annotations

import functools
import operator
from collections import namedtuple
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from spindrift.functions.numeric import dec
from spindrift.operators.graph import link_counts, ring_tier
from spindrift.operators.joins import nearest_other_place
from spindrift.operators.merge import WhenMatched, WhenNotMatched, merge
from spindrift.operators.sets import align_union
from spindrift.operators.windows import chunked_window, trailing_stats

DAY = 86_400
# fixed values: ring sizes, score rules (what is measured, points for each, weight in the total), cap of a score, lower bounds of the tiers
RING_TIERS = {5: "HIGH_RISK_RING", 3: "MEDIUM_RISK_RING", 2: "LOW_RISK_RING"}
ScoreRule = namedtuple("ScoreRule", "name measure factor weight")
SCORES = (
    ScoreRule("velocity_score", "max_velocity", 8.0, 0.35),
    # an account without a flagged amount has ratio 0, and so a negative score
    ScoreRule("amount_score", "coalesce(max_ratio, 0D) - 1D", 15.0, 0.30),
    ScoreRule("geo_score", "if(min_travel IS NULL, 0D, 1800D / greatest(CAST(min_travel AS DOUBLE), 1D))", 50.0, 0.20),
    ScoreRule("linkage_score", "link_count", 15.0, 0.15),
)
SCORE_CAP = 100.0
TIERS = {75: "CRITICAL", 50: "HIGH", 25: "MEDIUM", 0: "LOW"}


def velocity(df: DataFrame, key: str, ts: str, seconds: int = 3600, chunk_seconds: int | None = None) -> DataFrame:
    """Events of the key in the trailing span, the current second included."""
    return trailing_stats(df, [key], ts, None, seconds, chunk_seconds=chunk_seconds, prefix="recent")


def velocity_alerts(df: DataFrame, key: str, ts: str, seconds: int = 3600, limit: int = 5,
                    chunk_seconds: int | None = None) -> DataFrame:
    return velocity(df, key, ts, seconds, chunk_seconds).filter(F.col("recent_n") > limit)


def amount_scores(df: DataFrame, key: str, ts: str, amount: str, seconds: int = 30 * DAY) -> DataFrame:
    """Ratio and z-score of each amount against its key's trailing 30 days, the current second excluded.

    Both are NULL without history (or without spread); an alert needs either above 3.
    """
    past = trailing_stats(df, [key], ts, amount, seconds, chunk_seconds=DAY, include_current=False, prefix="past")
    value = dec(amount).cast("double")
    scored = past.withColumns({
        "amount_ratio": F.when(F.col("past_avg") > 0, value / F.col("past_avg")),
        "z_score": F.when(F.col("past_stddev") > 0, (value - F.col("past_avg")) / F.col("past_stddev")),
    })
    alert = (F.col("amount_ratio") > 3.0) | (F.col("z_score") > 3.0)
    return scored.withColumn("amount_alert", F.coalesce(alert, F.lit(False)))


def jumps(df: DataFrame, key: str, ts: str, row_id: str, amount: str, factor: float = 5.0, minutes: int = 60) -> DataFrame:
    """Rows worth more than ``factor`` times the row before, less than ``minutes`` after it."""
    prev = chunked_window(df, [key], [ts, row_id], lag={"prev_amount": amount, "prev_ts": ts})
    gap = (F.unix_seconds(F.col(ts).cast("timestamp")) - F.unix_seconds(F.col("prev_ts").cast("timestamp"))) / 60.0
    jump = F.col(amount) / F.nullif(F.col("prev_amount"), F.lit(0.0))
    return prev.withColumns({"amount_jump": jump, "minutes_gap": gap.cast("double")}).filter(
        (F.col("amount_jump") > factor) & (F.col("minutes_gap") < minutes))


def travel(df: DataFrame, key: str, place: str, ts: str, row_id: str, max_seconds: int = 1800) -> DataFrame:
    return nearest_other_place(df, key, place, ts, row_id, max_seconds)


def linkage(accounts: DataFrame, account: str, attributes: Sequence[str]) -> DataFrame:
    return ring_tier(link_counts(accounts, account, attributes), RING_TIERS)


def composite_risk(events: DataFrame, accounts: DataFrame, key: str, ts: str, amount: str, place: str, row_id: str,
                   account: str, attributes: Sequence[str], velocity_seconds: int = 3600) -> DataFrame:
    """Four capped scores per active account, their weighted sum and a tier."""
    fast = velocity(events, key, ts, velocity_seconds).groupBy(key).agg(F.max("recent_n").alias("max_velocity"))
    big = amount_scores(events, key, ts, amount).filter("amount_alert").groupBy(key).agg(
        F.max(F.coalesce("amount_ratio", F.lit(1.0))).alias("max_ratio"))
    moved = travel(events, key, place, ts, row_id).groupBy(key).agg(
        F.min("travel_seconds").alias("min_travel"), F.count(F.lit(1)).alias("arrivals"))
    linked = link_counts(accounts, account, attributes).select(F.col(account).alias("_acc"), "link_count")
    scored = fast.join(big, key, "left").join(moved, key, "left").join(
        linked, F.col(key) == F.col("_acc"), "left").fillna(0, ["link_count", "arrivals"])
    parts = {r.name: F.least(F.expr(r.measure) * F.lit(r.factor), F.lit(SCORE_CAP)) for r in SCORES}
    total = functools.reduce(operator.add, [F.col(r.name) * F.lit(r.weight) for r in SCORES])
    tier = F.lit(TIERS[0])
    for least in sorted(t for t in TIERS if t):
        tier = F.when(F.col("composite_risk") >= least, F.lit(TIERS[least])).otherwise(tier)
    return scored.withColumns(parts).withColumn("composite_risk", total).withColumn("risk_tier", tier).select(
        key, *parts, "composite_risk", "risk_tier")


CASE_COLUMNS = {
    "case_id": "string", "account_id": "bigint", "detection_type": "string", "risk_score": "double",
    "status": "string", "evidence_rows": "bigint", "first_evidence": "bigint", "last_evidence": "bigint",
    "notes": "string", "created_at": "timestamp_ntz", "updated_at": "timestamp_ntz",
}


def cases(events: DataFrame, accounts: DataFrame, key: str, ts: str, amount: str, place: str, row_id: str,
          account: str, attributes: Sequence[str], velocity_seconds: int = 3600, opened: str = "2024-02-01 00:00:00") -> DataFrame:
    """One open case per account and detector, with a score, a summary of its evidence, a note and the time it was ``opened`` at.

    The evidence itself is ``case_evidence``: one row per event, not one array per account.
    """

    def shaped(hits: DataFrame, code: str, kind: str, who: str, score, evidence: str) -> DataFrame:
        return hits.groupBy(F.col(who).alias("account_id")).agg(
            F.least(score, F.lit(100.0)).cast("double").alias("risk_score"),
            F.count(evidence).alias("evidence_rows"),
            F.min(evidence).alias("first_evidence"), F.max(evidence).alias("last_evidence"),
        ).withColumns({
            "case_id": F.concat(F.lit(f"CASE_{code}_"), F.col("account_id").cast("string")),
            "detection_type": F.lit(kind), "status": F.lit("OPEN"), "notes": F.concat(F.lit(f"{kind}: "), F.col("evidence_rows").cast("string"), F.lit(" evidence rows")),
            "created_at": F.lit(opened).cast("timestamp_ntz"), "updated_at": F.lit(opened).cast("timestamp_ntz"),
        })

    detectors = [
        shaped(velocity_alerts(events, key, ts, velocity_seconds), "VEL", "VELOCITY", key,
               F.max("recent_n") * 15.0, row_id),
        shaped(amount_scores(events, key, ts, amount).filter("amount_alert AND past_avg IS NOT NULL"), "AMT", "AMOUNT",
               key, (F.max("amount_ratio") - 1.0) * 20.0, row_id),
        shaped(travel(events, key, place, ts, row_id), "GEO", "GEO", key, F.count("to_id") * 25.0, "to_id"),
        shaped(linkage(accounts, account, attributes), "LNK", "LINKAGE", account, F.max("link_count") * 20.0, account),
    ]
    return align_union(detectors, CASE_COLUMNS)


def case_evidence(events: DataFrame, key: str, ts: str, amount: str, place: str, row_id: str,
                  velocity_seconds: int = 3600) -> DataFrame:
    """The events behind the cases: (case_id, event)."""

    def rows(df: DataFrame, code: str, who: str, event: str) -> DataFrame:
        return df.select(F.concat(F.lit(f"CASE_{code}_"), F.col(who).cast("string")).alias("case_id"),
                         F.col(event).alias("event"))

    moved = travel(events, key, place, ts, row_id)
    return (rows(velocity_alerts(events, key, ts, velocity_seconds), "VEL", key, row_id)
            .unionByName(rows(amount_scores(events, key, ts, amount).filter("amount_alert"), "AMT", key, row_id))
            .unionByName(rows(moved, "GEO", key, "from_id")).unionByName(rows(moved, "GEO", key, "to_id"))).distinct()


def escalate(case_table: DataFrame, new_alerts: DataFrame, account: str, at: str = "2024-02-02 00:00:00") -> DataFrame:
    """Second pass, ``at`` a later time: raise scores above 50 by a tenth, mark them and add a note, open cases for accounts without one.

    ``case_table`` is a stored table: it is read three times.
    """
    hot = case_table.filter("risk_score > 50").select(
        "case_id", F.least(F.col("risk_score") * 1.1, F.lit(100.0)).alias("risk_score"),
        F.lit("INVESTIGATING").alias("status"), "account_id", "detection_type", F.concat("notes", F.lit("; escalated")).alias("notes"),
        "created_at", F.lit(at).cast("timestamp_ntz").alias("updated_at"))
    known = case_table.filter("detection_type = 'VELOCITY'").select("account_id")
    fresh = new_alerts.select(F.col(account).alias("account_id")).distinct().join(known, "account_id", "left_anti").select(
        F.concat(F.lit("CASE_VEL_NEW_"), F.col("account_id").cast("string")).alias("case_id"),
        F.lit(75.0).alias("risk_score"), F.lit("OPEN").alias("status"), "account_id",
        F.lit("VELOCITY").alias("detection_type"), F.lit("opened by a later alert").alias("notes"),
        F.lit(at).cast("timestamp_ntz").alias("created_at"), F.lit(at).cast("timestamp_ntz").alias("updated_at"))
    return merge(case_table, hot.unionByName(fresh), ["case_id"], [
        WhenMatched({c: f"source.{c}" for c in ("risk_score", "status", "notes", "updated_at")}), WhenNotMatched("*"),
    ], check_source=False)  # case_id is unique on both sides by construction
