"""Rules, quarantine, contracts, reconciliation and profiling in single passes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F, types as T


@dataclass(frozen=True)
class Rule:
    """A row rule. A row passes only where the expression is true; NULL fails.

    ``action`` (warn, drop, fail) is used by ``expect``, ``severity`` by reports.
    """

    name: str
    expr: str
    action: str = "warn"
    severity: str = "ERROR"
    message: str | None = None

    @property
    def passes(self) -> Column:
        return F.coalesce(F.expr(self.expr), F.lit(False))


class RuleViolation(ValueError):
    """A rule with action fail, or a contract, does not hold."""


def rule_counts(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row: the total and the failing rows of every rule, from one pass."""
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count(F.when(~r.passes, 1)).alias(f"f_{i}") for i, r in enumerate(rules)],
    )


def rule_report(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Check, severity, failing rows, total, pass percentage: one row per rule."""
    lines = F.array(*[
        F.struct(F.lit(r.name).alias("check_name"), F.lit(r.severity).alias("severity"),
                 F.lit(r.action).alias("action"), F.col(f"f_{i}").alias("failing_rows"))
        for i, r in enumerate(rules)
    ])
    return rule_counts(df, rules).select("total", F.explode(lines).alias("l")).select(
        "l.check_name", "l.severity", "l.action", "l.failing_rows",
        F.col("total").alias("total_rows"),
        (F.col("l.failing_rows") == 0).alias("passed"),
        F.when(F.col("total") > 0, (F.col("total") - F.col("l.failing_rows")) * 100.0 / F.col("total"))
        .otherwise(F.lit(100.0)).cast("double").alias("pass_pct"),
    )


def expect(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """Apply expectations: (rows kept, metrics). Rules with action fail are checked now, in one job."""
    must = [r for r in rules if r.action == "fail"]
    if must:
        broken = rule_counts(df, must).first()
        bad = {r.name: broken[f"f_{i}"] for i, r in enumerate(must) if broken[f"f_{i}"]}
        if bad:
            raise RuleViolation(f"failing rows by rule: {bad}")
    kept = df
    for r in rules:
        if r.action == "drop":
            kept = kept.filter(r.passes)
    return kept, rule_report(df, rules)


def with_errors(df: DataFrame, rules: Sequence[Rule], column: str = "error_messages") -> DataFrame:
    """Adds every failed rule's message, in rule order, joined by "; " (empty when none failed)."""
    messages = F.array_compact(F.array(*[
        F.when(~r.passes, F.lit(r.message or r.name)) for r in rules
    ]))
    return df.withColumn(column, F.concat_ws("; ", messages))


def quarantine(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """(valid, dead letters). Together they hold exactly the input rows."""
    marked = with_errors(df, rules)
    valid = marked.filter(F.col("error_messages") == "").drop("error_messages")
    return valid, marked.filter(F.col("error_messages") != "")


def error_breakdown(dead: DataFrame) -> DataFrame:
    return dead.select(F.explode(F.split("error_messages", "; ")).alias("error")).groupBy("error").agg(
        F.count(F.lit(1)).alias("rows")
    )


def flag(df: DataFrame, rules: Sequence[Rule], prefix: str = "dq_") -> DataFrame:
    """A boolean column per rule, true where it fails; no row is dropped. Works on streams."""
    return df.withColumns({f"{prefix}{r.name}": ~r.passes for r in rules})


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with the number of copies."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)


# ---- schema -----------------------------------------------------------------------------

_WIDER = {
    ("int", "bigint"), ("int", "double"), ("smallint", "int"), ("smallint", "bigint"),
    ("float", "double"), ("date", "timestamp"), ("date", "timestamp_ntz"),
}


def schema_diff(actual: T.StructType, expected: T.StructType) -> list[tuple[str, str, str | None, str | None]]:
    """(column, missing | extra | retyped, expected type, actual type)."""
    have = {f.name: f.dataType.simpleString() for f in actual.fields}
    want = {f.name: f.dataType.simpleString() for f in expected.fields}
    out = [(c, "missing", t, None) for c, t in want.items() if c not in have]
    out += [(c, "extra", None, t) for c, t in have.items() if c not in want]
    out += [(c, "retyped", t, have[c]) for c, t in want.items() if c in have and have[c] != t]
    return out


def evolve(target: DataFrame, batch: DataFrame, mode: str = "addNewColumns") -> DataFrame:
    """Append a batch whose schema drifted.

    addNewColumns: new columns join the table, older rows hold NULL. rescue: new columns
    go into ``_rescued_data`` as JSON. failOnNewColumns: raise. none: drop them. A wider
    type widens the column; any other change of type raises.
    """
    extra = [c for c in batch.columns if c not in target.columns]
    if extra and mode == "failOnNewColumns":
        raise RuleViolation(f"new columns {extra}")
    if mode == "rescue":
        if "_rescued_data" not in target.columns:
            target = target.withColumn("_rescued_data", F.lit(None).cast("string"))
        extra = [c for c in batch.columns if c not in target.columns]
        rescued = F.to_json(F.struct(*extra)) if extra else F.lit(None).cast("string")
        batch = batch.withColumn("_rescued_data", rescued).drop(*extra)
    elif mode == "none":
        batch = batch.drop(*extra)
    elif mode not in ("addNewColumns", "failOnNewColumns"):
        raise ValueError(mode)
    for f in target.schema.fields:
        if f.name not in batch.columns:
            continue
        old, new = f.dataType.simpleString(), batch.schema[f.name].dataType.simpleString()
        if old == new:
            continue
        if (old, new) in _WIDER:
            target = target.withColumn(f.name, F.col(f.name).cast(new))
        elif (new, old) in _WIDER:
            batch = batch.withColumn(f.name, F.col(f.name).cast(old))
        else:
            raise RuleViolation(f"column {f.name}: {old} cannot take {new}")
    return target.unionByName(batch, allowMissingColumns=True)


@dataclass(frozen=True)
class Contract:
    """What a table promises. ``primary_key`` is informational, the rest is enforced."""

    schema: str
    not_null: Sequence[str] = ()
    checks: Mapping[str, str] = field(default_factory=dict)
    defaults: Mapping[str, str] = field(default_factory=dict)
    generated: Mapping[str, str] = field(default_factory=dict)
    primary_key: Sequence[str] = ()


def contract_rules(contract: Contract) -> list[Rule]:
    rules = [Rule(f"not_null_{c}", f"{c} IS NOT NULL") for c in contract.not_null]
    # a CHECK rejects only what is false: NULL passes, as in SQL
    rules += [Rule(n, f"coalesce({e}, true)") for n, e in contract.checks.items()]
    return rules


def conform(df: DataFrame, contract: Contract) -> DataFrame:
    """Fill defaults, cast to the schema and compute generated columns."""
    schema = T._parse_datatype_string(contract.schema)
    supplied = [c for c in df.columns if c in contract.generated]
    if supplied:
        raise RuleViolation(f"generated columns supplied: {supplied}")
    unknown = [c for c in df.columns if c not in schema.names]
    if unknown:
        raise RuleViolation(f"unknown columns: {unknown}")
    base = []
    for f in schema.fields:
        if f.name in contract.generated:
            continue
        if f.name in df.columns:
            value = F.col(f.name)
        elif f.name in contract.defaults:
            value = F.expr(contract.defaults[f.name])
        else:
            value = F.lit(None)
        base.append(value.cast(f.dataType).alias(f.name))
    out = df.select(*base)
    for name, expr in contract.generated.items():
        out = out.withColumn(name, F.expr(expr).cast(schema[name].dataType))
    return out.select(*schema.names)


def enforce(df: DataFrame, contract: Contract) -> DataFrame:
    """The conformed rows, or ``RuleViolation`` for the whole batch when a single row breaks the contract."""
    shaped = conform(df, contract)
    rules = contract_rules(contract)
    if rules:
        counts = rule_counts(shaped, rules).first()
        bad = {r.name: counts[f"f_{i}"] for i, r in enumerate(rules) if counts[f"f_{i}"]}
        if bad:
            raise RuleViolation(f"contract broken: {bad}")
    return shaped


def rescue(raw: DataFrame, schema: Mapping[str, str]) -> DataFrame:
    """Cast text columns; what does not parse stays readable in ``_rescued_data`` as JSON."""
    typed = {c: F.col(c).try_cast(t) for c, t in schema.items()}
    lost = F.struct(*[
        F.when(F.col(c).isNotNull() & typed[c].isNull(), F.col(c)).alias(c) for c in schema
    ])
    any_lost = F.lit(False)
    for c in schema:
        any_lost = any_lost | (F.col(c).isNotNull() & typed[c].isNull())
    others = [F.col(c) for c in raw.columns if c not in schema]
    return raw.select(*others, *[v.alias(c) for c, v in typed.items()],
                      F.when(any_lost, F.to_json(lost)).alias("_rescued_data"))


# ---- monitoring -------------------------------------------------------------------------


def null_safe_hash(columns):
    """64-bit hash of a row that also tells where its NULLs stand; xxhash64 alone passes over them."""
    return F.xxhash64(*[x for c in columns for x in (F.col(c).isNull(), F.col(c))])


def reconcile(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Counts of both sides, keys on one side only, duplicate keys and keys whose rows differ. One shuffle."""
    cols = [c for c in a.columns if c not in keys]
    digest = null_safe_hash(cols) if cols else F.lit(0).cast("bigint")
    # three sums of 22 bits: plain longs that stay in range for any number of copies
    parts = {f"_h{i}": F.shiftrightunsigned(digest, 22 * i).bitwiseAND(F.lit((1 << 22) - 1).cast("bigint")) for i in range(3)}
    both = a.select(*keys, *[p.alias(n) for n, p in parts.items()], F.lit(1).alias("_a"), F.lit(0).alias("_b")).unionByName(
        b.select(*keys, *[p.alias(n) for n, p in parts.items()], F.lit(0).alias("_a"), F.lit(1).alias("_b"))
    )
    per_key = both.groupBy(*keys).agg(
        F.sum("_a").alias("na"), F.sum("_b").alias("nb"),
        *[F.sum(F.col(n) * (F.col("_a") - F.col("_b"))).alias(f"gap{n}") for n in parts],
    )
    differs = F.lit(False)
    for n in parts:
        differs = differs | (F.col(f"gap{n}") != 0)
    zero = F.lit(0).cast("bigint")
    return per_key.agg(
        F.coalesce(F.sum("na"), zero).alias("rows_a"),
        F.coalesce(F.sum("nb"), zero).alias("rows_b"),
        F.count(F.when(F.col("nb") == 0, 1)).alias("only_a"),
        F.count(F.when(F.col("na") == 0, 1)).alias("only_b"),
        F.count(F.when(F.col("na") > 1, 1)).alias("duplicate_keys_a"),
        F.count(F.when(F.col("nb") > 1, 1)).alias("duplicate_keys_b"),
        F.count(F.when((F.col("na") > 0) & (F.col("nb") > 0) & differs, 1)).alias("changed"),
    )


def null_rates(df: DataFrame, columns: Sequence[str] | None = None, threshold: float = 0.0) -> DataFrame:
    cols = list(columns or df.columns)
    one = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.count(F.when(F.col(c).isNull(), 1)).alias(f"_{i}") for i, c in enumerate(cols)])
    lines = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"_{i}").alias("nulls"))
                      for i, c in enumerate(cols)])
    rate = F.col("l.nulls").cast("double") / F.nullif(F.col("_n"), F.lit(0)).cast("double")
    return one.select("_n", F.explode(lines).alias("l")).select(
        "l.column_name", "l.nulls", F.col("_n").alias("total_rows"), rate.alias("null_rate"),
        (F.coalesce(rate, F.lit(0.0)) > threshold).alias("above_threshold"),
    )


def volume(df: DataFrame, low: int, high: int) -> DataFrame:
    n = F.col("row_count")
    status = F.when(n < low, "TOO_FEW").when(n > high, "TOO_MANY").otherwise("OK")
    return df.agg(F.count(F.lit(1)).alias("row_count")).withColumn("status", status)


def freshness(df: DataFrame, ts: str, now: str, max_hours: float, keys: Sequence[str] = ()) -> DataFrame:
    """Hours since the newest row, against a given now."""
    newest = df.groupBy(*keys).agg(F.max(ts).alias("newest"))
    hours = (F.unix_seconds(F.lit(now).cast("timestamp")) - F.unix_seconds(F.col("newest").cast("timestamp"))) / 3600.0
    return newest.select(*keys, hours.cast("double").alias("hours_since"),
                         F.when(hours <= max_hours, "FRESH").otherwise("STALE").alias("status"))


def profile(df: DataFrame, columns: Sequence[str] | None = None, exact_distinct: bool = False) -> DataFrame:
    """Rows, nulls, distinct values, bounds and mean of each column in one pass.

    Distinct values are estimated by a fixed-size sketch unless ``exact_distinct``, which
    counts them from (column, value) pairs and so shuffles each distinct value once.
    """
    cols = list(columns or df.columns)
    numeric = {f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)}
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, c in enumerate(cols):
        aggs += [
            F.count(c).alias(f"_c{i}"),
            F.min(c).cast("string").alias(f"_lo{i}"),
            F.max(c).cast("string").alias(f"_hi{i}"),
            (F.sum(F.col(c).cast("decimal(38,4)")).cast("double") / F.count(c) if c in numeric
             else F.lit(None).cast("double")).alias(f"_m{i}"),
        ]
        if not exact_distinct:
            aggs.append(F.approx_count_distinct(c).alias(f"_d{i}"))
    lines = F.array(*[
        F.struct(F.lit(c).alias("column_name"), (F.col("_n") - F.col(f"_c{i}")).alias("nulls"),
                 (F.lit(None).cast("bigint") if exact_distinct else F.col(f"_d{i}")).alias("distinct_values"),
                 F.col(f"_lo{i}").alias("min_value"), F.col(f"_hi{i}").alias("max_value"),
                 F.col(f"_m{i}").alias("mean_value"))
        for i, c in enumerate(cols)
    ])
    out = df.agg(*aggs).select(F.col("_n").alias("total_rows"), F.explode(lines).alias("l")).select("total_rows", "l.*")
    if not exact_distinct:
        return out
    cells = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("v")) for c in cols
    ])).alias("s")).select("s.*").filter(F.col("v").isNotNull())
    distinct = cells.distinct().groupBy("column_name").agg(F.count(F.lit(1)).alias("distinct_values"))
    return out.drop("distinct_values").join(distinct, "column_name", "left").fillna(0, ["distinct_values"])


def drift(old: DataFrame, new: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """Population stability index of a numeric column over equal-width bins of the old range.

    Values outside the old range fall into the first or last bin. Empty shares count as 1e-4.
    """
    bounds = old.agg(F.struct(F.min(column).alias("lo"), F.max(column).alias("hi")))

    def counts(df: DataFrame, name: str) -> DataFrame:
        with_bounds = df.filter(F.col(column).isNotNull()).withColumn("_b", bounds.scalar())
        width = (F.col("_b.hi") - F.col("_b.lo")) / F.lit(bins)
        bin_no = F.least(F.greatest(F.floor((F.col(column) - F.col("_b.lo")) / F.nullif(width, F.lit(0.0))), F.lit(0)),
                         F.lit(bins - 1))
        return with_bounds.groupBy(F.coalesce(bin_no, F.lit(0)).cast("int").alias("bin")).agg(
            F.count(F.lit(1)).alias(name))

    both = counts(old, "old_rows").join(counts(new, "new_rows"), "bin", "full_outer").fillna(0)
    total = both.agg(F.struct(F.sum("old_rows").alias("o"), F.sum("new_rows").alias("n"))).scalar()
    shares = both.withColumn("_t", total).withColumn(
        "old_share", F.greatest(F.col("old_rows") / F.col("_t.o"), F.lit(1e-4))
    ).withColumn("new_share", F.greatest(F.col("new_rows") / F.col("_t.n"), F.lit(1e-4)))
    term = (F.col("new_share") - F.col("old_share")) * F.log(F.col("new_share") / F.col("old_share"))
    return shares.select("bin", "old_rows", "new_rows", term.alias("psi_term"))


#: Rank error of the quantile sketch, as one part of so many.
SKETCH_ACCURACY = 10_000


def quantile_drift(old: DataFrame, new: DataFrame, column: str, bins: int = 10, accuracy: int = SKETCH_ACCURACY) -> DataFrame:
    """Population stability index of a numeric column over bins of equal share of the old rows.

    The edges are quantiles of a sketch that tasks build apart and merge, off by 1/accuracy of the rows at most; both snapshots are counted against them. A bin holds
    the values above its lower edge up to its upper one; equal edges leave empty bins out. NULLs are a bin of their own, numbered -1. Empty shares count as 1e-4.
    """
    points = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    edges = old.agg(F.array_distinct(F.coalesce(F.percentile_approx(column, points, accuracy), F.array())).alias("e"))

    def counts(df: DataFrame, name: str) -> DataFrame:
        inside = F.size(F.filter(F.col("_e"), lambda e: e < F.col(column)))
        bin_no = F.when(F.col(column).isNull(), F.lit(-1)).otherwise(inside)
        return df.select(column).withColumn("_e", edges.scalar()).groupBy(bin_no.alias("bin")).agg(F.count(F.lit(1)).alias(name))

    return _stability(counts(old, "old_rows"), counts(new, "new_rows"), "bin")


def category_drift(old: DataFrame, new: DataFrame, column: str) -> DataFrame:
    """Stability index and frequency distance of a categorical column, by category: NULL is one, as are those that only one side has.

    The distances add up to the total variation distance of the two snapshots, 0 to 1.
    """
    count = lambda df, name: df.groupBy(F.col(column).alias("category")).agg(F.count(F.lit(1)).alias(name))
    return _stability(count(old, "old_rows"), count(new, "new_rows"), "category")


def _stability(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """(key, old_rows, new_rows, psi_term, distance) of two counts by key."""
    side = new.withColumnRenamed(key, "_key").withColumn("_new", F.lit(True))
    both = old.withColumn("_old", F.lit(True)).join(side, F.col(key).eqNullSafe(F.col("_key")), "full_outer")
    both = both.select(F.when(F.col("_old"), F.col(key)).otherwise(F.col("_key")).alias(key),
                       *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("old_rows", "new_rows")])
    total = both.agg(F.struct(F.sum("old_rows").alias("o"), F.sum("new_rows").alias("n"))).scalar()
    share = lambda c, of: F.coalesce(F.col(c) / F.nullif(F.col(of), F.lit(0)), F.lit(0.0))
    shares = both.withColumn("_t", total).withColumns({"_p": share("old_rows", "_t.o"), "_q": share("new_rows", "_t.n")})
    p, q = F.greatest("_p", F.lit(1e-4)), F.greatest("_q", F.lit(1e-4))
    return shares.select(key, "old_rows", "new_rows", ((q - p) * F.log(q / p)).alias("psi_term"), (F.abs(F.col("_q") - F.col("_p")) / 2).alias("distance"))


def fingerprint(df: DataFrame, predicate: str | None = None) -> DataFrame:
    """Row count and order-free content sum; equal before and after a rerun means nothing changed."""
    rows = df.filter(predicate) if predicate else df
    digest = null_safe_hash(df.columns).cast("decimal(38,0)")
    return rows.agg(F.count(F.lit(1)).alias("row_count"), F.sum(digest).cast("string").alias("content_sum"))


def pass_rate(condition: Column) -> Column:
    return F.count(F.when(condition, 1)).cast("double") / F.nullif(F.count(F.lit(1)), F.lit(0)).cast("double")
