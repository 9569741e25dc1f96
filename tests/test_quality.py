"""Rules, contracts, drift of schemas and reports, with NULLs."""

import pytest
from pyspark.sql import functions as F, types as T

from spindrift.operators import quality as q
from spindrift.operators.quality import Contract, Rule

RULES = [Rule("pos", "amount > 0", "drop", message="amount not positive"), Rule("known", "status IN ('a', 'b')", message="unknown status")]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame([(1, 5.0, "a"), (2, None, "b"), (3, -1.0, None), (4, 2.0, "x")], "id int, amount double, status string")


def test_null_fails_a_rule(rows):
    got = {r["check_name"]: (r["failing_rows"], r["total_rows"]) for r in q.rule_report(rows, RULES).collect()}
    assert got == {"pos": (2, 4), "known": (2, 4)}


def test_quarantine_keeps_every_row(rows):
    valid, dead = q.quarantine(rows, RULES)
    assert {r["id"] for r in valid.collect()} == {1}
    assert {r["id"]: r["error_messages"] for r in dead.collect()} == {
        2: "amount not positive", 3: "amount not positive; unknown status", 4: "unknown status"}
    assert {(r["error"], r["rows"]) for r in q.error_breakdown(dead).collect()} == {("amount not positive", 2), ("unknown status", 2)}


def test_expect_actions(rows):
    kept, _ = q.expect(rows, RULES)
    assert {r["id"] for r in kept.collect()} == {1, 4}
    with pytest.raises(q.RuleViolation, match="never"):
        q.expect(rows, [Rule("never", "id > 1", "fail")])


def test_empty_report(rows):
    assert q.rule_report(rows.limit(0), RULES).first()["pass_pct"] == 100.0


CONTRACT = Contract(
    schema="id int, name string, price decimal(10,2), discount decimal(5,2), final decimal(10,2), stock int",
    not_null=["id", "name"], checks={"price": "price > 0", "discount": "discount BETWEEN 0 AND 100", "stock": "stock >= 0"},
    defaults={"discount": "0"}, generated={"final": "price * (1 - discount / 100)"})


def batch(spark, *values, extra=""):
    return spark.createDataFrame(values, "id int, name string, price double, stock int" + extra)


def test_contract_fills_in(spark):
    row = q.enforce(batch(spark, (1, "a", 10.0, 5)), CONTRACT).first()
    assert (float(row["discount"]), float(row["final"])) == (0.0, 10.0)


@pytest.mark.parametrize("bad", [(None, "a", 1.0, 1), (1, None, 1.0, 1), (1, "a", -1.0, 1), (1, "a", 1.0, -1)])
def test_contract_rejects_whole_batch(spark, bad):
    with pytest.raises(q.RuleViolation):
        q.enforce(batch(spark, (9, "good", 1.0, 1), bad), CONTRACT)


def test_contract_rejects_discount_generated_unknown(spark):
    with pytest.raises(q.RuleViolation):
        q.enforce(batch(spark, (1, "a", 1.0, 1, 150.0), extra=", discount double"), CONTRACT)
    with pytest.raises(q.RuleViolation, match="generated"):
        q.enforce(batch(spark, (1, "a", 1.0, 1, 1.0), extra=", final double"), CONTRACT)
    with pytest.raises(q.RuleViolation, match="unknown"):
        q.enforce(batch(spark, (1, "a", 1.0, 1, 1.0), extra=", other double"), CONTRACT)


def test_check_lets_null_pass(spark):
    assert q.enforce(batch(spark, (1, "a", None, None)), CONTRACT).count() == 1


def test_evolve_modes(spark):
    old = spark.createDataFrame([(1, 2)], "id int, n int")
    new = spark.createDataFrame([(2, 2**40, "c")], "id int, n bigint, extra string")
    wide = q.evolve(old, new)
    assert wide.schema["n"].dataType == T.LongType() and {r["extra"] for r in wide.collect()} == {None, "c"}
    assert q.evolve(old, new, "none").columns == ["id", "n"]
    assert {r["_rescued_data"] for r in q.evolve(old, new, "rescue").collect()} == {None, '{"extra":"c"}'}
    with pytest.raises(q.RuleViolation):
        q.evolve(old, new, "failOnNewColumns")
    with pytest.raises(q.RuleViolation):
        q.evolve(old, spark.createDataFrame([("x",)], "id string"))


def test_schema_diff():
    have = T._parse_datatype_string("a int, b string, d int")
    want = T._parse_datatype_string("a bigint, b string, c int")
    assert {(c, p) for c, p, _, _ in q.schema_diff(have, want)} == {("a", "retyped"), ("c", "missing"), ("d", "extra")}


def test_rescue(spark):
    raw = spark.createDataFrame([("1", "2.5"), ("BAD", "3"), (None, "x")], "id string, v string")
    got = [tuple(r) for r in q.rescue(raw, {"id": "int", "v": "double"}).collect()]
    assert got == [(1, 2.5, None), (None, 3.0, '{"id":"BAD"}'), (None, None, '{"v":"x"}')]


def test_reconcile(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (2, "z"), (3, "q"), (5, "c"), (5, "c")], "k int, v string")
    b = spark.createDataFrame([(1, "x"), (2, "z"), (2, "y"), (3, "Q"), (4, "n"), (5, "d"), (5, "d")], "k int, v string")
    assert tuple(q.reconcile(a, b, ["k"]).first()) == (6, 7, 0, 1, 2, 2, 2)


def test_fingerprint_ignores_order(rows):
    a, b = q.fingerprint(rows).first(), q.fingerprint(rows.orderBy(F.desc("id")).repartition(3)).first()
    assert a == b != q.fingerprint(rows.withColumn("id", F.col("id") + 1)).first()


def test_drift_of_same_is_zero(rows):
    amounts = rows.filter("amount IS NOT NULL")
    assert amounts.count() == 3 and sum(r["psi_term"] for r in q.drift(amounts, amounts, "amount", 4).collect()) == 0


def test_profile_exact_and_sketch(rows):
    exact = {r["column_name"]: r["distinct_values"] for r in q.profile(rows, exact_distinct=True).collect()}
    sketch = {r["column_name"]: r["distinct_values"] for r in q.profile(rows).collect()}
    assert exact == sketch == {"id": 4, "amount": 3, "status": 3}


def test_hash_tells_where_nulls_stand(spark):
    rows = spark.createDataFrame([("x", None), (None, "x")], "a string, b string")
    assert rows.select(q.null_safe_hash(["a", "b"]).alias("h")).distinct().count() == 2


def test_pandas_tier_of_a_missing_balance():
    import pandas as pd

    from spindrift.queries.subqueries import pandas_tier

    assert pandas_tier(pd.Series([None, 0.0, 2500.0, 7500.0])).tolist() == ["BRONZE", "BRONZE", "SILVER", "GOLD"]


def test_drift_by_quantiles_and_categories(spark):
    old = spark.range(1000).selectExpr("CAST(id AS DOUBLE) AS v", "IF(id % 4 = 0, 'a', 'b') AS c").union(spark.sql("SELECT NULL, NULL"))
    same = q.quantile_drift(old, old, "v", 10).collect()
    assert {r.bin: r.old_rows for r in same} == {-1: 1, **dict.fromkeys(range(10), 100)} and all(r.psi_term == 0 for r in same)
    moved = q.quantile_drift(old, old.selectExpr("v + 500 AS v"), "v", 10).collect()
    assert sum(r.new_rows for r in moved) == 1001 and {r.bin for r in moved if r.new_rows} == {-1, 5, 6, 7, 8, 9}
    assert abs(sum(r.distance for r in moved) - 500 / 1001) < 0.01
    flat = q.quantile_drift(old.selectExpr("1D AS v"), old, "v", 10).collect()  # one value: its edges are one
    assert sum(r.old_rows for r in flat) == 1001
    by = {r.category: r for r in q.category_drift(old, old.filter("c = 'a'").selectExpr("'z' AS c").union(old.select("c")), "c").collect()}
    assert set(by) == {"a", "b", "z", None} and by["z"].old_rows == 0 and abs(sum(r.distance for r in by.values()) - 250 / 1251) < 1e-9
    none = q.quantile_drift(old.filter("false"), old, "v", 10).collect()
    assert sum(r.new_rows for r in none) == 1001 and q.category_drift(old.filter("false"), old.filter("false"), "c").isEmpty()


def test_a_large_sketch_is_near_the_true_quantiles(spark):
    rows = spark.range(200_000).selectExpr("CAST(pmod(hash(id), 100003) AS DOUBLE) AS v")
    found = q.quantile_drift(rows, rows, "v", 10, accuracy=1000).collect()
    assert all(abs(r.old_rows - 20_000) <= 2 * 200 + 10 for r in found)
