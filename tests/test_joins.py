"""Skew, range and interval joins against plain ones."""

import random

import pytest
from pyspark.sql import functions as F

from spindrift.operators import joins
from spindrift.operators.joins import hot_key_join, interval_join, latest_before, nearest_other_place, salted_join
from spindrift.plans.report import operators_of, plan_text

T0 = 1_700_000_000


@pytest.fixture(scope="module")
def sides(spark):
    fact = spark.createDataFrame([(1 if i % 10 < 8 else (None if i % 10 == 9 else i), i) for i in range(500)], "k long, x long")
    # copies of one row, and a dimension with a doubled key
    fact = fact.unionByName(spark.createDataFrame([(1, -1)] * 200, "k long, x long"))
    dim = spark.createDataFrame([(i, f"d{i}") for i in range(0, 300)] + [(1, "again")], "k long, d string")
    return fact, dim


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join(sides, how):
    fact, dim = sides
    a = fact.join(dim, "k", how).collect()
    b = salted_join(fact, dim, "k", 7, how).select(*fact.join(dim, "k", how).columns).collect()
    assert sorted(map(repr, a)) == sorted(map(repr, b))


def test_salted_join_rejects_full(sides):
    with pytest.raises(ValueError):
        salted_join(*sides, "k", 4, "full")


def test_repeats_of_the_dimension_are_not_broadcast(spark, tables):
    """The optimiser plans the dimension by its files, without the repeats: a sixteenth of what the driver would hold."""
    dim = tables.part.select("p_partkey", "p_brand")
    fact = tables.lineitem.select(F.col("l_partkey").alias("p_partkey"), "l_quantity")
    for joined in (salted_join(fact, dim, "p_partkey"), hot_key_join(fact, dim, "p_partkey", 0.001).filter("l_quantity > 1")):
        used = operators_of(plan_text(joined))
        assert "SortMergeJoin" in used
    assert "BroadcastExchange" not in plan_text(salted_join(fact, dim, "p_partkey"))


def test_hot_key_join(sides):
    fact, dim = sides
    a = fact.join(dim, "k").select("k", "x", "d").collect()
    b = hot_key_join(fact, dim, "k", 0.3, 5).select("k", "x", "d").collect()
    assert sorted(map(repr, a)) == sorted(map(repr, b))


def test_salt_spreads_copies(sides):
    fact, _ = sides
    one = fact.filter("x = -1").repartition(8)
    assert one.select(joins.row_salt(one, 8).alias("s")).distinct().count() > 1


def test_interval_bounds(spark):
    versions = spark.createDataFrame([("a", 1, 5, "x"), ("a", 5, None, "y")], "k string, lo int, hi int, v string")
    facts = spark.createDataFrame([("a", 0), ("a", 1), ("a", 4), ("a", 5), ("b", 2)], "k string, at int")
    got = {(r["at"], r["v"]) for r in interval_join(facts, versions, "k", "at", "lo", "hi").collect()}
    assert got == {(1, "x"), (4, "x"), (5, "y")}
    assert interval_join(facts, versions, "k", "at", "lo", "hi", "left").count() == 5


@pytest.mark.parametrize("hot_rows", [10, 1_000_000])
def test_interval_join_equals_range_join(spark, hot_rows):
    rnd = random.Random(hot_rows)
    versions, facts = [], [(None, 3, -1), ("a", None, -2), ("zz", 5, -3)]
    for k in "abc":
        cuts = sorted(rnd.sample(range(500), 60))
        for i, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
            if rnd.random() < 0.8:  # gaps
                versions.append((k, lo, hi, f"{k}{i}"))
        versions += [(k, cuts[-1], None, f"{k}open"), (k, cuts[5], cuts[5], "empty")]
    facts += [(rnd.choice("aaaab"), rnd.choice([7, rnd.randrange(520)]), i) for i in range(400)]  # a hot key and a hot moment
    v = spark.createDataFrame([*versions, (None, 1, 9, "x"), ("a", None, 9, "y")], "k string, lo int, hi int, v string")
    f = spark.createDataFrame(facts, "k string, at int, id int").repartition(3)
    for how in ("inner", "left"):
        side = v.withColumnRenamed("k", "vk")
        on = (F.col("k") == F.col("vk")) & (F.col("at") >= F.col("lo")) & (F.col("hi").isNull() | (F.col("at") < F.col("hi")))
        want = f.join(side, on, how).select("id", "k", "at", "lo", "hi", "v").collect()
        got = interval_join(f, v, "k", "at", "lo", "hi", how, hot_rows=hot_rows)
        assert sorted(map(repr, got.select("id", "k", "at", "lo", "hi", "v").collect())) == sorted(map(repr, want))
    assert "Join" not in interval_join(f, v, "k", "at", "lo", "hi")._jdf.queryExecution().optimizedPlan().toString()  # one pass in order of time
    with pytest.raises(ValueError):
        interval_join(f, v, "k", "at", "lo", "hi", "full")


def brute_travel(rows, limit):
    out = set()
    for (k, p, s, i) in rows:
        best = [r for r in rows if r[0] == k and r[1] != p and r[2] < s and s - r[2] <= limit]
        if best:
            m = max(r[2] for r in best)
            place, src = min((r[1], r[3]) for r in best if r[2] == m)
            out.add((k, src, i, place, p, s - m))
    return out


@pytest.mark.parametrize("hot_rows", [15, 1_000_000])
@pytest.mark.parametrize("seed", range(3))
def test_nearest_other_place(spark, seed, hot_rows):
    rnd = random.Random(seed)
    rows = [(rnd.choice("ab"), rnd.choice("xyz"), T0 + rnd.randrange(0, 300), i) for i in range(120)]
    rows += [("hot", "x", T0 + i, 500 + i) for i in range(80)] + [("hot", "y", T0 + 79 + 30, 900), ("hot", "y", T0 + 79 + 31 + 100, 901)]
    df = spark.createDataFrame(rows, "k string, p string, s long, id long").withColumn("ts", F.timestamp_seconds("s"))
    got = nearest_other_place(df, "k", "p", "ts", "id", 30, hot_rows=hot_rows).collect()
    assert {(r["k"], r["from_id"], r["to_id"], r["place_from"], r["place_to"], r["travel_seconds"]) for r in got} == brute_travel(rows, 30)


def test_travel_edges(spark):
    # 0, 1, 1800 and 1801 seconds apart, and the same place
    rows = [("a", "x", T0, 1), ("a", "y", T0, 2), ("b", "x", T0, 3), ("b", "y", T0 + 1, 4), ("c", "x", T0, 5), ("c", "y", T0 + 1800, 6),
            ("d", "x", T0, 7), ("d", "y", T0 + 1801, 8), ("e", "x", T0, 9), ("e", "x", T0 + 5, 10)]
    df = spark.createDataFrame(rows, "k string, p string, s long, id long").withColumn("ts", F.timestamp_seconds("s"))
    assert {r["to_id"] for r in nearest_other_place(df, "k", "p", "ts", "id", 1800).collect()} == {4, 6}


@pytest.mark.parametrize("hot_rows", [15, 1_000_000])
def test_latest_before(spark, hot_rows):
    rnd = random.Random(3)
    a = [(rnd.choice("ab"), T0 + rnd.randrange(0, 400), i) for i in range(80)]
    b = [(rnd.choice("abc"), T0 + rnd.randrange(0, 400), 1000 + i) for i in range(80)]
    make = lambda rows: spark.createDataFrame(rows, "k string, s long, id long").withColumn("ts", F.timestamp_seconds("s"))
    got = latest_before(make(a), make(b), "k", "ts", "ts", 40, ["ts", "id"], "id", hot_rows=hot_rows).collect()
    want = set()
    for k, s, i in b:
        hits = [r for r in a if r[0] == k and 0 <= s - r[1] <= 40]
        if hits:
            want.add((i, max((r[1], r[2]) for r in hits)[1], len(hits)))
    assert {(r["right_id"], r["left_id"], r["matches"]) for r in got} == want


def test_orphans_and_replicate(spark):
    fact = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    dim = spark.createDataFrame([(1,)], "d int")
    assert [r["k"] for r in joins.orphans(fact, dim, "k", "d").orderBy("k").collect()] == [None, 2]
    assert joins.replicate(fact, "role", ["a", "b"]).count() == 6
