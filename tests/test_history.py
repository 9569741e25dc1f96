"""History tables and change feeds: NULLs, order, repetition, round trips."""

import random

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from spindrift.operators import history as h
from spindrift.operators.merge import AmbiguousMerge

DDL = "k int, a string, b int"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_scd2_null_safe_and_idempotent(spark):
    dim = h.open_history(spark.createDataFrame([(1, None, 1), (2, "x", 2), (3, "y", 3), (4, "q", 4)], DDL), "2024-01-01")
    snap = spark.createDataFrame([(1, "v", 1), (2, None, 2), (3, "y", 99), (5, "n", 5)], DDL)
    once = h.scd2(dim, snap, ["k"], ["a"], "2024-02-01")
    got = {(r["k"], r["a"], str(r["eff_start"]), str(r["eff_end"]), r["is_current"]) for r in once.collect()}
    assert got == {
        (1, None, "2024-01-01", "2024-02-01", False), (1, "v", "2024-02-01", "None", True),
        (2, "x", "2024-01-01", "2024-02-01", False), (2, None, "2024-02-01", "None", True),
        (3, "y", "2024-01-01", "None", True), (4, "q", "2024-01-01", "None", True), (5, "n", "2024-02-01", "None", True)}
    assert rows(h.scd2(once, snap, ["k"], ["a"], "2024-02-01")) == rows(once)
    assert h.current(once).count() == 5 and h.as_of(once, F.lit("2024-01-15").cast("date")).count() == 4


LOG = [("INSERT", "c1", "a@x", 1), ("UPDATE", "c1", "b@x", 3), ("DELETE", "c1", None, 5), ("INSERT", "c1", "c@x", 7),
       ("INSERT", "c2", "d@x", 2), ("UPDATE", "c2", "e@x", 6), ("INSERT", "c3", "f@x", 4), ("DELETE", "c3", None, 8)]
LOG_DDL = "op string, id string, mail string, seq long"


@pytest.mark.parametrize("seed", range(3))
def test_cdc_any_order(spark, seed):
    shuffled = LOG + LOG[:2]  # two events delivered twice
    random.Random(seed).shuffle(shuffled)
    log = spark.createDataFrame(shuffled, LOG_DDL).repartition(3)
    live = h.live_rows(h.apply_cdc(log, ["id"], "seq", "op"))
    assert {(r["id"], r["mail"]) for r in live.collect()} == {("c1", "c@x"), ("c2", "e@x")}
    for hot_rows in (None, 2):
        hist = h.apply_cdc(log, ["id"], "seq", "op", scd_type=2, hot_rows=hot_rows)
        assert {(r["id"], r["mail"], r["valid_from"], r["valid_to"]) for r in hist.collect()} == {
            ("c1", "a@x", 1, 3), ("c1", "b@x", 3, 5), ("c1", "c@x", 7, None), ("c2", "d@x", 2, 6), ("c2", "e@x", 6, None), ("c3", "f@x", 4, 8)}


def test_cdc_late_event_after_delete(spark):
    first = h.apply_cdc(spark.createDataFrame([("DELETE", "c", None, 9)], LOG_DDL), ["id"], "seq", "op")
    late = spark.createDataFrame([("UPDATE", "c", "old", 3)], LOG_DDL)
    assert h.live_rows(h.apply_cdc(late, ["id"], "seq", "op", target=first)).isEmpty()


CELL = st.tuples(st.one_of(st.none(), st.sampled_from("xy")), st.one_of(st.none(), st.integers(0, 2)))
SNAPSHOT = st.dictionaries(st.integers(0, 5), CELL, max_size=5)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(a=SNAPSHOT, b=SNAPSHOT)
def test_feed_round_trip(spark, a, b):
    old = spark.createDataFrame([(k, *v) for k, v in a.items()], DDL)
    new = spark.createDataFrame([(k, *v) for k, v in b.items()], DDL)
    feed = h.initial_feed(old, 0, "2024-01-01").unionByName(h.change_feed(old, new, ["k"], 1, "2024-02-01"))
    assert rows(h.state_as_of(feed, ["k"], 1)) == rows(new)
    assert rows(h.state_as_of(feed, ["k"], 0)) == rows(old)
    assert rows(h.state_as_of(feed, ["k"], ts="2024-01-15")) == rows(old)
    assert rows(h.apply_feed(old, feed, ["k"], 0)) == rows(new)


def test_feed_kinds(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, None, 2), (3, "c", 3)], DDL)
    new = spark.createDataFrame([(1, "a", 1), (2, "v", 2), (4, "d", 4)], DDL)
    kinds = {(r["k"], r["_change_type"]) for r in h.change_feed(old, new, ["k"], 1, "2024-01-01").collect()}
    assert kinds == {(2, h.PRE), (2, h.POST), (3, h.DELETE), (4, h.INSERT)}


def test_first_bad_version(spark):
    v0 = spark.createDataFrame([(1, "a", 1)], DDL)
    v1 = spark.createDataFrame([(1, "a", 1), (2, None, 2)], DDL)
    v2 = spark.createDataFrame([(1, "a", 1), (2, "ok", 2)], DDL)
    feed = h.initial_feed(v0, 0, "2024-01-01").unionByName(h.change_feed(v0, v1, ["k"], 1, "2024-01-02")).unionByName(
        h.change_feed(v1, v2, ["k"], 2, "2024-01-03"))
    assert tuple(h.first_bad_version(feed, "a IS NOT NULL").first()) == (1, 1)
    assert h.first_bad_version(feed, "k > 0").isEmpty()


def test_scd2_refuses_a_key_twice(spark):
    dim = h.open_history(spark.createDataFrame([(1, "a")], "k int, v string"), "2024-01-01")
    twice = spark.createDataFrame([(1, "b"), (1, "c")], "k int, v string")
    with pytest.raises(AmbiguousMerge):
        h.scd2(dim, twice, ["k"], ["v"], "2024-02-01")
    assert h.current(h.scd2(dim, twice.limit(1), ["k"], ["v"], "2024-02-01")).count() == 1
