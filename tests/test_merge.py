"""Merge clauses, NULLs, repeated runs."""

import pytest

from spindrift.operators import merge as m
from spindrift.sources import ingest

DDL = "k int, v string, n int"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture()
def target(spark):
    return spark.createDataFrame([(1, "a", 1), (2, None, 2), (3, "c", None), (None, "z", 9)], DDL)


def test_first_clause_wins(spark, target):
    source = spark.createDataFrame([(1, "A", 10), (2, "B", 20), (3, "C", 30), (4, "D", 40), (None, "N", 50)], DDL)
    out = m.merge(target, source, ["k"], [
        m.delete(when="target.v = 'a'"), m.WhenMatched({"v": "concat(source.v, '!')"}, when="target.n > 1"),
        m.insert_all(when="source.n > 45"), m.WhenNotMatched({"k": "source.k", "v": "'new'"}),
    ])
    # a NULL key matches nothing, so that source row is inserted; a NULL condition is not met
    assert rows(out) == sorted([(2, "B!", 2), (3, "c", None), (None, "z", 9), (4, "new", None), (None, "N", 50)], key=repr)


def test_ambiguous_source(spark, target):
    doubled = spark.createDataFrame([(1, "x", 1), (1, "y", 1)], DDL)
    with pytest.raises(m.AmbiguousMerge):
        m.upsert(target, doubled, ["k"])
    unmatched = spark.createDataFrame([(7, "x", 1), (7, "y", 1)], DDL)
    assert m.upsert(target, unmatched, ["k"]).count() == 6


def test_upsert_twice_is_once(spark, target):
    source = spark.createDataFrame([(1, "x", 1), (5, "y", 1)], DDL)
    once = m.upsert(target, source, ["k"])
    assert rows(m.upsert(once, source, ["k"])) == rows(once)


def test_scope_leaves_others(spark, target):
    source = spark.createDataFrame([(1, "x", 1), (3, "x", 3)], DDL)
    out = m.merge(target, source.filter("k <= 2"), ["k"], [m.update_all(), m.insert_all()], target_pred="k <= 2")
    assert (3, "c", None) in rows(out) and (None, "z", 9) in rows(out) and (1, "x", 1) in rows(out)


def test_update_delete_null_predicate(target):
    assert (3, "c", None) in rows(m.update_where(target, "n > 0", {"v": "'u'"}))
    assert len(rows(m.delete_where(target, "n > 0"))) == 1


def test_replace_where(spark, target):
    new = spark.createDataFrame([(1, "r", 1)], DDL)
    assert rows(m.replace_where(target, new, "n = 1"))[0] == (1, "r", 1)
    with pytest.raises(ValueError):
        m.replace_where(target, new, "n = 2")


def test_guarded_upsert(spark):
    t = spark.createDataFrame([(1, 10, "old"), (2, 10, "old")], "k int, at int, v string")
    s = spark.createDataFrame([(1, 9, "late"), (2, 10, "same"), (3, 1, "new")], "k int, at int, v string")
    assert {(r["k"], r["v"]) for r in m.upsert_if_newer(t, s, ["k"], "at").collect()} == {(1, "old"), (2, "same"), (3, "new")}


def test_idempotent_ingest(spark, target):
    s = spark.createDataFrame([(1, "x", None), (8, "y", 1)], DDL)
    once = ingest.idempotent_ingest(target, s, ["k"])
    assert rows(ingest.idempotent_ingest(once, s, ["k"])) == rows(once)
    assert (1, "x", None) in rows(once)


def test_insert_missing(spark, target):
    s = spark.createDataFrame([(1, "x", 1), (9, "n", 1), (9, "n", 1)], DDL)
    once = m.insert_missing(target, s, ["k"])
    assert once.count() == 5 and (1, "a", 1) in rows(once)
    assert m.insert_missing(once, s, ["k"]).count() == 5


def test_erase_keys(spark, target):
    assert m.delete_keys(target, spark.createDataFrame([(1,), (2,)], "k int"), ["k"]).count() == 2
