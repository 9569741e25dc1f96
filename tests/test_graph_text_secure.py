"""Graph reach and components, linkage, text pieces, roles, nested helpers."""

import random

import pytest
from pyspark.sql import functions as F

from spindrift.functions import masks, nested
from spindrift.functions.dates import date_dim, date_range_predicate
from spindrift.operators import graph, secure, text, vector
from spindrift.operators.secure import RolePolicy


def brute_components(edges):
    label = {n: n for e in edges for n in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return label


@pytest.mark.parametrize("edges", [
    [(i, i + 1) for i in range(12)], [(1, 2), (2, 3), (3, 1), (10, 11), (7, 7)],
    [(random.Random(4).randrange(40), j) for j in range(40)], [(0, i) for i in range(1, 30)] + [(100, 101)],
])
def test_components(spark, edges):
    df = spark.createDataFrame(edges, "src long, dst long")
    assert {r["node"]: r["component"] for r in graph.components(df).collect()} == brute_components(edges)


def test_reach_ends_on_cycles(spark):
    df = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("x", "y")], "src string, dst string")
    start = spark.createDataFrame([("a",)], "node string")
    assert {r["node"]: r["depth"] for r in graph.impact(df, start).collect()} == {"a": 0, "b": 1, "c": 2, "d": 3}
    end = spark.createDataFrame([("d",)], "node string")
    assert {r["node"] for r in graph.upstream(df, end).collect()} == {"a", "b", "c", "d"}


def test_link_counts_without_pairs(spark):
    rnd = random.Random(1)
    rows = [(i, rnd.choice([None, 1, 2, 3, 4]), rnd.choice("abc"), rnd.choice([None, *range(8)])) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, a int, b string, c int")
    got = {r["id"]: (r["link_count"], r["distinct_links"]) for r in graph.link_counts(df, "id", ["a", "b", "c"]).collect()}
    for row in rows:
        shared = [sum(x is not None and x == y for x, y in zip(row[1:], other[1:])) for other in rows if other[0] != row[0]]
        assert got[row[0]] == (sum(shared), sum(n > 0 for n in shared))


@pytest.mark.parametrize("size,overlap", [(3, 0), (4, 1), (5, 4)])
def test_chunks_cover_whole_text(spark, size, overlap):
    docs = {i: " ".join(f"w{j}" for j in range(i)) for i in range(0, 14)}
    df = spark.createDataFrame([(k, f"  {v}\n") for k, v in docs.items()], "id int, t string")
    pieces = {}
    for r in text.chunk_text(df, "id", "t", size, overlap).orderBy("id", "chunk_no").collect():
        pieces.setdefault(r["id"], []).append(r["chunk"].split())
    for k, words in docs.items():
        words = words.split()
        want = []
        step = size - overlap
        at = 0
        while words and (at == 0 or at + overlap < len(words)):
            want.append(words[at:at + size])
            at += step
        assert pieces.get(k, []) == want


def test_classify_order_and_null(spark):
    df = spark.createDataFrame([("Refund my LOGIN",), ("a bug",), ("hello",), (None,)], "t string")
    assert [r[0] for r in df.select(text.classify("t")).collect()] == ["Billing", "Technical Issue", "General Inquiry", None]


def test_entities_and_redaction(spark):
    t = "Mail a.b@c.org on 2024-01-02 about v1.2.3 and $1,200.50, call +1 415-555-0100, id 123-45-6789"
    row = text.extract_entities(spark.createDataFrame([(t,)], "t string"), "t").first()
    assert (row["emails"], row["dates"], row["versions"], row["amounts"]) == (["a.b@c.org"], ["2024-01-02"], ["v1.2.3"], ["$1,200.50"])
    clean = spark.createDataFrame([(t,)], "t string").select(text.redact_text("t")).first()[0]
    assert "[EMAIL]" in clean and "[SSN]" in clean and "[PHONE]" in clean and "415" not in clean


def test_vector_blocks_agree(spark):
    rnd = random.Random(2)
    vec = lambda: [rnd.uniform(-1, 1) for _ in range(6)]
    corpus = spark.createDataFrame([(i, vec()) for i in range(60)], "vec_id long, embedding array<double>")
    queries = spark.createDataFrame([(i, vec()) for i in range(7)], "query_id long, embedding array<double>")
    one = vector.top_k(queries, corpus, 3).orderBy("query_id", "rank").collect()
    many = vector.top_k(queries, corpus, 3, max_queries=5).orderBy("query_id", "rank").collect()
    assert len(one) == 21 and [(r["query_id"], r["vec_id"]) for r in one] == [(r["query_id"], r["vec_id"]) for r in many]
    repeated = queries.union(queries).union(spark.createDataFrame([(None, vec()), (9, None)], queries.schema))
    again = vector.top_k(repeated, corpus.union(spark.createDataFrame([(99, None)], corpus.schema)), 3, max_queries=3)
    assert [(r["query_id"], r["vec_id"]) for r in again.orderBy("query_id", "rank").collect()] == [(r["query_id"], r["vec_id"]) for r in one]


POLICY = {"boss": RolePolicy(), "clerk": RolePolicy("dept = 'a'", {"pay": masks.redact}, columns=["id", "pay"])}


def test_roles(spark):
    df = spark.createDataFrame([(1, "a", "10"), (2, "b", "20"), (3, None, "30")], "id int, dept string, pay string")
    assert secure.secure_view(df, POLICY, "boss").count() == 3
    assert [tuple(r) for r in secure.secure_view(df, POLICY, "clerk").collect()] == [(1, "REDACTED")]
    assert secure.secure_view(df, POLICY, "stranger").count() == 0
    assert all(v is None for r in secure.apply_masks(df, POLICY, "stranger").collect() for v in r)


def test_masks(spark):
    row = spark.createDataFrame([("123-45-6789", "joan@x.org", "555-0100", 5432.1)], "s string, e string, p string, b double").select(
        masks.mask_ssn("s"), masks.mask_email("e"), masks.mask_phone("p"), masks.mask_band("b", 1000)).first()
    assert tuple(row) == ("***-**-6789", "jo***@x.org", "***-***-0100", "5000-5999")


def test_flatten_and_zscore(spark):
    df = spark.sql("SELECT struct(1 AS a, struct(2 AS b, struct(3 AS c) AS d) AS e) AS s, array(1D, 2D, 3D) AS xs, array(5D, 5D) AS flat, "
                   "cast(array() AS array<double>) AS none, cast(NULL AS array<double>) AS missing")
    assert nested.flatten_struct(df.select("s")).columns == ["s_a", "s_e_b", "s_e_d_c"]
    z = df.select(nested.array_zscore(F.col("xs")), nested.array_zscore(F.col("flat")), nested.array_zscore(F.col("none")),
                  nested.array_zscore(F.col("missing"))).first()
    assert [round(x, 4) for x in z[0]] == [-1.2247, 0.0, 1.2247] and z[1] == [None, None] and z[2] == [] and z[3] is None


def test_row_hash_tells_null_from_empty(spark):
    df = spark.createDataFrame([(None,), ("",)], "a string")
    assert df.select(nested.row_hash(["a"])).distinct().count() == 2


def test_dates(spark):
    assert date_dim(spark, "2024-02-27", "2024-03-02").count() == 5
    with pytest.raises(ValueError):
        date_range_predicate("d", "week", "2024-01")
