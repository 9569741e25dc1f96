"""Periodic runs, decontamination and whitening beside brute force, with nulls, empty and long texts, ties, repeated rows, empty tables and clashing names."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from spindrift.llm import decontamination, periodic_runs, whitening
from spindrift.llm.queries import QUERIES
from tests.conftest import SF


def plain_runs(x, shortest=12):
    """Every maximal stretch of every period, of equal stretches the least period."""
    n, best = len(x), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            s = i
            while i + q < n and x[i] == x[i + q]:
                i += 1
            if i + q - s >= max(shortest, 2 * q):
                best.setdefault((s, i + q - s), q)
            i += 1
    return sorted(((s, length, q) for (s, length), q in best.items()), key=lambda r: (r[0], r[2]))


def sequences(count):
    rng = random.Random(7)
    for _ in range(count):
        n, kind = rng.randint(0, 130), rng.random()
        if kind < 0.4:
            yield [rng.randint(0, rng.choice([0, 1, 2])) for _ in range(n)]
        elif kind < 0.8:
            x = []
            while len(x) < n:
                x += [rng.randint(0, rng.choice([1, 2, 9])) for _ in range(rng.randint(1, 9))] * rng.randint(1, 6)
                if rng.random() < 0.3:
                    x += x[-rng.randint(1, 30):] * rng.randint(1, 3)
            yield x
        else:  # progressions that meet, and Fibonacci words
            a, b = [0], [0, 1]
            for _ in range(rng.randint(3, 8)):
                a, b = b, b + a
            yield rng.choice([b + [rng.randint(0, 2)] + b, [0, 1] * rng.randint(0, 12) + [0] + [0, 1] * rng.randint(0, 12) + [0, 0]])


def test_runs_of_sequences():
    for x in [*sequences(1500), [1, 0, 1, 0, 1, 0, 1, 0, 0, 1, 0, 1, 0, 1, 0, 1, 0], list(range(40)) * 4, [3] * 500]:
        assert [tuple(r) for r in periodic_runs.runs_of(np.array(x, dtype=np.int64)).tolist()] == plain_runs(x), x
    with pytest.raises(ValueError):
        periodic_runs.runs_of(np.zeros(20, dtype=np.int64), 5)


def expected_runs(key, text, rewrite):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(key).encode()) if key is not None else 1
    if rewrite and h % 10 == 0 and w:
        g, n = h // 10, len(w)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(w)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    return (
        len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
        hashlib.sha256("".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()).hexdigest(),
        hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest(),
    )


def test_runs_of_documents(spark):
    texts = [None, "", " \t\n", "one word", "la " * 50, "é 中 x " * 9, " ".join(f"w{i}" for i in range(200)), "a b " * 5 + "a a " + "b a " * 8]
    texts += [" ".join(map(str, x)) for x in sequences(40)]
    rows = [(i, t, "clash", 3) for i, t in enumerate(texts)] + [(None, "x y " * 20, "c", 1), (4, "la " * 50, "c", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, runs string, n_words int").repartition(3)
    for rewrite in (None, periodic_runs.repeat_tail):
        made = periodic_runs.run_digests(periodic_runs.periodic_runs(df, rewrite=rewrite)).collect()
        assert sorted(map(repr, map(tuple, made))) == sorted(repr((k, *expected_runs(k, t, rewrite))) for k, t, *_ in rows)
    assert periodic_runs.run_digests(periodic_runs.periodic_runs(df.filter("false"))).count() == 0
    long = spark.createDataFrame([(1, " ".join(f"w{i % 5000}" for i in range(300_000)))], "doc_id long, text string")
    found = periodic_runs.periodic_runs(long).first()
    assert [tuple(r) for r in found.runs] == [(0, 300_000, 5000)] and len(found.collapsed.split()) == 5000 and found.n_words == 300_000


def test_runs_query_is_whole(spark, tables):
    made = {r.doc_id: tuple(r)[1:] for r in QUERIES["op13_periodic_runs"](spark, SF).collect()}
    short = [r for r in tables.documents.collect() if len(r.text.split()) < 400]
    assert len(made) == tables.documents.count() and len(short) > 50
    assert all(made[r.doc_id] == expected_runs(r.doc_id, r.text, True) for r in short)


def split(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))


def plain_contamination(text, items, words=10):
    own, hit, found = split(text), set(), set()
    for item, body in items:
        w = split(body)
        size = min(words, len(w))
        if item is None or not size:
            continue
        wanted = {tuple(w[i:i + size]) for i in range(len(w) - size + 1)}
        for i in range(len(own) - size + 1):
            if tuple(own[i:i + size]) in wanted:
                hit |= set(range(i, i + size))
                found.add(str(item))
    return len(own), len(hit), len(found), sorted(found), bool(hit)


def test_contamination_equals_brute_force(spark):
    rng = random.Random(5)
    some = [f"w{i}" for i in range(30)]
    items = [(i, " ".join(rng.choices(some, k=rng.choice([1, 2, 3, 5, 9, 10, 11, 25, 40])))) for i in range(25)]
    items += [(25, None), (26, ""), (27, "!? --"), (28, items[3][1]), (28, items[4][1]), (None, "w1 w2"), (29, "Dup dup DUP " * 8), (30, "é中 12x")]
    docs = [(1, None), (2, ""), (3, "..."), (None, "É Dup dup dup dup dup dup dup dup dup dup dup"), (4, "é中-12X é中 12"), (4, "nothing at all"), (4, "nothing at all")]
    for i in range(60):
        body = rng.choices(some, k=rng.randint(0, 80))
        for _ in range(rng.randint(0, 3)):
            w = split(rng.choice(items)[1])
            a = rng.randint(0, len(w))
            at = rng.randint(0, len(body))
            body[at:at] = w[a:a + rng.randint(1, 30)]
        docs.append((100 + i, rng.choice([" ", ", ", " - "]).join(w.upper() if rng.random() < 0.2 else w for w in body)))
    docs.append((999, " ".join(rng.choices(some, k=60_000)) + " " + items[0][1]))
    d = spark.createDataFrame([(*r, "x", 1) for r in docs], "doc_id long, text string, row string, item int").repartition(3)
    b = spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, window int")
    made = decontamination.contamination(d, b).collect()
    want = [(k, *plain_contamination(t, items)) for k, t in docs]
    assert sorted(repr(tuple(r)) for r in made) == sorted(map(repr, want)) and sum(w[-1] for w in want) > 20
    none = decontamination.contamination(d, b.filter("false")).collect()
    assert len(none) == len(docs) and not any(r.contaminated or r.n_hit for r in none)
    assert decontamination.contamination(d.filter("false"), b).count() == 0


def test_contamination_by_share(spark):
    item = "a b c d e f g h i j"
    docs = [(1, "x a b c d e f g h i j y"), (2, "x a b c d e f g h i Z y"), (3, "a b c d e Q g h i j"), (4, "a b c"), (5, "b c d e f g h i j k")]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(7, item)], "item_id long, text string")
    # eight shingles: all, seven, five, none that fits, none in place
    for percent, want in ((100, {1}), (85, {1, 2}), (60, {1, 2, 3})):
        assert {r.doc_id for r in decontamination.contamination(d, b, percent=percent).collect() if r.contaminated} == want
    _, spans = decontamination.contaminated_spans(d, b, percent=85)
    assert {(r.start, r.length, r.item) for r in spans.collect()} == {(1, 10, 7)}
    with pytest.raises(ValueError):
        decontamination.contaminated_spans(d, b, percent=0)


def whitened_rows(spark, vectors, **options):
    df = spark.createDataFrame([(i, v, "x", 2) for i, v in vectors], "vec_id long, embedding array<double>, component string, n int").repartition(3)
    return whitening.whitened(df, **options).collect()


def test_whitening_equals_dense_eigenvectors(spark):
    rng = np.random.default_rng(3)
    body = rng.standard_normal((300, 12)) * np.linspace(0.4, 1.2, 12)
    vectors = [(i, v.tolist()) for i, v in enumerate(body)]
    vectors += [(0, vectors[0][1])] * 5 + [(None, vectors[7][1]), (900, None), (901, []), (902, [None] * 12), (903, [math.nan] * 12), (904, [math.inf] * 12), (905, [1.0, 2.0])]
    made = whitened_rows(spark, vectors)
    x = np.floor(256 * body).astype(np.int64)
    n, sums = len(x), x.sum(axis=0)
    centred = x - sums / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    assert len(made) == 4 * (300 + 5 + 1) and {r.n for r in made} == {n}
    for k in range(4):
        e, axis = values[-1 - k], axes[:, -1 - k]
        own = {r.vec_id: r for r in made if r.component == k + 1}
        scores = centred @ axis / np.sqrt(e)
        sign = np.sign(own[0].whitened * scores[0])
        assert all(abs(own[i].whitened - sign * scores[i]) < 1e-9 for i in range(300))
        assert all(own[i].deviation == sum((n * int(a) - int(b)) ** 2 for a, b in zip(x[i], sums)) for i in range(300))
        assert abs(own[0].explained - e / values.sum()) < 1e-12 and own[0].identity_error < 1e-9
    assert {r.whitened for r in made if r.vec_id is None and r.component == 1} == {r.whitened for r in made if r.vec_id == 7 and r.component == 1}


def test_whitening_of_unusual_tables(spark):
    assert whitened_rows(spark, [(1, None)]) == [] and whitened_rows(spark, [(1, [0.5, 1.0])] * 9) == []
    flat = whitened_rows(spark, [(i, [float(i), 2.0 * i, 0.0]) for i in range(10)])  # one direction
    assert {r.component for r in flat} == {1} and flat[0].identity_error < 1e-9 and abs(flat[0].explained - 1) < 1e-12
    equal = whitened_rows(spark, [(2 * k + s, [float((-1) ** s * (k == j)) for j in range(6)]) for k in range(6) for s in range(2)])  # six equal eigenvalues
    assert len(equal) == 12 * 4 and equal[0].identity_error < 1e-9 and all(abs(r.explained - 1 / 6) < 1e-9 for r in equal)
    huge = whitened_rows(spark, [(i, [1e14 * i, -3.0, 1.0 * (i % 3)]) for i in range(6)])
    assert len(huge) >= 6 and huge[0].deviation is None
    one = whitened_rows(spark, [(i, [float(i)]) for i in range(4)])
    assert len(one) == 4 and one[0].identity_error < 1e-9


@pytest.mark.parametrize("dimension", [3, 40, 150])
def test_leading_pairs(dimension):
    rng = np.random.default_rng(dimension)
    turn = np.linalg.qr(rng.standard_normal((dimension, dimension)))[0]
    values = np.sort(np.concatenate((np.linspace(1, 1.2, dimension - 1), [1.2])))[::-1]  # a double largest one, the rest close together
    matrix = (turn * values) @ turn.T
    found, axes = whitening.leading(lambda x: matrix @ x, dimension, 4)
    assert np.abs(found - values[: len(found)]).max() < 1e-11 and len(found) == min(4, dimension)
    assert np.abs(matrix @ axes - axes * found).max() < 1e-12 and np.abs(axes.T @ axes - np.eye(len(found))).max() < 1e-12


def test_hot_vector_counts_once(spark):
    df = spark.createDataFrame([(i, [1.0, 2.0] if i % 3 else [float(i), float(i * i % 7)]) for i in range(90)], "vec_id long, embedding array<double>")
    n = len({tuple(r.embedding) for r in df.collect()})
    assert {r.n for r in whitening.whitened(df.withColumn("scaled", F.lit(1)).withColumn("vector", F.lit(1))).collect()} == {n}
