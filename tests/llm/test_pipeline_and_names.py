"""Every stage of the pipeline beside plain Python, and helper names that the input may bear."""

import collections
import math
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from spindrift.llm import bpe, exact_dedup, html_extract, jaccard_join, mixing, quality_classifier, quality_rules, url_filter, word_pieces

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)}).encode().split()


def shingles(text, size=5):
    w = words(text)
    return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(4)
    rows = []
    for i in range(60):
        body = [f"w{rng.randrange(400)}" for _ in range(rng.randint(30, 80))]
        rows.append((i, " ".join(body)))
        for _ in range(rng.choice([0, 0, 1, 3])):  # near copies, with the same and with other ids
            near = body.copy()
            near[rng.randrange(len(near))] = "changed"
            rows.append((rng.choice([i, 1000 + len(rows), None]), " ".join(near)))
    rows += [(500, "only one"), (500, "another text under the same id"), (501, rows[0][1].upper()), (502, None), (503, ""), (503, " \n "), (None, "no id at all here"), (None, None)]
    made = [(i, t, "en", rng.choice(["a", "b", None]), len(t or "")) for i, t in rows]
    return spark.createDataFrame(made, COLUMNS).repartition(3)


def rows_of(df):
    return collections.Counter((r.doc_id, r.text) for r in df.collect())


def test_quality_stage_keeps_what_the_scores_accept(spark, tables):
    kept = corpus_pipeline.quality(spark, tables.documents, tables.root)
    weights = quality_classifier.train(tables.documents, tables.labels)
    features = quality_classifier.Features(quality_classifier.Settings())
    want = collections.Counter()
    for r in tables.documents.collect():
        at, values = features(r.text or "")
        z = float(sum(float(weights[a]) * float(v) for a, v in zip(at, values)) + float(weights[-1]))
        if 1 / (1 + math.exp(-z)) >= 0.7:
            want[(r.doc_id, r.text)] += 1
    assert kept.columns == tables.documents.columns and rows_of(kept) == want and 0 < sum(want.values()) < tables.documents.count()
    label = {r.doc_id: r.quality for r in tables.labels.collect()}
    ids = {k for k, _ in want}
    assert sum(v == (k in ids) for k, v in label.items()) >= 0.9 * len(label)


def test_exact_stage(spark, docs):
    kept = corpus_pipeline.exact_copies(spark, docs, "")
    best = {}
    for r in docs.collect():
        body = (r.text or "").translate({c: c + 32 for c in range(65, 91)})
        best.setdefault(body, []).append(-1 if r.doc_id is None else r.doc_id)
    got = [((r.text or "").translate({c: c + 32 for c in range(65, 91)}), -1 if r.doc_id is None else r.doc_id) for r in kept.collect()]
    assert sorted(got) == sorted((b, max(ids)) for b, ids in best.items()) and kept.columns == docs.columns


def test_near_stage_drops_rows_not_ids(spark, docs):
    kept = corpus_pipeline.near_copies(spark, docs, "")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    sets, parent = [shingles(t) for _, t in rows], list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= 80 * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    groups = collections.defaultdict(list)
    for i, row in enumerate(rows):
        groups[root(i)].append(row)
    left = rows_of(kept)
    assert sum(left.values()) == len(groups) and kept.columns == docs.columns
    for members in groups.values():
        least = min((m[0] for m in members if m[0] is not None), default=None)
        assert any(left[m] for m in members if m[0] == least)
    assert left[(500, "only one")] == left[(500, "another text under the same id")] == 1  # an id dropped a row with a text of its own before


def test_row_numbers_hold(spark, docs, tmp_path):
    path = f"file://{tmp_path}/docs"
    docs.write.parquet(path)
    for table in (spark.read.parquet(path), docs):  # a table of files, and one that is not
        rows = corpus_pipeline.numbered(table, "_row")
        first = {r._row: (r.doc_id, r.text) for r in rows.collect()}
        assert len(first) == docs.count()
        spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
        try:  # other splits of the files change nothing
            assert {r._row: (r.doc_id, r.text) for r in rows.select("_row", "doc_id", "text").collect()} == first
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_mixing_and_encoding_stages(spark, docs):
    mixed = corpus_pipeline.mixed(spark, docs, "")
    plan = {(r.doc_id, r.text): r for r in mixing.mix(docs).collect()}
    made = rows_of(mixed)
    assert mixed.columns == docs.columns and set(made) <= set(plan)
    per = collections.Counter((r.doc_id, r.text) for r in docs.collect())
    assert all(made[k] <= 3 * per[k] for k in per)
    sizes, taken, targets = collections.Counter(), collections.Counter(), {}
    for r in mixing.mix(docs).collect():
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        targets[r.source] = r.target
    assert all(abs(taken[s] - targets[s]) <= 80 for s in sizes) and sum(n * len(words(t)) for (_, t), n in made.items()) == sum(taken.values())
    coded = corpus_pipeline.encoded(spark, docs, "").collect()
    assert len(coded) == docs.count() and all(r.exact and r.n_tokens == len(r.ids) for r in coded)


def test_stages_take_empty_tables(spark, docs, tables):
    none = docs.filter("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, tables.root).count() == 0


HELPERS = ("_id _value _path _run _group _row _bytes _own _source _draw _bin _more _html _host _of _body _none _turn _canonical _kept _whole _extra _end _before row node "
           "region keys group member scaled hits words window item start").split()


def test_helper_names_do_not_clash(spark):
    text = "some words of a text to read"
    df = spark.createDataFrame([(i, text + f" {i}", "s", f"http://h.org/{i}", f"<p>{text} {i}</p>") for i in range(4)], "doc_id long, text string, source string, url string, html string")
    wide = df.select("*", *[F.lit(f"kept {h}").alias(h) for h in HELPERS])
    weights = quality_classifier.train(wide, spark.createDataFrame([(1, 1)], "doc_id long, quality int"))
    made = {
        "mix": mixing.mix(wide), "repeated": mixing.repeated(mixing.mix(wide)), "dedup": exact_dedup.exact_duplicates(wide), "lines": quality_rules.judge_lines(wide),
        "html": html_extract.main_text(wide.drop("text")), "urls": url_filter.judge_urls(wide), "bpe": bpe.encode(wide), "score": quality_classifier.score(wide, weights),
    }
    for what, result in made.items():
        rows = result.collect()
        assert len(rows) == 4 or what == "repeated", what
        for h in HELPERS:
            assert h not in result.columns or {r[h] for r in rows} == {f"kept {h}"}, (what, h)
        assert set(HELPERS) <= set(result.columns), what
    assert word_pieces.token_counts(wide).count() == 4 == jaccard_join.jaccard_groups(wide).count()
