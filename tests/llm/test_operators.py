"""The operators on small tables with nulls, empty and long texts, ties, repeated rows and clashing columns, beside brute force."""

import collections
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from spindrift.llm import bpe, exact_dedup, html_extract, jaccard_join, mixing, quality_classifier, quality_rules, url_filter, warc, word_pieces
from spindrift.llm.queries import ORACLES, QUERIES
from tests.conftest import SF
from tests.oracle import canon, connect

TEXTS = [
    (1, "a b c d e f g h", "s1"), (2, "A b c d e f g h", "s1"), (3, None, None), (4, "", "s2"), (5, "   \n\t", "s2"), (6, "one two", "s3"),
    (7, "ONE two", "s3"), (8, "the same line here\n" * 400, "s1"), (9, "é中👍 <|endoftext|> x's 12 3", "s4"), (9, "é中👍 <|endoftext|> x's 12 3", "s4"),
    (None, "a b c d e f g h", "s1"), (10, " ".join(f"w{i}" for i in range(3000)), "s5"),
    (11, " ".join(f"w{i}" for i in range(2990)) + " new words at the end", "s5"), (12, "\x00 \x1c\u00a0\u2003 odd", None),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(*r, "x", 0.5, True, i) for i, r in enumerate(TEXTS)]
    kinds = "doc_id long, text string, source string, kept string, score double, ids boolean, `size` long"
    return spark.createDataFrame(rows, kinds).repartition(3)


@pytest.fixture(scope="module")
def none(docs):
    return docs.filter("false")


def words(text):
    return (text or "").encode().split()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracles(spark, name):
    df = QUERIES[name](spark, SF)
    cursor = connect(SF).execute(ORACLES[name])
    assert canon(df.columns, df.collect()) == canon([d[0] for d in cursor.description], cursor.fetchall())


def test_bpe_equals_tokenizers(docs, none):
    from tokenizers import Tokenizer

    own, other = bpe.Codec(bpe.TOKENIZER), Tokenizer.from_file(bpe.public_file(bpe.TOKENIZER))
    rng = random.Random(3)
    parts = ["a", "the", " ", "  ", "\n", "=", "aaaa", "é", "中", "👍", "\u0558", "\U0001e6c0", "<|endoftext|>", "'s", "1", "\x1c", "\u00a0", "ing", "\x00"]
    for _ in range(600):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 60)))
        ids = other.encode(text, add_special_tokens=False).ids
        assert own.encode(text).tolist() == ids
        assert own.decode(ids).decode("utf-8", "replace") == other.decode(ids, skip_special_tokens=False)
    made = bpe.decode(bpe.encode(docs)).collect()
    assert len(made) == len(TEXTS) and all(r.exact and r.decoded == (r.text or "") and r.n_tokens == len(r.ids) for r in made)
    assert bpe.encode(none).count() == 0 == bpe.encoding_digests(none).count()
    digest = bpe.encoding_digests(docs).filter("doc_id = 3").first()
    assert (digest.n_tokens, digest.ids_sha256) == (0, hashlib.sha256(b"").hexdigest())


def test_word_pieces_are_greedy(docs, none):
    tokens = set(bpe.vocabulary(bpe.TOKENIZER)[0])

    def greedy(word, tokens=tokens):
        n = 0
        while word:  # first the longest piece that starts a word, then the longest that continues one
            size = next(k for k in range(len(word), 0, -1) if (word[:k] if n else b" " + word[:k]) in tokens or k == 1)
            word, n = word[size:], n + 1
        return n

    for row in docs.select("doc_id", "text").join(word_pieces.token_counts(docs).select(F.col("doc_id").alias("d"), "n_words", "n_pieces"), F.expr("doc_id = d")).collect():
        assert (row.n_words, row.n_pieces) == (len(words(row.text)), sum(map(greedy, words(row.text))))
    few = {b" ab", b"abcde", b"bc", b" bcd", b"cd", b"abcd", b" abcdea", b"ea", b" "}
    small = word_pieces.PieceCounter(few)
    for seed in range(1500):
        word = bytes(random.Random(seed).choices(b"abcdez", k=seed % 17))
        assert small.count(word) == greedy(word, few)
    assert word_pieces.token_counts(none).count() == 0


def brute_groups(rows, size=4):
    def grams(text):
        w = (text or "").encode().lower().split()
        return frozenset([tuple(w)] if 0 < len(w) < size else [tuple(w[i:i + size]) for i in range(len(w) - size + 1)])

    sets = [grams(t) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                group = [group[j] if g == group[i] else g for g in group]
    least = collections.defaultdict(list)
    for (key, _), g in zip(rows, group):
        least[g] += [key] if key is not None else []
    return sorted(
        ((key, len(s), (min(least[g], default=None) if s else key)) for (key, _), s, g in zip(rows, sets, group)), key=repr
    )


def test_jaccard_groups(spark, docs, none):
    rng = random.Random(5)
    rows = [(r[0], r[1]) for r in TEXTS]
    base = [f"v{rng.randint(0, 60)}" for _ in range(120)]
    for i in range(150):  # near copies around the threshold, over one common passage
        own = list(base)
        for _ in range(rng.randint(0, 5)):
            own[rng.randrange(len(own))] = f"u{rng.randint(0, 400)}"
        rows.append((100 + i, " ".join(own)))
    for i in range(60):
        rows.append((400 + i, " ".join([*base[:15], *(f"z{rng.randint(0, 30)}" for _ in range(rng.randint(1, 40)))])))
    found = jaccard_join.jaccard_groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found), key=repr) == brute_groups(rows)
    assert jaccard_join.jaccard_groups(none).count() == 0
    assert jaccard_join.jaccard_groups(docs).count() == len(TEXTS)


def test_exact_duplicates(docs, none):
    found = exact_dedup.exact_duplicates(docs).collect()
    lower = lambda t: (t or "").encode().lower()
    groups = collections.defaultdict(list)
    for key, text, _ in TEXTS:
        groups[lower(text)].append(key)
    assert len(found) == len(TEXTS) and sum(r.kept for r in found) == len(groups)
    for r in found:
        keys = groups[lower(r.text)]
        assert r.group_size == len(keys) and r.keep_id == max((k for k in keys if k is not None), default=None)
        assert not r.kept or r.doc_id == r.keep_id
        assert r.text_sha256 == hashlib.sha256(lower(r.text)).hexdigest()
    assert exact_dedup.exact_duplicates(none).count() == 0


def test_radix_rounds(spark):
    rng = random.Random(1)
    heads = ["x" * 63, "x" * 64, "x" * 65, "y" * 575, "y" * 576, "y" * 577, "z" * 5000]
    rows = [(i, rng.choice(heads) + rng.choice(["", "a", "b"])) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    sizes = collections.Counter(t for _, t in rows)
    assert all(r.group_size == sizes[r.text] for r in exact_dedup.exact_duplicates(df).collect())


def test_mixing(docs, none):
    got = mixing.mix(docs).collect()
    assert len(got) == len(TEXTS) and mixing.mix(none).count() == 0
    assert sorted(map(repr, got)) == sorted(map(repr, mixing.mix(docs.repartition(7)).collect()))
    by_source = collections.defaultdict(list)
    for r in got:
        by_source[r.source].append(r)
        assert r.taken == r.size * r.repeats and 0 <= r.taken <= 3 * r.size and r.size == len(words(r.text))
    for rows in by_source.values():
        assert rows[0].target <= 3 * rows[0].source_size
        assert abs(sum(r.taken for r in rows) - rows[0].target) <= max(r.size for r in rows)
    assert mixing.repeated(mixing.mix(docs)).count() == sum(r.repeats for r in got)


def test_url_rules(spark):
    urls = [
        None, "", "no host", "http://", "http://A.com", "http://A.com/", "https://example.com/en/x?y", "http://xexample.com/en/", "ftp://a.www.Example.com/en/#f",
        "http://n.net/es/", "http://n.net/es", "http://b.org/x.example.com/en/", "http://spam.org/", "x://y://example.com/en/", "http://net/fr/" + "q" * 5000,
    ]
    df = spark.createDataFrame(list(enumerate(urls)) + [(1, "")], "page_id long, url string").withColumn("rule", F.lit(1))
    got = {r.page_id: r for r in url_filter.judge_urls(df).collect()}
    assert [got[i].rule for i in range(len(urls))] == [
        None, None, None, None, None, "com/", "example.com/en/", "com/", "www.example.com/en/", "net/es/", None, None, None, None, "net/fr/"
    ]
    assert {i for i, r in got.items() if r.verdict == "block"} == {6, 9, 12, 14}
    assert (got[4].host, got[4].path, got[0].host, got[13].host) == ("a.com", "", "", "y:")
    assert url_filter.judge_urls(df.filter("false")).count() == 0


def test_quality_rules(docs, none):
    got = {r.doc_id: r for r in quality_rules.judge_lines(docs).collect()}
    assert len(got) == len({k for k, *_ in TEXTS}) and quality_rules.judge_lines(none).count() == 0
    assert (got[8].n_words, got[8].n_dup_lines, got[8].n_repeat_words, got[8].kept) == (1600, 399, 1600, False)
    assert (got[3].n_words, got[3].word_chars, got[3].base_failed) == (0, 0, True)
    assert not got[10].base_failed and got[10].reason == "few letters"
    plain = "A plain sentence of some words.\nAnother one, as plain as that!\nshort\n"
    assert quality_rules.clean(plain)[1:4] == (3, 1, 1)
    for line in ("ภาษาไทยเป็นภาษาที่ไม่มีช่องว่างระหว่างคำ", "これは日本語の文で、", "हिन्दी में लिखा हुआ एक वाक्य", "နိုင်ငံတော်သစ်ကိုတည်ဆောက်", "今天天气很好我们去公园"):
        assert quality_rules.line_fault(line) is None, line
    assert quality_rules.line_fault("short") == "no sentence" and quality_rules.line_fault("年") == "no sentence" and quality_rules.line_fault("١٢٣٤ ٥٦٧٨") == "few letters"
    junk = "Home | News | Sport | Shop | Login\n" + "\n".join(f"THIS*** IS$$$ LINE%%% {i}###" for i in range(12))
    assert quality_rules.clean(junk)[0] == ""
    rng = random.Random(2)
    for _ in range(300):
        w = [rng.choice([b"a", b"b"]) for _ in range(rng.randint(0, 60))]
        seen = collections.defaultdict(list)
        for i in range(len(w) - 7):
            seen[tuple(w[i:i + 8])].append(i)
        assert quality_rules.repeated_words(w) == len({k for v in seen.values() if len(v) > 1 for i in v for k in range(i, i + 8)})


def test_classifier(spark, none):
    rng = random.Random(4)
    good = [" ".join(rng.choice(["sun", "rain", "tree", "house", "road"]) for _ in range(60)) for _ in range(300)]
    bad = [" ".join(rng.choice(["$$$", "!!!", "###", "WIN", "NOW"]) for _ in range(60)) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(good + bad)] + [(None, None), (900, ""), (901, "sun " * 50_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("x"))
    labels = spark.createDataFrame([(i, int(i < 300)) for i in range(360)] + [(None, 1), (5, None), (7, 1)], "doc_id long, quality int")
    weights = quality_classifier.train(df, labels)
    got = quality_classifier.score(df, weights).withColumn("held", quality_classifier.held_out(F.col("doc_id"))).collect()
    held = [r for r in got if r.held and r.doc_id < 360]
    assert held and sum(r.predicted == int(r.doc_id < 300) for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got) and len(got) == len(rows)
    assert not quality_classifier.train(df, labels.filter("false")).any()
    assert quality_classifier.score(none, weights).count() == 0


def test_warc(spark):
    long = "<p>é" + "x" * 1200
    rows = [(1, "http://a", long), (2, None, long), (3, "u\r\nv", None), (4, "b", "short"), (5, "b", "short"), (2, "b", long), (None, "c", long), (6, "d", "y" * 3_000_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("record_type", F.lit(0))
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.round_trip(df).collect()), key=repr)
    want = []
    for key, _, html in rows:
        raw = (html or "").encode()
        revisit = html == long and key != 2
        want.append((key, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response", 2 if revisit else None))
    assert got == sorted(want, key=repr)
    assert warc.round_trip(df.filter("false")).count() == 0


def test_warc_reader_rejects_cut_archives():
    import io

    digest = hashlib.sha1(b"abc").hexdigest()
    member = warc.gzip_member(warc.record("response", "1", "u", b"abc", None, digest))
    assert [warc.parsed(r)["payload"] for r in warc.Members(io.BytesIO(member * 3), piece=7)] == [b"abc"] * 3
    with pytest.raises(ValueError):
        list(warc.Members(io.BytesIO(member[:-12])))
    whole = warc.record("response", "1", "u", b"abc" * 1000, None, digest)
    for damaged in (whole[:-1], whole + b"x", whole.replace(b"WARC/", b"XARC/"), whole.replace(b"Content-Length: 3", b"Content-Length: 2"), whole + b"0" * 50_000_000):
        with pytest.raises(ValueError):
            list(warc.Members(io.BytesIO(warc.gzip_member(damaged))))
    wrong = warc.gzip_member(warc.record("response", "1", "u", b"abd", None, digest))
    assert [warc.parsed(r)["digest_ok"] for r in warc.Members(io.BytesIO(member + wrong), piece=5)] == [True, False]


@pytest.mark.parametrize("key", ["", " a ", "x\r\ny", "é>", "<urn:none>", None])
def test_warc_keeps_text_ids(spark, key):
    df = spark.createDataFrame([(key, "u", "page"), ("other", "u", "z" * 2000), ("zz", "u", "z" * 2000)], "page_id string, url string, html string")
    assert {(r.page_id, r.refers_to) for r in warc.round_trip(df).collect()} == {(key, None), ("other", "zz"), ("zz", None)}


def test_html(spark):
    article = "<article><h1>Title &amp; x</h1><p>Hello <b>wo</b>rld&nbsp;foo\n bar<br>z<p>two<ul><li>a<li>b</ul></article>"
    page = (
        "<html><body class='has-sidebar'><header><nav>menu</nav></header><div class='ad'>buy</div><aside>side</aside>" + article
        + "<div id=comments><p>nice " + "bla " * 200 + "</p></div><form><p>mail</p></form><script>'</p>'</script><footer>f</footer></body></html>"
    )
    rows = [(1, "http://h/a", page), (2, None, None), (3, "x", ""), (4, "http://h/b", page[: len(page) // 8]), (1, "http://h/a", page), (5, "http://k/", "plain &lt;text&gt;")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("old"))
    got = {r.page_id: r for r in html_extract.main_text(df).collect()}
    assert got[1].text == "Title & x Hello world foo bar z two a b" and got[1].n_chars == len(got[1].text)
    assert (got[2].text, got[3].text, got[5].text) == ("", "", "plain <text>")
    assert html_extract.main_text(df).count() == len(rows) and html_extract.main_text(df.filter("false")).count() == 0


def test_pipeline_keeps_clean_documents(spark):
    import corpus_pipeline

    kept = corpus_pipeline.run(spark, SF)
    assert kept.filter("NOT exact").isEmpty() and kept.count() > 0
