"""Hosts whose pages are made by more than one template."""

from spindrift.llm import html_extract


def test_minority_template_keeps_its_article(spark):
    story = lambda i: " ".join(f"Sentence {k} of story {i} is plain." for k in range(20))
    usual = [f"<body><div class=content><p>{story(i)}</p></div></body>" for i in range(9)]
    other = f"<body><div class=content>Short intro.</div><article><p>{story(9)}</p></article></body>"
    pages = [*usual, other]
    rows = [(i, f"http://two.org/{i}", page) for i, page in enumerate(pages)] + [(10 + i, None, page) for i, page in enumerate(pages)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = {r.page_id: r.text for r in html_extract.main_text(df).collect()}
    assert got == {i: story(i % 10) for i in range(20)}


def test_host_path_wins_over_a_longer_frame():
    story = "<p>" + "Plain words. " * 30 + "</p>"
    page = f"<body><div class=content>{story}</div><div class=more>" + "<p>" + "Other words. " * 10 + "</p></div></body>"
    assert html_extract.Page(page).text("body>div.content") == " ".join(("Plain words. " * 30).split())
