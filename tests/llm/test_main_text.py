import html
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from topicgraph.llm import main_text as M

W = M.weights({("word:p", True): 5000, ("word:h1", True): 500, ("word:div", False): 600, ("<p>", True): 90, ("</p>", True): 90,
               ("box:nav", False): 50, ("box:footer", False): 60, ("class:ad", False): 60,
               ("<div>", False): 100, ("</div>", False): 100, ("<body>", False): 50})


def reading_by_the_mark(page):
    """The article's blocks, by its tags alone."""
    inner = re.search(r"(?s)<article>(.*?)</article>", page)[1]
    parts = re.split(r"</?(?:p|h1)\b[^>]*>", inner)
    parts = (" ".join(html.unescape(re.sub(r"<br>|</?b>", lambda m: " " if m[0] == "<br>" else "", x)).split()) for x in parts)
    return " ".join(x for x in parts if x)


def f1(got, want):
    got, want = Counter(got.split()), Counter(want.split())
    both = sum((got & want).values())
    return 2 * both / max(1, sum(got.values()) + sum(want.values()))


def test_region_against_all_stretches():
    rnd = random.Random(5)
    for _ in range(300):
        s = [rnd.choice([-3, -1, -0.5, 1, 2]) for _ in range(rnd.randrange(0, 25))]
        a, b = M.best_region(s)
        best = max([0.0] + [sum(s[i:j]) for i in range(len(s)) for j in range(i + 1, len(s) + 1)])
        assert abs(sum(s[a:b]) - best) < 1e-9


def test_pages():
    page = """<html><head><title>no</title><style>p{}</style><script>var t="</p><p>no";</script></head><body>
    <header class=top><h1>Site</h1></header><nav><ul><li><a href=x>no</a></ul></nav><div class="cookie-notice">no <p>no</p></div>
    <article><header><h1>The &eacute;ssay</h1></header><p>One<b> two</b><br>three&nbsp;four<p>five &lt;six&gt;
    seven<!-- no --></p><div class="ad">no</div><form><input> no</form><ul><li>eight</li><li>nine</li></ul>
    <div id="comments"><p>no</p></div><p>a < b and "c"</p></article>
    <div>plain but beside</div><aside>no</aside><footer>no</footer></body></html>"""
    assert M.main_text(page, W) == 'The éssay One two three four five <six> seven eight nine a < b and "c"'
    assert M.main_text(None, W) == M.main_text("", W) == M.main_text("<p></p>", W) == ""
    assert M.main_text("plain words only", W) == "plain words only"
    assert M.main_text("<div><p>Text of a page without any mark at all.</p></div><nav>no", W) == "Text of a page without any mark at all."
    assert M.main_text("<article><p>cut off <b>in the", W) == "cut off in the"
    assert M.main_text("<article><p class=ad>no<p>yes</article>", W) == "yes"
    long = "<article>" + "<p>word word</p>" * 100_000 + "</article>"
    assert M.main_text(long, W) == " ".join(["word word"] * 100_000)


def test_query_keeps_whole_articles(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").withColumn("text", F.lit(0))
    got = M.extract(pages).collect()
    assert len(got) == pages.count() and all(r.n_chars == len(r.text) for r in got)
    assert {r.page_id: r.text for r in got} == {r.page_id: reading_by_the_mark(r.html) for r in pages.collect()}


MARKS = r"<(/?)(?:article|main)\b[^>]*>"


@pytest.mark.parametrize("instead", ["", r"<\1div>", r"<\1section>"])
def test_pages_without_their_marks(spark, instead):
    """Half of the pages teach, the marks of the others are taken away."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    weight = M.learn(pages.filter("page_id % 2 = 0"))
    rest = pages.filter("page_id % 2 = 1").collect()
    bare = spark.createDataFrame([(r.page_id, r.url, re.sub(MARKS, instead, r.html)) for r in rest], pages.select("page_id", "url", "html").schema)
    got = {r.page_id: r.text for r in M.extract(bare, weight).collect()}
    want = {r.page_id: reading_by_the_mark(r.html) for r in rest}
    exact = sum(got[i] == want[i] for i in want) / len(want)
    assert exact >= 0.97 and min(f1(got[i], want[i]) for i in want) >= 0.9


def test_the_mark_is_no_feature():
    page = "<body><div>beside the text here</div><article class=x><p>One two three</p></article><p>Four five six</p></body>"
    seen = {f for f, _ in M.label_counts(page)}
    assert seen == {"<body>", "</body>", "<div>", "</div>", "<p>", "</p>", "word:div", "word:p"}
    # what the mark leaves out is in the region all the same, as on any page without it
    assert M.main_text(page, W) == M.main_text(re.sub(MARKS, "", page), W) == "One two three Four five six"


def test_class_words_are_learnt():
    page = "<body><div class=promo><p>In the text after all</p></div><p>and more</p></body>"
    assert M.main_text(page, W) == "and more"
    learnt = M.weights({("class:promo", True): 50, ("word:p", True): 100, ("word:li", False): 50})
    assert M.main_text(page, learnt) == "In the text after all and more"


def test_equal_stretches():
    assert M.best_region([1.0, -2.0, 1.0]) == (0, 1) and M.best_region([-1.0, 0.0]) == (0, 0)
    page = "<p>a b</p><nav>x</nav><nav>x</nav><p>c d</p>"
    assert M.main_text(page, M.weights({("word:p", True): 1, ("box:nav", False): 500, ("<p>", True): 1})) == "a b"


def test_empty_and_null(spark):
    pages = spark.createDataFrame([(1, "u", None), (1, "u", ""), (None, None, "<p>x y</p>")], "page_id bigint, url string, html string")
    assert sorted((r.page_id, r.text, r.n_chars) for r in M.extract(pages.filter("page_id = 1")).collect()) == [(1, "", 0)] * 2
    assert [r.text for r in M.extract(pages.filter("page_id IS NULL")).collect()] == ["x y"]
    assert M.extract(pages.limit(0)).collect() == []


def test_long_attributes():
    for n in (9_999, 10_000, 300_000):
        value = "x>" * (n // 2)
        for q in "\"'":
            page = (f"<body><article data-a={q}{value}{q}><p>One<div class=advert style={q}{value}{q}>no</div><p>two"
                    f"<script data-b={q}{value}{q}>var no;</script><aside title={q}{value}{q}>no</aside></article><footer>beside")
            assert M.main_text(page, W) == "One two"
            assert M.label_counts(page) == M.label_counts(page.replace(value, ""))
    # a quote that never closes ends at the first '>'
    assert M.main_text("<article><p title=\"x>One two</p><p>three</p></article>", W) == "One two three"
    assert M.main_text("<article>" + "<p>word</p>" * 50_000 + "<p title='>end</article>", W).endswith("word end")
