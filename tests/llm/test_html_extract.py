import html
import re

import numpy as np
import pytest

from ontime.llm import html_extract
from ontime.llm.common import table

SF = "/root/testdata/sf0.01"


def article(page):
    """The article of a page of the test tables, which all have one layout."""
    body = re.search(r"<article>(.*?)(</article>|$)", page, re.S).group(1)
    blocks = [re.sub(r"\s+", " ", html.unescape(x)).strip() for x in re.split(r"(?:<(?:p|/p|h1|/h1|br|b)>)+", body)]
    return "\n".join(x for x in blocks if x)


@pytest.fixture(scope="module")
def model(spark):
    return html_extract.fit(table(spark, SF, "pages"))


def test_articles_of_the_test_pages(spark):
    rows = html_extract.main_text(table(spark, SF, "pages")).collect()
    pages = {r.page_id: r for r in table(spark, SF, "pages").collect()}
    assert len(rows) == len(pages)
    right = sum(r.text == article(pages[r.page_id].html) and r.url == pages[r.page_id].url and r.n_chars == len(r.text) for r in rows)
    assert right >= 0.99 * len(rows)


def test_other_layouts(model):
    page = """<html><body><header class="site-header"><h2>My Site</h2><a href=/>Home</a></header><div class="wrap"><div class="post-content">
      <h1>Title  here</h1><p>First paragraph &amp; more, with <a href=x>words</a>. It goes on.<p>Second one,\n too.</p><ul><li>an item<li>other</ul></div>
      <aside class="sidebar"><h3>Related</h3><ul><li><a href=x>One story</a></li></ul><p>Some teaser text, that reads well.</p></aside></div>
      <section id="comments"><h3>2 comments</h3><div class="comment"><p>I liked this, it is good. Thanks a lot.</p></div></section>
      <div class="cookie-banner"><p>We use cookies, to improve it. Accept them.</p></div><form action=/s><p>Search</p><input><button>Go</button></form>
      <script>var x = "</p><p>no</p>";</script><style>p{}</style><footer>(c) 2024</footer></body></html>"""
    assert model.texts([page])[0] == "Title here\nFirst paragraph & more, with words. It goes on.\nSecond one, too.\nan item\nother"
    unseen = """<div id="topnav2"><a href=a>A</a> <a href=b>B</a></div><div id=main><div class="advertisements">Buy now!</div><div class=entrytext>
      <p>Hello there, this is text.</p><p>More text, more words.</p></div></div><div class="commentbox"><article class="comment"><p>Great, I think.</p></article></div>"""
    assert model.texts([unseen])[0] == "Hello there, this is text.\nMore text, more words."


def test_decoding_is_the_best_consistent_choice():
    rng = np.random.default_rng(4)
    for _ in range(60):
        n = int(rng.integers(1, 9))
        parent = [-1] + [int(rng.integers(0, i)) for i in range(1, n)]
        margin = rng.normal(0, 3, n)
        gain = np.clip(margin, -6, 6)

        def worth(kept):
            total = sum(-np.logaddexp(0, -gain[i]) if kept >> i & 1 else -np.logaddexp(0, gain[i]) for i in range(n))
            return total - html_extract.DROP_PRICE * sum(not kept >> i & 1 and kept >> parent[i] & 1 for i in range(1, n))

        sound = [k for k in range(1, 2 ** n, 2) if all(not k >> i & 1 or k >> parent[i] & 1 for i in range(1, n))]
        got = html_extract.decode(parent, margin)
        assert np.isclose(worth(sum(1 << i for i in range(n) if got[i])), max(map(worth, sound)))


def test_trees_learn():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(3000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(int)
    trees = html_extract.Trees(x[:2000], y[:2000])
    assert ((trees.margin(x[2000:]) > 0) == y[2000:]).mean() > 0.95


def test_odd_pages(spark):
    odd = [(1, "u", None, "x"), (2, None, "", "x"), (3, "u", "just words &amp; more", "x"), (3, "u", "just words &amp; more", "x"),
           (None, "u", "<p>cut &am", "x"), (5, "u", "<p>" + "long words. " * 100_000, "x"), (6, "u", "<<<>&#0;</p></div><br", "x")]
    docs = spark.createDataFrame(odd, "page_id long, url string, html string, text string")
    rows = html_extract.main_text(docs).collect()
    texts = {(r.page_id, r.url): r.text for r in rows}
    assert len(rows) == len(odd) and texts[1, "u"] == texts[2, None] == "" and texts[3, "u"] == "just words & more"
    assert texts[None, "u"] == "cut &am" and len(texts[5, "u"]) == len("long words. " * 100_000) - 1
    assert html_extract.main_text(docs.limit(0)).collect() == []
    assert {r.text for r in html_extract.main_text(docs.where("page_id < 3")).collect()} == {""}


def test_tables_without_short_pages_keep_their_texts(spark):
    words = "It was a long day, and many words were said. " * 3000
    page = f"<html><body><nav><ul><li><a href=a>Home</a><li><a href=b>More</a></ul></nav><article><h1>Title</h1><p>{words}</p></article></body></html>"
    assert len(page) > html_extract.SAMPLE_CHARS
    schema = "page_id long, url string, html string"
    got = html_extract.main_text(spark.createDataFrame([(1, "u", page)], schema)).collect()[0].text
    assert got == "Title\n" + words.strip()
    hidden_start = "<script>" + "x" * html_extract.SAMPLE_CHARS + "</script>"
    rows = [(1, "u", "<html></html>"), (2, "u", hidden_start + "<article><p>Late text, but text. It counts.</p></article>"), (3, "u", "")]
    got = {r.page_id: r.text for r in html_extract.main_text(spark.createDataFrame(rows, schema)).collect()}
    assert got == {1: "", 2: "Late text, but text. It counts.", 3: ""}


def blocks(page):
    return [text for _, text, _ in html_extract.Page(page).blocks]


def test_hidden_elements_without_end_tags(spark):
    cut = "<html><head><title>t</title><body><article><p>Main text.</article></body></html>"
    assert blocks(cut) == ["Main text."]
    rows = spark.createDataFrame([(1, "u", cut)], "page_id long, url string, html string")
    assert html_extract.main_text(rows).collect()[0].text == "Main text."
    for tag in "title noscript template svg iframe canvas audio video select option button label map object".split():
        assert blocks(f"<html><head></head><body><div><{tag}></div><article><p>One.</p>two</article></body></html>") == ["One.", "two"]
        assert blocks(f"<body><p>A</p><{tag}><article><p>One.</p><svg><g>no</g></svg></article>") == ["A", "One."]
    assert blocks("<body><button>x<p>One.</p><button>y</button><p>Two <a><svg><path></a> more.</p>") == ["One.", "Two more."]
    assert blocks("<body><p>A</p><svg><p>B</p><svg><text>no</text></svg><p>C</p>") == ["A", "B", "C"]
    assert blocks("<body><p>A</p><script>x<p>B</p>") == blocks("<body><p>A</p><textarea>x<p>B</p>") == ["A"]


def test_closed_hidden_elements_stay_hidden():
    for tag in "title noscript template svg iframe canvas audio video select option textarea button".split():
        assert blocks(f"<body><div>a <{tag}>x<div><p>no</p></div><b>no</b><svg>no</svg><ul><li>no</ul></{tag}>b</div><p>c</p>") == ["a b", "c"]
    assert blocks("<head><title>The <body> tag</title></head><body><p>a<noscript><p>no</noscript> b</p>") == ["a b"]


def test_formulas_and_labels_are_read():
    page = "<article><p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>no</annotation></math> be <label>so</label>.</p><label>Key</label><object><p>Fall back</p></object><map><p>M</p></map></article>"
    assert blocks(page) == ["Let x=1 be so.", "Key", "Fall back", "M"]
    assert {"label", "object", "map"} <= set(html_extract.Page(page).tag)
