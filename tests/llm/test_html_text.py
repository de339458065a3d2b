import itertools
import random
import re
from html import unescape

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from qaprep.llm import html_text

P = "<p>This is a sentence of the article that has quite a few words in it, and it ends here.</p>"


def test_pages_give_their_articles(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r.text for r in html_text.extract(pages).collect()}
    for r in pages.collect():
        inner = re.search("<article>(.*)</article>", r.html, re.S)[1]
        inner = re.sub("<(?:br|/?p|/?h1)>", " ", inner).replace("<b>", "").replace("</b>", "")
        assert got[r.page_id] == " ".join(unescape(inner).split())


def text(page):
    return html_text.main_text(page)[0]


def test_boilerplate_around_and_inside_the_article():
    page = f"""<!doctype html><html><head><title>T</title><style>p {{}}</style></head><body class="has-sidebar">
    <header><a href="/">Site</a><h2>Daily words of the site</h2></header>
    <div class="cookie-notice"><p>We use cookies, as you surely know by now, and you can read all about it here.</p></div>
    <ul class="menu"><li><a href="/a">A</a></li><li><a href="/b">B</a></li></ul>
    <article><header><h1>Head &amp; tail</h1></header>{P}<script>if (a < b) {{ "</p>" }}</script>
    <p>Short&nbsp;one.</p><aside><p>Related: other things that you might like to read some other time.</p></aside>
    <div class="ad-slot ads"><p>Buy this wonderful thing today, it is the best thing you will ever have bought.</p></div>
    <table><tr><td>cell one</td><td>cell two</td></tr></table>{P}
    <section id="comments"><article><p>I like this article a lot, and I have many words to say about it.</p></article></section>
    </article>
    <form><label>Your e-mail address, please, so that we can write to you</label><input></form>
    <div id="sidebar"><p>Sidebar words that go on and on, as these things do, for one whole sentence.</p></div>
    <footer><p>Copyright of the people who made this page, and who own each and every word of it.</p></footer></body></html>"""
    sentence = re.sub("<.*?>", "", P)
    assert text(page) == f"Head & tail {sentence} Short one. cell one cell two {sentence}"


def test_page_without_article_element():
    page = f"<body><div class='nav'><a href=1>One</a> <a href=2>Two</a></div><div id=content><h1>Title</h1>{P}{P}</div>" \
           "<div class=footer>Imprint</div></body>"
    sentence = re.sub("<.*?>", "", P)
    assert text(page) == f"Title {sentence} {sentence}"
    plain = f"<body><div><a href=1>One</a></div><div>{P}{P}</div></body>"
    assert text(plain) == f"{sentence} {sentence}"


def test_broken_markup_does_not_crash():
    for page in [None, "", "<", "<p", "a < b and c > d", "<p>x<br>y" * 50, "<!-- open", "<script>never closed",
                 "</div></p></article>", "<a href=\"x>" * 300, "<div>" * 3000 + "deep words here", "&#xZZ; &amp &copy;",
                 "\x00<p>\x00</p>", "<article>" + "<p>very long words of text. " * 20_000]:
        text(page)
    assert text("<article><p>a &lt;b&gt; c&eacute; &#8364;</p></article>") == "a <b> cé €"
    assert text("<article><p>one<b>two</b> three<br>four</p></article>") == "onetwo three four"


def test_columns_and_edge_rows(spark):
    rows = [(1, None, None, 5), (1, "u", "<article><p>Some words.</p></article>", 5), (None, "u", "", 6)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = sorted((tuple(r)[:4] for r in html_text.extract(df).collect()), key=str)
    assert got == sorted([(1, None, "", 0), (1, "u", "Some words.", 11), (None, "u", "", 0)], key=str)
    assert html_text.extract(df.limit(0)).count() == 0


def energy(gain, edges, labels):
    return sum(g for g, x in zip(gain, labels) if x) - sum(w for i, j, w in edges if labels[i] != labels[j])


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 9), st.integers(0, 10**6))
def test_minimum_cut_is_optimal(n, seed):
    rnd = random.Random(seed)
    gain = [rnd.choice([-3, -1, -0.5, 0, 0.5, 1, 3]) for _ in range(n)]
    edges = [(rnd.randrange(n), rnd.randrange(n), rnd.choice([0.25, 1, 2])) for _ in range(rnd.randrange(14))]
    best = max(energy(gain, edges, x) for x in itertools.product([False, True], repeat=n))
    assert abs(energy(gain, edges, html_text.minimum_cut(gain, edges)) - best) < 1e-9


def test_smoothness_turns_a_doubtful_block():
    page = f"<body><div>{P}<p>ok then</p>{P}</div></body>"
    blocks, parent, depth = html_text.blocks_of(page)
    assert "ok then" in text(page)
    assert html_text.log_odds(blocks[1]) < html_text.log_odds(blocks[0])


@pytest.mark.parametrize("tag", ["article class='post comments-open'", "article class='post category-advertising'",
                                 "main class='with-nav'", "div role='main' id='no-sidebar-ads'"])
def test_article_with_a_hyphenated_name(tag):
    sentence = re.sub("<.*?>", "", P)
    assert text(f"<body><{tag}>{P}{P}</{tag.split()[0]}></body>") == f"{sentence} {sentence}"


def test_article_that_is_a_comment():
    sentence = re.sub("<.*?>", "", P)
    inner = "<article class='comment'><p>I like this article a lot, and I have many words to say.</p></article>"
    other = inner.replace("'comment'", "'comment-body'")
    assert text(f"<body><article>{P}{P}</article>{inner}<ol class='comment-list'>{other}</ol></body>") \
        == f"{sentence} {sentence}"


def sentence_of(p=P):
    return re.sub("<.*?>", "", p)


def test_the_cut_turns_blocks_of_the_given_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = html_text.extract(pages).agg({"n_turned": "sum", "n_blocks": "sum"}).first()
    assert 0.01 * got["sum(n_blocks)"] < got["sum(n_turned)"] < 0.5 * got["sum(n_blocks)"]


def test_the_cut_decides_on_pages_without_article():
    links = "<ul>" + "".join(f"<li><a href='/{i}'>Page {i}</a></li>" for i in range(8)) + "</ul>"
    page = f"<body><div>{links}</div><div>{P}<p>Yes</p>{P}<h2>So</h2>{P}</div><div>{links}</div></body>"
    got, _, _, turned = html_text.main_text(page)
    assert got == f"{sentence_of()} Yes {sentence_of()} So {sentence_of()}" and turned > 0
    # links inside an article follow it, a sentence inside a menu follows the menu
    page = f"<body><nav>{links}{P}</nav><article>{P}{links}{P}</article></body>"
    got, _, _, turned = html_text.main_text(page)
    assert got == f"{sentence_of()} {' '.join(f'Page {i}' for i in range(8))} {sentence_of()}" and turned == 9


@pytest.mark.parametrize("part", ["section id='discussion'", "div class='related-work'", "div class='search-engine-history'",
                                  "div class='share-price-report'", "div id='sharing' class='social-history'"])
@pytest.mark.parametrize("around", ["article", "div"])
def test_names_that_contain_a_word_do_not_empty_an_article(part, around):
    page = f"<body><nav><a href=1>x</a></nav><{around}><{part}>{P * 5}</{part.split()[0]}></{around}></body>"
    assert text(page) == " ".join([sentence_of()] * 5)


def test_hidden_and_advertised_parts_of_a_paragraph():
    page = f"<article><p>Seen <span style='display:none'>hidden words</span>text <b hidden>gone</b><i aria-hidden=true>x</i>" \
           f"goes on<span class='ad'>buy it now</span> here, to its end.</p>{P}</article>"
    assert text(page) == f"Seen text goes on here, to its end. {sentence_of()}"


@pytest.mark.parametrize("page", [
    "a <b " * 250_000, "<a " * 300_000, "<font>" * 40_000 + "x" + "</b>" * 40_000, "<a \"" * 200_000, "<a '>" * 200_000,
    "<p><div>" + "<font>" * 40_000 + "<hr>" * 40_000, "<!--" * 200_000, "<" * 1_000_000, "<div>" * 100_000 + "</p>" * 100_000,
    "<script>" * 100_000, "<p>a sentence. <a href=x>b</a></p>" * 30_000, "&" * 1_000_000, "<p class='" + "ad " * 300_000 + "'>x"])
def test_odd_pages_take_time_in_proportion(page):
    import time
    at = time.time()
    html_text.main_text(page)
    assert time.time() - at < 5


def test_fit_follows_the_examples_and_stays_with_the_prior_without():
    import numpy as np
    rnd = np.random.default_rng(3)
    x = np.column_stack([np.ones(400), rnd.uniform(1, 8, 400), *(rnd.integers(0, 2, 400) for _ in range(5))]).astype(float)
    y = x[:, 1] > 4
    w = html_text.fit_weights(x, y, pull=1.0)
    assert ((x @ np.array(w) > 0) == y).mean() > 0.9
    assert html_text.fit_weights(x, np.ones(400, bool)) == html_text.PRIOR
    assert html_text.fit_weights(x[:0], y[:0]) == html_text.PRIOR
    assert np.allclose(html_text.fit_weights(x, y, pull=1e9), html_text.PRIOR, atol=1e-2)
