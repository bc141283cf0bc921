"""Main-text extraction: exact cuts by brute force, pages with masked names, broken and deep pages."""

import itertools
import random
import re
import time

import numpy as np
import pytest
from test_llm import collect

from fluvion.llm import html_extract

PAGES = "/root/testdata/sf0.1/pages.parquet"


@pytest.fixture(scope="module")
def pages(spark):
    return [r.html for r in spark.read.parquet(PAGES).select("html").collect()]


@pytest.fixture(scope="module")
def weights(spark):
    return html_extract.fit_weights(spark.read.parquet(PAGES))


def article_of(page):
    """The text of the part that these pages call article."""
    part = re.search("<article>.*</article>", page, re.DOTALL)[0]
    return "\n".join(b.text for b in html_extract.blocks_of(part)[0])


def masked(page):
    """The page with all container names, classes and ids taken away."""
    page = re.sub(r"<(/?)(?:nav|article|header|footer|aside|section|main|form)\b[^>]*>", r"<\1div>", page)
    return re.sub(r"""\s(?:class|id|role)=(?:"[^"]*"|'[^']*')""", "", page)


def test_minimum_cut_is_minimal():
    draw = random.Random(6)
    for _ in range(60):
        n = draw.randint(1, 7)
        gain = [draw.uniform(-2, 2) for _ in range(n)]
        edges = [(draw.randrange(n), draw.randrange(n), draw.uniform(0, 1)) for _ in range(draw.randint(0, 12))]
        cost = lambda labels: -sum(g for g, x in zip(gain, labels, strict=True) if x) + sum(w for a, b, w in edges if labels[a] != labels[b])
        assert cost(html_extract.minimum_cut(gain, edges)) == pytest.approx(min(cost(x) for x in itertools.product([False, True], repeat=n)))


def test_symbols_are_counted_over_the_whole_block():
    at = html_extract.FEATURES.index("symbols")
    for text in ("ab | " + "x" * 15) * 5, ("ab | " + "x" * 15) * 200, "x" * 3800 + "|" * 200:
        row = html_extract.features([html_extract.Block("p", 0, text=text)])[0]
        assert row[at] == pytest.approx(0.5)


def test_html(spark):
    article = ["The first paragraph of the article tells at length &amp; in full what came to pass that day.", "A second one, with a <a href='x'>link</a> and <b>bold</b> words, goes on for quite a while too."]
    page = f"<html><head><title>T</title><style>p {{}}</style></head><body><nav><ul><li><a>Home</a></li><li><a>News</a></li></ul></nav><div class='cookie'>We use cookies</div><article><h1>A headline</h1><p>{article[0]}</p>\n<p>{article[1]}</p></article><div id='comments'><p>Nice text, I liked it a lot.</p></div><script>var a = '<p>no</p>';</script><footer>© 2020 all rights</footer></body></html>"
    rows = [(1, "u", page), (2, "u", None), (3, None, ""), (4, "u", "<p>unclosed <b>text that is long enough to be an article, said everyone who read it"), (4, "u", "<p>unclosed <b>text that is long enough to be an article, said everyone who read it")]
    got = collect(html_extract.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")), "page_id")
    assert got[1][0].text == "A headline\nThe first paragraph of the article tells at length & in full what came to pass that day.\nA second one, with a link and bold words, goes on for quite a while too."
    assert [r.text for r in (got[2][0], got[3][0])] == ["", ""] and len(got[4]) == 2
    assert all(r.n_chars == len(r.text) for rs in got.values() for r in rs)


def boxed(page):
    """The masked page with its paragraphs, titles and lists made plain boxes."""
    return re.sub(r"<(/?)(?:p|h1|ul|li)>", r"<\1div>", masked(page))


def test_articles_are_recovered_with_and_without_names(pages, weights):
    for mask, least in (lambda p: p, 0.99), (masked, 0.9):
        right = sum(html_extract.extract(mask(p), weights) == article_of(p) for p in pages)
        assert right >= least * len(pages), (right, len(pages))


def test_the_cut_changes_pages(pages, weights):
    """On many pages made of plain boxes the cut is another labelling than the classifier's own, and a better one on the whole."""
    changed, better, worse = 0, 0, 0
    for p in pages:
        blocks, elements = html_extract.blocks_of(boxed(p))
        gain = html_extract.features(blocks) @ weights
        cut = html_extract.minimum_cut(gain.tolist(), html_extract.smoothness(blocks, elements))
        alone = (gain > 0).tolist()
        if cut != alone:
            changed += 1
            article = set(article_of(p).split("\n"))
            wrong = [sum((b.text in article) != c for b, c in zip(blocks, x, strict=True)) for x in (cut, alone)]
            better += wrong[0] < wrong[1]
            worse += wrong[0] > wrong[1]
    assert changed > 0 and better > worse, (changed, better, worse)


ARTICLE = "".join(f"<p>Sentence number {i} of the article, which goes on at some length and tells what came to pass.</p>" for i in range(6))
NAV = "<nav><ul><li><a href=x>Home</a></li><li><a href=y>News</a></li></ul></nav>"
FOOT = "<footer>&copy; 2020 all rights</footer>"


@pytest.mark.parametrize(
    "page",
    [
        f"<html><head><title>t</title><body>{NAV}<article>{ARTICLE}</article>{FOOT}",
        f"<html><body><div class='layout has-sidebar'>{NAV}<div class=content>{ARTICLE}</div></div>{FOOT}",
        f"<body>{NAV}<div id=content class=with-sidebar>{ARTICLE}</div>{FOOT}",
        f"<body><form>{NAV}<main>{ARTICLE}</main></form>{FOOT}",
        f"<body>{NAV}<object data=x><article>{ARTICLE}</article>{FOOT}",
        f"<body>{NAV}<svg><path d=x><article>{ARTICLE}</article>{FOOT}",
        f"<body>{NAV}<select><option>a<div>{ARTICLE}</div>{FOOT}",
    ],
)
def test_articles_survive_frames_and_what_is_left_open(page, weights):
    text = html_extract.extract(page, weights)
    assert text.count("Sentence number") == 6 and "Home" not in text and "rights" not in text


def test_deep_and_broken_pages_take_linear_time(weights):
    def took(n):
        page = "<div>" * n + "</span></b></section>" * n + "<b>" * n + "<p>x</p></i>" * n + "<div></div>" * n
        start = time.process_time()
        html_extract.blocks_of(page)
        return time.process_time() - start

    took(500)
    small, large = min(took(1000) for _ in range(3)), took(8000)
    assert large < 20 * small


def test_many_undecided_blocks(weights):
    draw = random.Random(2)
    n = 4000
    gain = [draw.choice([-0.3, 0.3]) * draw.random() for _ in range(n)]
    edges = [(i, i + 1, 0.5) for i in range(n - 1)] + [(i, i + 7, 0.4) for i in range(n - 7)]
    start = time.process_time()
    html_extract.minimum_cut(gain, edges)
    assert time.process_time() - start < 20


def test_learning_weighs_names_by_their_trust():
    rows = np.array([[1, *html_extract.PRIOR * 0 + 1], [0, *html_extract.PRIOR * 0 + 1]])
    weights = html_extract.learn(rows, np.array([3.0, 1.0]))
    assert np.isfinite(weights).all() and np.abs(weights[html_extract.NAMES]).max() < 6
