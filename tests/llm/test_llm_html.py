import html
import re

import pytest
from llm_cases import scratch  # noqa: F401

from assay.llm import htmltext
from assay.llm.queries import op6
from assay.sources.tables import table

LONG = "This is a paragraph of the article with enough words to be seen as text. " * 3

CASES = {
    "": "", "plain words only": "plain words only", "<p>": "", "<!-- x --><p>a &lt;b&gt; &#233;&nbsp;&amp;amp; </p>": "a <b> é &amp;",
    "<html><body><nav>Home</nav><article><h1>T</h1><p>a<b>b</b> c<br>d<p>e</article><footer>f</footer>": "T\n\nab c d\n\ne",
    "<article><p>one</p><div class='ad'>buy</div><p>two</p><section id=\"comments\"><p>nice!</p></section></article>": "one\n\ntwo",
    "<main><p>x</p><form><p>q<input></p><button>go</button></form><aside>s</aside><p>y</p></main><p>z</p>": "x\n\ny",
    "<script>if (a < b) { '<p>no</p>' }</script><style>p{}</style><p>1 < 2 &copy 3</p>": "1 < 2 © 3",
    f"<ul><li><a href=a>Home</a><li><a href=b>News</a></ul><p>{LONG}</p><p>Short.</p><div class=cookie-notice>{LONG}</div>": LONG.strip() + "\n\nShort.",
    "<article><ul><li>a<li>b</ul><table><tr><td>c<td>d</table></article>": "a\n\nb\n\nc\n\nd",
    "<article><p title='a > b' hidden>h</p><p title=\"x > y\">v</p></article><div>w</div>": "v",
    "<article><p>unclosed <a href='x>t</p><p>u</p></article>": None, "<div class=\"menu\"><p>m</div><article>t": "t",
    "<article><header>Site</header><textarea><p>no</textarea><p>k \n l</p></article>": "k l", "</p></div>x</b>y": None,
}


@pytest.mark.parametrize("page", [p for p, t in CASES.items() if t is not None])
def test_cases(page):
    assert htmltext.main_text(page) == CASES[page]


def test_broken_markup_does_not_crash():
    for page in [p for p, t in CASES.items() if t is None] + ["<" * 1000, "<a" * 1000, "&#x110000; &#0; &bogus;", "<p " + "a='" * 1000, "<b>" * 20_000 + "x" + "</i>" * 20_000 + "<p>" * 20_000]:
        htmltext.main_text(page)


@pytest.mark.parametrize("before, after", [
    ("<div class='page has-sidebar'><article>", "</article></div>"), ("<div class='elementor-widget-text'><article>", "</article></div>"),
    ("<article class='post category-search'>", "</article>"), ("<article><section class='related-work'>", "</section></article>"),
    ("<div class='widget'><article>", "</article></div>"), ("<div id=overlay><main>", "</main></div>"), ("<article class='notice'>", "</article>"),
    ("<div class='page has-sidebar'>", "</div>"), ("<div class='elementor-widget-text'>", "</div>")])
def test_wrappers_with_names_inside_their_class(before, after):
    assert htmltext.main_text(f"<body><nav>m</nav>{before}<p>{LONG}</p><p>end</p>{after}<footer>f</footer>") == LONG.strip() + "\n\nend"


def test_what_is_named_stays_dropped():
    for name in ("comments", "comment", "advert"):
        assert htmltext.main_text(f"<article><p>a</p></article><div class='x {name}'><article><p>b</p></article></div><article class={name}>c</article>") == "a"
    assert htmltext.main_text("<article><p>a</p><div class='related'><article><p>b</p></article></div></article>") == "a"


def test_unmarked_pages_keep_what_is_between():
    adverts = "<div class=ad><p>b</p><p>u</p><p>y</p><p>!</p></div>"
    assert htmltext.main_text(f"<p>{LONG * 9}</p>{adverts}<p>last part</p>") == (LONG * 9).strip() + "\n\nlast part"
    links = "<ul>" + "<li><a href=x>link</a>" * 4 + "</ul>"
    body = f"<p>{LONG * 9}</p>{links}<p>See <a href=y>this long title of a text</a> too</p>{links}<p>{LONG}</p>"
    assert htmltext.main_text(links + body + links) == (LONG * 9).strip() + "\n\nSee this long title of a text too\n\n" + LONG.strip()


def test_windows():
    assert list(htmltext.stretches([0, 9, 0, 9, 0, 0, 0, 9], 10)) == [(1, 4)]
    assert list(htmltext.stretches([0, 9, 0, 9, 0, 0, 0, 9], 1)) == [(1, 4), (7, 8)]
    assert list(htmltext.stretches([], 1)) == []


def plain(page):
    """Brute force for the pages at hand, whose article is marked and holds no markup that is dropped."""
    article = re.search(r"(?s)<article>(.*?)</article>", page)[1]
    parts = re.split(r"</?(?:p|h1|div)>", article)
    found = [" ".join(html.unescape(re.sub(r"<br>", " ", re.sub(r"</?b>", "", x))).split()) for x in parts]
    return "\n\n".join(x for x in found if x)


def test_whole_table(spark):
    pages = table(spark, "/root/testdata/sf0.001", "pages")
    want = {r.page_id: plain(r.html) for r in pages.collect()}
    got = {r.page_id: r for r in op6(pages).collect()}
    assert {i: r.text for i, r in got.items()} == want
    assert all(r.n_chars == len(r.text) for r in got.values())


def test_edges(spark):
    rows = [(1, None, None), (None, "u", ""), (2, "u", "<p>é😀</p>"), (2, "u", "<p>é😀</p>"), (3, None, "<article><p>" + "w " * 100_000)]
    got = op6(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted(repr((r.page_id, r.n_chars)) for r in got) == sorted(map(repr, [(1, 0), (None, 0), (2, 2), (2, 2), (3, 199_999)]))
    clash = spark.createDataFrame([(1, "<p>a</p>", "old")], "page_id long, html string, text string")
    assert [tuple(r) for r in htmltext.extract(clash).collect()] == [(1, "a")]
    assert op6(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_quotes_open_a_value_only_behind_an_equals_sign():
    assert htmltext.main_text("<article><p it's>first</p><p>second</p><p it's>third</p></article>") == "first\n\nsecond\n\nthird"
    assert htmltext.main_text("<article><p title = 'a > b' x=\"c > d\">v</p><p class=it's>w</p></article>") == "v\n\nw"


@pytest.mark.parametrize("piece", ["<a '", "<a ='>' ", "<a =\"", "<p x=' ", "<!-", "</a", "<b>", "='>", "<script", "&amp;<", "<!--x", "< a=' >"])
def test_stray_markup_takes_linear_time(piece):
    import time

    began = time.monotonic()
    htmltext.main_text(piece * (1_000_000 if "'" in piece else 300_000))
    assert time.monotonic() - began < 20


def test_families_of_names():
    for name in ("comment-list", "comments-area", "commentlist", "ad-slot", "sidebar-left", "comment_form", "widget-area", "site-footer"):
        assert htmltext.main_text(f"<article><p>a</p><div class='{name}'><p>b</p></div><p>c</p></article>") == "a\n\nc", name
    for name in ("commentary", "has-sidebar", "post-header", "ad-hoc", "entry-content", "advertising-history"):
        assert htmltext.main_text(f"<article><p>a</p><div class='{name}'><p>b</p></div></article>") == "a\n\nb", name
    assert htmltext.main_text(f"<p>{LONG}</p><div class='site-footer'><p>{LONG}</p></div>") == LONG.strip()


def test_headline_in_the_header_of_the_article():
    page = "<body><header><h1>Site</h1></header><article><header><h1>Headline</h1><p>By one</p></header><p>Text</p></article>"
    assert htmltext.main_text(page) == "Headline\n\nText"


def test_teasers_are_left_out_and_posts_kept():
    teaser = "<article><h3><a href=x>More</a></h3><p>A short line.</p></article>"
    assert htmltext.main_text(f"<article><h1>T</h1><p>{LONG}</p></article>{teaser * 3}") == "T\n\n" + LONG.strip()
    assert htmltext.main_text(f"<article><p>{LONG}</p></article><article><p>{LONG[:119]}.</p></article>") == LONG.strip() + "\n\n" + LONG[:119] + "."


def test_windows_decide_inside_an_article():
    links = "<ul>" + "<li><a href=x>link</a>" * 4 + "</ul>"
    page = f"<article>{links}<h1><a href=y>Title</a></h1><p>{LONG}</p>{links}<p>end</p>{links}</article>"
    assert htmltext.main_text(page) == "Title\n\n" + LONG.strip() + "\n\nlink" * 4 + "\n\nend"
    assert htmltext.main_text("<article><p><a href=x>only links</a></p></article>") == "only links"


def test_generated_unmarked_pages():
    """Brute force: the paragraphs between menus and footers, whatever stands between them."""
    import random

    for seed in range(60):
        r = random.Random(seed)
        menu = "<nav>" + "".join(f"<a href=/{i}>menu {i}</a> " for i in range(r.randint(0, 6))) + "</nav>" + "<ul>" + "<li><a href=z>entry</a></li>" * r.randint(0, 6) + "</ul>"
        noise = ["<div class='ad-slot'><p>buy this now</p></div>", "<form><p>mail <input></p></form>", "<aside><p>side</p></aside>", "<!-- <p>no</p> -->",
                 "<script>var x = '<p>no</p>';</script>", "<ul><li><a href=x>see also</a></li></ul>"]
        body, want = "", []
        for _ in range(r.randint(1, 12)):
            t = " ".join(r.choice(["text", "word", "and", "it's", "A&amp;B", "<b>bold</b>", "<a href=q>linked</a>", "x"]) for _ in range(r.randint(20, 60))) + " end."
            body += f"<p>{t}</p>\n" + "".join(r.choices(noise, k=r.randint(0, 3)))
            want.append(" ".join(html.unescape(re.sub("<[^>]*>", "", t)).split()))
        assert htmltext.main_text(f"<html><head><title>no</title></head><body>{menu}<div>{body}</div>{menu}<footer>f</footer></body></html>") == "\n\n".join(want), seed
