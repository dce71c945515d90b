import random
import time

import pytest

from affinity.llm import html_text as H
from affinity.llm.html_text import extract_text, main_text

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><p>no";</script></head><body>
<header><h1>Site name</h1></header><nav><ul><li><a href=/a>One</a></li></ul></nav><!-- note <p>no</p> -->
<div class="cookie-notice"><p>We use cookies, many of them, all day.</p></div>%s
<aside><p>An aside, of some length, with commas, and more.</p></aside><div id="comments"><p>A reader, writes, a long, long, comment here.</p></div>
<form><p>Sign up, please, now</p></form><footer>&copy; site</footer></body></html>"""


@pytest.mark.parametrize("inner", [
    "<article><h1>Title &amp; more</h1><p>First   para,\n with <b>bold</b> text.</p><p>Second&nbsp;one<br>goes on.</p></article>",
    "<article><header><h1>Title &amp; more</h1></header><p><b>First para, with bold text.<br><p>Second one goes on.</article>",
    "<div id=main><h1>Title &amp; more</h1><div class='post-body'><p>First para, with bold text.</p><div class=ad><p>Buy, buy, buy</p></div><p>Second one goes on.</p></div></div>",
    "<article><h1>Title &amp; more</h1><p>First para, with bold text.</p><div class='readerComments'><p>Oh, no, no</p></div><p class=notice>Note, please</p>"
    "<ul class='share-links'><li>Share</ul><p>Second one goes on.</p><!-- c --></article>",
    "<article class=post><h1>Title &amp; more</h1><p>First para, with bold text.</p><script>x()</script><p>Second one goes on.</p><div class='share'>Share</div><section class='comments'><article class=comment><p>No, no, no, no</p></article></section></article>",
])
def test_article_only(inner):
    assert main_text(PAGE % inner) == "Title & more\nFirst para, with bold text.\nSecond one goes on."


def test_links_discount_and_siblings():
    text = "A paragraph with words, commas, and enough length to be an article of its own kind."
    page = "<body><div>" + "".join(f"<p><a href=x>{text}</a></p>" for _ in range(9)) + f"</div><section><p>{text}</p><p>{text}</p></section><p>Tail {text}</p></body>"
    assert main_text(page) == "\n".join([text, text, "Tail " + text])


@pytest.mark.parametrize("html,text", [
    (None, ""), ("", ""), ("plain words", "plain words"), ("<script>x</script>", ""), ("<nav><p>menu, menu</p></nav>", ""),
    ("<article><p>cut &amp", "cut &"), ("<article><p>cut &#8364;1 &lt;b&gt;", "cut €1 <b>"), ("<article><p>one<p>two</article", "one\ntwo"),
    ("<p>a</b></div></p>", "a"), ("<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000 + "</article>", "deep")])
def test_odd_pages(html, text):
    assert main_text(html) == text


def test_operator(rows_of, spark):
    schema = "page_id long, url string, html string, text int, kids string"
    rows = [(1, "u", PAGE % "<article><p>The é text</p></article>", 5, "k"), (2, "u", None, 5, None), (2, "u", None, 5, None), (None, None, "x" * 300_000, 1, "")]
    got = extract_text(rows_of(rows, schema))
    assert got.columns == ["page_id", "url", "html", "kids", "text", "n_chars"]
    assert sorted(((r.page_id, r.text[:10], r.n_chars) for r in got.collect()), key=repr) == sorted(
        [(1, "The é text", 10), (2, "", 0), (2, "", 0), (None, "x" * 10, 300_000)], key=repr)
    assert extract_text(rows_of(rows, schema).limit(0)).count() == 0
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    assert extract_text(pages).filter("text = '' OR text LIKE '%track(%' OR text LIKE '%©%'").count() == 0


PROSE = "<p>%s, a paragraph of an article, with words, commas, and enough length to count for something.</p>"
BODY = "".join(PROSE % f"Part {i}" for i in range(6))


@pytest.mark.parametrize("open_tag,close_tag", [
    ("<div class='content-sidebar-wrap'>", "</div>"), ("<div class='container no-sidebar'>", "</div>"), ("<div class='hidden-print'>", "</div>"),
    ("<div id='search'>", "</div>"), ("<form id=aspnetForm action=x><input type=hidden name=a value=b>", "</form>"),
    ("<form><div class='widget-zone'>", "</div></form>")])
def test_wrappers_of_the_whole_page_are_entered(open_tag, close_tag):
    page = f"<body>{open_tag}<div id=sidebar-left><p>Side, side, side</p></div><div><h1>Title</h1>{BODY}</div>" \
           f"<div class='comments'><p>Oh, no, no</p></div>{close_tag}<div class=menu>{'<li><a href=x>Go, go, go</a></li>' * 60}</div></body>"
    assert [x[:6] for x in main_text(page).split("\n")] == ["Title"] + [f"Part {i}" for i in range(6)]


@pytest.mark.parametrize("name", ["discussion", "related-work", "search"])
def test_sections_of_an_article_named_like_boilerplate(name):
    links = "<section id=related><h2>Related</h2>" + "<p><a href=x>See, also, this</a></p>" * 3 + "</section>"
    page = f"<body><article><h1>T</h1>{BODY}<section id='{name}'><h2>Own</h2>{PROSE % 'Section'}</section>{links}</article></body>"
    assert [x[:6] for x in main_text(page).split("\n")] == ["T"] + [f"Part {i}" for i in range(6)] + ["Own", "Sectio"]


def test_many_reader_comments_do_not_replace_the_article():
    comments = "<div id=comments>" + "<div class=comment-body><p>I, for one, think so, too, and so on, and on.</p></div>" * 40 + "</div>"
    page = f"<body><article><h1>T</h1>{BODY}{comments}</article></body>"
    assert [x[:6] for x in main_text(page).split("\n")] == ["T"] + [f"Part {i}" for i in range(6)]


@pytest.mark.parametrize("tag", ["font", "span", "b"])
def test_deep_inline_elements(tag):
    assert main_text("<article><p>" + f"<{tag}>" * 3000 + "deep" + f"</{tag}>" * 3000 + " end</article>") == "deep end"
    assert main_text("<body><div>" + f"x<{tag}>" * 3000 + "</div>") == "x" * 3000


def test_parts_beside_the_best_container():
    more = "<table><tr><td>Cell</table><dl><dt>Term<dd>Meaning</dl><figure><figcaption>Figure</figcaption></figure><details><summary>Sum</summary>Det</details>" \
           f"<h4>Fourth</h4><blockquote>Direct quote</blockquote><div>Short</div><ul><li><a href=x>Only a link</a></ul>Loose <b>bold</b> text"
    page = f"<body><h1>Title</h1><div>{BODY}</div>{more}<section>{PROSE % 'Close'}{PROSE % 'Close'}</section><div>Foot</div></body>"
    lines = ["Title", *(f"Part {i}" for i in range(6)), "Cell", "Term", "Meanin", "Figure", "Sum", "Det", "Fourth", "Direct", "Short", "Loose ",
             "Close,", "Close,"]
    assert [x[:6] for x in main_text(page).split("\n")] == lines


def test_blockquote_scores_its_own_text():
    quote = PROSE[3:-4] % "Quote" * 4
    assert main_text(f"<body><div><div><p>a</p></div><blockquote>{quote}</blockquote></div></body>").endswith(quote)
    builder = H.TreeBuilder()
    builder.feed(f"<body><blockquote>{quote}</blockquote></body>")
    order = H._measure(builder.root)
    H._give_points(order)
    assert next(n for n in order if n.tag == "blockquote").points > 0


@pytest.mark.parametrize("name", ["share-price", "alert-level", "search-results", "notice-period", "navy-blue", "header-row",
                                  "social-history", "copyright-law", "ad-hoc"])
def test_names_that_hold_such_a_word_by_chance(name):
    page = f"<body><article><h1>T</h1>{BODY}<div class={name}>{PROSE % 'Inner'}{PROSE % 'Inner'}</div></article></body>"
    assert [x[:5] for x in main_text(page).split("\n")] == ["T"] + ["Part "] * 6 + ["Inner"] * 2


@pytest.mark.parametrize("name", ["share-links", "site-header", "cookie_notice", "ad", "ad-top", "nav", "newsletter-signup", "post-comments",
                                  "related-posts", "sponsoredContent", "alert warning"])
def test_names_of_boilerplate(name):
    page = f"<body><article><h1>T</h1>{BODY}<div class='{name}'><p>Not this, please</p></div></article></body>"
    assert [x[:5] for x in main_text(page).split("\n")] == ["T"] + ["Part "] * 6


def test_deep_nesting_takes_linear_time():
    began = time.time()
    assert main_text("<article>" + "<div>" * 200_000 + "deep" + "</div>" * 200_000 + "</article>") == "deep"
    assert main_text("<p>" + "<table><tr><td>" + "<div>" * 100_000 + "x" + "</section>" * 100_000) == "x"
    assert main_text("<ul>" + "<li><b>" * 50_000 + "x") == "x"
    assert time.time() - began < 20


def test_white_space_and_invisible_characters():
    assert main_text("<article><p>a\u200bb \t\u00a0\u2003c\ufeffd</p></article>") == "a\u200bb c\ufeffd"


WORDS = "alpha beta, gamma delta; epsilon zeta eta, theta iota kappa lambda mu nu, xi omicron pi rho sigma tau".split()


def _page(rnd):
    """A page whose article text is known: (html, lines)."""
    words = lambda n: " ".join(rnd.choice(WORDS) for _ in range(n))
    lines, parts = [], []

    def block(tag, n, inline=True):
        text = words(n)
        lines.append(text)
        if inline and n > 8:
            a, b = text.split(" ", 5)[:5], text.split(" ", 5)[5]
            text = " ".join(a) + rnd.choice([" <b>{}</b>", "\n  <i>{}</i>", " <span><em>{}</em></span>", "&#32;{}"]).format(b)
        parts.append(f"<{tag}>{text}" + rnd.choice([f"</{tag}>", f"</{tag}>\n"] + [""] * (tag == "p")))

    block("h1", 4)
    for _ in range(rnd.randint(4, 9)):
        kind = rnd.random()
        if kind < 0.6:
            block("p", rnd.randint(15, 50))
        elif kind < 0.75:
            parts.append("<ul>")
            for _ in range(3):
                block("li", rnd.randint(6, 12))
            parts.append("</ul>")
        elif kind < 0.85:
            parts.append("<blockquote>")
            block("p", 20)
            parts.append("</blockquote>")
        elif kind < 0.95:
            block("h2", 3)
            block("p", 30)
        else:
            parts.append(rnd.choice(["<script>if (a < b) { x('</p>') }</script>", "<!-- <p>gone</p> -->", "<style>p > a {}</style>",
                                     "<div class='ad-box'><p>Buy this now</p></div>", "<div class='share-links'><a href=x>Share</a></div>",
                                     "<aside><p>An aside of some words</p></aside>"]))
    menu = "<nav><ul>" + "".join(f"<li><a href=/{i}>{words(2)}</a></li>" for i in range(6)) + "</ul></nav>"
    start, end = rnd.choice([("<article>", "</article>"), ("<main>", "</main>"), ("<div id=content>", "</div>"),
                             ("<div class=wrap><div class='post-body'>", "</div></div>")])
    around = [f"<header><p>{words(5)}</p></header>", menu, f"<div class='cookie-notice'><p>{words(8)}</p></div>"]
    after = [f"<div class='sidebar'><p>{words(6)}</p></div>", f"<section class='comments'><p>{words(9)}</p></section>",
             f"<form><p>{words(4)}</p></form>", f"<footer>&copy; {words(3)}</footer>"]
    rnd.shuffle(around)
    rnd.shuffle(after)
    html = "<!doctype html><html><head><title>T</title></head><body>" + "".join(around) + start + "".join(parts) + end + "".join(after)
    return html + rnd.choice(["</body></html>", ""]), lines


@pytest.mark.parametrize("seed", range(60))
def test_pages_of_known_text(seed):
    html, lines = _page(random.Random(seed))
    assert main_text(html) == "\n".join(lines)
