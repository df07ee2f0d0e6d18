from __future__ import annotations

import html
import re

import pytest
from conftest import SF_DIR

from fleetlake.llm import html_text
from fleetlake.llm.common import table
from fleetlake.llm.queries import QUERIES

PAGES = "page_id long, url string, html string, path string, text string"
LONG = "This is a paragraph of the main text that is long enough to count for something. "


def own(page):
    return html_text.main_text(page, None)


def brute(page):
    """For the pages of the test tables: headings and paragraphs of the one article, by their tags."""
    article = re.search(r"<article>(.*)</article>", page, re.DOTALL)[1]
    parts = re.split(r"</?(?:p|h1)>", article)
    texts = [" ".join(html.unescape(re.sub(r"<br>", " ", re.sub(r"</?b>", "", x))).split()) for x in parts]
    return "\n\n".join(x for x in texts if x)


@pytest.mark.parametrize("sf_dir", [SF_DIR, "/root/testdata/sf0.01"])
def test_query_against_brute_force(spark, sf_dir):
    pages = {r.page_id: r for r in table(spark, sf_dir, "pages").collect()}
    out = QUERIES["op3_html_text"](spark, sf_dir).collect()
    assert {(r.page_id, r.url, r.text, r.n_chars) for r in out} == {
        (i, p.url, brute(p.html), len(brute(p.html))) for i, p in pages.items()
    }


def test_what_is_around_the_article_is_dropped():
    page = f"""<html><head><title>t</title><style>p{{}}</style></head><body class="home"><header>head</header>
    <nav><ul><li>menu</ul></nav><div class="cookie-notice">{LONG * 5}</div><div id=sidebar>{LONG * 5}</div>
    <main><article class="post-12"><h1>The&nbsp;title</h1><p>First <b>bold</b> &amp; <i>it<b>al</i>ic<br>line.
    <p>{LONG}<script>var x = "</p>";</script><ul><li>one<li>two</ul><div class="ad-box"><div>buy</div></div>
    <form><p>mail</p></form><p hidden>unseen</p><!-- <p>no</p> --><table><tr><td>a<td>b</table>
    <section class="comments"><p>{LONG * 9}</p></section></article></main>
    <aside>{LONG * 9}</aside><footer>&copy;</footer></body></html>"""
    assert own(page).split("\n\n") == ["The title", "First bold & italic line.", LONG.strip(), "one", "two", "a", "b"]


@pytest.mark.parametrize(
    "page, text",
    [
        ("", ""),
        ("   ", ""),
        ("plain text &lt;b&gt; a < b", "plain text <b> a < b"),
        ("<p>cut off <b", "cut off"),
        ("<p>quote <a href=\"x>y</a> z", "quote y z"),
        ("<p>a<img src=x>b</p></div></p>c", "ab\n\nc"),
        ("<DIV><P>upper</DIV>", "upper"),
        ("<p>one<p>two<h2>three</h2>four", "one\n\ntwo\n\nthree\n\nfour"),
        ("<nav><a>x</a><article><p>kept</article>", "kept"),
        ("<script>never closed <p>x</p>", ""),
        ("<p>&#233;&eacute;&amp;amp; &notit; &am", "éé&amp; ¬it; &am"),
        ("<title>t</title><p>x　\n y", "x y"),
    ],
)
def test_odd_markup(page, text):
    assert own(page) == text


@pytest.mark.parametrize(
    "wrapper",
    [
        "<div class='layout has-sidebar'>{}</div>",
        "<div class=no-sidebar>{}</div>",
        "<section class='content-with-nav'>{}</section>",
        "<div id='page-header-wrap'><div class=social-science>{}</div></div>",
        "<form action=x method=post>{}</form>",
        "<div role=form>{}</div>",
    ],
)
def test_a_wrapper_named_like_noise_keeps_the_text(wrapper):
    parts = f"<p>{LONG}</p><p>{LONG * 2}</p>"
    beside = f"<nav>{LONG * 9}</nav><div class=sidebar><p>{LONG}</p></div><footer>{LONG * 9}</footer>"
    expected = f"{LONG.strip()}\n\n{(LONG * 2).strip()}"
    assert own(f"<body>{wrapper.format(f'<article>{parts}</article>{beside}')}</body>") == expected
    assert own(f"<body>{wrapper.format(f'<main>{parts}</main>')}{beside}</body>") == expected
    assert own(f"<body>{wrapper.format(f'<div class=x>{parts}</div>{beside}')}</body>") == expected
    assert own(f"<body><main>{wrapper.format(parts)}{beside}</main></body>") == expected


def test_long_noise_beside_an_article_is_dropped():
    comments = f"<div id=comments><ol><li><article class=comment-body><p>{LONG * 9}</p></article></ol></div>"
    assert own(f"<body><article><p>{LONG}</p></article>{comments}</body>") == LONG.strip()
    related = f"<div class=related><article><p>{LONG * 9}</p></article></div>"
    assert own(f"<body><article><p>{LONG * 10}</p>{related}</article></body>") == (LONG * 10).strip()


@pytest.mark.parametrize(
    "parts",
    [
        ("<div class=left><p>{}</p></div>", LONG * 6, "<div class=right><p>{}</p></div>", LONG * 4),
        ("<section><p>{}</p></section>", LONG * 6, "<section><p>{}</p></section>", LONG * 4),
        ("<h1>{}</h1>", "Title", "<div class=body><p>{}</p></div>", LONG * 9),
        ("<p>{}</p>", "A lead.", "<div class=body><p>{}</p></div>", LONG * 9),
        ("<div class=title><h1>{}</h1></div>", "Title", "<div class=body><p>{}</p></div>", LONG * 9),
    ],
)
def test_no_part_of_the_text_is_left_out(parts):
    first, one, second, two = parts
    content = f"<div class=content>{first.format(one)}{second.format(two)}</div>"
    expected = f"{one.strip()}\n\n{two.strip()}"
    for around in ("<body>{}</body>", "<body>{}<div class=extra><p>short</p></div></body>"):
        page = around.format(content)
        assert own(page) == html_text.main_text(page, "body>div.content") == expected
        assert html_text.best(html_text.containers(page)[0]).path() == "body>div.content"


def test_all_containers_at_the_path_count():
    page = f"<body><div><section><p>{LONG}</p></section><p>x</p><section><p>{LONG * 2}</p></section></div></body>"
    assert html_text.main_text(page, "body>div>section") == f"{LONG.strip()}\n\n{(LONG * 2).strip()}"
    two = f"<body><article><p>{LONG}</p></article><article><p>{LONG * 2}</p></article></body>"
    assert own(two) == f"{LONG.strip()}\n\n{(LONG * 2).strip()}"


def test_a_path_without_text_gives_the_own_best():
    page = f"<body><div class=story><img src=x></div><div class=other><p>{LONG}</p></div></body>"
    assert html_text.main_text(page, "body>div.story") == LONG.strip()


@pytest.mark.parametrize(
    "page, text",
    [
        ("<article><p class='notice'>Hint<p>Text</p><p>More</p></article>", "Text\n\nMore"),
        ("<article><ul><li class='share'>One<li>Two</ul><p>Three</article>", "Two\n\nThree"),
        ("<article><dl><dt class=ad>a<dd>b</dl><table><tr><td class=ad>c<td>d<tr class=ad><td>e<tr><td>f</table>g</article>", "b\n\nd\n\nf\n\ng"),
        ("<article><p class=notice>Hint<form>mail</form><p>Text</article>", "Text"),
        ("<article><select><option>a<option>b</select><p>Text</article>", "Text"),
        ("<article><p>Text</p><div><span class=share>x</div><p>More</p></article>", "Text\n\nMore"),
        ("<article><p>Text <button><p>x</p></button><p>More</article>", "Text\n\nMore"),
        ("<article><p>one <svg viewBox='0 0 1 1'/>two</p><p>three</p></article>", "one two\n\nthree"),
        ("<article><p>one <svg><path d='x'>no</path></svg>two <svg><path d='x'>no<p>three</article>", "one two\n\nthree"),
        ("<article><p>one</p><svg><title/><path d='x'/><text>no</text></svg><object/><p>two</p></article>", "one\n\ntwo"),
        ("<article><p>So <math><mi>x</mi><mo>=</mo><mspace/><mn>2</mn><annotation>x=2</annotation></math></p></article>", "So x=2"),
    ],
)
def test_dropped_elements_end_like_others(page, text):
    assert own(page) == text


def test_deep_and_long_pages_take_no_more_than_their_length():
    deep = "<div>" * 20_000 + LONG + "</div>" * 20_000
    assert own(deep) == LONG.strip()
    assert len(own("<p>word word</p>" * 50_000)) == 50_000 * 11 - 2
    assert own("<" * 100_000) == "<" * 100_000
    own("<a href='" * 20_000)


def test_a_host_votes_for_its_path(spark):
    """Where a page's own best is something else, its host's path decides."""
    usual = f'<body><div class="story s1"><p>{LONG * 3}</p></div><div class="extra"><p>short</p></div></body>'
    odd = f'<body><div class="s22 story"><p>Brief.</p></div><div class="extra"><p>{LONG * 9}</p></div></body>'
    rows = [(i, "http://A.com/x", usual, "x", "y") for i in range(5)] + [(10, "https://a.com", odd, "x", "y"), (11, "http://b.com/", odd, "x", "y")]
    rows += [(12, None, odd, "x", "y"), (13, "http://a.com/", None, "x", "y"), (14, "http://a.com/", "", "x", "y"), (None, "http://a.com/", usual, "x", "y"), rows[0]]
    pages = spark.createDataFrame(rows, PAGES)
    for limit in (html_text.WINNER_BYTES, 2**40):
        html_text.WINNER_BYTES, before = limit, html_text.WINNER_BYTES
        try:
            out = html_text.extract(pages.repartition(3)).collect()
        finally:
            html_text.WINNER_BYTES = before
        texts = {r.page_id: r.text for r in out}
        assert len(out) == len(rows)
        assert texts[0] == texts[None] == (LONG * 3).strip() and texts[10] == "Brief."
        assert texts[11] == texts[12] == (LONG * 9).strip() and texts[13] == texts[14] == ""
    assert {(r.host, r.path) for r in html_text.winning_paths(pages).collect()} == {("a.com", "body>div.s#.story"), ("b.com", "body>div.extra")}


def test_empty_table(spark):
    assert html_text.extract(spark.createDataFrame([], PAGES)).collect() == []


SAID = "This is a whole sentence of the story, long enough to count. "
OTHER = "A reader says something about it, at some length as well. "


@pytest.mark.parametrize(
    "page",
    [
        f"<body><div class=post><p>{SAID * 4}</p></div><ol class=comments>{f'<li>{OTHER}</li>' * 20}</ol></body>",
        f"<body><div class=post><p>{SAID * 4}</p></div><div class=cookie-consent><p>{OTHER * 20}</p></div></body>",
        f"<body><div class=post><p>{SAID * 4}</p></div><form class=newsletter><p>{OTHER * 20}</p></form></body>",
        f"<body><article><p>{SAID * 4}</p></article><section class=discussion><p>{OTHER * 20}</p></section></body>",
        f"<body><main><article><p>{SAID * 4}</p></article><section class=talk><p>{OTHER * 20}</p></section></main></body>",
        f"<body><div><p>{SAID * 4}</p><p style='color:red; display: none'>{OTHER}</p></div></body>",
        f"<body><div class='layout has-sidebar'><p>{SAID * 4}</p></div><p>{OTHER}</p></body>",
        f"<body><div class='with-comments'><p>{SAID * 4}</p></div></body>",
    ],
)
def test_noise_never_comes_back_for_its_length(page):
    assert html_text.main_text(page, None).startswith((SAID * 4).strip())
    if "has-sidebar" not in page:
        assert OTHER.strip() not in html_text.main_text(page, None)


@pytest.mark.parametrize("head", ["<header><h1>The title</h1><p>By someone</p></header>", "<div class=entry-header><h1>The title</h1><a href=x>Share</a></div>"])
def test_an_article_keeps_its_title(head):
    page = f"<body><header><h1>Site</h1></header><article>{head}<p>{SAID * 4}</p></article></body>"
    assert html_text.main_text(page, None) == f"The title\n\n{(SAID * 4).strip()}"


@pytest.mark.parametrize("page", ["<b>" * 60_000 + "<p>x" * 60_000, "<p>x<b>" * 60_000, "<div><p>" + "<i>" * 60_000 + "<li>x" * 60_000])
def test_unclosed_tags_take_no_more_than_their_length(page):
    import time

    start = time.process_time()
    html_text.main_text(page, None)
    assert time.process_time() - start < 10
