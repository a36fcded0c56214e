from __future__ import annotations

import html
import re
import time

import pytest

from millrace.llm.queries import QUERIES
from millrace.llm.site_text import Page, extract, host_of, main_text, site_templates

PAGES = "page_id long, url string, html string, host string, key int"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", 1) for i, u, h in rows], PAGES).repartition(3)


def test_query_against_a_plain_reading(spark, sf_dir):
    rows = QUERIES["op2_html_text"](spark, sf_dir).collect()
    source = {r.page_id: r for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    assert len(rows) == len(source)
    for r in rows:
        article = re.search(r"<article>(.*?)</article>", source[r.page_id].html, re.S)[1]
        lines = re.sub(r"<[^>]*>", "", re.sub(r"</?(p|h1)>", "\n", article)).split("\n")
        want = "\n".join(x for x in (" ".join(html.unescape(line).split()) for line in lines) if x)
        assert (r.text, r.n_chars, r.url) == (want, len(want), source[r.page_id].url)


@pytest.mark.parametrize(
    ("source", "text"),
    [
        (None, ""),
        ("", ""),
        ("plain &amp; text", "plain & text"),
        ("a < b &lt;i&gt; <3", "a < b <i> <3"),
        ("<p>hello <b>w <p>x<div class='sidebar'>no</div> tail", "hello w\nx\ntail"),
        ("<div>a<div>b</div>c</div>", "a\nb\nc"),
        ("<article><p>x<script>if(a<b){}</script>y</p><!-- c --> z<style>p{}</style></article>", "xy\nz"),
        ("<article class=comment>bad</article><article><p>good</article><article class=teaser>t</article>", "good"),
        ("<article><header><h1>T</h1></header><p>a</p><footer>f</footer><div id=comments><p>nice</div></article>", "T\na"),
        ("<body class='no-sidebar'><header>site</header><main><p>text&nbsp; here<br>too</p></main><aside>x</aside>", "text here too"),
        ("<div class=post><p>body text</p></div><div class='cookie-notice'>we use</div><form>f</form>", "body text"),
        ("<nav>menu<p>more", ""),
        ("<article><ul><li>a<li>b</ul><table><tr><td>1<td>2<tr><td>3</table></article>", "a\nb\n1 2\n3"),
        ("<article><p hidden>no</p><p style='display: none'>no</p><p>yes</p></article>", "yes"),
        ("<article><p title='a>b'>x</p>", "x"),
        ("<div id=pageHeader>site</div><div class='entry-header'><h1>T</h1></div><p>x</p><div class=cookieBar>c</div>", "T\nx"),
        ("<article class='post social-science'><p>x</p></article><article class=related><p>longer than that</p></article>", "x"),
        ("<article><p>let <math><mi>x</mi></math> be</p></article>", "let x be"),
        ("<script>unclosed <p>x", ""),
        ("<!-- unclosed <p>x", ""),
    ],
)
def test_pages(source, text):
    assert main_text(source) == text


def site(n: int, extra: str = "") -> list[tuple]:
    rows = []
    for i in range(n):
        body = f"<div><p>Welcome to our site, read on</p></div><p>own text number {i} of this page</p><p>and more {i * 7}</p>{extra}"
        rows.append((i, f"http://user@Www.Site.example:80/p{i}?x=http://other/", f"<html><body>{body}</body></html>"))
    return rows


def test_recurring_subtrees_go(spark):
    rows = site(12) + [(100, "http://lone.example/", site(1)[0][2]), (101, None, site(1)[0][2]), (102, "no url", None)]
    found = {r.page_id: r.text for r in extract(pages(spark, rows)).collect()}
    assert found[3] == "own text number 3 of this page\nand more 21"
    assert found[100] == found[101] == "Welcome to our site, read on\nown text number 0 of this page\nand more 0"
    assert found[102] == ""


def test_copies_of_a_page_are_no_template(spark):
    same = "<html><body><p>one and the same page</p><p>with two paragraphs</p></body></html>"
    rows = [(i, "http://a.example/", same) for i in range(50)] + [(60 + i, u, h) for i, u, h in site(3)]
    found = extract(pages(spark, rows)).collect()
    assert {r.text for r in found if r.page_id < 50} == {"one and the same page\nwith two paragraphs"} and len(found) == 53


def test_articles_that_share_a_passage_keep_it(spark):
    shared = "<p>a passage that many articles quote</p>"
    rows = [(i, "http://a.example/", f"<article><p>own {i}</p>{shared if i % 2 else ''}</article>") for i in range(40)]
    found = {r.page_id: r.text for r in extract(pages(spark, rows)).collect()}
    assert found[1] == "own 1\na passage that many articles quote"
    rows = [(i, "http://a.example/", f"<article><p>own {i}</p><div>Share this</div></article>") for i in range(40)]
    assert {r.text for r in extract(pages(spark, rows)).collect()} == {f"own {i}" for i in range(40)}


def test_templates_against_counting_by_hand(spark):
    rows = site(8, "<div><i>x</i></div>") + [(50 + i, f"http://b.example/{i}", site(8)[i][2]) for i in range(3)]
    found = site_templates(pages(spark, rows)).collect()
    page = Page(rows[0][2])
    keys = page.hashes()
    want = {keys[i] for i, block, _ in page.kept() if block and page.text_size(i) and "own" not in "".join(page.value[i : page.end[i]]) and "more" not in "".join(page.value[i : page.end[i]])}
    assert {(r.host, r.key) for r in found} == {("www.site.example", k) for k in want} and len(want) == 3


def test_hosts(spark):
    urls = ["http://A.b/c", "https://u:p@x.y:8080?q", "//no", "mailto:x", None, "", "ftp://h", "http:///path"]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    assert [r[0] for r in df.select(host_of(df.u)).collect()] == ["a.b", "x.y", None, None, None, None, "h", None]


def test_no_pages(spark):
    assert extract(pages(spark, [])).collect() == []


@pytest.mark.parametrize("source", ["<a \"'" * 20_000, "<div>" * 50_000 + "x", "<p>x" * 50_000, "<b>x" * 20_000 + "</i>" * 20_000, "&" * 100_000])
def test_long_odd_pages_take_no_time(source):
    begin = time.perf_counter()
    main_text(source)
    assert time.perf_counter() - begin < 10


def under_chrome(i: int, article: str) -> str:
    """A page with its own title, link and menu around an article."""
    return f"<html><head><title>t{i}</title><link rel=canonical href=/{i}></head><body><nav>menu {i}</nav>{article}</body></html>"


@pytest.mark.parametrize("wrap", ["<article>{}</article>", "<main>{}</main>", "<div class=post>{}</div>", "{}"])
@pytest.mark.parametrize("n", [16, 120])
def test_copied_articles_under_other_chrome_keep_their_text(spark, wrap, n):
    story = wrap.format("<h1>A story</h1><div><p>that was copied</p><section><p>to many pages</p></section></div>")
    rows = [(i, "http://a.example/", under_chrome(i, story)) for i in range(n // 3)]
    rows += [(i, "http://a.example/", under_chrome(i, wrap.format(f"<h1>own {i}</h1><div><p>text {i}</p></div>"))) for i in range(n // 3, n)]
    found = {r.page_id: r.text for r in extract(pages(spark, rows)).collect()}
    assert all(found[i] == "A story\nthat was copied\nto many pages" for i in range(n // 3))
    assert all(found[i] == f"own {i}\ntext {i}" for i in range(n // 3, n))


@pytest.mark.parametrize("wrap", ["<article><div>{}</div></article>", "<body><div>{}</div></body>"])
def test_passages_of_few_pages_stay(spark, wrap):
    shared = "<section><p>a passage that four of sixteen quote</p></section>"
    rows = [(i, "http://a.example/", wrap.format(f"<p>own {i}</p>{shared if i < 4 else ''}")) for i in range(16)]
    found = {r.page_id: r.text for r in extract(pages(spark, rows)).collect()}
    assert found[1] == "own 1\na passage that four of sixteen quote" and found[9] == "own 9"


STORY = "<h1>A title</h1><p>a text of some length that is the whole of the page</p>"


@pytest.mark.parametrize(
    "names",
    ["layout with-sidebar", "has-sidebar", "post no-sidebar", "page-with-banner", "hasSidebar", "col sidebar-layout", "notice-page", "ad"],
)
@pytest.mark.parametrize("where", ["class", "id"])
@pytest.mark.parametrize("page", ["<body>{}</body>", "<body><nav>menu of the site</nav>{}<footer>foot</footer></body>", "<main>{}</main>", "<article>{}</article>"])
def test_wrappers_of_the_whole_text_stay(names, where, page):
    wrapped = f'<div {where}="{names}">{STORY}<div class="sidebar">side</div></div>'
    assert main_text(page.format(wrapped)) == "A title\na text of some length that is the whole of the page"


@pytest.mark.parametrize(
    ("source", "text"),
    [
        ("<div class='page-banner'><p>a page without any heading, all in one element</p></div>", "a page without any heading, all in one element"),
        ("<body><p>short article</p><div class=comments><p>comments that are longer than the article</p></div></body>", "short article"),
        ("<body><div class='with-sidebar'><h1>T</h1><p>x</p></div><div class='sidebar with-border'>no</div></body>", "T\nx"),
        ("<body><p>text</p><div class='no-js cookie-bar'>we use</div></body>", "text"),
    ],
)
def test_marked_parts_and_wrappers(source, text):
    assert main_text(source) == text


def test_nested_wrappers_take_no_time():
    begin = time.perf_counter()
    assert main_text("<div class=ad>" * 30_000 + "x") == "x"
    assert main_text("<div><div class=ad>" * 15_000 + "x") == "x"
    assert main_text("<div class=ad><p>comment</p><div class=sidebar>long side text</div>" * 3_000)
    assert time.perf_counter() - begin < 10


LONG = "We build on the work of many others, who have shown over the years how such questions can be asked at all, and what their answers may be worth in the end."


@pytest.mark.parametrize(
    ("source", "text"),
    [
        # a form around the page, and forms that are none
        ("<body><form id=aspnetForm action=x><input type=hidden name=__VIEWSTATE value=abc><div><p>the text of</p><p>a whole page</p></div></form></body>", "the text of\na whole page"),
        ("<body><form id=f><div id=menu>Menu</div><article><h1>T</h1><p>x</p><form><input name=q><p>find</p></form></article></form>", "T\nx"),
        ("<main><p>text enough to be most of this page</p><form class=subscribe><p>your mail</p><input></form></main>", "text enough to be most of this page"),
        # comments that close at once, ends of scripts with more than their name
        ("<p>a<!-->b<!--->c<!-- x -->d<!----!>e", "abcde"),
        ("<p>a</p><script>x</script foo><p>b</p><style>y</style\n><p>c</p><title>t</title/><p>d", "a\nb\nc\nd"),
        ("<script>a</scripty>b</script><p>c", "c"),
        # titles and leads
        ("<body><div class=post><header class=entry-header><h1>T</h1></header><p>the text</p></div></body>", "T\nthe text"),
        ("<body><header class='post-header'><h1>T</h1></header><article><p>the text</p></article></body>", "T\nthe text"),
        ("<body><nav>n</nav><h1>T</h1><p class=lead>lead</p><article><p>the text</p></article><p>site</p></body>", "T\nlead\nthe text"),
        ("<body><h1>T</h1><main><p>the text</p></main></body>", "T\nthe text"),
        ("<body><header><h1>Site</h1></header><article><h1>T</h1><p>x</p></article></body>", "T\nx"),
        ("<body><header><h1>Site</h1></header><article><h2>T</h2><p>x</p></article></body>", "T\nx"),
        # several articles
        ("<main><h1>All</h1><article>A</article><p>between</p><article>B</article><aside>s</aside></main>", "All\nA\nbetween\nB"),
        ("<body><article><h2>A</h2></article><div class=ad>buy</div><p>site</p><article>B<article class=comment>c</article></article></body>", "A\nB"),
        # words of classes within articles
        (f"<article><p>a</p><p class='market-share'>It rose.</p><h2 class=related-work>Before</h2><div class='related-work'><p>{LONG}</p></div></article>", f"a\nIt rose.\nBefore\n{LONG}"),
        (f"<article><p>a</p><p class=ad>Buy.</p><div class='share-buttons'>{LONG}</div><div class='newsletter-weekly'><p>{LONG}</p><input></div></article>", "a"),
        (f"<article><p>{LONG}</p><div class='related-reads'><a href=x>{LONG}</a><p>short</p></div></article>", LONG),
        # words of a sentence, and controls
        ("<article><p>Press <button>OK</button> to go on, or the <label>Name</label> of it.</p><button>Share</button><p><button>Like</button></p></article>", "Press OK to go on, or the Name of it."),
        # markup that is cut off or odd
        ("<article><p>a</p><div class=\"x", "a"),
        ("<article><p title=a<b>b</p><p title='a<b>c'>c</p><p title=\"unclosed>d</p><p>e", "b\nc\nd\ne"),
        ("<article><p>x</p", "x"),
        ("<article><p>1 < 2 <3 and a<", "1 < 2 <3 and a<"),
        # tags left open
        ("<body><main><p>a<p>b<ul><li>c<li>d</main><footer>f", "a\nb\nc\nd"),
    ],
)
def test_faults_of_pages(source, text):
    assert main_text(source) == text


@pytest.mark.parametrize("source", ["<a b=\"" * 30_000, "<p title='" * 30_001, "<!--" * 50_000, "</script" * 50_000, "<script></scrip" * 20_000, "<p class=ad-x>" * 20_000 + "<label>x" * 20_000])
def test_odd_markup_takes_no_time(source):
    begin = time.perf_counter()
    main_text(source)
    main_text("<article>" + source)
    assert time.perf_counter() - begin < 10
