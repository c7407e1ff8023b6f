"""Main text of pages that show one case each, and templates of hosts."""

import os

import pytest

from permitry.llm import html_text, queries
from permitry.llm.dom import parse

FOLDER = os.environ.get("TEST_LLM_DIR", "/root/testdata/sf0.01")
PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body><header class="site-header"><a href="/">Home</a>
    News</header><nav><ul><li><a href="/a">A</a></li></ul></nav><div class="note">Same on all pages</div>
    <div class="content"><h1>{title}</h1><p>{first}</p><p>{second}</p><div class="ad">Buy {title}</div></div>
    <div id="comments"><p>reader of {title}</p></div><footer>&copy; {title}</footer></body></html>"""


@pytest.mark.parametrize("html, text", [
    ("", ""), (None, ""), ("plain &lt;text&gt; &amp; more", "plain <text> & more"),
    ("<article><h1>Title</h1><p>One<br>two  \n three<p>Next &#233;&nbsp;x</article>", "Title\n\nOne two three\n\nNext é x"),
    ("<main><script>if(a<b){'</p>'}</script><p>a<b>b</b>c</p><!-- no --><style>x</style></main><p>out</p>", "abc"),
    ("<article><ul><li>a<li>b</ul><table><tr><td>x<td>y<tr><td>z</table></article>", "a\n\nb\n\nx y\n\nz"),
    ("<article><form><p>mail</p></form><aside>s</aside><p>kept</p><footer>f</footer><div class='comments'>c</div></article>", "kept"),
    ("<div class='sidebar'>s</div><div id=cookie-notice>c</div><p>body text</p><div class='related-posts'>r</div>", "body text"),
    ("<header><nav>n</nav></header><article><header><h1>Head</h1></header><p>x", "Head\n\nx"),
    ("<p>unclosed <a href='x", "unclosed"), ("<div class='page-header-layout nav'><article><p>inside</p></article></div>", "inside"),
    ("<p>5 < 6 and 7 > 3</p>", "5 < 6 and 7 > 3"), ("<div>" * 9000 + "deep" + "</div>" * 9000, "deep"),
])
def test_pages(spark, html, text):
    assert html_text.main_text(html or "") == text


MENU = "<ul>" + "<li><a href='/x'>A long entry of the menu</a></li>" * 30 + "</ul>"


@pytest.mark.parametrize("html, text", [
    (f"<div id='all'>{MENU}<div><h1>Title</h1><p>A short article.</p></div><h3>More</h3>{MENU}</div>", "Title\n\nA short article.\n\nMore"),
    (f"<div>{MENU}<p>A short article.</p><div><h3>More</h3>{MENU}</div></div>", "A short article."),
    (f"<table><tr><td>{MENU[4:-5]}<td><p>A short article.</table>", "A short article."),
    (f"<div class='page with-sidebar'><div><p>The article.</p></div><div class='sidebar'>{MENU} side</div></div>", "The article."),
    ("<div class='no-sidebar'><p>The article.</p></div><div class='sidebar'>A side.</div>", "The article."),
    ("<div class='left-sidebar-layout'><p>The article.</p><div class='sidebar'>side</div></div><p>x</p>", "The article.\n\nx"),
    ("<div class='social-theme'><p>The article.</p></div><div class='sidebar'>About us</div>", "The article."),
    ("<main class='has-sidebar'><p>The article.</p><div class='sidebar'>side</div></main>", "The article."),
    ("<main class='left-sidebar'><p>The article.</p></main><p>x</p>", "The article."),
    ("<article><div class='share-wide'><p>The article.</p><div class='share'>Tell</div></div></article>", "The article."),
    ("<div class='search-result'><p>One.</p></div><div class='search-result'><p>Two.</p></div>", "One.\n\nTwo."),
    ("<div class='widget'>First</div><div class='widget'>Second</div>", "First\n\nSecond"),
    (f"<p>A text of the page.</p><div class='menu'>{MENU} few words</div><div><a>One</a> | <a>Two</a></div>", "A text of the page."),
    (f"<header><main><header><div class='ad'>x</div></header><p>In it.</p></main></header>{MENU}", "In it."), (MENU, ""),
])
def test_wrappers_keep_their_article(html, text):
    assert html_text.main_text(html) == text


def test_wrappers_on_hosts_with_a_template(spark):
    notice = "<div class='notice'>" + "The same long notice on all pages. " * 20 + "</div>"
    page = "<body><div class='right-sidebar-layout'>" + MENU + "<div><p>Article {0}.</p></div>" + notice + "</div></body>"
    rows = [(i, "http://h.example/x", page.format(i)) for i in range(12)]
    found = html_text.extract(pages(spark, rows)).collect()
    assert {r["page_id"]: r["text"] for r in found} == {i: f"Article {i}." for i in range(12)}


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(4)


def test_constant_nodes_are_template(spark):
    rows = [(i, f"http://Host.example/{i}", PAGE.format(title=f"Title {i}", first=f"First {i}.", second="All share this sentence."))
            for i in range(12)]
    rows += [(50, "http://other.example/", PAGE.format(title="Alone", first="x", second="y")), (51, None, None), (None, "odd", "")]
    found = {r["page_id"]: r for r in html_text.extract(pages(spark, rows)).collect()}
    assert len(found) == 15
    for i in range(12):
        assert "Same on all pages" not in found[i]["text"]
        assert found[i]["text"].startswith(f"Title {i}\n\nFirst {i}.")
        assert found[i]["n_chars"] == len(found[i]["text"])
    assert found[50]["text"] == "Same on all pages\n\nAlone\n\nx\n\ny"
    assert found[51]["text"] == "" and found[51]["url"] is None and found[None]["text"] == ""


@pytest.mark.parametrize("parts", [1, 3, 8])
@pytest.mark.parametrize("others, kept", [(6, False), (7, True)])
def test_constant_by_true_share(spark, parts, others, kept):
    """80 % of 30 pages are 24; the net vote of 24 against 6 is 18 at most."""
    note = "<div class='x'>{} on most pages</div>"
    rows = [(i, "http://h.example/x", f"<p>Article {i}.</p>" + note.format(f"Not {i}" if i % 4 == 0 and i < 4 * others else "Same"))
            for i in range(30)]
    found = {r["page_id"]: r["text"] for r in html_text.extract(pages(spark, rows).repartition(parts)).collect()}
    for i in range(30):
        other = i % 4 == 0 and i < 4 * others
        assert found[i] == f"Article {i}." + (f"\n\nNot {i} on most pages" if other else "\n\nSame on most pages" if kept else "")


def test_articles_that_repeat_are_kept(spark):
    rows = [(i, "http://h.example/x", "<nav>menu</nav><article><h1>T</h1><p>the same article</p></article>") for i in range(20)]
    assert {r["text"] for r in html_text.extract(pages(spark, rows)).collect()} == {"T\n\nthe same article"}


def test_alignment_counts_matching_nodes():
    one = html_text.fold([parse("<div><p>a</p><ul><li>1</li></ul><span>x</span></div>")])
    two = html_text.fold([parse("<div><h2>t</h2><p>b</p><ul><li>1</li><li>2</li></ul></div>")])
    assert html_text._matched(one, two)[0] == 5
    html_text._merge(one, two)
    div = one.children[0]
    assert [(c.key.strip(), c.pages) for c in div.children] == [("h2", 1), ("p", 2), ("ul", 2), ("span", 1)]
    assert html_text._dump(html_text._load(html_text._dump(one))) == html_text._dump(one)


def test_clashing_columns_and_empty(spark):
    rows = pages(spark, [(1, "http://a.b/", "<p>x</p>"), (1, "http://a.b/", "<p>x</p>")]).selectExpr("*", "url AS text", "url AS host")
    assert [r["text"] for r in html_text.extract(rows).collect()] == ["x", "x"]
    assert html_text.extract(pages(spark, [])).count() == 0


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_test_tables(spark):
    found = queries.op8_html_extraction(spark, FOLDER)
    assert found.count() == spark.read.parquet(f"{FOLDER}/pages.parquet").count()
    for row in found.collect():
        assert "track(" not in row["text"] and "©" not in row["text"] and row["n_chars"] == len(row["text"]) > 0
