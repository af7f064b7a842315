from __future__ import annotations

import time
from collections import defaultdict

import pytest

from tillmark.llm.html import MANY, Page, main_text, site_templates, without

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head>
<body class="no-sidebar"><header>Site</header><nav><ul><li><a href="/a">menu</a></ul></nav><div class="cookie-notice">We use cookies</div>
<div class="content"><article><header><h1>A &amp; B</h1></header><p>One <b>two</b>
 three&nbsp;four<p>Five<br>six &lt;7&gt;<div class="ad">buy</div><ul><li>x<li>y</ul><aside>no</aside>
<section id="comments"><p>first!</p></section><form><input><p>q</p></form></article></div><footer>&copy; me</footer></body></html>"""


def text_of(html):
    return "\n".join(t for t, _ in Page(html).content())


def test_the_article_is_left():
    assert text_of(PAGE) == "A & B\nOne two three four\nFive\nsix <7>\nx\ny"


@pytest.mark.parametrize("html, text", [
    ("", ""), ("plain <b>te</b>xt", "plain text"), ("<div>a</div><p>b<br>c &lt;x&gt; <scr", "a\nb\nc <x>"),
    ("<p><b>bold.<br><p>next</p>", "bold.\nnext"), ("<body><nav>m</nav><p>no article", "no article"),
    ("<table><tr><td>1<td>2<tr><td>3</table>tail", "1\n2\n3\ntail"), ("<!-- note --><p>a<!-- cut", "a"),
    ("<p>a &amp b &unknown; &#233;", "a & b &unknown; é"), ("<main>m</main><p>rest", "m"), ("a < b and c > d", "a < b and c > d"),
    ("<div hidden>h</div><div style='display: none'>n</div><p aria-hidden=true>z</p>v", "v"), ("</p></div>x</article>", "x"),
    ("<article><p>a</p></article><article class=comment><p>b</p></article>", "a"),
    ('<article class="post-12 post hentry category-social tag-search"><p>x', "x"), ('<article class="entry comments-open"><p>x', "x"),
    ('<article class="no-sidebar"><p>x', "x"), ('<div class="sidebar"><p>x', "x"), ('<div class="tag-search"><p>x<div class="site-footer">f', "x"),
    ("<form id=aspnetForm><div><p>x</p><input><label>q</label><div class=ad>buy</div></div></form>", "x"),
    ("<form><article><p>x</p><form><p>n</p></form></article></form>", "x"), ("<article></article><p>x", "x")])
def test_small_pages(html, text):
    assert text_of(html) == text


@pytest.fixture
def site(spark):
    """Ten pages of one host with a box and a paragraph that repeat, one page ten times, and a second host."""
    page = "<html><body>{box}<article><h1>Title {i}</h1><div>Read our letter</div><p>Again.</p><p>Words of page {i} of this host.</p></article></body></html>"
    rows = [(i, f"http://Host.example/p{i}", page.format(i=i, box="<div>Box</div>")) for i in range(10)]
    rows += [(100 + i, f"https://u@host.example:80/copy{i}?x", page.format(i=99, box="")) for i in range(10)]
    rows += [(200, "http://other.example/", page.format(i=0, box="")), (201, None, None), (202, "nonsense", ""), (203, "http://host.example", "<p>")]
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], "page_id long, url string, html string, host string, text string, row string")


def test_what_a_host_repeats_goes_but_not_its_paragraphs(site):
    found = {r.page_id: r for r in main_text(site).collect()}
    assert len(found) == 24
    assert found[3].text == "Title 3\nAgain.\nWords of page 3 of this host."
    assert found[105].text == "Title 99\nAgain.\nWords of page 99 of this host."
    # A host with a single page has no templates.
    assert found[200].text == "Title 0\nRead our letter\nAgain.\nWords of page 0 of this host."
    assert {found[i].text for i in (201, 202, 203)} == {""} and found[201].n_chars == 0
    assert found[3].host == "x" and found[3].row == "z" and all(r.n_chars == len(r.text) for r in found.values())


def test_copies_of_a_page_do_not_make_a_template(site):
    copies = site.filter("page_id between 100 and 199")
    assert site_templates(copies).isEmpty()
    assert main_text(copies).select("text").distinct().count() == 1


def test_no_rows_give_no_rows_and_repeated_rows_stay(site):
    assert main_text(site.limit(0)).isEmpty()
    assert main_text(site.unionAll(site)).count() == 48


def pages_of(spark, htmls, host="http://large.example/"):
    return spark.createDataFrame([(i, f"{host}{i}", h) for i, h in enumerate(htmls)], "page_id long, url string, html string")


def test_a_box_on_a_small_part_of_a_large_host_goes(spark):
    """Fifteen of two hundred pages have one box, the others one of fifteen more that a dozen pages share; one has its own."""
    box = lambda i: "Hot box" if i < 15 else f"Box {i % 15}" if i < 199 else "Lone box"
    found = main_text(pages_of(spark, [f"<p>Words of {i}</p><div>{box(i)}</div>" for i in range(200)])).collect()
    assert {r.page_id: r.text for r in found} == {i: f"Words of {i}" + ("\nLone box" if i == 199 else "") for i in range(200)}


def test_a_box_goes_however_much_of_a_page_it_is(spark):
    licence = "<div>" + "All rights are <a>reserved</a>. " * 12 + "</div>"
    htmls = [f"<p>Short {i}</p>{licence}" for i in range(12)] + [f"<article><p>Inside {i}</p>{licence}</article>" for i in range(12)] + [licence]
    texts = [r.text for r in main_text(pages_of(spark, htmls)).orderBy("page_id").collect()]
    assert texts[:24] == [f"Short {i}" for i in range(12)] + [f"Inside {i}" for i in range(12)]
    assert texts[24].startswith("All rights are reserved.")


def test_a_mirrored_article_stays(spark):
    """Pages that differ in what is dropped only count once."""
    htmls = [f"<nav>{i}</nav><div><p>An article.</p><ul><li>Its list</ul></div>" for i in range(12)]
    assert {r.text for r in main_text(pages_of(spark, htmls)).collect()} == {"An article.\nIts list"}


@pytest.mark.parametrize("html, blocks", [
    ("<div>x" * 200_000, 200_000), ("<a" * 500_000 + ">", 0), ("<p><object>" + "<div>x" * 150_000, 0), ("<b>x" * 200_000, 1),
    ("<table><tr><td>" * 70_000, 0), ("<p>x<ul><li>" * 80_000, 80_000), ("</div>" * 200_000, 0), ("<" * 1_000_000, 1)])
def test_time_grows_in_proportion_to_the_page(html, blocks):
    began = time.process_time()
    assert len(Page(html).outline()[0]) == blocks
    assert time.process_time() - began < 20  # the square of these lengths would take minutes


def test_templates_equal_a_plain_count(spark):
    """Boxes of every number of pages, nested ones, ties and repeated rows, against a count over parsed pages."""
    htmls = [f"<p>Words of {i}</p>" + "".join(f"<div>Box {b}<ul><li>item {b % 3}</li></ul></div>" for b in range(1, 25) if i % b == 0)
             for i in range(60)] + ["<div>Box 1<ul><li>item 1</li></ul></div>"] * 3
    pages = pages_of(spark, htmls)
    outlines = [Page(h).outline() for h in htmls]
    of = defaultdict(set)
    for texts, _, _, hashes in outlines:
        for h in hashes:
            of[h].add(tuple(texts))
    gone = frozenset(h for h, found in of.items() if len(found) >= MANY)
    assert len(gone) > 3 and {r.subtree for r in site_templates(pages).collect()} == gone
    assert {r.page_id: r.text for r in main_text(pages).collect()} == {i: "\n".join(without(*o, gone)) for i, o in enumerate(outlines)}
