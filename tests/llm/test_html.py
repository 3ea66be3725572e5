"""Extraction against the articles that pages were made from."""

import random
import re
import tracemalloc
from html import escape, unescape

import pytest

from ohlcraft.llm import html, queries
from tests.conftest import SF_DIR


def test_articles_of_the_whole_table(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()}
    rows = queries.op3_wrapper_induction(spark, SF_DIR).collect()
    assert len(rows) == len(pages)
    for row in rows:
        article = re.search(r"<article>(.*?)</article>", pages[row.page_id].html, re.S)[1]
        parts = (unescape(re.sub(r"<[^>]*>", "", p.replace("<br>", " "))) for p in re.split(r"</?(?:p|h1)>", article))
        assert row.text == "\n".join(t for p in parts if (t := " ".join(p.split())))
        assert row.n_chars == len(row.text) and row.url == pages[row.page_id].url


@pytest.fixture(scope="module")
def site():
    """Pages of a site without a mark of its own for the article."""
    draw = random.Random(2)
    words = [f"word{i}" for i in range(500)]
    pages, texts = [], []
    for n in range(30):
        said = [" ".join(draw.choices(words, k=draw.randint(20, 60))) + " a < b & c" for _ in range(draw.randint(2, 7))]
        body = "".join(f"<p>{escape(p)}</p>" for p in said)
        pages.append(
            f"<html><head><title>t{n}</title><style>p{{}}</style></head><body><div><ul><li><a href=/>Home</a><li><a href=/x>About us</a></ul></div>"
            f"<div class='cookie-notice'>We use cookies {n}</div><div><h1>Head {n}</h1><div>{body}"
            f"<script>var x = '<p>no</p>';</script><form>Subscribe <input name=q></form></div></div>"
            f"<div>All rights reserved by the makers of this fine site</div>"
            f"<div id=comments><p>I like it {n} a lot {' '.join(draw.choices(words, k=30))}</p></div></body></html>")
        texts.append(said)
    return pages, texts


def test_slots_of_an_unmarked_site(spark, site):
    pages, texts = site
    frame = spark.createDataFrame([(i, "http://site.example/p", p, "x") for i, p in enumerate(pages)], "page_id long, url string, html string, host string")
    for row in html.main_texts(frame).collect():
        lines = row.text.split("\n")
        assert [x for x in lines if x != f"Head {row.page_id}"] == texts[row.page_id]


def test_odd_pages(spark):
    rows = [(1, None, None), (2, "no url", ""), (3, "http://h/", "plain text"), (None, "http://h/", "<p>a<p>b &amp; c&nbsp;d"),
            (5, "http://h/", "<article><p>x<b>y</b> z<br>w</p><aside>no</aside>tail"), (5, "http://h/", "<article><p>x<b>y</b> z<br>w</p><aside>no</aside>tail"),
            (6, "http://deep/", "<div>" * 20_000 + "deep"), (9, "http://deep/", "<div>" * 20_000 + "<b>" * 20_000 + "deep"), (7, "http://q/", "<script>only"), (8, "http://q/", "<p>" + "long " * 60_000)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {}
    for row in html.main_texts(frame).collect():
        found.setdefault(row.page_id, []).append(row.text)
    assert found[1] == [""] and found[2] == [""] and found[3] == ["plain text"] and found[None] == ["a\nb & c d"]
    assert found[5] == ["xy z w\ntail"] * 2 and found[6] == found[9] == ["deep"] and found[7] == [""]
    assert found[8] == [("long " * 60_000).strip()]
    assert html.main_texts(frame.limit(0)).count() == 0


def test_matching_is_the_largest():
    left = html.parse("<div><p>1</p><ul><li>a<li>b</ul><p>2</p></div>")
    right = html.parse("<div><ul><li>a<li>b<li>c</ul><h2>t</h2><p>2</p></div>")
    assert len(html.match(left, right)) == 6  # html, div, ul, two li, p
    assert len(html.match(left, left)) == len(html.nodes(left))


def _texts(spark, pages):
    frame = spark.createDataFrame([(i, url, page) for i, (url, page) in enumerate(pages)], "page_id long, url string, html string")
    return [r.text for r in sorted(html.main_texts(frame).collect(), key=lambda r: r.page_id)]


def test_no_part_of_an_article_is_dropped(spark, site):
    pages, texts = site
    found = _texts(spark, [("http://site.example/p", p) for p in pages])
    assert found == ["\n".join([f"Head {n}", *said]) for n, said in enumerate(texts)]
    long = "long " * 60
    odd = ["<article><h1>Title</h1><div class=body><p>" + long + "</div></article>",
           "<article><section>some " + long[:100] + "</section><section>" + long + "</section></article>",
           "<table><tr><td>one<td>" + long + "</table>"]
    found = _texts(spark, [(f"http://h{i}/", page) for i, page in enumerate(odd)])
    assert found == ["Title\n" + long.strip(), "some " + long[:100].strip() + "\n" + long.strip(), "one\n" + long.strip()]


def test_templates_are_hidden_by_their_text(spark):
    """Larger than the articles, in plain elements; a page's own text in such a place stays."""
    draw = random.Random(6)
    said = [" ".join(draw.choices([f"word{i}" for i in range(500)], k=40)) for _ in range(24)]
    menu, notes = "menu of the site " * 40, ["This note is on nearly all pages"] * 24
    notes[7] = "A paragraph of the page's own"
    pages = [f"<div><div>{menu}</div><div>{x}</div><p>{note}</p></div>" for x, note in zip(said, notes)]
    # copies of one page tell nothing
    found = _texts(spark, [("http://one/", p) for p in pages + pages[:1] * 40])
    assert found == [x if n != 7 else f"{x}\n{notes[7]}" for n, x in enumerate(said)] + said[:1] * 40


def test_small_hosts_lose_their_templates(spark):
    draw = random.Random(7)
    pages, texts = [], []
    for host in range(2, 7):
        for _ in range(host):
            texts.append(" ".join(draw.choices([f"word{i}" for i in range(500)], k=40)))
            pages.append((f"http://h{host}/", f"<div>Home About</div><div><p>{texts[-1]}</p></div><p>The makers of this site</p>"))
    assert _texts(spark, pages) == texts


def test_names_and_hidden_attributes_by_what_they_hold(spark):
    draw = random.Random(9)
    words = [f"word{i}" for i in range(500)]
    said = [[" ".join(draw.choices(words, k=40)) for _ in range(5)] for _ in range(6)]
    widget = "<div class='elementor-widget elementor-widget-text-editor'><p>{}</p></div>"
    pages = ["<div class=menu>Home</div>" + "".join(map(widget.format, x)) + f"<div class=comments>Nice {x[0][:9]}</div>" for x in said]
    found = _texts(spark, [("http://w/", p) for p in pages] + [("http://alone/", pages[0])])
    assert found == ["\n".join(x) for x in said + said[:1]]
    odd = ["<div class='overflow-hidden p-4'>text</div><p title='hidden gems'>more</p><p hidden>no</p>"
           "<p style='display: none'>no</p><p aria-hidden=true>no</p><p data-class=menu>end</p>"]
    assert _texts(spark, [("http://o/", p) for p in odd]) == ["text\nmore\nend"]


LONG = "long " * 60


@pytest.mark.parametrize("page, expected", [
    (f"<h1>Headline</h1><article><p>{LONG}</p></article>", f"Headline\n{LONG}"),
    (f"<article><p>{LONG}</p></article><article><p>{LONG[:30]}</p></article>", f"{LONG}\n{LONG[:30]}"),
    (f"<article><p>{LONG}</p><section id='related-work'><p>Others</p></section></article>", f"{LONG}\nOthers"),
    (f"<article><h2 id='search'>Search</h2><p>{LONG}</p></article>", f"Search\n{LONG}"),
    (f"<article><p>{LONG}</p><p class='notice'>Take notice</p></article>", f"{LONG}\nTake notice"),
    (f"<article><div class='header'><h1>Title</h1></div><p>{LONG}</p></article>", f"Title\n{LONG}"),
    (f"<article><p>{LONG}</p><div class='share-buttons'>Share</div><div class=ad>Buy</div><div id=comments>Nice</div></article>", LONG),
    (f"<div class=header><h1>Site</h1></div><header><h1>Site</h1></header><article><p>{LONG}</p></article>", LONG),
])
def test_pages_without_others_of_their_host(spark, page, expected):
    assert _texts(spark, [("http://alone/", page)]) == ["\n".join(x.strip() for x in expected.split("\n"))]


def test_two_articles_that_end_alike(spark):
    pages = [f"<div>Home</div><article><p>{word * 50}</p><p>The end of it all</p></article>" for word in ("one ", "two ")]
    found = _texts(spark, [("http://two/", p) for p in pages])
    assert found == [f"{(word * 50).strip()}\nThe end of it all" for word in ("one ", "two ")]


def _largest(a, b):
    """Simple tree matching by its recursion."""
    if (a.tag, a.skipped) != (b.tag, b.skipped):
        return 0
    if a.skipped:
        return 1
    rows = [[0] * (len(b.children) + 1) for _ in range(len(a.children) + 1)]
    for i, x in enumerate(a.children):
        for j, y in enumerate(b.children):
            rows[i + 1][j + 1] = max(rows[i][j + 1], rows[i + 1][j], rows[i][j] + _largest(x, y))
    return 1 + rows[-1][-1]


@pytest.mark.parametrize("cells", [1 << 20, 1])
def test_matching_equals_its_recursion(monkeypatch, cells):
    monkeypatch.setattr(html, "CELLS", cells)
    draw = random.Random(12)

    def tree(depth):
        tag = draw.choice(["div", "section", "p", "ul", "form"])
        inner = "".join(tree(depth - 1) for _ in range(draw.randint(0, 4))) if depth and tag != "p" else "x"
        return f"<{tag}>{inner}</{tag}>"

    for _ in range(150):
        left, right = (html.parse("".join(tree(3) for _ in range(4))) for _ in range(2))
        found = html.match(left, right)
        assert len(found) == _largest(left, right)
        own = {node.number: node for node in html.nodes(left)}
        parents = {child.number: n for n, node in own.items() for child in node.children}
        to = {child.number: node.number for node in html.nodes(right) for child in node.children}
        for n, node in found.items():
            assert own[n].tag == node.tag and (not n or to[node.number] == found[parents[n]].number)
        assert len({node.number for node in found.values()}) == len(found)


def test_very_many_paragraphs(spark):
    """A page of 50,000, and two long lists that are unlike from their first element on."""
    body = "".join(f"<p>p{i}</p>" for i in range(50_000))
    said = "\n".join(f"p{i}" for i in range(50_000))
    assert _texts(spark, [("http://m/", f"<div>Menu</div><div>{body}</div>"), ("http://m/", f"<div>Menu</div><div><p>q</p></div>")]) == [
        said, "q"]
    draw = random.Random(3)
    left, right = (html.parse("".join(draw.choice(["<h2>t</h2>", "<p>x</p>", "<ul><li>a</ul>"]) for _ in range(6000))) for _ in range(2))
    tracemalloc.start()
    try:
        assert len(html.match(left, right)) > 5000
        assert tracemalloc.get_traced_memory()[1] < 200_000_000
    finally:
        tracemalloc.stop()
