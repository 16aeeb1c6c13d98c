import json
import random
import re
import time
import tracemalloc
from types import SimpleNamespace

import pytest

from ledgerloom.llm import html_text as ht

PAGE = """<html><head><title>T</title><style>p{x}</style></head><body class="has-sidebar"><header><h1>Site</h1></header>
<div id="main-nav">x</div><div class="cookie-notice">We use</div><main><article class="post"><header><h1>Real &amp; title</h1></header>
<p>One <b>bold</b> text<br>next&nbsp;line</p><ul><li>a<li>b</ul><div class="ad">BUY</div><form><input>Name<select><option>o</select></form>
<table><tr><td>c1<td>c2</table><script>var a="</p>";</script><p>last <button>press</button> words</p>
<section id="comments"><article><p>nice</p></article></section></article></main><aside>side</aside><footer>F</footer>"""


def test_one_page():
    assert ht.extract(PAGE, None) == "Real & title\nOne bold text next line\na\nb\nc1\nc2\nlast words"


@pytest.mark.parametrize("page, text", [
    ("", ""), ("  \n", ""), ("<", "<"), ("a < b &lt; c &#233; &bogus;", "a < b < c é &bogus;"), ("<!-- x", ""), ("</p></div>x", "x"),
    ("<p>cut <div clas", "cut"), ("a<br>b", "a b"), ("<p>x</p>" * 500, "\n".join(["x"] * 500)),
    ("<div>" * 4000 + "deep" + "</div>" * 4000, "deep"), ("<pre>a\n  b</pre>", "a b"), ("<p>a<p>b<i>c</i>d", "a\nbcd"),
    ("<script>x</script><style>y</style><noscript>z</noscript>t", "t"),
    ("<body><nav>n</nav><article><p>x</p></article><div class='comments'><article>c</article></div>", "x"),
    ("<form><main><p>all in a form</p></main></form>", "all in a form")])
def test_single_pages(page, text):
    assert ht.extract(page, None) == text


def host_page(i):
    """A host without any telling tag or name: only what varies is content."""
    body = "".join(f"<p>paragraph {i} {k} says something of its own, number {i * 7 + k}</p>" for k in range(1 + i % 4))
    return (f"<div><div>Great Site</div><div><div>Welcome, dear reader</div><div><h2>Story {i}</h2>{body}"
            f"<p>Written by the desk</p></div></div><div>All rights reserved</div></div>")


def test_wrapper_finds_template_and_content():
    fitted = ht.Fitted(json.loads(ht.to_text(ht.induce([host_page(i) for i in range(6)]))))
    for i in (2, 7, 8):
        text = ht.extract(host_page(i), fitted)
        assert text.startswith(f"Story {i}\nparagraph {i} 0") and text.count("\n") == 1 + i % 4
        for fixed in ("Great Site", "Welcome", "rights"):
            assert fixed not in text


def test_copies_on_a_host_are_not_template():
    page = "<html><body><nav>m</nav><article><h1>Same</h1><p>the very same article</p></article></body></html>"
    fitted = ht.Fitted(json.loads(ht.to_text(ht.induce([page] * 8))))
    assert ht.extract(page, fitted) == "Same\nthe very same article"


def test_matching_against_all_pairings():
    class Tree:
        def __init__(self, sign, *children):
            self.sign, self.children = sign, list(children)

    a = Tree("r", Tree("x", Tree("p")), Tree("y"), Tree("x", Tree("p"), Tree("q")))
    b = Tree("r", Tree("x", Tree("p"), Tree("q")), Tree("z"))
    assert ht.match(a, b, {}) == 4
    assert [(x.sign, y.sign) for x, y in ht.paired(a, b, {})] == [("x", "x")]
    assert ht.match(Tree("a"), Tree("b"), {}) == 0


def old_table(a, b, kinds):
    """Score of two lists of structures by the full table."""
    row = [0] * (len(b) + 1)
    for x in a:
        above, row = row, [0]
        for j, y in enumerate(b):
            row.append(max(above[j + 1], row[j], above[j] + kinds.score(x, y)))
    return row[-1]


@pytest.mark.parametrize("seed", range(20))
def test_pairs_are_a_best_matching(seed):
    pick = random.Random(seed)

    def tree(depth):
        return SimpleNamespace(sign=pick.choice("ab"), children=[tree(depth - 1) for _ in range(pick.randrange(7))] if depth else [])

    a, b = tree(3), tree(3)
    scores = {}
    pairs = ht.paired(a, b, scores)
    places = [(a.children.index(x), b.children.index(y)) for x, y in pairs]
    assert places == sorted(places) and len({i for i, _ in places}) == len({j for _, j in places}) == len(places)
    kinds = scores["kinds"]
    lists = [[kinds.kind(c) for c in t.children] for t in (a, b)]
    assert sum(ht.match(x, y, scores) for x, y in pairs) == old_table(*lists, kinds)


@pytest.mark.parametrize("unlike", [False, True])
def test_very_long_pages(unlike):
    """20,000 alternating siblings, alike from the start or only after it: quick, and within memory."""
    def page(n, first):
        return "<html><body><article>" + first + "".join(f"<h2>t{i} {n}</h2><p>text {i} of {n}</p>" for i in range(n // 2)) + "</article></body></html>"

    pages = [page(20_000, ""), page(19_000, "<ul><li>x</li></ul><dl><dd>y</dd></dl>" if unlike else "")]
    tracemalloc.start()
    began = time.perf_counter()
    wrapper = ht.induce(pages)
    text = ht.extract(pages[0], ht.Fitted(json.loads(ht.to_text(wrapper))))
    took, peak = time.perf_counter() - began, tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert text.count("\n") == 19_999 and text.startswith("t0 20000\ntext 0 of 20000")
    assert took < 60 and peak < 400 << 20  # under tracing; about a tenth of the time without


def test_frames(spark):
    rows = [(i, f"http://h{i % 2}.example/{i}", host_page(i)) for i in range(20)] + [
        (3, "http://h1.example/3", host_page(3)), (None, None, "<p>x"), (50, "no address", None), (51, "http://one.example", PAGE)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'z' AS host", "'z' AS wrapper", "1 AS place", "'z' AS text")
    found = {r.page_id: r for r in ht.main_texts(frame, "page_id", "url", "html").collect()}
    assert ht.main_texts(frame, "page_id", "url", "html").count() == len(rows)
    assert found[None].text == "x" and found[50].text == "" and found[50].n_chars == 0
    assert found[4].text.startswith("Story 4\n") and "Great Site" not in found[4].text
    assert found[51].n_chars == len(found[51].text) and found[51].text.startswith("Real & title")
    assert ht.main_texts(frame.where("false"), "page_id", "url", "html").count() == 0


def test_wrappers_too_large_to_broadcast(spark, monkeypatch):
    frame = spark.createDataFrame([(i, f"http://h{i % 2}.example/{i}", host_page(i)) for i in range(12)], "page_id long, url string, html string")
    small = sorted(map(tuple, ht.main_texts(frame, "page_id", "url", "html").collect()))
    monkeypatch.setattr(ht, "BROADCAST_BYTES", -1)
    assert sorted(map(tuple, ht.main_texts(frame, "page_id", "url", "html").collect())) == small


def test_given_pages_are_their_documents(spark):
    """The pages are made of documents whose id is in the address; headings stand before them."""
    folder = "/root/testdata/sf0.01"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    checked = 0
    for r in ht.main_texts(pages, "page_id", "url", "html").collect():
        text = docs.get(int(re.search(r"/[a-z]{2}/(\d+)", r.url)[1]))
        if text:
            lines = [" ".join(x.split()) for x in text.split("\n")]
            assert r.text.split("\n")[1:] == [x for x in lines if x]
            checked += 1
    assert checked > 100


def induced(page, n=8):
    return ht.Fitted(json.loads(ht.to_text(ht.induce([page(i) for i in range(n)]))))


def told(i, name, k):
    return " ".join(f"{name}{i}x{j}" for j in range(k))


def siblings(i):
    """Headline, lead and body in sibling blocks, the body with most of the text."""
    return (f"<div class=top>Great Site</div><div class=wrap><div class=title>{told(i, 'head', 2)}</div><div class=lead>{told(i, 'lead', 9)}</div>"
            f"<div class=story><p>{told(i, 'a', 30)}</p><p>{told(i, 'b', 30)}</p></div></div><div class=end>All rights</div>")


def in_main(i):
    return f"<div>Site</div><main><h1>{told(i, 'head', 2)}</h1><p>{told(i, 'lead', 5)}</p><article><p>{told(i, 'a', 40)}</p></article></main>"


def beside_article(i):
    return f"<div>Site</div><div class=title>{told(i, 'head', 2)}</div><article><p>{told(i, 'a', 40)}</p></article>"


@pytest.mark.parametrize("page, parts", [
    (siblings, [("head", 2), ("lead", 9), ("a", 30), ("b", 30)]), (in_main, [("head", 2), ("lead", 5), ("a", 40)]), (beside_article, [("head", 2), ("a", 40)])])
def test_all_varying_text_is_read(page, parts):
    fitted = induced(page)
    for i in (3, 11):
        assert ht.extract(page(i), fitted) == "\n".join(told(i, *p) for p in parts)


def test_parts_the_wrapper_does_not_know_are_read():
    page = siblings(9).replace("<div class=end>", "<div class=more>one more part</div><div class=end>")
    assert ht.extract(page, induced(siblings)) == ht.extract(siblings(9), None).removeprefix("Great Site\n").removesuffix("All rights") + "one more part"
    no_article = beside_article(9).replace("article", "section")
    assert told(9, "a", 40) in ht.extract(no_article, induced(beside_article))


@pytest.mark.parametrize("page, text", [
    ("<body><div>Site</div><article class='post comments-open'><p>all of it</p></article></body>", "all of it"),
    ("<article class='widget' id='notice'><p>all of it</p></article>", "all of it"),
    ("<div class='content no-sidebar'><p>all of it</p></div>", "all of it"),
    ("<div class='page-with-sidebar'><div class='entry share-enabled'><p>all of it</p></div><div class='share'>s</div></div>", "all of it"),
    ("<div class='sidebar'><article><p>one</p></article></div><div class='widget'><article><p>two</p></article></div>", "one\ntwo"),
    ("<div class='widget'><main><p>all of it</p></main></div><article>a</article>", "all of it\na"),
    ("<div class='widget'><p>the long text of a page</p></div><div class='share-buttons'>s</div>", "the long text of a page"),
    ("<article><p>one</p><div class='notice'>two</div><section class='discussion'>three</section><div class='ad-box'>x</div></article>", "one\ntwo\nthree"),
    ("<article><div class='comments'>the long text of an article</div><p>end</p></article>", "the long text of an article\nend"),
    ("<article>short</article><div class='comments'>many and long comments of readers</div>", "short"),
    ("<body><form><p>the long text of a page</p><button>go</button></form><div>x</div></body>", "the long text of a page\nx"),
    ("<article>short<form>a long form with many labels</form></article>", "short"), ("<form>ask</form><p>the long text</p>", "the long text"),
    ("<p><span class='ad'>x</span>some text</p>", "some text"), ("<p><span class='promo'>the long text</span> end</p>", "the long text end")])
def test_names_drop_no_main_text(page, text):
    assert ht.extract(page, None) == text


def test_templates_of_rare_layouts_come_from_all_pages(spark):
    """A host with a layout of a tenth of its pages, a layout of two pages and many copies of one page."""
    def page(i):
        note = "<div class=byline>Written by the night desk</div>" if i % 10 == 3 else "<div class=once>x</div>" if i in (50, 51) else ""
        return f"<div class=top>Great Site</div><div class=story><p>{told(i, 'a', 20)}</p><p>{told(i, 'b', 20)}</p></div>{note}"

    copy = page(1000) + "<section class=odd>said once</section>"
    rows = [(i, f"http://hot.example/{i}", page(i)) for i in range(100)] + [(1000 + i, f"http://hot.example/c{i}", copy) for i in range(60)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(7)
    for r in ht.main_texts(frame, "page_id", "url", "html").collect():
        i = min(r.page_id, 1000)
        more = "\nsaid once" if i == 1000 else "\nx" if i in (50, 51) else ""
        assert r.text == told(i, "a", 20) + "\n" + told(i, "b", 20) + more


def test_text_beside_articles_is_read_however_few_pages_have_it(spark):
    """A lead beside the article on one page of many, on a page that is not aligned, and in a layout of two."""
    def page(i):
        lead = f"<p>{told(i, 'lead', 8)}</p>" if i in (3, 20, 31) else ""
        more = f"<div class=odd><h2>{told(i, 'more', 3)}</h2></div>" if i in (50, 51) else ""
        return f"<div class=top>Great Site</div>{lead}{more}<article><p>{told(i, 'a', 40)}</p></article><div class=end>All rights</div>"

    rows = [(i, f"http://hot.example/{i}", page(i)) for i in range(60)] + [(100, "http://lone.example/", page(99))]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    for r in ht.main_texts(frame, "page_id", "url", "html").collect():
        i = 99 if r.page_id == 100 else r.page_id
        want = [told(i, "lead", 8)] * (i in (3, 20, 31)) + [told(i, "more", 3)] * (i in (50, 51)) + [told(i, "a", 40)]
        assert r.text == "\n".join(want), r


def test_pages_that_differ_in_classes_of_the_body_are_one_layout(spark):
    rows = [(i, f"http://h.example/{i}", f"<body class='tag-{chr(97 + i % 26)}x{'y' * (i // 26)}'><div>Great Site</div><article class='category-{told(i, 'c', 1)}'>"
             f"<p>{told(i, 'a', 20)}</p><p>Written by the desk</p></article><div>All rights</div></body>") for i in range(30)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.page_id: r.text for r in ht.main_texts(frame, "page_id", "url", "html").collect()} == {i: told(i, "a", 20) for i in range(30)}
