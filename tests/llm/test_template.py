"""Operator 8 on made pages and on the table."""

import html
import re

from pitwise.llm import template
from tests.llm.helpers import SF

SCHEMA = "page_id long, url string, html string"


def texts(spark, pages):
    """``pages`` of (url, html)."""
    df = spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(pages)], SCHEMA)
    rows = {r.page_id: r for r in template.extract(df).collect()}
    assert len(rows) == len(pages)
    for r in rows.values():
        assert r.n_chars == len(r.text)
    return [rows[i].text for i in range(len(pages))]


def one(spark, page):
    return texts(spark, [("http://h/x", page)])[0]


def test_articles_of_the_table(spark):
    from pitwise.llm.registry import queries

    out = {r.page_id: r.text for r in queries()["op8_template_deduction"](spark, SF).collect()}
    for p in spark.read.parquet(f"{SF}/pages.parquet").collect():
        own = re.search("<article>(.*?)</article>", p.html, re.DOTALL)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", x)).split()) for x in re.split("</?p>|</?h1>", own)]
        assert out[p.page_id] == "\n".join(b for b in blocks if b)


def test_references_white_space_blocks_and_left_out_places(spark):
    page = """<!doctype html><head><title>T</title><style>p{}</style></head><body class="page">
    <header><h1>Site</h1></header><nav>Menu</nav><div id="cookie-notice">We use cookies</div>
    <article><header><h1>Caf&eacute; &amp;  &#x41;&lt;b&gt;</h1></header><p>one<br>two <b>three
    </b>four<p>five <script>x("</p>")</script>six</p><div class="ad box">buy</div><!-- c --><ul><li>a<li>b</ul>
    <form>mail <input></form><aside>see also</aside><section class="comments"><p>first!</p></section></article>
    <div class="sidebar"><p>side</p></div><footer>foot</footer>"""
    assert one(spark, page) == "Café & A<b>\none two three four\nfive six\na\nb"


def test_odd_pages(spark):
    pages = [None, "", "plain  text", "<p>open", "<article>cut <b>of", "a < b and <3", "<article><p>x</article><p>y", '<div class="ad><p>q</p>', "<nav>m<article>t</article>", "<script>no end"]
    want = ["", "", "plain text", "open", "cut of", "a < b and <3", "x", "", "t", ""]
    assert texts(spark, [(f"http://{i}/", p) for i, p in enumerate(pages)]) == want
    assert texts(spark, [(None, "<article>a</article>"), (None, "<article>a</article>"), ("no url", "<p>z")]) == ["a", "a", "z"]
    empty = spark.createDataFrame([], SCHEMA)
    assert template.extract(empty).count() == 0


def test_repeated_rows_null_ids_and_clashing_columns(spark):
    rows = [(1, "http://h/", "<article>a</article>", "x")] * 5 + [(None, "http://h/", "<article>b</article>", "y")]
    df = spark.createDataFrame(rows, SCHEMA + ", text string").withColumnsRenamed({"text": "blocks"})
    out = template.extract(df.selectExpr("*", "1 as text", "2 as host", "3 as uid")).collect()
    assert sorted((r.page_id or 0, r.text) for r in out) == [(0, "b")] + [(1, "a")] * 5


def test_template_text_of_a_host_is_left_out_beyond_articles(spark):
    page = lambda i, items: f"<html><body><div>Share this page</div><div><h2>Title {i}</h2><p>Body of {i}.</p></div><ul>{items}</ul><div>All rights reserved</div></body></html>"
    pages = [("http://same.example/" + str(i), page(i, "<li>x</li>" * (1 + i % 3))) for i in range(8)]
    pages += [("http://lone.example/", page(99, "<li>x</li>"))]
    out = texts(spark, pages)
    for i in range(8):
        kept = out[i].split("\n")
        assert kept[:2] == [f"Title {i}", f"Body of {i}."] and "Share this page" not in kept and "All rights reserved" not in kept
    assert out[8].split("\n")[0] == "Share this page"  # one page shows no template


def test_text_in_an_article_is_never_taken_for_template(spark):
    pages = [(f"http://same.example/{i}", f"<body><article><p>Same line</p><p>{i}</p></article></body>") for i in range(9)]
    assert texts(spark, pages) == [f"Same line\n{i}" for i in range(9)]


def test_classes_out_of_order_are_no_template(spark):
    a, b = "<div>alpha</div>", "<section>beta</section>"
    pages = [(f"http://mixed.example/{i}", a + b if i % 2 else b + a) for i in range(10)]
    assert set(texts(spark, pages)) == {"alpha\nbeta", "beta\nalpha"}


def test_wrappers_with_telling_names_keep_the_article(spark):
    article = '<article><header class="entry-header"><h1>Title</h1></header><div class="post-header">By me</div><p>text</p></article>'
    for around in ('<div class="content-sidebar-wrap"><main>', '<div class="no-sidebar">', '<div id="share-page">', '<main><div class="sidebar">'):
        assert one(spark, f"<body>{around}{article}") == "Title\nBy me\ntext"
    assert one(spark, '<body><div class="widget"><div role=main class="comments"><p>x</div></div><div class="widget">y</div>') == "x"
    assert one(spark, '<body><div class="no-sidebar"><p>x</p><div class="ad">y</div></div>') == "x"
    assert one(spark, '<body><div id="share-page"><p>x</p><div class="ad">y</div></div>') == "x"
    after = '<div class="comments"><article>first!</article></div>'
    assert one(spark, f"<body><main><article>x{after}</article>{after}</main>") == "x"


def test_copies_of_a_page_are_no_template(spark):
    page = lambda i: f"<body><div><h2>Title {i}</h2><p>First of {i}.</p><p>Second of {i}.</p></div>"
    pages = [(f"http://copies.example/{i}", page(0)) for i in range(6)] + [("http://copies.example/x", page(1)), ("http://copies.example/y", page(2))]
    pages += [("http://repeated.example/", page(i % 4)) for i in range(8)]
    assert texts(spark, pages) == [f"Title {i}\nFirst of {i}.\nSecond of {i}." for i in [0] * 6 + [1, 2] + [0, 1, 2, 3] * 2]


def test_sections_of_a_host_have_their_own_template(spark):
    page = lambda s, i: f"<body><div>All of the site</div><div>Menu of {s}</div><{s}>Notice of {s}</{s}><div><h2>Title {i}</h2><p>Body of page {i} in {s}.</p></div>"
    sections = ("section", "center", "blockquote")
    pages = [(f"http://layouts.example/{i}", page(sections[i % 3], i)) for i in range(12)]
    pages += [(f"http://layouts.example/plain/{i}", f"<p>Only {i}</p>") for i in range(20)]
    want = [f"Title {i}\nBody of page {i} in {sections[i % 3]}." for i in range(12)] + [f"Only {i}" for i in range(20)]
    out = texts(spark, pages)
    assert [o.removeprefix("All of the site\n") for o in out] == want


def test_near_copies_keep_their_text(spark):
    paragraphs = "".join(f"<p>Paragraph {k} of the text that all of them hold.</p>" for k in range(6))
    pages = [(f"http://near.example/{i}", f"<body><div>{paragraphs}<p>Visit {i}</p></div>") for i in range(5)]
    assert all(o.startswith("Paragraph 0 of") and o.endswith(f"Visit {i}") for i, o in enumerate(texts(spark, pages)))


def test_order_is_that_of_the_page_for_tags_and_text_together(spark):
    page = lambda i: f"<section><p>Own text {i} of the page.</p></section>"
    pages = [(f"http://order.example/{i}", f"<body>Promo{page(i)}" if i % 2 else f"<body>{page(i)}Promo") for i in range(8)]
    assert all("Promo" in o for o in texts(spark, pages))  # now before, now after the section
    pages = [(f"http://order.example/{i}", f"<body>Promo{page(i)}") for i in range(8)]
    assert not any("Promo" in o for o in texts(spark, pages))


def test_very_long_pages_and_equal_blocks(spark):
    body = "".join(f"<p>Paragraph {i} of a long page.</p>" for i in range(20_000))
    pages = [("http://long.example/1", f"<body><nav>Menu</nav><article>{body}</article>"), ("http://long.example/2", "<p>" + "word " * 300_000), ("http://long.example/3", "<div>" * 3000 + "deep")]
    out = texts(spark, pages)
    assert out[0].count("\n") == 19_999 and out[1] == ("word " * 300_000).strip() and out[2] == "deep"
    page = lambda i: f"<body><div>Promo</div><div>Promo</div><h2>Title {i}</h2><p>Body of page {i} on its own.</p><footer>x</footer>"
    assert texts(spark, [(f"http://twice.example/{i}", page(i)) for i in range(6)]) == [f"Title {i}\nBody of page {i} on its own." for i in range(6)]


def at(*tokens):
    """A class of a page: the places of each of its tokens."""
    return {"cls": len(tokens) * 100 + tokens[0][0], "n": 3, "size": len(tokens), "at": [list(x) for x in tokens]}


def test_nesting_and_slots_against_brute_force():
    import random

    draw = random.Random(5)
    for _ in range(300):
        places = list(range(24))
        draw.shuffle(places)
        classes = []
        for _ in range(3):  # in order, occurrence after occurrence
            size, times = draw.choice([(2, 1), (3, 1), (2, 2)])
            own = sorted(places.pop() for _ in range(size * times))
            classes.append(at(*[own[k::size] for k in range(size)]))
        inside, crossed = template.nesting(classes)
        spans = [list(zip(*x["at"], strict=True)) for x in classes]
        clean = True
        for c in range(3):
            for d in range(3):
                if c == d:
                    continue
                for k in range(len(classes[d]["at"]) - 1):
                    begun = sum(any(s[k] < o[0] < s[k + 1] for s in spans[d]) for o in spans[c])
                    assert inside[c, d, k] == begun
                cross = any(s[0] < o[0] < s[-1] and any(o[0] < x < o[-1] for x in s) for s in spans[c] for o in spans[d])
                assert ((c, d) in crossed) == cross
                clean &= not cross
        if clean:
            taken = {p for x in classes for t in x["at"] for p in t}
            for p, slot in enumerate(template.cut(classes, list(range(24)))):
                around = [(o[0], c, sum(x <= p for x in o) - 1) for c in range(3) for o in spans[c] if o[0] <= p < o[-1]]
                want = template._token("slot", str(classes[max(around)[1]]["cls"]), str(max(around)[2])) if around else 0
                assert slot == (None if p in taken else want)


def template_texts(spark, pages):
    """Of distinct ``pages`` (html) of one host: each one's text tokens that are part of the template."""
    df = spark.createDataFrame([(i, "h", p) for i, p in enumerate(pages)], "uid long, host string, html string")
    rows = template.template_tokens(template.distinct_pages(df)).collect()
    blocks = [{b.at: b.text for b in template.parse(p)[0]} for p in pages]
    return [{blocks[i][p] for r in rows if r.uid == i for t in r["at"] for p in t if p in blocks[i]} for i in range(len(pages))]


def test_classes_that_are_not_nested_are_no_template(spark):
    own = lambda i: f"<p>Own text number {i} of the page, long enough to be its own.</p>"
    # x and y cross a to c on six of twelve pages; on the others there is a to c only.
    page = lambda i: f"<h1>a</h1>{'<h2>x</h2>' * (i % 2)}<h3>b</h3>{'<h4>y</h4>' * (i % 2)}{own(i)}<h5>c</h5>"
    got = template_texts(spark, [page(i) for i in range(12)])
    assert got == [{"a", "b", "c"}] * 12
    nested = lambda i: f"<h1>a</h1>{'<h2>x</h2><h4>y</h4>' * (i % 2)}<h3>b</h3>{own(i)}<h5>c</h5>"
    assert template_texts(spark, [nested(i) for i in range(12)]) == [{"a", "b", "c"} | ({"x", "y"} if i % 2 else set()) for i in range(12)]
    # Before b on some pages and after it on others.
    moved = lambda i: f"<h1>a</h1>{'<h2>x</h2><h4>y</h4>' * (i % 4 == 1)}<h3>b</h3>{'<h2>x</h2><h4>y</h4>' * (i % 4 == 3)}{own(i)}<h5>c</h5>"
    assert template_texts(spark, [moved(i) for i in range(12)]) == [{"a", "b", "c"}] * 12


def test_occurrences_of_a_class_keep_its_order(spark):
    own = lambda i: f"<p>Own text number {i} of the page, long enough to be its own.</p>"
    row = "<h2>x</h2><h4>y</h4>"
    page = lambda i: f"<h1>a</h1>{row * (1 + i % 3)}<h3>b</h3>{own(i)}"
    assert template_texts(spark, [page(i) for i in range(9)]) == [{"a", "b", "x", "y"}] * 9
    mixed = lambda i: f"<h1>a</h1>{'<h2>x</h2>' * (1 + i % 3)}{'<h4>y</h4>' * (1 + i % 3)}<h3>b</h3>{own(i)}"
    assert template_texts(spark, [mixed(i) for i in range(9)]) == [{"a", "b"}] * 9


def test_articles_that_are_template_from_end_to_end_are_left_out(spark):
    page = lambda i: f"<body><article>Join our club</article><article><h1>Title {i}</h1><p>Same line</p><p>Body of {i} with text of its own.</p></article>"
    want = [f"Title {i}\nSame line\nBody of {i} with text of its own." for i in range(6)]
    assert texts(spark, [(f"http://club.example/{i}", page(i)) for i in range(6)]) == want
    assert one(spark, page(0)) == "Join our club\n" + want[0]  # one page shows no template


def test_slots_of_articles_are_taken_on_pages_without(spark):
    page = lambda i, own: f"<body><div>Menu</div><h2>Top</h2>{own}<h3>Bottom</h3><p>Seen {i} times this week.</p>"
    article = [page(i, f"<article><p>Article {i} with text of its own.</p></article>") for i in range(4)]
    plain = [page(i, f"<section><p>Section {i} with text of its own and more.</p></section>") for i in range(4, 8)]
    short = [page(8, "<section><p>8</p></section>")]
    out = texts(spark, [(f"http://slots.example/{i}", p) for i, p in enumerate(article + plain + short)])
    assert out[:4] == [f"Article {i} with text of its own." for i in range(4)]
    assert out[4:8] == [f"Section {i} with text of its own and more." for i in range(4, 8)]
    assert out[8] == "8\nSeen 8 times this week."  # less than half of its text is there
    alone = texts(spark, [(f"http://plain.example/{i}", p) for i, p in enumerate(plain)])
    assert alone == [f"Section {i} with text of its own and more.\nSeen {i} times this week." for i in range(4, 8)]
