from __future__ import annotations

import random

from clinlake.llm import html_text
from clinlake.llm.html_text import blocks, extract, shared_lines


def longest(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


def test_alignment_is_a_longest_common_subsequence(monkeypatch):
    draw = random.Random(3)
    for cells in (10**9, 8):
        monkeypatch.setattr(html_text, "CELLS", cells)
        for _ in range(300):
            a, b = ([draw.choice("abcd") for _ in range(draw.randint(0, 12))] for _ in range(2))
            found, rest = shared_lines(a, b), iter(b)
            assert len(found) == longest(a, b) and all(a[i] in rest for i in found)


def test_article_without_its_surroundings():
    page = (
        '<!DOCTYPE html><html><head><title>t</title><style>p{}</style></head><body><nav><a href="/">menu</a></nav>'
        '<div class="ad">buy</div><article><header><h1>Title &amp; more</h1><span>byline</span></header>'
        '<p>one<br>two&nbsp;three <b>bold</b><p>four <script>var x="</p>";</script> five</p><form>name<input></form>'
        '<div class="comments"><p>first!</p><div>second</div></div><p class=notice>cookies<p>cut off &am</article>'
        "<aside>more</aside><!-- </article> --><footer>&copy; site</footer>"
    )
    assert [t for t, _ in blocks(page)] == ["Title & more", "one two three bold", "four five", "cut off &am"]


def test_names_of_headings_and_parts_of_names_keep_text():
    kept = [
        '<h2 id="related-work">Related work</h2>',
        '<section id="social-history"><p>Social history</p></section>',
        '<h1 id="hidden-figures">Hidden figures</h1>',
        '<p class="widget-description">A widget</p>',
        "<p title=Don't>Hello there</p><p>it's fine</p>",
        '<p title="a > b" data-x=\'<div class="ad">\'>Quoted</p>',
        '<div class="share-prices"><p>Share prices</p></div>',
        '<h3 class="search">Search</h3>',
    ]
    gone = [
        '<div class="ad">x</div>', '<div id="sidebar-left">x</div>', '<p class="lead notice">x</p>', '<div id=comments>x</div>',
        '<div class="cookie-banner">x</div>', '<div class="ad-slot-3">x</div>', '<ul class="social share_links"><li>x</ul>',
        '<div id="comment-12">x</div>', "<span class='newsletter-signup-form'>x</span>", "<p style='display: none'>x</p>",
        '<h2 hidden>x</h2>', '<div role="banner">x</div>',
    ]
    body = "".join(a + b for a, b in zip(kept + [""] * 4, gone, strict=True))
    want = ["Related work", "Social history", "Hidden figures", "A widget", "Hello there", "it's fine", "Quoted", "Share prices", "Search"]
    assert blocks(f"<article>{body}</article>") == [(t, True) for t in want]
    assert [t for t, _ in blocks(body)] == [t for t in want if t != "Share prices"]


def test_unclosed_tags_and_quotes_end():
    assert blocks("<p>one <b title='x>two") == [("one two", False)]
    assert blocks("<p>one</p><p a=\"b>two</p>") == [("one", False), ("two", False)]
    assert blocks("<p>one</p><p " + "a='" * 50_000) == [("one", False)]


def test_differencing_deletes_what_neighbours_share(spark):
    page = "<body><p>Site name</p><p>Story {0} begins.</p><p>It goes on {0}.</p><p>Contact us</p></body>"
    rows = [(i, f"http://h.example/{i}", page.format(i)) for i in range(3)]
    found = {r["page_id"]: r for r in extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert found[1]["text"] == "Story 1 begins.\nIt goes on 1." and found[1]["lines_deleted"] == 2
    assert found[1]["n_chars"] == len(found[1]["text"])


def test_copies_of_an_article_keep_their_text(spark):
    page = "<body><div>Site</div><article><p>Same text.</p><p>Same text.</p></article></body>"
    rows = [(i, f"http://h.example/{i}", page) for i in range(4)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r["text"] for r in extract(df, group_pages=2).collect()} == {"Same text.\nSame text."}


def test_site_lines_inside_articles_go_and_quotations_stay(spark):
    page = "<body><article><h1>Story {0}</h1><p>Share this story now</p><p>It goes {0}.</p>{1}<p>And ends {0}.</p></article></body>"
    for n in (3, 9):
        rows = [(i, f"http://h.example/{i}", page.format(i, "<p>A quotation.</p>" if i in (1, 2) else "")) for i in range(n)]
        for group in (1, 2, 1000):
            found = extract(spark.createDataFrame(rows, "page_id long, url string, html string"), group_pages=group).collect()
            for r in found:
                i = r["page_id"]
                quoted = "A quotation.\n" if i in (1, 2) else ""
                assert r["text"] == f"Story {i}\nIt goes {i}.\n{quoted}And ends {i}." and r["lines_deleted"] == 1


def test_nearest_urls_are_compared_at_every_size(spark):
    # Sections of three pages share a menu; half of the pages differ in the query only.
    page = "<body><p>Section {1}</p><p>Text {0}.</p></body>"
    rows = [(i, f"http://h.example/{i // 3:03}/{i}" if i < 60 else f"http://h.example/z?id={i:03}", page.format(i, i // 3)) for i in range(120)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        made = [{r["page_id"]: (r["text"], r["lines_deleted"]) for r in extract(df, group_pages=g).collect()} for g in (1000, 10)]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert made[0] == made[1] and all(t == (f"Text {i}.", 1) for i, t in made[1].items())


def test_rows_of_every_kind(spark):
    rows = [
        (1, None, None), (2, "", ""), (None, "http://a/", "<p>x</p>"), (3, "http://a/", "<p>x</p>"), (3, "http://a/", "<p>x</p>"),
        (4, "not a url", "plain text"), (5, "http://b/", "<p>" + "long words " * 50_000 + "</p>"), (6, "http://c/", "<nav>never closed"),
        (7, "http://d/", "<<p a='>'>odd</ p>"),
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' as host", "1 as part", "'t' as text")
    found = {(r["page_id"], r["url"]): r["text"] for r in extract(df).collect()}
    assert extract(df).count() == len(rows)
    assert found[(1, None)] == "" and found[(2, "")] == "" and found[(4, "not a url")] == "plain text" and found[(6, "http://c/")] == ""
    assert len(found[(5, "http://b/")]) == 11 * 50_000 - 1
    assert extract(df.where("false")).collect() == []
