from __future__ import annotations

import pytest

from tracebook.llm import html_text

PAGE = "page_id long, url string, html string"


def page(i, article, menu="Home"):
    return (
        f'<html><head><title>T{i}</title><script>var a="</p>";</script></head><body><nav><ul><li><a href="/">{menu}</a>'
        f"<li><a>About</a></ul></nav><div class=wrap><article><h1>Story {i}</h1>{article}<div>Share this story now</div>"
        f"</article></div><footer>&copy; site</footer></body></html>"
    )


CASES = [
    ("<article><p>a &amp; b&nbsp; c<br>d</p>\n<p>e</article>", "a & b c d\ne"),
    ("<p>x</p><!-- <p>no</p> --><style>p{}</style><P CLASS='a>b'>y <b>bold</b>er", "x\ny bolder"),
    ("<main><header><h1>Title</h1><p>by line</p></header><p>text</p><aside>side</aside></main>", "Title\ntext"),
    ("<article><p>one</p><section id=comments><p>troll</p></section></article><p>out</p>", "one"),
    ("<article><form>f</form><button>b</button><p role='alert'>cookie</p><p>t&#233;xt &lt;tag&gt;</p>", "téxt <tag>"),
    ("<article><div class='related posts'><p>r</p></div><ul><li>i<li>j</ul><p>p</article>", "i\nj\np"),
    ("<p><b>soup<p>next</i></p></div>end", "soup\nnext\nend"),
    ('<article><p title="unclosed>a</p><p>b</p></article>', "a\nb"),
    ("<article><pre>a\n  b</pre><hr><p>c</p></article>", "a b\nc"),
    ("plain text  only", "plain text only"),
    ("<noscript><p>n</p></noscript><svg><text>s</text></svg><p hidden>h</p><p style='display: none'>d</p>", ""),
    ("", ""),
    ("<", ""),
    ("<article>cut off <p>in the mid", "cut off\nin the mid"),
]


@pytest.mark.parametrize("source,text", CASES)
def test_blocks_of_single_pages(source, text):
    assert html_text.main_text(source, set(), set()) == text


def test_template_of_a_host(spark):
    rows = [(i, f"https://a.example.org/{i}", page(i, f"<p>Words number {i} of a text that is long.</p><p>More {i * 7}"))
            for i in range(20)]
    table = spark.createDataFrame(rows, PAGE).withColumn("host", html_text.F.lit("clash"))
    read = table.select("page_id", html_text.host_of(table.url).alias("host"),
                        html_text.F.xxhash64("html").alias("page_key"), "html")
    classes = html_text.equivalence_classes(read).collect()
    assert any(c.pages == c.total == c.host_pages == 20 for c in classes)
    (found,) = html_text.templates(read).collect()
    assert len(found.skeleton) >= 5 and len(found.constants) >= 3
    # text that all pages share is template, inside the article too
    got = {r.page_id: r for r in html_text.extract(table).collect()}
    assert got[3].text == "Story 3\nWords number 3 of a text that is long.\nMore 21"
    assert got[3].n_chars == len(got[3].text)


def test_copies_and_small_hosts_keep_their_text(spark):
    copies = [(i, "https://b.example.org/x", page(1, "<p>The same text on every page of this host.")) for i in range(12)]
    small = [(50 + i, "https://c.example.org/x", page(i, "<p>one of two")) for i in range(2)]
    odd = [(90, None, "<p>no url"), (91, "not a url", "<p>odd"), (92, "https://d.example.org", None), (None, "x", "<p>y")]
    got = {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(copies + small + odd, PAGE)).collect()}
    assert all("The same text on every page of this host." in got[i] for i in range(12))
    assert got[50] == "Story 0\none of two\nShare this story now"
    assert (got[90], got[91], got[92], got[None]) == ("no url", "odd", "", "y")


def test_pages_without_article_tags_use_the_slots_of_the_template(spark):
    def bare(i):
        links = "".join(f"<li><a href=/{k}>Link number {k}</a></li>" for k in range(5))
        return (f"<body><ul>{links}</ul><div id=top>{i}:{i * 3}</div><div id=body><p>{'long text ' * 9}{i}</p><p>and {i}"
                f" more of it</p></div><div id=end>Site {i}</div></body>")  # fmt: skip

    rows = [(i, f"http://e.example.org/{i}", bare(i)) for i in range(15)]
    got = {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(rows, PAGE)).collect()}
    assert got[4] == f"{'long text ' * 9}4\nand 4 more of it"


def test_pages_without_article_tags_keep_heading_lead_lists_and_links(spark):
    def bare(i, paragraphs):
        body = "".join(f"<p>{f'sentence {i} {k} ' * 6}</p>" for k in range(paragraphs))
        return (f"<body><div class=top><ul><li><a href=/>Home {i}</a></li></ul></div><div class=text><h1>Title {i}</h1>"
                f"<p class=lead>Lead {i}</p>{body}<ul><li>first {i}<li><a href=x>second {i}</a></ul></div>"
                f"<div class=end>Printed {i}</div></body>")  # fmt: skip

    for paragraphs in (1, 4):
        rows = [(i, f"http://g.example.org/{i}", bare(i, paragraphs)) for i in range(15)]
        got = {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(rows, PAGE)).collect()}
        body = [(f"sentence 4 {k} " * 6).strip() for k in range(paragraphs)]
        assert got[4].split("\n") == ["Title 4", "Lead 4", *body, "first 4", "second 4"]
    # the template finds the article: without it the page is one slot and all its blocks stay
    assert html_text.main_text(bare(4, 4), set(), set()).startswith("Home 4\nTitle 4\n")


def read_of(table):
    key = html_text.F.xxhash64("page_id", "html").alias("page_key")
    return table.select(html_text.host_of(table.url).alias("host"), key, "html")


def test_names_that_may_mark_furniture_are_told_by_the_template(spark):
    """share-price stands in one article, promo-teaser on all pages: only the host's pages tell which is furniture."""
    def full(i):
        own = "<div class=share-price><p>Shares closed at 7</p></div>" if i == 4 else ""
        return page(i, f"<p>Words number {i} of this text.</p>{own}<div class=promo-teaser><p>Buy number {i * 3}</p></div>")

    rows = [(i, f"https://h.example.org/{i}", full(i)) for i in range(30)]
    table = spark.createDataFrame(rows, PAGE)
    got = {r.page_id: r.text for r in html_text.extract(table).collect()}
    assert got[4] == "Story 4\nWords number 4 of this text.\nShares closed at 7"
    assert got[5] == "Story 5\nWords number 5 of this text."
    # without the template both are taken for furniture, and the line of all pages stays
    assert html_text.main_text(full(4), set(), set()) == "Story 4\nWords number 4 of this text.\nShare this story now"
    assert html_text.names_furniture("reader-comments-2") == (True, False)
    assert html_text.names_furniture("related-work") == (False, True)


def test_each_kind_of_pages_has_its_template(spark):
    """Two kinds of pages that share nothing but the frame: classes of half the pages tell the article."""
    def story(i):
        return (f"<html><body><div class=ma><ul><li>Menu {i}</ul></div><div class=mb><h1>Story {i}</h1>"
                f"<p>{f'tale {i} ' * 20}</p><ul><li>point {i}</ul></div><div class=mc><p>Printed {i}</p></div></body></html>")

    def review(i):
        return (f"<html><body><section class=ra><p>Rated {i}</p></section><section class=rb><h2>Review {i}</h2>"
                f"<p>{f'verdict {i} ' * 20}</p></section><section class=rc><p>Visits {i * 7}</p></section></body></html>")

    rows = [(i, f"https://k.example.org/{i}", (story if i % 2 else review)(i)) for i in range(24)]
    table = spark.createDataFrame(rows, PAGE)
    (found,) = html_text.templates(read_of(table)).collect()
    assert len(found.kinds) > len(found.skeleton) >= 3
    got = {r.page_id: r.text for r in html_text.extract(table).collect()}
    assert got[5] == f"Story 5\n{('tale 5 ' * 20).strip()}\npoint 5"
    assert got[8] == f"Review 8\n{('verdict 8 ' * 20).strip()}"
    # the outer template alone does not tell the article from the rest of the page
    assert html_text.main_text(story(5), set(found.skeleton), set()).startswith("Menu 5\nStory 5\n")


def test_very_long_pages_and_empty_tables(spark):
    long = "<article>" + "<p>word &amp; word</p>" * 100_000
    table = spark.createDataFrame([(1, "http://f.example.org", long)], PAGE)
    assert html_text.extract(table).first().n_chars == 100_000 * 12 - 1
    assert html_text.extract(table.limit(0)).collect() == []
