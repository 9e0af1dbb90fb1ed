import pytest

from brookhouse.llm.pages import Page, main_texts, op9_pages
from tests.conftest import SF

MENU = "<nav><ul><li><a href='/a'>Menu one</a></li><li>Menu two</li></ul></nav>"


def page(body, head="<title>T</title><style>p{}</style><script>var t='</p><article>no</article>';</script>"):
    return f"<!DOCTYPE html><html><head>{head}</head><body>{MENU}{body}<footer>&copy; Site</footer></body></html>"


def extract(spark, *rows):
    rows = [(i, *r) for i, r in enumerate(rows)]
    out = main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    return [r.text for r in sorted(out, key=lambda r: r.page_id)]


def test_boilerplate_and_blocks(spark):
    body = """<header>Site name</header><div class="ad">Buy &amp; more</div><aside>Side</aside><div id="cookie-notice">Cookies</div>
      <article><h1>Head  &amp;\n line</h1><p>One <b>bo</b>ld &lt;x&gt;<!-- no --> two<br>three</p><p>Unclosed <i>text<p>Next&nbsp;one</p>
      <form><input value="x">Name</form><ul><li>Item 1<li>Item 2</ul><div class="comments"><p>First!</p></div></article>"""
    assert extract(spark, ("http://h/1", page(body))) == ["Head & line\nOne bold <x> two three\nUnclosed text\nNext one\nItem 1\nItem 2"]


def test_the_host_decides(spark):
    def make(text, aside):
        return page(f"<div class='c1'><p>{text}</p></div><div class='box{len(aside)}'><p>{aside}</p></div>")
    pages = [("http://h/x", make("long text " * 40, "short")) for _ in range(5)] + [("http://h/odd", make("brief", "aside text " * 90))]
    got = extract(spark, *pages, ("http://other/x", make("brief", "aside text " * 90)))
    assert got[0] == ("long text " * 40).strip() and got[5] == "brief" and got[6] == ("aside text " * 90).strip()


def test_edge_cases(spark):
    long = "word " * 30_000
    rows = [("http://h/1", None), (None, ""), ("no scheme", "plain text"), ("http://h/2", page(f"<article><p>{long}</p></article>")),
            ("http://h/3", "<html><body><article><p>cut off &am"), ("http://h/4", "<p>a <"), ("http://h/5", "<<p>>x<!--"), ("http://h/6", "<p title='never ended>text</p>"),
            ("http://h/7", "<script>x"), ("http://h/7", "<script>x")]
    got = extract(spark, *rows)
    assert got[:4] == ["", "", "plain text", long.strip()] and got[4] == "cut off &am" and got[8] == got[9] == ""
    df = spark.createDataFrame([(1, "http://h/", "<p>x</p>", 3, 4)], "page_id long, url string, html string, host int, text int")
    assert [tuple(r) for r in main_texts(df).collect()] == [(1, "http://h/", "x", 1)]
    assert main_texts(df.limit(0)).count() == 0


@pytest.mark.parametrize("html", ["<div>" * 3000 + "x", "<p>" * 3000 + "x", "</div>" * 3000 + "x", "<a href=\"" * 300])
def test_deep_or_broken_markup(html):
    assert [b[1] for b in Page(html).blocks] in (["x"], [])


def test_query_covers_all_pages(spark):
    rows = op9_pages(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/pages.parquet").count() and all(r.n_chars == len(r.text) for r in rows)
    assert all(r.text for r in rows)


def test_nothing_of_the_article_is_lost(spark):
    lead = "<h1>Head</h1><p>The lead</p>"
    bodies = [f"<article>{lead}<div class='body'><p>{'long text ' * 90}</p></div></article>",
              f"<div class='post'>{lead}<div class='body'><p>{'long text ' * 90}</p></div></div>",
              f"<article>{lead}<section><p>{'one part ' * 40}</p></section>between<section><p>{'next part ' * 40}</p></section></article>",
              f"<div class='a'><div class='body'>{'b' * 600}</div><div class='more'>{'m' * 400}</div></div>"]
    got = extract(spark, *((f"http://h{k}/{n}", page(body)) for k, body in enumerate(bodies) for n in range(3)))
    text, one, two = ("long text " * 90).strip(), ("one part " * 40).strip(), ("next part " * 40).strip()
    want = [f"Head\nThe lead\n{text}", f"Head\nThe lead\n{text}", f"Head\nThe lead\n{one}\nbetween\n{two}", f"{'b' * 600}\n{'m' * 400}"]
    assert got == [x for x in want for _ in range(3)]


def test_two_templates_of_a_host(spark):
    news = [("http://h/n", page(f"<div class='news'><p>{'news text ' * 50}</p></div>")) for _ in range(8)]
    blog = [("http://h/b", page(f"<div class='news'><p>teaser</p></div><div class='blog'><p>{'blog text ' * 90}</p></div>")) for _ in range(2)]
    bare = [("http://h/c", page(f"<div class='news'><p>{'teaser ' * 9}</p></div><p>{'bare text ' * 90}</p>")) for _ in range(2)]
    got = extract(spark, *news, *blog, *bare)
    assert got[:8] == [("news text " * 50).strip()] * 8
    assert all(("blog text " * 90).strip() in x for x in got[8:10]) and all(("bare text " * 90).strip() in x for x in got[10:])


def test_end_tags_left_out_after_a_marked_element(spark):
    bodies = [
        ("<article><h1>T</h1><p class='notice'>Cookie note<p>Para one<p>Para two</article>", "T\nPara one\nPara two"),
        ("<article><ul><li class=share>x<li>Item one<li>Item two</ul><p>After</p></article>", "Item one\nItem two\nAfter"),
        ("<article><ul><li class=share>x<ul><li>inner</ul><li>Item one</ul>After</article>", "Item one\nAfter"),
        ("<article><p class=ad>Buy<div>Text</div><p>More</article>", "Text\nMore"),
        ("<article><dl><dt class=ad>Buy<dd class=promo>now<dt>Term<dd>Said</dl>End</article>", "Term\nSaid\nEnd"),
        ("<article><table><tr><td class=sponsor>Buy<td>One<tr class=ad><td>x<td>y<tr><td>Two</table>End</article>", "One\nTwo\nEnd"),
        ("<article><ul><li class=share>x</ul><p>After</p></article>", "After"),
        ("<article><p class=notice>Note</p>Text<p>More</article>", "Text\nMore"),
        ("<article><blockquote class=promo>Buy<p>now</p></blockquote><p>More</article>", "More"),
    ]
    assert extract(spark, *((f"http://e{k}/", page(body)) for k, (body, _) in enumerate(bodies))) == [want for _, want in bodies]


def test_names_count_as_a_whole(spark):
    parts = [("section class='search-methods'", True), ("div class='notice-of-motion'", True), ("p data-id='menu'", True), ("p data-class=ad", True), ("p title='class=ad'", True),
             ("div id=related_work", True), ("div class='story advert'", False), ("div class='cookie-notice'", False), ("div ID='siteFooter'", False), ("div class='ad-slot-12'", False),
             ("div class=comments-list", False), ("section role='complementary'", False), ("div class='shared'", True), ("p class='social_links-bar'", False)]
    body = "".join(f"<{start}>part {k}</{start.split()[0]}>" for k, (start, _) in enumerate(parts))
    (got,) = extract(spark, ("http://n/", page(f"<article><h1>Head</h1>{body}</article>")))
    assert got.split("\n") == ["Head", *(f"part {k}" for k, (_, stays) in enumerate(parts) if stays)]
