import pytest

from trawl.llm import html

PAGE = """<!DOCTYPE html><html><head><title>T &amp; U</title><style>p{margin:0}</style><script>var t="</p><p>no";</script></head>
<body class="home page"><header class="site"><h1>Site name</h1></header><nav><ul><li><a href="/">Home</a><li><a href="/x">X</a></ul></nav>
<!-- <p>comment</p> --><div class="ad">Buy &lt;now&gt;</div><div id="cookie-notice"><p>We use cookies</p></div>
<article><header><h1>Title  &eacute;</h1></header><p><b>First
 paragraph</b> with <a href="/y">a link</a>.<br>More<p>Second &amp;amp; &#x4e2d;&nbsp;&lt;b&gt;
<form><input value="a>b"><p>Subscribe</p></form><aside>Related</aside><table><tr><td>c1<td>c2</table><ul><li>one<li>two</ul>
<div class="share-buttons">Share</div></article><section class="comments"><article><p>Nice post</p></article></section>
<aside class=sidebar>Side</aside><footer>&copy; me</footer>"""

PLAIN = """<html><body><div class="top">Welcome to our site</div><div class="content"><h2>{t}</h2><p>{a}</p><p>{b}</p></div>
<div class="links"><a href="/1">{t} one</a> <a href="/2">two</a></div><div class="bottom">All rights reserved</div></body></html>"""


def _texts(spark, rows):
    got = html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    return {r.page_id: (r.text, r.n_chars) for r in got}


def test_article_page(spark):
    text = "Title é\nFirst paragraph with a link. More\nSecond &amp; 中 <b>\nc1\nc2\none\ntwo"
    got = _texts(spark, [(1, "http://a.example/x", PAGE), (2, None, PAGE), (3, "//A.example:80/", None), (4, "x", ""), (None, "y", PAGE)])
    assert got == {1: (text, len(text)), 2: (text, len(text)), 3: ("", 0), 4: ("", 0), None: (text, len(text))}


def test_template_of_a_host_without_article(spark):
    rows = [(i, f"https://plain.example/{i}", PLAIN.format(t=f"Title {i}", a=f"First text {i}.", b=f"Second {i}.")) for i in range(6)]
    got = _texts(spark, rows)
    assert got == {i: (t := f"Title {i}\nFirst text {i}.\nSecond {i}.", len(t)) for i in range(6)}


def test_text_repeated_inside_articles_stays(spark):
    rows = [(i, f"https://b.example/{i}", f"<body><article><p>Shared line.<p>Own {i}</article><footer>F</footer></body>") for i in range(8)]
    assert _texts(spark, rows) == {i: (f"Shared line.\nOwn {i}", len(f"Shared line.\nOwn {i}")) for i in range(8)}


@pytest.mark.parametrize("page,want", [
    ("plain text only", "plain text only"),
    ("<p>a<p>b</i></div>c", "a\nbc"),
    ("<article><p>cut off <a href='x", "cut off"),
    ("<article>1 < 2 & 3 &am</article>", "1 < 2 & 3 &am"),
    ("<ARTICLE><P>Upper</P></ARTICLE>", "Upper"),
    ("<article><div title='a>b'>q</div><script>x</script ><p>r</article>", "q\nr"),
    ("<!-- never closed <p>x</p>", ""),
    ("<article><p>" + "long word " * 30_000 + "</article>", ("long word " * 30_000).strip()),
    ("<div>" * 3000 + "<article>deep</article>", "deep"),
])
def test_lenient_reading(spark, page, want):
    assert _texts(spark, [(1, "http://h.example/", page)])[1][0] == want


def test_reading_time_is_linear():
    import time
    start = time.time()
    for bad in ("<a " + "x='" * 50_000, "<" * 100_000, "<a href=\"" * 20_000, "<!--" * 50_000, "</" * 100_000):
        html.blocks(bad)
    assert time.time() - start < 20


def test_empty_and_extra_columns(spark):
    pages = spark.createDataFrame([(1, "u", "<article>x</article>", "t", 3)], "page_id long, url string, html string, text string, labels int")
    assert [tuple(r) for r in html.extract(pages).collect()] == [(1, "u", "x", 1)]
    assert html.extract(pages.limit(0)).collect() == []


def test_article_teasers_beside_a_div_body(spark):
    cards = "".join(f"<article class='card'><a href='/{{i}}/{j}'>Teaser {{i}} {j}</a></article>" for j in range(3))
    page = "<body><div class='post'><p>Body of {i}</p></div>" + cards + "</body>"
    assert _texts(spark, [(i, "http://t.example/", page.format(i=i)) for i in range(5)]) == {
        i: (f"Body of {i}", 9) for i in range(5)}


def test_template_text_inside_an_article_goes(spark):
    page = "<body><article><div class='box'>Read our offers</div><p>Own {i}</p></article><div class='more'><p>Second {i}</p></div></body>"
    assert _texts(spark, [(i, "http://t.example/", page.format(i=i)) for i in range(5)]) == {
        i: (f"Own {i}\nSecond {i}", 14) for i in range(5)}


@pytest.mark.parametrize("page", [
    "<div class='layout with-sidebar'><article><p>Text</p></article><aside>Side</aside></div><div class='ad'>Buy</div>",
    "<article class='post has-share'><p>Text</p><div class='share'>Share</div></article>",
    "<form><nav>Menu</nav><article><p>Text</p></article><div class='comments'><article>Nice</article></div></form>",
    "<form><div class='post'><p>Text</p></div></form><div class='ad'>Buy</div>",
    "<h1 class='site-nav'>Site</h1><div class='layout with-sidebar'><p>Text</p></div><footer>Foot</footer>",
    "<div class='post'>Text</div><div class='comments'><article>Nice post</article></div>",
])
def test_a_cued_wrapper_that_holds_the_content(spark, page):
    assert _texts(spark, [(1, "http://w.example/", f"<body>{page}</body>")])[1][0] == "Text"


def test_copies_of_a_page_are_no_template(spark):
    copy = "<body><nav>{i}</nav><article><p>Same text</p></article><div class='own'>Only here</div></body>"
    rows = [(i, "http://c.example/", copy.format(i=i)) for i in range(4)]
    others = [(i, "http://c.example/", f"<body><article><h2>Other {i}</h2></article></body>") for i in range(10, 20)]
    got = _texts(spark, rows + others)
    assert all(got[i][0] == "Same text" for i in range(4)) and got[12][0] == "Other 12"
    plain = [(i, "http://d.example/", "<body><div class='own'>Only here</div></body>") for i in range(4)]
    assert {t for t, _ in _texts(spark, plain).values()} == {"Only here"}


def test_article_text_that_looks_like_template_stays(spark):
    """A heading that all articles share, a linked paragraph, and compound classes with a cue word inside an article."""
    shared = "<body><nav>Menu</nav><article><h1>Title {i}</h1><p>Lead {i}</p><h2>Summary</h2><p>Text {i}</p><p class='note'>End {i}</p></article></body>"
    assert _texts(spark, [(i, "http://s.example/", shared.format(i=i)) for i in range(6)]) == {
        i: (t := f"Title {i}\nLead {i}\nSummary\nText {i}\nEnd {i}", len(t)) for i in range(6)}
    first = "<body><article><h2>Summary</h2><p>Text {i}</p></article></body>"
    assert _texts(spark, [(i, "http://s.example/", first.format(i=i)) for i in range(6)])[3][0] == "Summary\nText 3"
    linked = "<body><div class='post'><p>Text {i}</p><p class='ref'><a href='/{i}'>A long reference {i}</a> x</p><p>End {i}</p></div>" \
             "<div class='more'><p><a href='/a'>Next {i}</a></p></div></body>"
    assert _texts(spark, [(i, "http://l.example/", linked.format(i=i)) for i in range(6)])[2][0] == "Text 2\nA long reference 2 x\nEnd 2"
    classes = "<body><article><div class='search-results-method'><p>Method {i}</p></div><div class='social-history'><p>History {i}</p></div>" \
              "<div class='share-buttons'>Share {i}</div><div class='comments'><p>Nice {i}</p></div></article></body>"
    assert _texts(spark, [(i, "http://m.example/", classes.format(i=i)) for i in range(6)])[1][0] == "Method 1\nHistory 1"


HOSTS = 12
_SHELL = ["<div class='top'>Site {h}</div><div class='body'>{c}</div><div class='low'>Legal text of {h}</div>",
          "<table><tr><td class='left'>Menu of {h}</td><td class='mid'>{c}</td></tr></table><p class='legal'>Site {h}</p>",
          "<div class='x{h}'><div class='a'>Hello from {h}</div><section class='b'>{c}</section></div>",
          "<div class='teaser'><article>Card one of {h}</article><article>Card two of {h}</article></div><div class='story'>{c}</div>"]
_BODY = ["<h2>Head {i}</h2><p>One {i} of {h}</p><p>Two {i}</p>", "<p>One {i} of {h}</p><h3>More</h3><ul><li>Point {i}</li><li>Last {i}</li></ul>"]


def test_hosts_without_article_tags(spark):
    """The plain tag rule finds nothing, or the teasers; the template finds the text, and is a brute-force one's."""
    rows, want = [], {}
    for h in range(HOSTS):
        for i in range(5):
            content = _BODY[h % 2].format(i=i, h=h)
            page = "<html><body>" + _SHELL[h % 4].format(h=h, c=content) + "</body></html>"
            rows.append((100 * h + i, f"https://h{h}.example/{i}", page))
            want[100 * h + i] = _BODY[h % 2].format(i=i, h=h)
    got = _texts(spark, rows)
    read = {k: "\n".join(html.blocks(v)[1]) for k, v in want.items()}
    assert {k: v[0] for k, v in got.items()} == read
    # Brute force: the blocks of a host whose text is not the same on all of its pages, and the headings among them.
    for h in range(HOSTS):
        pages = [html.blocks(p) for i, _, p in rows if i // 100 == h]
        for i, (paths, texts, _, _) in enumerate(pages):
            own = [t for p, t in zip(paths, texts) if not all(t in q[1] for q in pages) or p.endswith("/h3")]
            assert "\n".join(own) == read[100 * h + i]
