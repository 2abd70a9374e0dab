"""HTML extraction: the table's pages against a plain reader of their known layout, and planted layouts."""
import html
import re

from ripplet.llm import pages
from ripplet.sources.tables import read_table
from tests.conftest import SF_SMALL


def plain(source):
    article = re.search(r"<article>(.*?)</article>", source, re.S)[1]
    blocks = (" ".join(html.unescape(re.sub(r"</?b>|<br>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", article))
    return "\n\n".join(b for b in blocks if b)


def test_the_table(spark):
    df = read_table(spark, SF_SMALL, "pages")
    want = {r.page_id: plain(r.html) for r in df.collect()}
    assert {r.page_id: r.text for r in pages.main_text(df).collect()} == want


SOUP = """<html><head><title>T</title></head><body><div id="cookie-notice">We use cookies</div><header><a href=/>Site</a></header>
<div class=wrap><div class="menu"><ul><li><a href=1>one</a><li><a href=2>two</a></ul></div>
<div class="post-body"><h1>Title {i}</h1><p>First &amp; para {i} with &#233; text<p>Second<br>line &nbsp; here {i}.
<blockquote>Quote {i}</blockquote><ul><li>item a{i}<li>item b</ul><div class="share">Share this</div></div>
<div class="sidebar"><p>About us text</p></div><section id="comments"><article class="comment"><p>I love it {i}</p></article></section></div>
<form><p>Email</p><input></form><script>var x="<p>no</p>";</script></body></html>"""
TEXT = "Title {i}\n\nFirst & para {i} with é text\n\nSecond line here {i}.\n\nQuote {i}\n\nitem a{i}\n\nitem b"


def test_layout_without_a_marked_article():
    assert pages.extract([SOUP.format(i=i) for i in range(6)]) == [TEXT.format(i=i) for i in range(6)]
    assert pages.extract([SOUP.format(i=0)]) == [TEXT.format(i=0)]


def test_marked_article_with_furniture_inside():
    page = """<body><main><article class="post with-sidebar"><header><h1>Head</h1><p class=byline>by x</p></header><p>One</p><aside>no</aside>
    <div class="advert">buy</div><p>Two <!-- <p>hidden --> parts</p><footer>tags</footer></article><div class="comments"><p>me too</p></div></main></body>"""
    assert pages.extract([page]) == ["Head\n\nOne\n\nTwo parts"]


def test_template_classes():
    group = [pages.Page(SOUP.format(i=i)) for i in range(4)]
    t = pages.Template(group)
    body = "/#page/html/body"
    assert body + "/div.wrap/div.post-body" in t.skeleton and body + "/div.wrap/div.menu/ul/li" in t.tokens
    assert body + "/div.wrap/div.menu/ul/li" not in t.skeleton


def test_edges(spark):
    rows = [(1, "http://a.com/x", None), (2, None, "<p>a < b & c"), (3, "http://a.com/y", ""), (4, "http://a.com/z", "<div>x<div>y</div>z</div>"),
            (None, "no scheme", "plain words"), (4, "http://a.com/z", "<div>x<div>y</div>z</div>"), (5, "http://a.com/l", "<p>" + "long " * 200_000),
            (6, "u", "<script>never closed <p>x"), (7, "u", "<nav>only menu</nav>")]
    df = spark.createDataFrame([(*r, "h", 1, "t") for r in rows], "page_id long, url string, html string, host string, part int, text string")
    out = sorted(((r.page_id, r.text) for r in pages.main_text(df).collect()), key=repr)
    assert out == sorted([(1, ""), (2, "a < b & c"), (3, ""), (4, "x\n\ny\n\nz"), (None, "plain words"), (4, "x\n\ny\n\nz"), (5, ("long " * 200_000).strip()),
                          (6, ""), (7, "")], key=repr)
    assert pages.main_text(df.limit(0)).count() == 0


SHARED = """<body><article class=a1><h1>Title {i}</h1><div class=k2>Send to a friend</div><p>Body {i} {w}</p><p>Second {i}</p><ul><li>point {i}{i}<li>same</ul>
<div class=k7><h3>Read also</h3><p>Our best of the year</p></div><p>Written in our own house.</p></article></body>"""


def test_template_blocks_inside_the_article():
    group = [SHARED.format(i=i, w="word " * i) for i in range(8)]
    want = ["\n\n".join((f"Title {i}", " ".join(f"Body {i} {'word ' * i}".split()), f"Second {i}", f"point {i}{i}", "same")) for i in range(8)]
    assert pages.extract(group) == want
    # unmarked pages of the same host have a template of their own
    assert pages.extract(group + [SOUP.format(i=i) for i in range(6)]) == want + [TEXT.format(i=i) for i in range(6)]


def test_copied_articles_are_no_template():
    copy = "<article><h1>One</h1><p>The same story</p><p>told again</p></article>"
    other = ["<article><h1>T{i}</h1><p>Story {i}</p></article>".format(i=i) for i in range(3)]
    assert pages.extract([copy] * 9 + other) == ["One\n\nThe same story\n\ntold again"] * 9 + [f"T{i}\n\nStory {i}" for i in range(3)]
    assert pages.extract([copy.replace("One", f"Title {i}") for i in range(9)]) == [f"Title {i}\n\nThe same story\n\ntold again" for i in range(9)]


def test_all_marked_elements_and_links_stay():
    two = "<main><article><p>{0}</p></article><article><p>{1}</p></article></main>".format("a " * 60, "b " * 40)
    assert pages.extract([two]) == [("a " * 60).strip() + "\n\n" + ("b " * 40).strip()]
    lead = "<main><p>{0}</p><article><p>{1}</p></article></main>".format("a " * 35, "b " * 65)
    assert pages.extract([lead]) == [("a " * 35).strip() + "\n\n" + ("b " * 65).strip()]
    title = "<body><div class=t><h1><a href=x>Title {i}</a></h1></div><div class=c><p>Long {i} {w}</p><ul><li><a href=y>Reference {i}</a></ul></div></body>"
    want = [f"Title {i}\n\nLong {i} {('text ' * 40).strip()}\n\nReference {i}" for i in range(8)]
    assert pages.extract([title.format(i=i, w="text " * 40) for i in range(8)]) == want


def test_furniture_words_do_not_close_the_article():
    body = "<h1>Head</h1><p>One of the parts</p><p>Two of the parts</p>"
    text = "Head\n\nOne of the parts\n\nTwo of the parts"
    around = "<body><nav>menu</nav>{}<footer>end</footer></body>"
    for page in ("<form id=aspnetForm><main>{}</main></form>", "<form id=aspnetForm><div>{}</div></form>", "<form><div><article>{}</article></div></form>",
                 "<article class='post category-legal'>{}</article>", "<article class='post tag-social comments-open'>{}</article>",
                 "<main><article class='promo'>{}</article><p class=share>x</p></main>", "<article class='promo'>{}</article>",
                 "<div role=main class='content sidebar-left'>{}</div>", "<article><form>{}</form></article>",
                 "<article>{}<form><p>Your mail</p></form></article>", "<article>{}<article class=comment>" + "long " * 99 + "</article></article>",
                 "<article>{}</article><section class=related><article>Teaser</article></section>",
                 "<article>{}</article><div><article class=comment>" + "long " * 99 + "</article></div>",
                 "<div class='post category-legal comments-closed'>{}</div>"):
        assert pages.extract([around.format(page.format(body))]) == [text], page
    for header in ("<div class='post-header'><h1>Head</h1><p>by x</p></div>", "<div class=header><div><h1>Head</h1></div></div>",
                   "<header class=entry-header><div class=in><h1>Head</h1></div><nav><h2>Menu</h2></nav></header>"):
        assert pages.extract([f"<article>{header}<p>One</p></article>"]) == ["Head\n\nOne"], header
    assert pages.extract(["<header><h1>Site</h1></header><div class=text><div class=post-header><h1>Head</h1></div><p>One</p></div>"]) == ["Head\n\nOne"]


def test_custom_elements_and_open_heads():
    for tag in ("video-player", "svg-icon", "select-menu", "object-list", "math-box", "template-part"):
        assert pages.extract([f"<body><article><p>One</p><{tag} src=x></{tag}><p>Two</p></article></body>"]) == ["One\n\nTwo"], tag
    assert pages.extract(["<html><head><title>T</title><meta charset=utf-8><style>p{}</style><h1>Head</h1><p>One</p>"]) == ["Head\n\nOne"]
    assert pages.extract(["<head lang=en><title>T</title><link href=x><script>a</script><header>no</header><article><p>One</p></article>"]) == ["One"]
    assert pages.extract(["<head><title>T</title><meta name=x></head><p>One</p><video src=x>no</video><p>Two</p>"]) == ["One\n\nTwo"]
