import time
from html.parser import HTMLParser

import pytest

from lodebar.llm import html_extract as he
from lodebar.llm.html_text import read
from lodebar.llm.queries import op5_html_extract


class Plain(HTMLParser):
    """The article's headings and paragraphs of simple pages, by the standard library's parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.blocks = False, [[]]

    def handle_starttag(self, tag, attrs):
        if tag == "article":
            self.inside = True
        if tag in ("h1", "p", "article"):
            self.blocks.append([])
        if tag == "br":
            self.handle_data(" ")

    def handle_endtag(self, tag):
        if tag in ("h1", "p", "article"):
            self.blocks.append([])
        if tag == "article":
            self.inside = False

    def handle_data(self, data):
        if self.inside:
            self.blocks[-1].append(data)

    def text(self):
        joined = [" ".join("".join(b).split()) for b in self.blocks]
        return "\n".join(b for b in joined if b)


def test_whole_table_agrees_with_a_plain_reader(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").toPandas().set_index("page_id")
    got = op5_html_extract(spark, "/root/testdata/sf0.01").collect()
    assert len(got) == len(pages)
    for r in got:
        plain = Plain()
        plain.feed(pages.html[r.page_id])
        plain.close()
        assert r.text == plain.text() and r.n_chars == len(r.text) and r.url == pages.url[r.page_id]


ARTICLE = "<article><header><h1>Title &amp; more</h1></header><p>One <b>bold</b>\n text.<p>Two&nbsp;lines<br>here<ul><li>a<li>b</ul><aside>no</aside><section class='comments'><article>reader</article></section></article>"


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (None, ""),
        ("", ""),
        ("plain words", "plain words"),
        ("<p>a<p>b</p>c", "a\nb\nc"),
        (f"<html><body><nav>menu</nav><header>top</header>{ARTICLE}<footer>f</footer></body></html>", "Title & more\nOne bold text.\nTwo lines here\na\nb"),
        (f"<form action='/x'><input name=q>{ARTICLE}</form>", "Title & more\nOne bold text.\nTwo lines here\na\nb"),
        ("<div class='sidebar'>s</div><div id=main-content><p>x</p><div class='ad-box'>buy</div><p>y</p></div><div class='cookie-notice'>ok</div>", "x\ny"),
        ("<body><p>kept<script>var a='</p>'; if (a<b) c();</script> on</p><style>p{}</style><!-- <p>hidden</p> --><p hidden>h</p>", "kept on"),
        ("<article>cut <span class='share'>tweet</span>off &am", "cut off &am"),
        ("<article>a < b <p title='x > y'>c</p><p>d</p", "a < b\nc\nd"),
        ("<article>text<!-- never closed <p>x</p>", "text"),
        ("<article><p>&#233;&#x1F600;&lt;tag&gt; &copy</p></article>", "é\U0001f600<tag> ©"),
        ("<article><table><tr><td>1<td>2<tr><td>3</table><button>go</button></article>", "1\n2\n3"),
        ("<article></b></p></div>t</article>after", "t"),
        ("<ARTICLE><P CLASS=x>Up</P></ARTICLE>", "Up"),
    ],
)
def test_single_pages(html, text):
    assert he.main_text(html, set(), set())[0] == text


def test_time_grows_with_the_length_alone():
    for deep in ("<div>" * 50_000 + "x" + "</div>y" * 50_000, "<div>" * 50_000 + "x</p></span>" * 50_000, "<b>" * 50_000 + "x" + "</b>" * 50_000, "<iframe/>x" * 50_000):
        began = time.process_time()
        text, _ = he.main_text(deep, {1}, {1})
        assert text and time.process_time() - began < 10  # quadratic readers take minutes


def test_deep_and_long_pages():
    assert he.main_text("<div>" * 3000 + "deep" + "</div>" * 3000, set(), set())[0] == "deep"
    assert len(he.main_text("<article>" + "<p>word</p>" * 50_000, set(), set())[0]) == 5 * 50_000 - 1


def test_templates_part_constant_text_from_data(spark):
    page = lambda i: f"<html><body><div class=x><p>Welcome to our site</p></div><div class=y><p>story {i} is here</p>{'<blockquote>q</blockquote>' if i == 3 else ''}</div><p>All prices in euro</p></body></html>"
    rows = [(i, f"http://a.b/{i}", page(i), "k") for i in range(8)] + [(20, "http://c.d/", page(20), "k"), (21, None, None, "k"), (5, "http://a.b/5", page(5), "k")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, TEXT string").repartition(3)
    got = {r.page_id: r.text for r in he.extract(df).collect()}
    assert got[1] == "story 1 is here" and got[3] == "story 3 is here\nq" and got[21] == ""
    assert got[20] == "Welcome to our site\nstory 20 is here\nAll prices in euro"  # alone on its host
    assert he.extract(df).count() == len(rows)
    assert he.extract(df.limit(0)).count() == 0
    template = {r.host: r for r in he.templates(df).collect()}
    x, y = (next(b for b in read(page(1))[0] if t in b.text).element.parent for t in ("Welcome", "story"))
    assert x.path in template["a.b"].tags and y.path in template["a.b"].tags and len(template["a.b"].constants) == 2


def test_pages_that_occur_twice_make_no_classes_of_their_own(spark):
    """Lists that are in one doubled page each do not get the same vector."""
    lists = {1: "<ul><li>x</li></ul>", 2: "<ol><li>x</li></ol>"}
    page = lambda i: f"<div class=a><p>t{i}</p></div>{lists.get(i, '')}"
    rows = [(i % 4, f"http://a.b/{i % 4}", page(i % 4)) for i in range(8)]
    tokens = he.tokens(spark.createDataFrame(rows, "page_id long, url string, html string"))
    seen = {r.token: r.v for r in tokens.groupBy("token").agg(he.vector("page").alias("v")).collect()}
    one, two = (next(b for b in read(page(i))[0] if b.text == "x").element.path for i in (1, 2))
    assert seen[one] != seen[two] and seen[one] and seen[two]


def test_brute_force_classes(spark):
    """Every valid class has equal occurrence vectors, counted page by page."""
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").where("url like '%blog%'")
    rows = pages.selectExpr("page_id", "'http://one.host/' as url", "html")
    tags = set(he.templates(rows).first().tags)
    counts = [read(r.html)[1] for r in rows.collect()]
    vectors = {}
    for path in {p for c in counts for p in c}:
        vectors.setdefault(tuple(c.get(path, (0, 0))[1] for c in counts), []).append(path)
    want = {p for v, paths in vectors.items() if len(paths) >= 2 and sum(n > 0 for n in v) >= he.MIN_SUPPORT * len(counts) for p in paths}
    assert tags == want


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("<div class='page has-sidebar'><article><p>x</p></article></div>", "x"),
        ("<div class='sidebar-left'><article><p>x</p><div class='share'>tweet</div></article></div>", "x"),
        ("<div id='main' class='with-sidebar'><p>x</p></div>", "x"),
        ("<div id='main' class='sidebar-left'><p>x</p></div>", "x"),
        ("<article class='post comment-open'><p>x</p></article>", "x"),
        ("<section class='related-layout'><main><p>x</p></main></section>", "x"),
        ("<form><div><article><p>x</p></article></div><input type=submit></form>", "x"),
        ("<form><div><div id=content><p>x</p></div></div></form>", "x"),
        ("<article><p>x</p><form><p>mail</p></form><div class='related'><article>y</article></div></article>", "x"),
        ("<div class='related'><article>y</article></div><article>x</article>", "x"),
        ("<aside class='wide'><article>y</article></aside><div class='comments'><article>z</article></div><p>x</p>", "x"),
        ("<article class='comment'>y</article><p>x</p>", "x"),
        ("<article class='post has-comments'><p>x</p></article>", "x"),
        ("<article class='post category-social'><p>x</p></article>", "x"),
        ("<main class='page-with-sidebar'><p>x</p></main>", "x"),
        ("<article><p class='skip-first'>x</p><p>y</p></article>", "x\ny"),
        ("<article><p>a <math><mi>x</mi><mo>+</mo><mn>1</mn></math> b</p><fieldset><legend>l</legend><p>f</p></fieldset></article>", "a x+1 b\nl\nf"),
        ("<div class=x><h1>T</h1><p>real text</p></div><div class=y><article><a href=/1>teaser</a></article></div>", "T\nreal text"),
        ("<article><p>a</p><form><fieldset><p>mail</p></fieldset></form></article>", "a"),
        ("<article><a href=/>only a link</a></article>", "only a link"),
    ],
)
def test_a_word_on_a_wrapper_does_not_swallow_the_article_below(html, text):
    assert he.main_text(html, set(), set())[0] == text


def test_the_template_decides_before_names(spark):
    """Constants inside of an article go, data outside of it stays, whatever the names say."""
    share = "<div class=box><p>Read all about us</p></div>"
    inside = lambda i: f"<article><p>story {i}</p>{share}</article><p>All prices in euro</p>"
    outside = lambda i: f"<main><p>Welcome</p>{share}</main><div class=y><p>tale {i}</p></div>"
    widget = lambda i: f"<nav>menu</nav><div class=widget><p>note {i}</p></div><div class=sidebar><p>Links</p></div>"
    copies = lambda i: f"<article><p>{'same' if i < 3 else i}</p></article>"
    rows = [(i, f"http://{host}/{i}", page(i)) for host, page in (("in", inside), ("out", outside), ("widget", widget), ("copies", copies)) for i in range(6)]
    rows.append((9, "http://widget/9", "<article></article><div class=widget><p>note 9</p></div>"))
    rows += [(0, "http://few/0", inside(0)), (1, "http://few/1", inside(1))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = {r.url: r.text for r in he.extract(df).collect()}
    for i in range(6):
        assert got[f"http://in/{i}"] == f"story {i}"
        assert got[f"http://out/{i}"] == f"tale {i}"
        assert got[f"http://widget/{i}"] == f"note {i}"
        assert got[f"http://copies/{i}"] == ("same" if i < 3 else str(i))
    assert got["http://widget/9"] == ""
    assert got["http://few/1"] == "story 1\nRead all about us"  # two pages are no template


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("<article><h2 id='related-work'>Related work</h2><p>x y</p><h3 id='sharing'>On sharing</h3><p>z</p></article>", "Related work\nx y\nOn sharing\nz"),
        ("<article><p>x y</p><div class='related'><h2 id='related-work'>More</h2><p>z</p></div></article>", "x y"),
        ("<article><p>x y</p><h2 class='comments'>Comments</h2></article>", "x y"),
    ],
)
def test_an_id_made_from_a_heading_is_no_noise_inside_an_article(html, text):
    assert he.main_text(html, set(), set())[0] == text
