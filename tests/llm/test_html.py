from html.parser import HTMLParser

import pytest

from shelfmark.llm import html as H
from tests.conftest import SF_DIR
from tests.llm.oracle import duck

SCHEMA = "page_id long, url string, html string, path string"


class Article(HTMLParser):
    """The one article of the test pages, by the standard library's parser."""

    def __init__(self):
        super().__init__()
        self.on, self.blocks, self.parts = False, [], []

    def end(self):
        text = " ".join("".join(self.parts).split())
        self.blocks += [text] if text and self.on else []
        self.parts = []

    def handle_starttag(self, tag, attrs):
        if tag in ("article", "p", "h1"):
            self.end()
        self.on |= tag == "article"
        self.parts += [" "] if tag == "br" else []

    def handle_endtag(self, tag):
        if tag in ("article", "p", "h1"):
            self.end()
        self.on &= tag != "article"

    def handle_data(self, data):
        self.parts.append(data)


def test_pages_against_a_plain_parser(spark):
    expected = {}
    for page_id, url, html in duck().execute("SELECT page_id, url, html FROM pages").fetchall():
        parser = Article()
        parser.feed(html or "")
        parser.close()
        parser.end()
        text = "\n\n".join(parser.blocks)
        expected[page_id] = (url, text, len(text))
    found = H.op7_html_extraction(spark, SF_DIR).collect()
    assert {r.page_id: (r.url, r.text, r.n_chars) for r in found} == expected and len(found) == len(expected)


PROSE = [f"Paragraph {n} is long enough, it has commas, and it tells of things &amp; more things." for n in range(4)]
TEXT = "\n\n".join(["The Title", *(p.replace("&amp;", "&") for p in PROSE)])
BODY = "".join(f"<p>{p}</p>" for p in PROSE)
NOISE = (
    '<nav><ul><li><a href="/">Home</a><li><a href="/x">A rather long menu entry, with commas, for a menu</a></ul></nav>',
    '<aside class="sidebar"><p>Something about the author, which is long, and in a sidebar of its own.</p></aside>',
    '<div class="ad-box"><p>Buy this, buy that, buy everything, and then some more of it, today only.</p></div>',
    '<form action="/s"><p>Your name, your address, and what you would like to tell us, please.</p><input name=q></form>',
    '<div id="comments"><div class="comment"><p>' + "I do not agree, not at all, and here is why, at length. " * 30 + "</p></div></div>",
    '<div style="display: none"><p>Unseen text, which is of some length, and means nothing here.</p></div>',
    '<div class="cookie-notice"><p>We use cookies, and other things, to make this site what it is.</p></div>',
    '<footer><p>&copy; 2020 Somebody, somewhere, all rights reserved, and so on.</p></footer>',
    "<script>var x = '<p>not text, really, not at all, not even here</p>';</script><style>p{}</style><!-- <p>no</p> -->",
)
TEMPLATES = {
    "article": "<body>{a}<article><h1>The Title</h1>{body}{b}</article>{c}</body>",
    "article header": "<body>{a}<article><header><h1>The Title</h1><p>by one</p></header><div class=text>{body}</div>{b}</article>{c}",
    "divs": '<body>{a}<div class="wrap"><div class="post post-{n}"><h1>The Title</h1><div class="entry">{body}</div>{b}</div>{c}</div>',
    "main": '<body>{a}<main id="m{n}"><h2>The Title</h2><section>{body}</section>{b}</main>{c}',
    "cells": '<table><tr><td>{a}<td class="text"><h1>The Title</h1>{body}{b}<td>{c}</table>',
    "unclosed": "<div class=content><h1>The Title</h1>" + BODY.replace("</p>", "\n") + "{b}</div>{a}{c}",
}


@pytest.mark.parametrize("name", TEMPLATES)
def test_templates(name):
    for n in range(len(NOISE)):
        a, b, c = ("".join(NOISE[(n + k) % len(NOISE)] for k in range(s, s + 3)) for s in (0, 3, 5))
        html = TEMPLATES[name].replace("{body}", BODY).replace("{n}", str(n)).replace("{a}", a).replace("{b}", b).replace("{c}", c)
        page = H.parse(f"<!DOCTYPE html><html><head><title>No</title></head>{html}")
        node, score = H.best_container(page)
        assert score > 0 and H.article(page, page.nodes[node].path) == TEXT


def test_host_outvotes_a_single_page(spark):
    post = '<body><div class="box box-{n}"><p>{t}</p></div><div class="text t{n}">{body}</div></body>'
    rows = [(n, f"http://Host.org/{n}", post.format(n=n, t="Short, one.", body=BODY), "x") for n in range(5)]
    rows.append((5, "https://host.org:80/5", post.format(n=5, t=" ".join(PROSE) * 9, body="<p>Little.</p>"), "x"))
    pages = spark.createDataFrame(rows, SCHEMA)
    assert [(r.host, r.path, r.votes) for r in H.host_paths(pages).collect()] == [("host.org", ">div.t#.text", 5)]
    found = {r.page_id: r.text for r in H.extract(pages).collect()}
    assert found[5] == "Little." and found[0] == "\n\n".join(TEXT.split("\n\n")[1:])


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("a  b\n c", "a b c"),
        ("<p>x<br>y&nbsp;z &lt;b&gt; &#233;&hellip;</p>", "x y z <b> é…"),
        ("<p>a<b>b</b>c <i> d</i></p>", "abc d"),
        ("<ul><li>one<li>two</ul>", "one\n\ntwo"),
        ("<p>1 < 2 and 3 > 2</p>", "1 < 2 and 3 > 2"),
        ("<p>x</p><script>never closed <p>y</p>", "x"),
        ("<p>x</p><!-- never closed <p>y</p>", "x"),
        ("<p>x</p><div class='a", "x"),
        ('<p title="a > b">x</p>', "x"),
        ("<div><p>a<div>b</div>c</div>", "a\n\nb\n\nc"),
        ("", ""),
        ("<br><p></p>", ""),
    ],
)
def test_blocks(html, text):
    assert "\n\n".join(b.text for b in H.parse(html).blocks) == text


def test_edges(spark):
    deep = "<div>" * 50_000 + "deep" + "</div>" * 50_000
    rows = [(None, None, None, "x"), (1, "no address", "<p>t</p>", "x"), (2, "", "", "x"), (2, "", "", "x"), (3, "http://h", deep, "x"),
            (4, "http://h", "<p>" + "word " * 200_000, "x")]
    pages = spark.createDataFrame(rows, SCHEMA)
    found = sorted((r.page_id or -1, r.url, r.text[:9], r.n_chars) for r in H.extract(pages).collect())
    assert found == [(-1, None, "", 0), (1, "no address", "t", 1), (2, "", "", 0), (2, "", "", 0), (3, "http://h", "deep", 4), (4, "http://h", "word word", 999_999)]
    assert H.extract(pages.limit(0)).count() == 0


@pytest.mark.parametrize(
    "head",
    [
        "<head><meta charset=utf-8><title>No</title><body>",
        "<head><title>No</title><style>p{}</style><link rel=x href=y>",
        "<html><head><noframes><p>No</p></noframes><script>var no = 1</script>\n<body class=x>",
        "<HEAD><title>No</title></HEAD>",
        "<head><title>No</title></title>",
    ],
)
def test_head_ends_where_html_ends_it(head):
    page = H.parse(f"<!DOCTYPE html>{head}<article><h1>The Title</h1>{BODY}</article>")
    assert H.article(page, None) == TEXT
    assert "No" not in [b.text for b in H.parse(f"{head}<div>x</div>").blocks]


@pytest.mark.parametrize(
    "attrs",
    ['aria-hidden="false"', 'data-hidden="0"', 'title="The hidden valley"', "title='hidden'", "data-class=sidebar", 'data-style="display:none"',
     'title="a role=menu b"', 'alt="id=comments"', "data-role=banner", "aria-hidden=false", 'xml:id="footer"'],
)
def test_attributes_go_by_whole_names(attrs):
    page = H.parse(f"<body><div {attrs}><h1>The Title</h1>{BODY}</div>")
    assert H.article(page, None) == TEXT
    for paragraph in (f"<p {attrs}>x</p>", f"<p lang=en {attrs} dir=ltr>x</p>"):
        assert [n.role for n in H.parse(paragraph).nodes] == ["", ""]


@pytest.mark.parametrize("attrs", ["hidden", "hidden=''", "HIDDEN", 'class=a hidden id="b"', "data-x=1 hidden/", 'title="x"hidden', "class='sidebar'", "ROLE = menu", 'style="Display: none"'])
def test_hidden_elements_stay_out(attrs):
    assert H.parse(f"<p {attrs}>x</p>").nodes[1].role == "noise"


WRAPPERS = [
    'class="content-area has-sidebar"', 'id="wrapper" class="no-sidebar"', 'class="layout sidebar-right"', 'class="form-page"', 'class="site-with-banner"',
    'class="page-header-fixed"', 'id="sidebar-left"', 'class="nav-open menu-top"', 'class="search-page cookie-consent-given"', 'class="header-sticky social"',
    'id="hidden-print"', 'class="comments-closed widget"',
]
FRAMES = {
    "div": "<body><div {attrs}>{a}<div class='text'><h1>The Title</h1>{body}</div>{c}</div>",
    "two": "<body><div {attrs}><div {attrs}>{a}<div><h1>The Title</h1>{body}</div></div>{c}</div>",
    "article": "<body><div {attrs}>{a}<article><h1>The Title</h1>{body}{b}</article>{c}</div>",
    "form": "<body><form id=aspnetForm {attrs}>{a}<div class=text><h1>The Title</h1>{body}{b}</div>{c}</form>",
    "section": "<body>{a}<section {attrs}><div><h1>The Title</h1>{body}</div>{b}</section>",
}


@pytest.mark.parametrize("frame", FRAMES)
@pytest.mark.parametrize("attrs", WRAPPERS)
def test_layout_names_leave_the_text(frame, attrs):
    hard = [n for k, n in enumerate(NOISE) if k != 4]
    for n in range(len(hard)):
        a, b, c = ("".join(hard[(n + k) % len(hard)] for k in range(s, s + 2)) for s in (0, 3, 5))
        html = FRAMES[frame].replace("{attrs}", attrs).replace("{body}", BODY).replace("{a}", a).replace("{b}", b).replace("{c}", c)
        page = H.parse(html)
        node, score = H.best_container(page)
        assert score > 0 and H.article(page, page.nodes[node].path) == TEXT, (frame, attrs, n)


def test_comments_are_no_frame_however_long():
    comments = NOISE[4].replace(" class=\"comment\"", "") * 30
    page = H.parse(f"<body><div class=a><h1>The Title</h1>{BODY}</div>{comments}")
    assert H.article(page, None) == TEXT


def test_sidebar_beside_a_short_text_stays_out():
    page = H.parse('<body><div class=text><h1>The Title</h1><p>A short text, but a text.</p></div><div class="sidebar"><p>' + "On the side. " * 15 + "</p></div>")
    assert H.article(page, None) == "The Title\n\nA short text, but a text."


def test_page_whose_every_element_has_a_noise_word():
    body = BODY.replace("<p>", '<p class="share-text">')
    html = f'<body class="nav-page"><div id="sidebar" class="widget"><h1 class="banner-title">The Title</h1>{body}</div>'
    page = H.parse(html)
    assert H.article(page, None) == TEXT
    only = H.parse("<body><div class=sidebar>All there is.</div><nav>No, a menu.</nav>")
    assert H.article(only, None) == "All there is."
    assert H.article(H.parse("<nav><p>No, a menu.</p></nav>"), None) == ""


def test_wrapped_pages_vote(spark):
    wrapped = '<body class="form-page"><div class="layout sidebar-right">{n}<div class="text"><h1>The Title</h1>{body}</div></div>'
    rows = [(n, "http://h/x", wrapped.format(n=NOISE[n], body=BODY), "x") for n in (0, 1, 5, 7, 8)]
    found = H.extract(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [r.text for r in found] == [TEXT] * 5
