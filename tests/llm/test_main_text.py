import random
import re
import time
from html import unescape

import pytest

from odd_tables import PAGES

from tastemill.llm.main_text import extract, main_text, sound
from tastemill.sources.tables import read_table

PARAGRAPH = "A river runs past the mill and seven herons wait for fish every dawn. "


def page(body, head=""):
    return f"<!DOCTYPE html><html><head><title>T &amp; x</title>{head}</head><body>{body}</body></html>"


def test_articles_of_the_table(spark):
    pages = read_table(spark, "/root/testdata/sf0.01", "pages")
    found = {r.page_id: r.text for r in extract(pages).collect()}
    for r in pages.collect():
        inside = re.search("<article>(.*?)</article>", r.html, re.S).group(1)
        blocks = [re.sub("<[^>]*>", "", b.replace("<br>", " ")) for b in re.split("</?(?:h1|p)>", inside)]
        want = "\n\n".join(x for x in (" ".join(unescape(b).split()) for b in blocks) if x)
        assert found[r.page_id] == want


def test_everything_around_the_article_goes():
    noise = (
        "<header><h2>Site name of the day</h2></header><nav><ul><li><a href=/a>one</a></ul></nav>"
        "<div class='cookie-notice'>We use cookies on this site to serve you better.</div>"
        "<aside><p>Other long stories that you may like to read as well today.</p></aside>"
        "<div id=sidebar><p>" + PARAGRAPH + "</div><form><label>Name</label><input name=q></form>"
        "<div class='ad-box'><p>Buy now and save.</p></div>"
    )
    after = (
        "<section class=comments><article class=comment><p>" + PARAGRAPH * 2 + "</p></article></section>"
        "<ol class=commentlist><li>" + PARAGRAPH + "</li></ol><div role=complementary><p>" + PARAGRAPH + "</p></div>"
        "<footer>&copy; 2024</footer><script>var x='<p>no</p>';</script><style>p{}</style>"
    )
    body = f"<h1>Head &lt;one&gt;</h1><p>{PARAGRAPH}</p><p>Short.</p><ul><li>{PARAGRAPH}</li></ul>"
    want = "\n\n".join(["Head <one>", PARAGRAPH.strip(), "Short.", PARAGRAPH.strip()])
    for tag in ("article", "main", "div class=post-content"):
        close = tag.split()[0]
        assert main_text(page(f"{noise}<{tag}>{body}</{close}>{after}")) == want


def test_ratio_alone_finds_the_text():
    links = "<div>" + "".join(f"<a href=/{i}>link {i}</a> " for i in range(30)) + "</div>"
    body = "<div>" + f"<p>{PARAGRAPH * 3}</p>" * 4 + "</div>"
    assert main_text(page(links + body + links)) == "\n\n".join([(PARAGRAPH * 3).strip()] * 4)


def test_short_neighbours_of_the_text_are_no_content():
    top = "<div id=top>Menu <a href=1>one</a> <a href=2>two</a></div>"
    body = f"<div id=content><h1>Head</h1><p>{PARAGRAPH * 2}</p><p>ok</p><p>{PARAGRAPH * 2}</p></div>"
    want = ["Head", (PARAGRAPH * 2).strip(), "ok", (PARAGRAPH * 2).strip()]
    assert main_text(page(top + body + "<div id=last>&copy; me</div>")) == "\n\n".join(want)


LONG = (PARAGRAPH * 3).strip()
MENU = "<div id=left>" + "".join(f"<a href=/{i}>link {i}</a> " for i in range(20)) + "</div>"


def test_whole_content_around_articles():
    nested = f"<main><h1>Title</h1><article><p>{LONG}</p></article><p>ok</p></main>"
    assert main_text(page(MENU + nested + "<div>&copy; me</div>")) == f"Title\n\n{LONG}\n\nok"
    several = "<article><h2>A</h2><p>{0}</p></article><article><p>Short one.</p></article><article><p>{0}</p></article>"
    want = f"A\n\n{LONG}\n\nShort one.\n\n{LONG}"
    for around in ("{}", "<main>{}</main>", "<div class=list>{}</div>"):
        assert main_text(page(MENU + around.format(several.format(LONG)) + MENU)) == want
    card = f"<article><p>{LONG}</p></article>"
    for around in ("{}", "<div>{}</div>"):
        body = around.format(f"<div><p>{LONG}</p><p>x</p></div><div><p>{LONG}</p></div>{card}")
        assert main_text(page(body)) == f"{LONG}\n\nx\n\n{LONG}\n\n{LONG}"


def test_whole_content_around_divs():
    parts = f"<div class=title><h1>Title</h1></div><div><p>{LONG}</p></div><div><p>ok</p></div>"
    table = "<table><tr><td>one</td><td>two</td></tr></table>"
    want = ["Title", LONG, "ok", "one", "two", LONG]
    body = f"{parts}{table}<div><p>{LONG}</p></div>"
    for around in ("{}", "<div id=content>{}</div>", "<section>{}</section>", "<div><div>{}</div></div>"):
        assert main_text(page(MENU + around.format(body) + MENU)) == "\n\n".join(want)
    one = f"<div id=content>{parts}</div>"
    assert main_text(page(one)) == main_text(page(f"<div id=wrap>{MENU}{one}{MENU}</div>")) == "\n\n".join(want[:3])
    assert main_text(page(f"<div class=title><h1>Title</h1></div><div><p>{LONG}</p></div>")) == f"Title\n\n{LONG}"
    assert main_text(page(MENU)) == ""


def test_layout_words_of_wrappers():
    for name in ("has-sidebar", "layout-sidebar", "no-comments wide", "with_sidebar"):
        assert main_text(page(f'<div class="{name}"><p>{LONG}</p></div>')) == LONG
    for name in ("sidebar", "wide comments", "no-margin sidebar"):
        assert main_text(page(f'<div class="{name}"><p>{LONG}</p></div><div><p>ok</p></div>')) == "ok"


def test_white_space_references_and_broken_markup():
    assert main_text("<p>a \n\t b&nbsp;c &eacute;&#233; <b>d</b>e<br>f") == "a b c éé de f"
    assert main_text("<article><p><b>one two<br><p>three</p></article>") == "one two\n\nthree"
    assert main_text("plain text only") == "plain text only"
    assert main_text("<div class=ad><p>x y z") == ""
    for text in ("", None, "<", "<article", "<!--", "</p></div>", "&", "<p", "<script>x"):
        assert main_text(text) in ("", "<", "&", "<article", "<!--", "<p")
    long = "<p>" * 20_000 + "x"
    assert main_text(long) == "x"


def test_odd_rows(spark):
    rows = [(1, None, None), (None, "u", ""), (2, "u", "<p>" + PARAGRAPH * 5000), (3, "v", "<p>a b"), (3, "v", "<p>a b")]
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], PAGES + ", keys string, text string")
    out = extract(frame).collect()
    assert sorted(r.n_chars for r in out) == sorted([0, 0, len(PARAGRAPH * 5000) - 1, 3, 3])
    assert all(len(r.text) == r.n_chars for r in out)
    assert extract(spark.createDataFrame([], PAGES)).count() == 0


@pytest.mark.parametrize("odd", ["<![foo[ x", "<![x y z>", "<![\n", "<![CDATA[ y ]]>", "<!x", "<?php x ?>", "</ x>", "<! >"])
def test_marked_sections_and_declarations_do_not_stop_a_page(odd):
    assert LONG in main_text(page(f"<p>{LONG}</p>{odd}"))
    assert main_text(page(f"{odd}<p>{LONG}</p>")).endswith(LONG)


BROKEN = {
    "open tags": "<a ",
    "ends without a start": "<div></td>",
    "articles": "<article>",
    "scripts": "<script>x ",
    "comments": "<!-- ",
    "quotes": "<a b='c \" ",
    "quoted ends": '<a b=">" ',
    "spans": "<span></a>",
    "links in paragraphs": "<a><p></p>",
    "doubtful": "<form class=comments>",
    "references": "&amp;&",
    "marks": "<![x",
    "spaces": "<p" + " " * 50,
    "lesser": "< <",
    "menus": "<div><ul><li><a href=1>x",
}


@pytest.mark.parametrize("kind", sorted(BROKEN))
def test_broken_markup_takes_time_in_proportion(kind):
    start = time.time()
    for after in ("", ">", f"<p>{LONG}</p>"):
        main_text(BROKEN[kind] * (1_000_000 // len(BROKEN[kind])) + after)
    assert time.time() - start < 30  # quadratic work on a megabyte takes many minutes


def test_random_markup_never_raises():
    rng = random.Random(5)
    bits = ["<", ">", "</", "<!", "<!--", "-->", "<![", "]]>", "<?", "'", '"', "=", "&", "&#", "&lt", " ", "a", "p", "div",
            "<p>", "</p>", "<div class=x>", "<article>", "</article>", "<script>", "</script", "<form>", "<td>", "text ", "\n",
            "<title>", "<textarea", "class='comments'", "/>", "é"]
    for n in range(400):
        html = "".join(rng.choices(bits, k=rng.randrange(1, 200)))
        main_text(html)
        assert not re.search("<script>(?!</script>)", sound(html))
    start = time.time()
    main_text("".join(rng.choices(bits, k=400_000)))
    assert time.time() - start < 20


def test_whole_tags_pass_unchanged():
    html = '<!DOCTYPE html><p class="a b" title=\'x > y\' data-x=1>a &lt; b<br/></p ><a href=/x/y>z</a>'
    assert sound(html) == html.removeprefix("<!DOCTYPE html>").replace(" href=/x/y", "")
    assert sound("<p>a<!-- <p>no --><!--->b<script>if (a<b) '<p>'</script>c") == "<p>ab<script></script>c"
    assert sound("a < b <p don't>it's") == "a &lt; b <p>it's"


@pytest.mark.parametrize(
    "around",
    [
        '<div class="elementor-widget elementor-widget-text-editor">{}</div>',
        '<form id="aspnetForm"><input name=q>{}</form>',
        "<form><article>{}</article></form>",
        "<article><form>{}</form></article>",
        '<div class="site sidebar-right">{}</div>',
        '<div class="overlay">{}</div>',
        '<article><section class="search-theory">{}</section></article>',
        '<article><div class="social-history">{}</div></article>',
        '<article><div class="notice-board">{}</div></article>',
        '<article><div class="share-price-analysis">{}</div></article>',
    ],
)
def test_names_are_evidence_only(around):
    body = f"<p>{LONG}</p><p>Short.</p><p>{LONG}</p>"
    want = f"{LONG}\n\nShort.\n\n{LONG}"
    noise = "<div class=cookie-notice>We use cookies to serve you better.</div><form><label>Name</label><input></form>"
    assert main_text(page(around.format(body))) == want
    assert main_text(page(MENU + around.format(noise + body) + MENU)) == want


def test_widgets_of_a_page_builder_stay_together():
    parts = "".join(f"<div class=elementor-widget><p>{LONG}</p></div>" for _ in range(3))
    assert main_text(page(f"<div class=elementor-section>{parts}</div>")) == "\n\n".join([LONG] * 3)


def test_comments_after_the_article_go():
    said = "".join(f"<div><p>Ann, 3 May</p><p>{PARAGRAPH * 4}</p></div>" for _ in range(5))
    article = f"<article><h1>Head</h1><p>{LONG}</p></article>"
    for name in ("<section class=responses>", "<section>", "<div class=post-comments>", "<div id=disqus_thread>"):
        end = "</section>" if name.startswith("<section") else "</div>"
        assert main_text(page(f"{MENU}{article}{name}{said}{end}")) == f"Head\n\n{LONG}"


def test_lines_of_links_and_rights_beside_the_text_go():
    links = "".join(f"<li><a href=/{i}>Another page {i}</a></li>" for i in range(5))
    body = f"<p>{LONG}</p><p>Short.</p><p>{LONG}</p>"
    foot = f"<ul>{links}</ul><p>&copy; 2024 The Mill. All rights reserved.</p>"
    assert main_text(page(f"<div><ul>{links}</ul>{body}{foot}</div>")) == f"{LONG}\n\nShort.\n\n{LONG}"
    assert main_text(page(f"<article>{body}<p><a href=1>one</a></p><p><a href=1>two</a></p></article>")).endswith("one\n\ntwo")


TOLD = [
    "The council met on Tuesday to discuss the new bridge, which has been planned for more than ten years, and its cost.",
    "Engineers said that the foundations were laid last autumn and that the approach roads would be ready before the frost.",
    "Residents spoke of noise, but most of those at the meeting were in favour and asked for a cycle path on both sides.",
]


@pytest.mark.parametrize(
    "page, kept, gone",
    [
        ("<div><p>{0}<p>{1}<h3>Comments</h3><div class=c1><b>Ann</b><p>{2}</div><div class=c1><p>{2}</div></div>", "01", "2"),
        ("<article><p>{0}<p>{1}<h3>2 Comments</h3><div><p>{2}</div></article>", "01", "2"),
        ("<article><p>{0}<section><h2>Comments</h2><article><p>{2}</article></section></article>", "0", "2"),
        ("<div><div><p>{0}<p>{1}</div><div><h2>3 thoughts on the bridge</h2></div><div><div>{2}</div></div></div>", "01", "2"),
        ("<div><p>{0}<h2>Replies (2)</h2><p>{1}<h2>More of the story</h2><p>{2}</div>", "02", "1"),
        ("<article><p>{0}<h3>Leave a Reply</h3><p>{2}</article>", "0", "2"),
        # Headings of an article that only sound alike.
        ("<article><p>{0}<h2>Discussion</h2><p>{1}<h2>End</h2><p>{2}</article>", "012", ""),
        ("<div><p>{0}<h2>Comments</h2><p>{1}</div>", "01", ""),
        ("<div><p>{0}<h2>No response to the letter</h2><div>{1}</div></div>", "01", ""),
        ("<div><p>{0}<h2>One reply to critics</h2><p>{1}</div>", "01", ""),
        # A page of comments alone keeps them.
        ("<div><h1>2 comments</h1><div>{0}</div><div>{1}</div></div>", "01", ""),
    ],
)
def test_parts_under_headings_of_readers_go(page, kept, gone):
    text = main_text(page.format(*TOLD))
    assert all(TOLD[int(i)] in text for i in kept) and not any(TOLD[int(i)] in text for i in gone)


@pytest.mark.parametrize("piece", ["<div><h2>Comments</h2><p>{0}", "<h2>3 comments</h2><div>{0}</div>", "<h2>Comments</h2><p>{0}</p>"])
def test_many_headings_of_readers_take_linear_time(piece):
    page = piece.format(TOLD[0]) * 8_000
    start = time.time()
    main_text(page)
    assert time.time() - start < 5
