import time

import pytest

from larkspur.llm.html import extract, main_text
from tests.llm.frames import table

BODY = "A long first paragraph, with commas, and words enough to be worth some points in the end."


def page(article, before="", after=""):
    return (f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a='</p><p>no</p>';</script></head><body>"
            f"<header><h1>Site</h1><p>Tag, line, of, the, whole, site, and more.</p></header><nav><ul><li><a href=/>Home</a><li><a href=/b>B</a></ul></nav>"
            f"{before}{article}{after}<footer><p>&copy; Foot, er, words.</p></footer></body></html>")


def test_articles():
    want = f"Title\n{BODY}\nx.\nSecond & last"
    inner = f"<h1>Title</h1><p>{BODY}<p>x.</p>\n<p>Second\n &amp;   <i>last</i></p>"
    side = '<div class="sidebar"><p>Side, bar, text, with, many, commas, in, it, all.</p></div>'
    talk = '<section id="comments"><h2>Comments</h2><p>Great, post, really, very, nice, I, think, so, yes, yes.</p></section>'
    plain = "<section><h3>3 Comments</h3><div>Great, post, really, very, nice, I, think, so, yes, yes.</div></section>"
    ad = "<div class='ad-slot top'>Buy, now, and, save, a, lot, of, money, today.</div><aside>More, aside, text.</aside>"
    form = "<form><p>Name, mail, text, of, the, form.</p><input name=a><button>Go</button></form>"
    for wrap in ("<article>{}</article>", "<div>{}</div>", "<main><div class='post-body'>{}</div></main>", "<table><tr><td>{}</td></tr></table>",
                 "<div id=content>{}</div>"):
        for before, after in (("", ""), (side, talk), (ad, plain), (form + side, ad + talk)):
            assert main_text(page(wrap.format(inner), before, after)) == want, (wrap, before, after)
    assert main_text(page(f"<article>{ad}{inner}{talk}</article>")) == want


def test_siblings_of_the_best_container_are_kept():
    part = "<div><p>" + "</p><p>".join([BODY] * 3) + "</p></div>"
    assert main_text(page(f"<div>{part}{part}<div><p>End.</p></div></div>")).count(BODY) == 6


def test_short_parts_of_an_article_are_kept():
    entry = "<div class=entry>" + f"<p>{BODY}</p>" * 10 + "</div>"
    want = "T\n" + f"{BODY}\n" * 10 + "End\nShort closing.\nOne\nLast."
    close = "<h2>End</h2><p>Short closing.</p><ul><li>One</li></ul><section><p>Last.</p></section>"
    for wrap in ("<article>{}</article>", "<main>{}</main>", "<div id=wrap><div>{}</div></div>"):
        for head in ("<h1>T</h1>", "<header><h1>T</h1></header>") if wrap[1] != "d" else ("<h1>T</h1>",):
            assert main_text(page(wrap.format(head + entry + close))) == want, (wrap, head)
    part = "<div>" + f"<p>{BODY}</p>" * 3 + "</div>"
    assert main_text(f"<body>{part}<h2>Next</h2><p>Short.</p>{part}</body>").split("\n")[3:5] == ["Next", "Short."]


def test_names_do_not_take_out_the_article():
    inner = "<h1>T</h1>" + f"<p>{BODY}</p>" * 6
    side = "<div class='sidebar'><p>Side, bar, text, with, commas.</p></div>"
    talk = "<div id=comments>" + "<p>Great, post, really, very, nice, I, think, so, yes.</p>" * 30 + "</div>"
    for attributes in ("id=content class='has-sidebar'", "class='post no-comments'", "class='layout-sidebar'"):
        for tag in ("div", "section"):
            assert main_text(page(f"<{tag} {attributes}>{inner}{side}</{tag}>")) == "T\n" + "\n".join([BODY] * 6), attributes
    ad = "<div class='ad'>" + "Buy, now, and, save. " * 20 + "</div>"
    assert main_text(page(f"{ad}<article><h1>T</h1><p>Short.</p></article>")) == "T\nShort."
    assert main_text(page(f"<div class=post>{inner}{talk}</div>")) == "T\n" + "\n".join([BODY] * 6)


def test_lists_of_links_go_but_links_in_text_stay():
    menu = "<ul>" + "".join(f"<li><a href=/{i}>Read this other story {i}</a></li>" for i in range(9)) + "</ul>"
    text = main_text(page(f"<article><p>{BODY} <a href=x>A link, too</a>.</p>{menu}<ul><li>A point, with text</li></ul></article>"))
    assert text == f"{BODY} A link, too.\nA point, with text"


def test_awkward_pages(spark):
    rows = [(1, "u", None), (2, None, ""), (None, None, "<p>only"), (3, "u", "no tags &lt; at all"), (4, "u", "<script>x</script>"),
            (5, "u", page("<article>" + f"<p>{BODY}</p>" * 3000 + "</article>")), (5, "u", "<p>a<br>b&nbsp;&#233;</p>"), (6, "u", "<p title='a>b'>x, y</p></div></div>")]
    got = extract(table(spark, "page_id long, url string, html string", rows)).collect()
    texts = [r["_text"] for r in got]
    assert texts[:5] == ["", "", "only", "no tags < at all", ""] and texts[5].count("\n") == 2999
    assert texts[6:] == ["a b é", "x, y"]
    assert extract(table(spark, "page_id long, url string, html string", [])).collect() == []


def test_broken_markup_takes_linear_time():
    start = time.time()
    for text in ("<div>", "<p>a, b</p>", "<", '<a "', "</b>", "<!--", '<a x="', "<script>", "<![CDATA[", "<b>", "<li><b>"):
        main_text(text * 20_000)
    main_text("<b>" * 20_000 + "</i>" * 20_000 + "<h1>" * 20_000)
    assert time.time() - start < 30


def test_short_parts_beside_the_container_under_the_body():
    long = "".join(f"<p>Paragraph {i} of the story, which goes on for a while, as stories do, with commas, and clauses.</p>" for i in range(6))
    page = f"<body><h2>Heading here</h2><p>Short one.</p><div>{long}</div><p>Short closing.</p></body>"
    lines = main_text(page).split("\n")
    assert lines[:2] == ["Heading here", "Short one."] and lines[-1] == "Short closing." and len(lines) == 9


@pytest.mark.parametrize("size", [4000, 6000, 400_000])
def test_long_attributes_do_not_leak(size):
    text = "A paragraph of the story, which goes on for a while, as stories do. " * 3
    page = f"<article><p data-x=\"{'a > b ' * (size // 6)}\">{text}</p><p>{text}</p></article>"
    assert main_text(page) == "\n".join([text.strip()] * 2)


@pytest.mark.parametrize("piece", ['<a "', "<a '", '<a "\'', '<p x="', '<a "<" ', "<", '<div class=\'"', '"<a>'])
def test_broken_quotes_take_linear_time(piece):
    start = time.time()
    main_text("<p>" + piece * 50_000)
    assert time.time() - start < 20
