"""Main text of pages, and that bad pages have defined results."""

import html
import re

import pytest

from tests.conftest import SF_SMALL
from tidepool.llm import html_extract
from tidepool.llm.html_extract import main_text


def test_test_pages_give_the_article(spark):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    got = {r.page_id: r.text for r in html_extract.extract_digest(pages).collect()}
    rows = pages.collect()
    assert len(got) == len(rows)
    for r in rows:
        article = re.search(r"<article>(.*?)(?:</article>|$)", r.html, re.S)[1]
        plain = re.sub(r"<[^>]*>", "", re.sub(r"<br>", " ", re.sub(r"</?(?:h1|p)>", "\n", article)))
        lines = (" ".join(html.unescape(x).split()) for x in plain.split("\n"))
        assert got[r.page_id] == "\n".join(x for x in lines if x)


TEXT = "A long first paragraph, with commas, and so on. It goes on for a while, as paragraphs do; then it ends."
PAGE = """<html><head><title>T</title><style>p{{}}</style></head><body><header><p>Site name, slogan.</p></header>
<nav><ul><li><a href=/>Home</a><li><a href=/x>More</a></ul></nav><div class="cookie-notice">We use cookies, and more.</div>
{open}<h1>Head&shy;line &amp; more</h1><p>{text}<p>Short.<div class="ad-box">Buy this now, it is good.</div>
<ul><li>first point<li>second <b>point</b></ul><!-- <p>hidden --><script>if (a < b) document.write("<p>no</p>")</script>
<p>{text}</p><div id="comments"><p>{text} Nice, I agree, very much.</p></div>{close}
<aside><p>{text}</p></aside><form><p>Name, please: <input></p></form><footer>About, contact.</footer></body></html>"""
EXPECTED = f"Head­line & more\n{TEXT}\nShort.\nfirst point\nsecond point\n{TEXT}"


@pytest.mark.parametrize("open_, close", [("<article>", "</article>"), ("<main>", "</main>"), ("<div class=post>", "</div>"), ("<main><div>", "")])
def test_furniture_goes(open_, close):
    assert main_text(PAGE.format(open=open_, close=close, text=TEXT)) == EXPECTED


def test_a_class_may_speak_of_furniture_it_holds_beside_the_text():
    page = f"<body class=home><div class='layout has-sidebar'><div class='with-ads'><p>{TEXT}</p></div><div class=sidebar><p>{TEXT}</p></div></div>"
    assert main_text(page) == TEXT


ITEMS = [f"Item {i} of the list, as long as items are in a list like this." for i in range(10)]
LIST = "<ul>" + "".join(f"<li>{x}" for x in ITEMS) + "</ul>"
CARD = "<article class=card><p>A teaser, short, of some other page.</p></article>"
NODES = {
    "list": (f"<div class=post><h1>Head</h1><p>{TEXT}</p><p>{TEXT}</p><p>{TEXT}</p>{LIST}</div>", ["Head", TEXT, TEXT, TEXT, *ITEMS]),
    "two parts": (f"<div class=intro><p>{TEXT}</p><p>{TEXT}</p></div><div class=body>" + f"<p>{TEXT}</p>" * 3 + "</div>", [TEXT] * 5),
    "quote": (f"<div class=post><p>{TEXT}</p><blockquote><p>{TEXT}</p><p>{TEXT}</p></blockquote></div>", [TEXT] * 3),
    "teasers": (f"<div class=story><p>{TEXT}</p><p>{TEXT}</p></div>{CARD}{CARD}", [TEXT, TEXT, *["A teaser, short, of some other page."] * 2]),
}


@pytest.mark.parametrize("name", NODES)
def test_node_holds_all_content(name):
    page, lines = NODES[name]
    menu = "<div><ul><li><a href=/>Home</a><li><a href=/x>More of it</a></ul></div>"
    assert main_text(f"<html><body>{menu}{page}{menu}</body></html>") == "\n".join(lines)


@pytest.mark.parametrize("name", ["elementor-widget-container", "wp-block-widget-text", "layout sidebar-right", "post comments-enabled",
                                  "side-by-side", "search-result-page"])
def test_a_class_on_the_text_itself_is_no_furniture(name):
    text = f"<h1>Head</h1><p>{TEXT}</p><p>{TEXT}</p><div class=comments><p>{TEXT}</p></div>"
    for page in (f"<body><div class='{name}'>{text}</div></body>", f"<body><article><div class='{name}'>{text}</div></article></body>"):
        assert main_text(page + "<div class=sidebar><p>Some words, beside it.</p></div>") == f"Head\n{TEXT}\n{TEXT}"


def test_widgets_that_together_hold_the_text_stay():
    part = "<div class='elementor-element-{0} elementor-widget elementor-widget-{1}'>{2}</div>"
    page = part.format(0, "heading", "<h1>Head</h1>") + "".join(part.format(i, "text-editor", f"<p>{TEXT}</p>") for i in range(1, 5))
    assert main_text(f"<body><div>{page}</div><div class=comment-list>" + f"<p>{TEXT}</p>" * 3 + "</div>") == "\n".join(["Head"] + [TEXT] * 4)


def test_links_in_the_article_stay():
    page = (f"<article><h1><a href=/t>Title</a></h1><p>{TEXT}</p><p><a href=/y>A paragraph that is one link.</a></p><p>{TEXT}</p>"
            "<ol><li><a href=/1>First source</a><li><a href=/2>Second source</a></ol></article><div><p><a href=/z>Other page</a></p></div>")
    expected = f"Title\n{TEXT}\nA paragraph that is one link.\n{TEXT}\nFirst source\nSecond source"
    assert main_text(page) == expected
    assert main_text(page.replace("article>", "section>")) == expected


def test_formulas_and_plain_listings_stay():
    page = f"<article><p>{TEXT} <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>x=1</annotation></math></p><xmp>a &lt; <b>\n c</xmp><p>{TEXT}</p></article>"
    assert main_text(page) == f"{TEXT} x=1\na &lt; <b> c\n{TEXT}"


def test_defined_results(spark):
    rows = [(1, "u", None, 1), (2, "u", "", 1), (3, None, "<p", 1), (None, "u", "no tags at all, just text.", 1), (5, "u", "<nav>x</nav>", 1),
            (6, "u", "<p>" + "word, " * 100_000 + "</p>", 1), (6, "u", "<p>a&nbsp;&lt;b&gt;&#233;\n\t c</p>", 1), (6, "u", "<p>a&nbsp;&lt;b&gt;&#233;\n\t c</p>", 1)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = {(r.page_id, r.n_chars): r.text for r in html_extract.extract_digest(df).collect()}
    assert got[1, 0] == got[2, 0] == got[5, 0] == ""
    assert got[None, 26] == "no tags at all, just text."
    assert got[6, 599_999] == ("word, " * 100_000).strip()
    assert got[6, 8] == "a <b>é c"
    assert html_extract.extract_digest(df.where("1 = 0")).count() == 0


BODY = "".join(f"<p>Paragraph number {i} of the story, with commas, full stops and some length to it.</p>" for i in range(6))
STORY = "\n".join(f"Paragraph number {i} of the story, with commas, full stops and some length to it." for i in range(6))
TALK = "".join(f"<li>I, as reader {i}, agree with this story, and have a good deal more to say on it, at length.</li>" for i in range(60))


@pytest.mark.parametrize("page", [
    f"<body><form action=x><div id=main><h1>T</h1>{BODY}</div><input name=q></form></body>",
    f"<body><form><nav>a b</nav><div><h1>T</h1>{BODY}</div><form><label>Mail</label><input></form></form></body>",
    f"<body><div><h1>T</h1><svg class='i' viewBox=\"0 0 1 1\"/>{BODY}</div></body>",
    f"<body><div><h1>T</h1><div><button>Like</div>{BODY}</div></body>",
    f"<body><div><h1>T</h1><div><select><option>One<option>Two</div>{BODY}</div><button>x</button></body>",
    f"<body><div><h1>T</h1><svg><g><svg/></g><text>chart</text></svg>{BODY}</div></body>",
    f"<body><div class=post><h1>T</h1>{BODY}</div><ol id=comments>{TALK}</ol></body>",
    f"<body><div class=post><h1>T</h1>{BODY}</div><div class='comment-list'><ul>{TALK}</ul></div></body>",
    f"<body><div><h1>T</h1><div hidden><p>Not shown, at all, to anyone.</p></div>{BODY}</div></body>",
    f"<body><div><h1>T</h1><p style='color:red;display: none'>Not shown, at all.</p>{BODY}</div></body>",
    f"<body><div><h1>T</h1>{BODY}<p>Copyright © 2024 Example Press. All rights reserved.</p></div></body>",
])
def test_main_text_without_an_article_element(page):
    assert html_extract.main_text(page) == "T\n" + STORY


def test_a_page_of_nothing_but_comments_keeps_them():
    assert html_extract.main_text(f"<body><div id=comments><ol>{TALK}</ol></div></body>").count("\n") == 59
