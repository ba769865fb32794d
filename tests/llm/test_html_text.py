import re
import time
from html import unescape

import numpy as np

from recordwash.llm import html_text, queries
from recordwash.llm.html_text import main_text

LONG = "Plain words that go on for quite a while, so that the line is long enough to count. "


def test_article_without_what_surrounds_it():
    page = (
        "<html><head><title>T</title><style>p{}</style></head><body><nav><ul><li>Home</ul></nav>"
        "<header><h1>Site</h1></header><div class='cookie-notice'>We use cookies</div>"
        "<article><header><h1>Head &amp; line</h1></header><p>One&nbsp;two\n three<br>four"
        "<script>var x = '</p>';</script> five</p><div class=ad>Buy</div><p>No<b>w</b>."
        "<form>Name <input></form><ul><li>a<li>b</ul><section id=comments><p>First!</p></section>"
        "</article><aside>More</aside><footer>&copy; me</footer></body></html>"
    )
    assert main_text(page) == "Head & line\n\nOne two three four five\n\nNow.\n\na\n\nb"


def test_pages_without_an_article():
    page = f"<body><div><p>{LONG * 3}</p><p>Short.</p></div><div><a>x</a> <a>y</a> <a>z</a></div>"
    assert main_text(page) == " ".join((LONG * 3).split()) + "\n\nShort."


def test_defined_results():
    assert main_text("") == ""
    assert main_text("<nav>only</nav>") == ""
    assert main_text("just text & more") == "just text & more"
    assert main_text("<![odd[ x ]]>kept<p>a</p") == "kept\n\na"
    assert main_text("<div>" * 3000 + "deep") == "deep"
    assert main_text("<article><p>" + "w " * 100_000) == ("w " * 100_000).strip()
    assert main_text("a &lt;b&gt; &#233; &bogus;") == "a <b> é &bogus;"


def test_words_of_a_name_alone_remove_nothing():
    body = f"<p>{LONG * 3}</p><p>Short.</p>"
    want = " ".join((LONG * 3).split()) + "\n\nShort."
    menu = "<ul class=menu><li>a<li>b<li>c</ul>"
    for page in (
        f"<div class='content-sidebar-wrap'>{menu}<main>{body}</main></div>",
        f"<div class='site no-sidebar'>{menu}<article>{body}</article></div>",
        f"<div class='widget'><div>{menu}</div><div><article>{body}</article></div></div>",
        f"<div class='has-ads'>{menu}{body}</div>",
        f"<div id='social'>{body}</div><p>x</p>{menu}",
    ):
        assert main_text(page) == want
    for name in ("related-work", "menu-items", "login-flow", "cookies"):
        page = f"<article><h1>Head</h1>{body}<section id='{name}'><h2>More</h2>{body}</section>{menu}</article>"
        assert main_text(page) == f"Head\n\n{want}\n\nMore\n\n{want}"
    page = f"<article>{body}<div class=ad>Buy now</div><p>{LONG}</p></article><div class=ad>Buy</div>"
    assert main_text(page) == want + "\n\n" + LONG.strip()


def test_text_beside_articles():
    text = " ".join((LONG * 3).split())
    card = "<article><h3><a href=x><b>A</b> <i>card</i></a></h3></article>"
    menu = "<ul><li>a<li>b<li>c<li>d</ul>"
    page = f"<div><p>{LONG * 3}</p><p>{LONG * 3}</p></div>{menu}<div>{card * 5}</div>"
    assert main_text(page) == f"{text}\n\n{text}"
    page = f"<article><p>{LONG * 3}</p></article><nav>a</nav><article><p>Short answer, but one of its own.</p></article>"
    assert main_text(page) == f"{text}\n\nShort answer, but one of its own."
    page = f"<article><p>{LONG}</p></article><div><p>{LONG * 3}</p></div>{menu}<div><a>x</a> <a>y</a></div>"
    assert main_text(page) == f"{LONG.strip()}\n\n{text}"
    page = f"<div class=share><p>{LONG * 3}</p></div><article><p>A short card</p></article><div class=ad>Buy</div>"
    assert main_text(page) == f"{text}\n\nA short card"


def test_smoothing_keeps_constants_and_order():
    assert np.allclose(html_text.smoothed(np.full(7, 3.0)), 3.0)
    assert html_text.smoothed(np.array([0.0, 0, 9, 0, 0])).argmax() == 2


def plain_article(html):
    """Brute force for the test pages: all that stands in their one article."""
    inside = re.search("<article>(.*)</article>", html or "", re.S)
    blocks = re.split("</?(?:p|h1)>", inside[1].replace("<br>", " ")) if inside else []
    found = (" ".join(unescape(re.sub("<[^>]+>", "", b)).split()) for b in blocks)
    return "\n\n".join(b for b in found if b)


def test_query_matches_brute_force(spark, sf_dir):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    found = queries.op10_html_text(spark, sf_dir).collect()
    assert len(found) == len(pages)
    for row in found:
        page = pages[row["page_id"]]
        assert (row["url"], row["text"]) == (page["url"], plain_article(page["html"]))
        assert row["n_chars"] == len(row["text"])


def test_nulls_extra_columns_and_empty_table(spark):
    schema = "page_id long, url string, html string, text int"
    pages = spark.createDataFrame([(1, None, None, 7), (None, "u", "<p>a", 8)], schema)
    found = html_text.extract(pages)
    assert found.columns == ["page_id", "url", "html", "text", "_text"]
    assert {(r["text"], r["_text"]) for r in found.collect()} == {(7, ""), (8, "a")}
    assert html_text.extract(spark.createDataFrame([], schema)).count() == 0


WANT = " ".join((LONG * 3).split()) + "\n\nShort."
POST = f"<p>{LONG * 3}</p><p>Short.</p>"
OTHER = f"<p>{LONG * 2}</p><p>{LONG * 4}</p>"
MENU = "<ul class=menu><li>a<li>b<li>c</ul>"


def test_comments_notices_and_adverts_go_however_dense():
    comment = f"<article class='comment-body'>{OTHER}</article>"
    for page in (
        f"<article>{POST}<section class='comments'>{OTHER}{OTHER}</section></article>",
        f"<div class='post'>{POST}</div><div class='comments'>{OTHER}{OTHER}</div>",
        f"<article>{POST}<div class='ad'>{OTHER}</div></article>",
        f"<article>{POST}<div class='newsletter'>{OTHER}</div></article>",
        f"<div id='cookie-notice'>{OTHER}</div><div class='post'>{POST}</div>",
        f"<div class='post'>{POST}</div><div id='comments'>{comment}{comment}</div>",
        f"<main>{POST}</main><div id='comments'>{comment}{comment}</div>",
        f"<div class='post'>{POST}</div><div id='comments'><article>{OTHER}</article></div>",
        f"<article>{POST}<section id='comments'><h2>3 comments</h2>{OTHER}</section></article>",
        f"<div class='post'>{POST}</div><div class='sidebar'>{OTHER}</div>",
        f"<div class='post'>{POST}</div><div class='sponsored box'>{OTHER}</div><div class='ad-slot'>{OTHER}</div>",
        f"<div>{POST}</div><div class='comments'>" + f"<p>{LONG}</p>" * 50 + "</div>",
    ):
        assert main_text(page + MENU) == WANT, page[:90]


def test_names_of_layout_and_headings_stay():
    inner = f"<h2>More</h2>{POST}"
    for name in ("related-work", "cookies", "notice", "content-sidebar-wrap"):
        page = f"<article><h1>Head</h1>{POST}<section id='{name}'>{inner}</section>{MENU}</article>"
        assert main_text(page) == f"Head\n\n{WANT}\n\nMore\n\n{WANT}"
    page = f"<article><h1>Head</h1>{POST}<section id='cookies'>{POST}</section></article>"
    assert main_text(page) == f"Head\n\n{WANT}"
    page = f"<div class='content-sidebar-wrap'>{MENU}<div class='comments-wrap-main'>{POST}</div></div>"
    assert main_text(page) == WANT
    assert main_text(f"<div id='comments'>{POST}</div>") == WANT


def test_time_is_linear_in_broken_markup():
    start = time.perf_counter()
    assert main_text("<div>" * 100_000 + "deep" + "</p>" * 100_000 + "</section>" * 100_000) == "deep"
    assert main_text("<div>" * 5_000 + f"<article><p>{LONG}</article>" * 5_000).count("Plain") == 5_000
    assert time.perf_counter() - start < 10
