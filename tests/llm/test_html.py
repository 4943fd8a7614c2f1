import html as entities
import re
import time

import numpy as np
import pytest

from wordmill.llm import html

LONG = "Words of an article that goes on for quite a while, sentence after sentence, as articles do. " * 3
PAGE = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t = "<p>no</p>";</script></head>
<body><header><h2>Site</h2><ul><li><a href=x>Home</a><li><a href=y>News</a></ul></header>
<div class="cookie-notice"><p>We use cookies. {LONG}</p></div>
<div id=wrap><div class="post"><h1>A &amp; B</h1><p>First {LONG}<br>broken  \n line</p>
<div class="ad"><p>Buy now {LONG}</p></div><p>Ti.<ul><li>one &lt;item&gt;<li>two</ul><blockquote>Said {LONG}</blockquote>
<form><label>Name</label><input value=v><textarea>typed</textarea></form><table><tr><td>cell 1<td>cell 2</table><p>Last {LONG}</div>
<aside><p>Related {LONG}</p></aside><section id="comments"><p>Reader says {LONG}</p></section></div>
<footer>&copy; someone</footer></body></html>"""


def clean(text):
    return " ".join(text.split())


def test_a_page_with_everything_around():
    assert html.main_text(PAGE).split("\n\n") == [
        "A & B", clean(f"First {LONG} broken line"), "Ti.", "one <item>", "two", clean(f"Said {LONG}"), "cell 1", "cell 2", clean(f"Last {LONG}"),
    ]


@pytest.mark.parametrize("page, text", [
    ("", ""), ("plain words", "plain words"), ("<p>a<p>b", "a\n\nb"), ("<nav>menu</nav>", ""), ("<!-- x --><p>a &am", "a &am"),
    ("<article><p>aaaa</article><p>b", "aaaa"), ("<p>x</p></div></p><p>y", "x\n\ny"), ("<p>cut <b", "cut"), ("&eacute;&#233;&#xe9;&nbsp;x", "ééé x"),
    ("<article><h1>t</h1><section><p>" + LONG + "<p>" + LONG + "</section><section><p>ok</section></article>", "\n\n".join(["t", LONG.strip(), LONG.strip(), "ok"])),
    ("<div><div><p>" + LONG + "<p>" + LONG + "</div><div><p>" + LONG + "</div></div>", "\n\n".join([LONG.strip()] * 3)),
])
def test_small_pages(page, text):
    assert html.main_text(page) == text


def article(page):
    body = page[page.index("<article>") + 9 : page.index("</article>")]
    blocks = [clean(entities.unescape(re.sub(r"<[^>]*>", "", p.replace("<br>", "\n")))) for p in re.split(r"</?(?:p|h1)>", body)]
    return "\n\n".join(b for b in blocks if b)


def test_every_given_page(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: (r.url, r.text, r.n_chars) for r in html.extract(pages).collect()}
    assert got == {r.page_id: (r.url, article(r.html), len(article(r.html))) for r in pages.collect()}


def test_pieces_nulls_and_repeats(spark, monkeypatch):
    rows = [(1, "u", PAGE), (1, "u", PAGE), (None, None, None), (2, "v", "")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, text string")
    got = html.extract(df).collect()
    assert sorted((str(r.page_id), str(r.url), r.n_chars) for r in got)[2:] == [("2", "v", 0), ("None", "None", 0)]
    whole = html.main_text(PAGE)
    assert [r.text for r in got if r.page_id == 1] == [whole, whole]
    monkeypatch.setattr(html, "FEED", 7)
    assert html.main_text(PAGE) == whole
    assert html.extract(df.limit(0)).count() == 0
    assert len(html.main_text("<div>" * 3_000 + "deep " + "</div>" * 3_000)) == 4
    assert len(html.main_text("<p>" + "word " * 300_000)) == 1_499_999


def test_clusters_and_smoothing():
    assert 3 < html.two_clusters(np.array([1.0, 2, 1, 90, 100, 110])) < 90
    assert np.allclose(html.smoothed(np.full(4, 2.5)), 2.5)


@pytest.mark.parametrize("around", [
    'class="layout has-sidebar"', 'class="no-sidebar"', 'id="header-fixed-layout"', 'class="widget"', 'class="sidebar menu" id=share', 'id=comments',
])
def test_a_class_does_not_silence_the_article(around):
    text = [LONG.strip()] * 3
    body = "".join(f"<p>{t}</p>" for t in text)
    other = "<nav>menu</nav><div class='ad'><p>Buy now</p></div>"
    for inner in (f"<article>{body}</article>", f"<main>{body}</main>", f"<div>{body}</div>"):
        assert html.main_text(f"<body>{other}<div {around}>{inner}</div></body>").split("\n\n") == text, inner


def test_a_title_in_an_entry_header_stays_and_replies_go():
    body = f"<p>{LONG}</p><p>{LONG}</p>"
    page = f'<article><div class="entry-header"><h1>Title</h1></div>{body}<div class="ad"><p>Buy {LONG}</p></div></article>'
    replies = "".join(f'<article class="comment-body"><p>Reader {LONG}</p></article>' for _ in range(5))
    for around in ("", f'<div id="comments">{replies}</div>'):
        assert html.main_text(f"<body>{page}{around}</body>").split("\n\n") == ["Title", LONG.strip(), LONG.strip()]


@pytest.mark.parametrize("name", [
    'class="comment-list"', 'id="comments-area"', 'class="ad-slot"', 'class="adSlot"', 'class="post-comments"', 'class="x sidebar-left"', 'class="newsletter-box"',
])
def test_compound_names_silence_what_is_no_article(name):
    text = [LONG.strip()] * 3
    body = "".join(f"<p>{t}</p>" for t in text)
    other = f"<div {name}><ol><li><p>Other {LONG}</p></li></ol></div>"
    for page in (f"<article>{body}{other}</article>", f"<div>{body}{other}</div>", f"<div><div>{body}</div>{other}</div>", f"<main>{other}{body}</main>"):
        assert html.main_text(f"<body><nav>menu</nav>{page}</body>").split("\n\n") == text, page
    assert html.main_text(f"<body><nav>menu</nav><div {name}><article>{body}</article></div></body>").split("\n\n") == text


@pytest.mark.parametrize("page", [
    "<div>" * 20_000 + "deep", "<b>" * 30_000 + "deep", "<div>" * 3_000 + "</i>" * 30_000 + "deep", "<div>d " * 20_000,
    "<div class=ad>" * 8_000 + "<p>deep", "<p><b>" * 15_000 + "deep", "<select><option>" * 8_000 + "</select>deep",
])
def test_time_follows_the_length_of_nested_markup(page):
    start = time.process_time()
    assert "de" in html.main_text(page + "<p>de") or "ad" in page
    assert time.process_time() - start < 3
