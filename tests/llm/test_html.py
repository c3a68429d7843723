"""HTML extraction on page shapes of its own and on the page table."""

import html as entities
import re
import time

import pytest

from jobmart.llm import html

PARAGRAPH = "This is a paragraph with enough words to count as content of the page."


def page(body, tail=""):
    return f"<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style><script>var a='</p>';</script></head><body>{body}</body></html>{tail}"


@pytest.mark.parametrize("body, want", [
    (f"<nav><ul><li><a href=x>Home</a><li>Two</ul></nav><article><h1>Title</h1><p>{PARAGRAPH}<p>Short.</article><footer>&copy; x</footer>", f"Title\n\n{PARAGRAPH}\n\nShort."),
    (f"<header>Site name and menu</header><main><p>{PARAGRAPH}</p><form>Name <input></form><p>End&amp;more&nbsp;here</p></main><aside>Side</aside>", f"{PARAGRAPH}\n\nEnd&more here"),
    (f"<div class='cookie-notice'>We use cookies</div><div id=content><p>a <b>bold</b>\n  word<br>line {PARAGRAPH}</p><div class=ad>Buy</div><p>tail</p></div><div class=comments><p>{PARAGRAPH}</p></div>",
     f"a bold word line {PARAGRAPH}\n\ntail"),
    (f"<article><header><h1>Inner</h1></header><p>{PARAGRAPH}</p></article><section><article class=comment><p>Nice post</p></article></section>", f"Inner\n\n{PARAGRAPH}"),
    ("<nav>only a menu</nav>", ""), ("", ""),
])
def test_shapes(body, want):
    assert html.main_text(page(body)) == want


LINKS = "<ul>" + "".join(f"<li><a href=x{i}>Go {i}</a></li>" for i in range(30)) + "</ul>"
LONG = [f"<p>{w} {PARAGRAPH} {PARAGRAPH}</p>" * 3 for w in ("One", "Two", "Three")]
TEXT = ["\n\n".join([f"{w} {PARAGRAPH} {PARAGRAPH}"] * 3) for w in ("One", "Two", "Three")]


def test_regions_far_apart_are_all_kept():
    got = html.main_text(page(f"<div><h2>Short</h2>{LONG[0]}{LINKS}</div><div>{LINKS}{LONG[1]}</div><div>{LINKS}{LONG[2]}{LONG[2]}<p>End</p></div>"))
    assert all(t in got for t in TEXT) and got.startswith("Short") and got.endswith("End")
    assert got.index("One") < got.index("Two") < got.index("Three")


def test_text_beside_an_article_is_kept():
    assert html.main_text(page(f"<article>{LONG[0]}{LONG[0]}</article><div>{LONG[1]}<p>End</p></div>")) == f"{TEXT[0]}\n\n{TEXT[0]}\n\n{TEXT[1]}\n\nEnd"
    far = html.main_text(page(f"<article>{LONG[0]}{LONG[0]}</article>{LINKS}{LONG[1]}"))
    assert far.startswith(f"{TEXT[0]}\n\n{TEXT[0]}") and far.endswith(TEXT[1]) and "Go 15" not in far
    two = html.main_text(page(f"<main><article>{LONG[0]}</article><article>{LONG[1]}{LONG[1]}</article></main>"))
    assert two == f"{TEXT[0]}\n\n{TEXT[1]}\n\n{TEXT[1]}"


def test_cut_pages_and_plain_text():
    assert html.main_text(f"<article><p>{PARAGRAPH}<p>cut &am") == f"{PARAGRAPH}\n\ncut &am"
    assert html.main_text("no markup at all") == "no markup at all"
    assert len(html.main_text("<article><p>" + "word " * 100_000)) == 499_999


@pytest.mark.parametrize("name", ["market-share", "related-work", "social-history", "promo", "notice", "share menu-plan", "headerless"])
def test_classes_that_only_look_like_furniture_stay(name):
    page = f'<nav>menu</nav><article><h1>Title</h1><p>{PARAGRAPH}</p><p class="{name}">Kept words. {PARAGRAPH}</p><div id="{name}"><p>And these.</p></div></article>'
    assert html.main_text(page) == f"Title\n\n{PARAGRAPH}\n\nKept words. {PARAGRAPH}\n\nAnd these."


@pytest.mark.parametrize("part", ['<div class="share-buttons"><a href="x">Tell others</a> now</div>', '<div class="related"><a>One</a><a>Two</a></div>', '<div class="ad">Buy this</div>',
                                  '<section class="comments"><p>I do not agree with a word of it.</p></section>', '<ul class="post-navigation related-posts"><li><a>Next</a></ul>',
                                  '<div class="notice"><div class="promo"><a>All of it linked</a></div></div>'])
def test_furniture_inside_an_article_goes(part):
    assert html.main_text(f"<article><h1>Title</h1><p>{PARAGRAPH}</p>{part}<p>{PARAGRAPH}</p></article>") == f"Title\n\n{PARAGRAPH}\n\n{PARAGRAPH}"


def test_deep_pages_take_linear_time():
    n = 100_000
    for page, text in (("<div>x " * n, "\n\n".join(["x"] * n)), ("<div>" * n + "text" + "</span>" * n, "text"), ("<article>x " * n, "\n\n".join(["x"] * n))):
        began = time.process_time()
        assert html.main_text(page) == text
        assert time.process_time() - began < 30


def test_smoothing_keeps_constants():
    assert html.smoothed([3.0] * 7) == pytest.approx([3.0] * 7)


def test_page_table(spark):
    from tests.paths import SF_SMALL

    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    want = {}
    for r in pages.collect():
        inner = r.html.split("<article>", 1)[1].split("</article>", 1)[0].replace("<br>", " ").replace("<b>", "")
        blocks = (re.sub(r"\s+", " ", entities.unescape(b)).strip() for b in re.split("</?(?:h1|p)>", inner))
        want[r.page_id] = "\n\n".join(b for b in blocks if b)
    out = html.extract(pages).collect()
    assert {r.page_id: r.text for r in out} == want and all(r.n_chars == len(r.text) for r in out)


def test_nulls_repeats_and_extra_columns(spark):
    df = spark.createDataFrame([(None, None, None, 1), (1, "u", "", 2), (2, None, "<p>x", 3), (2, None, "<p>x", 3)], "page_id bigint, url string, html string, text int")
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in html.extract(df).collect()) == [(0, "", 0), (1, "", 0), (2, "x", 1), (2, "x", 1)]
    assert html.extract(df.where("false")).count() == 0
