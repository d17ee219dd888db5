"""Main text of pages: the given ones and hand-made ones."""

from __future__ import annotations

import html
import re

import pytest

from stratovox.llm import queries
from stratovox.llm.extraction import extracted, main_text

LONG = "This sentence has a few words, some commas, and goes on for a while so that it counts as text. " * 3


def expected(page):
    """Blocks of the given pages' only article, by plain cutting."""
    start = page.index("<article>") + 9
    end = min(e for e in (page.find("</article>", start), page.find("<footer", start), len(page)) if e >= 0)
    blocks = re.split(r"</?(?:p|h1|br)\b[^>]*>", page[start:end])
    blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>?", "", b)).split()) for b in blocks]
    return "\n".join(b for b in blocks if b)


def test_given_pages(spark, data):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{data}/pages.parquet").collect()}
    rows = queries.op4_extract(spark, data).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert r.text == expected(pages[r.page_id]) and r.n_chars == len(r.text)


NOISE = [
    "<nav><ul><li><a href=/>Home page of the site</a></li></ul></nav>", "<header><h2>Site name, slogan</h2></header>", f"<aside>{LONG}</aside>", f'<div class="sidebar">{LONG}</div>',
    f'<div id="cookie-notice">{LONG}</div>', f'<div class="ad">{LONG}</div>', "<form><label>Name</label><input></form>", "<script>var a='</p>'; if (a<b) {}</script>", "<style>p{color:red}</style>",
    f'<section class="comments"><div class="comment"><p>{LONG}</p></div></section>', f"<footer><p>{LONG}</p></footer>", "<!-- hidden <p>text</p> -->", f'<ul class="menu"><li><a href=x>{LONG}</a></li></ul>',
]


@pytest.mark.parametrize("wrap", ["<article>{}</article>", '<div class="content">{}</div>', "<main><div>{}</div></main>", "<div><div>{}</div></div>", "<td>{}</td>"])
@pytest.mark.parametrize("noise", NOISE)
def test_boilerplate_is_left_out(wrap, noise):
    body = f"<h1>Title &amp; more</h1><p>{LONG}</p><p>Short.</p><blockquote>{LONG}</blockquote><p>a&nbsp;b\n c &lt;d&gt; &#233;</p>"
    want = "\n".join(["Title & more", LONG.strip(), "Short.", LONG.strip(), "a b c <d> é"])
    for page in (noise + wrap.format(body), wrap.format(body) + noise, wrap.format(body.replace("<p>Short.", noise + "<p>Short."))):
        if noise.startswith("<header") and page.index("<header") > page.index(LONG[:20]) and ("<article>" in wrap or "<main>" in wrap):
            continue  # a header inside an article belongs to it
        assert main_text(f"<html><head><title>T</title></head><body>{page}</body></html>") == want


def test_repairs_and_defined_cases(spark):
    assert main_text(None) == main_text("") == main_text("<p></p><br>") == main_text("<script>x") == ""
    assert main_text("just text") == "just text"
    assert main_text("<p>one<p>two</b></div> more<li>three") == "one\ntwo\nmore\nthree" or main_text("<p>one<p>two").split("\n") == ["one", "two"]
    assert main_text("<article><p>a<" + "/p><p>b") == "a\nb"
    deep = "<div>" * 3000 + LONG + "</div>" * 3000
    assert main_text(deep) == LONG.strip()
    rows = spark.createDataFrame([(1, None, "k"), (1, None, "k"), (None, "<p>x</p>", "k")], "page_id long, html string, score string")
    found = extracted(rows)
    assert found.columns == ["page_id", "score", "text"] and sorted(r.text for r in found.collect()) == ["", "", "x"]
    assert extracted(rows.limit(0)).count() == 0


@pytest.mark.parametrize("page", ["<div>" * 8000 + "</span>" * 8000, '<a href="x>' + "<b>y</b>" * 8000, "<noscript>x " * 8000, "<header>" * 8000 + "x, y", "<i>x, " * 8000])
def test_hostile_pages_take_linear_time(page):
    """Five megabytes of unclosed or stray tags take no longer a byte than a tenth of that, within a factor of four."""
    import time

    def seconds(times):
        start = time.process_time()
        main_text(page * times)
        return time.process_time() - start

    small, times = 2, -(-5_000_000 // len(page))
    least = max(0.02, seconds(small))
    assert seconds(times) < 4 * least * times / small
