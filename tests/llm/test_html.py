"""Extraction against hand-labelled pages, a plain regex version on the driver's pages, and its edge cases."""

import html
import os
import random
import re

import pytest

from corpusloom.llm import html_extract

TEXT = "It was a long day, and the river, which had risen in the night, ran high between its banks. "
OTHER = "Nobody had seen the ferry since noon, though three people, all of them fishermen, had looked for it. "
A, B, C = TEXT.strip(), OTHER.strip(), "A third paragraph, shorter, closes the piece."
NAV = '<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li></ul></nav>'
FOOT = "<footer><p>&copy; 2024 Example, all rights reserved.</p></footer>"

#: (page, text) labelled by hand.
PAGES = {
    "article": (f"<body>{NAV}<header>Site name</header><article><h1>Title</h1><p>{A}</p><p>{B}</p></article>{FOOT}</body>", f"Title\n{A}\n{B}"),
    "inline content stays": (f"<article><p>See <label>Table 1</label> and <math>x=1</math>, ok.</p><p>{A}</p></article>", f"See Table 1 and x=1, ok.\n{A}"),
    "utility classes": (f'<article><div class="hidden-xs side-by-side"><p>{A}</p></div><p>{B}</p></article>', f"{A}\n{B}"),
    "headings with telling ids": (
        f'<article><h1>T</h1><p>{A}</p><h2 id="Related_work">Related work</h2><p>{B}</p><section id="social-impact"><h2 id="search">Search</h2><p>{C}</p></section></article>',
        f"T\n{A}\nRelated work\n{B}\nSearch\n{C}",
    ),
    "comments and share bars inside": (
        f'<article><h1>T</h1><div class="share-buttons"><a href="#">Tweet</a></div><p>{A}</p><aside>Aside, with words.</aside><div id="comments"><p>First, I disagree, strongly.</p></div></article>',
        f"T\n{A}",
    ),
    "no article": (f'<body><div id="top-menu"><a href=1>one</a> <a href=2>two</a></div><div class="post"><h1>T</h1><p>{A}</p><p>{B}</p></div><div class="sidebar"><p>Popular, now.</p></div></body>', f"T\n{A}\n{B}"),
    "heading in main before the article": (f"<main><h1>Big title</h1><article><p>{A}</p><p>{B}</p></article></main>", f"Big title\n{A}\n{B}"),
    "sections beside each other": (
        f"<div><h1>T</h1><section><h2>One</h2><p>{TEXT}{OTHER}{TEXT}</p><p>{OTHER}{TEXT}</p></section><section><h2>Two</h2><p>{A}</p></section><ul><li>point one, short</li><li>point two</li></ul></div>",
        f"T\nOne\n{A} {B} {A}\n{B} {A}\nTwo\n{A}\npoint one, short\npoint two",
    ),
    "article header and figure": (f"<article><header><h1>T</h1><p>By Someone</p></header><p>{A}</p><figure><img src=x><figcaption>A boat, moored.</figcaption></figure><p>{B}</p></article>", f"T\nBy Someone\n{A}\nA boat, moored.\n{B}"),
    "forms, scripts, notices": (
        f'<body><div class="cookie-banner"><p>We use cookies, lots of them, everywhere.</p></div><div class="content"><p>{A}</p><script>var a="</p>";</script><form><label>Mail</label><input></form><p>{B}</p></div></body>',
        f"{A}\n{B}",
    ),
    "references and white space": (f"<article><p>a&amp;b &lt;c&gt;\n &eacute;&#8212;&#x41;&nbsp;z</p><p>{A}</p></article>", f"a&b <c> é—A z\n{A}"),
    "table and list": (f"<article><p>{A}</p><table><tr><td>1</td><td>two</td></tr></table><ol><li>x<li>y</ol></article>", f"{A}\n1\ntwo\nx\ny"),
    "unclosed inline tag": (f"<body>{NAV}<article><h1>T</h1><p><b>{A}<p>{B}</p></article>{FOOT}", f"T\n{A}\n{B}"),
    "reader comments in an article": (f'<article><p>{A}</p><div class="post-comments"><p>I disagree, strongly, with all.</p></div><section class="user-comments"><p>Me too.</p></section></article>', A),
    "one comment": (f'<article><p>{A}</p><p>{B}</p><div class="comment"><p>{C}</p></div><ol class="commentlist"><li>{C}</li></ol></article>', f"{A}\n{B}"),
    "comments by camel case and id": (f'<main><p>{A}</p><p>{B}</p><div class="postComments"><p>{C}</p></div><div id="reader_comments"><p>{C}</p></div></main>', f"{A}\n{B}"),
    "replies": (f'<article><p>{A}</p><div class="comment-respond"><h3>Leave a reply</h3></div><div class="replyList"><p>{C}</p></div></article>', A),
    "advert between paragraphs": (f'<article><p>{A}</p><div class="ad-banner"><p>Buy one, get two, today.</p></div><div class="ad_box"><p>Cheap, new, here.</p></div><p>{B}</p></article>', f"{A}\n{B}"),
    "numbered slots": (f'<article><p>{A}</p><div class="adSlot-3 inline"><p>Buy now.</p></div><div class="google-ads-unit"><p>Buy, buy.</p></div><p>{B}</p></article>', f"{A}\n{B}"),
    "sponsored block": (f'<article><p>{A}</p><div class="sponsored-content"><h4>Our partner</h4><p>{C}</p></div><p>{B}</p></article>', f"{A}\n{B}"),
    "menu in an article": (f'<article><ul class="menu"><li><a href=1>One</a></li><li><a href=2>Two</a></li></ul><div class="nav"><a href=3>Three</a></div><h1>T</h1><p>{A}</p></article>', f"T\n{A}"),
    "menu by link density": (f'<article><h1>T</h1><p>{A}</p><div class="chapter-menu"><a href=1>First chapter</a> <a href=2>Second chapter</a></div></article>', f"T\n{A}"),
    "footer in an article": (f'<article><p>{A}</p><p>{B}</p><div class="footer"><p>Filed under news, all rights reserved.</p></div></article>', f"{A}\n{B}"),
    "words of other things stay": (
        f'<article><h1>T</h1><div class="ad-hoc-networks"><p>{A}</p></div><section class="related-work"><p>{B}</p></section><div class="menu-engineering"><p>{C}</p></div></article>',
        f"T\n{A}\n{B}\n{C}",
    ),
    "comment in code": (f'<article><p>{A}</p><pre><span class="comment"># start, here</span> run()</pre><p>{B}</p></article>', f"{A}\n# start, here run()\n{B}"),
    "heading with a telling class": (f'<article><h1>T</h1><h2 class="comment">On comments</h2><p>{A}</p><p>{B}</p></article>', f"T\nOn comments\n{A}\n{B}"),
    "marked section": (f"<article><p>{A}</p><![foo[bar]]><p>{B}</p><![if !IE]><p>{C}</p><![endif]></article>", f"{A}\n{B}\n{C}"),
    "declarations and instructions": (f"<?xml version='1.0'?><!DOCTYPE html><article><![ ><p>{A}</p><!><!x><?php echo 1 ?><p>{B}</p></article><!-- open <p>{C}</p>", f"{A}\n{B}"),
    "open declaration": (f"<article><p>{A}</p><p>{B}</p></article><![CDATA[ never closed <p", f"{A}\n{B}"),
    "links only": ("<body><ul><li><a href=1>a</a></li></ul><p>Short text, alone.</p></body>", "Short text, alone."),
}


@pytest.mark.parametrize("name", sorted(PAGES))
def test_labelled(name):
    page, want = PAGES[name]
    assert html_extract.main_text(page) == want


def test_small_inputs():
    assert [html_extract.main_text(h) for h in (None, "", "bare", "<p>a<p>b", "<div>" * 3000 + "deep", "<nav>x</nav>")] == ["", "", "bare", "a\nb", "deep", ""]


def test_random_markup_is_no_error():
    r = random.Random(8)
    parts = ["<", ">", "</", "/>", "<!", "<!--", "-->", "--!>", "<![", "]]>", "]", "<?", "?>", "&", "&#", "&#x", ";", "\"", "'", "=", " ", "\n", "\x00", "p", "div", "<p>", "</p>", "<div class=", "ad-box", "<a href=",
             "<script>", "</script>", "<style", "<title>", "<article>", "</article>", "<table><td>", "</table>", "<li>", "<![CDATA[", "<![if", "<!DOCTYPE", "&nbsp", "&#0;", "&#xD800;", "é🙂", "text, text", "comments", "<br/", "<svg/>", "<textarea>", "<plaintext>"]
    for _ in range(10_000):
        page = "".join(r.choice(parts) for _ in range(r.randint(1, 40)))
        assert isinstance(html_extract.main_text(page), str)
        assert A in html_extract.main_text(f"<article><p>{A}</p><p>{TEXT * 40}</p></article>{page}")


def test_long_pages_are_linear():
    import time

    n = 20_000
    for page in ("<b>" * n + "<p>x" * n, '<div class="header">' * n + "x", "<b>" * n + "<table><tr><td>" + "<i>" * n + "</b>" * n, "<b><div>,x" * n):
        began = time.process_time()
        html_extract.main_text(page)
        assert time.process_time() - began < 6


def test_extract(spark):
    """Nulls, empty pages, repeated rows, clashing and extra columns, an empty table."""
    page = PAGES["article"]
    rows = [(1, "u", page[0], "x", 5), (1, "u", page[0], "x", 5), (None, None, None, None, None), (2, "v", "", "y", 6), (3, None, "<![foo[bar]]>", None, 1), (4, "w", "a<![ >b", "", 0)]
    d = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")
    got = sorted(html_extract.extract(d).collect(), key=str)
    want = [(1, "u", page[1], len(page[1]))] * 2 + [(2, "v", "", 0), (None, None, "", 0), (3, None, "", 0), (4, "w", "ab", 2)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert html_extract.extract(d.limit(0)).count() == 0


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no driver tables")
def test_driver_pages(spark):
    """The driver's pages hold one article of headings and paragraphs: cut it out by patterns."""

    def plain(page):
        body = re.search(r"<article>(.*?)(?:</article>|\Z)", page or "", re.S)
        if not body:
            return None
        parts = re.split(r"</?(?:p|h1|li|ul)\b[^>]*>", re.sub(r"<!--.*?-->", "", body[1], flags=re.S))
        parts = [re.sub(r"<br\s*/?>", " ", x) for x in parts]
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in parts]
        return "\n".join(x for x in parts if x)

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r.text for r in html_extract.extract(pages).collect()}
    want = {r.page_id: plain(r.html) for r in pages.collect()}
    assert len(got) == len(want) and all(got[i] == t for i, t in want.items() if t is not None)
