import html
import itertools
import re
import time

import numpy as np
import pytest

from quillmark.llm import html_extract as extract
from quillmark.llm.common import read


def test_pages_of_the_table(spark, sf):
    """The generated pages keep their article in one element; everything else is boilerplate."""
    texts = {r.page_id: r for r in extract.op10_html(spark, sf).collect()}
    for r in read(spark, sf, "pages").collect():
        inner = re.search(r"<article>(.*?)(?:</article>|$)", r.html, re.S)[1]
        inner = re.sub(r"</?b>", "", inner).replace("<br>", " ")
        expected = " ".join(html.unescape(re.sub(r"<[^>]*>", " ", inner)).split())
        assert texts[r.page_id].text == expected
        assert texts[r.page_id].n_chars == len(expected) and texts[r.page_id].url == r.url


PAGE = """<html><head><title>No</title><style>p{}</style></head><body><header><h2>Site name</h2></header>
<nav><ul><li><a href=/>Home</a><li><a href=/x>More</a></ul></nav>
<main><h1>Head&amp;line</h1><p>First paragraph, with <b>bold</b>text and
 a few words.<p>Second &nbsp; paragraph goes on, and on, and ends here.<script>var a = "<p>no</p>";</script>
<div class="ad-box">Buy this now, only today.</div><form>Name <input> please</form><p>Third paragraph closes it all.</p>
<aside>Related things, that others read.</aside></main><section id="comments"><p>I think, as a reader, this is wrong.</p></section>
<!-- hidden <p>x</p> --><div style="display:none">Unseen text</div><footer>&copy; 2020 Someone</footer></body></html>"""


def test_a_whole_page():
    assert extract.main_text(PAGE, extract.PRIOR) == (
        "Head&line First paragraph, with boldtext and a few words. Second paragraph goes on, and on, and ends here. "
        "Third paragraph closes it all."
    )


@pytest.mark.parametrize("page", ["", "<", "<p", "<!--", "</p></div>", "<a href='x", "&#0;&#xD800;&bogus;", "<script>", "\x00", "<p>" * 5000])
def test_broken_pages_do_not_crash(page):
    assert isinstance(extract.main_text(page, extract.PRIOR), str)


def test_very_long_page():
    page = "<article>" + "<p>Some words, in a paragraph." * 20_000 + "</article>"
    assert extract.main_text(page, extract.PRIOR).count("paragraph") == 20_000


ARTICLE = "".join(f"<div>Paragraph {k} of the text goes on, with some words, and ends here.</div>" for k in range(6))


@pytest.mark.parametrize(
    "page",
    [
        f"<body><form>{PAGE.split('<body>')[1].split('</body>')[0]}</form></body>",
        f"<body><div class='no-footer'>{ARTICLE}</div></body>",
        f"<body><form id='search'><nav><a href=/>Home</a></nav><article>{ARTICLE}</article></form><footer>Imprint</footer></body>",
    ],
)
def test_a_name_around_the_whole_page_says_nothing(page):
    found = extract.main_text(page, extract.PRIOR)
    if "Head&amp;line" in page:
        assert found == extract.main_text(PAGE, extract.PRIOR)
    else:
        assert found.count("Paragraph") == 6 and "Home" not in found and "Imprint" not in found


def test_long_comments_do_not_become_the_article():
    comments = "".join(f"<p>I think, as reader {k}, that all of this is wrong.</p>" for k in range(40))
    page = f"<body><article>{ARTICLE}</article><section id='comments'>{comments}</section></body>"
    found = extract.main_text(page, extract.PRIOR)
    assert found.count("Paragraph") == 6 and "reader" not in found


def test_long_mixed_and_deep_pages_take_linear_time():
    mixed = "<p>Some words, in a paragraph, that go on for a while.</p><nav><a href=/>Home</a></nav>" * 5_000
    deep = "<div>Some words, in a paragraph, that go on for a while." * 5_000
    for page, count in ((mixed, 5_000), (deep, 5_000)):
        begin = time.process_time()
        assert extract.main_text(f"<body>{page}</body>", extract.PRIOR).count("paragraph") == count
        assert time.process_time() - begin < 5


def test_cut_is_minimal():
    chance = np.random.default_rng(8)
    for _ in range(60):
        n = int(chance.integers(1, 8))
        odds = chance.normal(0, 2, n)
        edges = [(int(a), int(b), float(c)) for a, b, c in zip(chance.integers(0, n, 10), chance.integers(0, n, 10), chance.random(10) * 2) if a != b]

        def cost(kept):
            own = sum(max(0, o) for o, k in zip(odds, kept) if not k) + sum(max(0, -o) for o, k in zip(odds, kept) if k)
            return own + sum(c for a, b, c in edges if kept[a] != kept[b])

        least = min(cost(k) for k in itertools.product((False, True), repeat=n))
        assert cost(extract.minimum_cut(odds, edges)) == pytest.approx(least)


def test_edge_rows(spark):
    rows = [(1, None, None, 1), (1, "u", "", 2), (None, "u", PAGE, 3), (2, "u", PAGE, 4), (2, "u", PAGE, 4)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text int")
    found = extract.extract(pages, extract.train(pages)).collect()
    assert sorted(r.n_chars for r in found)[:2] == [0, 0] and len({r.text for r in found}) == 2
    empty = pages.where("page_id > 5")
    assert extract.extract(empty, extract.train(empty)).count() == 0
