"""Main text of pages: markup strange and plain."""

import numpy as np

from wattline.llm import html
from wattline.llm.html import main_text


def test_marked_article():
    page = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style><script>var t="</p>";</script></head><body>
    <header class=top><h1>Site</h1></header><nav><ul><li><a href="/x">Menu</a></ul></nav><div class="ad">Buy<p>now</div>
    <article class="post has-sidebar"><h1>Title &amp;&eacute;&#33;</h1><p><b>Bold <br><p>One
      two&nbsp;three<!-- gone <p> --> four<div class="ad-box">Advert</div><p>x<aside>Side <p>more</aside><ul><li>a<li>b</ul>
    <form><p>Your name</form><section id="comments"><article><p>First!</p></article></section><p>End 1 < 2 &lt;b&gt;</article>
    <footer>&copy; me</footer></body></html>"""
    assert main_text(page) == "Title &é!\nBold\nOne two three four\nx\na\nb\nEnd 1 < 2 <b>"


def test_unclosed_menu_before_the_article():
    assert main_text("<nav><ul><li>Menu<article><p>Text</p></article><footer>f") == "Text"


def test_no_article_marked():
    para = "This paragraph is long enough to make the text surge over the threshold of the window. " * 2
    page = f"<body><div><a href=/>Home</a></div><div><a>About us and everything else on this site, in one long link text here and more</a></div>" \
           f"<div><h1>Head</h1><p>{para}</p><p>Short.</p><p>{para}</p></div><div class='footer'>Imprint</div>"
    assert main_text(page) == "\n".join(["Head", para.strip(), "Short.", para.strip()])


def test_surge_and_dive():
    assert html.between(np.array([0, 5, 0, 0, 9, 90, 1, 0, 0, 0, 0, 50, 60]), 3, 80).tolist() == \
        [False] * 4 + [True] * 3 + [False] * 4 + [True, True]


PARA = "This paragraph is long enough to make the text surge over the threshold of the window."


def test_short_lines_that_join_the_span():
    page = f"<div><h1>Head</h1><p>By Ann<p>Today<p>In short<div class=ad>Buy</div><p>So<p>Well<p>{PARA}<p>End</div>"
    assert main_text(page) == "\n".join(["Head", "By Ann", "Today", "In short", "So", "Well", PARA, "End"])
    far = f"<p>Welcome<div class=ad>Buy<p>two</div><div class=ad>more</div><p>{PARA}"
    assert main_text(far) == PARA


def test_unmarked_page_below_the_threshold_stays_whole():
    assert main_text("<nav>Menu</nav><p>One<div><a href=x>Link only</a></div><p>Two<footer>me</footer>") == "One\nTwo"
    assert main_text("<nav>Menu</nav><a href=x>Link only</a>") == "Link only"
    assert main_text("plain text") == "plain text" and main_text("<nav>Menu</nav>") == ""


def test_marked_article_only_widens():
    page = f"<h1>Head</h1><p>{PARA}</p><div class=ad>{PARA}</div><article><p>Card</p></article><footer>me</footer>"
    assert main_text(page) == f"Head\n{PARA}\nCard"
    far = f"<p>{PARA}</p>" + "<div class=ad>Buy</div>" * 4 + "<div>small print</div>" + "<div class=ad>Buy</div>" * 4 + "<main><p>Text <a>link</a><p><a>Link</a></main>"
    assert main_text(far) == f"{PARA}\nText link\nLink"


def test_odd_pages(spark):
    rows = [(1, "u", None), (None, None, ""), (2, "u", "<article>" + "<p>para &amp; text" * 50000), (2, "u", "plain text"), (3, "u", "<"),
            (4, "u", "<article><script>x</article>"), (5, "u", "<p>" * 3000 + "</div>" * 3000 + "<span>" * 3000)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    got = {(r.page_id, r.n_chars): r.text for r in html.extract(df).collect()}
    assert got[(1, 0)] == got[(None, 0)] == ""
    assert got[(2, 50000 * 12 - 1)] == "\n".join(["para & text"] * 50000)
    assert html.extract(df.limit(0)).count() == 0
