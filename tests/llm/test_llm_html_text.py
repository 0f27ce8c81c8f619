import itertools
import random
import re
from html import unescape

from llm_helpers import rows

from qlens.llm import html_text as h

PAGE = """<!DOCTYPE html><html><head><title>Site</title><style>p{}</style><script>var a = "</p><p>no";</script></head>
<body class="page"><!-- <p>comment</p> -->
<header class="site-header"><a href="/">Home</a> <h1>The Site</h1></header>
<nav><ul><li><a href=a>One</a><li><a href=b>Two</a></ul></nav>
<div id="cookie-notice">We use cookies on this site. Please accept them to read on.</div>
<div class="layout"><div class="sidebar-left"><p>A list of other things you may want to read on this site.</p></div>
<div class="post-content"><h2>A   title &amp; more</h2>
<p>First paragraph, with <b>bold</b> and <a href="x">a link</a> &lt;here&gt;.</p>
<p>Short.</p><blockquote>Quoted&nbsp;words</blockquote>
<ul><li>one<li>two</ul><table><tr><td>cell a<td>cell b</table>
<div class="ad">Buy this wonderful thing right now, it is very cheap today.</div>
<form><label>Name</label><input><textarea>text</textarea><button>Send it</button></form>
<p>Last paragraph of the article.</div>
<section id="comments"><div class="comment"><p>Great article, I have learned so much from reading it!</p></div></section></div>
<footer>&copy; 2024 The Site. All rights reserved.</footer></body></html>"""


def test_page():
    assert h.main_text(PAGE).split("\n") == [
        "A title & more",
        "First paragraph, with bold and a link <here>.",
        "Short.",
        "Quoted words",
        "one",
        "two",
        "cell a",
        "cell b",
        "Last paragraph of the article.",
    ]


def test_without_names():
    body = "<p>" + "A long paragraph that says a lot about its subject. " * 4 + "</p>"
    page = f"<ul><li><a href=a>Home</a><li><a href=b>About us</a></ul><div>{body}<p>Brief.</p>{body}</div><div><a href=x>More</a> <a href=y>Contact</a></div>"
    assert [t[:7] for t in h.main_text(page).split("\n")] == ["A long ", "Brief.", "A long "]


def test_articles_inside_what_is_not_content():
    story = "<article><h1>The story</h1><p>Its only paragraph is right here, for all to read.</p></article>"
    card = "<article><h2>Another story</h2><p>A few words about another story on this site.</p></article>"
    wanted = ["The story", "Its only paragraph is right here, for all to read."]
    assert h.main_text(f"{story}<section class=related>{card}</section><aside>{card}</aside>").split("\n") == wanted
    assert h.main_text(f"<div class=ad>Buy this thing now.{story}").split("\n") == wanted  # an advert without an end
    assert h.main_text("<nav><a href=a>Home</a></nav><div class=ad>Buy this thing now.</div><footer>The end.</footer>") == ""
    headed = '<div class="post"><div class="post-header"><h1>Title</h1></div><p>The text of the post is here.</p></div>'
    assert h.main_text(f"<div class=header>The site</div>{headed}").split("\n") == ["Title", "The text of the post is here."]


def test_elements_within_a_line():
    page = '<article><p>Some <b class="text">bold</b> words.</p><p>More <i>of</i> them <span class="ad">buy now</span></p></article>'
    assert h.main_text(page).split("\n") == ["Some bold words.", "More of them"]


def test_names_on_the_article_itself():
    body = "<header><h1>The story</h1></header><p>Its only paragraph is right here, for all to read.</p><p>Brief.</p>"
    wanted = ["The story", "Its only paragraph is right here, for all to read.", "Brief."]
    for tag, names in (
        ("article", "post has-comments"), ("article", "post category-social"), ("article", "sidebar-right"), ("article", "has-header"),
        ("main", "content with-sidebar"), ("main", "search"), ("article", "post comments social"), ("div", "content no-sidebar tag-search"),
        ("div", "post-content share"),
    ):
        page = f'<body class="single has-sidebar search"><nav><a href=a>Home</a></nav><{tag} class="{names}">{body}</{tag}><div class="ad">Buy this thing now.</div></body>'
        got = h.main_text(page).split("\n")
        assert got == (wanted if tag == "article" else wanted[-len(got):]) and len(got) >= 2, (tag, names, got)
    comment = '<article class="comment"><header>Somebody</header><p>I have learned so much from reading this, thank you!</p></article>'
    assert h.main_text(f"<article>{body}</article>{comment}").split("\n") == wanted


def test_sentence_with_an_element_that_speaks_against():
    page = '<article><p>Type into the <span class="search">search</span> box, <b class="form">then</b>: <i id=tags>go</i>.</p><p>More words <span class="ad">buy now</span> here.</p></article>'
    assert h.main_text(page).split("\n") == ["Type into the search box, then: go.", "More words here."]
    assert h.main_text('<article><p>All is said.<span class="share">Share this</span></p></article>') == "All is said."
    assert h.main_text('<p>Use the <span class="search">search</span> box to find more of them.</p>') == "Use the search box to find more of them."


def test_odd_html():
    for html in ("", "   ", "<", "<p", "<p class='x", "<!--", "<script>x", "&#x0;&bogus;", "<a href=\"x>y</a>", "</p></div>", "<div>" * 3000 + "x"):
        assert isinstance(h.main_text(html), str)
    assert h.main_text("<script>if (a < b) {}</script>") == ""
    assert h.main_text("<article><p>Half a refer&am</article>") == "Half a refer&am"


def brute_cut(odds, joined):
    """Least cost over all labellings."""
    return min(
        sum(max(o, 0) for o, s in zip(odds, side) if not s) + sum(max(-o, 0) for o, s in zip(odds, side) if s)
        + sum(c for a, b, c in joined if side[a] != side[b])
        for side in itertools.product((False, True), repeat=len(odds))
    )


def test_cut_is_cheapest():
    rng = random.Random(1)
    for _ in range(300):
        n = rng.randint(1, 9)
        odds = [rng.randint(-300, 300) for _ in range(n)]
        joined = [(a, a + 1, rng.randint(0, 200)) for a in range(n - 1)]
        joined += [(a, b, rng.randint(0, 200)) for a in range(n) for b in range(a + 2, n) if rng.random() < 0.3]
        side = h.minimum_cut(odds, joined)
        cost = sum(max(o, 0) for o, s in zip(odds, side) if not s) + sum(max(-o, 0) for o, s in zip(odds, side) if s)
        assert cost + sum(c for a, b, c in joined if side[a] != side[b]) == brute_cut(odds, joined)


def test_given_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    found = {r.page_id: r for r in h.extract(pages).collect()}
    assert len(found) == pages.count()
    for r in pages.collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        parts = [" ".join(unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>|<br>", inner)]
        assert found[r.page_id].text == "\n".join(p for p in parts if p)
        assert found[r.page_id].n_chars == len(found[r.page_id].text)


def test_rows(spark):
    schema = "page_id bigint, url string, html string, text string, n_chars string"
    body = "<article><p>A whole sentence for the text.</p></article>"
    pages = spark.createDataFrame(
        [(1, "u", None, "x", "y"), (2, None, "", "x", "y"), (3, "u", body, "x", "y"), (3, "u", body, "x", "y"), (None, "u", body * 3000, "x", "y")], schema
    )
    one = "A whole sentence for the text."
    long = "\n".join([one] * 3000)
    assert rows(h.extract(pages)) == sorted(
        [(1, "u", "", 0), (2, None, "", 0), (3, "u", one, 30), (3, "u", one, 30), (None, "u", long, len(long))], key=repr
    )
    assert h.extract(spark.createDataFrame([], schema)).collect() == []


def test_deep_pages_take_linear_time():
    """Megabytes of elements that are never closed, and of end tags that close nothing."""
    import time

    started = time.process_time()
    n = 2_000_000 // 18
    text = h.main_text("<article>" + "<div>word one two. " * n)
    assert text == "\n".join(["word one two."] * n)
    assert h.main_text("<article>" + "<div>a few words here. </p></section>" * 20_000).count("\n") == 19_999
    assert time.process_time() - started < 60


def test_sentences_between_lists_of_links_stay():
    page = "".join(f"<p>This is sentence number {k} of the page.</p><p><a href='#'>link {k}</a></p>" for k in range(2000))
    text = h.main_text(f"<html><body>{page}</body></html>").split("\n")
    assert text == [f"This is sentence number {k} of the page." for k in range(2000)]


def test_tree_distance():
    root = h.Place(0, None, 0)
    a, b = root.below(1).below(2), root.below(1).below(3).below(4)
    c = a.below(5)
    assert h.tree_distance(a, a) == 0 and h.tree_distance(a, c) == 1 and h.tree_distance(c, root) == 3
    assert h.tree_distance(a, b) == 5 and h.tree_distance(a, b, 2) == 2
