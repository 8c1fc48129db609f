import html
import re

import numpy as np

from ridgeline.llm import html_extract as H

LONG = "A long paragraph of the article which says a good deal about its matter, number {}, and then a little more."


def plain(page):
    """The article of the test pages: its blocks with the markup taken out."""
    body = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1|br)>", body)]
    return "\n".join(b for b in blocks if b)


def test_whole_test_table(spark):
    d = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    out = {r.page_id: r for r in H.extract(d).collect()}
    for r in d.collect():
        assert out[r.page_id].text == plain(r.html) and out[r.page_id].n_chars == len(plain(r.html)) and out[r.page_id].url == r.url


def page(body, article=True):
    inner = f"<article>{body}</article>" if article else f"<div class='content'>{body}</div>"
    return f"""<!doctype html><html><head><title>T</title><style>p{{}}</style></head><body><header><h1>Site name</h1></header>
    <div class="cookie-notice">We use cookies on this site and this notice is long enough to look like a text of its own.</div>
    <nav><ul><li><a href="/">Home</a><li><a href="/b">News and a very long menu entry that goes on and on for a while</a></ul></nav>
    <div id="sidebar"><p>{LONG.format("side")}</p></div>{inner}<section class="comments"><p>{LONG.format("comment")}</p></section>
    <form><label>Name</label><input><textarea>{LONG.format("form")}</textarea></form>
    <aside>{LONG.format("aside")}</aside><footer><p>&copy; {LONG.format("foot")}</p></footer><script>var x = "<p>{LONG}</p>";</script></body></html>"""


BODY = f"""<h1>A &lt;title&gt;</h1><p>{LONG.format(1)}</p><p>Sh<b>or</b>t&nbsp;&amp;
  spaced<!-- gone --></p><div class="ad-box"><p>{LONG.format("ad")}</p></div><ul><li>one<li>two <a href=x>linked</a></ul>
  <p>{LONG.format(2)}<br>after a break<script>no()</script></p><figure><figcaption>Caption</figcaption></figure>"""
WANT = ["A <title>", LONG.format(1), "Short & spaced", "one", "two linked", LONG.format(2) + " after a break", "Caption"]


def test_article_is_kept_whole_and_the_rest_goes():
    assert H.main_text(page(BODY)).split("\n") == WANT


def test_unmarked_page():
    got = H.main_text(page(BODY, article=False)).split("\n")
    assert LONG.format(1) in got and LONG.format(2) + " after a break" in got
    assert not any(w in " ".join(got) for w in ("side", "comment", "aside", "foot", "cookies", "News"))


def test_unmarked_page_is_kept_whole():
    assert H.main_text(page(BODY, article=False)).split("\n") == WANT
    ad = f"<div class='ad'>{LONG.format('ad')}</div>"
    tail = f"{ad}<p>The end.</p>{ad}<p><a href=x>All of this short line is a link</a></p><div>{ad}<ul><li>x</ul></div>"
    want = [*WANT, "The end.", "All of this short line is a link", "x"]
    assert H.main_text(page(BODY + tail, article=False)).split("\n") == want
    menu = "<div><ul>" + "<li><a href=x>Entry of an unnamed menu</a></li>" * 9 + "</ul></div>"
    assert H.main_text(f"<body>{menu}{ad}{page(BODY + tail, article=False)}</body>").split("\n") == want
    parts = "".join(f"<div><p>{LONG.format(k)}</p></div><div>{ad}<p>No. {k}</p>{ad}</div>" for k in range(3))
    want = [x for k in range(3) for x in (LONG.format(k), f"No. {k}")]
    assert H.main_text(f"<body>{menu}<div>{parts}</div></body>").split("\n") == want
    one = f"<div><div><p>{LONG.format(1)}</p></div>{ad}<p>Bye</p></div>"
    assert H.main_text(f"<body>{menu}{one}</body>").split("\n") == [LONG.format(1), "Bye"]


def test_names_that_only_contain_a_word_of_a_block():
    for name in ("page no-sidebar", "overflow-hidden", "has-banner post", "entry-header-none", "longform", "comments-open"):
        assert H.main_text(f"<body><div class='{name}'>{page(BODY)}</div></body>").split("\n") == WANT, name
    for name in ("content-with-header", "menu", "sidebar wide", "header"):      # the last three around the only article
        assert H.main_text(f"<div id='{name}'><article>{BODY}</article></div>").split("\n") == WANT, name
        assert H.main_text(f"<div id='{name}'><main>{BODY}</main></div><article>other</article>").split("\n") == [*WANT, "other"], name


def test_parts_of_a_marked_article_with_such_words():
    parts = [("section", "id", "discussion"), ("p", "class", "alert"), ("h2", "id", "search-methods"), ("div", "class", "feedback"),
             ("div", "class", "legal"), ("ul", "class", "related"), ("p", "class", "ad"), ("h3", "id", "comments"),
             ("div", "class", "notice"), ("section", "id", "cookies-and-law")]
    body = "".join(f"<{e} {a}='{v}'>Text of {v}</{e}>" for e, a, v in parts)
    assert H.main_text(page(BODY + body)).split("\n") == WANT + [f"Text of {v}" for _, _, v in parts]


def test_named_blocks_go():
    names = ["ad", "ad-slot-3", "topAds", "site-header", "main-nav", "footer_wrapper", "cookie-banner", "search-form", "sidebar",
             "comments-area", "post-comments", "userComment", "newsletter-box", "social-share"]
    junk = "".join(f"<div class='x {n}'><p>{LONG.format(n)}</p></div>" for n in names)
    assert H.main_text(page(BODY + junk)).split("\n") == WANT
    got = H.main_text(page(BODY + junk, article=False))
    assert not any(LONG.format(n) in got for n in names)


def test_comment_articles():
    said = "".join(f"<article {a}><p>{LONG.format('said')}</p></article>"
                   for a in ("class='comment'", "id='div-comment-7' class='comment-body'", "class=\"reader-comment odd\""))
    assert H.main_text(page(BODY) + said).split("\n") == WANT
    assert H.main_text(page(BODY + said)).split("\n") == WANT
    teaser = f"<div class='sidebar'><article><p>{LONG.format('teaser')}</p></article></div>"
    for extra in (said, f"<div id='comments'><article><p>{LONG.format('said')}</p></article></div>", teaser):
        got = H.main_text(page(BODY, article=False) + extra).split("\n")
        assert LONG.format(1) in got and LONG.format(2) + " after a break" in got
        assert not any("said" in x or "teaser" in x for x in got)


def test_broken_markup():
    assert H.main_text("<article><p>one<p>two</article>") == "one\ntwo"
    assert H.main_text("plain < text & more &amp") == "plain < text & more &"
    assert H.main_text("<article><p>open <b>bold") == "open bold"
    assert H.main_text("<p title='a>b'>x</p><script>never closed") == "x"
    assert H.main_text("<p>a</i></b></div>b</p>") == "a\nb"
    assert H.main_text("<p>cut <a href=\"x") == "cut"
    assert H.main_text("<!-- never closed <p>x</p>") == ""
    assert H.main_text("<ARTICLE><P>Upper</P></ARTICLE>") == "Upper"


def test_edge_rows(spark):
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<nav>x</nav>"), (3, "u", page(BODY)), (3, "u", page(BODY)),
            (4, "u", "<article>" + "<p>word</p>" * 20000 + "</article>"), (5, "u", "<" * 20000 + "é😀"), (6, "u", "<div>" * 3000 + "deep")]
    d = spark.createDataFrame([r + ("t", 1) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    out = {(r.page_id, r.url): (r.text, r.n_chars) for r in H.extract(d).collect()}
    assert out[1, "u"] == ("", 0) and out[2, None] == ("", 0) and out[None, "u"] == ("", 0)
    assert out[3, "u"][0].split("\n") == WANT and out[4, "u"][1] == 20000 * 5 - 1 and out[6, "u"] == ("deep", 4)
    assert out[5, "u"][0].endswith("é😀") and out[5, "u"][1] == len(out[5, "u"][0])
    assert H.extract(d.limit(0)).collect() == []


def test_regions_follow_surges_and_dives():
    w = np.array([0, 0, 5, 0, 9, 0, 0, 0, 0, 7, 0, 0])
    assert [(a, b) for a, b, _ in H.regions(w)] == [(0, 5), (7, 10)]
    assert H.regions(np.zeros(0)) == [] and H.regions(np.zeros(4)) == []
