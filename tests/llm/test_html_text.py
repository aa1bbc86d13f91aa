import time

import pytest

from tripartite.llm import html_text as ht


@pytest.mark.parametrize(
    "page,text",
    [
        (None, ""),
        ("", ""),
        ("plain  text &amp; more", "plain text & more"),
        ("<p>one<p>two, <b>three</p>", "one\n\ntwo, three"),
        ("<script>var a='</p>'</script><style>p{}</style><!-- no <p>x</p> -->", ""),
        (
            "<body><nav><ul><li><a href=/>Home</a></ul></nav><div class='ad'>Buy, now!</div>"
            "<article><h1>Title</h1><p>First, long paragraph.<br>Next line.</p><p>Second\n &eacute;t&#233;</p></article>"
            "<footer>&copy; me</footer></body>",
            "Title\n\nFirst, long paragraph. Next line.\n\nSecond été",
        ),
        (
            "<div id=header>Site</div><div class=sidebar><p>Links, many, of, them</p></div>"
            "<div id=content><p>The text, of some length, with commas, and more of it to score.</p>"
            "<p>And a second paragraph, with its own words, and its own commas.</p></div>"
            "<div class='comments'><p>First! I, for one, like, this, very, much, indeed, yes.</p></div>",
            "The text, of some length, with commas, and more of it to score.\n\n"
            "And a second paragraph, with its own words, and its own commas.",
        ),
        (
            "<main><p>Kept, as main text.</p><form><p>Your name</p><input></form>"
            "<aside><p>See, also, that</p></aside><div role=alert>Cookies!</div><div hidden>no</div>"
            "<table><tr><td>cell one<td>cell two</table></main>",
            "Kept, as main text.\n\ncell one\n\ncell two",
        ),
        ("<article><p>unclosed <i>tags <a href='x>y'>and</a> a &lt; sign", "unclosed tags and a < sign"),
    ],
)
def test_pages(page, text):
    assert ht.main_text(page) == text


TEXT = "<p>The text, of some length, with commas, and more of it to score.</p>"
PLAIN = TEXT[3:-4]


@pytest.mark.parametrize(
    "page,text",
    [
        (f"<div id=content class='with-sidebar'>{TEXT}{TEXT}</div>", f"{PLAIN}\n\n{PLAIN}"),
        (f"<article class='post has-comments'>{TEXT}</article>", PLAIN),
        (f"<div class='sidebar'>{TEXT}</div>", PLAIN),
        (f"<div class='widget'><main>{TEXT}</main></div>", PLAIN),
        (f"<article>{TEXT}<section id='related-work'><p>Others, too.</p></section></article>", f"{PLAIN}\n\nOthers, too."),
        (f"<article><div class='article-header'><h1>Head</h1></div>{TEXT}</article>", f"Head\n\n{PLAIN}"),
        (f"<article><p>one <svg viewBox='0 0 1 1'/> two</p><p>x <math/>y</p>{TEXT}</article>", f"one two\n\nx y\n\n{PLAIN}"),
        (f"<article><svg><path d='a'/><text>no</text></svg>{TEXT}</article>", PLAIN),
        (f"<article><title-bar>kept</title-bar>{TEXT}<style-x>as well</style-x></article>", f"kept\n\n{PLAIN}\n\nas well"),
        (f"<article>{TEXT}<ol><li><a href=x>A source</a></li></ol></article>", f"{PLAIN}\n\nA source"),
        (f"<article>{TEXT}<div class='share'>Share, this</div><p>a <span class='ad'>Buy</span></p></article>", f"{PLAIN}\n\na"),
    ],
)
def test_names_and_lists_take_no_article_text(page, text):
    assert ht.main_text(page) == text


NOISE = "<p>First! I, for one, like, this, very, much, indeed, yes.</p>"


@pytest.mark.parametrize(
    "comments",
    [
        f"<section id='comments'>{NOISE}</section>", f"<div class='comment-list'>{NOISE}{NOISE}</div>",
        f"<section id=comments><article class=comment>{NOISE}</article><article class='comment odd'>{NOISE}</article></section>",
        f"<div id='disqus_thread'>{NOISE}</div>", "<div class='social-share'><a href=x>Share, it</a></div>",
        "<div class='cookie-banner'><p>We, too, use cookies.</p></div>", f"<ol class='commentlist'><li>{NOISE}</ol>",
    ],
)
def test_comments_go_inside_and_beside_the_article(comments):
    body = f"<h1>Head</h1>{TEXT}{TEXT}{TEXT}"
    want = "\n\n".join(["Head", PLAIN, PLAIN, PLAIN])
    assert ht.main_text(f"<article>{body}{comments}</article>") == want
    assert ht.main_text(f"<div id=content>{body}</div>{comments}") == want
    assert ht.main_text(f"<main><div class='post'>{body}</div>{comments}</main>") == want


@pytest.mark.parametrize(
    "page,text",
    [
        (f"<div class='has-comments'>{TEXT}{TEXT}</div><div class='comments'>{NOISE}</div>", f"{PLAIN}\n\n{PLAIN}"),
        (f"<div id='social-network'><h1>On it</h1>{TEXT}</div>", f"On it\n\n{PLAIN}"),
        (f"<div id='comment-page'><article>{TEXT}</article></div>", PLAIN),
    ],
)
def test_names_spare_what_holds_the_article(page, text):
    assert ht.main_text(page) == text


@pytest.mark.parametrize(
    "page",
    [
        "<script " * 120_000, "<!" * 400_000, "<a href='" * 100_000, "<script " * 120_000 + ">", "</p>" * 200_000,
        "<div>x" * 50_000, "<div><p>a, b" * 50_000, "<article>" * 50_000 + "<p>x", "<div class=comment>a" * 30_000,
        "<div>" * 30_000 + "<p>x</b></i>" * 30_000, "<svg x" * 100_000 + "<p>x</p>",
    ],
)
def test_broken_and_deep_markup_takes_linear_time(page):
    start = time.process_time()
    ht.main_text(page)
    assert time.process_time() - start < 4


def test_text_behind_the_last_tag():
    assert ht.main_text("<p>a</p>b <c d") == "a\n\nb"
    assert ht.main_text("<p>a</p>b <!-- c <p> d") == "a\n\nb"
    assert ht.main_text("x < y, z <1") == "x < y, z <1"


def test_long_and_deep_pages():
    body = "".join(f"<p>Paragraph {i}, with words.</p>" for i in range(3000))
    assert ht.main_text(f"<article>{body}</article>").count("\n\n") == 2999
    assert ht.main_text("<div>" * 500 + "<p>deep, inside</p>") == "deep, inside"


def test_rows(spark):
    rows = [(1, "u", "<p>x</p>", "own"), (1, "u", "<p>x</p>", "own"), (None, None, None, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted(((r["row"].page_id, r["row"].text, r.text, r.n_chars) for r in ht.extract(df).collect()), key=repr)
    assert got == [(1, "own", "x", 1), (1, "own", "x", 1), (None, None, "", 0)]
    assert ht.extract(df.limit(0)).collect() == []
