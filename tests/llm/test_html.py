"""Main text of pages: hand-made layouts, and the article of the given pages by a plain pattern."""

import html
import re

from airq.llm import html_text
from airq.llm.queries import QUERIES

ARTICLE = "The first paragraph is long enough to count as the main text of this page, with a few words more."


def text(source, path=None):
    return html_text.main_text(html_text.parse(source), path)


def test_given_pages(spark, folder):
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    found = {r.page_id: r for r in QUERIES["op4_html_text"](spark, folder).collect()}
    assert len(found) == pages.count()
    for r in pages.collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", p)).split()) for p in re.split(r"</?(?:h1|p)>", inner)]
        expected = "\n".join(p for p in parts if p)
        assert (found[r.page_id].text, found[r.page_id].n_chars, found[r.page_id].url) == (expected, len(expected), r.url)


def test_parts_that_are_aside():
    page = f"""<body class="with-sidebar"><nav>Menu</nav><header><p>Top</p></header><div class="page"><h1>Title &amp more</h1>
    <div class="body-12"><p>{ARTICLE}<p>Second<b> bold</b>  par&nbsp;x <a href="q">link</a>.<ul><li>i1<li>i2</ul>
    <div class="cookieNotice">We use cookies</div><form><p>Name</p><button>Go</button></form><table><tr><td>c1<td>c2</table>
    <script>var a = "<p>no</p>";</script><style>p{{}}</style><!-- <p>no</p> -->
    <section id="comments"><p>A reader says a lot of words, far more than the article itself does. {ARTICLE * 3}</p></section>
    </div></div><aside>aside</aside><div class="sponsored">Buy</div><footer>foot</footer>"""
    assert text(page) == f"Title & more\n{ARTICLE}\nSecond bold par x link.\ni1\ni2\nc1\nc2"


def test_broken_markup_does_not_fail():
    cases = {
        "": "", "<": "<", "<p": "", "a < b": "a < b", "<p>x": "x", "</p>y": "y", "<!-- a": "", "<script>var": "",
        "<a href='>x</a>": "x", "&amp;&#x41;&bogus;": "&A&bogus;", '<p class="a>b">z</p>': "z", "x<br>y": "x y",
        "<p>a<p>b</i></div><p>c": "a\nb\nc", "<title>t</title>u": "u", "<ul><li>a<ul><li>b</ul><li>c</ul>": "a\nb\nc",
    }
    assert {k: text(k) for k in cases} == cases
    assert text("<div>" * 3000 + "deep") == "deep"
    assert text("<p>" + "word " * 300_000) == ("word " * 300_000).strip()


def test_consensus_of_a_host_beats_one_odd_page(spark):
    def page(body, extra):
        return f'<body><div class="k7"><p>{body}</p></div><div class="zz-3"><p>{extra}</p></div></body>'

    rows = [(i, f"https://h.example/{i}", page(ARTICLE * 3, "short")) for i in range(5)]
    rows += [(5, "https://h.example/odd", page("tiny", ARTICLE * 4)), (6, "https://other.example/", page("tiny", ARTICLE * 4))]
    rows += [(7, None, page("tiny", ARTICLE * 4)), (8, "https://h.example/", None), (9, "x", ""), (9, "x", "")]
    df = spark.createDataFrame([(*r, "extra") for r in rows], "page_id long, url string, html string, host string")
    for broadcast_bytes in (10_000, 0):
        got = html_text.extract_text(df, broadcast_bytes=broadcast_bytes).collect()
        assert len(got) == len(rows)
        by = {r.page_id: r.text for r in got}
        assert by[0] == ARTICLE * 3 and by[5] == "tiny" and by[6] == by[7] == ARTICLE * 4
        assert by[8] == by[9] == ""
    assert html_text.extract_text(df.limit(0)).collect() == []


def test_text_around_pictures_formulas_and_objects():
    cases = {
        "<article><p>a <svg class='i'/> b</p><p>c</p></article>": "a b\nc",
        "<article><p>a <svg><title>t</title><text x='1'>no</text></svg> b</p></article>": "a b",
        "<article><p>a <svg><path d='M0'> no</p><p>c <svg><p>d</article>": "a\nc\nd",
        "<p>if <math><mi>x</mi><mo>=</mo><mn>1</mn></math> then</p>": "if x=1 then",
        "<p>a <math display='block'/> b</p>": "a b",
        "<article><object data='q'><p>instead of it</p><p>more</article>": "instead of it\nmore",
        "<article><p>a <object data='q'><param name='x'>instead</object> b</p></article>": "a instead b",
        "<p>a<svg><foreignObject><div>no</div></foreignObject></svg></p><p>b</p>": "a\nb",
        "<p>a<script>if (x < 1) '<p>'</script><noscript><p>no</p></noscript></p>": "a",
    }
    assert {k: text(k) for k in cases} == cases


def test_wrappers_named_like_parts_aside():
    inner = f"<nav>Menu of it</nav><h1>Title</h1><p>{ARTICLE}</p><div class='related'><p>Next</p></div><form><p>Name</p></form>"
    wrappers = ["form id=aspnetForm", "div class='layout sidebar-right'", "div class='long-form'", "div class=paywall", "div id=page class=comments-open"]
    for w in wrappers:
        end = w.split()[0]
        for body in (inner, f"<article>{inner}</article>", f"<main>{inner}</main>", f"<div class=sidebar-page>{inner}</div>"):
            for page in (f"<{w}>{body}</{end}>", f"<nav><a href=x>Home</a></nav><{w}>{body}</{end}><footer>{ARTICLE * 2}</footer>"):
                assert text(page) == f"Title\n{ARTICLE}", page
    # an article in a wrapper beside plain text of about its length
    assert text(f"<div class=paywall><article><p>{ARTICLE}</p></article></div><div><p>{ARTICLE[:50]}</p></div>") == ARTICLE


def test_parts_aside_that_hold_much_stay_aside():
    article = f"<h1>Title</h1><p>{ARTICLE}</p>"
    thread = "".join(f"<article class=comment-body><p>{ARTICLE * 3} {i}</p></article>" for i in range(9))
    for part in (f"<div id=comments>{thread}</div>", f"<section class=comments><p>{ARTICLE * 30}</p></section>", f"<aside>{ARTICLE * 30}</aside>"):
        assert text(f"<div>{article}{part}</div>") == f"Title\n{ARTICLE}"
        assert text(f"<article>{article}</article>{part}") == f"Title\n{ARTICLE}"
    assert text(f"<main>{article}<div class=related><article><p>A card</p></article></div></main>") == f"Title\n{ARTICLE}"


def test_titles_in_the_header_of_an_article():
    header = "<header><nav><h1>Menu</h1></nav><div><h1>Title</h1></div><p>By someone</p></header>"
    for a in ("article", "main", "div role=main"):
        end = a.split()[0]
        assert text(f"<header><h1>Site</h1></header><{a}>{header}<p>{ARTICLE}</p></{end}>") == f"Title\n{ARTICLE}"
    assert text(f"<article class=comment><header><h1>No</h1></header></article><article><p>{ARTICLE}</p></article>") == ARTICLE


def test_names_that_hold_a_word_of_parts_aside():
    about = "".join(f"<{t} class={c}>about {c}</{t}>" for t, c in (("p", "share-price"), ("div", "form-factor"), ("section", "related-work"), ("td", "sideEffects")))
    lines = "\n".join(f"about {c}" for c in ("share-price", "form-factor", "related-work", "sideEffects"))
    parts = "".join(
        f"<div class='{c}'>no</div>"
        for c in ("related", "related-posts", "share-buttons", "ad-300x250", "newsletter-teaser", "cookieNotice", "x ads", "social_links", "comment-on", "promo")
    )
    links = "<div class=related-reading><a href=x>One story</a>, <a href=y>another story</a></div>"
    assert text(f"<article><p>{ARTICLE}</p>{about}{parts}{links}</article>") == f"{ARTICLE}\n{lines}"
    assert text(f"<div class=k><p>{ARTICLE}</p><p class=share-price>It rose.</p><div class=share-bar>no</div></div>") == f"{ARTICLE}\nIt rose."
    assert text(f"<article><p data-id=comments data-class='ad'>{ARTICLE}</p></article>") == ARTICLE


def test_text_that_is_not_shown():
    cases = {
        "<article><p>a</p><template><p>no</p></template><p>b</p></article>": "a\nb",
        "<article><p>a</p><p hidden>no</p><div style='color:red; DISPLAY : none'><p>no</p></div><p>b</p></article>": "a\nb",
        "<article><p>a <span hidden>no <b>no</b></span>b <b style=display:none>no</b>c</p></article>": "a b c",
        "<article><p class=hidden title='hidden'>a</p><p data-hidden>b</p></article>": "a\nb",
        "<p>a<script><!-- <script>no</script> <p>no</p> --></script>b</p>": "ab",
        "<p>a<script><!--<script>no</script> <p>no</p></script>b</p>": "ab",
        "<p>a<script>x = '<!-->' </script>b</p>": "ab",
        "<p>a<script><!-- no </script>b</p>": "ab",
        "<p>a<script><!-- <script> no </script>b</p>": "ab",
        "<p>a<script><!-- --> <script> no </script>b</p>": "ab",
    }
    assert {k: text(k) for k in cases} == cases


def test_all_articles_side_by_side_without_a_host():
    page = f"<nav>no</nav><article><p>{ARTICLE}</p></article><article><p>The second one.</p></article><footer>no</footer>"
    assert text(page) == text(page, "article") == f"{ARTICLE}\nThe second one."


def test_long_lists_of_attributes_take_linear_time():
    assert text("<p " + "a=1 " * 300_000 + ">x") == "x"
    assert text("<p " + "a" * 600_000 + " =>x") == "x"
    assert text("<script>" + "<!-- <script> " * 100_000 + "</script>x") == "x"
