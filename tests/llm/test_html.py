"""Main text of pages."""

import html as entities
import re

from cellflow.llm.html import blocks_of, extract_text, importance, main_text
from cellflow.llm.queries import LLM_QUERIES

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a = "<p>no</p>";</script></head><body>
<header class="top">Site</header><nav><ul><li><a href="/a">menu</a></li></ul></nav><!-- <p>hidden</p> -->
<div class="ad">buy</div><article><header><h1>Head &amp; line</h1></header><p>One <b>bo</b>ld&nbsp;word<br>next<p>two
 lines <a title="a>b">link</a></p><ul><li>x<li>y</ul><table><tr><td>c1<td>c2</table><div class="comments">first!</div>
<form>mail <input></form><aside>side</aside></article><div id="cookie-notice">cookies</div><footer>&copy; me</footer></body></html>"""


def test_one_page():
    assert main_text(PAGE, frozenset()) == "Head & line One bold word next two lines link x y c1 c2"


def test_odd_markup():
    assert main_text("", frozenset()) == "" and main_text("plain &lt;b&gt; text", frozenset()) == "plain <b> text"
    assert main_text("<p>a<p>b</b></i>c<p", frozenset()) == "a bc"
    assert main_text("<div>1 < 2 and 3 > 2 &am &amp &#233;&#xe9;</div>", frozenset()) == "1 < 2 and 3 > 2 &am & éé"
    assert main_text("<p>x<!-- open", frozenset()) == "x" and main_text("<script>never closed <p>y", frozenset()) == ""
    assert main_text("<article><p>a<b>b<br><p>c</article><p>d", frozenset()) == "ab c"
    assert main_text("<p>" * 3000 + "deep" + "<div>" * 3000 + "er", frozenset()) == "deep er"
    assert main_text("t<a x='" * 2000, frozenset()).startswith("t")
    assert len(blocks_of("<p>w</p>" * 5000)) == 5000


def pages(spark, rows, extra=()):
    return spark.createDataFrame([(*r, *["x"] * len(extra)) for r in rows], "page_id bigint, url string, html string" + "".join(f", {e} string" for e in extra))


def test_style_tree_removes_what_a_site_repeats(spark):
    def page(i):
        return f"<body><div class=slogan>The best site of all</div><div class=post><p>story {i} of its own</p></div><div class=legal>All rights stay here</div></body>"

    rows = [(i, f"https://one.example/{i}", page(i)) for i in range(12)] + [(50, "https://two.example/", page(50))]
    rows += [(60 + i, "http://three.example/x", "<main><p>the same story</p></main>") for i in range(9)]
    got = {r.page_id: r.text for r in extract_text(pages(spark, rows, ["id", "host", "path", "_low"])).collect()}
    assert all(got[i] == f"story {i} of its own" for i in range(12))
    assert got[50] == "The best site of all story 50 of its own All rights stay here"
    assert all(got[60 + i] == "the same story" for i in range(9))
    low = {r.path: r.importance for r in importance(pages(spark, rows), "url", "html").where("host = 'one.example'").collect()}
    assert low["/body/div.slogan"] == 0 and low["/body/div.post"] > 0.85


def test_story_stays_beside_any_number_of_repeated_blocks(spark):
    def page(n, story):
        return f"<body><div class=post><p>{story}</p></div>" + "".join(f"<div class=block-{'abcdefghij'[k]}>said on every page, {k}</div>" for k in range(n)) + "</body>"

    rows = [(100 * n + i, f"https://n{n}.example/{i}", page(n, f"story {i} of its own")) for n in range(3, 11) for i in range(12)]
    rows += [(5000 + i, f"https://copies.example/{i}", page(3, f"story {min(i, 8)} of its own")) for i in range(200)]
    got = {r.page_id: r.text for r in extract_text(pages(spark, rows)).collect()}
    assert all(got[100 * n + i] == f"story {i} of its own" for n in range(3, 11) for i in range(12))
    assert all(got[5000 + i] == f"story {min(i, 8)} of its own" for i in range(200))


def test_tree_judges_inside_and_beside_articles(spark):
    def inside(i):
        return f"<body><main><div class=tagline>the same words everywhere</div><p>story {i} of its own</p><div class=legal>all rights stay here</div></main></body>"

    def teaser(i):
        return f"<body><article><p>teaser {i}</p></article><div class=post><p>{f'the long story {i} of its own ' * 5}</p></div><div class=legal>all rights stay here</div></body>"

    def two(i):
        return f"<body><article><p>{f'first part {i} ' * 5}</p></article><div class=more><p>second part {i}</p></div><div class=legal>all rights</div></body>"

    rows = [(100 * k + i, f"https://h{k}.example/{i}", f(i)) for k, f in enumerate((inside, teaser, two)) for i in range(12)]
    rows += [(300, "https://alone.example", teaser(0))]
    got = {r.page_id: r.text for r in extract_text(pages(spark, rows)).collect()}
    for i in range(12):
        assert got[i] == f"story {i} of its own"
        assert got[100 + i] == f"teaser {i} " + " ".join([f"the long story {i} of its own"] * 5)
        assert got[200 + i] == " ".join([f"first part {i}"] * 5) + f" second part {i}"
    assert "the long story 0 of its own" in got[300]


def test_class_words_do_not_empty_a_page():
    story = "<p>the story of this page</p>"
    for page in (f"<body class='single no-sidebar'>{story}", f"<body class=widget>{story}", f"<div class='content-with-sidebar'>{story}</div>",
                 f"<article class='post comments-open'>{story}</article>", f"<div id='page-widget-area-main'>{story}</div>",
                 f"<main class='has-header'>{story}</main>", f"<div class=widget><main>{story}</main></div>",
                 f"<div class='promo'>{story}</div><div class=ad>buy</div>", f"<div class=social><div class=share><article>{story}</article></div></div>"):
        assert main_text(page, frozenset()) == "the story of this page", page
    comments = f"<article>{story}</article><div id=comments><article class=comment>{'first! ' * 50}</article></div><p class='cookie-notice'>cookies</p>"
    assert main_text(comments, frozenset()) == "the story of this page"


def test_numbers_of_pages_are_not_part_of_an_element(spark):
    def page(i):
        return f"<body class='postid-{i}'><div id='post-{i}'><div class=slogan>the same words</div><p>story {i} of its own</p></div></body>"

    rows = [(i, f"https://one.example/{i}", page(1700 + i)) for i in range(12)]
    got = {r.page_id: r.text for r in extract_text(pages(spark, rows)).collect()}
    assert all(got[i] == f"story {1700 + i} of its own" for i in range(12))


def test_cases(spark):
    rows = [(1, None, None), (1, None, None), (None, "x", ""), (2, "https://a.b", "<article>" + "long " * 50_000 + "</article>")]
    got = sorted((str(r.page_id), r.n_chars) for r in extract_text(pages(spark, rows)).collect())
    assert got == [("1", 0), ("1", 0), ("2", 249_999), ("None", 0)]
    assert extract_text(pages(spark, rows).limit(0)).count() == 0


def test_query(spark, sf):
    table = {r.page_id: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    rows = LLM_QUERIES["op7_main_text"](spark, sf).collect()
    assert len(rows) == len(table)
    for r in rows:
        inner = re.search(r"<article>(.*?)</article>", table[r.page_id].html, re.S)[1]
        want = " ".join(entities.unescape(re.sub(r"</?(?:p|h1|br)>", " ", inner).replace("<b>", "")).split())
        assert r.text == want and r.n_chars == len(want) and r.url == table[r.page_id].url
