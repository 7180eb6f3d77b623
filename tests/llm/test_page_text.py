"""Main text of pages: the scan against all stretches, exact texts of pages of many shapes."""

import html
import random
import re

import pytest

from chalkline.llm import page_text

SF = "/root/testdata/sf0.01"
SCHEMA = "page_id long, url string, html string, _main string, x0 int, text string"


def article(source):
    """The marked article of a generated page, by a plain reading."""
    body = re.search(r"<article>(.*?)</article>", source, re.S)[1].replace("<br>", " ")
    blocks = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>", "", body))
    return "\n".join(x for x in (" ".join(html.unescape(b).split()) for b in blocks) if x)


@pytest.fixture(scope="module")
def pages(spark):
    return spark.read.parquet(f"{SF}/pages.parquet")


@pytest.fixture(scope="module")
def weights(pages):
    return page_text.learn(pages)


def test_scan_finds_the_greatest_sum():
    rng = random.Random(1)
    for _ in range(300):
        s = [rng.randrange(-5, 6) for _ in range(rng.randrange(0, 14))]
        best = max([(sum(s[i:j]), -j, i) for i in range(len(s)) for j in range(i + 1, len(s) + 1)], default=(0, 0, 0))
        assert page_text.scan(s) == ((best[2], -best[1]) if best[0] > 0 else (0, 0))


def test_words_score_positive_and_tags_negative(weights):
    assert all(v > 0 for p, v in weights.items() if not p.startswith("<"))
    assert all(v < 0 for p, v in weights.items() if p.startswith("<"))
    assert weights["text"] > weights["link"] and weights["<boilerplate nav>"] < weights["<p>"]


def test_query_returns_the_articles(spark, pages):
    want = {r["page_id"]: (r["url"], article(r["html"])) for r in pages.collect()}
    got = page_text.op12_page_text(spark, SF).collect()
    assert {r["page_id"]: (r["url"], r["text"]) for r in got} == want
    assert all(r["n_chars"] == len(r["text"]) for r in got) and len(got) == pages.count()


def test_pages_without_a_mark(pages, weights):
    for r in pages.collect():
        bare = r["html"].replace("<article>", "<div>").replace("</article>", "</div>")
        assert page_text.main_text(bare, weights) == article(r["html"])


SHAPES = {
    "no mark, unclosed elements": (
        """<body class="no-sidebar"><div class="header">Welcome to the site</div><ul class="mainMenu"><li><a>Home</a><li><a>News</a></ul>
        <div class="cookie-notice">We use cookies.</div><div id="wrap"><div class="sidebar"><p>Many words at the side of it</div>
        <div id="content"><h1>Big  title</h1><p>First &amp; more&nbsp;text<br>next<p>A <a href='x>y'>link</a>ed one.
        <div class="ad"><p>Buy now please</p></div><table><tr><td>A<td>B</table><form><input><label>Name</label></form>
        <p>Last.</div></div><section id="comments"><p>Bob says nice things about all this</p></section><footer>&copy; x</footer>
        <script>var a = "<p>no</p>" """, "Big title\nFirst & more text next\nA linked one.\nA\nB\nLast."),
    "aside in the article": (
        "<article><header><h1>T</h1></header><aside>no no no</aside><p>yes</p><ul><li><a>only</a></li></ul></article><div>junk words</div>",
        "T\nyes\nonly"),
    "article in main": ("<main><article><p>The text is here</p></article><p>More</p></main><p>Other</p>", "The text is here"),
    "cards in main": ("<main><p>A long text of many words here</p><article>Card</article></main>", "A long text of many words here\nCard"),
    "comments as articles": ("<article><p>Real words</p><section class='comment-list'><article>Reply</article></section></article>", "Real words"),
    "hidden": ("<p>Seen words</p><p hidden>no</p><p style='display: none'>no</p><p aria-hidden=true>no</p>", "Seen words"),
    "comment, doctype, cdata": ("<!DOCTYPE html><!-- <p>no</p> --><?x y?><p>yes<![CDATA[z]]></p>", "yes"),
    "stray signs": ("a < b <3 &lt;c&gt; &#x41; &unknown; &amp", "a < b <3 <c> A &unknown; &"),
    "unclosed quote": ("<p title=\"x>one</p><p>two</p>", "one\ntwo"),
    "unclosed comment": ("<p>one</p><!-- two", "one"),
    "inline": ("<p>a<b>b</b>c <i>d</i></p>", "abc d"),
    "empty": ("", ""), "tags only": ("<p></p><div></div>", ""), "white space": (" \n\t ", ""),
}


@pytest.mark.parametrize("name", SHAPES)
def test_shapes(name, weights):
    source, want = SHAPES[name]
    assert page_text.main_text(source, weights) == want


def test_odd_rows(spark, weights):
    long_page = "<nav><a>m</a></nav><article>" + "".join(f"<p>word {i}</p>" for i in range(20_000)) + "</article>"
    deep = "<div>" * 5_000 + "deep words" + "</div>" * 5_000
    rows = [(1, None, None), (None, "u", ""), (2, "u", long_page), (3, "u", deep), (4, "v", "<p>twice</p>"), (4, "v", "<p>twice</p>")]
    df = spark.createDataFrame([(*r, "m", 7, "t") for r in rows], SCHEMA).repartition(3)
    out = page_text.extract(df, weights=weights)
    assert out.columns == [*df.columns, "__main"]
    got = sorted((r["page_id"] or 0, r["html"] or "", r["__main"]["text"], r["__main"]["n_chars"]) for r in out.collect())
    assert [g[2] for g in got if g[0] == 4] == ["twice", "twice"] and [g[2:] for g in got if not g[1]] == [("", 0), ("", 0)]
    texts = {g[0]: g[2] for g in got}
    assert texts[2] == "\n".join(f"word {i}" for i in range(20_000)) and texts[3] == "deep words"


def test_empty_table_and_no_labels(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert page_text.extract(none).count() == 0
    assert page_text.main_text("<p>some words</p>", page_text.scores({})) == "some words"
