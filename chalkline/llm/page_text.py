"""Main text of web pages: the maximum-scoring subsequence of words and tags.

A page is a sequence of words and tags.  Words score positive and tags negative, and one
linear scan finds the contiguous stretch with the greatest sum, the content region.

The scores are learned from labelled pages: pages that mark their article themselves (an
``article`` or ``main`` element).  Over all of them, words and tags are counted inside and
outside the marked article by the place they stand in, and a place's score is the logarithm
of its likelihood ratio, kept positive for words and negative for tags.  Places are

* boilerplate: menus, headers, footers, sidebars, notices, adverts, forms, comments, scripts
  and styles, known by element, role or the words of class and id;
* inside and outside, on pages that mark an article;
* plain text and link text, on pages that mark none.  Their scores come from the labelled
  pages as well, read as if their mark were not there.

So the boundaries of pages without a mark are found by what words and tags are worth on the
pages with one.  Counts are sums over the whole table with partial aggregation, one row per
place and element name of a fixed list.  Extraction is a pass over the pages without a shuffle.

The text of the region leaves out boilerplate and what is outside the mark.  Character
references are decoded; white space (any Unicode white space, line breaks included) inside a
block becomes one space; blocks are joined by a newline.  A line-break element is white space.

Defined results: null html is empty, an empty page or one without words has empty text; a
page of any length is read whole in time linear in it; repeated rows each have their result;
an empty table gives an empty table.  A table without labelled pages falls back to the prior
counts.  Extra columns stay as they are: the result is one struct column under a name that
the input does not use (``free_name``).  Of equal sums the stretch that ends first, and of
those the shortest, is taken.
"""

from __future__ import annotations

import html as _html
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_value, free_name

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
    figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre
    search section select summary table tbody td tfoot th thead tr ul""".split())
INLINE = frozenset("""a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small
    span strike strong sub sup time tt u var wbr""".split())
#: Opening one of these ends an open one of the same group, up to the container named.
SIBLINGS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
            "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
            "option": ({"option"}, {"select"})}
# What is no main text, by element, by role, and by the words of class and id.
NO_TEXT = frozenset("""head nav footer aside form script style noscript template object svg math canvas audio video button
    select textarea menu dialog search iframe""".split())
NO_TEXT_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
NO_TEXT_WORDS = frozenset("""ad ads adv advert adverts advertisement advertisements advertising adbox adslot adsense sponsor
    sponsored promo promos promotion promoted banner cookie cookies consent gdpr notice notices notification popup modal
    overlay newsletter subscribe subscription signup login paywall sidebar widget widgets menu nav navbar navigation
    breadcrumb breadcrumbs header masthead topbar footer copyright comment comments commentlist disqus respond reply replies
    discussion related recommended recommendations share sharing social pagination pager toolbar search searchform form
    """.split())
#: A class such as no-sidebar tells of the page, and post-header is part of the article.
ABOUT_PAGE = frozenset("no not has have with without".split())
OF_ARTICLE = frozenset("article post entry story content section title".split())
MARK_WORDS = frozenset("article articlebody post entry story content main".split())

ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>""")
LOOSE_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

#: Greatest and least size of a score, and prior counts, in a place never seen.
WORD_MOST, TAG_MOST, LEAST, PRIOR = 4.0, 2.0, 0.05, 0.5
UNIT = 1000                 # scores are integers, so sums are exact

ARTICLE, MAIN, NAMED = 1, 2, 4


# ---- inside tasks ----

def attributes(text: str) -> dict:
    return {k.lower(): v.strip("\"'") for k, v in ATTRIBUTE.findall(text)}


def kind_of(name: str, attrs: dict, in_article: bool) -> tuple[bool, int]:
    """(is boilerplate, marks of an article) of an element."""
    if name in NO_TEXT or attrs.get("role", "").lower() in NO_TEXT_ROLES:
        return True, 0
    if "hidden" in attrs or attrs.get("aria-hidden") == "true" or "display:none" in attrs.get("style", "").replace(" ", ""):
        return True, 0
    if name == "header" and not in_article:
        return True, 0
    mark = (ARTICLE * (name == "article" or attrs.get("itemprop") == "articleBody")
            | MAIN * (name == "main" or attrs.get("role") == "main"))
    for label in f"{attrs.get('class', '')} {attrs.get('id', '')}".split():
        parts = re.split(r"[^a-z]+", CAMEL.sub("-", label).lower())
        if parts[0] in ABOUT_PAGE or name in ("html", "body", "main"):
            continue
        words = NO_TEXT_WORDS.intersection(parts)
        if words == {"header"} and (in_article or OF_ARTICLE.intersection(parts)):
            continue
        if words:
            return True, 0
        if MARK_WORDS.intersection(parts):
            mark |= NAMED
    return False, mark


class Page:
    """Words and tags of a page in order: ``items`` of (text or None, tag or None, is
    boilerplate, marks, in a link, block)."""

    def __init__(self, source: str):
        self.items, self.stack, self.open = [], [], Counter()
        self.boiler, self.marks, self.link, self.block = 0, 0, 0, 0
        self.read(source)

    def read(self, source: str) -> None:
        at, n = 0, len(source)
        while at < n:
            lt = source.find("<", at)
            if lt < 0:
                lt = n
            if lt > at:
                self.text(source[at:lt])
            if lt == n:
                return
            if source.startswith("<!--", lt):
                end = source.find("-->", lt + 4)
                at = n if end < 0 else end + 3
            elif source[lt + 1:lt + 2] in ("!", "?"):
                end = source.find(">", lt)
                at = n if end < 0 else end + 1
            else:
                m = TAG.match(source, lt) or LOOSE_TAG.match(source, lt)
                if not m:
                    self.text("<")
                    at = lt + 1
                    continue
                at, name = m.end(), m[2].lower()
                if m[1]:
                    self.close(name)
                else:
                    self.start(name, attributes(m[3]) if m[3] else {})
                    if name in RAW:         # up to its own end tag, or all that follows
                        end = re.compile(rf"</{name}[\s/>]", re.I).search(source, at)
                        at = end.start() if end else n

    def text(self, raw: str) -> None:
        said = _html.unescape(raw) if "&" in raw else raw
        self.items.append((said, None, self.boiler > 0, self.marks, self.link > 0, self.block))

    def tag(self, name: str) -> None:
        self.items.append((None, name, self.boiler > 0, self.marks, self.link > 0, self.block))

    def start(self, name: str, attrs: dict) -> None:
        if name in BLOCKS:
            self.end_paragraph()
            self.block += 1
        if name in SIBLINGS:
            self.end_sibling(*SIBLINGS[name])
        if name == "br":
            self.items.append((" ", None, self.boiler > 0, self.marks, self.link > 0, self.block))
        if name not in VOID:
            boiler, marks = kind_of(name, attrs, bool(self.marks & (ARTICLE | MAIN)))
            self.stack.append((name, self.boiler, self.marks, self.link))
            self.open[name] += 1
            self.boiler += boiler
            if not self.boiler:
                self.marks |= marks
            self.link += name == "a"
        self.tag(name)

    def pop(self) -> str:
        name, self.boiler, self.marks, self.link = self.stack.pop()
        self.open[name] -= 1
        return name

    def end_paragraph(self) -> None:
        if self.open["p"]:
            for i in range(len(self.stack) - 1, -1, -1):
                if self.stack[i][0] == "p":
                    while len(self.stack) > i:
                        self.pop()
                    return
                if self.stack[i][0] in BLOCKS:
                    return

    def end_sibling(self, same: set, within: set) -> None:
        if any(self.open[x] for x in same):
            for i in range(len(self.stack) - 1, -1, -1):
                if self.stack[i][0] in same:
                    while len(self.stack) > i:
                        self.pop()
                    return
                if self.stack[i][0] in within:
                    return

    def close(self, name: str) -> None:
        self.tag(name)
        if name in BLOCKS:
            self.block += 1
        if not self.open[name]:
            return
        if name not in BLOCKS:              # an inline end tag does not end blocks opened since
            for i in range(len(self.stack) - 1, -1, -1):
                if self.stack[i][0] == name:
                    break
                if self.stack[i][0] in BLOCKS:
                    self.link -= name == "a" and self.link > 0
                    return
        while self.pop() != name:
            pass

    def marked(self, kinds=(ARTICLE, MAIN, NAMED)) -> int:
        """The kind of mark that holds the article: the first that has at least half of the
        words that the page has besides boilerplate (or, for elements, of all marked ones)."""
        words = Counter()
        for said, _, boiler, marks, _, _ in self.items:
            if said is not None and not boiler:
                n = len(said.split())
                words["all"] += n
                words["marked"] += n if marks & (ARTICLE | MAIN) else 0
                for kind in kinds:
                    words[kind] += n if marks & kind else 0
        for kind in kinds:
            whole = words["all"] if kind == NAMED else words["marked"]
            if words[kind] and 2 * words[kind] >= whole:
                return kind
        return 0

    def places(self, mark: int):
        """The place of every item: what its score is looked up by."""
        for said, tag, boiler, marks, link, _ in self.items:
            if tag is None:
                yield "boilerplate" if boiler else ("inside" if marks & mark else "outside") if mark else "link" if link else "text"
            else:
                name = tag if tag in BLOCKS or tag in INLINE or tag in NO_TEXT or tag in VOID or tag in RAW else "?"
                yield "<inside>" if marks & mark else f"<boilerplate {name}>" if boiler else f"<{name}>"


def count_places(source: str) -> Counter:
    """Words and tags of a labelled page by (place, is content); empty for other pages."""
    page, out = Page(source), Counter()
    mark = page.marked((ARTICLE, MAIN))
    if mark:
        for (said, tag, boiler, marks, _, _), shown, blind in zip(page.items, page.places(mark), page.places(0)):
            n = 1 if tag else len(said.split())
            inside = bool(marks & mark)
            content = inside and (tag is not None or not boiler)
            out[shown, content] += n
            if blind != shown:
                out[blind, content] += n
    return out


def scan(scores: list[int]) -> tuple[int, int]:
    """(start, end) of the contiguous stretch with the greatest sum; (0, 0) if none is positive."""
    best, found, total, start = 0, (0, 0), 0, 0
    for i, s in enumerate(scores):
        if total <= 0:
            total, start = 0, i
        total += s
        if total > best:
            best, found = total, (start, i + 1)
    return found


def main_text(source: str, weights: dict) -> str:
    page = Page(source)
    places = list(page.places(page.marked()))
    scores = []
    for (said, tag, *_), place in zip(page.items, places):
        if tag is None:
            scores.append(weights.get(place, weights["text"]) * len(said.split()))
        else:
            scores.append(weights.get(place, weights["<unseen boilerplate>" if place.startswith("<boilerplate") else "<unseen>"]))
    start, end = scan(scores)
    blocks, last = [], None
    for (said, tag, _, _, _, block), place in zip(page.items[start:end], places[start:end]):
        if tag is None and place in ("inside", "text", "link"):
            if block != last:
                blocks.append([])
                last = block
            blocks[-1].append(said)
    lines = (" ".join("".join(b).split()) for b in blocks)
    return "\n".join(x for x in lines if x)


# ---- Spark ----

def _count(column: str):
    def run(batches):
        for b in batches:
            total = Counter()
            for source in b.column(b.schema.get_field_index(column)).to_pylist():
                total.update(count_places(source or ""))
            yield pa.RecordBatch.from_pydict({
                "place": pa.array([p for p, _ in total], type=pa.string()),
                "content": pa.array([c for _, c in total], type=pa.bool_()),
                "n": pa.array(list(total.values()), type=pa.int64())})
    return run


def learn(pages: DataFrame, html: str = "html") -> dict[str, int]:
    """Scores by place, from all labelled pages.  What reaches the driver is one row per
    place, a fixed list."""
    counts = (pages.select(F.col(html).cast("string").alias("html")).mapInArrow(_count("html"), "place string, content boolean, n long")
              .groupBy("place").agg(F.sum(F.when(F.col("content"), F.col("n")).otherwise(0)).alias("content"),
                                    F.sum(F.when(F.col("content"), 0).otherwise(F.col("n"))).alias("other")))
    return scores({r["place"]: (r["content"], r["other"]) for r in counts.collect()})


def scores(counts: dict[str, tuple[int, int]]) -> dict[str, int]:
    """Log likelihood ratios of the places, positive for words and negative for tags."""
    seen = {**{p: (0, 0) for p in ("text", "link", "inside", "outside", "boilerplate", "<inside>", "<unseen>",
                                   "<unseen boilerplate>")}, **counts}
    for unseen, start in (("<unseen boilerplate>", "<boilerplate"), ("<unseen>", "<")):
        of = [v for p, v in counts.items() if p.startswith(start)]
        seen[unseen] = (sum(c for c, _ in of), sum(o for _, o in of))
    totals = {w: [sum(v[i] for p, v in counts.items() if p.startswith("<") != w) + 1 for i in (0, 1)] for w in (True, False)}
    out = {}
    for place, (content, other) in seen.items():
        word = not place.startswith("<")
        a, b = totals[word]
        ratio = math.log((content + PRIOR) / a) - math.log((other + PRIOR) / b)
        size = min(max(ratio if word else -ratio, LEAST), WORD_MOST if word else TAG_MOST)
        out[place] = round(UNIT * size) * (1 if word else -1)
    if not counts:
        out["text"] = out["inside"] = round(UNIT * WORD_MOST)
    return out


def _extract(column: str, out: str, weights: dict):
    def run(batches):
        for b in batches:
            texts = [main_text(x or "", weights) for x in b.column(b.schema.get_field_index(column)).to_pylist()]
            yield b.append_column(out, pa.array(texts, type=pa.string()))
    return run


def extract(pages: DataFrame, html: str = "html", weights: dict | None = None) -> DataFrame:
    """Every row of ``pages`` with ``_main``: struct(text, n_chars)."""
    weights = weights or learn(pages, html)
    names = [f"x{i}" for i in range(len(pages.columns))]
    rows = pages.toDF(*names)
    column = names[pages.columns.index(html)]
    schema = ", ".join([*[f"{n} {f.dataType.simpleString()}" for n, f in zip(names, pages.schema.fields)], "_text string"])
    done = rows.mapInArrow(_extract(column, "_text", weights), schema)
    return done.select(*[F.col(n).alias(c) for n, c in zip(names, pages.columns)],
                       F.struct(F.col("_text").alias("text"), F.char_length("_text").cast("long").alias("n_chars"))
                       .alias(free_name(pages, "_main")))


def op12_page_text(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return extract(pages).select("page_id", "url", "_main.text", "_main.n_chars")


by_value(__name__)
