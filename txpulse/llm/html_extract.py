"""Main text of web pages by a maximum-scoring subsequence of words and tags."""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: About so many pages that mark their article are learned from.
LABELLED_PAGES = 20_000
#: Least gain of a word, least and greatest cost of a tag.
LEAST, MOST = 0.05, 12.0
#: Cost of a tag within a sentence, such as a link, no more than a word gains: menus pay for their items and lists.
MOST_INLINE = LEAST

# fixed values of the HTML standard
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "noembed", "noframes", "xmp"}
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "div", "dl",
    "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header",
    "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody",
    "tfoot", "thead", "tr", "ul",
}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "del", "dfn", "em", "font", "i", "img",
    "ins", "kbd", "mark", "q", "ruby", "s", "samp", "small", "span", "strong", "sub", "sup", "time", "tt", "u", "var",
    "wbr",
}
#: Elements that end an open paragraph or item of the same kind.
ENDS_SAME = {"p", "li", "dt", "dd", "tr", "td", "th", "option"}
#: Elements that hold what is not the article.
ASIDE = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "button", "select", "option", "label", "fieldset", "head"}
#: Class, id or role names made of such words alone, or with QUALIFIERS, name it too, unless labelled pages show otherwise.
ASIDE_WORDS = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "sponsor", "sponsored", "promo",
    "promotion", "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "header", "masthead", "footer",
    "sidebar", "widget", "aside", "complementary", "contentinfo", "search", "cookie", "cookies", "consent", "gdpr",
    "notice", "alert", "popup", "modal", "overlay", "newsletter", "subscribe", "signup", "login", "share", "sharing",
    "social", "related", "recommended", "comment", "comments", "commentlist", "respond", "reply", "replies", "disqus",
    "copyright", "pagination", "pager", "toolbar", "skip",
}
QUALIFIERS = {
    "site", "global", "top", "bottom", "left", "right", "primary", "secondary", "box", "bar", "area", "block", "list",
    "links", "section", "container", "wrapper", "inner",
}
#: Elements that a name is worth before any was seen, and the share of them within articles that clears it.
PRIOR, CLEARED = 20, 0.2
#: Of these and of named elements one is no aside if it holds most words and all asides leave less than this share.
ROUND_ALL, LEAST_LEFT = {"form", "fieldset", "header"}, 0.1

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    # quotes count after = only, and no part is tried twice
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"'=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+|[\"'])*+)>"
    r"|</?[a-zA-Z][^>]*\Z",  # a tag that never ends
    re.S,
)
MARKS = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)


def names_of(attributes: str) -> list[str]:
    """Class, id and role names of an element, in lower case."""
    return [n for m in MARKS.finditer(attributes) for n in (m[2] or m[3] or m[4] or "").lower().split()] if attributes else []


def is_aside(name: str, attributes: str, weights: dict[str, float], in_article: bool) -> bool:
    """Whether an element's tag or names say that it is beside the article; ``weights`` of ".name" under 0 clear a name."""
    if name in ("html", "body", "article", "main"):
        return False
    if name in ASIDE:
        return not (name == "header" and in_article)  # an article's own header
    for n in names_of(attributes):
        parts = [p for p in re.split(r"[^a-z0-9]+", n) if p]
        if not ASIDE_WORDS.isdisjoint(parts) and all(p in ASIDE_WORDS or p in QUALIFIERS for p in parts):
            if weights.get("." + n, 1.0) > 0:
                return True
    return False


def tokens(page: str, weights: dict[str, float] | None = None):
    """(name, text, in_article, beside, names) in page order; name of a tag with text "", or "" with text.

    Text of scripts, styles, titles and the like is left out with its element.
    """
    weights = weights or {}
    found: list[list] = []
    stack: list[tuple[str, bool, int]] = []  # name, is an article, its number among the asides
    opened: Counter[str] = Counter()
    asides: list[list] = []  # first token within, first one after, may stand round the page
    articles = at = 0

    def close(name: str) -> None:
        nonlocal articles
        if not opened[name]:
            return
        while True:
            top, article, aside = stack.pop()
            opened[top] -= 1
            articles -= article
            if aside >= 0:
                asides[aside][1] = len(found)
            if top == name:
                return

    def put(name: str, text: str = "", names: list[str] | tuple = ()) -> None:
        found.append([name, text, articles > 0, False, names])

    while True:
        m = TOKEN.search(page, at)
        text = page[at : m.start()] if m else page[at:]
        if text:
            put("", " " if text.isspace() else text)
        if not m:
            break
        at = m.end()
        if not m[2]:
            continue
        name = m[2].lower()
        if m[1]:
            close(name)
            put(name)
            continue
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
            if not m[3].rstrip().endswith("/") or name not in ("svg", "iframe", "template"):
                at = end.end() if end else len(page)
            put(name)
            continue
        if name in ENDS_SAME and any(s[0] == name for s in stack[-2:]):
            close(name)
        elif name in BLOCK and stack and any(s[0] == "p" for s in stack[-3:]):
            close("p")
        if name not in VOID and not m[3].rstrip().endswith("/"):
            article, aside = name in ("article", "main"), -1
            if is_aside(name, m[3], weights, articles > 0):
                aside = len(asides)
                asides.append([len(found), -1, name in ROUND_ALL or name not in ASIDE])
            stack.append((name, article, aside))
            opened[name] += 1
            articles += article
        put(name, "", names_of(m[3]))
    _mark_asides(found, [(a, b if b >= 0 else len(found), wide) for a, b, wide in asides])
    return found


def _mark_asides(found: list[list], asides: list[tuple[int, int, bool]]) -> None:
    """Marks what lies in an aside; one that holds the page, such as a form round it all, is none."""
    upto = list(accumulate((0 if t[0] else len(t[1].split()) for t in found), initial=0))

    def covered(spans: list[tuple[int, int, bool]]) -> list[bool]:
        depth = [0] * (len(found) + 1)
        for a, b, _ in spans:
            depth[a] += 1
            depth[b] -= 1
        return [d > 0 for d in accumulate(depth[:-1])]

    beside = covered(asides)
    left = sum(n - p for p, n, out in zip(upto, upto[1:], beside, strict=False) if not out)
    if left < LEAST_LEFT * upto[-1]:
        beside = covered([(a, b, wide) for a, b, wide in asides if not wide or 2 * (upto[b] - upto[a]) <= upto[-1]])
    for t, out in zip(found, beside, strict=True):
        t[3] = out


def _count(batches):
    """Words and tags inside and outside the marked article, by tag name ("" for words); elements by ".name"."""
    for batch in batches:
        inside: dict[str, list[int]] = {}
        for page in batch.column(0).to_pylist():
            for name, text, article, beside, names in tokens(page):
                n = inside.setdefault(name[:32], [0, 0])
                n[0 if article and not beside else 1] += 1 if name else len(text.split())
                for x in names:
                    inside.setdefault(f".{x[:64]}", [0, 0])[0 if article else 1] += 1
        yield pa.RecordBatch.from_pydict(
            {"name": pa.array(inside.keys(), pa.string()), "inside": pa.array([n[0] for n in inside.values()], pa.int64()),
             "outside": pa.array([n[1] for n in inside.values()], pa.int64())}
        )


def learn_weights(pages: DataFrame, html_col: str = "html", id_col: str = "page_id", rows: int = LABELLED_PAGES) -> dict[str, float]:
    """Gain of a word (name "") and cost of each tag, from pages that mark their article.

    The log of how much more often than outside it occurs inside the article;
    words gain LEAST at least, tags cost between LEAST and MOST. A ".name"
    weighs below 0 if a share over CLEARED of its elements, PRIOR more of them
    taken to stand outside, is within articles.
    """
    marked = pages.where(F.col(html_col).rlike("(?i)<(article|main)[ >]")).select(id_col, html_col)
    share = min(1.0, rows / max(1, pages.select(id_col).count()))
    chosen = marked.where(F.pmod(F.xxhash64(F.lit("fit"), id_col), F.lit(1_000_000)) < share * 1_000_000)
    counts = chosen.select(html_col).mapInArrow(_count, "name string, inside long, outside long")
    # names of the sampled pages only, so their number is bounded like the sample
    counts = counts.groupBy("name").agg(F.sum("inside").alias("i"), F.sum("outside").alias("o")).collect()
    tags = [r for r in counts if not r["name"].startswith(".")]
    total_in, total_out = sum(r["i"] for r in tags) + 1, sum(r["o"] for r in tags) + 1
    weights = {r["name"]: CLEARED - r["i"] / (r["i"] + r["o"] + PRIOR) for r in counts if r["name"].startswith(".")}
    for r in tags:
        odds = math.log((r["i"] + 1) / total_in) - math.log((r["o"] + 1) / total_out)
        most = MOST_INLINE if r["name"] in INLINE else MOST
        weights[r["name"]] = max(LEAST, odds) if not r["name"] else -min(most, max(LEAST, -odds))
    return {"": 1.0} | weights


def scores(found: list[list], weights: dict[str, float], unseen: float = -1.0) -> list[float]:
    """What each word run gains and each tag costs.

    Words gain the same wherever they are, since a marked article may be a teaser
    card and the main text stand elsewhere; tags inside a marked article cost
    least, those of an advert or list beside its text too. Text beside the
    article (menus, notices, adverts, forms, comments and so on) gains nothing.
    """
    word, out = weights.get("", 1.0), []
    for name, text, article, beside, _ in found:
        if name:
            out.append(-LEAST / 10 if article else weights.get(name[:32], -MOST_INLINE if name in INLINE else unseen))
        else:
            out.append(0.0 if beside else word * len(text.split()))
    return out


def best_region(gains: list[float]) -> tuple[int, int]:
    """The contiguous part with the greatest sum, in one pass."""
    best, best_at, total, start = 0.0, (0, 0), 0.0, 0
    for i, gain in enumerate(gains):
        total += gain
        if total <= 0:
            total, start = 0.0, i + 1
        elif total > best - 1e-9:  # a word may just make up for its tag
            best, best_at = total, (start, i + 1)
    return best_at


def main_text(page: str | None, weights: dict[str, float], unseen: float = -1.0) -> str:
    """The blocks of the best contiguous region of words and tags, without what is beside the article, joined by an empty line."""
    if not page:
        return ""
    found = tokens(page, weights)
    first, end = best_region(scores(found, weights, unseen))
    blocks, block = [], []
    for name, text, _, beside, _ in found[first:end]:
        if name in BLOCK:
            blocks.append("".join(block))
            block = []
        elif name in ("br", "td", "th"):
            block.append(" ")
        elif not name and not beside:
            block.append(text)
    blocks.append("".join(block))
    clean = (" ".join(html.unescape(b).split()) for b in blocks)
    return "\n\n".join(b for b in clean if b)


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text, n_chars), one row per page, from the whole html.

    The weights come from about LABELLED_PAGES pages that mark their article.
    Null or empty html, and a page with no words but those beside an article, give an empty text.
    Very long pages are read whole, in time and memory in proportion to their length.
    Repeated rows give repeated rows; other columns are not read; an empty
    table gives no rows.
    """
    weights = learn_weights(pages, html_col, id_col)

    @F.pandas_udf("string")
    def extract(column):
        return column.map(lambda page: main_text(page, weights), na_action="ignore").fillna("")

    return (
        pages.select(F.col(id_col), F.col(url_col), extract(F.col(html_col)).alias("text"))
        .withColumn("n_chars", F.length("text").cast("long"))
    )
