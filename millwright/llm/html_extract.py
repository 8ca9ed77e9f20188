"""Main text of web pages: the maximum-scoring subsequence of words and tags.

A page is read as a sequence of words and tags. Words score by where they stand, tags score
negative; the contiguous run with the largest sum, found in one linear scan, is the content
region. What is clearly boilerplate counts nothing in an article, or in any element that holds
content both before and after it; elsewhere it ends a region. Words that score negative inside the region (a menu or an advert within an article) are
left out of its text.

The scores are learned from labelled pages: for each feature of the elements around a word
(tag, whether inside an article, words in class, id and role), in how many pages it holds content
and in how many it holds something else, as a smoothed log ratio. Counting pages instead of words
keeps one long page from deciding, a feature met in a single page counts nothing, and one that is
about as frequent on both sides is neutral. An element is clearly boilerplate if its features
together say so; part of a hyphenated class name counts half of what a whole name does. Form
controls and hidden elements are never content. ``LABELLED_PAGES`` are small pages made by a rule
from lists of class names; further ones can be given.

Every token costs the same, however deep it stands: an open element keeps the sum of the weights
down to it, whether boilerplate holds it, and its outermost element, whose content is before and
after whatever its inner ones' is.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import cache, lru_cache
from html import unescape
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from millwright.llm.common import map_batches

# Elements marked with this attribute are content, and what is not below one is not.
LABEL = "data-content"

# Names in class, id and role that stand for boilerplate, and for content or either.
BOILERPLATE_NAMES = (
    "ad ads advert advertisement ad-slot ad-banner ad-container ad-wrapper top-ad sponsored "
    "sponsored-content sponsor promo promo-box promotion banner banner-ad adsense "
    "nav navbar navigation main-nav site-nav nav-menu nav-bar top-nav menu main-menu menu-bar "
    "side-menu mobile-menu breadcrumb breadcrumbs pagination pager skip-link topbar masthead "
    "site-header page-header-bar logo search search-box search-form "
    "sidebar side-bar sidebar-left right-sidebar sidebar-widget page-sidebar widget widget-area "
    "footer site-footer page-footer footer-links footer-menu copyright contentinfo complementary "
    "comment comments comment-list comment-form comment-body comments-area user-comments "
    "reader-comments comment-thread comment-reply reply disqus "
    "cookie cookies cookie-banner cookie-notice cookie-consent cookie-bar cookie-popup consent gdpr "
    "notice disclaimer popup modal overlay lightbox toast "
    "share share-buttons social social-share social-links share-bar follow-us "
    "related related-posts related-articles related-links related-stories recommended "
    "recommendations more-stories trending most-read read-next "
    "newsletter newsletter-signup newsletter-form subscribe subscribe-box signup login paywall"
).split()
CONTENT_NAMES = (
    "content main-content page-content site-content post-content entry-content article-content "
    "article article-body article-text story story-body story-text body body-text text text-block "
    "post post-body post-text entry entry-text page site site-wrapper wrapper page-wrapper "
    "container main main-column row col column inner section section-text block paragraph title "
    "headline subtitle lead intro summary abstract quote caption figure-caption note side-note "
    "footnote footer-note header article-header post-header date story-date time author author-bio "
    "byline meta post-meta article-meta tags article-tags share-price social-issues related-work "
    "text-widget alert alert-text list item list-item menu-price table cell code link links image "
    "news-story search-result-text notice-text"
).split()

_LINKS = "".join(f'<li><a href="/{w}">{w}</a></li>' for w in "home news sport culture about".split())
_NOISE_WORDS = "read more here and there about some other things that we sell or show"
_SENTENCES = (
    '<p>One two three four <a href="/x">five six seven</a> eight <b>nine ten</b> eleven.</p>'
    "<p>Twelve <i>thirteen</i> <em>fourteen</em> <span>fifteen</span> <strong>sixteen</strong>.</p>"
    "<ul><li>first of <a href='/y'>the points</a> made</li><li>second of them</li></ul><h2>Part</h2>"
    "<h3>Of a part</h3><section><h4>Less</h4><p>Seventeen <small>eighteen</small>.</p></section>"
)
_RARER = (
    "<blockquote><p>What they said</p></blockquote><figure><figcaption>What is seen</figcaption>"
    "</figure><ol><li>a point made</li></ol><dl><dt>word</dt><dd>sense</dd></dl><table><tr><th>head"
    "</th><td>cell of it</td></tr></table><pre><code>code of it</code></pre><div>And more</div>"
)


def _noise(names: Iterable[str], wrap: str = "div") -> str:
    inner = f"<span>{_NOISE_WORDS}</span><p>{_NOISE_WORDS}</p><ul>{_LINKS}</ul>"
    return "".join(f'<{wrap} class="{n}"><section><h3>Also</h3><div>{inner}</div></section></{wrap}>' for n in names)


def _content(names: Iterable[str]) -> str:
    return "".join(f'<div class="{n}"><p class="{n}">Some words <span>of it</span></p></div>' for n in names)


def labelled_pages(per_page: int = 6, shift: int = 3) -> tuple[str, ...]:
    """Pages in which every name occurs twice, beside others each time, around an article.

    Articles stand in an article or main element, or in plain ones only; some hold boilerplate.
    """
    pages = []
    for offset in (0, shift):
        noisy = BOILERPLATE_NAMES[offset:] + BOILERPLATE_NAMES[:offset]
        plain = CONTENT_NAMES[offset:] + CONTENT_NAMES[:offset]
        size = -(-len(noisy) // per_page)
        for k in range(size):
            # Names that are alike stand in different pages.
            around, own = noisy[k::size], plain[k::size]
            text = _SENTENCES + (_RARER if k % 3 == 0 else "") + _content(own)
            menu = f"<nav><ul>{_LINKS}</ul></nav>" if k % 5 else f'<div role="navigation"><ul>{_LINKS}</ul></div>'
            side = f"<aside><h3>Also</h3><p>{_NOISE_WORDS}</p></aside>"
            form = f"<form><span>{_NOISE_WORDS}</span></form>"
            end = f"<footer><p>&copy; us <span>{_NOISE_WORDS}</span></p></footer>"
            top = f"<header><h1>Site</h1><div>name</div>{menu}</header>"
            title = "<header><h1>A title of words</h1></header>"
            if k % 4 == 0:
                article = f"<article data-content>{title}{text}</article>"
            elif k % 8 == 2:
                inner = f"<section data-content>{text}</section>"
                own_noise = f"{menu}{side}{_noise(around)}{form}{end}"
                article = f"<main><h1 data-content>A title</h1>{inner}{own_noise}</main>"
            else:
                article = f'<div><section><div data-content><h1>A title</h1>{text}</div></section></div>'
            head, tail = _noise(around[: per_page // 2]), _noise(around[per_page // 2 :], "section")
            pages.append(f"<html><body>{top}{menu}{head}{article}{side}{form}{tail}{end}</body></html>")
    # Little else than text.
    pages += [f"<html><body data-content><h1>A title</h1>{_SENTENCES * 2}{_RARER}</body></html>"] * 2
    return tuple(pages)


LABELLED_PAGES = labelled_pages()

# Fixed values of the markup language.
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_RAW = frozenset("script style textarea title noscript template iframe svg".split())
_CONTROLS = frozenset("button select label datalist input".split())
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav "
    "ol option p pre section select summary table tbody tfoot thead tr ul".split()
)
_SPACES = frozenset("br td th img".split())
_CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",), "option": ("option",)}
_PARTS_OF_PAGE = frozenset("article aside div footer form header main nav section table td".split())
_CONTAINERS = frozenset("article main".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?P<close>>|\Z)"
    r"|<[a-zA-Z/][^>]*(?:>|\Z)",
    re.S,
)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_PARTS = re.compile(r"[a-z]+")
_HIDDEN = re.compile(
    r"(?:^|[\s\"'])hidden(?=[\s=/\"']|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I
)

# An element that is this clearly not content decides for all that is in it.
_DECISIVE = -1.5
# Weights nearer to zero are none: a feature of either side.
_NEUTRAL = 0.7
_LEAST_PAGES = 2
_SMOOTHING = 0.5
_PASSED_TAG = -0.01
_CACHED = 16_384  # elements whose scores are kept


def names_of(attrs: str) -> str:
    """The names in class, id and role, wherever they stand among the attributes."""
    if not attrs:
        return ""
    names = " ".join("".join(found) for found in _NAMES.findall(attrs)).lower().split()
    return " ".join(["[hidden]", *names] if _HIDDEN.search(_NAMES.sub(" ", attrs)) else names)


def features(tag: str, names: str, inside: bool) -> dict[str, float]:
    """Features of an element for the words in it, and how much each one counts."""
    found = {f"{tag}@in" if inside else f"{tag}@out": 1.0}
    if tag in ("html", "body"):
        return found
    for name in names.split():
        found["." + "-".join(_PARTS.findall(name))] = 1.0
        parts = _PARTS.findall(name)
        if len(parts) > 1:
            for part in parts:
                found.setdefault(f"~{part.removesuffix('s')}", 0.5)
    return found


class Open(NamedTuple):
    """An open element, with what holds for all that is in it."""

    tag: str
    inside: bool  # in an article or main element
    labelled: bool
    features: frozenset[str]  # of itself and all around it; while learning only
    weight: float
    boilerplate: bool
    whole: bool  # no part of a page is open but the page itself
    outermost: int  # number of the outermost element in the page, or 0: the page
    block: int  # depth of the nearest block, itself included
    item: int  # depth of the nearest list item, row or list, itself included


_PAGE = Open("", False, False, frozenset(), 0.0, False, True, 0, -1, -1)


def tokens(html: str) -> Iterator[tuple[str, str, str]]:
    """``(kind, name or text, attributes)`` with kind ``start``, ``end`` or ``text``.

    What a cut-off page leaves open (a comment, a tag) is dropped.
    """
    at, n = 0, len(html)
    while at < n:
        found = _TOKEN.search(html, at)
        if not found:
            yield "text", html[at:], ""
            return
        if found.start() > at:
            yield "text", html[at : found.start()], ""
        at = found.end()
        tag = (found["tag"] or "").lower()
        if not tag or not found["close"]:
            continue
        if found["end"]:
            yield "end", tag, ""
            continue
        yield "start", tag, found["attrs"]
        if tag in _RAW:
            close = re.compile(rf"</{tag}\b[^>]*>", re.I).search(html, at)
            at = close.end() if close else n
            yield "end", tag, ""


_ITEMS = frozenset(_CLOSES)
_LISTS = frozenset(("ul", "ol", "dl", "table", "select", "menu"))


def walk(html: str, weights: Weights | None = None) -> Iterator[tuple[str, str, Open]]:
    """Tokens with the innermost open element at each; without weights, its features."""
    stack: list[Open] = [_PAGE]
    depths: dict[str, int] = {}  # open elements by tag
    number = 0

    def close(depth: int) -> None:
        for element in stack[depth:]:
            depths[element.tag] -= 1
        del stack[depth:]

    for kind, value, attrs in tokens(html):
        top = stack[-1]
        if kind == "start":
            if value in _BLOCKS and top.block > 0 and stack[top.block].tag == "p":
                close(top.block)
                top = stack[-1]
            if value in _CLOSES:
                at = top.item
                while at > 0 and stack[at].tag not in _LISTS and stack[at].tag not in _CLOSES[value]:
                    at = stack[at - 1].item
                if at > 0 and stack[at].tag in _CLOSES[value]:
                    close(at)
                    top = stack[-1]
            yield "tag", value, top
            if value not in _VOID:
                number += 1
                stack.append(_opened(value, attrs, top, len(stack), number, weights))
                depths[value] = depths.get(value, 0) + 1
        elif kind == "end":
            yield "tag", value, top
            if depths.get(value):
                depth = len(stack) - 1
                while stack[depth].tag != value:
                    depth -= 1
                close(depth)
        else:
            yield "text", value, top


def _opened(tag: str, attrs: str, top: Open, depth: int, number: int, weights: Weights | None) -> Open:
    inside = top.inside or tag in _CONTAINERS
    names = names_of(attrs)
    page = tag in ("html", "body")
    weight, boilerplate = 0.0, False
    own: frozenset[str] = frozenset()
    if weights is None:
        own = top.features | features(tag, names, inside).keys()
    else:
        weight, boilerplate = weights.element(tag, names, inside)
    return Open(
        tag,
        inside,
        top.labelled or LABEL in attrs,
        own,
        top.weight + weight,
        top.boilerplate or boilerplate,
        top.whole and (page or tag not in _PARTS_OF_PAGE),
        top.outermost or (0 if page else number),
        depth if tag in _BLOCKS else top.block,
        depth if tag in _ITEMS or tag in _LISTS else top.item,
    )


def _log_ratio(inside: float, outside: float, all_in: float, all_out: float) -> float:
    return math.log((inside + _SMOOTHING) / (all_in + 1)) - math.log(
        (outside + _SMOOTHING) / (all_out + 1)
    )


class Weights:
    """Scores of features and tags, learned from labelled pages."""

    def __init__(self, pages: Iterable[str]):
        held: tuple[Counter, Counter] = (Counter(), Counter())
        tags: tuple[Counter, Counter] = (Counter(), Counter())
        for page in pages:
            met: tuple[set[str], set[str]] = (set(), set())
            for kind, value, top in walk(page):
                if kind == "tag":
                    tags[top.labelled][value] += 1
                elif value.split():
                    met[top.labelled].update(top.features, {""})
            for side in (0, 1):
                held[side].update(met[side])
        totals = held[1][""], held[0][""]
        self.words = {}
        for f in held[0] | held[1]:
            weight = _log_ratio(held[1][f], held[0][f], *totals)
            if f and held[0][f] + held[1][f] >= _LEAST_PAGES and abs(weight) >= _NEUTRAL:
                self.words[f] = weight
        n_tags = sum(tags[1].values()), sum(tags[0].values())
        self.tags = {
            t: min(-0.1, max(-2.0, _log_ratio(tags[1][t], tags[0][t], *n_tags) - 1))
            for t in tags[0] | tags[1]
        }
        self.element = lru_cache(_CACHED)(self._element)

    def _element(self, tag: str, names: str, inside: bool) -> tuple[float, bool]:
        """Sum of the weights of an element's features, and whether it is clearly boilerplate.

        Unknown features count nothing. A tag that speaks for content does not outweigh its
        element's names, nor does one part of a name another one.
        """
        if tag in _RAW or tag in _CONTROLS or tag == "head" or names.startswith("[hidden]"):
            return -9.0, True
        weights = {f: share * self.words.get(f, 0.0) for f, share in features(tag, names, inside).items()}
        against = sum(w for f, w in weights.items() if w < 0 or f[0] == ".")
        return sum(weights.values()), against <= _DECISIVE

    def word(self, top: Open) -> float:
        """Score of a word within the open elements, between -1 and 1."""
        if top.boilerplate:
            # Within an article such words are passed over; elsewhere they end a region, unless
            # content goes on after them (``main_text``).
            return 0.0 if top.inside else -1.0
        return max(-1.0, min(1.0, top.weight + 0.5))

    def tag(self, name: str, top: Open) -> float:
        """Score of a tag; within content, where even a single word stands apart, next to none."""
        if top.inside or (not top.boilerplate and top.weight > 0):
            return _PASSED_TAG
        return self.tags.get(name, -0.5)


@cache
def default_weights() -> Weights:
    return Weights(LABELLED_PAGES)


def best_run(scores: list[float]) -> tuple[int, int]:
    """Start and end of the contiguous run with the largest positive sum; the first of equals."""
    best, best_run, total, start = 0.0, (0, 0), 0.0, 0
    for i, score in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += score
        if total > best:
            best, best_run = total, (start, i + 1)
    return best_run


def main_text(html: str, weights: Weights | None = None) -> str:
    """The text of the content region; blocks are joined by line breaks."""
    weights = weights or default_weights()
    scores: list[float] = []
    items: list[str | None] = []  # text, "" for a space, None for the end of a block
    # Where positive words stand first and last in each outermost element, and, under 0, in the
    # page: those in articles, or in no part of the page. An inner element's lie within these.
    content: dict[int, list[int]] = {}
    boilerplate: list[tuple[int, int, float]] = []
    for kind, value, top in walk(html, weights):
        own = value
        if kind == "tag":
            score, passed = weights.tag(value, top), _PASSED_TAG
            items.append(None if value in _BLOCKS else "" if value in _SPACES else "\0")
        else:
            score, passed = weights.word(top), 0.0
            own = unescape(value) if "&" in value else value
            items.append(own if score > 0 else "\0")
            score *= len(own.split())
        scores.append(score)
        if score > 0:
            content.setdefault(top.outermost, [len(scores), 0])[1] = len(scores)
            if top.whole or top.inside:
                content.setdefault(0, [len(scores), 0])[1] = len(scores)
        elif score < passed and top.boilerplate:
            boilerplate.append((len(scores), top.outermost, passed))
    # Boilerplate with content before and after it in one element does not end a region.
    for at, outermost, passed in boilerplate:
        for n in (outermost, 0):
            if n in content and content[n][0] < at < content[n][1]:
                scores[at - 1] = passed
    start, end = best_run(scores)
    blocks, block = [], []
    for item in [*items[start:end], None]:
        if item is None:
            text = " ".join("".join(block).split())
            if text:
                blocks.append(text)
            block = []
        elif item == "":
            block.append(" ")
        elif item != "\0":
            block.append(item)
    return "\n".join(blocks)


def extract(pages: DataFrame, *, labelled: Iterable[str] = LABELLED_PAGES) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page.

    Null html is an empty page; pages without a region of positive score have empty text. Rows
    with equal ids are pages of their own, and an empty table gives no rows.
    """
    labelled = tuple(labelled)

    def extracted(batches):
        weights = Weights(labelled)
        for batch in batches:
            html = batch.column("html").to_pylist()
            for low in range(0, len(html), 500):
                texts = [main_text(h or "", weights) for h in html[low : low + 500]]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("page_id").slice(low, len(texts)),
                        batch.column("url").slice(low, len(texts)),
                        pa.array(texts, pa.string()),
                        pa.array([len(t) for t in texts], pa.int64()),
                    ],
                    ["page_id", "url", "text", "n_chars"],
                )

    schema = "page_id bigint, url string, text string, n_chars bigint"
    return map_batches(pages, ["page_id", "url", "html"], extracted, schema)
