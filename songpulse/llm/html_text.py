"""Main text of web pages by the distribution of text over line blocks.

Markup is stripped to lines, one per block element, without what is never part of an article
(scripts, styles, navigation, headers, footers, asides, forms, adverts, notices, comments).
An excluded element is one by its tag, role or class and id names (``_excluded_names``).
Sums of text length, links not counted, over windows of ``WINDOW`` lines rise at a surge and fall
at a dive; the stretch between them that holds most text is the main text. Stretches of one element,
or with only short lines between them, are one, and headings and short blocks of the element
next to its ends belong to it; without a dense window the longest line takes its place. If most of that stretch is
inside one article or main element, its ends are moved to the element's: inside it a short paragraph is text, outside
it none is. An article with a line of text that is no link stands before denser text outside of it, and dense
articles next to each other in one main are one text.

Defined cases: NULL or empty html gives the empty text, as does a page without lines; malformed
or unclosed tags are read as far as they go (an unclosed excluded element ends with the
element around it, and an article or main that opens in it counts); pages of any length are read whole, in a time
that grows with their length; repeated rows give equal
rows; further columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Lines per window, and the sum of text length at which a window counts as dense.
WINDOW = 3
DENSE = 80

# Element and attribute names of HTML.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody tfoot thead tr ul".split()
)
RAW = frozenset("script style title textarea noscript iframe template noembed noframes xmp".split())
EXCLUDED = frozenset("nav footer aside form head button select svg canvas object dialog menu datalist video audio math".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ROOTS = frozenset("article main".split())
EXCLUDED_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
EXCLUDED_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adslot sponsor sponsored promo promotion banner cookie"
    " cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login share sharing"
    " social related recommended recommendations sidebar widget menu nav navbar navigation breadcrumb breadcrumbs masthead footer"
    " comment comments reply replies respond disqus toolbar pagination pager search skip".split()
)
#: A class or id counts as a whole: see ``_excluded_names``. These may stand beside the names above in one (site-footer, comment-list).
PLACES = frozenset("site top bottom left right global list box bar buttons links posts".split())
#: What a box of such a kind is called (ad-container, comments-area, related-articles, newsletter-form).
BOXES = frozenset(
    "area articles block body box card cell column container content counter cta entry form frame group header holder icon icons inner"
    " item items label layer link list message module outer overlay panel placeholder popup posts region row section slot space spot"
    " stories strip thread title unit widget wrap wrapper zone".split()
)
#: Names that say what a page or its text has, is about or lacks; they name no box.
QUALIFIERS = frozenset("no not has have with without is tag tagged category cat type format topic hide hidden show".split())
COMMENTS = frozenset("comment comments reply replies respond disqus".split())
#: Names that themes also give to wrappers of the whole text.
LAYOUT = frozenset("sidebar widget banner popup modal overlay share sharing social subscribe subscription toolbar masthead search".split())
#: Text, links not counted, from which such an element can be a wrapper.
WRAPPED = 240
CELLS = frozenset("td th".split())
TEXT_BLOCKS = HEADINGS | frozenset(
    "p li ul ol dl dt dd pre blockquote address caption figcaption figure hgroup header hr summary table tbody tfoot thead tr".split()
)
#: Enclosing elements remembered for a line.
MOST_DEPTH = 64

_TAG_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_IN_TAG = re.compile(r"[>\"']")
_ATTR = re.compile(r"(class|id|role|style|hidden|aria-hidden|aria-label)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?(?=[\s/>]|$)", re.I)
_NAME = re.compile(r"[a-z0-9]+")


@dataclass(frozen=True)
class Tag:
    """Markup at [start, end) of a page; a comment or a declaration has no name."""

    start: int
    end: int
    name: str = ""
    closing: bool = False
    attrs: str = ""


class Tags:
    """Scanner for the tags of a page.

    No part of a page is read more than a few times, however it is malformed: what does not come any
    more after a place (``>``, a quote) is known from one look at the page's end.
    """

    def __init__(self, page: str):
        self.page = page
        self.last = {c: page.rfind(c) for c in ">\"'"}

    def next(self, at: int) -> Tag | None:
        """The first tag from ``at`` on; a ``<`` that opens none is text."""
        page = self.page
        while (start := page.find("<", at)) >= 0:
            if page.startswith("<!--", start):
                end = page.find("-->", start + 4)
                return Tag(start, len(page) if end < 0 else end + 3)
            if start > self.last[">"]:
                at = page.find("<!--", start)  # only an unclosed comment can come
                if at < 0:
                    return None
                continue
            closing = page.startswith("/", start + 1)
            name = _TAG_NAME.match(page, start + 1 + closing)
            if name:
                end = self._end(name.end())
                return Tag(start, end, name[0].lower(), closing, page[name.end() : end - 1])
            if page[start + 1 : start + 2] in ("!", "?", "/"):
                return Tag(start, page.find(">", start) + 1)
            at = start + 1
        return None

    def _end(self, at: int) -> int:
        """The end of a tag whose attributes begin at ``at``: behind the first ``>`` outside quotes, or, if a
        quote is not closed or none comes, behind the first at all."""
        first = self.page.find(">", at)
        place = at
        while m := _IN_TAG.search(self.page, place):
            if m[0] == ">":
                return m.end()
            if m.start() >= self.last[m[0]]:
                break  # not closed
            place = self.page.find(m[0], m.end()) + 1
        return first + 1


@dataclass
class Line:
    """Text of one block, its length without links, and the innermost article or main around it."""

    text: str
    weight: int
    root: int
    part: int = 0  # the excluded element around it inside its root
    inside: tuple[int, ...] = ()  # the elements around it that are more than one block of text
    heading: bool = False
    around: int = 0  # the article or main around its own one


@dataclass
class Part:
    """An excluded element, or an article or main inside one."""

    kind: str
    root: int
    outer: int  # the excluded element around it inside its root
    closed: bool = False


def _excluded_names(token: str) -> set[str]:
    """The excluded names that a class or id stands for.

    All of its parts are such names or places (site-footer); or the last part is one (primary-sidebar,
    post-comments); or the first is one and the last names a box or a size (comment-body, ad-300x250). None
    if a part only qualifies (has-sidebar, tag-ad) or the name goes on otherwise (related-work).
    """
    parts = _NAME.findall(token)
    if not parts or not QUALIFIERS.isdisjoint(parts):
        return set()
    if EXCLUDED_NAMES.issuperset(set(parts) - PLACES):
        return EXCLUDED_NAMES.intersection(parts)
    if parts[-1] in EXCLUDED_NAMES:
        return {parts[-1]}
    if parts[0] in EXCLUDED_NAMES and (parts[-1] in BOXES or parts[-1][0].isdigit()):
        return {parts[0]}
    return set()


def _excluded(name: str, attrs: str) -> str:
    """Kind of an element that holds no article text by itself: markup, layout, foreign or comment."""
    if name == "form":
        return "layout"
    if name in EXCLUDED:
        return "markup"
    if not attrs or name in ("html", "body"):
        return ""
    names: set[str] = set()
    for m in _ATTR.finditer(attrs):
        key, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if key == "hidden" or key == "aria-hidden" and value == "true":
            return "markup"
        if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return "markup"
        if key == "role" and value in EXCLUDED_ROLES:
            return "markup"
        if key in ("class", "id"):
            for token in value.split():
                names |= _excluded_names(token)
    if name in ROOTS:  # an article may say that it has a sidebar; one that is a comment is none
        names &= {"comment", "comments", "reply", "replies", "ad", "advert", "sponsored", "related", "promo"}
    if not names:
        return ""
    return "comment" if names & COMMENTS else "layout" if names <= LAYOUT else "foreign"


def lines(page: str) -> list[Line]:
    """The page's blocks of text in order, without excluded elements."""
    found: list[Line] = []
    words: list[str] = []  # of the current block
    linked = 0  # characters of it inside links
    links = 0
    header = 0  # open header elements; only headings of an article's header are kept
    heading = 0
    parts = [Part("", 0, 0)]
    roots = [Part("", 0, 0)]  # outer: the excluded element it is in, inside the root around it
    root = part = n_elements = 0
    inside: tuple[int, ...] = ()
    # Open elements: name, and what held before them.
    opened: list[tuple] = []
    places: dict[str, list[int]] = {}
    blocks: list[int] = []
    tops: list[int] = []  # articles, mains and what stands for them

    def flush() -> None:
        nonlocal linked
        raw = html.unescape("".join(words))
        text = " ".join(raw.split())
        if text and not (header and not (heading and root)):
            found.append(Line(text, max(0, len(text) - linked), root, part, inside, bool(heading), roots[root].root))
        words.clear()
        linked = 0

    def close(place: int, own: bool) -> None:
        """Ends the open elements from ``place`` on; the first by its ``own`` end tag."""
        nonlocal root, part, inside, links, header, heading
        while len(opened) > place:
            name, made, *before = opened.pop()
            places[name].pop()
            if blocks and blocks[-1] == len(opened):
                blocks.pop()
            if tops and tops[-1] == len(opened):
                tops.pop()
            if made:
                flush()
                if made > 0:
                    parts[made].closed = own and len(opened) == place
                root, part, links, heading = before[1:]
                header = 0 if made < 0 else header
            elif name == "header":
                header = max(0, header - 1)
            inside = before[0]

    at, tags = 0, Tags(page)
    while at < len(page):
        tag = tags.next(at)
        start = tag.start if tag else len(page)
        if start > at:
            words.append(page[at:start])
            if links:
                linked += start - at
        if not tag:
            break
        at = tag.end
        name, closing, attrs = tag.name, tag.closing, tag.attrs
        if not name:
            continue  # a comment, a declaration or a stray end tag
        if not closing and name in RAW:
            end = re.compile(rf"</{name}[\s/>]", re.I).search(page, at)
            at = page.find(">", end.start()) + 1 or len(page) if end else len(page)
            continue
        block = name in BLOCKS or name in EXCLUDED
        if name in BLOCKS:
            flush()
        elif name in ("br", "td", "th"):
            words.append(" ")
        if name in HEADINGS:
            heading = 0 if closing else 1
        if name == "a":
            links = max(0, links - 1) if closing else links + 1
        if closing:
            if name in ("body", "html"):
                close(0, False)
            elif places.get(name):
                # What was left open inside ends too, but inline elements end no block and others no article.
                place, limit = places[name][-1], (tops[-1] if tops else -1) if block or name in CELLS else blocks[-1] if blocks else -1
                limit = -1 if name in ROOTS else limit
                if place >= limit:
                    close(place, True)
            continue
        if name in VOID or attrs.endswith("/"):
            continue
        if name in ("body", "html"):
            close(0, False)
            continue
        if blocks and block and (opened[blocks[-1]][0] == "p" or opened[blocks[-1]][0] == name and name in ("li", "dt", "dd", "tr")):
            close(blocks[-1], False)
        kind, made = _excluded(name, attrs), 0
        before = (inside, root, part, links, heading)
        if kind:
            flush()
            made = len(parts)
            parts.append(Part(kind, root, part))
            part = made
        elif name in ROOTS:
            made = -len(roots)
            roots.append(Part("root", root, part))
            root, part, header, heading = len(roots) - 1, 0, 0, 0
        elif name == "header":
            header += 1
        if (block or name in CELLS) and name not in TEXT_BLOCKS:
            n_elements += 1
            inside = (*inside[-MOST_DEPTH:], n_elements)
        places.setdefault(name, []).append(len(opened))
        if block or name in CELLS:
            blocks.append(len(opened))
        if name in ROOTS:
            tops.append(len(opened))
        opened.append((name, made, *before))
    flush()
    close(0, False)
    return _kept(found, parts, roots)


def _kept(found: list[Line], parts: list[Part], roots: list[Part]) -> list[Line]:
    """The lines outside excluded elements, and those inside that are the page's text after all.

    An article or main inside an excluded element counts if the page has none of dense text outside;
    in one that is closed and not of layout only if the page has no dense text and no article or
    main with more than a heading, in closed comments never. A layout
    element that holds nearly all text of its article or page is a wrapper, not an addition.
    """
    released, counted = [False] * len(parts), [not r.outer for r in roots]
    released[0] = True

    def chosen() -> list[Line]:
        free, ok = [True], [True]
        for i in range(1, len(parts)):
            free.append(released[i] and free[parts[i].outer])
        for i in range(1, len(roots)):
            ok.append(ok[roots[i].root] and (free[roots[i].outer] or counted[i]))
        return [x for x in found if free[x.part] and ok[x.root]]

    def dense(some: list[Line]) -> bool:
        weights = [x.weight for x in some]
        return any(sum(weights[i : i + WINDOW]) >= DENSE for i in range(len(weights)))

    rest = chosen()
    if len(rest) == len(found):
        return rest
    rooted = [x for x in rest if x.root]
    if not dense(rooted):
        any_text = dense(rest) or any(x.weight and not x.heading for x in rooted)
        apart, comment = [False], [False]  # of a part or one around it
        for p in parts[1:]:
            apart.append(p.closed and p.kind != "layout" or apart[p.outer])
            comment.append(p.closed and p.kind == "comment" or comment[p.outer])
        counted = [not r.outer or not comment[r.outer] and not (apart[r.outer] and any_text) for r in roots]
        rest = chosen()

    wraps = [p.kind == "layout" or not p.closed and p.kind == "foreign" for p in parts]
    weights, others = [0] * len(parts), {}
    for x in found:
        weights[x.part] += x.weight
    for x in rest:
        others.setdefault(x.root, []).append(x)
    others[0] = rest
    small = {root: sum(x.weight for x in some) for root, some in others.items() if not dense(some)}
    small |= {p.root: 0 for p in parts if p.root not in others}
    for i in range(len(parts) - 1, 0, -1):
        if wraps[i] and wraps[parts[i].outer]:
            weights[parts[i].outer] += weights[i]
    for i, p in enumerate(parts[1:], 1):
        if wraps[p.outer]:
            released[i] = wraps[i] and released[p.outer]
        elif wraps[i] and not p.outer:
            released[i] = p.root in small and weights[i] >= max(WRAPPED, 3 * small[p.root])
    return chosen()


def _common(a: tuple[int, ...], b: tuple[int, ...]) -> tuple[int, ...]:
    """The elements of ``a`` down to the innermost one that is also in ``b``."""
    if a == b:
        return a
    other = set(b)
    return a[: max((i + 1 for i, e in enumerate(a) if e in other), default=0)]


def _around(some: list[Line]) -> tuple[int, ...]:
    """The elements that enclose all lines of some length."""
    full = [x.inside for x in some if x.weight >= DENSE // WINDOW] or [x.inside for x in some]
    return reduce(_common, full)


def _plain(x: Line) -> bool:
    """Whether most of a line is not links."""
    return 2 * x.weight >= len(x.text)


def densest(found: list[Line]) -> tuple[int, int]:
    """Lines [surge, dive) of the stretch with most text.

    Neighbouring stretches are one if the same element encloses them, or if no line between them
    is mostly links; none is joined over the ends of an article or main.
    """
    n = len(found)
    sums = [sum(x.weight for x in found[i : i + WINDOW]) for i in range(n)]
    joined: list[tuple[int, int]] = []
    around: tuple[int, ...] = ()  # of the last stretch
    i = 0
    while i < n:
        if sums[i] < DENSE:
            i += 1
            continue
        first = i
        while i < n and sums[i] >= DENSE:
            i += 1
        last = min(n, i - 1 + WINDOW)
        while first < last and found[first].weight < DENSE // WINDOW:
            first += 1  # the window rose before its text did
        while last > first and found[last - 1].weight < DENSE // WINDOW:
            last -= 1
        if first == last:
            continue
        before, around = around, _around(found[first:last])
        if joined:
            begin, end = joined[-1]
            same_root = all(x.root == found[first].root for x in found[end - 1 : first])
            if first <= end or same_root and (around == before or all(map(_plain, found[end:first]))):
                joined[-1] = begin, last
                continue
        joined.append((first, last))
    best = max(joined, key=lambda s: sum(x.weight for x in found[s[0] : s[1]]), default=(0, 0))
    if not joined and n:  # no dense window: the longest line, to be extended in its element
        first = max(range(n), key=lambda i: (found[i].weight, not found[i].heading))
        best = (first, first + 1)
    return best


def extended(found: list[Line], first: int, last: int) -> tuple[int, int]:
    """The stretch with the headings and short blocks next to it in its element, and a heading before that."""
    around = _around(found[first:last])
    within = lambda x: around[-1] in x.inside if around else not x.inside
    while first and within(x := found[first - 1]) and (x.heading or _plain(x)):
        first -= 1
    while last < len(found) and within(x := found[last]) and (x.heading or _plain(x)):
        last += 1
    while first and (x := found[first - 1]).heading and (not x.inside or x.inside[-1] in around):
        first -= 1
    return first, last


def _article(found: list[Line], first: int, last: int) -> list[int]:
    """The articles or mains that hold the main text; none if it is outside of them.

    That of most of the dense stretch or, if the stretch is outside, that of most text: an article of some
    text that is not links stands before what is around it. Articles of dense text next to it in the same main belong
    to it.
    """
    weights: dict[int, int] = {}
    for x in found[first:last]:
        weights[x.root] = weights.get(x.root, 0) + x.weight + 1
    root = max(weights, key=weights.get, default=0)
    if not root or 2 * weights[root] <= sum(weights.values()):
        texts: dict[int, int] = {}
        for x in found:
            if x.root and x.weight and not x.heading and _plain(x):
                texts[x.root] = texts.get(x.root, 0) + x.weight
        root = max(texts, key=texts.get, default=0)
    if not root:
        return []
    around = next(x.around for x in found if x.root == root)
    if not around:
        return [root]
    beside: dict[int, int] = {}
    for x in found:
        if x.root and x.around == around:
            beside[x.root] = beside.get(x.root, 0) + x.weight
    return [r for r, weight in beside.items() if r == root or weight >= DENSE]


def main_text(page: str | None) -> str:
    """The blocks of the main text, joined by an empty line."""
    found = lines(page or "")
    if not found:
        return ""
    first, last = densest(found)
    kept: list[Line] = []
    if roots := _article(found, first, last):
        for root in sorted(roots):
            inside = [i for i, x in enumerate(found) if x.root == root]
            # What lies between its first and last line and opened inside it.
            kept += [x for x in found[inside[0] : inside[-1] + 1] if x.root >= root and not (x.root != root and x.root in roots)]
    else:
        first, last = extended(found, first, last)
        kept = found[first:last]
    return "\n\n".join(x.text for x in kept)


def extract(pages: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``keep`` (default page_id and url) and ``text``; one row per page."""
    keep = keep or ["page_id", "url"]
    rows = pages.select(*keep, F.col("html").cast("string").alias("_html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array((main_text(v.as_py()) for v in batch.columns[-1]), pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], texts], [*keep, "text"])

    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]
    return rows.mapInArrow(run, ", ".join([*kept, "text string"]))
